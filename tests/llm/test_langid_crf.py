"""The conditional random field: exact marginals, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
import pytest

from cubewise.llm import langid_crf as L

FIXTURE = "/root/testdata/sf0.001"


def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    potentials, switch = rng.random((6, 3)) + 0.01, rng.random((3, 3)) + 0.1
    expected = np.zeros((6, 3))
    for path in np.ndindex(*[3] * 6):
        weight = switch[:, path[0]].sum() * potentials[0, path[0]]
        for t in range(1, 6):
            weight *= switch[path[t - 1], path[t]] * potentials[t, path[t]]
        expected[np.arange(6), path] += weight
    expected /= expected.sum(axis=1, keepdims=True)
    assert np.allclose(L.forward_backward(potentials, np.array([6]), switch), expected)


def test_chained_blocks_against_one_pass():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 63, 64, 65, 130, 1000])
    potentials, switch = rng.random((lengths.sum(), 4)) + 0.01, rng.random((4, 4)) + 0.1
    got = L.forward_backward(potentials, lengths, switch)
    at = 0
    for n in lengths.tolist():
        p = potentials[at:at + n]
        f, b = [switch.sum(axis=0) * p[0]], [np.ones(4)]
        for t in range(1, n):
            x = f[-1] @ switch * p[t]
            f.append(x / x.sum())
            y = switch @ (p[n - t] * b[0])
            b.insert(0, y / y.sum())
        m = np.array(f) * np.array(b)
        assert np.allclose(got[at:at + n], m / m.sum(axis=1, keepdims=True))
        at += n


def test_gradient_against_finite_differences():
    rng = np.random.default_rng(3)
    lengths, labels = np.array([5, 1, 3]), 3
    scores, transitions = rng.normal(size=(9, labels)), rng.normal(size=(labels, labels))
    gold = rng.integers(labels, size=9)

    def likelihood(scores, transitions):
        switch, total, at = np.exp(transitions), 0.0, 0
        for n in lengths.tolist():
            def weight(path, at=at):
                w = switch[:, path[0]].sum() * np.exp(scores[at, path[0]])
                for t in range(1, len(path)):
                    w *= switch[path[t - 1], path[t]] * np.exp(scores[at + t, path[t]])
                return w
            total += np.log(weight(gold[at:at + n]) / sum(weight(p) for p in np.ndindex(*[labels] * n)))
            at += n
        return total

    by_score, by_transition = L.likelihood_gradient(np.exp(scores), lengths, transitions, gold)
    for values, got in ((scores, by_score), (transitions, by_transition)):
        for at in np.ndindex(*values.shape):
            kept = values[at]
            values[at] = kept + 1e-5
            up = likelihood(scores, transitions)
            values[at] = kept - 1e-5
            down = likelihood(scores, transitions)
            values[at] = kept
            assert abs((up - down) / 2e-5 - got[at]) < 1e-6


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FIXTURE}/documents.parquet")
    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    rows = L.report(docs).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    seen = [r for r in rows if r["held_out"] and any(c.isalpha() for c in lang[r["doc_id"]][1])]
    assert sum(r["lang_pred"] == lang[r["doc_id"]][0] for r in seen) >= 0.95 * len(seen)
    assert all(0 <= r["score"] <= 1 for r in rows)

    # Words of texts spliced from two languages.
    model = L.fit(L.sample(docs))
    rng = random.Random(2)
    spans = {}
    for d, (label, text) in lang.items():
        if zlib.crc32(str(d).encode()) % 4 == 2 and len(L.words_of(text)) > 30:
            spans.setdefault(label, []).append(L.words_of(text)[:25])
    right = total = 0
    for _ in range(40):
        a, b = rng.sample(sorted(spans), 2)
        x, y = rng.choice(spans[a]), rng.choice(spans[b])
        best = L.label_words(model, [x + y + x])[0].argmax(axis=1)
        gold = [a] * len(x) + [b] * len(y) + [a] * len(x)
        right += sum(model.labels[i] == g for i, g in zip(best, gold))
        total += len(gold)
    assert right >= 0.9 * total


def test_edge_cases(spark, docs_of):
    rows = [(i, f"{'hola que tal esto' if i % 2 else 'the and of with this'} w{i}") for i in range(60)]
    docs = docs_of([*rows, (100, None), (101, ""), (102, "12 + 3 = !"), (103, "x" * 300_000), (None, "the and of"),
                    (104, "the " * 100_000), (5, "the"), (5, "the")])
    docs = docs.selectExpr("doc_id", "text", "if(text like 'hola%', 'es', if(text like 'the and%', 'en', null)) as lang", "1 as score")
    got = {r["doc_id"]: r for r in L.report(docs).collect()}
    assert L.report(docs).count() == docs.count()
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (100, 101, 102))
    assert got[104]["lang_pred"] == got[None]["lang_pred"] == "en" and got[103]["lang_pred"] in ("en", "es")
    assert not got[None]["held_out"]
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in L.report(unlabelled).collect()} == {"und"}
    assert L.report(docs.limit(0)).collect() == []


def test_sample_is_bounded_and_varied(spark, monkeypatch):
    rows = [(None, f"the and of {i}", "en") for i in range(600)] + [(i, f"of with {i}", "en") for i in range(300)]
    a, b = [i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2][:2]
    rows += [(a, f"hola que {i}", "es") for i in range(500)] + [(b, "tal esto", "es")] * 800
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    brought, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: brought.append(len(out := collect(self))) or out)
    got = L.sample(docs, per_language=20)
    assert max(brought) <= 2 * 2 * (4 * 20 + 20)
    for lang in ("en", "es"):
        texts = [t for t, label in got if label == lang]
        assert len(texts) == len(set(texts)) == 20
    assert any("with" in t for t, _ in got)
    assert sorted(got) == sorted(L.sample(docs.repartition(5), per_language=20))


def test_every_letter_of_a_long_run_counts():
    rng = random.Random(4)
    run = {lang: "".join(rng.choice(letters) for _ in range(4000)) for lang, letters in (("a", "abcdefg"), ("b", "tuvwxyz"))}
    model = L.fit([(run[lang][i:i + 400], lang) for lang in run for i in range(0, 4000, 400)])
    text = run["a"][:30] + run["b"][:500] + run["a"][:30]
    words = L.words_of(text)
    assert "".join(words) == text and max(map(len, words)) <= L.LONGEST_WORD
    share = L.label_words(model, [words])[0].mean(axis=0)
    assert model.labels[int(share.argmax())] == "b"


def test_bounds_reject_what_no_learned_language_accounts_for(spark, docs_of):
    docs = spark.read.parquet(f"{FIXTURE}/documents.parquet")
    model, bounds = L.fit_calibrated(L.sample(docs, per_language=200))
    foreign = {
        -1: "Příliš žluťoučký kůň úpěl ďábelské ódy v noci na jaře a v létě", -2: "asdkjh qwoieu zxmcnb qpwoei alskdj zmxncb",
        -3: "Быстрая коричневая лиса прыгает через ленивую собаку", -4: "这是一个中文的句子 我们正在测试语言识别",
        -5: "Hyvää päivää kaikille ystäville jotka asuvat tässä kaupungissa nyt", -6: "12 + 3", -7: None}
    clean = [(r["doc_id"], r["text"]) for r in docs.collect() if L.words_of(r["text"] or "")] + [(10 ** 6, "Ok")]
    kept = L.keep_identified(docs_of([*clean, *foreign.items()]), model, bounds)
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & foreign.keys()
    assert len(ids) >= 0.99 * len({i for i, _ in clean}) and 10 ** 6 in ids


def test_familiarity_by_hand():
    model = L.Model(["a"], {}, np.zeros((L.FEATURES, 1)), np.zeros((1, 1)))
    model.learn_trigrams(L.trigrams(["one", "two"])[0])
    known = {"<on", "one", "ne>", "<tw", "two", "wo>"}
    texts = [["one", "three"], [], ["x"], ["two", "tone", "one"]]
    for text, value in zip(texts, L.familiarity(model, texts).tolist(), strict=True):
        grams = [f"<{w}>"[i:i + 3] for w in text for i in range(len(w))]
        assert value == (sum(g in known for g in grams) + L.PRIOR_TRIGRAMS) / (len(grams) + L.PRIOR_TRIGRAMS)


def test_segments(spark):
    docs = spark.read.parquet(f"{FIXTURE}/documents.parquet")
    model = L.fit(L.sample(docs))
    some = docs.where("doc_id < 20")
    for r in L.segments(some, model).join(some, "doc_id").collect():
        assert sum(s["words"] for s in r["segments"]) == len(L.words_of(r["text"]))


def test_all_rows_are_learned_from(spark, docs_of, monkeypatch):
    monkeypatch.setattr(L, "sample", lambda *a, **k: pytest.fail("a sample"))
    rows = [(i, f"the and of with this w{i}", "en") for i in range(900)] + [(1000 + i, f"hola que tal esto p{i}", "es") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    counts = {(r["lang"], r["word"]): r["n"] for r in L.counted_words(docs).collect()}
    assert counts["en", "the"] == counts["es", "hola"] == 900 and len(counts) == 11
    slices = [[(0, w.split())] for w in ("a b c", "d " * 200, "")]
    model = L.Model(["x"], {}, np.zeros((L.FEATURES, 1)), np.zeros((1, 1)))
    assert L.train(model, iter(slices)) == 203
    texts = [(n % 2, [f"{n}-{i}" for i in range(90 * n)]) for n in range(6)]
    words, gold = L.spans(texts, np.random.default_rng(1))
    assert sorted(words) == sorted(w for _, t in texts for w in t)
    assert all(int(w.split("-")[0]) % 2 == g for w, g in zip(words, gold))
    model = L.fit_all(docs)
    assert model.labels == ["en", "es"] and all(model.seen[L.trigrams(["hola", "with"])[0]])
    for label, text in (("en", "with this and the"), ("es", "esto tal que hola")):
        assert model.labels[int(L.label_words(model, [L.words_of(text)])[0].mean(axis=0).argmax())] == label


def test_bounds_of_all_rows(spark):
    docs = spark.read.parquet(f"{FIXTURE}/documents.parquet").select("doc_id", "text", "lang")
    foreign = [(-1, "Příliš žluťoučký kůň úpěl ďábelské ódy v noci na jaře a v létě", None),
               (-2, "asdkjh qwoieu zxmcnb qpwoei alskdj zmxncb", None), (-3, "Быстрая коричневая лиса прыгает через собаку", None),
               (-6, "12 + 3", None), (-7, None, None)]
    both = docs.unionByName(spark.createDataFrame(foreign, docs.schema)).repartition(3)
    kept = {r["doc_id"] for r in L.identified_by_all(both).collect()}
    clean = {r["doc_id"] for r in docs.collect() if L.words_of(r["text"] or "")}
    assert not kept & {-1, -2, -3, -6, -7} and len(kept & clean) >= 0.99 * len(clean)
    assert L.identified_by_all(docs.limit(0)) is None
    lone = spark.createDataFrame([(i, "hola que", "es") for i in range(8)], docs.schema)
    assert L.identified_by_all(lone).count() == 8
