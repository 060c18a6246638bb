import hashlib
import random

import numpy as np
import public_tokenizers
import sentencepiece

from cubewise.llm import piece_bpe

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_bpe.MODEL))
TEXTS = [
    "", " ", "   ", "\n", "plain words here", " two  spaces\n\nand   lines \n", "tab\tand\r\nreturn", "naïve Größe, 中文字 と かな",
    "\U0001f600\U0001f468‍\U0001f469 é̀", "▁literal▁ ▁", "<s></s><unk><0x0A>", "a" * 5000, "x y" * 3000,
    " " * 700 + "end", "null\x00inside", "ا ب ت", "The the THE. the,the",
]


def ids_of(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


def test_both_agendas_equal_the_library_on_random_texts():
    voc = piece_bpe.vocabulary()
    rng = random.Random(7)
    letters = "ab  \n\té中\U0001f600e the<0x0A>.▁\x00́-ing "
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for text, raw in zip(texts, voc.encode_all(texts), strict=True):
        assert ids_of(raw) == LIBRARY.encode(text), text
        assert [i for c in voc.cut(text) for i in voc.merge(c)] == LIBRARY.encode(text), text


def test_full_memory_is_emptied_and_results_stay(monkeypatch):
    voc = piece_bpe.vocabulary()
    monkeypatch.setattr(piece_bpe, "MEMORY_CHUNKS", 5)
    monkeypatch.setattr(piece_bpe, "LEARNT_AT_ONCE", 2)
    for _ in range(2):
        assert [ids_of(r) for r in voc.encode_all(TEXTS)] == LIBRARY.encode(TEXTS)
    assert all(len(c) <= piece_bpe.LONG_CHUNK for c in voc.memory)


def test_slices_hold_few_characters_or_one_row(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(piece_bpe, "SLICE_CHARS", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["", "abc", "x" * 50, "", "12345", "123456"])], ["i", "t"])
    got = [(k.to_pylist(), t) for k, t in piece_bpe.slices([batch])]
    assert [i for k, _ in got for i in k] == list(range(6)) and [t for _, ts in got for t in ts] == batch.column(1).to_pylist()
    assert all(len(ts) == 1 or sum(map(len, ts)) <= 10 for _, ts in got)


def test_query_equals_the_library(docs_of):
    rows = [(n, t) for n, t in enumerate(TEXTS)] + [(None, "no id"), (3, None), (4, "plain words here"), (4, "plain words here")]
    got = piece_bpe.round_trip(docs_of(rows)).collect()
    want = []
    for i, t in rows:
        ids = LIBRARY.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(LIBRARY.decode(ids).encode() if ids else b"").hexdigest(), True))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert piece_bpe.round_trip(docs_of([])).count() == 0


def test_encode_then_decode(docs_of):
    rows = [(n, t) for n, t in enumerate(TEXTS) if "▁" not in t]
    back = piece_bpe.decode(piece_bpe.encode(docs_of(rows)))
    assert dict(map(tuple, back.collect())) == dict(rows)
