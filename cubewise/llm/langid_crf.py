"""Language identification of words by a linear-chain conditional random field.

A text's words (runs of letters, longer ones in pieces of ``LONGEST_WORD``) are
labelled jointly. A word's features are its
prefixes and suffixes, its character bigrams and trigrams and its entry in the lexicon of
frequent training words, all lower-cased; neighbouring labels have learned
transition weights. Forward-backward gives each word the probability of each
language given the whole text, so code-switched text is labelled word by word. A
document's language is the one with the largest share of its words; the score is
that share.

The model is fitted on a bounded sample of labelled rows: at most
``SAMPLE_PER_LANGUAGE`` distinct documents of each language, those with the smallest
hash of their id and text, whole. Training sequences are cut from those documents and joined
across languages, so that transitions are learned from switches too. Weights are
fitted by stochastic gradient ascent on the conditional likelihood (AdaGrad).

Prediction reads whole texts. Messages are passed in blocks of words: all blocks
of a batch step together, and the blocks of one text are chained by their transfer
matrices, so a text of any length costs its length.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is
every text if nothing was learned (no labelled rows); ties go to the language that
sorts first; a label is learned if it has at least one word; repeated rows and rows
without an id are predicted like any others; an empty table gives no rows; other
columns are dropped.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubewise.llm.byte_bpe import small_batches
from cubewise.llm.common import LAST_ID, by_name, lean, stored, text_or_empty

UNDETERMINED = "und"
SAMPLE_PER_LANGUAGE = 150
CALIBRATION_PER_LANGUAGE = 50
LEXICON_WORDS = 4000  # a language
FEATURES = 1 << 15
TRIGRAMS = 1 << 20
# Words of the language and seen trigrams that a text is taken to have besides its own, so that a short
# one is not judged by two or three.
PRIOR_WORDS = 6
PRIOR_TRIGRAMS = 6
SEQUENCE_WORDS = 64
SEQUENCES = 2400
BATCH = 48
EPOCHS = 2
FIRST_UPDATES = 60
RATE = 0.3
BLOCK_WORDS = 64
MEMORY_WORDS = 100_000
NEW_WORDS = 10_000  # whose features are computed at once
# A longer run of letters (scripts without spaces have them) is several words.
LONGEST_WORD = 40

_WORD = regex.compile(rf"\p{{L}}{{1,{LONGEST_WORD}}}")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(feature, word number) pairs of all the words at once: the bigrams and
    trigrams of ``<word>`` (its short affixes among them), its first three and
    last three and four letters, all as hashed numbers, and the lexicon's entries,
    which come after."""
    marked = [f"<{w}>" for w in words]
    size = np.array([len(m) for m in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(words)), size)
    room = end[owner] - np.arange(len(codes))
    flat, of = [], []

    def gram(at: np.ndarray, n: int) -> None:
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = (h ^ codes[at + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        flat.append((h >> np.uint64(20)).astype(np.int64) % FEATURES)
        of.append(owner[at])

    gram(np.flatnonzero(room >= 2), 2)
    gram(np.flatnonzero(room >= 3), 3)
    gram((end - size)[size >= 5], 4)
    gram((end - 4)[size >= 5], 4)
    gram((end - 5)[size >= 6], 5)
    entries = [(FEATURES + lexicon[w], i) for i, w in enumerate(words) if w in lexicon]
    known = np.array(entries, np.int64).reshape(-1, 2)
    return np.concatenate([*flat, known[:, 0]]), np.concatenate([*of, known[:, 1]])


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigram of ``<word>``, word number) pairs of all the words at once."""
    marked = [f"<{w}>" for w in words]
    size = np.array([len(m) for m in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    at = np.flatnonzero(np.cumsum(size)[owner] - np.arange(len(codes)) >= 3)
    h = (codes[at] << np.uint64(42) | codes[at + 1] << np.uint64(21) | codes[at + 2]) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(44)).astype(np.int64) % TRIGRAMS, owner[at]


class RowNumbers(dict):
    """word -> its row; words asked for the first time are listed in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.new.append(word)
        return row


class Model:
    """Labels, lexicon and weights; small, and sent to the tasks as it is."""

    def __init__(self, labels: list[str], lexicon: dict[str, int], weights: np.ndarray, transitions: np.ndarray):
        self.labels = labels
        self.lexicon = lexicon
        self.weights = weights
        self.transitions = transitions
        self.learn_trigrams(np.empty(0, np.int64))

    def learn_trigrams(self, seen: np.ndarray) -> None:
        """Numbers of the trigrams that the learned texts have (for ``familiarity``)."""
        self.seen = np.zeros(TRIGRAMS, bool)
        self.seen[seen] = True
        self.memory = RowNumbers()
        self.scores = np.zeros((1024, len(self.labels)))
        self.shared = np.zeros((1024, 2))  # a word's trigrams: seen, all

    def __getstate__(self) -> tuple:
        return self.labels, self.lexicon, self.weights.astype(np.float32), self.transitions, np.flatnonzero(self.seen)

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state[:4])
        self.learn_trigrams(state[4])

    def rows(self, words: list[str]) -> np.ndarray:
        """Row numbers in ``scores`` of the words' label scores."""
        memory = self.memory
        if len(memory) > MEMORY_WORDS:
            memory.clear()
        known = len(memory)
        out = np.fromiter(map(memory.__getitem__, words), np.int64, len(words))
        if memory.new:
            while len(memory) > len(self.scores):
                self.scores = np.concatenate((self.scores, np.zeros_like(self.scores)))
                self.shared = np.concatenate((self.shared, np.zeros_like(self.shared)))
            for at in range(0, len(memory.new), NEW_WORDS):
                part = memory.new[at:at + NEW_WORDS]
                flat, owner = word_features(part, self.lexicon)
                judged = self.seen.any()
                for label in range(len(self.labels)):
                    self.scores[known + at:known + at + len(part), label] = np.bincount(
                        owner, self.weights[flat, label], len(part))
                if judged:
                    gram, owner = trigrams(part)
                    self.shared[known + at:known + at + len(part), 0] = np.bincount(owner, self.seen[gram], len(part))
                    self.shared[known + at:known + at + len(part), 1] = np.bincount(owner, minlength=len(part))
            memory.new.clear()
        return out


def messages(potentials: np.ndarray, lengths: np.ndarray, switch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages of every word of chains laid end to end, each
    up to a factor.

    potentials: words x labels, positive; switch: labels x labels, positive. Before
    a chain's first word stands one of unknown label. Each chain is cut into blocks;
    ``inner`` is a block's transfer matrix."""
    total, labels = potentials.shape
    blocks = -(-lengths // BLOCK_WORDS)
    starts = np.cumsum(lengths) - lengths
    first_block = np.cumsum(blocks) - blocks
    chain = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(len(chain)) - first_block[chain]
    begin = starts[chain] + nth * BLOCK_WORDS
    size = np.minimum(BLOCK_WORDS, lengths[chain] - nth * BLOCK_WORDS)

    # Transfer of a block: from the label before it to the label of its last word.
    inner = np.broadcast_to(np.eye(labels), (len(chain), labels, labels)).copy()
    for step in range(int(size.max())):
        live = np.flatnonzero(size > step)
        moved = inner[live] @ switch * potentials[begin[live] + step][:, None, :]
        inner[live] = moved / moved.max(axis=(1, 2), keepdims=True)

    # Messages into each block from the left, and into its end from the right.
    left = np.ones((len(chain), labels))
    right = np.ones((len(chain), labels))
    for n in range(1, int(blocks.max())):
        at = np.flatnonzero(nth == n) if n < 64 else first_block[blocks > n] + n
        message = np.einsum("bi,bij->bj", left[at - 1], inner[at - 1])
        left[at] = message / message.max(axis=1, keepdims=True)
    last = first_block + blocks - 1
    for n in range(1, int(blocks.max())):
        at = last[blocks > n] - n
        message = np.einsum("bij,bj->bi", inner[at + 1], right[at + 1])
        right[at] = message / message.max(axis=1, keepdims=True)

    # Inside the blocks, all of them a word at a time.
    forward = np.empty_like(potentials)
    for step in range(int(size.max())):
        live = np.flatnonzero(size > step)
        at = begin[live] + step
        before = left[live] if step == 0 else forward[at - 1]
        message = before @ switch * potentials[at]
        forward[at] = message / message.max(axis=1, keepdims=True)
    backward = np.empty_like(potentials)
    end = begin + size - 1
    for step in range(int(size.max())):
        live = np.flatnonzero(size > step)
        at = end[live] - step
        if step == 0:
            backward[at] = right[live]
        else:
            message = (backward[at + 1] * potentials[at + 1]) @ switch.T
            backward[at] = message / message.max(axis=1, keepdims=True)
    return forward, backward


def forward_backward(potentials: np.ndarray, lengths: np.ndarray, switch: np.ndarray) -> np.ndarray:
    """Label probabilities of every word of chains laid end to end."""
    forward, backward = messages(potentials, lengths, switch)
    marginal = forward * backward
    return marginal / marginal.sum(axis=1, keepdims=True)


def likelihood_gradient(potentials: np.ndarray, lengths: np.ndarray, transitions: np.ndarray,
                        gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of the conditional log-likelihood of the labels ``gold`` by each
    word's label scores (words x labels) and by the transition weights: what is
    observed less what is expected. A pair's expectation joins the message into its
    left word, the transition, and the evidence of and beyond its right word."""
    switch = np.exp(transitions)
    forward, backward = messages(potentials, lengths, switch)
    marginal = forward * backward
    marginal /= marginal.sum(axis=1, keepdims=True)
    difference = -marginal
    difference[np.arange(len(gold)), gold] += 1

    first = np.zeros(len(gold), bool)
    first[np.cumsum(lengths) - lengths] = True
    right = np.flatnonzero(~first)
    slope = np.zeros_like(transitions)
    np.add.at(slope, (gold[right - 1], gold[right]), 1)
    pair = forward[right - 1][:, :, None] * switch * (potentials[right] * backward[right])[:, None, :]
    slope -= (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    # Given the first word's label, the label before it follows the column of switch.
    slope += switch / switch.sum(axis=0) * difference[first].sum(axis=0)
    return difference, slope


def label_words(model: Model, texts: list[list[str]]) -> list[np.ndarray]:
    """Label probabilities of the words of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    some = np.flatnonzero(lengths)
    out = [np.empty((0, len(model.labels)))] * len(texts)
    if len(some):
        rows = model.rows([w for t in texts for w in t])
        scores = model.scores[rows]
        potentials = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
        marginals = forward_backward(potentials, lengths[some], np.exp(model.transitions))
        for i, part in zip(some.tolist(), np.split(marginals, np.cumsum(lengths[some])[:-1]), strict=True):
            out[i] = part
    return out


def fit(sample: list[tuple[str, str]], seed: int = 0) -> Model | None:
    """Fit to (text, label) rows; None if no row has a word."""
    words = sorted((label, words_of(text)) for text, label in sample)
    words = [(label, w) for label, w in words if w]
    if not words:
        return None
    labels = sorted({label for label, _ in words})
    number = {label: i for i, label in enumerate(labels)}
    lexicon: dict[str, int] = {}
    for label in labels:
        counts = Counter(w for own, ws in words if own == label for w in ws)
        for word, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]:
            lexicon.setdefault(word, len(lexicon))
    model = Model(labels, lexicon, np.zeros((FEATURES + len(lexicon), len(labels))),
                  np.zeros((len(labels), len(labels))))

    rng = np.random.default_rng(seed)
    by_label = [[w for own, w in words if own == label] for label in labels]

    def span(label: int, n: int) -> list[str]:
        text = by_label[label][rng.integers(len(by_label[label]))]
        at = int(rng.integers(max(1, len(text) - n + 1)))
        return text[at:at + n]

    def sequence() -> tuple[list[str], list[int]]:
        # Half of them switch language, every few words up to every few dozen.
        parts, gold = [], []
        switching = rng.random() < 0.5
        label = int(rng.integers(len(labels)))
        while len(parts) < SEQUENCE_WORDS:
            piece = span(label, int(rng.integers(2, 24)) if switching else SEQUENCE_WORDS)
            parts += piece
            gold += [label] * len(piece)
            if switching:
                label = int(rng.integers(len(labels)))
        return parts[:SEQUENCE_WORDS], gold[:SEQUENCE_WORDS]

    sequences = [sequence() for _ in range(SEQUENCES)]
    distinct = sorted({w for text, _ in sequences for w in text})
    flat, owner = word_features(distinct, lexicon)
    by_word = flat[np.argsort(owner, kind="stable")]
    features = dict(zip(distinct, np.split(by_word, np.cumsum(np.bincount(owner))[:-1]), strict=True))
    squares = np.full_like(model.weights, 1e-2)
    moves = np.full_like(model.transitions, 1e-2)
    for epoch in range(EPOCHS):
        order = rng.permutation(len(sequences))
        for at in range(0, len(order), BATCH):
            batch = [sequences[i] for i in order[at:at + BATCH]]
            ids = [features[w] for text, _ in batch for w in text]
            counts = np.array([len(i) for i in ids])
            flat = np.concatenate(ids)
            owner = np.repeat(np.arange(len(ids)), counts)
            scores = np.zeros((len(ids), len(labels)))
            np.add.at(scores, owner, model.weights[flat])
            potentials = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
            lengths = np.full(len(batch), SEQUENCE_WORDS)
            gold = np.array([g for _, gs in batch for g in gs])
            difference, slope = likelihood_gradient(potentials, lengths, model.transitions, gold)
            gradient = np.zeros_like(model.weights)
            np.add.at(gradient, flat, difference[owner])
            touched = np.unique(flat)
            squares[touched] += gradient[touched] ** 2
            model.weights[touched] += RATE * gradient[touched] / np.sqrt(squares[touched])
            moves += slope ** 2
            model.transitions += RATE * slope / np.sqrt(moves)
    # Between -4 and 4, so that no text is held to one language by transitions alone.
    model.transitions = np.clip(model.transitions, -4, 4)
    return model


def familiarity(model: Model, texts: list[list[str]]) -> np.ndarray:
    """For each text's words the share of trigrams that the learned texts have."""
    rows = model.rows([w for t in texts for w in t])  # which may enlarge the tables
    counts = model.shared[rows]
    ends = np.cumsum([len(t) for t in texts])
    sums = np.concatenate((np.zeros((1, 2)), np.cumsum(counts, axis=0)))
    of_text = sums[ends] - sums[ends - [len(t) for t in texts]] + PRIOR_TRIGRAMS
    return of_text[:, 0] / of_text[:, 1]


class Bounds(NamedTuple):
    """What a text must reach to count as one of a learned language."""

    score: float
    familiar: dict[str, float]

    def reached(self, lang: str, score: float, words: int, familiar: float) -> bool:
        return (lang != UNDETERMINED and (score * words + PRIOR_WORDS) / (words + PRIOR_WORDS) >= self.score
                and familiar >= self.familiar.get(lang, 0.0))


def calibrate(model: Model, learned: list[tuple[str, str]], rows: list[tuple[str, str]]) -> Bounds:
    """Bounds from labelled rows that the model has not learned from: the score
    halfway between 1/K (no language of K) and their smallest; for each language half
    their smallest familiarity, none where there is no such row."""
    model.learn_trigrams(np.concatenate([trigrams(words_of(text))[0] for text, _ in learned]))
    texts = [w for w in (words_of(text) for text, _ in rows) if w]
    shares = [m.mean(axis=0) for m in label_words(model, texts)]
    known: dict[str, float] = {}
    for share, value in zip(shares, familiarity(model, texts).tolist(), strict=True):
        label = model.labels[int(share.argmax())]
        known[label] = min(known.get(label, 1.0), value / 2)
    chance = 1 / len(model.labels)
    least = min([float(s.max()) for s in shares], default=chance)
    return Bounds((chance + least) / 2 if len(model.labels) > 1 else 0.0, known)


def fit_calibrated(rows: list[tuple[str, str]]) -> tuple[Model | None, Bounds | None]:
    """Fit to three of four rows of each language, in the order of a hash of the
    text; calibrate on the others."""
    learned, others = [], []
    for label in sorted({label for _, label in rows}):
        own = sorted((zlib.crc32(text.encode("utf-8", "surrogatepass")), text) for text, of in rows if of == label)
        cut = -(-3 * len(own) // 4)
        learned += [(text, label) for _, text in own[:cut]]
        others += [(text, label) for _, text in own[cut:]]
    model = fit(learned)
    return model, calibrate(model, learned, others) if model else None


def held_out(doc_id: Column) -> Column:
    """Rows that the model must not learn from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           per_language: int = SAMPLE_PER_LANGUAGE) -> list[tuple[str, str]]:
    """At most per_language (text, label) rows of each language: those of the
    smallest hash of id and text, equal rows once. Three passes, each of which
    brings a bounded number of rows to the driver: the languages' counts of
    distinct hashes, from which a bound follows that some four times as many
    pass; those hashes; the texts of the chosen ones."""
    hashed = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
              .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                      F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col)), 1).alias("h")))
    counts = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    bounds = {r["lang"]: min(LAST_ID, (4 * per_language + 20) * (1 << 63) // max(1, r["n"])) for r in counts}
    if not bounds:
        return []

    def up_to(bounds: dict[str, int]) -> Column:
        return F.coalesce(*[F.when(F.col("lang") == lang, F.col("h") <= F.lit(h)) for lang, h in sorted(bounds.items())])

    candidates = hashed.where(up_to(bounds))
    chosen = {}
    for r in candidates.select("lang", "h").distinct().collect():
        chosen.setdefault(r["lang"], []).append(r["h"])
    last = {lang: sorted(hs)[:per_language][-1] for lang, hs in chosen.items()}
    rows = hashed.where(up_to(last)).groupBy("lang", "h").agg(F.array_min(F.collect_set("text")).alias("text"))
    return [(r["text"], r["lang"]) for r in sorted(rows.select("lang", "h", "text").collect())]


def counted_words(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of all rows of (text, lang)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in small_batches(batches, 200):
            for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts.update((lang, w) for w in words_of(text))
            if len(counts) > MEMORY_WORDS:
                yield counted(counts)
                counts.clear()
        yield counted(counts)

    def counted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang for lang, _ in counts], pa.string()), pa.array([w for _, w in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])

    return (rows.select("text", "lang").mapInArrow(lean(run), "lang string, word string, n bigint")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def spans(texts: list[tuple[int, list[str]]], rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """The words of all texts, each once, with their labels, laid end to end: half of
    the texts in spans of ``SEQUENCE_WORDS``, the others in spans of a few words up to a few
    dozen, in random order, so that sequences cut from them switch language."""
    whole, short = [], []
    for label, words in texts:
        switching = rng.random() < 0.5
        at = 0
        while at < len(words):
            n = int(rng.integers(2, 24)) if switching else SEQUENCE_WORDS
            (short if switching else whole).append((label, words[at:at + n]))
            at += n
    parts = [p for kind in (whole, short) for p in (kind[i] for i in rng.permutation(len(kind)))]
    gold = np.repeat([label for label, _ in parts], [len(p) for _, p in parts]).astype(np.int64)
    return [w for _, p in parts for w in p], gold


def train(model: Model, slices: Iterator[list[tuple[int, list[str]]]], seed: int = 0) -> int:
    """Gradient ascent (AdaGrad) over all words of all texts; how many. The first
    slices are gone over ``EPOCHS`` times. Batches grow, as the steps get smaller."""
    rng = np.random.default_rng(seed)
    squares = np.full_like(model.weights, 1e-2)
    moves = np.full_like(model.transitions, 1e-2)
    updates = total = 0
    for texts in slices:
        for _ in range(EPOCHS if updates < FIRST_UPDATES else 1):
            words, gold = spans(texts, rng)
            if not words:
                continue
            number: dict[str, int] = {}
            ids = np.array([number.setdefault(w, len(number)) for w in words])
            flat, owner = word_features(list(number), model.lexicon)
            starts = np.arange(0, len(words), SEQUENCE_WORDS)
            size = BATCH * (1 + updates // FIRST_UPDATES * 15)
            for chosen in np.array_split(rng.permutation(len(starts)), -(-len(starts) // size)):
                lengths = np.minimum(SEQUENCE_WORDS, len(words) - starts[chosen])
                at = np.repeat(starts[chosen] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
                # Features are looked at once a distinct word.
                used, place = np.unique(ids[at], return_inverse=True)
                here = np.zeros(len(number), bool)
                here[used] = True
                some = here[owner]
                feature, of = flat[some], np.searchsorted(used, owner[some])
                scores = np.stack([np.bincount(of, model.weights[feature, label], len(used))
                                   for label in range(len(model.labels))], axis=1)[place]
                potentials = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
                difference, slope = likelihood_gradient(potentials, lengths, model.transitions, gold[at])
                for label in range(len(model.labels)):
                    by_word = np.bincount(place, difference[:, label], len(used))
                    gradient = np.bincount(feature, by_word[of], len(model.weights))
                    squares[:, label] += gradient ** 2
                    model.weights[:, label] += RATE * gradient / np.sqrt(squares[:, label])
                moves += slope ** 2
                model.transitions += RATE * slope / np.sqrt(moves)
                updates += 1
        total += sum(len(w) for _, w in texts)
    return total


def fit_all(rows: DataFrame) -> Model | None:
    """Fit to all rows of (text, lang), none null: the lexicon's and the trigrams'
    counts are Spark aggregates, and every task trains on all its rows; the tasks'
    weights are averaged by their numbers of words. The driver gets the lexicon,
    the trigrams' numbers and one weight a feature and label, whatever the rows' number."""
    counts = stored(counted_words(rows), "words")
    labels = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not labels:
        return None
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    frequent = counts.withColumn("rank", rank).where(F.col("rank") <= LEXICON_WORDS).collect()
    lexicon: dict[str, int] = {}
    for r in sorted(frequent, key=lambda r: (r["lang"], r["rank"])):
        lexicon.setdefault(r["word"], len(lexicon))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(trigrams(batch.column(0).to_pylist())[0]))], names=["gram"])

    seen = counts.select("word").mapInArrow(lean(grams), "gram bigint").distinct().toArrow().column("gram").to_numpy()
    shape = (FEATURES + len(lexicon), len(labels))
    number = {label: i for i, label in enumerate(labels)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(labels, lexicon, np.zeros(shape), np.zeros((len(labels), len(labels))))
        n = train(model, ([(number[lang], words_of(text)) for text, lang in zip(*(c.to_pylist() for c in b.columns), strict=True)
                           if lang in number] for b in small_batches(batches, 200)))
        values = np.concatenate((model.weights.ravel(), model.transitions.ravel()))
        place = np.flatnonzero(values)
        if n:
            # The words count for places that this task left at zero, too.
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(place, -1)), pa.array(np.append(values[place] * n, n))], names=["place", "value"])

    sums = (rows.select("text", "lang").mapInArrow(lean(run), "place bigint, value double")
            .groupBy("place").agg(F.sum("value").alias("value")).toArrow())
    place, value = sums.column("place").to_numpy(), sums.column("value").to_numpy()
    flat = np.zeros(shape[0] * shape[1] + len(labels) ** 2)
    flat[place[place >= 0]] = value[place >= 0] / value[place < 0].sum()
    transitions = np.clip(flat[shape[0] * shape[1]:].reshape(len(labels), -1), -4, 4)
    model = Model(labels, lexicon, flat[:shape[0] * shape[1]].reshape(shape), transitions)
    model.learn_trigrams(seen)
    return model


def identified_by_all(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame | None:
    """The rows of docs whose text reaches the bounds of a learned language; None if there
    is nothing to learn from. Three of four labelled texts (by hash) are learned from,
    all of them; the bounds (see ``calibrate``) are the least of all others. A language
    whose texts all fall to the others is learned from them."""
    def labelled(i: Column, text: Column, lang: Column) -> Column:
        return lang.isNotNull() & text.isNotNull() & ~held_out(i)

    def other(text: Column) -> Column:
        return F.crc32(text.cast("binary")) % 4 == 3

    i, text, lang = F.col(id_col), F.col(text_col), F.col(lang_col)
    rows = docs.where(labelled(i, text, lang)).select(text.alias("text"), lang.alias("lang"), other(text).alias("other"))
    sides = rows.groupBy("lang").agg(F.count_if(~F.col("other")).alias("learned")).collect()
    few = [r["lang"] for r in sides if not r["learned"]]
    model = fit_all(rows.where(~F.col("other") | F.col("lang").isin(few))) if sides else None
    if model is None:
        return None
    judged = stored(predict(docs, model, text_col, measures=True), "judged")
    i, text, lang = (F.col(f"_{docs.columns.index(c)}") for c in (id_col, text_col, lang_col))
    least = (judged.where(labelled(i, text, lang) & other(text) & ~lang.isin(few) & (F.col("words") > 0))
             .groupBy("lang_pred").agg(F.min("score").alias("score"), F.min("familiar").alias("familiar")).collect())
    chance = 1 / len(model.labels)
    score = (chance + min([r["score"] for r in least], default=chance)) / 2 if len(model.labels) > 1 else 0.0
    familiar = F.lit(0.0)
    for r in least:
        familiar = F.when(F.col("lang_pred") == r["lang_pred"], F.lit(r["familiar"] / 2)).otherwise(familiar)
    share = (F.col("score") * F.col("words") + PRIOR_WORDS) / (F.col("words") + PRIOR_WORDS)
    return by_name(judged.where((F.col("lang_pred") != UNDETERMINED) & (share >= score) & (F.col("familiar") >= familiar)), docs)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", bounds: Bounds | None = None,
            measures: bool = False) -> DataFrame:
    """docs' columns as _0, _1, ... (so that no name clashes), lang_pred, score and,
    given bounds, whether the text reaches them; with ``measures`` its number of words
    and its familiarity."""
    names = docs.columns
    kinds = [f"`_{n}` {t}" for n, (_, t) in enumerate(docs.dtypes)]
    text_at = names.index(text_col)
    added = ["lang_pred", "score", *(["identified"] if bounds else ["words", "familiar"] if measures else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 200):
            texts = [words_of(t or "") for t in batch.column(text_at).to_pylist()]
            langs, scores = [], []
            for marginals in label_words(model, texts) if model else [()] * len(texts):
                if not len(marginals):
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                share = marginals.mean(axis=0)
                best = int(share.argmax())
                langs.append(model.labels[best])
                scores.append(min(1.0, float(share[best])))
            columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            if measures:
                columns += [pa.array([len(t) for t in texts], pa.int64()), pa.array(familiarity(model, texts), pa.float64())]
            elif bounds:
                known = familiarity(model, texts).tolist()
                columns.append(pa.array([bounds.reached(lang, score, len(t), k) for lang, score, t, k
                                         in zip(langs, scores, texts, known, strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=[f"_{n}" for n in range(len(names))] + added)

    kinds += ["lang_pred string", "score double", *(["identified boolean"] if bounds else ["words bigint", "familiar double"] if measures else [])]
    return (docs.select(*[F.col(c).alias(f"_{n}") for n, c in enumerate(names)])
            .mapInArrow(lean(run), ", ".join(kinds)))


def keep_identified(docs: DataFrame, model: Model, bounds: Bounds, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text reaches the bounds of a learned language."""
    kept = predict(docs, model, text_col, bounds).where("identified")
    return kept.select(*[F.col(f"_{n}").alias(c) for n, c in enumerate(docs.columns)])


def segments(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, segments array<struct<lang, words, score>>): a text's stretches of
    words of one language, in order."""
    kind = "array<struct<lang:string,words:int,score:double>>"
    arrow = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 200):
            out = []
            for marginals in label_words(model, [words_of(t) for t in batch.column(1).to_pylist()]):
                best = marginals.argmax(axis=1) if len(marginals) else np.empty(0, int)
                edges = [0, *(np.flatnonzero(np.diff(best)) + 1).tolist(), len(best)] if len(best) else []
                out.append([{"lang": model.labels[best[a]], "words": b - a, "score": float(marginals[a:b, best[a]].mean())}
                            for a, b in zip(edges, edges[1:], strict=False)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, arrow)], names=["doc_id", "segments"])

    return (docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
            .mapInArrow(run, f"doc_id {dict(docs.dtypes)[id_col]}, segments {kind}"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row a document."""
    model = fit(sample(docs, id_col, text_col, lang_col))
    return predict(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model).select(
        F.col("_0").alias("doc_id"), held_out(F.col("_0")).alias("held_out"), "lang_pred", "score")
