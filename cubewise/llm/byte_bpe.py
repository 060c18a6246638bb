"""Byte-level BPE encoding and decoding.

``encode`` turns each text into token ids by a rank file (every match of the
split pattern is merged separately, no special tokens), with each token's
offsets in bytes and in characters on request. ``decode`` turns ids back into
bytes and text through the byte table; a character whose bytes are split over
several tokens comes back whole because the bytes are joined before UTF-8 is
read.

The tokenizers library does the merging on Arrow batches. A rank file names
tokens, not merges: two neighbouring pieces merge when their join is a token,
the join of lowest rank first. ``merge_rules`` therefore lists every split of
every token into two tokens, by rank of the whole.

Defined cases: a null text counts as empty; an empty text has no tokens. Rows
repeat as they come; other columns are dropped, so their names cannot clash.
A text with an unpaired surrogate cannot occur in a Spark string.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubewise.llm.common import text_or_empty
from cubewise.llm.pretokens import BYTE_CHARACTERS, WHITE_SPACE, ChunkMemory, id_bytes

VOCABULARY = "byte_bpe_50k.tiktoken"
# Remembered words per Python worker.
MEMORY_WORDS = 500_000
# Unseen words that go to the tokenizer in one call.
LEARNT_AT_ONCE = 50_000

_loaded: dict[str, Encoder] = {}


class CutElsewhere(Exception):
    """The text has white space beside a space: not every space is a cut."""


class Encoder:
    """One worker's tokenizer for a rank file."""

    def __init__(self, vocabulary: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token_bytes[rank] = token
        self.token_lengths = np.array([len(t) for t in self.token_bytes], np.int64)
        model = models.BPE(vocab={spell(t): r for t, r in ranks.items()}, merges=merge_rules(ranks))
        self.tokenizer = Tokenizer(model)
        # Isolated matches cover the whole text: every character is white space or not.
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.chunk = regex.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")
        self.words = ChunkMemory(self.encode_word, MEMORY_WORDS)

    def encode_chunk(self, chunk: str) -> bytes:
        return id_bytes(self.tokenizer.encode_batch_fast([chunk], add_special_tokens=False)[0].ids)

    def learn(self, texts: list[str]) -> None:
        """Encode the words of texts that are not remembered, many in one call;
        a word's ids are those whose bytes make up its bytes."""
        new = self.words.expect({w for text in texts for w in text.split(" ") if w and w[-1] not in WHITE_SPACE})
        for at in range(0, len(new), LEARNT_AT_ONCE):
            some = new[at:at + LEARNT_AT_ONCE]
            ids = np.frombuffer(self.encode_chunk(" " + " ".join(some)), "<u4")
            ends = np.cumsum([1 + len(w.encode("utf-8")) for w in some])
            cuts = [0, *(4 * np.searchsorted(np.cumsum(self.token_lengths[ids]), ends) + 4).tolist()]
            raw = ids.tobytes()
            self.words |= {w: raw[a:b] for w, a, b in zip(some, cuts, cuts[1:])}

    def encode_word(self, word: str) -> bytes:
        """Ids of a word with the space before it."""
        if not word or word[-1] in WHITE_SPACE:
            raise CutElsewhere
        return self.encode_chunk(" " + word)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        A match never runs over a space that follows something other than
        white space, so the text may be cut there. Splitting at every space is
        right unless a word is empty or ends with other white space; then the
        cuts are searched for."""
        if not text:
            return b""
        words = text.split(" ")
        try:
            if not words[-1] or not words[0] or words[0][-1] in WHITE_SPACE:
                raise CutElsewhere
            return self.encode_chunk(words[0]) + b"".join(map(self.words.__getitem__, words[1:]))
        except CutElsewhere:
            return b"".join(self.words[c[1:]] if c[0] == " " and c[-1] not in WHITE_SPACE else self.encode_chunk(c)
                            for c in self.chunk.findall(text))

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each token starts in bytes, and its first and one-past-last
        character. A token that holds part of a character counts the whole of it."""
        ends = np.cumsum(self.token_lengths[ids])
        starts = ends - self.token_lengths[ids]
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        return starts, character[starts], character[ends - 1] + 1

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))


def spell(token: bytes) -> str:
    return "".join(BYTE_CHARACTERS[b] for b in token)


def merge_rules(ranks: dict[bytes, int]) -> list[tuple[str, str]]:
    """Every split of a token into two tokens, by the rank of the whole."""
    return [(spell(token[:i]), spell(token[i:])) for token in sorted(ranks, key=ranks.__getitem__)
            for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    if vocabulary not in _loaded:
        _loaded[vocabulary] = Encoder(vocabulary)
    return _loaded[vocabulary]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           vocabulary: str = VOCABULARY, offsets: bool = False) -> DataFrame:
    """(id, ids), and with offsets (byte_start, char_start, char_end), one row a text."""
    id_type = dict(docs.dtypes)[id_col]
    schema = f"{id_col} {id_type}, ids array<int>"
    if offsets:
        schema += ", byte_start array<bigint>, char_start array<bigint>, char_end array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            enc.learn(texts)
            ids = [np.frombuffer(enc.encode(t), "<u4") for t in texts]
            columns = [batch.column(0), lists(ids, pa.int32())]
            if offsets:
                places = [enc.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
                columns += [lists([p[n] for p in places], pa.int64()) for n in range(3)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return docs.select(F.col(id_col), text_or_empty(F.col(text_col)).alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids",
           vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, bytes, text): the bytes the ids spell, and their text (bytes that are
    no UTF-8, as when ids were cut inside a character, read as U+FFFD). Null ids
    count as none; an id outside the vocabulary is an error."""
    id_type = dict(encoded.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in small_batches(batches):
            raw = [enc.decode(np.array(ids or [], np.int64)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary()), pa.array([r.decode("utf-8", "replace") for r in raw])],
                names=[id_col, "bytes", "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"{id_col} {id_type}, bytes binary, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of each text's ids and
    of the bytes those ids decode to, without moving either out of the task."""
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in small_batches(batches):
            n, ids_hex, decoded_hex = [], [], []
            texts = batch.column(1).to_pylist()
            enc.learn(texts)
            for text in texts:
                ids = enc.encode(text)
                n.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                decoded_hex.append(hashlib.sha256(enc.decode(np.frombuffer(ids, "<u4"))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(decoded_hex, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col(id_col), text_or_empty(F.col(text_col)).alias("text"))
            .mapInArrow(run, f"{id_col} {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that Python holds the ids of few texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(kind.to_pandas_dtype()), kind))
