"""SentencePiece encoding and decoding for merge-type vocabularies.

``encode`` gives the ids that the sentencepiece library gives: the text is
normalised (a dummy space in front, spaces written as U+2581), cut into
characters, and neighbouring symbols are merged from a score-ordered agenda of
adjacent pairs: the pair whose join has the best score first, the leftmost of
equals. Characters outside the vocabulary are spelled by their bytes' pieces.

A merge's result is a vocabulary piece, so no merge runs over two neighbouring
characters that stand side by side in no piece. Texts are therefore cut before
runs of U+2581 and around line breaks (``Vocabulary`` verifies that no piece holds
such a neighbourhood), and each worker remembers the ids of chunks it has seen.

Every batch is checked against the library, whole text by whole text. The
library's ids are returned (they are the definition of right), and
``library_agrees`` says whether the agenda gave the same.

Defined cases: a null text counts as empty; an empty text has no tokens. Rows
repeat as they come; other columns are dropped, so their names cannot clash. A
very long text is encoded whole (its ids are held once, as a Python list, by
the library's interface); texts are taken in slices of ``SLICE_CHARS``
characters, so few are held at once. A text holding U+2581 decodes to spaces
there, as by the library.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubewise.llm.byte_bpe import lists
from cubewise.llm.common import text_or_empty
from cubewise.llm.pretokens import id_bytes

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
# Remembered chunks per Python worker.
MEMORY_CHUNKS = 400_000
# Characters of the texts that are encoded and checked in one call.
SLICE_CHARS = 400_000
# Chunks of more characters are merged one by one and not remembered.
LONG_CHUNK = 64
# Unseen chunks that are merged side by side.
LEARNT_AT_ONCE = 20_000
NO_JOIN = 1 << 30

_loaded: dict[str, Vocabulary] = {}


class Vocabulary:
    """One worker's pieces and scores of a model file, and the library's own processor."""

    def __init__(self, model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        path = public_tokenizers.path(model)
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        rules, trained = spec.normalizer_spec, spec.trainer_spec
        if (trained.model_type != trained.BPE or not trained.byte_fallback or rules.precompiled_charsmap
                or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces):
            raise ValueError(f"{model}: not a merge-type vocabulary with byte fallback and identity normalisation")
        if any(p.type in (4, 5) for p in spec.pieces):
            raise ValueError(f"{model}: user-defined or unused pieces need the library's own segmentation")
        self.pieces = {p.piece: (-p.score, n) for n, p in enumerate(spec.pieces) if p.type == 1}
        self.byte_ids = [0] * 256
        for n, p in enumerate(spec.pieces):
            if p.type == 6:
                self.byte_ids[int(p.piece[1:-1], 16)] = n
        # Cuts are exact where no piece holds the two characters side by side.
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in self.pieces):
            raise ValueError(f"{model}: pieces run over spaces or line breaks")
        self.chunk = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [str(n) for n in range(len(spec.pieces))]
        self.memory: dict[str, bytes] = {}
        # For many chunks at once: characters' ids, and the joins of two pieces by key.
        self.other = len(spec.pieces)  # a character outside the vocabulary joins nothing
        self.character = np.full(sys.maxunicode + 1, self.other, np.int64)
        for piece, (_, n) in self.pieces.items():
            if len(piece) == 1:
                self.character[ord(piece)] = n
        order = {cost: n for n, cost in enumerate(sorted({cost for cost, _ in self.pieces.values()}))}
        joins = sorted((self.pieces[p[:i]][1] * self.other + self.pieces[p[i:]][1], order[cost], n)
                       for p, (cost, n) in self.pieces.items() for i in range(1, len(p))
                       if p[:i] in self.pieces and p[i:] in self.pieces)
        self.join_key, self.join_rank, self.join_id = np.array(joins, np.int64).T.copy()

    def merge(self, chunk: str) -> list[int]:
        """Ids of a chunk of normalised text by the agenda."""
        pieces = self.pieces
        if (whole := pieces.get(chunk)) is not None and len(chunk) == 1:
            return [whole[1]]
        symbols: list[str] = list(chunk)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            if (found := pieces.get(chunk[i:i + 2])) is not None:
                agenda.append((found[0], i, i + 1, 2))
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            # A pair is stale once either side has been merged otherwise.
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                if (found := pieces.get(symbols[left] + symbols[nxt])) is not None:
                    heappush(agenda, (found[0], left, nxt, size + len(symbols[nxt])))
            prev = before[left]
            if prev >= 0 and (found := pieces.get(symbols[prev] + symbols[left])) is not None:
                heappush(agenda, (found[0], prev, left, len(symbols[prev]) + size))
        return [n for s in symbols if s for n in self.spell(s)]

    def spell(self, symbol: str) -> list[int]:
        found = self.pieces.get(symbol)
        return [found[1]] if found else [self.byte_ids[b] for b in symbol.encode("utf-8")]

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For symbols side by side the rank of their join's score (NO_JOIN: none) and its id."""
        key = np.where((left < self.other) & (right < self.other), left * self.other + right, -1)
        at = np.minimum(np.searchsorted(self.join_key, key), len(self.join_key) - 1)
        return np.where(self.join_key[at] == key, self.join_rank[at], NO_JOIN), self.join_id[at]

    def merge_many(self, chunks: list[str]) -> list[bytes]:
        """Ids of many short chunks: one agenda each, whose best pair (by rank, then
        place) is merged in every chunk at once until no chunk has a pair left."""
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")
        symbol, place = self.character[points], np.arange(len(points))
        owner = np.repeat(np.arange(len(chunks)), [len(c) for c in chunks])
        done = []

        def ranked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Ranks and joins of the symbols at ``at`` with the ones behind them."""
            nxt = np.minimum(at + 1, len(symbol) - 1)
            found, join = self.rank(symbol[at], symbol[nxt])
            return np.where((nxt > at) & (owner[nxt] == owner[at]), found, NO_JOIN), join

        ranks, joins = ranked(place)
        while len(symbol):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(ranks << 32 | np.arange(len(symbol)), starts)
            open_chunk = best >> 32 < NO_JOIN
            if not open_chunk.all():
                stays = np.repeat(open_chunk, np.diff(starts, append=len(symbol)))
                done.append((owner[~stays], symbol[~stays], place[~stays]))
                gone = np.cumsum(~stays)
                at = (best & 0xFFFFFFFF)[open_chunk]
                at = at - gone[at]
                symbol, place, owner, ranks, joins = (x[stays] for x in (symbol, place, owner, ranks, joins))
            else:
                at = best & 0xFFFFFFFF
            symbol[at] = joins[at]
            stays = np.ones(len(symbol), bool)
            stays[at + 1] = False
            at = at - np.arange(len(at))  # one symbol went in every chunk before
            symbol, place, owner, ranks, joins = (x[stays] for x in (symbol, place, owner, ranks, joins))
            if len(at):
                touched = np.concatenate([at, at[at > 0] - 1])
                ranks[touched], joins[touched] = ranked(touched)
        owner, symbol, place = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        owner, symbol, place = owner[order], symbol[order], place[order]
        bounds = np.searchsorted(owner, np.arange(len(chunks) + 1))
        raw = symbol.astype("<u4").tobytes()
        out = [raw[4 * a:4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for n in set(owner[symbol == self.other].tolist()):
            of = slice(bounds[n], bounds[n + 1])
            out[n] = id_bytes([i for s, p in zip(symbol[of].tolist(), place[of].tolist(), strict=True)
                               for i in ([s] if s < self.other else self.spell(chr(points[p])))])
        return out

    def cut(self, text: str) -> list[str]:
        return self.chunk.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as little-endian unsigned 32-bit integers."""
        cut = list(map(self.cut, texts))
        wanted: set[str] = set().union(*cut)
        new = wanted.difference(self.memory)
        if len(self.memory) + len(new) > MEMORY_CHUNKS:
            self.memory.clear()
            new = wanted
        long = [c for c in new if len(c) > LONG_CHUNK]
        for c in long:
            self.memory[c] = id_bytes(self.merge(c))
        short = list(new.difference(long)) if long else list(new)
        for at in range(0, len(short), LEARNT_AT_ONCE):
            some = short[at:at + LEARNT_AT_ONCE]
            self.memory.update(zip(some, self.merge_many(some), strict=True))
        out = [b"".join(map(self.memory.__getitem__, chunks)) for chunks in cut]
        for c in long:
            del self.memory[c]
        return out


def vocabulary(model: str = MODEL) -> Vocabulary:
    if model not in _loaded:
        _loaded[model] = Vocabulary(model)
    return _loaded[model]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts of rows, cut so that a slice has few characters or one row."""
    for batch in batches:
        texts = batch.column(1).to_pylist()
        ends = np.cumsum([len(t) for t in texts])
        at = 0
        while at < len(texts):
            held = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, held + SLICE_CHARS, "right")))
            yield batch.column(0).slice(at, to - at), texts[at:to]
            at = to


def encode_checked(voc: Vocabulary, texts: list[str]) -> Iterator[tuple[list[int], bool]]:
    """For every text the library's ids, and whether the agenda gave the same."""
    own = voc.encode_all(texts)
    for mine, ids in zip(own, voc.library.encode(texts, num_threads=1), strict=True):
        yield ids, np.array(ids, "<u4").tobytes() == mine


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """(id, ids array<int>, library_agrees), one row a text."""
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(model)
        for keys, texts in slices(batches):
            done = list(encode_checked(voc, texts))
            yield pa.RecordBatch.from_arrays(
                [keys, lists([np.array(ids, np.int32) for ids, _ in done], pa.int32()), pa.array([ok for _, ok in done])],
                names=[id_col, "ids", "library_agrees"])

    return (docs.select(F.col(id_col), text_or_empty(F.col(text_col)).alias("text"))
            .mapInArrow(run, f"{id_col} {id_type}, ids array<int>, library_agrees boolean"))


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """(id, text): what the library reads from the ids; null ids count as none."""
    id_type = dict(encoded.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = vocabulary(model).library
        for batch in batches:
            texts = [library.decode(ids) if ids else "" for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"{id_col} {id_type}, text string")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, library_agrees): digests of each
    text's ids (decimal, joined by commas) and of the text they decode to,
    without moving either out of the task."""
    id_type = dict(docs.dtypes)[id_col]
    schema = f"{id_col} {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, library_agrees boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(model)
        for keys, texts in slices(batches):
            n, ids_hex, text_hex, agrees = [], [], [], []
            for ids, ok in encode_checked(voc, texts):
                n.append(len(ids))
                ids_hex.append(hashlib.sha256(",".join(map(voc.names.__getitem__, ids)).encode()).hexdigest())
                text_hex.append(hashlib.sha256((voc.library.decode(ids) if ids else "").encode()).hexdigest())
                agrees.append(ok)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string()),
                 pa.array(agrees, pa.bool_())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", "library_agrees"])

    return (docs.select(F.col(id_col), text_or_empty(F.col(text_col)).alias("text")).mapInArrow(run, schema))
