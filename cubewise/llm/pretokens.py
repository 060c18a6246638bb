"""Token ids of whole texts by a BPE vocabulary, one space-separated chunk at a
time. A chunk's ids never depend on its neighbours, so each worker remembers
the ids of chunks it has seen (a bounded memory) and a text's ids are the
remembered pieces joined. Chunks seen for the first time go to the tokenizers
library."""

from __future__ import annotations

import re
import struct

# What both regular-expression engines of the tokenizer libraries call white space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"

# Remembered chunks per Python worker, and the longest chunk worth remembering.
MEMORY_CHUNKS = 250_000
MEMORY_CHUNK_CHARS = 64


class ChunkMemory(dict):
    """chunk -> its ids as bytes; ``encode`` answers for chunks not remembered.

    Two generations bound the memory: when the younger is full it becomes the
    older, and what is asked for again moves back into the younger."""

    def __init__(self, encode, size: int = MEMORY_CHUNKS):
        super().__init__()
        self.encode = encode
        self.size = size
        self.older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if len(chunk) <= MEMORY_CHUNK_CHARS:
            if 2 * len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def expect(self, chunks: set[str]) -> list[str]:
        """Hold what is remembered of the chunks in the younger generation, so that
        none is lost while they are in use; those not remembered are returned."""
        wanted = [c for c in chunks if c not in self and len(c) <= MEMORY_CHUNK_CHARS]
        if 2 * (len(self) + len(wanted)) > self.size:
            self.older = dict(self)
            self.clear()
            wanted = [c for c in chunks if len(c) <= MEMORY_CHUNK_CHARS]
        self |= {c: self.older[c] for c in wanted if c in self.older}
        return [c for c in wanted if c not in self.older]


def byte_characters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 stands for itself, the rest follows from code point 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in kept}
    for n, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + n)
    return table


BYTE_CHARACTERS = byte_characters()


def as_byte_characters(text: str) -> str:
    """The text's UTF-8 bytes, each as its printable stand-in."""
    return text.encode("utf-8").decode("latin-1").translate(BYTE_CHARACTERS)


# Characters on whose class (letter, digit, white space, other) all
# regular-expression engines and Unicode versions agree, and which no
# normalisation changes: Basic Latin without controls, precomposed Latin letters.
_PLAIN = re.compile("[!-~\n\t\r \xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u0148\u014a-\u017e]*")


def is_plain(chunk: str) -> bool:
    return _PLAIN.fullmatch(chunk) is not None


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)
