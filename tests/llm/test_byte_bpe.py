"""Byte-level BPE against the tiktoken library, and round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from cubewise.llm import byte_bpe as B


def reference():
    with open(public_tokenizers.path(B.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(1)
    out = ["", " ", "\n", "  a  b ", "a \n b\t\tc  ", "don't we'll 'S", "<|endoftext|> x", "漢字 かな 😀👨‍👩‍👧", "\x85 \xa0x　y",
           "é" * 1000, "ab" * 3000, "x" * 20_000, "\x00\x01 \x1c\x1d a", "İ ŉ ǅ ∑ ١٢٣ ½ á"]
    for _ in range(400):
        out.append("".join(rng.choice(" \n\tsab1é漢😀　\u0085-=*'tѣ") for _ in range(rng.randint(0, 40))))
    return out


def test_ids_are_tiktokens():
    own, theirs = B.encoder(), reference()
    for text in texts():
        ids = np.frombuffer(own.encode(text), "<u4")
        assert ids.tolist() == theirs.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_every_code_point():
    own, theirs = B.encoder(), reference()
    for cp in range(0, 0x110000, 7):
        if not 0xD800 <= cp < 0xE000:
            text = f"a{chr(cp)}1 {chr(cp)}\n{chr(cp)} !{chr(cp)}"
            assert np.frombuffer(own.encode(text), "<u4").tolist() == theirs.encode_ordinary(text)


def test_offsets_and_split_characters(docs_of):
    text = "né 漢字 😀!"
    row = B.encode(docs_of([(1, text)]), offsets=True).first()
    raw, at = text.encode(), [*row["byte_start"], len(text.encode())]
    assert b"".join(raw[a:b] for a, b in zip(at, at[1:])) == raw
    for a, b, first, last in zip(at, at[1:], row["char_start"], row["char_end"]):
        piece = text[first:last].encode()
        assert raw[a:b] in piece and first < last
    assert row["char_start"][0] == 0 and row["char_end"][-1] == len(text)
    # Some character spans several tokens, and still comes back.
    assert len(row["ids"]) > len(set(row["char_start"]))


def test_tables(docs_of):
    rows = [(n, t) for n, t in enumerate(texts()[:40])] + [(None, "x y"), (7, None), (7, None)]
    docs = docs_of(rows)
    back = B.decode(B.encode(docs)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(i), t or "") for i, t in rows)
    theirs = reference()
    expected = []
    for i, t in rows:
        ids = theirs.encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, B.round_trip(docs).collect()), key=str) == sorted(expected, key=str)
    assert B.round_trip(docs_of([])).collect() == []
