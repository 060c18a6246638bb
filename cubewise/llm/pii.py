"""Surrogates for personal data.

Detected entities are replaced by keyed surrogates of the same kind: a phone
number by a phone number in the same punctuation, a card number by one of the same
network and checksum state, an address of a machine by another, a secret by one in
the same alphabet, an e-mail address letter for letter (each by one of its own
script; punctuation and the domain stay), a name by a pronounceable
one of the same script whose ending suits the gender that the title tells.

A name is all capitalised words after a title, of any script that has capitals,
with initials; particles (van, de la) stay. Its words are replaced wherever else they
stand capitalised in the document. Left out: names of documents that give them
no title, names that go on in the next line, scripts without capitals. Names
neither Latin nor Cyrillic get Latin surrogates.

Card numbers are 13 to 19 digits that start with 3 to 6, or 16 in 2221-2720, plain or
in groups of four or of 4-6-5 and 4-6-4. Phone numbers have a country code, ten digits
in groups or plain from 2 (with or without a 1 before), Russian grouping, or a leading 0 (plain 10 or 11
digits, pairs, area code and number). A secret goes up to white space or a quote,
inside quotes up to the closing one; punctuation that ends a sentence stays.
Left out: numbers of at most nine digits without code or 0, and plain ones of ten from 1,
which amounts, times and counts look like; after a sign and a space, unquoted words without a
digit, symbol or inner capital (prose); secrets of fewer than six characters; domains outside ASCII.

Coreference: the surrogate depends on the key, the kind and the entity's canonical
form, so one person's number, however punctuated, gets one surrogate in the whole
corpus. Distinctness: numbers, addresses and secrets go through a keyed permutation
of their own format (a Feistel network with cycle walking), names through a keyed
hash; then all distinct entities are checked in Spark. Of entities that share a
surrogate, or whose surrogate is an entity of the corpus itself, all but one take
their next candidate, until none collides. Only entities that moved to a later
candidate are sent back to the documents that hold them.

Defined cases: a null text stays null; a text without entities stays as it is, to
the byte; repeated rows and rows without an id are treated like any others; an
empty table gives no rows; other columns stay untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubewise.llm.byte_bpe import small_batches
from cubewise.llm.common import lean, stored

KEY = b"surrogates"  # production jobs pass their own
ROUNDS = 8
# Candidates after which an entity's format counts as full. E-mail addresses, secrets,
# names and phone numbers are lengthened long before.
MOST_ATTEMPTS = 64

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"


def _class(*categories: str) -> str:
    """The characters of these categories, as the inside of a regular expression's set."""
    of = [n for n in range(0x20000) if unicodedata.category(chr(n)) in categories]
    first = [n for k, n in enumerate(of) if not k or of[k - 1] != n - 1]
    last = [n for k, n in enumerate(of) if k == len(of) - 1 or of[k + 1] != n + 1]
    return "".join(f"{chr(x)}-{chr(y)}" for x, y in zip(first, last, strict=True))


_UPPER = _class("Lu", "Lt")
_IN_NAME = _class("Lu", "Lt", "Ll", "Lm", "Mn", "Mc")
# Capitalised words that end a name; small words that may stand inside one.
_NO_NAME = ("The|This|That|These|He|She|It|We|They|You|And|But|Or|In|On|At|Is|Was|Has|Had|For|To|Of|With|From|When|Then|If|"
            "Der|Die|Das|Ein|Eine|Er|Sie|Es|Wir|Und|Oder|Aber|Im|Am|Ist|War|Hat|El|La|Los|Las|Un|Una|En|Y|Pero|"
            "Le|Les|Une|Il|Elle|Et|Mais|Dans|Он|Она|Они|Это|И|Но|В|На|С")
_PARTICLE = ("van|von|de|del|della|dela|der|den|des|dem|la|las|los|le|du|di|da|dos|das|do|el|al|bin|ibn|ben|ter|ten|te|zu|zum|"
             "zur|vom|af|av|y|e|фон|ван|дер|де|да|ла|ди|ибн|аль")
_APOSTROPHE = "['\u2019]"
# A word of a name ends at a possessive s; one letter is an initial and has a dot.
_PART = (rf"(?:[dDlLO]{_APOSTROPHE})?(?!(?:{_NO_NAME})(?!\w))[{_UPPER}](?:[{_IN_NAME}]++(?:{_APOSTROPHE}(?!s(?!\w))[{_IN_NAME}]++)*+"
         rf"(?![\w])|\.(?=[ ]?[{_UPPER}]))")
_SMALL = rf"(?:(?:{_PARTICLE})[ -]|[dl]{_APOSTROPHE}(?=[{_UPPER}]))"
_NAME = rf"{_SMALL}*{_PART}(?:[ -]?(?<=[ .-]){_SMALL}*{_PART})*"
# Titles and the gender they tell.
TITLES = {"Mr": "m", "Herr": "m", "Señor": "m", "Monsieur": "m", "Господин": "m", "господин": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Señora": "f", "Madame": "f", "Mme": "f",
          "Госпожа": "f", "госпожа": "f", "Dr": "n", "Prof": "n"}
_SECRET_WORD = r"password|passwd|pwd|secret|token|api[_-]?key"
ENTITY = re.compile(
    r"(?P<email>(?<![\w.%+-])\w[\w.%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+)"
    rf"|(?:(?<!\w)(?i:{_SECRET_WORD})(?P<gap>[\"']?\s{{0,3}}[=:]\s{{0,3}})"
    r"(?:(?P<quote>[\"'])(?P<quoted>(?=[^\"']*\w)(?:(?!(?P=quote))[^\r\n]){6,}+)(?P=quote)"
    r"|[\"']?(?:(?<=[=:])|(?=[^\s\"']*[\d!#$%&*?@^~+/]|[^\s\"']*[^\W\d_A-ZÀ-ÖØ-Þ][A-ZÀ-ÖØ-Þ]))"
    r"(?P<secret>(?=[^\s\"']*\w)[^\s\"']{5,}(?<![.,;:)\]}>\\])(?<=[^\s\"']{6}))))"
    r"|(?P<key>(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w))"
    rf"|(?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<!\w)(?:(?:[3-6]\d{3}(?P<sep>[ -]?)\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7})"
    r"|(?:222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720)(?P<sep2>[ -]?)\d{4}(?P=sep2)\d{4}(?P=sep2)\d{4}"
    r"|3\d{3}(?P<sep3>[ -])\d{6}(?P=sep3)\d{4,5})(?!\w))"
    r"|(?P<phone>(?<![\w+])(?:(?:\+?\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}"
    r"|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}"
    r"|(?:\+?7|8)[ -]?\(?\d{3}\)?[ -]?\d{3}[ -]\d\d[ -]\d\d"
    r"|(?<!\d[.,])(?:1?[2-9]\d{9}|0\d{9,10})(?![.,]\d)"
    r"|(?<!\d[.,])0\d(?:[ .-]\d\d){4}|0\d{2,4}[ /-]\d{5,8}|0\d{2,4}(?:[ -]\d{3,4}){2})(?!\w))"
    rf"|(?:(?<!\w)(?P<title>{'|'.join(TITLES)})\.?[ ](?P<name>{_NAME}))")
# The words of a name, and where one may be mentioned without a title.
WORD = re.compile(rf"(?<![\w]){_PART}|(?<=[dl]['\u2019]){_PART}")
# A text without any of these holds no entity.
HINT = re.compile(rf"[\d@]|AKIA|ASIA|(?:{'|'.join(TITLES)})\.? |(?i:{_SECRET_WORD})[\"']?\s{{0,3}}[=:]")

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
SYMBOLS = "!#$%&*?@^~"
HEX, TOKEN = "0123456789abcdef", UPPER + DIGITS
SYLLABLES = {
    "latin": [c + v for c in ("b", "d", "f", "g", "h", "k", "l", "m", "n", "p", "r", "s", "t", "v", "w", "z")
              for v in ("a", "e", "i", "o", "u")],
    "cyrillic": [c + v for c in ("б", "в", "г", "д", "з", "к", "л", "м", "н", "п", "р", "с", "т") for v in ("а", "е", "и", "о", "у")],
}
ENDINGS = {("latin", "m"): "n", ("latin", "f"): "a", ("latin", "n"): "", ("latin", "family"): "r",
           ("cyrillic", "m"): "н", ("cyrillic", "f"): "я", ("cyrillic", "n"): "", ("cyrillic", "family"): "к"}


def permute(key: bytes, tweak: str, value: int, size: int, accept: Callable[[int], bool] = lambda n: True) -> int:
    """A keyed permutation of 0..size-1, and of those of its values that
    ``accept`` accepts (value among them): walk until one is met."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for n in range(ROUNDS):
            digest = hmac.digest(key, f"{tweak}|{n}|{half}|{right}".encode(), "sha256")
            left, right = right, left ^ int.from_bytes(digest[:16], "little") & mask if half <= 128 else left ^ (
                int.from_bytes(hashlib.shake_256(digest).digest(half // 8 + 1), "little") & mask)
        value = left << half | right
        if value < size and accept(value):
            return value


def permute_text(key: bytes, tweak: str, text: str, alphabets: list[str], accept: Callable[[str], bool] = lambda t: True) -> str:
    """Permute the texts that have a letter of alphabets[i] at place i; a place
    without alphabet keeps its character."""
    shape = "".join(c if not a else a[0] for c, a in zip(text, alphabets, strict=True))
    value, size = 0, 1
    for c, a in zip(text, alphabets, strict=True):
        if a:
            value, size = value * len(a) + a.index(c), size * len(a)

    def spell(n: int) -> str:
        out = []
        for c, a in zip(reversed(text), reversed(alphabets), strict=True):
            if a:
                n, digit = divmod(n, len(a))
                c = a[digit]
            out.append(c)
        return "".join(reversed(out))

    if size == 1:
        return text
    return spell(permute(key, f"{tweak}|{shape}", value, size, lambda n: accept(spell(n))))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def network_of(digits: str) -> str:
    if digits[0] == "2":
        return "2-series" if "2221" <= digits[:4] <= "2720" else "2"
    return "34" if digits[:2] in ("34", "37") else digits[0]


# The country codes of two digits; 1 and 7 have one, all others three.
TWO_DIGIT_CODES = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                   "81 82 84 86 90 91 92 93 94 95 98").split()


def country_code(number: str) -> str:
    """The plus sign and country code with which a number begins, if any."""
    if not number.startswith("+"):
        return ""
    return number[:2] if number[1] in "17" else number[:3] if number[1:3] in TWO_DIGIT_CODES else number[:4]


def candidate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The surrogate of a canonical entity; a later attempt gives another one."""
    tweak = f"{kind}|{attempt}"
    if kind in ("email", "secret"):
        # So many attempts mean that the format has too few members: lengthen it.
        entity = "a" * (attempt // 8) + entity
    if kind == "email":
        return permute_text(key, tweak, entity, [alphabet(c) for c in local(entity)])
    if kind == "ip":
        value = 0
        for octet in entity.split("."):
            value = value << 8 | int(octet)
        value = permute(key, tweak, value, 1 << 32)
        return ".".join(str(value >> shift & 255) for shift in (24, 16, 8, 0))
    if kind == "card":
        good = luhn(entity)
        # Networks that their first digit does not tell.
        network = network_of(entity)
        return permute_text(key, tweak, entity, ["", *[DIGITS] * (len(entity) - 1)],
                            lambda t: network_of(t) == network and luhn(t) == good)
    if kind == "phone":
        # A number with a country code keeps the code. So many attempts mean that the
        # format has too few numbers: lengthen it.
        entity += "0" * (attempt // 8)
        code = len(country_code(entity))
        return permute_text(key, tweak, entity, [""] * code + [DIGITS] * (len(entity) - code))
    if kind == "ssn":
        return permute_text(key, tweak, entity, [DIGITS] * len(entity))
    if kind == "key":
        return permute_text(key, tweak, entity, [""] * 4 + [TOKEN] * (len(entity) - 4))
    if kind == "secret":
        if set(entity) <= set(HEX):
            return permute_text(key, tweak, entity, [HEX] * len(entity))
        return permute_text(key, tweak, entity, [SYMBOLS if c in SYMBOLS else alphabet(c) for c in entity])
    _, script, part = kind.split("-")
    number = int.from_bytes(hmac.digest(key, f"{tweak}|{entity}".encode(), "sha256")[:8], "little")
    out = ""
    for _ in range(3 + attempt // 4):
        number, n = divmod(number, len(SYLLABLES[script]))
        out += SYLLABLES[script][n]
    return (out + ENDINGS[script, part]).capitalize()


@cache
def alphabet(c: str) -> str:
    """What may stand in c's place: letters of c's case and script (its block of
    128 code points), digits of its kind; nothing for punctuation."""
    for own in (LOWER, UPPER, DIGITS):
        if c in own:
            return own
    if c.isdecimal():
        zero = ord(c) - unicodedata.decimal(c)
        return "".join(map(chr, range(zero, zero + 10)))
    if not c.isalnum():
        return ""
    block = [chr(n) for n in range(ord(c) & ~127, (ord(c) | 127) + 1)]
    own = "".join(b for b in block if b == c or (b.isalpha() and b.isupper() == c.isupper()
                                                 and len(b.upper()) == len(b.lower()) == 1))
    return own if len(own) > 9 else LOWER + own


def local(email: str) -> str:
    """The address with everything from the @ on made unreplaceable."""
    at = email.index("@")
    return email[:at] + "@" * (len(email) - at)


def entities(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(kind, canonical form, start, end), in order, without overlap: what the
    patterns find, and every other mention of a name that a title told."""
    found = [*patterns(text)]
    names: dict[str, str] = {}
    for kind, entity, _, _ in found:
        if kind.startswith("name-") and len(entity) > 1:
            names.setdefault(entity, kind)
    at = 0
    for word in WORD.finditer(text) if names else ():
        entity = word[0].lower()
        if entity not in names:
            continue
        while at < len(found) and found[at][3] <= word.start():
            yield found[at]
            at += 1
        if at == len(found) or found[at][2] >= word.end():
            yield names[entity], entity, word.start(), word.end()
    yield from found[at:]


def patterns(text: str) -> Iterator[tuple[str, str, int, int]]:
    """What is told by its form, or by the title or word before it."""
    if not HINT.search(text):
        return
    for found in ENTITY.finditer(text):
        group = next(k for k in ("email", "secret", "quoted", "key", "ip", "ssn", "card", "phone", "name") if found[k] is not None)
        start, end = found.span(group)
        kind, surface = "secret" if group == "quoted" else group, found[group]
        if kind == "name":
            gender = TITLES[found["title"]]
            parts = [p for p in WORD.finditer(text, start, end + 1)]
            for n, part in enumerate(parts):
                script = "cyrillic" if "А" <= part[0][0] <= "я" or part[0][0] in "Ёё" else "latin"
                role = "family" if n == len(parts) - 1 else gender
                initial = part[0].endswith(".")
                yield f"name-{script}-{role}", part[0].lower().rstrip("."), part.start(), part.end() - initial
        elif kind == "email":
            yield kind, surface.lower(), start, end
        elif kind in ("ssn", "card", "phone"):
            digits = "".join(str(unicodedata.decimal(c)) for c in surface if c.isdecimal())
            # A North American number is the same with and without its prefix.
            if kind == "phone" and len(digits) == 11 and digits[0] == "1":
                digits = digits[1:]
            elif kind == "phone" and surface[0] == "+":
                digits = "+" + digits
            yield kind, digits, start, end
        elif kind == "ip":
            yield kind, ".".join(str(int(o)) for o in surface.split(".")), start, end
        else:
            yield kind, surface, start, end


def dress(kind: str, surface: str, surrogate: str) -> str:
    """The surrogate with the surface's punctuation and case."""
    if kind in ("ssn", "card", "phone"):
        surrogate = surrogate.removeprefix("+")
        places = [n for n, c in enumerate(surface) if c.isdecimal()]
        if kind == "phone" and len(places) == 11 and unicodedata.decimal(surface[places[0]]) == 1:
            surrogate = "1" + surrogate
        out = list(surface)
        for n, digit in zip(places, surrogate):
            # In the digits of the surface's own script.
            out[n] = chr(ord(surface[n]) - unicodedata.decimal(surface[n]) + int(digit))
        # A lengthened number goes on behind its last digit.
        out[places[-1]] += surrogate[len(places):]
        return "".join(out)
    if kind == "email":
        surface = surface.rjust(len(surrogate))
        return "".join(s.upper() if c.isupper() else s for c, s in zip(surface, surrogate, strict=True))
    if kind.startswith("name-") and len(surface) > 1 and surface.isupper():
        return surrogate.upper()
    return surrogate


def replace(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with surrogates, and (kind, start, end) of each in the new text."""
    out, spans, at, size = [], [], 0, 0
    for kind, entity, start, end in entities(text):
        new = dress(kind, text[start:end], candidate(key, kind, entity, attempts.get((kind, entity), 0)))
        out += [text[at:start], new]
        size += start - at
        spans.append((kind, size, size + len(new)))
        size += len(new)
        at = end
    return ("".join([*out, text[at:]]), spans) if out else (text, spans)


def found_entities(docs: DataFrame, text_col: str, key: bytes) -> DataFrame:
    """(kind, entity, attempt, surrogate): every distinct entity with its first candidate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {(k, e) for t in batch.column(0).to_pylist() if t for k, e, _, _ in entities(t)}
            yield rows([(k, e, 0, candidate(key, k, e, 0)) for k, e in sorted(seen)])

    return docs.select(F.col(text_col)).mapInArrow(lean(run), ENTITIES).groupBy("kind", "entity").agg(
        F.first("attempt").alias("attempt"), F.first("surrogate").alias("surrogate"))


ENTITIES = "kind string, entity string, attempt int, surrogate string"


def rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) if found else [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.string()), strict=True)],
        names=["kind", "entity", "attempt", "surrogate"])


def assign(found: DataFrame, key: bytes, first: Callable = candidate) -> DataFrame:
    """Move entities to later candidates until surrogates are distinct and none
    is an entity of the corpus."""
    table = stored(found, "entities")
    known = table.select("kind", F.lower("entity").alias("lowered")).distinct().withColumn("is_entity", F.lit(True))

    def next_candidate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield rows([(k, e, n + 1, first(key, k, e, n + 1))
                        for k, e, n in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)])

    while True:
        holder = table.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "entity"))["entity"].alias("holder"))
        marked = (table.withColumn("lowered", F.lower("surrogate"))
                  .join(holder, ["kind", "surrogate"]).join(known, ["kind", "lowered"], "left")
                  .select("kind", "entity", "attempt", "surrogate",
                          ((F.col("holder") != F.col("entity")) | F.coalesce("is_entity", F.lit(False))).alias("moves")))
        marked = stored(marked, "entities")
        moving = marked.where("moves").drop("moves")
        if moving.isEmpty():
            return marked.drop("moves")
        spent = [r["kind"] for r in moving.where(F.col("attempt") >= MOST_ATTEMPTS).select("kind").distinct().collect()]
        if spent:
            raise ValueError(f"no surrogates left for the formats of some entities of kind {', '.join(sorted(spent))}")
        table = stored(marked.where("not moves").drop("moves").unionByName(moving.mapInArrow(next_candidate, ENTITIES)), "entities")


def surrogates(docs: DataFrame, text_col: str = "text", key: bytes = KEY, first: Callable = candidate) -> DataFrame:
    """docs with the text replaced, and ``entities``: array<struct<kind,start,end>>
    of the surrogates in the new text (code points)."""
    moved = assign(found_entities(docs, text_col, key), key, first).where("attempt > 0").select("kind", "entity", "attempt")
    names = docs.columns
    rows_in = docs.select(*[F.col(c).alias(f"_{n}") for n, c in enumerate(names)])
    text_at = names.index(text_col)
    if moved.isEmpty():
        rows_in = rows_in.withColumn("_attempts", F.lit(None).cast("array<struct<kind:string,entity:string,attempt:int>>"))
    else:
        rows_in = with_attempts(rows_in, f"_{text_at}", moved)
    kinds = ", ".join(f"`_{n}` {t}" for n, (_, t) in enumerate(docs.dtypes))
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, places = [], []
            for text, attempts in zip(batch.column(text_at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                later = {(a["kind"], a["entity"]): a["attempt"] for a in attempts or []}
                new, found = (None, []) if text is None else replace(text, key, later)
                texts.append(new)
                places.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
            columns = list(batch.columns[:len(names)])
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(places, spans)],
                                             names=[f"_{n}" for n in range(len(names))] + ["_entities"])

    out = rows_in.mapInArrow(lean(run), f"{kinds}, `_entities` array<struct<kind:string,start:int,end:int>>")
    return out.select(*[F.col(f"_{n}").alias(c) for n, c in enumerate(names)], F.col("_entities").alias("entities"))


def with_attempts(docs: DataFrame, text_col: str, moved: DataFrame) -> DataFrame:
    """docs with ``_attempts``: the moved entities that each text holds. Texts are
    told by two hashes, so equal texts share the answer."""
    keys = [F.xxhash64(text_col), F.crc32(F.col(text_col).cast("binary"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out = [(a, b, k, e) for a, b, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) if t
                   for k, e in sorted({(k, e) for k, e, _, _ in entities(t)})]
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)],
                names=["_h", "_c", "kind", "entity"])

    held = (docs.select(keys[0].alias("_h"), keys[1].alias("_c"), text_col)
            .mapInArrow(lean(run), "_h bigint, _c bigint, kind string, entity string").distinct()
            .join(moved, ["kind", "entity"])
            .groupBy("_h", "_c").agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias("_attempts")))
    return (docs.withColumn("_h", keys[0]).withColumn("_c", keys[1]).join(held, ["_h", "_c"], "left").drop("_h", "_c"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = KEY) -> DataFrame:
    """(doc_id, text, n_entities, kinds, changed), one row a document."""
    done = surrogates(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", key)
    return done.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"),
                       F.array_join(F.transform("entities", lambda e: e["kind"]), ",").alias("kinds"),
                       (F.size("entities") > 0).alias("changed"))
