"""Personal data replaced by keyed, type-consistent surrogates."""

from __future__ import annotations

import bisect
import functools
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from drydock.llm.common import fresh, staged, unstaged

_LETTER = r"[^\W\d_]"
_NAME = rf"{_LETTER}+(?:['’]{_LETTER}+)?"

#: Titles that open a name, with the gender they tell (fixed values).
TITLES = {"mr": "m", "mister": "m", "sir": "m", "herr": "m", "monsieur": "m", "señor": "m", "sr": "m", "don": "m",
          "господин": "m", "mrs": "f", "ms": "f", "miss": "f", "madam": "f", "frau": "f", "madame": "f", "mme": "f",
          "mademoiselle": "f", "mlle": "f", "señora": "f", "sra": "f", "señorita": "f", "srta": "f", "госпожа": "f"}

#: Given names that tell a gender where a title stands before a single name (fixed values).
GIVEN = {
    "m": "adam albert antoine bruno carl charles daniel david edgar emil felix frank georg george hans henry hugo ivan "
         "jack james jean john jonas josé juan karl leo louis luis marco martin max michael nils oscar otto pablo paul "
         "peter pierre ralph robert simon theo thomas victor william антон борис вадим виктор денис егор иван максим "
         "олег павел роман".split(),
    "f": "ada alice anna anne bella carmen clara claire diana elena elizabeth elsa emily emma eva flora greta helen ida "
         "irene jana jane julia lara laura lena lisa lucia maria marie marta mary mia nina nora olga paula rosa sara "
         "sarah sofia vera алла анна вера галина дарья елена ирина лидия мария нина ольга софья".split(),
}

#: What made-up names consist of, by script: consonants, vowels, and endings by role (fixed values).
SOUNDS = {"latin": ("b c d f g h j k l m n p r s t v w z".split(), "a e i o u".split()),
          "cyrillic": ("б в г д ж з к л м н п р с т ф х ч ш".split(), "а е и о у".split())}
ENDINGS = {
    ("latin", "m"): "n r s l rt ld rd m".split(), ("latin", "f"): "na ra sa la ria lia nia tte".split(),
    ("latin", "family"): "ner ler mann son ton man berg field".split(),
    ("cyrillic", "m"): "н р м л с т д й".split(), ("cyrillic", "f"): "на ра са ла рия лия ния та".split(),
    ("cyrillic", "family"): "нов ров лов ков нин рин лин кин".split(),
}

#: Alphabets from which letters are drawn; other scripts give their own by rule (fixed values).
ALPHABETS = {"LATIN": "abcdefghijklmnopqrstuvwxyz", "CYRILLIC": "абвгдежзиклмнопрстуфхцчшэюя",
             "GREEK": "αβγδεζηθικλμνξοπρστυφχψω"}

_LOCAL = re.compile(r"[\w.%+-]*")
_DOMAIN = re.compile(r"[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+")
_SECRET_WORDS = ("api_key", "api-key", "apikey", "access_key", "access-key", "accesskey", "auth", "bearer", "passwd",
                 "password", "pwd", "secret", "token")
_SECRET_REST = re.compile(r"[\"']?\s*[=:]\s*[\"']?([\w+/.=~-]{8,})")
_NAME_REST = re.compile(rf"\.?\s({_NAME}(?:[ -]{_NAME}){{0,2}})")
_NUMBERS = (  # all hold a digit
    ("hex", re.compile(r"\b((?=[0-9a-fA-F]*[0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,}))\b")),
    ("iban", re.compile(r"\b([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b")),
    ("ipv6", re.compile(r"(?<![\w:.])((?=[0-9a-fA-F:]*[0-9])(?:[0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4})(?![\w:]|\.\d)")),
    ("ip", re.compile(r"(?<![\w.])((?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3})(?![\w]|\.\d)")),
    ("ssn", re.compile(r"(?<![\w-])(\d{3}-\d{2}-\d{4})(?![\w-])")),
    ("card", re.compile(r"(?<![\w.-])(\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w-]|\.\d)")),
    ("phone", re.compile(r"(?<![\w.+])(\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d[\d .-]{4,14}\d|"
                         r"\(\d{2,4}\) ?\d{2,4}[ .-]?\d{3,5}|\d{3}[ .-]\d{3}[ .-]\d{4}|0\d{2,4}[ /-]\d{3,4}[ -]\d{3,4}|"
                         r"0\d{1,4}[ /-]\d{6,8})(?![\w]|[/-]\d)")),
)
_DIGIT = re.compile(r"\d")
_HEX = re.compile(r"[0-9a-f]{32,}|[0-9A-F]{32,}")


@dataclass(frozen=True)
class Entity:
    """A span of a text, its kind, and the value by which equal ones are known."""

    start: int
    stop: int
    kind: str
    value: str


def script_of(text: str) -> str:
    """The script of the first letter, by the first word of its Unicode name."""
    return next((unicodedata.name(c, "LATIN").split()[0].lower() for c in text if c.isalpha()), "latin")


def _canonical(kind: str, text: str) -> str | None:
    """What a number is known by, however it is written; None if it is none of its kind."""
    if kind in ("phone", "card", "iban", "ssn"):
        return "".join(c for c in text if c.isalnum()).upper()
    if kind == "ipv6":
        try:
            return ipaddress.IPv6Address(text).exploded if sum(map(bool, text.split(":"))) > 2 else None
        except ValueError:
            return None
    return text


def _names(gender: str, match: re.Match) -> Iterator[Entity]:
    """The parts of a name: given names with the title's gender, then the family name."""
    start, parts = match.start(1), []
    for part in re.finditer(_NAME, match[1]):
        if part[0][0].islower():  # letters without case may begin a name
            break
        parts.append(part)
    alone = len(parts) == 1 and parts[0][0].casefold() in GIVEN[gender]  # "Mrs. Anna"
    for k, part in enumerate(parts):
        kind = "family" if k == len(parts) - 1 and not alone else f"given_{gender}"
        yield Entity(start + part.start(), start + part.end(), f"{kind}_{script_of(part[0])}", part[0].casefold())


def _after(words, low: str, text: str, rest: re.Pattern) -> Iterator[tuple[str, re.Match]]:
    """Matches of ``rest`` right behind whole words of the text."""
    for word in words:
        at = low.find(word)
        while at >= 0:
            end = at + len(word)
            if not (at and (low[at - 1].isalnum() or low[at - 1] == "_")):
                match = rest.match(text, end)
                if match and not (end < len(low) and (low[end].isalnum() or low[end] == "_")):
                    yield word, match
            at = low.find(word, end)


def _local_part(text: str, at: int) -> str:
    """The characters of a local part that stand before ``at``, however many."""
    size = 128
    while True:
        back = text[max(0, at - size):at][::-1]
        n = _LOCAL.match(back).end()
        if n < size:
            return back[:n][::-1]
        size *= 4


def _keep(kept: list[Entity], e: Entity) -> None:
    """Put an entity in its place unless it overlaps another."""
    at = bisect.bisect_left(kept, e.start, key=lambda k: k.start)
    if (at == 0 or kept[at - 1].stop <= e.start) and (at == len(kept) or kept[at].start >= e.stop):
        kept.insert(at, e)


def _gaps(kept: list[Entity], length: int) -> list[tuple[int, int]]:
    """The spans of the text between the entities."""
    edges = [0, *(x for e in kept for x in (e.start, e.stop)), length]
    return [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b]


def detect(text: str | None) -> list[Entity]:
    """Entities of a text, left to right without overlaps; earlier kinds win.

    A later kind is searched for in the gaps that earlier ones leave, so an
    overlap shortens a match and does not discard it.

    Plain searches for ``@``, a digit and the naming words come first, so a text
    without them is read at the speed of a string search.
    """
    if not text:
        return []
    found: list[Entity] = []
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            local = _local_part(text, at)
            start = at - len(local.lstrip(".-%"))
            if start < at:
                found.append(Entity(start, domain.end(), "email", text[start:domain.end()].lower()))
        at = text.find("@", at + 1)
    low = text.lower()
    if len(low) != len(text):  # a letter whose small form is longer: keep the places
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    kept: list[Entity] = []
    for e in found:
        _keep(kept, e)
    for _, match in _after(_SECRET_WORDS, low, text, _SECRET_REST):
        start, stop = match.span(1)
        at = bisect.bisect_left(kept, start, key=lambda k: k.start)
        if at < len(kept) and kept[at].start < stop and kept[at].kind == "email":  # the secret runs into an address
            stop, last = kept[at].start, kept[at].stop
            if 0 < stop - start < 8:  # too little to be told from others: one entity with the address
                kept[at] = Entity(start, last, "email", text[start:last].lower())
                continue
        value = text[start:stop]
        if value:
            _keep(kept, Entity(start, stop, "hex" if _HEX.fullmatch(value) else "secret", value))
    if _DIGIT.search(text):
        for kind, pattern in _NUMBERS:
            for begin, end in _gaps(kept, len(text)):
                for match in pattern.finditer(text, begin, end):
                    value = _canonical(kind, match[1])
                    if value is not None:
                        _keep(kept, Entity(match.start(1), match.end(1), kind, value))
    for title, match in _after(TITLES, low, text, _NAME_REST):
        for e in _names(TITLES[title], match):
            at = bisect.bisect_left(kept, e.start, key=lambda k: k.start)
            if at < len(kept) and e.start < kept[at].start < e.stop:
                stop = kept[at].start
                e = Entity(e.start, stop, e.kind, text[e.start:stop].casefold())
            _keep(kept, e)
    return kept


# -- surrogates ---------------------------------------------------------------


class Stream:
    """Numbers drawn from a key and a message."""

    def __init__(self, key: bytes, message: str):
        self.key, self.message, self.block, self.pool = key, message, 0, 0
        self.left = 1

    def below(self, n: int) -> int:
        if self.left < n << 32:
            self.pool = int.from_bytes(hmac.digest(self.key, f"{self.block}|{self.message}".encode(
                "utf-8", "surrogatepass"), "sha256"), "big")
            self.left, self.block = 1 << 256, self.block + 1
        self.pool, value = divmod(self.pool, n)
        self.left //= n
        return value


@functools.lru_cache(maxsize=1000)
def _alphabet(c: str) -> str:
    """The letters of a small letter's script, as many as Unicode names in the same way
    with one word; Latin ones where these are too few to draw from."""
    words = re.split("[ -]", unicodedata.name(c, "LATIN SMALL LETTER A"))
    if words[0] in ALPHABETS:
        return ALPHABETS[words[0]]
    ends = [k for k, w in enumerate(words) if w in ("LETTER", "SYLLABLE", "IDEOGRAPH", "CHARACTER")]
    pool = _named(" ".join(words[:ends[0] + 1]), unicodedata.category(c)) if ends else ""
    return pool if len(pool) >= 10 else ALPHABETS["LATIN"]


@functools.lru_cache(maxsize=100)
def _named(prefix: str, category: str) -> str:
    form = re.compile(re.escape(prefix) + r"[ -]\w+")
    return "".join(c for c in map(chr, range(0x80, 0x10000))
                   if unicodedata.category(c) == category and form.fullmatch(unicodedata.name(c, "")))


def _like(stream: Stream, text: str, more: int = 0) -> str:
    """Each letter by one of its script and case, each digit by one of its script, the
    rest as it is; ``more`` characters, like the last letter or digit, are added."""
    last = next((c for c in reversed(text) if c.isalpha() or c.isdecimal()), "a")
    out = []
    for c in text + last * more:
        if c.isdecimal():
            out.append(chr(ord(c) - unicodedata.decimal(c) + stream.below(10)))
        elif c.isalpha():
            pool = _alphabet(c.lower()[0])
            new = pool[stream.below(len(pool))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def _name(stream: Stream, role: str, script: str, value: str, more: int) -> str:
    """A made-up name of a script and role (m, f or family).

    Syllables and an ending that tells the role; a million and more names at
    the first draw. A family name whose original has a feminine ending gets
    one. Scripts without sounds here get letters of their own, and given names
    keep their last letter, which tells the gender where a language marks it.
    """
    if script not in SOUNDS:
        return _like(stream, value, more) if role == "family" else _like(stream, value[:-1] or value, more) + value[-1]
    consonants, vowels = SOUNDS[script]
    syllables = "".join(consonants[stream.below(len(consonants))] + vowels[stream.below(len(vowels))]
                        for _ in range(2 + more + stream.below(2)))
    ends = ENDINGS[(script, role)]
    feminine = "а" if role == "family" and script == "cyrillic" and value.endswith("а") else ""
    return syllables + ends[stream.below(len(ends))] + feminine


def luhn_digit(digits: str) -> str:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def propose(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The surrogate of a value (in the canonical form of its kind) at the n-th attempt.

    From the third attempt on it grows by a character every other attempt, so
    there are always enough forms, however many values of a kind there are.
    """
    stream, more = Stream(key, f"{kind}|{attempt}|{value}"), attempt // 2
    if kind == "email":
        local, _, domain = value.partition("@")
        head, _, last = domain.rpartition(".")
        return f"{_like(stream, local, more)}@{_like(stream, head)}.{last}"
    if kind == "hex":
        drawn = "".join(f"{stream.below(16):x}" for _ in range(len(value) + more))
        return drawn if value.islower() or value.isdigit() else drawn.upper()
    if kind == "ip" and more < 3:
        return ".".join(str(n) for n in (1 + stream.below(223), stream.below(256), stream.below(256), stream.below(256)))
    if kind in ("ip", "ipv6"):  # nearly all short addresses occur, or a long one
        return "2001:0db8:" + ":".join(f"{stream.below(1 << 16):04x}" for _ in range(6))
    if kind == "card":
        body = str(1 + stream.below(9)) + "".join(str(stream.below(10)) for _ in range(len(value) - 2 + more))
        check = luhn_digit(body)  # a number that fails the check keeps failing it
        return body + (check if luhn_digit(value[:-1]) == value[-1] else str((int(check) + 1 + stream.below(9)) % 10))
    if kind == "iban":
        rest = _like(stream, value[4:], more)
        return value[:2] + iban_check(value[:2], rest) + rest
    if kind == "phone":  # the first digit, with it the country or trunk code, stays
        return value[0] + _like(stream, value[1:], more)
    if kind.startswith(("given_", "family_")):
        role, script = kind.removeprefix("given_").rsplit("_", 1)
        return _name(stream, role, script, value, more).casefold()
    return _like(stream, value, more)


def dressed(surface: str, kind: str, surrogate: str) -> str:
    """The surrogate in the format of the text it replaces."""
    if kind in ("phone", "card", "iban", "ssn"):
        drawn = iter(surrogate)
        return "".join(next(drawn) if c.isalnum() else c for c in surface) + "".join(drawn)
    if kind.startswith(("given_", "family_")):
        if surface.isupper() and len(surface) > 1:
            return surrogate.upper()
        if surrogate.endswith("σ"):  # the form of the letter at the end of a word
            surrogate = surrogate[:-1] + "ς"
        return surrogate[:1].upper() + surrogate[1:]
    if kind == "email":
        if surface.isupper():
            return surrogate.upper()
        return "".join(new.upper() if old.isupper() else new for old, new in zip(surface, surrogate, strict=True)) \
            if len(surface) == len(surrogate) else surrogate
    if kind == "ipv6":
        plain = ipaddress.IPv6Address(surrogate).compressed if len(surface) < len(surrogate) else surrogate
        return plain.upper() if surface.isupper() else plain
    return surrogate


# -- Spark --------------------------------------------------------------------

_MENTION = "key struct<id: bigint, text_hash: bigint>, kind string, value string"


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, kinds, values = [], [], []
        for at, text in enumerate(batch.column(1).to_pylist()):
            for kind, value in sorted({(e.kind, e.value) for e in detect(text)}):
                keys.append(at)
                kinds.append(kind)
                values.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keys, pa.int64())), pa.array(kinds, pa.string()),
             pa.array(values, pa.string())], names=["key", "kind", "value"])


def _proposer(key: bytes, attempt: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [propose(key, k, v, attempt) for k, v in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(drawn, pa.string())],
                                             names=["kind", "value", "surrogate"])
    return run


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """A surrogate for each distinct ``(kind, value)``, different from all others of
    its kind and from every value that occurs.

    All entities propose at once. Of those with the same proposal the least keeps
    it, unless it is taken or is itself a value of the corpus; the others try
    again with the next number. The checks are joins on (kind, surrogate), so
    the table may be of any size. Proposals grow with the number of the attempt,
    so the values left fall to none after about the logarithm of their number.
    """
    schema = "kind string, value string, surrogate string"
    known = staged(entities.select("kind", "value").distinct(), "entities")
    originals = known.select("kind", F.col("value").alias("surrogate"))
    given, todo, attempt = None, known, 0
    while given is None or todo.limit(1).count():
        drawn = staged(todo.mapInArrow(_proposer(key, attempt), schema), "proposals")
        best = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        best = best.join(originals, ["kind", "surrogate"], "left_anti")
        if given is not None:
            best = best.join(given.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = staged(best.select("kind", "value", "surrogate"), "surrogates")
        todo = staged(drawn.select("kind", "value").join(won, ["kind", "value"], "left_anti"), "open")
        unstaged(drawn)
        given, attempt = won if given is None else given.union(won), attempt + 1
    return given


def replace_entities(text: str | None, known: dict) -> tuple[str | None, list[dict]]:
    """The text with its entities replaced, and where the surrogates stand in it."""
    out, spans, at, length = [], [], 0, 0
    for e in detect(text):
        new = dressed(text[e.start:e.stop], e.kind, known[(e.kind, e.value)])
        out += [text[at:e.start], new]
        length += e.start - at
        spans.append({"kind": e.kind, "start": length, "stop": length + len(new)})
        length, at = length + len(new), e.stop
    return (None if text is None else "".join(out) + text[at:]), spans


def _replacer(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text, pairs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                known = {(p["kind"], p["value"]): p["surrogate"] for p in pairs or ()}
                new, found = replace_entities(text, known) if known else (text, [])
                texts.append(new)
                spans.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(schema.field(0).type), pa.array(texts, pa.string()),
                 pa.array(spans, schema.field(2).type)], schema=schema)
    return run


def surrogate_texts(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, entities``: every text with its personal data replaced.

    Found are mail addresses, IPv4 and IPv6 addresses, phone, card and social
    security numbers, IBANs, secrets after a naming word, long hexadecimal
    strings, and names after a title. A surrogate has the kind, script, case and
    punctuation of what it replaces (a card number its Luhn check, an IBAN its
    check digits, a given name the title's gender), and its length but for names
    and IPv6. One value has one surrogate in all documents, whatever its
    formatting, and the parts of a name keep theirs whether or not a given name
    stands before the family name. Over all documents no two values of a kind
    share a surrogate, and none is a value that occurs. It is drawn from the
    key, the kind and the value. Only a value whose draw another value has too,
    or which is itself a value of the corpus, depends on the others: it draws
    again, and grows by a character where a kind is crowded. ``entities``
    holds ``(kind, start, stop)`` in the new text.

    A null text stays null; an empty one or one without personal data stays as
    it is; a text of any length is searched whole; an empty table gives none. Rows that repeat are treated alike; a null id is kept. Other columns
    are left aside. A value in a third of all documents is one entity, and its
    mentions are joined by Spark's splitting of skewed joins.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    own = docs.select(F.struct(F.col(doc_id).cast("long").alias("id"),
                               F.xxhash64(F.col(text).cast("string")).alias("text_hash")).alias("key"),
                      F.col(text).cast("string").alias("text"))
    mentions = staged(own.mapInArrow(_mentions, _MENTION), "mentions")
    given = assign(mentions, key)
    pairs = mentions.distinct().join(given, ["kind", "value"]).groupBy("key").agg(
        F.collect_list(F.struct("kind", "value", "surrogate")).alias("pairs"))
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("stop", T.LongType())])
    schema = T.StructType([T.StructField("key", own.schema["key"].dataType), T.StructField("text", T.StringType()),
                           T.StructField("entities", T.ArrayType(span))])
    joined = own.join(pairs, "key", "left").select("key", "text", "pairs")
    replaced = joined.mapInArrow(_replacer(to_arrow_schema(schema)), schema)
    return replaced.select(F.col("key.id").alias("doc_id"), "text", "entities")


def with_surrogates(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with all columns, personal data in ``text`` replaced; rows keep their order of columns."""
    whole = fresh(docs, "whole")
    numbered = staged(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole),
                                  F.monotonically_increasing_id().alias("row")), "documents")
    found = surrogate_texts(numbered.select("row", F.col(f"{whole}.`{text}`").alias("text")), key, "row")
    joined = numbered.join(found.select(F.col("doc_id").alias("row"), F.col("text").alias("new")), "row")
    return joined.select(*[F.col("new").alias(c) if c == text else F.col(f"{whole}.`{c}`").alias(c)
                           for c in docs.columns])
