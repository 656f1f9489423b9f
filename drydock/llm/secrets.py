"""Secret scans: fixed patterns, and formats inferred from what they find as probabilistic automata."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from drydock.llm.common import staged

# The patterns of the base kinds, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_LEAST = 6

SYMBOLS = "".join(chr(c) for c in range(33, 127) if chr(c).isalnum() or chr(c) in "+/_.=-")
#: What may be a credential without a keyword: a run of the symbols of this length at least.
CANDIDATE_LEAST = 16
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % CANDIDATE_LEAST)
#: Ordinary words are shorter than any candidate, so no credential teaches what is ordinary.
ORDINARY = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{6,%d}(?![A-Za-z0-9+/_.=-])" % (CANDIDATE_LEAST - 1))
#: Bounds of what formats are learned from: distinct values of each kind, ordinary
#: words, and characters of each.
SAMPLE_VALUES, SAMPLE_WORDS, SAMPLE_CHARS = 2000, 4000, 256
LEAST_VALUES = 8
ALPHA = 0.05
#: The share of known credentials that a format may score lower than what it accepts, and
#: the least evidence (natural logarithm of the odds against ordinary words) for a whole value.
LOST, EVIDENCE = 0.02, 10.0
LONG_VALUE = 128


# -- automata -----------------------------------------------------------------

_CODE = np.full(128, -1, dtype=np.int64)
_CODE[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
N = len(SYMBOLS)


@dataclass
class PrefixTree:
    """Counts by state: values that pass, that end, and that go on by each symbol."""

    passed: list[int] = field(default_factory=lambda: [0])
    ended: list[int] = field(default_factory=lambda: [0])
    child: list[dict[int, int]] = field(default_factory=lambda: [{}])
    moved: list[dict[int, int]] = field(default_factory=lambda: [{}])

    def add(self, value: str) -> None:
        state = 0
        for code in _CODE[np.frombuffer(value.encode("ascii"), np.uint8)].tolist():
            self.passed[state] += 1
            self.moved[state][code] = self.moved[state].get(code, 0) + 1
            step = self.child[state].get(code)
            if step is None:
                step = self.child[state][code] = len(self.child)
                self.passed.append(0)
                self.ended.append(0)
                self.child.append({})
                self.moved.append({})
            state = step
        self.passed[state] += 1
        self.ended[state] += 1


def compatible(tree: PrefixTree, a: int, b: int, alpha: float) -> bool:
    """Whether two states could have the same future: by Hoeffding's bound no
    frequency of an end or a symbol differs, in them or in what follows them."""
    root = math.sqrt(0.5 * math.log(2 / alpha))
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        n, m = tree.passed[a], tree.passed[b]
        if not n or not m:
            continue
        bound = root * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        if bound >= 1:  # nothing can differ by more, here or further on, where counts are no larger
            continue
        if abs(tree.ended[a] / n - tree.ended[b] / m) > bound:
            return False
        for code in tree.moved[a].keys() | tree.moved[b].keys():
            if abs(tree.moved[a].get(code, 0) / n - tree.moved[b].get(code, 0) / m) > bound:
                return False
            if code in tree.child[a] and code in tree.child[b]:
                todo.append((tree.child[a][code], tree.child[b][code]))
    return True


def _fold(tree: PrefixTree, into: int, state: int) -> None:
    """Add the counts of ``state`` and of the tree below it to those of ``into``."""
    todo = [(into, state)]
    while todo:
        a, b = todo.pop()
        tree.passed[a] += tree.passed[b]
        tree.ended[a] += tree.ended[b]
        for code, n in tree.moved[b].items():
            tree.moved[a][code] = tree.moved[a].get(code, 0) + n
            if code in tree.child[a]:
                todo.append((tree.child[a][code], tree.child[b][code]))
            else:
                tree.child[a][code] = tree.child[b][code]


def infer(values: list[str], alpha: float = ALPHA) -> Automaton:
    """A probabilistic automaton of the values: the states of their prefix tree,
    merged from the root outwards wherever their counts are compatible."""
    tree = PrefixTree()
    for value in sorted(values):
        tree.add(value)
    kept = [0]
    blue = {step: (0, code) for code, step in tree.child[0].items()}
    while blue:
        state = min(blue, key=lambda s: (-tree.passed[s], s))
        parent = blue.pop(state)
        match = next((k for k in kept if compatible(tree, k, state, alpha)), None)
        if match is None:
            kept.append(state)
            blue |= {step: (state, code) for code, step in tree.child[state].items() if step not in blue}
            continue
        tree.child[parent[0]][parent[1]] = match
        _fold(tree, match, state)
        known = set(kept)
        blue = {step: (k, code) for k in kept for code, step in tree.child[k].items() if step not in known}
    place = {state: k for k, state in enumerate(kept)}
    step = np.full((len(kept), N), -1, dtype=np.int64)
    log = np.zeros((len(kept), N + 1))
    for state, k in place.items():
        counts = np.full(N + 1, 0.5 / (N + 1))  # what was never seen is unlikely, not impossible
        for code, n in tree.moved[state].items():
            counts[code] += n
            step[k, code] = place[tree.child[state][code]]
        counts[N] += tree.ended[state]
        log[k] = np.log(counts / counts.sum())
    return Automaton(step, log)


@dataclass(frozen=True)
class Automaton:
    """``step[state, symbol]`` (-1: none; such a symbol keeps the state) and ``log``, the logarithms of
    the probabilities of each symbol and, in the last column, of the end."""

    step: np.ndarray
    log: np.ndarray

    def score(self, values: list[str]) -> np.ndarray:
        """Log-likelihood of each value; all values take one symbol at a time together."""
        out = np.zeros(len(values))
        size = np.array([len(v) for v in values], dtype=np.int64)
        for k in np.flatnonzero(size > LONG_VALUE):
            out[k] = self._score_long(values[k])
        order = np.flatnonzero(size <= LONG_VALUE)
        order = order[np.argsort(-size[order], kind="stable")]
        codes = _CODE[np.frombuffer("".join(values[k] for k in order).encode("ascii"), np.uint8)]
        size = size[order]
        begin = np.cumsum(size) - size
        state, total = np.zeros(len(order), dtype=np.int64), np.zeros(len(order))
        for t in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -t, "left"))
            code = codes[begin[:n] + t]
            total[:n] += self.log[state[:n], code]
            after = self.step[state[:n], code]
            state[:n] = np.where(after < 0, state[:n], after)
        out[order] = total + self.log[state, N]
        return out

    def _score_long(self, value: str) -> float:
        step, log, state, total = self.step.tolist(), self.log.tolist(), 0, 0.0
        for code in _CODE[np.frombuffer(value.encode("ascii"), np.uint8)].tolist():
            total += log[state][code]
            state = step[state][code] if step[state][code] >= 0 else state
        return total + log[state][N]


# -- formats ------------------------------------------------------------------


@dataclass(frozen=True)
class Formats:
    """An automaton for each kind that could be learned, one for ordinary words, and for
    each kind the least length and the least odds a symbol that are accepted."""

    kinds: list[str]
    automata: list[Automaton]
    words: Automaton | None
    least_length: np.ndarray
    least_odds: np.ndarray

    def odds(self, values: list[str]) -> np.ndarray:
        """For each kind and value the logarithm of its odds against ordinary words."""
        return np.stack([a.score(values) for a in self.automata]) - self.words.score(values)

    def classify(self, values: list[str]) -> list[str | None]:
        """The kind in whose format each value is, if any; of several the likeliest."""
        if not self.kinds or not values:
            return [None] * len(values)
        size = np.array([len(v) for v in values])
        odds = self.odds(values)
        good = ((odds >= EVIDENCE) & (odds / size >= self.least_odds[:, None])
                & (size >= np.maximum(self.least_length, CANDIDATE_LEAST)[:, None]))
        best = np.where(good, odds, -np.inf).argmax(axis=0)
        return [self.kinds[k] if good[k, i] else None for i, k in enumerate(best.tolist())]


def fit(credentials: dict[str, list[str]], words: list[str], alpha: float = ALPHA) -> Formats:
    """Formats of labelled credentials, told from ordinary words.

    A kind's automaton is inferred from all its values. What it accepts is set
    by values it has not seen: each half is scored by the automaton of the
    other half, and all but the lowest ``LOST`` share are accepted. A kind of
    fewer than ``LEAST_VALUES`` values is not learned; nor is any without words.
    """
    kinds = [k for k in KINDS if len(set(credentials.get(k, ()))) >= LEAST_VALUES]
    if not kinds or not words:
        return Formats([], [], None, np.zeros(0), np.zeros(0))
    ordinary = infer(words, alpha)
    automata, lengths, odds = [], [], []
    for kind in kinds:
        values = sorted(set(credentials[kind]))
        halves = values[::2], values[1::2]
        unseen = [(infer(a, alpha).score(b) - ordinary.score(b)) / np.array([len(v) for v in b])
                  for a, b in (halves, halves[::-1])]
        automata.append(infer(values, alpha))
        lengths.append(min(len(v) for v in values))
        odds.append(float(np.quantile(np.concatenate(unseen), LOST, method="lower")))
    return Formats(kinds, automata, ordinary, np.array(lengths), np.maximum(odds, 0.0))


# -- scanning -----------------------------------------------------------------


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """``kind, start, end, value`` of the base patterns, by start and then by kind."""
    found = [("assign", m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """All runs of symbols long enough that touch no base span, without the dots and dashes at their ends."""
    edge = 0
    for m in CANDIDATE.finditer(text):
        while edge < len(base) and base[edge][2] <= m.start():
            edge += 1
        value = m[0].strip(".-")
        if len(value) >= CANDIDATE_LEAST and not any(a < m.end() and b > m.start() for _, a, b, _ in base[edge:edge + 1]):
            start = m.start() + m[0].index(value)
            yield start, start + len(value), value


def ordinary_word(text: str, base: list[tuple[str, int, int, str]]) -> str | None:
    """One word of the text that touches no base span: the first after a place drawn by hash."""
    place = zlib.crc32(text[:4096].encode("utf-8", "surrogatepass")) % (len(text) + 1)
    for begin in (place, 0):
        m = ORDINARY.search(text, begin)
        if m:
            return None if any(a < m.end() and b > m.start() for _, a, b, _ in base) else m[0]
    return None


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                      T.StructField("stop", T.LongType()), T.StructField("value", T.StringType()),
                      T.StructField("learned", T.BooleanType())])


def _spans(found: list[tuple[str | None, int, int, str]], learned: bool) -> list[dict]:
    return [{"kind": k, "start": a, "stop": b, "value": v, "learned": learned} for k, a, b, v in found]


def _scanner(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                spans, maybe, words = [], [], []
                for text in some.column(0).to_pylist():
                    base = base_spans(text or "")
                    spans.append(_spans(base, False))
                    maybe.append(_spans([(None, *c) for c in candidates(text or "", base)], True))
                    words.append(ordinary_word(text or "", base))
                yield pa.RecordBatch.from_arrays(
                    [some.column(1).cast(schema.field(0).type), pa.array(spans, schema.field(1).type),
                     pa.array(maybe, schema.field(2).type), pa.array(words, pa.string())], schema=schema)
    return run


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans, candidates, word`` of each row: what the base patterns find, all runs of symbols
    which may be a credential without a keyword, and one ordinary word."""
    from pyspark.sql.pandas.types import to_arrow_schema
    own = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{doc_id}`").alias("doc_id"))
    schema = T.StructType([T.StructField("doc_id", own.schema["doc_id"].dataType),
                           T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("candidates", T.ArrayType(_SPAN)),
                           T.StructField("word", T.StringType())])
    return own.mapInArrow(_scanner(to_arrow_schema(schema)), schema)


def learn(scanned: DataFrame, most_values: int = SAMPLE_VALUES, most_words: int = SAMPLE_WORDS) -> Formats:
    """Formats of what ``scan`` has found: of each kind the ``most_values`` distinct values of least hash, and as
    many ordinary words as told (the documented bound; of longer ones the first ``SAMPLE_CHARS`` characters)."""
    def least(values: Column, rows: DataFrame, most: int) -> list[str]:
        own = rows.select(F.substring(values, 1, SAMPLE_CHARS).alias("value")).filter("value IS NOT NULL").distinct()
        return [r[0] for r in own.orderBy(F.xxhash64("value"), "value").limit(most).collect()]

    found = scanned.select(F.explode("spans").alias("span")).select("span.kind", "span.value")
    return fit({kind: least(F.col("value"), found.filter(F.col("kind") == kind), most_values) for kind in KINDS},
               least(F.col("word"), scanned, most_words))


def _finder(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = batch.column(2).to_pylist()
            values = sorted({c["value"] for row in maybe for c in row})
            kinds = dict(zip(values, shared.value.classify(values), strict=True))
            spans = []
            for row, extra in zip(batch.column(1).to_pylist(), maybe, strict=True):
                row += [c | {"kind": kinds[c["value"]]} for c in extra if kinds[c["value"]]]
                spans.append(sorted(row, key=lambda s: (s["start"], KINDS.index(s["kind"]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, schema.field(1).type)], schema=schema)
    return run


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", formats: Formats | None = None) -> DataFrame:
    """``doc_id, spans`` of every whole text; a span has kind, start, stop (code points), value and whether its
    format was ``learned`` rather than a base pattern matched.

    Base spans are found first and always stay. Their values are the labelled
    credentials from which formats are learned, unless ``formats`` are given.
    Every other run of symbols long enough is scored by all formats; a span is added where one
    accepts it. Spans are in order of start, then of kind. A value counts for
    itself, so equal texts give equal spans.

    Null and empty texts have no spans. Repeated rows and ids repeat; other
    columns are left aside, whatever their names; an empty table gives an empty
    one. A text is scanned once and as a whole, in time in proportion to it;
    only what is found is kept in the shared folder for the scoring.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    scanned = staged(scan(docs, doc_id, text), "scanned")
    shared = docs.sparkSession.sparkContext.broadcast(formats or learn(scanned))
    schema = T.StructType([scanned.schema["doc_id"], T.StructField("spans", T.ArrayType(_SPAN))])
    return scanned.select("doc_id", "spans", "candidates").mapInArrow(_finder(shared, to_arrow_schema(schema)), schema)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
