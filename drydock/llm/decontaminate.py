"""Benchmark decontamination by q-gram lemma filtering and banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from drydock.llm.common import chunks, code_points, rolled, slices, spans_hash, staged

Q = 12
ERROR_RATE = 0.05
BLOCK_CHARS = 2_000_000
BATCH_CHARS = 2_000_000
_MASK_BITS = 22


def normal(text: str | None) -> str:
    """Lower case, with every run of white space as one blank."""
    return " ".join((text or "").lower().split())


def budget(length: int, error_rate: float = ERROR_RATE) -> int:
    """Edits allowed for an item: its share."""
    return int(length * error_rate)


def gram_size(length: int, q: int = Q, error_rate: float = ERROR_RATE) -> int:
    """The size of grams an item is found by: q, or as many characters fewer as
    leave one shared gram implied when all its edits are made."""
    return max(1, min(q, length // (budget(length, error_rate) + 1)))


@dataclass(frozen=True)
class GramIndex:
    """All q-grams of a block of items, sorted by hash."""

    ids: list
    texts: list[str]
    grams: np.ndarray
    items: np.ndarray
    places: np.ndarray
    seen: np.ndarray
    needed: np.ndarray
    edits: np.ndarray
    q: int


def build_index(rows: list[tuple], q: int = Q, error_rate: float = ERROR_RATE) -> GramIndex:
    """Items given as ``(id, normal text)``, each of a ``gram_size`` of q at least."""
    grams, items, places = [], [], []
    for at, (_, text) in enumerate(rows):
        prefix = rolled(code_points(text))
        start = np.arange(len(text) - q + 1)
        grams.append(spans_hash(prefix, start, start + q))
        items.append(np.full(len(start), at))
        places.append(start)
    hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    order = np.argsort(hashes, kind="stable")
    seen = np.zeros(1 << _MASK_BITS, dtype=bool)
    seen[(hashes >> np.uint64(64 - _MASK_BITS)).astype(np.int64)] = True
    lengths = np.array([len(t) for _, t in rows], dtype=np.int64)
    edits = np.array([budget(int(n), error_rate) for n in lengths], dtype=np.int64)
    return GramIndex([i for i, _ in rows], [t for _, t in rows], hashes[order],
                     np.concatenate(items)[order] if items else np.zeros(0, np.int64),
                     np.concatenate(places)[order] if places else np.zeros(0, np.int64),
                     seen, lengths - q + 1 - edits * q, edits, q)


def banded_distance(item: np.ndarray, region: np.ndarray, low: int, high: int, most: int) -> int:
    """Least edits that turn ``item`` into some part of ``region``, along diagonals low..high.

    On diagonal d the item's character i meets the region's character i + d; the
    part may begin and end anywhere. For 0, 1, 2 ... edits each diagonal of the
    band holds how far into the item it gets: an edit moves on by a changed, a
    left out or an added character, and equal characters are passed at once by a
    table of the next difference. Gives most + 1 where more edits are needed.
    """
    m, n, width = len(item), len(region), high - low + 1
    diagonal = low + np.arange(width)
    j = np.arange(m)[None, :] + diagonal[:, None]
    inside = (j >= 0) & (j < n)
    if n:
        differs = ~inside | (region[np.minimum(np.maximum(j, 0), n - 1)] != item[None, :])
    else:
        differs = np.ones((width, m), dtype=bool)
    following = np.full((width, m + 1), m, dtype=np.int64)
    following[:, :m] = np.where(differs, np.arange(m)[None, :], m)
    following = np.minimum.accumulate(following[:, ::-1], axis=1)[:, ::-1]
    never, room, row = -1, n - diagonal, np.arange(width)
    reach = np.where((diagonal >= 0) & (diagonal <= n), 0, never)
    for edits in range(most + 1):
        if edits:
            changed = np.where(reach >= 0, reach + 1, never)
            left_out = np.append(changed[1:], never)  # from the diagonal above
            added = np.concatenate(([never], reach[:-1]))  # from the diagonal below
            step = np.maximum(np.maximum(changed, added), left_out)
            step = np.minimum(np.minimum(step, m), room)
            reach = np.where((step >= 0) & (step + diagonal >= 0), step, never)
        on = reach >= 0
        reach = np.where(on, following[row, np.maximum(reach, 0)], never)
        if reach.max() >= m:
            return edits
    return most + 1


def find(texts: list[str], index: GramIndex) -> list[list[tuple]]:
    """For each normal text its matches ``(item, start, end, edits)``, the cheapest of an overlap.

    An occurrence of an item of length m with k edits shares at least
    m - q + 1 - k q of its q-grams within k diagonals of each other. Hits are
    counted in bands of 2k + 1 diagonals that begin every k + 1, so some band
    holds them all; bands with enough hits are verified by alignment. Nothing
    else is assumed: a band is never passed over for being common.
    """
    found: list[list[tuple]] = [[] for _ in texts]
    if not len(index.grams):
        return found
    q, lengths = index.q, np.array([len(t) for t in texts], dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
    points = code_points("\x00".join(texts) + "\x00")
    if len(points) < q:
        return found
    prefix = rolled(points)
    start = np.arange(len(points) - q + 1)
    grams = spans_hash(prefix, start, start + q)
    maybe = np.flatnonzero(index.seen[(grams >> np.uint64(64 - _MASK_BITS)).astype(np.int64)])
    left = np.searchsorted(index.grams, grams[maybe], "left")
    count = np.searchsorted(index.grams, grams[maybe], "right") - left
    maybe, left, count = maybe[count > 0], left[count > 0], count[count > 0]
    doc = np.searchsorted(offsets, maybe, "right") - 1
    for part in _slices(doc, count, 4_000_000):
        _bands(part, maybe, left, count, doc, offsets, points, lengths, index, found)
    return found


def _slices(doc: np.ndarray, count: np.ndarray, most: int) -> Iterator[slice]:
    """Whole documents together, as many as give about ``most`` hits."""
    ends = np.append(np.flatnonzero(np.diff(doc)) + 1, len(doc)) if len(doc) else np.zeros(0, np.int64)
    total, start, held = np.concatenate(([0], np.cumsum(count))), 0, 0
    for at, end in enumerate(ends):
        if total[end] - total[start] >= most or at == len(ends) - 1:
            yield slice(start, int(end))
            start = int(end)


def _bands(part, maybe, left, count, doc, offsets, points, lengths, index, found) -> None:
    n = count[part]
    if not len(n):
        return
    which = np.repeat(np.arange(len(n)), n)
    entry = np.repeat(left[part], n) + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    item, docs = index.items[entry], doc[part][which]
    diagonal = maybe[part][which] - offsets[docs] - index.places[entry]
    k = index.edits[item]
    shift = index.texts and max(len(t) for t in index.texts)
    band = (diagonal + shift) // (k + 1)
    # a band starts at every k + 1 diagonals and is 2k + 1 wide: a hit lies in its own and the one before
    step = int(band.max()) + 2
    key = (docs * len(index.ids) + item) * step + band
    low = (diagonal + shift) - band * (k + 1)
    spill = (band > 0) & (low < k)
    keys, hits = np.unique(np.concatenate((key, key[spill] - 1)), return_counts=True)
    enough = hits >= index.needed[(keys // step) % len(index.ids)]
    best: dict[tuple, list] = {}
    for value in keys[enough].tolist():
        rest, at = divmod(value, step)
        d, i = divmod(rest, len(index.ids))
        edits = int(index.edits[i])
        first = at * (edits + 1) - shift  # the band's first diagonal
        body = code_points(index.texts[i]).astype(np.int64)
        begin = max(0, first - edits)
        end = min(int(lengths[d]), first + 3 * edits + len(body))
        region = points[offsets[d] + begin: offsets[d] + end].astype(np.int64)
        cost = banded_distance(body, region, first - edits - begin, first + 3 * edits - begin, edits)
        if cost <= edits:
            best.setdefault((d, i), []).append((begin, end, cost))
    for (d, i), spans in best.items():
        kept: list[tuple] = []
        for span in sorted(spans):  # neighbouring bands meet the same occurrence
            if kept and span[0] - kept[-1][0] <= 2 * int(index.edits[i]) + 1:
                kept[-1] = min(kept[-1], span, key=lambda s: s[2])
            else:
                kept.append(span)
        found[d] += [(index.ids[i], b, e, c) for b, e, c in kept]


def _finder(block, own: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(own)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"item_id": i, "start": b, "stop": e, "edits": c} for i, b, e, c in sorted(m, key=str)]
                    for m in _found(batch.column(0), block.value)]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(schema.field(0).type),
                                              pa.array(rows, schema.field(1).type)], schema=schema)
    return run


def _found(texts: pa.Array, indexes: list[GramIndex]) -> Iterator[list]:
    """The matches of each text, a few texts at a time."""
    for some in slices(texts):
        bodies = [normal(t) for t in some]
        for part in chunks(bodies, [len(t) for t in bodies], BATCH_CHARS):
            for each in zip(*(find(part, index) for index in indexes), strict=True):
                yield [m for found in each for m in found]


def benchmark_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", q: int = Q,
                     block_chars: int = BLOCK_CHARS) -> list[DataFrame]:
    """The items cut into blocks of about ``block_chars`` characters, whatever their number."""
    items = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text")).filter(
        "text IS NOT NULL").distinct()
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) for b in range(blocks)]


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text", q: int = Q, error_rate: float = ERROR_RATE,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Every document ``(doc_id, matches)`` with the benchmark items that occur in its text.

    An item occurs where some part of the text is within ``error_rate`` of the
    item's length in edits of it, case and white space aside. A match is
    ``(item_id, start, stop, edits)``, start and stop bounding it in the normal
    text. The benchmark enters in blocks of bounded size, each of which is sent
    to the executors and compared with all documents in one pass over them.

    Null and empty texts match nothing. Items that are null or shorter than q
    normal characters identify nothing and never match; repeated items count
    once, and one id with several texts matches by any. Rows that repeat a
    doc_id are searched each for itself; a null doc_id is kept. An item with a
    third of all documents as matches adds one entry to each of them. An empty
    benchmark matches nothing. Other columns are left aside.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{doc_id}`").alias("doc_id"))
    schema = T.StructType([T.StructField("doc_id", own.schema["doc_id"].dataType),
                           T.StructField("matches", T.ArrayType(T.StructType([
                               T.StructField("item_id", benchmark.schema[item_id].dataType)] + [
                               T.StructField(n, T.LongType()) for n in ("start", "stop", "edits")])))])
    blocks = benchmark_blocks(benchmark, item_id, item_text, q, block_chars)
    if len(blocks) > 1:  # several passes: fix what a document is by its row in a written table
        own = staged(own.withColumn("_row", F.monotonically_increasing_id()), "decontaminate")
        passes = None
        wide = T.StructType([T.StructField("_row", T.LongType())] + schema.fields[1:])
        for block in blocks:
            found = _pass(own.select("text", "_row"), block, wide, q, error_rate)
            passes = found if passes is None else passes.union(found)
        joined = passes.groupBy("_row").agg(F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches"))
        return own.select("doc_id", "_row").join(joined, "_row").select("doc_id", "matches")
    return _pass(own, blocks[0], schema, q, error_rate)


def _indexes(block: DataFrame, q: int, error_rate: float) -> list[GramIndex]:
    rows = [(r["item_id"], normal(r["text"])) for r in block.collect()]  # one block, of bounded size
    sizes: dict[int, set] = {q: set()}
    for row in rows:
        if len(row[1]) >= q:
            sizes.setdefault(gram_size(len(row[1]), q, error_rate), set()).add(row)
    return [build_index(sorted(items, key=str), size, error_rate) for size, items in sorted(sizes.items())]


def _pass(own: DataFrame, block: DataFrame, schema: T.StructType, q: int, error_rate: float) -> DataFrame:
    shared = own.sparkSession.sparkContext.broadcast(_indexes(block, q, error_rate))
    return own.mapInArrow(_finder(shared, schema), schema)


def _free(shared):
    def free(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([not m for m in _found(texts, shared.value)], pa.bool_())
    return arrow_udf(free, T.BooleanType())


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          q: int = Q, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item occurs, with all their columns.

    Only the text goes to Python, and only the answer comes back. A further block
    of the benchmark looks at what the ones before it have left, in the same pass.
    """
    for block in benchmark_blocks(benchmark, item_id, item_text, q, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(_indexes(block, q, error_rate))
        docs = docs.filter(_free(shared)(F.col(f"`{text}`").cast("string")))
    return docs


def leaked(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: ``doc_id, leaked, n_items, item_ids, edits`` (least edits of its matches)."""
    found = matches(docs, benchmark)
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.select("doc_id", (F.size("matches") > 0).alias("leaked"),
                        F.size(items).cast("long").alias("n_items"), items.alias("item_ids"),
                        F.array_min(F.transform("matches", lambda m: m["edits"])).alias("edits"))
