"""Helpers of the corpus operators: staging, ranks, components, packed texts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from drydock.session import remove_path, scratch

#: A run of characters other than blank, tab, line feed to carriage return.
BLANK_SEPARATED = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read again: what follows sees one
    fixed result, however often it is read and whichever executors are lost."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstaged(df: DataFrame) -> None:
    """Delete what ``staged`` has written, when nothing reads it any more."""
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        remove_path(df.sparkSession, folder)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that does not occur, whatever columns the caller brings."""
    taken, name = {c.lower() for c in df.columns}, f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hashable(values: Sequence[Column], df: DataFrame) -> list[Column]:
    """Columns of ``df`` as Spark can hash them: as JSON where a type holds a map or variant."""
    kinds = [kind for _, kind in df.select(*[v.alias(f"_{k}") for k, v in enumerate(values)]).dtypes]
    return [F.to_json(F.struct(v.alias("value"))) if "map<" in kind or "variant" in kind else v
            for v, kind in zip(values, kinds, strict=True)]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_SEPARATED)), F.lit(0)).cast("long")


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Positions from 0 along ``order``, without one task that sees all rows:
    rows are cut into ranges, numbered inside each, and moved by the rows before."""
    ranged = (df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    inside = staged(ranged.withColumn("_at", F.row_number().over(Window.partitionBy("_range").orderBy(*order))),
                    "numbered")
    counts = sorted((r["_range"], r["n"]) for r in inside.groupBy("_range").agg(F.count("*").alias("n")).collect())
    before, total = [], 0  # one entry per range, of which there are as many as shuffle partitions
    for piece, n in counts:
        before.append((piece, total))
        total += n
    if not before:
        return inside.withColumn(name, F.col("_at").cast("long")).drop("_range", "_at")
    offsets = df.sparkSession.createDataFrame(before, "_range int, _before long")
    return (inside.join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_at") - 1 + F.col("_before")).drop("_range", "_at", "_before"))


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected components of ``(a, b)`` as ``(id, root)``, root the least id.

    Every round joins each id's root to its neighbours' and takes the least,
    then jumps to the root's root; rounds grow with the logarithm of a path.
    Each round is written to the shared folder, so no lineage builds up. A hub
    with a third of all edges is met by partial aggregation and by Spark's
    splitting of skewed joins.
    """
    spark = edges.sparkSession
    both = staged(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .filter("a <> b").distinct(), "edges")
    roots = staged(both.groupBy("a").agg(F.min("b").alias("m"))
                   .select(F.col("a").alias("id"), F.least("a", "m").alias("root")), "roots")
    for _ in range(rounds):
        near = (both.join(roots, both["b"] == roots["id"]).groupBy("a").agg(F.min("root").alias("near")))
        low = roots.join(near, roots["id"] == near["a"], "left").select(
            "id", "root", F.least("root", F.coalesce("near", "root")).alias("low"))
        hooks = (low.groupBy(F.col("root").alias("at")).agg(F.min("low").alias("to")))
        stepped = low.join(hooks, low["root"] == hooks["at"]).select("id", "root", F.least("low", "to").alias("low"))
        onward = stepped.select(F.col("id").alias("at"), F.col("low").alias("to"))
        jumped = staged(stepped.join(onward, stepped["low"] == onward["at"], "left").select(
            "id", F.col("root").alias("old"), F.least("low", F.coalesce("to", "low")).alias("root")), "roots")
        changed = jumped.filter("root <> old").limit(1).count()
        roots = jumped.select("id", "root")
        if not changed:
            return roots
    raise RuntimeError(f"components did not settle in {rounds} rounds")


# -- packed texts -------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers (mod 2**64) of an odd base, or of its inverse."""
    key = "inverse" if inverse else "plain"
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[key] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash: see ``spans_hash``."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values)), out=out[1:])
    return out


def spans_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end), equal for equal contents anywhere."""
    return mixed((prefix[end] - prefix[start]) * powers(len(prefix), inverse=True)[start]
                 + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


_KINDS: dict[str, np.ndarray] = {}


def is_kind(points: np.ndarray, kind: str) -> np.ndarray:
    """str.isalpha, str.isalnum ... for an array of code points."""
    known = _KINDS.get(kind)
    if known is None:
        known = _KINDS[kind] = np.array([getattr(chr(c), kind)() for c in range(0x20000)])
    found = known[np.minimum(points, 0x1FFFF)]
    for c in np.unique(points[points >= 0x20000]):
        found[points == c] = getattr(chr(int(c)), kind)()
    return found


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def chunks(rows: Sequence, sizes: Sequence[int], most: int):
    """Consecutive slices of at most ``most`` in total size, or one large row."""
    start = total = 0
    for at, n in enumerate(sizes):
        if at > start and total + n > most:
            yield rows[start:at]
            start, total = at, 0
        total += n
    if start < len(rows):
        yield rows[start:]


def slices(texts, rows: int = 256):
    """The texts of an Arrow array as lists of a few rows each (null: empty), so that
    no more than those are held a second time as Python strings."""
    for at in range(0, len(texts), rows):
        yield [t or "" for t in texts.slice(at, rows).to_pylist()]


def whole_groups(batches, keys: Sequence[str], most_rows: int, most_bytes: int):
    """Arrow tables of whole groups from batches that are sorted by ``keys`` (no nulls).

    A table has at least ``most_rows`` rows or ``most_bytes`` bytes, but for the
    last; groups are kept small by whoever deals them out.
    """
    import pyarrow as pa
    held, rows, size = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows < most_rows and size < most_bytes:
            continue
        whole = pa.Table.from_batches(held)
        new = np.zeros(whole.num_rows, dtype=bool)
        for k in keys:
            values = whole.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        cut = int(np.flatnonzero(new)[-1]) if new.any() else 0
        if cut:
            yield whole.slice(0, cut)
        rest = whole.slice(cut).combine_chunks()
        held = rest.to_batches()
        rows, size = rest.num_rows, rest.nbytes
    if held:
        yield pa.Table.from_batches(held)


def group_starts(table, keys: Sequence[str]) -> np.ndarray:
    """Where the groups of a sorted table begin, and its end."""
    new = np.ones(table.num_rows, dtype=bool)
    if table.num_rows:
        new[1:] = False
    for k in keys:
        values = table.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)
