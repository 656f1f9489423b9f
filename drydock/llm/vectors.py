"""Near-duplicate vectors by a forest of random-projection trees with spill."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from drydock.llm.common import components, staged

TREES = 12
SAMPLE_ROWS = 16_384
LEAF_ROWS = 512
BLOCK_ROWS = 2_048
MARGIN = 0.08
DENSE = 0.2


@dataclass
class Tree:
    """Splits in order of creation: a child is a later split, or -1 - leaf."""

    directions: list = field(default_factory=list)
    cuts: list = field(default_factory=list)
    children: list = field(default_factory=list)
    leaves: int = 0


def best_cut(values: np.ndarray, margin: float) -> tuple[float, float]:
    """A cut between the quartiles with the least share of values within ``margin`` of it, and that share."""
    ordered = np.sort(values)
    cuts = np.quantile(ordered, np.linspace(0.25, 0.75, 17))
    near = np.searchsorted(ordered, cuts + margin, "right") - np.searchsorted(ordered, cuts - margin, "left")
    at = int(near.argmin())
    return float(cuts[at]), float(near[at]) / len(ordered)


def grow(sample: np.ndarray, leaf: int, rng: np.random.Generator, margin: float = MARGIN, tries: int = 6) -> Tree:
    """Split unit vectors again and again along random directions.

    Whoever lies within ``margin`` of a cut goes to both sides. A node is a leaf
    when few vectors are left, or when it is dense: along no direction tried is
    there a cut that keeps most of its vectors on one side only.
    """
    tree = Tree()

    def node(rows: np.ndarray) -> int:
        if len(rows) > leaf:
            for _ in range(tries):
                direction = rng.standard_normal(sample.shape[1])
                along = sample[rows] @ direction
                cut, spilled = best_cut(along, margin)
                if spilled <= DENSE and (along < cut - margin).any() and (along > cut + margin).any():
                    at = len(tree.cuts)
                    tree.directions.append(direction)
                    tree.cuts.append(cut)
                    tree.children.append([0, 0])
                    tree.children[at] = [node(rows[along <= cut + margin]), node(rows[along >= cut - margin])]
                    return at
        tree.leaves += 1
        return -tree.leaves

    node(np.arange(len(sample)))
    return tree


def leaves_of(tree: Tree, vectors: np.ndarray, margin: float = MARGIN) -> tuple[np.ndarray, np.ndarray]:
    """All ``(row, leaf)`` of the vectors in a tree; rows near a cut have several."""
    rows_out, leaf_out = [], []
    todo = [(0 if tree.cuts else -1, np.arange(len(vectors)))]
    while todo:
        at, rows = todo.pop()
        if not len(rows):
            continue
        if at < 0:
            rows_out.append(rows)
            leaf_out.append(np.full(len(rows), -at - 1, dtype=np.int64))
            continue
        along = vectors[rows] @ tree.directions[at]
        left, right = tree.children[at]
        todo.append((left, rows[along <= tree.cuts[at] + margin]))
        todo.append((right, rows[along >= tree.cuts[at] - margin]))
    if not rows_out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows_out), np.concatenate(leaf_out)


def unit(vectors: np.ndarray) -> np.ndarray:
    # scaled by the largest component first, so neither huge nor tiny vectors lose their norm
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _stack(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims)


def _assigner(forest, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = forest.value
        bases = np.concatenate(([0], np.cumsum([t.leaves for t in trees])))
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = unit(_stack(batch.column(2), dims))
            found = [leaves_of(t, vectors) for t in trees]
            rows = np.concatenate([r for r, _ in found])
            leaf = np.concatenate([x + base for (_, x), base in zip(found, bases[:-1], strict=True)])
            order = np.lexsort((leaf, rows))
            rows, leaf = rows[order], leaf[order]
            start = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            codes = pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(leaf, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), codes],
                                             names=["item", "copies", "embedding", "leaves"])
    return run


def earlier_meeting(codes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether two padded rows of leaf codes (-1 and -2 where empty) share one."""
    met = np.zeros(len(codes), dtype=bool)
    for k in range(codes.shape[1]):
        met |= (other == codes[:, k][:, None]).any(axis=1)
    return met


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For edges among n nodes, one edge from each node to the least node of its component."""
    low = np.arange(n)
    while len(a):
        least = low.copy()
        np.minimum.at(least, a, low[b])
        np.minimum.at(least, b, low[a])
        least = least[least]
        if (least == low).all():
            break
        low = least
    node = np.flatnonzero(low != np.arange(n))
    return low[node], node


def _comparer(dims: int, least: float):
    def run(key, group):
        leaf, first, second = (int(k) for k in key)
        group = group.sort_values("item", kind="stable").reset_index(drop=True)
        vectors = unit(np.stack(group["embedding"].to_numpy()).astype(np.float64).reshape(len(group), dims))
        items, copies = group["item"].to_numpy(), group["copies"].to_numpy()
        widest = max(1, max(int(np.searchsorted(c, leaf)) for c in group["leaves"]))
        before = np.full((len(group), widest), -1, dtype=np.int64)
        for at, c in enumerate(group["leaves"]):
            n = int(np.searchsorted(c, leaf))
            before[at, :n] = c[:n]
        other = np.where(before < 0, -2, before)
        rows = np.flatnonzero(group["block"].to_numpy() == first)
        columns = rows if first == second else np.flatnonzero(group["block"].to_numpy() == second)
        links = np.zeros(len(group), dtype=np.int64)
        ends_a, ends_b = [], []
        for start in range(0, len(rows), 256):
            some = rows[start:start + 256]
            i, j = np.nonzero(vectors[some] @ vectors[columns].T >= least)
            i, j = some[i], columns[j]
            if first == second:
                i, j = i[i < j], j[i < j]
            new = np.zeros(len(i), dtype=bool)
            for at in range(0, len(i), 100_000):
                part = slice(at, at + 100_000)
                new[part] = ~earlier_meeting(before[i[part]], other[j[part]])
            i, j = i[new], j[new]
            links += np.bincount(i, copies[j], len(group)).astype(np.int64)
            links += np.bincount(j, copies[i], len(group)).astype(np.int64)
            low, high = spanning(i, j, len(group))
            ends_a.append(low)
            ends_b.append(high)
        low, high = spanning(np.concatenate(ends_a), np.concatenate(ends_b), len(group)) if ends_a else ([], [])
        linked = np.flatnonzero(links)
        root = items.copy()
        root[high] = items[low]
        return pd.DataFrame({"item": items[linked], "root": root[linked], "links": links[linked]})
    return run


def _blocks(rows: DataFrame, key: str, block_rows: int) -> DataFrame:
    """Rows of a key met block by block: plus ``block, first, second``.

    A key of at most ``block_rows`` rows is one block. A larger one is cut, and
    each row goes to every pair its block is in, so no task gets more than two blocks.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1")
    cut = counts.select(F.col(key).alias("_key"), F.ceil(F.col("_n") / block_rows).cast("int").alias("_cuts"))
    own = rows.join(cut, rows[key] == cut["_key"]).withColumn("block", F.pmod(F.xxhash64("item"), F.col("_cuts")))
    met = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)))
    return met.withColumn("first", F.least("block", "_other")).withColumn(
        "second", F.greatest("block", "_other")).drop("_key", "_cuts", "_other")


def link_vectors(items: DataFrame, dims: int, least: float, trees: int = TREES, leaf_rows: int = LEAF_ROWS,
                 sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS, seed: int = 1) -> DataFrame:
    """Links among distinct vectors ``(item, copies, embedding)`` of one length: ``item, root, links``.

    The trees are grown on a sample of about ``sample_rows`` vectors, but every
    vector goes down every tree. A pair is compared in each leaf it shares and
    counted in the first, which both rows can tell from their lists of leaves;
    so no pair is ever written: a leaf gives each vector its number of new links
    and the least vector it is connected with there.
    """
    spark = items.sparkSession
    total = items.count()
    draw = F.pmod(F.xxhash64(F.lit(seed), "item"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = items.filter(draw < min(1.0, sample_rows / max(1, total))).select("item", "embedding").collect()
    sample = np.array([r["embedding"] for r in sorted(picked)], dtype=np.float64).reshape(-1, dims)
    rng = np.random.default_rng(seed)
    leaf = max(8, math.ceil(leaf_rows * len(sample) / max(1, total)))
    forest = [grow(unit(sample), leaf, rng) if len(sample) else Tree(leaves=1) for _ in range(trees)]
    shared = spark.sparkContext.broadcast(forest)
    placed = items.select("item", "copies", "embedding").mapInArrow(
        _assigner(shared, dims), "item long, copies long, embedding array<double>, leaves array<long>")
    placed = staged(placed, "leaves")
    held = placed.withColumn("leaf", F.explode("leaves"))
    met = _blocks(held, "leaf", block_rows)
    return met.groupBy("leaf", "first", "second").applyInPandas(
        _comparer(dims, least), "item long, root long, links long")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.9,
                 **options) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Two vectors are linked where their cosine, in double precision, is at least
    ``least``. ``n_links`` counts all other linked rows, copies included;
    ``component_id`` is the least id reachable over links, itself included;
    ``kept`` says whether that is the row's own.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    rows with a null id, link with nothing (a null id is its own component).
    Vectors of different lengths never link. Equal vectors are one item with a
    number of copies, so a copy held by a third of all rows is compared once.
    Rows which repeat an id are rows like any other. An empty table gives an
    empty result; other columns are left aside. Scaled copies have cosine 1.
    """
    own = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                         F.col(embedding).cast("array<double>").alias("embedding"))
    sound = (F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
             & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("embedding", lambda x: x != 0))
    flagged = own.withColumn("sound", F.coalesce(sound, F.lit(False)))
    alone = flagged.filter("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                               F.col("vec_id").alias("component_id"))
    good = flagged.filter("sound").select("vec_id", "embedding")
    items = staged(good.groupBy("embedding").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
                   .withColumn("item", F.monotonically_increasing_id()), "vectors")
    sizes = sorted(r[0] for r in items.select(F.size("embedding")).distinct().collect())
    partial = None
    for dims in sizes:  # nearly always one length
        found = link_vectors(items.filter(F.size("embedding") == dims), dims, least, **options)
        partial = found if partial is None else partial.union(found)
    if partial is None:
        linked = items.select("embedding", (F.col("copies") - 1).alias("n_links"),
                              F.col("least_id").alias("component_id"))
    else:
        partial = staged(partial, "links")
        roots = components(partial.select(F.col("item").alias("a"), F.col("root").alias("b")))
        counts = partial.groupBy("item").agg(F.sum("links").alias("others"))
        known = items.join(roots.withColumnRenamed("id", "item"), "item", "left").join(counts, "item", "left").select(
            "embedding", "copies", "least_id", F.coalesce("others", F.lit(0)).alias("others"),
            F.coalesce("root", "item").alias("root"))
        known = staged(known, "linked")
        low = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
        linked = known.join(low, "root").select(
            "embedding", (F.col("others") + F.col("copies") - 1).alias("n_links"), "component_id")
    joined = good.join(linked, "embedding").select("vec_id", "n_links", "component_id")
    return joined.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
