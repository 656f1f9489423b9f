"""N-gram Jaccard join by a MinHash LSH forest with exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from drydock.llm.common import (
    chunks, code_points, components, fresh, group_starts, hashable, is_kind, mixed, rolled, runs, spans_hash, staged,
    whole_groups)
from drydock.llm.vectors import spanning

NGRAM = 5
SIMILARITY = 0.8
TREES = 16
DEPTH = 8
RECALL = 0.999
BATCH_CHARS = 1_000_000
BLOCK_ROWS = 1_024
VERIFY_ROWS = 256
VERIFY_BYTES = 32 << 20


# -- shingles -----------------------------------------------------------------


def shingle_hashes(texts: list[str], ngram: int = NGRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each text's word n-grams: ``shingles, start, n_words``.

    Words are runs of letters and digits in lower case. A text of fewer than
    ``ngram`` words has all its words as its one shingle; one without words none.
    """
    lowered = [t.lower() for t in texts]
    offsets = np.concatenate(([0], np.cumsum(np.array([len(t) for t in lowered], dtype=np.int64) + 1)))
    points = code_points("\n".join(lowered) + "\n")
    start, end = runs(is_kind(points, "isalnum"))
    words = spans_hash(rolled(points), start, end)
    doc = np.searchsorted(offsets, start, "right") - 1
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(n_words)))[:-1]
    count = np.where(n_words >= ngram, n_words - ngram + 1, np.minimum(n_words, 1))
    at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    size = np.repeat(np.minimum(n_words, ngram), count)
    prefix = rolled(words)
    return spans_hash(prefix, at, at + size), np.concatenate(([0], np.cumsum(count))), n_words


def signature_seeds(length: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, length + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def signatures(shingles: np.ndarray, start: np.ndarray, length: int, seed: int) -> np.ndarray:
    """MinHash signatures, one row of 32-bit values per text that has shingles."""
    filled = np.flatnonzero(np.diff(start))
    out = np.zeros((len(start) - 1, length), dtype=np.uint32)
    if len(filled):
        for k, salt in enumerate(signature_seeds(length, seed)):
            hashed = ((shingles ^ salt) * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(32)
            out[filled, k] = np.minimum.reduceat(hashed, start[filled])
    return out


def recall_at(similarity: float | np.ndarray, depth: int, trees: int) -> float | np.ndarray:
    """Chance that a pair of this similarity shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def _signer(length: int, ngram: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            ids, at = batch.column(1), 0
            for some in chunks(texts, [len(t) for t in texts], BATCH_CHARS):
                shingles, start, n_words = shingle_hashes(some, ngram)
                signature = signatures(shingles, start, length, seed)
                # equal word sequences are one class: a 128-bit hash over the shingles in order
                order = rolled(shingles)
                low = spans_hash(order, start[:-1], start[1:])
                twice = rolled(mixed(shingles))
                high = spans_hash(twice, start[:-1], start[1:]) ^ n_words.astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(some)), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)),
                     pa.array(n_words.astype(np.int64)), pa.array([r.tobytes() for r in signature], pa.binary()),
                     pa.array([r.tobytes() for r in signature.astype(np.uint8)], pa.binary())],
                    names=["id", "low", "high", "n_words", "signature", "sketch"])
                at += len(some)
    return run


# -- candidates: prefixes of the trees ----------------------------------------


def _prefixes(depth: int, full: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            signature = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, trees, full)
            key = np.zeros((n, trees), dtype=np.uint64) + np.arange(1, trees + 1, dtype=np.uint64)
            for k in range(depth):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, :, k].astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.reshape(-1).view(np.int64)),
                 pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), trees))], names=["key", "item"])
    return run


MET = ("key", "first", "second")


def pairs_within(start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ``i < j`` inside consecutive groups that begin at ``start`` (its last is the end)."""
    size = np.diff(start)
    place = np.arange(int(start[-1] - start[0])) - np.repeat(start[:-1] - start[0], size)
    after = np.repeat(size, size) - 1 - place
    i = np.repeat(np.arange(len(place)), after)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
    return i + int(start[0]), j + int(start[0])


def _estimator(length: int, least: float):
    """Who is near whom by signature among the items of each bucket, as a spanning forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, MET, 20_000, 32 << 20):
            values = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, length)
            items, node = np.unique(rows.column("item").to_numpy(), return_inverse=True)
            block, first, second = (rows.column(c).to_numpy() for c in ("block", "first", "second"))
            starts = group_starts(rows, MET)
            ends_a, ends_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            sizes = np.diff(starts)
            for part in chunks(np.arange(len(sizes)), list(sizes * sizes), 1 << 20):
                i, j = pairs_within(starts[part[0]:part[-1] + 2])
                met = (block[i] != block[j]) | (first[i] == second[i])
                i, j = i[met], j[met]
                for at in range(0, len(i), 1 << 15):
                    x, y = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
                    near = (values[x] == values[y]).sum(axis=1) >= least * length
                    ends_a.append(node[x[near]])
                    ends_b.append(node[y[near]])
            low, high = spanning(np.concatenate(ends_a), np.concatenate(ends_b), len(items))
            yield pa.RecordBatch.from_arrays([pa.array(items[low].astype(np.int64)),
                                              pa.array(items[high].astype(np.int64))], names=["a", "b"])
    return run


def _sorted_groups(met: DataFrame, keys: tuple) -> DataFrame:
    return met.repartition(*keys).sortWithinPartitions(*keys)


def cut_blocks(rows: DataFrame, key: str, cuts: DataFrame) -> DataFrame:
    """Rows of a key met block by block: plus ``block, first, second``. ``cuts`` has the
    number of blocks of each key (``_key, _cuts``); keys it does not name are left out."""
    own = rows.join(cuts, rows[key] == cuts["_key"]).withColumn("block", F.pmod(F.xxhash64("item"), F.col("_cuts")))
    met = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)))
    return met.withColumn("first", F.least("block", "_other")).withColumn(
        "second", F.greatest("block", "_other")).drop("_key", "_cuts", "_other")


def candidate_edges(signed: DataFrame, depth: int, trees: int, full: int, least: float) -> DataFrame:
    """Edges ``(a, b)`` that connect items ``(item, signature, sketch)`` sharing a prefix
    of ``depth`` in some tree and looking similar enough by the whole sketch, which
    is the low byte of each value: it agrees wherever the signature does.

    Only keys travel at first; sketches follow to keys that two items share. A
    key shared by many is met in blocks, and each pair of blocks gives no more
    edges than it has items.
    """
    keys = signed.select("item", "signature").mapInArrow(_prefixes(depth, full, trees), "key long, item long")
    counts = keys.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1").select(
        F.col("key").alias("_key"), F.ceil(F.col("_n") / BLOCK_ROWS).cast("int").alias("_cuts"))
    met = cut_blocks(keys, "key", counts)
    with_sketch = met.join(signed.select("item", "sketch"), "item")
    # in a bucket everyone shares the prefix; the whole sketch decides who is a candidate
    return _sorted_groups(with_sketch.select(*MET, "block", "item", "sketch"), MET).mapInArrow(
        _estimator(full * trees, least), "a long, b long")


# -- verification --------------------------------------------------------------


def exact_links(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray,
                similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of rows and columns whose sets have a Jaccard of at least ``similarity``, with it."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    if len(sets) <= 4:
        common = np.array([[len(np.intersect1d(sets[a], sets[b], assume_unique=True)) if a < b else 0
                            for b in range(len(sets))] for a in range(len(sets))], dtype=np.int64)
        common = common + common.T
    else:
        owner = np.repeat(np.arange(len(sets)), size)
        _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[code] > 1  # the others are in no intersection
        owner, code = owner[shared], code[shared]
        order = np.argsort(code, kind="stable")
        owner, code = owner[order], code[order]
        distinct, begin = np.unique(code, return_index=True)
        begin = np.append(begin, len(code))
        counted = np.zeros((len(sets), len(sets)), dtype=np.float32)
        for at in range(0, len(distinct), 8192):  # a slice of the shingles at a time bounds the matrix
            end = min(at + 8192, len(distinct))
            part = slice(begin[at], begin[end])
            table = np.zeros((len(sets), end - at), dtype=np.float32)
            table[owner[part], np.searchsorted(distinct[at:end], code[part])] = 1
            counted += table @ table.T
        common = counted.astype(np.int64)
    common = common[np.ix_(rows, columns)]
    union = size[rows][:, None] + size[columns][None, :] - common
    i, j = np.nonzero((common >= similarity * union - 1e-9) & (common > 0))  # 4 of 5 is 0.8, however it rounds
    jaccard = common[i, j] / union[i, j]
    i, j = rows[i], columns[j]
    once = i != j
    return i[once], j[once], jaccard[once]


TOLD = ("group", "first", "second")
LINKS = "item long, root long, links long, pairs long, implied double"


def _verifier(similarity: float, ngram: int, depth: int, trees: int):
    def verified(items, copies, block, first, second, sets):
        rows = np.flatnonzero(block == first)
        columns = rows if first == second else np.flatnonzero(block == second)
        i, j, jaccard = exact_links(sets, rows, columns, similarity)
        if first == second:
            i, j, jaccard = i[i < j], j[i < j], jaccard[i < j]
        links = np.bincount(i, copies[j], len(items)) + np.bincount(j, copies[i], len(items))
        low, high = spanning(i, j, len(items))
        root = items.copy()
        root[high] = items[low]
        implied = np.bincount(i, 1 / recall_at(jaccard, depth, trees), len(items))
        linked = np.flatnonzero(links)
        return (items[linked], root[linked], links[linked].astype(np.int64),
                np.bincount(i, minlength=len(items))[linked], implied[linked])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, TOLD, 2_000, 16 << 20):
            texts = rows.column("text").to_pylist()
            sets: list[np.ndarray] = []
            for some in chunks(texts, [len(t) for t in texts], BATCH_CHARS):
                shingles, start, _ = shingle_hashes(some, ngram)
                sets += [np.unique(shingles[a:b]) for a, b in zip(start[:-1], start[1:], strict=True)]
            items, copies, block, first, second = (
                rows.column(c).to_numpy() for c in ("item", "copies", "block", "first", "second"))
            starts, found = group_starts(rows, TOLD), []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                # a repeated row counts once; items in order, so that the least comes first
                own = a + np.unique(items[a:b], return_index=True)[1]
                found.append(verified(items[own], copies[own], block[own], first[a], second[a],
                                      [sets[x] for x in own]))
            kinds = (np.int64, np.int64, np.int64, np.int64, np.float64)  # empty parts have types of their own
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).astype(k)) for x, k in zip(zip(*found, strict=True), kinds, strict=True)],
                names=["item", "root", "links", "pairs", "implied"])
    return run


def _verified(own: DataFrame, items: DataFrame, edges: DataFrame, similarity: float, ngram: int, depth: int,
              trees: int) -> DataFrame:
    """Exact links inside the groups that candidates connect; texts travel to their group, block by block.

    Members grow with the documents, so their join is a shuffle at every size.
    """
    groups = components(edges).withColumnRenamed("id", "item").withColumnRenamed("root", "group")
    members = staged(items.join(groups, "item").select(
        "item", "copies", "least_id", "least_text", "group", "n_bytes"), "members")
    cuts = members.groupBy("group").agg(F.count("*").alias("_n"), F.sum("n_bytes").alias("_b")).select(
        "group", F.greatest(F.ceil(F.col("_n") / VERIFY_ROWS), F.ceil(F.col("_b") / VERIFY_BYTES), F.lit(1))
        .cast("int").alias("_cuts"))
    known = members.join(cuts, "group")
    texts = own.select("id", "text", F.xxhash64("text").alias("text_hash")).join(
        known.hint("merge"), F.col("id").eqNullSafe(F.col("least_id")) & (F.col("text_hash") == F.col("least_text")))
    met = (texts.withColumn("block", F.pmod(F.xxhash64("item"), F.col("_cuts")))
           .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)))
           .select("group", F.least("block", "_other").alias("first"), F.greatest("block", "_other").alias("second"),
                   "block", "item", "copies", "text"))
    return _sorted_groups(met, TOLD).mapInArrow(_verifier(similarity, ngram, depth, trees), LINKS)


def near_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
               ngram: int = NGRAM, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL,
               seed: int = 3) -> DataFrame:
    """``doc_id, text_hash, group, n_links, component_id, kept`` for every row.

    Two documents are linked where the Jaccard similarity of their sets of word
    n-grams is at least ``similarity``. ``n_links`` counts all other linked
    rows, copies included; ``component_id`` is the least id reachable over
    links, itself included; ``kept`` says whether that is the row's own.

    Each text has ``trees`` labels of ``depth`` MinHash values; a tree is the
    sorted trie of one label, in which texts meet at the prefix they share. The
    prefix begins at full depth and is shortened, first until a pair just at the
    threshold is found with probability ``recall``, then, should the verified
    links imply a lower recall (each found with a chance its own similarity
    gives), further until they do not. What meets and looks similar by its whole
    signature is connected, and inside each connected group every pair is
    verified on its exact sets. Neither step writes pairs: both give each text
    its number of links and the least text it is connected with.

    Texts with the same words in the same order are one class with a number of
    copies. Null texts and texts without words link with nothing; texts of
    fewer than ``ngram`` words are linked when all their words agree. Rows with
    a null id are linked like others, and null is a component's id only where
    all its ids are. Rows that repeat id and text are copies with one id.
    ``group`` numbers the components (null for texts without words). Other
    columns are left aside; an empty table gives an empty result.
    """
    length = trees * depth
    own = docs.select(F.col(text).cast("string").alias("text"), F.col(doc_id).cast("long").alias("id"))
    tagged = own.select("text", F.struct("id", F.xxhash64("text").alias("text_hash"),
                                         F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
                        .alias("id"))
    signed = staged(tagged.mapInArrow(
        _signer(length, ngram, seed), "id struct<id: bigint, text_hash: bigint, n_bytes: bigint>, low long, high long, "
        "n_words long, signature binary, sketch binary").select("id.*", "low", "high", "n_words", "signature", "sketch"),
        "signed")
    worded = signed.filter("n_words > 0")
    classes = worded.groupBy("low", "high").agg(
        F.count("*").alias("copies"), F.min(F.struct(
            F.col("id").isNull().alias("none"), "id", "text_hash", "n_bytes", "signature", "sketch")).alias("least"))
    with_signature = staged(classes.select(
        "low", "high", "copies", F.col("least.id").alias("least_id"), F.col("least.text_hash").alias("least_text"),
        "least.n_bytes", "least.signature", "least.sketch").withColumn("item", F.monotonically_increasing_id()), "classes")
    classes = with_signature.drop("signature", "sketch")
    by_item = with_signature.select("item", "signature", "sketch")

    reach = depth
    while reach > 1 and recall_at(similarity, reach, trees) < recall:
        reach -= 1
    looks = max(0.0, similarity - 5 * (similarity * (1 - similarity) / length) ** 0.5)
    while True:
        edges = staged(candidate_edges(by_item, reach, trees, depth, looks), "candidates")
        links = staged(_verified(own, classes, edges, similarity, ngram, reach, trees), "links")
        seen = links.agg(F.sum("pairs").alias("pairs"), F.sum("implied").alias("implied")).first()
        if reach == 1 or not seen["pairs"] or seen["pairs"] / seen["implied"] >= recall:
            break
        reach -= 1

    roots = components(links.select(F.col("item").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("item").agg(F.sum("links").alias("others"))
    known = staged(classes.join(roots.withColumnRenamed("id", "item"), "item", "left").join(counts, "item", "left")
                   .select("low", "high", "least_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1)
                           .alias("n_links"), F.coalesce("root", "item").alias("root")), "known")
    low = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    joined = worded.join(known.join(low, "root").select(
        "low", "high", F.col("root").alias("group"), "n_links", "component_id"), ["low", "high"])
    alone = signed.filter("n_words = 0").select(
        "id", "text_hash", F.lit(None).cast("long").alias("group"), F.lit(0).cast("long").alias("n_links"),
        F.col("id").alias("component_id"))
    return (joined.select("id", "text_hash", "group", "n_links", "component_id").union(alone)
            .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", "doc_id"))


def distinct_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each group of near duplicates.

    The row with the least id (then text hash) stays; where rows repeat both, one
    of them. Rows without words are in no group, and all stay.
    """
    whole, key, once, content = (fresh(docs, n) for n in ("whole", "key", "once", "content"))
    names = ("doc_id", "text_hash")
    found = near_texts(docs, doc_id, text, **options).select("group", F.struct(*names).alias(key), F.struct(
        F.col("doc_id").isNull().alias("none"), *names).alias("order"))
    chosen = found.filter("group IS NOT NULL").groupBy("group").agg(F.min("order").alias("order")).select(
        F.struct(*[F.col(f"order.{n}") for n in names]).alias(key), F.lit(True).alias(once))
    alone = found.filter("group IS NULL").select(key, F.lit(False).alias(once)).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), F.struct(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("text_hash")).alias(key),
        F.xxhash64(*hashable([F.col(f"`{c}`") for c in docs.columns], docs)).alias(content))
    kept = rows.join(chosen.union(alone), key)
    order = Window.partitionBy(key).orderBy(content)
    return kept.withColumn("_place", F.row_number().over(order)).filter(
        ~F.col(once) | (F.col("_place") == 1)).select(f"{whole}.*")
