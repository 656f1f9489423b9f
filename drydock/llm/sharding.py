"""Sharding by a hypergeometric communication matrix."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window, functions as F

from drydock.llm.common import fresh, hashable, staged

PIECE_ROWS = 50_000


def hypergeometric(draw: random.Random, good: int, bad: int, n: int) -> int:
    """How many of n items drawn without return from good + bad are good.

    Inversion outwards from the mode, in about as many steps as the deviation.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))

    def ways(total: int, part: int) -> float:
        return math.lgamma(total + 1) - math.lgamma(part + 1) - math.lgamma(total - part + 1)

    at_mode = math.exp(ways(good, mode) + ways(bad, n - mode) - ways(good + bad, n))
    left = draw.random() - at_mode
    down, up, p_down, p_up = mode, mode, at_mode, at_mode
    while left > 0 and (down > low or up < high) and (p_down > 0 or p_up > 0):
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        else:
            p_up = 0.0
        if down > low:
            p_down *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
        else:
            p_down = 0.0
    return mode


def communication_matrix(rows: list[int], columns: list[int], seed: int) -> list[list[int]]:
    """Counts from each piece to each shard with exact sums of rows and columns,
    distributed as if all items had been shuffled uniformly."""
    draw, left, matrix = random.Random(seed), list(columns), []
    for n in rows:
        taken, open_ = [], sum(left)
        for s, room in enumerate(left):
            open_ -= room
            k = hypergeometric(draw, room, open_, n)
            taken.append(k)
            n -= k
            left[s] -= k
        matrix.append(taken)
    return matrix


def place(df: DataFrame, keys: list[Column], shards: int = 24, seed: int = 9,
          piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Every row with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in its shard).

    Rows are dealt into pieces by a hash of ``keys``. How many of a piece's rows
    go to which shard is drawn exactly, without return, from piece and shard
    sizes; shard sizes differ by one at most. Each piece is permuted (by hash)
    and cut at those counts, rows go to their shards, and each shard is permuted
    again by another hash. A shard is ordered in sub-ranges of its hash, so no
    task holds a whole one. Only the pieces' sizes, one number for ``piece_rows``
    rows, reach the driver.

    The same rows give the same result on any rerun. Rows with equal keys are
    interchangeable: their places are fixed, which of them takes which is not.
    Null keys count as values. An empty table gives an empty result.
    """
    shard_name, slot_name = (n if n not in {c.lower() for c in df.columns} else fresh(df, n) for n in ("shard", "slot"))
    own = [F.col(f"`{c}`") for c in df.columns]
    key, piece, rank, bounds, second, part, local = (fresh(df, n) for n in (
        "key", "piece", "rank", "bounds", "second", "part", "local"))
    total = df.count()
    pieces = max(1, math.ceil(total / piece_rows))
    known = [x for k in hashable(keys, df) for x in (k, k.isNull())]
    dealt = df.select(*own, F.xxhash64(F.lit(seed), *known).alias(key)).withColumn(
        piece, F.pmod(F.xxhash64(F.lit("piece"), key), F.lit(pieces)))
    sizes = {r[0]: r[1] for r in dealt.groupBy(piece).agg(F.count("*")).collect()}
    rows = [sizes.get(p, 0) for p in range(pieces)]
    matrix = communication_matrix(rows, [total // shards + (s < total % shards) for s in range(shards)], seed)
    cuts = []
    for p, counts in enumerate(matrix):
        ends, run = [], 0
        for n in counts:
            run += n
            ends.append(run)
        cuts.append((p, ends))
    cut = df.sparkSession.createDataFrame(cuts, f"{piece} long, {bounds} array<long>")
    within = Window.partitionBy(piece).orderBy(key)
    sub = max(1, math.ceil(total / shards / piece_rows))
    # the hash of the second permutation takes in the rank, so equal rows part
    sent = (dealt.withColumn(rank, F.row_number().over(within)).join(cut, piece)
            .withColumn(shard_name, F.size(F.filter(bounds, lambda end: end < F.col(rank))).cast("int"))
            .withColumn(second, F.xxhash64(F.lit("slot"), key, rank))
            .withColumn(part, F.floor(F.shiftrightunsigned(second, 1) / F.lit(2.0 ** 63) * sub).cast("long"))
            .select(*own, shard_name, second, part))
    held = staged(sent.groupBy(shard_name, part).agg(F.count("*").alias("n")), "shard-parts")
    before = held.select(shard_name, part, F.coalesce(F.sum("n").over(
        Window.partitionBy(shard_name).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias(local))
    order = Window.partitionBy(shard_name, part).orderBy(second)
    return (sent.withColumn(rank, F.row_number().over(order)).join(before, [shard_name, part])
            .select(*own, F.col(shard_name), (F.col(rank) - 1 + F.col(local)).cast("long").alias(slot_name)))


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32``: UTF-8 bytes plus 8 (null text: none), and the text's
    CRC-32 (null for a null text)."""
    body = F.col(text).cast("string").cast("binary")
    return docs.select(F.col(doc_id).alias("doc_id"),
                       (F.coalesce(F.octet_length(body), F.lit(0)) + 8).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"))
