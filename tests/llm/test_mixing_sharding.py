import random
from collections import Counter

import pytest

from cases import CLASHES, DOCS, awkward, frame
from drydock.llm import mixing, sharding


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """The excess over a stop is dealt out again and again, in fractions."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, rest, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while rest > 1e-9 and free:
        whole = sum(weight[s] for s in free)
        for s in free:
            target[s] += rest * weight[s] / whole
        rest = 0.0
        for s in list(free):
            if target[s] >= most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.discard(s)
    return target


def test_targets_against_brute_force(spark):
    rng = random.Random(3)
    for _ in range(3):
        sizes = {f"s{k}": rng.choice([0, 1, 5, 50, 1000, 20000]) for k in range(rng.randint(1, 9))} | {None: 7}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        assert found == pytest.approx(brute_targets(sizes), rel=1e-9, abs=1e-6)


def test_mix_awkward(spark):
    df = frame(spark, extra=CLASHES)
    out = mixing.mix(df)
    assert out.columns[:-1] == df.columns
    rows = out.collect()
    assert len(rows) == len(awkward())
    for r in rows:
        m = r[out.columns[-1]]
        assert m["size"] == len([w for w in (r["text"] or "").replace("\n", " ").replace("\t", " ").split(" ") if w])
        assert m["taken"] == m["size"] * m["copies"] and 0 <= m["copies"] <= 3
    again = sorted(map(repr, mixing.mix(df.repartition(3)).collect()))
    assert sorted(map(repr, rows)) == again
    emitted = Counter(map(repr, mixing.emit(df).collect()))
    wanted = Counter()
    for r in rows:
        wanted[repr(r[:-1])] += r[out.columns[-1]]["copies"]
    assert sorted(emitted.values()) == sorted(v for v in wanted.values() if v)
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.emit(df.limit(0)).columns == df.columns


def test_hypergeometric_is_exact():
    from math import comb
    draw, counts, n = random.Random(5), Counter(), 20000
    for _ in range(n):
        counts[sharding.hypergeometric(draw, 7, 11, 6)] += 1
    for k in range(7):
        p = comb(7, k) * comb(11, 6 - k) / comb(18, 6)
        assert abs(counts[k] / n - p) < 0.015
    for good, bad, m in [(0, 5, 3), (5, 0, 3), (3, 3, 6), (1, 10**10, 10**6), (10**9, 10**9, 50_000)]:
        k = sharding.hypergeometric(draw, good, bad, m)
        assert max(0, m - bad) <= k <= min(good, m)


def test_matrix_sums():
    rows, columns = [5, 0, 17, 8], [10, 10, 10]
    matrix = sharding.communication_matrix(rows, columns, 1)
    assert [sum(r) for r in matrix] == rows and [sum(c) for c in zip(*matrix)] == columns


@pytest.mark.parametrize("piece_rows", [7, 1000])
def test_place(spark, piece_rows):
    rows = awkward() + [(100 + k, f"t{k}", None, None, k) for k in range(150)]
    df = frame(spark, rows, extra=CLASHES)
    placed = sharding.place(df, [df[c] for c in ("doc_id", "text", "lang")], shards=5, piece_rows=piece_rows)
    found = [(r[-2], r[-1]) for r in placed.collect()]
    assert placed.columns[:-2] == df.columns and len(found) == len(rows)
    sizes = Counter(s for s, _ in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) <= set(range(5))
    for shard, n in sizes.items():
        assert sorted(x for s, x in found if s == shard) == list(range(n))
    again = sharding.place(df.repartition(4), [df[c] for c in ("doc_id", "text", "lang")], shards=5, piece_rows=piece_rows)
    assert sorted(map(repr, placed.select("doc_id", *placed.columns[-2:]).collect())) == sorted(
        map(repr, again.select("doc_id", *again.columns[-2:]).collect()))
    assert sharding.place(df.limit(0), [df["doc_id"]], shards=5).collect() == []


def test_fewer_rows_than_shards(spark):
    df = spark.createDataFrame([(k, "x", None, None, 1) for k in range(3)], DOCS)
    assert sorted(r["shard"] for r in sharding.place(df, [df["doc_id"]], shards=24).collect()) == [0, 1, 2]


def test_shuffle_is_uniform(spark):
    df = spark.range(2000).selectExpr("id AS doc_id")
    placed = sharding.place(df, [df["doc_id"]], shards=4, piece_rows=100).collect()
    halves = Counter((r["shard"], r["doc_id"] < 1000) for r in placed)
    assert all(abs(halves[(s, True)] - 250) < 60 for s in range(4))
    order = [r["doc_id"] for r in sorted(placed, key=lambda r: (r["shard"], r["slot"]))]
    assert abs(sum(a < b for a, b in zip(order, order[1:])) - 1000) < 120


def test_measured(spark):
    rows = {r["doc_id"]: r for r in sharding.measured(spark.createDataFrame(
        [(1, "é"), (2, None), (3, "")], "doc_id long, text string")).collect()}
    assert (rows[1]["size"], rows[2]["size"], rows[3]["size"]) == (10, 8, 8)
    import zlib
    assert rows[1]["text_crc32"] == zlib.crc32("é".encode()) and rows[2]["text_crc32"] is None
