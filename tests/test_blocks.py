"""A member parsed block by block against the same member parsed as a whole."""

import random

import numpy as np
import pytest
from conftest import zip_bytes
from pyspark.sql import functions as F

from drydock.sources import blocks
from drydock.sources.archives import expand_archives, list_members
from drydock.sources.blocks import expand_large_members


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def put(tmp_path, name, members):
    (tmp_path / name).write_bytes(zip_bytes(members))


def both(spark, tmp_path, block):
    paths = spark.createDataFrame([(str(p),) for p in sorted(tmp_path.iterdir())], "path string")
    members = list_members(paths).filter("member IS NOT NULL")
    return rows_of(expand_archives(paths)), rows_of(expand_large_members(members, block_bytes=block))


CASES = {
    "quoted": 'a,b\n1,"x\ny ""z"" , \n\n"\n2,"' + "\n" * 40 + '"\n3,plain\n',
    "ends": "a,b\r\n1,2\r\n\r\n3,4\r5,6\n\n\n7,8",
    "bare_quotes": 'a,b\n1,x"y\n2,"z"w\n3,""\n"4"5,6\n',
    "blank_first": "\n\r\n\n\n\n\n\n\n\n\n\n\n\n\n\n\n\na,b\n1,2\n",
    "one_column": "a\n1\n\n  \n2\n\"\"\n3\n",
    "ragged": "a,b,c\n1\n1,2,3\n4,5\n6,7,8\n",
    "too_long": "a,b\n1,2\n1,2,3\n3,4\n",
    "only_header": "a,b\n",
    "wide": "é,b\n1,ü\n" + "x,y\n" * 20,
    "mark": "﻿\"a\",b\n1,2\n",
    "long_record": "a,b\n1," + "x" * 500 + "\n2,y\n"}


@pytest.mark.parametrize("block", [1, 7, 64])
def test_members_equal_the_whole(spark, tmp_path, block):
    put(tmp_path, "all.zip", {f"{name}.csv": text for name, text in CASES.items()})
    put(tmp_path, "latin.zip", {"l.csv": "a,b\n1,é\n".encode("latin-1") + b"2,x\n" * 30, "é.csv": "é,b\n1,2\n".encode("latin-1")})
    whole, parts = both(spark, tmp_path, block)
    assert parts == whole


def test_random_members(spark, tmp_path):
    rng = random.Random(2)
    for k in range(12):
        text = "a,b\n" + "".join(rng.choice(['1,2\n', '"x\n","y"\n', '"a""b",\n', '\r\n', 'z,"\r\n"\r\n', 'é,🎉\n', ',\n'])
                                 for _ in range(60))
        put(tmp_path, f"r{k}.zip", {"r.csv": text})
    whole, parts = both(spark, tmp_path, 11)
    assert parts == whole


def test_faults(spark, tmp_path):
    put(tmp_path, "empty.zip", {"e.csv": "", "ok.csv": "a\n1\n"})
    (tmp_path / "torn.zip").write_bytes(zip_bytes({"t.csv": "a,b\n" + "".join(f"{k},{k * k}\n" for k in range(3000))})[:600] +
                                        zip_bytes({"t.csv": "a,b\n" + "".join(f"{k},{k * k}\n" for k in range(3000))})[700:])
    paths = spark.createDataFrame([(str(p),) for p in sorted(tmp_path.iterdir())], "path string")
    members = list_members(paths).filter("member IS NOT NULL")
    found = expand_large_members(members, block_bytes=64)
    told = {r["member"] for r in found.filter("error IS NOT NULL").collect()}
    assert "e.csv" in told and "ok.csv" not in told
    assert found.filter("member = 'ok.csv' AND row_no = 1").count() == 1


def test_large_members_are_split_and_spread(spark, tmp_path):
    put(tmp_path, "mixed.zip", {"large.csv": "a,b\n" + "".join(f'{k},"line\n{k}"\n' for k in range(20_000)), "small.csv": "a\n1\n"})
    paths = spark.createDataFrame([(str(tmp_path / "mixed.zip"),)], "path string")
    whole = rows_of(expand_archives(paths))
    small = "spark.sql.adaptive.coalescePartitions.enabled"  # Spark would put so few bytes into one task
    spark.conf.set(small, "false")
    try:
        split = expand_archives(paths, split_above=1000, block_bytes=16_384)
        tasks = split.filter("member = 'large.csv' AND row_no > 0").select(F.spark_partition_id().alias("task")).distinct().count()
    finally:
        spark.conf.unset(small)
    assert rows_of(split) == whole and tasks > 3


@pytest.mark.parametrize("seed", range(5))
def test_functions_compose(seed):
    rng = random.Random(seed)
    data = np.frombuffer("".join(rng.choice('a",\r\nb') for _ in range(rng.randint(0, 6000))).encode(), np.uint8)
    at = rng.randint(0, len(data))
    ends, records, lines = blocks.block_function(data)
    left, right = blocks.block_function(data[:at]), blocks.block_function(data[at:])
    for s in range(6):
        assert ends[s] == right[0][left[0][s]]
        assert records[s] == left[1][s] + right[1][left[0][s]] and lines[s] == left[2][s] + right[2][left[0][s]]
        cut = blocks.first_cut(data, s)
        assert (cut is not None) == bool(lines[s])
        if cut:
            assert blocks.block_function(data[:cut[0]])[2][s] == 1 == 1 + blocks.block_function(data[:cut[0] - 1])[2][s]
