"""Deliveries: states join, publishing adds, and only what widened is written again."""

import itertools
import os
import random

import pytest
from conftest import zip_bytes
from pyspark.sql import functions as F

from drydock.config import ColumnRoles, Dataset, Provenance, Registry
from drydock.operators.profile import profile_all
from drydock.operators.states import STATE_SCHEMA, column_states, joined_states
from drydock.plans.ingest import ingest, typed_table
from drydock.session import child_names
from drydock.sinks import versions
from drydock.sinks.versions import read_manifest
from drydock.sources.archives import expand_archives
from drydock.sources.listing import scan_published
from drydock.streaming import deliveries
from drydock.streaming.arrivals import notice_archives
from drydock.streaming.deliveries import published_deliveries
from drydock.streaming.incremental import current_records, incremental_ingest, landed, landed_profiles

REGISTRY = Registry((Dataset("things", "CSV_THINGS", "THINGS", "All things"), Dataset("rest", "CSV_REST", "REST", "The rest")))
ROLES = ColumnRoles(("KEY",), ("SEEN", "MADE"))


class Zone:
    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, path, 0
        (path / "raw").mkdir()

    def deliver(self, name, text, **options):
        self.n += 1
        (self.path / "raw" / f"{self.n}_{name}.zip").write_bytes(zip_bytes({"a.csv": text}))
        self.run(**options)

    def run(self, **options):
        incremental_ingest(self.spark, str(self.path / "raw"), str(self.path / "out"), str(self.path / "seen"), REGISTRY,
                           publish_to=str(self.path / "published"), roles=ROLES, **options).awaitTermination()

    def table(self, name="things"):
        return scan_published(self.spark, str(self.path / "published"), name)

    def files(self, delivery=None, name="things"):
        found = published_deliveries(self.spark, str(self.path / "published"), name).collect()
        return sorted(r["file"] for r in found if delivery in (None, r["delivery"]))

    def told(self):
        found = landed(self.spark, str(self.path / "out"), "published").orderBy("batch").collect()
        return [(r["status"], r["message"], r["lost"]) for r in found]

    def whole(self, name="things"):
        """One ingest of all archives."""
        out = self.path / f"whole-{self.n}"
        ingest(self.spark, str(self.path / "raw"), str(out), REGISTRY, roles=ROLES, collisions="union")
        return self.spark.read.parquet(f"{out}/{name}.parquet")


@pytest.fixture
def zone(spark, tmp_path):
    return Zone(spark, tmp_path)


def same(a, b):
    assert [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_nothing_widens_and_files_stay(zone):
    zone.deliver("CSV_THINGS", "key,n,name\n1,5,a\n2,6,b\n")
    first = zone.files()
    zone.deliver("CSV_THINGS", "key,n,name\n3,7,c\nx,,\n")
    zone.deliver("CSV_THINGS", "n,other\n8,True\n")
    assert zone.files(0) == first and len(zone.files()) > len(first)
    same(zone.table(), zone.whole())
    same(zone.spark.read.parquet(str(zone.path / "published" / "things.parquet")), zone.whole())  # without the manifest
    assert zone.told() == [("success", "2 rows, 3 columns, 0 descriptions", {"KEY": 0}),
                           ("success", "4 rows, 3 columns, 0 descriptions", {"KEY": 1}),
                           ("success", "5 rows, 4 columns, 0 descriptions", {})]


def test_types_widen(zone):
    old, new = "007,-0,9007199254740993,4,1,x", "1.5,text,18446744073709551615,True,,y"
    zone.deliver("CSV_THINGS", f"key,a,b,c,d,e,f\n1,{old}\n2,-0,1,2,3,,z\n")
    zone.deliver("CSV_THINGS", "key,e,m\n3,5,007\n")
    first, second = zone.files(0), zone.files(1)
    zone.deliver("CSV_THINGS", f"key,a,b,c,d,e,f\n4,{new}\n")
    same(zone.table(), zone.whole())
    assert zone.files(1) == second and not set(zone.files(0)) & set(first)  # the second holds no column that widened


def test_a_cast_serves_where_it_gives_what_the_text_gives(zone, monkeypatch):
    zone.deliver("CSV_THINGS", "key,n\n1,007\n2,9007199254740993\n")
    written = []
    monkeypatch.setattr(deliveries, "_written", lambda *a, f=deliveries._written: written.append(a[2]) or f(*a))
    zone.deliver("CSV_THINGS", "key,n\n3,1.5\n")
    assert written == [1]
    same(zone.table(), zone.whole())


def test_a_column_without_values_gets_its_type_later(zone):
    zone.deliver("CSV_THINGS", "key,n\n1,\n2,NA\n")
    first = zone.files()
    assert zone.table().schema["N"].dataType.simpleString() == "double"
    zone.deliver("CSV_THINGS", "key,n\n3,text\n")
    assert zone.files(0) == first
    same(zone.table(), zone.whole())


def test_no_records_and_clashing_names(zone):
    zone.deliver("CSV_THINGS", "key,n\n")
    same(zone.table(), zone.whole())
    zone.deliver("CSV_THINGS", "key,n\n1,2\n")
    before = zone.table().collect()
    assert [tuple(r) for r in before] == [(1, 2)]
    zone.deliver("CSV_THINGS", "key,N\n1,2\n")
    assert zone.told()[-1][0] == "error" and "once upper-cased" in zone.told()[-1][1]
    assert zone.table().collect() == before


def test_random_deliveries_equal_one_ingest(zone):
    rng = random.Random(8)
    values = ["1", "22", "-3", "1.5", "x", "", "NA", "True", "false", "007", "18446744073709551615", "20240131", "1e3"]
    for k in range(4):
        names = rng.sample(["key", "a", "b", " seen ", "c", "made"], rng.randint(2, 5))
        some = rng.sample(values, 3)
        rows = [",".join(rng.choice(some) for _ in names) for _ in range(rng.randint(0, 6))]
        zone.deliver(rng.choice(["CSV_THINGS", "CSV_THINGS", "CSV_REST"]), "\n".join([",".join(names), *rows]) + "\n")
    for name in ("things", "rest"):
        if (zone.path / "published" / f"{name}.parquet").exists():
            same(zone.table(name), zone.whole(name))


def test_a_delivery_that_comes_again_replaces_itself(zone):
    zone.deliver("CSV_THINGS", "key,n\n1,2\n")
    spark, out = zone.spark, str(zone.path / "out")
    states = landed(spark, out, "states")
    records = lambda n: landed(spark, out, "records").filter(F.col("batch") == n).drop("batch")
    deliveries.publish_delivery(spark, records, states, str(zone.path / "published"), REGISTRY.get("things"), 0, roles=ROLES)
    assert zone.table().count() == 1 and read_manifest(spark, str(zone.path / "published/things.parquet")).version == 2
    assert len([n for n in child_names(spark, str(zone.path / "published/things.parquet")) if n.endswith(".parquet")]) == 1


@pytest.mark.parametrize("step", ["write_manifest", "write_schema_file"])
def test_a_writer_that_stops_leaves_a_whole_version(zone, monkeypatch, step):
    zone.deliver("CSV_THINGS", "key,n\n1,2\n")

    def stop(*_):
        raise OSError("the power went")

    monkeypatch.setattr(deliveries, step, stop)
    zone.deliver("CSV_THINGS", "key,n\n2,x\n")
    monkeypatch.undo()
    assert zone.told()[-1][0] == "error"
    found = sorted(map(tuple, zone.table().collect()))
    assert found == ([(1, 2)] if step == "write_manifest" else [(1, "2"), (2, "x")])
    zone.deliver("CSV_THINGS", "key,n\n3,y\n")  # the next one sweeps up; its state knows both
    left = [n for n in child_names(zone.spark, str(zone.path / "published/things.parquet")) if n.endswith(".parquet")]
    assert sorted(left) == zone.files()
    same(zone.table(), zone.whole())


def test_two_writers_cannot_make_one_version(spark, tmp_path):
    schema = spark.range(1).schema
    folder = str(tmp_path / "t.parquet")
    versions.write_manifest(spark, folder, versions.Manifest(1, schema, ()))
    with pytest.raises(OSError, match="taken"):
        versions.write_manifest(spark, folder, versions.Manifest(1, schema, ()))
    assert read_manifest(spark, folder).version == 1
    assert versions.scan_versioned(spark, folder, read_manifest(spark, folder)).count() == 0


def test_states_join_in_any_order(spark, archives):
    found = {"a": {"x.csv": "key,seen\n1,01/31/2024 00:00:00\n"}, "b": {"x.csv": "seen,key\n20240203,2\n"},
             "c": {"x.csv": "key,n\n3,True\n4,\n"}, "d": {"x.csv": "n\n"}}
    rows = expand_archives(archives(found)).withColumn("dataset", F.lit("t"))
    apart = [column_states(rows.filter(F.col("path") == p), ROLES) for p in found]
    whole = joined_states(column_states(rows, ROLES)).drop("first").collect()
    for order in itertools.islice(itertools.permutations(range(4)), 0, 24, 7):
        states = spark.createDataFrame([], STATE_SCHEMA)
        for k in order:
            states = states.unionByName(apart[k])
        assert sorted(map(repr, joined_states(states).drop("first").collect())) == sorted(map(repr, whole))
    types = {r["column"]: r["type"] for r in whole}
    assert types == {c: t for c, t in typed_table(rows.drop("dataset"), ColumnRoles((), ())).toDF(
        *[c.lower() for c in typed_table(rows.drop("dataset"), ColumnRoles((), ())).columns]).dtypes}


def test_profiles_from_states_equal_those_from_the_data(zone):
    zone.deliver("CSV_THINGS", "key,made,seen\n1,20240131,\n2,20230101,\n")
    zone.deliver("CSV_THINGS", "key,made\n3,20250101\n4,99991231\n")
    zone.deliver("CSV_REST", "seen,n\n01/31/2024 00:00:00,5\n2024-02-03,6\nno date,7\n")
    got = landed_profiles(zone.spark, str(zone.path / "out"), REGISTRY, ROLES, str(zone.path / "published"))
    want = profile_all({n: zone.table(n) for n in ("things", "rest")}, REGISTRY, ROLES.date_columns)
    same(got, want)


# -- archives that come again ------------------------------------------------------


def replace(zone, n, text, name="CSV_THINGS"):
    """Another archive under an old name, a minute younger each time."""
    place = zone.path / "raw" / f"{n}_{name}.zip"
    when = place.stat().st_mtime + 60
    place.write_bytes(zip_bytes({"a.csv": text}) if isinstance(text, str) else text)
    os.utime(place, (when, when))


def statuses(zone):
    found = landed(zone.spark, str(zone.path / "out")).orderBy("batch").collect()
    return [(r["batch"], r["path"].rsplit("/", 1)[-1][0], r["status"]) for r in found]


def test_a_replaced_archive_takes_the_place_of_its_records(zone):
    zone.deliver("CSV_THINGS", "key,n,gone\n1,5,a\n2,x,b\n")
    zone.deliver("CSV_THINGS", "key,n\n3,7\n")
    second = zone.files(1)
    replace(zone, 1, "key,n,new\n1,6,c\n")
    zone.run()
    same(zone.table(), zone.whole())
    assert zone.table().schema["N"].dataType.simpleString() == "bigint" and zone.files(0) == []
    assert not set(zone.files(1)) & set(second)  # n was text while the first one said so
    assert statuses(zone) == [(0, "1", "success"), (1, "2", "success"), (2, "1", "success")]
    current = current_records(zone.spark, str(zone.path / "out")).filter("row_no > 0")
    assert sorted(r["fields"][0] for r in current.collect()) == ["1", "3"]
    got = landed_profiles(zone.spark, str(zone.path / "out"), REGISTRY, ROLES, str(zone.path / "published"))
    same(got, profile_all({"things": zone.table()}, REGISTRY, ROLES.date_columns))


def test_replacing_leaves_other_deliveries_and_datasets_alone(zone):
    (zone.path / "raw" / "1_CSV_THINGS.zip").write_bytes(zip_bytes({"a.csv": "key,n\n1,5\n"}))
    (zone.path / "raw" / "8_CSV_THINGS.zip").write_bytes(zip_bytes({"a.csv": "key,n\n8,5\n"}))
    (zone.path / "raw" / "9_CSV_REST.zip").write_bytes(zip_bytes({"a.csv": "n\n9\n"}))
    zone.run()
    zone.n = 1
    zone.deliver("CSV_THINGS", "key,n\n2,6\n")
    zone.deliver("CSV_REST", "n\n3\n")
    things, rest = zone.files(1), zone.files(name="rest")
    replace(zone, 8, "key,n\n7,5\n7,8\n")
    zone.run()
    assert zone.files(1) == things and zone.files(name="rest") == rest
    assert sorted(map(tuple, zone.table().collect())) == [(1, 5), (2, 6), (7, 5), (7, 8)]
    zone.deliver("CSV_REST", "n\n4\n")  # its first delivery shares a micro-batch with what was replaced
    assert zone.files(0, "rest") == [f for f in rest if f.startswith("d000000")]
    same(zone.table("rest"), zone.whole("rest"))


def test_touched_and_broken_archives_change_nothing(zone):
    zone.deliver("CSV_THINGS", "key,n\n1,5\n")
    before = zone.files()
    replace(zone, 1, (zone.path / "raw" / "1_CSV_THINGS.zip").read_bytes())
    zone.run()
    replace(zone, 1, b"broken")
    zone.run()
    assert zone.files() == before and [tuple(r) for r in zone.table().collect()] == [(1, 5)]
    replace(zone, 1, "key,n\n1,5\n2,5\n")
    zone.run()
    zone.run()
    assert [s for _, _, s in statuses(zone)] == ["success", "skipped", "error", "success"]
    same(zone.table(), zone.whole())


def test_a_replacement_that_could_not_be_published_is_made_good(zone, monkeypatch):
    zone.deliver("CSV_THINGS", "key,n\n1,5\n")
    zone.deliver("CSV_THINGS", "key,n\n2,6\n")

    def stop(*_):
        raise OSError("the power went")

    monkeypatch.setattr(deliveries, "write_manifest", stop)
    replace(zone, 1, "key,n\n1,7\n")
    zone.run()
    monkeypatch.undo()
    assert sorted(map(tuple, zone.table().collect())) == [(1, 5), (2, 6)]
    zone.deliver("CSV_THINGS", "key,n\n3,8\n")
    same(zone.table(), zone.whole())


def test_two_versions_noticed_before_they_are_read(zone):
    raw, notices = str(zone.path / "raw"), str(zone.path / "out" / "notices")
    (zone.path / "raw" / "1_CSV_THINGS.zip").write_bytes(zip_bytes({"a.csv": "key,n\n1,5\n"}))
    notice_archives(zone.spark, raw, notices, 10)
    replace(zone, 1, "key,n\n1,7\n")
    zone.run()
    assert statuses(zone) == [(0, "1", "success"), (1, "1", "skipped")]
    same(zone.table(), zone.whole())


def test_notices_come_in_files_of_bounded_size(zone):
    raw, notices = str(zone.path / "raw"), str(zone.path / "out" / "notices")
    notice_archives(zone.spark, raw, notices, 2)
    assert child_names(zone.spark, notices) == []
    for k in range(7):
        (zone.path / "raw" / f"{k}_CSV_THINGS.zip").write_bytes(zip_bytes({"a.csv": f"key\n{k}\n"}))
        os.utime(zone.path / "raw" / f"{k}_CSV_THINGS.zip", (10**9 * (k % 2 + 1),) * 2)  # old ones among new ones
    notice_archives(zone.spark, raw, notices, 2)
    notice_archives(zone.spark, raw, notices, 2)
    sizes = zone.spark.read.parquet(notices).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) <= 2 and sum(r["count"] for r in sizes) == 7
    zone.run(files_per_batch=2)
    (zone.path / "raw" / "7_CSV_THINGS.zip").write_bytes(zip_bytes({"a.csv": "key\n7\n"}))
    os.utime(zone.path / "raw" / "7_CSV_THINGS.zip", (10**8, 10**8))  # years older than all that has been read
    zone.run()
    assert sorted(r["KEY"] for r in zone.table().collect()) == list(range(8))


def test_outcomes_of_before_digests_were_kept(zone):
    """Archives read without a digest are read once more, and replace themselves."""
    zone.deliver("CSV_THINGS", "key,n\n1,5\n")
    place = str(zone.path / "out" / "outcomes" / "batch=0")
    old = zone.spark.createDataFrame(zone.spark.read.parquet(place).drop("digest").collect(),
                                     zone.spark.read.parquet(place).drop("digest").schema)
    old.write.mode("overwrite").parquet(place)
    replace(zone, 1, (zone.path / "raw" / "1_CSV_THINGS.zip").read_bytes())
    zone.run()
    same(zone.table(), zone.whole())
    assert zone.files(0) == []
