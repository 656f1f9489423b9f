"""Lookup joins and membership tests.

None of them forces a broadcast: Spark broadcasts a side it knows (or, at run
time, finds) to be small, and otherwise shuffles, splitting partitions that a hot
key makes large. A caller who knows of a hot key that this cannot split may
spread the large side over ``salts`` copies of the small one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from drydock.config import UNKNOWN_DATASET, UNKNOWN_TABLE, Registry
from drydock.functions.patterns import first_word
from drydock.functions.text import contains_any, stem, upper_strip


def lookup(facts: DataFrame, dims: DataFrame, on: Sequence[str], how: str = "left",
           salts: int = 1, salt_by: Sequence[str] = ()) -> DataFrame:
    """Join each fact to the dimension row of its key (at most one per key).

    The salt of a fact is a hash of its ``salt_by`` columns (all columns if
    none are named), so a task which is run again deals its rows out alike.
    """
    if salts <= 1:
        return facts.join(dims, list(on), how)
    parts = list(salt_by) or [c for c, t in facts.dtypes if "map<" not in t]
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in parts]), F.lit(salts)).cast("int")
    copies = dims.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("_salt", spread).join(copies, [*on, "_salt"], how).drop("_salt")


def exclude(work: DataFrame, done: DataFrame, on: Sequence[str], salts: int = 1,
            salt_by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``work`` whose key is not in ``done``."""
    return lookup(work, done.select(*on).distinct(), on, "left_anti", salts, salt_by)


def include(work: DataFrame, done: DataFrame, on: Sequence[str], salts: int = 1,
            salt_by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``work`` whose key is in ``done``."""
    return lookup(work, done.select(*on).distinct(), on, "left_semi", salts, salt_by)


def join_descriptions(columns: DataFrame, dictionary: DataFrame, salts: int = 1) -> DataFrame:
    """Columns ``(table, column, ...)`` with their description, '' where none."""
    texts = dictionary.select("table", "variable", "description")
    keyed = columns.withColumn("variable", upper_strip(F.col("column")))
    return (lookup(keyed, texts, ["table", "variable"], "left", salts)
            .withColumn("description", F.coalesce("description", F.lit("")))
            .drop("variable"))


def described(columns: DataFrame, dictionary: DataFrame, salts: int = 1) -> DataFrame:
    """Columns which have a dictionary entry."""
    keyed = columns.withColumn("variable", upper_strip(F.col("column")))
    return include(keyed, dictionary, ["table", "variable"], salts).drop("variable")


def dictionary_coverage(columns: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Per table label of a dictionary ``table, entries, describing, found``: its entries, those which describe a
    column ``(table, column)``, and whether there is a table of that name at all. A label with ``describing`` 0 serves
    nothing, and asks for a ``table_map`` if ``found`` is false. Labels are in order."""
    keys = columns.select("table", upper_strip(F.col("column")).alias("variable")).distinct()
    met = lookup(dictionary.select("table", "variable"), keys.withColumn("_met", F.lit(1)), ["table", "variable"])
    labels = met.groupBy("table").agg(F.count("*").alias("entries"), F.count("_met").alias("describing"))
    tables = keys.select("table").distinct().withColumn("_found", F.lit(True))
    return lookup(labels, tables, ["table"]).select(
        "table", "entries", "describing", F.coalesce("_found", F.lit(False)).alias("found")).orderBy("table")


#: Up to so many datasets a registry is written into the plan, as a projection; a larger one is an automaton or a join.
DATASETS_IN_PLAN = 64


def _with_attributes(df: DataFrame, registry: Registry, dataset: str, attributes: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add to each row attributes of its dataset, ``{column: (attribute, default)}``."""
    if len(registry.datasets) <= DATASETS_IN_PLAN:
        for name, (attribute, default) in attributes.items():
            value = F.lit(default)
            for d in reversed(registry.datasets):
                value = F.when(F.col(dataset) == d.name, F.lit(getattr(d, attribute))).otherwise(value)
            df = df.withColumn(name, value)
        return df
    first = {d.name: d for d in reversed(registry.datasets)}
    rows = [(name, *[getattr(d, attribute) for attribute, _ in attributes.values()]) for name, d in first.items()]
    dims = df.sparkSession.createDataFrame(
        rows, ", ".join(f"{n} string" for n in ("_name", *[f"_{a}" for a in attributes])))
    joined = df.join(dims, F.col(dataset) == dims["_name"], "left")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in attributes]
    return joined.select(*kept, *[F.coalesce(F.col(f"_{name}"), F.lit(default)).alias(name)
                                  for name, (_, default) in attributes.items()])


_TABLE = {"dict_table": ("dict_table", UNKNOWN_TABLE)}
_TEXT = {"description": ("description", UNKNOWN_DATASET)}


def with_dictionary_table(df: DataFrame, registry: Registry, dataset: str = "dataset") -> DataFrame:
    """Add ``dict_table``, the dictionary table of each row's dataset."""
    return _with_attributes(df, registry, dataset, _TABLE)


def with_dataset_description(df: DataFrame, registry: Registry, dataset: str = "dataset") -> DataFrame:
    """Add ``description``, the registered text of each row's dataset."""
    return _with_attributes(df, registry, dataset, _TEXT)


def dataset_of(base, registry: Registry):
    """First registered dataset whose pattern occurs in an upper-cased stem."""
    label = F.lit(None).cast("string")
    for d in reversed(registry.datasets):
        label = F.when(contains_any(base, [d.archive_pattern]), F.lit(d.name)).otherwise(label)
    return label


def classify(files: DataFrame, registry: Registry, path: str = "path") -> DataFrame:
    """Files with ``dataset`` (null if unrecognised), its table and description.

    The first pattern in registry order wins. A short registry is a projection:
    no join, no shuffle, the stem taken once for all patterns. A long one is an
    automaton over the stems, which meets all patterns in one pass whatever
    their number, and a join with the registry's rows.
    """
    named = files.withColumn("_stem", F.upper(stem(F.col(path))))
    if len(registry.datasets) <= DATASETS_IN_PLAN:
        named = named.withColumn("dataset", dataset_of(F.col("_stem"), registry)).drop("_stem")
        return _with_attributes(named, registry, "dataset", _TABLE | _TEXT)
    spark = files.sparkSession
    found = named.withColumn("_first", first_word(spark, F.col("_stem"), [d.archive_pattern for d in registry]))
    dims = spark.createDataFrame([(k, d.name, d.dict_table, d.description) for k, d in enumerate(registry)],
                                 "_place int, _dataset string, _dict_table string, _description string")
    added = {"dataset": F.col("_dataset"), "dict_table": F.coalesce("_dict_table", F.lit(UNKNOWN_TABLE)),
             "description": F.coalesce("_description", F.lit(UNKNOWN_DATASET))}
    return found.join(dims, found["_first"] == dims["_place"], "left").select(
        *[F.col(f"`{c}`") for c in files.columns if c not in added], *[c.alias(n) for n, c in added.items()])
