"""Small tables with the awkward cases every operator must take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = ("the of and to in is that for it as was with be by on not he his but at are this have from or had an they "
         "which one you were all her she there would their we him been has when who will no more if out so").split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ed", "ing"]) for _ in range(n))


def awkward(seed=1):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    rng = random.Random(seed)
    base = prose(rng, 80)
    rows = [(k, prose(rng, rng.randint(3, 60)), "en", f"src{k % 3}", 1) for k in range(12)]
    rows += [(20, base, "en", "src0", 1), (21, base, "en", "src1", 1), (21, base, "en", "src1", 1),
             (22, base + " tail", None, None, None), (None, base, "en", None, 1), (None, None, None, None, None),
             (23, None, "de", "src2", None), (24, "", "en", "src2", 0), (25, "  \n\t", None, "", 1),
             (26, "1234 !!", "en", "src2", 1), (27, prose(rng, 5000), "en", "src0", 1), (28, "x" * 5000, None, "src0", 1),
             (29, "ñandú über façade — Привет 漢字 🎉", "es", "Ärger", 1), (20, "another text with the same id", "en", "src0", 1)]
    return rows


def frame(spark, rows=None, extra=()):
    """The rows as a table, with extra columns of clashing names."""
    df = spark.createDataFrame(awkward() if rows is None else rows, DOCS)
    for name in extra:
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df


CLASHES = ("size", "mix", "_mix", "shard", "slot", "key", "_key", "_row", "row", "kept", "_whole", "group", "item", "id",
           "_copy", "_place", "_piece", "matches", "label", "whole")
