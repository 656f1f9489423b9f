"""Spelling variants: words one edit apart, found by partition-and-enumerate signatures."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from drydock.llm.common import code_points, mixed, staged, unstaged

RUN = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ERROR_RATE = 199
LEAST_POINTS, LEAST_COUNT, RATIO = 6, 5, 5
#: Parts the dimensions are dealt to. At distance d a signature leaves out d of them:
#: 15 signatures for distance 2, and 6 for distance 1 at each of two lengths.
PARTS = 6
#: Asked of each join here, as both sides have a row per word or more. Spark sizes a table by its compressed files,
#: and does not count what an explode adds, so it would broadcast tables that the driver cannot hold.
MERGE = "merge"


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", error_rate: int = ERROR_RATE) -> DataFrame:
    """``word, n`` of all runs of letters of all texts, in lower case (A-Z only).

    One run in ``error_rate`` loses a letter: where the CRC-32 of id and run is
    divisible by it. Null texts have no runs; a null id counts as an empty one.
    Occurrences are added up inside each task before they are shuffled, so a
    very frequent word is a row per task.
    """
    run = F.explode(F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(RUN), F.lit(0))).alias("run")
    runs = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("doc_id"), run).select(
        "doc_id", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    hashed = runs.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shortened = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    return (hashed.select(F.when(F.col("h") % error_rate == 0, shortened).otherwise(F.col("run")).alias("word"))
            .groupBy("word").agg(F.count("*").alias("n")))


# -- signatures ---------------------------------------------------------------


def part_hashes(words: list[str], parts: int = PARTS) -> np.ndarray:
    """For each word and part a hash of the letters that part holds.

    A word's letters are a binary vector with a dimension for each letter and
    occurrence (``e``, the second ``e``, ...). The dimensions are dealt to the
    parts; a part's hash is the sum of its dimensions' hashes, so the order of
    the letters does not matter.
    """
    size = np.array([len(w) for w in words], dtype=np.int64)
    points = code_points("".join(words)).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    order = np.lexsort((points, owner))
    letter = points[order]
    new = np.ones(len(letter), dtype=bool)
    new[1:] = (letter[1:] != letter[:-1]) | (owner[1:] != owner[:-1])
    opened = np.flatnonzero(new)
    occurrence = np.arange(len(letter)) - np.repeat(opened, np.diff(np.append(opened, len(letter))))
    dimension = mixed((letter << 32 | occurrence).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros((len(words), parts), dtype=np.uint64)
    np.add.at(out, (owner, (letter + occurrence) % parts), dimension)
    return out


def signatures(words: list[str], parts: int = PARTS) -> np.ndarray:
    """The signatures of each word, one row per word.

    Replacing a letter keeps the length and changes at most two dimensions, so
    all but some two parts stay as they are: one signature for each two parts
    left out. Inserting or deleting one changes the length by one and a single
    dimension: one signature for each part left out, as the shorter and as the
    longer of the two words. Words one edit apart always share a signature.
    """
    each = part_hashes(words, parts)
    whole = each.sum(axis=1, dtype=np.uint64)
    size = np.array([len(w) for w in words], dtype=np.uint64)
    out = []
    for k, (a, b) in enumerate(combinations(range(parts), 2)):
        out.append(mixed(whole - each[:, a] - each[:, b] + mixed(size << np.uint64(16) | np.uint64(k))))
    for a in range(parts):
        for longer in (size, size + np.uint64(1)):
            out.append(mixed(whole - each[:, a] + mixed(longer << np.uint64(16) | np.uint64(1 << 15 | a))))
    return np.stack(out, axis=1).view(np.int64)


_SIGNED = "word string, n long, signature array<long>"


def _signer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = signatures(batch.column(0).to_pylist())
        offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.reshape(-1)))],
            names=["word", "n", "signature"])


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: each pair of words exactly one edit apart, once (word < other).

    The join is on signatures only; its condition lets through what is verified,
    so candidates are met inside the join and never written. Words of equal
    length that differ in one place agree before or after their middle, which
    is looked at first, as it costs least. Spark splits a signature that many
    words share, as the join is a merge join. A pair found by several signatures
    counts once.
    """
    half = F.floor(F.length("word") / 2).cast("int")
    signed = words.mapInArrow(_signer, _SIGNED).select(
        "word", "n", F.hash(F.col("word").substr(F.lit(1), half)).alias("head"),
        F.hash(F.col("word").substr(half + 1, F.length("word"))).alias("tail"), F.explode("signature").alias("signature"))
    a, b = signed.alias("a"), signed.alias("b").hint(MERGE)
    may = (F.col("a.head") == F.col("b.head")) | (F.col("a.tail") == F.col("b.tail")) | (
        F.length("a.word") != F.length("b.word"))
    one_edit = F.levenshtein("a.word", "b.word", 1) == 1
    return a.join(b, (F.col("a.signature") == F.col("b.signature")) & (F.col("a.word") < F.col("b.word")) & may & one_edit
                  ).select("a.word", "a.n", F.col("b.word").alias("other"), F.col("b.n").alias("other_n")).distinct()


# -- forms and roots ----------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: from each ``word`` with a ``form``, the last form that is reached.

    Every round jumps from a word's root to that word's own, so rounds grow with
    the logarithm of a chain; and chains are short, as every form is several
    times as frequent as its word. Rounds go on until nothing changes.
    """
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("at"), F.col("root").alias("to")).hint(MERGE)
        stepped = staged(now.join(onward, now["root"] == onward["at"], "left").select(
            "word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "roots")
        unstaged(now)
        now = stepped.drop("moved")
        if stepped.filter("moved").isEmpty():
            return now


def variants(counts: DataFrame, least_points: int = LEAST_POINTS, least_count: int = LEAST_COUNT,
             ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word long and frequent enough.

    ``counts`` has ``word, n``, a row per word. Two words are near if one
    inserted, deleted or replaced code point makes them equal. A word's form is
    its most frequent near word (the least of several), if it is at least
    ``ratio`` times as frequent. Other columns are left aside; rows without a
    word or count are no words, and an empty table gives an empty one.
    """
    words = staged(counts.select(F.col("word").cast("string"), F.col("n").cast("long")).filter(
        (F.length("word") >= least_points) & (F.col("n") >= least_count)), "words")
    pairs = near_words(words)
    both = pairs.select(F.explode(F.array(
        F.struct("word", "n", F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")).alias("near")),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"),
                 F.struct((-F.col("n")).alias("n"), F.col("word").alias("word")).alias("near")))).alias("p")).select("p.*")
    found = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("near")).select(
        F.col("word").alias("found"), "n_near", "near.word", (-F.col("near.n")).alias("near_n")).select(
        "found", "n_near", F.col("word").alias("near"), "near_n").hint(MERGE)
    is_form = F.col("near_n") >= ratio * F.col("n")
    formed = staged(words.join(found, words["word"] == found["found"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near")).alias("form"),
        F.when(is_form, F.col("near_n")).alias("form_n")), "formed")
    last = roots(formed.filter("form IS NOT NULL").select("word", "form")).select(
        F.col("word").alias("at"), "root").hint(MERGE)
    return formed.join(last, formed["word"] == last["at"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``variants`` of the words of all whole texts. Repeated rows count again; the order of rows,
    ties and other columns change nothing; a text is cut into words as a whole however long."""
    return variants(word_counts(docs, doc_id, text))


#: The query ``op13_spelling_variants`` for DuckDB: CRC-32 byte by byte, and words with one letter left out in place
#: of signatures.
SQL = """
WITH bits AS (
  SELECT i AS byte, list_reduce([CAST(i AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) AS crc
  FROM range(256) t(i)),
crc AS (SELECT list(crc ORDER BY byte) AS steps FROM bits),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT id, run, count(*) AS times FROM runs GROUP BY ALL),
bytes AS (
  SELECT *, list_prepend(CAST(4294967295 AS UBIGINT), flatten(list_transform(string_split(id || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS UBIGINT)]
                   ELSE [CAST(195 AS UBIGINT), CAST(unicode(c) - 64 AS UBIGINT)] END))) AS byte FROM counted),
hashed AS (
  SELECT run, times, xor(list_reduce(byte, lambda c, b: xor(c >> 8, steps[CAST(xor(c, b) & 255 AS INT) + 1])),
    CAST(4294967295 AS UBIGINT)) AS h FROM bytes, crc),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) ||
    substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, CAST(sum(times) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(times) >= 5),
gaps AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.rest = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.rest = w.word),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS place,
    count(*) OVER (PARTITION BY word) AS n_near FROM pairs),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 5 * w.n THEN r.other END AS form,
    CASE WHEN r.other_n >= 5 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1),
paths AS (
  WITH RECURSIVE step AS (
    SELECT word, word AS here, 0 AS depth FROM formed
    UNION ALL SELECT s.word, f.form, s.depth + 1 FROM step s JOIN formed f ON s.here = f.word WHERE f.form IS NOT NULL)
  SELECT word, arg_max(here, depth) AS root FROM step GROUP BY word)
SELECT f.word, f.form, p.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN paths p ON f.word = p.word"""
