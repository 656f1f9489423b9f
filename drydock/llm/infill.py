"""Fill-in-the-middle: a document's middle moved to its end, cut by an index of its multibyte characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

PLAIN, PSM, SPM = "plain", "psm", "spm"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100 documents, those from here on stay as they are
SPM_BELOW = 20  # of 100 documents that are cut, those below here put the suffix first
#: Bytes that are looked at together: many short texts, or a part of a long one.
BLOCK_BYTES = 4 << 20
CUTS = T.StructType([T.StructField(name, T.LongType()) for name in (
    "n", "prefix_bytes", "middle_bytes", "prefix_chars", "middle_chars")])


class ExceptionIndex:
    """Where code points and bytes part: the multibyte characters only.

    For each of them it records the byte it starts at and how many bytes more
    than one it takes. Between two of them a code point is a byte, so a cut is
    moved by the excess of the characters before it, which one binary search finds.
    """

    def __init__(self, data: np.ndarray) -> None:
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate(([0], np.cumsum(extra)))

    def to_points(self, cut: np.ndarray) -> np.ndarray:
        """Code points before each byte; the bytes start a character."""
        return cut - self.before[np.searchsorted(self.at, cut)]

    def to_bytes(self, cut: np.ndarray) -> np.ndarray:
        """Bytes before each code point."""
        return cut + self.before[np.searchsorted(self.at - self.before[:-1], cut)]


def unit_starts(data: np.ndarray, after_letter: bool = False) -> np.ndarray:
    """Bytes at which a unit starts: a run of the letters A-Z and a-z, or any other character.

    ``after_letter`` tells that a letter goes before the first byte.
    """
    lowered = data | 0x20
    letter = (lowered >= 0x61) & (lowered <= 0x7A)
    inner = letter.copy()
    inner[1:] &= letter[:-1]
    inner[:1] &= after_letter
    return np.flatnonzero(~inner & ((data & 0xC0) != 0x80))


def _chosen(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = first % (n + 1), second % (n + 1)
    return np.minimum(a, b), np.maximum(a, b)


def cut_short(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
    """The fields of ``CUTS`` for the texts ``data[offsets[k]:offsets[k + 1]]``."""
    begin, end = offsets[:-1], offsets[1:]
    starts = np.union1d(unit_starts(data), begin[begin < end])  # a text starts a unit, whatever goes before
    low = np.searchsorted(starts, begin)
    n = np.searchsorted(starts, end) - low
    starts = np.append(starts, len(data))
    index = ExceptionIndex(data)
    cuts = [np.where(unit < n, starts[np.minimum(low + unit, len(starts) - 1)], end)
            for unit in _chosen(first, second, n)]
    points = [index.to_points(x) for x in (begin, *cuts)]
    return [n, cuts[0] - begin, cuts[1] - cuts[0], points[1] - points[0], points[2] - points[1]]


def _blocks(data: np.ndarray, block: int) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of whole characters."""
    at = 0
    while at < len(data):
        end = min(at + max(block, 4), len(data))
        while end < len(data) and (data[end] & 0xC0) == 0x80:
            end -= 1
        yield at, data[at:end]
        at = end


def cut_long(data: np.ndarray, first: int, second: int, block: int) -> list[np.ndarray]:
    """``cut_short`` for one long text, which is gone through twice block by block:
    to count its units, and to find the cuts."""
    def found() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for at, part in _blocks(data, block):
            yield at, part, unit_starts(part, at > 0 and 0x61 <= data[at - 1] | 0x20 <= 0x7A)

    total = sum(len(starts) for _, _, starts in found())
    cuts = [int(x[0]) for x in _chosen(np.array([first]), np.array([second]), np.array([total]))]
    bytes_at, points_at, units, points = [len(data)] * 2, [0, 0], 0, 0
    for at, part, starts in found():
        index = ExceptionIndex(part)
        for k, cut in enumerate(cuts):
            if units <= cut < units + len(starts):
                here = starts[cut - units:cut - units + 1]
                bytes_at[k], points_at[k] = at + int(here[0]), points + int(index.to_points(here)[0])
        units += len(starts)
        points += len(part) - int(index.before[-1])
    points_at = [points if cut == total else p for cut, p in zip(cuts, points_at, strict=True)]
    return [np.array([x]) for x in (total, bytes_at[0], bytes_at[1] - bytes_at[0], points_at[0],
                                    points_at[1] - points_at[0])]


def cut_texts(texts: pa.Array, first: np.ndarray, second: np.ndarray, block: int = BLOCK_BYTES) -> pa.StructArray:
    """``CUTS`` of each text (null: empty), read from the UTF-8 bytes Arrow holds, which are not copied."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    parts, row = [], 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + block, "right")) - 1)
        own = data[offsets[row]:offsets[end]]
        if len(own) > block:
            parts.append(cut_long(own, int(first[row]), int(second[row]), block))
        else:
            parts.append(cut_short(own, offsets[row:end + 1] - offsets[row], first[row:end], second[row:end]))
        row = end
    columns = [np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True)] or [np.zeros(0, np.int64)] * 5
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=CUTS.names)


@arrow_udf(CUTS)
def _cuts(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, first, second in batches:
        yield cut_texts(texts, first.to_numpy(), second.to_numpy())


def rearranged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every whole text.

    A unit is a run of the letters A-Z and a-z or any other single code point.
    Two cuts and the form are drawn from SHA-256 of ``1:`` and the id, so they
    depend on nothing else. ``output`` is the text with the three parts behind
    their marks, prefix first (``psm``) or suffix first (``spm``), or the text
    itself (``plain``): where the draw says so, where it is empty and where it
    holds a mark. ``restored`` undoes it.

    Null texts are empty; a null id counts as an empty one. Every row is cut for
    itself: repeated rows and ids repeat. Other columns are left aside,
    whatever their names; an empty table gives an empty one. A long text is cut
    in blocks, so beyond the text itself memory does not grow with it.

    One pass and no shuffle; only text and draws go to Python, only positions
    come back, and the parts are put together by Spark, byte by byte as they were.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                      F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = own.withColumn("digest", digest).select("doc_id", "text", *[
        F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)])
    cut = drawn.withColumn("cut", _cuts("text", "h1", "h2"))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains("text", F.lit(mark))
    form = (F.when((F.col("text") == "") | marked | (F.col("h3") % 100 >= PLAIN_FROM), F.lit(PLAIN))
            .when(F.col("h4") % 100 < SPM_BELOW, F.lit(SPM)).otherwise(F.lit(PSM)))
    whole, p, m = F.col("text").cast("binary"), F.col("cut.prefix_bytes").cast("int"), F.col("cut.middle_bytes").cast("int")
    prefix, middle = whole.substr(F.lit(1), p), whole.substr(p + 1, m)
    suffix = whole.substr(p + m + 1, F.octet_length("text"))

    def joined(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(x).cast("binary") if isinstance(x, str) else x for x in parts]).cast("string")

    moved = F.when(F.col("form") == PSM, joined(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)).when(
        F.col("form") == SPM, joined(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)).otherwise(F.col("text"))
    is_cut = F.col("form") != PLAIN
    return cut.withColumn("form", form).select(
        "doc_id", F.col("cut.n").alias("n"), "form", F.when(is_cut, F.col("cut.prefix_chars")).alias("prefix_chars"),
        F.when(is_cut, F.col("cut.middle_chars")).alias("middle_chars"), moved.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``rearranged`` was given, from its output and form alone.

    A cut text holds no mark of its own, and no mark can arise where parts
    meet, as each begins with its only ``<``: the marks are where it splits.
    """
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return F.when(form == PLAIN, output).when(form == PSM, F.concat(part[1], part[3], part[2])).otherwise(
        F.concat(part[2], part[3], part[1]))


#: The query ``op12_fill_middle`` for DuckDB.
SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
units AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS unit,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM drawn),
cuts AS (
  SELECT *, len(unit) AS n, least(h1 % (len(unit) + 1), h2 % (len(unit) + 1)) AS a,
         greatest(h1 % (len(unit) + 1), h2 % (len(unit) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (
  SELECT *, coalesce(array_to_string(unit[1:a], ''), '') AS p, coalesce(array_to_string(unit[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(unit[b + 1:n], ''), '') AS s FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""
