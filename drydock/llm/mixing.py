"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from drydock.llm.common import fresh, numbered, staged, word_count

MOST_REPEATS = 3


def hashed_draw(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the parts alone (48 bits of an MD5)."""
    known = [F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *known))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), share: float = 1.0,
                   most: int = MOST_REPEATS) -> DataFrame:
    """Token targets of sources ``(source, source_size)``: plus ``weight, target``.

    Sources in code-point order (null last) weigh ``weights``, repeating. They
    share ``share`` of all sizes by weight; a target stops at ``most`` times its
    source's size, and what is over goes to the others by weight until none is
    above. That is one water level: target = least(most * size, level * weight).
    Each pass finds, in one aggregate, what the sources at their stop hold, and
    raises the level; it ends when no further source stops. Where all sizes are
    0, so are all targets.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], "_rank")
    ranked = staged(ranked.select(
        "source", "source_size", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")).alias("weight")),
        "sources")
    whole = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"),
                       F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).first()
    wanted = share * whole["size"]
    stopped, free = 0, whole["weight"]
    level = wanted / free if free else 0.0
    stops = F.col("source_size") * most <= F.lit(level) * F.col("weight")
    while free:
        stops = F.col("source_size") * most <= F.lit(level) * F.col("weight")
        now = ranked.agg(
            F.coalesce(F.sum(F.when(stops, F.col("source_size"))), F.lit(0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0)).alias("free")).first()
        if (now["stopped"], now["free"]) == (stopped, free) or not now["free"]:
            break
        stopped, free = now["stopped"], now["free"]
        level = (wanted - most * stopped) / free
    target = F.when(stops, (F.col("source_size") * most).cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.withColumn("target", target)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = (1, 2, 3), share: float = 1.0, most: int = MOST_REPEATS,
        seed: str = "mix") -> DataFrame:
    """Every row with ``size, source_size, target, copies, taken`` (a struct column ``mix``).

    A source's rate is its target by its size. A document is emitted floor(rate)
    times, and once more when a number hashed from seed, id and text falls below
    the fraction. The same rows give the same mix in any order and on any rerun.

    A null text has size 0; a null source is a source of its own, the last; a
    source of size 0 has rate 0. Rows which repeat id and text share one draw.
    Columns of other names are kept; the result is added as one struct under a
    name the caller's columns do not use (``mix``, else with underscores).
    """
    name = "mix" if "mix" not in {c.lower() for c in docs.columns} else fresh(docs, "mix")
    key, size = fresh(docs, "source_key"), word_count(F.col(text))
    totals = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    targets = source_targets(staged(totals, "totals"), weights, share, most)
    joined = docs.join(targets.select(F.struct("source", "source_size", "target").alias(key)),
                       F.col(source).eqNullSafe(F.col(f"{key}.source")))
    total, target = F.col(f"{key}.source_size"), F.col(f"{key}.target")
    rate = F.when(total > 0, F.least(target / total, F.lit(float(most)))).otherwise(F.lit(0.0))
    extra = hashed_draw(seed, F.col(doc_id), F.md5(F.col(text))) < rate - F.floor(rate)
    copies = (F.floor(rate) + F.when(extra, 1).otherwise(0)).cast("long")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(
        size.alias("size"), total.cast("long").alias("source_size"), target.alias("target"),
        copies.alias("copies"), (size * copies).alias("taken")).alias(name))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: the columns of ``docs``, each row as often as the mix takes it."""
    mixed = mix(docs, **options)
    name = mixed.columns[-1]
    copy = fresh(mixed, "copy")
    return (mixed.filter(F.col(f"{name}.copies") > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(f"{name}.copies").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST(CAST(('0x' || substr(md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), 'null'),
              coalesce(md5(text), 'null'))), 1, 12)) AS BIGINT) AS DOUBLE) / 281474976710656.0 AS draw
  FROM documents),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, coalesce(sum(source_size) OVER w, 0) AS stopped, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS free,
         sum(source_size) OVER () AS total, row_number() OVER (ORDER BY source_size * 3.0 / weight, source NULLS LAST) AS spot
  FROM ranked WINDOW w AS (ORDER BY source_size * 3.0 / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, CAST(total - 3 * stopped AS DOUBLE) / CAST(free AS DOUBLE) AS here FROM ordered),
level AS (
  SELECT arg_min(here, spot) FILTER (source_size * 3 > here * weight) AS lifted FROM levels),
targets AS (
  SELECT source, source_size,
         CASE WHEN lifted IS NULL OR source_size * 3 <= lifted * weight THEN CAST(source_size * 3 AS DOUBLE)
              ELSE lifted * weight END AS target
  FROM ranked, level),
rated AS (
  SELECT doc_id, size, source_size, target, draw,
         CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0.0 END AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       size * CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM rated
"""
