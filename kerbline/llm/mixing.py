"""Mixing sources to target weights: capped water-filling, seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import staged, word_count

_SLICES = 4096  # of a source's seeded order; hex digits of the hash name the slice


def water_fill(sources: DataFrame, epochs: int = 3) -> DataFrame:
    """Targets for ``sources`` (key, size, weight): adds ``target`` double.

    All sizes together are shared out by weight. A source whose share exceeds
    ``epochs`` times its size is clamped there, and what it cannot take is shared among
    the others by weight, until none is above. Each round is one aggregate that
    returns one row; rounds end when no further source is clamped.
    """
    full = F.col("size") * epochs
    total = sources.agg(F.sum("size")).first()[0] or 0
    clamped = -1
    level: Column = F.lit(0.0)
    ceiling = F.lit(False)
    while True:
        left, weights, n = sources.agg(
            F.lit(total) - F.coalesce(F.sum(F.when(ceiling, full)), F.lit(0)),
            F.coalesce(F.sum(F.when(~ceiling, F.col("weight"))), F.lit(0)),
            F.count(F.when(ceiling, 1)),
        ).first()
        if not weights or n == clamped:
            break
        clamped = n
        level = F.lit(float(left)) * F.col("weight") / F.lit(float(weights))
        ceiling = level > full
    return sources.withColumn("target", F.when(ceiling, full.cast("double")).otherwise(level))


def mix_sources(
    docs: DataFrame, *, epochs: int = 3, weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix-1",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """How often each document is taken so that sources meet their target weights.

    Sources in code point order (null last, a source of its own) get ``weights`` in turn;
    :func:`water_fill` makes targets of them. A source's documents are taken as many
    whole times as its target allows; the rest of the target is taken in the order of a
    seeded hash of doc_id, and the document at the end of it only in part. So taken
    words meet the target to half a word, and no document exceeds ``epochs`` times.

    Returns doc_id, source, size, source_size, target, whole (int), part (words of the
    fractional repetition), taken, and keeps repeated rows. Null texts and texts without
    a word have size 0 and are taken 0 words; an empty table gives an empty result;
    of further columns of ``docs`` only ``carry`` are read, and returned. Rows with equal
    doc_id order by size, then by these. Rows without a doc_id are seeded by their text, and
    rows equal in all that is read here are counted before they are ordered, and listed one
    by one at the end, so that neither many null ids nor many copies meet in one window.
    """
    name = F.coalesce(
        F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.md5(F.coalesce("text", F.lit(""))))
    )
    seeded = F.md5(F.concat(F.lit(seed + ":"), name))
    rows = (
        docs.select(
            "doc_id",
            "source",
            # null and "" are two sources
            F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("key"),
            word_count("text").alias("size"),
            seeded.alias("h"),
            *carry,
        )
        .groupBy("doc_id", "source", "key", "size", "h", *carry)
        .agg(F.count("*").alias("copies"))
        .withColumn("slice", F.conv(F.substring("h", 1, 3), 16, 10).cast("int"))
    )
    rows = staged(rows, "mix-rows")
    words = F.col("size") * F.col("copies")
    slices = rows.groupBy("key", "source", "slice").agg(F.sum(words).alias("slice_size"))
    slices = staged(slices, "mix-slices")
    # one row per source
    sources = slices.groupBy("key", "source").agg(F.sum("slice_size").alias("size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    sources = sources.withColumn("weight", F.array(*map(F.lit, weights))[turn])
    sources = water_fill(staged(sources, "mix-sources"), epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = (
        sources.select("key", F.col("size").alias("source_size"), "target")
        .withColumn("whole", whole.cast("int"))
        .withColumn("rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5))
    )
    ahead = W.partitionBy("key").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    plan = (
        slices.withColumn("before", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0)))
        .select("key", "slice", "before")
        .join(sources, "key")
    )
    inside = (
        W.partitionBy("key", "slice")
        .orderBy("h", F.col("doc_id").asc_nulls_last(), "size", *carry)
        .rowsBetween(W.unboundedPreceding, -1)
    )
    room = F.col("rest") - F.col("before") - F.col("inside") - F.col("copy") * F.col("size")
    return (
        rows.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0)))
        .join(plan, ["key", "slice"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), room)).cast("long"))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "whole",
            "part",
            (F.col("whole") * F.col("size") + F.col("part")).alias("taken"),
            *carry,
        )
    )


OP5_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^ \\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    md5(concat('mix-1:', coalesce(CAST(doc_id AS VARCHAR), concat('-', md5(coalesce(text, '')))))) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM d GROUP BY source),
t AS (SELECT CAST(sum(source_size) AS BIGINT) AS total FROM s),
-- sources fill up in the order of the level at which they are full
f AS (
  SELECT *, 3.0 * source_size / weight AS full_at,
    total - coalesce(sum(3 * source_size) OVER w, 0) AS left_over,
    sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM s, t
  WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stop AS (
  SELECT left_over, weights FROM f
  WHERE CAST(left_over AS DOUBLE) <= full_at * CAST(weights AS DOUBLE)
  ORDER BY full_at, source NULLS LAST LIMIT 1),
g AS (
  SELECT s.source, s.source_size,
    CASE WHEN stop.weights IS NULL
        OR CAST(stop.left_over AS DOUBLE) * s.weight / CAST(stop.weights AS DOUBLE) > 3 * s.source_size
      THEN CAST(3 * s.source_size AS DOUBLE)
      ELSE CAST(stop.left_over AS DOUBLE) * s.weight / CAST(stop.weights AS DOUBLE) END AS target
  FROM s LEFT JOIN stop ON true),
k AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM g),
o AS (
  SELECT d.doc_id, d.size, k.source_size, k.target, k.whole,
    floor(k.target - k.whole * k.source_size + 0.5) AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id NULLS LAST, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside
  FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + greatest(0, least(size, rest - inside)) AS BIGINT) AS taken
FROM o
"""
