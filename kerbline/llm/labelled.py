"""Which rows a classifier may learn from, and the bounded sample it learns from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(folds: int, fold: int, doc_id: str = "doc_id") -> Column:
    """True for rows whose crc32(doc_id as text) leaves ``fold``; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def learning_sample(
    rows: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, most: int
) -> DataFrame:
    """At most ``most`` labelled rows outside the held-out fold, with ``label`` int.

    The rows are those of the smallest hashes of doc_id among the ids that ``rows`` has, so
    labels of absent documents take no place of others. Ids are compared as text. A document
    with several labels has the largest; null labels do not count. Of rows that repeat a
    doc_id the one with the smallest hash of its other columns counts.
    """
    name = F.col("doc_id").cast("string").alias("label_id")
    known = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(folds, fold))
        .groupBy(name)
        .agg(F.max(label).cast("int").alias("label"))
        .join(rows.select(name), "label_id", "left_semi")
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(most)
    )
    own = [F.col(f"`{c}`") for c in rows.columns]
    joined = rows.join(F.broadcast(known), F.col("doc_id").cast("string") == F.col("label_id"))
    one = F.min_by(F.struct(*own), F.xxhash64(*own)).alias("row")
    return joined.groupBy("label_id", "label").agg(one).select("row.*", "label")
