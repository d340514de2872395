"""The corpus pipeline: stages over ``documents``, each written and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm.common import packed, scratch, staged, table
from kerbline.llm.line_dedup import dedup_lines
from kerbline.llm.mixing import mix_sources
from kerbline.llm.packing import pack
from kerbline.llm.quality import quality_scores
from kerbline.llm.simhash import component_rows

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


_KEY = "pipeline_row"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a hash of the whole row, which with doc_id names the row and its copies."""
    return docs.withColumn(_KEY, F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))


def _own(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` (row, key) joined to those of ``rows`` (id, key) by both."""
    keyed = packed(docs).select("row", F.xxhash64(*(F.col("row")[c] for c in docs.columns)).alias("key"))
    # the merge join is dealt and split alike at every size
    same = (F.col("key") == F.col(_KEY)) & F.col("row.doc_id").eqNullSafe(F.col("id"))
    return keyed.join(rows.hint("merge"), same, how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject, each row by its own score."""
    scores = quality_scores(_keyed(docs), table(spark, sf_dir, "labels"), carry=(_KEY,))
    stay = scores.where("predicted = 1").select(F.col("doc_id").alias("id"), _KEY)
    return _own(docs, stay, "left_semi").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one has too."""
    return dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays, null last.

    Rows that repeat a doc_id, or have none, are copies only if their fingerprints are
    linked; of rows with the same smallest doc_id that of the smallest hash stays.
    """
    rows = component_rows(_keyed(docs), (_KEY,))
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), F.col("doc_id").alias("id"), F.col(_KEY)))
    stay = rows.groupBy("root").agg(first.alias("least")).select("least.id", f"least.{_KEY}")
    # of equal rows it does not matter which one stays; null ids are equal here
    kept = _own(docs, stay, "left_semi").withColumn("id", F.col("row.doc_id"))
    return kept.dropDuplicates(["key", "id"]).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, a part of at least half as a whole.

    Rows that are equal in all columns are taken as often as all of them together.
    """
    mixed = mix_sources(_keyed(docs), carry=(_KEY,))
    due = F.col("whole") + (2 * F.col("part") >= F.greatest("size", F.lit(1))).cast("int")
    taken = mixed.groupBy(F.col("doc_id").alias("id"), _KEY).agg(F.sum(due).cast("int").alias("times"))
    rows = _own(docs, taken.where("times > 0"), "inner").dropDuplicates(["key", "id"])
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2,048 words; repetitions of a document lie in different bins."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line-dedup", lines),
    ("simhash", near_dedup),
    ("mixing", mix),
    ("packing", packing),
]

# the learned score, the fingerprints and the packing have no SQL form
ORACLE_SQL = None


def _after(spark: SparkSession, stages: list[tuple[str, Stage]], sf_dir: str) -> DataFrame:
    """``documents`` after ``stages``, staged; what a stage read and staged goes when it is written."""
    if not stages:
        return table(spark, sf_dir, "documents")
    *before, (name, stage) = stages
    with scratch(spark):
        docs = _after(spark, before, sf_dir)
        return staged(stage(spark, docs, sf_dir), f"pipeline-{name}", outlives=True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, every stage but the last staged as Parquet.

    Null and empty texts pass as texts without a word, as far as the quality model keeps
    them; an empty table gives an empty result.
    """
    return STAGES[-1][1](spark, _after(spark, STAGES[:-1], sf_dir), sf_dir)
