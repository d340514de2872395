"""The registered corpus queries, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import alignment_report, tokenizer_path
from .common import table
from .exact_dedup import OP4_SQL, exact_dedup, later_half
from .licences import licence_paragraphs
from .line_dedup import line_decisions
from .mixing import OP5_SQL, mix_sources
from .nearest import OP8_SQL, nearest_neighbours
from .packing import pack
from .passages import repeated_passages
from .quality import quality_scores
from .repair import OP12_SQL, damaged, repair_report
from .rotation import OP11_SQL, cosine_groups
from .simhash import simhash_groups
from .toxicity import toxicity_scores


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_decisions(table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), later_half())


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_paragraphs(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op8_block_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_groups(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(table(spark, sf_dir, "conversations")), F.col("present"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment_report(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_simhash_near_dedup,
        op3_toxicity,
        op4_exact_dedup,
        op5_mix_sources,
        op6_licence_scan,
        op7_substring_dedup,
        op8_block_nearest,
        op9_best_fit_packing,
        op10_quality,
        op11_embedding_near_dedup,
        op12_conversation_repair,
        op13_token_alignment,
    )
}
SQL: dict[str, str] = {
    "op4_exact_dedup": OP4_SQL,
    "op5_mix_sources": OP5_SQL,
    "op8_block_nearest": OP8_SQL,
    "op11_embedding_near_dedup": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
}
