"""Scores of predictions and of clusterings, as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import contingency
from .blocks import cluster_sums
from .ranking import rank_rows


def regression_scores(df: DataFrame, *, actual: str, predicted: str) -> DataFrame:
    err = F.col(actual).cast("double") - F.col(predicted).cast("double")
    return df.agg(
        (1 - F.try_divide(F.avg(err * err), F.var_pop(F.col(actual).cast("double")))).alias("r2"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
    )


def ordered_pairs(df: DataFrame, *, key: str, actual: str, predicted: str) -> DataFrame:
    """Actual and predicted values with their 0-based rank by the actual one."""
    return rank_rows(df.select(key, actual, predicted), [actual, key]).df


def confusion(df: DataFrame, *, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    """Counts for every pair of labels seen on either side, zeros included."""
    kind = df.schema[actual].dataType
    pairs = df.select(
        F.col(actual).alias("label"), F.col(predicted).cast(kind).alias("prediction")
    )
    counts = contingency(pairs, "label", "prediction")
    both = F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("prediction")))
    grid = (
        counts.agg(both.alias("_all"))
        .withColumn("label", F.explode("_all"))
        .withColumn("prediction", F.explode("_all"))
        .drop("_all")
    )
    return grid.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def _or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def class_scores(table: DataFrame) -> DataFrame:
    """Per-class scores from a confusion table, one pass over its cells.

    ``class_accuracy`` is the diagonal over the column sum, which is the precision.
    """
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"),
            F.col("n").alias("support"),
            F.lit(0).cast("long").alias("called"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            F.lit(0).cast("long").alias("tp"),
            F.lit(0).cast("long").alias("support"),
            F.col("n").alias("called"),
        ),
    )
    per = (
        table.select(F.explode(sides).alias("_s"))
        .select("_s.*")
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "called")])
    )
    total = table.agg(F.sum("n")).scalar()
    precision = _or_zero(F.col("tp"), F.col("called"))
    recall = _or_zero(F.col("tp"), F.col("support"))
    return (
        per.withColumn("n", total)
        .withColumns(
            {
                "fp": F.col("called") - F.col("tp"),
                "fn": F.col("support") - F.col("tp"),
                "tn": F.col("n") - F.col("called") - F.col("support") + F.col("tp"),
                "precision": precision,
                "recall": recall,
                "f_score": _or_zero(2 * precision * recall, precision + recall),
                "class_accuracy": precision,
            }
        )
        .withColumn(
            "ovr_accuracy", _or_zero(F.col("tp") + F.col("tn"), F.col("n"))
        )
        .drop("called", "n")
    )


def overall_scores(table: DataFrame) -> DataFrame:
    """Accuracy and support-weighted F score from a confusion table."""
    per = class_scores(table)
    return per.agg(
        _or_zero(F.sum("tp"), F.sum("support")).alias("accuracy"),
        _or_zero(F.sum(F.col("support") * F.col("f_score")), F.sum("support")).alias("weighted_f1"),
    )


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labelings from their contingency table."""
    table = contingency(df, a, b)

    def pairs(c: Column) -> Column:
        c = c.cast("double")
        return c * (c - 1) / 2

    rows = table.groupBy(a).agg(F.sum("n").alias("m")).agg(F.sum(pairs(F.col("m")))).scalar()
    cols = table.groupBy(b).agg(F.sum("n").alias("m")).agg(F.sum(pairs(F.col("m")))).scalar()
    parts = table.agg(F.sum(pairs(F.col("n"))).alias("both"), pairs(F.sum("n")).alias("every")).select(
        "both", "every", rows.alias("ra"), cols.alias("cb")
    )
    expected = F.try_divide(F.col("ra") * F.col("cb"), F.col("every"))
    top = (F.col("ra") + F.col("cb")) / 2
    score = F.when(top == expected, F.lit(1.0)).otherwise(
        F.try_divide(F.col("both") - expected, top - expected)
    )
    return parts.select(score.alias("adjusted_rand"))


def silhouettes(
    df: DataFrame, *, key: str, vector: str, cluster: str, size: int | None = None
) -> DataFrame:
    """Exact Euclidean silhouette of each row; 0 in a cluster of one."""
    return silhouettes_of(df, key=key, vector=vector, clusters=[cluster], size=size).select(
        key, F.col("cluster").alias(cluster), "silhouette"
    )


def silhouettes_of(
    df: DataFrame, *, key: str, vector: str, clusters: Sequence[str], size: int | None = None
) -> DataFrame:
    """(key, which, cluster, silhouette) of several clusterings; each distance is worked out once."""
    sums = cluster_sums(df, key=key, vector=vector, clusters=clusters, size=size)
    mine = F.array(*[F.col(c) for c in clusters])[F.col("which")]
    own = F.col("other") == F.col("cluster")
    per = sums.withColumn("cluster", mine).groupBy(key, "which", "cluster").agg(
        F.max(F.when(own, F.col("dist_sum"))).alias("_in"),
        F.max(F.when(own, F.col("n_other"))).alias("_n"),
        F.min(F.when(~own, F.col("dist_sum") / F.col("n_other"))).alias("_b"),
    )
    a = F.try_divide(F.col("_in"), (F.col("_n") - 1).cast("double"))
    score = F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("_b") - a, F.greatest(a, F.col("_b"))), F.lit(0.0))
    )
    return per.select(key, "which", "cluster", score.alias("silhouette"))


def ordered_silhouettes(scores: DataFrame, *, key: str, cluster: str) -> DataFrame:
    """Silhouettes with their position in the plot: by cluster, then by score."""
    return rank_rows(scores, [cluster, "silhouette", key], rank="place").df


def mean_silhouette(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("silhouette").alias("silhouette"))
