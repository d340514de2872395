"""Helpers the corpus operators share: staged tables, words, graph components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path

# The six characters \x20 and \x09-\x0D, which separate words and are dropped when
# texts are normalised. bytes.split() without arguments splits on exactly these.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# paths of staged tables, by the scratch blocks they were made in, the innermost last
_SCRATCH: list[list[str]] = []


def staged(df: DataFrame, name: str, *, outlives: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back, so that its lineage ends there.

    In a :func:`scratch` block the table goes with the block, or, if it ``outlives`` it,
    with the block around it.
    """
    path = staging_path(df.sparkSession, name)
    level = len(_SCRATCH) - 1 - outlives
    if level >= 0:
        _SCRATCH[level].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end, but for those that outlive the block.

    Whatever is still to be read must be staged so, since a DataFrame is not read before
    it is asked for. Blocks are opened by the driver, one inside the other.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def packed(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as one struct column ``row``, so that no name of theirs can clash."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def no_spaces(text: Column | str) -> Column:
    """The text without its white space; null counts as empty."""
    col = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(col, F.lit("")), SPACES, "")


def word_count(text: Column | str) -> Column:
    """Number of words of a text; null has none."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable node for each of ``n`` nodes under the links ``u``-``v``."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        apart = low < high
        u, v = low[apart], high[apart]
        if not len(u):
            break
        np.minimum.at(root, v, u)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b) as (node, root), root the smallest node.

    Alternates the large-star and small-star steps until the edges no longer change.
    Minima are aggregated before they are joined, so a node with very many links costs
    one aggregate, and its join is split by the adaptive skew join. Edges are staged
    after each round. Nodes without an edge to another node do not appear. A graph that
    has not settled after ``most_rounds`` (it halves path lengths, so 2^60) is an error.
    """
    now = staged(edges.where("a <> b").select("a", "b").distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        # every row of large has u > v here, as the small star wants it
        large = staged(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))
        )
        now = staged(
            small.where("u <> v").distinct().select(F.col("u").alias("a"), F.col("v").alias("b")),
            "edges",
        )
        # one row: equal marks of two rounds mean equal edges
        last, mark = mark, now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if last == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError("components did not settle")
