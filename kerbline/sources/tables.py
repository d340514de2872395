"""Plain readers and writers."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null


def read_table(spark: SparkSession, path: str, *, schema: str | None = None) -> DataFrame:
    """Parquet, ORC or CSV with a header, told apart by the end of the path.

    NaN becomes NULL, so that missing has one form.
    """
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        df = read_csv(spark, path, schema=schema)
    elif path.rstrip("/").endswith(".orc"):
        df = spark.read.orc(path)
    else:
        df = spark.read.parquet(path)
    return without_nan(df)


def read_csv(spark: SparkSession, path, *, schema=None) -> DataFrame:
    """CSV by its header; without a schema every column is text.

    Files whose header differs from the schema fail instead of being read by position.
    """
    if schema is None:
        schema = spark.read.option("header", True).csv(path).schema
    return (
        spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)
    )


def without_nan(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_database(
    spark: SparkSession, url: str, table: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """A table behind JDBC. Name ``partitionColumn`` and bounds to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {})).load()


def write_database(
    df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None
) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **(options or {})).mode(
        "append"
    ).save()


def save_model(model: MLWritable, path: str) -> None:
    as_pipeline = model if isinstance(model, PipelineModel) else PipelineModel([model])
    as_pipeline.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def csv_headers(spark: SparkSession, paths: list[str]) -> list[tuple[str, tuple[str, ...]]]:
    """The header of each file, from its first line; files without a line are left out."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop

    def first(path: str) -> str | None:
        where = hadoop.fs.Path(path)
        data = where.getFileSystem(conf).open(where)
        codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        if codec is not None:
            data = codec.createInputStream(data)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(data, "UTF-8"))
        try:
            return lines.readLine()
        finally:
            lines.close()

    with ThreadPoolExecutor(16) as pool:
        found = zip(paths, pool.map(first, paths))
        return [(p, tuple(next(csv.reader([line.removeprefix("\ufeff")])))) for p, line in found if line]


def remove_path(spark: SparkSession, table: str, column: str, value: str) -> None:
    """Delete one partition folder of a table, if it is there."""
    jvm = spark.sparkContext._jvm
    names = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    where = jvm.org.apache.hadoop.fs.Path(f"{table}/{names.getPartitionPathString(column, value)}")
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def group_table(df: DataFrame, *, name: str) -> DataFrame:
    """Name and cell columns of a percentile-cell table, as exported."""
    return df.select(F.col(name), "row", "column", "group")
