"""Loading of file drops into Parquet tables, one partition per file, replayable.

A file is known by its name. Of one name in several folders the newest date counts, then
the smallest path. A file is loaded when the table holds none, some or too many of its
rows or an older file of its name, and skipped when it holds as many rows as the file has
to give. The write replaces the partitions of the loaded files only, so running a load
again after a failure gives the same table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import file_name_of, folder_date
from ..operators.joins import join_counted
from ..session import cut
from .feeds import FEEDS, Feed, clean, missing_columns, route_of, sound, unroutable
from .tables import csv_headers, path_exists, read_csv, remove_path

SKIP, APPEND, REPLACE, KEEP, UNROUTABLE = "skip", "append", "replace", "keep", "unroutable"
PATH = "_path"


def drop_glob(root: str, prefix: str = "") -> str:
    return f"{root.rstrip('/')}/received/*/files/{prefix}*"


def discover(spark: SparkSession, root: str) -> DataFrame:
    """The files of all drops with their date and feed; contents are not read."""
    files = spark.read.format("binaryFile").load(drop_glob(root)).select("path", "length")
    return files.select(
        "path",
        "length",
        file_name_of("path").alias("file_name"),
        folder_date("path").alias("file_date"),
    ).withColumn("route", route_of("file_name"))


def _decoded(path: str) -> Column:
    """A path from a percent-encoded URI."""
    return F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))


def stamp(df: DataFrame, path: str = "_metadata.file_path") -> DataFrame:
    """Add the lineage columns from the path of a row's file, a percent-encoded URI."""
    where = _decoded(path)
    return df.withColumns({"file_date": folder_date(where), "file_name": file_name_of(where)})


def scan_files(spark: SparkSession, paths: list[str], feed: Feed) -> DataFrame:
    """Files of one feed as text, each by its own header, with lineage and their path.

    Columns that only some files have are NULL in the others; a file without a column of
    the feed is an error.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, header in csv_headers(spark, paths):
        by_header.setdefault(header, []).append(path)
    parts = []
    for header, own in by_header.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        rows = read_csv(spark, own, schema=schema)
        rows = stamp(rows.withColumn(PATH, F.col("_metadata.file_path")), PATH)
        lacking = missing_columns(rows, feed.spec)
        if lacking:
            raise ValueError(f"{own[0]} lacks {', '.join(lacking)}")
        parts.append(rows)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_feed(spark: SparkSession, root: str, feed: Feed) -> DataFrame:
    """All files of one feed as text, with lineage."""
    found = spark.read.format("binaryFile").load(drop_glob(root, feed.prefix)).select("path")
    # one short text per file
    return scan_files(spark, sorted(r["path"] for r in found.collect()), feed)


def rows_per_file(table: DataFrame, out: str = "n") -> DataFrame:
    return table.groupBy("file_name").agg(F.count(F.lit(1)).alias(out))


def _pathed(rows: DataFrame) -> DataFrame:
    return rows if PATH in rows.columns else rows.withColumn(PATH, F.lit(""))


def incoming_files(rows: DataFrame, counted: Column | None = None) -> DataFrame:
    """Row count of each file; of a name seen in several folders the newest one counts.

    ``counted`` says which rows a file has to give; without it all count.
    """
    one = F.lit(1) if counted is None else F.when(counted, 1)
    per = _pathed(rows).groupBy("file_name", "file_date", PATH).agg(F.count(one).alias("_n"))
    # NULL dates come before all others
    newest = F.struct(-F.unix_date("file_date"), F.col(PATH), F.col("_n"), F.col("file_date"))
    newest = F.min(F.struct(F.isnull("file_date").alias("_undated"), newest.alias("_f")))["_f"]
    return per.groupBy("file_name").agg(
        newest["file_date"].alias("file_date"),
        newest["_n"].alias("n_file"),
        newest[PATH].alias(PATH),
        (F.count(F.lit(1)) - 1).alias("n_older"),
    )


def reconcile(incoming: DataFrame, loaded: DataFrame) -> DataFrame:
    """What to do with each file.

    ``incoming`` has (file_name, n_file), ``loaded`` has (file_name, n_table). With
    file_date and table_date too, a file older than the loaded one is skipped, and a newer
    one replaces it whatever the counts.
    """
    have, give = F.coalesce("n_table", F.lit(0)), F.col("n_file")
    older = newer = F.lit(False)
    if "file_date" in incoming.columns and "table_date" in loaded.columns:
        older = F.coalesce(F.col("file_date") < F.col("table_date"), F.lit(False))
        newer = F.coalesce(F.col("file_date") > F.col("table_date"), F.lit(False))
    return incoming.join(loaded, "file_name", "full").withColumn(
        "action",
        F.when(give.isNull(), KEEP)
        .when(older, SKIP)
        .when((have == give) & ~newer, SKIP)
        .when(have == 0, APPEND)
        .otherwise(REPLACE),
    )


def loaded_counts(spark: SparkSession, target: str) -> DataFrame:
    """(file_name, n_table, table_date) of the files in a table."""
    if not path_exists(spark, target):
        return spark.createDataFrame([], "file_name string, n_table long, table_date date")
    # naming the columns keeps names text and lets an empty table count as none
    held = spark.read.schema("file_date date, file_name string").parquet(target)
    return held.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_table"), F.max("file_date").alias("table_date")
    )


def load_rows(raw: DataFrame, feed: Feed, target: str, *, mode: str = "raise") -> DataFrame:
    """Bring stamped rows into ``target`` and return the action taken per file.

    With ``mode="drop"`` a file has those rows to give that break no rule. A file that has
    none left loses its partition.
    """
    spark = raw.sparkSession
    raw = _pathed(raw)
    if mode == "drop":
        # files that give no row still count, with none
        good = incoming_files(sound(feed.spec)(raw)).select("file_name", "file_date", PATH, "n_file")
        seen = incoming_files(raw).drop("n_file")
        incoming = seen.join(good, ["file_name", "file_date", PATH], "left").fillna(0, ["n_file"])
    else:
        incoming = incoming_files(raw)
    # the counts are fixed before the write, which changes the table they come from
    actions = cut(reconcile(incoming, loaded_counts(spark, target)))
    due = actions.where(F.col("action").isin(APPEND, REPLACE))
    files = due.select("file_name", "file_date", PATH)
    if not files.isEmpty():
        rows = join_counted(raw, files, ["file_name", "file_date", PATH], "left_semi")
        (
            clean(rows.drop(PATH), feed.spec, mode=mode)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("file_name")
            .parquet(target)
        )
        # the write leaves partitions alone for which it has no row
        for row in due.where(F.col("n_file") == 0).select("file_name").collect():
            remove_path(spark, target, "file_name", row["file_name"])
    return actions.drop(PATH)


_REPORT = "file_name string, file_date date, n_file long, n_older long, n_table long, table_date date, action string, route string"


def load_drops(spark: SparkSession, root: str, warehouse: str, *, mode: str = "raise") -> DataFrame:
    """Load every feed found under ``root``; returns (route, file_name, action, ...).

    Files that no feed takes are in the report as ``unroutable``.
    """
    files = cut(discover(spark, root).select("file_name", "file_date", "route"))
    out = spark.createDataFrame([], _REPORT).unionByName(
        unroutable(files).select("file_name", "file_date", F.lit(UNROUTABLE).alias("action")),
        allowMissingColumns=True,
    )
    found = [r["route"] for r in files.where("route IS NOT NULL").select("route").distinct().collect()]
    for route in sorted(found):
        feed = FEEDS[route]
        done = load_rows(scan_feed(spark, root, feed), feed, f"{warehouse}/{feed.table}", mode=mode)
        out = out.unionByName(done.withColumn("route", F.lit(route)))
    return out
