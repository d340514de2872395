"""A log of loaded files, so that a load opens new and changed files only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import file_name_of, folder_date
from ..session import cut
from .drops import UNROUTABLE, drop_glob, load_rows, loaded_counts, scan_files
from .feeds import FEEDS, route_of
from .tables import path_exists

UNCHANGED, OLDER = "unchanged", "older"
_LOG = "route string, path string, length long, modified timestamp, file_name string, n_file long, logged timestamp"
_REPORT = "route string, file_name string, file_date date, path string, action string, n_file long"


def log_path(warehouse: str) -> str:
    return f"{warehouse.rstrip('/')}/load_log"


def listed(spark: SparkSession, root: str) -> DataFrame:
    """All files of all drops by their listing alone: path, length, modified, name, date, feed."""
    files = spark.read.format("binaryFile").load(drop_glob(root))
    return files.select(
        "path", "length", F.col("modificationTime").alias("modified"), file_name_of("path").alias("file_name"),
        folder_date("path").alias("file_date"),
    ).withColumn("route", route_of("file_name"))


def read_log(spark: SparkSession, warehouse: str) -> DataFrame:
    """The last entry of each path."""
    where = log_path(warehouse)
    if not path_exists(spark, where):
        return spark.createDataFrame([], _LOG)
    entries = spark.read.schema(_LOG).parquet(where)
    own = [c for c in entries.columns if c != "path"]
    return entries.groupBy("path").agg(F.max_by(F.struct(*own), "logged").alias("e")).select("path", "e.*")


def due_files(files: DataFrame, log: DataFrame, held: DataFrame) -> DataFrame:
    """What to do with each listed file, without opening it.

    Of one name the newest date counts, then the smallest path; the others are ``older``.
    A file is ``unchanged`` when the log has its path with this length and time and the
    table (file_name, n_table) holds the rows that the log says; all others are due, their
    action is NULL.
    """
    newest = F.struct(F.isnull("file_date"), -F.unix_date("file_date"), "path")
    first = files.groupBy("file_name").agg(F.min(newest)["path"].alias("newest"))
    known = log.select("path", F.col("length").alias("old_length"), F.col("modified").alias("old_time"), "n_file")
    same = (
        (F.col("length") == F.col("old_length")) & (F.col("modified") == F.col("old_time"))
        & (F.coalesce("n_table", F.lit(0)) == F.col("n_file"))
    )
    return (
        files.join(first, "file_name").join(known, "path", "left").join(held, "file_name", "left")
        .withColumn(
            "action", F.when(F.col("path") != F.col("newest"), OLDER).when(F.coalesce(same, F.lit(False)), UNCHANGED)
        )
        .select(*files.columns, "action", "n_file")
    )


def load_new(spark: SparkSession, root: str, warehouse: str, *, mode: str = "raise") -> DataFrame:
    """Load the new and changed files of every feed; returns one row per file found.

    Rows are (route, file_name, file_date, path, action, n_file): ``append``, ``replace``
    or ``skip`` as by ``drops.load_drops`` for the files that were opened, ``unchanged``
    and ``older`` for those that were not, ``unroutable`` for those that no feed takes. An
    entry is written once the rows of its feed are; a load that died before that opens
    its files again and finds them complete.
    """
    files = cut(listed(spark, root))
    log = cut(read_log(spark, warehouse))
    out = spark.createDataFrame([], _REPORT).unionByName(
        files.where("route IS NULL").select("file_name", "file_date", "path", F.lit(UNROUTABLE).alias("action")),
        allowMissingColumns=True,
    )
    routes = sorted(r["route"] for r in files.where("route IS NOT NULL").select("route").distinct().collect())
    for route in routes:
        feed = FEEDS[route]
        target = f"{warehouse}/{feed.table}"
        held = loaded_counts(spark, target).select("file_name", "n_table")
        # the table changes below
        plan = cut(due_files(files.where(F.col("route") == route), log.where(F.col("route") == route), held))
        out = out.unionByName(
            plan.where("action IS NOT NULL").select("route", "file_name", "file_date", "path", "action", "n_file")
        )
        due = plan.where("action IS NULL").drop("action", "n_file")
        # one short text per file to open
        paths = sorted(r["path"] for r in due.select("path").collect())
        if not paths:
            continue
        done = load_rows(scan_files(spark, paths, feed), feed, target, mode=mode).select("file_name", "action", "n_file")
        # a file without rows gives none, and has no action of its own
        done = cut(
            due.join(done, "file_name", "left").withColumns(
                {"action": F.coalesce("action", F.lit("skip")), "n_file": F.coalesce("n_file", F.lit(0))}
            )
        )
        entries = done.withColumn("logged", F.current_timestamp())
        entries.select(*[c.split(" ")[0] for c in _LOG.split(", ")]).write.mode("append").parquet(log_path(warehouse))
        out = out.unionByName(done.select("route", "file_name", "file_date", "path", "action", "n_file"))
    return out
