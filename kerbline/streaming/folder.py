"""The drop folder as a stream: every new file goes through the batch load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.drops import drop_glob, load_rows, scan_files
from ..sources.feeds import FEEDS, Feed


def stream_files(spark: SparkSession, root: str, route: str) -> DataFrame:
    """The paths of one feed's new files; their contents are read when they are loaded."""
    files = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    )
    return files.load(drop_glob(root, FEEDS[route].prefix)).select("path")


def land_stream(
    rows: DataFrame, feed: Feed, target: str, checkpoint: str, *, mode: str = "raise"
) -> StreamingQuery:
    """Load everything that is waiting, then stop. A replayed batch changes nothing."""

    def land(batch: DataFrame, _: int) -> None:
        load_rows(batch, feed, target, mode=mode)

    return (
        rows.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_folder(
    spark: SparkSession, root: str, warehouse: str, route: str, checkpoint: str, *, mode: str = "raise"
) -> StreamingQuery:
    """The waiting files of one feed into its table, each by its own header."""
    feed = FEEDS[route]

    def land(batch: DataFrame, _: int) -> None:
        # one short text per file that arrived
        paths = sorted(r["path"] for r in batch.collect())
        if paths:
            load_rows(scan_files(spark, paths, feed), feed, f"{warehouse}/{feed.table}", mode=mode)

    return (
        stream_files(spark, root, route)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
