"""Session settings and the ways of cutting a plan: checkpoint and staged table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "kerbline", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # checkpoints go when nothing refers to them any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, setting in conf.items():
        builder = builder.config(name, setting)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a folder of its own; a cluster without it is an error, because
    a machine-local folder would be lost with the machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(named)
        return named
    current = sc._jsc.sc().getCheckpointDir()
    if not current.isEmpty():
        return current.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="kerbline-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage and restart its lineage from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_PART_ROWS = 250_000


def spread(df: DataFrame) -> DataFrame:
    """``df`` materialised in twice as many parts as the cluster has cores, more if they get large.

    A table of few bytes and much work per row would else stay in the one or two parts that
    adaptive execution leaves of it, and keep as many cores busy.
    """
    kept = cut(df)
    parts = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-kept.count() // _PART_ROWS))
    return cut(kept.repartition(parts))


def _staging_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/staged-{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed by :func:`drop_staged`."""
    return f"{_staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Remove all staged tables of this application; call it when its results are written."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staging_root(spark))
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
