"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


_LOCAL_DIRS: dict[str, str] = {}


def build_session(app: str = "cadenza", cores: str = "8", shuffle_partitions: int = 8,
                  driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; on a cluster a
    missing setting is an error, because a driver-local folder would not survive there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="cadenza-")
    return _LOCAL_DIRS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the application's own folder, which can be removed when it has ended."""
    return f"{shared_dir(spark)}/cadenza/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, name: str = "") -> None:
    """Delete the application's own written tables, or those of one name, once nothing reads them any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/cadenza/{spark.sparkContext.applicationId}")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(folder):
        for status in files.listStatus(folder):
            if status.getPath().getName().startswith(f"{name}-" if name else ""):
                files.delete(status.getPath(), True)


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a written table, so a lost executor re-reads instead of recomputing."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """A written table, and aggregates over its rows taken while they were written, by name.

    The aggregates lie in the writing stage, where every partition counts once, whether tasks are repeated or not.
    """
    seen = Observation()
    written = write_and_read(df.observe(seen, *[value.alias(key) for key, value in metrics.items()]), name)
    return written, seen.get
