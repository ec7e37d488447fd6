"""Session settings and the shared staging folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "stallkeeper", cores: str = "*", shuffle_partitions: int = 8,
                  **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_named: dict[str, str] = {}


def name_staging_root(spark: SparkSession, folder: str) -> None:
    """Folder for a session that has none, as in tests; a running session no longer takes the setting."""
    _named[spark.sparkContext.applicationId] = folder


def has_staging_root(spark: SparkSession) -> bool:
    return bool(spark.conf.get(CHECKPOINT_KEY, None) or _named.get(spark.sparkContext.applicationId))


def staging_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the session names it."""
    root = spark.conf.get(CHECKPOINT_KEY, None) or _named.get(spark.sparkContext.applicationId)
    if not root:
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder all executors can reach")
    return root


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage and fixes values such as row positions, so that a lost
    executor cannot change them.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_last(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Stage what ``make`` gives and remove the tables it has staged on the way, which nothing else may read."""
    mark = _passing.set(passing := [])
    try:
        df = make()
    finally:
        _passing.reset(mark)
    out, spark = stage(df, label), df.sparkSession
    for path in passing:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return out


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


TASK_ROWS = 1_000_000


def parts_for(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Partitions for a join or grouping of ``rows`` rows: the session's width, or more if a task got over ``task_rows``."""
    return max(shuffle_width(spark), -(-rows // task_rows))
