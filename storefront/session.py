"""Session helpers: local sessions for tests, shared scratch space, landed tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cores: str | int = "*", app: str = "storefront") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor reaches, for what several jobs read.

    Named by ``spark.checkpoint.dir``, else the folder given to ``setCheckpointDir``. Only a
    session on one machine may do without: executors of a cluster would each write to a disk
    of their own, and later reads would miss rows.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="storefront-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Have a scratch folder deleted when the driver ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(place)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over all shuffle partitions, for one side of a join by these keys.

    Adaptive execution merges partitions by their compressed bytes, and keys compress to a few
    bytes a row, so one task may be left to sort millions of rows. A number of partitions that is
    named is kept, and the other side of the join follows it. It is one more than Spark's own,
    as Spark drops a repartition that changes nothing, and with it the name.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1, *keys)


def land(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    For rows that several jobs read: they are computed once, all readers see the same, and
    a lost executor takes nothing with it. The folder goes when the driver ends.
    """
    return land_observed(df, label)[0]


def land_observed(df: DataFrame, label: str, **figures: Column) -> tuple[DataFrame, dict[str, int], str]:
    """The landed table, aggregates that its write counted on the way, and its folder."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    watched = df.observe(seen, *[f.alias(name) for name, f in figures.items()]) if figures else df
    watched.write.parquet(path)
    drop_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path), dict(seen.get) if figures else {}, path
