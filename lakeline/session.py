"""Session set-up, shared scratch folders and small execution helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_own_roots: dict[str, str] = {}


def local_session(app: str = "lakeline", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.lakeline.scanPartitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if root:
        return root.rstrip("/") if context.master.startswith("local") else qualified(spark, root.rstrip("/"))
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _own_roots:
        _own_roots[app] = tempfile.mkdtemp(prefix="lakeline-")
        atexit.register(shutil.rmtree, _own_roots[app], ignore_errors=True)
        context.setCheckpointDir(_own_roots[app])
    return _own_roots[app]


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme Spark reads it by, which for a bare path is the cluster's default.

    Tasks that write files of their own would else take a bare path for their machine's disk.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unique path below the shared root; nothing is created yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/lakeline/{app}/{purpose}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of a table that several jobs use, and survives the loss
    of executors, which a cached block does not.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that the steps of one computation hand on, each dropped once no later step reads it."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder = spark, work_folder(spark, purpose)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` under a new name and read it back, as ``stored`` does."""
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        drop_folders(self.spark, *(f"{self.folder}/{name}" for name in names))


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this application has written below the shared root, once its results are written."""
    drop_folders(spark, f"{shared_root(spark)}/lakeline/{spark.sparkContext.applicationId}")


def drop_folders(spark: SparkSession, *paths: str) -> None:
    """Delete folders wherever Spark keeps them; one that is not there is no fault."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a scan over ``spark.lakeline.scanPartitions`` partitions, if the session sets it.

    A local session does, as its tables are single files that Spark cannot split. A
    cluster leaves it unset, and the scan is used as it is.
    """
    partitions = df.sparkSession.conf.get("spark.lakeline.scanPartitions", None)
    return df.repartition(int(partitions), *keys) if partitions else df


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From here on the session hands Python at most ``BATCH_BYTES`` of rows at a time, unless it has a limit of its own.

    Spark's 64 MB are held several times over, by the executor and by Python, for each task, where rows hold whole texts.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, str(BATCH_BYTES))


@contextmanager
def cached(*frames: DataFrame):
    """Keep inputs of an iterative fit in memory, spilling to disk, for its duration."""
    kept = [frame.persist(StorageLevel.MEMORY_AND_DISK) for frame in frames]
    try:
        yield kept[0] if len(kept) == 1 else kept
    finally:
        for frame in kept:
            frame.unpersist()
