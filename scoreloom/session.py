"""Session settings and the two ways a result is materialised between jobs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"
BOUNDED_ROWS = 10_000


def build_session(app: str = "scoreloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; make a local one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="scoreloom-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    else:
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name beside the checkpoints, visible to every executor."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Give a scan of few large files one partition per core before heavy row work.

    A scan that already has that many partitions is left alone, so large inputs
    are never shuffled here.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder once and read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "stored", vectors: Sequence[str] = ()) -> DataFrame:
    """Write `df` to a parquet table beside the checkpoints; readers scan only the columns they use.

    Columns named in `vectors` are structs with the fields of a vector, and come back as vectors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name in vectors else f.dataType) for f in df.schema]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def bounded_side(df: DataFrame, max_rows: int = BOUNDED_ROWS) -> DataFrame:
    """The small side of a join, run once.

    Up to `max_rows` rows are fetched and come back as a broadcast table. A
    larger result is never fetched: it is checkpointed and joined by shuffle.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    return materialise(df)
