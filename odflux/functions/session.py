"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "odflux", master: str | None = None, **conf: str) -> SparkSession:
    """Session with a UTC clock, AQE, skew-join splitting and RocksDB stream state."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.multipleWatermarkPolicy": "min",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint folder: the one the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master, where driver and
    executors share one disk. On a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-")
    context.setCheckpointDir(named)
    return named


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Write the frame as a table in the checkpoint folder and read on from there.

    Unlike a checkpointed plan, the table brings its real size to the planner, so a
    small state is broadcast and a large one is not, and carries no inferred
    constraints from round to round. A lost executor only rereads files.
    """
    path = f"{ensure_checkpoint_dir(frame.sparkSession)}/cut-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    table = frame.sparkSession.read.schema(frame.schema).parquet(path)
    table._cut_path = path
    return table


def release(frame: DataFrame) -> None:
    """Delete the table behind a frame of ``cut_lineage`` that no later plan reads; other frames are left alone."""
    path = getattr(frame, "_cut_path", None)
    if path:
        spark = frame.sparkSession
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
