"""Session settings every job relies on, and where its intermediate tables lie."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Read and print timestamps in UTC; leave all sizing to the cluster and to AQE.

    For wide contracts submit with ``spark.sql.codegen.hugeMethodLimit=8000``: the JVM
    interprets longer methods, and a projection that grows past that runs faster unfused.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables may be written: a folder that driver and executors share.

    ``spark.checkpoint.dir`` names it. A session on one machine may leave it unset and gets a
    folder in its SQL warehouse; on a cluster that may be a folder of the driver's own, so there
    the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Store a small intermediate result in the shared folder and forget how it was made."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def stored(frame: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame as Parquet under a new name in the shared folder, and read it again.

    Unlike a checkpoint it is compressed, read column by column, and can be read by a later
    driver; whoever owns the shared folder clears it.
    """
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
