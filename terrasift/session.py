"""Session helpers: a configured local session, and lineage cut through the cluster's shared folder."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, **conf: str) -> SparkSession:
    """A session for one machine; on a cluster the session comes from outside."""
    n = cores or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Folders made for local sessions; they go with the process.
_own: dict[SparkSession, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; one of this machine only for a local session without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark not in _own:
        _own[spark] = tempfile.mkdtemp(prefix="terrasift-")
        atexit.register(shutil.rmtree, _own[spark], ignore_errors=True)
    return _own[spark]


def checkpointed(df: DataFrame, partitions: int | None = None, sized: bool = True) -> DataFrame:
    """The same rows read from the shared folder, without their lineage, in at most so many partitions.

    Spark hands its guess of their size on. It starts from the bytes of the input files, counts an exploded array as one row and is multiplied by each join, so it can be far too
    small (such rows are sent through the driver to join them) or grow without bound. Not ``sized``: the size is unknown, and joins go by what is shuffled.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    at_rest = (df.coalesce(partitions) if partitions else df).checkpoint(eager=True)
    if sized:
        return at_rest
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(at_rest._jdf.queryExecution().toRdd(), at_rest._jdf.schema(), False), spark)


def release(spark: SparkSession) -> None:
    """Let the cleaner delete shuffle files that nothing refers to any more; long loops over small tables pile them up."""
    gc.collect()
    spark._jvm.System.gc()
