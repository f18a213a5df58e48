"""Incremental screening: titles that arrive as files are joined as they come, with a run log and each title once.

A Structured Streaming file source feeds micro-batches; the checkpoint folder makes a restarted run go on where the last one ended. Titles
written before are left out by an anti join on their key, so a file that is delivered twice, or a batch that is repeated after a failure,
adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import spatial
from ..sources import readers


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def screen_arrivals(spark: SparkSession, source: str, schema: StructType, pieces: DataFrame, key: str, target: str, log: str, checkpoint: str) -> StreamingQuery:
    """Starts a run over everything that has arrived; titles that touch a piece go to ``target``, one row a batch to ``log``."""

    def batch(titles: DataFrame, number: int) -> None:
        hits = spatial.spatial_join(titles.dropDuplicates([key]), pieces, key, "left_semi")
        if _exists(spark, target):
            hits = hits.join(spark.read.parquet(target).select(key), key, "left_anti")
        hits = hits.persist()
        try:
            written = hits.count()
            hits.write.mode("append").parquet(target)
            readers.append_log(spark, log, batch=number, titles_read=titles.count(), titles_written=written, status="complete")
        finally:
            hits.unpersist()

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(spark: SparkSession, log: str) -> DataFrame:
    """One row: batches, titles read and written so far."""
    return spark.read.json(log).agg(F.count("*").alias("batches"), F.sum("titles_read").alias("titles_read"), F.sum("titles_written").alias("titles_written"))
