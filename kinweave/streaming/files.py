"""New files below a prefix as a stream, and jobs per arrival."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kinweave.sinks.merge import KeyedTable
from kinweave.sources.readers import CSV_DIALECT


def stream_files(
    spark: SparkSession, prefix: str, schema: T.StructType | str, fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
    if fmt == "csv":
        reader = reader.options(**CSV_DIALECT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(prefix)


def on_arrival(
    stream: DataFrame, checkpoint: str, job: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Run `job(rows, batch_id)` for all files that have arrived, then stop.

    A batch may be repeated after a failure, under the same id: the job has to write by id.
    """
    return (
        stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def append_changes(table: KeyedTable, old: int, new: int, feed: str, batch_id: int) -> None:
    """Add the changes between two versions to the feed, as its part `batch_id`.

    A part comes to stand by one rename and is never written again: a repeated batch makes the same changes, and
    whoever follows the feed must not meet them twice.
    """
    feed = feed.rstrip("/")
    context = table.spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(f"{feed}/batch_id={batch_id}")
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    if files.exists(place):
        return
    draft = f"{feed}/.draft-{uuid.uuid4().hex}"
    table.changes(old, new).write.parquet(draft)
    if not files.rename(context._jvm.org.apache.hadoop.fs.Path(draft), place):
        raise RuntimeError(f"part {batch_id} of {feed} could not be put in place")


def read_changes(spark: SparkSession, feed: str) -> DataFrame:
    return spark.read.parquet(feed).withColumn("batch_id", F.col("batch_id").cast("long"))


def follow_changes(spark: SparkSession, feed: str, schema: T.StructType, parts_per_batch: int | None = None) -> DataFrame:
    """The feed as a stream: `action`, the columns of the table (`schema`), and `batch_id`.  A consumer's checkpoint
    remembers which parts it has taken, so each change reaches it once, restarts included.  The feed may still be empty."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(feed)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    fields = [T.StructField("action", T.StringType()), *schema.fields, T.StructField("batch_id", T.LongType())]
    reader = spark.readStream.schema(T.StructType(fields))
    if parts_per_batch:
        reader = reader.option("maxFilesPerTrigger", parts_per_batch)
    return reader.parquet(feed)
