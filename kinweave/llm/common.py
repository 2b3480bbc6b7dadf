"""What the operators of this folder share."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.session import scratch_path

# The word separators of every operator: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def squeeze(text: Column) -> Column:
    """`text` without its word separators; NULL counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def held_out(doc_id: Column) -> Column:
    """The third of the documents that no model is fitted on; a NULL id is never fitted on."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as `--py-files` would,
    by way of the shared folder.

    Batches are kept small, so that a worker's memory does not depend on how long texts are.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    context, package = spark.sparkContext, Path(__file__).parent.parent
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    place = f"{scratch_path(spark, 'package')}/kinweave_package.zip"
    path = context._jvm.org.apache.hadoop.fs.Path(place)
    stream = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(archive.getvalue()))
    stream.close()
    context.addPyFile(place)
    _shipped.add(context.applicationId)
