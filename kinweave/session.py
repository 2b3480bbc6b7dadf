"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans rely on.  Skewed join partitions are split by AQE; the
# force flag keeps the split even where it costs an extra exchange further up.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Comparing pairs costs far more than their bytes suggest: keep small shuffles spread.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Files of ids and dictionary values unfold to many times their size: without this, tables that
    # fill the driver's memory pass for small enough to broadcast.
    "spark.sql.sources.fileCompressionFactor": "8.0",
    "spark.sql.session.timeZone": "UTC",
}


# The corpus operators broadcast by name what has one size whatever the input, and their tables
# are written as they are read: taken for larger, small ones would be shuffled with all texts.
CORPUS_SETTINGS = SETTINGS | {"spark.sql.sources.fileCompressionFactor": "1.0"}


def tune(spark: SparkSession, settings: dict[str, str] = SETTINGS) -> SparkSession:
    """Apply the runtime settings above to a session made elsewhere."""
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "kinweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, or where that is unset
    the checkpoint folder given to the context.

    Only a local session without either gets a temporary folder; a cluster session is
    refused, because a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="kinweave-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below this application's part of the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/kinweave-{app}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to its part of the shared folder."""
    folder = f"{shared_dir(spark)}/kinweave-{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Compute `df` once into a table in the shared folder and read it from there.

    The table outlives any executor, later jobs scan only the columns they need, and its
    file sizes give the optimizer true statistics.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
