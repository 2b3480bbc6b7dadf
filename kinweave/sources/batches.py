"""The latest batch below a prefix."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def _walk(spark: SparkSession, folder: str, recursive: bool) -> Iterator[str]:
    """Paths of files in or below a folder, as the file system lists them: one is held at a time."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, recursive)
    while files.hasNext():
        name = files.next().getPath().toString()
        if not name.rsplit("/", 1)[1].startswith(("_", ".")):
            yield name


def _literal(name: str) -> str:
    """A pattern that only `name` matches: Spark takes paths, as it takes name filters, for patterns."""
    return "".join(f"\\{c}" if c in "*?[]{}^\\" else c for c in name)


def latest_folder(spark: SparkSession, base: str, pattern: str = ".json") -> tuple[str, bool] | None:
    """(folder, whether what lies below it counts): the lexicographically greatest first-level folder below `base` that has
    a file whose path contains `pattern`; `base` itself, without what lies below, where only that has one.

    Only the first level is listed as a whole; folders are then looked into from the greatest on, until the first hit.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    folders = [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]
    folders = sorted((f for f in folders if not f.getName().startswith(("_", "."))), key=lambda f: f.getName(), reverse=True)
    places = [*((f.toString(), True) for f in folders), (path.toString(), False)]
    return next((p for p in places if any(pattern in f for f in _walk(spark, *p))), None)


def latest_batch(spark: SparkSession, base: str, pattern: str = ".json", first_only: bool = False) -> list[str]:
    """Paths of the files of the latest folder whose path contains `pattern`, the first of them only with `first_only`."""
    found = latest_folder(spark, base, pattern)
    if found is None:
        return []
    hits = (f for f in _walk(spark, *found) if pattern in f)
    return [min(hits)] if first_only else sorted(hits)


def read_latest(
    spark: SparkSession, base: str, fmt: str, schema, pattern: str = "", first_only: bool = False
) -> DataFrame | None:
    """The latest batch as a DataFrame, None when no file matches.  Spark reads the folder itself and picks the files by their
    names; only where `pattern` does not lie within a file name are the paths listed for it."""
    from kinweave.sources.readers import read_entities

    pattern = pattern or "."
    found = latest_folder(spark, base, pattern)
    if found is None:
        return None
    folder, recursive = found
    if first_only or "/" in pattern or pattern in folder:
        return read_entities(spark, [_literal(f) for f in latest_batch(spark, base, pattern, first_only)], fmt, schema)
    options = {"pathGlobFilter": f"*{_literal(pattern)}*", "recursiveFileLookup": str(recursive).lower()}
    return read_entities(spark, _literal(folder), fmt, schema, **options)
