"""Merge by key, versions of a keyed table, change feed."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.session import cut
from kinweave.sinks.versions import Versioned
from kinweave.sources.tables import quoted, text_literal

INSERT, UPDATE, DELETE, KEEP, REJECT = "INSERT", "UPDATE", "DELETE", "KEEP", "REJECT"
UPDATED = "LAST_UPDATED"


def one_per_key(source: DataFrame, key: str, order_by: str | None = None) -> DataFrame:
    """(key, s, n): one row of the source per key, and how many it had: the latest by
    `order_by`, where NULL comes before any value; without it a repeated key fails the job."""
    row = F.struct(*source.columns)
    if order_by:
        latest = F.struct(F.col(order_by).isNotNull(), F.col(order_by))
        return source.groupBy(key).agg(F.max_by(row, latest).alias("s"), F.count(F.lit(1)).alias("n"))
    repeated = F.concat(F.lit(f"merge source repeats {key} "), F.col(key).cast("string"))
    grouped = source.groupBy(key).agg(F.any_value(row).alias("s"), F.count(F.lit(1)).alias("n"))
    return grouped.select(key, F.when(F.col("n") == 1, F.col("s")).otherwise(F.raise_error(repeated)).alias("s"), "n")


def merge_rows(
    target: DataFrame, source: DataFrame, key: str, as_of: datetime | str,
    order_by: str | None = None, updated: str = UPDATED,
) -> DataFrame:
    """Target columns plus `action`: KEEP, UPDATE, INSERT, or REJECT for a NULL source key,
    `changed`: whether a row is new or has another value than before, and `superseded`: source
    rows of the key that a later one replaced.

    A matched row takes every value from the source, NULL included; a target column that
    the source lacks becomes NULL in it.  Both sides meet by key once: the source is
    grouped by key already, and a target bucketed by key is not shuffled.
    """
    have = set(source.columns)
    s = one_per_key(source.where(F.col(key).isNotNull()), key, order_by)
    t = target.select(F.col(key), F.struct(*target.columns).alias("t"))
    both = t.join(s, key, "full")
    in_t, in_s = F.col("t").isNotNull(), F.col("n").isNotNull()
    stamp = F.lit(str(as_of)).cast("timestamp_ntz")

    def value(name: str, stamped: Column) -> Column:
        kind = target.schema[name].dataType
        if name == key:
            return F.col(key)
        if name == updated:
            new = stamped
        elif name in have:
            new = F.col(f"s.{name}")
        else:
            new = F.lit(None)
        return F.when(in_s, new.cast(kind)).otherwise(F.col(f"t.{name}"))

    action = F.when(in_t & in_s, UPDATE).when(in_s, INSERT).otherwise(KEEP)
    superseded = F.coalesce(F.col("n") - 1, F.lit(0)).alias("superseded")
    values = [value(c, stamp).alias(c) for c in target.columns]
    changed = in_s & ~F.col("t").eqNullSafe(F.struct(*values))
    merged = both.select(*values, action.alias("action"), changed.alias("changed"), superseded)
    rejected = source.where(F.col(key).isNull()).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema], F.lit(REJECT).alias("action"),
        F.lit(False).alias("changed"), F.lit(0).cast("long").alias("superseded"),
    )
    return merged.unionByName(rejected)


def change_feed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """INSERT, UPDATE and DELETE rows between two snapshots, with the new values (the old
    ones of a deleted row).  Values compare null-safe, so NULL to NULL is no change."""
    o = old.select(F.col(key), F.struct(*new.columns).alias("o"))
    n = new.select(F.col(key), F.struct(*new.columns).alias("n"))
    both = o.join(n, key, "full")
    action = (
        F.when(F.col("o").isNull(), INSERT).when(F.col("n").isNull(), DELETE)
        .when(~F.col("o").eqNullSafe(F.col("n")), UPDATE)
    )
    rows = both.select(action.alias("action"), F.coalesce("n", "o").alias("r")).where("action is not null")
    return rows.select("action", "r.*")


# Columns that the files of a keyed table have besides its own: the bucket they lie in, and how
# the merge that wrote a row changed it.
BUCKET, ACTION = "kw_bucket", "kw_action"


class KeyedTable(Versioned):
    """A keyed table as a series of versions below one folder, bucketed by key.

    A version is a manifest that names one folder of files per bucket.  A merge rewrites the
    buckets that its source has keys in and takes the others over from the version before, so
    its cost goes with the buckets it touches.  The rows that a merge writes say how it
    changed them, so the changes between a version and the next are read from those buckets
    alone.  No reader sees half a merge, and a failed one leaves nothing behind that counts: a version
    counts once its manifest stands.  Neither a merge nor a comparison of versions shuffles the
    table, and `lookup` reads the buckets of its keys only.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int | None = None):
        super().__init__(spark, root)
        self.key = key
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # Reading.

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.hash(self.key), F.lit(buckets))

    def _open(self, manifest: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        """The files of a version, all or those of some buckets, with BUCKET and ACTION."""
        name = self._table_name(manifest)
        if not self.spark.catalog.tableExists(name):
            schema = T.StructType.fromJson(manifest["schema"])
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, {ACTION} STRING, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                f"CLUSTERED BY ({quoted(self.key)}) INTO {manifest['buckets']} BUCKETS LOCATION {text_literal(f'{self.root}/data')}"
            )
            places = [f"PARTITION ({BUCKET} = {b}) LOCATION {text_literal(f'{self.root}/{p}')}" for b, p in manifest["files"].items()]
            if places:
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(places)}")
        rows = self.spark.table(name)
        # A filter on the partition column, so that the optimizer learns the true sizes.
        return rows.where(F.col(BUCKET) >= 0 if buckets is None else F.col(BUCKET).isin(list(buckets)))

    def read(self, version: int | None = None) -> DataFrame | None:
        """A version, by default the newest; None when there is none."""
        known = self.versions()
        if not known:
            return None
        return self._open(self._manifest(known[-1] if version is None else version)).drop(BUCKET, ACTION)

    def _buckets_of(self, keys: DataFrame, buckets: int) -> list[int]:
        """The buckets that hold these keys: one number each reaches the driver."""
        found = keys.where(F.col(self.key).isNotNull()).select(self._bucket(buckets).alias(BUCKET)).distinct()
        return sorted(r[0] for r in found.collect())

    def lookup(self, keys: DataFrame, columns: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of these keys (a column named like the table's key); no other bucket is read.  Runs a job."""
        manifest = self._manifest(self.versions()[-1] if version is None else version)
        keys = keys.select(F.col(self.key).cast(T.StructType.fromJson(manifest["schema"])[self.key].dataType))
        rows = self._open(manifest, self._buckets_of(keys, manifest["buckets"])).drop(BUCKET, ACTION)
        return (rows.select(*columns) if columns is not None else rows).join(keys, self.key, "left_semi")

    # Writing.

    def _write_files(self, rows: DataFrame, buckets: int) -> dict[int, str]:
        """Write rows that lie by key, with their ACTION: the folder of each bucket that has any."""
        token = uuid.uuid4().hex
        stage = f"kinweave_stage_{token}"
        (
            rows.withColumn(BUCKET, self._bucket(buckets)).write.format("parquet").partitionBy(BUCKET)
            .bucketBy(buckets, self.key).option("path", f"{self.root}/data/{token}").saveAsTable(stage)
        )
        self.spark.sql(f"DROP TABLE {stage}")  # an external table: its files stay
        named = (re.fullmatch(rf"{BUCKET}=(\d+)", n) for n in self._names(f"data/{token}"))
        return {int(m[1]): f"data/{token}/{m[0]}" for m in named if m}

    def write(self, df: DataFrame, version: int | None = None) -> int:
        """Write a complete version, one file per bucket, and return its number."""
        if taken := {BUCKET, ACTION} & set(df.columns):
            raise ValueError(f"{sorted(taken)} are names that a keyed table needs for itself")
        if version is None:
            version = max(self.versions(), default=0) + 1
        files = self._write_files(df.repartition(self.buckets, self.key).withColumn(ACTION, F.lit(None).cast("string")), self.buckets)
        self._commit(version, {
            "token": uuid.uuid4().hex, "buckets": self.buckets, "schema": df.schema.jsonValue(), "files": files, "base": None, "touched": []})
        return version

    def merge(
        self, source: DataFrame, as_of: datetime | str, order_by: str | None = None,
        version: int | None = None, updated: str = UPDATED,
    ) -> dict[str, int]:
        """Merge into the newest version (the newest before `version`, when that is given,
        so that repeating a merge repeats its result) and write the next.

        Counters: inserted, updated, rejected, superseded by a later row of the same key, and
        total, which is the rows of the source.  They are taken in the writing stage
        itself, where a repeated task counts once.  The source is cut into a table first, as its
        keys say which buckets are read.
        """
        earlier = [v for v in self.versions() if version is None or v < version]
        if not earlier:
            raise RuntimeError(f"{self.root} has no version to merge into; create the target first")
        base = self._manifest(max(earlier))
        kind = T.StructType.fromJson(base["schema"])[self.key].dataType
        source = cut(source.withColumn(self.key, F.col(self.key).cast(kind)), "merge_source")
        touched = self._buckets_of(source, base["buckets"])
        target = self._open(base, touched).drop(BUCKET, ACTION)
        merged = merge_rows(target, source, self.key, as_of, order_by, updated)
        seen = Observation()
        counted = merged.observe(
            seen, *[F.count_if(F.col("action") == a).alias(n) for a, n in
                    ((INSERT, "inserted"), (UPDATE, "updated"), (REJECT, "rejected"))],
            F.coalesce(F.sum("superseded"), F.lit(0)).alias("superseded"),
        )
        counted = counted.withColumn(ACTION, F.when(F.col("changed"), F.col("action"))).where(F.col("action") != REJECT)
        files = self._write_files(counted.drop("action", "changed", "superseded"), base["buckets"])
        self._commit(max(earlier) + 1 if version is None else version, {
            **base, "token": uuid.uuid4().hex, "files": {**base["files"], **files}, "base": base["token"], "touched": touched})
        counts = {k: seen.get[k] for k in ("inserted", "updated", "rejected", "superseded")}
        counts["total"] = sum(counts.values())
        return counts

    def prune(self, keep: int = 2) -> list[int]:
        """Delete all but the newest `keep` versions, and give their numbers.  Files that a newer
        version has taken over stay; those that none names, of failed writes too, go."""
        return self._drop_old(keep)

    def changes(self, old: int, new: int) -> DataFrame:
        """INSERT, UPDATE and DELETE rows between two versions: what the merge noted, where `new` was merged
        into `old`, else a comparison of the buckets that differ."""
        before, after = self._manifest(old), self._manifest(new)
        if after["base"] == before["token"]:
            rows = self._open(after, after["touched"]).where(F.col(ACTION).isNotNull())
            return rows.select(F.col(ACTION).alias("action"), *[c for c in rows.columns if c not in (BUCKET, ACTION)])
        differ = None
        if before["buckets"] == after["buckets"]:
            every = before["files"].keys() | after["files"].keys()
            differ = sorted(b for b in every if before["files"].get(b) != after["files"].get(b))
        return change_feed(*[self._open(m, differ).drop(BUCKET, ACTION) for m in (before, after)], self.key)
