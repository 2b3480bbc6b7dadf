"""Which records bear which signature: an inverted index that grows with every batch.

A record bears one signature per exact rule, and those of `signature_sides` per fuzzy rule; two
records that a rule can match share one.  A batch is looked up by its own signatures, so
neither the fields of what is loaded are read nor their signatures made again.  The index also holds the
members of every group, under a signature of the group.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators.exact import all_present
from kinweave.operators.similarity import signature_sides
from kinweave.plans.rules import Rule, spread
from kinweave.sinks.versions import Versioned
from kinweave.sources.tables import text_literal

# Roles that a signature is stored under: equal keys, the longer and the shorter of two values, a group.
SAME, LONG, SHORT, GROUP = "same", "long", "short", "group"
PART = "kw_part"
# Parts that one table may have before they are put together.
PARTS = 16


def _digest(fields: Sequence[Column]) -> Column:
    """128 bits that stand for some values."""
    return F.unhex(F.md5(F.to_json(F.array(*[f.cast("string") for f in fields]))))


def signatures(rows: DataFrame, id_col: str, rules: Sequence[Rule], sought: bool = False) -> DataFrame:
    """(h, p, id): signatures of records, `p` standing for the values that the rule compares.

    They are given as stored or as `sought`: a value meets in the role of the longer one those stored as the
    shorter one, and the other way round.
    """
    parts = []
    for number, rule in enumerate(rules):
        given = spread(rows, id_col, rule.names).where(all_present(rule.names))
        if not rule.fuzzy:
            keys = [F.col(n) for n in rule.names]
            parts.append(given.select(F.xxhash64(F.lit(number), F.lit(SAME), *keys).alias("h"), _digest(keys).alias("p"), F.col(id_col).alias("id")))
            continue
        sides = signature_sides(given.withColumnRenamed(id_col, "pid"), rule.exact, rule.fuzzy)
        for side, role in zip(sides, (SHORT, LONG) if sought else (LONG, SHORT)):
            values = [F.col(f"v.{n}") for n in rule.names]
            parts.append(side.select(F.xxhash64(F.lit(number), F.lit(role), "h").alias("h"), _digest(values).alias("p"), F.col("v.pid").alias("id")))
    return reduce(DataFrame.unionByName, parts).distinct()


def memberships(rows: DataFrame, id_col: str = "id", match_id: str = "match_id") -> DataFrame:
    """(h, p, id): every record under its group."""
    return rows.select(_group(F.col(match_id)).alias("h"), _digest([F.col(id_col)]).alias("p"), F.col(id_col).alias("id"))


def _group(match_id: Column) -> Column:
    return F.xxhash64(F.lit(-1), F.lit(GROUP), match_id)


class SignatureIndex(Versioned):
    """(h, p, id, live) bucketed by `h`; every version adds one part.

    A part says of a record which signatures it has got and which it has lost (`live` false); of
    several parts the newest counts.  Neither a lookup nor an addition shuffles what is
    stored.  Versions are those of the loaded table, so a repeated batch replaces its part.
    """

    def __init__(self, spark: SparkSession, root: str, id_col: str, rules: Sequence[Rule], buckets: int | None = None):
        super().__init__(spark, root)
        self.id_col, self.rules = id_col, list(rules)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def start(self, loaded: DataFrame, version: int) -> None:
        """The first version, of a loaded table that may hold rows already."""
        if not loaded.isEmpty():
            found = signatures(loaded, self.id_col, self.rules).unionByName(memberships(loaded, self.id_col))
            return self.add(found.withColumn("live", F.lit(True)), version)
        kind = loaded.schema[self.id_col].dataType.simpleString()
        self._commit(version, {"token": uuid.uuid4().hex, "buckets": self.buckets, "id": kind, "files": {}})

    def add(self, entries: DataFrame, version: int) -> None:
        """Write (h, p, id, live) as the part of a version, and put parts together where there are many."""
        earlier = [v for v in self.versions() if v < version]
        base = self._manifest(max(earlier)) if earlier else {"buckets": self.buckets, "files": {}}
        files = dict(base["files"])
        if len(files) >= PARTS:
            entries = _newest(self._open(base).unionByName(entries.withColumn(PART, F.lit(version)))).where("live")
            files = {}
        token = uuid.uuid4().hex
        stage = f"kinweave_stage_{token}"
        placed = entries.select("h", "p", "id", "live").repartition(base["buckets"], "h")
        placed.write.format("parquet").bucketBy(base["buckets"], "h").option("path", f"{self.root}/data/{token}").saveAsTable(stage)
        self.spark.sql(f"DROP TABLE {stage}")
        kind = entries.schema["id"].dataType.simpleString()
        self._commit(version, {"token": uuid.uuid4().hex, "buckets": base["buckets"], "id": kind, "files": {**files, version: f"data/{token}"}})

    def _open(self, manifest: dict) -> DataFrame:
        name = self._table_name(manifest)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} (h BIGINT, p BINARY, id {manifest['id']}, live BOOLEAN, {PART} INT) USING parquet "
                f"PARTITIONED BY ({PART}) CLUSTERED BY (h) INTO {manifest['buckets']} BUCKETS LOCATION {text_literal(f'{self.root}/data')}"
            )
            places = [f"PARTITION ({PART} = {v}) LOCATION {text_literal(f'{self.root}/{p}')}" for v, p in manifest["files"].items()]
            if places:
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(places)}")
        return self.spark.table(name).where(F.col(PART) >= 0)

    def find(self, sought: DataFrame, version: int | None = None) -> DataFrame:
        """(h, p, id): live entries under the hashes `h` of `sought`."""
        stored = self._open(self._manifest(self.versions()[-1] if version is None else version))
        return _newest(stored.join(sought.select("h").distinct(), "h", "left_semi")).where("live").select("h", "p", "id")

    def near(self, batch: DataFrame, version: int | None = None) -> DataFrame:
        """(id): for every signature of the batch, one record of each combination of values that bears it.

        Records with equal values are linked already, so the smallest of them stands for all.
        """
        found = self.find(signatures(batch, self.id_col, self.rules, sought=True), version)
        return found.groupBy("h", "p").agg(F.min("id").alias(self.id_col)).select(self.id_col).distinct()

    def members(self, groups: DataFrame, version: int | None = None) -> DataFrame:
        """(id): the records of the groups in the only column of `groups`, and few others."""
        found = self.find(groups.select(_group(F.col(groups.columns[0])).alias("h")), version)
        return found.select(F.col("id").alias(self.id_col)).distinct()

    def prune(self, keep: int = 2) -> list[int]:
        """Delete all but the newest `keep` versions, and what only they name."""
        return self._drop_old(keep)


def _newest(entries: DataFrame) -> DataFrame:
    """What the newest part says of each entry; within a part, having a signature outweighs losing it."""
    last = F.max(F.struct(PART, "live"))
    return entries.groupBy("h", "p", "id").agg(last.alias("last")).select("h", "p", "id", "last.live")
