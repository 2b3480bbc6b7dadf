"""Shards of near equal bytes by a k-d tree over document metadata.

The tree cuts a node of m shards at the weighted median of its widest dimension (the
weighted l/m quantile where m is odd), until a node is one shard, that is, until it holds
the target bytes.  Weights are bytes.  A cut is found exactly, without sorting and without
moving rows: rounds of histograms over ever narrower ranges, for all nodes of a level at
once, close in on the one row in which the wanted byte falls.  The driver holds a node per
shard and the range it searches.  A level writes which node each row is in; no round reads a text.

A shard's place in the tree bounds its metadata, so a reader that asks for a source or a
range of lengths skips whole shards by the statistics of their files.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.session import cut

#: Histogram bars of a node and round; a search over 2**60 values takes five rounds.
BARS = 4096
#: Rows that are numbered together, about.
NUMBERED = 8192
OVERHEAD = 8
#: Numbers beyond this count as this, so that no difference leaves 64 bits.
FAR = 1 << 61
STRING_BYTES = 7


@dataclass
class Node:
    """A part of the tree: `leaves` shards from number `first`; the rest once it is cut."""

    first: int
    leaves: int
    bytes: int = 0
    dim: int = 0
    at: tuple[int, int, int] | None = None
    inclusive: bool = False
    left: int | None = None
    right: int | None = None


def byte_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(OVERHEAD)


def _near(number: Column) -> Column:
    return F.greatest(F.lit(-FAR), F.least(F.lit(FAR), number))


def _plain(column: Column, kind: T.DataType) -> Column | None:
    """A dimension as a whole number or a text; fractions stay doubles; None where it has no order of use."""
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        number = column.cast("double")
        return F.when(~F.isnan(number), F.greatest(F.lit(-1e300), F.least(F.lit(1e300), number)))
    if isinstance(kind, T.BooleanType):
        return column.cast("long")
    if isinstance(kind, T.IntegralType):
        return _near(column.cast("long"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return _near(F.unix_micros(column))
    if isinstance(kind, T.TimestampNTZType):
        return _near(F.unix_micros(column.cast("timestamp")))
    return None


def _coordinate(column: Column, low: object, high: object) -> Column:
    """Whole numbers in the order of the values, NULL before all: of a text, seven bytes from
    the first byte in which the least and the greatest value differ."""
    if low is None:
        return F.lit(-1).cast("long")
    if isinstance(low, str):
        a, b = low.encode(), high.encode()
        same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        digits = F.hex(F.substring(column.cast("binary"), same + 1, STRING_BYTES))
        return F.coalesce(F.conv(F.rpad(digits, 2 * STRING_BYTES, "0"), 16, 10).cast("long"), F.lit(-1))
    if isinstance(low, float):
        reach = high / 2 - low / 2
        scaled = F.floor((column / 2 - F.lit(low / 2)) / F.lit(reach or 1.0) * F.lit(float(1 << 40))).cast("long")
        return F.coalesce(scaled, F.lit(-1))
    return F.coalesce(column, F.lit(low - 1))


def _tie(key: Column, kind: T.DataType) -> Column:
    """The order of rows with equal coordinates: by key, NULL last."""
    number = _near(key.cast("long")) if isinstance(kind, T.IntegralType) else F.shiftright(F.xxhash64(key.cast("string")), 2)
    return F.when(key.isNotNull(), number).otherwise(F.lit(FAR + 1))


def _table(rows: list[dict], schema: str) -> Column:
    """A list that the driver holds, as a constant that rows look things up in."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")


def _coordinate_of(dim: Column, dims: int) -> Column:
    return F.coalesce(*[F.when(dim == i, F.col(f"b_{i}")) for i in range(dims)], F.lit(0).cast("long"))


def _descended(rows: DataFrame, tree: list[Node], dims: int) -> DataFrame:
    """`rows` with each `node` that is cut replaced by the one of its halves in which the row lies."""
    cuts = _table(
        [{} if n.at is None else {"dim": n.dim, "c": n.at[0], "k": n.at[1], "r": n.at[2] + n.inclusive, "left": n.left, "right": n.right}
         for n in tree],
        "dim int, c long, k long, r long, left int, right int",
    )
    looked = rows.withColumn("t", F.get(cuts, F.col("node"))).withColumn("v", _coordinate_of(F.col("t.dim"), dims))
    before = F.expr("v < t.c or (v = t.c and (b_key < t.k or (b_key = t.k and b_row < t.r)))")
    node = F.when(F.col("t.left").isNull(), F.col("node")).when(before, F.col("t.left")).otherwise(F.col("t.right"))
    return looked.withColumn("node", node).drop("t", "v")


@dataclass
class Search:
    """The range of a node in which its cut lies: component `part` of (coordinate, key, row) within
    [`low`, `high`], the components before it being `fixed`; `before` bytes lie below."""

    want: int
    part: int
    low: int
    high: int
    fixed: list[int]
    before: int = 0

    def narrowed(self, lows: list[int], highs: list[int]) -> Search:
        part = self.part
        fixed = list(self.fixed)
        while part < 2 and lows[part] == highs[part]:
            fixed.append(lows[part])
            part += 1
        return Search(self.want, part, lows[part], highs[part], fixed, self.before)


def _split_level(rows: DataFrame, tree: list[Node], dims: int, extents: list[tuple[int, int]] | None) -> list[tuple[int, int]] | None:
    """Cut every node of more than one shard that has rows.  Runs jobs."""
    rows = rows.where(F.get(_table([{"open": n.leaves > 1} for n in tree], "open boolean"), F.col("node"))["open"])
    ranges = [f(f"b_{c}").alias(f"{n}_{c}") for c in [*range(dims), "key", "row"] for n, f in (("lo", F.min), ("hi", F.max))]
    found = rows.groupBy("node").agg(F.sum("b_size").alias("bytes"), *ranges).collect()
    searches: dict[int, Search] = {}
    for row in found:
        node = tree[row.node]
        here = [(row[f"lo_{i}"], row[f"hi_{i}"]) for i in range(dims)]
        extents = extents or here
        widths = [float(h - lo) / float(b - a) if b > a else 0.0 for (lo, h), (a, b) in zip(here, extents)]
        node.dim = widths.index(max(widths)) if widths else 0
        lows = [here[node.dim][0] if dims else 0, row.lo_key, row.lo_row]
        highs = [here[node.dim][1] if dims else 0, row.hi_key, row.hi_row]
        want = row.bytes * (node.leaves // 2) // node.leaves
        searches[row.node] = Search(want, 0, lows[0], highs[0], []).narrowed(lows, highs)
        node.bytes = row.bytes
    while searches:
        state = _table(
            [{} if (s := searches.get(i)) is None else
             {"dim": n.dim, "want": s.want, "part": s.part, "low": s.low, "high": s.high, "width": (s.high - s.low) // BARS + 1,
              "f0": (s.fixed + [0, 0])[0], "f1": (s.fixed + [0, 0])[1], "before": s.before} for i, n in enumerate(tree)],
            "dim int, want long, part int, low long, high long, width long, f0 long, f1 long, before long",
        )
        looked = rows.withColumn("s", F.get(state, F.col("node"))).where("s.part is not null").withColumn("v0", _coordinate_of(F.col("s.dim"), dims))
        looked = looked.withColumn("v", F.expr("case s.part when 0 then v0 when 1 then b_key else b_row end"))
        looked = looked.where("(s.part = 0 or (v0 = s.f0 and (s.part = 1 or b_key = s.f1))) and v between s.low and s.high")
        bars = looked.groupBy("node", F.expr("(v - s.low) div s.width").alias("bar")).agg(
            F.sum("b_size").alias("bytes"), F.count(F.lit(1)).alias("n"),
            *[f(c).alias(f"{n}{i}") for i, c in enumerate(("v0", "b_key", "b_row")) for n, f in (("lo", F.min), ("hi", F.max))],
        )
        upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("bar")) + F.get(state, F.col("node"))["before"]
        hits = bars.withColumn("after", upto).where(
            (F.col("after") > F.get(state, F.col("node"))["want"]) & (F.col("after") - F.col("bytes") <= F.get(state, F.col("node"))["want"])
        ).collect()
        for hit in hits:
            search, node = searches[hit.node], tree[hit.node]
            search.before = hit.after - hit.bytes
            lows, highs = [hit.lo0, hit.lo1, hit.lo2], [hit.hi0, hit.hi1, hit.hi2]
            if hit.n > 1:
                searches[hit.node] = search.narrowed(lows, highs)
                continue
            # The row in which the wanted byte lies goes to the side that it makes more even.
            half = node.leaves // 2
            node.at, node.inclusive = tuple(lows), node.leaves * (2 * search.before + hit.bytes) <= 2 * half * node.bytes
            node.left, node.right = len(tree), len(tree) + 1
            tree += [Node(node.first, half), Node(node.first + half, node.leaves - half)]
            del searches[hit.node]
    return extents


def shards(
    docs: DataFrame, count: int | None = None, target_bytes: int | None = None, dimensions: Sequence[str] = ("source", "lang", "n_chars"),
    key: str = "doc_id", text: str = "text", carry: Sequence[str] | None = None,
) -> DataFrame:
    """The columns of `docs` (of `carry`, if given), and `place`: a struct of size, shard and slot.

    `count` shards of near equal bytes, or as many as the whole needs at `target_bytes` each.
    `size` is the text's UTF-8 bytes plus 8.  Every cut is within half a document of its
    quantile.  `slot` numbers a shard's rows from 0, in the order of an MD5 of the key, so a shard reads its
    documents shuffled; rows are numbered in groups of bounded size.

    Defined cases: NULL text has no bytes; NULL in a dimension comes first, a dimension that
    the table lacks or that has no order is left out; rows with equal coordinates lie in the
    order of their keys (NULL last), equal keys in that of the table, so copies and one hot
    value are cut like all else; equal texts need not share a shard; fewer rows than shards leave shards empty; an
    empty table gives no rows; clashing names are kept, as the result is one struct, called
    `_place` if `place` is taken.  Runs jobs.
    """
    if (count is None) == (target_bytes is None):
        raise ValueError("give either count or target_bytes")
    if (target_bytes if count is None else count) < 1:
        raise ValueError("count and target_bytes must be at least 1")
    carry = list(docs.columns if carry is None else carry)
    plain = [p for d in dimensions if d in docs.columns and (p := _plain(F.col(d), docs.schema[d].dataType)) is not None]
    ends = [f(p).alias(f"{n}{i}") for i, p in enumerate(plain) for n, f in (("lo", F.min), ("hi", F.max))]
    seen = docs.agg(F.count(F.lit(1)).alias("n"), *ends).first()
    tie = _tie(F.col(key), docs.schema[key].dataType)
    base = cut(
        docs.select(
            *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], byte_size(F.col(text)).alias("b_size"), tie.alias("b_key"),
            F.col(key).cast("string").alias("b_name"), F.monotonically_increasing_id().alias("b_row"),
            *[_coordinate(p, seen[f"lo{i}"], seen[f"hi{i}"]).alias(f"b_{i}") for i, p in enumerate(plain)],
        ),
        "shard_rows",
    )
    if count is None:
        count = max(1, round((base.agg(F.sum("b_size")).first()[0] or 0) / target_bytes))
    tree, extents, dims = [Node(0, count)], None, len(plain)
    rows = base.select("b_size", "b_key", "b_name", "b_row", *[f"b_{i}" for i in range(dims)], F.lit(0).alias("node"))
    while True:
        parts = len(tree)
        extents = _split_level(rows, tree, dims, extents)
        if len(tree) == parts:
            break
        rows = cut(_descended(rows, tree, dims), "shard_level")
    shard = F.get(_table([{"first": n.first} for n in tree], "first int"), F.col("node"))["first"]
    numbered = _numbered(rows.select("b_key", "b_name", "b_row", shard.alias("shard")), seen.n, count)
    return base.join(numbered.select("b_row", "shard", "slot"), "b_row").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
        F.struct(F.col("b_size").alias("size"), "shard", "slot").alias("place" if "place" not in carry else "_place"),
    )


def _numbered(rows: DataFrame, n: int, count: int) -> DataFrame:
    """`rows` with `slot`, gapless within each shard: groups of rows are counted, and rows
    numbered within a group from the sum of the groups before it.

    A group is a range of key digests; where one key has very many rows, it is such a range in one
    part of the table.
    """
    bits = max(0, math.ceil(math.log2(max(1, n / (count * NUMBERED)))))
    digest = F.md5(F.coalesce("b_name", F.concat(F.lit("null"), F.col("b_row").cast("string"))))
    rows = rows.withColumn("h", F.conv(F.substring(digest, 1, 13), 16, 10).cast("long"))
    rows = rows.withColumn("range", F.shiftright("h", 52 - bits)).withColumn("part", F.shiftright("b_row", 33))
    sizes = cut(rows.groupBy("shard", "range", "part").agg(F.count(F.lit(1)).alias("n")), "shard_counts")
    hot = sizes.groupBy("shard", "range").agg(F.sum("n").alias("n")).where(F.col("n") > 4 * NUMBERED)
    hot = cut(hot.select("shard", "range", F.lit(True).alias("hot")), "shard_hot")

    def grouped(df: DataFrame) -> DataFrame:
        marked = df.join(hot, ["shard", "range"], "left")
        return marked.withColumn("part", F.when(F.col("hot"), F.col("part")).otherwise(F.lit(-1))).drop("hot")

    groups = grouped(sizes).groupBy("shard", "range", "part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("range", "part")) - F.col("n")
    starts = cut(groups.select("shard", "range", "part", before.alias("start")), "shard_starts")
    place = F.row_number().over(Window.partitionBy("shard", "range", "part").orderBy("h", "b_key", "b_row")) - 1
    return grouped(rows).join(starts, ["shard", "range", "part"]).withColumn("slot", (F.col("start") + place).cast("long"))


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 1_000_000, place: str = "place") -> None:
    """A folder `shard=...` per shard, its files being runs of slots in order."""
    columns = [c for c in placed.columns if c != place]
    rows = placed.select(*columns, f"{place}.shard", f"{place}.slot").withColumn("run", F.floor(F.col("slot") / rows_per_file))
    rows.repartition("shard", "run").sortWithinPartitions("shard", "slot").drop("run").write.partitionBy("shard").parquet(path)
