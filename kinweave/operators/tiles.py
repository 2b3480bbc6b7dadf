"""Crowds of rows that agree in fields with few values: what links them, without all their pairs.

Rows meet in blocks: under equal exact fields and a pair of values, equal or similar, of each field
that is compared value by value.  A block with many pairs is cut into tiles of a bounded size,
and a task compares all rows of a tile (`tile_search`), but gives only a best pair of each row
and a forest.  So the output grows with the rows, although each two of a block are compared.  Blocks
with few pairs are joined as elsewhere: a tile costs some milliseconds whatever it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators import tile_search
from kinweave.operators.similarity import FuzzyField, Plan, _lettered, _row, _verified
from kinweave.session import cut

cloudpickle.register_pickle_by_value(tile_search)

# A block is cut into tiles from so many pairs on, and blocks are tiled where they have so many in all.
TILED_PAIRS = 10_000
WORTH_TILING = 20_000_000
# Rows on a side of a tile, and characters.
TILE_ROWS, TILE_CHARS = 4_096, 1 << 19
# Pairs compared by one task: some 5 seconds.
TASK_PAIRS = 200_000_000


def blocks(rows: DataFrame, exact: Sequence[str], few: Sequence[tuple[FuzzyField, DataFrame]]) -> DataFrame:
    """(exact fields, fields in `few`, _h, _g, _twin, _ahead, _l, _s, _pairs, _d0, _n0, ...), cut: the blocks that rows
    with these values are in.

    `_h` and `_g` are two hashes of the block, which tell it apart.  Of two combinations of values that meet
    the smaller one is `_ahead`; a `_twin` block holds one combination only.  `_l` and `_s` count the
    rows of both sides, `_d0` and `_n0` are the edits between the two values of the first field and the longer length.
    """
    names = [f.name for f, _ in few]
    kinds = rows.groupBy(*exact, *names).agg(F.count(F.lit(1)).alias("_rows"))
    for number, (field, near) in enumerate(few):
        own, other = F.col(field.name), F.col(f"_p{number}")
        met = near.select(own, F.explode("partners").alias(f"_p{number}")).select(
            "*", F.levenshtein(own, other).alias(f"_d{number}"), F.greatest(F.length(own), F.length(other)).alias(f"_n{number}"))
        # As many rows as few values have partners: known to be small.
        kinds = kinds.join(F.broadcast(met), field.name)
    own, partner = F.array(*names), F.array(*[f"_p{i}" for i in range(len(few))])
    ends = [*exact, F.when(own <= partner, own).otherwise(partner), F.when(own <= partner, partner).otherwise(own)]
    numbers = [f"_{c}{i}" for i in range(len(few)) for c in "dn"]
    kinds = kinds.select(
        *exact, *names, *numbers, "_rows", (own == partner).alias("_twin"), (own <= partner).alias("_ahead"),
        F.xxhash64(F.lit("block"), *ends).alias("_h"), F.xxhash64(F.lit("check"), *ends).alias("_g"))
    kinds = cut(kinds, "kinds")
    ahead, behind = (F.coalesce(F.sum(F.when(side, F.col("_rows"))), F.lit(0)) for side in (F.col("_ahead"), ~F.col("_ahead")))
    sizes = kinds.groupBy("_h", "_g").agg(ahead.alias("_l"), behind.alias("_s"))
    pairs = F.when(F.col("_twin"), F.col("_l").cast("double") * (F.col("_l") - 1) / 2).otherwise(F.col("_l").cast("double") * F.col("_s"))
    return cut(kinds.join(sizes, ["_h", "_g"]).withColumn("_pairs", pairs).where("_pairs > 0").drop("_rows"), "blocks")


def _tiled(rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], plan: Plan, held: DataFrame, side: int) -> DataFrame:
    """The rows of the blocks `held` under each tile (`_h`, `_g`, `_i`, `_j`) that they are in, on its `_right` side or not.

    A side is cut into as many parts as keep `side` rows each, and every part meets all of the other side.
    """
    few, others = plan
    names = [f.name for f, _ in few]
    parts = {c: F.ceil(F.col(c) / F.lit(side)).cast("int") for c in ("_l", "_s")}
    own = F.when(F.col("_ahead"), parts["_l"]).otherwise(parts["_s"])
    theirs = F.when(F.col("_twin") | ~F.col("_ahead"), parts["_l"]).otherwise(parts["_s"])
    placed = rows.join(held.drop("_pairs"), [*exact, *names]).withColumns(
        {"_c": F.pmod(F.xxhash64("pid", F.lit("part")), own).cast("int"), "_theirs": theirs}).withColumn(
        "_e", F.explode(F.sequence(F.lit(0), F.col("_theirs") - 1)))
    c, e = F.col("_c"), F.col("_e")
    first = F.when(F.col("_twin"), F.least(c, e)).when(F.col("_ahead"), c).otherwise(e)
    second = F.when(F.col("_twin"), F.greatest(c, e)).when(F.col("_ahead"), e).otherwise(c)
    right = F.when(F.col("_twin"), c > e).otherwise(~F.col("_ahead"))
    return placed.select(
        "_h", "_g", first.alias("_i"), second.alias("_j"), right.alias("_right"), "_twin", "pid",
        *[f"_{c}{i}" for i in range(len(few)) for c in "dn"], *[F.col(f.name).alias(f"_o{i}") for i, f in enumerate(others)])


def _searched(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], min_score: float, plan: Plan, held: DataFrame, pairs: float
) -> DataFrame:
    """(id_a, id_b, score): what links the rows of the blocks `held`, and a best pair of each."""
    import pyarrow as pa

    few, others = plan
    longest = max([rows.agg(F.max(F.length(f.name))).first()[0] or 1 for f in others], default=1)
    side = max(64, min(TILE_ROWS, TILE_CHARS // max(longest, 1)))
    known, opened = {f.name: i for i, (f, _) in enumerate(few)}, {f.name: i for i, f in enumerate(others)}
    places = [("known", known[f.name]) if f.name in known else ("open", opened[f.name]) for f in fuzzy]
    kind = rows.schema["pid"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("id_a", to_arrow_type(kind)), ("id_b", to_arrow_type(kind)), ("score", pa.float64())])
    run = tile_search.searcher(places, [f.threshold for f in others], len(few), len(exact), min_score, schema)
    width = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(int(pairs / TASK_PAIRS), 20_000))
    dealt = _tiled(rows, exact, fuzzy, plan, held, side).repartition(width, *tile_search.KEY).sortWithinPartitions(*tile_search.KEY, "_right")
    found = dealt.mapInArrow(run, f"id_a {kind.simpleString()}, id_b {kind.simpleString()}, score double")
    return found.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "score")


def _joined(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], min_score: float, plan: Plan, held: DataFrame
) -> DataFrame:
    """(id_a, id_b, score): all similar pairs of the blocks `held`."""
    few, _ = plan
    paired = [f.name for f, _ in few]
    row = _row(exact, fuzzy, known=paired)
    placed = _lettered(rows, fuzzy, paired).join(held.select(*exact, *paired, "_h", "_twin", "_ahead"), [*exact, *paired])
    long_side = placed.where("_ahead").select("_h", "_twin", row.alias("a"))
    short_side = placed.where("_twin or not _ahead").select("_h", row.alias("b")).hint("merge")
    met = long_side.join(short_side, "_h").where(~F.col("_twin") | (F.col("a.pid") < F.col("b.pid")))
    return _verified(met, exact, fuzzy, min_score, known=paired)


def linked_blocks(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], min_score: float, plan: Plan,
    worth: float | None = None, tiled_pairs: float | None = None,
) -> DataFrame | None:
    """(id_a, id_b, score): some of the similar pairs of profile rows, with the same connected
    components as all of them and with a best pair of every row that has one; None where the
    blocks of the `plan` have too few pairs for tiles, or an id is no number or text."""
    worth = WORTH_TILING if worth is None else worth
    tiled_pairs = TILED_PAIRS if tiled_pairs is None else tiled_pairs
    few, _ = plan
    if not few or rows.schema["pid"].dataType.simpleString() not in ("string", "bigint", "int"):
        return None
    held = blocks(rows, exact, few)
    many = F.col("_pairs") >= F.lit(float(tiled_pairs))
    total, left = held.where("_ahead").agg(
        F.coalesce(F.sum(F.when(many, F.col("_pairs"))), F.lit(0.0)), F.count_if(~many)).first()
    if total < worth:
        return None
    found = _searched(rows, exact, fuzzy, min_score, plan, held.where(many), total)
    if not left:
        return found
    return found.unionByName(_joined(rows, exact, fuzzy, min_score, plan, held.where(~many)))
