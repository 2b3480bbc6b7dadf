"""Similarity join: pairs of records with equal exact fields and similar fuzzy fields.

No block is ever paired with itself in full.  Candidates come from an equi-join on
signatures that lose no pair (after Li, Deng and Feng, "Pass-Join", 2011): when at most k
edits separate two values, and the longer one is cut into k + 1 segments, one segment must
occur unchanged in the shorter one, close to its own position.  A signature shared by too
many records is split by the signatures of the next fuzzy field, and so on.

On large tables, fields with few distinct values are compared value by value beforehand.  A row
then asks under each of its values' partners, so only rows that are similar in all of these
fields meet, and each two of them once.

Rows under signatures are many times what the optimizer makes of the small table they come
from, so their joins are marked as merge joins: a broadcast of them would fill the driver.

Rows are first reduced to profiles (distinct combinations of the compared fields), so a
group of equal copies is one row here, whatever its size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.values import edit_budget, is_similar
from kinweave.operators.exact import all_present
from kinweave.session import cut

# A signature is split by the next field when it holds this many candidate pairs, and the
# pairs outnumber the finer signatures this many times.
SPLIT_PAIRS = 200_000
SPLIT_GAIN = 8
# Below this many pairs in all splittable signatures together, a split is not worth its jobs.
WORTH_SPLITTING = 20_000_000

# Above so many, crowded signatures are shuffled to the rows, not sent whole to every executor.
MANY_SIGNATURES = 100_000

# A leading field is chosen from about so many rows, whatever the table, and only where a
# table has this many pairs: it takes some seconds.  A signature's row costs as much as so
# many pairs that meet (16 and 0.7 microseconds of a core, as measured).
PLANNED_ROWS = 4_096
WORTH_PLANNING = 2_000_000_000
SIGNATURE_COST = 20
# What a pair in a tile costs, as measured: about 50 nanoseconds.
TILED_COST = 1 / 14

# On such tables, fields with so few distinct values are compared value by value first, unless a
# value has more partners than that on average: each makes a row.
FEW_VALUES = 2_000
MANY_PARTNERS = 8

# Characters are told apart by their codes modulo this: digits and small letters nearly all are.
LETTERS = 37

# What rows may be marked with: the component they are known to be of, or whether they still
# ask for partners.
ROOT, ASKS = "_root", "_asks"


@dataclass(frozen=True)
class FuzzyField:
    name: str
    threshold: float

    def __post_init__(self) -> None:
        if not 0.0 < self.threshold < 1.0:
            raise ValueError(f"threshold of {self.name} must lie between 0 and 1")


def profiles(df: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """Distinct combinations of `fields` with the smallest and the greatest id that has each
    (`pid`, `last`)."""
    return (
        df.where(all_present(fields)).groupBy(*fields)
        .agg(F.min(id_col).alias("pid"), F.max(id_col).alias("last"))
    )


def copy_links(df: DataFrame, id_col: str, fields: Sequence[str], distinct_rows: DataFrame) -> DataFrame:
    """(id_a, id_b, score): every profile's smallest id with the other ids of the profile."""
    shared = distinct_rows.where("pid < last").select(*fields, F.col("pid").alias("id_a"))
    rows = df.where(all_present(fields)).select(F.col(id_col).alias("id_b"), *fields)
    links = rows.join(shared, list(fields)).where("id_b > id_a")
    return links.select("id_a", "id_b", F.lit(1.0).alias("score"))


def _segment(longer: Column, budget: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of segment `i` when `longer` characters make budget + 1."""
    parts = budget + 1
    size = F.floor(longer / parts).cast("int")
    extra_from = parts - (longer - size * parts)
    start = i * size + F.greatest(F.lit(0), i - extra_from)
    return start, size + (i >= extra_from).cast("int")


def _count_up(first: Column, last: Column) -> Column:
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _deletions(c: Column, longer: Column) -> Column:
    """(i, s) for the value without its character `i`, for every character."""
    return F.transform(F.sequence(F.lit(0), F.length(c) - 1), lambda i: F.struct(i.alias("i"), F.xxhash64(
        longer, F.lit(-1), F.concat(F.substring(c, F.lit(1), i), F.substring(c, i + 2, F.length(c)))).alias("s")))


def segment_signatures(c: Column, threshold: float, fine: bool = False) -> Column:
    """(i, s) for every segment of a value in the role of the longer one.

    With `fine`, a value that may differ by one edit shows what a deletion leaves of it
    instead: more signatures, but nearly every pair that shares one is similar.
    """
    longer = F.length(c)
    budget = edit_budget(longer, threshold)

    def one(i: Column) -> Column:
        start, size = _segment(longer, budget, i)
        return F.struct(i.alias("i"), F.xxhash64(longer, i, F.substring(c, start + 1, size)).alias("s"))

    segments = F.transform(F.sequence(F.lit(0), budget), one)
    return F.when(budget == 1, _deletions(c, longer)).otherwise(segments) if fine else segments


def substring_signatures(c: Column, threshold: float, fine: bool = False) -> Column:
    """(i, s) for a value in the role of the shorter one: for every longer length in reach,
    every substring that can be one of its segments.

    With `fine`, where a longer value may differ by one edit, what a deletion leaves: of
    this value at the same length, the value itself at one less.
    """
    own = F.length(c)

    def for_length(longer: Column) -> Column:
        budget = edit_budget(longer, threshold)
        gap = longer - own

        def for_segment(i: Column) -> Column:
            start, size = _segment(longer, budget, i)
            first = F.greatest(F.lit(0), start - F.floor((budget + gap) / 2).cast("int"))
            last = F.least(own - size, start + F.floor((budget - gap) / 2).cast("int"))
            return F.transform(_count_up(first, last), lambda at: F.struct(
                i.alias("i"), F.xxhash64(longer, i, F.substring(c, at + 1, size)).alias("s")))

        segments = F.flatten(F.transform(F.sequence(F.lit(0), budget), for_segment))
        if not fine:
            return segments
        itself = F.array(F.struct(F.lit(0).alias("i"), F.xxhash64(longer, F.lit(-1), c).alias("s")))
        left = F.when(gap == 0, _deletions(c, longer)).when(gap == 1, itself)
        return F.when((budget == 1) & (gap <= 1), left).otherwise(segments)

    return F.array_distinct(F.flatten(F.transform(F.sequence(own, _reach(c, threshold)), for_length)))


def _reach(c: Column, threshold: float) -> Column:
    """The greatest length a similar value can have."""
    return F.floor(F.length(c) / F.lit(threshold) + F.lit(1e-9)).cast("int")


def signature_count(c: Column, threshold: float) -> Column:
    """At most this many signatures in both roles, without making them."""
    parts = edit_budget(_reach(c, threshold), threshold) + 1
    return (_reach(c, threshold) - F.length(c) + 1) * parts * parts + parts


def letters(c: Column) -> Column:
    """A bit for each character that occurs, by its code modulo `LETTERS`: an edit changes two at most."""
    at = F.transform(_count_up(F.lit(1), F.length(c)), lambda i: F.pmod(F.ascii(F.substring(c, i, F.lit(1))), F.lit(LETTERS)))
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return F.aggregate(at, none, lambda found, bit: found.bitwiseOR(F.call_function("shiftleft", one, bit)))


def pair_score(a: str, b: str, exact: Sequence[str], fuzzy: Sequence[FuzzyField], budgets: dict[str, Column]) -> Column:
    """Mean of the field scores, an exact field scoring 1, rounded to 6 places.  The values of each
    field are known to differ by no more than its budget."""
    total: Column = F.lit(float(len(exact)))
    for f in fuzzy:
        x, y = F.col(f"{a}.{f.name}"), F.col(f"{b}.{f.name}")
        share = F.call_function("levenshtein", x, y, budgets[f.name]) / F.greatest(f"{a}.n_{f.name}", f"{b}.n_{f.name}")
        total = total + F.when(x == y, F.lit(1.0)).otherwise(F.lit(1.0) - share)
    return F.round(total / F.lit(float(len(exact) + len(fuzzy))), 6)


def _lettered(rows: DataFrame, fuzzy: Sequence[FuzzyField], known: Sequence[str] = ()) -> DataFrame:
    """Profiles with the `letters` of the fields that are not known to be similar, before rows are multiplied."""
    return rows.withColumns({f"_m_{f.name}": letters(F.col(f.name)) for f in fuzzy if f.name not in known})


def _row(exact: Sequence[str], fuzzy: Sequence[FuzzyField], mark: str | None = None, known: Sequence[str] = ()) -> Column:
    """A lettered profile as a struct; lengths and edit budgets are worked out here, once per row,
    so that the test of a pair stays small enough to be compiled well."""
    cols = {c: F.col(c) for c in ["pid", *exact, *([mark] if mark else [])]}
    for f in fuzzy:
        length = F.length(f.name)
        cols |= {f.name: F.col(f.name), f"n_{f.name}": length, f"k_{f.name}": edit_budget(length, f.threshold)}
        if f.name not in known:
            cols[f"m_{f.name}"] = F.col(f"_m_{f.name}")
    return F.named_struct(*[x for name, c in cols.items() for x in (F.lit(name), c)])


def _verified(
    joined: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], min_score: float, apart: bool = False,
    known: Sequence[str] = (),
) -> DataFrame:
    """Rows with structs `a` and `b` that pass every field test, as canonical pairs.

    The longer value has the larger budget, so the larger budget is that of the pair.
    Lengths and letters of all fields are compared before the first edit distance, which stops
    at the budget and answers -1 beyond it.  Fields in `known`, by which the rows met, come last.
    """
    test = F.col("a.pid") != F.col("b.pid")
    if apart:
        test = test & (F.col(f"a.{ROOT}") != F.col(f"b.{ROOT}"))
    for name in exact:
        test = test & (F.col(f"a.{name}") == F.col(f"b.{name}"))
    budgets = {f.name: F.greatest(f"a.k_{f.name}", f"b.k_{f.name}") for f in sorted(_by_threshold(fuzzy), key=lambda f: f.name in known)}
    for name, budget in budgets.items():
        test = test & (F.abs(F.col(f"a.n_{name}") - F.col(f"b.n_{name}")) <= budget)
    for name, budget in budgets.items():
        if name not in known:
            unlike = F.bit_count(F.col(f"a.m_{name}").bitwiseXOR(F.col(f"b.m_{name}")))
            test = test & (unlike <= budget * 2)
    for name, budget in budgets.items():
        a, b = F.col(f"a.{name}"), F.col(f"b.{name}")
        test = test & ((a == b) | (F.call_function("levenshtein", a, b, budget) >= 0))
    out = joined.where(test).select(
        F.least("a.pid", "b.pid").alias("id_a"), F.greatest("a.pid", "b.pid").alias("id_b"),
        pair_score("a", "b", exact, fuzzy, budgets).alias("score"),
    )
    return out.where(F.col("score") >= F.lit(min_score)) if min_score > 0 else out


def _first_meeting(level: int, field: FuzzyField) -> Column:
    """Whether a pair should meet here: equal values meet at their first segment only, and
    where both lengths are equal in one of the two possible roles only."""
    a, b = f"a.{field.name}", f"b.{field.name}"
    first = (F.col(f"i{level}") == 0) | (F.col(a) != F.col(b))
    la, lb = F.col(f"a.n_{field.name}"), F.col(f"b.n_{field.name}")
    if level == 0:
        return first & ((la > lb) | (F.col("a.pid") < F.col("b.pid")))
    return first & (F.col(f"left_longer{level}") | (la < lb))


def _join_sides(
    long_side: DataFrame, short_side: DataFrame, split: Sequence[FuzzyField], few: FuzzyField | None = None
) -> DataFrame:
    """Candidate pairs of the signatures over the fields split by so far; where rows are
    marked, those with an asking row.  `few`: the first field compared value by value, in whose
    place the signatures start with no field."""
    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.drop(ASKS).withColumnRenamed("v", "a").join(
            right.select("h", F.col("v").alias("b")).hint("merge"), "h")

    if ASKS in long_side.columns:
        met = meet(long_side.where(ASKS), short_side).unionByName(
            meet(long_side.where(~F.col(ASKS)), short_side.where(ASKS)))
    else:
        met = meet(long_side, short_side)
    if few:
        met = met.where((F.col(f"a.{few.name}") != F.col(f"b.{few.name}")) | (F.col("a.pid") < F.col("b.pid")))
    for level, field in enumerate(split, start=1 if few else 0):
        met = met.where(_first_meeting(level, field))
    return met


def _crowded(
    long_side: DataFrame, short_side: DataFrame, nxt: FuzzyField | None, split_pairs: int, split_gain: float
) -> DataFrame:
    """(h, pairs): signatures worth splitting by `nxt`, or crowded at all where no field is left."""
    fan = signature_count(F.col(f"v.{nxt.name}"), nxt.threshold) if nxt else F.lit(0)
    asks = (F.col(ASKS) if ASKS in long_side.columns else F.lit(True)).cast("int")
    sides = long_side.select(
        "h", F.lit(1).alias("l"), F.lit(0).alias("s"), asks.alias("la"), F.lit(0).alias("sa"), fan.alias("fan")
    ).unionByName(short_side.select(
        "h", F.lit(0).alias("l"), F.lit(1).alias("s"), F.lit(0).alias("la"), asks.alias("sa"), fan.alias("fan")))
    return _hot(sides.groupBy("h").agg(*[F.sum(c).alias(c) for c in ("l", "s", "la", "sa", "fan")]), split_pairs, split_gain)


def _hot(counts: DataFrame, split_pairs: int, split_gain: float) -> DataFrame:
    pairs = F.col("la").cast("double") * F.col("s") + (F.col("l") - F.col("la")).cast("double") * F.col("sa")
    enough = (pairs > F.lit(float(split_pairs))) & (pairs > F.lit(split_gain) * F.col("fan"))
    return counts.where(enough).select("h", pairs.alias("pairs"))


def _split_by(side: DataFrame, hot: DataFrame, field: FuzzyField, level: int, is_long: bool) -> DataFrame:
    """Rows of crowded signatures under a finer signature that also covers `field`.

    Which of two values is the longer one may differ from field to field, so each side
    shows `field` in both roles and the role is part of the finer signature.
    """
    value = F.col(f"v.{field.name}")
    as_longer = segment_signatures(value, field.threshold)
    as_shorter = substring_signatures(value, field.threshold)

    def with_role(signatures: Column, left_longer: bool) -> Column:
        return F.transform(signatures, lambda x: F.struct(x["i"], x["s"], F.lit(left_longer).alias("left_longer")))

    first, second = (as_longer, as_shorter) if is_long else (as_shorter, as_longer)
    both = F.concat(with_role(first, True), with_role(second, False))
    finer = side.join(hot, "h", "left_semi").select("*", F.explode(both).alias("x"))
    return finer.select(
        *[c for c in side.columns if c != "h"], F.xxhash64("h", "x.s", "x.left_longer").alias("h"),
        F.col("x.i").alias(f"i{level}"), F.col("x.left_longer").alias(f"left_longer{level}"),
    )


def _by_threshold(fuzzy: Sequence[FuzzyField]) -> list[FuzzyField]:
    """The highest threshold leaves the fewest edits, so the longest segments: it leads."""
    if not fuzzy:
        raise ValueError("a similarity join needs a fuzzy field; use exact links instead")
    return sorted(fuzzy, key=lambda f: -f.threshold)


def known_signatures(rows: DataFrame, field: FuzzyField, fine: bool = False) -> DataFrame:
    """(value, both lists of its signatures), cut: a value that many rows have is taken apart once.

    Spark broadcasts the table where its files are small, as with few values that most rows share.
    """
    value = F.col(field.name)
    return cut(rows.select(value).distinct().select(
        value, segment_signatures(value, field.threshold, fine).alias("as_longer"),
        substring_signatures(value, field.threshold, fine).alias("as_shorter")), "signatures")


def signature_sides(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], mark: str | None = None, fine: bool = False,
    lead: FuzzyField | None = None, known: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(h, v, i0) twice: every row `v` under its signatures in the role of the longer value
    and in that of the shorter one.  `h` covers the exact fields and the leading field, of
    which `i0` is the segment.  `known`: the `known_signatures` of that field, if made before."""
    lead = lead or _by_threshold(fuzzy)[0]
    base = F.xxhash64(*[F.col(c) for c in exact]) if exact else F.lit(0).cast("long")
    row, rows = _row(exact, fuzzy, mark), _lettered(rows, fuzzy)

    def side(role: str, signatures: Column) -> DataFrame:
        given = rows
        if known is not None:
            given, signatures = rows.join(known.select(lead.name, role), lead.name), F.col(role)
        exploded = given.select(row.alias("v"), base.alias("x"), F.explode(signatures).alias("y"))
        return exploded.select(F.xxhash64("x", "y.s").alias("h"), "v", F.col("y.i").alias("i0"))

    value = F.col(lead.name)
    return (
        side("as_longer", segment_signatures(value, lead.threshold, fine)),
        side("as_shorter", substring_signatures(value, lead.threshold, fine)),
    )


def partner_values(rows: DataFrame, field: FuzzyField) -> DataFrame:
    """(value, `partners`: all values similar to it, itself too), cut; meant for few values."""
    value = F.col(field.name)
    values = cut(rows.select(value).distinct(), "values")
    other = values.select(value.alias("other"))
    near = values.crossJoin(other).where(is_similar(value, F.col("other"), field.threshold))
    return cut(near.groupBy(field.name).agg(F.collect_list("other").alias("partners")), "partners")


def few_valued(rows: DataFrame, fuzzy: Sequence[FuzzyField]) -> list[tuple[FuzzyField, DataFrame]]:
    """The fields to be compared value by value, each with its `partner_values`."""
    counts = rows.agg(*[F.approx_count_distinct(f.name).alias(f.name) for f in fuzzy]).first()
    found = [(f, partner_values(rows, f)) for f in fuzzy if 0 < counts[f.name] <= FEW_VALUES]
    return [(f, near) for f, near in found if near.agg(F.avg(F.size("partners"))).first()[0] <= MANY_PARTNERS]


def paired_sides(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], few: Sequence[tuple[FuzzyField, DataFrame]],
    mark: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(h, v) twice: every row `v` under its values of the fields in `few` and each partner of
    them, as (own, partner) on one side and (partner, own) on the other.  Of the first field the
    smaller value is always on the one side, so rows that differ in it meet once."""
    paired = [f.name for f, _ in few]
    row, rows = _row(exact, fuzzy, mark, paired), _lettered(rows, fuzzy, paired)
    return tuple(_under_values(rows, exact, few, is_long).select("h", row.alias("v")) for is_long in (True, False))


def _under_values(
    rows: DataFrame, exact: Sequence[str], few: Sequence[tuple[FuzzyField, DataFrame]], is_long: bool
) -> DataFrame:
    """The rows of one of the `paired_sides`, with `h`."""
    keys = [F.col(c) for c in exact]
    for number, (field, near) in enumerate(few):
        own, partner = F.col(field.name), F.col(f"_partner{number}")
        # As many rows as there are few values: known to be small.
        rows = rows.join(F.broadcast(near), field.name).withColumn(f"_partner{number}", F.explode("partners")).drop("partners")
        if not number:
            rows = rows.where(own <= partner if is_long else partner <= own)
        keys += [own, partner] if is_long else [partner, own]
    return rows.withColumn("h", F.xxhash64(*keys))


def paired_counts(
    rows: DataFrame, exact: Sequence[str], few: Sequence[tuple[FuzzyField, DataFrame]], nxt: FuzzyField | None = None
) -> DataFrame:
    """(h, l, s, la, sa, fan): how many rows the `paired_sides` have under each `h`, all of them asking, and how many
    signatures of `nxt`.  Rows with equal values are counted before they are dealt to their partners."""
    fan = signature_count(F.col(nxt.name), nxt.threshold) if nxt else F.lit(0)
    alike = rows.groupBy(*dict.fromkeys([*exact, *[f.name for f, _ in few]])).agg(F.count(F.lit(1)).alias("_n"), F.sum(fan).alias("fan"))
    long_side, short_side = (_under_values(alike, exact, few, is_long) for is_long in (True, False))
    sides = long_side.select("h", F.col("_n").alias("l"), F.lit(0).alias("s"), "fan").unionByName(
        short_side.select("h", F.lit(0).alias("l"), F.col("_n").alias("s"), "fan"))
    return sides.groupBy("h").agg(
        F.sum("l").alias("l"), F.sum("s").alias("s"), F.sum("l").alias("la"), F.sum("s").alias("sa"), F.sum("fan").alias("fan"))


def _asking(long_side: DataFrame, short_side: DataFrame, mark: str) -> list[DataFrame]:
    """Both sides with a column that says which rows ask for partners.

    Among rows marked by component, all ask but those of the signature's most frequent
    component: two rows of different components cannot both be of that one.  A signature
    whose rows all are of one component can link nothing, and goes.
    """
    if mark == ASKS:
        return [s.withColumn(ASKS, F.col(f"v.{ASKS}")) for s in (long_side, short_side)]
    root = F.col(f"v.{ROOT}").alias(ROOT)
    counts = long_side.select("h", root).unionByName(short_side.select("h", root)).groupBy("h", ROOT).count()
    mixed = counts.groupBy("h").agg(
        F.max_by(ROOT, F.struct("count", ROOT)).alias("major"), F.count("*").alias("roots")).where("roots > 1")
    mixed = cut(mixed.select("h", "major"), "mixed").hint("merge")
    return [s.join(mixed, "h").withColumn(ASKS, F.col(f"v.{ROOT}") != F.col("major")).drop("major")
            for s in (long_side, short_side)]


def lead_costs(rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], share: float = 1.0) -> list[float]:
    """What each field would cost as the leading one: the rows of its signatures, and the
    pairs that share one.

    From the rows whose hash falls into `share`: signatures grow with the rows, pairs with
    their square.
    """
    picked = rows if share >= 1 else rows.where(
        F.pmod(F.xxhash64("pid", F.lit("lead")), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    picked = cut(picked, "picked")
    share = min(share, 1.0)
    parts = []
    for number, field in enumerate(fuzzy):
        long_side, short_side = signature_sides(picked, exact, fuzzy, lead=field)
        parts += [side.select(F.lit(number).alias("field"), "h", F.lit(l).alias("l"), F.lit(1 - l).alias("s"))
                  for side, l in ((long_side, 1), (short_side, 0))]
    counts = reduce(DataFrame.unionByName, parts).groupBy("field", "h").agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    # A row meets itself in both roles; rows that only do so make no pair in the whole table either.
    met = F.greatest(F.col("l").cast("double") * F.col("s") - F.least("l", "s"), F.lit(0.0))
    cost = F.sum(F.col("l") + F.col("s")) / F.lit(share) * F.lit(float(SIGNATURE_COST)) + F.sum(met) / F.lit(share * share)
    found = {r.field: r.cost for r in counts.groupBy("field").agg(cost.alias("cost")).collect()}
    return [found.get(number, 0.0) for number in range(len(fuzzy))]


def _is_large(rows: DataFrame, worth: float) -> int:
    """The rows of a table of more than `worth` pairs, 0 for others."""
    count = rows.count()
    return count if count ** 2 > worth else 0


def paired_cost(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], few: Sequence[tuple[FuzzyField, DataFrame]],
    tiled_pairs: float | None = None,
) -> float:
    """What comparing the fields in `few` value by value would cost, as `lead_costs` counts it;
    with `tiled_pairs`, where groups of rows with so many pairs are compared in tiles."""
    counts = paired_counts(rows, exact, few)
    met = F.col("l").cast("double") * F.col("s")
    if tiled_pairs is not None:
        met = F.when(met >= F.lit(float(tiled_pairs)), met * F.lit(TILED_COST)).otherwise(met)
    cost = F.sum(F.col("l") + F.col("s")) * F.lit(float(SIGNATURE_COST)) + F.sum(met)
    return counts.agg(cost).first()[0] or 0.0


def _order(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], worth: float, costs: Sequence[float] | None = None
) -> list[FuzzyField]:
    """The order in which fields make signatures: by cost, where there are two of them and
    a table of more than `worth` pairs; otherwise by threshold.  The pairs are the same."""
    order = _by_threshold(fuzzy)
    count = _is_large(rows, worth) if len(order) > 1 else 0
    if not count:
        return order
    costs = costs or lead_costs(rows, exact, order, PLANNED_ROWS / count)
    return [order[i] for i in sorted(range(len(order)), key=lambda i: costs[i])]


Plan = tuple[list[tuple[FuzzyField, DataFrame]], list[FuzzyField]]


def _plan(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], worth: float = WORTH_PLANNING, tiled_pairs: float | None = None,
) -> Plan:
    """The fields compared value by value first, where a table has more than `worth` pairs and that
    costs less than signatures, and the order of the others.  The pairs are the same.  `tiled_pairs`
    as for `paired_cost`."""
    order, costs = _by_threshold(fuzzy), None
    count = _is_large(rows, worth)
    few = few_valued(rows, order) if count else []
    if few:
        costs = lead_costs(rows, exact, order, PLANNED_ROWS / count)
        if paired_cost(rows, exact, fuzzy, few, tiled_pairs) <= min(costs):
            paired = {f.name for f, _ in few}
            return few, [f for f in order if f.name not in paired]
    return [], _order(rows, exact, fuzzy, worth, costs)


def crowds(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField],
    split_pairs: int = SPLIT_PAIRS, split_gain: float = SPLIT_GAIN, plan: Plan | None = None,
) -> float:
    """Candidate pairs in the crowded signatures of the leading field, or of the fields with few values."""
    few, order = plan or _plan(rows, exact, fuzzy)
    if few:
        hot = _hot(paired_counts(rows, exact, few, order[0] if order else None), split_pairs, split_gain)
    else:
        order = _by_threshold(fuzzy)
        sides = signature_sides(rows, exact, fuzzy, known=known_signatures(rows, order[0]))
        hot = _crowded(*sides, order[1] if len(order) > 1 else None, split_pairs, split_gain)
    return hot.agg(F.sum("pairs")).first()[0] or 0.0


def similar_pairs(
    rows: DataFrame, exact: Sequence[str], fuzzy: Sequence[FuzzyField], min_score: float = 0.0,
    split_pairs: int = SPLIT_PAIRS, split_gain: float = SPLIT_GAIN, worth_splitting: int = WORTH_SPLITTING,
    worth_planning: int = WORTH_PLANNING, mark: str | None = None, fine: bool = False, plan: Plan | None = None,
) -> DataFrame:
    """(id_a, id_b, score) over profile rows (`pid` and the fields), `id_a < id_b`.

    All pairs whose exact fields are equal, whose fuzzy fields reach their thresholds and
    whose score reaches `min_score`; the limits only choose how the candidates are found.
    With `mark`, a column of `rows`: `ROOT`, pairs whose rows differ in it; `ASKS`, pairs in
    which it is true of a row.  `plan`: the `_plan` of these rows and fields, if made before.

    Runs a counting job per split, to learn which signatures are worth splitting.
    """
    few, order = plan or _plan(rows, exact, fuzzy, worth_planning)
    if few:
        long_side, short_side = paired_sides(rows, exact, fuzzy, few, mark)
        order = [None, *order]
        first, paired = few[0][0], [f.name for f, _ in few]
    else:
        first, paired = None, []
        known = known_signatures(rows, order[0], fine) if _is_large(rows, worth_planning) else None
        long_side, short_side = signature_sides(rows, exact, fuzzy, mark, fine, order[0], known)
    if mark:
        long_side, short_side = _asking(long_side, short_side, mark)
    apart = mark == ROOT
    done: list[DataFrame] = []
    for level in range(len(order)):
        split = [f for f in order[: level + 1] if f]
        nxt = order[level + 1] if level + 1 < len(order) else None
        if nxt is not None:
            if first and not level and not mark:
                hot = _hot(paired_counts(rows, exact, few, nxt), split_pairs, split_gain)
            else:
                hot = _crowded(long_side, short_side, nxt, split_pairs, split_gain)
            hot = cut(hot, "crowded")
            total, signatures = hot.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)), F.count("*")).first()
            hot = hot.hint("merge") if signatures > MANY_SIGNATURES else hot
        if nxt is None or not total or total < worth_splitting:
            done.append(_verified(_join_sides(long_side, short_side, split, first), exact, fuzzy, min_score, apart, paired))
            break
        cold = [s.join(hot, "h", "left_anti") for s in (long_side, short_side)]
        done.append(_verified(_join_sides(*cold, split, first), exact, fuzzy, min_score, apart, paired))
        long_side = _split_by(long_side, hot, nxt, level + 1, is_long=True)
        short_side = _split_by(short_side, hot, nxt, level + 1, is_long=False)
    # Rows that met by few values met once, and no more where their signatures were split.
    once, often = (done[:1], done[1:]) if first else ([], done)
    if often:
        once = [*once, reduce(DataFrame.unionByName, often).dropDuplicates(["id_a", "id_b"])]
    return reduce(DataFrame.unionByName, once)
