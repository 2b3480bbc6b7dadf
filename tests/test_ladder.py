"""Steps by falling scores: the same groups, best pairs and best partners as from all pairs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinweave.operators import similarity as s
from kinweave.operators.ladder import best_partners, linking_pairs, raised, step_scores
from kinweave.operators.similarity import FuzzyField, profiles, similar_pairs
from links import root_of

@pytest.fixture(scope="module")
def crowd(spark):
    """Names of a few stems, of unlike lengths, with runs of equal letters, an empty one too."""
    rng = random.Random(3)
    stems = ["aabbccddee", "aabbccddeeff", "margarethe", "xyzzyxyzzyxyzzyxyzzy", "köln"]
    rows = {(rng.choice("XY"), "", "q")}
    while len(rows) < 160:
        name = list(rng.choice(stems))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(name))
            name[at:at + rng.randrange(2)] = rng.choice(["", "a", "b", "zz"])
        rows.add((rng.choice("XY"), "".join(name), rng.choice(["north", "nord", "south", "sout"])))
    data = [(i, *r) for i, r in enumerate(sorted(rows))]
    return profiles(spark.createDataFrame(data, "id long, z string, a string, b string").repartition(4), "id", ["z", "a", "b"])


RULES = [
    (["z"], [FuzzyField("a", 0.7)], 0.0, {"steps": (0.1, 0.3, 0.6, 0.9)}),
    ([], [FuzzyField("a", 0.6), FuzzyField("b", 0.75)], 0.0, {"split_pairs": 1, "split_gain": 0.0, "worth_splitting": 0}),
    (["z"], [FuzzyField("a", 0.5), FuzzyField("b", 0.5)], 0.85, {}),
]


def all_of(rows, exact, fuzzy, least):
    return {(r.id_a, r.id_b): r.score for r in similar_pairs(rows, exact, fuzzy, least).collect()}


def best_of(pairs):
    best = {}
    for pair, score in pairs.items():
        for end in pair:
            best[end] = max(best.get(end, 0.0), score)
    return best


@pytest.mark.parametrize("exact, fuzzy, least, how", RULES)
def test_groups_and_best_pairs_are_those_of_all_pairs(crowd, exact, fuzzy, least, how):
    every = all_of(crowd, exact, fuzzy, least)
    some = {(r.id_a, r.id_b): r.score for r in linking_pairs(crowd, exact, fuzzy, least, worth_climbing=0, **how).collect()}
    assert some.items() <= every.items() and every
    assert root_of(list(some)) == root_of(list(every))
    assert best_of(some) == best_of(every)


@pytest.mark.parametrize("exact, fuzzy, least, how", RULES)
def test_best_partners_are_those_of_all_pairs(crowd, exact, fuzzy, least, how):
    ends = {}
    for (a, b), score in all_of(crowd, exact, fuzzy, least).items():
        ends.setdefault(a, []).append((-score, b))
        ends.setdefault(b, []).append((-score, a))
    want = {(p, other, -score) for p, found in ends.items() for score, other in sorted(found)[:2]}
    got = best_partners(crowd, exact, fuzzy, 2, least, worth_climbing=0, **how).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9])
def test_what_deletions_leave_loses_no_pair(crowd, threshold):
    fields = [FuzzyField("a", threshold)]
    coarse = {tuple(r) for r in similar_pairs(crowd, [], fields).collect()}
    assert {tuple(r) for r in similar_pairs(crowd, [], fields, fine=True).collect()} == coarse and coarse


def test_pairs_of_a_dense_crowd_grow_with_its_records(spark):
    """Names that are nearly all similar to each other: four times the records make about 16
    times the pairs, but few more than four times the pairs made."""
    def made(n):
        words = [format(i, "b").zfill(12).replace("0", "o").replace("1", "i") for i in range(n)]
        rows = profiles(spark.createDataFrame(list(enumerate(words)), "id long, a string"), "id", ["a"])
        fields = [FuzzyField("a", 0.5)]
        every = similar_pairs(rows, [], fields).count()
        some = linking_pairs(rows, [], fields, steps=(0.2, 0.5), worth_climbing=0).count()
        partners = best_partners(rows, [], fields, 3, worth_climbing=0, steps=(0.2, 0.5)).count()
        return every, some, partners

    few, many = made(256), made(1024)
    assert many[0] > 12 * few[0]
    assert many[1] < 6 * few[1] and many[1] < 10 * 1024
    assert many[2] == 3 * 1024


def test_candidates_of_a_step_are_those_with_an_asking_row(spark):
    """A crowd of one component meets nobody any more but for the rows outside."""
    from kinweave.operators import similarity as s
    rows = spark.range(400).select(
        F.col("id").alias("pid"), F.format_string("customer %04d", "id").alias("a"),
        F.when(F.col("id") < 398, 0).otherwise(F.col("id")).alias(s.ROOT))
    fields = [FuzzyField("a", 0.6)]
    sides = s._asking(*s.signature_sides(rows, [], fields, s.ROOT), s.ROOT)
    pairs = s._join_sides(*sides, fields).select("a.pid", F.col("b.pid").alias("other")).distinct()
    assert 0 < pairs.count() <= 2 * 2 * 400
    got = {tuple(r)[:2] for r in similar_pairs(rows, [], fields, mark=s.ROOT).collect()}
    names = [f"customer {i:04d}" for i in range(400)]
    near = lambda x, y: sum(p != q for p, q in zip(names[x], names[y])) <= 5
    assert got == {(x, y) for x, y in itertools.combinations(range(400), 2) if y >= 398 and near(x, y)}


def test_steps(spark):
    fields = [FuzzyField("a", 0.8)]
    assert step_scores([], fields, 0.0, (0.5, 0.25)) == [0.95, 0.9]
    assert step_scores([], fields, 1.0, (0.5,)) == []
    assert raised([], fields, 0.95)[0].threshold == pytest.approx(0.95, abs=1e-5)
    assert raised(["z"], fields, 0.85)[0].threshold == 0.8


def test_the_leading_field_is_chosen_by_cost(spark):
    """A field of three values has the highest threshold, but every signature of it is a crowd."""
    from kinweave.operators import similarity as s
    rng = random.Random(5)
    data = [(i, rng.choice(["north", "south", "nord"]), "".join(rng.choice("abcdefghij") for _ in range(12))) for i in range(1500)]
    data += [(2000 + i, side, name[:4] + "x" + name[5:]) for i, side, name in data[:50]]
    rows = profiles(spark.createDataFrame(data, "id long, side string, name string"), "id", ["side", "name"])
    fields = [FuzzyField("side", 0.95), FuzzyField("name", 0.9)]
    assert [f.name for f in s._order(rows, [], fields, 1e9)] == ["side", "name"]
    assert [f.name for f in s._order(rows, [], fields, 1)] == ["name", "side"]
    whole = s.lead_costs(rows, [], fields)
    part = s.lead_costs(rows, [], fields, 0.5)
    assert whole[0] > 2 * whole[1] and part[0] > 2 * part[1] and 0.5 < part[0] / whole[0] < 2
    by_cost = {tuple(r) for r in similar_pairs(rows, [], fields, worth_planning=1).collect()}
    assert by_cost == {tuple(r) for r in similar_pairs(rows, [], fields).collect()} and len(by_cost) >= 50


def test_cost_of_an_empty_table(spark):
    rows = profiles(spark.createDataFrame([], "id long, a string, b string"), "id", ["a", "b"])
    fields = [FuzzyField("a", 0.9), FuzzyField("b", 0.7)]
    assert similar_pairs(rows, [], fields, worth_planning=-1).collect() == []


@pytest.mark.parametrize("fine", [False, True])
def test_signatures_of_values_are_those_of_rows(crowd, fine):
    """Values are taken apart once each; rows come under the same signatures, in structs with the same fields."""
    fields = [FuzzyField("a", 0.7), FuzzyField("b", 0.75)]
    plain = s.signature_sides(crowd, ["z"], fields, fine=fine, lead=fields[0])
    known = s.signature_sides(crowd, ["z"], fields, fine=fine, lead=fields[0], known=s.known_signatures(crowd, fields[0], fine))
    for one, other in zip(plain, known):
        assert one.schema["v"].dataType.names == other.schema["v"].dataType.names
        assert sorted(one.collect(), key=str) == sorted(other.collect(), key=str)
    assert all_of(crowd, ["z"], fields, 0.0) == {
        (r.id_a, r.id_b): r.score for r in similar_pairs(crowd, ["z"], fields, worth_planning=0, fine=fine).collect()}


def test_fields_with_few_values_are_compared_by_value(spark, monkeypatch):
    """Rows meet once, under their values and those values' partners, and all pairs are found."""
    first, last = ["james", "jamese", "jame", "mary", "maryo", "", "robert", "rebert"], ["smith", "smyth", "smithe", "brown"]
    rows = spark.createDataFrame(
        [(i, "xy"[i % 2], first[i % 8], last[i // 8 % 4], f"{i * 7 % 90} {('oak', 'elm', 'maple')[i % 3]} st") for i in range(160)],
        "pid long, z string, a string, b string, c string").dropDuplicates(["z", "a", "b", "c"])
    rows = rows.withColumn(s.ROOT, F.col("pid") % 7)
    fields = [FuzzyField("a", 0.8), FuzzyField("b", 0.8), FuzzyField("c", 0.7)]
    few = s.few_valued(rows, fields[:2])
    assert [f.name for f, _ in few] == ["a", "b"]
    near = {r.a: set(r.partners) for r in few[0][1].collect()}
    assert near["james"] == {"james", "jamese", "jame"} and near[""] == {""}
    met = s._join_sides(*s.paired_sides(rows, ["z"], fields, few), [], fields[0])
    pairs = met.select(F.least("a.pid", "b.pid").alias("x"), F.greatest("a.pid", "b.pid").alias("y"))
    assert pairs.count() == pairs.distinct().count() == s.similar_pairs(rows, ["z"], fields[:2]).count()
    monkeypatch.setattr(s, "paired_cost", lambda *a: 0.0)
    limits = {"split_pairs": 10, "split_gain": 0, "worth_splitting": 0}
    for more, mark in ((limits, None), ({}, s.ROOT)):
        assert len(s._plan(rows, ["z"], fields, 0)[0]) >= 2
        want = {tuple(r) for r in s.similar_pairs(rows, ["z"], fields, mark=mark).collect()}
        assert want and {tuple(r) for r in s.similar_pairs(rows, ["z"], fields, worth_planning=0, mark=mark, **more).collect()} == want
