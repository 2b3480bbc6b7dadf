"""Crowds of similar rows: cheap tests lose no pair, work is planned once, and links are thinned out before they are grouped."""

import random

import pytest
from pyspark.sql import functions as F

from kinweave.operators import components as c
from kinweave.operators import similarity as s
from kinweave.operators.ladder import linking_pairs
from kinweave.operators.similarity import FuzzyField
from links import root_of


@pytest.fixture(scope="module")
def rows(spark):
    first, last = ["james", "jamese", "jame", "mary", "maryo", ""], ["smith", "smyth", "smithe", "brown"]
    return spark.createDataFrame(
        [(i, "xy"[i % 2], first[i % 6], last[i // 6 % 4], f"{i * 7 % 90} {('oak', 'elm', 'maple')[i % 3]} st") for i in range(160)],
        "pid long, z string, a string, b string, c string").dropDuplicates(["z", "a", "b", "c"])


FIELDS = [FuzzyField("a", 0.8), FuzzyField("b", 0.8), FuzzyField("c", 0.7)]


def test_an_edit_changes_two_letters_at_most(spark):
    rng = random.Random(11)
    signs = "abz019 éßЖ中\U0001f600"
    data = []
    for _ in range(300):
        word = [rng.choice(signs) for _ in range(rng.randrange(9))]
        other, edits = list(word), rng.randrange(4)
        for _ in range(edits):
            at = rng.randrange(len(other) + 1)
            other[at:at + rng.randrange(2)] = rng.choice(["", *signs])
        data.append(("".join(word), "".join(other), edits))
    unlike = F.bit_count(s.letters(F.col("x")).bitwiseXOR(s.letters(F.col("y"))))
    got = spark.createDataFrame(data, "x string, y string, edits int").select("edits", unlike.alias("unlike")).collect()
    assert all(r.unlike <= 2 * r.edits for r in got) and max(r.unlike for r in got) >= 4
    assert spark.range(1).select(s.letters(F.lit("")), s.letters(F.lit("aab")) == s.letters(F.lit("ba"))).first()[:] == (0, True)


def test_counts_under_values_are_those_of_the_sides(rows):
    few = s.few_valued(rows, FIELDS[:2])
    sides = s.paired_sides(rows, ["z"], FIELDS, few)
    want = [{r.h: r["count"] for r in side.groupBy("h").count().collect()} for side in sides]
    got = s.paired_counts(rows, ["z"], few, FIELDS[2]).collect()
    assert [{r.h: n for r in got if (n := r[name])} for name in ("l", "s")] == want
    hot = {tuple(r) for r in s._crowded(*sides, FIELDS[2], 10, 0.0).collect()}
    assert hot and {tuple(r) for r in s._hot(s.paired_counts(rows, ["z"], few, FIELDS[2]), 10, 0.0).collect()} == hot


def test_the_join_is_planned_once_and_lists_a_pair_once(rows, monkeypatch):
    planned, costs = [], s.lead_costs
    monkeypatch.setattr(s, "lead_costs", lambda *a: planned.append(1) or costs(*a))
    monkeypatch.setattr(s, "paired_cost", lambda *a: 0.0)
    limits = {"worth_planning": 0}
    pairs = linking_pairs(rows, ["z"], FIELDS, worth_climbing=1, **limits, split_pairs=10**9)
    assert len(planned) == 1
    want = {tuple(r) for r in s.similar_pairs(rows, ["z"], FIELDS).collect()}
    assert want and sorted(tuple(r) for r in pairs.collect()) == sorted(want)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_many_links_are_thinned_out(spark, kind):
    """Crowds in which every two are linked, a long chain, and links of a node with itself and with nobody."""
    links = [(x, y) for n in range(4) for x in range(n * 100, n * 100 + 40) for y in range(n * 100, n * 100 + 40)]
    links += [(x + 1, x) for x in range(1000, 1040)] + [(140, 205), (None, 7), (7, None)]
    random.Random(2).shuffle(links)
    table = spark.createDataFrame(links, "id_a long, id_b long").select(*[F.col(x).cast(kind) for x in ("id_a", "id_b")])
    want = root_of([(x, y) if kind == "long" else (str(x), str(y)) for x, y in links if x != y and None not in (x, y)])
    for run in (64, 10_000):
        few = c.cut(c.thinned(table.coalesce(2), many=1, run=run))
        found = [tuple(r) for r in few.collect()]
        assert len(found) < (2_000 if run == 64 else 2 * 220) and all(x != y for x, y in found)
        assert root_of(found) == want
    assert c.thinned(table) is table


def test_a_large_round_is_cut_half_way(spark, monkeypatch):
    chain = spark.range(60).select(F.col("id").alias("id_a"), (F.col("id") + 1).alias("id_b"))
    labels, cut = [], c.cut
    monkeypatch.setattr(c, "cut", lambda df, label: labels.append(label) or cut(df, label))
    plain = {tuple(r) for r in c.components(chain).collect()}
    rounds = len(labels) - 1
    monkeypatch.setattr(c, "WORTH_CUTTING", 1)
    labels.clear()
    assert {tuple(r) for r in c.components(chain).collect()} == plain == {(i, 0) for i in range(61)}
    assert len(labels) == 1 + 2 * rounds
