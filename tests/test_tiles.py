"""Blocks compared in tiles: groups and best pairs are those of all pairs, and few pairs are listed."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinweave.operators import components
from kinweave.operators import similarity as s
from kinweave.operators import tile_search as search
from kinweave.operators import tiles
from kinweave.operators.ladder import linking_pairs
from kinweave.operators.similarity import FuzzyField
from links import root_of
from test_ladder import best_of
from test_matching import edit_distance

FIELDS = [FuzzyField("a", 0.8), FuzzyField("c", 0.6), FuzzyField("b", 0.8), FuzzyField("d", 0.7)]


@pytest.fixture(scope="module")
def rows(spark):
    """Few names, and streets and towns of unlike lengths, with equal ones and empty ones."""
    rng = random.Random(4)
    first, last = ["james", "jamese", "jame", "mary", "maryo", ""], ["smith", "smyth", "smithe", "brown"]
    made = {(rng.choice("xy"), rng.choice(first), rng.choice(last),
             rng.choice(["", f"{rng.randrange(200)} {rng.choice(['oak', 'elm', 'maple'])} st", f"po box {rng.randrange(900)}"]),
             rng.choice(["köln", "koln", "berlin", "bärlin am see"])) for _ in range(500)}
    data = [(f"p{i:04d}", *row) for i, row in enumerate(sorted(made))]
    return spark.createDataFrame(data, "pid string, z string, a string, b string, c string, d string").repartition(4).cache()


@pytest.mark.parametrize("names, least, side, tiled", [("abcd", 0.0, 16, 0), ("abc", 0.9, 4096, 0), ("ab", 0.93, 16, 0), ("acd", 0.0, 64, 40)])
def test_groups_and_best_pairs_are_those_of_all_pairs(rows, monkeypatch, names, least, side, tiled):
    monkeypatch.setattr(tiles, "TILE_ROWS", side)
    monkeypatch.setattr(search, "BATCH", 50)
    monkeypatch.setattr(search, "CELLS", 300)
    fields = [f for f in FIELDS if f.name in names]
    given = s.profiles(rows.withColumnRenamed("pid", "id"), "id", ["z", *[f.name for f in fields]])
    few = [(f, s.partner_values(given, f)) for f in fields if f.name in "ab"]
    plan = (few, [f for f in fields if f.name not in "ab"])
    every = {(r.id_a, r.id_b): r.score for r in s.similar_pairs(given, ["z"], fields, least).collect()}
    found = tiles.linked_blocks(given, ["z"], fields, least, plan, worth=0, tiled_pairs=tiled).collect()
    some = {(r.id_a, r.id_b): r.score for r in found}
    assert some.items() <= every.items() and every
    assert root_of(list(some)) == root_of(list(every))
    assert best_of(some) == best_of(every)


def test_a_crowd_lists_few_pairs(spark, monkeypatch):
    """All are similar; the whole search is planned so, and split limits do not change what comes out."""
    rows = spark.range(600).select(
        F.col("id").alias("pid"), F.lit("z").alias("z"), F.lit("anna").alias("a"), F.format_string("%03d long street", "id").alias("c"))
    fields = [FuzzyField("a", 0.8), FuzzyField("c", 0.7)]
    monkeypatch.setattr(tiles, "WORTH_TILING", 1)
    monkeypatch.setattr(s, "paired_cost", lambda *a: 0.0)
    monkeypatch.setattr(s, "FEW_VALUES", 100)
    for split in ({}, {"split_pairs": 1, "split_gain": 0.0, "worth_splitting": 1}):
        found = linking_pairs(rows, ["z"], fields, worth_climbing=1, worth_planning=0, **split).collect()
        assert len(found) < 2 * 600 and len(root_of([(r.id_a, r.id_b) for r in found])) == 600
        assert set(best_of({(r.id_a, r.id_b): r.score for r in found}).values()) == {round(1 - 1 / 15 / 3, 6)}


def test_ids_that_are_neither_numbers_nor_texts_are_left_to_joins(rows):
    given = rows.withColumn("pid", F.struct("pid"))
    few = [(FIELDS[0], s.partner_values(rows, FIELDS[0]))]
    assert tiles.linked_blocks(given, ["z"], FIELDS[:2], 0.0, (few, [FIELDS[1]]), worth=0) is None


@pytest.mark.parametrize("kind", ["long", "string"])
def test_large_graphs_are_united_by_numbers(spark, monkeypatch, kind):
    """Chains, stars and loose links, and of links with nobody nothing comes out."""
    rng = random.Random(8)
    links = [(x, x + 1) for x in range(200)] + [(900, 1000 + x) for x in range(150)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(180)]
    links += [(x, y) for x in range(6000, 6110) for y in range(6000, 6110)] if kind == "long" else []
    links += [(x, x) for x in range(5000, 5005)] + [(None, 3), (3, None)]
    rng.shuffle(links)
    table = spark.createDataFrame(links, "id_a long, id_b long").select(*[F.col(x).cast(kind) for x in ("id_a", "id_b")]).repartition(7)
    rounds = {tuple(r) for r in components.components(table).collect()}
    united = components._united
    used = []
    monkeypatch.setattr(components, "WORTH_NUMBERING", 1)
    monkeypatch.setattr(components, "ONE_RUN", 50)
    monkeypatch.setattr(components, "_united", lambda *a: used.append(1) or united(*a))
    got = components.components(table).collect()
    assert {tuple(r) for r in got} == rounds and len(got) == len(rounds) > 500 and used
    monkeypatch.setattr(components, "ONE_TASK_NODES", 10)
    assert {tuple(r) for r in components.components(table).collect()} == rounds and len(used) == 1


def test_bounds_and_distances():
    rng = random.Random(1)
    words = ["".join(rng.choice("ab1éЖ\U0001f600 ") for _ in range(rng.randrange(12))) for _ in range(200)] + ["x" * 150, "x" * 148 + "yz"]
    lengths, codes, marks = search.characters(pa.array(words))
    a, b = (np.array([rng.randrange(200) for _ in range(3000)] + [200 + x]) for x in range(2))
    want = np.array([edit_distance(words[x], words[y]) for x, y in zip(a, b)])
    gap = abs(lengths[a] - lengths[b])
    assert ((np.bitwise_count(marks[a] ^ marks[b]) + gap + 1) // 2 <= want).all()
    for cap in (0, 1, 3, 6):
        near = gap <= cap
        got = search.distances(codes, lengths, a[near], b[near], cap)
        assert ((got == want[near]) | ((got > cap) & (want[near] > cap))).all()


def test_scores_are_rounded_as_spark_does(spark):
    values = [1 - i / 64 / 4 for i in range(64)] + [0.9921875, 0.9765625, 0.8333335, 2 / 3]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(F.round("x", 6)).collect()
    assert search.rounded(np.array(values)).tolist() == [r[0] for r in got]
