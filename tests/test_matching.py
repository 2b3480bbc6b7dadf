import itertools
import random

import pytest
from pyspark.sql import functions as F

from links import root_of
from kinweave.operators.components import components
from kinweave.operators import components as components_module
from kinweave.operators.exact import dedup_within, element_links, exact_links
from kinweave.operators import similarity as similarity_module
from kinweave.operators.similarity import FuzzyField, _join_sides, profiles, signature_sides, similar_pairs
from kinweave.operators.topk import top_matches
from kinweave.plans.rules import Exact, Fuzzy, Rule, all_links, parse_rules, rule_links

NAMES = ["smith", "johnson", "williams", "brown", "garcia", "miller", "davis", "oconnor", "mcdonaldson", "li"]


def damaged(rng, word, edits):
    letters = list(word)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        kind = rng.choice("ids")
        if kind == "i":
            letters.insert(at, rng.choice("abcdefgh"))
        elif kind == "d" and len(letters) > 2:
            letters.pop(at)
        else:
            letters[at] = rng.choice("abcdefgh")
    return "".join(letters)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def sim(a, b):
    return 1 - edit_distance(a, b) / max(len(a), len(b))


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(7)
    rows = [
        (f"r{i:03d}", rng.choice("XY"), damaged(rng, rng.choice(NAMES), rng.randrange(4)),
         damaged(rng, rng.choice(NAMES), rng.randrange(3)))
        for i in range(220)
    ]
    rows += [(f"s{i:03d}", *rng.choice(rows)[1:]) for i in range(40)]
    return rows, spark.createDataFrame(rows, "id string, z string, a string, b string").repartition(4)


def brute_pairs(rows, ta, tb, min_score=0.0):
    """All similar pairs of profiles, with scores."""
    first = {}
    for r in sorted(rows):
        first.setdefault(r[1:], r[0])
    out = {}
    for (p, i), (q, j) in itertools.combinations(sorted(first.items(), key=lambda x: x[1]), 2):
        if p[0] == q[0]:
            x, y = sim(p[1], q[1]), sim(p[2], q[2])
            score = round((1 + x + y) / 3, 6)
            if x >= ta - 1e-9 and y >= tb - 1e-9 and score >= min_score:
                out[i, j] = score
    return out, first


SPLITS = [
    {}, {"split_pairs": 20, "split_gain": 0.0, "worth_splitting": 0},
    {"split_pairs": 50, "split_gain": 0.0, "worth_splitting": 0}, {"split_pairs": 1, "split_gain": 0.0, "worth_splitting": 0},
]


@pytest.mark.parametrize("limits", SPLITS)
def test_similar_pairs_are_all_pairs(people, limits):
    rows, df = people
    want, _ = brute_pairs(rows, 0.8, 0.7)
    got = similar_pairs(profiles(df, "id", ["z", "a", "b"]), ["z"], [FuzzyField("a", 0.8), FuzzyField("b", 0.7)], **limits)
    assert {(r.id_a, r.id_b): pytest.approx(r.score, abs=2e-6) for r in got.collect()} == want and want


def test_confidence_is_that_of_the_best_pair(spark):
    """A chain of names: each is similar to its neighbours only, and scores by the nearer one."""
    names = ["aaaaaaaaaa", "aaaaaaaabb", "aaaaaabbbb", "aaaaabbbbb"]
    df = spark.createDataFrame(list(enumerate(names)), "id long, n string")
    links = all_links(df, "id", [Rule("r", (Fuzzy("n", 0.8),))])
    from kinweave.operators.groups import best_link
    got = {r.id: round(r.score, 6) for r in best_link(links).collect()}
    assert got == {0: 0.8, 1: 0.8, 2: 0.9, 3: 0.9}


def test_any_array_element_matches_in_a_rule(spark):
    df = spark.sql("select * from values (1L, array('a', 'b'), 'x'), (2L, array('b', 'c'), 'x'), (3L, array('c'), 'y'), "
                   "(4L, array(), 'x'), (5L, null, 'x') t(id, k, l)")
    pairs = lambda *fields: {(r.id_a, r.id_b) for r in rule_links(df, "id", Rule("r", fields)).collect()}
    assert pairs(Exact("k")) == {(1, 2), (2, 3)}
    assert pairs(Exact("k"), Exact("l")) == {(1, 2)}


@pytest.mark.parametrize("threshold", [0.35, 0.5, 0.9])
def test_all_thresholds_without_exact_field(people, threshold):
    rows, df = people
    values = sorted({r[2] for r in rows})
    one = df.select(F.col("a").alias("id"), "a").distinct()
    got = similar_pairs(profiles(one, "id", ["a"]), [], [FuzzyField("a", threshold)]).collect()
    want = {(x, y) for x, y in itertools.combinations(values, 2) if sim(x, y) >= threshold - 1e-9}
    assert {(r.id_a, r.id_b) for r in got} == want


def test_min_score(people):
    rows, df = people
    want, _ = brute_pairs(rows, 0.8, 0.7, 0.93)
    got = similar_pairs(
        profiles(df, "id", ["z", "a", "b"]), ["z"], [FuzzyField("a", 0.8), FuzzyField("b", 0.7)], min_score=0.93)
    assert {(r.id_a, r.id_b) for r in got.collect()} == set(want)


def test_rule_groups(people):
    rows, df = people
    rule = Rule("r", (Exact("z"), Fuzzy("a", 0.8), Fuzzy("b", 0.7)))
    want, first = brute_pairs(rows, 0.8, 0.7)
    pairs = list(want) + [(first[r[1:]], r[0]) for r in rows if first[r[1:]] != r[0]]
    links = rule_links(df, "id", rule).collect()
    assert root_of([(r.id_a, r.id_b) for r in links]) == root_of(pairs)
    assert len(links) < len(rows)  # linear, not a link per pair


def test_order_and_partitioning_do_not_matter(people):
    _, df = people
    rule = Rule("r", (Exact("z"), Fuzzy("a", 0.8)))
    one = rule_links(df, "id", rule).collect()
    other = rule_links(df.orderBy(F.desc("b")).repartition(3, "b"), "id", rule).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))


def test_top_k_is_that_of_all_pairs(people):
    rows, df = people
    best = set()
    for r in rows:
        scored = []
        for o in rows:
            if o[0] != r[0] and o[1] == r[1]:
                x = sim(r[2], o[2])
                if x >= 0.5 - 1e-9:
                    scored.append((-round((1 + x) / 2, 6), o[0]))
        best |= {tuple(sorted((r[0], o))) for _, o in sorted(scored)[:2]}
    got = top_matches(df, "id", ["z"], [FuzzyField("a", 0.5)], k=2).collect()
    assert {(r.id_a, r.id_b) for r in got} == best


def test_exact_links_drop_null_keys(spark):
    df = spark.sql("select * from values (1, 'a', 'x'), (2, 'a', 'x'), (3, 'a', null), (4, 'a', null), (5, 'b', 'x'), "
                   "(6, 'a', 'x') t(id, k, l)")
    assert sorted(map(tuple, exact_links(df, "id", ["k", "l"]).collect())) == [(1, 2), (1, 6)]
    assert sorted(map(tuple, exact_links(df, "id", ["l"]).collect())) == [(1, 2), (1, 5), (1, 6)]


def test_any_element_of_an_array_key(spark):
    df = spark.sql("select * from values (1, array('a', 'b')), (2, array('b')), (3, array('c', null)), (4, null) t(id, k)")
    assert [tuple(r) for r in element_links(df, "id", "k").collect()] == [(1, 2)]


def test_hot_key_join_is_split(spark):
    """A key with most rows is spread over several join tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 60_000, 1, 16).select(
            "id", F.when(F.col("id") < 30_000, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") / 2)).alias("k"))
        links = exact_links(df, "id", ["k"])
        assert links.count() == 29_999
        links.collect()
        assert "skew=true" in links._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("hub_degree", [1_000_000, 1])
def test_components(spark, monkeypatch, hub_degree):
    monkeypatch.setattr(components_module, "HUB_DEGREE", hub_degree)
    rng = random.Random(3)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(64)]
    star = [("s999", f"s{i:03d}") for i in range(40)]
    loose = [(f"r{rng.randrange(60):03d}", f"r{rng.randrange(60):03d}") for _ in range(45)]
    edges = chain + star + [e for e in loose if e[0] != e[1]]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "id_a string, id_b string"))
    assert {r.id: r.root for r in got.collect()} == root_of(edges)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "id_a long, id_b long")).isEmpty()


def test_first_rule_wins(spark):
    df = spark.sql("select * from values ('1', 'e', 'p'), ('2', 'e', 'p'), ('3', null, 'p') t(id, email, phone)")
    rules = [Rule("email", (Exact("email"),)), Rule("phone", (Exact("phone"),))]
    got = {(r.id_a, r.id_b): r.rule_id for r in all_links(df, "id", rules).collect()}
    assert got == {("1", "2"): "email", ("1", "3"): "phone"}


def test_rule_documents():
    document = {"MatchingKeys": [
        {"MatchingKey": [{"FieldName": "email", "ExactMatch": True}]},
        {"MatchingKey": [{"FieldName": "first_name", "ExactMatch": False, "FuzzyMatchScore": 0.8}]},
    ]}
    rules = parse_rules(document)
    assert rules[0].exact == ["email"] and rules[1].fuzzy[0].threshold == 0.8
    named = parse_rules({"Rules": [{"RuleName": "mail", "MatchingKeys": ["email", "phone"]}], "MatchingThreshold": 0.9})
    assert named[0].name == "mail" and named[0].exact == ["email", "phone"] and named[0].min_score == 0.9


@pytest.mark.parametrize("threshold", [0.0, 1.0, 1.5])
def test_threshold_bounds(threshold):
    with pytest.raises(ValueError):
        Fuzzy("a", threshold)


def test_dedup_keeps_smallest_id_per_source(spark):
    df = spark.sql("select * from values ('x', 2, 'a'), ('x', 1, 'a'), ('y', 3, 'a'), ('x', 4, null), ('x', 5, null) t(source, id, k)")
    assert sorted(r.id for r in dedup_within(df, "id", ["k"]).collect()) == [1, 3, 4]


def test_no_nested_loop_in_the_matcher(people):
    _, df = people
    pairs = similar_pairs(profiles(df, "id", ["z", "a", "b"]), ["z"], [FuzzyField("a", 0.8), FuzzyField("b", 0.7)])
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_rows_under_signatures_are_not_broadcast(people):
    """They come from a table that looks small, but all of them would go through the driver."""
    _, df = people
    fields = [FuzzyField("a", 0.7), FuzzyField("b", 0.7)]
    met = _join_sides(*signature_sides(profiles(df, "id", ["z", "a", "b"]), ["z"], fields), fields[:1])
    plan = met._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_many_crowded_signatures_are_not_broadcast(people, monkeypatch):
    _, df = people
    monkeypatch.setattr(similarity_module, "MANY_SIGNATURES", 0)
    pairs = similar_pairs(profiles(df, "id", ["z", "a", "b"]), ["z"], [FuzzyField("a", 0.7), FuzzyField("b", 0.7)], **SPLITS[-1])
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().sparkPlan().toString()


def test_files_count_as_larger_than_they_are(spark):
    assert float(spark.conf.get("spark.sql.sources.fileCompressionFactor")) > 1
