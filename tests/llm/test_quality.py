"""Quality rules and the line classifier."""

import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinweave.llm import quality_crf
from kinweave.llm.quality_rules import RULES, Rule, judge
from tests_common import words_of


def measures(text):
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def test_measures(documents, clashing, sample):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["a", "bb", "c#", "d\n", "é|"]) for _ in range(rng.randint(0, 80)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n\x0b"), (103, "a b"), (104, "x y x y x"), (105, "a b c " * 7000), (None, "a b c a b c"), (0, rows[0][1])]
    rows += [(1000 + r[0], r[1]) for r in sample]
    got = judge(clashing(documents(rows))).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert collections.Counter((r.doc_id, *(r[n] for n in names)) for r in got) == collections.Counter((r[0], *measures(r[1])) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and not r.failed)


def test_rules_are_one_plain_projection(documents):
    plan = judge(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Exchange", "Join", "Generate"))
    assert judge(documents([])).count() == 0 and judge(documents([(1, "a")]), rules=()).first().failed == []


def test_each_rule_speaks_up(documents):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 8)))
    text = "\n".join(f"the {word()} of {word()} {word()} is in the {word()} and {word()} {word()} was {word()}" for _ in range(8))
    cases = {
        "length": "too short", "symbols": text.replace(" ", "# "), "letters": " ".join(f"{i}{i}{i}" for i in range(200)),
        "stop_words": " ".join(f"quark{chr(97 + i % 26)}{i}" for i in range(90)), "capitals": text.upper(),
        "repeated_lines": "\n".join([f"the {i} line of it" for i in range(20)] + ["one more of the same"] * 19),
        "bullet_lines": "\n".join("- " + x for x in text.split("\n")), "cut_lines": "\n".join(x + "..." for x in text.split("\n")),
        "word_length": " ".join("abcdefghijklmnopqrstuvwxyz" + str(i) for i in range(60)),
    }
    # A third of the words in windows found twice: more than the rule allows, less than the base does.
    cases["repeated_words"] = " ".join([f"the {word()} of {word()}{i}" for i in range(20)] + ["was it in that"] * 10)
    got = {r.doc_id: r for r in judge(documents([(i, t) for i, t in enumerate([text, *cases.values()])])).collect()}
    assert got[0].kept, got[0].failed
    for i, name in enumerate(cases, start=1):
        assert name in got[i].failed, (name, got[i].failed)
        assert name != "repeated_words" or not got[i].base_failed
    assert {r.name for r in RULES} >= set(cases) and Rule("x", "1", high=0).passes() is not None


def test_clean_documents_are_kept(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = judge(docs).where("n_words >= 50").join(labels, "doc_id")
    shares = {r.quality: r.share for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert shares[1] > 0.97 and shares[0] < 0.05


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(1)
    counts = np.array([1, 4, 0, 3])
    emission, steps = rng.normal(size=8), rng.normal(size=(2, 2))
    good, pairs, total = quality_crf.Chains(counts).marginals(emission, steps)
    at, want, expected, logs = 0, [], np.zeros((2, 2)), 0.0
    for n in counts[counts > 0]:
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            value = sum(emission[at + k] for k, x in enumerate(labels) if x) + sum(steps[a, b] for a, b in itertools.pairwise(labels))
            weights[labels] = np.exp(value)
        z = sum(weights.values())
        logs += np.log(z)
        want += [sum(w for x, w in weights.items() if x[k]) / z for k in range(n)]
        for labels, w in weights.items():
            for a, b in itertools.pairwise(labels):
                expected[a, b] += w / z
        at += n
    assert np.allclose(good, want) and np.allclose(pairs, expected) and np.isclose(total, logs)


def test_line_measures_do_not_depend_on_the_batch(sample):
    texts = [r[1] for r in sample] + [None, "", "\n \n", "a", "a\na\nb a a a", "É!\n\x0b\nx" * 30]
    whole = quality_crf.measure_lines(pa.array(texts, pa.string()))
    single = [quality_crf.measure_lines(pa.array([t], pa.string())) for t in texts]
    assert np.array_equal(whole.counts, np.concatenate([s.counts for s in single]))
    assert np.allclose(whole.measures, np.concatenate([s.measures for s in single]), atol=1e-6)
    assert whole.counts[-1] == len([x for x in texts[-1].split("\n") if words_of(x)])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_crf.classify(docs, labels)
    assert got.count() == docs.count()
    held = got.where("held_out").join(labels, "doc_id").select("predicted", "quality").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    # The labels of held-out documents make no difference.
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {(r.doc_id, r.score) for r in quality_crf.classify(docs, flipped).collect()} == {(r.doc_id, r.score) for r in got.collect()}


def test_classifier_of_odd_rows(spark, documents, clashing):
    rows = [(i, f"the good line number {i} of a text.\nAnother one, as good.") for i in range(40)]
    rows += [(100 + i, "bad# bad# bad# bad#\nbad# bad#") for i in range(40)]
    labels = spark.createDataFrame([(i, 1 if i < 100 else 0) for i, _ in rows] + [(None, 1), (5, None), (6, 1)], "doc_id long, quality int")
    odd = [(None, "the good line"), (900, None), (901, ""), (902, " \n"), (903, "word " * 50_000), (1, rows[1][1])]
    got = quality_crf.classify(clashing(documents(rows + odd)), labels).collect()
    assert len(got) == 86 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[None].held_out and by[900].score == by[901].score == by[902].score
    assert by[3].predicted == 1 and by[103].predicted == 0
    nothing = quality_crf.classify(documents([(1, "a b")]), labels.limit(0)).first()
    assert nothing.score == pytest.approx(0.5)
    assert quality_crf.classify(documents([]), labels).count() == 0
