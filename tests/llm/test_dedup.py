"""Exact dedup, Jaccard join and suffix dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinweave.llm import exact_dedup, jaccard_join, suffix_dedup
from kinweave.llm.common import ship
from kinweave.llm.exact_dedup import drop_copies, mark_copies
from kinweave.llm.shingles import shingle_sets
from tests_common import words_of

EMPTY = [(1, None), (2, ""), (3, " \n\t")]


def exact(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = collections.defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] or 0))
    out = []
    for r in rows:
        group = groups[norm(r[1])]
        best = min(group)
        sha = hashlib.sha256(norm(r[1]).encode()).hexdigest()
        out.append((r[0], None if best[1] else best[2], len(group), sha))
    return sorted(out, key=repr)


def marked(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def test_exact_copies(documents, clashing):
    rows = [(5, "a b"), (4, "ab "), (9, "a  b\n"), (8, "a\x0bb\x0c "), (7, "a b"), (None, "ab"), (None, "z"), (6, "ab" * 50_000), *EMPTY]
    df = clashing(documents(rows))
    got = mark_copies(df)
    assert marked(got) == exact(rows)
    kept = {r.doc_id for r in got.where("kept").collect()}
    assert kept == {8, 7, None, 6, 3}
    assert drop_copies(df).columns == df.columns
    assert {r.doc_id for r in drop_copies(df).collect()} == kept


def test_copies_padded_with_blanks_meet_without_the_frequent_ones(documents, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_frequent", lambda docs, text: docs.select(F.lit(0).cast("long").alias("h")).limit(0))
    text = "abc def " * 20
    rows = [(1, text), (2, " " * 200 + text), (3, "\n" * 500 + text), (4, "a" + "\t" * 190 + text[1:]), (5, " " * 300 + "other"), (6, "other"), (7, " " * 400), (8, None)]
    got = mark_copies(documents(rows))
    assert marked(got) == exact(rows)
    assert {r.doc_id for r in got.where("kept").collect()} == {3, 5, 7}


def test_one_text_in_most_rows_and_repeated_rows(documents):
    rows = [(i, "same text" + " " * (i % 7)) for i in range(3000)] + [(i, f"other {i}") for i in range(1000)] + [(1, "same text ")] * 3
    got = mark_copies(documents(rows))
    assert marked(got) == exact(rows)
    assert got.where("kept").count() == 1001


def test_empty_table(documents):
    assert mark_copies(documents([])).count() == 0
    assert jaccard_join.similar_groups(documents([])).count() == 0
    assert suffix_dedup.remove_repeats(documents([])).count() == 0


def test_exact_dedup_plan_has_no_python(spark, documents):
    plan = mark_copies(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "rangepartitioning" in plan


def shingles(text):
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def similar(rows, threshold=80):
    sets = {i: shingles(t) for i, t in rows}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    low = {i: i for i in sets}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, s in sets.items():
        for j, k in collections.Counter(j for x in s for j in holders[x]).items():
            if 100 * k >= threshold * (len(s) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                low[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def edited(seed, count, vocabulary, low, high):
    rng = random.Random(seed)
    pool, base, rows = [f"w{i}" for i in range(vocabulary)], [], []
    for i in range(count):
        if base and rng.random() < 0.7:
            words = list(rng.choice(base))
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = rng.choice(pool)
            if rng.random() < 0.2:
                words = words[: max(1, len(words) * 9 // 10)]
        else:
            words = [rng.choice(pool) for _ in range(rng.randint(low, high))]
        if not base or rng.random() < 0.3:
            base.append(words)
        rows.append((3 * i + 1, " ".join(words)))
    return rows


def grouped(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("shape", [(40, 1, 12), (300, 5, 60), (2000, 20, 200)])
def test_similar_groups(documents, monkeypatch, shape):
    rows = edited(3, 250, *shape) + [(9000 + i, t) for i, t in EMPTY]
    assert grouped(jaccard_join.similar_groups(documents(rows))) == similar(rows)
    # Every way at once: blocks of a few sets, and all signatures on the way of the hot ones.
    monkeypatch.setattr(jaccard_join, "LEFT", 3)
    monkeypatch.setattr(jaccard_join, "RIGHT", 5)
    monkeypatch.setattr(jaccard_join, "levels", lambda sketch: __import__("numpy").full(len(sketch), 9, "uint8"))
    assert grouped(jaccard_join.similar_groups(documents(rows))) == similar(rows)


def test_the_driver_gets_levels_and_no_counters(spark, documents):
    rows = [(i, " ".join(f"w{k % (i + 9)}" for k in range(300))) for i in range(40)]
    ship(spark)
    survey = jaccard_join._surveyed(documents(rows).select(F.col("doc_id").alias("key"), "text").repartition(3), 5, 1)
    sketch = jaccard_join._summed(survey)
    hashes, _ = shingle_sets(pa.array([t for _, t in rows]), 5)
    want = np.bincount(jaccard_join._slots(hashes), minlength=1 << jaccard_join.SLOT_BITS)
    assert want.max() > 3 and sketch.level.dtype == np.uint8 and (sketch.level == jaccard_join.levels(want)).all()
    count, slots = np.unique(want, return_counts=True)
    assert (sketch.count.tolist(), sketch.slots.tolist()) == (count.tolist(), slots.tolist())
    assert sketch.total() == want.sum()
    nothing = jaccard_join._summed(survey.where("false"))
    assert not nothing.level.any() and (nothing.count.tolist(), nothing.slots.tolist()) == ([0], [1 << jaccard_join.SLOT_BITS])


@pytest.mark.parametrize("light", [2, 40, 256])
def test_any_boundary_loses_nothing(documents, monkeypatch, light):
    monkeypatch.setattr(jaccard_join, "boundary", lambda *a: light)
    rows = edited(11, 200, 300, 3, 70)
    assert grouped(jaccard_join.similar_groups(documents(rows))) == similar(rows)


@pytest.mark.parametrize("light", [2, 8, 256])
@pytest.mark.parametrize("threshold", [30, 50, 66, 100])
def test_other_thresholds(documents, monkeypatch, light, threshold):
    monkeypatch.setattr(jaccard_join, "boundary", lambda *a: light)
    words = [f"w{i}" for i in range(40)]
    short = [" ".join(words[k : k + n]) for k in range(0, 24, 6) for n in (5, 6, 7, 8)]  # sets of one to four shingles
    rows = [(10_000 + i, t) for i, t in enumerate(short)] + edited(13, 120, 300, 5, 60)
    assert grouped(jaccard_join.similar_groups(documents(rows), threshold=threshold)) == similar(rows, threshold)


def test_similar_groups_of_odd_rows(documents, clashing):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text), (5, text), (4, text.upper()), (None, text), (None, "a b c"), (3, "a b c"), (8, "a b"), (9, "b a"), (7, "x " * 20_000), *EMPTY]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(clashing(documents(rows))).collect()), key=repr)
    want = [(5, 6, 4), (5, 6, 4), (4, 6, 4), (None, 6, 4), (None, 1, 3), (3, 1, 3), (8, 1, 8), (9, 1, 9), (7, 1, 7), (1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert got == sorted(want, key=repr)


def test_one_document_of_each_group_stays(documents, sample):
    df = documents(sample)
    wanted = {i for i, (_, c) in similar([r[:2] for r in sample]).items() if i == c}
    kept = jaccard_join.one_per_group(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == wanted


def test_rows_with_one_key_or_none_stay_or_go_by_themselves(documents):
    say = lambda k, end="": " ".join(f"{k}w{i}" for i in range(30)) + end
    rows = [(5, say("a")), (None, say("a", " x")), (None, say("b")), (None, say("c")), (None, say("c", " x")), (7, say("d")), (7, say("d", " x")),
            (7, say("e")), (8, say("f")), (8, say("f")), (9, say("e", " x")), (None, None), (None, "")]
    df = documents(rows)
    got = collections.Counter((r.doc_id, (r.text or "").removesuffix(" x")) for r in jaccard_join.one_per_group(df.withColumn("_row", F.lit(1))).collect())
    assert got == collections.Counter([(5, say("a")), (None, say("b")), (None, say("c")), (7, say("d")), (7, say("e")), (8, say("f")), (None, ""), (None, "")])


def test_one_large_group_of_near_copies(documents):
    rng, base = random.Random(2), [f"t{i}" for i in range(120)]
    rows = []
    for i in range(600):
        words = list(base)
        for _ in range(i % 5):
            words[rng.randrange(120)] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    assert grouped(jaccard_join.similar_groups(documents(rows))) == similar(rows)


def repeats(rows, least=100):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for k in range(len(data) - least + 1):
            if data[k : k + least] in seen:
                covered[k : k + least] = b"\1" * least
            else:
                seen.add(data[k : k + least])
        spans = sum(1 for k in range(len(data)) if covered[k] and (k == 0 or not covered[k - 1]))
        out[i] = (len(data), spans, bytes(b for b, c in zip(data, covered, strict=True) if not c))
    return out


def removed(df):
    return {r.doc_id: (r.n_bytes, len(r.spans), bytes(r.kept)) for r in df.collect()}


def passages(seed, alphabet):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared, rows = [text(rng.randint(80, 400)) for _ in range(10)], []
    for i in range(150):
        t = text(rng.randint(0, 150))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            t += p[rng.randint(0, 60) : len(p) - rng.randint(0, 60)] + text(rng.randint(0, 40))
        if rng.random() < 0.1:
            t = t[:20] * 20
        rows.append((2 * i, t))
    return rows + [(9000 + i, t) for i, t in EMPTY] + [(9900, rows[5][1])]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij ", "abcdefghijklmnopqrstuvwxyz é"])
@pytest.mark.parametrize("limits", [{}, {"group": 2, "share": 3}])
def test_repeated_strings(documents, alphabet, limits):
    rows = passages(5, alphabet)
    assert removed(suffix_dedup.remove_repeats(documents(rows), **limits)) == repeats(rows)


@pytest.mark.parametrize("least", [50, 170, 250, 300])
def test_repeated_strings_of_other_lengths(documents, least):
    rows = passages(7, "abc ")
    rows += [(20_000 + i, "ab" * 40 + rows[k][1] * 2) for i, k in enumerate(range(0, 40, 3))]
    assert removed(suffix_dedup.remove_repeats(documents(rows), least=least)) == repeats(rows, least)


def test_strings_shorter_than_an_anchor_are_refused():
    with pytest.raises(ValueError):
        suffix_dedup.Segments(np.zeros(64, np.uint8), np.array([0, 64]), 31)


def occurrences(rows, size):
    """Every place of every string of `size` bytes."""
    found = collections.defaultdict(set)
    for i, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - size + 1):
            found[data[k : k + size]].add((i, k))
    return found


@pytest.mark.parametrize("least", [50, 100, 170, 300])
@pytest.mark.parametrize("limits", [{}, {"group": 2, "share": 3}])
def test_groups_list_every_occurrence(documents, least, limits):
    rows = passages(9, "abcdefghij ")
    rows += [(20_000 + i, rows[i][1]) for i in range(0, 60, 2)] + [(30_000 + i, rows[i][1] + rows[i + 1][1]) for i in range(20)]
    texts = {i: (t or "").encode() for i, t in rows}
    table = documents(rows).select(F.col("doc_id").alias("doc"), "text")
    groups = collections.defaultdict(list)
    for r in suffix_dedup.repeat_groups(table, least, **limits).collect():
        groups[r.anchor, r.part].append((r.doc, r.start, r.stop, r.first))
    by_string = {}
    sizes = collections.defaultdict(set)
    for group in groups.values():
        strings = {texts[d][a:b] for d, a, b, _ in group}
        assert len(strings) == 1 and len(group) > 1
        string = strings.pop()
        places = {(d, a) for d, a, _, _ in group}
        assert len(places) == len(group) and len(string) >= least
        assert string not in by_string or limits  # a crowded anchor's strings may come more than once
        by_string[string] = places
        assert {(d, a) for d, a, _, first in group if first} == {min(places)}
        sizes[len(string)].add(string)
    for size, strings in sizes.items():
        every = occurrences(rows, size)
        assert all(every[s] == by_string[s] for s in strings)
    most = collections.Counter()
    for string, places in by_string.items():
        for k in range(len(string) - least + 1):
            most[string[k : k + least]] = max(most[string[k : k + least]], len(places))
    repeated = {s: len(p) for s, p in occurrences(rows, least).items() if len(p) > 1}
    assert repeated and most == repeated


def test_groups_of_copies(documents):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = text(140)
    two = text(60) + passage + text(60)
    rows = [(1, passage + text(30)), (2, two), (3, two), (4, text(10) + passage), (5, None), (6, "")]
    found = suffix_dedup.repeat_groups(documents(rows).select(F.col("doc_id").alias("doc"), "text")).collect()
    assert {r.doc for r in found} == {1, 2, 3, 4}
    inside = collections.defaultdict(set)
    for r in found:
        inside[r.anchor, r.part].add(r.doc)
    assert set(map(frozenset, inside.values())) == {frozenset({1, 2, 3, 4}), frozenset({2, 3})}
    assert suffix_dedup.repeat_groups(documents([]).select(F.col("doc_id").alias("doc"), "text")).count() == 0


def test_repeated_strings_of_the_sample(documents, sample):
    rows = [r[:2] for r in sample]
    assert removed(suffix_dedup.remove_repeats(documents(rows))) == repeats(rows)


def test_repeated_strings_of_odd_rows(documents, clashing):
    rng = random.Random(1)
    line = "".join(rng.choice("abcdefgh") for _ in range(150))
    rows = [(7, line), (7, line), (7, "x" + line), (None, line), (3, line[:99]), (4, line * 3000), *EMPTY]
    got = suffix_dedup.remove_repeats(clashing(documents(rows))).collect()
    kept = collections.Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got)
    assert kept[(4, 450_000, line.encode())] == 1 and kept[(3, 99, line[:99].encode())] == 1
    assert kept[(7, 150, b"")] == 2 and kept[(7, 151, b"x")] == 1 and kept[(None, 150, b"")] == 1
    assert kept[(1, 0, b"")] == 1 and len(got) == len(rows)


def test_maximal_repeats_are_all_and_cannot_be_extended():
    rng = random.Random(4)
    for _ in range(200):
        lefts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 6))).encode() for _ in range(6)]
        rights = [b"X" + "".join(rng.choice("ab") for _ in range(rng.randint(0, 6))).encode() for _ in range(6)]
        found = {(le, ri, tuple(sorted(m))) for le, ri, m in suffix_dedup.maximal_repeats(lefts, rights, 4)}
        wanted = set()
        for a in range(6):
            for b in range(a):
                le, ri = suffix_dedup.common(lefts[a], lefts[b]), suffix_dedup.common(rights[a], rights[b])
                if le + ri >= 4:
                    both = [k for k in range(6) if lefts[k][:le] == lefts[a][:le] and rights[k][:ri] == rights[a][:ri]]
                    wanted.add((le, ri, tuple(both)))
        assert found == wanted
