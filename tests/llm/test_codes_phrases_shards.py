"""Vector codes, collocations and sharding against brute force, and their defined cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave.llm import collocations as phrases
from kinweave.llm.collocations import collocations, parse
from kinweave.llm.sharding import shards, write_shards
from kinweave.llm.vector_codes import compress, digest, hilbert, shortlist

VECTORS = "vec_id long, embedding array<float>, label int"


# Vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """{vec_id: (code, error)} and codebooks, in Python integers."""
    kept = sorted((k, [math.floor(4096 * float(x)) for x in v]) for k, v in rows)
    width = len(kept[0][1]) // parts
    part = {k: [v[p * width : (p + 1) * width] for p in range(parts)] for k, v in kept}
    books = [[part[k][p] for k, _ in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = [[[] for _ in books[p]] for p in range(parts)]
        for x in part.values():
            for p in range(parts):
                groups[p][nearest(p, x[p])[1]].append(x[p])
        books = [[[sum(c) // len(g) for c in zip(*g)] if g else e for g, e in zip(groups[p], books[p])] for p in range(parts)]
    found = {k: [nearest(p, x[p]) for p in range(parts)] for k, x in part.items()}
    return {k: ([i for _, i in n], sum(d for d, _ in n)) for k, n in found.items()}, books


def test_codes_are_those_of_brute_force(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(5, 16))
    vectors = [(i * 3, (centers[i % 5] + rng.normal(size=16) / 9).astype(np.float32).tolist(), i % 4 or None) for i in range(700)]
    vectors += [(5000 + i, vectors[0][1], 1) for i in range(300)]
    bad = [(1, None, 1), (2, [], 1), (4, [float("nan")] * 16, 2), (5, [1.0] * 15 + [None], 3), (7, [float("inf")] * 16, 3), (8, [1.0] * 8, 0)]
    coded, books = compress(spark.createDataFrame(vectors + bad, VECTORS))
    rows = coded.collect()
    want, want_books = plain_codes([(k, v) for k, v, _ in vectors])
    assert {r.vec_id: (r.code, r.error) for r in rows} == want and len(rows) == 1000
    assert books.tolist() == want_books
    assert digest(books) == hashlib.sha256(",".join(str(c) for p in want_books for e in p for c in e).encode()).hexdigest()
    labels = Counter()
    for k, _, label in vectors:
        labels[label] += want[k][1]
    assert {r.label: r.label_error for r in rows} == dict(labels)


def test_codes_defined_cases(spark, clashing):
    none, books = compress(spark.createDataFrame([(1, None, 2)], VECTORS))
    assert none.collect() == [] and books.size == 0
    assert compress(spark.createDataFrame([], VECTORS))[0].collect() == []
    few = [(None, [1.0] * 8, None), (None, [1.0] * 8, None), (4, [-0.5] * 8, 1), (4, [0.25] * 8, 1)]
    rows = compress(clashing(spark.createDataFrame(few, VECTORS)))[0].collect()
    assert [r.error for r in rows] == [0] * 4 and {r.label_error for r in rows} == {0}
    assert sorted((r.vec_id or 0, r.code[0]) for r in rows) == [(0, 2), (0, 2), (4, 0), (4, 1)]
    with pytest.raises(ValueError):
        compress(spark.createDataFrame([(1, [1.0] * 9, 1)], VECTORS))


@pytest.mark.parametrize(("d", "bits"), [(2, 4), (3, 3), (8, 1)])
def test_hilbert_curve_visits_every_cell_by_single_steps(d, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
    place = hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(place)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shortlists_lose_no_nearest_entry_and_get_short():
    rng = np.random.default_rng(5)
    lengths = []
    for _ in range(300):
        entries = rng.integers(-40, 40, (16, 4))
        x = rng.integers(-40, 40, 4) + rng.integers(-3, 4, (50, 4))
        near = shortlist(x.min(0), x.max(0), entries)
        best = ((x[:, None] - entries[None]) ** 2).sum(2)
        assert {int(np.flatnonzero(row == row.min())[0]) for row in best} <= set(near.tolist())
        assert np.array_equal(near[best[:, near].argmin(1)], best.argmin(1))
        lengths.append(len(near))
    assert np.mean(lengths) < 8


# Collocations


def plain_collocations(rows, least, keep=2000, most=5):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            for n in range(1, most + 1):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        ranked, frequent = [], {p: c for p, c in f.items() if c >= least and len(p) > 1}
        inside = {}
        for p, c in frequent.items():
            for size in range(2, len(p)):
                for at in range(len(p) - size + 1):
                    part = p[at : at + size]
                    inside[part] = max(inside.get(part, 0), c)
        for p, a in frequent.items():
            if inside.get(p, -1) >= a:
                continue
            score, k = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:keep], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def found_collocations(df, **options):
    return sorted(tuple(r) for r in collocations(df, **options).collect())


def test_collocations_are_those_of_brute_force(spark, documents, sample):
    rows = [(lang, text) for _, text, lang, _ in sample]
    assert found_collocations(documents(sample), least=8) == plain_collocations(rows, 8)
    assert found_collocations(documents(sample), least=8, keep=5) == plain_collocations(rows, 8, 5)


def test_collocations_of_few_words_and_odd_texts(spark, documents, clashing):
    rng = random.Random(4)
    words = ["a", "B", "ä", "日本", "cc", " x"]
    gaps = [" "] * 8 + ["\t", ", ", ".\n", "  ", "!?", "\x0b"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    texts += [None, "", " \t\n.;", "x", "Go go " * 3000, "y " * 20_000 + "z. z", texts[0], texts[0]]
    rows = [(i, t, rng.choice(["en", "de", None]), "s") for i, t in enumerate(texts)] + [(1, texts[1], "en", "s")] * 30
    want = plain_collocations([(lang, t) for _, t, lang, _ in rows], 12)
    assert len(want) > 100
    assert found_collocations(clashing(documents(rows)), least=12) == want
    assert collocations(documents([])).collect() == []
    with pytest.raises(ValueError):
        collocations(documents([]), most=1)


def test_counted_rows_take_no_hashes_along(spark, documents, monkeypatch):
    added, sent = phrases._added, []
    monkeypatch.setattr(phrases, "_added", lambda found, least: sent.append(found.columns) or added(found, least))
    rows = [(i, f"w{i} often seen v{i}", "en" if i % 2 else None, "s") for i in range(40)]
    chunks = parse(documents(rows))
    assert sorted(map(tuple, phrases.frequent_phrases(chunks, 20).collect())) == [
        (lang, n, p, 20) for lang in ("en", "und") for n, p in ((1, "often"), (1, "seen"), (2, "often seen"))]
    assert sent == [["lang", "words", "phrase", "f"]] * 2
    pairs = phrases._frequent_pairs(chunks, np.full(1 << 23, 255, np.uint8), 1)
    assert pairs.count() == 2 * 41 and pairs.where("h & 16777215 <> 0").count() == 0


def test_hashes_that_meet_are_told_apart():
    weight, h, check = np.array([1, 2, 3, 4]), np.array([7, 7, 9, 7], np.uint64), np.array([1, 2, 5, 1], np.uint64)
    which, total = phrases._summed(weight, h, check)
    assert sorted(zip(h[which].tolist(), check[which].tolist(), total.tolist())) == [(7, 1, 5), (7, 2, 2), (9, 5, 3)]


def test_parse_owns_every_word_once_and_shares_passages(spark, documents):
    rng = random.Random(9)
    passage = " ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 300)) for _ in range(2000))
    rows = [(i, f"start{i} {passage} end{i}", "en", "s") for i in range(50)]
    chunks = parse(documents(rows)).collect()
    assert sum(c.own * c.times for c in chunks) == 50 * 2002
    shared = [c for c in chunks if c.times == 50]
    assert sum(c.own for c in shared) > 1800 and all(len(c.text.split()) <= c.own + 4 for c in chunks)


# Sharding


def plain_shards(rows, count):
    """{key: shard} for rows (key, size, coordinates): every cut by sorting."""
    dims = range(len(rows[0][2]))
    extent = [max(r[2][d] for r in rows) - min(r[2][d] for r in rows) for d in dims]
    out = {}

    def divide(part, first, leaves):
        if leaves == 1 or not part:
            out.update({r[0]: first for r in part})
            return
        width = [(max(r[2][d] for r in part) - min(r[2][d] for r in part)) / extent[d] if extent[d] else 0 for d in dims]
        dim = width.index(max(width))
        half, total, upto, left, right = leaves // 2, sum(r[1] for r in part), 0, [], []
        for r in sorted(part, key=lambda r: (r[2][dim], r[0])):
            upto += r[1]
            (left if leaves * (2 * upto - r[1]) <= 2 * half * total else right).append(r)
        divide(left, first, half)
        divide(right, first + half, leaves - half)

    divide(rows, 0, count)
    return out


def slots_are_gapless(rows):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.place.shard, []).append(r.place.slot)
    return all(sorted(s) == list(range(len(s))) for s in by_shard.values())


@pytest.mark.parametrize("count", [1, 2, 7, 24])
def test_shards_are_those_of_sorting(spark, count):
    rng = random.Random(count)
    rows = [(i, "x" * rng.choice([3, 50, 400]), rng.choice([0, 0, 0, 5, 9]), rng.randint(0, 10**6), rng.random() < 0.5) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, a int, b long, c boolean").repartition(5)
    got = shards(df, count, dimensions=("a", "b", "c"), carry=("doc_id",)).collect()
    want = plain_shards([(i, len(t) + 8, (a, b, int(c))) for i, t, a, b, c in rows], count)
    assert {r.doc_id: r.place.shard for r in got} == want
    assert slots_are_gapless(got)
    sizes = Counter()
    for r in got:
        sizes[r.place.shard] += r.place.size
    assert len(sizes) == count and max(sizes.values()) - min(sizes.values()) <= 2 * 408


def test_shards_defined_cases(spark, documents, clashing):
    texts = [(i, t, lang, s) for i, (t, lang, s) in enumerate([(None, None, None), ("", "en", "a"), ("é" * 100_000, "de", "src1")] * 3)]
    copies = [(7, "same", "en", "hot")] * 4000 + [(None, "same", "en", "hot")] * 3000
    df = clashing(documents(texts + copies))
    rows = shards(df, 6).collect()
    assert len(rows) == 7009 and slots_are_gapless(rows)
    assert Counter(r.text for r in rows) == Counter(t[1] for t in texts + copies)
    assert {r.place.size for r in rows if r.text and r.text.startswith("é")} == {200_008}
    assert shards(documents([]), 6).collect() == []
    assert {r.place.shard for r in shards(documents([(1, "x")]), 24).collect()} <= set(range(24))
    assert len(shards(documents(texts), 3, dimensions=("nothing",)).collect()) == 9
    named = documents(texts).withColumn("place", F.lit(1))
    assert shards(named, 2).columns[-1] == "_place"
    for wrong in ({}, {"count": 2, "target_bytes": 5}, {"count": 0}):
        with pytest.raises(ValueError):
            shards(documents(texts), **wrong)


def test_rows_of_one_key_are_numbered_in_parts(spark, documents, monkeypatch):
    monkeypatch.setattr("kinweave.llm.sharding.NUMBERED", 10)
    rows = [(7, f"t{i}", "en", "hot") for i in range(900)] + [(i, "x", "en", "a") for i in range(300)]
    assert slots_are_gapless(shards(documents(rows).repartition(8), 3).collect())


def test_shards_bound_their_metadata_and_can_be_written(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    total = docs.agg(F.sum(F.octet_length("text") + 8)).first()[0]
    placed = shards(docs, target_bytes=total // 4)
    write_shards(placed, f"{tmp_path}/out", rows_per_file=20)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4
    assert back.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).count() == 0
    spans = back.groupBy("shard").agg(F.countDistinct("source").alias("n")).collect()
    assert min(s.n for s in spans) < docs.select("source").distinct().count()


def test_text_coordinates_keep_the_order_of_the_texts(spark, documents):
    sources = ["src1", "src10", "src2", "srcä", "src", None, "src2x"]
    rows = [(i, "t" * 10, "en", s) for i, s in enumerate(sources * 30)]
    got = shards(documents(rows), 3, dimensions=("source",)).collect()
    bounds = sorted((r.place.shard, (r.source or "").encode(), r.source is not None) for r in got)
    by_order = sorted(got, key=lambda r: (r.source is not None, (r.source or "").encode()))
    assert [r.place.shard for r in by_order] == sorted(b[0] for b in bounds)
