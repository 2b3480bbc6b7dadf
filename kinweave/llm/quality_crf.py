"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Every line is good or bad.  Its features are binned measures of the line itself and of the
lines before and after it; the chain adds how labels follow each other.  Forward-backward
passes give each line the probability of being good, and a text scores their mean,
weighted by the lines' lengths.  For fitting, a line carries the label of its document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.common import held_out, ship
from kinweave.llm.textvec import BLANK, LOWER, Spans, slices, texts, words

#: Labelled documents the model is fitted on, at most.
SAMPLE = 4000
BINS = 8

UPPER, LOW, DIGIT, HIGH, SYMBOL, STOP, MARK, ELSE = range(8)
KIND = np.full(256, ELSE, np.uint8)
KIND[65:91], KIND[97:123], KIND[48:58], KIND[128:] = UPPER, LOW, DIGIT, HIGH
KIND[list(b"#*$%&|<>@^~_=+\\{}[]/")] = SYMBOL
KIND[list(b".!?")] = STOP
KIND[list(b",;:'\"-()")] = MARK
KIND[BLANK] = ELSE + 1


@dataclass
class Lines:
    """The lines of some texts that hold a word: measures, weights, and how many each text has."""

    measures: np.ndarray
    weight: np.ndarray
    counts: np.ndarray


MEASURES = (
    "bytes", "words", "word_length", "upper", "digits", "symbols", "stops", "marks", "long_bytes", "capitalised", "ends_in_symbol",
    "short_words", "same_as_last", "same_as_second_last", "seen_before", "stop_words_end", "ends_in_stop", "starts_upper",
    "exclamations", "line_seen", "line_count", "place",
)


def _seen(hashes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether an equal value stands earlier in the same group."""
    order = np.lexsort((np.arange(len(hashes)), hashes, group))
    out = np.zeros(len(hashes), bool)
    out[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (group[order[1:]] == group[order[:-1]])
    return out


def measure_lines(column: pa.Array) -> Lines:
    data, offsets = texts(column)
    starts, ends, row = words(data, offsets)
    if not len(starts):
        return Lines(np.zeros((0, len(MEASURES))), np.zeros(0), np.zeros(len(column), np.int64))
    breaks = np.cumsum(data == 10)
    # A line is the words of one text between two line breaks.
    new = np.ones(len(starts), bool)
    new[1:] = (row[1:] != row[:-1]) | (breaks[starts[1:]] != breaks[starts[:-1]])
    head = np.flatnonzero(new)
    line = np.cumsum(new) - 1
    tail = np.append(head[1:], len(starts)) - 1
    first, last, text = starts[head], ends[tail], row[head]
    n = len(head)

    kinds = KIND[data]
    solid = np.zeros((9, n))
    for k in range(9):
        sums = np.append(0, np.cumsum(kinds == k, dtype=np.int32))
        solid[k] = sums[last] - sums[first]
    bangs = np.append(0, np.cumsum(data == 33, dtype=np.int32))
    size = solid[:8].sum(axis=0)
    count = (tail - head + 1).astype(float)
    letters = np.maximum(solid[UPPER] + solid[LOW] + solid[HIGH], 1)
    mean = lambda x: np.bincount(line, x, n) / count

    spans = Spans(LOWER[data])
    word = spans.hash(starts, ends)
    together = np.zeros(len(word), bool)
    together[1:] = (word[1:] == word[:-1]) & ~new[1:]
    second = np.zeros(len(word), bool)
    second[2:] = (word[2:] == word[:-2]) & ~new[2:] & ~new[1:-1]
    length = ends - starts
    counts = np.bincount(text, minlength=len(column))
    per_line = np.repeat(counts, counts)
    place = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    measures = np.stack([
        np.log1p(size), np.log1p(count), size / count, solid[UPPER] / letters, solid[DIGIT] / size, solid[SYMBOL] / size,
        solid[STOP] / count, solid[MARK] / count, solid[HIGH] / size, mean(kinds[starts] == UPPER), mean(kinds[ends - 1] == SYMBOL),
        mean(length <= 1), mean(together), mean(second), mean(_seen(word, line)), mean(kinds[ends - 1] == STOP),
        kinds[last - 1] == STOP, kinds[first] == UPPER, (bangs[last] - bangs[first]) / count,
        _seen(spans.hash(first, last), text), np.log1p(per_line), place / per_line,
    ], axis=1).astype(np.float32)
    return Lines(measures, size, counts)


def _binned(lines: Lines, edges: list[np.ndarray]) -> np.ndarray:
    """(line, feature) -> weight index: own bins, then those of the line before and after."""
    width, wide = len(edges), BINS + 2
    own = np.stack([np.searchsorted(e, lines.measures[:, k], "right") for k, e in enumerate(edges)], axis=1) if len(
        lines.measures) else np.zeros((0, width), np.int64)
    none = np.full((1, width), BINS + 1)
    before, after = np.concatenate([none, own[:-1]]), np.concatenate([own[1:], none])
    ends = np.cumsum(lines.counts[lines.counts > 0])
    if len(ends):
        before[np.append(0, ends[:-1])] = BINS + 1
        after[ends - 1] = BINS + 1
    base = np.arange(width) * wide
    block = width * wide
    return np.concatenate([own + base, before[: len(own)] + base + block, after[len(after) - len(own):] + base + 2 * block], axis=1)


class Chains:
    """Forward-backward passes over sequences of two-state nodes, all texts at once."""

    def __init__(self, counts: np.ndarray):
        self.sizes = counts[counts > 0]
        first = np.cumsum(self.sizes) - self.sizes
        order = np.argsort(-self.sizes, kind="stable")
        self.first, self.sorted = first[order], self.sizes[order]
        self.active = [int(np.searchsorted(-self.sorted, -t, "left")) for t in range(int(self.sizes.max(initial=0)))]

    def marginals(self, emission: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(probability of state 1 at each node, expected steps 2 x 2, sum of log Z)."""
        node = np.stack([np.ones(len(emission)), np.exp(np.clip(emission, -30, 30))], axis=1)
        move = np.exp(steps)
        alpha, beta = np.zeros_like(node), np.ones_like(node)
        scale = np.ones(len(node))
        for t, n in enumerate(self.active):
            at = self.first[:n] + t
            now = node[at] if t == 0 else (alpha[at - 1] @ move) * node[at]
            scale[at] = now.sum(axis=1)
            alpha[at] = now / scale[at, None]
        for t in range(len(self.active) - 1, 0, -1):
            at = self.first[: self.active[t]] + t
            beta[at - 1] = ((node[at] * beta[at]) @ move.T) / scale[at, None]
        inner = np.ones(len(node), bool)
        inner[self.first] = False
        at = np.flatnonzero(inner)
        pairs = alpha[at - 1][:, :, None] * move * (node[at] * beta[at] / scale[at, None])[:, None, :]
        both = alpha * beta
        return both[:, 1] / np.maximum(both.sum(axis=1), 1e-300), pairs.sum(axis=0), float(np.log(scale).sum())


@dataclass
class Model:
    edges: list[np.ndarray]
    weights: np.ndarray
    steps: np.ndarray
    prior: float

    def score(self, column: pa.Array) -> np.ndarray:
        lines = measure_lines(column)
        out = np.full(len(column), self.prior)
        filled = np.flatnonzero(lines.counts)
        if len(filled):
            emission = self.weights[_binned(lines, self.edges)].sum(axis=1) + self.weights[-1]
            good = Chains(lines.counts).marginals(emission, self.steps)[0]
            ends = np.cumsum(lines.counts[filled]) - lines.counts[filled]
            out[filled] = np.add.reduceat(good * lines.weight, ends) / np.add.reduceat(lines.weight, ends)
        return out


def fit_lines(lines: Lines, labels: np.ndarray, rounds: int = 200, rate: float = 0.05, ridge: float = 1e-4) -> Model:
    """Maximum likelihood by Adam; `labels` has one 0 or 1 per text."""
    edges = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) if len(c) else np.zeros(0) for c in lines.measures.T]
    edges = [np.unique(np.append(e, [0.05, 0.3])) if len(e) < 3 else e for e in edges]
    edges = [e[:BINS] for e in edges]
    features = _binned(lines, edges)
    chains, filled = Chains(lines.counts), lines.counts > 0
    wanted = np.repeat(labels[filled], lines.counts[filled]).astype(float)
    inner = np.ones(len(wanted), bool)
    inner[np.cumsum(lines.counts[filled]) - lines.counts[filled]] = False
    seen = np.zeros((2, 2))
    at = np.flatnonzero(inner)
    np.add.at(seen, (wanted[at - 1].astype(int), wanted[at].astype(int)), 1)
    size = 3 * len(edges) * (BINS + 2) + 1
    point, first, second = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    total = max(len(wanted), 1)
    for t in range(1, rounds + 1 if len(wanted) else 1):
        weights, steps = point[:size], point[size:].reshape(2, 2)
        good, pairs, _ = chains.marginals(weights[features].sum(axis=1) + weights[-1], steps)
        error = good - wanted
        slope = np.zeros_like(point)
        slope[:size] = np.bincount(features.ravel(), np.repeat(error, features.shape[1]), size)
        slope[size - 1] = error.sum()
        slope[size:] = (pairs - seen).ravel()
        slope = slope / total + ridge * point
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        point = point - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    prior = float(labels.mean()) if len(labels) else 0.5
    return Model(edges, point[:size], point[size:].reshape(2, 2), prior)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on `sample` labelled documents at most, those with the smallest hash of their id.

    Measures are taken on the executors; the driver gets numbers of lines and their measures
    only.  A document labelled more than once counts as good when its labels are on average;
    of rows that share a key, one is learned from, that with the smallest hash of its text.
    """
    ship(docs.sparkSession)
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("l_key")).agg((F.avg(label) >= 0.5).alias("good"))
    drawn = known.orderBy(F.xxhash64("l_key"), "l_key").limit(sample)  # so the broadcast has `sample` rows at most
    rows = docs.select(F.col(key).alias("l_key"), F.col(text).alias("t")).where("t is not null")
    rows = rows.join(F.broadcast(drawn), "l_key")
    one = Window.partitionBy("l_key").orderBy("mark")
    rows = rows.withColumn("mark", F.xxhash64("t")).withColumn("n", F.row_number().over(one)).where("n = 1")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", 1 << 18):
                lines = measure_lines(part.column("t"))
                ends = np.cumsum(lines.counts)
                both = np.concatenate([lines.weight[:, None], lines.measures], axis=1).astype("<f4")
                blobs = [both[a:b].tobytes() for a, b in zip(ends - lines.counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("l_key").cast(pa.string()), part.column("good"), pa.array(blobs, pa.binary())], names=["k", "good", "m"])

    table = rows.select("l_key", "good", "t").mapInArrow(measured, "k string, good boolean, m binary").toPandas()
    table = table.sort_values("k", kind="stable")
    parts = [np.frombuffer(m, "<f4").reshape(-1, len(MEASURES) + 1) for m in table["m"]]
    every = np.concatenate(parts) if parts else np.zeros((0, len(MEASURES) + 1))
    lines = Lines(every[:, 1:], every[:, 0].astype(float), np.array([len(p) for p in parts], np.int64))
    return fit_lines(lines, table["good"].to_numpy(bool).astype(float))


def quality(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The probability that a text is good, from its whole text; the share of good ones where it has no word."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = [sent.value.score(p.column("t")) for p in slices(pa.RecordBatch.from_arrays([column], names=["t"]), "t", 1 << 18)]
            yield pa.array(np.concatenate(parts) if parts else [], pa.float64())

    scored.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scored, "double")(F.coalesce(F.col(text), F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """key, held_out, score (0 to 1, higher: likelier good) and predicted of every row.

    Defined cases: NULL, empty and blank texts get the share of good documents as score; a
    NULL key counts as held out and NULL labels are not learned; a score of 0.5 predicts
    1; repeated rows score alike; an empty table gives no rows, and without labels every
    text with words scores 0.5.
    """
    model = model or fit(docs, labels, key, text)
    rows = docs.select(F.col(key).alias("_key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("_text"))
    rows = rows.withColumn("score", quality(rows, model, "_text"))
    return rows.select(F.col("_key").alias(key), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
