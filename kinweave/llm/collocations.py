"""Phrase collocations by prefix-free parsing.

A text is parsed into chunks that its own words delimit: a chunk starts at the text's start
and wherever the hash of the next words is a trigger, and reaches those words beyond the next
chunk's start, so that neighbours overlap.  Equal passages parse alike wherever they stand, so the
dictionary of distinct chunks with their frequencies is all that is counted from here on: phrases
inside a chunk, weighted by the chunk's frequency, each by the chunk that owns its first word.

Phrases below the least frequency are never gathered: words are counted first, then pairs of
frequent words, then the phrases all of whose pairs are frequent.  Fixed-size bitmaps of hashes
say what may be frequent; they let too much through, never too little, and the counts that
come out are sums by the phrases themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.bitmaps import bitmap, is_set
from kinweave.llm.common import ship
from kinweave.llm.textvec import LOWER, Spans, give_back, mix, slices, texts, words
from kinweave.session import cut

#: Words of the longest phrase; a chunk reaches one word less beyond its own.
MOST_WORDS = 5
#: One window of words in so many is a trigger, by the top bits of its hash.
TRIGGER_BITS = 5
SLICE = 1 << 22
HELD = 2_000_000
#: What is sent of a pair's hash.
PAIR_BITS = ~np.uint64((1 << 24) - 1)
UNDETERMINED = "und"

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
GAP = BREAK.copy()
GAP[[ord(" "), ord("\t")]] = True
_MADE = np.random.Generator(np.random.PCG64(12))
SECOND_BYTE = _MADE.integers(0, 2**64, 256, dtype=np.uint64)
STEP = _MADE.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of any spans, overlapping or not, as one text column."""
    lengths = ends - starts
    offsets = np.append(0, np.cumsum(lengths))
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])]
    ).cast(pa.large_string()).cast(pa.string())


def _runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each word on."""
    value = np.full(len(hashes) - n + 1, n, np.uint64)
    for k in range(n):
        value += hashes[k : len(hashes) - n + 1 + k] * STEP[k]
    return mix(value)


def _chunks(langs: pa.Array, column: pa.Array, most: int) -> pa.RecordBatch | None:
    """(lang, own, text): the chunks of a batch of texts, words separated by a blank, pieces by a line break."""
    data, offsets = texts(column)
    data = LOWER[data]
    starts, ends, row = words(data, offsets, GAP)
    n = len(starts)
    if not n:
        return None
    breaks = np.append(0, np.cumsum(BREAK[data]))
    opens = np.ones(n, bool)
    opens[1:] = (breaks[starts[1:]] > breaks[ends[:-1]]) | (row[1:] != row[:-1])
    # Each word once more behind one separator, so that equal passages are equal bytes.
    lengths = ends - starts
    at = np.cumsum(lengths + 1) - lengths
    plain = np.empty(at[-1] + lengths[-1], np.uint8)
    plain[at - 1] = np.where(opens, 10, 32)
    plain[np.arange(lengths.sum()) + np.repeat(at - (np.cumsum(lengths) - lengths), lengths)] = data[
        np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)]

    begins = np.ones(n, bool)
    begins[1:] = row[1:] != row[:-1]
    width = most - 1
    if n > width:
        hashes = Spans(plain).hash(at, at + lengths)
        windows = _runs(hashes, width) >> np.uint64(64 - TRIGGER_BITS) == 0
        begins[: len(windows)] |= windows & (row[: len(windows)] == row[width - 1 : n])
    first = np.flatnonzero(begins)
    own = np.diff(np.append(first, n))
    # Beyond its own words a chunk shows those that phrases begun in it may reach: to the piece's end.
    piece = np.cumsum(opens)
    piece_end = np.searchsorted(piece, piece, "right")
    last = first + own
    reach = np.where((last < n) & ~opens[np.minimum(last, n - 1)], np.minimum(last + width, piece_end[np.minimum(last, n - 1)]), last)
    text = _spans(plain, at[first], at[reach - 1] + lengths[reach - 1])
    return pa.RecordBatch.from_arrays([langs.take(pa.array(row[first])), pa.array(own.astype(np.int32)), text], names=["lang", "own", "text"])


def parse(docs: DataFrame, lang: str = "lang", text: str = "text", most: int = MOST_WORDS) -> DataFrame:
    """(lang, own, text, times): the dictionary of distinct chunks and how often each was parsed.

    `own` words of the chunk are its own, the others belong to the next chunk.
    """

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = _chunks(part.column("lang"), part.column("text"), most)
                if found is not None:
                    yield found

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.col(text).alias("text"))
    found = rows.mapInArrow(cut_up, "lang string, own int, text string")
    return found.groupBy("lang", "own", "text").agg(F.count(F.lit(1)).alias("times"))


@dataclass
class Words:
    """The words of some chunks: where each stands, its two hashes (of language and word), the run of words
    without a break that it is in, the weight of its chunk, and whether the chunk owns it."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    hashes: np.ndarray
    check: np.ndarray
    run: np.ndarray
    weight: np.ndarray
    owned: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch) -> Words:
        data, offsets = texts(batch.column("text"))
        starts, ends, row = words(data, offsets, GAP)
        opens = np.ones(len(starts), bool)
        opens[1:] = (row[1:] != row[:-1]) | (data[starts[1:] - 1] == 10)
        tongues = batch.column("lang").dictionary_encode()
        salts = [int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest()) for t in tongues.dictionary.to_pylist()]
        salt = np.array(salts, np.uint64)[tongues.indices.to_numpy()]
        first = np.searchsorted(row, row)
        return Words(
            data, starts, ends, row, mix(Spans(data).hash(starts, ends) ^ salt[row]), Spans(data, SECOND_BYTE).hash(starts, ends),
            np.cumsum(opens), batch.column("times").to_numpy()[row], np.arange(len(row)) - first < batch.column("own").to_numpy()[row],
        )

    def phrases(self, n: int) -> np.ndarray:
        """Where phrases of n words begin that the chunks own."""
        if len(self.run) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.owned[: len(self.run) - n + 1] & (self.run[: len(self.run) - n + 1] == self.run[n - 1 :]))


def _summed(weight: np.ndarray, hashes: np.ndarray, check: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(one index for each distinct hash, sum of its weights).  Values that share a hash are told apart by `check`."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(hashes)
    edge = np.append(True, hashes[order][1:] != hashes[order][:-1])
    if check is not None and (~edge[1:] & (check[order][1:] != check[order][:-1])).any():
        order = np.lexsort((check, hashes))
        edge = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (check[order][1:] != check[order][:-1]))
    at = np.flatnonzero(edge)
    return order[at], np.add.reduceat(weight[order], at)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches of chunks put together, so that more equal phrases meet in one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            held.append(part)
            if sum(b.nbytes for b in held) >= SLICE:
                yield pa.concat_batches(held)
                held = []
    if held:
        yield pa.concat_batches(held)
    give_back()


def _over(chunks: DataFrame, count: Callable[[Words, pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            found = Words.of(batch)
            if len(found.starts):
                yield from count(found, batch)

    return chunks.mapInArrow(run, schema)


def _rows(found: Words, batch: pa.RecordBatch, n: int, at: np.ndarray, hashes: np.ndarray, check: np.ndarray) -> pa.RecordBatch:
    """The distinct phrases of n words that begin at `at`, with their language and frequency."""
    which, total = _summed(found.weight[at], hashes, check)
    begin = at[which]
    # A single blank stands between the words of a piece, so a phrase is a span.
    phrase = _spans(found.data, found.starts[begin], found.ends[begin + n - 1])
    lang = batch.column("lang").take(pa.array(found.row[begin]))
    return pa.RecordBatch.from_arrays(
        [lang, pa.array(np.full(len(which), n, np.int32)), phrase, pa.array(total)], names=["lang", "words", "phrase", "f"])


PHRASES = "lang string, words int, phrase string, f long"


def _added(found: DataFrame, least: int) -> DataFrame:
    """Sums by the phrases themselves."""
    return found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def _frequent_words(chunks: DataFrame, least: int) -> DataFrame:
    def count(found: Words, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(found.owned)
        yield _rows(found, batch, 1, at, found.hashes[at], found.check[at])

    return _added(_over(chunks, count, PHRASES), least)


def _word_hashes(single: DataFrame) -> DataFrame:
    """(h) of words: worked out again for the frequent ones, not sent along with all words."""

    def hashes(found: Words, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(found.hashes.view(np.int64))], names=["h"])

    return _over(single.select("lang", F.col("words").alias("own"), F.col("phrase").alias("text"), F.col("f").alias("times")), hashes, "h long")


def _frequent_pairs(chunks: DataFrame, frequent: np.ndarray, least: int) -> DataFrame:
    """(h): hashes of all pairs of frequent words that are frequent, and of few others.  They go without their lowest
    bits, which the bitmap does not use: of 10^9 pairs one in 1,000 shares its hash, and most of these stay rare."""
    sent = chunks.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            hashes, total = (np.concatenate(x) for x in zip(*held))
            which, total = _summed(total, hashes)
            return hashes[which], total

        def batch_of(hashes: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(total)], names=["h", "f"])

        for batch in _gathered(batches):
            found = Words.of(batch)
            at = found.phrases(2)
            known = is_set(sent.value, found.hashes)
            at = at[known[at] & known[at + 1]] if len(at) else at
            if not len(at):
                continue
            hashes = _runs(found.hashes, 2)[at] & PAIR_BITS
            which, total = _summed(found.weight[at], hashes)
            held.append((hashes[which], total))
            if sum(len(h) for h, _ in held) > 2 * HELD:
                held = [merged()]
                if len(held[0][0]) > HELD:
                    yield batch_of(*held.pop())
        if held:
            yield batch_of(*merged())

    found = chunks.mapInArrow(run, "h long, f long")
    return found.groupBy("h").agg(F.sum("f").alias("f")).where(F.col("f") >= least).select("h")


def _frequent_phrases(chunks: DataFrame, pairs: np.ndarray, least: int, most: int) -> DataFrame:
    """Phrases of two words and more, of those all of whose pairs may be frequent."""
    sent = chunks.sparkSession.sparkContext.broadcast(pairs)

    def count(found: Words, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if len(found.run) < 2:
            return
        known = np.append(is_set(sent.value, _runs(found.hashes, 2)) & (found.run[1:] == found.run[:-1]), False)
        chain = known.copy()
        for n in range(2, most + 1):
            at = found.phrases(n)
            at = at[chain[at]] if len(at) else at
            if not len(at):
                return
            yield _rows(found, batch, n, at, _runs(found.hashes, n)[at], _runs(found.check, n)[at])
            chain[: len(chain) - n + 1] &= known[n - 1 :]
            chain[len(chain) - n + 1 :] = False

    return _added(_over(chunks, count, PHRASES), least)


def frequent_phrases(chunks: DataFrame, least: int, most: int = MOST_WORDS) -> DataFrame:
    """(lang, words, phrase, f): all phrases of up to `most` words with f of at least `least`, from the dictionary.

    Whatever is contained in a frequent phrase is as frequent, so every part of a phrase in the
    result is in it too.  Runs jobs.
    """
    single = cut(_frequent_words(chunks, least), "frequent_words")
    pairs = cut(_frequent_pairs(chunks, bitmap(_word_hashes(single)), least), "frequent_pairs")
    return single.unionByName(_frequent_phrases(chunks, bitmap(pairs), least, most))


def _part(split: Column, first: Column, count: Column) -> Column:
    return F.array_join(F.slice(split, first, count), " ")


def score_phrases(frequent: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, k, score) per phrase of two words and more, at its weakest cut.

    Products are decimals of 38 digits.  `sizes` is (lang, n).
    """
    many = frequent.where("words > 1").withColumnRenamed("f", "a")
    cuts = many.withColumn("w", F.split("phrase", " ")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "words", "a", "k", _part(F.col("w"), F.lit(1), F.col("k")).alias("left"),
        _part(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
    )
    found = (
        cuts.join(frequent.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(frequent.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .join(sizes, "lang")
    )
    exact = {c: F.col(c).cast("decimal(18,0)") for c in "anlr"}
    score = F.call_function("div", exact["a"] * exact["n"] * F.lit(1000).cast("decimal(4,0)"), exact["l"] * exact["r"])
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    grouped = found.groupBy("lang", "phrase", "words", "a", "n").agg(weakest.alias("cut"))
    return grouped.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.k", "cut.score")


def covered(frequent: DataFrame, share: int = 100) -> DataFrame:
    """(lang, phrase): phrases inside a longer one that has at least `share` percent of their frequency."""
    longer = frequent.where("words > 2").withColumn("w", F.split("phrase", " "))
    inside = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inside = inside.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    most = inside.select("lang", _part(F.col("w"), F.col("at"), F.col("size")).alias("phrase"), "f")
    most = most.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    held = frequent.where("words > 1").join(most, ["lang", "phrase"])
    return held.where(F.expr(f"{share} * f <= 100 * most")).select("lang", "phrase")


def collocations(
    docs: DataFrame, least: int = 100, keep: int = 2000, lang: str = "lang", text: str = "text", most: int = MOST_WORDS, share: int = 100,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `keep` collocations.

    Words are lower-cased (A-Z) runs without blanks and tabs within the pieces between [.,;:!?] and line breaks.
    A phrase of 2 to `most` words that stands at least `least` times scores by its weakest
    cut, floor(1000 * a * n / (l * r)); phrases that a longer one covers are left out.

    Defined cases: NULL and empty texts and texts without words have no phrases; NULL is
    the language `und`; ties in score and frequency go by the phrase's bytes; repeated rows count
    each; a text of any length is parsed whole; an empty table gives no rows; further columns
    are not looked at, whatever their names.  Runs jobs.
    """
    if not 2 <= most <= len(STEP):
        raise ValueError(f"phrases need from 2 to {len(STEP)} words at most")
    ship(docs.sparkSession)
    chunks = cut(parse(docs, lang, text, most), "chunks")
    sizes = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    frequent = cut(frequent_phrases(chunks, least, most), "phrases")
    scored = score_phrases(frequent, sizes).join(covered(frequent, share), ["lang", "phrase"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = scored.withColumn("rank", rank).where(F.col("rank") <= keep)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
