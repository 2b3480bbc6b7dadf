"""Best-fit packing by swap-based local search.

Every document becomes token ids and an end mark; longer ones are cut into full pieces with
the shorter piece first.  Only lengths decide how pieces lie together, so the lengths of all
pieces are counted, at most 1024 counters, and the driver packs the counts: best fit first, then
pieces are moved or exchanged between underfull bins, one for one or two for one, as long as
squared fill grows, until bins are empty.  Bins that hold the same lengths are one pattern
with a count, and a step is made for as many of them as there are.  So the packing is that of
the whole table at once, however lengths lie in files or tasks, and its work does not grow
with the number of documents.  A piece finds its place by its rank among those of its length:
tasks number their own, and the sums over the tasks before are added.  These are one row per
task, at most `TASKS`, so they are broadcast whatever the input, and ids stay where they are.
"""

from __future__ import annotations

import bisect
import os
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm.common import ship
from kinweave.llm.textvec import slices
from kinweave.llm.tokens import encoder, vocabulary_path
from kinweave.session import cut

LENGTH = 1024
END = 2
#: Tasks that cut pieces, at most; each takes 8 kB of a broadcast.
TASKS = 4_096

#: (size, how many) of the pieces of a bin, the largest first.
Pattern = tuple[tuple[int, int], ...]


def _filled(pattern: Pattern) -> int:
    return sum(size * k for size, k in pattern)


def best_fit_counts(counts: dict[int, int], length: int = LENGTH) -> dict[Pattern, int]:
    """How many bins of each pattern: the largest piece first, each into the fullest bin that takes it.

    A bin that has taken a piece is the fullest for the next of that size, while it has room.
    """
    by_room: list[dict[Pattern, int]] = [{} for _ in range(length + 1)]
    rooms = 0  # bit r of rooms: some bin has room r

    def put(room: int, pattern: Pattern, n: int) -> None:
        nonlocal rooms
        if n:
            by_room[room][pattern] = by_room[room].get(pattern, 0) + n
            rooms |= 1 << room

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                pattern, n = by_room[room].popitem()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, pattern, n = length, (), -(-left // (length // size))
            each = room // size
            whole = min(n, left // each)
            put(room - each * size, (*pattern, (size, each)), whole)
            left -= whole * each
            if whole < n:
                if left:
                    put(room - left * size, (*pattern, (size, left)), 1)
                put(room, pattern, n - whole - (left > 0))
                left = 0
    return {pattern: n for held in by_room for pattern, n in held.items()}


def search_counts(patterns: dict[Pattern, int], length: int = LENGTH) -> dict[Pattern, int]:
    """Move or exchange pieces between underfull bins while squared fill grows.

    The emptiest bin gives: a piece that another bin has room for, a piece for a smaller one, or two
    for a smaller one, to the bin that becomes fullest by it.  All bins of its pattern do so at
    once, as far as there are bins to take it: first steps of the most bins, then of half as many,
    at last of single ones.  Each step raises the sum of squared fills, so the
    search ends; it also ends when no fewer bins are possible.
    """
    patterns = dict(patterns)
    least = -(-sum(_filled(p) * n for p, n in patterns.items()) // length)
    for bit in range(max(patterns.values(), default=0).bit_length() - 1, -1, -1):
        _search(patterns, length, least, 1 << bit)
    return patterns


def _search(patterns: dict[Pattern, int], length: int, least: int, many: int) -> None:
    """Steps that `many` bins or more make at once, until there are none."""
    under = _Underfull([p for p, n in patterns.items() if n >= many], length)
    used, stuck, moved = sum(patterns.values()), set(), False
    while used > least:
        b = next((p for _, p in under.order if p not in stuck), None)
        if b is None and not moved:
            break
        if b is None:  # those that found nothing look again, until none of them does
            stuck, moved = set(), False
            continue
        found = under.better(b, patterns[b] >= 2 * many)
        if found is None:
            stuck.add(b)
            continue
        a, given, taken = found
        times = patterns[b] // 2 if a == b else min(patterns[a], patterns[b])
        b_after, a_after = _changed(b, taken, given), _changed(a, given, taken)
        for pattern, n in ((b, -times), (a, -times), (b_after, times), (a_after, times)):
            if pattern:
                patterns[pattern] = patterns.get(pattern, 0) + n
            else:
                used -= n
        for pattern in {b, a, b_after, a_after} - {()}:
            if patterns[pattern] >= many:
                under.add(pattern)
            else:
                under.remove(pattern)
            if not patterns[pattern]:
                del patterns[pattern]
        moved = True


def _changed(pattern: Pattern, more: tuple[int, ...], less: tuple[int, ...]) -> Pattern:
    held = dict(pattern)
    for size in more:
        held[size] = held.get(size, 0) + 1
    for size in less:
        held[size] -= 1
    return tuple(sorted(((size, k) for size, k in held.items() if k), reverse=True))


class _Underfull:
    """The patterns with room, the emptiest first, and each size that each of them holds."""

    def __init__(self, patterns: list[Pattern], length: int):
        self.length, self.order, self.rows = length, [], {}
        self._clear(4096)
        for pattern in patterns:
            self.add(pattern)

    def _clear(self, width: int) -> None:
        self.used, self.owners = 0, []
        self.size = np.zeros(width, np.int64)
        self.fill = np.full(width, 2 * self.length, np.int64)  # a row of no pattern: too full for anything

    def add(self, pattern: Pattern) -> None:
        fill = _filled(pattern)
        if fill >= self.length or pattern in self.rows:
            return
        bisect.insort(self.order, (fill, pattern))
        if self.used + len(pattern) > len(self.size):
            held = list(self.rows)
            self._clear(2 * sum(map(len, held)) + 4096)
            for other in held:
                self._fill(other)
        self._fill(pattern)

    def _fill(self, pattern: Pattern) -> None:
        rows = slice(self.used, self.used + len(pattern))
        self.size[rows], self.fill[rows] = [size for size, _ in pattern], _filled(pattern)
        self.owners += [pattern] * len(pattern)
        self.rows[pattern], self.used = rows, rows.stop

    def remove(self, pattern: Pattern) -> None:
        if pattern in self.rows:
            del self.order[bisect.bisect_left(self.order, (_filled(pattern), pattern))]
            self.fill[self.rows.pop(pattern)] = 2 * self.length

    def better(self, b: Pattern, itself: bool) -> tuple[Pattern, tuple[int, ...], tuple[int, ...]] | None:
        """(pattern, sizes it gets, sizes it gives) of the first step by which squared fill grows."""
        fill, sizes = _filled(b), [size for size, _ in b]
        fills, held = self.fill[: self.used], self.size[: self.used]
        if not itself:
            fills = fills.copy()
            fills[self.rows[b]] = 2 * self.length
        for size in sizes:  # move
            after = fills + size
            good = np.flatnonzero((after <= self.length) & (after > fill))
            if len(good):
                return self.owners[good[np.argmax(after[good])]], (size,), ()
        pairs = [(x, y) for i, (x, k) in enumerate(b) for y in ([x] if k > 1 else []) + sizes[i + 1 :]]
        left = fills - held
        for given in [(size,) for size in sizes] + pairs:  # exchange one, or two, for a smaller one
            after = left + sum(given)
            good = np.flatnonzero((held < sum(given)) & (after <= self.length) & (after > fill))
            if len(good):
                x = good[np.argmax(after[good])]
                return self.owners[x], given, (int(held[x]),)
        return None


def places(patterns: dict[Pattern, int]) -> list[tuple[int, int, int, int, int, int]]:
    """(size, first rank, rank after the last, bins, first bin, offset): where the pieces of a size go by rank.

    Those of one row fill the same place of all its bins in turn, then the next place.
    """
    out, taken, base = [], {}, 0
    for pattern, n in sorted(patterns.items()):
        at = 0
        for size, k in pattern:
            first = taken.get(size, 0)
            taken[size] = first + k * n
            out.append((size, first, taken[size], n, base, at))
            at += size * k
        base += n
    return out


def _dealt(sizes: np.ndarray, patterns: dict[Pattern, int]) -> np.ndarray:
    bins, order = np.zeros(len(sizes), np.int64), np.argsort(sizes, kind="stable")
    starts = np.searchsorted(sizes[order], np.arange(int(sizes.max(initial=0)) + 1))
    for size, first, last, n, base, _ in places(patterns):
        bins[order[starts[size] + first : starts[size] + last]] = base + np.arange(last - first) % n
    return bins


def best_fit(sizes: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The bin of every piece: the largest first, each into the fullest bin that takes it."""
    return _dealt(sizes, best_fit_counts(Counter(sizes.tolist()), length))


def local_search(sizes: np.ndarray, bins: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The bin of every piece after `search_counts`."""
    held = defaultdict(Counter)
    for size, b in zip(sizes.tolist(), bins.tolist(), strict=True):
        held[b][size] += 1
    patterns = Counter(tuple(sorted(h.items(), reverse=True)) for h in held.values())
    return _dealt(sizes, search_counts(patterns, length))


FIELDS = (("piece", "int"), ("start", "long"), ("length", "long"), ("ids", "binary"), ("task", "int"), ("rank", "long"))
PLACES = "p_length long, p_first long, p_last long, p_bins long, p_bin long, p_offset long"


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                   length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece: key, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset.

    `path` names the vocabulary file, by default the public byte-level one, and must be readable
    at that place on every executor.  Runs jobs that cut the pieces, and their numbers by length and task, into tables.
    Defined cases: NULL and empty texts are the end mark alone; repeated rows are packed
    each; a NULL key is kept; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or vocabulary_path()
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), *[T.StructField(n, T._parse_datatype_string(t)) for n, t in FIELDS]])
    types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        task, model, ranks = TaskContext.get().partitionId(), encoder(path), [0] * (length + 1)
        for batch in batches:
            key_type = batch.schema.field("key").type
            for part in slices(batch, "text", 1 << 18):
                ids, counts = model.encode(part.column("text"))
                ends = np.cumsum(counts)
                out = []
                for k, first, size in zip(part.column("key").to_pylist(), (ends - counts).tolist(), counts.tolist(), strict=True):
                    every = np.append(ids[first : first + size], np.uint32(end)).astype("<u4")
                    size += 1
                    head = size % length if size > length else size
                    at = 0
                    for n, stop in enumerate([*([head] if head else []), *range(head + length, size + 1, length)]):
                        out.append((k, n, at, stop - at, every[at:stop].tobytes(), task, ranks[stop - at]))
                        ranks[stop - at] += 1
                        at = stop
                columns = list(zip(*out, strict=True)) if out else [[] for _ in schema]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (key_type, *types), strict=True)], names=schema.names)

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    pieces = cut(rows.coalesce(TASKS).mapInArrow(cut_up, schema), "pieces")
    counts = cut(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.select("length", F.col("task").alias("s_task"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    sums = sums.groupBy("s_task").agg(F.map_from_entries(F.collect_list(F.struct("length", "n"))).alias("sums"))
    starts = cut(sums.select("s_task", F.transform(
        F.sequence(F.lit(1), F.lit(length)), lambda n: F.col("sums")[n.cast("long")]).alias("s_before")), "starts")
    where = spark.createDataFrame(places(search_counts(best_fit_counts(totals, length), length)), PLACES)
    numbered = pieces.join(F.broadcast(starts), F.col("task") == F.col("s_task"))
    rank = F.col("rank") + F.get("s_before", F.col("length").cast("int") - 1)
    numbered = numbered.withColumn("rank", rank).drop("s_task", "s_before")
    inside = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("p_first")) & (F.col("rank") < F.col("p_last"))
    nth = F.col("rank") - F.col("p_first")
    return numbered.join(F.broadcast(where), inside).select(
        F.col("key").alias(key), "piece", "start", "length", "ids", (F.col("p_bin") + nth % F.col("p_bins")).alias("sequence_id"),
        (F.col("p_offset") + ((nth - nth % F.col("p_bins")) / F.col("p_bins")).cast("long") * F.col("length")).alias("offset"),
    )
