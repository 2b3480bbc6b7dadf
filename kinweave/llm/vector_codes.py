"""Vector code compression: product codes from exact integer k-means over Hilbert-sorted blocks.

Each vector is cut into parts.  The parts of one position lie sorted along a Hilbert curve
in flat blocks, with the box of every block (least and greatest value of each component) and its
component sums.  In a round, box distances leave a block the few entries that can be nearest to
anything in it: an entry whose least distance to the box exceeds another's greatest is out.
A block left with one entry is settled by its stored sums; any other compares its rows with
the shortlist in 64-bit integers.  No bound is rounded, so codes, sums and errors are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import ship, shuffle_width
from kinweave.session import cut

SCALE = 4096
#: Rows of a block.
BLOCK = 256
#: Whole components beyond this are refused: 64 squares of differences still fit 64 bits.
FAR = 1 << 27
HILBERT_BITS = 63


def whole(vector: Column, scale: int = SCALE) -> Column:
    """The components times `scale`, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def sound(vector: Column, scale: int = SCALE) -> Column:
    """Whether a vector has components, all of them finite and of a size that is counted exactly."""
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) * F.lit(float(scale)) < F.lit(float(FAR)), F.lit(False)))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of points (n, d) with components below 2**bits; bits * d <= 63.

    Skilling, "Programming the Hilbert curve" (2004): axes to the transposed index, then its bits interleaved.
    """
    x = points.T.astype(np.int64).copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[d - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    place = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def _components(column: pa.Array, d: int) -> np.ndarray:
    """A list column whose lists all have d whole numbers, as (n, d)."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sort_parts(kept: DataFrame, d: int, parts: int, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """(part, place, row, x): every part of every vector with its place on the curve of its position."""
    width = d // parts
    bits = max(1, min(16, HILBERT_BITS // width))
    used = min(width, HILBERT_BITS)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = np.maximum(high - low, 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _components(batch.column("v"), d)
            scaled = (x - low) * ((1 << bits) - 1) // span
            for p in range(parts):
                at = slice(p * width, (p + 1) * width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(x), p, np.int32)), pa.array(hilbert(scaled[:, at][:, :used], bits)), batch.column("row"),
                        pa.array([r.tobytes() for r in x[:, at].astype("<i4")], pa.binary()),
                    ],
                    names=["part", "place", "row", "x"],
                )

    return kept.select("row", "v").mapInArrow(cut_up, "part int, place long, row long, x binary")


def _blocks(parts: DataFrame, width: int) -> DataFrame:
    """(part, rows, x, low, high, sums): flat blocks of up to BLOCK rows of one position."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part, rows = batch.column("part").to_numpy(), batch.column("row").to_numpy()
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), "<i4").reshape(-1, width)
            edges = np.append(np.flatnonzero(np.diff(part)) + 1, len(part))
            starts = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(np.append(0, edges[:-1]), edges)])
            ends = np.append(starts[1:], len(part))
            low, high = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
            sums = np.add.reduceat(x.astype(np.int64), starts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[starts]), pa.array([rows[a:b].astype("<i8").tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([x[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    *[pa.array([r.tobytes() for r in t.astype("<i8")], pa.binary()) for t in (low, high, sums)],
                ],
                names=["part", "rows", "x", "low", "high", "sums"],
            )

    # The row is part of the sort key, so one vector that very many rows share is split like any other range.
    spread = parts.repartitionByRange(shuffle_width(parts.sparkSession), "part", "place", "row").sortWithinPartitions("part", "place", "row")
    return spread.mapInArrow(gather, "part int, rows binary, x binary, low binary, high binary, sums binary")


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Rising indexes of the entries that can be nearest to a point of the box; ties stay."""
    below, above = low - entries, entries - high
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(1)
    most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(1)
    return np.flatnonzero(least <= most.min())


def _nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, the first of equals; squared distance) of every row."""
    far = x[:, None, :] - entries[None, :, :]
    distances = np.einsum("nkd,nkd->nk", far, far)
    best = distances.argmin(1)
    return best, distances[np.arange(len(x)), best]


def _each_block(batch: pa.RecordBatch, books: np.ndarray, width: int) -> Iterator[tuple]:
    """(part, box, shortlist, raw rows and components) of every block of a batch."""
    boxes = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i8").reshape(-1, width) for c in ("low", "high", "sums")]
    columns = [batch.column(c).to_pylist() for c in ("part", "rows", "x")]
    for part, rows, x, low, high, sums in zip(*columns, *boxes):
        yield part, rows, x, sums, shortlist(low, high, books[part])


def _count_round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Sums of components and, last, counts, by part and entry.  A task sends one row per entry at most."""
    parts, entries, width = books.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for part, rows, x, sums, near in _each_block(batch, books, width):
                if len(near) == 1:
                    totals[part, near[0], :width] += sums
                    totals[part, near[0], width] += len(rows) // 8
                    continue
                x = np.frombuffer(x, "<i4").reshape(-1, width).astype(np.int64)
                best = near[_nearest(x, books[part][near])[0]]
                np.add.at(totals[part], best, np.column_stack([x, np.ones(len(x), np.int64)]))
        part, entry = np.nonzero(totals[:, :, width])
        flat = totals[part, entry]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(list(flat), pa.list_(pa.int64()))],
            names=["part", "entry", "sums"],
        )

    found = blocks.mapInArrow(assign, "part int, entry int, sums array<long>")
    found = found.select("part", "entry", F.posexplode("sums").alias("at", "value"))
    totals = np.zeros((parts, entries, width + 1), object)
    for row in found.groupBy("part", "entry", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        totals[row.part, row.entry, row["at"]] = int(row.value)
    return totals


def _assign(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(row, part, code, error) of every part."""
    width = books.shape[2]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows, x, _, near in _each_block(batch, books, width):
                x = np.frombuffer(x, "<i4").reshape(-1, width).astype(np.int64)
                best, error = _nearest(x, books[part][near])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(rows, "<i8")), pa.array(np.full(len(x), part, np.int32)), pa.array(near[best].astype(np.int32)), pa.array(error)],
                    names=["row", "part", "code", "error"],
                )

    return blocks.mapInArrow(assign, "row long, part int, code int, error long")


def fit(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks (part, entry, component) after `rounds` rounds of k-means; an entry that nothing uses stays."""
    for _ in range(rounds):
        totals = _count_round(blocks, books)
        counts = np.maximum(totals[:, :, -1:], 1)
        books = np.where(totals[:, :, -1:] > 0, totals[:, :, :-1] // counts, books).astype(np.int64)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal text, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16,
    rounds: int = 6, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """(key, label, code, error, label_error) per kept vector, and the codebooks (part, entry, component).

    `code` is an array of entry indexes by part; `error` is the sum of squared distances, in
    units of 1 / scale; `label_error` its sum over equal labels.  Codebooks start from the
    vectors with the smallest keys.  The driver holds codebooks and one row of sums per entry; the blocks are a table.

    Defined cases: a vector that is NULL, empty or holds NULL, NaN, an infinity or a component beyond
    32768 either way (at the scale of 4096) is dropped, as is one of another length than that of the smallest key;
    rows with equal keys stay apart, their vectors' order decides who starts a codebook; NULL keys
    come last; NULL labels are one label; with fewer vectors than entries a codebook is as short; a length that `parts` does not divide is
    an error; a table without kept vectors gives no rows and empty codebooks; further columns
    are not looked at.  Runs jobs.
    """
    ship(vectors.sparkSession)
    rows = vectors.where(sound(F.col(vector), scale)).select(
        F.col(key).alias("k"), F.col(label).alias("l"), whole(F.col(vector), scale).alias("v"))
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    order = [F.col("k").asc_nulls_last(), F.col("v"), F.col("row")]
    first = rows.orderBy(*order).select(F.size("v").alias("d")).first()
    if first is None:
        nothing = rows.select("k", "l", F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error"))
        return _with_label_error(nothing, key, label), np.zeros((parts, 0, 0), np.int64)
    d = first.d
    if d % parts:
        raise ValueError(f"vectors of {d} components cannot be cut into {parts} equal parts")
    kept = rows.where(F.size("v") == d)
    start = np.array([r.v for r in kept.orderBy(*order).limit(entries).select("v").collect()], np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, d // parts).transpose(1, 0, 2))
    ends = kept.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("at").collect()
    low, high = np.array([r.low for r in ends]), np.array([r.high for r in ends])
    blocks = cut(_blocks(_sort_parts(kept, d, parts, low, high), d // parts), "vector_blocks")
    books = fit(blocks, books, rounds)
    coded = _assign(blocks, books).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("part", "code"))).alias("codes"), F.sum("error").alias("error"))
    coded = cut(coded.select(F.col("row").alias("r"), F.transform("codes", lambda c: c["code"]).alias("code"), "error"), "codes")
    found = kept.join(coded, F.col("row") == F.col("r")).select("k", "l", "code", "error")
    return _with_label_error(found, key, label), books


def _with_label_error(found: DataFrame, key: str, label: str) -> DataFrame:
    found = cut(found, "coded")
    # A table of its own, so that a label that very many vectors share is split where it is joined back.
    sums = cut(found.groupBy(F.col("l").alias("s")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")), "label_errors")
    joined = found.join(sums, F.col("l").eqNullSafe(F.col("s")))
    return joined.select(F.col("k").alias(key), F.col("l").alias(label), "code", "error", "label_error")
