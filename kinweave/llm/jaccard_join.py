"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets.

Two documents link when their shingle sets have a Jaccard similarity of `threshold` or more.
Equal sets are one set from the start.  Shingles are put in one order, rarely used ones
first, by a counting sketch of fixed size that covers all documents.  Then

* a light (small) set enumerates all pairs of shingles of its prefix, so two similar light
  sets share such a pair;
* a heavy (large) set enters the inverted lists of the single shingles of a shorter prefix,
  together with the light sets large enough to be similar to it, and the lists are scanned.

The boundary is the size at which the estimated cost of both ways together is least.  Sets
that share a pair or a list meet at its most central set, the pivot, and are compared with
it.  Only those that are not similar to their pivot are then compared with everything else
that met there, in blocks, by counting along inverted lists.  Before texts are read for an
exact comparison, sizes and short bit arrays rule out sets that differ by too much, which
they prove.  So no pair is lost, and none is made within a group of copies.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.bitmaps import bitmap, may_hold
from kinweave.llm.common import ship, shuffle_width
from kinweave.llm.shingles import WIDTH, shingle_sets
from kinweave.llm.textvec import mix, slices
from kinweave.operators.components import components
from kinweave.session import cut

#: The sketch: 2**SLOT_BITS counters, summed in blocks; one byte each once they are levels.
SLOT_BITS, BLOCK_BITS = 22, 14
#: Sets compared in one block: those left over by a pivot, and those they are compared with.
LEFT, RIGHT = 128, 512
#: Sets compared with one pivot in one place.
GUESTS = 256
#: Cost of scanning one entry of an inverted list, in rows shuffled.
SCAN_COST = 0.05


def overlap_needed(a, b, threshold: int):
    """Smallest intersection of sets of sizes a and b with 100 * intersection >= threshold * union."""
    return -(-threshold * (a + b) // (100 + threshold))


def least_overlap(n, threshold: int):
    """Smallest intersection of a set of size n with any similar set."""
    return -(-threshold * n // 100)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _names(hashes: np.ndarray, counts: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit name of each set: the sum of its mixed hashes, mixed with its size."""
    sums = np.append(np.uint64(0), np.cumsum(mix(hashes + np.uint64(seed)), dtype=np.uint64))
    ends = np.cumsum(counts)
    return mix((sums[ends] - sums[ends - counts]) ^ (counts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)


def _surveyed(docs: DataFrame, width: int, seed: int) -> DataFrame:
    """(key, n, name, check, null, null) of every row, and (.., block, counts) of the sketch."""
    key_type = docs.schema["key"].dataType.simpleString()

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, kind = np.zeros(1 << SLOT_BITS, np.uint32), None
        for batch in batches:
            kind = batch.schema.field("key").type
            for part in slices(batch, "text", 1 << 19):
                hashes, counts = shingle_sets(part.column("text"), width)
                np.add.at(sketch, _slots(hashes), 1)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(counts, pa.int64()), pa.array(_names(hashes, counts, seed)),
                     pa.array(_names(hashes, counts, seed + 77)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        if kind is not None:
            blocks = sketch.reshape(-1, 1 << BLOCK_BITS)
            used = np.flatnonzero(blocks.any(axis=1))
            n = len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, kind), *[pa.nulls(n, pa.int64())] * 3, pa.array(used, pa.int32()),
                 pa.array([zlib.compress(blocks[b].astype("<u4").tobytes(), 1) for b in used], pa.binary())], names=names)

    names = ["key", "n", "name", "check", "block", "counts"]
    return docs.mapInArrow(survey, f"key {key_type}, n long, name long, check long, block int, counts binary")


def levels(counts: np.ndarray) -> np.ndarray:
    """One byte per slot: four steps for each doubling of its count."""
    return np.minimum(4 * np.log2(1.0 + counts), 255).astype(np.uint8)


@dataclass
class Sketch:
    """What the driver keeps of the counters: a byte for each slot, and how many slots have each count (rising)."""

    level: np.ndarray
    count: np.ndarray
    slots: np.ndarray

    def total(self) -> float:
        return float((self.count * self.slots).sum())


def _summed(survey: DataFrame) -> Sketch:
    """The sketch summed on the executors: its counters do not come to the driver, where they would pass through its
    memory several times over."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                own = np.frombuffer(zlib.decompress(counts), "<u4").astype(np.uint64)
                sums[block] = sums[block] + own if block in sums else own
        for block, counts in sums.items():
            found = [x.astype("<i8").tobytes() for x in np.unique(counts, return_counts=True)]
            blobs = [pa.array([x], pa.binary()) for x in (levels(counts).tobytes(), *found)]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), *blobs], names=["block", "level", "count", "slots"])

    parts = survey.where("block is not null").select("block", "counts").repartition("block")
    level = np.zeros((1 << (SLOT_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.uint8)
    count, slots, unused = [np.zeros(1, np.int64)], [], len(level)
    for block, *blobs in parts.mapInArrow(add, "block int, level binary, count binary, slots binary").collect():
        level[block] = np.frombuffer(blobs[0], np.uint8)
        count.append(np.frombuffer(blobs[1], "<i8"))
        slots.append(np.frombuffer(blobs[2], "<i8"))
        unused -= 1
    slots.insert(0, np.array([unused << BLOCK_BITS], np.int64))
    count, place = np.unique(np.concatenate(count), return_inverse=True)
    slots = np.bincount(place, np.concatenate(slots)).astype(np.int64)
    return Sketch(level.ravel(), count[slots > 0], slots[slots > 0])


def boundary(sizes: dict[int, int], sketch: Sketch, threshold: int) -> int:
    """Sets below the returned size are light.  `sizes`: how many sets have each size.

    Light sets cost a row for each pair of their prefix; heavy ones, and light ones that may
    be similar to them, a row for each single shingle and a scan of its list.  Prefixes hold
    the rarest shingles, so the lists' mean length is that of the rarest share of all
    occurrences in the sketch, beyond what sharing a slot by chance adds up to.
    """
    total = sketch.total()
    count, slots = sketch.count.astype(float), sketch.slots.astype(float)
    upto = np.cumsum(count * slots)
    last = int(np.searchsorted(upto, total * (100 - threshold) / 100))
    before = upto[last] - count[last] * slots[last]
    rare = np.append(slots[:last], max(np.ceil((total * (100 - threshold) / 100 - before) / max(count[last], 1.0)), 1.0))
    count = count[: last + 1]
    mean = max(float((rare * count**2).sum()) / max(float((rare * count).sum()), 1.0) - total / len(sketch.level) - 1.0, 0.0)
    n = np.array(sorted(sizes), np.int64)
    many = np.array([sizes[k] for k in n.tolist()], float)
    prefix = n - least_overlap(n, threshold) + 1
    pairs, lists = many * (prefix + 1) * prefix / 2, many * prefix * (1 + SCAN_COST * mean)
    choices = [2, *range(4, 257, 4)]
    costs = [pairs[n < x].sum() + lists[100 * n >= threshold * x].sum() for x in choices]
    return choices[int(np.argmin(costs))]


def signatures(hashes: np.ndarray, counts: np.ndarray, level: np.ndarray, light: int, threshold: int):
    """(signatures, owner row, level of the rarest part, centrality of every set)."""
    owner = np.repeat(np.arange(len(counts)), counts)
    own_level = level[_slots(hashes)]
    order = np.argsort(own_level, kind="stable")
    order = order[np.argsort(owner[order].astype(np.uint16) if len(counts) <= 1 << 16 else owner[order], kind="stable")]
    hashes, own_level = hashes[order], own_level[order]
    first = np.cumsum(counts) - counts
    place = np.arange(len(hashes)) - np.repeat(first, counts)
    prefix = counts - least_overlap(counts, threshold) + 1
    single = (100 * counts >= threshold * light) & (counts > 0)
    if threshold <= 50:  # only then may one shingle in common link unlike sets
        single |= (counts > 0) & (threshold * counts <= 100)
    chosen = np.flatnonzero((place < np.repeat(prefix, counts)) & np.repeat(single, counts))
    out, rows, heat = [mix(hashes[chosen])], [owner[chosen]], [own_level[chosen]]
    small = (counts > 1) & (counts < light)
    for gap in range(1, int((prefix[small] + 1).max(initial=0))):
        # Pairs of shingles `gap` apart within the longer prefix of the light sets.
        a = np.flatnonzero((place + gap < np.repeat(prefix + 1, counts)) & np.repeat(small, counts))
        out.append(mix(hashes[a] * np.uint64(0xD6E8FEB86659FD93) + mix(hashes[a + gap])))
        rows.append(owner[a])
        heat.append(np.minimum(own_level[a], own_level[a + gap]))
    sums = np.append(0, np.cumsum(own_level, dtype=np.int64))
    central = 256 * (sums[first + counts] - sums[first]) // np.maximum(counts, 1)
    return np.concatenate(out), np.concatenate(rows), np.concatenate(heat), central


def _lists(docs: DataFrame, level: np.ndarray, light: int, threshold: int, width: int, seed: int, hot: int) -> DataFrame:
    """(sig, name, central, hot): the signatures of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(level)  # 2**SLOT_BITS bytes, whatever the input

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                hashes, counts = shingle_sets(part.column("text"), width)
                name = _names(hashes, counts, seed)
                sig, row, heat, central = signatures(hashes, counts, sent.value, light, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig.view(np.int64)), pa.array(name[row]), pa.array(central[row].astype(np.int32)), pa.array(heat >= hot)],
                    names=["sig", "name", "central", "hot"])

    return docs.select("text").mapInArrow(emit, "sig long, name long, central int, hot boolean")


def _meetings(cold: DataFrame, hot: DataFrame | None) -> DataFrame:
    """(pivot, name, crowd): every set that shares a signature with others, and the most central of these.

    `crowd`: more than the two share it.  A running window streams each list.  Signatures that
    the sketch calls hot go another way: their pivots are partial aggregates, joined back
    as a skewed join that Spark splits.
    """
    ordered = Window.partitionBy("sig").orderBy(F.desc("central"), "name")
    sofar = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    crowd = (F.row_number().over(ordered) > 2) | F.lead("name").over(ordered).isNotNull()
    met = cold.select(F.first("name").over(sofar).alias("pivot"), "name", crowd.alias("crowd"))
    if hot is not None:
        hot = cut(hot.groupBy("sig", "name").agg(F.max("central").alias("central")), "hot")
        first = F.struct((-F.col("central")).alias("c"), F.col("name").alias("name"))
        pivots = cut(hot.groupBy("sig").agg(F.min(first)["name"].alias("pivot")), "pivots")
        met = met.unionByName(hot.join(pivots, "sig").select("pivot", "name", F.lit(True).alias("crowd")))
    return met.where("pivot <> name").groupBy("pivot", "name").agg(F.max("crowd").alias("crowd"))


def _near_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text) of `docs` that a bitmap of `keys` lets through, and all without a key."""
    bits = bitmap(keys.where("key is not null").select(F.xxhash64("key").alias("h")))
    return docs.where(F.col("key").isNull() | may_hold(docs.sparkSession, bits, F.xxhash64("key")))


def _found(docs: DataFrame, wanted: DataFrame, width: int, seed: int, column: str) -> DataFrame:
    """(name, `column`) of the `wanted` (key, name) sets, each from a document that has it: its
    text, or the bits of its set.  A document's name is worked out again, as rows that share
    a key may have other texts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                hashes, counts = shingle_sets(part.column("text"), width)
                values = part.column("text") if column == "text" else pa.array(parities(hashes, counts), pa.binary())
                rows = [part.column("key"), pa.array(_names(hashes, counts, seed)), pa.array(counts, pa.int64()), values]
                yield pa.RecordBatch.from_arrays(rows, names=["key", "name", "n", column]).filter(pa.array(counts > 0))

    near = _near_keys(docs, wanted)
    made = f"key {docs.schema['key'].dataType.simpleString()}, name long, n long, {column} {'string' if column == 'text' else 'binary'}"
    mine = wanted.withColumnsRenamed({"key": "w_key", "name": "w_name"})
    found = near.mapInArrow(find, made)
    return found.join(mine, (F.col("name") == F.col("w_name")) & F.col("key").eqNullSafe(F.col("w_key")), "left_semi").select("name", "n", column)


def parities(hashes: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A bit array per set, at least twice as many bits as elements: how many elements fall on
    each bit, odd or even.  Sets differ by no fewer elements than their arrays by bits."""
    sizes = 64 << np.maximum(np.ceil(np.log2(np.maximum(counts, 1) / 32)), 0).astype(np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = (ends - sizes)[owner] + (hashes.astype(np.int64) & (sizes[owner] - 1))
    total = int(ends[-1]) if len(ends) else 0
    packed = np.packbits((np.bincount(at, minlength=total) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [packed[(e - n) // 8 : e // 8] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Arrays of bytes (..., n) as they would be with `size` bytes."""
    return np.bitwise_xor.reduce(bits.reshape(*bits.shape[:-1], -1, size), axis=-2)


def most_apart(a, b, threshold: int):
    """How many elements similar sets of sizes a and b may differ by; negative where none are."""
    need = overlap_needed(a, b, threshold)
    return np.where(need <= np.minimum(a, b), a + b - 2 * need, -1)


def may_link(n: int, bits: np.ndarray, sizes: np.ndarray, groups: dict[int, tuple[np.ndarray, np.ndarray]], threshold: int) -> np.ndarray:
    """Which of the sets (of `sizes`; `groups`: bytes -> (rows, bits)) could be similar to one with `n` elements and `bits`."""
    out = np.zeros(len(sizes), bool)
    most = 1 << int(np.ceil(np.log2(100 / threshold)))  # arrays of similar sets differ in size by that factor at most
    for size, (rows, other) in groups.items():
        if not len(bits) <= most * size <= most * most * len(bits):
            continue
        own, other = (fold(bits, size), other) if size < len(bits) else (bits, fold(other, len(bits)))
        apart = np.bitwise_count(other ^ own).sum(axis=1, dtype=np.int64)
        out[rows] = apart <= most_apart(n, sizes[rows], threshold)
    return out


def by_size(blobs: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """bytes -> (rows, bits) of bit arrays of several sizes."""
    length = np.array([len(b) for b in blobs])
    return {
        int(size): (rows := np.flatnonzero(length == size), np.frombuffer(b"".join(blobs[k] for k in rows), np.uint8).reshape(len(rows), -1))
        for size in np.unique(length)
    }


def _possible(meetings: DataFrame, marks: DataFrame, threshold: int) -> DataFrame:
    """(pivot, name) that their sizes and bits do not rule out."""

    def test(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for n, bits, m, other in columns:
            out = []
            for a, x, b, y in zip(n.to_pylist(), bits.to_pylist(), m.to_pylist(), other.to_pylist(), strict=True):
                out.append(bool(may_link(a, np.frombuffer(x, np.uint8), np.array([b]), by_size([y]), threshold)[0]))
            yield pa.array(out, pa.bool_())

    test.__annotations__ = {"columns": Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    hosts = marks.select(F.col("name").alias("pivot"), F.col("n").alias("p_n"), F.col("bits").alias("p_bits"))
    both = meetings.select("pivot", "name").join(marks, "name").join(hosts, "pivot")
    sized = both.where(F.expr(f"100 * least(n, p_n) >= {threshold} * greatest(n, p_n)"))
    return sized.where(F.arrow_udf(test, "boolean")("p_n", "p_bits", "n", "bits")).select("pivot", "name")


def _hashed(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    """The shingle sets of a batch's texts."""
    out = []
    for part in slices(batch, "text", 1 << 19):
        hashes, counts = shingle_sets(part.column("text"), width)
        out += np.split(hashes, np.cumsum(counts)[:-1])
    return out


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two rising arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _with_pivots(meetings: DataFrame, texts: DataFrame, threshold: int, width: int) -> DataFrame:
    """(pivot, name) that are similar: sets compared with pivots, `GUESTS` or so at a place."""
    places = cut(meetings.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / GUESTS).cast("int").alias("places")), "places")
    salt = F.pmod(F.xxhash64("name"), F.col("places")).cast("int").alias("salt")
    guests = meetings.join(places, "pivot").select("pivot", salt, "name").join(texts, "name")
    guests = guests.select("pivot", "salt", F.lit(1).alias("guest"), "name", "text")
    hosts = places.select("pivot", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("salt")).join(texts.withColumnRenamed("name", "pivot"), "pivot")
    hosts = hosts.select("pivot", "salt", F.lit(0).alias("guest"), F.col("pivot").alias("name"), "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            pivots, names = [], []
            columns = [batch.column(c).to_pylist() for c in ("pivot", "guest", "name")]
            for pivot, guest, name, value in zip(*columns, _hashed(batch, width), strict=True):
                if not guest:
                    host, own = pivot, value
                    continue
                assert host == pivot
                low, high = sorted((len(own), len(value)))
                near = 100 * low >= threshold * high and shared(own, value) >= overlap_needed(low, high, threshold)
                if near:
                    pivots.append(pivot), names.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(pivots, pa.int64()), pa.array(names, pa.int64())], names=["pivot", "name"])

    rows = hosts.unionByName(guests).repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "guest")
    return rows.select("pivot", "guest", "name", "text").mapInArrow(compare, "pivot long, name long")


def block_links(sets: list[np.ndarray], left: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links from the sets numbered `left` to any of `sets`, by counting along inverted lists."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    out = []
    for u in left.tolist():
        begin, stop = np.searchsorted(flat, sets[u], "left"), np.searchsorted(flat, sets[u], "right")
        length = stop - begin
        at = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        common = np.bincount(owner[at], minlength=len(sets))
        near = common >= overlap_needed(sizes, sizes[u], threshold)
        near[u] = False
        out += [(u, int(v)) for v in np.flatnonzero(near)]
    return out


def _blocks(verdicts: DataFrame) -> DataFrame:
    """(pivot, r, c, left, name): the sets of each pivot in blocks, such that each that is not
    similar to it (`left`) meets all others in one of them.

    A set that shared a signature with the pivot alone has met no other set there.
    """
    verdicts = verdicts.where("crowd")
    counts = verdicts.groupBy("pivot").agg(F.count(F.lit(1)).alias("every"), F.count_if(~F.col("linked")).alias("open"))
    counts = cut(
        counts.where("open > 0 and every > 1")
        .select("pivot", F.ceil(F.col("open") / LEFT).cast("int").alias("rows"), F.ceil(F.col("every") / RIGHT).cast("int").alias("cols")),
        "blocks",
    )
    place = lambda seed, n: F.pmod(F.xxhash64("name", F.lit(seed)), F.col(n)).cast("int")
    guests = verdicts.join(counts, "pivot")
    lefts = guests.where("not linked and (rows > 1 or cols > 1)").select(
        "pivot", place(1, "rows").alias("r"), F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("c"), F.lit(True).alias("left"), "name")
    rights = guests.select(
        "pivot", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("r"), place(2, "cols").alias("c"),
        (~F.col("linked") & (F.col("rows") == 1) & (F.col("cols") == 1)).alias("left"), "name")
    return lefts.unionByName(rights)


def _in_blocks(blocks: DataFrame, values: DataFrame, settle, schema: str, read) -> DataFrame:
    """`settle(block, left, names, values)` for every block; `read` makes a batch's values."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, left, names, held = None, [], [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("pivot", "r", "c", "left", "name")]
            for pivot, r, c, open_, name, value in zip(*columns, read(batch), strict=True):
                if (pivot, r, c) != block:
                    if len(names) > 1:
                        yield settle(block, left, names, held)
                    block, left, names, held = (pivot, r, c), [], [], []
                left.append(open_), names.append(name), held.append(value)
        if len(names) > 1:
            yield settle(block, left, names, held)

    rows = blocks.join(values, "name").repartition("pivot", "r", "c").sortWithinPartitions("pivot", "r", "c")
    return rows.select("pivot", "r", "c", "left", "name", *[c for c in values.columns if c != "name"]).mapInArrow(search, schema)


def _promising(blocks: DataFrame, marks: DataFrame, threshold: int) -> DataFrame:
    """The rows of the blocks whose sets could be similar to another of their block."""

    def settle(block, left, names, held) -> pa.RecordBatch:
        sizes, groups = np.array([n for n, _ in held]), by_size([bits for _, bits in held])
        own, keep = np.array(names), np.zeros(len(names), bool)
        for u in np.flatnonzero(left).tolist():
            near = may_link(held[u][0], np.frombuffer(held[u][1], np.uint8), sizes, groups, threshold) & (own != own[u])
            if near.any():
                keep |= near
                keep[u] = True
        rows = np.flatnonzero(keep)
        return pa.RecordBatch.from_arrays(
            [pa.array([block[0]] * len(rows), pa.int64()), pa.array([block[1]] * len(rows), pa.int32()), pa.array([block[2]] * len(rows), pa.int32()),
             pa.array(np.array(left)[rows], pa.bool_()), pa.array(own[rows], pa.int64())], names=["pivot", "r", "c", "left", "name"])

    def read(batch: pa.RecordBatch) -> list[tuple[int, bytes]]:
        return list(zip(batch.column("n").to_pylist(), batch.column("bits").to_pylist(), strict=True))

    return _in_blocks(blocks, marks, settle, "pivot long, r int, c int, left boolean, name long", read)


def _among_guests(blocks: DataFrame, texts: DataFrame, threshold: int, width: int) -> DataFrame:
    """(a, b): links within the blocks, no more than join their sets."""

    def settle(block, left, names, held) -> pa.RecordBatch:
        seen: dict[int, int] = {}
        parent, found = list(range(len(names))), []

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for k, name in enumerate(names):  # a set may stand on both sides
            parent[root(k)] = root(seen.setdefault(name, k))
        for u, v in block_links(held, np.flatnonzero(left), threshold):
            x, y = root(u), root(v)
            if x != y:
                parent[x] = y
                found.append((names[u], names[v]))
        return pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])

    return _in_blocks(blocks, texts, settle, "a long, b long", lambda batch: _hashed(batch, width))


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 80, width: int = WIDTH) -> DataFrame:
    """key, n_shingles and component_id (the smallest key reachable by links) of every row.

    `threshold` is in hundredths.  Runs jobs that cut their results into tables.  Shingles and
    sets are compared as 64-bit hashes; two sets under one name would be noticed by a
    second hash, and named anew.  Defined cases: NULL, empty and blank texts have no shingle
    and are linked with nothing; below `width` words the whole text is one shingle; repeated
    rows have equal sets and one component; a NULL key is not the smallest unless
    alone; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    for seed in range(1, 100):
        survey = cut(_surveyed(rows, width, seed), "survey")
        known = survey.where("block is null and n > 0")
        by_name = cut(known.groupBy("name").agg(F.min("key").alias("key"), F.min("n").alias("n"),
                                                (F.min("check") < F.max("check")).alias("clash")), "names")
        if not by_name.where("clash").take(1):
            break
    sketch = _summed(survey)
    # Sizes up to the largest a light set may have, and all others as one.
    sizes = {r.n: r.c for r in by_name.groupBy(F.least("n", F.lit(1024)).alias("n")).agg(F.count(F.lit(1)).alias("c")).collect()}
    light = boundary(sizes, sketch, threshold) if sizes else 2
    hot = int(levels(np.array([max(sketch.total() / (4 * shuffle_width(spark)), 1000.0)]))[0])
    lists = _lists(rows, sketch.level, light, threshold, width, seed, hot)
    meetings = cut(_meetings(lists.where("not hot"), lists.where("hot") if sketch.level.max() >= hot else None), "meetings")
    chosen = lambda names: cut(by_name.select("name", "key").join(names.distinct(), "name", "left_semi"), "chosen")
    both = lambda pairs: pairs.select("name").union(pairs.select("pivot"))
    marks = cut(_found(rows, chosen(both(meetings)), width, seed, "bits"), "marks")
    possible = cut(_possible(meetings, marks, threshold), "possible")
    texts = cut(_found(rows, chosen(both(possible)), width, seed, "text").drop("n"), "texts")
    linked = cut(_with_pivots(possible, texts, threshold, width).distinct(), "linked")
    verdicts = meetings.join(linked.withColumn("linked", F.lit(True)), ["pivot", "name"], "left")
    verdicts = cut(verdicts.withColumn("linked", F.coalesce("linked", F.lit(False))), "verdicts")
    blocks = cut(_promising(_blocks(verdicts), marks, threshold), "promising")
    texts = cut(_found(rows, chosen(blocks.select("name")), width, seed, "text").drop("n"), "texts")
    links = linked.select(F.col("pivot").alias("a"), F.col("name").alias("b"))
    links = cut(links.unionByName(_among_guests(blocks, texts, threshold, width)), "links")
    roots = components(links, "a", "b").withColumnRenamed("id", "name")
    classes = by_name.join(roots, "name", "left").select("name", "key", F.coalesce("root", "name").alias("root"))
    lowest = cut(classes.groupBy("root").agg(F.min("key").alias("component_id")), "lowest")
    classes = cut(classes.join(lowest, "root").select(F.col("name").alias("c_name"), "component_id"), "classes")
    marked = survey.where("block is null").join(classes, (F.col("name") == F.col("c_name")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return marked.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 80) -> DataFrame:
    """One row of `docs` for each group of near copies, that of the smallest key, NULL last.

    Rows are told apart by a number of their own, so rows that share a key, or have none, stay or
    go each by itself.  Of rows with the smallest key any one stays.  Runs jobs that cut `docs`
    and their results into tables.
    """
    number = "_row"
    while number.lower() in (c.lower() for c in docs.columns):
        number += "_"
    rows = cut(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    groups = similar_groups(rows, number, text, threshold)
    keys = rows.select(number, F.col(key).alias("key"))
    members = cut(groups.select(number, "component_id").join(keys, number), "members")
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", F.col(number).alias("row"))).alias("first")
    firsts = members.groupBy("component_id").agg(first, F.count(F.lit(1)).alias("size")).where("size > 1")
    firsts = cut(firsts.select("component_id", F.col("first.row").alias("stays")), "firsts")
    dropped = members.join(firsts, "component_id").where(F.col(number) != F.col("stays")).select(number)
    return rows.join(dropped, number, "left_anti").drop(number)
