"""Suffix-array dedup: repeated byte strings of `least` bytes or more, found from a sparse suffix array.

Every string of 100 bytes has an anchor: the 32 bytes in it with the smallest hash.  Equal
strings have equal anchors at equal places, so only suffixes that start at an anchor need
sorting, and the text that an anchor's strings span (its segment) holds all there is to
compare.  Two steps find the repeats.

1. Segments are brought together by the hash of their anchor.  Segments that are equal are a
   class, told by two 64-bit hashes, and all but its first go.  Anchors with different
   segments are noted in a bitmap of fixed size.
2. Only segments of noted anchors are read again, one of each class, with their text.  For each
   anchor the suffixes are sorted, neighbouring common prefixes give the interval tree by a
   stack scan, and within an interval the texts to the left are scanned the same way: where
   they part, the repeat cannot be extended, and the classes there are a group.

What goes follows from classes and their groups.  `repeat_groups` joins the members of the
classes to them, so that a group lists every occurrence, copies included.

An anchor with very many different segments is not gathered: each of its strings of `least`
bytes is a class of its own, told by the hashes of string and anchor.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.bitmaps import bitmap, is_set, may_hold
from kinweave.llm.common import ship
from kinweave.llm.textvec import Spans, mix, slices, texts
from kinweave.session import cut

LEAST, GRAM = 100, 32
#: Different segments of an anchor that are sorted in one group, and that one task's share may hold.
GROUP, SHARE = 4096, 256
#: Text whose segments a task compares before it sends them on.
BUFFER = 8 << 20
ANCHOR, COVERED, MARK = 0, 1, 2


class Segments:
    """The anchors of some texts: absolute start and end of each segment, hashes, and rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int = LEAST):
        self.data, self.offsets = data, offsets
        empty = np.zeros(0, np.int64)
        self.lo = self.hi = self.anchor = self.row = empty
        self.h = self.c = np.zeros(0, np.uint64)
        if least < GRAM:
            raise ValueError(f"repeats have {GRAM} bytes at least, not {least}")
        starts = len(data) - least + 1
        if starts <= 0:
            return
        self.spans = Spans(data)
        hashes = self.spans.windows(GRAM)
        place = np.uint64((1 << 31) - 1)
        low = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
        width, wanted = 1, least - GRAM + 1
        while 2 * width <= wanted:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < wanted:
            low = np.minimum(low[: starts], low[wanted - width :])
        anchor = (low & place).astype(np.int64)
        inside = np.repeat(offsets[1:], np.diff(offsets))[:starts] - np.arange(starts) >= least
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
        end = inside.copy()
        end[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1])
        self.lo, self.hi = np.flatnonzero(new), np.flatnonzero(end)
        self.anchor = anchor[self.lo]
        self.h = hashes[self.anchor]
        span = _pack(self.anchor - self.lo, self.hi - self.lo, least).astype(np.uint64)
        self.c = self.spans.hash(self.lo, self.hi + least) ^ mix(span)
        self.row = np.searchsorted(offsets, self.lo, "right") - 1


def _firsts(h: np.ndarray, c: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each entry is the first, by document and place, of those with its hashes."""
    both = mix(h ^ (c * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(both)
    sorted_ = both[order]
    same = np.zeros(len(both), bool)
    same[1:] = sorted_[1:] == sorted_[:-1]
    same[:-1] |= same[1:]
    first = np.ones(len(both), bool)
    some = order[same]
    if len(some):
        some = some[np.lexsort((at[some], doc[some], both[some]))]
        first[some[1:][both[some[1:]] == both[some[:-1]]]] = False
    return first


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs covered by some spans."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > stop[:-1]
    return start[new], np.append(stop[:-1][new[1:]], stop[-1])


def merged_by(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, stop) of the maximal runs that the spans of each owner cover."""
    if not len(owner):
        return owner, start, stop
    owners, code = np.unique(owner, return_inverse=True)
    stride = int(stop.max()) + 1  # one line of bytes for all owners, with a gap between them
    first, last = merged(code * stride + start, code * stride + stop)
    code = first // stride
    return owners[code], first - code * stride, last - code * stride


def _pack(lo: np.ndarray, length: np.ndarray, least: int) -> np.ndarray:
    """Place and number of strings of a segment in one: an anchor has fewer than `least` strings."""
    return lo * least + length


def _survey(docs: DataFrame, least: int, share: int) -> DataFrame:
    """(h, salt, c, doc, at, kind): segments to bring together, and what is known to be repeated
    within a task's share, as spans from `at` to `c`."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            h, c, doc, at = (np.concatenate(x) for x in zip(*held, strict=True))
            first = _firsts(h, c, doc, at)
            rows = np.flatnonzero(first)
            start = at[~first] // least
            owner, start, stop = merged_by(doc[~first], start, start + at[~first] % least + least)
            value, code, count = np.unique(h[rows], return_inverse=True, return_counts=True)
            crowded = count >= share
            salt = np.where(crowded[code], c[rows] | np.uint64(1), np.uint64(0))
            marks = value[crowded]
            zero = lambda n: np.zeros(n, np.uint64)
            return _batch({
                "h": np.concatenate([h[rows], mix(owner.astype(np.uint64)), marks]),
                "salt": np.concatenate([salt, zero(len(owner)), zero(len(marks))]),
                "c": np.concatenate([c[rows], stop.astype(np.uint64), zero(len(marks))]),
                "doc": np.concatenate([doc[rows], owner, zero(len(marks)).view(np.int64)]),
                "at": np.concatenate([at[rows], start, zero(len(marks)).view(np.int64)]),
                "kind": np.repeat(np.array([ANCHOR, COVERED, MARK], np.int8), [len(rows), len(owner), len(marks)]),
            })

        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                data, offsets = texts(part.column("text"))
                s = Segments(data, offsets, least)
                doc = part.column("doc").to_numpy()
                held.append((s.h, s.c, doc[s.row], _pack(s.lo - offsets[s.row], s.hi - s.lo, least)))
                size += len(data)
                if size >= BUFFER:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.mapInArrow(survey, "h long, salt long, c long, doc long, at long, kind byte")


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    arrays = [pa.array(v.view(np.int64) if v.dtype == np.uint64 else v) for v in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def _gathered(survey: DataFrame, least: int, group: int) -> DataFrame:
    """(doc, start, stop) of repeated segments, and (h, big) of anchors with different segments."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, classes, marked = None, 0, False  # of the anchor that the batch before ended in

        for batch in batches:
            h, salt, c, doc, at, kind = (batch.column(i).to_numpy() for i in range(6))
            known = kind == COVERED
            own = np.flatnonzero(~known)
            start, stop = np.where(known, at, at // least), np.where(known, c, at // least + at % least + least)
            h, salt, c, mark = h[own], salt[own], c[own], kind[own] == MARK
            newgroup, newclass = np.ones(len(own), bool), np.ones(len(own), bool)
            newgroup[1:] = (h[1:] != h[:-1]) | (salt[1:] != salt[:-1])
            newclass[1:] = newgroup[1:] | (c[1:] != c[:-1])
            if len(own) and last is not None:
                newgroup[0] = (h[0], salt[0]) != last[:2]
                newclass[0] = newgroup[0] or c[0] != last[2]
            covered = np.concatenate([np.flatnonzero(known), own[~newclass & ~mark]])
            out_h, out_big = [], []
            if len(own):
                groups = np.cumsum(newgroup)  # 0: goes on from the batch before
                count = np.bincount(groups, newclass).astype(np.int64)
                marks = np.bincount(groups, mark) > 0
                key = np.zeros((len(count), 2), np.int64)
                key[groups] = np.stack([h, salt], axis=1)
                if last is not None:
                    key[0] = last[:2]
                    count[0] += classes
                    marks[0] |= marked
                done = slice(0 if last is not None else 1, len(count) - 1)
                big = (key[done, 1] != 0) | marks[done] | (count[done] > group)
                noted = big | (count[done] > 1)
                out_h, out_big = key[done, 0][noted], big[noted]
                last, classes, marked = (h[-1], salt[-1], c[-1]), int(count[-1]), bool(marks[-1])
            yield found(doc[covered], start[covered], stop[covered], out_h, out_big)
        if last is not None:
            big = bool(last[1] != 0 or marked or classes > group)
            if big or classes > 1:
                yield found(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), [last[0]], [big])

    def found(doc: np.ndarray, start: np.ndarray, stop: np.ndarray, h: Sequence, big: Sequence) -> pa.RecordBatch:
        n, m = len(doc), len(h)
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(doc, pa.int64()), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.array(start, pa.int64()), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.array(stop, pa.int64()), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(np.asarray(h, np.int64))]),
            pa.concat_arrays([pa.nulls(n, pa.bool_()), pa.array(np.asarray(big, bool))]),
        ], names=["doc", "start", "stop", "h", "big"])

    rows = survey.repartition("h", "salt").sortWithinPartitions("h", "salt", "c", "doc", "at")
    return rows.mapInArrow(gather, "doc long, start long, stop long, h long, big boolean")


def _strings(s: Segments, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, segment) of every string of `least` bytes in the segments `rows`."""
    count = s.hi[rows] - s.lo[rows] + 1
    at = np.repeat(s.lo[rows] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    return at, np.repeat(rows, count)


def _suffixes(docs: DataFrame, noted: np.ndarray, big: np.ndarray, least: int) -> DataFrame:
    """(key, c, doc, at, left, text): segments of noted anchors; strings of the big ones, by their
    own hash and that of the anchor, without `left`; and spans from `at` to `c` known to be repeated, with `left` -1."""
    sent = docs.sparkSession.sparkContext.broadcast((noted, big))  # two bitmaps of one size

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        noted, big = sent.value
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            """Strings of big anchors: the first of each in this share, and spans of the others."""
            own, h, doc, at = (np.concatenate(x) for x in zip(*held, strict=True))
            first = _firsts(own, h, doc, at)
            owner, start, stop = merged_by(doc[~first], at[~first], at[~first] + least)
            rows = np.flatnonzero(first)
            n, m = len(rows), len(owner)
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([own[rows], mix(owner.astype(np.uint64))]).view(np.int64)),
                pa.array(np.concatenate([h[rows].view(np.int64), stop])), pa.array(np.concatenate([doc[rows], owner])),
                pa.array(np.concatenate([at[rows], start])), pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(np.full(m, -1, np.int32))]),
                pa.nulls(n + m, pa.binary()),
            ], names=names)

        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                data, offsets = texts(part.column("text"))
                s = Segments(data, offsets, least)
                doc = part.column("doc").to_numpy()
                crowd, some = is_set(big, s.h), is_set(noted, s.h)
                rows = np.flatnonzero(some & ~crowd)
                first = _firsts(s.h[rows], s.c[rows], doc[s.row[rows]], s.lo[rows])
                rows = rows[first]  # the others are known to be repeated
                raw, base = data.tobytes(), offsets[s.row[rows]]
                spans = zip(s.lo[rows].tolist(), (s.hi[rows] + least).tolist(), strict=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(s.h[rows].view(np.int64)), pa.array(s.c[rows].view(np.int64)), pa.array(doc[s.row[rows]], pa.int64()),
                    pa.array(s.lo[rows] - base), pa.array((s.anchor - s.lo)[rows].astype(np.int32)),
                    pa.array([raw[a:b] for a, b in spans], pa.binary()),
                ], names=names)
                rows = np.flatnonzero(crowd)
                if len(rows):
                    at, owner = _strings(s, rows)
                    row = s.row[owner]
                    held.append((s.spans.hash(at, at + least), s.h[owner], doc[row], at - offsets[row]))
                size += len(data)
                if held and size >= BUFFER:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    names = ["key", "c", "doc", "at", "left", "text"]
    return docs.mapInArrow(emit, "key long, c long, doc long, at long, left int, text binary")


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    top = min(len(a), len(b))
    if a[:top] == b[:top]:
        return top
    low = 0
    while top - low > 1:
        mid = (low + top) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            top = mid
    return low


def intervals(order: list[int], strings: list[bytes], least: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of the sorted strings with a common prefix of `least` or more.

    A stack scan over the common prefixes of neighbours: an interval is complete when a
    shorter prefix follows it.
    """
    stack: list[tuple[int, int]] = []
    for k in range(1, len(order) + 1):
        now = common(strings[order[k - 1]], strings[order[k]]) if k < len(order) else -1
        left = k - 1
        while stack and stack[-1][0] > now:
            value, left = stack.pop()
            yield value, left, k - 1
        if now >= least and (not stack or stack[-1][0] < now):
            stack.append((now, left))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members): strings around a common anchor that occur at several members.

    `rights` start at the anchor, `lefts` end before it and are given backwards.  A repeat
    reaches `left` bytes back and `right` bytes on, `least` or more together; right, its
    members' prefixes part, and left, their texts differ, so it cannot be extended.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    rank = sorted(range(len(lefts)), key=lefts.__getitem__)
    place = [0] * len(lefts)
    for k, member in enumerate(rank):
        place[member] = k
    after = {member: k for k, member in enumerate(order)}
    longest = max(map(len, lefts))
    for right, first, last in intervals(order, rights, max(least - longest, 1)):
        members = sorted(order[first : last + 1], key=place.__getitem__)
        for left, a, b in intervals(members, lefts, max(least - right, 0)):
            group = members[a : b + 1]
            low, high = min(group, key=after.__getitem__), max(group, key=after.__getitem__)
            if common(rights[low], rights[high]) == right:  # else a narrower interval has them all
                yield left, right, group


def _repeats(suffixes: DataFrame, least: int) -> DataFrame:
    """(h, part, c, doc, at, start, stop, whole, first): what classes of segments have in common.

    `part` numbers the maximal repeats around an anchor `h`; a row says where the first member
    of class `c`, a segment that starts at `at` of `doc`, has the repeat, and whether that
    is the whole segment.  Rows without `part` are repeated strings of crowded anchors and spans known before.
    """
    names = ("h", "part", "c", "doc", "at", "start", "stop", "whole", "first")
    kinds = (*[pa.int64()] * 7, *[pa.bool_()] * 2)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []  # (doc, at, left, text, class) of different segments of one anchor
        last = None  # hash of the segment or string before
        out: list[tuple] = []

        def settle() -> None:
            members.sort(key=lambda m: m[:2])
            lefts, rights = [m[3][: m[2]][::-1] for m in members], [m[3][m[2] :] for m in members]
            for number, (left, right, group) in enumerate(maximal_repeats(lefts, rights, least)):
                one = min(group)
                for k in group:
                    doc, at, before, text, c = members[k]
                    whole = (left, right) == (before, len(text) - before)
                    out.append((key, number, c, doc, at, at + before - left, at + before + right, whole, k == one))

        def drain() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for k, c, doc, at, left, text in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                if k != key:
                    if len(members) > 1:
                        settle()
                    key, members, last = k, [], None
                if left == -1:
                    out.append((None, None, None, doc, None, at, c, None, False))
                elif left is None:
                    out.append((None, None, None, doc, None, at, at + least, None, last != (c, None)))
                    last = (c, None)
                elif last != (c, left):  # only the first of equal segments
                    members.append((doc, at, left, text, c))
                    last = (c, left)
            yield drain()
        if len(members) > 1:
            settle()
        yield drain()

    rows = suffixes.repartition("key").sortWithinPartitions("key", F.col("left").isNull(), "c", "doc", "at")
    return rows.mapInArrow(search, "h long, part long, c long, doc long, at long, start long, stop long, whole boolean, first boolean")


def _members(docs: DataFrame, big: np.ndarray, least: int) -> DataFrame:
    """(h, c, m_doc, m_at, m_stop): every segment with its class; of crowded anchors, every string."""
    sent = docs.sparkSession.sparkContext.broadcast(big)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                data, offsets = texts(part.column("text"))
                s = Segments(data, offsets, least)
                doc = part.column("doc").to_numpy()
                crowd = is_set(sent.value, s.h)
                rows = np.flatnonzero(~crowd)
                base = offsets[s.row[rows]]
                yield _batch({"h": s.h[rows], "c": s.c[rows], "m_doc": doc[s.row[rows]], "m_at": s.lo[rows] - base, "m_stop": s.hi[rows] + least - base})
                if crowd.any():
                    at, owner = _strings(s, np.flatnonzero(crowd))
                    row = s.row[owner]
                    start = at - offsets[row]
                    yield _batch({"h": s.spans.hash(at, at + least), "c": s.h[owner], "m_doc": doc[row], "m_at": start, "m_stop": start + least})

    return docs.mapInArrow(emit, "h long, c long, m_doc long, m_at long, m_stop long")


def _numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, key, text) with `doc` a long in the order of the documents.

    Integer keys without NULL or repetition are that already.  Otherwise (key, hash of text) is
    numbered in sorted order, so that rows with a key and text in common are one document.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if rows.schema["key"].dataType.typeName() in ("long", "integer", "short", "byte"):
        counts = rows.groupBy("key").count()
        if not counts.where("key is null or count > 1").take(1):
            return rows.withColumn("doc", F.col("key").cast("long"))
    known = rows.select("key", F.xxhash64("text").alias("mark")).distinct()
    order = [F.col("key").asc_nulls_last(), F.col("mark")]
    known = cut(known.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("doc", F.monotonically_increasing_id()), "numbers")
    known = known.withColumnsRenamed({"key": "n_key", "mark": "n_mark"})
    same = F.col("key").eqNullSafe(F.col("n_key")) & (F.xxhash64("text") == F.col("n_mark"))
    return cut(rows.join(known, same).select("key", "text", "doc"), "numbered")


def _search(docs: DataFrame, least: int, group: int | None, share: int | None) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(spans of segments equal to an earlier one, what classes have in common, bitmap of crowded anchors)."""
    gathered = cut(_gathered(_survey(docs, least, share or SHARE), least, group or GROUP), "gathered")
    noted, big = bitmap(gathered.where("h is not null")), bitmap(gathered.where("big"))
    return gathered.where("h is null").select("doc", "start", "stop"), cut(_repeats(_suffixes(docs, noted, big, least), least), "repeats"), big


def repeat_groups(docs: DataFrame, least: int = LEAST, group: int | None = None, share: int | None = None) -> DataFrame:
    """(anchor, part, doc, start, stop, first) from (doc, text): all that is repeated, in bytes.

    (anchor, part) names a group: one string of `least` bytes or more, and all its occurrences, in
    equal segments and copies too; `first` marks the earliest.  Within the reach of its
    anchor, of 2 * `least` - 32 bytes at most, no group can be extended; a longer repeat is several
    groups, which overlap.  Groups of a crowded anchor are single strings of `least` bytes, which may be extendable.
    Every string of `least` bytes that occurs twice lies in a group that occurs as often.
    `doc` is a long, one row each.  NULL and short texts have no group.  Runs jobs that cut their results into tables.
    """
    ship(docs.sparkSession)
    docs = docs.select("doc", "text")
    _, repeats, big = _search(docs, least, group, share)
    shared = repeats.where("part is not null")
    members = _members(docs, big, least)
    earliest = F.min(F.struct("m_doc", "m_at")).alias("one")
    classes = cut(members.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), earliest).where("n > 1"), "classes")
    name = F.xxhash64("h", "c")
    wanted = bitmap(shared.select(name.alias("h")).unionByName(classes.select(name.alias("h"))))
    members = cut(members.where(may_hold(docs.sparkSession, wanted, name)), "members")
    shift = F.col("m_at") + F.col("start") - F.col("at")
    several = shared.join(members, ["h", "c"]).select(
        F.col("h").alias("anchor"), "part", F.col("m_doc").alias("doc"), shift.alias("start"), (shift + F.col("stop") - F.col("start")).alias("stop"),
        (F.col("first") & (F.col("m_doc") == F.col("doc")) & (F.col("m_at") == F.col("at"))).alias("first"),
    )
    # A class is a group of its own unless what it has in common with others is the whole of it.
    alone = cut(classes.join(shared.where("whole").select("h", "c"), ["h", "c"], "left_anti"), "alone")
    single = alone.join(members, ["h", "c"]).select(
        F.col("h").alias("anchor"), F.col("c").alias("part"), F.col("m_doc").alias("doc"), F.col("m_at").alias("start"), F.col("m_stop").alias("stop"),
        (F.struct("m_doc", "m_at") == F.col("one")).alias("first"),
    )
    return several.unionByName(single)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST,
                   group: int | None = None, share: int | None = None) -> DataFrame:
    """key, n_bytes, spans (start, stop of what goes), kept (the remaining bytes) of every row.

    A byte goes when a string of `least` bytes that covers it also starts earlier: in a
    document with a smaller key, or earlier in the same one.  Defined cases: NULL texts are
    empty; texts below `least` bytes stay whole; a NULL key comes last; rows that share a key
    are documents in the order of a hash of their text, or one document if that is equal
    too; an empty table gives no rows; other columns are not read.
    """
    ship(docs.sparkSession)
    rows = _numbered(docs, key, text)
    whole, repeats, _ = _search(rows.select("doc", "text"), least, group, share)
    found = whole.unionByName(repeats.where("not first").select("doc", "start", "stop"))
    spans = found.groupBy("doc").agg(F.collect_list(F.col("start") * (1 << 32) + F.col("stop")).alias("found"))
    kind = docs.schema[key].dataType

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                data, offsets = texts(part.column("text"))
                sizes, starts, stops, kept = np.diff(offsets), [], [], []
                raw, found = data.tobytes(), part.column("found")
                for k in range(part.num_rows):
                    own = found[k].values
                    own = own.to_numpy(zero_copy_only=False) if own is not None else np.zeros(0, np.int64)
                    a, b = merged(own >> 32, own & 0xFFFFFFFF)
                    whole, at, rest = raw[offsets[k] : offsets[k + 1]], 0, []
                    for x, y in zip(a.tolist(), b.tolist(), strict=True):
                        rest.append(whole[at:x])
                        at = y
                    rest.append(whole[at:])
                    kept.append(b"".join(rest)), starts.append(a), stops.append(b)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(sizes, pa.int64()), pa.array(starts, pa.list_(pa.int64())), pa.array(stops, pa.list_(pa.int64())),
                     pa.array(kept, pa.binary())], names=["key", "n_bytes", "starts", "stops", "kept"])

    joined = rows.join(spans, "doc", "left").select("key", "text", "found")
    done = joined.mapInArrow(apply, f"key {kind.simpleString()}, n_bytes long, starts array<long>, stops array<long>, kept binary")
    spans = F.arrays_zip(F.col("starts").alias("start"), F.col("stops").alias("stop"))
    return done.select(F.col("key").alias(key), "n_bytes", spans.alias("spans"), "kept")
