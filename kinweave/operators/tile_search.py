"""Rows of one tile, all compared with each other: runs on the executors, in numpy.

A tile holds rows that agree in all fields but the open ones.  Each two of them are held against
each other by lengths and characters first, which bound their edit distance from below.  An
edit distance is then only worked out where it can matter: where the two rows are not
linked yet, or where the pair may score better than the best one known of either.  Pairs with the
lowest bounds come first, so in a crowd nearly all others are ruled out.  What comes out is a
best pair of every row that has one and a forest that links what the similar pairs link.

Functions of this module are sent to the executors whole: they need no copy of the package.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pairs whose characters are compared at once, and pairs whose edit distances are worked out at once.
CELLS, BATCH = 1 << 18, 1 << 14
# Bits of a mask for the first occurrence of a character, by its code, and for later ones.
SIGNS, MORE = 37, 27
# What tells tiles apart.
KEY = ("_h", "_g", "_i", "_j")


def budgets(lengths, threshold):
    """`edit_budget`, of an array of lengths."""
    return np.floor(lengths * (1.0 - threshold) + 1e-9).astype(np.int64)


def characters(texts):
    """Lengths, code points from 1 on as one row per position, and a mask of 64 bits of each text.

    A bit of the mask stands for the first occurrence of some characters or for a later one of
    some: of two texts, each edit changes one bit of what only one has and one of what only the other has at most.
    """
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    n, widest = len(lengths), max(int(lengths.max()), 1)
    held = np.array(texts.to_pylist(), dtype=f"U{widest}")
    codes = held.view(np.uint32).reshape(n, widest)
    there = np.arange(widest) < lengths[:, None]
    codes = np.where(there, codes + np.uint32(1), 0).astype(np.uint32)
    kind = np.uint8 if codes.max() < 256 else np.uint32
    signs = np.sort(codes, axis=1)
    at = np.arange(widest)
    fresh = np.ones((n, widest), bool)
    fresh[:, 1:] = signs[:, 1:] != signs[:, :-1]
    again = at - np.maximum.accumulate(np.where(fresh, at, 0), axis=1)
    bit = np.where(again == 0, signs % SIGNS, SIGNS + (signs + 5 * np.maximum(again - 1, 0)) % MORE).astype(np.uint64)
    marks = np.where(signs > 0, np.uint64(1) << bit, np.uint64(0))
    return lengths, np.ascontiguousarray(codes.T.astype(kind)), np.bitwise_or.reduce(marks, axis=1)


def distances(codes, lengths, a, b, cap):
    """Edit distances of the texts `a` and `b`, rows of `codes`, whose lengths differ by `cap` at most;
    beyond `cap` any number above it."""
    la, lb = lengths[a], lengths[b]
    rows, band = int(la.max(initial=0)), 2 * cap + 1
    kind = np.uint8 if rows + cap < 100 else np.int32
    far = 120 if kind is np.uint8 else 1 << 30
    x = codes[:rows, a]
    y = np.zeros((rows + band, len(b)), codes.dtype)
    have = min(len(codes), rows + cap + 1)
    y[cap:cap + have] = codes[:have, b]
    line = np.full((band, len(a)), far, kind)
    line[cap:] = np.arange(cap + 1, dtype=kind)[:, None]
    out = np.full(len(a), far, np.int64)
    place = lb - la + cap

    def note(row):
        done = np.flatnonzero(la == row)
        out[done] = line[place[done], done]

    note(0)
    for row in range(1, rows + 1):
        new = line + (x[row - 1] != y[row - 1:row - 1 + band])
        np.minimum(new[:-1], line[1:] + kind(1), out=new[:-1])
        if row <= cap:
            new[:cap - row] = far
            new[cap - row] = row
        for o in range(max(1, cap - row + 1), band):
            np.minimum(new[o], new[o - 1] + kind(1), out=new[o])
        line = new
        note(row)
    return out


def rounded(scores):
    """To 6 places as Spark rounds: half up, by the shortest decimals of a number."""
    values, which = np.unique(scores, return_inverse=True)
    place = Decimal("0.000001")
    return np.array([float(Decimal(repr(float(v))).quantize(place, ROUND_HALF_UP)) for v in values], np.float64)[which]


class Tile:
    """Rows from 0 on, of which the first `left` are to be compared with the others, or with each
    other where `twin`.  `fields`: (texts, threshold) of the open fields; `score` makes the score of
    pairs from the similarities of these.  Pairs below the score `least` do not count."""

    def __init__(self, fields, left, n, twin, score, least):
        self.left, self.n, self.twin, self.score, self.least = left, n, twin, score, least
        self.fields = []
        for texts, threshold in fields:
            lengths, codes, mask = characters(texts)
            self.fields.append((lengths, codes, mask, budgets(lengths, threshold)))
        self.root = np.arange(n)
        self.best = np.full(n, -1.0)
        self.partner = np.full(n, -1)
        self.forest = []

    def search(self):
        """(row, other row, score): a best pair of each row, and what links them."""
        if self.fields:
            self._meet()
        else:
            self._all_alike()
        own = np.flatnonzero(self.partner >= 0)
        parts = [(own, self.partner[own], self.best[own]), *self.forest]
        a, b, score = (np.concatenate(x) for x in zip(*parts))
        return a, b, rounded(score)

    def _all_alike(self):
        rows = np.arange(self.n)
        ends = [(0, rows[1:])] if self.twin else [(0, rows[self.left:]), (self.left, rows[1:self.left])]
        for one, others in ends:
            self._keep(np.full(len(others), one), others, self.score([]))

    def _meet(self):
        lengths, _, mask, budget = self.fields[0]
        rows = np.argsort(lengths[:self.left], kind="stable")
        others = rows if self.twin else self.left + np.argsort(lengths[self.left:], kind="stable")
        theirs = lengths[others]
        if len(rows) * len(others) <= CELLS:
            return self._meet_at_once(rows, others)
        sizes, starts = np.unique(lengths[rows], return_index=True)
        for size, start, end in zip(sizes, starts, [*starts[1:], len(rows)]):
            allowed = np.maximum(budget[rows[start]], budget[others])
            gap = np.abs(theirs - size)
            reach = np.flatnonzero(gap <= allowed)
            if not len(reach):
                continue
            first, last = reach[0], reach[-1] + 1
            at = start
            while at < end:
                low = max(first, at + 1) if self.twin else first
                if low >= last:
                    break
                until = min(end, at + max(1, CELLS // (last - low)))
                among = others[low:last]
                unlike = np.bitwise_count(mask[rows[at:until], None] ^ mask[among])
                most = 2 * allowed[low:last] - gap[low:last]
                found = np.flatnonzero(unlike <= np.clip(most, 0, 255).astype(np.uint8))
                row, col = np.divmod(found, last - low)
                if self.twin:
                    later = row + at < col + low
                    found, row, col = found[later], row[later], col[later]
                lowest = (unlike.ravel()[found] + gap[low:last][col] + 1) // 2
                self._compare(rows[at + row], among[col], lowest)
                at = until

    def _meet_at_once(self, rows, others):
        """A small tile: all lengths together, as every call of numpy has its price."""
        lengths, _, mask, budget = self.fields[0]
        gap = np.abs(lengths[rows, None] - lengths[others])
        allowed = np.maximum(budget[rows, None], budget[others])
        unlike = np.bitwise_count(mask[rows, None] ^ mask[others])
        near = (unlike <= 2 * allowed - gap) & (gap <= allowed)
        row, col = np.nonzero(np.triu(near, 1) if self.twin else near)
        self._compare(rows[row], others[col], (unlike[row, col] + gap[row, col] + 1) // 2)

    def _compare(self, a, b, lowest):
        """Pairs that may be similar by the first field, of which they differ by `lowest` edits at least."""
        bounds = [lowest]
        for lengths, _, mask, budget in self.fields[1:]:
            gap = np.abs(lengths[a] - lengths[b])
            bound = (np.bitwise_count(mask[a] ^ mask[b]) + gap + 1) // 2
            near = np.maximum(bound, gap) <= np.maximum(budget[a], budget[b])
            a, b, bounds = a[near], b[near], [x[near] for x in [*bounds, bound]]
        most = self._scored(a, b, bounds)
        step = np.sum(bounds, axis=0)
        for level in np.unique(step):
            chosen = np.flatnonzero(step == level)
            for at in range(0, len(chosen), BATCH):
                some = chosen[at:at + BATCH]
                x, y = a[some], b[some]
                matter = (self.root[x] != self.root[y]) | (most[some] > np.minimum(self.best[x], self.best[y]))
                if self.least:
                    matter &= most[some] >= self.least - 1e-5
                self._verify(x[matter], y[matter])

    def _scored(self, a, b, edits):
        shares = []
        for (lengths, *_), edit in zip(self.fields, edits):
            longer = np.maximum(np.maximum(lengths[a], lengths[b]), 1)
            shares.append(np.where(edit == 0, 1.0, 1.0 - edit / longer))
        return self.score(shares)

    def _verify(self, a, b):
        edits = []
        for lengths, codes, _, budget in self.fields:
            if not len(a):
                return
            allowed = np.maximum(budget[a], budget[b])
            apart = distances(codes, lengths, a, b, int(allowed.max()))
            near = apart <= allowed
            a, b, edits = a[near], b[near], [x[near] for x in [*edits, apart]]
        self._keep(a, b, self._scored(a, b, edits))

    def _keep(self, a, b, scores):
        """Similar pairs: they may be the best of their rows, and may link what was apart."""
        scores = np.broadcast_to(scores, a.shape)
        if self.least:
            enough = rounded(scores) >= self.least
            a, b, scores = a[enough], b[enough], scores[enough]
        for one, other in ((a, b), (b, a)):
            np.maximum.at(self.best, one, scores)
            top = scores == self.best[one]
            self.partner[one[top]] = other[top]
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, scores, x, y = a[apart], b[apart], scores[apart], x[apart], y[apart]
            high, pick = np.unique(np.maximum(x, y), return_index=True)
            self.root[high] = np.minimum(x, y)[pick]
            self.forest.append((a[pick], b[pick], scores[pick]))
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]


def searcher(places, thresholds, known, n_exact, least, schema):
    """A function for `mapInArrow` over rows sorted by `KEY`, then `_right`.

    The fields of the rule in order are `places`: ("open", number) or ("known", number).  Open field
    n is column `_o{n}`; of a known one `_d{n}` and `_n{n}` are the edits between the two values of the tile and
    the longer length.
    """
    def scorer(edits, longer):
        fixed = [1.0 if d == 0 else 1.0 - d / n for d, n in zip(edits, longer)]

        def score(shares):
            total = float(n_exact)
            for kind, number in places:
                total = total + (shares if kind == "open" else fixed)[number]
            return total / float(n_exact + len(places))

        return score

    def settle(held):
        rows = pa.Table.from_batches(held).combine_chunks()
        n, twin = rows.num_rows, rows["_twin"][0].as_py() and rows["_i"][0].as_py() == rows["_j"][0].as_py()
        left = n - pc.sum(pc.cast(rows["_right"], pa.int64())).as_py()
        if n < 2 or not (twin or 0 < left < n):
            return None
        edits, longer = ([rows[f"{c}{i}"][0].as_py() for i in range(known)] for c in ("_d", "_n"))
        fields = [(rows[f"_o{i}"].combine_chunks(), t) for i, t in enumerate(thresholds)]
        a, b, score = Tile(fields, left, n, twin, scorer(edits, longer), least).search()
        ids = rows["pid"].combine_chunks()
        return pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b)), pa.array(score)], schema=schema)

    def run(batches):
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in KEY])
            turns = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for start, end in zip(turns, turns[1:]):
                key = keys[:, start].tolist()
                if key != last and held:
                    done = settle(held)
                    if done is not None:
                        yield done
                    held = []
                held.append(batch.slice(start, end - start))
                last = key
        if held:
            done = settle(held)
            if done is not None:
                yield done

    return run
