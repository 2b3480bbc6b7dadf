"""Token ids of many texts at once, for a byte-level BPE with the usual splitting pattern.

The pattern cuts a text into short pieces that are encoded one by one.  Here the pieces of a
whole batch are found with numpy, and every different piece is encoded once per worker, with
the vocabulary of a tokenizers file; `tests/llm` compares the ids with those that the
tokenizers library gives for whole texts.
"""

from __future__ import annotations

import functools
import itertools
import json

import numpy as np
import pandas as pd
import pyarrow as pa

from kinweave.llm.textvec import Spans, texts

VOCABULARY = "byte_bpe_50k.json"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER, LETTER, NUMBER, SPACE = range(4)
#: Different pieces that a worker remembers before it starts anew; a matter of memory only.
REMEMBERED = 300_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point, as the splitting pattern sees it."""
    import regex

    classes = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, range(0xD800))) + "\0" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for run in regex.finditer(pattern, every):
            classes[run.start() : run.end()] = kind
    return classes


def _pieces(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces start; `points` are code points, `offsets` where the texts start and end.

    The pattern: 's|'t|'re|'ve|'m|'ll|'d, then a run of letters, of numbers, or of others, each
    with one blank before it if there is one, then white space, of which the last before a
    word is left over for the next piece.
    """
    kind = _classes()[points]
    edge = np.zeros(len(points) + 1, bool)
    edge[offsets] = True
    start = edge[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(start)
    ends = np.append(runs[1:], len(points))
    # White space before another run: its last character stands alone or, a blank, joins the run.
    gap = np.flatnonzero((kind[runs] == SPACE) & ~edge[ends])
    last = ends[gap] - 1
    start[last] = True
    start[ends[gap][points[last] == 32]] = False
    # Contractions: an apostrophe alone and not after a blank, then the letters in question.
    for k in np.flatnonzero((points[runs] == 39) & (ends - runs == 1) & start[runs] & ~edge[ends]):
        at, stop = ends[k], ends[k + 1] if k + 1 < len(ends) else len(points)
        if kind[at] != LETTER:
            continue
        pair = bytes(min(p, 255) for p in points[at : min(stop, at + 2)])
        size = 1 if pair[:1] in (b"s", b"t", b"m", b"d") else 2 if pair in (b"re", b"ve", b"ll") else 0
        if size:
            start[at] = False
            if at + size < stop:
                start[at + size] = True
    return np.flatnonzero(start)


class Known:
    """A growing map from 64-bit hashes to row numbers, as two sorted arrays."""

    def __init__(self) -> None:
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 where there is none."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        order = np.argsort(hashes)
        at = np.empty(len(hashes), np.int64)
        at[order] = np.minimum(np.searchsorted(self.hashes, hashes[order]), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.rows[at], -1)

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Rows for new hashes, numbered on from the last."""
        rows = len(self.hashes) + np.arange(len(hashes))
        order = np.argsort(hashes)
        every = np.concatenate([self.hashes, hashes[order]])
        merged = np.argsort(every, kind="stable")
        self.hashes, self.rows = every[merged], np.concatenate([self.rows, rows[order]])[merged]
        return rows


def grown(array: np.ndarray, size: int) -> np.ndarray:
    """`array`, doubled until it has `size` rows."""
    while len(array) < size:
        array = np.concatenate([array, np.zeros_like(array)])
    return array


def _byte_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary as bytes: a byte-level file writes every byte as one printable character."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    letters = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(letters[c] for c in token): rank for token, rank in vocabulary.items() if all(c in letters for c in token)}


class Encoder:
    """Ids of texts by the vocabulary file at `path`; one per worker."""

    def __init__(self, path: str):
        import tiktoken

        self.model = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=_byte_ranks(path), special_tokens={})
        self._forget()

    def _forget(self) -> None:
        self.known = Known()
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _learn(self, fresh: list[str], hashes: np.ndarray) -> np.ndarray:
        found = list(map(self.model.encode_ordinary, fresh))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        total = int(sizes.sum())
        rows = self.known.add(hashes)
        self.flat = grown(self.flat, self.used + total)
        self.first, self.count = grown(self.first, len(self.known)), grown(self.count, len(self.known))
        self.flat[self.used : self.used + total] = np.fromiter(itertools.chain.from_iterable(found), np.uint32, total)
        self.first[rows] = self.used + np.cumsum(sizes) - sizes
        self.count[rows] = sizes
        self.used += total
        return rows

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each text has); a NULL text has none."""
        data, offsets = texts(column)
        raw = data.tobytes()
        try:
            points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        except UnicodeDecodeError:  # not UTF-8: text by text, with the usual mark for what is damaged
            rows = [self.model.encode_ordinary(raw[a:b].decode("utf-8", "replace")) for a, b in itertools.pairwise(offsets.tolist())]
            return np.array([i for row in rows for i in row], np.uint32), np.array([len(row) for row in rows], np.int64)
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        if len(points) == len(data):
            starts = _pieces(points, offsets)
        else:
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            starts = lead[_pieces(points, np.searchsorted(lead, offsets))]
        ends = np.append(starts[1:], len(data))
        codes, hashes = pd.factorize(Spans(data).hash(starts, ends))
        if len(self.known) > REMEMBERED:
            self._forget()
        place = self.known.find(hashes)
        new = np.flatnonzero(place < 0)
        if len(new):
            one = np.zeros(len(hashes), np.int64)
            one[codes[::-1]] = np.arange(len(codes))[::-1]
            spans = zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)
            place[new] = self._learn([raw[a:b].decode() for a, b in spans], hashes[new])
        sizes, first = self.count[place][codes], self.first[place][codes]
        upto = np.cumsum(sizes)
        ids = self.flat[np.repeat(first - (upto - sizes), sizes) + np.arange(upto[-1])]
        return ids, np.diff(np.append(0, upto)[np.searchsorted(starts, offsets)])


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
