"""Sets of word shingles as sorted 64-bit hashes, for a batch of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from kinweave.llm.textvec import LOWER, Spans, mix, texts, words

WIDTH = 5
_STEP = np.random.Generator(np.random.PCG64(7)).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, how many each text has): rising and distinct within a text.

    Words are the runs of non-blank bytes with A-Z lower-cased.  A text with fewer than
    `width` words, but any, has one shingle of all its words; one without words has none.
    """
    data, offsets = texts(column)
    starts, ends, row = words(LOWER[data], offsets)
    counts = np.bincount(row, minlength=len(column))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    word = Spans(LOWER[data]).hash(starts, ends)
    n = len(word) - width + 1
    if n > 0:
        value = word[:n] * _STEP[0]
        for k in range(1, width):
            value += word[k : n + k] * _STEP[k]
        inside = row[:n] == row[width - 1 :]
        value, owner = mix(value[inside]), row[:n][inside]
    else:
        value, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    few = np.flatnonzero((counts > 0) & (counts < width))
    if len(few):
        first = np.cumsum(counts)[few] - counts[few]
        short = np.full(len(few), width, np.uint64)
        for k in range(width - 1):
            at = np.minimum(first + k, len(word) - 1)
            short = np.where(k < counts[few], short * _STEP[32] + word[at] * _STEP[k], short)
        value, owner = np.append(value, mix(short ^ counts[few].astype(np.uint64))), np.append(owner, few)
    order = np.argsort(value)
    order = order[np.argsort(owner[order].astype(np.uint16) if len(column) <= 1 << 16 else owner[order], kind="stable")]
    value, owner = value[order], owner[order]
    kept = np.ones(len(value), bool)
    kept[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[kept], np.bincount(owner[kept], minlength=len(column))
