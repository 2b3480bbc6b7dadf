"""Bitmaps of 64-bit hashes: of one size on the driver and in every task, whatever they hold.

A bitmap only lets rows be left out early; what falls on a set bit by chance is told apart later.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BIT_BITS, BLOCK_BITS = 26, 18


def _bits(h: np.ndarray) -> np.ndarray:
    return (h.view(np.uint64) >> np.uint64(64 - BIT_BITS)).astype(np.int64)


def bitmap(hashes: DataFrame) -> np.ndarray:
    """2**BIT_BITS bits, set where a value of the long column `h` falls."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            bits = _bits(batch.column("h").to_numpy())
            for b in np.unique(bits >> BLOCK_BITS).tolist():
                block = blocks.setdefault(b, np.zeros(1 << BLOCK_BITS, bool))
                block[bits[bits >> BLOCK_BITS == b] & ((1 << BLOCK_BITS) - 1)] = True
        if blocks:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(blocks), pa.int32()), pa.array([np.packbits(x).tobytes() for x in blocks.values()], pa.binary())], names=["block", "bits"])

    block = F.shiftrightunsigned("h", 64 - BIT_BITS + BLOCK_BITS).cast("int").alias("block")
    out = np.zeros((1 << (BIT_BITS - BLOCK_BITS), 1 << (BLOCK_BITS - 3)), np.uint8)
    for row in hashes.select("h").distinct().select("h", block).repartition("block").mapInArrow(collect, "block int, bits binary").collect():
        out[row.block] = np.frombuffer(row.bits, np.uint8)
    return out.ravel()


def is_set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _bits(h)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def may_hold(spark: SparkSession, bits: np.ndarray, h: Column) -> Column:
    """Whether the bitmap has the bit of the long `h`."""
    sent = spark.sparkContext.broadcast(bits)

    def look(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(is_set(sent.value, column.to_numpy(zero_copy_only=False)))

    look.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(look, "boolean")(h)
