"""Bloom filters of bounded size, made by Spark and probed with numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS_PER_SEED = 32
#: Larger sets make a fuller filter, which passes more; the join behind it decides.
MAX_FILTER_BITS = 1 << 28


def filter_slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(bits - 1)
    return h & low, (h >> np.uint64(32)) & low


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """Bloom filter over the seeds, as 64-bit words, of at most ``MAX_FILTER_BITS`` bits."""
    n = seeds.count()
    bits = 1024
    while bits < min(n * FILTER_BITS_PER_SEED, MAX_FILTER_BITS):
        bits *= 2
    low = F.lit(bits - 1)
    slot = F.explode(
        F.array(F.col("h").bitwiseAND(low), F.shiftrightunsigned("h", 32).bitwiseAND(low))
    )
    rows = (
        seeds.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        .toPandas()
    )
    table = np.zeros(bits // 64, np.uint64)
    table[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return table


def in_filter(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (table[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) != 0
