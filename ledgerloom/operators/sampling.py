"""Pilot subsets, size buckets, ordinals and seeds."""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.governance import BUCKETS
from ledgerloom.sources.shared import stored

# Upper bounds of the size buckets in bytes, named by the corruption that makes files so large.
SIZES = (("clean", 60 * 1024), ("light", 200 * 1024), ("heavy", 500 * 1024), ("very-heavy", 1_000_000_000))


def size_bucket(size: Column, unit: float = 1.0) -> Column:
    """Half-open size buckets, null from the last bound on; unit scales the bounds."""
    out = F.lit(None).cast("string")
    for name, bound in reversed(SIZES):
        out = F.when(size < bound * unit, name).otherwise(out)
    return out


def pilot(docs: DataFrame, n: int, group: str, order: str) -> DataFrame:
    """The first n documents of each group."""
    return docs.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(order))).filter(F.col("place") <= n)


def with_seed(docs: DataFrame, master: int, order: str) -> DataFrame:
    """A seed for each document from its place in a total order.

    Range-sorted partitions number their rows, then add the rows of those before: no partition holds all rows. The numbered rows
    are stored, so what counts them and what reads them sees the same numbers.
    """
    placed = stored(docs.orderBy(order).withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    idx = F.col("_row") - F.col("_first") + F.col("_start")
    return placed.join(F.broadcast(starts), "_part").withColumn("idx", idx).withColumn("seed", F.lit(master) * 1_000_000 + F.col("idx")).drop("_part", "_row", "_n", "_first", "_start")


# MT19937, its state's size and middle, and the multipliers of its seeding.
WORDS, MIDDLE, FIRST_SEED, SEEDING = 624, 397, 19650218, (1812433253, 1664525, 1566083941)
TWIST, TOP, REST = 0x9908B0DF, 0x80000000, 0x7FFFFFFF
#: Seeds that are worked on at a time; a state is 2.5 kB.
TOGETHER = 4096


@functools.lru_cache(maxsize=1)
def _unseeded() -> np.ndarray:
    """The state that every seeding begins from."""
    state = [FIRST_SEED]
    for i in range(1, WORDS):
        state.append((SEEDING[0] * (state[-1] ^ (state[-1] >> 30)) + i) & 0xFFFFFFFF)
    return np.array(state, np.uint32)


def _states(keys: np.ndarray) -> np.ndarray:
    """The states (WORDS, seeds) of keys (words of the seed, seeds), all seeds at once."""
    s = np.repeat(_unseeded()[:, None], keys.shape[1], axis=1)
    mixed = lambda i, by: s[i] ^ ((s[i - 1] ^ (s[i - 1] >> np.uint32(30))) * np.uint32(by))
    i = 1
    for k in range(2 * WORDS - 1):
        if k < WORDS:
            j = k % len(keys)
            s[i] = mixed(i, SEEDING[1]) + keys[j] + np.uint32(j)
        else:
            s[i] = mixed(i, SEEDING[2]) - np.uint32(i)
        i += 1
        if i == WORDS:
            s[0], i = s[WORDS - 1], 1
    s[0] = TOP
    return s


def first_draws(seeds: np.ndarray) -> np.ndarray:
    """The first number from 0 to 1 of a Mersenne twister with each 64-bit seed; a negative seed is as its positive one."""
    out = np.empty(len(seeds), np.float64)
    size = np.where(seeds < 0, np.uint64(0) - seeds.astype(np.uint64), seeds.astype(np.uint64))
    for wide in (False, True):
        some = np.flatnonzero((size >> np.uint64(32) > 0) == wide)
        for at in range(0, len(some), TOGETHER):
            here = some[at : at + TOGETHER]
            low, high = (size[here] & np.uint64(0xFFFFFFFF)).astype(np.uint32), (size[here] >> np.uint64(32)).astype(np.uint32)
            s = _states(np.stack([low, high] if wide else [low]))
            draws = []
            for i in range(2):
                y = (s[i] & np.uint32(TOP)) | (s[i + 1] & np.uint32(REST))
                x = s[i + MIDDLE] ^ (y >> np.uint32(1)) ^ ((y & np.uint32(1)) * np.uint32(TWIST))
                x ^= x >> np.uint32(11)
                x ^= (x << np.uint32(7)) & np.uint32(0x9D2C5680)
                x ^= (x << np.uint32(15)) & np.uint32(0xEFC60000)
                draws.append(x ^ (x >> np.uint32(18)))
            out[here] = ((draws[0] >> np.uint32(5)).astype(np.float64) * 67108864.0 + (draws[1] >> np.uint32(6))) / 9007199254740992.0
    return out


def buckets_of(seeds: np.ndarray) -> np.ndarray:
    """Corruption buckets by one draw of the Mersenne twister with each seed."""
    upto = np.array(list(itertools.accumulate(share for _, share in BUCKETS)))
    at = np.searchsorted(upto, first_draws(seeds), side="right")
    return np.array([name for name, _ in BUCKETS], dtype=object)[np.minimum(at, len(BUCKETS) - 1)]


def bucket_of(seed: int) -> str:
    return buckets_of(np.array([seed], np.int64))[0]


def with_bucket(docs: DataFrame) -> DataFrame:
    """The corruption bucket of each seed, null for a null one; no SQL function has this generator."""

    @F.pandas_udf("string")
    def drawn(seeds: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(seeds), dtype=object)
        known = seeds.notna().to_numpy()
        out[known] = buckets_of(seeds[known].to_numpy().astype(np.int64))
        return out

    return docs.withColumn("bucket", drawn("seed"))


def spaced_dates(start: Column, days: Column, n: Column) -> Column:
    """n dates, evenly spaced over some days."""
    one = lambda i: F.date_add(start, F.floor(days * (i / n)).cast("int"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<date>"))
