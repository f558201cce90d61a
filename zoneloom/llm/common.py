"""What several text operators share: readers of Arrow text, hashing, gapless numbers, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import zoneloom
from zoneloom.session import settle

# functions that run in Python workers travel by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(zoneloom)

SLICE_BYTES = 1 << 16
LETTERS = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLIERS = (np.random.default_rng(77).integers(1, 1 << 62, 64, dtype=np.uint64) << np.uint64(2)) + np.uint64(3)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


TEXT_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python by the thousand; with the default of 10,000 a batch of long ones fills a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


def whole_row(docs: DataFrame):
    """All columns as one struct, so that a row travels beside helper columns whatever its own are called."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])


def n_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value over all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo..hi of a batch with at most ``limit`` bytes and 8,192 rows, or one longer row: their bytes and offsets."""
    data, at = text_bytes(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = min(lo + 8_192, max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1))
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def row_of(at: np.ndarray) -> np.ndarray:
    """The row that each byte belongs to."""
    return np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))


WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_LETTERS = LETTERS[LOWER]


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes that are not ASCII white space, within rows."""
    n = len(data)
    inside = ~WHITE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = at[:-1][at[:-1] < n]
    begins[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = at[1:][at[1:] > 0] - 1
    ends[last] = inside[last]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(at, s, "right") - 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(1, n), np.uint64)
    have = 1
    while have < len(out):
        more = min(have, len(out) - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


BASE = 0x9E3779B97F4A7C15 | 3
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class Cache(dict):
    """Values worked out once in a process; it travels empty."""

    def __reduce__(self):
        return Cache, ()


POWERS = Cache()


def kept_powers(base: int, n: int) -> np.ndarray:
    if len(POWERS.get(base, ())) < n:
        POWERS[base] = powers(base, max(n, SLICE_BYTES + 1))
    return POWERS[base][:n]


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, from prefix sums of a polynomial over all bytes."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(LOWER_LETTERS[data] * kept_powers(BASE, len(data)), out=total[1:])
    back = kept_powers(BASE_INVERSE, len(data) + 1)
    return mix((total[e] - total[s]) * back[s] + (e - s).astype(np.uint64))


def word_shingles(data: np.ndarray, at: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``size`` lower-cased words, by rows; one with fewer words, but some, has them all as one."""
    s, e, row = words(data, at)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = word_hashes(data, s, e)
    n = len(h)
    m = max(0, n - size + 1)
    whole = np.zeros(m, np.uint64)
    for k in range(size):
        whole += mix(h[k : k + m] * MULTIPLIERS[k])
    full = row[:m] == row[size - 1 :]
    counts = np.bincount(row, minlength=len(at) - 1)
    few = np.flatnonzero((counts > 0) & (counts < size))
    short = np.zeros(len(few), np.uint64)
    if len(few):
        first = np.searchsorted(row, few)
        for k in range(size - 1):
            has = counts[few] > k
            short[has] += mix(h[first[has] + k] * MULTIPLIERS[k])
        short = mix(short + counts[few].astype(np.uint64))
    row, whole = row[:m][full], mix(whole[full])
    if len(few):
        row, whole = np.concatenate([row, few]), np.concatenate([whole, short])
        order = np.argsort(row, kind="stable")
        row, whole = row[order], whole[order]
    return row, whole


def numbered(df: DataFrame, group: list[str], order: list[str], spread: str, pieces: int, to: str) -> DataFrame:
    """Gapless numbers from 0 within each group, without one task per group.

    Rows are dealt to ``pieces`` by the hash column ``spread``; each piece is numbered on its own
    and starts where the counts of the pieces before it end.
    """
    piece = df.withColumn("_piece", F.pmod(F.col(spread), F.lit(pieces)).cast("int"))
    counts = piece.groupBy(*group, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = Window.partitionBy(*group, "_piece").orderBy(*order)
    return (piece.join(starts, [*group, "_piece"])
            .withColumn(to, (F.row_number().over(own) - 1 + F.col("_start")).cast("long"))
            .drop("_piece", "_start"))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternating large-star and small-star steps; every step keeps at most one row per node and
    neighbour, groups through partial sums and is written to the checkpoint folder.
    """
    now = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .filter("a <> b").distinct())
    seen = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        under = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(under, "a")
        small = (linked.select("a", F.col("m").alias("b"))
                 .unionByName(linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
                 .filter("a <> b").distinct())
        now = settle(small)
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (state.n, state.h) == seen:
            break
        seen = (state.n, state.h)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots).distinct()


def near_log(n: float, least: int, most: int) -> int:
    """A power of two near ``n`` between two bounds."""
    return int(min(most, max(least, 2 ** math.ceil(math.log2(max(1.0, n))))))


def blobs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """A binary array whose row i has the bytes of values[cuts[i]:cuts[i + 1]]."""
    values = np.ascontiguousarray(values)
    wide = np.asarray(cuts, np.int64) * values.dtype.itemsize
    if len(wide) and wide[-1] > np.iinfo(np.int32).max:
        raise OverflowError(f"{wide[-1]} bytes in one group: raise spark.sql.shuffle.partitions")
    offsets = wide.astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.view(np.uint8))])
