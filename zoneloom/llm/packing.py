"""Packing into optimal length buckets.

The global histogram of lengths goes to a dynamic programme that chooses the bucket boundaries with
the least padding; inside each bucket, documents are numbered and every run of them that fits the
token budget is a batch. Lengths are counted as UTF-8 bytes, as a byte-level model reads them, or by
any column that the caller names. The histogram holds every length that occurs, so the padding is the
least there is. Different lengths add up to the bytes of the corpus at most, so there are no more of them
than the root of twice its size: 250,000 at 30 GB, 16 bytes each.

Defined cases: a null or empty text has length 0 and goes to the shortest bucket; a text longer than
the budget is a batch of its own, never cut; equal lengths never fall into different buckets; null or
repeated ids are ordinary rows; other columns are neither read nor returned, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneloom.llm.common import n_partitions, numbered


def _cheapest(best: np.ndarray, before: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each length i the j < i at which its bucket is best cut off, and what that costs.

    The best j never falls as i grows: lengths in the middle are settled first, and bound those on either side.
    """
    choice = np.zeros(len(best), np.int64)
    trial = best.copy()  # the shortest length has nothing before it
    low, high = np.array([1]), np.array([len(best) - 1])
    left, right = np.array([0]), np.array([len(best) - 1])
    while len(low):
        mid = (low + high) // 2
        size = np.minimum(right, mid - 1) - left + 1
        start = np.cumsum(size) - size
        who = np.repeat(np.arange(len(mid)), size)
        j = np.arange(len(who)) - start[who] + left[who]
        i = mid[who]
        cost = best[j] + (before[i + 1] - before[j + 1]) * wide[i]
        least = np.minimum.reduceat(cost, start)
        hit = np.flatnonzero(cost == least[who])
        choice[mid] = j[hit[np.searchsorted(hit, start)]]
        trial[mid] = least
        below, above = low < mid, mid < high
        low, high, left, right = (
            np.concatenate([low[below], mid[above] + 1]), np.concatenate([mid[below] - 1, high[above]]),
            np.concatenate([left[below], choice[mid][above]]), np.concatenate([choice[mid][below], right[above]]))
    return choice, trial


def boundaries(counts: np.ndarray, lengths: np.ndarray, buckets: int) -> list[int]:
    """Indexes of the longest length of each bucket, so that the padded total is least."""
    n = len(counts)
    if n == 0:
        return []
    # whole numbers unless the padded total could pass 2^62
    exact = int(counts.sum()) * int(lengths[-1]) < 1 << 62
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64 if exact else np.float64)
    wide = lengths.astype(before.dtype)
    best = before[1:] * wide
    back = []
    for _ in range(min(buckets, n) - 1):
        choice, trial = _cheapest(best, before, wide)
        choice[trial >= best] = -1
        back.append(choice)
        best = np.minimum(best, trial)
    ends, i = [n - 1], n - 1
    for choice in reversed(back):
        if choice[i] >= 0:
            i = int(choice[i])
            ends.append(i)
    return ends[::-1]


def pack(docs: DataFrame, length: Column | None = None, buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """Every document with its length, bucket, width, batch of the bucket, place in it and padding."""
    if length is None:
        length = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(length.cast("long"), F.lit(0).cast("long")).alias("n_tokens"))
    # at most the root of twice the bytes of all texts
    found = rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).toArrow()
    lengths, counts = found["n_tokens"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(lengths)
    widths = [int(lengths[order[e]]) for e in boundaries(counts[order], lengths[order], buckets)]
    fits = [max(1, budget // max(1, w)) for w in widths]

    def pick(values):
        return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values or [0]]), F.col("bucket") + 1)

    passed = F.filter(F.array(*[F.lit(w).cast("long") for w in widths or [0]]), lambda w: w < F.col("n_tokens"))
    placed = rows.withColumn("bucket", F.size(passed)).withColumn("spread", F.xxhash64("doc_id", "n_tokens"))
    placed = numbered(placed, ["bucket"], ["spread", "doc_id", "n_tokens"], "spread", 4 * n_partitions(docs.sparkSession), "k")
    return placed.select(
        "doc_id", "n_tokens", "bucket", pick(widths).alias("bucket_width"),
        F.floor(F.col("k") / pick(fits)).cast("long").alias("batch"),
        (F.col("k") % pick(fits)).cast("long").alias("place"), (pick(widths) - F.col("n_tokens")).alias("padding"))
