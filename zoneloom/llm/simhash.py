"""SimHash fingerprints of whole texts, and permuted block tables that find the near ones.

Every run of five lower-cased words is a term; its 128-bit hash votes on the sign of each bit, once
for every time the term occurs. Texts of Jaccard similarity 0.8 differ in about 19 bits, give or take
4, so near means Hamming radius 23. Of two fingerprints within radius ``r`` at least one of eight
blocks of 16 bits differs in ``r // 8`` bits or fewer: a table a block, asked with every such change
of the query's block, finds all of them; the whole distance decides. Queries and fingerprints meet in
tiles of a share of both, each pair in one, and a tile returns one row a query, not its pairs.

Documents are compared with the next one by ``doc_id``. One shuffle deals the texts to ranges of ids;
the first document of each range is also sent to the end of the range before it.

Defined cases: a null text is empty; a text without words has the fingerprint of zeros, one with
fewer than five words has them all as one term; a null ``doc_id`` sorts first, rows of the same
``doc_id`` by text; the document after the last is the first, a single one is its own next; an empty
table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneloom.llm.common import mix, n_partitions, small_batches, text_bytes, word_shingles
from zoneloom.session import settle

BITS = 128
RADIUS = 23
BLOCK = 16  # bits
TILE = 1 << 18  # fingerprints
ASKED = 1 << 17  # queries
CANDIDATES = 1 << 17  # at once
LOWEST = -(1 << 63)
STRIDE = 1 << 15
ROWS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def fingerprints(texts: list[str]) -> np.ndarray:
    """(n, 16) bytes: the bits for which the weighted votes of the terms are positive."""
    data, at = text_bytes(pa.array(texts, pa.large_string()))
    row, h = word_shingles(data, at)
    order = np.argsort(row, kind="stable")
    row, h = row[order], h[order]
    both = np.stack([h, mix(h + np.uint64(0x632BE59BD9B4E019))], axis=1)
    edges = np.searchsorted(row, np.arange(len(texts) + 1))
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    for i in range(len(texts)):
        lo, hi = edges[i], edges[i + 1]
        if lo == hi:
            continue
        votes = np.zeros(BITS, np.int64)
        for a in range(lo, hi, STRIDE):
            votes += np.unpackbits(both[a : min(hi, a + STRIDE)].view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * votes > hi - lo)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def edited(text: str, after: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


def _measure(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Rows for all but the last of the texts."""
    changed = [edited(t, u) for t, u in zip(texts, texts[1:], strict=False)]
    own, other = fingerprints(texts), fingerprints(changed)
    hexed = lambda x: [r.tobytes().hex() for r in x]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
         pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]), pa.array(hexed(own[:-1])), pa.array(hexed(other)),
         pa.array(likeness(own[:-1], other)), pa.array(likeness(own[:-1], own[1:]))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _walk(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Sorted rows in, each measured against the one after it; a range's last row only closes it."""
    ids, texts, size = [], [], 0
    for b in batches:
        for key, tail, text in zip(b.column("doc_id").to_pylist(), b.column("tail").to_pylist(), b.column("text"), strict=True):
            value = text.as_py() or ""
            ids.append(key)
            texts.append(value)
            size += len(value)
            if tail or size > limit:
                if len(texts) > 1:
                    yield _measure(ids, texts)
                keep = slice(len(ids) if tail else -1, None)
                ids, texts = ids[keep], texts[keep]
                size = sum(map(len, texts))


def fingerprint_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with the likeness to that and to the next."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    ranges = 2 * n_partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("k"))
    cuts = rows.agg(F.percentile_approx("k", [i / ranges for i in range(1, ranges)], 10_000).alias("cuts")).first()["cuts"]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(), "right").astype("int32"))

    firsts = rows.select("k").withColumn("range", range_of("k")).groupBy("range").agg(F.min("k").alias("k")).orderBy("range").collect()
    before = {r["k"]: firsts[i - 1]["range"] for i, r in enumerate(firsts)}  # one entry a range
    keys, goals = np.array(sorted(before), np.int64), np.array([before[k] for k in sorted(before)], np.int32)

    @F.pandas_udf("array<int>")
    def homes(k: pd.Series) -> pd.Series:
        """The range of an id and, for the first of a range, the one before it as -1 - range."""
        values = k.to_numpy()
        own = np.searchsorted(cuts, values, "right")
        at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        return pd.Series([[int(o), -1 - int(goals[j])] if keys[j] == v else [int(o)] for o, j, v in zip(own, at, values, strict=True)])

    dealt = (rows.withColumn("home", F.explode(homes("k")))
             .select("doc_id", "text", "k", (F.col("home") < 0).alias("tail"),
                     F.when(F.col("home") < 0, -1 - F.col("home")).otherwise(F.col("home")).alias("range"))
             .repartition(ranges, "range").sortWithinPartitions("range", "tail", "k", "text"))
    return dealt.select("doc_id", "tail", "text").mapInArrow(_walk, ROWS)


def block_changes(flips: int) -> np.ndarray:
    """Every value of a block with at most ``flips`` bits set."""
    every = np.arange(1 << BLOCK, dtype=np.int64)
    return every[np.bitwise_count(every) <= flips]


def pairs_within(queries: np.ndarray, prints: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, print) numbers of all pairs of (n, 16) bytes at most ``radius`` bits apart, each once."""
    tables = BITS // BLOCK
    flips = radius // tables
    changes = block_changes(flips)
    asked, kept = (np.ascontiguousarray(x).view(np.uint16).astype(np.int64) for x in (queries, prints))
    whole, held = (np.ascontiguousarray(x).view(np.uint64) for x in (queries, prints))
    for t in range(tables):
        order = np.argsort(kept[:, t], kind="stable")
        starts = np.searchsorted(kept[order, t], np.arange((1 << BLOCK) + 1))
        step = max(1, CANDIDATES // len(changes))
        for lo in range(0, len(asked), step):
            keys = asked[lo : lo + step, t, None] ^ changes
            first, n = starts[keys], starts[keys + 1] - starts[keys]
            ends = np.cumsum(n.sum(axis=1))
            a = 0
            while a < len(keys):
                # a query has no more candidates than the tile has fingerprints
                z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CANDIDATES, "right")))
                some, begin = n[a:z].ravel(), first[a:z].ravel()
                query = np.repeat(np.arange(lo + a, lo + min(z, len(keys))), n[a:z].sum(axis=1))
                at = np.arange(some.sum()) + np.repeat(begin - (np.cumsum(some) - some), some)
                found = order[at]
                a = z
                near = np.bitwise_count(whole[query] ^ held[found]).sum(axis=1) <= radius
                query, found = query[near], found[near]
                if t:  # those that an earlier table has found
                    fresh = (np.bitwise_count(asked[query, :t] ^ kept[found, :t]) > flips).all(axis=1)
                    query, found = query[fresh], found[fresh]
                yield query, found


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BITS // 8)


def _near(radius: int):
    """The queries of a tile, each with the smallest id and the number of rows within the radius there."""

    def near(table: pa.Table) -> pa.Table:
        side = pc.is_null(table.column("n"))  # a query has no count
        asked, held = table.filter(side), table.filter(pc.invert(side))
        queries, prints = _bytes(asked.column("print")), _bytes(held.column("print"))
        n, known = held.column("n").to_numpy(), held.column("least").is_valid().to_numpy()
        least = held.column("least").fill_null(0).to_numpy()
        rows, best = np.zeros(len(queries), np.int64), np.full(len(queries), np.iinfo(np.int64).max)
        has = np.zeros(len(queries), bool)
        for query, found in pairs_within(queries, prints, radius):
            np.add.at(rows, query, n[found])
            query, found = query[known[found]], found[known[found]]
            np.minimum.at(best, query, least[found])
            has[query] = True
        some = np.flatnonzero(rows)
        return pa.table({"print": asked.column("print").take(pa.array(some)), "near_id": pa.array(best[some], pa.int64(), mask=~has[some]),
                         "n_near": pa.array(rows[some])})

    return near


def near_counts(queries: DataFrame, held: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(print, near_id, n_near) of each distinct query: the least id and the rows of (print, least, n) at most ``radius`` bits away."""
    spark = held.sparkSession
    queries, held = settle(queries.distinct()), settle(held)
    parts = max(n_partitions(spark), math.ceil(held.count() / TILE))
    bands = max(1, math.ceil(queries.count() / ASKED))

    def share(of: int):
        return F.pmod(F.xxhash64("print"), F.lit(of))

    def every(of: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(of - 1).cast("long")))

    asked = queries.select("print", F.lit(None).cast("long").alias("least"), F.lit(None).cast("long").alias("n"),
                           share(bands).alias("band"), every(parts).alias("part"))
    kept = held.select("print", "least", "n", every(bands).alias("band"), share(parts).alias("part"))
    found = (asked.unionByName(kept).select((F.col("band") * parts + F.col("part")).alias("tile"), "print", "least", "n")
             .groupBy("tile").applyInArrow(_near(radius), "print binary, near_id long, n_near long"))
    return found.groupBy("print").agg(F.min("near_id").alias("near_id"), F.sum("n_near").alias("n_near"))


def fingerprint_documents(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fingerprint_next`` and, for ids divisible by 20, the smallest id within the radius and how many rows are."""
    rows = settle(fingerprint_next(docs))
    prints = rows.select(F.unhex("fingerprint").alias("print"), "doc_id")
    held = prints.groupBy("print").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    found = near_counts(prints.filter("doc_id % 20 = 0").select("print"), held, radius)
    found = found.select(F.lower(F.hex("print")).alias("fingerprint"), "near_id", "n_near")
    again = rows.join(found, "fingerprint", "left")
    only = F.col("doc_id") % 20 == 0
    return again.select(*[c for c in rows.columns], F.when(only, F.col("near_id")).alias("near_id"),
                        F.when(only, F.col("n_near")).alias("n_near"))
