"""Exact duplicates: a static binary-fuse filter for each immutable snapshot screens what comes in.

A snapshot is frozen, so its filter is built once from its digests and never updated: one filter a
shard, 9 bits or so a digest. Incoming digests are routed to the shard's filter. What the filter
knows for sure to be new skips the snapshot; the rest joins the snapshot's exact buckets, where the
bytes of the two texts are compared. Copies within the new batch are grouped separately.

Defined cases: a null text counts as empty, and empty texts are equal; a null ``doc_id`` is smaller
than every other; rows that agree in text and ``doc_id`` are one document written twice and share
its verdict; an empty table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneloom.llm.common import mix, n_partitions, small_batches, whole_row
from zoneloom.session import settle


def normal_text(texts: pa.Array) -> pa.Array:
    """Only A-Z lower-cased; null is empty."""
    return pc.ascii_lower(texts.fill_null(""))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [hashlib.sha256(x.as_buffer()).digest() for x in normal_text(b.column("text")).cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("raw"), pa.array(found, pa.binary()), b.column("incoming")],
                                         ["doc_id", "raw", "digest", "incoming"])


def _raw():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, raw, digest, incoming) of every row: a hash of the text as it is, SHA-256 of the normalised text."""
    return (rows.select("doc_id", _raw().alias("raw"), "text", "incoming")
            .mapInArrow(_digest, "doc_id long, raw long, digest binary, incoming boolean"))


# ---- binary-fuse filter, three slots a key, 8-bit fingerprints


def _slots(keys: np.ndarray, seed: int, length: int, segments: int) -> np.ndarray:
    h = mix(keys + np.uint64(seed))
    start = (h >> np.uint64(32)) % np.uint64(segments)
    within = [mix(h + np.uint64(k + 1)) & np.uint64(length - 1) for k in range(3)]
    return np.stack([((start + np.uint64(k)) * np.uint64(length) + within[k]).astype(np.int64) for k in range(3)])


def _prints(keys: np.ndarray, seed: int) -> np.ndarray:
    return (mix(keys ^ np.uint64(seed * 2 + 1)) >> np.uint64(40)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """(seed, segment length, start segments, table) holding every distinct 64-bit key."""
    keys = np.unique(keys)
    n = max(2, len(keys))
    length = min(1 << 18, 1 << max(2, int(math.log(n) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    segments = max(1, math.ceil(n * factor / length) - 2)
    for seed in range(1, 10_000):
        if seed % 20 == 0:
            segments += 1 + segments // 16
        slots = _slots(keys, seed, length, segments)
        size = (segments + 2) * length
        count = np.bincount(slots.ravel(), minlength=size)
        total = np.zeros(size, np.int64)
        for k in range(3):
            np.add.at(total, slots[k], np.arange(len(keys)))
        peeled, left = [], len(keys)
        ready = np.flatnonzero(count == 1)
        while len(ready):
            own, first = np.unique(total[ready], return_index=True)
            peeled.append((own, ready[first]))
            left -= len(own)
            touched = slots[:, own].ravel()
            np.subtract.at(count, touched, 1)
            np.subtract.at(total, touched, np.tile(own, 3))
            touched = np.unique(touched)
            ready = touched[count[touched] == 1]
        if left:
            continue
        table = np.zeros(size, np.uint8)
        prints = _prints(keys, seed)
        for own, at in reversed(peeled):
            a, b, c = slots[:, own]
            table[at] = 0
            table[at] = prints[own] ^ table[a] ^ table[b] ^ table[c]
        return seed, length, segments, table
    raise RuntimeError("no seed peels this filter")


def may_hold(keys: np.ndarray, seed: int, length: int, segments: int, table: np.ndarray) -> np.ndarray:
    """False only for keys that the filter was not built from."""
    a, b, c = _slots(keys, seed, length, segments)
    return (table[a] ^ table[b] ^ table[c]) == _prints(keys, seed)


def _key64(digest: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digest.to_pylist()), ">u8").reshape(-1, 4)[:, 0].astype(np.uint64)


FILTER = "shard int, seed long, length long, segments long, slots binary"


def _build(table: pa.Table) -> pa.Table:
    seed, length, segments, slots = build_filter(_key64(table.column("digest")))
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "seed": [seed], "length": [length],
                     "segments": [segments], "slots": pa.array([slots.tobytes()], pa.binary())})


def freeze(snapshot: DataFrame, shards: int) -> DataFrame:
    """One filter for each shard of a snapshot's distinct digests."""
    return snapshot.select("digest", _shard(shards)).groupBy("shard").applyInArrow(_build, FILTER)


def _shard(shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


def _screen(filters: pa.Table, incoming: pa.Table) -> pa.Table:
    incoming = incoming.select(["digest"])
    if not filters.num_rows or not incoming.num_rows:
        return incoming.slice(0, 0)
    f = filters.to_pylist()[0]
    keep = may_hold(_key64(incoming.column("digest")), f["seed"], f["length"], f["segments"], np.frombuffer(f["slots"], np.uint8))
    return incoming.filter(pa.array(keep))


def screen(filters: DataFrame, incoming: DataFrame, shards: int) -> DataFrame:
    """The incoming digests that the snapshot may hold."""
    routed = incoming.select("digest", _shard(shards))
    return filters.groupBy("shard").cogroup(routed.groupBy("shard")).applyInArrow(_screen, "digest binary")


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = normal_text(b.column("text"))
        found = [hashlib.sha256(x.as_buffer()).digest() for x in texts.cast(pa.large_binary())]
        same = pc.equal(b.column("digest"), pa.array(found, pa.binary()))
        yield pa.RecordBatch.from_arrays([b.column("digest"), texts], ["digest", "text"]).filter(same)


def classes(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """Every row of (doc_id, text, incoming) with the class of its text.

    Returns doc_id, raw, digest, keep_id (the largest doc_id of the class) and group_size.
    """
    shards = shards or 2 * n_partitions(rows.sparkSession)
    marked = settle(digests(rows))
    grouped = marked.groupBy("digest", "incoming").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
    old, new = grouped.filter("not incoming"), grouped.filter("incoming")  # copies within the batch meet here
    maybe = screen(freeze(old, shards), new, shards)
    pairs = settle(maybe.join(old.select("digest", F.col("n").alias("n0"), F.col("last").alias("last0")), "digest")
                   .join(new.select("digest", F.col("n").alias("n1"), F.col("last").alias("last1")), "digest"))
    # byte check: one text of each side
    wanted = pairs.select("digest", F.explode(F.array("last0", "last1")).alias("_id")).distinct()
    texts = rows.select(F.col("doc_id").alias("_row"), "text").join(wanted, F.col("_row").eqNullSafe(F.col("_id")))
    alike = (texts.select("digest", "text").mapInArrow(_bytes_of, "digest binary, text string")
             .groupBy("digest").agg((F.min("text") == F.max("text")).alias("alike")))
    joined = pairs.join(alike.filter("alike"), "digest").select(
        "digest", (F.col("n0") + F.col("n1")).alias("n_all"), F.greatest("last0", "last1").alias("last_all"))
    decided = grouped.join(joined, "digest", "left").select(
        "digest", "incoming", F.when(F.col("n_all").isNull(), F.col("last")).otherwise(F.col("last_all")).alias("keep_id"),
        F.coalesce("n_all", "n").alias("group_size"))
    return marked.join(decided, ["digest", "incoming"]).select("doc_id", "raw", "digest", "keep_id", "group_size")


def _judged(docs: DataFrame, incoming) -> DataFrame:
    small_batches(docs.sparkSession)
    if incoming is None:
        incoming = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(2)) == 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", incoming.alias("incoming"))
    return classes(rows).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def exact_duplicates(docs: DataFrame, incoming=None) -> DataFrame:
    """The class of every document; ``incoming`` says which rows are the new batch (by default half of the ids, by crc32)."""
    return _judged(docs, incoming).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, incoming=None) -> DataFrame:
    """The documents without exact copies, columns as they came; of a document written twice, one row."""
    stay = (_judged(docs, incoming).filter("kept").groupBy(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"))
            .agg(F.count(F.lit(1)).alias("_n")))
    # a row travels as one struct: its own columns may have any name
    plain = docs.select(F.col("doc_id").cast("long").alias("_at"), _raw().alias("_of"), whole_row(docs).alias("row"))
    kept = plain.join(stay, F.col("_at").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_raw")))
    once = kept.filter("_n = 1").select("row.*")
    return once.unionByName(kept.filter("_n > 1").dropDuplicates(["_id", "_raw"]).select("row.*"))
