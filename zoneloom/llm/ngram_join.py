"""Near duplicates: the self-join of documents whose sets of word shingles are alike.

A document's set is its distinct 5-word shingles as 64-bit hashes. Equal sets are one class and meet
once. Two classes link when ``100 * intersection >= 80 * union``; the join finds every such link that
connects classes not yet connected, and returns components.

1. A set can link only if four fifths of its shingles occur in some other set; most have fewer and
   drop out. The rest are ordered, those of one set alone first, then by counters of a fixed number of
   slots. Sets that link share a shingle among the first fifth of either (prefix principle).
2. Classes that share one meet in a tile, without their sets. A 256-bit bitmap of each set, every
   shingle toggling one bit, bounds the overlap from above: differing bits are at most the differing
   shingles. Tiles report a spanning forest of the pairs that the bound lets through, never all pairs.
3. The groups so formed get their sorted arrays, made once more from the texts. A large group is dealt to tiles of size bands (a
   factor 1.25 each; only equal and adjacent bands can link) and blocks within bands. In a tile, size,
   then bitmap, then the exact sorted intersection decide; pairs already connected are skipped.

Defined cases: a null text, an empty one or one without words has the empty set, links with nothing
and is its own component; fewer than five words make one shingle of all; a null ``doc_id`` joins its
component and is smaller than none (null only where the component has null ids alone); repeated rows
are one class; an empty table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneloom.llm.common import components, mix, n_partitions, near_log, slices, small_batches, text_bytes, whole_row, word_shingles
from zoneloom.llm.screen import kept_bits, shared_grams
from zoneloom.session import settle

SIMILAR = 80
SIZE = 5
WORDS = 4  # 64-bit words of a bitmap in the token tiles
WIDE = 32  # and where the sets are at hand
BLOCK_SHINGLES = 2_000_000
TOKEN_BLOCK = 4_096


def distinct_by_row(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of each row sorted and without repeats."""
    cut = _edges(row, n)
    h = h.copy()
    for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False):
        h[a:b].sort()
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[fresh], h[fresh]


def sets_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle), distinct and sorted within rows."""
    return distinct_by_row(*word_shingles(data, at, SIZE), len(at) - 1)


def _edges(row: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(row, np.arange(n + 1))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, ids = [], []
        for lo, hi, data, at in slices(b.column("text")):
            row, h = sets_of(data, at)
            cut = _edges(row, hi - lo)
            sizes += np.diff(cut).tolist()
            ids += [hashlib.blake2b(h[x:y].tobytes(), digest_size=16).digest() for x, y in zip(cut, cut[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                                         ["doc_id", "key", "n", "set_id"])


CHUNK = 1 << 16
COUNTS = "chunk int, origin int, slots binary, counts binary"


def _packed(total: np.ndarray, origin: int) -> list[tuple]:
    """The counters above 0, by chunks of 65,536 slots."""
    out = []
    for chunk in range(-(-len(total) // CHUNK)):
        own = total[chunk * CHUNK : (chunk + 1) * CHUNK]
        at = np.flatnonzero(own)
        out.append((chunk, origin, at.astype(np.uint16).tobytes(), own[at].astype(np.int64).tobytes()))
    return out


def _rows_of(out: list[tuple]) -> pa.RecordBatch:
    a, b, c, d = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(c, pa.binary()), pa.array(d, pa.binary())],
                                      ["chunk", "origin", "slots", "counts"])


def _counter(slots: int) -> Callable:
    shift = np.uint64(64 - int(math.log2(slots)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for b in batches:
            for _, _, data, at in slices(b.column("text")):
                _, h = word_shingles(data, at, SIZE)
                total += np.bincount((h >> shift).astype(np.int64), minlength=slots)
        yield _rows_of(_packed(total, TaskContext.get().partitionId()))

    return count


def _added(table: pa.Table) -> np.ndarray:
    total = np.zeros(CHUNK, np.int64)
    for x, y in zip(table.column("slots").to_pylist(), table.column("counts").to_pylist(), strict=True):
        total[np.frombuffer(x, np.uint16)] += np.frombuffer(y, np.int64)
    return total


def _add(table: pa.Table) -> pa.Table:
    """One row for the rows of a chunk from 64 neighbouring origins."""
    (_, _, slots, counts), = _packed(_added(table), 0)
    chunk, origin = table.column("chunk")[0].as_py(), table.column("origin")[0].as_py() // 64
    return pa.Table.from_batches([_rows_of([(chunk, origin, slots, counts)])])


def _level(slots: int) -> Callable:
    def level(table: pa.Table) -> pa.Table:
        total = _added(table)[: min(CHUNK, slots)]
        mean = total.mean()
        high = np.flatnonzero(total > 1.25 * mean + 8)
        found = np.minimum(255, 8 * np.log2(total[high] / (mean + 1) + 1) + 1)
        return pa.table({"slot": pa.array(high + CHUNK * table.column("chunk")[0].as_py(), pa.int64()), "level": pa.array(found.astype(np.int32))})

    return level


def rarity(texts: DataFrame, slots: int) -> np.ndarray:
    """How common the shingles of each slot are, as a level from 0: a table of fixed size.

    Counters are added up in a tree: 64 tasks, 4,096 tasks, all.
    """
    counted = texts.select("text").mapInArrow(_counter(slots), COUNTS)
    for _ in range(2):
        counted = counted.groupBy("chunk", F.floor(F.col("origin") / 64).alias("near")).applyInArrow(_add, COUNTS)
    high = counted.groupBy("chunk").applyInArrow(_level(slots), "slot long, level int").toPandas()  # fewer than the slots
    levels = np.zeros(slots, np.uint8)
    levels[high["slot"].to_numpy(np.int64)] = high["level"].to_numpy(np.uint8)
    return levels


NOTE = [("n", np.int64), ("masked", np.int64), ("bitmap", np.uint64, WORDS)]


def _grams(part_bits: int) -> Callable:
    """All shingles of a row; its note has their number, the number after masking and the bitmap."""
    mask = kept_bits(part_bits)

    def grams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(at) - 1
        row, h = sets_of(data, at)
        notes = np.zeros(n, NOTE)
        notes["n"], notes["bitmap"] = np.bincount(row, minlength=n), bitmaps(row, h, n)
        h = h & mask
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        notes["masked"] = np.bincount(row[fresh], minlength=n)
        return row[fresh], h[fresh], notes.view(np.uint8).reshape(n, -1)

    return grams


def least_overlap(notes: np.ndarray) -> np.ndarray:
    """Masked shingles that a set has in common with any set it links with, at least."""
    return (SIMILAR * notes["n"] + 99) // 100 - (notes["n"] - notes["masked"])


def _enough(notes: np.ndarray, shared: np.ndarray) -> np.ndarray:
    known = np.ascontiguousarray(notes).view(NOTE).ravel()
    return (shared > 0) & (shared >= least_overlap(known))


def bitmaps(row: np.ndarray, h: np.ndarray, n: int, words: int = WORDS) -> np.ndarray:
    """(n, words) of 64 bits: every shingle toggles one bit of its row."""
    bits = words * 64
    bit = row * bits + (mix(h ^ np.uint64(0xA5A5A5A5)) >> np.uint64(40)).astype(np.int64) % bits
    odd = (np.bincount(bit, minlength=n * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, bits), axis=1).view(np.uint64)


class Forest:
    """Union-find over row numbers that reports the unions made."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.made: list[tuple[int, int]] = []

    def join(self, a: int, b: int) -> None:
        x, y = self.label[a], self.label[b]
        if x != y:
            self.label[self.label == y] = x
            self.made.append((a, b))


def may_link(n: np.ndarray, maps: np.ndarray, i: int, js: np.ndarray) -> np.ndarray:
    """Bits that differ from row i, where size and bitmap leave a link possible; else -1."""
    differ = np.bitwise_count(maps[js] ^ maps[i]).sum(axis=1).astype(np.int64)
    total = n[js] + n[i]
    most = (total - differ) // 2  # of the intersection
    able = (100 * most >= SIMILAR * (total - most)) & (100 * np.minimum(n[js], n[i]) >= SIMILAR * np.maximum(n[js], n[i]))
    return np.where(able, differ, -1)


def _maps(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, WORDS)


def _forest(table: pa.Table) -> pa.Table:
    """A spanning forest of the pairs that share a token and pass the bound."""
    keys, at = np.unique(table.column("key").to_numpy(), return_inverse=True)
    token = table.column("token").to_numpy()
    some = np.unique(at, return_index=True)[1]
    n, maps = table.column("n").to_numpy()[some], _maps(table.column("bitmap").take(pa.array(some)))
    order = np.lexsort((n[at], token))
    at, token = at[order], token[order]
    cut = np.append(np.flatnonzero(np.append(True, token[1:] != token[:-1])), len(token))
    parent = list(range(len(keys)))
    made = []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(a: int, b: int) -> None:
        x, y = find(a), find(b)
        if x != y:
            parent[y] = x
            made.append((a, b))

    length = np.diff(cut)
    two = cut[:-1][length == 2]
    if len(two):
        pairs = np.unique(np.sort(np.stack([at[two], at[two + 1]], axis=1), axis=1), axis=0)
        i, j = pairs[:, 0], pairs[:, 1]
        differ = np.bitwise_count(maps[i] ^ maps[j]).sum(axis=1).astype(np.int64)
        total = n[i] + n[j]
        most = (total - differ) // 2
        able = (100 * most >= SIMILAR * (total - most)) & (100 * np.minimum(n[i], n[j]) >= SIMILAR * np.maximum(n[i], n[j]))
        for a, b in pairs[able].tolist():
            join(a, b)
    seen = set()
    for lo, hi in zip(cut[:-1][length > 2].tolist(), cut[1:][length > 2].tolist(), strict=True):
        own = np.unique(at[lo:hi])
        name = own.tobytes()
        if name in seen:
            continue
        seen.add(name)
        own = own[np.argsort(n[own], kind="stable")]
        sizes = n[own]
        ends = np.searchsorted(100 * sizes, (100 * 100 * sizes) // SIMILAR, "right")
        root = np.array([find(x) for x in own.tolist()])
        for k in range(len(own) - 1):
            js = np.arange(k + 1, ends[k])
            js = js[root[js] != root[k]]
            if not len(js):
                continue
            hits = js[may_link(n, maps, int(own[k]), own[js]) >= 0]
            if len(hits):
                for j in own[hits].tolist():
                    join(int(own[k]), j)
                merged = np.isin(root, root[hits])
                root[merged] = root[k]
    a, b = (np.array([m[k] for m in made], np.int64) for k in (0, 1))
    return pa.table({"a": pa.array(keys[a], pa.int64()), "b": pa.array(keys[b], pa.int64())})


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """The exact test, on sorted distinct arrays."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum()) if len(y) else 0
    return 100 * both >= SIMILAR * (len(x) + len(y) - both)


def _verify(table: pa.Table) -> pa.Table:
    """A spanning forest of the links within one tile."""
    table = table.sort_by([("n", "ascending"), ("key", "ascending")])
    keys, n, side = table.column("key").to_numpy(), table.column("n").to_numpy(), table.column("side").to_numpy()
    data, at = text_bytes(table.column("shingles"))
    values, at = np.ascontiguousarray(data).view(np.uint64), at // 8
    maps = bitmaps(np.repeat(np.arange(len(keys)), n), values, len(keys), WIDE)
    ends = np.searchsorted(100 * n, (100 * 100 * n) // SIMILAR, "right")
    forest = Forest(len(keys))
    for i in range(len(keys) - 1):
        js = np.arange(i + 1, ends[i])
        # side 0: a tile of one block; sides 1 and 2: only pairs across
        js = js[(forest.label[js] != forest.label[i]) & ((side[js] == 0) | (side[js] != side[i]))]
        if not len(js):
            continue
        differ = may_link(n, maps, i, js)
        js, differ = js[differ >= 0], differ[differ >= 0]
        for j in js[np.argsort(differ, kind="stable")].tolist():
            if forest.label[i] != forest.label[j] and linked(values[at[i] : at[i + 1]], values[at[j] : at[j + 1]]):
                forest.join(i, j)
    a, b = (np.array([m[k] for m in forest.made], np.int64) for k in (0, 1))
    return pa.table({"a": pa.array(keys[a], pa.int64()), "b": pa.array(keys[b], pa.int64())})


def _few(df: DataFrame, most: int = 50_000) -> tuple[DataFrame, int]:
    """A written table, to be broadcast if it is counted to be small; and its count."""
    df = settle(df)
    n = df.count()
    return (F.broadcast(df) if n <= most else df), n


def _token_tiles(found: DataFrame, block: int) -> DataFrame:
    """(tile, token, key, n, bitmap): tokens by part; a token of more than ``block`` sets by pairs of blocks."""
    spark = found.sparkSession
    rows = found.select("key", "n", "bitmap", F.explode("tokens").alias("token"))
    part = F.pmod(F.xxhash64("token"), F.lit(4 * n_partitions(spark))).cast("string")
    many, n = _few(rows.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > block)
                   .select("token", F.ceil(F.col("m") / block).cast("int").alias("blocks")))
    if not n:
        return rows.select(part.alias("tile"), "token", "key", "n", "bitmap")
    looked = rows.join(many, "token", "left")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.concat_ws(
        "-", F.col("token").cast("string"), F.least(own, o).cast("string"), F.greatest(own, o).cast("string")))
    tiles = F.when(F.col("blocks").isNull(), F.array(part)).otherwise(pairs)
    return looked.select(F.explode(tiles).alias("tile"), "token", "key", "n", "bitmap")


TILES = "array<struct<tile: string, side: int>>"


def _group_tiles(members: DataFrame, most: int) -> DataFrame:
    """(key, tiles): one tile a group; a group of more than ``most`` shingles has pairs of size-banded blocks."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(1.25))).cast("int")
    rows = members.withColumn("band", band)
    sums = rows.groupBy("root", "band").agg(F.sum("n").alias("total"))
    large, n = _few(sums.groupBy("root").agg(F.sum("total").alias("all"), F.map_from_entries(F.collect_list(F.struct(
        "band", F.ceil(F.col("total") / (most // 2)).cast("int")))).alias("blocks")).filter(F.col("all") > most).select("root", "blocks"))
    root = F.col("root").cast("string")
    whole = F.array(F.struct(root.alias("tile"), F.lit(0).alias("side"))).cast(TILES)
    if not n:
        return rows.select("key", whole.alias("tiles"))
    own = F.struct(F.col("band").alias("band"), F.pmod(F.xxhash64("key"), F.element_at("blocks", F.col("band"))).cast("int").alias("block"))
    others = F.flatten(F.transform(
        F.filter(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1), lambda x: F.map_contains_key("blocks", x)),
        lambda x: F.transform(F.sequence(F.lit(0), F.element_at("blocks", x) - 1), lambda k: F.struct(x.alias("band"), k.alias("block")))))
    pairs = F.transform(F.col("others"), lambda o: F.struct(
        F.concat_ws("-", root, F.to_json(F.least(F.col("own"), o)), F.to_json(F.greatest(F.col("own"), o))).alias("tile"),
        F.when(F.col("own") == o, 0).when(F.col("own") < o, 1).otherwise(2).alias("side"))).cast(TILES)
    looked = rows.join(large, "root", "left")
    apart = looked.filter("blocks is not null").withColumn("own", own).withColumn("others", others).select("key", pairs.alias("tiles"))
    return looked.filter("blocks is null").select("key", whole.alias("tiles")).unionByName(apart)


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, at in slices(b.column("text")):
            row, h = sets_of(data, at)
            cut = _edges(row, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [b.column("key").slice(lo, hi - lo), pa.array(np.diff(cut)), b.column("tiles").slice(lo, hi - lo),
                 pa.array([h[x:y].tobytes() for x, y in zip(cut, cut[1:], strict=False)], pa.binary())],
                ["key", "n", "tiles", "shingles"])


def _prefixes(levels: np.ndarray) -> Callable:
    """(key, n, bitmap, tokens): of the shared shingles, rarest first, as many as a linking set must have one of.

    Shingles of one set alone come first of all, so they count towards the prefix but are no tokens.
    """
    shift = np.uint64(64 - int(math.log2(len(levels))))

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            notes = np.frombuffer(b"".join(b.column("note").to_pylist()), NOTE)
            least = least_overlap(notes)
            tokens = []
            for x, most in zip(b.column("grams").to_pylist(), least.tolist(), strict=True):
                h = np.frombuffer(x, np.uint64)
                h = h[np.lexsort((h, levels[h >> shift]))]
                tokens.append(h[: len(h) - most + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array(notes["n"]), pa.array([m.tobytes() for m in notes["bitmap"]], pa.binary()),
                 pa.array(tokens, pa.list_(pa.int64()))], ["key", "n", "bitmap", "tokens"])

    return prefix


def row_key():
    """A hash of the id and the text of a row: rows that agree in both share it."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))


def rooted_rows(docs: DataFrame, token_block: int = TOKEN_BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, key, n_shingles, root (null without shingles: alone) and component_id of every document."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    part_bits = int(math.log2(near_log(n_partitions(spark), 2, 1 << 20)))
    slots = near_log(4096 * n_partitions(spark), 1 << 14, 1 << 22)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("key", row_key())
    marked = settle(keyed.select("doc_id", "key", "text").mapInArrow(_summaries, "doc_id long, key long, n long, set_id binary"))
    classes = settle(marked.filter("n > 0").groupBy("set_id").agg(F.min("key").alias("key"), F.min("doc_id").alias("least")))
    shared = shared_grams(keyed, _grams(part_bits), part_bits, _enough)
    found = shared.dropDuplicates(["key"]).join(classes.select("key"), "key", "left_semi")  # one row a class
    found = settle(found.mapInArrow(_prefixes(rarity(keyed, slots)), "key long, n long, bitmap binary, tokens array<long>"))
    edges = _token_tiles(found, token_block).groupBy("tile").applyInArrow(_forest, "a long, b long")
    members = found.select("key", "n").join(components(edges).withColumnRenamed("node", "key"), "key")
    dealt = keyed.select("key", "text").join(_group_tiles(members, block_shingles), "key")
    dealt = dealt.mapInArrow(_arrays, f"key long, n long, tiles {TILES}, shingles binary")
    # a document written twice brings its set twice: harmless, as equal sets link
    links = (dealt.select(F.inline("tiles"), "key", "n", "shingles").groupBy("tile").applyInArrow(_verify, "a long, b long"))
    roots = components(links).withColumnRenamed("node", "key")
    rooted = classes.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_set = rooted.join(least, "root").select("set_id", "root", "component_id")
    return marked.join(by_set, "set_id", "left").select(
        "doc_id", "key", F.col("n").alias("n_shingles"), "root",
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_groups(docs: DataFrame, token_block: int = TOKEN_BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return rooted_rows(docs, token_block, block_shingles).select("doc_id", "n_shingles", "component_id")


def keep_nearest(docs: DataFrame) -> DataFrame:
    """Of each component the row with the smallest id that is not null, as it came; rows without shingles all stay.

    Rows are told apart by ``row_key``, not by id: ids may be null or occur twice.
    """
    rows = settle(rooted_rows(docs).filter("root is not null").groupBy("root", "key")
                  .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    first = first.select("root", F.col("first.key").alias("kept"))
    judged = rows.join(first, "root").select(F.col("key").alias("_key"), (F.col("key") == F.col("kept")).alias("_first"), "n")
    judged = settle(judged.filter("not _first or n > 1"))
    plain = docs.select(row_key().alias("_key"), whole_row(docs).alias("row"))  # own columns may have any name
    stay = plain.join(judged.select("_key"), "_key", "left_anti").select("row.*")
    again = plain.join(judged.filter("_first").select("_key"), "_key", "left_semi")  # the kept row, written several times
    return stay.unionByName(again.dropDuplicates(["_key"]).select("row.*"))
