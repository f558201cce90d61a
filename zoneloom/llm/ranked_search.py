"""Ranked lexical search with a document FP-tree.

Documents are restricted to the terms that the items hold; every shard of documents becomes a tree of their
vectors, whose terms stand in the order of their document frequency, most frequent first, so that documents
share the paths of their frequent terms. A node of the tree is a run of documents that begin with the same path;
it keeps, for its subtree, the largest tf of every term and the smallest length weight m. Both bound every score
below the node from above. Each item walks the tree depth first, better bounds first, and leaves out a subtree
that cannot reach the ten best found so far. Shards return ten documents an item, ranked together afterwards.

Paths are sorted, so a node is a range of rows and its maxima are one reduction; a run of at most ``LEAF``
documents is scored at once. The items, their terms and frequencies travel to the tasks: ``ITEMS`` of them with
``ITEM_BYTES`` of text at most; more are searched in several such blocks, each over the stored vectors of its terms.

Defined cases: a null or empty text has no term; an item without terms, or whose terms no document holds, has no
rows; rows of one item_id are one item with the terms of all, a null item_id is an item too; equal scores stand by
ascending doc_id, null last; repeated ids and repeated rows are documents of their own; an empty table of either
kind gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneloom.llm.common import LOWER, row_of, slices, small_batches, text_bytes, word_hashes
from zoneloom.session import settle

BEST = 10
LEAF = 32
CELLS = 8 << 20  # documents of a tree times terms
ITEMS, ITEM_BYTES = 4_096, 8 << 20
B_NUMERATOR, B_DENOMINATOR = 90, 100  # the contract's length constants
INNER = np.zeros(256, bool)
INNER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
VECTOR = "doc_id long, n long, terms binary, tfs binary"
RANKED = "item_id long, rank int, doc_id long, score long"


# ---- terms


def term_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of digits, letters and non-ASCII bytes, within rows."""
    inside = INNER[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    n = len(data)
    first, last = at[:-1][at[:-1] < n], at[1:][at[1:] > 0] - 1
    begins[first], ends[last] = inside[first], inside[last]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(at, s, "right") - 1


class Vocabulary:
    """Distinct terms by hash, with their bytes for the exact comparison."""

    def __init__(self, terms: list[bytes]):
        data, at = text_bytes(pa.array(terms, pa.binary()))
        s = at[:-1]
        h = word_hashes(data, s, at[1:]) if len(terms) else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        if len(np.unique(h)) < len(h):
            raise ValueError("two terms of the items have the same 64-bit hash")
        self.terms = [terms[i] for i in order]
        self.hashes = h[order]
        self.data, self.at = text_bytes(pa.array(self.terms, pa.binary()))

    def find(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """The number of every term, or -1."""
        out = np.full(len(s), -1, np.int64)
        if not len(self.hashes) or not len(s):
            return out
        h = word_hashes(data, s, e)
        k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        size = np.diff(self.at)
        hit = np.flatnonzero((self.hashes[k] == h) & (size[k] == e - s))
        if len(hit):  # compare the bytes
            length = (e - s)[hit]
            starts = np.cumsum(length) - length
            step = np.arange(int(length.sum())) - np.repeat(starts, length)
            same = LOWER[data[np.repeat(s[hit], length) + step]] == self.data[np.repeat(self.at[:-1][k[hit]], length) + step]
            hit = hit[np.logical_and.reduceat(same, starts)]
        out[hit] = k[hit]
        return out


def _lower_terms(text: str | None) -> set[bytes]:
    data, at = text_bytes(pa.array([text or ""]))
    data = LOWER[data]
    s, e, _ = term_spans(data, at)
    return {data[a:b].tobytes() for a, b in zip(s, e, strict=True)}


def _restricter(vocabulary: Vocabulary):
    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, len(vocabulary.terms))
        for b in batches:
            for lo, hi, data, at in slices(b.column("text"), 1 << 20):
                s, e, row = term_spans(data, at)
                n = np.bincount(row, minlength=hi - lo)
                found = vocabulary.find(data, s, e)
                known = found >= 0
                pair, tf = np.unique(row[known] * size + found[known], return_counts=True)
                cuts = np.searchsorted(pair // size, np.arange(hi - lo + 1))
                terms, tf = (pair % size).astype(np.int32), tf.astype(np.int32)
                out = [[x[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)] for x in (terms, tf)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())],
                    ["doc_id", "n", "terms", "tfs"])

    return restrict


def restricted_vectors(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document: all its terms counted, those of the vocabulary with their tf."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_restricter(vocabulary), VECTOR)


def _holder(size: int):
    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            data, _ = text_bytes(b.column("terms"))
            df += np.bincount(np.ascontiguousarray(data).view(np.int32), minlength=size)
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(df[used])], ["term", "df"])

    return held


# ---- the tree


class Tree:
    """The FP-tree of a shard: rows sorted by path, nodes as ranges of rows with their maxima."""

    def __init__(self, ids: pa.Array, m: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray, rank: np.ndarray):
        """``row``, ``term``, ``tf`` by rows; ``rank`` orders the terms, the most frequent first."""
        n, size = len(m), len(rank)
        order = np.lexsort((rank[term], row))
        row, term, tf = row[order], term[order], tf[order]
        cuts = np.searchsorted(row, np.arange(n + 1))
        path = [rank[term[a:b]].astype(">u4").tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        place = np.array(sorted(range(n), key=path.__getitem__), np.int64)
        self.ids, self.m = ids.take(pa.array(place)), m[place]
        self.tf = np.zeros((n, size), np.int32)
        where = np.empty(n, np.int64)
        where[place] = np.arange(n)
        self.tf[where[row], term] = tf
        path = [path[i] for i in place]
        # terms that each path shares with the one before it
        self.shared = np.array([0, *(_common(a, b) for a, b in zip(path, path[1:], strict=False))], np.int64)
        self.lo, self.hi, self.children = [], [], []
        self.low_id = pa.array(self.ids).to_numpy(zero_copy_only=False)
        if n:
            self._grow(0, n)
        self.tops = np.stack([self.tf[a:b].max(axis=0) for a, b in zip(self.lo, self.hi, strict=True)]) if n else self.tf
        self.least = np.array([self.m[a:b].min() for a, b in zip(self.lo, self.hi, strict=True)], np.int64)

    def _grow(self, lo: int, hi: int) -> None:
        """Nodes of the rows from the root down: a node's children begin where its rows share least."""
        self.lo.append(lo)
        self.hi.append(hi)
        self.children.append([])
        todo = [0]
        while todo:
            k = todo.pop()
            a, b = self.lo[k], self.hi[k]
            if b - a <= LEAF:
                continue
            inner = self.shared[a + 1 : b]
            cut = a + 1 + np.flatnonzero(inner == inner.min())
            if len(cut) > LEAF:  # a wide node, as under the root or of equal paths: runs of its children
                cut = cut[:: len(cut) // LEAF + 1]
            for x, y in zip([a, *cut], [*cut, b], strict=True):
                self.children[k].append(len(self.lo))
                todo.append(len(self.lo))
                self.lo.append(int(x))
                self.hi.append(int(y))
                self.children.append([])

    def best(self, terms: np.ndarray, weight: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``most`` best documents with a score above 0."""
        ceiling = score(self.tops[:, terms], self.least, weight)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        floor = 0
        todo = [0] if len(self.m) else []
        while todo:
            k = todo.pop()
            if ceiling[k] < max(1, floor):  # an equal bound may hide a smaller id
                continue
            if self.children[k]:
                todo += sorted(self.children[k], key=ceiling.__getitem__)  # the best is taken next
                continue
            a, b = self.lo[k], self.hi[k]
            own = score(self.tf[a:b, terms], self.m[a:b], weight)
            good = np.flatnonzero(own >= max(1, floor))
            rows, scores = np.concatenate([rows, good + a]), np.concatenate([scores, own[good]])
            if len(rows) > most:
                keep = np.lexsort((self.low_id[rows], -scores))[:most]
                rows, scores = rows[keep], scores[keep]
            floor = int(scores.min()) if len(rows) == most else 0
        return rows, scores


def _common(a: bytes, b: bytes) -> int:
    """Terms at the start that two paths share."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a[:n], np.uint32), np.frombuffer(b[:n], np.uint32)
    unlike = x != y
    return int(unlike.argmax()) if unlike.any() else n // 4


def score(tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Scores of rows of tf, in 64-bit integers."""
    tf = tf.astype(np.int64)
    return (weight * (1_000_000_000 * tf // (1_000 * tf + 8 * m[:, None]))).sum(axis=1)


def _searcher(items: list[tuple[int | None, np.ndarray]], weight: np.ndarray, rank: np.ndarray, documents: int, length: int, most: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = max(256, CELLS // max(1, len(rank)))
        waiting, n = [], 0
        for b in batches:
            for lo in range(0, b.num_rows, limit):
                part = b.slice(lo, limit)
                if n + part.num_rows > limit:
                    yield answer(pa.Table.from_batches(waiting))
                    waiting, n = [], 0
                waiting.append(part)
                n += part.num_rows
        if n:
            yield answer(pa.Table.from_batches(waiting))

    def answer(table: pa.Table) -> pa.RecordBatch:
        data, at = text_bytes(table.column("terms"))
        tf, _ = text_bytes(table.column("tfs"))
        own = table.column("n").to_numpy()
        m = B_DENOMINATOR - B_NUMERATOR + B_NUMERATOR * own * documents // max(1, length)
        # a document without any of the terms scores 0 with each item
        tree = Tree(table.column("doc_id").combine_chunks(), m, row_of(at // 4), np.ascontiguousarray(data).view(np.int32),
                    np.ascontiguousarray(tf).view(np.int32), rank)
        who, rows, scores = [], [], []
        for k, (_, terms) in enumerate(items):
            r, s = tree.best(terms, weight[terms], most)
            who.append(np.full(len(r), k))
            rows.append(r)
            scores.append(s)
        ids = pa.array([item for item, _ in items], pa.int64())
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(np.concatenate(who).astype(np.int64))), tree.ids.take(pa.array(np.concatenate(rows).astype(np.int64))),
             pa.array(np.concatenate(scores).astype(np.int64))], ["item_id", "doc_id", "score"])

    return search


def _blocks(items: DataFrame) -> Iterator[list]:
    """The items in blocks that fit a task: all of them if they do, else dealt by a hash of their id."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    parts = math.ceil(max(size["n"] / ITEMS, size["bytes"] / ITEM_BYTES, 1))
    if parts == 1:
        yield rows.collect()
        return
    parts *= 2  # dealt by hash they are not of one size
    dealt = settle(rows.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts))))
    for k in range(parts):
        yield dealt.filter(F.col("part") == k).select("item_id", "text").collect()


def _ranked(docs: DataFrame, rows: list, most: int) -> DataFrame:
    terms_of: dict = {}
    for r in rows:
        terms_of.setdefault(r["item_id"], set()).update(_lower_terms(r["text"]))
    vocabulary = Vocabulary(sorted(set().union(*terms_of.values())))
    if not vocabulary.terms:
        return docs.sparkSession.createDataFrame([], RANKED)
    number = {t: i for i, t in enumerate(vocabulary.terms)}
    size = len(number)
    vectors = settle(restricted_vectors(docs, vocabulary))
    total = vectors.agg(F.count_if(F.col("n") > 0).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    df = np.zeros(size, np.int64)
    held = vectors.select("terms").mapInArrow(_holder(size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in held.collect():  # one row for each term of the items
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * total["N"] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    rank = np.empty(size, np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(size)
    items = [(i, np.array(sorted(number[t] for t in terms), np.int64)) for i, terms in terms_of.items() if terms]
    found = vectors.mapInArrow(_searcher(items, weight, rank, total["N"], total["L"], most), "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, most: int = BEST) -> DataFrame:
    """The ``most`` best documents of every item: item_id, rank, doc_id, score."""
    out = None
    for rows in _blocks(items):
        part = _ranked(docs, rows, most)
        out = part if out is None else out.unionByName(part)
    return out
