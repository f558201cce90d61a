"""Near duplicates among embeddings: collision counting on sorted random projections.

Equal vectors become one class with a weight. Unit vectors are projected on random Gaussian directions.
A pair at the wanted cosine lies at a known distance, so how often its projections fall together is known:

* tables of ``k`` projections each cut space into cells; vectors of one cell form a block. ``k`` grows with
  the logarithm of the number of vectors, the number of tables is what the recall asks for;
* within a block, each of ``COUNTED`` projections is sorted, every vector opens a window centred on itself,
  and the windows that a pair falls into are counted. Pairs with a count that all but ``MISS`` of the pairs
  at the wanted cosine reach are verified by the cosine in double precision;
* a pair counts in the first table whose block it shares, so no link is counted twice.

A block beyond ``block_rows`` vectors is dealt to pairs of its parts. Blocks return a number of links and one
local root for each vector, never pairs; the roots are joined to components.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing and
are kept; vectors of different lengths link with nothing; equal vectors are linked; repeated ids are rows of
their own; a component's id is its smallest ``vec_id`` that is not null, and rows without an id are kept only
where no row of the component has one; an empty table gives no rows; other columns are neither read nor returned.
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
from pyspark.sql import types as T

from zoneloom.llm.common import Cache, components, mix
from zoneloom.session import settle

SIMILARITY = 0.95
RECALL = 0.995  # share of the pairs just at the similarity that share a block in some table
CELL = 6.0  # width of a cell, in distances of a pair just at the similarity
COUNTED, WINDOW, MISS = 32, 1.5, 0.001  # projections counted in a block, half a window's width in such distances
BLOCK_ROWS, BLOCK_BYTES = 4_096, 16 << 20
LISTED_BLOCKS = 100_000
QUERIES, PAIRS = 256, 1 << 16
SEED = 1213
LOWEST = -(1 << 63)
DIRECTIONS = Cache()


# ---- how often projections of a pair fall together


def in_cell(width: float) -> float:
    """Chance that two points share a cell of ``width`` standard deviations of their difference, placed at random."""
    tail = 0.5 * math.erfc(width / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * width) * (1 - math.exp(-width * width / 2))


def least_count(n: int, p: float, miss: float) -> int:
    """The largest count that at most ``miss`` of the draws from a binomial (n, p) stay below."""
    below, count = 0.0, 0
    while below + math.comb(n, count) * p**count * (1 - p) ** (n - count) <= miss:
        below += math.comb(n, count) * p**count * (1 - p) ** (n - count)
        count += 1
    return count


class Plan:
    """Cells and tables for ``n`` vectors: blocks of about ``block`` vectors, found with the wanted recall."""

    def __init__(self, n: int, block: int, similarity: float, recall: float = RECALL):
        self.distance = math.sqrt(2 - 2 * similarity)
        other = in_cell(CELL * self.distance / math.sqrt(2))  # of unrelated unit vectors
        self.cells = max(0, math.ceil(math.log(max(1.0, n / block)) / -math.log(other)))
        shared = in_cell(CELL) ** self.cells
        self.tables = 1 if self.cells == 0 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - shared)))
        self.count = least_count(COUNTED, math.erf(WINDOW / math.sqrt(2)), MISS)
        self.similarity, self.block = similarity, block

    def codes(self, units: np.ndarray) -> np.ndarray:
        """The block of every vector in every table, as 64-bit hashes."""
        size = units.shape[1]
        key = size, self.cells, self.tables
        if key not in DIRECTIONS:
            rng = np.random.default_rng([SEED, size])
            DIRECTIONS[key] = rng.standard_normal((size, self.cells * self.tables)), rng.random(self.cells * self.tables)
        directions, shift = DIRECTIONS[key]
        cells = np.floor(units @ directions / (CELL * self.distance) + shift).astype(np.int64).astype(np.uint64)
        out = np.empty((len(units), self.tables), np.uint64)
        for t in range(self.tables):
            h = np.full(len(units), mix(np.array([size * 1_000_003 + t], np.uint64))[0])
            for k in range(t * self.cells, (t + 1) * self.cells):
                h = mix(h ^ (cells[:, k] + np.uint64(k + 1)))
            out[:, t] = h
        return out.view(np.int64)


# ---- vectors and their classes


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components, offsets of the n + 1 rows, and which rows are null or hold null or non-finite components."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten()
    values = np.asarray(flat.to_numpy(zero_copy_only=False), np.float64 if pa.types.is_float64(flat.type) else np.float32)
    at = np.concatenate([[0], np.cumsum(lengths)])
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    return values, at, (lengths == 0) | (odd[at[1:]] > odd[at[:-1]])


def _reader(dtype: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, at, odd = _flat(b.column("embedding"))
            values = values.astype(dtype)
            ids = b.column("vec_id").to_pylist()
            keys, raw, good = [], [], []
            for i, (lo, hi) in enumerate(zip(at, at[1:], strict=False)):
                own = values[lo:hi] + 0.0  # -0.0 and 0.0 are one value
                fine = not odd[i] and own.any()
                good.append(bool(fine))
                raw.append(own.tobytes() if fine else None)
                # 8 bytes for a row of its own: it spreads and meets no class
                keys.append(hashlib.blake2b(raw[-1], digest_size=16).digest() if fine
                            else hashlib.blake2b(f"{ids[i]} {i}".encode(), digest_size=8).digest())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())],
                                             ["vec_id", "same", "vector"])

    return read


def read_vectors(rows: DataFrame) -> tuple[DataFrame, str]:
    """(vec_id, same, vector) and the type of the components; equal vectors have the same ``same``, ``vector`` is null where unusable."""
    single = isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType)
    kind, dtype = ("float", "<f4") if single else ("double", "<f8")
    plain = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    return plain.mapInArrow(_reader(dtype), "vec_id long, same binary, vector binary"), dtype


def unit_rows(column: pa.ChunkedArray | pa.Array, dtype: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors in double precision, by length of the vectors."""
    sizes = np.asarray(pc.binary_length(column).to_numpy(zero_copy_only=False) if isinstance(column, pa.Array)
                       else pc.binary_length(column).to_numpy())
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = np.frombuffer(b"".join(column.take(pa.array(rows)).to_pylist()), dtype).reshape(len(rows), -1).astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
        yield rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _sender(plan: Plan, dtype: str, whole: bool):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for lo in range(0, big.num_rows, 1_000):
                b = big.slice(lo, 1_000)
                for rows, units in unit_rows(b.column("vector"), dtype):
                    codes = plan.codes(units)
                    block = pa.array(codes.T.ravel())
                    if not whole:
                        yield pa.RecordBatch.from_arrays([block], ["block"])
                        continue
                    again = pa.array(np.tile(rows, plan.tables))
                    own = pa.array([c.tobytes() for c in codes], pa.binary()).take(pa.array(np.tile(np.arange(len(rows)), plan.tables)))
                    table = pa.array(np.repeat(np.arange(plan.tables, dtype=np.int32), len(rows)))
                    yield pa.RecordBatch.from_arrays(
                        [block, table, b.column("node").take(again), b.column("n").take(again), b.column("vector").take(again), own],
                        ["block", "in_table", "node", "n", "vector", "codes"])

    return send


# ---- counting within a block


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Let ``label`` (each entry its root) join a[i] with b[i]; the smaller root stays."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label[:] = label[label]


def candidates(p: np.ndarray, q: np.ndarray, half: float, least: int, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows of ``p`` and ``q`` with ``least`` projections in a window; ``within`` one set, i < j."""
    order = np.argsort(q, axis=0, kind="stable")
    rank = np.empty(q.shape, np.uint16)
    np.put_along_axis(rank, order, np.arange(len(q), dtype=np.uint16)[:, None], axis=0)
    ranks = np.ascontiguousarray(rank.T)
    values = np.take_along_axis(q, order, axis=0)
    first = np.stack([np.searchsorted(values[:, k], p[:, k] - half, "left") for k in range(p.shape[1])])
    wide = np.stack([np.searchsorted(values[:, k], p[:, k] + half, "right") for k in range(p.shape[1])]) - first
    first, wide = first.astype(np.uint16), wide.astype(np.uint16)
    for lo in range(0, len(p), QUERIES):
        hi, skip = min(len(p), lo + QUERIES), lo if within else 0
        counts = np.zeros((hi - lo, len(q) - skip), np.uint8)
        for k in range(p.shape[1]):  # a rank before the window wraps to a large one
            counts += (ranks[k, None, skip:] - first[k, lo:hi, None]) < wide[k, lo:hi, None]
        i, j = np.nonzero(counts >= least)
        i, j = i + lo, j + skip
        if within:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), PAIRS):
            yield i[at : at + PAIRS], j[at : at + PAIRS]


def _counter(plan: Plan, dtype: str):
    def count(table: pa.Table) -> pa.Table:
        nodes = table.column("node").combine_chunks()
        n = table.column("n").to_numpy()
        part = table.column("part").to_numpy()
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.int64).reshape(len(n), -1)
        tile = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        own = table.column("in_table")[0].as_py()
        links, label = np.zeros(len(n), np.int64), np.arange(len(n))
        for rows, units in unit_rows(table.column("vector"), dtype):
            directions = np.random.default_rng([SEED + 1, units.shape[1]]).standard_normal((units.shape[1], COUNTED))
            p = units @ directions
            left, right = np.flatnonzero(part[rows] == tile[0]), np.flatnonzero(part[rows] == tile[1])
            for i, j in candidates(p[left], p[right], WINDOW * plan.distance, plan.count, tile[0] == tile[1]):
                i, j = left[i], right[j]
                close = np.einsum("ij,ij->i", units[i], units[j]) >= plan.similarity
                i, j = rows[i[close]], rows[j[close]]
                first = ~(codes[i, :own] == codes[j, :own]).any(axis=1)  # not met in an earlier table
                i, j = i[first], j[first]
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                joined(label, i, j)
        linked = np.flatnonzero(links)
        return pa.table({"node": nodes.take(pa.array(linked)), "links": pa.array(links[linked]), "root": nodes.take(pa.array(label[linked]))})

    return count


def _parts(heavy: DataFrame, sent: DataFrame) -> DataFrame:
    """Every sent row with its part of the block and the pairs of parts that it is compared in."""
    if heavy.count() <= LISTED_BLOCKS:
        heavy = F.broadcast(heavy)
    dealt = sent.join(heavy, "block", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    return (dealt.select("*", other).withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other"))
            .drop("other", "parts"))


def link_vectors(rows: DataFrame, similarity: float = SIMILARITY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    vectors, dtype = read_vectors(rows)
    usable = vectors.filter("vector is not null")
    classes = usable.groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.min("vector").alias("vector"))
    # nodes in the order of their smallest ids, those without one last
    first = F.coalesce(F.lpad(F.hex(F.col("least").bitwiseXOR(F.lit(LOWEST))), 16, "0"), F.lit("z"))
    classes = settle(classes.withColumn("node", F.concat(first, F.hex("same"))))
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("vector")).alias("bytes")).first()
    block_rows = max(2, min(block_rows, BLOCK_BYTES // max(1, size["bytes"] or 1), 1 << 15))
    plan = Plan(size["n"], block_rows, similarity)
    at = classes.select("node", "n", "vector")
    blocks = at.mapInArrow(_sender(plan, dtype, False), "block long").groupBy("block").count()
    heavy = settle(blocks.filter(F.col("count") > block_rows).select("block", F.ceil(F.col("count") / block_rows).cast("int").alias("parts")))
    sent = at.mapInArrow(_sender(plan, dtype, True), "block long, in_table int, node string, n long, vector binary, codes binary")
    found = settle(_parts(heavy, sent).groupBy("block", "lo", "hi")
                   .applyInArrow(_counter(plan, dtype), "node string, links long, root string"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (classes.select("same", "node", "n", "least").join(links, "node", "left").join(roots, "node", "left")
             .select("same", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("root", "node").alias("root")))
    id_of = F.when(~F.col("root").startswith("z"), F.conv(F.substring("root", 1, 16), 16, -10).cast("long").bitwiseXOR(F.lit(LOWEST)))
    told = vectors.select("vec_id", "same").join(known, "same", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(id_of).alias("component_id"))
    return told.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
