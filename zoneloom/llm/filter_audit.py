"""How quality filters act on one another, over every order of applying them.

Each document becomes a mask of the filters that it fails; masks are counted by part, so that at most 32 cells
a part are left. A Gray code then walks the 32 subsets of filters: each step toggles one filter, which moves the
active-failure counter of the cells that fail it by one, and cells whose counter leaves or reaches zero leave
or join the running survivors. The 32 states are stored; every step of every order is a difference of two.

A document fails E when a smaller doc_id has the identical text anywhere in the table. Texts are told apart by
SHA-256. Rows are added up by text, part and labels before any of them meet, so a text that a third of all rows
hold is a handful of rows.

Defined cases: a null text counts as empty, a null ``lang`` is the part ''; rows without doc_id neither fail E nor
make others fail it; rows of one doc_id and text do not fail E by each other; a doc_id with several labels is good
if one of them says so, and toxic likewise; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
WHITE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SALTS = 64
RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_mask(text: Column) -> Column:
    """Bit i is set when the text alone fails filter i; E needs the table."""
    words = F.array_remove(F.split(text, WHITE), "")
    n = F.size(words)
    chars = F.length(text)
    capitals = chars - F.length(F.translate(text, CAPITALS, ""))
    fails = [n < 100, 100 * F.size(F.array_distinct(words)) < 80 * n, 100 * capitals > 10 * chars, text.rlike("[#$%&*|]")]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters that they fail."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                       F.sha2(text, 256).alias("same"), text_mask(text).alias("mask"))
    told = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"), F.lit(0).alias("salt")))
    # rows without an id have no label; the salt keeps them from meeting
    salted = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.pmod(F.hash("same", "part"), F.lit(SALTS))).otherwise(0))
    marked = salted.join(told, ["doc_id", "salt"], "left").select(
        "doc_id", "part", "same", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    kind = ["same", "part", "mask", "good", "toxic"]
    by_id = marked.groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    by_text = by_id.groupBy(*kind).agg(F.sum("n").alias("n"), F.min("doc_id").alias("least"),
                                       F.min_by("n", "doc_id").alias("at_least"),
                                       F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without"))
    least = F.min("least").over(Window.partitionBy("same"))  # a text has few parts and labels
    passes = F.col("without") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    e = 1 << FILTERS.index("E")
    split = by_text.withColumn("first", least).withColumn("passes", passes).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask"), F.col("passes").alias("n")),
            F.struct((F.col("mask") + e).alias("mask"), (F.col("n") - F.col("passes")).alias("n")))).alias("cell"))
    n = F.col("cell.n")
    return split.filter(n > 0).groupBy("part", F.col("cell.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"))


def gray_walk(masks: np.ndarray, weights: np.ndarray, filters: int = len(FILTERS)) -> np.ndarray:
    """Survivors of every subset of filters: a row for each subset, a column for each kind of weight."""
    fails = [(masks >> f) & 1 == 1 for f in range(filters)]
    active = np.zeros(len(masks), np.int64)
    running = weights.sum(axis=0)
    states = np.zeros((1 << filters, weights.shape[1]), np.int64)
    states[0] = running
    subset = 0
    for step in range(1, 1 << filters):
        f = (step & -step).bit_length() - 1  # the bit in which two neighbours of the code differ
        subset ^= 1 << f
        on = subset >> f & 1
        hit = fails[f]
        if on:
            running = running - weights[hit & (active == 0)].sum(axis=0)
        active[hit] += 1 if on else -1
        if not on:
            running = running + weights[hit & (active == 0)].sum(axis=0)
        states[subset] = running
    return states


def steps_of(states: np.ndarray) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) from the stored states."""
    whole, size = len(states) - 1, len(FILTERS)
    alone = [int(states[0, 0] - states[1 << f, 0]) for f in range(size)]  # documents that fail f
    unique = [int(states[whole ^ (1 << f), 0] - states[whole, 0]) for f in range(size)]
    share = [0] * size
    for f in range(size):
        for before in range(whole + 1):
            if not before >> f & 1:
                k = before.bit_count()
                share[f] += math.factorial(k) * math.factorial(size - 1 - k) * int(states[before, 0] - states[before | 1 << f, 0])
    out = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            f = FILTERS.index(letter)
            after = before | 1 << f
            lost = states[before] - states[after]
            out.append((order, step, int(states[after, 0]), int(lost[0]), alone[f] - int(lost[0]), unique[f], int(lost[1]), int(lost[2]), share[f]))
            before = after
    return out


def _audit(cells: pa.Table) -> pa.Table:
    """At most 32 cells of one part."""
    weights = np.stack([cells.column(c).to_numpy() for c in ("n", "good", "toxic")], axis=1).astype(np.int64)
    rows = steps_of(gray_walk(cells.column("mask").to_numpy().astype(np.int64), weights))
    columns = [pa.array(list(c)) for c in zip(*rows, strict=True)]
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    part = pa.array([cells.column("part")[0].as_py()] * len(rows))
    columns[1] = columns[1].cast(pa.int32())
    return pa.table([part, *columns], ["part", *names])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    return failure_cells(docs, labels).groupBy("part").applyInArrow(_audit, RESULT)
