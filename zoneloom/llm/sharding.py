"""Sharding by balanced label propagation, in DataFrame operations only.

Documents of equal text are linked. Linked documents start spread evenly, groups laid end to end by
a prefix sum over their sizes, so that only those on a border start in two shards or more. Then, round
by round, the members of a group that lie apart ask for the shard that holds most of it. All that ask
move at once as far as the places that are free or are left in the same round reach; a round that
gains nothing that way is tried with the fullest shard that has room. It ends when neither lowers the
number of cut links. Unlinked documents fill what is left of the quotas, so that the counts of any two
shards differ by at most one.

Defined cases: a null text has no bytes and links with other null texts only; null or repeated ids
are ordinary rows; an empty table gives no rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneloom.llm.common import n_partitions, numbered
from zoneloom.session import settle


def _quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def _loads(state: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _listed(values: list[int], at):
    """The value at a place counted from 0."""
    return F.element_at(F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>"), (at + 1).cast("int"))


def _rank(n: str, shard: str):
    """What a shard is worth to a group: the members it holds, then a hash that breaks ties."""
    return F.struct(F.col(n).alias("n"), F.xxhash64("group", shard).alias("tie"))


def laid(sized: DataFrame, within: list[str], pieces: int) -> DataFrame:
    """Where each group of ``n`` begins when the groups of each ``within`` are laid end to end: column ``start``."""
    piece = sized.withColumn("_piece", F.pmod(F.xxhash64("group"), F.lit(pieces)).cast("int"))
    sums = piece.groupBy(*within, "_piece").agg(F.sum("n").alias("_n"))
    before = Window.partitionBy(*within).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*within, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = Window.partitionBy(*within, "_piece").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    return (piece.join(starts, [*within, "_piece"])
            .withColumn("start", (F.coalesce(F.sum("n").over(own), F.lit(0)) + F.col("_start")).cast("long"))
            .drop("_piece", "_start"))


def deal(groups: DataFrame, linked: DataFrame, total: int, shards: int, pieces: int) -> DataFrame:
    """(row, group, shard) of the ``total`` linked rows: groups end to end over shards of even size."""
    members = numbered(linked, ["group"], ["row"], "spread", pieces, "member")
    at = F.col("start") + F.col("member")
    least, more = divmod(total, shards)
    edge = more * (least + 1)
    shard = F.when(at < edge, F.floor(at / (least + 1))).otherwise(more + F.floor((at - edge) / max(1, least)))
    return members.join(laid(groups, [], pieces), "group").select("row", "group", shard.cast("int").alias("shard"))


def flows(wishes: np.ndarray, free: np.ndarray) -> np.ndarray:
    """How many of ``wishes[from, to]`` move at once: no shard gains more than it loses and has free."""
    out = wishes.astype(np.int64)
    while True:
        over = out.sum(axis=0) - out.sum(axis=1) - free
        to = int(over.argmax())
        if over[to] <= 0:
            return out
        column = out[:, to]
        share = column * (over[to] / column.sum())
        less = np.minimum(share.astype(np.int64), column)
        for s in np.argsort(-column, kind="stable"):  # what rounding left over, largest first
            less[s] += min(over[to] - less.sum(), column[s] - less[s])
        out[:, to] -= less


def propagate(state: DataFrame, quotas: list[int], pieces: int, swap: bool) -> DataFrame:
    """One round over (row, group, shard): movers go to their group's fullest shard, places left being places free.

    Without ``swap`` they go to the fullest shard that has room before the round.
    """
    shards = len(quotas)
    free = [q - n for q, n in zip(quotas, _loads(state, shards), strict=True)]
    room = F.lit(1) if swap else _listed(free, F.col("shard"))
    held = state.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
    # the shard that holds most of the group is the aim, even if full: then those elsewhere take the next one with room
    aims = held.groupBy("group").agg(
        F.max(F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard")).alias("most"),
        F.max(F.when(room > 0, F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard"))).alias("open"))
    aims = aims.select("group", F.col("most.shard").alias("most"), F.col("open.n").alias("open_n"), F.col("open.shard").alias("aim"))
    asked = settle(held.join(aims, "group").filter(
        (F.col("aim") != F.col("shard")) & (F.col("shard") != F.col("most"))
        & (_rank("open_n", "aim") > _rank("n", "shard"))).select("group", "shard", "aim", "n"))
    wishes = np.zeros((shards, shards), np.int64)
    for r in asked.groupBy("shard", "aim").agg(F.sum("n").alias("n")).collect():  # at most one a pair of shards
        wishes[r["shard"], r["aim"]] = r["n"]
    most = _listed(flows(wishes, np.array(free)).ravel().tolist(), F.col("shard") * shards + F.col("aim"))
    take = F.least(F.col("n"), most - F.col("start"))
    parts = (laid(asked, ["shard", "aim"], pieces).select("group", "shard", "aim", "n", take.alias("take")).filter("take > 0"))
    looked = state.join(parts, ["group", "shard"], "left")
    whole = looked.filter("take is null or take = n").select("row", "group", F.coalesce("aim", "shard").alias("shard"))
    some = numbered(looked.filter("take < n").withColumn("spread", F.xxhash64("row")), ["group", "shard"], ["row"], "spread", pieces, "place")
    return whole.unionByName(some.select("row", "group", F.when(F.col("place") < F.col("take"), F.col("aim")).otherwise(F.col("shard")).alias("shard")))


def cut_edges(state: DataFrame) -> DataFrame:
    """Linked pairs whose ends lie in different shards, from counts: one row, column ``cut``."""
    held = state.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
    sums = held.groupBy("group").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("squares"))
    return sums.agg(F.coalesce(F.sum((F.col("all") * F.col("all") - F.col("squares")) / 2), F.lit(0.0)).cast("long").alias("cut"))


def assign_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Every document with its shard and its place there."""
    spark = docs.sparkSession
    pieces = 4 * n_partitions(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2("text", 256), F.lit("null")).alias("group"))
    rows = rows.withColumn("spread", F.xxhash64("doc_id", "group"))
    rows = settle(numbered(rows, [], ["spread", "doc_id", "group"], "spread", pieces, "row"))
    total = rows.count()
    quotas = _quotas(total, shards)
    several = settle(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    linked = rows.select("row", "group").join(several.select("group"), "group", "left_semi").withColumn("spread", F.xxhash64("row"))
    n_linked = several.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    state = settle(deal(several, linked, n_linked, shards, pieces))
    cut, swap = cut_edges(state).first()["cut"], True
    while cut:
        moved = settle(propagate(state, quotas, pieces, swap))
        now = cut_edges(moved).first()["cut"]
        if now < cut:
            state, cut, swap = moved, now, True
        elif swap:
            swap = False
        else:
            break
    left, ends, at = _loads(state, shards), [], 0
    for q, n in zip(quotas, left, strict=True):
        at += q - n
        ends.append(at)
    alone = numbered(rows.select("row", F.xxhash64("row").alias("spread")).join(state.select("row"), "row", "left_anti"),
                     [], ["row"], "spread", pieces, "k")
    passed = F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("k"))
    placed = state.select("row", "shard").unionByName(alone.select("row", F.size(passed).alias("shard")))
    whole = rows.drop("spread").join(placed, "row").withColumn("spread", F.xxhash64("row"))
    return numbered(whole, ["shard"], ["row"], "spread", pieces, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
