"""URL filter: host rules, and for the rest two character models, of accepted and of rejected URLs.

URLs that a rule accepts or rejects are the two corpora. Each model counts what follows every context of
up to five bytes, over all URLs of its corpus; longer contexts are kept only if frequent, so the order
varies. Probabilities are smoothed from the shortest context up (Witten-Bell). A URL's evidence is the
difference of its log-likelihoods, divided by its length; a fifth of the ruled URLs, left out of the
counts, sets the level from which a URL is allowed.

The models are tables that grow with the URLs and never leave the executors. A string of up to six bytes,
a context and what follows it, packs into one long, so both models are one table by string; each order is
joined to the one below it. URLs meet their strings' gains in blocks of ``BLOCK_BYTES``, where a string is
looked up once however often the block has it, so no string is a hot key.

The level comes from counts of both kinds by step of evidence, ``STEPS`` to the unit, over all URLs left out.

Defined cases: a null URL or one without ``://`` has an empty host and path, no rule and, with nothing
to judge, is blocked; without ruled URLs of one kind, URLs get the verdict of the other kind, without
any, allow; without left-out URLs of both kinds the level is 0; repeated rows are judged alike; other
columns are neither read nor returned, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneloom.llm.common import slices
from zoneloom.session import settle

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
ORDER = 5
SIZE_BIT = 48  # a packed string keeps its bytes below
BLOCK_BYTES = 1 << 18
STEPS = 1024


def parts(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in A-Z, and path."""
    found = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(found(1), UPPER, LOWERED), found(2)


def ruled(pages: DataFrame, rules: tuple = RULES, *more: str) -> DataFrame:
    """page_id, url, host, path, and rule and ruling of the longest rule that fits, else null."""
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), path.alias("path"), *more)
    rule, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # longer ones later, so they win
        at, start = name[: name.index("/")], name[name.index("/") :]
        fits = ((F.col("host") == at) | F.col("host").endswith("." + at)) & F.col("path").startswith(start)
        rule, ruling = F.when(fits, name).otherwise(rule), F.when(fits, verdict).otherwise(ruling)
    return rows.withColumn("rule", rule).withColumn("ruling", ruling)


def grams(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """For every length up to ``ORDER`` + 1 the string that ends at each place, its length above its bytes; 0 where the URL begins later."""
    n = len(data)
    place = np.arange(n) - np.repeat(at[:-1], np.diff(at))
    value, out = np.zeros(n, np.int64), []
    for k in range(ORDER + 1):
        value[k:] += data[: max(0, n - k)].astype(np.int64) << (8 * k)
        out.append(np.where(place >= k, value + ((k + 1) << SIZE_BIT), 0))
    return out


def longest(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The longest string that ends at each place."""
    return np.maximum.reduce(grams(data, at))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        kind = b.column("kind").to_numpy()
        for lo, hi, data, at in slices(b.column("url"), 1 << 17):
            if len(data):
                of = np.tile(np.repeat(kind[lo:hi], np.diff(at)), ORDER + 1)
                every = np.concatenate(grams(data, at))
                found, where = np.unique(every[every != 0], return_inverse=True)
                of = of[every != 0]
                n = [np.bincount(where, weights=of == k, minlength=len(found)).astype(np.int64) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n[0]), pa.array(n[1])], ["gram", "good", "bad"])


def models(urls: DataFrame) -> DataFrame:
    """For every string ``gram`` of the URLs, how likely both models hold its last byte after the others: ``p_good, p_bad``.

    ``urls`` has ``url`` and ``kind``: 1 counts as accepted, 2 as rejected, 0 only asks.
    """
    size = F.shiftright("gram", SIZE_BIT)
    counts = (urls.mapInArrow(_count, "gram long, good long, bad long").groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
              .withColumn("size", size.cast("int")))
    kept = [F.when((F.col("size") < 3) | (F.col(c) > 1), F.col(c)).otherwise(0).alias(c) for c in ("good", "bad")]
    shorter = f"shiftleft(cast(size - 1 as bigint), {SIZE_BIT})"
    counts = counts.select("gram", "size", *kept, F.expr(f"{shorter} + shiftright(gram & {(1 << SIZE_BIT) - 1}, 8)").alias("context"),
                           F.expr(f"{shorter} + (gram & (shiftleft(1L, 8 * (size - 1)) - 1))").alias("suffix"))
    totals = counts.groupBy("context").agg(*[F.sum(c).alias(f"total_{c}") for c in ("good", "bad")],
                                           *[F.count_if(F.col(c) > 0).alias(f"kinds_{c}") for c in ("good", "bad")])
    counts = settle(counts.join(totals, "context").drop("context"))
    orders: list[DataFrame] = []
    for k in range(1, ORDER + 2):
        own = counts.filter(F.col("size") == k)
        if orders:  # what a string ends in is a string of the same URL, so none is lost
            own = own.join(orders[-1].select(F.col("gram").alias("suffix"), F.col("p_good").alias("q_good"), F.col("p_bad").alias("q_bad")), "suffix")
        else:
            own = own.withColumns({"q_good": F.lit(1 / 256), "q_bad": F.lit(1 / 256)})
        smooth = [F.when(F.col(f"total_{c}") > 0, (F.col(c) + F.col(f"kinds_{c}") * F.col(f"q_{c}")) / (F.col(f"total_{c}") + F.col(f"kinds_{c}")))
                  .otherwise(F.col(f"q_{c}")).alias(f"p_{c}") for c in ("good", "bad")]
        orders.append(settle(own.select("gram", "good", "bad", *smooth)))
    out = orders[0]
    for order in orders[1:]:
        out = out.unionByName(order)
    return out


def _wanted(key: tuple, rows: pa.Table) -> pa.Table:
    """The distinct longest strings of a block."""
    found = [np.unique(longest(data, at)) for _, _, data, at in slices(rows["url"], 1 << 17)]
    own = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
    return pa.table({"block": pa.array(np.full(len(own), key[0].as_py(), np.int64)), "gram": pa.array(own)})


def _score(rows: pa.Table, known: pa.Table) -> pa.Table:
    """Rows of a block with the mean gain of their bytes."""
    own, gain = known["gram"].to_numpy(), known["gain"].to_numpy()
    order = np.argsort(own)
    own, gain = own[order], gain[order]
    found = np.zeros(rows.num_rows)
    for lo, hi, data, at in slices(rows["url"], 1 << 17):
        if len(data):
            total = np.append(0.0, np.cumsum(gain[np.searchsorted(own, longest(data, at))]))
            found[lo:hi] = (total[at[1:]] - total[at[:-1]]) / np.maximum(np.diff(at), 1)
    return pa.table({"page_id": rows["page_id"], "url": rows["url"], "evidence": pa.array(found)})


def evidence(urls: DataFrame, gains: DataFrame) -> DataFrame:
    """page_id, url and evidence: log-likelihood difference a byte, of accepted less rejected."""
    n = urls.agg(F.sum(F.octet_length("url") + F.lit(16))).head()[0] or 0
    block = F.pmod(F.xxhash64("page_id", "url"), F.lit(max(1, math.ceil(n / BLOCK_BYTES))).cast("long"))
    placed = urls.select("page_id", "url", block.alias("block"))
    wanted = placed.groupBy("block").applyInArrow(_wanted, "block long, gram long")
    known = wanted.join(gains, "gram").select("block", "gram", "gain")
    return placed.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_score, "page_id long, url string, evidence double")


def best_level(steps: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The level that separates the two kinds with the best mean of both rates, given how many of each kind have
    their evidence in a step; 0 when there is but one kind."""
    if not good.sum() or not bad.sum():
        return 0.0
    order = np.argsort(steps)
    e, g, b = steps[order], good[order], bad[order]
    at = int(np.argmax(np.append(0, np.cumsum(b)) / b.sum() - np.append(0, np.cumsum(g)) / g.sum()))
    if at == 0:
        return float(e[0] / STEPS)
    return float((e[at - 1] + 1 + e[at]) / 2 / STEPS) if at < len(e) else float((e[-1] + 1) / STEPS)


def judge(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, and the evidence of the character models.

    The level is set by all distinct URLs that the rules decide and the models have not seen.
    """
    rows = ruled(pages, rules)
    fold = F.crc32("url") % 5 == 0
    counted = F.when(fold | F.col("ruling").isNull(), 0).when(F.col("ruling") == "allow", 1).otherwise(2)
    chances = models(rows.filter("url <> ''").select("url", counted.alias("kind")))
    full = [bool(n) for n in chances.filter(F.shiftright("gram", SIZE_BIT) == 1).agg(F.sum("good"), F.sum("bad")).head()]
    if all(full):
        gains = chances.select("gram", (F.log("p_good") - F.log("p_bad")).alias("gain"))
        scored = ruled(settle(evidence(rows.select("page_id", "url"), gains)), rules, "evidence")
        known = scored.filter("ruling is not null").filter(fold).select("url", "evidence", (F.col("ruling") == "allow").alias("good"))
        step = F.floor(F.col("evidence") * STEPS).cast("long").alias("step")
        # bounded by the steps that likelihoods can differ by
        tried = known.dropDuplicates(["url"]).groupBy(step).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).toArrow()
        level = best_level(*[tried[c].to_numpy() for c in ("step", "good", "bad")])
        other = F.when(F.col("evidence") >= level, "allow").otherwise("block")
    else:
        scored = rows.withColumn("evidence", F.lit(0.0))
        other = F.lit("block" if full == [False, True] else "allow")
    nothing = (F.col("host") == "") & (F.col("path") == "")
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruling", F.when(nothing, "block").otherwise(other)).alias("verdict"), "evidence")
