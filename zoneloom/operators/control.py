"""Incremental state: one row per unit (state, county), moved through the stages by joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY = ["state", "county"]

# fixed values: stages in order, and the columns of the two tables
STAGES = ["new", "bronze", "silver", "subdivided"]
IMPORT_LOG_SCHEMA = """
state string, county string, fema_update_date date, source_url string, dfirm_id string,
zip_size_mb double, zip_name string, bronze_path string, bronze_rows bigint,
bronze_encoding string, bronze_crs string, bronze_at timestamp, silver_rows bigint,
silver_invalid_fixed bigint, silver_at timestamp, subdivided_rows bigint,
subdivide_max_vertices int, subdivide_ms int, subdivide_at timestamp, status string,
error string, error_at timestamp
"""
BENCHMARK_SCHEMA = """
run_at timestamp, stage string, name string, layout string, variant string, scope string,
rows bigint, files bigint, bytes bigint, elapsed_ms double, notes string
"""
ERROR_LENGTH = 500

FEED_COLUMNS = {
    "url": "source_url",
    "dfirm_id": "dfirm_id",
    "zip_size_mb": "zip_size_mb",
    "zip_name": "zip_name",
}


def empty_log(spark: SparkSession) -> DataFrame:
    """An import log with no rows."""
    return spark.createDataFrame([], IMPORT_LOG_SCHEMA)


def conform(df: DataFrame, schema_of: DataFrame) -> DataFrame:
    """Additive schema evolution: columns the stored table lacks come in as NULL."""
    return schema_of.limit(0).unionByName(df, allowMissingColumns=True)


def stage_rank(status: Column) -> Column:
    """Position of a status in the stage order."""
    return F.array_position(F.array(*[F.lit(s) for s in STAGES]), status)


def _match(log: DataFrame, feed: DataFrame, how: str) -> DataFrame:
    tagged = feed.select(
        *KEY, F.struct(*[c for c in feed.columns if c not in KEY]).alias("feed")
    )
    return log.withColumn("known", F.lit(True)).join(tagged, KEY, how)


def upsert(log: DataFrame, feed: DataFrame, update_only: bool = False) -> DataFrame:
    """Register a feed. Only a strictly newer delivery sends a unit back to ``new``.

    Link, name, id and size always follow the feed; the date keeps the greatest. With
    ``update_only`` unknown units are ignored.
    """
    both = _match(log, feed, "left" if update_only else "full_outer")
    in_feed = F.col("feed").isNotNull()
    out = {c: F.col(c) for c in log.columns}
    for source, target in FEED_COLUMNS.items():
        out[target] = F.when(in_feed, F.col(f"feed.{source}")).otherwise(F.col(target))
    newer = F.col("feed.fema_update_date") > F.col("fema_update_date")
    out["fema_update_date"] = F.greatest(F.col("feed.fema_update_date"), F.col("fema_update_date"))
    out["status"] = F.when(F.col("known").isNull() | newer, F.lit("new")).otherwise(F.col("status"))
    return both.select(*[expr.alias(name) for name, expr in out.items()])


def upsert_counters(log: DataFrame, feed: DataFrame, update_only: bool = False) -> DataFrame:
    """``inserted, updated, newer``: updated counts every known unit, changed or not."""
    both = _match(log, feed, "right")
    known = F.col("known").isNotNull()
    inserted = F.lit(0).cast("bigint") if update_only else F.count_if(~known)
    return both.agg(
        inserted.alias("inserted"),
        F.count_if(known).alias("updated"),
        F.count_if(known & (F.col("feed.fema_update_date") > F.col("fema_update_date"))).alias(
            "newer"
        ),
    )


def worklist(
    log: DataFrame,
    stage: str,
    state: str | None = None,
    counties: list[str] | None = None,
    force: bool = False,
    loaded_only: bool = False,
) -> DataFrame:
    """Units waiting for ``stage``; ``force`` ignores the status."""
    units = log
    if not force:
        units = units.where(F.col("status") == STAGES[STAGES.index(stage) - 1])
    if loaded_only:
        units = units.where("bronze_at IS NOT NULL")
    if state:
        units = units.where(F.col("state") == state)
    if counties:
        units = units.where(F.col("county").isin(counties))
    return units.select(*KEY, "fema_update_date", "source_url")


def mark(log: DataFrame, results: DataFrame, stage: str) -> DataFrame:
    """Write stage results back: one row per unit, ``error`` NULL on success.

    A success sets the result columns and the status and clears the error; a failure writes only
    the error, cut to 500 characters, and its time, so the unit stays where it was.
    """
    new = [c for c in results.columns if c not in KEY]
    tagged = results.select(*KEY, F.struct(*new).alias("result"))
    both = log.join(tagged, KEY, "left")
    hit = F.col("result").isNotNull()
    good = hit & F.col("result.error").isNull()
    out = {}
    for c in log.columns:
        value = F.col(c)
        if c == "status":
            value = F.when(good, F.lit(stage)).otherwise(value)
        elif c == "error":
            value = F.when(hit, F.substring("result.error", 1, ERROR_LENGTH)).otherwise(value)
        elif c == "error_at":
            at = F.col("result.error_at") if "error_at" in new else F.current_timestamp()
            value = F.when(good, None).when(hit, at).otherwise(value)
        elif c in new:
            value = F.when(good, F.col(f"result.{c}")).otherwise(value)
        out[c] = value
    return both.select(*[e.alias(n) for n, e in out.items()])


def completed(log: DataFrame, stage: str = "subdivided") -> DataFrame:
    """Units whose last completed stage is ``stage``."""
    return log.where(F.col("status") == stage).select(*KEY)


def never_loaded(log: DataFrame, state: str | None = None) -> DataFrame:
    """Units listed but never ingested, counted per state."""
    units = log.where("bronze_at IS NULL")
    if state:
        units = units.where(F.col("state") == state)
    return units.groupBy("state").agg(F.count("*").alias("units")).orderBy("state")


def reconcile(log: DataFrame, inventory: DataFrame) -> DataFrame:
    """Downgrade units whose files are gone.

    ``inventory`` holds ``state, county, stage`` of the files that exist. A stage counts only when
    all stages below it exist too. Rows it changed carry ``downgraded``.
    """
    have = inventory.groupBy(*KEY).agg(F.collect_set("stage").alias("have"))
    both = log.join(have, KEY, "left")

    def present(stage):
        return F.coalesce(F.array_contains("have", stage), F.lit(False))

    # highest stage first: the first one whose files are all there
    reached = F
    for n in range(len(STAGES) - 1, 0, -1):
        whole = present(STAGES[1])
        for s in STAGES[2 : n + 1]:
            whole = whole & present(s)
        reached = reached.when(whole, F.lit(STAGES[n]))
    reached = reached.otherwise(F.lit(STAGES[0]))
    both = both.withColumn("reached", reached).withColumn(
        "downgraded", stage_rank(F.col("reached")) < stage_rank(F.col("status"))
    )
    text = F.concat(F.lit("reconcile: files for status "), F.col("status"), F.lit(" missing"))
    return both.withColumns(
        {
            "error": F.when(F.col("downgraded"), text).otherwise(F.col("error")),
            "status": F.when(F.col("downgraded"), F.col("reached")).otherwise(F.col("status")),
        }
    ).select(*log.columns, "downgraded")


def prune(log: DataFrame, state: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(kept, removed)``: removed are the units never ingested, in one state if named."""
    gone = F.col("bronze_at").isNull()
    if state:
        gone = gone & (F.col("state") == state)
    return log.where(~gone), log.where(gone)


def drop_state(log: DataFrame, state: str) -> DataFrame:
    """All units of one state out of the log."""
    return log.where(F.col("state") != state)


def status_report(log: DataFrame) -> DataFrame:
    """Per state and status: units, MB, rows of each layer, growth ratio, errors."""
    return (
        log.groupBy("state", "status")
        .agg(
            F.count("*").alias("counties"),
            F.round(F.sum("zip_size_mb")).alias("zip_mb"),
            F.sum("bronze_rows").alias("bronze_rows"),
            F.sum("silver_rows").alias("silver_rows"),
            F.sum("subdivided_rows").alias("subdivided_rows"),
            F.round(
                F.sum("subdivided_rows") / F.nullif(F.sum("silver_rows"), F.lit(0)), 1
            ).alias("ratio"),
            F.count("error").alias("errors"),
        )
        .orderBy("state", "status")
    )


def error_list(log: DataFrame) -> DataFrame:
    """Units with an error, oldest first."""
    return (
        log.where("error IS NOT NULL")
        .select(*KEY, "status", "error_at", "error")
        .orderBy("error_at", *KEY)
    )


def unit_listing(log: DataFrame, state: str | None = None) -> DataFrame:
    """Units by state and archive size."""
    units = log.where(F.col("state") == state) if state else log
    return units.select(*KEY, "fema_update_date", "zip_size_mb", "status").orderBy(
        "state", "zip_size_mb", "county"
    )


def smallest_units(log: DataFrame, n: int = 2) -> DataFrame:
    """The ``n`` smallest units of each state, the ones to suggest first.

    Each task keeps at most ``n`` rows per state before the shuffle.
    """
    ranked = W.partitionBy("state").orderBy(F.asc_nulls_last("zip_size_mb"), "county")
    return (
        log.select("state", "county", "zip_size_mb", F.row_number().over(ranked).alias("pick"))
        .where(F.col("pick") <= n)
    )


class ScopeRefused(ValueError):
    """The scope is too wide to run without naming units; carries the suggested picks."""

    def __init__(self, message: str, picks: DataFrame | None = None):
        super().__init__(message)
        self.picks = picks


def scope(
    log: DataFrame,
    state: str | None = None,
    counties: list[str] | None = None,
    whole_state: bool = False,
    all_states: bool = False,
    defaults: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Units a run touches: everything, named units, a whole state, the state's default list."""
    if all_states:
        return log
    in_state = log.where(F.col("state") == state) if state else log
    if counties:
        return in_state.where(F.col("county").isin(counties))
    if whole_state and state:
        return in_state
    if state and (defaults or {}).get(state):
        return in_state.where(F.col("county").isin(defaults[state]))
    if not state:
        raise ScopeRefused("name a state and its units, or ask for all states")
    raise ScopeRefused(
        f"{state} has no default list: name its units", smallest_units(in_state)
    )


def missing_units(requested: DataFrame, available: DataFrame) -> DataFrame:
    """Requested units that are not available."""
    return requested.select(*KEY).distinct().join(available, KEY, "left_anti")


def run_stage(
    log: DataFrame, stage: str, work: Callable[[DataFrame], DataFrame], **options
) -> DataFrame:
    """One Spark job over all units waiting for ``stage``; their results marked in the log.

    ``work`` gets the worklist and returns one row per unit with the stage's columns and ``error``.
    """
    return mark(log, work(worklist(log, stage, **options)), stage)


class LogStore:
    """The import log on shared storage: each save is a new folder, a small list names the last.

    Older versions stay readable, so a save that fails half-way changes nothing. One writer.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> DataFrame:
        return self.spark.read.schema("version int").json(f"{self.root}/versions")

    def save(self, log: DataFrame, version: int) -> int:
        from zoneloom.sources.layout import write_parquet

        write_parquet(log, f"{self.root}/v{version:06d}")
        self.spark.range(1).select(F.lit(version).alias("version")).write.mode("append").json(
            f"{self.root}/versions"
        )
        return version

    def last_version(self) -> int:
        return self._versions().agg(F.max("version")).first()[0]

    def append_benchmarks(self, runs: DataFrame) -> None:
        """Measurements beside those stored before; columns that ``runs`` lacks are NULL, others are refused."""
        from zoneloom.sources.layout import write_parquet

        empty = self.spark.createDataFrame([], BENCHMARK_SCHEMA)
        extra = set(runs.columns) - set(empty.columns)
        if extra:
            raise ValueError(f"no such benchmark columns: {sorted(extra)}")
        rows = empty.unionByName(runs, allowMissingColumns=True)
        kept = [F.col(c).cast(t).alias(c) for c, t in empty.dtypes]
        write_parquet(rows.select(*kept), f"{self.root}/benchmarks", mode="append")

    def benchmarks(self) -> DataFrame:
        """All measurements appended so far."""
        return self.spark.read.schema(BENCHMARK_SCHEMA).parquet(f"{self.root}/benchmarks")

    def load(self) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.root}/v{self.last_version():06d}")
        return conform(stored, empty_log(self.spark))
