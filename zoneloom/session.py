"""Session helpers: where shared scratch data goes and how kernels reach the executors."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship_kernels() -> None:
    """Pickle this package's functions by value, so executors need no copy of it."""
    import zoneloom

    cloudpickle.register_pickle_by_value(zoneloom)


def local_session(cores: str = "*", app: str = "zoneloom", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir`` as the session names it.

    Only a local session that names none gets a temporary folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="zoneloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder for one written table."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def passing_shuffles(spark: SparkSession):
    """What is planned inside drops its shuffle files as it ends; left to itself Spark keeps them until the driver
    happens to collect its garbage. Only for what is written as a whole: nothing reads those files again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def settle(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage through the reliable checkpoint folder."""
    shared_root(df.sparkSession)
    with passing_shuffles(df.sparkSession):
        return df.where(F.lit(True)).checkpoint(eager=True)  # planned anew: ``df`` may have been planned before


def stored(df: DataFrame, name: str) -> DataFrame:
    """``settle`` for rows with geometry: as Parquet, a fraction of what the checkpoint's rows take. Types that Parquet
    has not go the other way."""
    if any(kind in df.schema.simpleString() for kind in ("void", "interval", "variant")):
        return settle(df)
    path = workspace(df.sparkSession, name)
    with passing_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by) -> DataFrame:
    """Hash rows over the session's shuffle partitions; an explicit number, so CPU-bound work
    is not merged into few tasks because its input is small."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *by)


STAYS = {"Project", "Filter", "SubqueryAlias", "MapInArrow"}  # steps that leave rows in the task they are in, near as many


def is_spread(df: DataFrame) -> bool:
    """Whether the rows come straight from a spreading over as many partitions as the session shuffles to."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in STAYS:
        plan = plan.children().head()
    return plan.nodeName() == "RepartitionByExpression" and plan.numPartitions() >= n
