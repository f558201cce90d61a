"""Parquet layouts: units, cells, one global Hilbert order, and the indexes over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from zoneloom.functions import grid as G
from zoneloom.functions import rings as R
from zoneloom.operators.joins import LISTED_KEYS, candidate_files, match_in_files, with_box
from zoneloom.operators.reports import extent
from zoneloom.session import passing_shuffles, settle
from zoneloom.sources.folders import listed, partition_files

# fixed values: compression level of a published set, and rows per row group of the layouts
PUBLISH_LEVEL = 15
SILVER_GROUP = 1_000
CELL_GROUP = 2_000
GLOBAL_GROUP = 20_000

# layers that are rewritten all the time: the published level saves 3 percent of the bytes and
# takes several times as long, most of all on many small files
LAYER_LEVEL = 3
SLICE = 1 << 20  # curve positions that are numbered by one task
ROWS_PER_FILE = 5_000_000  # above this a unit or cell is spread over several files
# On a local disk Hadoop's checksum files cost two started processes (chmod) for each file of a layer, several times
# what the file takes; Parquet's pages hold checksums of their own. Other file systems take no notice.
PLAIN_LOCAL = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
WORLD = (-180.0, -90.0, 180.0, 90.0)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    group_rows: int | None = None,
    mode: str = "overwrite",
    level: int = LAYER_LEVEL,
    **options: str,
) -> None:
    """The one writer of this package: zstd, and row groups of a set length."""
    writer = (
        df.write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", str(level))
        .options(**options)
    )
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", str(group_rows))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with passing_shuffles(df.sparkSession):
        writer.parquet(path)


def _write_grouped(
    df, path, keys, order, group_rows, rows_per_file, mode, sizes=None, **options
) -> None:
    """One file per key; a key of ``n`` rows above ``rows_per_file`` gets ``ceil(n / rows_per_file)``.

    ``sizes`` holds ``keys, n`` when that is cheaper to know than to count ``df``, which may be the
    outcome of a kernel. It only says which keys are numbered, so an upper bound will do: files are
    filled by the rows there are.
    """
    # an explicit number: small input must not end up in one task that writes every file
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    large = settle(sizes.where(F.col("n") > rows_per_file).select(*keys))
    if large.isEmpty():
        numbered = df.withColumn("_file", F.lit(0).cast("long"))
    else:
        marked = df.join(large.withColumn("_large", F.lit(True)), keys, "left")
        # rows are numbered within slices of the curve; a slice starts where those before it end
        piece = F.floor(F.col(order[0]) / SLICE) if order else F.pmod(F.xxhash64(*df.columns), F.lit(4096))
        slices = marked.where("_large").withColumn("_slice", piece)
        counts = slices.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"))
        before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
        starts = counts.select(*keys, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
        # rows equal in the order columns are told apart by a hash of the whole row
        own = W.partitionBy(*keys, "_slice").orderBy(*order, F.xxhash64(*df.columns))
        place = F.row_number().over(own) - 1 + F.col("_start")
        spread = slices.join(starts, [*keys, "_slice"]).select(*df.columns, F.floor(place / rows_per_file).alias("_file"))
        whole = marked.where("_large is null").select(*df.columns, F.lit(0).cast("long").alias("_file"))
        numbered = whole.unionByName(spread)
    # files of one key that meet in a task are full but for the last, so the limit cuts between them
    write_parquet(
        numbered.repartition(tasks, *keys, "_file").sortWithinPartitions(*keys, "_file", *order).drop("_file"),
        path, keys, group_rows, mode, maxRecordsPerFile=str(rows_per_file), **PLAIN_LOCAL, **options,
    )


def write_units(
    df: DataFrame,
    path: str,
    keys=("state", "county"),
    order=(),
    group_rows: int = SILVER_GROUP,
    rows_per_file: int = ROWS_PER_FILE,
    sizes: DataFrame | None = None,
) -> None:
    """A whole layer, one folder per unit."""
    _write_grouped(
        df, path, list(keys), list(order), group_rows, rows_per_file, "overwrite", sizes
    )


def replace_units(
    df: DataFrame,
    path: str,
    keys=("state", "county"),
    order=(),
    group_rows: int = SILVER_GROUP,
    rows_per_file: int = ROWS_PER_FILE,
    sizes: DataFrame | None = None,
) -> None:
    """Rewrite only the units that ``df`` holds; all others stay as they are."""
    _write_grouped(
        df, path, list(keys), list(order), group_rows, rows_per_file, "overwrite", sizes,
        partitionOverwriteMode="dynamic",
    )


def replace_cells(
    filed: DataFrame,
    path: str,
    group_rows: int = CELL_GROUP,
    rows_per_file: int = ROWS_PER_FILE,
    sizes: DataFrame | None = None,
) -> None:
    """Rewrite only the cells that ``filed`` (rows with ``cell, hilbert``) holds."""
    if sizes is None:
        sizes = settle(filed.groupBy("cell").agg(F.count("*").alias("n")))
    _write_grouped(
        filed, path, ["cell"], ["hilbert"], group_rows, rows_per_file, "overwrite", sizes,
        partitionOverwriteMode="dynamic",
    )
    require_few_files(filed.sparkSession, path, sizes, rows_per_file)


def require_few_files(spark: SparkSession, path: str, sizes: DataFrame, rows_per_file: int) -> None:
    """Raise when a cell of ``sizes`` (``cell, n``) has more files than its rows ask for."""
    files = partition_files(spark, path, ["cell"]).groupBy("cell").agg(F.count("*").alias("files"))
    most = F.greatest(F.lit(1), F.ceil(F.col("n") / rows_per_file))
    bad = files.join(sizes, "cell").where(F.col("files") > most).orderBy("cell").limit(5).collect()
    if bad:
        raise ValueError(f"cells with more files than their rows ask for: {[(r.cell, r.files, r.n) for r in bad]}")


def scan(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """A layer with its folder columns; ``glob`` narrows to matching folders."""
    reader = spark.read.option("basePath", root)
    return listed(spark, lambda: reader.parquet(f"{root}/{glob}" if glob else root))


def scan_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """Exactly the files or folders an index named."""
    return spark.read.option("basePath", root).parquet(*paths)


def scan_chosen(spark: SparkSession, root: str, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """The partitions of a layer that ``chosen`` names, repeats allowed; the list never leaves the executors.

    The names are joined on the partition columns, so that Spark prunes the scan's folders when it runs.
    """
    named = settle(chosen.groupBy(*keys).agg(F.count("*").alias("_n")))
    side = named.where("_n > 0").select(*keys)  # always true; a filter on this side is what prunes at run time
    if named.count() <= LISTED_KEYS:
        side = F.broadcast(side)
    return scan(spark, root).join(side, keys, "left_semi")


def two_step_scan(
    points: DataFrame, index: DataFrame, root: str, file_key: str, size: float, columns: list[str], keep: list[str] | None = None
) -> DataFrame:
    """Points to candidate files by the index, then only those files of the layer at ``root`` are read; ``keep`` names
    the columns of a hit."""
    files = settle(candidate_files(points, index, file_key, size))
    zones = scan_chosen(points.sparkSession, root, files.select(file_key), [file_key])
    return match_in_files(files, zones.select(file_key, *columns), file_key, size, keep)


def scan_numbered(spark: SparkSession, root: str, keys=("state", "county")) -> DataFrame:
    """A layer with ``file_row_number``: the 0-based row of each unit, over all of its files by name.

    The offsets of files behind the first of their unit are prefix sums over row counts, which the
    footers give; a unit in one file has none, so what is joined is small.
    """
    keys = list(keys)
    rows = scan(spark, root).select(
        "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_at")
    )
    counts = rows.groupBy(*keys, "_path").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*keys).orderBy("_path").rowsBetween(W.unboundedPreceding, -1)
    starts = settle(counts.select("_path", F.sum("_n").over(before).alias("_start")).where("_start > 0"))
    if starts.count() <= LISTED_KEYS:
        starts = F.broadcast(starts)
    at = F.col("_at") + F.coalesce("_start", F.lit(0).cast("bigint"))
    return rows.join(starts, "_path", "left").withColumn("file_row_number", at).drop("_path", "_at", "_start")


def plain_path(path) -> Column:
    """The path that file metadata holds in URI form, as readers take it."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """``path, bytes`` of the data files, from the listing alone."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", F.col("length").alias("bytes"))
    )


def table_size(spark: SparkSession, root: str) -> DataFrame:
    """Rows, files and bytes of a layout."""
    rows = spark.read.parquet(root).agg(F.count("*").alias("rows"))
    size = file_listing(spark, root).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes")
    )
    return size.withColumn("rows", rows.scalar())


def file_cells(pieces: DataFrame, size: float, curve_box, bits: int = 16) -> DataFrame:
    """Each piece under every cell it overlaps, with its cell name and curve position."""
    box = R.envelope(*curve_box)
    filed = G.with_zone_cells(with_box(pieces), size)
    x, y = G.box_centre(F.col("bbox"))
    return filed.withColumns(
        {
            "cell": G.cell_id(F.col("ci"), F.col("cj")),
            "hilbert": G.hilbert_in_box(x, y, box, bits),
        }
    )


def write_cells(
    pieces: DataFrame,
    path: str,
    size: float,
    curve_box=None,
    bits: int = 16,
    group_rows: int = CELL_GROUP,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """The cell layout: one file per cell, in curve order, with a box column for skipping.

    The curve runs over the extent of the data unless ``curve_box`` names one.
    """
    if curve_box is None:
        curve_box = tuple(extent(pieces).first()["bbox"])
    filed = file_cells(pieces, size, curve_box, bits)
    # boxes alone give a close upper bound, and only their column is read for it
    boxed = G.with_box_cells(pieces.select("bbox"), size)
    sizes = settle(
        boxed.groupBy(G.cell_id(F.col("ci"), F.col("cj")).alias("cell")).agg(F.count("*").alias("n"))
    )
    _write_grouped(
        filed, path, ["cell"], ["hilbert"], group_rows, rows_per_file, "overwrite", sizes
    )
    require_few_files(pieces.sparkSession, path, sizes, rows_per_file)


def write_global_order(
    pieces: DataFrame,
    path: str,
    curve_box=WORLD,
    bits: int = 16,
    files: int | None = None,
    group_rows: int = GLOBAL_GROUP,
    level: int = PUBLISH_LEVEL,
    **options: str,
) -> None:
    """The whole set in one curve order, file after file."""
    x, y = G.box_centre(F.col("bbox"))
    keyed = pieces.withColumn("hilbert", G.hilbert_in_box(x, y, R.envelope(*curve_box), bits))
    # the hash lets rows with one curve position spread over files
    order = ["hilbert", F.xxhash64(*pieces.columns)]
    if files and "maxRecordsPerFile" in options:
        # the limit says how many files there are, and the tasks that write them grow with the cluster
        files = max(files, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = (files, *order) if files else tuple(order)
    write_parquet(
        keyed.repartitionByRange(*parts).sortWithinPartitions("hilbert"), path,
        group_rows=group_rows, level=level, **options,
    )


def file_index(spark: SparkSession, root: str) -> DataFrame:
    """Per file: rows, bytes, box. One pass over the box column of all files."""
    rows = scan(spark, root)
    units = [c for c in ("state", "county", "cell") if c in rows.columns]
    return extent_of_files(
        rows.select(
            *units, "bbox", plain_path(F.col("_metadata.file_path")).alias("path"),
            F.col("_metadata.file_size").alias("size"),
        ),
        units,
    )


def extent_of_files(rows: DataFrame, units: list[str]) -> DataFrame:
    """Rows, bytes and box per ``path``."""
    b = F.col("bbox")
    return rows.groupBy("path").agg(
        *[F.first(u).alias(u) for u in units],
        F.count("*").alias("rows"),
        F.max("size").alias("bytes"),
        F.struct(
            F.min(b["xmin"]).alias("xmin"),
            F.min(b["ymin"]).alias("ymin"),
            F.max(b["xmax"]).alias("xmax"),
            F.max(b["ymax"]).alias("ymax"),
        ).alias("bbox"),
    )


def cell_index(spark: SparkSession, root: str) -> DataFrame:
    """Per cell: files, rows, bytes, box."""
    b = F.col("bbox")
    return (
        file_index(spark, root)
        .groupBy("cell")
        .agg(
            F.count("*").alias("files"),
            F.sum("rows").alias("rows"),
            F.sum("bytes").alias("bytes"),
            F.struct(
                F.min(b["xmin"]).alias("xmin"),
                F.min(b["ymin"]).alias("ymin"),
                F.max(b["xmax"]).alias("xmax"),
                F.max(b["ymax"]).alias("ymax"),
            ).alias("bbox"),
        )
    )


def extra_files(index: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Cells that got a second file although one would do; empty when the layout is sound."""
    return index.where((F.col("rows") <= rows_per_file) & (F.col("files") > 1))


def write_cell_index(index: DataFrame, path: str, size: float, srid: int = R.SRID) -> None:
    """The cell index as JSON lines, each with the grid it belongs to."""
    index.withColumns(
        {
            "cell_size": F.lit(float(size)),
            "srid": F.lit(srid),
            "note": F.lit(
                "rows repeat across cells: one that reaches into several cells is in the file of each, "
                "so count or draw it by its state, county, zone_id and piece_id"
            ),
        }
    ).write.mode("overwrite").json(path)
