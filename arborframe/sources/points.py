"""Readers and writers of point tables.

Clouds arrive as Parquet or as headerless text; binary scanner files are converted
upstream. Everything below is lazy except the one-row check for empty attributes, the
numbering of text lines (the lines are written once as a table) and the writers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborframe.lineage import cut_lineage
from arborframe.functions.numeric import half_even
from arborframe.operators.clean import crop_circle
from arborframe.operators.spatial import XY, radius_pairs
from arborframe.schema import DIMENSION_TYPES, OTHER_DIMENSION

OUTPUT_MARK = "FT_output"
UNLABELLED_SKIPS = ("segmented_raw", "terrain_points")
CLASS_DTM = 8
#: Bits of a point id that hold the position in its file; the file's number stands above them.
POSITION_BITS = 40
#: Rows per file and writing task that the writers aim at.
ROWS_PER_FILE = 1_000_000


def select_dims(df: DataFrame, headers: Sequence[str]) -> DataFrame:
    """Requested dimensions that exist, in the requested order; unknown ones are skipped."""
    have = set(df.columns)
    return df.select(*[h for h in headers if h in have])


def load_points(
    spark: SparkSession, path: str, headers: Sequence[str], fmt: str = "parquet", plots: DataFrame | None = None, ids: bool = False
) -> DataFrame:
    """Points with the requested dimensions, cropped to the plots when given.

    ``fmt='csv'`` reads space-delimited text whose columns are ``headers`` in order. ``ids``
    adds point_id: the file's number among the files read, by path, and the point's position
    in its file. It is the same for every reading of the same files, however they are split.
    """
    if fmt == "parquet":
        raw = spark.read.parquet(path)
        if ids:
            raw = raw.withColumns({"_file": F.col("_metadata.file_path"), "_position": F.col("_metadata.row_index")})
            raw = with_point_ids(raw)
            headers = ["point_id", *[h for h in headers if h != "point_id"]]
        out = select_dims(raw, headers)
    else:
        schema = T.StructType([T.StructField(h, T.DoubleType()) for h in headers])
        text = with_point_ids(numbered_lines(spark, path)) if ids else spark.read.text(path)
        parts = F.split(F.trim("value"), r"\s+")
        named = [F.try_element_at(parts, F.lit(i + 1)).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]
        out = text.select(*(["point_id"] if ids else []), *named)
    return out if plots is None else crop_circle(out, plots)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _position, value): the lines of text files with their place in the file, from 0.

    A task reads the lines of a block of a file in order, so a line's place is the number of
    lines in the blocks before its own plus its place in the block.
    """
    block = ["_file", "_block"]
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_read"), "value"
    )
    lines = cut_lineage(lines)
    sizes = lines.groupBy(*block).agg(F.min("_read").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = cut_lineage(sizes.select(*block, "_first", before.alias("_before")))
    return lines.join(sizes, block).select("_file", (F.col("_before") + F.col("_read") - F.col("_first")).alias("_position"), "value")


def with_point_ids(rows: DataFrame) -> DataFrame:
    """point_id from _file and _position, which it replaces (an older point_id too)."""
    # one row per file: a short list, numbered in one task
    files = rows.select("_file").distinct()
    files = cut_lineage(files.select("_file", F.row_number().over(Window.orderBy("_file")).cast("long").alias("_number")))
    ids = F.shiftleft("_number", POSITION_BITS) + F.col("_position")
    return rows.drop("point_id").join(files, "_file").withColumn("point_id", ids).drop("_file", "_position", "_number")


def drop_empty_attributes(df: DataFrame, keep: Sequence[str] = ("plot_id", "point_id", "x", "y", "z")) -> DataFrame:
    """Drop numeric attributes that are zero everywhere (one aggregate over the table)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keep]
    if not numeric:
        return df
    used = df.agg(*[F.max((F.col(c) != 0).cast("int")).alias(c) for c in numeric]).first()
    return df.drop(*[c for c in numeric if used[c] is not None and used[c] == 0])


def save_points(df: DataFrame, path: str, fmt: str = "parquet", partition: Sequence[str] = ("plot_id",), mode: str = "errorifexists") -> bool:
    """Write a cloud without its empty attributes; an empty cloud writes nothing."""
    if df.isEmpty():
        return False
    slim = drop_empty_attributes(df)
    if fmt == "csv":
        slim.write.mode(mode).csv(path, sep=" ", header=False)
    else:
        write_by(slim, path, *partition, mode=mode)
    return True


def coords_quantise(df: DataFrame, offsets: tuple[float, float, float], scale: float = 0.001) -> DataFrame:
    return df.withColumns({f"{c}_q": F.rint((F.col(c) - o) / scale).cast("long") for c, o in zip("xyz", offsets)})


def typed_dims(df: DataFrame, fixed: Sequence[str] = ("plot_id", "point_id")) -> DataFrame:
    """Storage type by attribute name; unknown attributes become float."""
    def cast(c: str) -> Column:
        return F.col(c) if c in fixed else F.col(c).cast(DIMENSION_TYPES.get(c.lower(), OTHER_DIMENSION))

    return df.select(*[cast(c).alias(c) for c in df.columns])


def plot_id_from_name(path: Column) -> Column:
    """Base name up to the first underscore, then up to the first dot."""
    name = F.substring_index(F.regexp_replace(path, r"\\", "/"), "/", -1)
    return F.substring_index(F.substring_index(name, "_", 1), ".", 1)


def discover_inputs(paths: DataFrame, column: str = "path", suffix: str = ".laz") -> DataFrame:
    """Input clouds: files with the suffix that are not outputs of an earlier run."""
    return paths.filter(F.col(column).endswith(suffix) & ~F.col(column).contains(OUTPUT_MARK))


def list_inputs(spark: SparkSession, folder: str, suffix: str = ".laz") -> DataFrame:
    """(path, bytes, modified) of the input clouds below a folder; the files are listed, not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").load(folder)
    found = found.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    return discover_inputs(found, suffix=suffix)


def read_folder(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """All clouds below a folder with their plot id from the file name."""
    df = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").parquet(path)
    df = df.withColumn("source", F.col("_metadata.file_path")).filter(~F.col("source").contains(OUTPUT_MARK))
    return df.withColumn("plot_id", plot_id_from_name(F.col("source"))).drop("source")


def combine_plots(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def drop_label(df: DataFrame, source: str | None = None, skip: Sequence[str] = UNLABELLED_SKIPS) -> DataFrame:
    """Client copy without labels; intermediate clouds are left out by source name."""
    if source is not None:
        df = df.filter(~reduce(lambda a, b: a | b, [F.col(source).contains(s) for s in skip]))
    return df.drop("label")


def unlabelled_test_copy(samples: DataFrame) -> DataFrame:
    return samples.filter(F.col("split") == "test").drop("label")


def merge_clouds(full: DataFrame, tree_cloud: DataFrame, dtm: DataFrame) -> DataFrame:
    """Full cloud, tree cloud and terrain nodes in one table.

    Terrain nodes get class 8; tree and terrain points get the plot's mean GPS time;
    never-classified tree points become unclassified (1); absent attributes are 0.
    """
    mean = full.groupBy("plot_id").agg(F.avg("gps_time").alias("_gps"))

    def timed(df: DataFrame) -> DataFrame:
        return df.drop("gps_time").join(cut_lineage(mean), "plot_id").withColumnRenamed("_gps", "gps_time")

    trees = timed(tree_cloud).withColumn("classification", F.when(F.col("classification") == 0, 1).otherwise(F.col("classification")))
    nodes = timed(dtm).withColumn("classification", F.lit(CLASS_DTM))
    merged = combine_plots([full.withColumn("tree_id", F.lit(0).cast("long")), trees, nodes])
    return merged.fillna(0)


def split_by_tree(tree_points: DataFrame, ground_points: DataFrame, skeleton: DataFrame, max_range: float) -> DataFrame:
    """Points of every tree plus the ground points near its skeleton in plan view."""
    spots = skeleton.select("plot_id", "tree_id", *XY).distinct()
    pairs = radius_pairs(ground_points.drop("tree_id"), spots, max_range, XY)
    cols = tree_points.columns
    near = pairs.withColumn("tree_id", F.col("near.tree_id")).select(*cols).dropDuplicates(["plot_id", "tree_id", "point_id"])
    return tree_points.unionByName(near)


def write_by(df: DataFrame, path: str, *keys: str, mode: str = "errorifexists", rows_per_file: int = ROWS_PER_FILE) -> None:
    """One folder per key value, with as many files as its rows need.

    The rows of every key are counted first (combined before the shuffle); a key with much of
    the data is then spread by a hash of the row over as many tasks as it fills files, a small
    one is written as one file. Equal rows share a task, which starts a new file when one is full.
    """
    sizes = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("long").alias("_files"))
    sizes = cut_lineage(sizes.select(F.struct(*keys).alias("_key"), "_files"))
    spread = df.join(sizes, F.struct(*[df[k] for k in keys]).eqNullSafe(F.col("_key")))
    spread = spread.repartition(*keys, F.pmod(F.xxhash64(*df.columns), F.col("_files"))).select(*df.columns)
    spread.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(*keys).parquet(path)


def read_by(df: DataFrame, path: str) -> DataFrame:
    """What ``write_by`` stored of df, with its columns in their order and types."""
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def has_label(df: DataFrame, source: str = "plot_id") -> DataFrame:
    return df.groupBy(source).agg((F.count("label") > 0).alias("has_label"))


def split_by_label(sources: dict[str, DataFrame]) -> tuple[list[str], list[str]]:
    """Names of sources with and without a label attribute."""
    with_label = [n for n, d in sources.items() if "label" in d.columns]
    return with_label, [n for n in sources if n not in with_label]


def load_glyphs(spark: SparkSession, folder: str) -> DataFrame:
    """Alphabet of 0/1 grids, one comma-separated file per character, as set bits.

    File names are the characters; ``semiC``, ``dot``, ``space``, ``capM`` and
    ``underscore`` stand for ':', '.', ' ', 'M' and '_' (file readers skip names that
    begin with an underscore, so those two need a plain name).
    """
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.csv")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.csv$", 1)
    ch = name
    for file_name, char in (("semiC", ":"), ("dot", "."), ("space", " "), ("capM", "M"), ("underscore", "_")):
        ch = F.when(name == file_name, char).otherwise(ch)
    rows = files.select(ch.alias("ch"), F.posexplode(F.split(F.trim("value"), r"\r?\n")).alias("row", "line"))
    cells = rows.select("ch", "row", F.posexplode(F.split("line", ",")).alias("col", "bit"))
    return cells.filter(F.trim("bit") == "1").select("ch", "row", "col")
