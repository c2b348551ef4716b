"""Directory pick-up as a file stream: every new cloud in a folder is read once.

Only stateless steps run in the stream; per-plot steps need the whole plot and stay in
the batch jobs. The checkpoint location remembers which clouds were taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from arborframe.operators.clean import drop_noise_class
from arborframe.sources.points import OUTPUT_MARK, plot_id_from_name


def new_clouds(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", per_trigger: int = 1000) -> DataFrame:
    """Points of clouds below ``folder`` with the plot id of their file name."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    points = reader.option("maxFilesPerTrigger", per_trigger).parquet(folder).withColumn("_src", F.col("_metadata.file_path"))
    points = points.filter(~F.col("_src").contains(OUTPUT_MARK))
    return points.withColumn("plot_id", plot_id_from_name(F.col("_src"))).drop("_src")


def take_new_clouds(spark: SparkSession, folder: str, schema: T.StructType, out: str, state: str) -> StreamingQuery:
    """Append the points of all clouds that arrived since the last call, then stop."""
    points = drop_noise_class(new_clouds(spark, folder, schema))
    writer = points.writeStream.format("parquet").partitionBy("plot_id").option("checkpointLocation", state)
    return writer.outputMode("append").trigger(availableNow=True).start(out)
