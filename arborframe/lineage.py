"""Lineage cut for iterative operators.

Each round of a loop is written as a table into the shared folder the cluster names
in ``spark.checkpoint.dir`` and read back, so a lost executor costs a re-read and the
plan of a round never contains the rounds before it. A written table also carries
file statistics, which a checkpointed RDD does not. ``release`` deletes a round's
table once the next one is written; ``drop_scratch`` deletes what is left.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, set[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's setting; one is made only in local mode without it."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="arborframe-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession) -> str:
    """A new path below the scratch folder, remembered for ``drop_scratch``."""
    path = f"{scratch_root(spark)}/arborframe-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._scratch_path = path
    return kept


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def release(*tables: DataFrame) -> None:
    """Delete tables made by ``cut_lineage`` that no later plan reads; other frames are left alone."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path is not None:
            _delete(df.sparkSession, path)
            _written.get(df.sparkSession.sparkContext.applicationId, set()).discard(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables of this application; call it once results are written."""
    paths = _written.pop(spark.sparkContext.applicationId, set())
    for path in paths:
        _delete(spark, path)
    return len(paths)
