"""Intermediate tables in the cluster's shared folder.

Lineage is cut by writing a Parquet table below ``spark.checkpoint.dir`` and reading it back:
a lost executor costs a re-read, never a recomputation, and the joins above see real sizes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marketlake.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new scratch table and return the table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(path.getParent(), True)
