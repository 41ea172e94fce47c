"""A small table that only grows: one file per entry, the newest row of a key is its state.

Writers never read and overwrite the same files, so two that write at once both keep their
rows; what a crashed writer leaves behind is neither read nor in the way. Entries are a few
rows each (watermarks, published tables), written by the driver once per load or build.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

ORDER = [T.StructField("version", T.LongType()), T.StructField("writer", T.StringType())]


def entries(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All rows ever written, with ``version`` and ``writer``; none if there is no log."""
    full = T.StructType([*schema.fields, *ORDER])
    try:
        return spark.read.schema(full).option("recursiveFileLookup", "true").parquet(root)
    except AnalysisException:
        return spark.createDataFrame([], full)


def append(spark: SparkSession, root: str, rows: DataFrame) -> int:
    """Write ``rows`` as one entry; returns its version, above every version it can see.

    The entry appears as a whole (one file, moved into place by the job's commit). Versions
    follow the clock, so of two writers that don't see each other the later one counts.
    """
    seen = entries(spark, root, rows.schema).agg(F.max("version")).first()[0] or 0
    version, writer = max(seen + 1, time.time_ns()), uuid.uuid4().hex
    out = rows.withColumn("version", F.lit(version)).withColumn("writer", F.lit(writer))
    out.coalesce(1).write.mode("error").parquet(f"{root.rstrip('/')}/entry-{writer}")
    return version


def newest(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key, without its order columns."""
    w = Window.partitionBy(*keys).orderBy(F.desc("version"), F.desc("writer"))
    return log.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop(
        "_rn", "version", "writer")


def compact(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str]) -> int:
    """Replace the entries seen now by one that holds their newest rows, versions included.

    Only files that were read are deleted, and only after the new entry is there; a row that is in both for a
    moment counts once, as the newest of its key. Returns the number of files dropped.
    """
    log = entries(spark, root, schema)
    files = log.inputFiles()
    if len(files) < 2:
        return 0
    w = Window.partitionBy(*keys).orderBy(F.desc("version"), F.desc("writer"))
    rows = log.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    rows.coalesce(1).write.mode("error").parquet(f"{root.rstrip('/')}/entry-{uuid.uuid4().hex}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for file in files:
        fs.delete(path(file), False)
    return len(files)
