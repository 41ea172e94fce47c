"""Which files the published tables consist of: one small log that readers resolve.

A build writes its tables to a folder of its own and publishes all of them with one entry of the log, so
readers see the old set or the new one, never a mix, and a build that breaks leaves the old set.
A table may consist of parts (the fact's months); an entry that replaces some parts keeps the others.
Folders that no entry needs any more are removed by :func:`sweep`, when no reader uses them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from marketlake.sinks import append_log

# ``whole``: the entry replaces all parts of the table
PUBLISHED = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("part", T.StringType()),
    T.StructField("path", T.StringType()), T.StructField("whole", T.BooleanType()),
])
LOG = "_published"


def _log_root(root: str) -> str:
    return f"{root.rstrip('/')}/{LOG}"


def _fs(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return jvm_path, jvm_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def parts_of(spark: SparkSession, path: str, column: str) -> list[str]:
    """The ``column=...`` folders of a written table (by month: some hundred)."""
    jvm_path, fs = _fs(spark, path)
    found = fs.globStatus(jvm_path(f"{path}/{column}=*")) or []
    return sorted(s.getPath().getName() for s in found)


def publish(spark: SparkSession, root: str, tables: dict[str, str],
            parts: dict[str, list[str]] | None = None, whole: bool = True,
            withdraw: Sequence[str] = ()) -> int:
    """Publish written tables (name -> path, below ``root``) with one entry; returns its version.

    ``parts`` names the folders of a table that is published by parts. Without ``whole`` those
    parts join or replace the ones published before. Tables in ``withdraw`` are published no more.
    """
    base, rows = root.rstrip("/") + "/", []
    for name, path in tables.items():
        if not path.startswith(base):
            raise ValueError(f"{path} is not below {root}")
        own = path[len(base):]  # a folder of tables may be moved as a whole
        for part in (parts or {}).get(name, [""]):
            rows.append((name, part, own, whole or not part))
    rows += [(name, "", "", True) for name in withdraw]
    return append_log.append(spark, _log_root(root), spark.createDataFrame(rows, PUBLISHED))


def current(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, part, path) of the tables as published now."""
    log = append_log.entries(spark, _log_root(root), PUBLISHED)
    by_table = Window.partitionBy("table_name")
    since = F.max(F.when(F.col("whole"), F.struct("version", "writer"))).over(by_table)
    alive = log.withColumn("_since", since).filter(
        F.col("_since").isNull() | (F.struct("version", "writer") >= F.col("_since"))).drop("_since")
    return append_log.newest(alive, ["table_name", "part"]).filter("path != ''").drop("whole")


def files_of(spark: SparkSession, root: str, name: str) -> list[str]:
    """The folders a published table is read from; none if it isn't published."""
    rows = current(spark, root).filter(F.col("table_name") == name).collect()  # one row per part
    return sorted("/".join(x for x in (root.rstrip("/"), r.path, r.part) if x) for r in rows)


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A published table. Part columns are there as with a partitioned table."""
    paths = files_of(spark, root, name)
    if not paths:
        raise AnalysisException(f"table {name} is not published in {root}")
    builds: dict[str, list[str]] = {}
    for path in paths:
        top, _, last = path.rpartition("/")
        builds.setdefault(top if "=" in last else path, []).append(path)
    # the folders of one build are one scan; filters on parts prune folders in each
    scans = [spark.read.option("basePath", base).parquet(*own) for base, own in sorted(builds.items())]
    return reduce(DataFrame.unionByName, scans)


def sweep(spark: SparkSession, root: str, prefix: str = "build-") -> list[str]:
    """Delete the build folders that hold nothing of the published tables; returns their names.

    For times without readers and without a build under way.
    """
    jvm_path, fs = _fs(spark, root)
    used = {r.path.split("/")[0] for r in current(spark, root).select("path").collect()}
    gone = [s.getPath() for s in fs.globStatus(jvm_path(f"{root.rstrip('/')}/{prefix}*")) or []
            if s.getPath().getName() not in used]
    for path in gone:
        fs.delete(path, True)
    return sorted(p.getName() for p in gone)
