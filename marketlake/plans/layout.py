"""Second layouts of the fact: bucketed by symbol, and what each month holds of each symbol.

The fact is stored by month, which suits trends and refreshes. Per-symbol queries would shuffle it:
the bucketed copy is laid out as they need it, so their windows and aggregates read it without an
exchange. The month counts tell which months hold the latest rows of every symbol, so that
"latest N" queries read those alone.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.plans.build import COUNTS, FACT, read_fact, read_mart
from marketlake.sinks import published

BY_SYMBOL = "fact_by_symbol"
ROWS_PER_BUCKET = 4_000_000


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets for a fact of ``rows`` rows: tasks of a few hundred MB, whatever the number of symbols."""
    return max(1, -(-rows // rows_per_bucket))


def write_by_symbol(fact: DataFrame, path: str, buckets: int) -> None:
    """The fact in ``buckets`` files, dealt by symbol and sorted by symbol and date."""
    spark, name = fact.sparkSession, f"w_{uuid.uuid4().hex}"
    (fact.repartition(buckets, "symbol").write.bucketBy(buckets, "symbol").sortBy("symbol", "date")
     .format("parquet").option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay


def table_by_symbol(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The files at ``path`` as a table whose buckets Spark knows."""
    name = f"fact_by_symbol_{hashlib.sha1(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                        for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY (symbol) SORTED BY (symbol, date) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)


def publish_by_symbol(spark: SparkSession, out_root: str, buckets: int | None = None) -> int:
    """Lay the published fact out by symbol and publish the copy; returns its buckets.

    A build or refresh of the fact withdraws the copy, so a stale one is never read.
    """
    out_root = out_root.rstrip("/")
    fact = read_fact(spark, f"{out_root}/{FACT}")
    buckets = buckets or bucket_count(fact.count())
    path = f"{out_root}/build-{uuid.uuid4().hex}/{BY_SYMBOL}_{buckets}"
    write_by_symbol(fact, path, buckets)
    published.publish(spark, out_root, {BY_SYMBOL: path})
    return buckets


def read_by_symbol(spark: SparkSession, out_root: str) -> DataFrame | None:
    """The fact laid out by symbol; None if there is no copy of the published fact."""
    paths = published.files_of(spark, out_root.rstrip("/"), BY_SYMBOL)
    return table_by_symbol(spark, paths[0], int(paths[0].rsplit("_", 1)[1])) if paths else None


def months_of_latest(counts: DataFrame, n: int) -> list[str]:
    """The months that hold one of the ``n`` latest rows of some symbol (some hundred at most).

    ``counts`` has the rows of each symbol and month; a month counts for a symbol while its
    later months hold fewer than ``n`` rows. A symbol that ended long ago adds its own last
    months, not all months since.
    """
    later = Window.partitionBy("symbol").orderBy(F.desc("month")).rowsBetween(
        Window.unboundedPreceding, -1)
    needed = counts.withColumn("later", F.coalesce(F.sum("rows").over(later), F.lit(0))) \
        .filter(F.col("later") < n).select("month").distinct()
    return sorted(r.month for r in needed.collect())


def read_latest(spark: SparkSession, out_root: str, n: int = 30) -> DataFrame:
    """The months of the published fact that any symbol's ``n`` latest rows lie in: the input of the
    comparison, statistics and VIX queries, which cut it to ``n`` rows a symbol."""
    out_root = out_root.rstrip("/")
    months = months_of_latest(read_mart(spark, out_root, COUNTS), n)
    return read_fact(spark, f"{out_root}/{FACT}", months=months)
