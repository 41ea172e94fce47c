"""SparkSession construction with the settings the library is tuned for."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on; cluster deployments may override the sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # call-site capture costs several JVM round trips per Column function on the driver
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "marketlake",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.

    ``master`` defaults to ``local[$BENCH_CPUS or *]`` only for a plain ``python`` process.
    Under ``spark-submit`` (or a pyspark shell) the launcher has already configured the
    master and it is left alone.
    """
    builder = SparkSession.builder.appName(app_name)
    launched = any(k in os.environ for k in ("PYSPARK_GATEWAY_PORT", "SPARK_MASTER", "MASTER"))
    if master is None and not launched:
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # register the checkpoint folder now when it is known (or local); on a cluster without
    # one, only code that needs a checkpoint (the landing stream) asks for it and fails
    if spark.conf.get("spark.checkpoint.dir", None) or \
            str(spark.sparkContext.master).startswith("local"):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset (local runs and tests) is a
    private scratch folder created and registered with the SparkContext; the setting itself
    is a core config and is never changed at run time.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not str(sc.master).startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset: name a shared folder for the cluster "
                         "(a machine-local folder would not survive a lost driver or executor)")
    local = tempfile.mkdtemp(prefix="marketlake-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scale_conf(shuffle_bytes: int, partition_bytes: int = 256 << 20,
               min_partitions: int = 16) -> dict:
    """Shuffle sizing for a run whose largest exchange moves about ``shuffle_bytes``.

    The first exchange of the price dedup carries roughly the projected raw columns (the
    map-side partial top-1 removes only versions that meet in one split), so size from that:
    one reducer per ``partition_bytes`` keeps every sort in memory or in a few spills. AQE
    starts from this count and coalesces the later, smaller exchanges (per-symbol windows,
    pivots, dimensions) toward the same advisory size; skewed partitions are split.

    Example: 100 TB raw, ~35% surviving projection -> ~35 TB -> ~130k partitions of 256 MiB.
    """
    n = max(min_partitions, -(-int(shuffle_bytes) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
