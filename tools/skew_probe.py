"""Measure how the latest-wins dedup handles a hot symbol, from Spark's event log.

    python tools/skew_probe.py [--sf /root/testdata/sf0.1]

The price fixture is re-keyed so that one symbol holds about 40% of all raw rows (every
'view' and 'click' event), with hundreds of versions per day. The staged prices are
computed twice, each executed through the noop sink:

* ``marketlake``: the library plan (partial top-1 per (symbol, date) before an exchange
  on (symbol, date), then the per-symbol windows);
* ``naive``: the same model after ``repartition("symbol")``, i.e. one exchange on the
  symbol with no map-side reduction.

For every shuffle-reading stage it prints the records read by the busiest task and by all
tasks. The event log goes to a fresh scratch folder.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    from pyspark.sql import functions as F

    from marketlake.plans import staging
    from marketlake.session import get_session
    from marketlake.sources import fixtures as fx

    log_dir = tempfile.mkdtemp(prefix="skew-probe-")
    spark = get_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        # keep the exchanges as planned, so task sizes show the partitioning itself
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false"})
    ev = spark.read.parquet(f"{args.sf}/events.parquet")
    hot = ev.filter(F.col("event_type").isin("view", "click")).count() / ev.count()
    raw = fx.raw_prices(spark, args.sf)
    events_type = ev.select(fx.run_id_of("event_id").alias("source_run_id"), "event_type")
    skewed = raw.join(events_type, "source_run_id").withColumn(
        "symbol", F.when(F.col("event_type").isin("view", "click"), F.lit(-1))
                   .otherwise(F.col("symbol"))).drop("event_type")
    skewed.write.mode("overwrite").parquet(f"{log_dir}/skewed_raw")
    base = spark.read.parquet(f"{log_dir}/skewed_raw")
    n_raw = base.count()
    runs = {"marketlake": staging.stg_stock_prices(base),
            "naive": staging.stg_stock_prices(base.repartition("symbol"))}
    for name, df in runs.items():
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    log = [p for p in glob.glob(f"{log_dir}/*") if os.path.isfile(p) and "local-" in p][0]
    stage_job, tasks = {}, {}
    for line in open(log):
        e = json.loads(line)
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description")
            for sid in e["Stage IDs"]:
                stage_job[sid] = desc
        elif kind == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            rd = m.get("Shuffle Read Metrics") or {}
            n = rd.get("Total Records Read", 0)
            tasks.setdefault(e["Stage ID"], []).append(n)
    print(f"hot symbol share of raw rows: {hot:.1%}; raw rows: {n_raw}")
    print(f"{'plan':12s} {'stage':>5s} {'tasks':>5s} {'max task records':>17s} {'all records':>12s}")
    for sid in sorted(tasks):
        desc = stage_job.get(sid)
        recs = tasks[sid]
        if desc in runs and sum(recs) > 0:
            print(f"{desc:12s} {sid:5d} {len(recs):5d} {max(recs):17d} {sum(recs):12d}")


if __name__ == "__main__":
    main()
