"""Command line for the daily run: ``ingest`` landed files, ``verify`` the raw tables, then
``build`` the marts or ``refresh`` what the new rows change.

    spark-submit --py-files marketlake.zip marketlake/cli.py ingest \\
        --landing <shared>/landing/prices/* --table stock_prices_daily --root <shared>/raw
    spark-submit --py-files marketlake.zip marketlake/cli.py build \\
        --root <shared>/raw --out <shared>/marts --as-of 2024-01-31

Paths are whatever the cluster's file system understands; the stream checkpoints stay with the
raw tables.
"""

from __future__ import annotations

import argparse
import json

from marketlake.schemas import RAW_TABLES
from marketlake.streaming.extract import SHAPES, extract_rows

# Dataset name of each raw table (the run log and watermark keys).
DATASETS = {"stock_prices_daily": "stock_prices", "company_info": "company_info",
            "benchmark_series_daily": "benchmark_series"}


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="marketlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest", help="append newly landed files to a raw table")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--table", required=True, choices=sorted(DATASETS))
    ing.add_argument("--root", required=True, help="folder of the raw and metadata tables")
    ing.add_argument("--format", default="parquet")
    ing.add_argument("--shape", choices=sorted(SHAPES), help="shape of a download; without it the "
                     "files hold rows of the raw table")
    ing.add_argument("--symbols", default="", help="universe of a download, comma-separated")
    ing.add_argument("--start")
    ing.add_argument("--end")
    ing.add_argument("--period", default="max")
    ing.add_argument("--as-of", help="last day of the period")
    ver = sub.add_parser("verify", help="check the raw tables: non-empty, fresh prices")
    ver.add_argument("--root", required=True)
    ver.add_argument("--as-of", required=True, help="evaluation date of the freshness check")
    bld = sub.add_parser("build", help="rebuild staging views, marts and checks")
    bld.add_argument("--root", required=True)
    bld.add_argument("--out", required=True)
    bld.add_argument("--as-of", required=True, help="evaluation date of the freshness check")
    bld.add_argument("--no-fail", action="store_true", help="report failed checks only")
    ref = sub.add_parser("refresh", help="bring built marts up to the raw tables, month by month")
    ref.add_argument("--root", required=True)
    ref.add_argument("--out", required=True)
    ref.add_argument("--overlap-days", type=int, default=1, help="days before the last build's ingest "
                     "mark that are looked at again")
    ref.add_argument("--no-fail", action="store_true", help="report failed checks only")
    args = ap.parse_args(argv)

    from marketlake.session import get_session
    spark = get_session()
    root = args.root.rstrip("/")
    if args.cmd == "ingest":
        from marketlake.streaming.landing import ingest_landed
        dataset = DATASETS[args.table]
        date_col = None if args.table == "company_info" else "date"
        schema, transform = _landed_schema(args.table), None
        if args.shape:
            if SHAPES[args.shape] != args.table:
                ap.error(f"{args.shape} feeds {SHAPES[args.shape]}")
            symbols = [s for s in args.symbols.split(",") if s]
            schema = spark.read.format(args.format).load(args.landing).schema

            def transform(df):
                return extract_rows(df, args.shape, symbols, args.start, args.end, args.period,
                                    args.as_of)
        results = ingest_landed(
            spark, args.landing, schema, f"{root}/{args.table}", dataset,
            runs_path=f"{root}/ingest_runs",
            watermark_root=f"{root}/watermarks" if date_col else None,
            file_format=args.format, date_col=date_col or "date",
            partition_by=[date_col] if date_col else None, transform=transform)
        out = {"batches": results}
    elif args.cmd == "verify":
        out = {"checks": verify_raw(spark, root, args.as_of)}
    elif args.cmd == "refresh":
        from marketlake.plans.refresh import refresh_marts
        out = refresh_marts(spark, root, args.out, args.overlap_days, fail_on_error=not args.no_fail)
    else:
        from marketlake.plans.build import build_marts
        out = build_marts(spark, root, args.out, args.as_of, fail_on_error=not args.no_fail)
    print(json.dumps(out, default=str))
    return out


def verify_raw(spark, root: str, as_of) -> list[dict]:
    """The load verification before the transform: every raw table must hold rows (hard
    failure); prices older than the freshness limit only warn. One pass per table."""
    from marketlake.operators.quality import DataQualityError, check_model
    rows = []
    for table in DATASETS:
        df = spark.read.parquet(f"{root}/{table}")
        fresh = "date" if table == "stock_prices_daily" else None
        part = check_model(df, table, non_empty=True, freshness=fresh, as_of=as_of)
        rows += [r.asDict() for r in part.collect()]  # one row per check
    failed = [r for r in rows if r["status"] == "fail"]
    if failed:
        raise DataQualityError(f"raw tables failed verification: {failed}")
    return rows


def _landed_schema(table: str):
    """A landed extract carries the raw columns except the run id the load stamps."""
    from pyspark.sql import types as T
    return T.StructType([f for f in RAW_TABLES[table].fields if f.name != "source_run_id"])


if __name__ == "__main__":
    main()
