"""Domain raw tables derived from the driver tables (FIXTURES.md section 3).

``events`` plays both the price ticks and the benchmark ticks, ``customer`` x ``nation`` the
company snapshots, ``lineitem`` x ``part`` a long price history. The same expressions are
written in DuckDB SQL in ``plans.oracle`` so both engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.sources.tables import read_table

# Benchmark series played by each driver event type.
EVENT_TYPE_SERIES = [
    ("view", "^GSPC"),
    ("error", "^VIX"),
    ("click", "^TNX"),
    ("purchase", "XLK"),
    ("signup", "XLF"),
]

# Ingest time of the current company snapshot; the older snapshot is one day earlier.
COMPANY_SNAPSHOT_TS = "2024-02-01 00:00:00"


def run_id_of(event_id) -> F.Column:
    """A per-row run id whose lexical order follows ``event_id`` (tie-break key)."""
    return F.concat(F.lit("run_"), F.lpad(F.col(event_id).cast("string"), 12, "0"))


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stock_prices_daily`` rows: one per event (about 2.5 versions per symbol and day)."""
    ev = read_table(spark, sf_dir, "events")
    v = F.col("value")
    return ev.select(
        F.col("user_id").alias("symbol"),
        F.to_date("ts").alias("date"),
        (v * F.lit(0.5)).alias("open"),
        (v * F.lit(1.25)).alias("high"),
        (v * F.lit(0.75)).alias("low"),
        v.alias("close"),
        v.alias("adj_close"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        F.col("ts").alias("ingested_at"),
        run_id_of("event_id").alias("source_run_id"),
    )


def raw_benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``benchmark_series_daily`` rows: every event is a tick of its type's series."""
    ev = read_table(spark, sf_dir, "events")
    series = None
    for etype, ticker in EVENT_TYPE_SERIES:
        cond = F.col("event_type") == F.lit(etype)
        series = F.when(cond, ticker) if series is None else series.when(cond, ticker)
    return ev.select(
        series.alias("series_ticker"),
        F.to_date("ts").alias("date"),
        F.col("value"),
        F.col("ts").alias("ingested_at"),
        run_id_of("event_id").alias("source_run_id"),
    )


# Company attributes the fixture has no source for: typed NULLs, in table order.
_COMPANY_NULLS = (
    [("enterprise_value", "BIGINT")]
    + [(c, "DOUBLE") for c in (
        "pe_ratio", "forward_pe", "peg_ratio", "price_to_book", "dividend_yield", "beta",
        "fifty_two_week_high", "fifty_two_week_low", "fifty_day_average",
        "two_hundred_day_average")]
    + [("shares_outstanding", "BIGINT"), ("float_shares", "BIGINT"), ("employees", "INT")]
    + [(c, "STRING") for c in ("country", "city", "website", "business_summary")]
)


def _company_snapshot(acctbal: str, ingested_at: str, run_id: str, error: str) -> str:
    fields = [("symbol", "c_custkey"), ("company_name", "c_name"),
              ("sector", "c_mktsegment"), ("industry", "n_name"),
              ("market_cap", f"CAST(round({acctbal} * 100.0D) AS BIGINT) * 300000")]
    fields += [(c, f"CAST(NULL AS {t})") for c, t in _COMPANY_NULLS]
    fields += [("ingested_at", ingested_at), ("source_run_id", f"'{run_id}'"),
               ("error", error)]
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields) + ")"


def raw_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``company_info`` rows: two snapshots per customer, emitted from one scan.

    The current snapshot carries an error for a negative balance; the older one (balance
    halved, one day earlier) is clean, so a failed refresh falls back to it.
    """
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    # nation is a fixed 25-row reference table; the planner broadcasts it by file size.
    cn = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    ts = f"TIMESTAMP_NTZ '{COMPANY_SNAPSHOT_TS}'"
    current = _company_snapshot("c_acctbal", ts, "run_company_2",
                                "CASE WHEN c_acctbal < 0 THEN 'negative balance' END")
    older = _company_snapshot("(c_acctbal / 2.0D)", f"{ts} - INTERVAL 1 DAY", "run_company_1",
                              "CAST(NULL AS STRING)")
    return cn.selectExpr(f"inline(array({current}, {older}))")


# Tie-break columns of the long history, unique within a brand and day.
LONG_HISTORY_TIE = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"]


def raw_long_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long price history: brand = symbol, ship date = trading day, unit price = close.

    Many lines per brand and day, so the latest-wins dedup works on a deep history
    (thousands of dates per symbol) with a few very hot symbols.
    """
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    j = li.join(part, li["l_partkey"] == part["p_partkey"], "inner")
    close = F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))
    return j.select(
        F.col("p_brand").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        (close * F.lit(0.5)).alias("open"),
        (close * F.lit(1.25)).alias("high"),
        (close * F.lit(0.75)).alias("low"),
        close.alias("close"),
        close.alias("adj_close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.col("l_shipdate").alias("ingested_at"),
        F.concat(F.lit("run_"), F.col("l_orderkey").cast("string")).alias("source_run_id"),
        *LONG_HISTORY_TIE,
    )


# --- wide downloads, documents, lists ------------------------------------------------------
def wide_daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide multi-ticker download: one row per date, one OHLCV struct per event type.

    Each block is the newest event of that type on that day (the whole events table is
    deduplicated); the pivot has one output row per date, so it stays small.
    """
    from marketlake.operators.dedup import latest_version
    from marketlake.sources.reshape import WIDE_FIELDS

    ev = read_table(spark, sf_dir, "events")
    base = ev.select(F.col("event_type").alias("ticker"), F.to_date("ts").alias("Date"),
                     "value", "props", "ts", "event_id")
    latest = latest_version(base, ["ticker", "Date"], "ts", ["event_id"])
    v = F.col("value")
    fields = [v * F.lit(0.5), v * F.lit(1.25), v * F.lit(0.75), v, v,
              F.get_json_object("props", "$.k").cast("bigint")]
    bars = latest.select("ticker", "Date", F.struct(*[e.alias(n) for e, n in
                                                      zip(fields, WIDE_FIELDS)]).alias("bar"))
    tickers = [t for t, _ in EVENT_TYPE_SERIES]
    return bars.groupBy("Date").pivot("ticker", tickers).agg(F.first("bar"))


# Tickers requested from the wide download: every event type plus one that is not there.
WIDE_REQUEST = [t for t, _ in EVENT_TYPE_SERIES] + ["delisted"]


def company_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile document per customer: ``(symbol, doc, ingested_at)``.

    Shapes by segment: AUTOMOBILE lacks longName (shortName is used), BUILDING lacks both
    names (the symbol is used), FURNITURE has an explicit ``"longName": null``; a negative
    balance gives a truncated, malformed document.
    """
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    cn = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    seg = F.col("c_mktsegment")
    body = [
        F.col("c_mktsegment").alias("sector"), F.col("n_name").alias("industry"),
        (F.round(F.col("c_acctbal") * F.lit(100.0)).cast("bigint") * F.lit(300000)).alias("marketCap"),
        (F.col("c_acctbal") / F.lit(100.0)).alias("trailingPE"),
        (F.col("c_nationkey") * F.lit(1000)).alias("fullTimeEmployees"),
        F.col("n_name").alias("country"),
    ]
    short = F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("shortName")
    full = F.to_json(F.struct(F.col("c_name").alias("longName"), short, *body))
    no_long = F.to_json(F.struct(short, *body))
    no_names = F.to_json(F.struct(*body))
    null_long = F.to_json(F.struct(F.lit(None).cast("string").alias("longName"), short, *body),
                          {"ignoreNullFields": "false"})
    broken = F.concat(F.lit('{"longName": "'), F.col("c_name"), F.lit('"'))
    doc = (F.when(F.col("c_acctbal") < 0, broken)
            .when(seg == "AUTOMOBILE", no_long)
            .when(seg == "BUILDING", no_names)
            .when(seg == "FURNITURE", null_long)
            .otherwise(full))
    return cn.select(F.col("c_custkey").alias("symbol"), doc.alias("doc"),
                     F.to_timestamp_ntz(F.lit(COMPANY_SNAPSHOT_TS)).alias("ingested_at"))


def event_crew_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-element JSON list of ``{craft, name}`` per event: ``(event_id, crew)``."""
    ev = read_table(spark, sf_dir, "events")
    crew = F.to_json(F.array(
        F.struct(F.col("event_type").alias("craft"),
                 F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name")),
        F.struct(F.col("event_type").alias("craft"),
                 F.concat(F.lit("event-"), F.col("event_id").cast("string")).alias("name")),
    ))
    return ev.select("event_id", crew.alias("crew"))


# --- two sequential loads ------------------------------------------------------------------
# The price history is loaded in two runs: everything up to and including this date, then
# the rest. Together they cover the whole table.
FIRST_LOAD_THROUGH = "2024-01-15"


def watermark_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(state after the first run, updates of the second run), from the raw tables.

    First run: ``stock_prices`` and ``benchmark_series``. Second run: ``stock_prices``
    (update) and ``company_info`` (insert); ``benchmark_series`` is untouched.
    """
    from marketlake.sinks.raw_store import batch_watermarks

    cut = F.to_date(F.lit(FIRST_LOAD_THROUGH))
    p = raw_prices(spark, sf_dir).withColumn("dataset", F.lit("stock_prices"))
    b = raw_benchmarks(spark, sf_dir).withColumn("dataset", F.lit("benchmark_series"))
    first_rows = (p.filter(F.col("date") <= cut).select("dataset", "date", "ingested_at")
                  .unionByName(b.filter(F.col("date") <= cut)
                               .select("dataset", "date", "ingested_at")))
    first = batch_watermarks(first_rows, "dataset")
    comp = raw_company(spark, sf_dir).select(
        F.lit("company_info").alias("dataset"), F.to_date("ingested_at").alias("date"),
        "ingested_at")
    second_rows = (p.filter(F.col("date") > cut).select("dataset", "date", "ingested_at")
                   .unionByName(comp))
    return first, batch_watermarks(second_rows, "dataset")


def ingest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ``ingest_runs`` log for the fixture: one completed run per dataset and ingestion
    day (the daily load of the reference), with the rows it loaded.

    Grouping by (dataset, day) combines map-side to a few rows per task, so the log costs
    one pass over the raw tables however many rows they hold.
    """
    def runs(df: DataFrame, dataset: str, table: str) -> DataFrame:
        day = F.to_date("ingested_at")
        return df.groupBy(day.alias("day")).agg(
            F.max("ingested_at").alias("run_timestamp"),
            F.count(F.lit(1)).alias("records_loaded"),
        ).select(
            F.concat(F.lit("run_"), F.date_format("day", "yyyyMMdd"), F.lit(f"_{dataset}"))
             .alias("run_id"),
            F.lit(dataset).alias("dataset_name"), F.lit(table).alias("table_name"),
            "run_timestamp", "records_loaded",
            F.lit("completed").alias("status"), F.lit(None).cast("string").alias("error_message"),
        )
    return runs(raw_prices(spark, sf_dir), "stock_prices", "stock_prices_daily").unionByName(
        runs(raw_benchmarks(spark, sf_dir), "benchmark_series", "benchmark_series_daily"))


# --- a second load that corrects the first ---------------------------------------------------
# Rows that arrive from here on are the second load.
SECOND_LOAD_FROM = "2024-01-16 00:00:00"


def _corrections(raw: DataFrame) -> DataFrame:
    """Every tenth event is about a day ten days before it arrives: a late correction."""
    n = F.regexp_extract("source_run_id", r"(\d+)", 1).cast("bigint")
    return raw.withColumn("date", F.when(n % 10 == 0, F.date_sub("date", 10)).otherwise(F.col("date")))


def corrected_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw prices of both loads, late corrections included."""
    return _corrections(raw_prices(spark, sf_dir))


def corrected_benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corrections(raw_benchmarks(spark, sf_dir))


def first_load(raw: DataFrame) -> DataFrame:
    """What had arrived before the second load."""
    return raw.filter(F.col("ingested_at") < F.lit(SECOND_LOAD_FROM).cast("timestamp_ntz"))


def first_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The company snapshots before the second load, which brings those of every seventh symbol."""
    return raw_company(spark, sf_dir).filter(
        (F.col("source_run_id") == "run_company_1") | (F.col("symbol") % 7 != 0))


# --- inputs that make every operator do something --------------------------------------------
# Days that bring the end of the long history to 2024-01-20, into the events' month.
LONG_SHIFT_DAYS = 8112


def shifted_long_prices(spark: SparkSession, sf_dir: str, by_part: bool = False) -> DataFrame:
    """The long history moved so that only its last days have benchmark rows.

    With ``by_part`` the symbol is the part number: those below the number of customers have a
    company, the others none.
    """
    raw = raw_long_prices(spark, sf_dir)
    if by_part:
        li = read_table(spark, sf_dir, "lineitem")
        close = F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))
        raw = li.select(
            F.col("l_partkey").alias("symbol"), F.to_date("l_shipdate").alias("date"),
            (close * F.lit(0.5)).alias("open"), (close * F.lit(1.25)).alias("high"),
            (close * F.lit(0.75)).alias("low"), close.alias("close"), close.alias("adj_close"),
            F.col("l_quantity").cast("bigint").alias("volume"),
            F.col("l_shipdate").alias("ingested_at"),
            F.concat(F.lit("run_"), F.col("l_orderkey").cast("string")).alias("source_run_id"),
            *LONG_HISTORY_TIE)
    return raw.withColumn("date", F.date_add("date", LONG_SHIFT_DAYS))


def prices_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw prices in which every seventh event has no close and every fourth a close of 0."""
    n = F.regexp_extract("source_run_id", r"(\d+)", 1).cast("bigint")
    return raw_prices(spark, sf_dir).withColumn(
        "close", F.when(n % 7 == 0, F.lit(None)).when(n % 4 == 0, F.lit(0.0)).otherwise(F.col("close")))


def wide_bars_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide download with NaN closes every third day and no volume every fifth."""
    wide = wide_daily_bars(spark, sf_dir)
    day = F.dayofmonth("Date")
    for ticker, _ in EVENT_TYPE_SERIES:
        bar = F.col(ticker)
        wide = wide.withColumn(ticker, bar.withField(
            "Close", F.when(day % 3 == 0, F.lit(float("nan"))).otherwise(bar["Close"])).withField(
            "Volume", F.when(day % 5 == 0, F.lit(None)).otherwise(bar["Volume"])))
    return wide


def flat_download(spark: SparkSession, sf_dir: str, ticker: str) -> DataFrame:
    """The one-ticker form of the wide download: flat columns."""
    from marketlake.sources.reshape import WIDE_FIELDS
    wide = wide_daily_bars(spark, sf_dir)
    return wide.where(F.col(ticker).isNotNull()).select(
        "Date", *[F.col(ticker)[f].alias(f) for f in WIDE_FIELDS])


def number_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per customer whose numbers are written in the forms JSON producers use."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey").cast("string")
    cap = (F.col("c_custkey").cast("bigint") * 1_000_000).cast("string")
    forms = [
        F.concat(F.lit('{"marketCap": '), cap, F.lit('.0, "fullTimeEmployees": '), k, F.lit(".0}")),
        F.concat(F.lit('{"marketCap": '), k, F.lit("e6}")),
        F.concat(F.lit('{"marketCap": "'), cap, F.lit('"}')),
        F.lit('{"marketCap": "n/a", "sector": "S"}'),
        F.lit('{"marketCap": NaN}'),
        F.concat(F.lit('{"fullTimeEmployees": '), k, F.lit('.5, "marketCap": '), cap, F.lit("}")),
        F.lit('{"marketCap": null}'),
    ]
    doc = F.concat(F.lit('{"marketCap": '), cap, F.lit("}"))
    for i, form in reversed(list(enumerate(forms))):
        doc = F.when(F.col("c_custkey") % 8 == i, form).otherwise(doc)
    return c.select(F.col("c_custkey").alias("symbol"), doc.alias("doc"),
                    F.to_timestamp_ntz(F.lit(COMPANY_SNAPSHOT_TS)).alias("ingested_at"))
