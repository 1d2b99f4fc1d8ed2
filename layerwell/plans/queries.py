"""Registered queries: the library's operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from layerwell.functions.dates import month_start_from_name, parse_compact_date
from layerwell.functions.text import normalize_strings
from layerwell.operators import quality as dq
from layerwell.operators.dedup import keep_latest
from layerwell.operators.lineage import (
    BRONZE_INGESTED_AT,
    SILVER_INGESTED_AT,
    add_bronze_lineage,
    add_silver_lineage,
)
from layerwell.operators.schema import enforce_schema, rejected_values, rename_columns
from layerwell.operators.selection import newest, within
from layerwell.plans.builders import (
    combined_monthly,
    compact_dates,
    daily_event_metrics,
    month_names,
    monthly_event_metrics,
    monthly_totals,
)
from layerwell.plans.packing import workbook_batches, zip_batches
from layerwell.plans.refresh import Lake, Run, bad_lines, build_gold, refresh_bronze, refresh_silver, run_all
from layerwell.plans.registry import Registry
from layerwell.session import scratch_path
from layerwell.sinks.appends import append_rows
from layerwell.sinks.audit import append_files, file_table
from layerwell.sinks.parquet import merge_partitions, stage, write_partitions, write_table
from layerwell.sources.delimited import parse_zipped_delimited, read_delimited
from layerwell.sources.listing import expected_files, files_to_acquire, new_files, source_key
from layerwell.sources.manifest import load_manifest, record_files
from layerwell.sources.table_log import table_state
from layerwell.sources.tables import read_partition, read_snapshot, read_table, read_window
from layerwell.sources.workbook import parse_workbooks
from layerwell.spec import PipelineConfig, TableSpec
from layerwell.streaming.ingest import stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_ID = "20240201_000000"
CLOCK = datetime(2024, 2, 1, tzinfo=timezone.utc)

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "order_day"]
ORDER_TYPES = {
    "o_orderkey": "int64",
    "o_custkey": "int64",
    "o_orderstatus": "string",
    "o_totalprice": "float64",
    "order_day": "date",
}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query; instants are read and shown in UTC."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        QUERIES[name] = run
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ----------------------------------------------------------- views of the tables


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day, with the number in their properties."""
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"),
        "event_id",
        "user_id",
        "event_type",
        hundredths("value").alias("cents"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("prop"),
    )


EVENT_MEASURES = {
    "key": "event_id",
    "means": {"cents": "mean_cents", "prop": "mean_prop"},
    "sums": {"cents": "sum_cents"},
}


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by day; they span many months."""
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("day"), "o_orderkey", hundredths("o_totalprice").alias("cents")
    )


ORDER_MEASURES = {
    "key": "o_orderkey",
    "means": {"cents": "mean_cents"},
    "sums": {"cents": "sum_cents"},
}


def order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per nation, market segment and month."""
    # Counting before the joins leaves one row per customer and month, so that a
    # customer with very many orders cannot overload a join task.
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", month_of("o_orderdate").alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"), "month")
        .agg(F.sum("orders").alias("orders"))
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        F.to_date("o_orderdate").alias("order_day"),
    )


def month_of(column: str):
    return F.to_date(F.date_trunc("month", column))


def year_of(column: str):
    return F.to_date(F.date_trunc("year", column))


def hundredths(column: str):
    """A two-decimal amount as an integer, whose mean is the same in any order."""
    return F.round(F.col(column) * 100).cast("bigint")


# ------------------------------------------------------------- rollups and joins


@query("feed_daily")
def feed_daily(spark, sf_dir):
    build = daily_event_metrics("events", **EVENT_MEASURES, date_column="day")
    return build({"events": event_feed(spark, sf_dir)})


@query("feed_daily_unique_ids")
def feed_daily_unique_ids(spark, sf_dir):
    """As ``feed_daily`` where ids are known to be unique per day."""
    build = daily_event_metrics("events", **EVENT_MEASURES, date_column="day", ids_are_unique=True)
    return build({"events": event_feed(spark, sf_dir)})


@query("feed_monthly")
def feed_monthly(spark, sf_dir):
    build = monthly_event_metrics("events", **EVENT_MEASURES, date_column="day", result="month")
    months = build({"events": event_feed(spark, sf_dir)})
    return months.withColumn("month", F.to_date("month"))


@query("orders_monthly")
def orders_monthly(spark, sf_dir):
    build = monthly_event_metrics("orders", **ORDER_MEASURES, date_column="day", result="month")
    months = build({"orders": order_feed(spark, sf_dir)})
    return months.withColumn("month", F.to_date("month"))


@query("counts_monthly")
def counts_monthly(spark, sf_dir):
    build = monthly_totals("counts", "orders", "month", "orders")
    return build({"counts": order_counts(spark, sf_dir)})


@query("combined_monthly")
def combined_monthly_report(spark, sf_dir):
    """Order metrics next to shipment counts; months of either side stay."""
    orders = orders_monthly(spark, sf_dir)
    items = table(spark, sf_dir, "lineitem").select(
        month_of("l_shipdate").alias("month"), F.lit(1).alias("items")
    )
    shipped = monthly_totals("items", "items", "month", "items")({"items": items})
    build = combined_monthly(
        "orders",
        "shipped",
        {"total_events": "orders", "mean_cents": "mean_order_cents"},
        {"items": "shipped_items"},
        key="month",
    )
    return build({"orders": orders, "shipped": shipped})


# ----------------------------------------------------------------- keep latest


@query("dedup_latest")
def dedup_latest(spark, sf_dir):
    return keep_latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts")


@query("dedup_lineitem")
def dedup_lineitem(spark, sf_dir):
    return keep_latest(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate"
    )


# ------------------------------------------------------------ partitioned tables


def _shipping_summary(spark, sf_dir):
    """One row per order that has shipped, dated by its last shipment."""
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.to_date(F.max("l_shipdate")).alias("version"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return shipped.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_key"),
        "version",
        F.lit("shipped").alias("status"),
        F.col("o_custkey").alias("customer"),
        year_of("o_orderdate").alias("year"),
    )


def _order_rows(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.to_date("o_orderdate").alias("version"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").alias("customer"),
        year_of("o_orderdate").alias("year"),
    )


def _merged_orders(spark, sf_dir, on_tie):
    path = scratch_path(spark, "merge")
    write_partitions(_shipping_summary(spark, sf_dir), path, ["year"])
    merge_partitions(
        _order_rows(spark, sf_dir), path, ["year"], ["order_key"], "version", on_tie=on_tie
    )
    return read_table(spark, path)


@query("partition_merge")
def partition_merge(spark, sf_dir):
    return _merged_orders(spark, sf_dir, "existing")


@query("partition_merge_incoming_wins")
def partition_merge_incoming_wins(spark, sf_dir):
    return _merged_orders(spark, sf_dir, "incoming")


@query("partition_overwrite")
def partition_overwrite(spark, sf_dir):
    """Restate the newest year; the other partitions stay as they are."""
    path = scratch_path(spark, "overwrite")
    rows = _order_rows(spark, sf_dir)
    write_partitions(rows, path, ["year"])
    restated = newest(rows, "year").withColumn("status", F.lit("restated"))
    write_partitions(restated, path, ["year"])
    return read_table(spark, path)


@query("append_incremental")
def append_incremental(spark, sf_dir):
    """Two deliveries and an empty run through a streaming upsert."""
    root = scratch_path(spark, "append")
    items = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    landing, target = f"{root}/landing", f"{root}/table"
    first = F.coalesce(F.col("l_linestatus") == "F", F.lit(False))
    for delivery in (first, ~first, None):
        if delivery is not None:
            items.where(delivery).write.mode("append").parquet(landing)
        stream_upsert(
            spark.readStream.schema(items.schema).parquet(landing),
            target,
            ["l_returnflag"],
            ["l_orderkey", "l_linenumber"],
            "l_shipdate",
            f"{root}/checkpoint",
        )
    return read_table(spark, target)


@query("partition_read")
def partition_read(spark, sf_dir):
    path = scratch_path(spark, "partition")
    items = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    write_partitions(items, path, ["l_returnflag"])
    rows, _files = read_partition(spark, path, items.schema, {"l_returnflag": "R"})
    return rows


@query("table_replace")
def table_replace(spark, sf_dir):
    """Replace a table, then read some of its columns and rows."""
    path = scratch_path(spark, "replace")
    documents = table(spark, sf_dir, "documents")
    write_table(documents, path)
    write_table(documents.withColumn("lang", F.upper("lang")), path)
    return read_table(spark, path, ["doc_id", "lang", "text"], F.col("n_chars") > 1000)


@query("table_replace_interrupted")
def table_replace_interrupted(spark, sf_dir):
    """A table after a replacing write that failed on some rows, and after the
    next run of it."""
    path = scratch_path(spark, "interrupted")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    write_table(parts, path)
    renamed = parts.withColumn("p_name", F.upper("p_name"))
    broken = F.when(F.col("p_partkey") % 50 == 7, F.raise_error(F.lit("interrupted"))).otherwise(F.col("p_name"))
    try:
        write_table(renamed.withColumn("p_name", broken.cast("string")), path)
    except PySparkException as failure:
        if "interrupted" not in str(failure):
            raise
    kept = stage(read_table(spark, path).withColumn("run", F.lit("failed")))
    write_table(renamed, path)
    return kept.unionByName(read_table(spark, path).withColumn("run", F.lit("repeated")))


@query("evolved_table")
def evolved_table(spark, sf_dir):
    """Years of orders, of which the later ones have a column more, merged into
    one table and read in a window that covers both."""
    path = scratch_path(spark, "evolved")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("version"), "o_orderpriority", year_of("o_orderdate").alias("year")
    )
    late = F.col("year") >= date(1997, 1, 1)
    for batch in (orders.where(~late).drop("o_orderpriority"), orders.where(late)):
        merge_partitions(batch, path, ["year"], ["o_orderkey"], "version")
    return read_window(spark, path, "year", date(1995, 1, 1), date(1998, 1, 1))


@query("window_filter")
def window_filter(spark, sf_dir):
    return within(event_feed(spark, sf_dir), "day", date(2024, 1, 5), date(2024, 1, 20))


@query("window_read")
def window_read(spark, sf_dir):
    """The same window on a table partitioned by day."""
    path = scratch_path(spark, "window")
    write_partitions(event_feed(spark, sf_dir), path, ["day"])
    return read_window(spark, path, "day", date(2024, 1, 5), date(2024, 1, 20))


@query("snapshot_read")
def snapshot_read(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    write_table(order_counts(spark, sf_dir).withColumn("snapshot", F.lit(RUN_ID)), path)
    return read_snapshot(
        spark, path, "snapshot", "month", date(1996, 1, 1), date(1999, 6, 1)
    )


@query("latest_snapshot")
def latest_snapshot(spark, sf_dir):
    return newest(_order_rows(spark, sf_dir), "year")


# ------------------------------------------------------------- files and manifests


@query("new_files")
def new_files_listed(spark, sf_dir):
    """Documents are the listing, labels the manifest of what was processed."""
    listing = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("docs/"), F.col("doc_id")).alias("path"), "n_chars"
    )
    manifest = table(spark, sf_dir, "labels").select(
        F.concat(F.lit("docs/"), F.col("doc_id")).alias("path")
    )
    return new_files(listing, manifest)


@query("manifest_union")
def manifest_union(spark, sf_dir):
    """Recording overlapping sets of files keeps one entry per file."""
    path = scratch_path(spark, "manifest")
    for name in ("labels", "documents"):
        files = table(spark, sf_dir, name).select(
            F.concat(F.lit("docs/"), F.col("doc_id"), F.lit(".txt.gz")).alias("path"),
            source_key(F.concat(F.col("doc_id"), F.lit(".txt.gz"))).alias("source_key"),
            F.lit(CLOCK).alias("modified_at"),
        )
        record_files(files, path, f"run-{name}", CLOCK)
    return load_manifest(spark, path).select("path", "source_key", "run_id")


@query("expected_files")
def files_expected(spark, sf_dir):
    """Daily files of a window that have not arrived; events tell which did."""
    expected = expected_files(
        spark,
        date(2023, 12, 28),
        date(2024, 2, 10),
        "{year}{month:02d}{day:02d}.export.csv.zip",
        "https://files.example.org/feed",
    )
    present = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("source_key")
    )
    return files_to_acquire(expected, present)


# ------------------------------------------------------------ columns and schemas


@query("parse_ymd")
def parse_compact_dates(spark, sf_dir):
    digits = F.date_format("ts", "yyyyMMdd")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("x"), digits))
        .when(F.col("event_type") == "view", F.substring(digits, 1, 7))
        .otherwise(digits)
    )
    return table(spark, sf_dir, "events").select(
        "event_id", F.to_date(parse_compact_date(text)).alias("event_date")
    )


@query("parse_month_name")
def parse_month_names(spark, sf_dir):
    name = F.date_format("o_orderdate", "MMMM")
    text = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("No"), name))
        .when(F.col("o_orderstatus") == "F", F.lower(name))
        .otherwise(name)
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date(month_start_from_name(text, F.year("o_orderdate"))).alias("month_start_date"),
    )


CAST_TYPES = {
    "event_id": "string",
    "digits": "Int64",
    "event_type": "Int64",
    "value": "Int64",
    "stamp": "datetime64[ns]",
    "absent": "Float64",
}


def _castable(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.regexp_extract("props", "([0-9]+)", 1).alias("digits"),
        "event_type",
        "value",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        "user_id",
    )


@query("cast_to_schema")
def cast_to_schema(spark, sf_dir):
    return enforce_schema(_castable(spark, sf_dir), CAST_TYPES).withColumn(
        "stamp", F.col("stamp").cast("timestamp_ntz")
    )


@query("cast_null_column")
def cast_null_column(spark, sf_dir):
    """Columns with any value that cannot be cast become null as a whole."""
    return enforce_schema(
        _castable(spark, sf_dir), CAST_TYPES, on_error="null_column"
    ).withColumn("stamp", F.col("stamp").cast("timestamp_ntz"))


DATE_FORMATS = ("MM/dd/yyyy", "dd.MM.yyyy")
DATED_TYPES = {"o_orderkey": "Int64", "day": "date", "amount": "Int64"}


def _order_dates_as_text(spark, sf_dir):
    """Days as four kinds of text, one of which no format fits; whole amounts and others."""
    day = F.col("o_orderdate")
    kinds = [F.date_format(day, p) for p in (*DATE_FORMATS, "yyyy-MM-dd", "yyyyMM'th'")]
    text = reduce(lambda rest, k: F.when(F.col("o_orderkey") % 4 == k, kinds[k]).otherwise(rest), range(3), kinds[3])
    amount = F.when(F.col("o_orderkey") % 5 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day"), amount.alias("amount"))


@query("cast_formats")
def cast_formats(spark, sf_dir):
    """Text in several date formats, which are tried in order."""
    return enforce_schema(_order_dates_as_text(spark, sf_dir), DATED_TYPES, formats={"day": DATE_FORMATS})


@query("rejected_values")
def rejected(spark, sf_dir):
    """The cells that the declared types turn into null, by column and value."""
    return rejected_values(_order_dates_as_text(spark, sf_dir), DATED_TYPES, {"day": DATE_FORMATS})


@query("normalize_strings")
def normalized_strings(spark, sf_dir):
    padded = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit(" \t"), F.col("c_name"), F.lit("\n ")).alias("c_name"),
        F.concat(F.col("c_mktsegment"), F.lit("  ")).alias("c_mktsegment"),
    )
    return normalize_strings(padded)


@query("rename_prune")
def rename_prune(spark, sf_dir):
    spec = TableSpec.from_mapping(
        "customers",
        {
            "columns": {
                "customer_id": {"source": "c_custkey", "type": "int64"},
                "customer_name": {"source": "c_name", "type": "string"},
                "balance": {"source": "c_acctbal", "type": "float64"},
                "phone": {"source": "c_phone", "type": "string"},
            }
        },
    )
    renamed = rename_columns(table(spark, sf_dir, "customer"), spec)
    return enforce_schema(renamed, spec.dtypes)


@query("lineage_bronze")
def lineage_bronze(spark, sf_dir):
    rows = add_bronze_lineage(
        table(spark, sf_dir, "customer"), "customers", "customer.parquet", RUN_ID, CLOCK
    )
    return rows.withColumn(BRONZE_INGESTED_AT, F.col(BRONZE_INGESTED_AT).cast("timestamp_ntz"))


@query("lineage_silver")
def lineage_silver(spark, sf_dir):
    bronze = add_bronze_lineage(
        table(spark, sf_dir, "customer"), "customers", "customer.parquet", "bronze-1", CLOCK
    )
    silver = add_silver_lineage(
        bronze.drop("_source_name", "_source_file"), RUN_ID, CLOCK + timedelta(hours=1)
    )
    return silver.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in (BRONZE_INGESTED_AT, SILVER_INGESTED_AT)}
    )


# --------------------------------------------------------------------- quality


def _check(df: DataFrame, *checks: dq.Check) -> DataFrame:
    return dq.run_checks(df, list(checks)).drop("detail")


@query("dq_nulls")
def dq_nulls(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return _check(
        documents.join(labels, "doc_id", "left"), dq.not_null("quality"), dq.not_null("lang")
    )


@query("dq_pk_duplicates")
def dq_pk_duplicates(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return dq.key_uniqueness(items, ["l_orderkey", "l_linenumber"]).drop("detail")


@query("dq_pk_duplicate_rows")
def dq_pk_duplicate_rows(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return dq.duplicate_rows(items, ["l_orderkey", "l_linenumber"])


@query("dq_range")
def dq_range(spark, sf_dir):
    return _check(table(spark, sf_dir, "events"), dq.value_range("value", 10.0, 100.0))


@query("dq_categories")
def dq_categories(spark, sf_dir):
    return _check(
        table(spark, sf_dir, "events"), dq.valid_categories("event_type", ["click", "view"])
    )


@query("dq_format")
def dq_format(spark, sf_dir):
    return _check(
        table(spark, sf_dir, "customer"), dq.string_format("c_name", r"Customer#\d{6}[0-4]")
    )


@query("dq_negative")
def dq_negative(spark, sf_dir):
    return _check(table(spark, sf_dir, "customer"), dq.not_negative("c_acctbal"))


@query("dq_coverage")
def dq_coverage(spark, sf_dir):
    return dq.missing_days(
        table(spark, sf_dir, "events"), "ts", date(2024, 1, 1), date(2024, 2, 2)
    )


@query("dq_gaps")
def dq_gaps(spark, sf_dir):
    """Days without an event, per user and kind of event."""
    return dq.gaps_per_entity(
        table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", date(2024, 1, 3), date(2024, 1, 28)
    )


@query("dq_future")
def dq_future(spark, sf_dir):
    return _check(
        table(spark, sf_dir, "events"), dq.no_future_dates("ts", datetime(2024, 1, 20, 12))
    )


@query("dq_recency")
def dq_recency(spark, sf_dir):
    return _check(
        table(spark, sf_dir, "orders"),
        dq.data_recency("o_orderdate", datetime(2001, 8, 10), timedelta(days=2)),
        dq.data_recency("o_orderdate", datetime(2001, 8, 1, 12), timedelta(days=2)),
    )


@query("dq_record_ts")
def dq_record_ts(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("shipped_at")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    joined = orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return _check(
        joined, dq.record_timestamp(joined, "shipped_at"), dq.record_timestamp(joined, "absent")
    )


@query("dq_completeness")
def dq_completeness(spark, sf_dir):
    """Orders without a single line."""
    expected = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    return dq.missing_members(items, expected, ["order_key"])


@query("dq_completeness_result")
def dq_completeness_result(spark, sf_dir):
    expected = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    missing = dq.missing_members(items, expected, ["order_key"])
    orders = expected.distinct().count()
    return dq.completeness(missing, "completeness", "order_key", expected=orders).drop("detail")


@query("dq_schema")
def dq_schema(spark, sf_dir):
    """Checks on names and types next to row checks, in one pass."""
    events = table(spark, sf_dir, "events")
    declared = {"event_id": "Int64", "ts": "datetime64[ns]", "user_id": "float", "value": "int"}
    return dq.run_checks(
        events,
        [
            dq.required_columns(events, ["event_id", "country"]),
            dq.primary_keys_exist(events, ["event_id"]),
            dq.partition_keys_exist(events, ["event_date"]),
            dq.extra_columns(events, declared),
            dq.column_types(events, declared),
            dq.not_null("event_id"),
            dq.not_negative("value"),
        ],
    )


# ---------------------------------------------------------------- file formats


@query("bronze_csv")
def bronze_csv(spark, sf_dir):
    """Orders written as headerless tab-separated text and read back."""
    path = scratch_path(spark, "csv")
    order_days(spark, sf_dir).write.csv(path, sep="\t")
    rows = read_delimited(
        spark, [path], {"sep": "\t", "names": ORDER_COLUMNS, "skipinitialspace": True}
    )
    return enforce_schema(rows, ORDER_TYPES)


@query("bronze_zip")
def bronze_zip(spark, sf_dir):
    """Orders packed into zip archives, one per batch of rows, and unpacked."""
    lines = order_days(spark, sf_dir).select(
        F.concat_ws("\t", *(F.col(c).cast("string") for c in ORDER_COLUMNS)).alias("line")
    )
    archives = lines.mapInPandas(zip_batches, "path string, content binary")
    rows = parse_zipped_delimited(archives, {"sep": "\t", "names": ORDER_COLUMNS})
    return enforce_schema(rows, ORDER_TYPES)


@query("bronze_headers")
def bronze_headers(spark, sf_dir):
    """Orders as text under three headers: in order, in another order with a
    column more, and with a column less; read in one go."""
    path, days = scratch_path(spark, "csv"), order_days(spark, sf_dir)
    status = F.col("o_orderstatus")
    for name, wanted, columns in (
        ("finished", status == "F", ["o_orderkey", "o_custkey", "o_orderstatus"]),
        ("open", status == "O", ["o_totalprice", "o_orderstatus", "o_orderkey", "o_custkey"]),
        ("partial", status == "P", ["o_orderstatus", "o_orderkey"]),
    ):
        days.where(wanted).select(*columns).write.csv(f"{path}/{name}", header=True)
    rows = read_delimited(spark, [f"{path}/{n}" for n in ("finished", "open", "partial")], {"header": 0})
    return enforce_schema(rows, {n: t for n, t in ORDER_TYPES.items() if n != "order_day"})


@query("bronze_overwrite")
def bronze_overwrite(spark, sf_dir):
    """Orders landed by status and ingested anew after the files of one status are
    gone and those of another came again without rows."""
    run = Run(
        spark, BAD_LINES_CONFIG, Lake(scratch_path(spark, "lake")), TRANSFORMS, BUILDERS, RUN_ID, CLOCK
    )
    landing = run.lake.landing("flagged")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string"), "o_orderstatus")
    for status in "FOP":
        orders.where(F.col("o_orderstatus") == status).write.csv(f"{landing}/{status}")
    refresh_bronze(run, "flagged")
    orders.limit(0).write.csv(f"{landing}/O", mode="overwrite")
    orders.where("o_orderstatus = 'P' and o_orderkey % 2 = 0").write.csv(f"{landing}/P", mode="overwrite")
    refresh_bronze(run, "flagged")
    return read_table(spark, run.lake.bronze("flagged")).select("key", "flag")


@query("bronze_bad_lines")
def bronze_bad_lines(spark, sf_dir):
    """Orders as text, of which the finished ones have fields too many, through
    bronze and silver: rows that arrived, and the lines kept back."""
    run = Run(
        spark, BAD_LINES_CONFIG, Lake(scratch_path(spark, "lake")), TRANSFORMS, BUILDERS, RUN_ID, CLOCK
    )
    more = F.when(F.col("o_orderstatus") == "P", F.lit(",,more")).when(F.col("o_orderstatus") == "O", F.lit(",")).otherwise(F.lit(""))
    line = F.concat(F.col("o_orderkey"), F.lit(',"'), F.col("o_orderstatus"), F.lit(',x"'), more)
    table(spark, sf_dir, "orders").select(line).write.text(run.lake.landing("flagged"))
    refresh_bronze(run, "flagged")
    refresh_silver(run, "flagged")
    silver = read_table(spark, run.lake.silver("flagged")).select("key", "flag", F.lit(None).cast("string").alias("line"))
    none = F.lit(None).cast("string")
    return silver.unionByName(bad_lines(run, "flagged").select(none.alias("key"), none.alias("flag"), "line"))


@query("bronze_workbook")
def bronze_workbook(spark, sf_dir):
    """Customers packed into workbooks, one per batch of rows, and decoded."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    books = customers.mapInPandas(workbook_batches, "path string, content binary")
    rows = parse_workbooks(books, {"names": list(customers.columns)})
    return enforce_schema(
        rows,
        {"c_custkey": "int64", "c_name": "string", "c_acctbal": "float64", "c_mktsegment": "string"},
    )


# -------------------------------------------------------------- layers and audit


@query("folded_appends")
def folded_appends(spark, sf_dir):
    """Orders appended in nine parts to a table that folds its folders, the last
    parts with one column more, and the folders that are left."""
    path = scratch_path(spark, "appends")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", (F.pmod(F.col("o_orderkey").cast("long"), F.lit(9))).alias("part")
    )
    for part in range(9):
        rows = orders.where(F.col("part") == part)
        append_rows(rows if part > 5 else rows.drop("o_orderpriority"), path, fold_after=4)
    folders = len(table_state(spark, path).locations(path))
    return read_table(spark, path).groupBy("part", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_orderkey").cast("long")).alias("key_sum"),
        F.lit(folders <= 5).alias("folded"),
    )


@query("audit_rows")
def audit_rows(spark, sf_dir):
    """Files of two audited table runs, counted by layer, table and role."""
    path = scratch_path(spark, "audit")
    for name, key, role in (("pages", "url", "input"), ("documents", "doc_id", "output")):
        files = table(spark, sf_dir, name).select(F.col(key).cast("string"))
        append_files(file_table(files, RUN_ID, "bronze", name, role), path)
    files = read_table(spark, f"{path}/files")
    return files.groupBy("run_id", "layer", "table", "role").agg(
        F.count(F.lit(1)).alias("files"), F.count_distinct(F.col("path")).alias("paths")
    )


EVENT_COLUMNS = ["day", "event_id", "user_id", "event_type", "cents", "prop"]

KEY = {"nullable": False, "primary_key": True}
MONTH_KEY = {"type": "date", **KEY}
EVENT_RESULTS = {
    "total_events": {"type": "Int64"},
    "mean_cents": {"type": "Float64"},
    "mean_prop": {"type": "Float64"},
    "sum_cents": {"type": "Int64"},
}

LAYERED_CONFIG = PipelineConfig.from_mappings(
    {
        "pipeline": {
            "name": "activity",
            "timezone": "UTC",
            "execution": {"start_date": "1995-01-01", "end_date": "2024-12-31"},
        }
    },
    {
        "sources": {
            "events": {
                "acquisition_method": "manual_drop",
                "ingestion_mode": "append",
                "file_type": "csv",
                "reader": {"sep": "\t", "header": None, "names": EVENT_COLUMNS},
            },
            "order_counts": {
                "acquisition_method": "manual_drop",
                "ingestion_mode": "latest_snapshot",
                "file_type": "csv",
                "reader": {"header": 0},
            },
        }
    },
    {
        "schemas": {
            "bronze": {
                "events": {"required_columns": ["day", "event_id"]},
                "order_counts": {"required_columns": ["segment", "month_name", "order_year", "n"]},
            },
            "silver": {
                "events": {
                    "columns": {
                        "day": {
                            "type": "date", "nullable": False,
                            "partition_key": True, "record_timestamp": True,
                        },
                        "event_id": {"type": "string", **KEY},
                        "user_id": {"type": "Int64"},
                        "event_type": {"type": "string"},
                        "cents": {"type": "Int64"},
                        "prop": {"type": "Int64"},
                    }
                },
                "order_counts": {
                    "columns": {
                        "month": {**MONTH_KEY, "record_timestamp": True},
                        "segment": {"type": "string", **KEY},
                        "nation": {"type": "string", **KEY},
                        "orders": {"source": "n", "type": "int64", "nullable": False},
                    }
                },
            },
            "gold": {
                "events_by_day": {
                    "inputs": {"events": {"layer": "silver", "table_name": "events"}},
                    "columns": {"day": MONTH_KEY, **EVENT_RESULTS},
                },
                "events_by_month": {
                    "inputs": {"events": {"layer": "silver", "table_name": "events"}},
                    "columns": {"month": MONTH_KEY, **EVENT_RESULTS},
                },
                "orders_by_month": {
                    "inputs": {"order_counts": {"layer": "silver", "table_name": "order_counts"}},
                    "columns": {"month": MONTH_KEY, "orders": {"type": "Int64"}},
                },
                "activity": {
                    "inputs": {
                        "orders": {"layer": "gold", "table_name": "orders_by_month"},
                        "events": {"layer": "gold", "table_name": "events_by_month"},
                    },
                    "columns": {
                        "month": MONTH_KEY,
                        "orders": {"type": "Int64"},
                        "events": {"type": "Int64"},
                        "mean_event_cents": {"type": "Float64"},
                    },
                },
            },
        }
    },
)

BAD_LINES_CONFIG = PipelineConfig.from_mappings(
    {"pipeline": {"name": "flags", "timezone": "UTC", "execution": {"start_date": "1992-01-01"}}},
    {"sources": {"flagged": {
        "acquisition_method": "manual_drop", "ingestion_mode": "overwrite", "file_type": "csv",
        "reader": {"header": None, "names": ["key", "flag"], "bad_lines": "keep"},
    }}},
    {"schemas": {
        "bronze": {"flagged": {"required_columns": ["key", "flag"]}},
        "silver": {"flagged": {"columns": {"key": {"type": "string", **KEY}, "flag": {"type": "string"}}}},
        "gold": {},
    }},
)

TRANSFORMS = Registry("silver transform")
TRANSFORMS.register("flagged", lambda df: df)
TRANSFORMS.register("events", compact_dates("day"))
TRANSFORMS.register("order_counts", month_names("month_name", "order_year", "month"))

BUILDERS = Registry("gold builder")
BUILDERS.register(
    "events_by_day",
    daily_event_metrics("events", **EVENT_MEASURES, date_column="day", ids_are_unique=True),
)
BUILDERS.register(
    "events_by_month",
    monthly_event_metrics("events", **EVENT_MEASURES, date_column="day", result="month"),
)
BUILDERS.register("orders_by_month", monthly_totals("order_counts", "orders", "month", "orders"))
BUILDERS.register(
    "activity",
    combined_monthly(
        "orders_by_month",
        "events_by_month",
        {"orders": "orders"},
        {"total_events": "events", "mean_cents": "mean_event_cents"},
        key="month",
    ),
)


def layered_run(spark: SparkSession, sf_dir: str, gold: list[str], lake: Lake | None = None) -> Run:
    """Land events and order counts as text, then refresh all layers; into a
    given lake, land them only."""
    run = Run(
        spark, LAYERED_CONFIG, lake or Lake(scratch_path(spark, "lake")), TRANSFORMS, BUILDERS,
        RUN_ID, CLOCK,
    )
    events = event_feed(spark, sf_dir).withColumn("day", F.date_format("day", "yyyyMMdd"))
    events.select(*EVENT_COLUMNS).write.csv(run.lake.landing("events"), sep="\t")
    tables = ["events"]
    if "activity" in gold or lake:
        tables.append("order_counts")
        # One file: a snapshot of counts per nation, segment and month, small by nature.
        order_counts(spark, sf_dir).select(
            "nation",
            "segment",
            F.year("month").alias("order_year"),
            F.date_format("month", "MMMM").alias("month_name"),
            F.col("orders").alias("n"),
        ).repartition(1).write.csv(run.lake.landing("order_counts"), header=True)
    if lake:
        return run
    with run.recording():
        for name in tables:
            refresh_bronze(run, name)
            refresh_silver(run, name)
        build_gold(run, gold)
    return run


@query("layered_daily")
def layered_daily(spark, sf_dir):
    run = layered_run(spark, sf_dir, ["events_by_day"])
    return read_table(spark, run.lake.gold("events_by_day"))


@query("layered_combined")
def layered_combined(spark, sf_dir):
    run = layered_run(spark, sf_dir, ["events_by_month", "orders_by_month", "activity"])
    return read_table(spark, run.lake.gold("activity"))


@query("full_run")
def full_run(spark, sf_dir):
    """All layers in one run, and the same once more: the second one finds no new
    events, and only replaces the snapshot and the two tables made from it. Returns
    the report and the number of gold tables that each run built."""
    lake = Lake(scratch_path(spark, "lake"))
    first = layered_run(spark, sf_dir, [], lake=lake)
    run_all(first)
    again = replace(first, run_id="20240202_000000", now=CLOCK + timedelta(days=1))
    run_all(again)
    runs = read_table(spark, f"{lake.audit}/runs").where("layer = 'gold' and rows_written > 0")
    built = {r["run_id"]: r["count"] for r in runs.groupBy("run_id").count().collect()}
    return read_table(spark, lake.gold("activity")).withColumns({
        "built_first": F.lit(built.get(first.run_id, 0)).cast("bigint"),
        "built_again": F.lit(built.get(again.run_id, 0)).cast("bigint"),
    })


@query("layered_silver")
def layered_silver(spark, sf_dir):
    """The silver table after landing and merging all events."""
    run = layered_run(spark, sf_dir, [])
    return read_table(spark, run.lake.silver("events")).select(
        *EVENT_COLUMNS, "_silver_run_id", "_bronze_run_id"
    )
