"""Keep-latest against hand-made cases and a plain Python model."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from layerwell.operators.dedup import keep_latest

DAY1, DAY2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
SCHEMA = "id long, _bronze_ingested_at timestamp, value long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_version_stays(spark):
    df = spark.createDataFrame([(1, DAY1, 10), (1, DAY2, 20), (2, DAY1, 30)], SCHEMA)
    assert rows(keep_latest(df, ["id"], "_bronze_ingested_at")) == [(1, DAY2, 20), (2, DAY1, 30)]


def test_ties_are_settled_by_given_order_then_by_value(spark):
    df = spark.createDataFrame([(1, DAY1, 10), (1, DAY1, 20)], SCHEMA)
    assert rows(keep_latest(df, ["id"], "_bronze_ingested_at")) == [(1, DAY1, 10)]
    last = keep_latest(df, ["id"], "_bronze_ingested_at", tie_breakers=[F.col("value").desc()])
    assert rows(last) == [(1, DAY1, 20)]


def test_rows_are_sorted_by_key_before_scope(spark):
    df = spark.createDataFrame([(1, DAY1, 10), (1, DAY2, 20)], SCHEMA)
    kept = keep_latest(df, ["id"], "_bronze_ingested_at", scope=["value"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all("Sort [id#" in line for line in sorts)
    assert rows(kept) == [(1, DAY1, 10), (1, DAY2, 20)]


def test_null_keys_are_dropped_null_scope_is_not(spark):
    df = spark.createDataFrame([(None, DAY1, 1), (1, DAY1, None), (1, DAY1, 5)], SCHEMA)
    out = keep_latest(df, ["id"], "_bronze_ingested_at", scope=["value"])
    assert rows(out) == [(1, DAY1, 5), (1, DAY1, None)]


def test_unreadable_versions_rank_last(spark):
    df = spark.createDataFrame(
        [(1, "soon", 1), (1, "2026-01-01", 2), (2, None, 3)], "id long, v string, value long"
    )
    assert rows(keep_latest(df, ["id"], "v")) == [(1, "2026-01-01", 2), (2, None, 3)]


def test_without_version_column_nothing_changes(spark):
    df = spark.createDataFrame([(1, DAY1, 10), (1, DAY2, 20)], SCHEMA)
    assert keep_latest(df, ["id"], "absent").count() == 2
    assert keep_latest(df, ["id"], None).count() == 2


def test_columns_without_order_are_allowed(spark):
    df = spark.createDataFrame([(1, DAY1, {"a": 1})], "id long, v timestamp, m map<string,int>")
    assert keep_latest(df, ["id"], "v").count() == 1


def test_random_frames_match_a_model(spark):
    rng = random.Random(7)
    for _ in range(3):
        data = [
            (
                rng.choice([None, *range(12)]),
                rng.choice([None, *(DAY1 + timedelta(days=d) for d in range(4))]),
                rng.randrange(50),
            )
            for _ in range(300)
        ]
        best = {}
        for key, version, value in data:
            if key is None:
                continue
            rank = (version is None, -(version or DAY1).toordinal(), value)
            if key not in best or rank < best[key][0]:
                best[key] = (rank, (key, version, value))
        out = keep_latest(
            spark.createDataFrame(data, SCHEMA).repartition(5), ["id"], "_bronze_ingested_at"
        )
        assert rows(out) == sorted((row for _, row in best.values()), key=str)


def test_hot_key_is_reduced_before_the_exchange(spark):
    df = spark.range(1000).select(
        F.least("id", F.lit(1)).alias("id"), F.current_timestamp().alias("v"), F.col("id").alias("value")
    )
    plan = keep_latest(df, ["id"], "v")._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "Final" in above
    assert "WindowGroupLimit" in below and "Partial" in below
