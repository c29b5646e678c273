"""Daily sketches: merged over batches they give what one pass gives, near the exact number."""
import pytest
from pyspark.sql import functions as F

from fleetscope.operators.sketches import daily_sketches, relative_error, totals_of_sketches
from fleetscope.session import new_subdir
from fleetscope.streaming.sinks import write_daily_sketches

SCHEMA = "device_id string, event_timestamp timestamp, event_type string"


def test_merged_batches_equal_one_pass(spark):
    n = 60_000
    events = spark.range(n).select(
        F.concat(F.lit("d"), F.col("id") % 20_000).alias("device_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7).alias("event_timestamp"),
        F.when(F.col("id") % 10 == 0, "critical").otherwise("normal").alias("event_type"))
    path = f"{new_subdir(spark, 'sketches')}/days"
    for k in (0, 1, 2, 1):  # every day in every batch, one written again
        write_daily_sketches(events.where(F.pmod(F.hash("event_timestamp"), F.lit(3)) == k), k, path)
    stored = spark.read.parquet(path)
    got, want = totals_of_sketches(stored).first(), totals_of_sketches(daily_sketches(events)).first()
    assert (got.total_events, got.critical_events, got.last_seen) == (n, n // 10, want.last_seen)
    for r in (got, want):
        assert abs(r.unique_devices / 20_000 - 1) <= 4 * relative_error()
    exact = {r.day: r.n for r in events.groupBy(F.to_date("event_timestamp").alias("day")).agg(
        F.count_distinct("device_id").alias("n")).collect()}
    days = totals_of_sketches(stored, ["day"]).collect()
    assert {r.day for r in days} == set(exact)
    assert all(abs(r.unique_devices / exact[r.day] - 1) <= 4 * relative_error() for r in days)


def test_empty_and_nulls(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert tuple(totals_of_sketches(daily_sketches(none)).first()) == (0, 0, None, 0)
    nulls = spark.createDataFrame([(None, None, None), (None, None, "critical")], SCHEMA)
    assert tuple(totals_of_sketches(daily_sketches(nulls)).first()) == (2, 1, None, 0)
    with pytest.raises(ValueError):
        daily_sketches(none, lg_k=3)
