"""Chunked sessions equal Spark's own session_window, also with tiny chunks."""
import pytest
from pyspark.sql import functions as F

from recordlog.operators.sessions import sessionize


@pytest.mark.parametrize("chunk_us", [60_000_000, 600_000_000, 3_600_000_000 * 24 * 40])
def test_sessionize_matches_session_window(fx_small, chunk_us):
    log = fx_small.log
    got = sessionize(log, ["key"], "timestamp", "3 hours", {"n": F.count(F.lit(1))}, chunk_us=chunk_us)
    exp = log.groupBy(F.session_window("timestamp", "3 hours").alias("w"), "key").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "key", "n")
    a = sorted(tuple(r) for r in got.collect())
    b = sorted(tuple(r) for r in exp.collect())
    assert a == b


def test_exact_gap_joins_session(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", t0), ("k", t0 + dt.timedelta(hours=1)), ("k", t0 + dt.timedelta(hours=2, seconds=1))],
                               "key string, ts timestamp")
    rows = sessionize(df, ["key"], "ts", "1 hour", {"n": F.count(F.lit(1))}, chunk_us=1_800_000_000).collect()
    assert sorted(r.n for r in rows) == [1, 2]


def test_null_keys_have_sessions_and_null_times_none(spark):
    import datetime as dt
    t0 = dt.datetime(1969, 12, 31, 23)
    df = spark.createDataFrame([("a", t0), (None, t0), (None, t0 + dt.timedelta(minutes=50)), (None, t0 + dt.timedelta(hours=9)),
                                ("a", None), (None, None)], "key string, ts timestamp")
    rows = sessionize(df, ["key"], "ts", "1 hour", {"n": F.count(F.lit(1))}, chunk_us=1_800_000_000).collect()
    assert sorted((str(r.key), r.n) for r in rows) == [("None", 1), ("None", 2), ("a", 1)]
