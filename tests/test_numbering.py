"""Chunked numbering equals a plain row_number, also with many chunks per group."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from recordlog.operators.numbering import chunk_of, number_within
from recordlog.operators.offsets import append
from recordlog.sources.log import events_as_records


def test_chunked_equals_row_number(spark, fx_small):
    recs = events_as_records(fx_small.table("events"))
    got = number_within(recs, ["topic", "partition_id"], ["event_id"], chunk_of("event_id", 7))
    w = Window.partitionBy("topic", "partition_id").orderBy("event_id")
    exp = recs.withColumn("log_offset", (F.row_number().over(w) - 1).cast("bigint"))
    a = sorted(got.select("event_id", "log_offset").collect())
    b = sorted(exp.select("event_id", "log_offset").collect())
    assert a == b


def test_append_continues_partitions(spark):
    log = spark.createDataFrame([("t", 0, 0), ("t", 0, 1), ("t", 1, 5)], "topic string, partition_id int, log_offset bigint")
    new = spark.createDataFrame([("t", 0, 30), ("t", 0, 10), ("t", 1, 7), ("u", 0, 1)],
                                "topic string, partition_id int, seq bigint")
    ack = {(r.topic, r.partition_id, r.seq): r.log_offset for r in append(new, log, "seq").collect()}
    assert ack == {("t", 0, 10): 2, ("t", 0, 30): 3, ("t", 1, 7): 6, ("u", 0, 1): 0}


def test_dense_offsets_in_fixture_log(fx_small):
    b = fx_small.log.groupBy("topic", "partition_id").agg(
        F.min("log_offset").alias("lo"), F.max("log_offset").alias("hi"), F.count("*").alias("n")).collect()
    for r in b:
        assert r.lo == 0 and r.hi == r.n - 1


def test_numbering_property(spark):
    """Random groups, random chunk widths: chunked numbering = row_number."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 10_000)), min_size=1, max_size=60, unique_by=lambda t: t[1]),
           st.integers(1, 50))
    def check(rows, width):
        df = spark.createDataFrame(rows, "g int, o bigint")
        got = number_within(df, ["g"], ["o"], chunk_of("o", width), out="n")
        w = Window.partitionBy("g").orderBy("o")
        exp = df.withColumn("n", (F.row_number().over(w) - 1).cast("bigint"))
        assert sorted(got.collect()) == sorted(exp.collect())
    check()


def test_latest_commits_packing(spark):
    from recordlog.operators.offsets import latest_commits
    df = spark.createDataFrame(
        [("g", "t", 0, 5, 100), ("g", "t", 0, 7, 100), ("g", "t", 0, 9, 50), ("g", "t", 1, 3, -4), ("g", "t", 1, 2, -3),
         ("g", "u", 0, 9223372036854775807, 9223372036854775807), ("g", "u", 0, 1, -9223372036854775808)],
        "consumer_group string, topic string, partition_id int, log_offset bigint, committed_at bigint")
    got = {(r.topic, r.partition_id): (r.log_offset, r.committed_at) for r in latest_commits(df).collect()}
    assert got == {("t", 0): (7, 100), ("t", 1): (2, -3),
                   ("u", 0): (9223372036854775807, 9223372036854775807)}
    assert "SortAggregate" not in latest_commits(df)._jdf.queryExecution().executedPlan().toString()


def test_rows_with_nulls_are_numbered(spark):
    from recordlog.operators.numbering import chunk_of, number_within
    rows = [("t", 0, 5), ("t", 0, None), ("t", None, 7), (None, None, 1), ("t", 0, 2**60)]
    df = spark.createDataFrame(rows, "topic string, partition_id int, seq bigint")
    got = number_within(df, ["topic", "partition_id"], ["seq"], chunk_of("seq", 4)).collect()
    assert sorted(map(str, ((r.topic, r.partition_id, r.seq, r.log_offset) for r in got))) == sorted(map(str, [
        ("t", 0, None, 0), ("t", 0, 5, 1), ("t", 0, 2**60, 2), ("t", None, 7, 0), (None, None, 1, 0)]))


def test_chunks_are_exact_for_large_numbers(spark):
    from recordlog.operators.numbering import chunk_of
    from recordlog.operators.offsets import with_batches
    n = 2**53 * 100 + 99
    df = spark.createDataFrame([(n,), (n + 1,)], "log_offset bigint")
    assert [r.batch_no for r in with_batches(df, 100).orderBy("log_offset").collect()] == [2**53, 2**53 + 1]
    assert [r[0] for r in df.select(chunk_of("log_offset", 100)).orderBy("log_offset").collect()] == [2**53, 2**53 + 1]


def test_fetch_of_partitions_with_gaps(spark):
    from recordlog.operators.select import fetch, first_n
    rows = [("a", 0, o) for o in (5, 6, 7, 8, 9)] + [("a", 1, o) for o in (3, 50, 51, 900, 901)] + [("b", 0, 2)] + [("b", 1, o) for o in range(100)]
    df = spark.createDataFrame(rows, "topic string, partition_id int, log_offset bigint")
    for n in (1, 3, 4, 1000):
        got = sorted(tuple(r) for r in fetch(df, n).select("topic", "partition_id", "log_offset").collect())
        want = sorted(x for t, p in {r[:2] for r in rows} for x in sorted(r for r in rows if r[:2] == (t, p))[:n])
        assert got == want
    assert first_n(df.limit(0), 3).count() == 0


def test_fetch_filters_the_scan(spark, tmp_path):
    from recordlog.operators.select import fetch
    path = str(tmp_path / "log")
    spark.range(1000).selectExpr("'t' AS topic", "0 AS partition_id", "id AS log_offset", "'v' AS value").write.parquet(path)
    plan = fetch(spark.read.parquet(path), 10)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(log_offset,10)" in plan
