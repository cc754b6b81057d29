"""Row push, stream apps, Kafka mapping, audit targets, replay stream."""
import os
import tempfile

from pyspark.sql import functions as F

from recordlog.sources.log import from_kafka, kafka_options
from recordlog.streaming.push import apps, register_app, run_app
from recordlog.streaming.sinks import RowSubscriber, push_rows, write_audit


def test_kafka_options():
    o = kafka_options("b:9092", topics="a, b", starting={"a": {"0": 5}}, max_offsets_per_trigger=100)
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == '{"a": {"0": 5}}' and o["maxOffsetsPerTrigger"] == "100"
    assert kafka_options("b", pattern="ev\\..*")["subscribePattern"] == "ev\\..*"


def test_from_kafka_mapping(spark):
    df = spark.createDataFrame(
        [("t", 1, 7, None, b"k", b"v", [("X-Correlation-Id", b"c1"), ("a", b"x"), ("X-Correlation-Id", b"c2")])],
        "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary, "
        "headers array<struct<key:string,value:binary>>")
    r = from_kafka(df).first()
    assert (r.topic, r.partition_id, r.log_offset) == ("t", 1, 7)
    assert r.headers == {"X-Correlation-Id": "c2", "a": "x"}


def test_stream_app_registry(spark):
    register_app("only_clicks", lambda df: df.filter(F.col("topic") == "ev.click"))
    assert "only_clicks" in apps()
    df = spark.createDataFrame([("ev.click",), ("ev.view",)], "topic string")
    assert run_app("only_clicks", df).count() == 1


def test_push_rows_one_call_per_row(spark, fx_small):
    root = tempfile.mkdtemp(prefix="push-rows-")
    src = os.path.join(root, "src")
    fx_small.log.select("topic", "partition_id", "log_offset").write.parquet(src)
    sink = os.path.join(root, "rows")
    os.makedirs(sink)

    def on_row(row, _dir=sink):
        with open(os.path.join(_dir, f"{row.topic}-{row.partition_id}-{row.log_offset}"), "w"):
            pass
    stream = spark.readStream.schema("topic string, partition_id int, log_offset bigint").parquet(src)
    q = push_rows(stream, RowSubscriber(on_row), os.path.join(root, "ckpt"))
    q.awaitTermination()
    assert len(os.listdir(sink)) == fx_small.log.count()


def test_audit_logfile_target(spark, fx_small):
    from recordlog.operators.results import audit_from_results
    root = tempfile.mkdtemp(prefix="audit-lines-")
    write_audit(audit_from_results(fx_small.results), root, 3, target="logfile")
    lines = spark.read.text(os.path.join(root, "batch_id=3"))
    assert lines.count() == fx_small.log.count()
    assert lines.first().value.startswith('{"id":')


def test_replay_stream_progress(spark, fx_small):
    import __spark_entry__ as E
    prog = E.queries()["replay_stream"](spark, "/root/testdata/sf0.001")
    rows = prog.collect()
    assert rows and all(r.n_records > 0 for r in rows)
    # a request that was rolled back stays at its start and is not finished
    assert all(r.next_offset == r.last_offset + 1 or (r.next_offset == r.start_offset and not r.finished) for r in rows)


def test_kafka_sink_without_jar(spark, fx_small):
    import pytest
    from recordlog.sources.codec import write_kafka
    with pytest.raises(RuntimeError):
        write_kafka(fx_small.log.limit(1), "localhost:9092", "t", value_format="STRING")


def test_fetch_counts_repeated_offsets_and_null_partitions(spark):
    from recordlog.operators import select as S
    rows = [("t", 0, o, f"{o}-{k}") for o in range(5) for k in range(3)] + [("t", None, o, "n") for o in range(4)] \
        + [("t", 1, 10 * o, "gap") for o in range(6)]
    df = spark.createDataFrame(rows, "topic string, partition_id int, log_offset bigint, value string").withColumn("key", F.lit("k"))
    for n in (1, 3, 4, 100):
        got = {}
        for r in S.fetch(df, n).collect():
            got.setdefault(r["partition_id"], []).append(r["log_offset"])
        want = {p: sorted(o for _, q, o, _ in rows if q == p)[:n] for p in (0, None, 1)}
        assert {p: sorted(v) for p, v in got.items()} == want
    assert S.fetch_bytes(df, max_bytes=1, max_records=3).count() == 3


def test_long_lists_of_partitions_and_positions(spark):
    from recordlog.operators import select as S
    df = spark.range(3000).selectExpr("concat('t', id % 600) AS topic", "CAST(id % 2 AS int) AS partition_id", "id AS log_offset")
    every = [tuple(r) for r in df.collect()]
    for n in (150, 900):
        pairs = [(f"t{k}", k % 2) for k in range(n)]
        assert sorted(tuple(r) for r in S.assign(df, pairs).collect()) == sorted(r for r in every if r[:2] in set(pairs))
        at = {p: 1000 for p in pairs}
        got = S.seek(df, [(*p, 1000) for p in pairs] + [(*pairs[0], 0)])
        at[pairs[0]] = 0
        assert sorted(tuple(r) for r in got.collect()) == sorted(r for r in every if r[:2] in at and r[2] >= at[r[:2]])


def test_replay_of_many_topics(spark, monkeypatch):
    from recordlog.operators import replay as R
    log = spark.range(200).selectExpr("concat('t', id % 20) AS topic", "0 AS partition_id", "id div 20 AS log_offset", "'v' AS value")
    req = spark.createDataFrame([(k, f"t{k}", 0, 2, 5, "g", False, False, None) for k in range(12)], R.REQUEST_DDL)
    want = sorted((k, f"t{k}", o) for k in range(12) for o in range(2, 5))
    for most in (500, 3):
        monkeypatch.setattr(R, "MAX_TOPICS", most)
        assert sorted(tuple(r) for r in R.replay(req, log).select("request_id", "topic", "log_offset").collect()) == want
