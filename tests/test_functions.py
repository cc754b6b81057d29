"""Scalar rules and their quirks."""
import pytest
from pyspark.sql import functions as F

from recordlog.functions import names as N
from recordlog.operators import tables as TB
from recordlog.operators.replay import validate_replays
from recordlog.plans.fixtures import FIXED_REQUESTS
from recordlog.operators.replay import REQUEST_DDL


def _one(spark, col, value, ddl="s string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("o")).first().o


def test_topic_list(spark):
    assert _one(spark, N.topic_list("s"), "a, b ,c") == ["a", "b", "c"]
    assert _one(spark, N.topic_list("s"), "a,,b,") == ["a", "", "b", ""]
    assert _one(spark, N.topic_list("s"), " single ") == [" single "]
    assert N.parse_topic_list("a, b") == ["a", "b"] and N.parse_topic_list(" x") == [" x"]


def test_dlq_names(spark):
    assert _one(spark, N.dlq_topic("s"), "t") == "t.dlq"
    assert _one(spark, N.dlq_topic("s"), "t.dlq") == "t.dlq"
    assert _one(spark, N.dlq_topic("s"), "a.dlqx") == "a.dlqx"          # contains, not endswith
    assert _one(spark, N.dlq_topic("s", always=True), "t.dlq") == "t.dlq.dlq"
    assert _one(spark, N.base_topic("s"), "t.dlq") == "t"
    assert _one(spark, N.base_topic("s"), "xxdlq1") == "xxdlq1"        # literal, not a regex
    assert _one(spark, N.base_topic("s"), "plain") == "plain"


def test_parse_bool(spark):
    for v, e in [("true", True), ("TRUE", True), ("yes", False), ("1", False), (None, False), ("true ", False)]:
        assert _one(spark, N.parse_bool("s"), v) is e


def test_topic_membership_modes(spark):
    assert _one(spark, N.topic_in("s", "test1,other"), "test") is False
    assert _one(spark, N.topic_in("s", "test1,other", "compat"), "test") is True


def test_validation_rule_order(spark):
    req = spark.createDataFrame(FIXED_REQUESTS, REQUEST_DDL)
    v = {r.request_id: r.error_detail for r in validate_replays(req, "ev.error,ev.click,ev.view,ev.purchase").collect()}
    assert v[1] is None and v[2] is None and v[3] is None and v[13] is None
    assert v[4] == "topic name can not be empty"
    assert v[5].startswith("provided topic")
    assert v[9] == "replay end offset can not be less than start offset"
    assert v[10] == "replay end offset can not be equal to start offset"
    assert v[12] == "Destination topic can not be empty for a streaming app"


def test_pull_query_needs_key_or_scan(spark):
    t = spark.createDataFrame([("1", "v")], "key string, value string")
    with pytest.raises(ValueError):
        TB.pull_query(t)
    assert TB.pull_query(t, key="1").count() == 1
    assert TB.pull_query(t, table_scan=True, where="value = 'v'").count() == 1


def test_tombstone_removes_key(spark):
    import datetime as dt
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", 0, 0, ts, "a"), ("k", 0, 1, ts + dt.timedelta(seconds=1), None),
                                ("j", 0, 2, ts, "b")],
                               "key string, partition_id int, log_offset bigint, timestamp timestamp, value string")
    assert [r.key for r in TB.materialize_latest(df, ["key"]).collect()] == ["j"]
    assert sorted(r.key for r in TB.materialize_latest(df, ["key"], tombstones=False).collect()) == ["j", "k"]


def test_decode_policies(spark):
    from recordlog.sources.codec import decode
    df = spark.createDataFrame([("a", '{"k": 1}'), ("b", "{bad"), ("c", None)], "key string, value string")
    assert [r.key for r in decode(df, "STRING", "JSON", "k int", "skip").collect()] == ["a", "c"]
    kept = {r.key: r.corrupt_value for r in decode(df, "STRING", "JSON", "k int", "keep").collect()}
    assert kept == {"a": None, "b": "{bad", "c": None}
    with pytest.raises(Exception):
        decode(df, "STRING", "JSON", "k int", "fail").collect()
    assert decode(df.limit(1), "BINARY", "STRING").first().key == "YQ=="


def test_topic_list_python_and_spark_agree(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    texts = []

    @settings(max_examples=60, deadline=None)
    @given(st.text(alphabet="ab ,\t.", max_size=12))
    def collect(t):
        texts.append(t)
    collect()
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.o for r in df.select(N.topic_list("s").alias("o")).collect()]
    assert got == [N.parse_topic_list(t) for t in texts]


def test_kafka_reader_without_jar(spark):
    from recordlog.sources.log import kafka_options, read_kafka
    with pytest.raises(RuntimeError):
        read_kafka(spark, kafka_options("localhost:9092", topics="a"))


def test_inject_headers_replaces_same_name(spark):
    from recordlog.functions.headers import inject_headers
    df = spark.createDataFrame([({"Authorization": "old", "X-Correlation-Id": "c"},), (None,)],
                               "headers map<string,string>")
    got = [r.h for r in df.select(inject_headers("headers", "Bearer new", "svc").alias("h")).collect()]
    assert got[0] == {"X-Correlation-Id": "c", "Authorization": "Bearer new", "X-Caller-Id": "svc"}
    assert got[1] == {"Authorization": "Bearer new", "X-Caller-Id": "svc"}


def test_results_from_json_accepts_text_booleans(spark):
    from recordlog.sources.codec import results_from_json
    body = ('[{"record": {"topic": "t", "partition": 0, "offset": 1}, "processed": "false"},'
            ' {"record": {"topic": "t", "partition": 0, "offset": 2}, "processed": "TRUE"},'
            ' {"record": {"topic": "t", "partition": 0, "offset": 3}, "processed": true},'
            ' {"record": {"topic": "t", "partition": 0, "offset": 4}}]')
    got = results_from_json(spark.createDataFrame([(body,)], "body string")).orderBy("log_offset").collect()
    assert [r.processed for r in got] == [False, True, True, None]
