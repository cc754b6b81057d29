"""Storage layout and ordering claims."""
import glob
import os
import tempfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from recordlog.operators._args import join_checked
from recordlog.operators.select import log_order
from recordlog.plans import fixtures, streaming_queries
from recordlog.sources.log import read_log, write_log


def test_write_log_segments_sorted(spark, fx_small):
    path = os.path.join(tempfile.mkdtemp(prefix="layout-"), "log")
    write_log(fx_small.log, path, segment_rows=64)
    topics = sorted(os.path.basename(d) for d in glob.glob(os.path.join(path, "topic=*")))
    assert topics == sorted(f"topic={t}" for t in ["ev.click", "ev.error", "ev.purchase", "ev.signup", "ev.view"])
    for f in glob.glob(os.path.join(path, "topic=*", "*.parquet")):
        t = pq.read_table(f, columns=["partition_id", "log_offset"]).to_pylist()
        keys = [(r["partition_id"], r["log_offset"]) for r in t]
        assert keys == sorted(keys)
    back = read_log(spark, path)
    assert back.count() == fx_small.log.count()
    assert back.select("topic", "partition_id", "log_offset").exceptAll(
        fx_small.log.select("topic", "partition_id", "log_offset")).count() == 0


def test_log_order_is_global(spark, fx_small):
    d = log_order(fx_small.log, 4).select("topic", "partition_id", "log_offset")
    parts = d.rdd.glom().collect()
    flat = [tuple(r) for p in parts for r in p]
    assert flat == sorted(flat) and len(flat) == fx_small.log.count()
    assert sum(1 for p in parts if p) > 1          # really spread over several tasks


def test_join_checked_both_paths(spark, fx_small):
    small = fx_small.log.groupBy("topic", "partition_id").agg(F.max("log_offset").alias("m"))
    a = join_checked(fx_small.log, small, ["topic", "partition_id"])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")  # fewer bytes than the small side counts with
    b = join_checked(fx_small.log, small, ["topic", "partition_id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    hint = "strategy=broadcast"
    assert hint in a._jdf.queryExecution().analyzed().toString()
    assert hint not in b._jdf.queryExecution().analyzed().toString()
    assert sorted(a.select("topic", "partition_id", "log_offset", "m").collect()) == \
        sorted(b.select("topic", "partition_id", "log_offset", "m").collect())


def _rows_by_file(spark, path):
    return [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).count().collect()]


def test_document_log_is_ranked_and_stored_in_segments(spark, tmp_path, monkeypatch):
    """A topic of many texts takes many tasks, however few topics there are."""
    monkeypatch.setattr(fixtures, "DOC_SEGMENT", 8)
    monkeypatch.setattr(fixtures, "_STORED", {})
    rows = [(i, f"text {i}", "en") for i in range(400)] + [(None, "no id", "en"), (7, "id again", None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    widths = []
    number = fixtures.number_within
    monkeypatch.setattr(fixtures, "number_within", lambda d, g, o, chunk: widths.append(
        max(r["count"] for r in d.groupBy(*g, chunk.alias("c")).count().collect())) or number(d, g, o, chunk))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        log = fixtures.Fixtures(spark, str(tmp_path)).doc_log
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert widths == [8]
    got = sorted((r["log_offset"], r["value"]) for r in log.filter("topic = 'docs.en'").collect())
    assert [o for o, _ in got] == list(range(401))
    assert got[0][1] == "no id" and [v for _, v in got[1:]] == [f"text {i}" for i in range(400)]
    tasks = {f.rsplit("/", 1)[1][:10] for f in log.inputFiles() if "topic=docs.en" in f}
    assert len(tasks) > 1


def test_document_stream_has_files_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(streaming_queries, "DOC_SEGMENT", 16)
    docs = spark.range(1000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'same text' AS text")
    path, each = streaming_queries.stage_texts(docs, "words-in")
    rows = _rows_by_file(spark, path)
    assert sum(rows) == 1000 and max(rows) <= 32
    assert each == 16 and len(rows) <= 4 * each
    path, each = streaming_queries.stage_texts(docs.limit(0), "words-in")
    assert each == 1 and spark.read.parquet(path).count() == 0
