"""Consume loop: rollback re-reads the same batch, sinks stay single-copy, commits advance."""
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from recordlog.operators.results import fixture_results
from recordlog.streaming.consume import ConsumerConfig, RollbackError, consume
from recordlog.streaming.manifest import read_batches

LOG_COLS = ["topic", "partition_id", "log_offset", "timestamp", "key", "value", "headers", "event_id"]


def _stage(fx, root):
    path = os.path.join(root, "log")
    fx.log.select(*LOG_COLS).repartition(4, "topic", "partition_id").write.parquet(path)
    return path


def _stream(spark, path):
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def make_fn(marker):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        res = fixture_results(pdf)
        if not os.path.exists(marker):          # backend "down": everything fails
            res["processed"] = pd.array([False] * len(res), dtype="boolean")
        return res
    return fn


def test_rollback_then_retry(spark, fx_small):
    root = tempfile.mkdtemp(prefix="consume-test-")
    path = _stage(fx_small, root)
    marker = os.path.join(root, "backend-up")
    seen = []
    cfg = ConsumerConfig(out_dir=os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"), group="g",
                         on_batch=lambda bid, res: seen.append(
                             (bid, sorted(tuple(r) for r in res.select("topic", "partition_id", "log_offset").collect()))))
    q = consume(_stream(spark, path), make_fn(marker), cfg)
    with pytest.raises(Exception) as ei:
        q.awaitTermination()
    assert "RollbackError" in str(ei.value) or isinstance(ei.value, RollbackError)
    assert not os.path.exists(os.path.join(cfg.out_dir, "audit"))      # nothing written before the decision
    open(marker, "w").close()
    q = consume(_stream(spark, path), make_fn(marker), cfg)
    q.awaitTermination()
    assert q.exception() is None
    # batch 0 seen twice with the same records
    first = [rows for bid, rows in seen if bid == 0]
    assert len(first) == 2 and first[0] == first[1]
    # sinks hold exactly one copy of every record
    audit = read_batches(spark, cfg.out_dir, "audit")
    assert audit.count() == fx_small.log.count()
    # dead letters + successes = all records, disjoint
    dl = read_batches(spark, cfg.out_dir, "dead_letters")
    n_failed = fx_small.results.filter(~F.coalesce(F.col("processed"), F.lit(False))).count()
    assert dl.count() == n_failed
    dead = {(r.origin_topic, r.partition_id, r.source_offset) for r in dl.collect()}
    aud = audit.select(F.from_json("value", "topic string, partition_id int, log_offset bigint, audit_status string")
                       .alias("a")).select("a.*").collect()
    ok = {(r.topic, r.partition_id, r.log_offset) for r in aud if r.audit_status == "SUCCESS"}
    every = {(r.topic, r.partition_id, r.log_offset) for r in fx_small.log.collect()}
    assert not (dead & ok) and (dead | ok) == every
    # commit positions never go backwards
    commits = read_batches(spark, cfg.out_dir, "commits").collect()
    last = {}
    for r in sorted(commits, key=lambda r: r.batch_id):
        k = (r.topic, r.partition_id)
        assert r.log_offset >= last.get(k, -1)
        last[k] = r.log_offset


def test_rerun_batch_is_idempotent(spark, fx_small):
    """Running the same batch id twice leaves one copy."""
    from recordlog.streaming.consume import consume_batch
    root = tempfile.mkdtemp(prefix="consume-idem-")
    cfg = ConsumerConfig(out_dir=os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"))
    batch = fx_small.log.select(*LOG_COLS).filter("topic = 'ev.click'")
    consume_batch(batch, 7, fixture_results, cfg)
    consume_batch(batch, 7, fixture_results, cfg)
    assert read_batches(spark, cfg.out_dir, "audit").count() == batch.count()


def test_last_retry_writes_no_dead_letters(spark, fx_small):
    from recordlog.streaming.consume import consume_batch
    root = tempfile.mkdtemp(prefix="consume-last-")
    cfg = ConsumerConfig(out_dir=os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"), last_retry=True,
                         threshold=100)
    batch = fx_small.log.select(*LOG_COLS)
    consume_batch(batch, 0, fixture_results, cfg)
    # the batch's folder stands, so that a re-run clears what an earlier attempt left; it holds no rows
    assert read_batches(spark, cfg.out_dir, "dead_letters").count() == 0
    assert read_batches(spark, cfg.out_dir, "audit").count() == batch.count()


def test_process_match_by_key(spark, fx_small):
    from recordlog.operators.results import process

    def shuffled(pdf):
        res = fixture_results(pdf)
        res[["topic", "partition_id", "log_offset"]] = pdf[["topic", "partition_id", "log_offset"]].values
        return res.iloc[::-1]
    src = fx_small.log.select("topic", "partition_id", "log_offset", "key", "value", "event_id")
    got = process(src, shuffled, match="key").select("topic", "partition_id", "log_offset", "processed")
    exp = fx_small.results.select("topic", "partition_id", "log_offset", "processed")
    assert sorted(got.collect()) == sorted(exp.collect())

    def missing(pdf):
        res = fixture_results(pdf)
        res[["topic", "partition_id", "log_offset"]] = pdf[["topic", "partition_id", "log_offset"]].values
        res.loc[res.index[0], "log_offset"] = -1
        return res
    with pytest.raises(Exception):
        process(src, missing, match="key").collect()


def test_process_batch_rows(spark, fx_small):
    from recordlog.operators.results import process

    def sized(pdf):
        assert len(pdf) <= 100
        return fixture_results(pdf)
    src = fx_small.log.select("topic", "partition_id", "log_offset", "key", "value", "event_id")
    got = process(src, sized, batch_rows=100).select("topic", "partition_id", "log_offset", "processed")
    exp = fx_small.results.select("topic", "partition_id", "log_offset", "processed")
    assert sorted(got.collect()) == sorted(exp.collect())


def test_function_error_rolls_back_and_retries(spark, fx_small):
    """A raising function (the backend answered with an error) fails the batch; the consumer
    restarts from the checkpoint and the same batch is processed once it succeeds."""
    from recordlog.streaming.consume import run_consumer
    root = tempfile.mkdtemp(prefix="consume-raise-")
    path = _stage(fx_small, root)
    marker = os.path.join(root, "failed-once")

    def fn(pdf):
        if not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("backend answered 503")
        return fixture_results(pdf)
    cfg = ConsumerConfig(out_dir=os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"))
    attempts = run_consumer(lambda: _stream(spark, path), fn, cfg, max_attempts=3)
    assert attempts == 2
    audit = read_batches(spark, cfg.out_dir, "audit")
    assert audit.count() == fx_small.log.count()


def _config(root, **more):
    return ConsumerConfig(out_dir=os.path.join(root, "out"), checkpoint=os.path.join(root, "ckpt"), threshold=100, **more)


def test_no_commit_when_dead_letters_cannot_be_written(spark, fx_small):
    from recordlog.streaming.consume import consume_batch
    root = tempfile.mkdtemp(prefix="consume-broken-")
    cfg = _config(root)
    os.makedirs(cfg.out_dir)
    open(os.path.join(cfg.out_dir, "dead_letters"), "w").close()  # a file where the sink needs a folder
    with pytest.raises(Exception):
        consume_batch(fx_small.log.select(*LOG_COLS), 0, fixture_results, cfg)
    assert not os.path.exists(os.path.join(cfg.out_dir, "commits"))


def test_a_successful_retry_clears_the_dead_letters_of_the_first_attempt(spark, fx_small):
    from recordlog.streaming.consume import consume_batch
    root = tempfile.mkdtemp(prefix="consume-retry-")
    cfg = _config(root)
    batch = fx_small.log.select(*LOG_COLS)
    consume_batch(batch, 0, fixture_results, cfg)
    assert read_batches(spark, cfg.out_dir, "dead_letters").count() > 0

    def all_well(pdf):
        res = fixture_results(pdf)
        res["processed"] = True
        return res
    consume_batch(batch, 0, all_well, cfg)
    assert read_batches(spark, cfg.out_dir, "dead_letters").count() == 0
    assert read_batches(spark, cfg.out_dir, "commits").count() > 0


def test_stream_and_drain_commits_share_one_clock(spark, fx_small):
    import time

    from pyspark.sql import functions as F

    from recordlog.operators.offsets import commit, latest_commits
    from recordlog.streaming.consume import consume_batch
    root = tempfile.mkdtemp(prefix="consume-clock-")
    cfg = _config(root, group="g")
    batch = fx_small.log.select(*LOG_COLS)
    first = batch.groupBy("topic", "partition_id").agg(F.min("log_offset").alias("log_offset"))
    drained = commit(spark.createDataFrame([], "consumer_group string, topic string, partition_id int, log_offset bigint, committed_at bigint"),
                     first, "g", int(time.time() * 1000) - 1)
    consume_batch(batch, 0, fixture_results, cfg)
    streamed = read_batches(spark, cfg.out_dir, "commits")
    got = latest_commits(drained.unionByName(streamed.select(*drained.columns)), "g")
    want = batch.groupBy("topic", "partition_id").agg(F.max("log_offset").alias("log_offset"))
    cols = ["topic", "partition_id", "log_offset"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_push_query_takes_sql(spark, fx_small):
    from recordlog.streaming.push import push_query
    root = tempfile.mkdtemp(prefix="push-sql-")
    fx_small.log.select("topic", "log_offset").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("topic string, log_offset bigint").parquet(f"{root}/in")
    push_query(stream, "SELECT topic, log_offset FROM {changes} WHERE topic = 'ev.click'", f"{root}/out", f"{root}/ckpt").awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == fx_small.log.filter("topic = 'ev.click'").count()
