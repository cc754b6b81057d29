"""Replay properties: the whole range is the identity; ranges agree with a brute-force filter."""
import os

import pytest
from pyspark.sql import functions as F

from recordlog.operators.offsets import partition_bounds
from recordlog.operators.replay import REQUEST_DDL, replay


def test_full_range_is_identity(spark, fx_small):
    b = partition_bounds(fx_small.log).collect()
    req = spark.createDataFrame(
        [(i, r.topic, r.partition_id, r.first_offset, r.next_offset, "g", False, False, None) for i, r in enumerate(b)],
        REQUEST_DDL)
    got = replay(req, fx_small.log, bucket=16).select("topic", "partition_id", "log_offset")
    assert got.count() == fx_small.log.count()
    assert got.exceptAll(fx_small.log.select("topic", "partition_id", "log_offset")).count() == 0


def test_overlapping_ranges_match_brute_force(spark, fx_small):
    req = spark.createDataFrame([
        (1, "ev.click", 0, 3, 40, "g", False, False, None),
        (2, "ev.click", 0, 10, 11, "g", False, False, None),
        (3, "ev.click", 0, 0, 10**12, "g", False, False, None),   # far beyond the end: clamped, not exploded
        (4, "ev.view", 2, 17, 18, "g", False, False, None)], REQUEST_DDL)
    got = sorted((r.request_id, r.log_offset) for r in replay(req, fx_small.log, bucket=8).collect())
    wide = sorted((r.request_id, r.log_offset) for r in replay(req, fx_small.log, bucket=8, target_rows=3).collect())
    assert wide == got
    exp = []
    for rid, t, p, s, e in [(1, "ev.click", 0, 3, 40), (2, "ev.click", 0, 10, 11), (3, "ev.click", 0, 0, 10**12),
                            (4, "ev.view", 2, 17, 18)]:
        rows = fx_small.log.filter((F.col("topic") == t) & (F.col("partition_id") == p)
                                   & (F.col("log_offset") >= s) & (F.col("log_offset") < e)).collect()
        exp += [(rid, r.log_offset) for r in rows]
    assert got == sorted(exp)


def test_replay_batch_aborts_on_start_mismatch(spark, fx_small):
    """A request whose start offset holds no record is audited as FAILURE and not replayed."""
    import os
    import tempfile

    from recordlog.operators.offsets import append
    from recordlog.operators.replay import replay_control_record
    from recordlog.operators.results import fixture_results
    from recordlog.streaming.replay import ReplayConfig, replay_batch
    req = spark.createDataFrame([
        (1, "ev.click", 0, 0, 5, "g", False, False, None),
        (2, "ev.click", 0, 10**9, 10**9 + 5, "g", False, False, None)], REQUEST_DDL)
    ctl = replay_control_record(req).select(F.lit("ctl").alias("topic"), F.lit(0).alias("partition_id"),
                                            "request_id", "key", "value",
                                            F.create_map().cast("map<string,string>").alias("headers"))
    ctl = append(ctl, ctl.limit(0).select("topic", "partition_id", F.lit(0).cast("bigint").alias("log_offset")),
                 "request_id").drop("request_id")
    root = tempfile.mkdtemp(prefix="replay-abort-")
    cfg = ReplayConfig(out_dir=root, checkpoint=os.path.join(root, "ckpt"), config_topics="ev.click")
    replay_batch(ctl, 0, lambda: fx_small.log, fixture_results, cfg)
    aborted = spark.read.parquet(os.path.join(root, "audit_aborted"))
    assert aborted.count() == 1
    prog = spark.read.parquet(os.path.join(root, "progress")).collect()
    assert len(prog) == 1 and prog[0].n_records == 5 and prog[0].finished


def _control(spark, requests):
    from recordlog.operators.offsets import append
    from recordlog.operators.replay import replay_control_record
    req = spark.createDataFrame(requests, REQUEST_DDL)
    ctl = replay_control_record(req).select(F.lit("ctl").alias("topic"), F.lit(0).alias("partition_id"), "request_id", "key", "value",
                                            F.create_map().cast("map<string,string>").alias("headers"))
    none = ctl.limit(0).select("topic", "partition_id", F.lit(0).cast("bigint").alias("log_offset"))
    return append(ctl, none, "request_id").drop("request_id")


def test_replayed_results_follow_the_consume_rules(spark, fx_small):
    """A request whose results fail too often is rolled back and audited; the other one writes dead
    letters, audit and, after them, its commit."""
    import tempfile

    from recordlog.operators.results import fixture_results
    from recordlog.streaming.replay import ReplayConfig, replay_batch
    ctl = _control(spark, [(1, "ev.click", 0, 0, 20, "g1", False, False, None), (2, "ev.view", 1, 0, 20, "g2", False, False, None)])

    def half_bad(pdf):
        res = fixture_results(pdf)
        res["processed"] = [t != "ev.view" and o % 10 != 0 for t, o in zip(pdf["topic"], pdf["log_offset"])]
        return res
    root = tempfile.mkdtemp(prefix="replay-rules-")
    cfg = ReplayConfig(out_dir=root, checkpoint=f"{root}/ckpt", config_topics="ev.click,ev.view", threshold=30)
    replay_batch(ctl, 0, lambda: fx_small.log, half_bad, cfg)
    commits = spark.read.parquet(f"{root}/commits").collect()
    assert [(r.consumer_group, r.topic, r.log_offset) for r in commits] == [("g1", "ev.click", 19)]
    assert {r.origin_topic for r in spark.read.parquet(f"{root}/dead_letters").collect()} == {"ev.click"}
    assert spark.read.parquet(f"{root}/dead_letters").count() == 2 and spark.read.parquet(f"{root}/audit").count() == 20
    assert spark.read.parquet(f"{root}/audit_rolled_back").count() == 1


def test_a_failing_function_is_audited(spark, fx_small):
    import os
    import tempfile

    from recordlog.streaming.replay import ReplayConfig, replay_batch

    def broken(pdf):
        raise ValueError("backend down")
    root = tempfile.mkdtemp(prefix="replay-broken-")
    cfg = ReplayConfig(out_dir=root, checkpoint=f"{root}/ckpt", config_topics="ev.click")
    replay_batch(_control(spark, [(1, "ev.click", 0, 0, 5, "g", False, False, None)]), 0, lambda: fx_small.log, broken, cfg)
    rows = spark.read.parquet(f"{root}/audit_failed").collect()
    assert len(rows) == 1 and "backend down" in rows[0].value
    # the batch's folders stand, so that a re-run clears what an earlier attempt left; they hold no rows
    assert all(spark.read.parquet(f"{root}/{sink}").count() == 0 for sink in ("commits", "dead_letters", "audit"))
    assert not spark.read.parquet(f"{root}/progress").first()["finished"] and not os.listdir(f"{root}/_results")


def test_one_failed_request_never_touches_another(spark, fx_small):
    """One good request, one with a poison record, one whose range goes beyond the log, in one micro-batch."""
    import tempfile

    from recordlog.operators.results import fixture_results
    from recordlog.streaming.replay import ReplayConfig, replay_batch
    ctl = _control(spark, [(1, "ev.click", 0, 0, 8, "good", False, False, None), (2, "ev.view", 1, 0, 8, "poison", False, False, None),
                           (3, "ev.click", 1, 2, 10**6, "open", False, False, None), (4, "ev.click", 0, 4, 8, "good too", False, False, None)])

    def poisoned(pdf):
        if (pdf["topic"] == "ev.view").any() and (pdf["log_offset"] == 5).any():
            raise ValueError("poison record")
        res = fixture_results(pdf)
        res["processed"] = True
        return res
    root = tempfile.mkdtemp(prefix="replay-poison-")
    cfg = ReplayConfig(out_dir=root, checkpoint=f"{root}/ckpt", config_topics="ev.click,ev.view")
    replay_batch(ctl, 0, lambda: fx_small.log, poisoned, cfg)
    from recordlog.streaming.replay import read_replay_requests
    group = {r["request_id"]: r["consumer_group"] for r in read_replay_requests(ctl).collect()}
    last = fx_small.log.filter("topic = 'ev.click' AND partition_id = 1").agg(F.max("log_offset")).first()[0]
    progress = {group[r["request_id"]]: (r["next_offset"], r["finished"]) for r in spark.read.parquet(f"{root}/progress").collect()}
    assert progress == {"good": (8, True), "good too": (8, True), "poison": (0, False), "open": (last + 1, False)}
    assert {r["consumer_group"]: r["log_offset"] for r in spark.read.parquet(f"{root}/commits").collect()} \
        == {"good": 7, "good too": 7, "open": last}
    failed = spark.read.parquet(f"{root}/audit_failed").collect()
    assert len(failed) == 1 and "poison record" in failed[0].value
    assert spark.read.parquet(f"{root}/audit").count() == 8 + 4 + last - 1


def test_an_error_of_the_job_itself_is_raised(spark, fx_small):
    """Only what the function raises is a request's failure; the batch is read again after anything else."""
    import tempfile

    from recordlog.streaming.replay import ReplayConfig, replay_batch
    root = tempfile.mkdtemp(prefix="replay-job-")
    cfg = ReplayConfig(out_dir=root, checkpoint=f"{root}/ckpt", config_topics="ev.click")
    gone = fx_small.log.withColumn("value", F.raise_error(F.lit("lost file")).cast("string"))
    with pytest.raises(Exception, match="lost file"):
        replay_batch(_control(spark, [(1, "ev.click", 0, 0, 5, "g", False, False, None)]), 0, lambda: gone, lambda pdf: pdf, cfg)
    assert not os.path.exists(f"{root}/commits") and not os.path.exists(f"{root}/audit_failed")


def test_control_topics_are_read_as_they_stand(spark):
    from recordlog.streaming.replay import read_replay_requests
    from recordlog.operators.replay import topic_read
    from recordlog.functions.names import without_suffix
    df = spark.createDataFrame([("a.dlqx.dlq",), ("a.dlq",), ("a",)], "t string")
    assert [r[0] for r in df.select(without_suffix("t")).collect()] == ["a.dlqx", "a", "a"]
    reqs = read_replay_requests(_control(spark, [(1, "a.dlqx", 0, 0, 5, "g", True, False, None)]))
    assert reqs.select("topic_name", topic_read(reqs)).first()[:] == ("a.dlqx", "a.dlqx.dlq")
