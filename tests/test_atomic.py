"""Batches over several sinks, reserved appends and stored tables: all or nothing, once, in the right bucket."""
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from recordlog.operators.results import fixture_results
from recordlog.sources import claims, reservations as R, segments as G
from recordlog.streaming import table_store as T
from recordlog.streaming.consume import ConsumerConfig, consume_batch
from recordlog.streaming.manifest import BatchWriter, CommitConflict, drop_attempts, read_batches, read_manifests

LOG_COLS = ["topic", "partition_id", "log_offset", "timestamp", "key", "value", "headers", "event_id"]
SINKS = ("dead_letters", "audit", "commits")


def test_claim_has_one_winner(spark):
    path = tempfile.mkdtemp(prefix="claims-")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: claims.claim(spark, f"{path}/x", {"who": i}), range(8)))
    assert won.count(True) == 1
    assert claims.read_claim(spark, f"{path}/x")["who"] == won.index(True)
    assert claims.children(spark, path) == ["x"] and claims.children(spark, f"{path}/x") == []
    assert claims.read_claim(spark, f"{path}/none") is None


@pytest.mark.parametrize("before", [*SINKS, "manifest"])
def test_a_kill_between_writes_leaves_nothing_or_the_last_whole_batch(spark, fx_small, monkeypatch, before):
    root = tempfile.mkdtemp(prefix="atomic-")
    cfg = ConsumerConfig(out_dir=f"{root}/out", checkpoint=f"{root}/ckpt", threshold=100)
    log = fx_small.log.select(*LOG_COLS)
    first, second = log.filter("topic = 'ev.click'"), log.filter("topic = 'ev.view'")
    consume_batch(first, 0, fixture_results, cfg)
    whole = {s: read_batches(spark, cfg.out_dir, s).count() for s in SINKS}
    write, commit = BatchWriter.write, BatchWriter.commit

    def killed_write(self, sink, df, fmt="parquet"):
        if sink == before:
            raise KeyboardInterrupt(sink)
        write(self, sink, df, fmt)

    def killed_commit(self):
        raise KeyboardInterrupt("manifest")
    monkeypatch.setattr(BatchWriter, "write", killed_write)
    if before == "manifest":
        monkeypatch.setattr(BatchWriter, "commit", killed_commit)
    with pytest.raises(KeyboardInterrupt):
        consume_batch(second, 1, fixture_results, cfg)
    # neither the new batch nor a part of it is seen
    assert {s: read_batches(spark, cfg.out_dir, s).count() for s in SINKS} == whole
    # the batch that stood is not touched by a killed second run either
    with pytest.raises(KeyboardInterrupt):
        consume_batch(first, 0, fixture_results, cfg)
    assert {s: read_batches(spark, cfg.out_dir, s).count() for s in SINKS} == whole
    monkeypatch.setattr(BatchWriter, "write", write)
    monkeypatch.setattr(BatchWriter, "commit", commit)
    consume_batch(second, 1, fixture_results, cfg)
    assert read_batches(spark, cfg.out_dir, "audit").count() == first.count() + second.count()
    assert read_batches(spark, cfg.out_dir, "commits").select("batch_id").distinct().count() == 2
    drop_attempts(spark, cfg.out_dir, list(SINKS), 2)
    assert spark.read.parquet(f"{cfg.out_dir}/audit").count() == first.count() + second.count()


def test_of_two_attempts_at_once_one_commits(spark):
    root = tempfile.mkdtemp(prefix="atomic-two-")
    a, b = BatchWriter(spark, root, 3), BatchWriter(spark, root, 3)
    a.write("s", spark.range(2))
    b.write("s", spark.range(5))
    b.commit()
    with pytest.raises(CommitConflict):
        a.commit()
    assert read_batches(spark, root, "s").count() == 5
    again = BatchWriter(spark, root, 3)  # a later run replaces the batch as a whole
    again.write("s", spark.range(7).withColumn("more", F.lit("x")))
    again.commit()
    assert read_batches(spark, root, "s").columns == ["id", "more", "batch_id"] and read_batches(spark, root, "s").count() == 7
    assert read_manifests(spark, root).count() == 1
    with pytest.raises(FileNotFoundError):
        read_batches(spark, root, "other")


def _records(spark, n, partition="id % 2", topic="'t'", start=0):
    return spark.range(start, start + n).select(
        F.expr(topic).alias("topic"), F.expr(f"cast({partition} as int)").alias("partition_id"),
        F.timestamp_millis("id").alias("timestamp"), F.lit("k").alias("key"), F.col("id").cast("string").alias("value"),
        F.lit(None).cast("map<string,string>").alias("headers"), F.col("id").alias("seq"))


def _ranges(spark, path):
    return sorted((r.topic, r.partition_id, r.base, r.base + r.n) for r in R.reservations(spark, path).collect())


def test_appends_at_the_same_time_get_disjoint_ranges_without_gaps(spark):
    path = tempfile.mkdtemp(prefix="reserved-")
    with ThreadPoolExecutor(3) as pool:
        acks = list(pool.map(lambda i: R.append_reserved(_records(spark, 10 + i, start=100 * i), path, f"r{i}", segment_rows=4).collect(), range(3)))
    ranges = _ranges(spark, path)
    for p in (0, 1):
        of = [(b, e) for _, q, b, e in ranges if q == p]
        assert of[0][0] == 0 and all(x[1] == y[0] for x, y in zip(of, of[1:]))
    log = G.read_segments(spark, path)
    assert log.count() == 33 and log.select("partition_id", "log_offset").distinct().count() == 33
    assert {(r.seq, r.partition_id, r.log_offset) for ack in acks for r in ack} \
        == {(int(r.value), r.partition_id, r.log_offset) for r in log.collect()}


def test_a_repeated_append_gets_its_first_offsets_also_after_a_failure(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="reserved-again-")
    rows = _records(spark, 10)
    first = sorted(map(tuple, R.append_reserved(rows, path, "a").collect()))

    def killed(*_):
        raise KeyboardInterrupt
    for step in ("write_data", "write_index"):  # killed after the reservation, and after the records
        with monkeypatch.context() as m:
            m.setattr(R, step, killed)
            with pytest.raises(KeyboardInterrupt):
                R.append_reserved(_records(spark, 6, start=50), path, step)
    R.append_reserved(_records(spark, 4, start=90), path, "c").collect()
    assert G.read_segments(spark, path).count() == 14
    for step, base in (("write_data", 5), ("write_index", 8)):
        ack = R.append_reserved(_records(spark, 6, start=50), path, step).collect()
        assert sorted(r.log_offset for r in ack if r.partition_id == 0) == [base, base + 1, base + 2]
    assert sorted(map(tuple, R.append_reserved(rows, path, "a").collect())) == first
    log = G.read_segments(spark, path)
    assert log.count() == 26 and sorted(r.log_offset for r in log.filter("partition_id = 1").collect()) == list(range(13))
    with pytest.raises(R.ReservationError):
        R.reserve(spark, path, "a", spark.createDataFrame([("t", 0, 99)], "topic string, partition_id int, n bigint"))


def test_refused_records_have_an_error_and_leave_the_others_alone(spark):
    path = tempfile.mkdtemp(prefix="reserved-refused-")
    rows = _records(spark, 8, partition="case id when 1 then -1 when 2 then null else 0 end", topic="case when id = 3 then '' else 't' end") \
        .withColumn("value", F.when(F.col("seq") == 4, F.repeat(F.lit("x"), 100)).otherwise(F.col("value")))
    ack = {r.seq: r for r in R.append_reserved(rows, path, "q", max_record_bytes=50).collect()}
    assert [ack[i].log_offset for i in range(8)] == [0, None, None, None, None, 1, 2, 3]
    assert "negative" in ack[1].error and "empty" in ack[2].error and "topic" in ack[3].error and "larger" in ack[4].error
    assert all(ack[i].error is None for i in (0, 5, 6, 7))
    # nothing but refused records, and no records: a request all the same
    assert R.append_reserved(rows.filter("seq = 1"), path, "none").count() == 1
    assert R.append_reserved(rows.limit(0), path, "empty").count() == 0
    assert G.read_segments(spark, path).count() == 4


def test_reservations_fold(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="reserved-fold-")
    monkeypatch.setattr(R, "FOLD_EVERY", 2)
    counts = spark.createDataFrame([("t", 0, 5)], "topic string, partition_id int, n bigint")
    bases = [R.reserve(spark, path, f"r{i}", counts).first()["base"] for i in range(5)]
    assert bases == [0, 5, 10, 15, 20]
    assert any(n.startswith("_fold-") for n in claims.children(spark, f"{path}/reservations"))
    assert R.reserve(spark, path, "r1", counts).first()["base"] == 5 and len(_ranges(spark, path)) == 5


def _changes(spark, rows):
    return spark.createDataFrame(rows, "key string, n int, value string")


def test_compaction_changes_no_answer_and_a_lookup_reads_its_bucket(spark):
    path = tempfile.mkdtemp(prefix="table-")
    T.create_table(spark, path, _changes(spark, []).schema, ["key"], buckets=4)
    assert T.read_store(spark, path).count() == 0
    T.write_changes(_changes(spark, [(f"k{i}", 0, "a") for i in range(40)] + [(None, 0, "null key")]), path, 0)
    T.write_changes(_changes(spark, [(f"k{i}", 1, None if i % 4 == 0 else "b") for i in range(20)]), path, 1)

    def answers():
        return (sorted(map(tuple, T.read_store(spark, path).collect()), key=repr),
                sorted(map(tuple, T.lookup(spark, path, [("k0",), ("k1",), (None,), ("no",)]).collect()), key=repr))
    before = answers()
    assert len(before[0]) == 41 - 5 and before[1] == sorted([("k1", 1, "b"), (None, 0, "null key")], key=repr)
    assert T.compact(spark, path) and not T.compact(spark, path)
    assert answers() == before
    T.write_changes(_changes(spark, [(f"k{i}", 1, None if i % 4 == 0 else "b") for i in range(20)]), path, 1)  # run again
    assert answers() == before
    T.drop_merged(spark, path)
    assert answers() == before
    T.write_changes(_changes(spark, [("k0", 2, "back"), ("k1", 2, None)]), path, 2)
    assert T.lookup(spark, path, [("k0",), ("k1",)]).collect() == [("k0", 2, "back")]
    assert T.lookup(spark, path, []).count() == 0
    found = T.lookup(spark, path, [("k7",)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan, plan
    assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}) >= 1
    read = T.lookup(spark, path, [("k7",)]).select(F.lit(1)).agg(F.count(F.lit(1))).first()[0]
    assert read == 1
    with pytest.raises(ValueError):
        T.create_table(spark, path, _changes(spark, []).schema, ["n"], buckets=4)


def test_two_compactions_at_once(spark):
    path = tempfile.mkdtemp(prefix="table-two-")
    T.create_table(spark, path, _changes(spark, []).schema, ["key"], buckets=2)
    T.write_changes(_changes(spark, [("a", 0, "x"), ("b", 0, "y")]), path, 0)
    with ThreadPoolExecutor(2) as pool:
        won = list(pool.map(lambda _: T.compact(spark, path), range(2)))
    assert any(won) and T.read_store(spark, path).count() == 2


def test_interval_join_bounds_its_state_and_outer_rows_come_out(spark, fx_small):
    from recordlog.streaming.joins import interval_join
    from recordlog.streaming.push import push_query
    root = tempfile.mkdtemp(prefix="interval-")
    ts = "timestamp_seconds(1700000000 + id * 3600)"  # a stream drops records of 1970-01-01T00:00, where its watermark begins
    left = spark.range(60).select("id", F.expr(ts).alias("sent"))
    right = spark.range(0, 60, 2).select("id", F.expr(f"{ts} + interval 30 minutes").alias("got"))
    for k in range(3):
        left.filter(f"id div 20 = {k}").write.mode("append").parquet(f"{root}/l")
        right.filter(f"id div 20 = {k}").write.mode("append").parquet(f"{root}/r")
        streams = [spark.readStream.schema(f.schema).parquet(f"{root}/{d}") for f, d in ((left, "l"), (right, "r"))]
        q = push_query(interval_join(*streams, ["id"], "sent", "got", "1 hour", "2 hours", "left_outer"), None, f"{root}/out", f"{root}/ckpt")
        q.awaitTermination()
        kept = max(p["stateOperators"][0]["numRowsTotal"] for p in [q.lastProgress])
        assert kept < 20  # of up to 90 rows that have come, those that may still meet one
    out = spark.read.parquet(f"{root}/out")
    assert out.filter("got is not null").count() == 30
    unmatched = {r.id for r in out.filter("got is null").collect()}
    assert unmatched and all(i % 2 for i in unmatched) and max(unmatched) < 60
    batch = interval_join(left, right, ["id"], "sent", "got", "1 hour", "2 hours")
    assert batch.count() == 30
    with pytest.raises(ValueError):
        interval_join(left, right, ["id"], "sent", "got", "1 hour", "2 hours", "full")


def test_posted_failures_are_stored_once_and_every_result_is_audited(spark, fx_small):
    from recordlog.streaming.deadletters import post_failures
    path = tempfile.mkdtemp(prefix="posted-")
    results = fx_small.results.filter("topic = 'ev.click'")
    failed = results.filter("processed = false").count()
    for _ in range(2):
        ack, audit = post_failures(results, path, "p", 1735689600000)
        assert ack.filter("error is null").count() == ack.count() == failed and audit.count() == results.count()
    stored = G.read_segments(spark, path)
    assert stored.count() == failed and {r[0] for r in stored.select("topic").distinct().collect()} == {"ev.click.dlq"}
    row = stored.filter("headers['X-Stack-Trace'] is not null").first()
    assert row["headers"]["X-Stack-Trace"] == "error happened"


def test_dead_letters_on_their_last_retry_are_not_queued_again(spark, fx_small):
    from recordlog.streaming.deadletters import replay_dead_letters
    root = tempfile.mkdtemp(prefix="last-retry-")
    fx_small.dlq.select(*LOG_COLS).write.parquet(f"{root}/in")
    cfg = ConsumerConfig(out_dir=f"{root}/out", checkpoint=f"{root}/ckpt", threshold=100)

    def source():
        return spark.readStream.schema(fx_small.dlq.select(*LOG_COLS).schema).parquet(f"{root}/in")
    assert replay_dead_letters(source, "ev.click", fixture_results, cfg) == 1
    assert read_batches(spark, cfg.out_dir, "dead_letters").count() == 0
    assert read_batches(spark, cfg.out_dir, "audit").count() == fx_small.dlq.filter("topic = 'ev.click.dlq'").count()
