"""Segmented logs: whatever is asked through the index equals the same question put to all records."""
import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from recordlog.operators import select as S
from recordlog.session import scratch_path
from recordlog.sources import segments as G
from recordlog.sources import stream as ST
from recordlog.sources.log import LOG_SCHEMA

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def row(topic, p, o, ms, size=5):
    return topic, p, o, T0 + dt.timedelta(milliseconds=ms), f"k{o}", "v" * size, {"n": str(o)}


def awkward(seed=1):
    """Gaps, repeated offsets, late times, a null partition, one partition much longer than the others."""
    r = random.Random(seed)
    rows = [row("a", 0, o, o * 10 - (700 if o % 17 == 0 else 0), r.randint(0, 40)) for o in range(300) if o % 7]
    rows += [row("a", 1, 5 + 3 * k, 5000 - k) for k in range(40)]          # times fall as offsets rise
    rows += [row("b", 0, o, o) for o in range(20) for _ in range(3)]       # each offset three times
    rows += [row("b", None, o, o) for o in range(9)] + [row("b", 7, 1000, 1)]
    return rows


def log_of(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


@pytest.fixture(scope="module")
def log(spark):
    path = scratch_path(spark, "segments")
    rows = awkward()
    G.write_segments(log_of(spark, rows[::2]), path, segment_rows=16)
    G.write_segments(log_of(spark, rows[1::2]), path, segment_rows=25)
    return path, rows


def key(r):
    return str(r["topic"]), str(r["partition_id"]), r["log_offset"], r["timestamp"].timestamp()


def test_all_records_and_bounds(spark, log):
    path, rows = log
    every = G.read_segments(spark, path)
    assert sorted(map(key, every.collect())) == sorted(map(key, log_of(spark, rows).collect()))
    want = log_of(spark, rows).groupBy("topic", "partition_id").agg(F.min("log_offset"), F.max("log_offset"), F.count("*"), F.max("log_offset") + 1)
    assert sorted(map(str, map(tuple, G.index_bounds(G.read_index(spark, path)).collect()))) == sorted(map(str, map(tuple, want.collect())))


@pytest.mark.parametrize("n", [1, 3, 30, 1000])
@pytest.mark.parametrize("max_bytes", [0, 120])
def test_fetch_equals_a_sort_of_everything(spark, log, n, max_bytes):
    path, rows = log
    got = [key(r) for r in G.fetch_segments(spark, path, n, max_bytes).collect()]
    parts = {}
    for r in sorted((x for x in rows), key=lambda x: x[2]):
        parts.setdefault((r[0], r[1]), []).append(r)
    for (t, p), own in parts.items():
        size, run = 0, 0
        for r in own[:n]:
            run += len(r[4]) + len(r[5])
            if max_bytes and size and run > max_bytes:
                break
            size += 1
        offsets = sorted(k[2] for k in got if k[:2] == (str(t), str(p)))
        assert offsets == [r[2] for r in own[:size]], (t, p)
    whole = S.fetch_bytes(log_of(spark, rows), max_bytes, n)
    assert sorted(k[:3] for k in got) == sorted(key(r)[:3] for r in whole.collect())


def test_fetch_and_read_from_positions(spark, log):
    path, rows = log
    at = {("a", 0): 100, ("a", 1): 6, ("b", 0): 19, ("b", None): 3, ("b", 7): 2000}
    pos = spark.createDataFrame([(t, p, o) for (t, p), o in at.items()], "topic string, partition_id int, log_offset bigint")
    after = sorted((str(r[0]), str(r[1]), r[2]) for r in rows if r[2] >= at[r[0], r[1]])
    assert sorted(key(r)[:3] for r in G.read_from(spark, path, pos).collect()) == after
    got = sorted(key(r)[:3] for r in G.fetch_segments(spark, path, 4, positions=pos).collect())
    assert got == sorted(x for t, p in at for x in [y for y in after if y[:2] == (t, str(p))][:4])


@pytest.mark.parametrize("ms", [-1000, 0, 1500, 2111, 4980, 10**6])
def test_seek_by_time_with_late_records(spark, log, ms):
    path, rows = log
    asked = [("a", 0, T0 + dt.timedelta(milliseconds=ms)), ("a", 1, T0 + dt.timedelta(milliseconds=ms)), ("b", 0, T0 + dt.timedelta(milliseconds=ms)), ("x", 0, T0)]
    got = sorted(tuple(r) for r in G.time_positions(spark, path, asked).collect())
    least = {}
    for t, p, o, ts, *_ in rows:
        if (t, p) in {a[:2] for a in asked} and ts >= T0 + dt.timedelta(milliseconds=ms):
            least[t, p] = min(o, least.get((t, p), o))
    assert got == sorted((t, p, o) for (t, p), o in least.items())


def test_plans_read_the_index_and_named_segments_only(spark, log):
    path, _ = log
    bounds = G.index_bounds(G.read_index(spark, path))
    assert bounds.inputFiles() and all("/index/" in f for f in bounds.inputFiles())
    every = set(G.read_segments(spark, path).inputFiles())
    fetched = set(G.fetch_segments(spark, path, 10).inputFiles())
    assert fetched < every and len(fetched) < len(every) / 2
    pos = G.time_positions(spark, path, [("a", 0, T0 + dt.timedelta(milliseconds=2000))])
    opened = {f for f in pos.inputFiles() if "/data/" in f}
    assert opened < every and len(opened) < len(every) / 4


def test_many_named_segments_are_joined(spark, log, monkeypatch):
    path, rows = log
    whole = sorted(key(r)[:3] for r in G.fetch_segments(spark, path, 10).collect())
    monkeypatch.setattr(G, "MAX_NAMED", 2)
    assert sorted(key(r)[:3] for r in G.fetch_segments(spark, path, 10).collect()) == whole


def test_an_append_without_its_index_is_not_there(spark):
    import os
    path = scratch_path(spark, "segments-torn")
    G.write_segments(log_of(spark, awkward()[:50]), path, segment_rows=16)
    before = G.read_segments(spark, path).count()
    torn = G.write_segments(log_of(spark, awkward()[50:90]), path, segment_rows=16)
    os.remove(f"{path.removeprefix('file:')}/index/{torn}/_SUCCESS")  # as if the job had died before its commit
    assert G.read_segments(spark, path).count() == before == G.index_bounds(G.read_index(spark, path)).agg(F.sum("n_records")).first()[0]


def test_append_continues_from_the_index(spark):
    path = scratch_path(spark, "segments-append")
    new = spark.createDataFrame([(k, "t", k % 2, T0, "k", "v", None) for k in range(11)],
                                "seq bigint, topic string, partition_id int, timestamp timestamp, key string, value string, headers map<string,string>")
    for turn in range(2):
        ack = sorted(tuple(r) for r in G.append_segments(new, path).collect())
        assert ack == sorted((k, "t", k % 2, k // 2 + turn * (6 if k % 2 == 0 else 5)) for k in range(11))
    empty = G.append_segments(new.limit(0), path)
    assert empty.count() == 0 and G.index_bounds(G.read_index(spark, path)).agg(F.sum("n_records")).first()[0] == 22


def drained(spark, stream, checkpoint):
    """What the stream gives until it has no more."""
    rows = []
    q = stream.writeStream.foreachBatch(lambda df, _: rows.extend(df.collect())).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    return sorted(key(r)[:3] for r in rows)


def test_stream_starts(spark, log):
    path, rows = log
    some = [(str(r[0]), str(r[1]), r[2]) for r in rows if r[1] is not None]
    assert drained(spark, ST.stream_segments(spark, path), scratch_path(spark, "c")) == sorted(some)
    assert drained(spark, ST.stream_segments(spark, path, "latest"), scratch_path(spark, "c")) == []
    got = drained(spark, ST.stream_segments(spark, path, [("a", 0, 250), ("b", 0, 18), ("a", 1, 10**6), ("b", 7, 0)]), scratch_path(spark, "c"))
    at = {("a", "0"): 250, ("b", "0"): 18, ("a", "1"): 10**6, ("b", "7"): 0}
    assert got == sorted(x for x in some if x[2] >= at[x[:2]])
    got = drained(spark, ST.stream_segments(spark, path, {"timestamps": [("a", 0, T0 + dt.timedelta(milliseconds=2500)), ("b", 0, T0 + dt.timedelta(days=9))]}), scratch_path(spark, "c"))
    least = min(r[2] for r in rows if r[:2] == ("a", 0) and r[3] >= T0 + dt.timedelta(milliseconds=2500))
    assert got == sorted(x for x in some if x[:2] != ("b", "0") and (x[:2] != ("a", "0") or x[2] >= least))


def test_stream_goes_on_exactly_after_a_restart(spark):
    path, checkpoint = scratch_path(spark, "segments-stream"), scratch_path(spark, "c")
    G.write_segments(log_of(spark, [row("a", 0, o, o) for o in range(10)]), path, segment_rows=4)
    commits = spark.createDataFrame([("g", "a", 0, 2, 1), ("g", "a", 0, 5, 2), ("h", "a", 0, 9, 3)],
                                    "consumer_group string, topic string, partition_id int, log_offset bigint, committed_at bigint")
    first = drained(spark, ST.stream_segments(spark, path, commits=commits, group="g"), checkpoint)
    assert [x[2] for x in first] == [6, 7, 8, 9]
    G.write_segments(log_of(spark, [row("a", 0, o, o) for o in range(10, 13)] + [row("n", 2, o, o) for o in range(2)]), path, segment_rows=4)
    again = drained(spark, ST.stream_segments(spark, path, "earliest"), checkpoint)  # the checkpoint decides, not the argument
    assert again == [("a", "0", 10), ("a", "0", 11), ("a", "0", 12), ("n", "2", 0), ("n", "2", 1)]
    assert drained(spark, ST.stream_segments(spark, path), checkpoint) == []


def test_appends_that_run_side_by_side_are_both_there(spark):
    path = scratch_path(spark, "segments-both")
    work = [threading.Thread(target=G.write_segments, args=(log_of(spark, [row(t, 0, o, o) for o in range(30)]), path, 8)) for t in "xyz"]
    for w in work:
        w.start()
    for w in work:
        w.join()
    assert G.read_segments(spark, path).count() == 90
