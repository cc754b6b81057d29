"""Selecting records from a log DataFrame: subscription, assignment, seeking, bounded fetch.

All of them are filters or joins on (topic, partition_id, log_offset), so on a
stored log partitioned by topic the topic predicates prune folders and offset
predicates reach the parquet scan.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DLQ_EXT, MAX_FETCH_BYTES, MAX_POLL_RECORDS
from ..functions.names import parse_topic_list
from ._args import any_of, as_frame, join_checked, small_frame

TP = ["topic", "partition_id"]
#: Pairs of a list that become a filter; longer lists are joined.
MAX_FILTERED = 200


def subscribe(df: DataFrame, topics: str | list[str]) -> DataFrame:
    """Records of the listed topics (a comma text is parsed as the original service does)."""
    names = parse_topic_list(topics) if isinstance(topics, str) else list(topics)
    return df.filter(F.col("topic").isin(names))


def subscribe_pattern(df: DataFrame, pattern: str) -> DataFrame:
    """Records of the topics whose whole name matches the Java regex ``pattern``."""
    return df.filter(F.col("topic").rlike(f"^(?:{pattern})$"))


def union_topics(*dfs: DataFrame) -> DataFrame:
    """One log from several subscriptions (columns by name, missing ones null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _tp_filter(pairs) -> F.Column:
    by_topic: dict[str, set[int]] = {}
    for t, p in pairs:
        by_topic.setdefault(t, set()).add(int(p))
    return any_of([(F.col("topic") == t) & F.col("partition_id").isin(sorted(ps)) for t, ps in by_topic.items()])


def assign(df: DataFrame, partitions) -> DataFrame:
    """Records of exactly the listed topic-partitions.

    ``partitions``: list of (topic, partition_id) -- becomes a scan filter, beyond
    ``MAX_FILTERED`` pairs a join with the list -- or a DataFrame with those two columns --
    a left semi join."""
    if not isinstance(partitions, DataFrame):
        pairs = sorted({(t, int(p)) for t, p in partitions})
        if len(pairs) <= MAX_FILTERED:
            return df.filter(_tp_filter(pairs))
        partitions = small_frame(df.sparkSession, pairs, "topic string, partition_id int")
        return df.join(partitions, TP, "left_semi")
    return df.join(partitions.select(*TP), TP, "left_semi")


def seek(df: DataFrame, positions) -> DataFrame:
    """Records of the listed partitions from the given offset on.

    ``positions``: list of (topic, partition_id, log_offset) -- of several positions of one
    partition the least counts -- or a DataFrame with those columns (``log_offset`` is the
    position, one row per partition)."""
    if not isinstance(positions, DataFrame):
        least: dict[tuple, int] = {}
        for t, p, o in positions:
            least[t, int(p)] = min(int(o), least.get((t, int(p)), int(o)))
        if len(least) <= MAX_FILTERED:
            return df.filter(any_of([(F.col("topic") == t) & (F.col("partition_id") == p) & (F.col("log_offset") >= o)
                                     for (t, p), o in least.items()]))
        pos = small_frame(df.sparkSession, [(t, p, o) for (t, p), o in least.items()], "topic string, partition_id int, _pos bigint")
        return df.join(pos, TP).filter(F.col("log_offset") >= F.col("_pos")).drop("_pos")
    pos = positions.select(*TP, F.col("log_offset").cast("bigint").alias("_pos"))
    return join_checked(df, pos, TP).filter(F.col("log_offset") >= F.col("_pos")).drop("_pos")


def _ts_ms(ts) -> int:
    import datetime as dt
    if isinstance(ts, (int, float)):
        return int(ts)
    if isinstance(ts, str):
        ts = dt.datetime.fromisoformat(ts.replace("Z", "+00:00"))
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=dt.timezone.utc)
    return int(ts.timestamp() * 1000)


def timestamp_positions(df: DataFrame, timestamps) -> DataFrame:
    """Per listed partition, the earliest offset whose record time is >= the given time
    (epoch millis, ISO text or datetime; naive = UTC).  Partitions without such a
    record get no row."""
    req = as_frame(df, [(t, int(p), _ts_ms(ts)) for t, p, ts in timestamps]
                   if not isinstance(timestamps, DataFrame) else timestamps,
                   "topic string, partition_id int, ts_ms bigint")
    return (df.join(req, TP)
            .filter(F.unix_millis("timestamp") >= F.col("ts_ms"))
            .groupBy(*TP).agg(F.min("log_offset").alias("log_offset")))


def seek_timestamps(df: DataFrame, timestamps) -> DataFrame:
    """Records from the first offset at or after the given time, per listed partition."""
    pos = timestamp_positions(df, timestamps)
    if not isinstance(timestamps, DataFrame):
        p = pos.select(*TP, F.col("log_offset").alias("_pos"))
        return join_checked(df, p, TP).filter(F.col("log_offset") >= F.col("_pos")).drop("_pos")
    return seek(df, pos)


def _bounds_for(df: DataFrame, partitions) -> DataFrame:
    req = as_frame(df, partitions, "topic string, partition_id int").select(*TP)
    b = assign(df, req).groupBy(*TP).agg(F.min("log_offset").alias("first"), F.max("log_offset").alias("last"))
    return req.join(b, TP, "left")


def seek_to_beginning(df: DataFrame, partitions) -> DataFrame:
    """Position (first offset; 0 for an empty partition) of each listed partition."""
    return _bounds_for(df, partitions).select(*TP, F.coalesce("first", F.lit(0)).cast("bigint").alias("position"))


def seek_to_end(df: DataFrame, partitions) -> DataFrame:
    """Position after the last record (last + 1; 0 for an empty partition): reading from
    there gives no rows until new records arrive."""
    return _bounds_for(df, partitions).select(*TP, F.coalesce(F.col("last") + 1, F.lit(0)).cast("bigint").alias("position"))


def resume(df: DataFrame, commits: DataFrame, group: str, reset: str = "earliest") -> DataFrame:
    """Records after the group's last committed offset of each partition.

    Partitions without a commit start at the first record (``earliest``) or
    after the last one (``latest``, i.e. nothing yet)."""
    from .offsets import latest_commits
    if reset not in ("earliest", "latest"):
        raise ValueError("reset must be 'earliest' or 'latest'")
    last = latest_commits(commits, group).select(*TP, F.col("log_offset").alias("_committed"))
    j = join_checked(df, last, TP, "left")
    keep = F.col("log_offset") > F.col("_committed")
    keep = F.coalesce(keep, F.lit(reset == "earliest"))
    return j.filter(keep).drop("_committed")


def fetch(df: DataFrame, max_records: int = MAX_POLL_RECORDS) -> DataFrame:
    """The first ``max_records`` records of each partition (after positioning): an offset filter,
    then a rank over the few rows that pass it (see ``_ranked``)."""
    return _ranked(df, max_records).drop("_rank")


def _ranked(df: DataFrame, max_records: int) -> DataFrame:
    """The first ``max_records`` rows of each partition with their rank.

    Offsets grow by one where nothing is missing, so the rows wanted lie below first offset +
    ``max_records``: a filter, whose highest value reaches the scan, instead of a sort of the
    whole log.  Partitions that come up short of it (gaps in their offsets) are ranked whole."""
    from ..session import checkpoint_root
    w = Window.partitionBy(*TP).orderBy("log_offset")
    rank = F.row_number().over(w)
    checkpoint_root(df.sparkSession)
    ends = df.groupBy(*TP).agg(F.min("log_offset").alias("_first"), F.max("log_offset").alias("_last")).checkpoint(eager=True)
    top = ends.agg(F.max("_first")).first()[0]
    if top is None:
        return df.limit(0).withColumn("_rank", F.lit(1))
    near = join_checked(df.filter(F.col("log_offset") < top + max_records), ends, TP, null_safe=True) \
        .filter(F.col("log_offset") < F.col("_first") + max_records)
    short = near.groupBy(*TP, "_first", "_last").agg(F.count(F.lit(1)).alias("_n")) \
        .filter((F.col("_n") < max_records) & (F.col("_last") >= F.col("_first") + max_records)).select(*TP).checkpoint(eager=True)
    # an offset may stand more than once, so the rank decides here too
    found = near.drop("_first", "_last").withColumn("_rank", rank).filter(F.col("_rank") <= max_records)
    if short.isEmpty():
        return found
    whole = join_checked(df, short, TP, "left_semi", null_safe=True).withColumn("_rank", rank).filter(F.col("_rank") <= max_records)
    return join_checked(found, short, TP, "left_anti", null_safe=True).select(*whole.columns).unionByName(whole)


def record_bytes() -> F.Column:
    return (F.coalesce(F.octet_length(F.col("key")), F.lit(0))
            + F.coalesce(F.octet_length(F.col("value")), F.lit(0))).cast("bigint")


def fetch_bytes(df: DataFrame, max_bytes: int = MAX_FETCH_BYTES, max_records: int = MAX_POLL_RECORDS) -> DataFrame:
    """Records of each partition up to ``max_records`` and a running byte budget.

    The first record is always returned, even when it alone is over the budget;
    ``max_bytes <= 0`` means no byte limit.  The running sum is taken over the
    at most ``max_records`` rows per partition that survive the count limit."""
    return within_bytes(_ranked(df, max_records), max_bytes)


def within_bytes(ranked: DataFrame, max_bytes: int) -> DataFrame:
    """Ranked rows (``_rank`` from 1 in each partition) up to a running byte budget, without the rank."""
    if max_bytes <= 0:
        return ranked.drop("_rank")
    w = Window.partitionBy(*TP).orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    return (ranked.withColumn("_run", F.sum(record_bytes()).over(w))
            .filter((F.col("_rank") == 1) | (F.col("_run") <= max_bytes))
            .drop("_run", "_rank"))


def first_n(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` records of every partition, by offset."""
    return fetch(df, n)


def log_order(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Records in log order: (topic, partition_id, log_offset) ascending across and within
    tasks.  Range partitioning on all three keys splits a hot partition into offset
    ranges instead of sending it to one task."""
    keys = [*TP, "log_offset"]
    d = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return d.sortWithinPartitions(*keys)


def read_dead_letters(df: DataFrame, topics: str | list[str], ext: str = DLQ_EXT) -> DataFrame:
    """Records of the dead-letter topics of the listed topics (name + ``ext``)."""
    names = parse_topic_list(topics) if isinstance(topics, str) else list(topics)
    return subscribe(df, [t + ext for t in names])


def topics_not_configured(requested: DataFrame, configured, col: str = "topic") -> DataFrame:
    """Requested topic names that are not configured (anti join; distinct)."""
    conf = as_frame(requested, [(t,) for t in (parse_topic_list(configured) if isinstance(configured, str)
                                                  else configured)], f"{col} string") \
        if not isinstance(configured, DataFrame) else configured.select(col)
    return requested.select(col).distinct().join(conf, col, "left_anti")
