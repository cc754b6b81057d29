"""A stored log with a sparse index: one index row per segment.

A *segmented log* is a folder.  Each append writes its records as segments -- the records of one
topic-partition in one range of ``segment_rows`` offsets, in a folder of their own -- and then one
index row per segment: first and last offset, number of records, least and greatest time, bytes.
The index of an append is written last and counts once its job has committed, so readers see all of
an append or nothing.

Bounds and the base of an append come from the index alone.  A bounded fetch and a seek by time
ask the index which segments can hold the answer, and only those are opened; nothing is assumed
about offsets and times but what the index says, so gaps, repeated offsets and late times are fine:

* the first ``n`` records lie at or below the least last offset at which the segments that end there
  or before, and begin at or after the position, hold ``n`` records;
* the first offset at or after a time lies at or before the least first offset of the segments that
  hold no earlier time, and else in a segment that holds a time at or after it.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import MAX_POLL_RECORDS, OFFSET_CHUNK
from ..operators._args import as_frame
from ..operators.numbering import chunk_of, floor_div, null_safe_join, number_within
from ..operators.select import _ts_ms, record_bytes, within_bytes

TP = ["topic", "partition_id"]
INDEX_DDL = ("topic string, partition_id int, first_offset bigint, last_offset bigint, n_records bigint, "
             "min_ms bigint, max_ms bigint, bytes bigint, write_id string, segment string")
#: Segments that are opened by name; beyond it the folders are filtered by a join with the index rows.
MAX_NAMED = 10_000


def write_segments(df: DataFrame, path: str, segment_rows: int = OFFSET_CHUNK, num_files: int | None = None) -> str:
    """Append the records of ``df`` (offsets set) to the segmented log at ``path``; returns the id of the append.

    The records of a segment go to one task, which writes them in log order; a hot partition is as
    many segments as its offsets need, so it spreads over tasks."""
    write_id = uuid.uuid4().hex
    schema = write_data(df, path, write_id, segment_rows, num_files)
    write_index(df.sparkSession, path, write_id, schema)
    return write_id


def write_data(df: DataFrame, path: str, write_id: str, segment_rows: int = OFFSET_CHUNK, num_files: int | None = None) -> StructType:
    """The segments of an append; no reader sees them before ``write_index``.  Returns their schema."""
    key = F.concat(F.lit("s"), F.hex(F.xxhash64("topic")), F.lit("-"), F.coalesce(F.col("partition_id").cast("string"), F.lit("none")),
                   F.lit("-"), floor_div(F.col("log_offset"), segment_rows).cast("string"))
    d = df.withColumn("segment", key)
    d = d.repartition(num_files, "segment") if num_files else d.repartition("segment")
    d.sortWithinPartitions("segment", *TP, "log_offset").write.partitionBy("segment").parquet(f"{path}/data/write_id={write_id}")
    return d.schema


def index_rows(spark: SparkSession, path: str, write_id: str, schema: StructType) -> DataFrame:
    """One row per segment of an append, from its stored records."""
    ms = F.unix_millis("timestamp")
    index = (spark.read.schema(schema).parquet(f"{path}/data/write_id={write_id}").groupBy(*TP, "segment")
             .agg(F.min("log_offset").alias("first_offset"), F.max("log_offset").alias("last_offset"), F.count(F.lit(1)).alias("n_records"),
                  F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"), F.sum(record_bytes()).alias("bytes")))
    return index.select(*TP, "first_offset", "last_offset", "n_records", "min_ms", "max_ms", "bytes",
                        F.lit(write_id).alias("write_id"), "segment")


def write_index(spark: SparkSession, path: str, write_id: str, schema: StructType) -> None:
    """Commit an append: its index rows, the same ones if it is called again."""
    index_rows(spark, path, write_id, schema).write.mode("overwrite").parquet(f"{path}/index/{write_id}")


def _committed(spark: SparkSession, path: str) -> list[str]:
    """Index folders of the appends that have committed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/index")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    found = [f.getPath() for f in fs.listStatus(at) if f.isDirectory()]
    return sorted(str(p) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index rows of all committed appends."""
    folders = _committed(spark, path)
    return spark.read.schema(INDEX_DDL).parquet(*folders) if folders else spark.createDataFrame([], INDEX_DDL)


def read_segments(spark: SparkSession, path: str, named: DataFrame | None = None) -> DataFrame:
    """The records of the log, or of the segments that ``named`` (rows of the index) lists."""
    segments = [] if named is None else \
        [(r[0], r[1]) for r in named.select("write_id", "segment").distinct().limit(MAX_NAMED + 1).collect()]
    base = f"{path}/data"
    writes = sorted({f.rsplit("/", 1)[-1] for f in _committed(spark, path)})
    if not writes:
        raise FileNotFoundError(f"no append has committed in {path}")
    # an append of no records leaves no segment to take the columns from
    schema = next((s for s in (_schema(spark, f"{base}/write_id={w}") for w in writes) if s is not None), None)
    if schema is None:
        raise FileNotFoundError(f"no append of {path} holds records")
    reader = spark.read.schema(schema).option("basePath", base)
    if named is not None and len(segments) <= MAX_NAMED:
        if not segments:
            return spark.createDataFrame([], schema)
        return reader.parquet(*[f"{base}/write_id={w}/segment={s}" for w, s in segments]).drop("write_id", "segment")
    found = reader.parquet(*[f"{base}/write_id={w}" for w in writes])
    if named is not None:
        found = found.join(named.select("write_id", "segment").distinct(), ["write_id", "segment"], "left_semi")
    return found.drop("write_id", "segment")


def _schema(spark: SparkSession, folder: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at) or not any(s.getPath().getName().startswith("segment=") for s in fs.listStatus(at)):
        return None
    return StructType([f for f in spark.read.parquet(folder).schema if f.name not in ("write_id", "segment")])


def index_bounds(index: DataFrame) -> DataFrame:
    """first, last and next offset and record count of every topic-partition, from the index alone."""
    return (index.groupBy(*TP)
            .agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"), F.sum("n_records").alias("n_records"))
            .withColumn("next_offset", F.col("last_offset") + 1))


def _positioned(index: DataFrame, positions: DataFrame | None) -> DataFrame:
    """Index rows that reach the position (``_pos``) of their topic-partition; without positions all of them."""
    if positions is None:
        return index.withColumn("_pos", F.lit(None).cast("bigint"))
    pos = positions.select(*TP, F.col("log_offset").cast("bigint").alias("_pos"))
    return null_safe_join(index, pos, TP).filter(F.col("last_offset") >= F.col("_pos"))


def first_segments(index: DataFrame, n: int, positions: DataFrame | None = None) -> DataFrame:
    """Index rows of the segments that hold the first ``n`` records of each topic-partition (from its position on)."""
    rows = _positioned(index, positions)
    whole = F.when(F.col("_pos").isNull() | (F.col("first_offset") >= F.col("_pos")), F.col("n_records")).otherwise(0)
    upto = Window.partitionBy(*TP).orderBy("last_offset").rangeBetween(Window.unboundedPreceding, 0)
    enough = F.when(F.sum(whole).over(upto) >= n, F.col("last_offset"))
    least = F.min("_enough").over(Window.partitionBy(*TP))
    found = rows.withColumn("_enough", enough).withColumn("_least", least)
    return found.filter(F.col("_least").isNull() | (F.col("first_offset") <= F.col("_least"))).drop("_enough", "_least", "_pos")


def fetch_segments(spark: SparkSession, path: str, max_records: int = MAX_POLL_RECORDS, max_bytes: int = 0,
                   positions: DataFrame | None = None) -> DataFrame:
    """The first ``max_records`` records of each topic-partition, from its position (topic, partition_id, log_offset)
    on where ``positions`` are given (partitions without one are left out), within a running byte budget when
    ``max_bytes`` > 0.  Only the segments that the index names are read."""
    rows = read_segments(spark, path, first_segments(read_index(spark, path), max_records, positions))
    if positions is not None:
        pos = positions.select(*TP, F.col("log_offset").cast("bigint").alias("_pos"))
        rows = null_safe_join(rows, pos, TP).filter(F.col("log_offset") >= F.col("_pos")).drop("_pos")
    rank = F.row_number().over(Window.partitionBy(*TP).orderBy("log_offset"))
    first = rows.withColumn("_rank", rank).filter(F.col("_rank") <= max_records)
    return within_bytes(first, max_bytes)


def time_positions(spark: SparkSession, path: str, timestamps) -> DataFrame:
    """Per listed topic-partition the earliest offset whose record time is at or after the given one (epoch millis, ISO
    text or datetime; naive = UTC; or a DataFrame topic, partition_id, ts_ms).  Partitions without such a record get no row."""
    index = read_index(spark, path)
    asked = as_frame(index, timestamps if isinstance(timestamps, DataFrame) else [(t, int(p), _ts_ms(ts)) for t, p, ts in timestamps],
                     "topic string, partition_id int, ts_ms bigint")
    rows = null_safe_join(index, asked, TP).filter(F.col("max_ms") >= F.col("ts_ms"))
    # a segment without earlier times has its answer in the index; those that hold earlier ones are opened if they begin before it
    least = F.min(F.when(F.col("min_ms") >= F.col("ts_ms"), F.col("first_offset"))).over(Window.partitionBy(*TP))
    rows = rows.withColumn("_least", least)
    mixed = rows.filter((F.col("min_ms") < F.col("ts_ms")) & (F.col("_least").isNull() | (F.col("first_offset") < F.col("_least"))))
    known = rows.filter(F.col("_least").isNotNull()).select(*TP, F.col("_least").alias("log_offset"))
    opened = null_safe_join(read_segments(spark, path, mixed.select("write_id", "segment")), asked, TP) \
        .filter(F.unix_millis("timestamp") >= F.col("ts_ms")).select(*TP, "log_offset")
    return known.unionByName(opened).groupBy(*TP).agg(F.min("log_offset").alias("log_offset"))


def read_from(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """Records from the given offset of each listed topic-partition on; earlier segments are not opened."""
    rows = read_segments(spark, path, _positioned(read_index(spark, path), positions))
    pos = positions.select(*TP, F.col("log_offset").cast("bigint").alias("_pos"))
    return null_safe_join(rows, pos, TP).filter(F.col("log_offset") >= F.col("_pos")).drop("_pos")


def resume_positions(spark: SparkSession, path: str, commits: DataFrame, group: str, reset: str = "earliest") -> DataFrame:
    """Position of every topic-partition of the log for ``group``: after its last commit, else its first offset
    (``earliest``) or the end (``latest``)."""
    from ..operators.offsets import latest_commits
    if reset not in ("earliest", "latest"):
        raise ValueError("reset must be 'earliest' or 'latest'")
    bounds = index_bounds(read_index(spark, path))
    last = latest_commits(commits, group).select(*TP, F.col("log_offset").alias("_committed"))
    start = F.col("first_offset" if reset == "earliest" else "next_offset")
    return null_safe_join(bounds, last, TP, "left").select(*TP, F.coalesce(F.col("_committed") + 1, start).alias("log_offset"))


def append_segments(df: DataFrame, path: str, seq: str = "seq", chunk: Column | None = None,
                    segment_rows: int = OFFSET_CHUNK) -> DataFrame:
    """Give the rows the next offsets of their topic-partitions (from the index, 0 for a new one, ordered by ``seq``), store
    them, and return the acknowledgement (seq, topic, partition_id, log_offset) read back from what was stored."""
    spark = df.sparkSession
    base = index_bounds(read_index(spark, path)).select(*TP, F.col("next_offset").alias("base"))
    rows = df.drop("log_offset") if "log_offset" in df.columns else df
    numbered = number_within(rows, TP, [seq], chunk if chunk is not None else chunk_of(seq), base=base)
    write_id = write_segments(numbered, path, segment_rows)
    return spark.read.schema(numbered.schema).parquet(f"{path}/data/write_id={write_id}").select(seq, *TP, "log_offset")
