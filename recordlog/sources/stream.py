"""A segmented log as a stream source: the stream's offset is one position per topic-partition.

``stream_segments`` starts at the earliest or latest record, at given offsets, at times or after a
group's commits.  Positions are found by Spark from the index (and the commits table) when the
stream is made, and count for a new query only: a restarted one goes on from its checkpoint.  Each
micro-batch reads, of the segments that reach over its range, one per task; the planner reads
nothing but index rows that it has not seen.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from .segments import TP, index_bounds, read_index, read_segments, time_positions

FORMAT = "recordlog"


def starting_positions(spark: SparkSession, path: str, starting="earliest", commits: DataFrame | None = None,
                       group: str | None = None) -> dict[str, dict[str, int]]:
    """Position per topic and partition, for partitions that need one (others start at their first record).

    ``starting``: ``earliest``, ``latest``, a list of (topic, partition_id, log_offset), or
    ``{"timestamps": [(topic, partition_id, time)]}`` (no record at or after the time: the end).  With
    ``commits`` and ``group`` the committed partitions start after their last commit and
    ``starting`` holds for the rest.  One row per topic-partition reaches the driver."""
    index = read_index(spark, path)
    ends = {(r[0], r[1]): r[2] for r in index_bounds(index).select(*TP, "next_offset").collect()}
    if starting == "earliest":
        found: dict = {}
    elif starting == "latest":
        found = dict(ends)
    elif isinstance(starting, dict):
        at = {(r[0], r[1]): r[2] for r in time_positions(spark, path, starting["timestamps"]).collect()}
        found = {(t, int(p)): at.get((t, int(p)), ends.get((t, int(p)), 0)) for t, p, _ in starting["timestamps"]}
    else:
        found = {(t, int(p)): int(o) for t, p, o in starting}
    if commits is not None:
        from ..operators.offsets import latest_commits
        found |= {(r[0], r[1]): r[2] + 1 for r in latest_commits(commits, group).select(*TP, "log_offset").collect()}
    out: dict[str, dict[str, int]] = {}
    for (t, p), o in found.items():
        if t is not None and p is not None:
            out.setdefault(t, {})[str(p)] = o
    return out


def stream_segments(spark: SparkSession, path: str, starting="earliest", commits: DataFrame | None = None, group: str | None = None,
                    positions: dict | None = None, schema: StructType | None = None) -> DataFrame:
    """The log at ``path`` as a stream, also of what is appended later.  ``positions`` (from ``starting_positions``) takes
    the place of ``starting``.  ``schema`` is needed only for a log that holds no records yet."""
    spark.dataSource.register(SegmentSource)
    schema = schema or read_segments(spark, path).schema
    positions = positions if positions is not None else starting_positions(spark, path, starting, commits, group)
    return (spark.readStream.format(FORMAT).schema(schema).option("path", path)
            .option("positions", json.dumps(positions)).load())


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return SegmentStreamReader(schema, self.options["path"], json.loads(self.options["positions"]))


class SegmentRange(InputPartition):
    """Offsets begin <= offset < end of a topic-partition in one segment."""

    def __init__(self, folder: str, topic: str, partition_id: int, begin: int, end: int):
        self.folder, self.topic, self.partition_id, self.begin, self.end = folder, topic, partition_id, begin, end


def _filesystem(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class SegmentStreamReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, path: str, positions: dict):
        self.schema, self.path, self.positions = schema, path, positions
        self.seen: dict[str, list[dict]] = {}  # index rows of each committed append

    def _rows(self) -> list[dict]:
        import pyarrow.dataset as ds
        from pyarrow import fs
        files, root = _filesystem(self.path)
        for folder in files.get_file_info(fs.FileSelector(f"{root}/index", allow_not_found=True)):
            done = files.get_file_info(f"{folder.path}/_SUCCESS").type == fs.FileType.File
            if folder.type == fs.FileType.Directory and folder.path not in self.seen and done:
                self.seen[folder.path] = ds.dataset(folder.path, filesystem=files, format="parquet").to_table(
                    columns=["topic", "partition_id", "first_offset", "last_offset", "write_id", "segment"]).to_pylist()
        return [r for rows in self.seen.values() for r in rows if r["topic"] is not None and r["partition_id"] is not None]

    def initialOffset(self) -> dict:
        return self.positions or {"": {"": 0}}

    def latestOffset(self) -> dict:
        ends = {t: dict(ps) for t, ps in self.positions.items()}
        for r in self._rows():
            of = ends.setdefault(r["topic"], {})
            of[str(r["partition_id"])] = max(of.get(str(r["partition_id"]), 0), r["last_offset"] + 1)
        return ends or {"": {"": 0}}

    def partitions(self, start: dict, end: dict) -> list[SegmentRange]:
        found = []
        for r in self._rows():
            topic, p = r["topic"], str(r["partition_id"])
            begin = start.get(topic, {}).get(p, self.positions.get(topic, {}).get(p, 0))
            upto = end.get(topic, {}).get(p, 0)
            if r["last_offset"] >= begin and r["first_offset"] < upto:
                found.append(SegmentRange(f"{self.path}/data/write_id={r['write_id']}/segment={r['segment']}", topic, r["partition_id"], begin, upto))
        return found

    def read(self, partition: SegmentRange):
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import to_arrow_schema
        files, folder = _filesystem(partition.folder)
        want = to_arrow_schema(self.schema)
        keep = ((pc.field("topic") == partition.topic) & (pc.field("partition_id") == partition.partition_id)
                & (pc.field("log_offset") >= partition.begin) & (pc.field("log_offset") < partition.end))
        for batch in ds.dataset(folder, filesystem=files, format="parquet").to_batches(columns=want.names, filter=keep):
            if batch.num_rows:
                yield batch.cast(want)
