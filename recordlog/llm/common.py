"""Helpers the operators share: the shared folder, stored tables, UTF-8 views of Arrow batches."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, everywhere in the subpackage: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor and is not
    computed again for each use."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(table: DataFrame) -> None:
    """Delete a table that ``store`` wrote, once nothing reads it any more."""
    spark = table.sparkSession
    root = shared_root(spark)
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if path.split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/")):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def bounded_sample(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """At most ``rows`` rows of ``df``, those with a small hash of the key columns, the same in every run.

    Rows are picked by the hash where they lie, so that about ``rows`` rows move, not that many of each task."""
    every = df.count()
    if every > rows:
        share = rows / every * max(0.5, 1 - 4 / rows ** 0.5)
        df = df.filter(F.shiftrightunsigned(F.xxhash64(*key), 1) < int(share * (1 << 63)))
    return df.orderBy(F.xxhash64(*key), *key).limit(rows)


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    edge = F.when(text.rlike(rf"^{SPACE}"), 1).otherwise(0) + F.when(text.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0)) \
        .otherwise(F.size(F.split(text, SPACE)) - edge).cast("long")


def utf8(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of an Arrow string column, null as empty, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32,
                       count=column.offset + len(column) + 1)[column.offset:].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    nulls = column.is_null().to_pylist() if column.null_count else None
    for i in range(len(column)):
        yield b"" if nulls and nulls[i] else bytes(view[at[i]:at[i + 1]])


class Hashes(dict):
    """64-bit value of a word, kept for the words seen last; emptied when it grows past ``most``."""

    def __init__(self, of, most: int = 400_000):
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = self.of(word)
        return value


def whole_rows(df: DataFrame, **more: Column) -> DataFrame:
    """``df`` as one struct column _row beside the given columns, so that none of its columns can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[v.alias(k) for k, v in more.items()])


def from_rows(df: DataFrame, like: DataFrame, **other: Column) -> DataFrame:
    """The columns of ``like`` out of _row, some of them replaced."""
    return df.select(*[(other[c] if c in other else F.col("_row").getField(c)).alias(c) for c in like.columns])


def clear_of(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names: results take the place of clashing input columns."""
    have = {c.lower() for c in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in have])
