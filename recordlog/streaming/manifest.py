"""Atomic commit of a micro-batch over several sinks.

Every attempt of a batch writes each sink into a folder of its own, ``<out>/<sink>/batch_id=<id>/attempt=<a>``;
after the last write one manifest, ``<out>/_manifests/<id>-<version>``, names the attempt and its sinks.
Readers follow the manifests (the greatest version of each batch), so they see all sinks of a batch or
none, whatever a killed attempt left behind.  A batch that runs again commits the next version, which
replaces the one before it as a whole; of two attempts that run at the same time one commits and the
other is told so."""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from ..sources.claims import BODY, children, claim, delete

MANIFESTS = "_manifests"
_DDL = "batch_id bigint, version bigint, attempt string, sinks map<string,struct<format:string,schema:string>>"
#: Attempt folders that are opened by name; beyond it all are listed and joined with the manifests.
MAX_NAMED = 10_000


class CommitConflict(RuntimeError):
    """Another attempt of the same batch has committed in the meantime."""


class BatchWriter:
    """One attempt of one micro-batch: ``write`` each sink (from several threads if wanted), then ``commit``."""

    def __init__(self, spark: SparkSession, out_dir: str, batch_id: int):
        self.spark, self.out_dir, self.batch_id = spark, out_dir, int(batch_id)
        self.attempt = f"a{uuid.uuid4().hex}"
        self.version = 1 + max((v for b, v in _versions(spark, out_dir) if b == self.batch_id), default=-1)
        self.sinks: dict[str, dict] = {}

    def write(self, sink: str, df: DataFrame, fmt: str = "parquet") -> None:
        df.write.format(fmt).save(f"{self.out_dir}/{sink}/batch_id={self.batch_id}/attempt={self.attempt}")
        self.sinks[sink] = {"format": fmt, "schema": df.schema.json()}

    def commit(self) -> None:
        """From here on readers see every sink of this attempt, and nothing of earlier ones."""
        body = {"batch_id": self.batch_id, "version": self.version, "attempt": self.attempt, "sinks": self.sinks}
        if not claim(self.spark, f"{self.out_dir}/{MANIFESTS}/{self.batch_id}-{self.version}", body):
            raise CommitConflict(f"batch {self.batch_id} of {self.out_dir}: version {self.version} is another attempt's")


def _versions(spark: SparkSession, out_dir: str) -> list[tuple[int, int]]:
    names = [n for n in children(spark, f"{out_dir}/{MANIFESTS}") if not n.startswith("_")]
    return [(int(b), int(v)) for b, v in (n.split("-") for n in names)]


def read_manifests(spark: SparkSession, out_dir: str) -> DataFrame:
    """The manifest that counts for each batch: batch_id, version, attempt, sinks."""
    if not _versions(spark, out_dir):
        return spark.createDataFrame([], _DDL)
    found = spark.read.schema(_DDL).json(f"{out_dir}/{MANIFESTS}/[0-9]*/{BODY}")
    newest = F.row_number().over(Window.partitionBy("batch_id").orderBy(F.desc("version")))
    return found.withColumn("_n", newest).filter("_n = 1").drop("_n")


def read_batches(spark: SparkSession, out_dir: str, sink: str) -> DataFrame:
    """Rows of ``sink`` of all committed batches, with their ``batch_id``.  Attempts without a manifest do not
    count and are not opened (up to 10,000 batches; beyond it the manifests are joined)."""
    named = read_manifests(spark, out_dir).withColumn("sink", F.col("sinks").getItem(sink)).filter("sink IS NOT NULL") \
        .select("batch_id", "attempt", "sink")
    rows = named.orderBy("batch_id").limit(MAX_NAMED + 1).collect()
    if not rows:
        raise FileNotFoundError(f"no batch of {out_dir} has committed rows of {sink}")
    fmt = rows[0]["sink"]["format"]
    base = f"{out_dir}/{sink}"
    # columns that later batches add are null in earlier ones
    schema = _merged(dict.fromkeys(r["sink"]["schema"] for r in rows))
    reader = spark.read.format(fmt).option("basePath", base)
    reader = reader.schema(schema.add("batch_id", LongType()).add("attempt", StringType()))
    if len(rows) <= MAX_NAMED:
        return reader.load([f"{base}/batch_id={r['batch_id']}/attempt={r['attempt']}" for r in rows]).drop("attempt")
    return reader.load(base).join(named.select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi").drop("attempt")


def _merged(schemas) -> StructType:
    import json

    def merge(left: StructType, right: StructType) -> StructType:
        have = set(left.fieldNames())
        return StructType(left.fields + [f for f in right.fields if f.name not in have])
    return reduce(merge, (StructType.fromJson(json.loads(s)) for s in schemas))


def drop_attempts(spark: SparkSession, out_dir: str, sinks: list[str], batches_below: int) -> int:
    """Delete the attempts that no manifest names, of batches below ``batches_below`` (which no attempt may still be
    writing); returns their number."""
    counts = {(r["batch_id"], r["attempt"]) for r in
              read_manifests(spark, out_dir).filter(F.col("batch_id") < batches_below).select("batch_id", "attempt").toLocalIterator()}
    gone = 0
    for sink in sinks:
        for batch in children(spark, f"{out_dir}/{sink}"):
            number = int(batch.split("=")[1])
            for attempt in children(spark, f"{out_dir}/{sink}/{batch}") if number < batches_below else []:
                if (number, attempt.split("=")[1]) not in counts:
                    delete(spark, f"{out_dir}/{sink}/{batch}/{attempt}")
                    gone += 1
    return gone
