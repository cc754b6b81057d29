"""The flagship query: the consume decision for every batch of a log, in one plan."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import offsets as O
from ..operators import results as RS
from .fixtures import Fixtures, sql

KEYS = ["topic", "partition_id", "batch_no"]


def batch_outcomes(spark: SparkSession, sf_dir: str, threshold: float = 30, mode: str = "compat") -> DataFrame:
    """Per (topic, partition_id, batch_no): batch size, failed, rolled back, dead letters
    (0 when rolled back) and the commit position (null when rolled back)."""
    res = O.with_batches(Fixtures(spark, sf_dir).results)
    # one aggregation (partial before the shuffle) gives every figure of a batch
    dec = res.groupBy(*KEYS).agg(
        *RS.batch_counts(),
        F.count(F.when(~F.coalesce(F.col("processed"), F.lit(False)), 1)).alias("_dl"),
        F.max("log_offset").alias("_last")).withColumn("rolled_back", RS.rollback_flag(threshold, mode))
    return dec.select(
        *KEYS, "batch_size", "failed", "rolled_back",
        F.when(F.col("rolled_back"), F.lit(0)).otherwise(F.col("_dl")).cast("bigint").alias("dead_letters"),
        F.when(~F.col("rolled_back"), F.col("_last")).alias("commit_offset"))


ORACLE = sql("""SELECT topic, partition_id, batch_no, batch_size, failed, rolled_back,
  CAST(CASE WHEN rolled_back THEN 0 ELSE dl END AS BIGINT) AS dead_letters,
  CASE WHEN NOT rolled_back THEN last END AS commit_offset FROM (
  SELECT topic, partition_id, log_offset // 100 AS batch_no, count(*) AS batch_size,
         CAST(sum(CASE WHEN processed = FALSE THEN 1 ELSE 0 END) AS BIGINT) AS failed,
         sum(CASE WHEN processed = FALSE THEN 1 ELSE 0 END) >= 30.0 * count(*) / 100.0 AS rolled_back,
         count(CASE WHEN processed IS NOT TRUE THEN 1 END) AS dl, max(log_offset) AS last
  FROM results GROUP BY 1, 2, 3)""")
