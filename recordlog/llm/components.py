"""Connected components of an edge table: alternating large-star and small-star rounds.

Each round is two aggregations and two joins on the node; the edge table is written to
the shared folder after every round, so a lost executor costs one round at most and the
driver sees only a row count and a checksum."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlog.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("hi", "lo").union(edges.select(F.col("lo"), F.col("hi"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = edges.join(least, "hi")
    moved = joined.filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return (r[0], r[1])


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) for every node of ``pairs`` (its first two columns, longs): component is
    the smallest node reachable.  Loops and repeated pairs are ignored; no pairs, no rows."""
    a, b = pairs.columns[:2]
    edges = store(pairs.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                  .filter("hi != lo").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = store(_small_star(_large_star(edges)), "edges")
        last, mark = mark, _mark(edges)
        if last == mark:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")) \
        .union(edges.select("lo", "lo").distinct())
