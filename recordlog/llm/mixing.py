"""Mixing sources to target weights by weighted fair queueing.

Every document of a source stands in a queue, in an order given by a hash of its id; the
queue is served up to ``passes`` times.  A document's virtual finish time is the words of
its source up to and including it, divided by the source's target.  All queues together are
ordered by that time and the order is cut where the total budget is used up, so each source
has been served its target to within one document.

The running sums never gather a source in one task: the hash order is cut into buckets of a
few thousand documents, bucket sums are added up over the buckets of a source, and each
bucket adds its own documents to the sum before it.  The global order is cut into slices of
virtual time in the same way; only the slice that holds the cut is sorted.

Defined results: null text or size counts 0 words and is never taken; a null source is a
source of its own, last in code point order; rows with a null id or repeated rows are
documents like others, ties in the order are cut by size and by a hash of the whole row;
an empty table gives an empty mix.  Input columns named like a result column are replaced.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlog.llm.common import clear_of, store, word_count

#: Documents of one bucket of the hash order, on average; any value gives the same mix.
BUCKET_ROWS = 4096
#: Rows of the table of ends, one a source, that may be broadcast; beyond it Spark decides by size.
MOST_SOURCES = 10_000
RESULT = ("size", "source_size", "target", "finish_time", "copies", "taken")


def _targets(sizes: DataFrame, weights: Sequence[float], share: float, passes: int) -> DataFrame:
    """(source, source_size, target): weights go to the sources in code point order, null last;
    a target over ``passes`` times its source is cut there and the rest is shared again by weight.
    One row per source: a mixture has as many rows here as it has weights to give."""
    every = Window.partitionBy()
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    up = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(rank) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("_w", w).withColumn("_cap", F.col("source_size") * float(passes)) \
        .withColumn("_ratio", F.col("_cap") / F.col("_w")) \
        .withColumn("_total", F.sum("source_size").over(every) * float(share)) \
        .withColumn("_rest", F.sum("_w").over(every) - F.sum("_w").over(up)) \
        .withColumn("_capped", F.sum("_cap").over(up))
    # served up to the rate _ratio the capped sources of the prefix are full; the last prefix that fits sets the rate
    fits = F.col("_capped") + F.col("_ratio") * F.col("_rest") <= F.col("_total")
    rate = F.when(fits & (F.col("_rest") > 0), (F.col("_total") - F.col("_capped")) / F.col("_rest")) \
        .when(fits, F.lit(float("inf"))).otherwise(F.lit(0.0))
    t = t.withColumn("_rate", F.greatest(F.max(rate).over(every), F.col("_total") / F.sum("_w").over(every)))
    return t.select(F.col("source").alias("_src"), "source_size",
                    F.least(F.col("_cap"), F.col("_rate") * F.col("_w")).alias("target"))


def _times(queue: DataFrame, buckets: DataFrame, targets: DataFrame, tie: list[Column]) -> DataFrame:
    """Adds the words of the source up to each document, the source's size and its target."""
    w = Window.partitionBy("_src", "_bucket").orderBy("_order", *tie).rowsBetween(Window.unboundedPreceding, 0)
    side = buckets.join(targets.withColumnRenamed("_src", "_s"), F.col("_src").eqNullSafe(F.col("_s"))).drop("_s")
    side = side.select(F.col("_src").alias("_s"), F.col("_bucket").alias("_b"), "_before", "source_size", "target")
    return queue.join(side, F.col("_src").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b"))) \
        .withColumn("_upto", F.col("_before") + F.sum("_size").over(w)).drop("_s", "_b", "_before")


def _finish(e: int) -> Column:
    return F.when(F.col("target") > 0, (F.col("source_size") * float(e) + F.col("_upto")) / F.col("target")).otherwise(0.0)


def _served(docs: DataFrame, id_col: str, text_col: str, source_col: str, size_col: str | None,
            weights: Sequence[float], share: float, passes: int, seed: int):
    """The queue of whole rows, its narrow copy with running sums, buckets, targets, and the virtual time at which
    the budget is used up."""
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0)) if size_col else word_count(F.col(text_col))
    rows = docs.count()
    bits = max(1, math.ceil(math.log2(rows / BUCKET_ROWS + 1)))
    order = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"))
    queue = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(source_col).alias("_src"),
                        F.col(id_col).alias("_id"), size.alias("_size"), order.alias("_hash")) \
        .withColumn("_bucket", F.shiftrightunsigned("_hash", 64 - bits)) \
        .withColumn("_order", F.shiftrightunsigned("_hash", 1)).drop("_hash")
    narrow = store(queue.select("_src", "_id", "_size", "_bucket", "_order", F.xxhash64("_row").alias("_tie")), "mix-queue")
    sums = store(narrow.groupBy("_src", "_bucket").agg(F.sum("_size").alias("_sum")), "mix-buckets")
    targets = store(_targets(sums.groupBy(F.col("_src").alias("source")).agg(F.sum("_sum").alias("source_size")),
                             weights, share, passes), "mix-targets")
    before = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sums.select("_src", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))

    # virtual time at which the budget is used up: slices of time first, then the slice with the cut
    slices = max(1, rows * passes // BUCKET_ROWS)
    timed = _times(narrow, buckets, targets, [F.col("_id"), F.col("_size"), F.col("_tie")])
    served = timed.select("_size", F.explode(F.array(*[_finish(e) for e in range(passes)])).alias("v")) \
        .withColumn("slice", F.least(F.floor(F.col("v") * slices), F.lit(2 * slices)))
    served = store(served, "mix-served")
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    running = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    upto = served.groupBy("slice").agg(F.sum("_size").alias("n"), F.max("v").alias("v")) \
        .withColumn("upto", F.sum("n").over(running))
    budget += 1e-6 * max(1.0, budget) / max(1, rows)  # rounding of the targets' sum
    full = upto.filter(F.col("upto") <= budget).agg(F.max("v"), F.max("slice"), F.max("upto")).first()
    cut = upto.filter(F.col("upto") > budget).agg(F.min("slice")).first()[0]
    last = full[0] if full[0] is not None else -1.0
    if cut is not None:
        in_slice = served.filter(F.col("slice") == cut).groupBy("v").agg(F.sum("_size").alias("n")) \
            .withColumn("upto", F.sum("n").over(Window.orderBy("v")) + F.lit(full[2] or 0))
        within = in_slice.filter(F.col("upto") <= budget).agg(F.max("v")).first()[0]
        last = max(last, within) if within is not None else last

    return queue, timed, buckets, targets, last


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        size_col: str | None = None, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
        passes: int = 2, seed: int = 17) -> DataFrame:
    """``docs`` with size, source_size, target, finish_time (of the first pass), copies (0 to
    ``passes``) and taken (copies x size).  ``share``: budget as a share of all words.  ``size_col``
    names a column of sizes; else words of ``text_col`` are counted.  ``docs`` is read twice."""
    queue, _, buckets, targets, last = _served(docs, id_col, text_col, source_col, size_col, weights, share, passes, seed)
    final = _times(queue, buckets, targets, [F.col("_id"), F.col("_size"), F.xxhash64("_row")])
    copies = sum((F.when(_finish(e) <= F.lit(last), 1).otherwise(0) for e in range(passes)), F.lit(0))
    copies = F.when(F.col("_size") > 0, copies).otherwise(0)
    keep = clear_of(docs, *RESULT).columns
    return final.select(*[F.col("_row").getField(c).alias(c) for c in keep], F.col("_size").alias("size"),
                        F.col("source_size"), F.col("target"), _finish(0).alias("finish_time"), copies.alias("copies")) \
        .withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    size_col: str | None = None, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                    passes: int = 2, seed: int = 17) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it, columns as given.

    Finish times rise along a source's queue, so a pass takes a document exactly if its place is not behind the last
    one whose time fits.  These places, one for each source and pass, are found on the narrow table; the whole
    rows are filtered by them where they lie.  Rows equal in every column share a place and a fate."""
    queue, timed, _, _, last = _served(docs, id_col, text_col, source_col, size_col, weights, share, passes, seed)
    place = ["_order", "_id", "_size", "_tie"]
    ends = store(timed.groupBy("_src").agg(*[F.max(F.when(_finish(e) <= F.lit(last), F.struct(*place))).alias(f"_end{e}")
                                            for e in range(passes)]).withColumnRenamed("_src", "_s"), "mix-ends")
    if ends.count() <= MOST_SOURCES:
        ends = F.broadcast(ends)
    here = F.struct(F.col("_order"), F.col("_id"), F.col("_size"), F.xxhash64("_row").alias("_tie"))
    copies = sum((F.when(here <= F.col(f"_end{e}"), 1).otherwise(0) for e in range(passes)), F.lit(0))
    took = queue.join(ends, F.col("_src").eqNullSafe(F.col("_s"))).withColumn("_copies", F.when(F.col("_size") > 0, copies).otherwise(0))
    took = took.filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return took.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
