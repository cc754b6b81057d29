"""Document fingerprints: threshold-scaled sketches, in DataFrame functions only.

A sketch holds every shingle hash below a fixed fraction of the hash range, so its size follows
the document's and two sketches can be merged, intersected and compared at any sizes: the
share of the smaller sketch that the other holds estimates how much of the smaller document
the larger one contains.  The smallest hash of all stays in the sketch whatever its size, so a
text with a word never has an empty one; sketches with that hash merge the same way.

``edited`` replaces the end of each text by the beginning of the next document's.  Documents meet
their successors without a global sort in one task: ids are cut into ranges of a few thousand
rows that are sorted on their own, and the last row of each is joined to the first of the next.  The
text is shuffled once.

Defined results: a null text is empty; an empty text (or white space alone) has an empty sketch,
written as an empty string, like another empty one (1) and unlike any other (0); null ids come
last, rows that share an id in the order of their texts; with a single row the next document is
the row itself; an empty table gives no rows.  Only the id and text columns are read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlog.llm.common import SPACE

#: Rows of one range of ids, about, and quantiles of the ids between which ranges are equally wide.
RANGE_ROWS, KNOTS = 2000, 128


def sketch(text: Column, words: int = 5, scale: int = 4) -> Column:
    """Sorted shingle hashes (longs) below 1 / ``scale`` of the range, and the smallest of all;
    texts of fewer than ``words`` words are one shingle."""
    hashed = F.transform(F.filter(F.split(text, SPACE), lambda w: w != ""), lambda w: F.xxhash64(w))
    # bound first: the lambda below then reads an array that is there already
    shingles = F.transform(F.array(hashed), lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(1))),
                    lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(words)]))))[0]
    limit = -(1 << 63) + (1 << 64) // scale
    return F.transform(F.array(shingles), lambda s: F.array_sort(F.array_distinct(
        F.filter(F.concat(F.filter(s, lambda h: h < limit), F.array(F.array_min(s))), lambda h: h.isNotNull()))))[0]


def as_text(hashes: Column) -> Column:
    """A sketch as hexadecimal numbers in order."""
    return F.lower(F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), ","))


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that the other holds; two empty sketches are alike."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least) \
        .otherwise((F.size(a) == F.size(b)).cast("double"))


def merged(a: Column, b: Column) -> Column:
    """Sketch of two documents together."""
    return F.array_sort(F.array_union(a, b))


def _range(ids: Column, knots: list[tuple[int, int, int, int]]) -> Column:
    """Number of an id's range.  Knots (lowest id, highest id, ranges, first range) lie one after
    another; the one that holds the id is found by halving, inside it ranges are equally wide."""
    if len(knots) == 1:
        low, high, ranges, first = knots[0]
        part = F.floor((ids - low) / float(max(1, high - low)) * ranges)
        return F.greatest(F.lit(0), F.least(part, F.lit(ranges - 1))) + first
    half = len(knots) // 2
    return F.when(ids < knots[half][0], _range(ids, knots[:half])).otherwise(_range(ids, knots[half:]))


def _ranged(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text, tie) with the number of their range, ascending with the id, null ids lowest."""
    ids = rows.select("id")
    limits = ids.agg(F.percentile_approx("id", [k / KNOTS for k in range(KNOTS + 1)], 100 * KNOTS)).first()[0]
    limits = sorted(set(limits or [0]))
    inner = [(x, y, 1, 0) for x, y in zip(limits, [*limits[1:], limits[-1]])]
    knot = F.when(F.col("id").isNull(), -1).otherwise(_range(F.col("id"), [(x, y, 1, k) for k, (x, y, _, _) in enumerate(inner)]))
    counts = {r[0]: r[1] for r in ids.groupBy(knot.alias("knot")).count().collect()}  # one row a knot
    knots, first = [], 0
    for k, (low, high, _, _) in enumerate(inner):
        ranges = -(-counts.get(k, 0) // RANGE_ROWS) or 1
        knots.append((low, high, ranges, first))
        first += ranges
    spare = -(-counts.get(-1, 0) // RANGE_ROWS) or 1
    none = F.least(F.floor(F.col("tie") / float(1 << 63) * spare), F.lit(spare - 1)) - spare
    return rows.withColumn("range", F.when(F.col("id").isNull(), none).otherwise(_range(F.col("id"), knots)).cast("long"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, next): each text and that of the next document by descending id, the first after the last."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = _ranged(rows.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 1)))
    order = Window.partitionBy("range").orderBy(F.col("id").desc_nulls_last(), F.col("tie").desc(), "text")
    placed = rows.withColumn("next", F.lead("text").over(order)).withColumn("nth", F.row_number().over(order))
    # ranges that have rows, and the one whose last row each range's first row follows
    every = Window.orderBy("range")
    ranges = rows.groupBy("range").agg(F.lit(1).alias("one")).withColumn("above", F.lead("range").over(every)) \
        .withColumn("above", F.coalesce("above", F.min("range").over(Window.partitionBy())))
    heads = placed.filter("nth = 1").select("range", F.col("text").alias("head")) \
        .join(ranges.select("range", "above"), "range").select(F.col("above").alias("at"), "head")
    found = placed.join(heads, (F.col("range") == F.col("at")) & F.col("next").isNull(), "left")
    return found.select("id", "text", F.coalesce("next", "head").alias("next"))


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last third replaced by the beginning of ``following``."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, scale: int = 4) -> DataFrame:
    """(id, text, edited, sketch, edited_sketch, near_edited, near_next) of every row."""
    rows = with_next(docs, id_col, text_col).withColumn("edited", edited(F.col("text"), F.col("next")))
    for name, of in (("sketch", "text"), ("edited_sketch", "edited"), ("next_sketch", "next")):
        rows = rows.withColumn(name, sketch(F.col(of), words, scale))
    return rows.select("id", "text", "edited", "sketch", "edited_sketch",
                       containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
