"""SimHash near-duplicates by hashing of small Hamming balls.

A document's fingerprint sums its shingle hashes bit by bit.  Fingerprints at most ``bits``
apart are linked.  Around every distinct fingerprint the ball of half the distance is
enumerated and entered in one table, keyed by the whole 64-bit value.  This stands in for tables
of segments: all near copies that share a segment would fall into one bucket of such a table,
whereas here a bucket holds only fingerprints near one common value: at most 65 for two bits, however
many near copies a document has, and no list of candidate pairs grows with the square of a group.
Members of a bucket are linked to its smallest one after their complete distance has been
verified; the links' components are the groups.  Two fingerprints at distance d always meet
in the bucket of a value half way between them, so no link is lost.

Defined results: null and empty texts (and texts of white space) have the fingerprint zero and
are linked like any other; a null id never names a component unless no other id does; repeated
rows are one group; an empty table gives no rows.  Only the id and text columns are read.
"""
from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlog.llm.common import from_rows, store, utf8, whole_rows
from recordlog.llm.components import components

#: Bits of each byte value, lowest first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
BYTE_AT = (np.arange(8) * 256)[None, :]


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """SimHash of a UTF-8 text over shingles of ``words`` words, as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest

    parts = text.lower().split()  # bytes.lower changes A-Z only, bytes.split cuts at ASCII white space
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxh64_intdigest(line, seed)]
    else:
        ends = list(accumulate(len(p) + 1 for p in parts))
        starts = [0, *ends[:len(parts) - words]]
        hashes = [xxh64_intdigest(line[a:b - 1], seed) for a, b in zip(starts, ends[words - 1:])]
    values = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    tally = np.bincount((values + BYTE_AT).ravel(), minlength=2048).reshape(8, 256) @ BYTE_BITS
    return int(np.packbits((tally * 2 > len(hashes)).ravel(), bitorder="little").view("<i8")[0])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` as _row with a key that is never null: the id, and a hash of the text and of the id being null."""
    return whole_rows(docs, id=F.col(id_col).cast("long"), key=F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
                      tie=F.xxhash64(F.col(text_col), F.col(id_col).isNull()), text=F.col(text_col))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """(id, tie, fp) of every row; tie tells rows that share an id apart by their text."""
    def scan(batches):
        for b in batches:
            fp = pa.array([fingerprint(t, words, seed) for t in utf8(b.column(2))], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fp], ["id", "tie", "fp"])

    return _keyed(docs, id_col, text_col).select("id", "tie", "text").mapInArrow(scan, "id bigint, tie bigint, fp bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _ball(bits: int) -> list[tuple[int, int]]:
    """(mask, flipped bits) of the balls that the table entries are made of."""
    return [(_signed(sum(1 << i for i in at)), n) for n in range((bits + 1) // 2 + 1) for at in combinations(range(64), n)]


def links(fps: DataFrame, bits: int = 2) -> DataFrame:
    """(fp, center): links between the distinct fingerprints ``fps`` that span every group of
    fingerprints linked at ``bits`` or fewer differing bits."""
    entries = F.array(*[F.struct(F.col("fp").bitwiseXOR(F.lit(m)).alias("key"), F.lit(n <= bits // 2).alias("near"))
                        for m, n in _ball(bits)])
    table = fps.select("fp", F.explode(entries).alias("e")).select("fp", "e.key", "e.near")
    bucket = Window.partitionBy("key")
    found = table.withColumn("center", F.min(F.when(F.col("near"), F.col("fp"))).over(bucket)).filter("fp != center")
    return found.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("center"))) <= bits).select("fp", "center")


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, bits: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scanned rows, fp -> root, root -> first row): the first row has the smallest id, null last."""
    scanned = store(fingerprints(docs, id_col, text_col, words, seed), "simhash")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "tie")
    distinct = scanned.groupBy("fp").agg(F.min(order).alias("first"))
    found = components(links(distinct.select("fp"), bits))
    named = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", F.coalesce("component", "fp").alias("root"), "first")
    return scanned, named.select("fp", "root"), named.groupBy("root").agg(F.min("first").alias("first"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 2,
           seed: int = 42) -> DataFrame:
    """(id, fp, component): one row per row of ``docs``; component is the smallest id of its group."""
    scanned, named, roots = _grouped(docs, id_col, text_col, words, bits, seed)
    labels = named.join(roots, "root").select("fp", F.col("first.id").alias("component"))
    return scanned.join(labels, "fp").select("id", "fp", "component")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 2,
          seed: int = 42) -> DataFrame:
    """``docs`` with one row of each group, the one with the smallest id; columns as given."""
    _, _, roots = _grouped(docs, id_col, text_col, words, bits, seed)
    first = roots.select(F.coalesce("first.id", F.lit(0)).alias("key"), F.col("first.tie").alias("tie"))
    kept = _keyed(docs, id_col, text_col).select("_row", "key", "tie").join(first, ["key", "tie"], "left_semi")
    return from_rows(kept.dropDuplicates(["key", "tie"]), docs)
