"""Substring dedup by content-chosen blocks over an index of all documents.

This stands in for a greedy relative Lempel-Ziv parse, whose every step would be a lookup in the
whole index: blocks meet their copies in one shuffle, and windows are checked at their borders.

Every document is cut into reference blocks at places its content chooses: a window of
``window`` words belongs to the smallest hash among the grams inside it (its anchor), and the
consecutive windows of one anchor form a block, about seven windows long.  Equal windows have
equal anchors, so only blocks of one anchor can share a window.

* A block that stands earlier in the corpus word for word is one long copied stretch: all
  its windows repeat.
* At a factor's boundary blocks of one anchor differ; only there are windows compared one by
  one, by a 128-bit hash.

Neighbouring copied stretches join into the longest factors; the words of all factors go.

Each task first settles what it can alone: of equal blocks it passes on the earliest, and an
anchor with several blocks becomes a single mark, its blocks going on to the window check.  So
no key receives more than one row of a task, however often a line, passage or document repeats.
The text is shuffled once, for documents to meet their copied stretches.

Defined results: null, empty and short texts (under ``window`` words) lose nothing; documents
are ordered by id, null ids last, rows that share an id by a hash of the text; rows equal in id
and text count as one document and keep or lose the same words; an empty table gives no rows.
Only the id and text columns are read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlog.llm.common import Hashes, store, utf8

#: Most windows of a block; grams are ``window`` - 12 words long, one at least.
BLOCK = 13
#: Words that are hashed in one step.
STEP_WORDS = 200_000
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: A place in a document: no id (1 bit), hash of the text (24), first word (30), windows (4), kind (3).
START_AT, TIE_AT, NONE_AT = 7, 37, 61
CANDIDATE, MARK, COPIED, CHECK = range(4)
NO_ID = (1 << 63) - 1
PLACE = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("id", pa.int64()), ("at", pa.int64())])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def grams(words: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of every run of ``n`` word hashes, put together from runs of powers of two."""
    found, size, block, length = None, 0, words, 1
    shift = np.uint64(base)
    while True:
        if n & length:
            if found is None:
                found = block
            else:
                rest = len(words) - size - length + 1
                found = found[:rest] * shift + block[size:size + rest]
            size += length
        if size == n:
            return found
        block = block[:-length] * shift + block[length:]
        length, shift = 2 * length, np.uint64(int(shift) ** 2 & (1 << 64) - 1)


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Smallest of every ``n`` neighbours."""
    length = 1
    while 2 * length <= n:
        values, length = np.minimum(values[:-length], values[length:]), 2 * length
    return np.minimum(values[:len(values) - (n - length)], values[n - length:]) if n > length else values


def blocks(words: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Blocks of the documents whose word hashes stand one after another in ``words``:
    anchor, content, number of the document, first window, windows."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    end = np.cumsum(lengths)
    size = max(1, window - BLOCK + 1)
    hashed = _mixed(grams(words, size, A))
    at = np.arange(len(hashed), dtype=np.uint64)
    low = np.uint64(0xFFFFFFFF)
    anchor = (_least((hashed & ~low) | at, window - size + 1) & low).astype(np.int64)
    starts = np.flatnonzero(end[doc[:len(anchor)]] - np.arange(len(anchor)) >= window)
    anchor, doc = anchor[starts], doc[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    count = np.diff(first, append=len(starts))
    whole = grams(words, window, B)
    content = _mixed(whole[starts[first]] * A + whole[starts[first] + count - 1]) + count.astype(np.uint64)
    begin = end - lengths
    return hashed[anchor[first]], content, doc[first], starts[first] - begin[doc[first]], count


def _first(k1, k2, ids, at) -> tuple[np.ndarray, ...]:
    """Rows in order of key and place; whether a row begins a key; whether it stands after the key's first place."""
    order = np.lexsort((at, ids, k2, k1))
    k1, k2, ids, at = k1[order], k2[order], ids[order], at[order]
    begins = np.ones(len(k1), dtype=bool)
    begins[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    head = np.flatnonzero(begins)[np.cumsum(begins) - 1] if len(k1) else np.zeros(0, dtype=np.int64)
    return k1, k2, ids, at, begins, (ids != ids[head]) | (at != at[head])


def _rows(*parts: tuple[np.ndarray, ...]):
    """Record batches of (k1, k2, id, at)."""
    for part in parts:
        for lo in range(0, len(part[0]), 65_536):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c[lo:lo + 65_536]).view(np.int64)) for c in part], schema=PLACE)


def _passing(ids, at):
    """Rows whose fate is known travel under keys of their own."""
    k1 = _mixed(ids.view(np.uint64) * A + at.view(np.uint64) * B)
    return k1.view(np.int64), k1.view(np.int64), ids, at


def _steps(batches, word, id_at: int, key_at: int, text_at: int):
    """(word hashes, lengths, ids, keys, rows) of as many documents as make a step; rows: their other columns."""
    words, lengths, ids, keys, rows, size = [], [], [], [], [], 0
    for b in batches:
        others = [b.column(k).to_pylist() if k not in (id_at, key_at, text_at) else None for k in range(b.num_columns)]
        for i, (d, k, text) in enumerate(zip(b.column(id_at).to_pylist(), b.column(key_at).to_pylist(), utf8(b.column(text_at)))):
            parts = text.split()
            words.append(np.fromiter(map(word.__getitem__, parts), dtype=np.uint64, count=len(parts)))
            lengths.append(len(parts))
            ids.append(d)
            keys.append(k)
            rows.append(next((o[i] for o in others if o is not None), None))
            size += len(parts)
            if size >= STEP_WORDS:
                yield np.concatenate(words), np.array(lengths), np.array(ids), np.array(keys), rows
                words, lengths, ids, keys, rows, size = [], [], [], [], [], 0
    if ids:
        yield np.concatenate(words), np.array(lengths), np.array(ids), np.array(keys), rows


def _word_hashes() -> Hashes:
    from xxhash import xxh3_64_intdigest

    return Hashes(xxh3_64_intdigest)


def _index(window: int):
    """Blocks of a task's documents, settled within the task."""
    def scan(batches):
        found = []
        for words, lengths, ids, keys, _ in _steps(batches, _word_hashes(), 0, 1, 2):
            if len(words) < window:
                continue
            anchor, content, doc, start, count = blocks(words, lengths, window)
            at = keys[doc] | start << START_AT | count << 3
            found.append((anchor.view(np.int64), content.view(np.int64), ids[doc], at))
        if not found:
            return
        k1, k2, ids, at, begins, later = _first(*(np.concatenate(c) for c in zip(*found)))
        del found
        one = np.flatnonzero(begins)
        anchor = k1[one]
        many = np.zeros(len(one), dtype=bool)
        many[1:] = anchor[1:] == anchor[:-1]
        many[:-1] |= anchor[1:] == anchor[:-1]
        marks = np.unique(anchor[many])
        alone, shared, copied = one[~many], one[many], np.flatnonzero(later)
        zero = np.zeros(len(marks), dtype=np.int64)
        yield from _rows((k1[alone], k2[alone], ids[alone], at[alone] | CANDIDATE), (marks, zero, zero, zero + MARK),
                         _passing(ids[copied], at[copied] | COPIED), _passing(ids[shared], at[shared] | CHECK))
    return scan


def _windows(window: int):
    """Windows of the blocks that need the check, settled within the task."""
    def scan(batches):
        found = []
        for words, lengths, ids, keys, lists in _steps(batches, _word_hashes(), 0, 1, 2):
            begin = np.cumsum(lengths) - lengths
            rows = [np.array(x, dtype=np.int64) for x in lists]
            doc = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
            at = np.concatenate(rows)
            doc, at = doc[(at & 7) == CHECK], at[(at & 7) == CHECK]
            count = at >> 3 & 15
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            doc = np.repeat(doc, count)
            start = np.repeat(at >> START_AT & (1 << 30) - 1, count) + nth
            place = begin[doc] + start
            h1, h2 = (_mixed(grams(words, window, base)[place]).view(np.int64) for base in (A, B))
            found.append((h1, h2, ids[doc], keys[doc] | start << START_AT | 1 << 3))
        if not found:
            return
        k1, k2, ids, at, begins, later = _first(*(np.concatenate(c) for c in zip(*found)))
        yield from _rows((k1[begins], k2[begins], ids[begins], at[begins] | CANDIDATE), _passing(ids[later], at[later] | COPIED))
    return scan


def _kept(window: int):
    """Each document without the words of its factors."""
    def cut(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for i, k, places, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), utf8(b.column(2))):
                words = text.split()
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                if places:
                    at = np.array(places, dtype=np.int64)
                    at = at[(at & 7) == COPIED]
                    start = at >> START_AT & (1 << 30) - 1
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + (at >> 3 & 15) - 1 + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turns = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
                text = b" ".join(words) if not len(turns) else b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                row = (None if k >> NONE_AT else i, k >> TIE_AT & (1 << 24) - 1, len(words), int(gone.sum()), text,
                       turns[:, 0].tolist(), (turns[:, 1] - turns[:, 0]).tolist())
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            arrays = [pa.array(c, pa.binary()).cast(t) if t == pa.string() else pa.array(c, t) for c, t in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "tie", "n_words", "n_removed", "kept", "factor_starts", "factor_lengths"])
    return cut


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """(id, tie, n_words, n_removed, kept, factor_starts, factor_lengths) of every row: the text that
    is left, words joined by one space, and the factors that went, in words.  A word goes if a window
    of ``window`` words around it stands earlier: in a document before, or before in this document."""
    none = F.col(id_col).isNull()
    key = F.shiftleft(none.cast("long"), NONE_AT).bitwiseOR(
        F.shiftleft(F.xxhash64(text_col).bitwiseAND(F.lit((1 << 24) - 1)), TIE_AT))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(key, F.lit(0)).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    place = "k1 bigint, k2 bigint, id bigint, at bigint"
    kind = F.col("at").bitwiseAND(F.lit(7))
    body = F.col("at").bitwiseAND(F.lit(~7))
    earlier = F.rank().over(Window.partitionBy("k1", "k2").orderBy("id", "at")) > 1

    found = rows.mapInArrow(_index(window), place).repartition("k1").withColumn("later", earlier)
    anchor = Window.partitionBy("k1")
    content = F.when(kind == CANDIDATE, F.col("k2"))
    found = found.withColumn("differ", (F.max(kind == MARK).over(anchor)) | (F.min(content).over(anchor) != F.max(content).over(anchor)))
    fate = F.when(kind != CANDIDATE, kind).when(F.col("later"), COPIED).when(F.col("differ"), CHECK)
    key_of = F.col("at").bitwiseAND(F.lit(~((1 << TIE_AT) - 1)))
    found = found.withColumn("fate", fate).filter(F.col("fate").isin(COPIED, CHECK)) \
        .select("id", key_of.alias("key"), body.bitwiseOR(F.col("fate").cast("long")).alias("at"))
    found = store(found.groupBy("id", "key").agg(F.collect_list("at").alias("places")), "copied-blocks")

    check = found.filter(F.exists("places", lambda x: x.bitwiseAND(F.lit(7)) == CHECK))
    windows = rows.join(check, ["id", "key"]).select("id", "key", "text", "places").mapInArrow(_windows(window), place)
    windows = windows.withColumn("later", earlier).filter((kind == COPIED) | F.col("later")) \
        .select("id", key_of.alias("key"), body.bitwiseOR(F.lit(COPIED)).alias("at"))
    copied = found.select("id", "key", F.explode("places").alias("at")).filter(kind == COPIED).union(windows) \
        .groupBy("id", "key").agg(F.collect_list("at").alias("places"))
    result = "id bigint, tie bigint, n_words bigint, n_removed bigint, kept string, factor_starts array<bigint>, factor_lengths array<bigint>"
    return rows.join(copied, ["id", "key"], "left").select("id", "key", "text", "places").mapInArrow(_kept(window), result)
