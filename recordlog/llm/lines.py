"""Line dedup: an exact set-similarity join of lines.

A line's tokens are its distinct shingles of five words; with ``short``, a line of one to four words
has one token, its whole word sequence, so it matches exact repeats.  All tokens are put in one order, rarest
first: counts over every document in hashed counters, ties by hash.  Two lines with a Jaccard
similarity of t or more share a token among the first n - ceil(t n) + 1 of both (prefix filter);
lengths and the token's positions bound their overlap (length and positional filter), and so
does the parity of their tokens' bits (a bitmap of 128 bits, which never rejects a match).  What
passes is verified on the full token sets.  A line goes if an earlier line of the corpus, by
document and line number, matches it; lines are judged on the input, not on what is left.

Equal lines first become one: a task settles its own and passes on the earliest by a digest of
128 bits, then the earliest of all stays.  The same reading fills the counters.  The prefixes
cross the network once, as token and line number; tokens that stand in one line only end there.
Each token's lines are compared with the earliest of them, which settles a group of
near copies in time linear in its size; only lines that this left open are compared with the
other lines of their tokens.

Defined results: lines are cut at line feeds; without ``short`` lines of fewer
than ``words`` words, and always lines without any word, are never compared or removed; null and empty texts lose nothing (null stays null); documents are ordered by id, null
ids last, rows that share an id by a hash of the text; rows equal in id and text count as one
document; an empty table gives no rows; extra columns are kept as they are.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlog.llm.common import drop, from_rows, store, utf8, whole_rows
from recordlog.llm.substrings import A, B, NO_ID, _first, _mixed, grams

#: Counters of the token counts, a fixed table of 512 KB.
COUNTER_BITS = 16
#: Fills a short line up to a shingle; stands for no word.
FILL = np.uint64(0x9E3779B97F4A7C15)
#: A line's place: no id (1 bit), hash of the text (24), line number (38).
TIE_AT, NONE_AT = 38, 62
LINE = "line bigint, id bigint, at bigint, n int, b1 bigint, b2 bigint, prefix array<bigint>"
#: A line's number: the task's (23 bits) and its own (24); an entry adds the token's place in the prefix, up to 16 bits.
TASK_LINES, POS_BITS = 24, 16
FIRST, LATER, COUNTS = range(3)
#: Ends a document: a byte that UTF-8 never uses.
DOCUMENT = b"\xff"
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E), DOCUMENT[0]])
#: Bytes that are hashed in one step, at some 40 times as much memory; bits of the filter of documents that a join needs.
STEP_BYTES, FILTER_BITS = 1 << 18, 22


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` as _row with id and key, never null; the key tells rows without an id and rows that share one apart."""
    key = F.shiftleft(F.col(id_col).isNull().cast("long"), NONE_AT).bitwiseOR(
        F.shiftleft(F.xxhash64(text_col).bitwiseAND(F.lit((1 << 24) - 1)), TIE_AT))
    return whole_rows(docs, id=F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), key=F.coalesce(key, F.lit(0)), text=F.col(text_col))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return _keyed(docs, id_col, text_col).select("id", "key", F.coalesce("text", F.lit("")).alias("text"))


class WordHashes:
    """64-bit hashes of all words of many texts at once, from running sums over their bytes."""

    def __init__(self):
        self.of_byte = _mixed(np.arange(1, 257, dtype=np.uint64) * A)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", int(B)), ("down", pow(int(B), -1, 1 << 64))):
                powers = np.full(n, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers))

    def of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, hash) of every word; data ends with white space."""
        self._powers(len(data))
        inside = ~SPACES[data]
        begin = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
        end = np.flatnonzero(inside[:-1] & ~inside[1:])
        total = np.cumsum(self.of_byte[data] * self.up[:len(data)])
        before = np.where(begin > 0, total[begin - 1], np.uint64(0))
        return begin, _mixed((total[end] - before) * self.down[begin] + (end - begin).astype(np.uint64))


def _shingles(batches, words: int, short: bool, wanted=None):
    """Shingle hashes of steps of documents: (hash, number of the line, ids, places) of lines that have any.
    ``wanted``: column of line numbers to read, else all."""
    least = 1 if short else words
    hashes = WordHashes()
    texts, ids, keys, picked, held = [], [], [], [], 0

    def step():
        data = np.frombuffer(DOCUMENT.join([*texts, b""]), dtype=np.uint8)
        begin, every = hashes.of(data)
        ends = np.flatnonzero((data == 0x0A) | (data == DOCUMENT[0]))
        count = np.diff(np.searchsorted(ends, np.flatnonzero(data == DOCUMENT[0]), side="right"), prepend=0)
        upto = np.searchsorted(begin, ends)
        length = np.diff(upto, prepend=0)
        doc = np.repeat(np.arange(len(count)), count)
        number = np.arange(len(ends)) - np.repeat(np.cumsum(count) - count, count)
        keep = length >= least
        if wanted is not None:
            asked = np.zeros(len(ends), dtype=bool)
            for first, numbers in zip((np.cumsum(count) - count).tolist(), picked):
                asked[first + np.array(numbers, dtype=np.int64)] = True
            keep &= asked
        keep = np.flatnonzero(keep)
        length, first = length[keep], upto[keep] - length[keep]
        size = np.maximum(length, words)
        filled = np.full(size.sum(), FILL)
        inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        filled[np.repeat(np.cumsum(size) - size, length) + inside] = every[np.repeat(first, length) + inside]
        owner = np.repeat(np.arange(len(size)), size)
        starts = np.flatnonzero(np.repeat(np.cumsum(size), size)[:max(0, len(filled) - words + 1)] - np.arange(max(0, len(filled) - words + 1)) >= words)
        of = doc[keep]
        hashed = _mixed(grams(filled, words, A))[starts] if len(keep) else filled
        return hashed, owner[starts], np.array(ids, dtype=np.int64)[of], np.array(keys, dtype=np.int64)[of] | number[keep]

    for b in batches:
        asked = b.column(wanted).to_pylist() if wanted is not None else None
        for i, (d, k, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)))):
            texts.append(text)
            ids.append(d)
            keys.append(k)
            if asked is not None:
                picked.append(asked[i])
            held += len(text)
            if held >= STEP_BYTES:
                found = step()
                if len(found[2]):
                    yield found
                texts, ids, keys, picked, held = [], [], [], [], 0
    if ids:
        found = step()
        if len(found[2]):
            yield found
    pa.default_memory_pool().release_unused()  # of the batches; else the worker holds on to it, and lives on after its task


def _line_digests(hashed: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each line's shingles, with their repeats."""
    begin = np.searchsorted(owner, np.arange(n))
    one = _mixed(hashed * B)
    return np.add.reduceat(one, begin), np.add.reduceat(_mixed(one + A), begin)


def _scan(words: int, short: bool):
    """One reading of all lines: counts of their shingles in counters (kind COUNTS), each task's earliest of equal
    lines (FIRST) and the others (LATER)."""
    def scan(batches):
        total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
        rows = []
        for hashed, owner, ids, ats in _shingles(batches, words, short):
            total += np.bincount((hashed >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), minlength=len(total))
            h1, h2 = _line_digests(hashed, owner, len(ids))
            rows.append((h1.view(np.int64), h2.view(np.int64), ids, ats))
        at = np.flatnonzero(total)
        none = np.zeros(len(at), dtype=np.int64)
        found = [(at, total[at], none, none, np.full(len(at), COUNTS, dtype=np.int32))]
        if rows:
            h1, h2, ids, ats = (np.concatenate(c) for c in zip(*rows))
            h1, h2, ids, ats, begins, later = _first(h1, h2, ids, ats)
            keep = begins | later  # rows that repeat a line's place count once
            found.append(tuple(c[keep] for c in (h1, h2, ids, ats)) + (np.where(later[keep], LATER, FIRST).astype(np.int32),))
        for part in found:
            for lo in range(0, len(part[0]), 65_536):
                yield pa.RecordBatch.from_arrays([pa.array(c[lo:lo + 65_536]) for c in part], ["h1", "h2", "id", "at", "kind"])
    return scan


def _distinct(tokens: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    return tokens[new], owner[new]


def _index(counts: np.ndarray, words: int, threshold: float, short: bool):
    """Lines of a task with their prefix; of equal lines the earliest only."""
    mean = max(1.0, counts.sum() / len(counts))
    # rarity class of a counter: 0 up to twice the mean, then by powers of two
    rarity = np.minimum(63, np.maximum(0, np.floor(np.log2(np.maximum(counts, 1) / mean)))).astype(np.uint64)
    low = np.uint64((1 << 58) - 1)

    def scan(batches):
        from pyspark import TaskContext

        lists, rows = [], []
        for hashed, owner, ids, ats in _shingles(batches, words, short):
            h1, h2 = _line_digests(hashed, owner, len(ids))
            token, owner = _distinct(rarity[(hashed >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)] << np.uint64(58) | hashed & low, owner)
            begin = np.searchsorted(owner, np.arange(len(ids)))
            n = np.diff(begin, append=len(owner))
            mixed = _mixed(token * B)
            bit, half = np.uint64(1) << (mixed & np.uint64(63)), (mixed >> np.uint64(6)) & np.uint64(1)
            b1, b2 = (np.bitwise_xor.reduceat(np.where(half == np.uint64(k), bit, np.uint64(0)), begin) for k in (0, 1))
            most = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
            head = np.arange(len(owner)) - begin[owner] < most[owner]
            lists.append((token[head].view(np.int64), most))
            rows.append((h1.view(np.int64), h2.view(np.int64), ids, ats, n, b1.view(np.int64), b2.view(np.int64)))
        if not rows:
            return
        h1, h2, ids, ats, n, b1, b2 = (np.concatenate(c) for c in zip(*rows))
        flat, most = np.concatenate([x for x, _ in lists]), np.concatenate([x for _, x in lists])
        order = np.lexsort((ats, ids, h2, h1))
        keep = np.sort(order[_first(h1, h2, ids, ats)[4]])
        ends = np.cumsum(most)
        number = (TaskContext.get().partitionId() << TASK_LINES) + np.arange(len(keep))
        for lo in range(0, len(keep), 16_384):
            some = keep[lo:lo + 16_384]
            size = most[some]
            at = np.repeat(ends[some] - size, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            prefix = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(flat[at]))
            yield pa.RecordBatch.from_arrays([pa.array(number[lo:lo + 16_384]), *(pa.array(c[some]) for c in (ids, ats)), pa.array(n[some].astype(np.int32)),
                                              pa.array(b1[some]), pa.array(b2[some]), prefix], ["line", "id", "at", "n", "b1", "b2", "prefix"])
    return scan


def _met(batches):
    """Of entries in order of their tokens, those whose token another entry has too."""
    held, last = None, None  # the rows of the last token of a batch, and what they belong to

    def out(tokens, refs):
        return pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(refs)], ["token", "ref"])

    for b in batches:
        tokens, refs = b.column(0).to_numpy(), b.column(1).to_numpy()
        if not len(tokens):
            continue
        same = tokens[1:] == tokens[:-1]
        meets = np.zeros(len(tokens), dtype=bool)
        meets[1:] |= same
        meets[:-1] |= same
        if last is not None and tokens[0] == last:
            meets[0] = True
            if held is not None:
                yield out(np.array([last]), np.array([held]))
            held = None
        last = tokens[-1]
        alone = not meets[-1]
        held = refs[-1] if alone else None
        if meets.any():
            yield out(tokens[meets], refs[meets])


def _led(threshold: float):
    """Of entries in order of token and line, those whose token another line has too, with the earliest line of the
    token (lead) and whether the two may match."""
    names = ["token", "id", "at", "n", "pos", "b1", "b2"]

    def scan(batches):
        held, emitted = None, False  # first row of the last token, and whether it has gone out
        for b in batches:
            if not b.num_rows:
                continue
            c = [b.column(k).to_numpy() for k in range(7)]
            c = c if held is None else [np.append(h, x) for h, x in zip(held, c)]
            token = c[0]
            first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            size = np.diff(first, append=len(token))
            if held is not None and emitted:
                size[0] += 1
            lead = np.repeat(first, np.diff(first, append=len(token)))
            out = np.repeat(size > 1, np.diff(first, append=len(token)))
            if held is not None and emitted:
                out[0] = False
            emitted = bool(size[-1] > 1)
            held = [x[first[-1]:first[-1] + 1] for x in c]
            at = np.flatnonzero(out)
            x, y = [v[lead[at]] for v in c], [v[at] for v in c]
            close = _may_match(threshold, x[3], y[3], x[4], y[4], _differing(x[5], y[5]) + _differing(x[6], y[6]),
                               np.minimum, np.maximum, np.ceil) & ((x[1] != y[1]) | (x[2] != y[2]))
            if len(at):
                yield pa.RecordBatch.from_arrays([*map(pa.array, y), pa.array(x[1]), pa.array(x[2]), pa.array(close)], [*names, "lead_id", "lead_at", "close"])
    return scan


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)).astype(np.int64)


def _may_match(threshold: float, nx, ny, px, py, differ, least_of=F.least, most_of=F.greatest, ceil=F.ceil):
    """Length, positional and bitmap filter of a pair with a common token, on columns or arrays."""
    least = ceil((nx + ny) * (threshold / (1 + threshold)) - 1e-9)
    upto = least_of(px, py) + 1 + least_of(nx - px - 1, ny - py - 1)
    return (least_of(nx, ny) >= most_of(nx, ny) * threshold - 1e-9) & (upto >= least) & (differ <= nx + ny - 2 * least)


def _touched(rows: DataFrame, some: DataFrame, how: str = "left_semi") -> DataFrame:
    """``rows`` whose (id, key) may be among those of ``some`` (all that are, and few others), or with left_anti the rest:
    a filter of 2^FILTER_BITS bits, which is broadcast (a bound), so that other rows need not be shuffled."""
    place = F.pmod(F.xxhash64("id", "key"), F.lit(1 << FILTER_BITS))
    bits = store(some.select(F.shiftright(place, 6).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int")).alias("bit"))
                 .groupBy("_word").agg(F.bit_or("bit").alias("_bits")), "line-filter")
    here = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    return rows.join(F.broadcast(bits), (F.shiftright(place, 6) == F.col("_word")) & (F.col("_bits").bitwiseAND(here) != 0), how)


def _earlier(x: str = "x", y: str = "y") -> Column:
    return (F.col(f"{x}.id") < F.col(f"{y}.id")) | ((F.col(f"{x}.id") == F.col(f"{y}.id")) & (F.col(f"{x}.at") < F.col(f"{y}.at")))


def _verified(rows: DataFrame, pairs: DataFrame, words: int, threshold: float, short: bool) -> DataFrame:
    """(id, at) of the later lines of pairs that match on their full token sets."""
    pairs = store(pairs.distinct(), "line-pairs")
    number = F.lit((1 << TIE_AT) - 1)
    needed = pairs.select(F.col("x_id").alias("id"), F.col("x_at").alias("at")).union(pairs.select("y_id", "y_at")).distinct() \
        .select("id", F.col("at").bitwiseAND(F.lit(~((1 << TIE_AT) - 1))).alias("key"), F.col("at").bitwiseAND(number).alias("line")) \
        .groupBy("id", "key").agg(F.collect_set("line").alias("lines"))

    def read(batches):
        for hashed, owner, ids, ats in _shingles(batches, words, short, wanted=3):
            token, owner = _distinct(hashed, owner)
            begin = np.searchsorted(owner, np.arange(len(ids) + 1))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ats), pa.ListArray.from_arrays(
                pa.array(begin.astype(np.int32)), pa.array(token.view(np.int64)))], ["id", "at", "tokens"])

    # rows that repeat a document give its lines again: one copy serves
    needed = store(needed, "line-needed")
    sets = _touched(rows, needed).join(needed, ["id", "key"]).select("id", "key", "text", "lines") \
        .mapInArrow(read, "id bigint, at bigint, tokens array<bigint>").dropDuplicates(["id", "at"])
    sets = store(sets, "line-tokens")
    for side in "xy":
        pairs = pairs.join(sets.select(F.col("id").alias(f"{side}_id"), F.col("at").alias(f"{side}_at"), F.col("tokens").alias(f"{side}_tokens")),
                           [f"{side}_id", f"{side}_at"])
    common = F.size(F.array_intersect("x_tokens", "y_tokens"))
    total = F.size("x_tokens") + F.size("y_tokens")
    return store(pairs.filter(common >= F.ceil(total * F.lit(threshold / (1 + threshold)) - 1e-9))
                 .select(F.col("y_id").alias("id"), F.col("y_at").alias("at")).distinct(), "line-matches")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: float = 0.8,
             short: bool = False) -> DataFrame:
    """(id, key, removed): the numbers (from 0) of the lines that go, of documents that lose any."""
    rows = _rows(docs, id_col, text_col)
    seen = store(rows.mapInArrow(_scan(words, short), "h1 bigint, h2 bigint, id bigint, at bigint, kind int"), "line-digests")
    counts = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    for r in seen.filter(F.col("kind") == COUNTS).groupBy("h1").agg(F.sum("h2")).collect():  # one row a counter
        counts[r[0]] = r[1]
    nth = F.rank().over(Window.partitionBy("h1", "h2").orderBy("id", "at"))
    later = store(seen.filter(F.col("kind") == LATER).select("id", "at")
                  .union(seen.filter(F.col("kind") == FIRST).withColumn("nth", nth).filter("nth > 1").select("id", "at")), "line-repeats")
    drop(seen)
    lines = store(rows.mapInArrow(_index(counts, words, threshold, short), LINE), "lines")
    # an entry: token, and the line's number with the token's place; tokens that stand in one line only match nothing
    entries = lines.select(F.posexplode("prefix").alias("pos", "token"), "line") \
        .select("token", F.shiftleft("line", POS_BITS).bitwiseOR(F.least("pos", F.lit((1 << POS_BITS) - 1)).cast("long")).alias("ref"))
    met = store(entries.repartition("token").sortWithinPartitions("token").mapInArrow(_met, "token bigint, ref bigint"), "line-tokens-met") \
        .select("token", F.col("ref").bitwiseAND(F.lit((1 << POS_BITS) - 1)).cast("int").alias("pos"), F.shiftright("ref", POS_BITS).alias("line"))
    firsts = lines.drop("prefix").join(later, ["id", "at"], "left_anti")
    entries = store(met.join(firsts, "line").drop("line"), "line-entries")
    drop(lines)

    kinds = "token bigint, id bigint, at bigint, n int, pos int, b1 bigint, b2 bigint"
    by_token = entries.select("token", "id", "at", "n", "pos", "b1", "b2").repartition("token").sortWithinPartitions("token", "id", "at")
    entries = store(by_token.mapInArrow(_led(threshold), f"{kinds}, lead_id bigint, lead_at bigint, close boolean"), "line-groups")
    led = entries.filter("close").select(F.col("lead_id").alias("x_id"), F.col("lead_at").alias("x_at"), F.col("id").alias("y_id"), F.col("at").alias("y_at"))
    matched = _verified(rows, led, words, threshold, short)
    open_lines = entries.join(matched, ["id", "at"], "left_anti")
    differ = F.bit_count(F.col("x.b1").bitwiseXOR(F.col("y.b1"))) + F.bit_count(F.col("x.b2").bitwiseXOR(F.col("y.b2")))
    is_lead = (F.col("x.id") == F.col("y.lead_id")) & (F.col("x.at") == F.col("y.lead_at"))
    rest = open_lines.alias("y").join(entries.alias("x"), "token") \
        .filter(_earlier() & ~is_lead & _may_match(threshold, *(F.col(c) for c in ("x.n", "y.n", "x.pos", "y.pos")), differ)) \
        .select(F.col("x.id").alias("x_id"), F.col("x.at").alias("x_at"), F.col("y.id").alias("y_id"), F.col("y.at").alias("y_at"))
    matched = matched.union(_verified(rows, rest, words, threshold, short))
    gone = later.union(matched)
    number = F.lit((1 << TIE_AT) - 1)
    return gone.groupBy("id", F.col("at").bitwiseAND(F.lit(~((1 << TIE_AT) - 1))).alias("key")) \
        .agg(F.array_sort(F.collect_set(F.col("at").bitwiseAND(number))).alias("removed"))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: float = 0.8,
           short: bool = False) -> DataFrame:
    """(id, n_lines, removed) of every row of ``docs``; removed: line numbers, in order."""
    rows = _rows(docs, id_col, text_col).select("id", "key", F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).alias("n_lines"))
    found = rows.join(repeated(docs, id_col, text_col, words, threshold, short), ["id", "key"], "left")
    none = F.col("key").bitwiseAND(F.lit(1 << NONE_AT)) != 0
    return found.select(F.when(~none, F.col("id")).alias("id"), "n_lines", F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: float = 0.8,
          short: bool = False) -> DataFrame:
    """``docs`` with the repeated lines cut out of the text, columns as given."""
    @F.arrow_udf("string")
    def cut(texts: pa.Array, removed: pa.Array) -> pa.Array:
        out = []
        for text, gone in zip(utf8(texts), removed.to_pylist()):
            gone = gone if gone is None else set(gone)
            out.append(None if gone is None else b"\n".join(line for n, line in enumerate(text.split(b"\n")) if n not in gone))
        return pa.array(out, pa.binary()).cast(pa.string())

    rows = _keyed(docs, id_col, text_col)
    gone = store(repeated(docs, id_col, text_col, words, threshold, short), "line-gone")
    # only documents that lose lines meet them in a shuffle
    found = _touched(rows, gone).join(gone, ["id", "key"], "left")
    touched = F.col("removed").isNotNull()
    found = found.withColumn("left", cut(F.when(touched, F.col("text")), F.col("removed")))  # other texts stay on the JVM's side
    found = from_rows(found, docs, **{text_col: F.when(touched, F.col("left")).otherwise(F.col("text"))})
    return found.union(from_rows(_touched(rows, gone, "left_anti"), docs))
