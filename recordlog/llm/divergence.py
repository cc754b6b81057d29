"""Source divergence audit over a vocabulary kept as minimal acyclic transducers.

Each language keeps the terms that stand in enough of its documents.  The kept terms, sorted, are
cut into shards at places their own hashes choose; each shard becomes a minimal acyclic
transducer, built from its sorted terms, that gives a term's place in order (its ordinal).  The
texts are then read again and all their terms stream through the transducers for the recount:
a task first adds up what its own texts hold, the sums go to the shard of the term, many in a row, and
what the transducer does not accept is dropped.  Shard and ordinal are in the order of the terms, so
they break ties.

A group is a (language, source).  With count+1 over total+V scaled to integers, every kept term
adds (p-q)^2/q to each pair of groups of its language; sums by pair form inside the task, one
row a pair leaves it.  No vocabulary is broadcast: only the cuts (about ``MOST_CUTS`` at most,
256 bytes each) and the table of groups, whose pairs the result lists anyway.

Defined results: null text, language and source are empty; each row is a document, also when it
repeats another; groups without terms have counts of zero; an empty table gives no rows.  All
arithmetic is on integers, exact for counts of any size.  Extra columns are not read.
"""
from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import islice, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlog.llm.common import store, utf8

#: Parts of a term in bytes: letters and everything beyond ASCII; A-Z become a-z, the rest separates.
LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
#: Terms of a shard, about; more when there would be over MOST_CUTS shards.
SHARD_TERMS, MOST_CUTS, CUT_BYTES = 8_192, 16_384, 256
#: Sums that a task holds before it passes them on.
HELD = 500_000
SCALE = 1_000_000_000
#: Sums of a row that a task passes on, and of a shard before they are added up.
ROW_TERMS, SUMMED = 512, 1_000_000
ROW = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("entry", pa.binary()), ("source", pa.string()), ("terms", pa.binary()), ("ns", pa.binary())])
TERM = "lang string, entry binary, place bigint, sources array<string>, ns array<bigint>"
SCORE = "part string, lang string, source string, item string, place bigint, value bigint"


class Transducer:
    """Minimal acyclic automaton of sorted, distinct byte strings that gives each its number in order."""

    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.final: list[bool] = []
        self.edges: list[tuple] = []
        self.words: list[int] = []  # accepted from a state on
        self.path: list[list] = [[False, []]]
        self.last = b""

    def _state(self, final: bool, edges: list) -> int:
        key = (final, *edges)
        found = self.register.get(key)
        if found is None:
            found = self.register[key] = len(self.final)
            self.final.append(final)
            self.edges.append(tuple(edges))
            self.words.append(final + sum(self.words[to] for _, to in edges))
        return found

    def _close(self, depth: int) -> None:
        while len(self.path) - 1 > depth:
            state = self._state(*self.path.pop())
            self.path[-1][1].append((self.last[len(self.path) - 1], state))

    def add(self, word: bytes) -> None:
        """Words come in ascending order."""
        same, upto = 0, min(len(word), len(self.last))
        while same < upto and word[same] == self.last[same]:
            same += 1
        self._close(same)
        self.path += [[False, []] for _ in range(len(word) - same)]
        self.path[-1][0] = True
        self.last = word

    def finish(self) -> Transducer:
        """The tables that ``ordinals`` walks: transitions by (state, byte), target and number of words before."""
        self._close(0)
        self.start = self._state(*self.path.pop())
        keys, target, skip = [], [], []
        for state, edges in enumerate(self.edges):
            before = int(self.final[state])
            for byte, to in edges:
                keys.append(state << 8 | byte)
                target.append(to)
                skip.append(before)
                before += self.words[to]
        self.keys, self.target, self.skip = (np.array(x, dtype=np.int64) for x in (keys, target, skip))
        self.accepts = np.array(self.final)
        self.register, self.path = {}, []
        return self

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """Number of each word in order, -1 if it is none of the transducer's; all words walk at once."""
        out = np.full(len(words), -1, dtype=np.int64)
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        begin = np.cumsum(length) - length
        live, state, number, at = np.arange(len(words)), np.full(len(words), self.start), np.zeros(len(words), dtype=np.int64), 0
        while len(live):
            over = length[live] == at
            done = over & self.accepts[state]
            out[live[done]] = number[done]
            live, state, number = live[~over], state[~over], number[~over]
            if not len(live) or not len(self.keys):
                break
            want = state << 8 | data[begin[live] + at]
            k = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            ok = self.keys[k] == want
            live, state, number = live[ok], self.target[k[ok]], number[ok] + self.skip[k[ok]]
            at += 1
        return out


def _terms(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def _entry(lang: str) -> bytes:
    """What stands before the terms of a language: terms hold no zero byte."""
    return lang.encode() + b"\0"


def _document_counts(batches):
    """(entry, documents that hold it) of a task."""
    held: dict[str, Counter] = {}

    def rows():
        for lang, counts in held.items():
            head = _entry(lang)
            keys = list(counts)
            for at in range(0, len(keys), 65_536):
                some = keys[at:at + 65_536]
                yield pa.RecordBatch.from_arrays([pa.array([head + k for k in some], pa.binary()),
                                                  pa.array([counts[k] for k in some], pa.int64())], ["entry", "n"])
        held.clear()

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
            held.setdefault(lang, Counter()).update(set(_terms(text)))
            if len(held[lang]) > HELD or len(held) > 64 and sum(map(len, held.values())) > HELD:
                yield from rows()
    yield from rows()


def vocabulary(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """(entry): language, a zero byte and the term, of every term in ``min_docs`` documents (lang, text) or more."""
    return docs.select("lang", "text").mapInArrow(_document_counts, "entry binary, n bigint") \
        .groupBy("entry").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs).select("entry")


def cuts(vocab: DataFrame, shard_terms: int = SHARD_TERMS) -> list[bytes]:
    """Where shards begin: terms that their hash picks, one in ``shard_terms``."""
    rate = max(shard_terms, -(-vocab.count() // MOST_CUTS))
    found = vocab.filter(F.pmod(F.xxhash64("entry"), F.lit(rate)) == 0).select(F.substring("entry", 1, CUT_BYTES)).collect()
    return sorted({bytes(r[0]) for r in found})


def recount(docs: DataFrame, vocab: DataFrame, at: list[bytes]) -> DataFrame:
    """(lang, entry, place, sources, ns): how often each kept term stands in the texts of each source."""
    def kept(batches):
        for b in batches:
            entries = b.column(0).to_pylist()
            empty = pa.array([b""] * len(entries), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([bisect_right(at, e) for e in entries], pa.int32()), pa.array([0] * len(entries), pa.int32()),
                                              b.column(0).cast(pa.binary()), pa.array([""] * len(entries), pa.string()), empty, empty], schema=ROW)

    def counted(batches):
        held: dict[tuple, Counter] = {}

        def rows():
            for (lang, source), counts in held.items():
                head = _entry(lang)
                terms = sorted(counts)
                numbers = np.fromiter(map(counts.__getitem__, terms), dtype="<i8", count=len(terms))
                # the cuts within the language, and where they part its terms
                first = bisect_right(at, head)
                edges = [0, *(bisect_left(terms, c[len(head):]) for c in takewhile(lambda c: c.startswith(head), islice(at, first, None))), len(terms)]
                found = [(shard, some[lo:lo + ROW_TERMS]) for shard, some in enumerate(map(range, edges, edges[1:]), first)
                         for lo in range(0, len(some), ROW_TERMS)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard for shard, _ in found], pa.int32()), pa.array([1] * len(found), pa.int32()), pa.array([head] * len(found), pa.binary()),
                    pa.array([source] * len(found), pa.string()), pa.array([b"\0".join(terms[x.start:x.stop]) + b"\0" for _, x in found], pa.binary()),
                    pa.array([numbers[x.start:x.stop].tobytes() for _, x in found], pa.binary())], schema=ROW)
            held.clear()

        size = 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2))):
                own = held.setdefault((lang, source), Counter())
                size -= len(own)
                own.update(_terms(text))
                size += len(own)
                if size > HELD:
                    yield from rows()
                    size = 0
        yield from rows()

    kind = "shard int, kind int, entry binary, source string, terms binary, ns binary"
    rows = vocab.mapInArrow(kept, kind).unionByName(docs.select("lang", "source", "text").mapInArrow(counted, kind))
    return rows.repartition("shard").sortWithinPartitions("shard", "kind", "entry").mapInArrow(_stream, TERM)


def _words(terms: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different terms of rows in which a zero byte ends each, and where each stands among them."""
    data = np.frombuffer(b"".join(terms), dtype=np.uint8)
    ends = np.flatnonzero(data == 0)
    offsets = np.append(0, ends + 1 - np.arange(1, len(ends) + 1)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data[data != 0])]).dictionary_encode()
    return words.dictionary.to_pylist(), words.indices.to_numpy()


def _stream(batches):
    """Shard after shard: builds the transducer from its sorted terms, then streams the texts' terms through it
    and adds up what it accepts by term and source."""
    shard, automaton, kept, names, known = None, None, [], [], {}
    sums: list[tuple] = []  # numbers, sources, counts of the shard
    size = summed = 0  # of their rows, and of those that are added up

    def settled():
        numbers, sources, counts = _summed(sums)
        begin = np.append(np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])), len(numbers)).astype(np.int32)
        entries = [kept[i] for i in numbers[begin[:-1]]]
        return pa.RecordBatch.from_arrays([
            pa.array([e[:e.rindex(b"\0")].decode() for e in entries], pa.string()), pa.array(entries, pa.binary()),
            pa.array((shard << 32) + numbers[begin[:-1]]),
            pa.ListArray.from_arrays(pa.array(begin), pa.array([names[s] for s in sources], pa.string())),
            pa.ListArray.from_arrays(pa.array(begin), pa.array(counts))], ["lang", "entry", "place", "sources", "ns"])

    for b in batches:
        shards, kinds = (b.column(k).to_numpy() for k in (0, 1))
        for lo, hi in _runs(shards, kinds):
            if shards[lo] != shard:
                if size:
                    yield settled()
                shard, automaton, kept, sums, size, summed = int(shards[lo]), Transducer(), [], [], 0, 0
            if kinds[lo] == 0:
                for word in b.column(2).slice(lo, hi - lo).to_pylist():
                    automaton.add(word)
                    kept.append(word)
                continue
            if not kept:
                continue
            if automaton.path:
                automaton.finish()
            heads, source, terms, ns = (b.column(k).slice(lo, hi - lo).to_pylist() for k in (2, 3, 4, 5))
            for name in set(source) - known.keys():
                known[name] = len(names)
                names.append(name)
            edges = [0, *(i for i in range(1, len(heads)) if heads[i] != heads[i - 1]), len(heads)]
            for first, last in zip(edges, edges[1:]):
                words, which = _words(terms[first:last])
                numbers = automaton.ordinals([heads[first] + w for w in words])[which]
                ids = np.repeat([known[x] for x in source[first:last]], [len(x) // 8 for x in ns[first:last]])
                some = numbers >= 0
                sums.append((numbers[some], ids[some], np.frombuffer(b"".join(ns[first:last]), dtype="<i8")[some]))
                size += len(sums[-1][0])
            if size > 2 * summed + SUMMED:
                sums = [_summed(sums)]
                size = summed = len(sums[0][0])
    if size:
        yield settled()


def _summed(sums: list[tuple]) -> tuple:
    """Numbers, sources and counts added up, in order of number and source."""
    numbers, sources, counts = (np.concatenate(x) for x in zip(*sums))
    order = np.lexsort((sources, numbers))
    numbers, sources, counts = numbers[order], sources[order], counts[order]
    first = np.flatnonzero(np.append(True, (numbers[1:] != numbers[:-1]) | (sources[1:] != sources[:-1])))
    return numbers[first], sources[first], np.add.reduceat(counts, first)


def _runs(*keys: np.ndarray):
    n = len(keys[0])
    if not n:
        return
    change = np.zeros(n, dtype=bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    edges = [0, *np.flatnonzero(change).tolist(), n]
    yield from zip(edges[:-1], edges[1:])


def _share(counts: np.ndarray, total, v: int) -> np.ndarray:
    """p = 1 + floor(SCALE (count + 1) / (total + V)), beyond 64 bits in Python's integers."""
    below = total + v
    if int(np.max(below)) < 9_000_000_000:
        return 1 + SCALE * (counts + 1) // below
    return np.asarray(1 + SCALE * (counts.astype(object) + 1) // below, dtype=np.int64)


def _scores(groups: dict, top: int):
    """Sums by pair of groups of a task's terms, and the task's best terms of each group."""
    def score(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(0).to_pylist()
            edges = [0, *(i for i in range(1, len(langs)) if langs[i] != langs[i - 1]), len(langs)]
            for first, last in zip(edges[:-1], edges[1:]):
                if first == last:
                    continue
                lang = langs[first]
                names, at, totals, v = groups[lang]
                pair = sums.setdefault(lang, np.zeros((len(names), len(names)), dtype=np.int64))
                step = max(1, 1_000_000 // len(names))
                for lo in range(first, last, step):
                    rows = b.slice(lo, min(step, last - lo))
                    lists = rows.column(3)
                    sizes = np.diff(lists.offsets.to_numpy())
                    owner = np.repeat(np.arange(len(sizes)), sizes)
                    counts = np.zeros((len(names), len(sizes)), dtype=np.int64)
                    counts[[at[s] for s in lists.flatten().to_pylist()], owner] = rows.column(4).flatten().to_numpy()
                    p = _share(counts, totals[:, None], v)
                    for g in range(len(names)):
                        d = p[g] - p
                        pair[g] += (d * d // p).sum(axis=1)
                    q = _share(counts.sum(axis=0), np.sum(totals), v)
                    entries = rows.column(1).to_pylist()
                    places = rows.column(2).to_numpy()
                    found = []
                    for g in range(len(names)):
                        some = np.flatnonzero((counts[g] > 0) & (p[g] > q))
                        d = p[g][some] - q[some]
                        f = d * d // q[some]
                        best = np.lexsort((places[some], -f))[:top]
                        found += [(lang, names[g], entries[i].rpartition(b"\0")[2].decode(), int(places[i]), int(x)) for i, x in zip(some[best], f[best])]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(["term"] * len(found)), *(pa.array(c) for c in zip(*found))],
                                                         ["part", "lang", "source", "item", "place", "value"])
        for lang, pair in sums.items():
            names = groups[lang][0]
            for g, name in enumerate(names):
                yield pa.RecordBatch.from_arrays([
                    pa.array(["pair"] * len(names)), pa.array([lang] * len(names)), pa.array([name] * len(names)), pa.array(names),
                    pa.array(np.zeros(len(names), dtype=np.int64)), pa.array(pair[g])], ["part", "lang", "source", "item", "place", "value"])
    return score


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200, shard_terms: int = SHARD_TERMS,
          text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how each source's words differ from those of the other sources of its
    language (part pair), and the ``top`` terms it has more of than the language (part term)."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    vocab = store(vocabulary(docs, min_docs), "audit-vocabulary")
    counts = store(recount(docs, vocab, cuts(vocab, shard_terms)), "audit-counts")
    each = counts.select("lang", F.explode(F.arrays_zip("sources", "ns")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")) \
        .agg(F.sum("x.ns").alias("n"), F.count("*").alias("terms"))
    groups = store(docs.select("lang", "source").distinct().join(each, ["lang", "source"], "left"), "audit-groups")
    size = {r[0]: r[1] for r in counts.groupBy("lang").count().collect()}  # one row a language
    by_lang: dict[str, list] = {}
    for r in groups.select("lang", "source", F.coalesce("n", F.lit(0))).orderBy("lang", "source").collect():  # one row a group
        by_lang.setdefault(r[0], []).append((r[1], r[2]))
    table = {lang: ([s for s, _ in rows], {s: i for i, (s, _) in enumerate(rows)}, np.array([n for _, n in rows], dtype=np.int64), size.get(lang, 0))
             for lang, rows in by_lang.items()}
    scores = store(counts.mapInArrow(_scores(table, top), SCORE), "audit-scores")

    sums = scores.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "source")
    pairs = names.join(names.withColumnRenamed("source", "item"), "lang").filter("source <> item") \
        .join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    group = Window.partitionBy("lang", "source")
    pairs = pairs.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item")))
    terms = scores.filter("part = 'term'").withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "place"))).filter(F.col("rank") <= top)
    return pairs.unionByName(terms.select(pairs.columns))
