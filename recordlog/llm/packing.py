"""Best-fit packing of token pieces into sequences: bin completion by branch and bound.

Documents are tokenized where they lie; only lengths move.  Lengths are at most ``capacity``,
so how many pieces there are of each length is a table of at most ``capacity`` rows whatever
the size of the corpus, and a packing is a short list of fillings with the number of times
each is used.  The driver searches that list: best-fit decreasing gives the first solution;
then, around the largest length left, undominated fillings are enumerated in order of waste,
each used as often as the counts allow, and a branch ends when its waste alone already rules
out a better solution.  A first pass tries the few most promising fillings of each branch; what
is left of the steps goes to a second one over all undominated fillings, each used as often as
possible or once, so the search only ends at its steps, a proof, or the end of the tree.  The tasks then deal the pieces of each length out to the fillings'
places by their rank among the pieces of that length.  Ranks are counted in buckets of a hash
of the key, so a length that a third of all pieces share is never gathered in one task.

Defined results: a null or empty text is one piece that holds the end id alone; longer
documents are cut into full pieces and a rest; a null id and repeated rows are documents like
others, each with its own places; an empty table gives no pieces; extra columns are ignored.
"""
from __future__ import annotations

import math
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain
from operator import length_hint

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlog.llm.common import store, utf8

#: One filling of a sequence: ((length, how many), ...), longest first.
Filling = tuple[tuple[int, int], ...]
#: Steps of the search for better packings, and in its first pass of one enumeration of fillings and
#: its branches.  They bound the driver's time; the packing is whole wherever the search ends.
SEARCH_NODES, FILLING_STEPS, BRANCHES = 8_000, 400, 3
BUCKET_ROWS = 4096
#: Pieces or parts that one call of the tokenizer takes.
CALL_PARTS = 8192


# -- tokens ---------------------------------------------------------------------------------

#: Parts that a vocabulary's own splitting leaves to `_PIECES` below: printable ASCII but for the apostrophe, and
#: the Latin letters of one code point each up to U+00FF, which stand for themselves in NFC.
_OTHER = re.compile(r"[^!-&(-~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]|<\|")
_PIECES = re.compile(r"[a-z\u00DF-\u00F6\u00F8-\u00FF]+|[0-9]|[^a-z0-9\u00DF-\u00F6\u00F8-\u00FF]+")
#: A vocabulary of bytes writes these letters' two UTF-8 bytes as two signs: those from 0x80 to 0xA0 as U+0122 on.
_AS_BYTES = {c: "".join(chr(b + 0xA2 if b <= 0xA0 else 0x143 if b == 0xAD else b) for b in chr(c).encode()) for c in range(0xC0, 0x100)}
#: Parts by which a vocabulary shows that its tokenizer splits them so.
PROBES = [*map(chr, (*range(33, 39), *range(40, 127), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))),
          "the", "internationalization", "qzxwv", "aaaaaaaaaaaaaaaaaaaaaaaa", "thshdndthanntheranre", "The", "WORDS,", "a.b", "end.", "$$$", ".,!?",
          "a1b22", "3.14", "x_y", "mail.01@host.example.com", "(2024-05-06)", "École,", "naïve", "straße", "ÀÉÎÕÜ", "été!été", "#ÿ9ß-þ"]


class TokenBytes:
    """Ids of a UTF-8 text as little-endian unsigned 32-bit integers.

    The vocabulary never joins across ASCII white space, so a text is put together from its space-separated
    parts.  Many texts go at once, about ``at_once`` bytes: Arrow splits them, tells their different parts and
    puts the ids of the parts together; only parts not seen of late are encoded.  Parts seen last are kept
    (``most`` and as many before them, and those of one such block of texts).

    Where the tokenizer shows by `PROBES` that it does, common parts are cut into runs of letters, single
    digits and runs of other signs in small letters, and the different pieces of all of them go to the
    vocabulary's model in one call, whose ids tell where a piece ends.  All other parts go to the tokenizer as they are."""

    def __init__(self, path: str, most: int = 160_000, at_once: int = 8 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.most, self.at_once = Tokenizer.from_file(path), most, at_once
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.ends, self.bare = None, None
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            vocab = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            cut = dict(zip(PROBES, self._by_pieces(PROBES)))
            if cut != dict(zip(PROBES, self._encode(PROBES))):
                self.bare = None
            self.known.clear()

    def of(self, texts: Iterator[bytes]) -> Iterator[bytes]:
        some, size = [], 0
        for t in texts:
            # fewer different parts; a small letter may compose with a mark where the capital does not, so others stay
            some.append(t.lower() if t.isascii() and b"<|" not in t else t)
            size += len(t)
            if size >= self.at_once:
                yield from self._block(some)
                some, size = [], 0
        if some:
            yield from self._block(some)
        pa.default_memory_pool().release_unused()

    def _block(self, texts: list[bytes]) -> Iterator[bytes]:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        parts = split.values.dictionary_encode()
        ids = pa.array(self._ids([p.decode("utf-8", "replace") for p in parts.dictionary.cast(pa.large_binary()).to_pylist()]), pa.large_binary())
        every = ids.take(parts.indices)
        _, offsets, data = every.buffers()
        at = np.frombuffer(offsets, dtype=np.int64, count=len(every) + 1)[split.offsets.to_numpy()].tolist()
        view = memoryview(data if data is not None else b"")
        del split, parts, ids
        pa.default_memory_pool().release_unused()  # else the worker holds on to what a block took, and lives on after its task
        for a, b in zip(at, at[1:]):
            yield bytes(view[a:b])

    def _ids(self, parts: list[str]) -> list[bytes]:
        if len(self.known) > self.most:  # parts that are met again come back from the older half
            self.before, self.known = self.known, {}
        new = set(parts) - self.known.keys()
        back = {p: self.before[p] for p in new if p in self.before}
        self.known.update(back)
        new = list(new - back.keys())
        other = new
        if self.bare is not None:
            common, other = [], []
            for p in new:
                (common if p.isascii() and p.isalpha() or not _OTHER.search(p) else other).append(p)
            self.known.update(zip(common, self._by_pieces(common)))
        self.known.update(zip(other, self._encode(other)))
        return list(map(self.known.__getitem__, parts))

    def _by_pieces(self, parts: list[str]) -> list[bytes]:
        known, lower = self.known, list(map(str.lower, parts))
        cut = {p: _PIECES.findall(p) for p in lower if not p.isalpha()}
        new = list((set(lower) - cut.keys()).union(*cut.values()) - known.keys())
        for lo in range(0, len(new), CALL_PARTS):
            some = new[lo:lo + CALL_PARTS]
            text = " ".join([p if p.isascii() else p.translate(_AS_BYTES) for p in some])
            ids = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            to = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(to) != len(some):
                return self._encode(parts)
            every = ids.tobytes()
            known.update((p, every[a:b]) for p, a, b in zip(some, [0, *to], to))
        return [b"".join([known[x] for x in cut[p]]) if p in cut else known[p] for p in lower]

    def _encode(self, parts: list[str]) -> list[bytes]:
        found = []
        for lo in range(0, len(parts), CALL_PARTS):
            some = self.tokenizer.encode_batch_fast(parts[lo:lo + CALL_PARTS], add_special_tokens=False)
            found += [np.array(e.ids, dtype="<u4").tobytes() for e in some]
        return found


def encoder(path: str) -> TokenBytes:
    """The encoder of this process: the parts it knows serve all tasks that the process runs.  Functions reach the
    tasks by value, so it is kept on a module that a process has once."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_encoders_by_path", {})
    if path not in kept:
        kept[path] = TokenBytes(path)
    return kept[path]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
           capacity: int = 4096, with_ids: bool = False) -> DataFrame:
    """(id, tie, piece, start, length, crc32[, ids]) of every piece; ids are little-endian bytes.
    tie tells rows that share an id apart by their text."""
    names = ["id", "tie", "piece", "start", "length", "crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        tokens = encoder(tokenizer)
        for b in batches:
            out: list[list] = [[] for _ in names]
            for i, t, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), tokens.of(utf8(b.column(2)))):
                whole = memoryview(ids + end)
                for k, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at:at + 4 * capacity]
                    row = [i, t, k, at // 4, len(part) // 4, zlib.crc32(part)] + [bytes(part)] * with_ids
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    schema = "id bigint, tie bigint, piece int, start bigint, length bigint, crc32 bigint" + ", ids binary" * with_ids
    return rows.mapInArrow(cut, schema)


# -- the search, over counts of lengths ------------------------------------------------------

def best_fit(counts: dict[int, int], capacity: int) -> dict[Filling, int]:
    """Best-fit decreasing, all bins alike at once: filling -> bins."""
    open_bins: dict[int, dict[Filling, int]] = {capacity: {}}
    rooms: list[int] = []

    def put(room: int, filling: Filling, bins: int) -> None:
        if bins:
            if room not in open_bins or not open_bins[room]:
                open_bins.setdefault(room, {})
                insort(rooms, room)
            open_bins[room][filling] = open_bins[room].get(filling, 0) + bins

    def drop(room: int) -> None:
        del open_bins[room]
        rooms.pop(bisect_left(rooms, room))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                bins, rest = divmod(left, each)
                put(capacity - each * length, ((length, each),), bins)
                if rest:
                    put(capacity - rest * length, ((length, rest),), 1)
                break
            room = rooms[at]
            filling, bins = open_bins[room].popitem()
            each = room // length
            full = min(bins, left // each)
            rest = min(left - full * each, each - 1) if full < bins else 0
            kept = bins - full - (rest > 0)
            if not open_bins[room]:
                drop(room)
            put(room, filling, kept)
            put(room - each * length, (*filling, (length, each)), full)
            if rest:
                put(room - rest * length, (*filling, (length, rest)), 1)
            left -= full * each + rest
    found: dict[Filling, int] = {}
    for room in rooms:
        for filling, bins in open_bins[room].items():
            found[filling] = found.get(filling, 0) + bins
    return found


def _dominated(counts: dict[int, int], lengths: list[int], chosen: tuple, waste: int) -> bool:
    used = dict(chosen)
    for length, _ in chosen:
        k = bisect_left(lengths, length + 1)
        while k < len(lengths) and lengths[k] <= length + waste:
            if counts[lengths[k]] > used.get(lengths[k], 0):
                return True
            k += 1
    return any(counts[x] > used.get(x, 0) for x in lengths[:bisect_left(lengths, waste + 1)])


def _every_filling(counts: dict[int, int], lengths: list[int], room: int) -> Iterator[tuple[int, Filling] | None]:
    """All undominated fillings of ``room``, one at a time, and None for each step between them."""
    stack = [(len(lengths), room, ())]
    while stack:
        upto, room, chosen = stack.pop()
        at = bisect_left(lengths, room + 1, 0, upto)
        if at == 0:
            yield None if _dominated(counts, lengths, chosen, room) else (room, chosen)
            continue
        yield None
        # with at least one of the longest that fits, the most first, or none of it
        length = lengths[at - 1]
        stack.append((at - 1, room, chosen))
        stack += [(at - 1, room - n * length, (*chosen, (length, n))) for n in range(1, min(counts[length], room // length) + 1)]


def _fillings(counts: dict[int, int], lengths: list[int], room: int) -> list[tuple[int, Filling]]:
    """Undominated fillings of ``room``, least waste first: no length in one can be exchanged for a
    longer one that is left, and nothing that is left still fits."""
    found: list[tuple[int, Filling]] = []
    steps = 0

    def grow(upto: int, room: int, chosen: tuple) -> bool:
        nonlocal steps
        steps += 1
        at = bisect_left(lengths, room + 1, 0, upto)
        if at == 0:
            if not _dominated(counts, lengths, chosen, room):
                found.append((room, chosen))
            return room == 0 or steps > FILLING_STEPS
        for k in range(at - 1, max(-1, at - 1 - BRANCHES), -1):
            length = lengths[k]
            most = min(counts[length], room // length)
            for n in range(most, max(0, most - 2), -1):
                if grow(k, room - n * length, (*chosen, (length, n))) or steps > FILLING_STEPS:
                    if len(found) >= BRANCHES or steps > FILLING_STEPS:
                        return True
        return False

    grow(len(lengths), room, ())
    return sorted(set(found))[:BRANCHES]


def plan(counts: dict[int, int], capacity: int, steps: int | None = SEARCH_NODES) -> dict[Filling, int]:
    """Filling -> how often; every piece of ``counts`` (length -> pieces) has a place.  ``steps`` bound the search;
    None lets it run to a proof or the end of the tree."""
    counts = {k: n for k, n in counts.items() if n}
    total = sum(k * n for k, n in counts.items())
    best = best_fit(counts, capacity)
    least = max(-(-total // capacity), sum(n for k, n in counts.items() if 2 * k > capacity))
    nodes = 0

    def few(rest: dict[int, int], lengths: list[int], room: int) -> Iterator:
        return iter([(w, f, False) for w, f in _fillings(rest, lengths, room) or [(room, ())]])

    def every(rest: dict[int, int], lengths: list[int], room: int) -> Iterator:
        for found in _every_filling(rest, lengths, room):
            yield found and (*found, False)
            if found:
                yield (*found, True)

    for choose in (few, every):
        # a stack of branches: lengths left, fillings so far (the earlier ones, the last, how often), bins used,
        # waste so far, and the choices not tried yet
        stack = [(dict(counts), None, 0, 0, None)]
        while stack and sum(best.values()) > least and (steps is None or nodes < steps):
            left, used, bins, waste, choices = stack.pop()
            spare = (sum(best.values()) - 1) * capacity - total  # waste that a better packing may have
            if waste > spare:
                continue
            if not left:
                best = {}
                while used:
                    used, key, times = used
                    best[key] = best.get(key, 0) + times
                continue
            longest = max(left)
            if choices is None:
                rest = {**left, longest: left[longest] - 1}
                choices = choose(rest, sorted(k for k, n in rest.items() if n), capacity - longest)
            choice = next(choices, False)
            if choice is False:
                continue
            nodes += 1
            if length_hint(choices, 1):
                stack.append((left, used, bins, waste, choices))
            if choice is None:  # a step without a filling
                continue
            w, filling, once = choice
            if waste + w > spare:
                continue
            take = dict(filling)
            take[longest] = take.get(longest, 0) + 1
            times = min(left[k] // n for k, n in take.items())
            if w:  # a filling with waste is used no oftener than a better packing could bear
                times = max(1, min(times, (spare - waste) // w))
            if once and times == 1:  # tried already
                continue
            times = 1 if once else times
            key = tuple(sorted(take.items(), reverse=True))
            after = {k: n - times * take.get(k, 0) for k, n in left.items()}
            stack.append(({k: n for k, n in after.items() if n}, (used, key, times), bins + times, waste + w * times, None))
    return best


# -- dealing the pieces out --------------------------------------------------------------------

def _places(packing: dict[Filling, int]) -> np.ndarray:
    """Rows (length, first rank, pieces in a sequence, first sequence, offset) by length and first rank."""
    rows, given, base = [], {}, 0
    for filling, bins in packing.items():
        at = 0
        for length, each in filling:
            first = given.get(length, 0)
            rows.append((length, first, each, base, at))
            given[length] = first + bins * each
            at += each * length
        base += bins
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(items: DataFrame, order: list[str], capacity: int = 4096, steps: int | None = SEARCH_NODES) -> DataFrame:
    """``items`` (a stored table with a column length, 1 to ``capacity``) with sequence_id and offset.
    ``order``: columns that make a row's rank; equal rows may exchange places."""
    rows = items.count()
    bits = max(1, math.ceil(math.log2(rows / BUCKET_ROWS + 1)))
    numbered = items.withColumn("_bucket", F.shiftrightunsigned(F.xxhash64(*order), 64 - bits))
    sums = store(numbered.groupBy("length", "_bucket").agg(F.count("*").alias("_n")), "pack-counts")
    counts = {r[0]: r[1] for r in sums.groupBy("length").agg(F.sum("_n")).collect()}  # at most ``capacity`` rows
    places = _places(plan(counts, capacity, steps))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = Window.partitionBy("length", "_bucket").orderBy(*order)
    ranked = numbered.join(sums, ["length", "_bucket"]) \
        .withColumn("_rank", F.col("_before") + F.row_number().over(rank) - 1).drop("_before", "_bucket")
    ranked = ranked.select(*items.columns, "_rank")
    at_length, at_rank = items.columns.index("length"), len(items.columns)
    names = [*items.columns, "sequence_id", "offset"]
    step = int(places[:, 1].max(initial=0)) + rows + 1
    keys = places[:, 0] * step + places[:, 1]

    def deal(batches):
        for b in batches:
            length, rank = (b.column(k).to_numpy(zero_copy_only=False) for k in (at_length, at_rank))
            row = np.searchsorted(keys, length * step + rank, side="right") - 1
            _, first, each, base, at = places[row].T
            bins, nth = np.divmod(rank - first, each)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(at_rank)), pa.array(base + bins), pa.array(at + nth * length)], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return ranked.mapInArrow(deal, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                   capacity: int = 4096, steps: int | None = SEARCH_NODES) -> DataFrame:
    """(id, tie, piece, start, length, crc32, sequence_id, offset): where each piece of each document goes."""
    cut = store(pieces(docs, tokenizer, id_col, text_col, end_id, capacity), "pieces")
    return pack(cut, ["id", "tie", "piece"], capacity, steps)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """(sequence_id, ids): the sequences themselves, as little-endian bytes.  A row that repeats
    another's id and text has the same ids, so one copy of them serves every place."""
    cut = pieces(docs, tokenizer, id_col, text_col, end_id, capacity, with_ids=True) \
        .select(F.coalesce("id", F.lit(0)).alias("_id"), F.col("id").isNull().alias("_null"), "tie", "piece", "ids") \
        .dropDuplicates(["_id", "_null", "tie", "piece"])
    places = packed.select(F.coalesce("id", F.lit(0)).alias("_id"), F.col("id").isNull().alias("_null"), "tie", "piece",
                           "sequence_id", "offset")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return places.join(cut, ["_id", "_null", "tie", "piece"]).groupBy("sequence_id").agg(parts.alias("parts")) \
        .select("sequence_id", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"))
