import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from recordlog.llm import lines

from .cases import documents, frame, words


def brute(rows, size=5, threshold=0.8):
    tie = {(i, t): xxhash.xxh64_intdigest((t or "").encode(), 42) if t is not None else 42 for i, t, *_ in rows}
    order = sorted(tie, key=lambda k: (k[0] is None, k[0] or 0, tie[k] & (1 << 24) - 1))
    seen, gone = [], defaultdict(list)
    for i, t in order:
        for n, line in enumerate((t or "").split("\n")):
            w = words(line)
            s = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
            if s:
                if any(len(s & x) >= threshold * len(s | x) - 1e-9 for x in seen):
                    gone[i, t].append(n)
                seen.append(s)
    return gone


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_equals_brute_force(spark, threshold):
    rows = documents()
    base = rows[0][1].split("\n")[0] + " and then some more words to make it long enough"
    rows += [(40_000 + k, base.replace("some", f"some{k}") + "\nshort one", "en", "s", 1) for k in range(30)]
    want = brute(rows, threshold=threshold)
    got = lines.judged(frame(spark, rows, extra="removed int,n_lines int"), threshold=threshold).collect()
    assert sorted((str(r["id"]), r["n_lines"], str(list(r["removed"]))) for r in got) \
        == sorted((str(i), len(t.split("\n")) if t else 0, str(want.get((i, t), []))) for i, t, *_ in rows)


def test_dedup_cuts_the_lines_out(spark):
    rows = documents()
    want = brute(rows)
    docs = frame(spark, rows, extra="_id int,_removed string")
    got = lines.dedup(docs)
    assert got.columns == docs.columns

    def left(i, t):
        return t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want.get((i, t), []))
    assert sorted(str((r["doc_id"], r["text"])) for r in got.collect()) == sorted(str((i, left(i, t))) for i, t, *_ in rows)


def test_empty_table(spark):
    assert lines.judged(frame(spark, [])).count() == 0
    assert lines.dedup(frame(spark, [])).count() == 0


def brute_short(rows, size=5, threshold=0.8):
    """``brute`` with the exact repeats among lines of one to four words."""
    gone = {k: set(v) for k, v in brute(rows, size, threshold).items()}
    tie = {(i, t): xxhash.xxh64_intdigest((t or "").encode(), 42) if t is not None else 42 for i, t, *_ in rows}
    seen = set()
    for i, t in sorted(tie, key=lambda k: (k[0] is None, k[0] or 0, tie[k] & (1 << 24) - 1)):
        for n, line in enumerate((t or "").split("\n")):
            w = tuple(words(line))
            if 0 < len(w) < size:
                if w in seen:
                    gone.setdefault((i, t), set()).add(n)
                seen.add(w)
    return {k: sorted(v) for k, v in gone.items()}


def test_short_lines_lose_their_repeats(spark):
    rows = documents()
    rows += [(50_000 + k, f"Read more\n \nread more\n Read  more\nmore Read\nunique{k}\none two three four\none two three four five\n\n", "en", "s", 1)
             for k in range(30)]
    want = brute_short(rows)
    got = lines.judged(frame(spark, rows), short=True).collect()
    assert sorted((str(r["id"]), str(list(r["removed"]))) for r in got) == sorted((str(i), str(want.get((i, t), []))) for i, t, *_ in rows)

    def left(i, t):
        return t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want.get((i, t), []))
    assert sorted(str((r["doc_id"], r["text"])) for r in lines.dedup(frame(spark, rows), short=True).collect()) \
        == sorted(str((i, left(i, t))) for i, t, *_ in rows)


def test_memory_of_a_scan_does_not_grow_with_its_texts():
    """A worker hashes a bounded number of bytes at once; the texts here are 7 MB, in lines that repeat."""
    text = "\n".join(" ".join(f"w{(k * 7 + j) % 50}" for j in range(9)) for k in range(100))
    one = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(np.zeros(200, dtype=np.int64)), pa.array([text] * 200)], ["id", "key", "text"])
    tracemalloc.start()
    try:
        found = sum(len(s[2]) for s in lines._shingles([one] * 12, 5, True))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == 12 * 200 * 100
    assert len(text) * 2400 > 6 << 20 and peak < 24 << 20
