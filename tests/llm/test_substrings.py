import pytest

from recordlog.llm import substrings

from .cases import documents, frame, words


def brute(rows, window):
    """(id, text) -> (kept words, removed) with rows equal in id and text as one document."""
    import xxhash
    tie = {}
    for i, t, *_ in rows:
        tie[i, t] = xxhash.xxh64_intdigest((t or "").encode(), 42) if t is not None else 42
    order = sorted(tie, key=lambda k: (k[0] is None, k[0] or 0, tie[k] & (1 << 24) - 1))
    seen, out = set(), {}
    for i, t in order:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if key in seen:
                gone[s:s + window] = [True] * window
            seen.add(key)
        out[i, t] = (b" ".join(x for x, g in zip(w, gone) if not g).decode(), sum(gone), len(w))
    return out


@pytest.mark.parametrize("window", [20, 7, 1])
def test_equals_brute_force(spark, window):
    rows = documents()
    rows += [(i, "a b " * 40 + "end", "en", "s", 1) for i in range(20_000, 20_020)]
    rows += [(30_000, "the same words " * 300, "en", "s", 1)]
    got = substrings.dedup(frame(spark, rows, extra="key int,kept string"), window=window).collect()
    want = brute(rows, window)
    assert sorted((str(r["id"]), r["kept"], r["n_removed"], r["n_words"]) for r in got) \
        == sorted((str(i), *want[i, t]) for i, t, *_ in rows)
    for r in got:
        assert sum(r["factor_lengths"]) == r["n_removed"] and len(r["factor_starts"]) == len(r["factor_lengths"])


def test_partitioning_changes_nothing(spark):
    df = frame(spark)
    one = sorted(map(str, substrings.dedup(df.coalesce(1)).collect()))
    assert one == sorted(map(str, substrings.dedup(df.repartition(13)).collect()))


def test_empty_table(spark):
    assert substrings.dedup(frame(spark, [])).count() == 0
