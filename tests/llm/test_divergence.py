import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recordlog.llm import divergence

from .cases import SCHEMA, documents, frame

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=3, top=200):
    rows = [(t or "", la or "", s or "") for _, t, la, s, *_ in rows]
    terms = [TERM.findall(t.translate(LOWER)) for t, *_ in rows]
    seen, counts, groups = defaultdict(Counter), defaultdict(Counter), {(la, s) for _, la, s in rows}
    for (_, la, s), ts in zip(rows, terms):
        seen[la].update(set(ts))
        counts[la, s].update(ts)
        counts[la, None].update(ts)
    kept = {la: [t for t, n in c.items() if n >= min_docs] for la, c in seen.items()}
    out = []

    def share(g):
        total = sum(counts[g][t] for t in kept[g[0]])
        return {t: 1 + 10**9 * (counts[g][t] + 1) // (total + len(kept[g[0]])) for t in kept[g[0]]}

    shares = {g: share(g) for g in [*groups, *((la, None) for la in kept)]}
    for la, s in groups:
        p = shares[la, s]
        pairs = [(sum((p[t] - q) ** 2 // q for t, q in shares[la, o].items()), o) for l2, o in groups if l2 == la and o != s]
        found = [((p[t] - q) ** 2 // q, t) for t, q in shares[la, None].items() if counts[la, s][t] and p[t] > q]
        for part, items in (("pair", pairs), ("term", found)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(la, s, part, item, value, k + 1) for k, (value, item) in enumerate(items[:top if part == "term" else None])]
    return sorted(out)


def table():
    rows = documents()
    more = ["Ärger ärger ÀB über-all", "über über MIT ohne", "z\u0001z z{y}", "aa ab aaa ab", "über aa\x00ab"]
    rows += [(500 + k, f"{more[k % 5]} {more[k % 3]}", [None, "de", "x\0y", "en"][k % 4], ["a", "b", None, "c c", "a\0"][k % 5], 1) for k in range(60)]
    rows += [(700, "12 34", "empty", "only", 1), (701, None, "empty", "other", 1)]
    return rows


@pytest.mark.parametrize("shard_terms,top", [(8192, 200), (5, 3)])
def test_equals_brute_force(spark, shard_terms, top):
    rows = table()
    got = divergence.audit(frame(spark, rows, extra="entry int,place string"), top=top, shard_terms=shard_terms)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, top=top)


def test_sums_leave_a_task_early(spark, monkeypatch):
    rows = table()
    monkeypatch.setattr(divergence, "HELD", 20)
    assert sorted(tuple(r) for r in divergence.audit(frame(spark, rows)).collect()) == brute(rows)


def test_empty_tables(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, None, None, None), (2, "rare", "en", "s", 1), (3, "words", "en", "t", 1)]
    assert sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect()) == brute(rows) \
        == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(max_size=6), max_size=40), st.lists(st.binary(max_size=6), max_size=20))
def test_transducer_is_minimal_and_numbers_words(words, others):
    built = divergence.Transducer()
    words = sorted(words - {b""})
    for w in words:
        built.add(w)
    built.finish()
    every = words + others
    assert built.ordinals(every).tolist() == [words.index(w) if w in words else -1 for w in every]
    # as many states as there are different sets of continuations
    rests = {frozenset(w[len(p):] for w in words if w.startswith(p)) for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert len(built.final) == max(1, len(rests))


def test_shares_beyond_64_bits():
    counts = np.array([[10**13, 0, 7]])
    total = np.array([[10**14]])
    assert divergence._share(counts, total, 3).tolist() == [[1 + 10**9 * (c + 1) // (10**14 + 3) for c in (10**13, 0, 7)]]


def test_sums_of_many_terms_share_a_row(spark, monkeypatch):
    """What the texts hold is shuffled and sorted as rows of many terms, not as a row a term."""
    docs = spark.createDataFrame([("en", "s", " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)))] * 3, "lang string, source string, text string").coalesce(1)
    vocab = divergence.vocabulary(docs)
    assert vocab.count() == 400
    seen = spark.sparkContext.accumulator(0)

    def stream(batches):
        for b in batches:
            seen.add(int((b.column(1).to_numpy() == 1).sum()))
        yield from ()
    monkeypatch.setattr(divergence, "_stream", stream)
    divergence.recount(docs, vocab, []).collect()
    assert seen.value == 1


def test_words_of_rows():
    words, which = divergence._words([b"a\0bc\0", b"", b"bc\0\xc3\xa9\0a\0"])
    assert [words[k] for k in which] == [b"a", b"bc", b"bc", "é".encode(), b"a"]


@pytest.mark.parametrize("row_terms,summed", [(1, 0), (3, 10)])
def test_small_rows_and_early_sums(spark, monkeypatch, row_terms, summed):
    rows = table()
    monkeypatch.setattr(divergence, "ROW_TERMS", row_terms)
    monkeypatch.setattr(divergence, "SUMMED", summed)
    assert sorted(tuple(r) for r in divergence.audit(frame(spark, rows), shard_terms=5).collect()) == brute(rows)
