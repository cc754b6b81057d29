import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from recordlog.llm import trie

TURNS = "conv_id bigint, turn bigint, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """Turns (role, text) of each conversation, in order."""
    found = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            found[c].append((t is not None, t or 0, role, digest, text))
    return {c: [(x[2], x[4]) for x in sorted(v)] for c, v in found.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    value = {p: (len(m) - 1) * len(p[-1][1].encode().split()) if p else 0 for p, m in members.items()}
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) if children[p] else 1
        saved[p] = value[p] + sum(saved[c] for c in children[p])
    ends = {p: ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p))) for p, m in members.items()}
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in members.items())


def rows_of(df):
    assert df.columns == NAMES
    return sorted(tuple(r) for r in df.collect())


def conversations(seed, n):
    r = random.Random(seed)
    texts = ["hello there", "one two  three", "", None, "why\tnot", "x" * 3000, "é ü"]
    rows = []
    for c in range(n):
        if c % 13 == 5:
            continue  # absent bases too
        turns = [(c, t, r.choice(["user", "assistant", None]), r.choice(texts[:2 + c % 6])) for t in range(r.randint(1, 6))]
        rows += turns
    first = [("user", "the common first turn"), ("assistant", "and its answer")]
    rows += [(10_000 + c, t, *first[t]) for c in range(n // 2) for t in range(2)]           # exact copies
    rows += [(20_000 + c, t, *(first + [("user", f"own {c}")])[t]) for c in range(n // 2) for t in range(3)]
    rows += [(7, None, "user", "no turn number"), (7, 3, "user", "tied"), (7, 3, "user", "tied"), (7, 3, "user", "also tied"),
             (None, 1, "user", "no conversation"), (-5, 0, "user", "negative"), (-40, 2, None, None)]
    rows += [(30_001, t, "user", "long") for t in range(2000)] + [(30_002, t, "user", "long") for t in range(1990)]
    return rows


@pytest.mark.parametrize("block_rows", [8, 50, 8192])
def test_equals_brute_force(spark, block_rows):
    rows = conversations(3, 120)
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS key", "2 AS turns", "3 AS depth", "'x' AS block").repartition(4)
    got = trie.trie(trie.rebuilt(trie.sequences(df)), block_rows=block_rows)
    assert rows_of(got) == brute(rebuild(ordered(rows)))


def test_without_rebuilding(spark):
    rows = conversations(5, 40)
    got = trie.trie(trie.sequences(spark.createDataFrame(rows, TURNS)), block_rows=10)
    assert rows_of(got) == brute(ordered(rows))


def test_empty_and_turnless(spark):
    empty = spark.createDataFrame([], TURNS)
    assert trie.trie(trie.rebuilt(trie.sequences(empty))).count() == 0
    # conversations whose own turns are all replaced by those of an absent base
    ids = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 >= 1]
    rows = [(c, 0, "user", "gone") for c in ids]
    got = rows_of(trie.trie(trie.rebuilt(trie.sequences(spark.createDataFrame(rows, TURNS)))))
    assert got == brute(rebuild(ordered(rows))) and len(got) == 1 and got[0][3] == len(ids)


def test_range_minimum_against_loops():
    r = np.random.default_rng(1)
    values = r.integers(0, 6, 97)
    table = trie.RangeMinimum(values)
    for row in range(97):
        for least in range(7):
            right = row
            while right + 1 < 97 and values[right + 1] >= least:
                right += 1
            left = row
            while left > 0 and values[left] >= least:
                left -= 1
            at, low = np.array([row]), np.array([least])
            assert table.rightmost(at, low)[0] == right and table.leftmost(at, low)[0] == left
            assert table.least(np.array([left]), np.array([right]))[0] == values[left:right + 1].min()
