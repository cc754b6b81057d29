import math
import zlib
from collections import Counter

import numpy as np
import pytest

from recordlog.llm import language_model as lm

from .cases import SCHEMA, documents, frame


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def brute(rows):
    """Counts and base scores, word by word."""
    split = [(i, [*(t or "").encode().translate(lm.LOWER).split(), b"\n"]) for i, t, *_ in rows]
    c = Counter(w for i, ws in split if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return c, sorted((str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n,
                      round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws in split)


def rows_of(df):
    assert df.columns == ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return sorted((str(r[0]), *r[1:5], round(r[5], 6)) for r in df.collect())


@pytest.mark.parametrize("frequent", [131_072, 40])
def test_counts_and_base_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "HELD", 50)
    rows = documents() + [(9_000 + k, "The same words THE end É é\x0bnew", "en", "s", 1) for k in range(8)]
    assert rows_of(lm.score(frame(spark, rows, extra="row int,word string,times int"))) == brute(rows)[1]


def model_of(texts, words=6, seed=3):
    c = Counter(w for t in texts for w in lm.tokens(t))
    frequent = sorted(c.items(), key=lambda x: (-x[1], x[0]))
    sums = {}
    for w, n in frequent[words:]:
        k, m = sums.get(lm.group_of(w), (0, 0))
        sums[lm.group_of(w)] = k + 1, m + n
    vocab = lm.Vocabulary(frequent, sum(c.values()), len(c), sums)
    model = lm.Model(vocab, seed)
    model.b = model.b + np.random.default_rng(seed).normal(0, 1, len(model.b)).astype(np.float32)
    return c, vocab, model


def test_scores_equal_a_plain_evaluation_and_are_normalised(monkeypatch):
    monkeypatch.setattr(lm, "WORDS", 6)
    monkeypatch.setattr(lm, "CONTEXTS", 10)
    texts = [t.encode() for _, t, *_ in documents() if t][:20]
    c, vocab, model = model_of(texts)
    numbers = lm.Numbers(vocab.frequent)
    model.r, model.q = model.r * 8, model.q * 8
    model.factors()

    def plain(ws):
        ctx, total = [vocab.begin, vocab.begin], 0.0
        for w in ws:
            i = numbers[w]
            h = model.r[ctx[-1]] * model.c[0] + model.r[ctx[-2]] * model.c[1]
            s = (h @ model.q.T + model.b).astype(np.float64)
            total += s[vocab.class_of[i]] - np.log(np.exp(s).sum()) + vocab.share_of[i] * np.log(10)
            ctx.append(vocab.row_of[i])
        return total

    every, one, two, size, words = next(lm._contexts(texts, vocab, numbers))
    got = model.log_probabilities(one, two, vocab.class_of[every]) + vocab.share_of[every] * np.log(10)
    got = np.add.reduceat(got, np.cumsum(size) - size)
    assert np.allclose(got, [plain(ws) for ws in words], rtol=1e-4)
    # all classes after a context sum to one, and so do the tokens of a class with one unseen token
    k = len(vocab.mass)
    p = np.exp(model.log_probabilities(np.full(k, one[5]), np.full(k, two[5]), np.arange(k)))
    assert abs(p.sum() - 1) < 1e-4
    for g in range(lm.GROUPS):
        own = [10 ** vocab.share_of[numbers[w]] for w in c if vocab.class_of[numbers[w]] == 6 + g]
        assert abs(sum(own) + 0.5 / vocab.mass[6 + g] - 1) < 1e-9


def test_gradients_against_differences(monkeypatch):
    monkeypatch.setattr(lm, "WORDS", 6)
    texts = [t.encode() for _, t, *_ in documents() if t][:5]
    _, vocab, model = model_of(texts)
    every, one, two, *_ = next(lm._contexts(texts, vocab, lm.Numbers(vocab.frequent)))
    one, two, target, drawn = one[:40], two[:40], vocab.class_of[every][:40], np.array([0, 3, 5, 5, 9])
    model.r, model.c, model.q, model.b = (p.astype(np.float64) for p in model.parameters())
    g1, g2, gc, gq, gb = model.gradients(one, two, target, drawn)
    gr = lm._added(np.concatenate([one, two]), np.concatenate([g1, g2]), len(model.r))
    r = np.random.default_rng(0)
    for value, g in zip(model.parameters(), (gr, gc, gq, gb)):
        some = np.argsort(-np.abs(g).ravel())[:20]
        for at in r.choice(some, 6, replace=False):
            spot = np.unravel_index(at, value.shape)
            keep = value[spot]
            value[spot] = keep + 1e-4
            up = model.loss(one, two, target, drawn)
            value[spot] = keep - 1e-4
            down = model.loss(one, two, target, drawn)
            value[spot] = keep
            assert abs((up - down) / 2e-4 - g[spot]) < 1e-4 + 0.02 * abs(g[spot])


def test_learns_what_follows(spark):
    r = np.random.default_rng(1)
    rows = [(k, " ".join("red blue green".split()[int(i) % 3] + " ball" if k % 2 else "one two three"
                         for i in r.integers(0, 3, 40)), "en", "s", 1) for k in range(600)]
    got = lm.score(frame(spark, rows)).filter("held_out").selectExpr("sum(base_score) b", "sum(score) s").first()
    assert got["s"] > 0.8 * got["b"]
    again = lm.score(frame(spark, rows)).filter("held_out").selectExpr("sum(score) s").first()
    assert abs(again["s"] - got["s"]) < 1e-3 * abs(got["s"])


def test_empty_tables_and_nothing_to_learn_from(spark):
    assert lm.score(spark.createDataFrame([], SCHEMA)).count() == 0
    only = [i for i in range(60) if held(i)]
    got = lm.score(spark.createDataFrame([(i, "some words", "en", "s", 1) for i in only], SCHEMA)).collect()
    assert len(got) == len(only) and all(x["n_known"] == 0 and x["train_tokens"] == 0 and np.isfinite(x["score"]) for x in got)
    assert all(abs(x["base_score"]) < 1e-9 for x in got)  # V and N are zero: (0.5 / 0.5) for each token
