import random
import zlib

import numpy as np
import pytest

from recordlog.llm import quality, toxicity

from .cases import SCHEMA, documents, frame, sentence

BAD = ["grobnik", "snarfel", "vuxxon"]


def corpus(n=500):
    """Texts with labels: junk in capitals, and texts with bent forms of a few words."""
    r = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        text, good, toxic = sentence(r, r.randint(20, 120)), i % 5 != 0, i % 4 == 0
        if toxic:
            words = text.split()
            for _ in range(4):
                words[r.randrange(len(words))] = r.choice(BAD) + r.choice(["", "s", "ing", "ed"])
            text = " ".join(words)
        if not good:
            text = "!! ".join(text.upper().split())
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


@pytest.mark.parametrize("name", ["quality", "toxicity"])
def test_held_out_accuracy_and_edge_rows(spark, name):
    rows, labels = corpus()
    odd = [r for r in documents() if not r[1] or r[0] is None or r[0] > 10_000]
    odd = [(None if r[0] is None else r[0] + 100_000, *r[1:]) for r in odd]
    docs = frame(spark, rows + odd + rows[:2], extra="score double,x int,_score int")
    known = spark.createDataFrame([(i, q if name == "quality" else t) for i, q, t in labels] + [(None, 1), (7, None), (999_999, 0)],
                                  "id bigint, label int")
    if name == "quality":
        got, mod, rest, cut = quality.classify(docs, known, fit_rows=400).collect(), 4, 2, 0.7
    else:
        got, mod, rest, cut = toxicity.classify(docs, known).collect(), 5, 0, 0.5
    assert len(got) == len(rows) + len(odd) + 2
    truth = {i: (q if name == "quality" else t) for i, q, t in labels}
    tested = 0
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
        if r["id"] is None:
            assert r["held_out"] is False
            continue
        assert r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % mod == rest)
    hits = [r["predicted"] == truth[r["id"]] for r in got if r["held_out"] and r["id"] in truth]
    assert len(hits) > 60 and np.mean(hits) > 0.93
    again = {(r["id"], round(r["score"], 12)) for r in got}
    assert len({i for i, _ in again if i in truth}) == sum(i in truth for i, _ in again)  # repeated rows score alike


def test_labels_held_out_change_nothing(spark):
    rows, labels = corpus(120)
    docs = frame(spark, rows)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q, _ in labels]
    a, b = (sorted((r["id"], r["score"]) for r in quality.classify(docs, spark.createDataFrame(x, "id bigint, label int")).collect())
            for x in ([(i, q) for i, q, _ in labels], turned))
    assert a == b


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_labels_and_empty_table(spark, module):
    none = spark.createDataFrame([], "id bigint, label int")
    assert {r["score"] for r in module.classify(frame(spark), none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(0, 60)], "id bigint, label int")
    assert all(r["score"] > 0.9 for r in module.classify(frame(spark), one).collect())
    assert module.classify(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_accepted_keeps_rows_as_given(spark):
    rows, labels = corpus(300)
    docs = frame(spark, rows, extra="score int,_row int")
    known = spark.createDataFrame([(i, q) for i, q, _ in labels], "id bigint, label int")
    kept = quality.accepted(docs, known)
    assert kept.columns == docs.columns
    wanted = {r["id"] for r in quality.classify(docs, known).collect() if r["predicted"]}
    assert {r["doc_id"] for r in kept.collect()} == wanted


def test_slopes_of_the_network():
    n = toxicity.Network([b"aa", b"bb", b"cc"])
    n.p = {k: v.astype(np.float64) for k, v in n.p.items()}
    words = [b"", b"aa", b"bb", b"zz"]
    windows = np.array([[1, 2, 3, 1], [2, 3, 0, 0]])

    def value():
        v, _ = n.vectors(words)
        table = np.concatenate([v @ n.p["wxf"] + n.p["bf"], v @ n.p["wxb"] + n.p["bb"]], axis=1)
        return v, table
    v, table = value()
    keep = []
    n.run(table, windows, keep)
    g, _ = n.slopes(windows, v, keep, np.array([1.0, -2.0]))
    for name in ("whf", "wxb", "att", "out", "bf"):
        at = tuple(0 for _ in n.p[name].shape)
        before = n.p[name][at]
        out = []
        for step in (1e-2, -1e-2):
            n.p[name][at] = before + step
            out.append(n.run(value()[1], windows) @ np.array([1.0, -2.0]))
        n.p[name][at] = before
        assert g[name][at] == pytest.approx((out[0] - out[1]) / 2e-2, rel=0.05, abs=1e-3)


def test_reader_covers_every_word():
    n = toxicity.Network([])
    n.run = lambda table, windows, keep=None: np.array([float(len(set(w.tolist()) - {0})) for w in windows])
    reader = toxicity.Reader(n, most=40)
    for size in (0, 1, 31, 32, 33, 56, 57, 500):
        text = b" ".join(b"w%d" % k for k in range(size))
        top, _ = reader.read([text])
        assert top[0] == min(size, toxicity.WINDOW)
    seen = []
    n.run = lambda table, windows, keep=None: seen.append(windows) or np.zeros(len(windows))
    reader.read([b" ".join(b"v%d" % k for k in range(333))])
    assert len(set(np.concatenate(seen).ravel().tolist())) == 333
