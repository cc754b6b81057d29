import math
import random

import numpy as np

from recordlog.llm import embeddings

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(seed=2, dim=24):
    r = np.random.default_rng(seed)
    rows = [r.normal(size=dim) for _ in range(150)]
    for noise in (0.01, 0.15, 0.25, 0.32):  # from near copies to pairs about the threshold
        rows += [rows[k] + noise * r.normal(size=dim) for k in range(60)]
    rows += [rows[3] + 0.02 * r.normal(size=dim) for _ in range(80)]  # a dense group
    rows += [rows[5]] * 30  # copies
    out = [(i, np.float32(v).astype(float).tolist(), 0) for i, v in enumerate(rows)]
    out += [(9000, None, 1), (9001, [], 1), (9002, [0.0] * dim, 1), (9003, [float("nan")] * dim, 1), (9004, [1.0, None], 1),
            (9005, [float("inf")] * dim, 1), (9006, out[0][1][:5], 1), (9007, out[0][1][:5], 1), (9008, out[0][1][:1], 0)]
    return out


def brute(rows, threshold=0.95):
    good = [(i, np.float32(v).astype(float)) for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, root = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for k, (i, a) in enumerate(good):
        for j, b in good[:k]:
            if len(a) == len(b) and a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (links[i], find(i)) for i, *_ in rows}


def test_links_and_components(spark):
    rows = vectors()
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), SCHEMA).selectExpr("*", "1 AS code", "2 AS class").repartition(3)
    got = {r["id"]: (r["n_links"], r["component"]) for r in embeddings.links(df).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)  # never a link below the threshold
    recall = sum(n for n, _ in got.values()) / sum(n for n, _ in want.values())
    assert recall >= 0.98
    assert np.mean([got[i][1] == want[i][1] for i in want]) > 0.98


def test_null_ids_and_repeated_rows(spark):
    v, w = [1.0, 2.0, 3.0], [-1.0, 0.5, 0.0]
    rows = [(None, v, 0), (4, v, 0), (4, v, 0), (None, w, 0), (None, w, 0), (None, None, 0)]
    got = sorted(map(str, ((r["id"], r["n_links"], r["component"]) for r in embeddings.links(spark.createDataFrame(rows, SCHEMA)).collect())))
    assert got == sorted(map(str, [(None, 2, 4), (4, 2, 4), (4, 2, 4), (None, 1, None), (None, 1, None), (None, 0, None)]))


def test_doubles_are_compared_as_they_are(spark):
    a, b = 1.0, 1.0 + 2.0 ** -40  # one number in single precision
    edge = math.sqrt(1 / 0.95 ** 2 - 1)
    rows = [(1, [a, 0.0], 0), (2, [b, 0.0], 0), (3, [1e200, 1e200], 0), (4, [2e-200, 2e-200], 0), (5, [0.0, -3.0], 0),
            (6, [-1.0, edge * (1 - 1e-12)], 0), (7, [-1.0, 0.0], 0), (8, [-1.0, -edge * (1 + 1e-12)], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {r["id"]: (r["n_links"], r["component"]) for r in embeddings.links(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (1, 6), 7: (1, 6), 8: (0, 8)}


def test_empty_table(spark):
    assert embeddings.links(spark.createDataFrame([], SCHEMA)).count() == 0
