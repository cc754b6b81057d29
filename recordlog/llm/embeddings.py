"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact rerank.

A rotation learned from a bounded sample (``fit_rows`` vectors with the smallest hash) turns
vectors into balanced binary codes; all vectors are then coded and indexed.  Codes are cut
into segments of 16 bits; a table of each segment is asked for every code within one bit of
it, hits within ``reach`` bits in all go on to the rerank with the original vectors in double
precision, so no pair below the threshold is linked.

Copies and dense groups are not compared pair by pair.  Equal vectors are one representative
with a number.  Representatives with one code gather around a leader: those within half the
threshold's angle of it are linked to each other by the triangle inequality and form a class
(a few rounds of leaders; what is left stands alone).  Between two classes the leaders' angle
and the classes' radii decide at once whether all or no members are linked; only where they
leave it open are members compared.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers link
with nothing; vectors of different lengths do not link; a null id stands for itself (component
null unless its vector links with one that has an id); repeated rows are rows like others and
count as links of each other; an empty table gives no rows.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlog.llm.common import bounded_sample, store
from recordlog.llm.components import components

SEGMENT = 16
NO_ID = (1 << 63) - 1
#: Room for rounding in sums of angles.
SLACK = 1e-6


class Rotation:
    """Codes of unit vectors: principal directions of the sample, turned so that signs lose little."""

    def __init__(self, sample: np.ndarray, bits: int = 64, rounds: int = 40, seed: int = 3):
        self.dim = sample.shape[1] if sample.ndim == 2 and len(sample) else 1
        sample = sample.reshape(-1, self.dim)
        self.mean = sample.mean(axis=0) if len(sample) else np.zeros(self.dim)
        bits = min(bits, self.dim)
        _, _, directions = np.linalg.svd(np.vstack([sample - self.mean, np.zeros((self.dim, self.dim))]), full_matrices=False)
        w = directions[:bits].T
        p = (sample - self.mean) @ w
        turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
        for _ in range(rounds if len(sample) else 0):
            u, _, vt = np.linalg.svd(np.where(p @ turn >= 0, 1.0, -1.0).T @ p)
            turn = (u @ vt).T
        self.matrix = w @ turn

    def codes(self, unit: np.ndarray) -> np.ndarray:
        bits = ((unit - self.mean) @ self.matrix >= 0).astype(np.uint8)
        return np.packbits(np.pad(bits, ((0, 0), (0, 64 - bits.shape[1]))), axis=1, bitorder="little").view("<i8").ravel()


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision; where squares could leave its range, each is divided by a power of two, which is exact."""
    largest = np.abs(rows).max(axis=1, initial=0.0)
    if ((largest > 1e-100) & (largest < 1e100)).all():
        return rows
    return np.ldexp(rows, -np.frexp(largest)[1][:, None])


def _cosines(a: list, b: list, step: int = 1000) -> np.ndarray:
    """Cosine of each pair; the two vectors of a pair have one length."""
    out, sizes = np.empty(len(a)), np.array([len(x) for x in a], dtype=np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for k in range(0, len(at), step):
            some = at[k:k + step]
            x = _scaled(np.array([a[i] for i in some], dtype=np.float64))
            y = _scaled(np.array([b[i] for i in some], dtype=np.float64))
            out[some] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
    return out


def _bits(a: Column, b: Column, mask: int = -1) -> Column:
    return F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit(mask)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _type(reps: DataFrame) -> str:
    return dict(reps.dtypes)["vec"]


def _coded(reps: DataFrame, fit_rows: int) -> DataFrame:
    """``reps`` with the code of each vector."""
    dim = reps.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    sample = [] if dim is None else bounded_sample(reps.filter(F.size("vec") == dim[0]), fit_rows, "rep").select("vec").collect()
    sample = _scaled(np.array([r[0] for r in sample], dtype=np.float64)) if sample else np.zeros((0, 1))
    rotation = Rotation(sample / np.linalg.norm(sample, axis=1, keepdims=True))

    def code(batches):
        for b in batches:
            vectors = b.column(2).to_pylist()
            x = np.zeros((len(vectors), rotation.dim))
            for row, v in zip(x, vectors):  # another length is cut or filled up: only a code, never a cosine
                v = _scaled(np.asarray(v, dtype=np.float64)[None, :])[0, :rotation.dim]
                row[:len(v)] = v
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rotation.codes(x), pa.int64())], ["rep", "n", "vec", "code"])

    return reps.select("rep", "n", "vec").mapInArrow(code, f"rep bigint, n bigint, vec {_type(reps)}, code bigint")


def _classes(reps: DataFrame, angle: float, rounds: int) -> DataFrame:
    """(rep, n, vec, code, class, off): class is the rep of the leader, off the angle to it."""
    limit = angle / 2 - SLACK
    done, rest = None, reps
    for k in range(rounds):
        leaders = rest.groupBy("code", F.size("vec").alias("d")).agg(F.min("rep").alias("class"), F.min_by("vec", "rep").alias("lead"))
        leaders = store(leaders, "vector-leads")  # a table of its own, so that the join below may split a hot code
        led = rest.withColumn("d", F.size("vec")).join(leaders, ["code", "d"]).select("rep", "n", "vec", "code", "class", "lead")

        def measure(batches):
            for b in batches:
                off = np.arccos(np.clip(_cosines(b.column(2).to_pylist(), b.column(5).to_pylist()), -1, 1))
                off[b.column(0).to_numpy() == b.column(4).to_numpy()] = 0.0
                yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(off)], ["rep", "n", "vec", "code", "class", "off"])

        led = store(led.mapInArrow(measure, f"rep bigint, n bigint, vec {_type(reps)}, code bigint, class bigint, off double"), "vector-classes")
        near = led.filter(F.col("off") <= limit)
        done = near if done is None else done.union(near)
        rest = led.filter(F.col("off") > limit).select("rep", "n", "vec", "code")
    return done.union(rest.select("rep", "n", "vec", "code", F.col("rep").alias("class"), F.lit(0.0).alias("off")))


def _candidates(classes: DataFrame, reach: int) -> DataFrame:
    """(a, b): pairs of classes, a < b, whose codes agree in a segment but for one bit and in all but for
    ``reach`` bits.  A pair is found in its first such segment only."""
    masks = [_signed(((1 << SEGMENT) - 1) << at) for at in range(0, 64, SEGMENT)]
    table = classes.select(F.col("class").alias("b"), F.col("code").alias("code_b"), F.posexplode(F.array(
        *[F.col("code").bitwiseAND(F.lit(m)) for m in masks])).alias("segment", "value"))
    balls = F.array(*[F.array(*[F.col("code").bitwiseAND(F.lit(m)).bitwiseXOR(F.lit(f)) for f in
                                [0, *[_signed(1 << i) for i in range(at, at + SEGMENT)]]]) for at, m in zip(range(0, 64, SEGMENT), masks)])
    asked = classes.select(F.col("class").alias("a"), F.col("code").alias("code_a"), F.posexplode(balls).alias("segment", "ball")) \
        .select("a", "code_a", "segment", F.explode("ball").alias("value"))
    found = asked.join(table, ["segment", "value"])
    earlier = F.lit(False)
    for k, m in enumerate(masks):
        earlier = earlier | ((F.col("segment") > k) & (_bits(F.col("code_a"), F.col("code_b"), m) <= 1))
    return found.filter((F.col("a") < F.col("b")) & (_bits(F.col("code_a"), F.col("code_b")) <= reach) & ~earlier).select("a", "b")


def links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, fit_rows: int = 10_000,
          reach: int = 20, rounds: int = 3) -> DataFrame:
    """(id, n_links, component) of every row of ``vectors``."""
    v = F.col(vector_col)
    if dict(vectors.dtypes)[vector_col] != "array<float>":  # any other number is read as a double
        v = v.cast("array<double>")
    good = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(good, v).alias("vec"))
    valid = rows.filter("vec is not null")
    equal = valid.groupBy("vec").agg(F.min(F.coalesce("id", F.lit(NO_ID))).alias("rep"), F.count("*").alias("n"))
    # vectors that only null ids carry share NO_ID; a number below every id in use tells them apart
    reps = equal.withColumn("rep", F.when(F.col("rep") == NO_ID, F.xxhash64("vec").bitwiseOR(F.lit(1 << 62)).bitwiseAND(F.lit(NO_ID)))
                            .otherwise(F.col("rep")))
    angle = math.acos(threshold)
    reps = store(_coded(store(reps, "vectors"), fit_rows), "codes")
    members = store(_classes(reps, angle, rounds), "vector-members")
    classes = store(members.groupBy("class").agg(F.sum("n").alias("size"), F.max("off").alias("radius"),
                                                 F.max(F.when(F.col("rep") == F.col("class"), F.struct("code", "vec"))).alias("lead"))
                    .select("class", "size", "radius", "lead.code", "lead.vec"), "vector-leaders")
    pairs = _candidates(classes, reach)
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("class").alias(side), F.col("vec").alias(f"vec_{side}"), F.col("radius").alias(f"radius_{side}"),
                                          F.col("size").alias(f"size_{side}")), side)

    def decide(batches):
        for b in batches:
            x, y = b.column("vec_a").to_pylist(), b.column("vec_b").to_pylist()
            same = np.array([len(p) == len(q) for p, q in zip(x, y)], dtype=bool)
            cos = np.full(len(x), -1.0)
            cos[same] = _cosines([p for p, s in zip(x, same) if s], [q for q, s in zip(y, same) if s])
            radii = b.column("radius_a").to_numpy() + b.column("radius_b").to_numpy()
            off = np.arccos(np.clip(cos, -1, 1))
            every = np.where(radii > 0, off + radii <= angle - SLACK, cos >= threshold)
            some = (radii > 0) & ~every & (off - radii <= angle + SLACK)
            keep = pa.array((every | some) & same)
            part = pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), b.column("size_a"), b.column("size_b"), pa.array(every)],
                                              ["a", "b", "size_a", "size_b", "every"])
            yield part.filter(keep)

    decided = store(pairs.mapInArrow(decide, "a bigint, b bigint, size_a bigint, size_b bigint, every boolean"), "class-pairs")
    every, some = decided.filter("every"), decided.filter("not every").select("a", "b")
    for side in "ab":
        some = some.join(members.select(F.col("class").alias(side), F.col("rep").alias(f"rep_{side}"), F.col("n").alias(f"n_{side}"),
                                        F.col("vec").alias(f"vec_{side}")), side)

    def compare(batches):
        for b in batches:
            linked = _cosines(b.column("vec_a").to_pylist(), b.column("vec_b").to_pylist()) >= threshold
            part = pa.RecordBatch.from_arrays([b.column(c) for c in ("rep_a", "rep_b", "n_a", "n_b")], ["a", "b", "n_a", "n_b"])
            yield part.filter(pa.array(linked))

    single = store(some.mapInArrow(compare, "a bigint, b bigint, n_a bigint, n_b bigint"), "member-pairs")
    of_class = every.select(F.col("a").alias("class"), F.col("size_b").alias("k")).union(every.select("b", "size_a")) \
        .groupBy("class").agg(F.sum("k").alias("linked"))
    of_rep = single.select(F.col("a").alias("rep"), F.col("n_b").alias("k")).union(single.select("b", "n_a")) \
        .groupBy("rep").agg(F.sum("k").alias("more"))
    named = components(members.filter("rep != class").select("rep", "class").union(every.select("a", "b")).union(single.select("a", "b")))
    found = members.select("rep", "class", "vec").join(classes.select("class", "size"), "class").join(of_class, "class", "left") \
        .join(of_rep, "rep", "left").join(named.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("vec", (F.col("size") - 1 + F.coalesce("linked", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_links"),
                F.coalesce("component", "rep").alias("component"))
    # the names of vectors without an id end here: a component is an id in use or null
    used = valid.select(F.col("id").alias("component")).filter("id is not null").distinct().withColumn("used", F.lit(True))
    found = found.join(used, "component", "left").select("vec", "n_links", F.when(F.col("used"), F.col("component")).alias("component"))
    return valid.join(found, "vec").select("id", "n_links", "component") \
        .union(rows.filter("vec is null").select("id", F.lit(0).cast("long"), "id"))
