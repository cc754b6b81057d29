"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a few numbers (shares of character classes, repeated words and lines,
lengths).  Each number is cut into bins by quantiles of the fitted rows; boosting goes round
the features in a cycle and adds one shallow tree on one feature at a time to that feature's
lookup table, then does the same on the pairs whose residuals show the strongest interaction.
A score adds up table entries: one bin look-up a feature and a pair, vectorised over a batch.

The model is fitted on the driver from a bounded sample of labelled rows (``fit_rows``, those
with the smallest hash of the id); what is sent there are feature rows, never texts.  Every
text is read and scored whole, inside the scan of the documents.

Defined results: null and empty texts have all features zero and a score like any other;
labels that are null, of unknown documents or repeated are left out or count as often as they
stand; without labels of both classes every score is the share of label 1 (0.5 without any);
a null id is never held out; an empty table gives no rows; input columns named like a result
column are replaced.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlog.llm.common import bounded_sample, from_rows, store, utf8, whole_rows

FEATURES = ("words", "word_length", "upper", "digits", "punctuation", "exclamation", "symbols", "distinct_words",
            "distinct_lines", "line_words", "non_ascii", "stops", "spaces", "longest_word", "repeats")
_CLASS = {"upper": range(65, 91), "digits": range(48, 58), "exclamation": b"!?", "symbols": b"#$%&*@^~|<>{}[]=_\\/+",
          "punctuation": [c for c in range(33, 127) if not chr(c).isalnum()], "non_ascii": range(128, 256), "spaces": b" \t\r\n\x0b\x0c",
          "stops": b".,;:", "letters": [*range(65, 91), *range(97, 123), *range(128, 256)]}
COUNTS = np.zeros((256, len(_CLASS)))
for _k, _members in enumerate(_CLASS.values()):
    COUNTS[list(_members), _k] = 1


def text_features(text: bytes) -> list[float]:
    """The numbers of one UTF-8 text, in the order of ``FEATURES``."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ COUNTS
    count = dict(zip(_CLASS, seen.tolist()))
    size, n = len(text), len(words)
    lines = text.split(b"\n")
    pairs = len(set(zip(words, words[1:])))
    return [np.log1p(n), (size - count["spaces"]) / n, count["upper"] / max(1.0, count["letters"]), count["digits"] / size,
            count["punctuation"] / size, count["exclamation"] / size, count["symbols"] / size, len(set(words)) / n,
            len(set(lines)) / len(lines), np.log1p(n / len(lines)), count["non_ascii"] / size, count["stops"] / n,
            count["spaces"] / size, np.log1p(max(map(len, words))), 1 - pairs / max(1, n - 1)]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x) of every row."""
    def scan(batches):
        for b in batches:
            x = pa.array([text_features(t) for t in utf8(b.column(1))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), x], ["id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(scan, "id bigint, x array<double>")


class Gam:
    """Lookup tables of single features and of pairs, and the bins' edges."""

    def __init__(self, bins: int = 48, rounds: int = 160, pairs: int = 8, pair_rounds: int = 60, rate: float = 0.08,
                 leaves: int = 3, least: int = 20):
        self.bins, self.rounds, self.n_pairs, self.pair_rounds = bins, rounds, pairs, pair_rounds
        self.rate, self.leaves, self.least = rate, leaves, least
        self.base, self.edges, self.tables, self.pairs = 0.0, [], [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Gam":
        share = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if len(y) else 0.5
        self.base = float(np.log(share / (1 - share)))
        if len(np.unique(y)) < 2:
            return self
        steps = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, j], steps)) for j in range(x.shape[1])]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        b = self._binned(x)
        logit = np.full(len(y), self.base)
        for _ in range(self.rounds):
            for j, table in enumerate(self.tables):
                step = self._tree(b[:, j], len(table), y, logit)
                table += step
                logit += step[b[:, j]]
        found = sorted(((self._gain(b[:, i], b[:, j], i, j, y, logit), i, j) for i in range(b.shape[1]) for j in range(i)), reverse=True)
        self.pairs = [(i, j, np.zeros((len(self.tables[i]), len(self.tables[j])))) for _, i, j in found[:self.n_pairs]]
        for _ in range(self.pair_rounds):
            for i, j, table in self.pairs:
                step = self._pair_tree(b[:, i], b[:, j], table.shape, y, logit)
                table += step
                logit += step[b[:, i], b[:, j]]
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    @staticmethod
    def _slopes(y, logit):
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    def _tree(self, b, size, y, logit) -> np.ndarray:
        """One tree of up to ``leaves`` leaves over the bins, each leaf a Newton step."""
        g, h = self._slopes(y, logit)
        gs, hs, ns = (np.bincount(b, v, size) for v in (g, h, np.ones(len(b))))
        parts = [(0, size)]
        while len(parts) < self.leaves:
            best = max(((*self._cut(gs, hs, ns, lo, hi), lo, hi) for lo, hi in parts), key=lambda c: c[0])
            if best[0] <= 1e-9:
                break
            _, at, lo, hi = best
            parts.remove((lo, hi))
            parts += [(lo, at), (at, hi)]
        step = np.zeros(size)
        for lo, hi in parts:
            step[lo:hi] = self.rate * gs[lo:hi].sum() / (hs[lo:hi].sum() + 1.0)
        return step

    def _cut(self, gs, hs, ns, lo, hi) -> tuple[float, int]:
        g, h, n = (np.cumsum(v[lo:hi])[:-1] for v in (gs, hs, ns))
        if not len(g):
            return 0.0, lo
        G, H, N = gs[lo:hi].sum(), hs[lo:hi].sum(), ns[lo:hi].sum()
        gain = g ** 2 / (h + 1) + (G - g) ** 2 / (H - h + 1) - G ** 2 / (H + 1)
        gain[(n < self.least) | (N - n < self.least)] = 0.0
        at = int(np.argmax(gain))
        return float(gain[at]), lo + at + 1

    def _quarters(self, bi, bj, shape, y, logit):
        g, h = self._slopes(y, logit)
        flat = bi * shape[1] + bj
        gs, hs = (np.bincount(flat, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))
        cg, ch = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (gs, hs))

        def part(c, quarter):
            low = c[1:-1, 1:-1]
            top, left, every = c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
            return (low, top - low, left - low, every - top - left + low)[quarter]

        parts = [(part(cg, q), part(ch, q)) for q in range(4)]
        return parts, sum(a ** 2 / (b + 1) for a, b in parts)

    def _gain(self, bi, bj, i, j, y, logit) -> float:
        _, score = self._quarters(bi, bj, (len(self.tables[i]), len(self.tables[j])), y, logit)
        return float(score.max()) if score.size else 0.0

    def _pair_tree(self, bi, bj, shape, y, logit) -> np.ndarray:
        """A tree of one cut on each feature: four leaves."""
        step = np.zeros(shape)
        parts, score = self._quarters(bi, bj, shape, y, logit)
        if score.size:
            r, c = np.unravel_index(int(np.argmax(score)), score.shape)
            for (a, b), area in zip(parts, ((slice(0, r + 1), slice(0, c + 1)), (slice(0, r + 1), slice(c + 1, None)),
                                            (slice(r + 1, None), slice(0, c + 1)), (slice(r + 1, None), slice(c + 1, None)))):
                step[area] = self.rate * a[r, c] / (b[r, c] + 1.0)
        return step

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.base)
        if self.edges and len(x):
            b = self._binned(x)
            for j, table in enumerate(self.tables):
                logit += table[b[:, j]]
            for i, j, table in self.pairs:
                logit += table[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def held_out(ids: Column, mod: int, rest: int) -> Column:
    """Whether a row's label must not be learned from."""
    return F.coalesce(F.crc32(ids.cast("string").cast("binary")) % mod == rest, F.lit(False))


def fit(scanned: DataFrame, labels: DataFrame, fit_rows: int = 20_000, mod: int = 4, rest: int = 2) -> Gam:
    """``scanned``: (id, x); ``labels``: (id, label).  Learns from at most ``fit_rows`` labelled rows
    whose crc32(id) mod ``mod`` is not ``rest``."""
    known = labels.toDF("id", "label").filter(F.col("label").isNotNull() & ~held_out(F.col("id"), mod, rest))
    rows = bounded_sample(scanned.join(known, "id").select("id", "label", "x"), fit_rows, "id").select("x", "label").collect()
    x = np.array([r[0] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    return Gam().fit(x, np.array([float(r[1]) for r in rows]))


def score_features(scanned: DataFrame, model: Gam) -> DataFrame:
    """(id, score) from (id, x)."""
    def add(batches):
        for b in batches:
            x = np.array(b.column(1).to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x), pa.float64())], ["id", "score"])

    return scanned.select("id", "x").mapInArrow(add, "id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7,
             fit_rows: int = 20_000, mod: int = 4, rest: int = 2) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    scanned = store(features(docs, id_col, text_col), "quality")
    scored = score_features(scanned, fit(scanned, labels, fit_rows, mod, rest))
    return scored.select("id", held_out(F.col("id"), mod, rest).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7,
             fit_rows: int = 20_000, mod: int = 4, rest: int = 2) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, columns as given.  Only labelled rows'
    features are gathered; documents are scored where they are read."""
    wanted = store(features(docs, id_col, text_col), "quality")
    model = fit(wanted, labels, fit_rows, mod, rest)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array([text_features(t) for t in utf8(texts)], dtype=float).reshape(-1, len(FEATURES))))

    scored = whole_rows(docs, score=score(F.col(text_col)))
    return from_rows(scored.filter(F.col("score") >= threshold), docs)
