"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the vector of the word (words of the fitted texts) next to the sum of the
vectors of its character runs (three to five characters, hashed), so bent and unseen forms of
a word still carry what their letters say.  Two gated recurrent layers, one in each direction,
read a window of words; attention pools their states into one value.  Windows overlap by a
quarter and cover the whole text; the document's score is a logistic curve of the highest and the mean
window value.

The network is fitted on the driver from a bounded sample: at most ``fit_docs`` labelled
documents of each class (smallest hash of the id), of each up to ``fit_windows`` evenly spread
windows.  A label belongs to a document, not to a window, so a document's value in fitting is a
smooth maximum over its windows.  Every text is then read and scored whole in one scan.

Defined results: null and empty texts are one window without words and have a score like any
other; null labels and labels of unknown documents are left out; without labels of both classes
every score is the share of label 1 (0.5 without any); a null id is never held out; repeated
rows score alike; an empty table gives no rows.  Only the id and text columns are read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlog.llm.common import bounded_sample, store, utf8
from recordlog.llm.quality import held_out

#: Words of a window, words between the starts of windows, size of a state and of each vector.
WINDOW, STRIDE, STATE, VECTOR = 32, 24, 8, 8
CHAR_BITS = 15
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
#: Windows that are computed at once.
STEP_WINDOWS = 512
#: First step size of the vectors; the layers' is a third of it.
RATE = 0.1


def plain(word: bytes) -> bytes:
    """A word in lower case without punctuation around it."""
    return word.decode("utf-8", "replace").lower().encode().strip(PUNCTUATION) or word


def char_runs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character runs of all words one after another, and where each word's begin."""
    marked = [b"\x02" + w + b"\x03" for w in words]
    chars = np.frombuffer(b"".join(marked) + b"\x00" * 4, dtype=np.uint8).astype(np.uint64)
    size = np.array([len(w) for w in marked], dtype=np.int64)
    n = int(size.sum())
    starts = np.cumsum(size) - size
    counts = [np.maximum(0, size - length + 1) for length in (3, 4, 5)]
    begin = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(sum(counts), out=begin[1:])
    found, filled = np.empty(begin[-1], dtype=np.int64), begin[:-1].copy()
    code = chars[:n] << np.uint64(8) | chars[1:n + 1]
    for length, count in zip((3, 4, 5), counts):
        code = code << np.uint64(8) | chars[length - 1:n + length - 1]
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        runs = (code[np.repeat(starts, count) + nth] + np.uint64(length)) * np.uint64(0x9E3779B97F4A7C15)
        found[np.repeat(filled, count) + nth] = runs >> np.uint64(64 - CHAR_BITS)
        filled += count
    return found, begin


def _sums(rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sum of each word's rows over the root of their number."""
    out = np.zeros((len(begin) - 1, rows.shape[1]), dtype=rows.dtype)
    some = np.flatnonzero(begin[1:] > begin[:-1])
    if len(some):
        out[some] = np.add.reduceat(rows, begin[some], axis=0)
    return out / np.sqrt(np.maximum(1, np.diff(begin)))[:, None].astype(rows.dtype)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters, values and slopes.  Words are rows of an input table; row 0 stands for no word."""

    def __init__(self, vocabulary: list[bytes], seed: int = 5):
        from xxhash import xxh3_64_intdigest

        r = np.random.default_rng(seed)
        f = np.float32
        keys = np.array([xxh3_64_intdigest(w) for w in vocabulary], dtype=np.uint64)
        self.keys = np.sort(keys)
        self.p = {
            "words": (r.normal(0, 0.05, (len(vocabulary) + 1, VECTOR))).astype(f),  # the last row: unknown words
            "chars": (r.normal(0, 0.05, (1 << CHAR_BITS, VECTOR))).astype(f),
            "att": r.normal(0, 0.1, 2 * STATE).astype(f), "out": r.normal(0, 0.3, 2 * STATE).astype(f), "bias": np.zeros(1, f)}
        for d in "fb":
            self.p |= {f"wx{d}": r.normal(0, 0.3, (2 * VECTOR, 3 * STATE)).astype(f),
                       f"wh{d}": r.normal(0, 0.3, (STATE, 3 * STATE)).astype(f), f"b{d}": np.zeros(3 * STATE, f)}
        self.curve = np.array([1.0, 0.0, 0.0])  # of the highest and the mean window, and a constant
        self.constant: float | None = None

    def word_rows(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        key = np.array([xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
        at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        return np.where(self.keys[at] == key, at, len(self.keys)) if len(self.keys) else np.zeros(len(key), dtype=np.int64)

    def vectors(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        row = self.word_rows(words)
        runs, begin = char_runs(words)
        return np.concatenate([self.p["words"][row], _sums(self.p["chars"][runs], begin)], axis=1), (row, runs, begin)

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """What the two layers add for each word; forward, then backward layer."""
        v, _ = self.vectors(words)
        return np.concatenate([v @ self.p["wxf"] + self.p["bf"], v @ self.p["wxb"] + self.p["bb"]], axis=1)

    def run(self, table: np.ndarray, windows: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Values of windows (rows of ``table``, 0 for none).  ``keep``: gets what the slopes need."""
        n, t = windows.shape
        mask = (windows != 0).astype(np.float32).T
        padded = not mask.all()
        states = np.empty((t, n, 2 * STATE), dtype=np.float32)
        inputs = table[windows.T]
        for k, d in enumerate("fb"):
            h = np.zeros((n, STATE), dtype=np.float32)
            wh, cols = self.p[f"wh{d}"], slice(3 * STATE * k, 3 * STATE * (k + 1))
            for s in range(t) if d == "f" else range(t - 1, -1, -1):
                x, g = inputs[s, :, cols], h @ wh
                gates = _sigmoid(x[:, :2 * STATE] + g[:, :2 * STATE])
                r, z, gn = gates[:, :STATE], gates[:, STATE:], g[:, 2 * STATE:]
                new = np.tanh(x[:, 2 * STATE:] + r * gn)
                if keep is not None:
                    keep.append((d, s, h, r, z, gn, new))
                after = new + z * (h - new)
                h = h + mask[s][:, None] * (after - h) if padded else after
                states[s, :, STATE * k:STATE * (k + 1)] = h
        e = states @ self.p["att"] + (mask - 1) * np.float32(1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tn,tnk->nk", a, states)
        if keep is not None:
            keep.append((mask, states, a, pooled))
        return pooled @ self.p["out"] + self.p["bias"]

    def slopes(self, windows: np.ndarray, vectors: np.ndarray, keep: list, dvalue: np.ndarray) -> tuple[dict, np.ndarray]:
        """Slopes of the parameters and of the words' vectors, given those of the windows' values."""
        mask, states, a, pooled = keep.pop()
        g = {"out": pooled.T @ dvalue, "bias": dvalue.sum(keepdims=True)}
        dpooled = dvalue[:, None] * self.p["out"]
        da = np.einsum("tnk,nk->tn", states, dpooled)
        de = a * (da - (a * da).sum(axis=0))
        g["att"] = np.einsum("tn,tnk->k", de, states)
        dstates = a[:, :, None] * dpooled + de[:, :, None] * self.p["att"]
        dvectors = np.zeros_like(vectors)
        for d in "fb":
            wh, wx = self.p[f"wh{d}"], self.p[f"wx{d}"]
            dwh, dinput = np.zeros_like(wh), np.zeros((len(vectors), 3 * STATE), dtype=np.float32)
            dh = np.zeros((len(windows), STATE), dtype=np.float32)
            k = "fb".index(d)
            for _, s, h, r, z, gn, new in reversed([x for x in keep if x[0] == d]):
                m = mask[s][:, None]
                dh = dh + dstates[s, :, STATE * k:STATE * (k + 1)]
                now = dh * m
                dz, dn = now * (h - new) * z * (1 - z), now * (1 - z) * (1 - new ** 2)
                dr = dn * gn * r * (1 - r)
                dg = np.concatenate([dr, dz, dn * r], axis=1)
                np.add.at(dinput, windows[:, s], np.concatenate([dr, dz, dn], axis=1))
                dwh += h.T @ dg
                dh = dh * (1 - m) + now * z + dg @ wh.T
            g |= {f"wh{d}": dwh, f"wx{d}": vectors.T @ dinput, f"b{d}": dinput.sum(axis=0)}
            dvectors += dinput @ wx.T
        return g, dvectors

    def fit(self, docs: list[list[list[bytes]]], labels: np.ndarray, epochs: int = 4, batch: int = 24, steps: int = 200,
            seed: int = 5) -> "Network":
        """``docs``: windows of words of each document; at least ``steps`` steps, so small samples go round oftener."""
        r = np.random.default_rng(seed)
        seen = {k: np.zeros_like(v, dtype=np.float64) for k, v in self.p.items()}
        epochs = max(epochs, -(-steps * batch // max(1, len(docs))))
        for epoch in range(epochs):
            rate = RATE / (1 + 3 * epoch / epochs)
            order = r.permutation(len(docs))
            for lo in range(0, len(order), batch):
                some = order[lo:lo + batch]
                words: dict[bytes, int] = {}
                windows = np.zeros((sum(len(docs[i]) for i in some), WINDOW), dtype=np.int64)
                owner = np.repeat(np.arange(len(some)), [len(docs[i]) for i in some])
                for row, w in zip(windows, (w for i in some for w in docs[i])):
                    row[:len(w)] = [words.setdefault(x, len(words) + 1) for x in w]
                vectors, (word, runs, begin) = self.vectors([b"", *words])
                table = np.concatenate([vectors @ self.p["wxf"] + self.p["bf"], vectors @ self.p["wxb"] + self.p["bb"]], axis=1)
                keep: list = []
                value = self.run(table, windows, keep)
                top = np.full(len(some), -np.inf)
                np.maximum.at(top, owner, value)
                share = np.exp(value - top[owner])
                total = np.bincount(owner, share, len(some))
                smooth = top + np.log(total / np.bincount(owner, minlength=len(some)))
                slope = (_sigmoid(smooth) - labels[some]) / len(some)
                dvalue = (slope[owner] * share / total[owner]).astype(np.float32)
                g, dvectors = self.slopes(windows, vectors, keep, dvalue)
                dvectors[0] = 0
                for k, v in g.items():
                    seen[k] += v ** 2
                    self.p[k] -= (0.3 * rate * v / (np.sqrt(seen[k]) + 1e-4)).astype(np.float32)
                count = np.diff(begin)
                dchar = np.repeat(dvectors[:, VECTOR:] / np.sqrt(np.maximum(1, count))[:, None], count, axis=0)
                for k, at, v in (("words", word, dvectors[:, :VECTOR]), ("chars", runs, dchar)):
                    rows, back = np.unique(at, return_inverse=True)
                    total_v = np.zeros((len(rows), VECTOR))
                    np.add.at(total_v, back, v)
                    seen[k][rows] += total_v ** 2
                    self.p[k][rows] -= (rate * total_v / (np.sqrt(seen[k][rows]) + 1e-4)).astype(np.float32)
        return self

    def score(self, top: np.ndarray, mean: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(top), self.constant)
        return _sigmoid(np.clip(self.curve[0] * top + self.curve[1] * mean + self.curve[2], -30, 30))


class _Rows(dict):
    """Row of each word; a new word gets the next row and waits in ``new`` until its input is worked out."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = row = len(self) + 1
        self.new.append(word)
        return row


class Reader:
    """Highest and mean window value of texts, all windows; inputs of the words seen last are kept."""

    def __init__(self, network: Network, most: int = 200_000):
        self.network, self.most, self.rows = network, most, _Rows()
        self.table = np.zeros((most + 1, 6 * STATE), dtype=np.float32)
        self.table[0] = network.inputs([b""])[0]

    def _learn(self) -> None:
        new, last = self.rows.new, len(self.rows) + 1
        if last > len(self.table):  # a text with more new words than are kept
            self.table = np.concatenate([self.table, np.zeros((last - len(self.table), 6 * STATE), dtype=np.float32)])
        for lo in range(0, len(new), 8192):
            some = new[lo:lo + 8192]
            self.table[last - len(new) + lo:last - len(new) + lo + len(some)] = self.network.inputs([plain(w) for w in some])
        new.clear()

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        top, total, windows = np.full(len(texts), -np.inf), np.zeros(len(texts)), np.zeros(len(texts))
        waiting: list[tuple[int, np.ndarray]] = []
        size, span = 0, np.arange(WINDOW)

        def flush():
            nonlocal size
            if not waiting:
                return
            self._learn()
            every = np.concatenate([w for _, w in waiting])
            owner = np.repeat([i for i, _ in waiting], [len(w) for _, w in waiting])
            value = np.concatenate([self.network.run(self.table, every[lo:lo + STEP_WINDOWS]) for lo in range(0, len(every), STEP_WINDOWS)])
            np.maximum.at(top, owner, value)
            np.add.at(total, owner, value)
            np.add.at(windows, owner, 1)
            waiting.clear()
            size = 0

        for i, text in enumerate(texts):
            if len(self.rows) > self.most:
                flush()
                self.rows.clear()
                self.rows.new.clear()
            words = text.split()
            n = len(words)
            row = np.zeros(max(n, WINDOW), dtype=np.int32)
            row[:n] = np.fromiter(map(self.rows.__getitem__, words), dtype=np.int32, count=n)
            starts = np.arange(0, max(1, n - WINDOW), STRIDE)
            if n > WINDOW:
                starts = np.append(starts, n - WINDOW)  # the last one ends with the text
            for at in range(0, len(starts), 8 * STEP_WINDOWS):
                some = starts[at:at + 8 * STEP_WINDOWS]
                waiting.append((i, row[some[:, None] + span]))
                size += len(some)
                if size >= 8 * STEP_WINDOWS:
                    flush()
        flush()
        return top, total / np.maximum(1, windows)


def _sample(docs: DataFrame, labels: DataFrame, fit_docs: int, mod: int, rest: int) -> DataFrame:
    """(id, label, text) of the sampled rows: the ids of at most ``fit_docs`` labels of each class."""
    known = labels.toDF("id", "label").filter(F.col("label").isin(0, 1) & ~held_out(F.col("id"), mod, rest))
    ids = None
    for value in (0, 1):
        one = bounded_sample(known.filter(F.col("label") == value), fit_docs, "id")
        ids = one if ids is None else ids.union(one)
    return docs.join(F.broadcast(ids), "id")  # two times ``fit_docs`` rows of two numbers at most


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = 2000, fit_windows: int = 8, mod: int = 5, rest: int = 0) -> Network:
    """``docs``: (id, text); ``labels``: (id, label)."""
    sample = store(_sample(docs, labels, fit_docs, mod, rest), "toxic-sample")

    def windows(batches):
        for b in batches:
            out = []
            for text in utf8(b.column(2)):
                words = text.split()
                starts = np.unique(np.linspace(0, max(0, len(words) - WINDOW), fit_windows).astype(int)
                                   if len(words) > WINDOW else [0])
                out.append([b" ".join(map(plain, words[s:s + WINDOW])) for s in starts])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.int32()), pa.array(out, pa.list_(pa.binary()))],
                                             ["id", "label", "windows"])

    rows = sample.select("id", "label", "text").mapInArrow(windows, "id bigint, label int, windows array<binary>").collect()
    rows.sort(key=lambda r: (r[0], r[2]))
    y = np.array([float(r[1]) for r in rows])
    if len(np.unique(y)) < 2:
        network = Network([])
        network.constant = float(y.mean()) if len(y) else 0.5
        return network
    texts = [[bytes(w).split() for w in r[2]] for r in rows]
    often: dict[bytes, int] = {}
    for doc in texts:
        for w in {w for window in doc for w in window}:
            often[w] = often.get(w, 0) + 1
    network = Network(sorted(w for w, n in often.items() if n >= 3)).fit(texts, y)
    seen = scan(sample, network, "label").select("top", "mean", F.col("label").cast("double")).collect()
    network.curve = _logistic(np.array([[r[0], r[1]] for r in seen]), np.array([r[2] for r in seen]))
    return network


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the columns of ``x`` and a constant, by Newton steps with a small penalty."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.array([1.0, 0.0, 0.0])
    for _ in range(30):
        p = _sigmoid(np.clip(x @ w, -30, 30))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), x.T @ (y - p) - 0.1 * w)
    return w


def scan(docs: DataFrame, network: Network, *more: str) -> DataFrame:
    """(id, top, mean, ...) of (id, text, ...): the highest and the mean value of each text's windows."""
    def read(batches):
        reader = Reader(network)
        for b in batches:
            top, mean = reader.read(list(utf8(b.column(1))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(top), pa.array(mean), *b.columns[2:]], ["id", "top", "mean", *more])

    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in more)
    return docs.select("id", "text", *more).mapInArrow(read, f"id bigint, top double, mean double{kinds}")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
             fit_docs: int = 2000, fit_windows: int = 8, mod: int = 5, rest: int = 0) -> DataFrame:
    """(id, held_out, score, predicted) of every row.  ``labels``: (id, label); labels of ids whose
    crc32 mod ``mod`` is ``rest`` are not learned from."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    network = fit(rows, labels, fit_docs, fit_windows, mod, rest)

    def add(batches):
        for b in batches:
            score = network.score(b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())], ["id", "score"])

    scored = scan(rows, network).mapInArrow(add, "id bigint, score double")
    return scored.select("id", held_out(F.col("id"), mod, rest).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
