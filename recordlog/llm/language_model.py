"""Language-model scoring by a log-bilinear model trained with noise-contrastive estimation.

The model (numpy) predicts a token's class from the two tokens before it: their vectors, each
scaled by the position's weights, add up to a prediction, and a class scores by its product with
the class's vector plus a bias.  Classes are the ``WORDS`` most frequent tokens, the end among
them, and ``GROUPS`` groups of the others by a hash of their last bytes.  All scores of a batch are
one matrix product, so each row is normalised exactly.  Inside a group a token has its share of
the group's counts, plus 0.5 for each token and for one unseen token of the group; so a text's
probability is normalised over all tokens.

Training never sums over classes: each token is told from ``NOISE`` classes drawn by their
frequency, with log(k q) taken off the scores and the normaliser held at one.  It begins with one
task on a bounded sample (``START_DOCS``); then every task goes once through the
training documents that lie with it, from that start, and the parameters are averaged by number
of tokens (``PARTS`` sums reach the driver, whatever the number of tasks).

Counts cover the whole corpus.  Tasks know the counts of the ``FREQUENT`` most frequent tokens (a
bound); the others of a document go to their counts by a join on the token, once for each
document that holds them, and come back as one sum a document.

Defined results: null and empty texts are one end token; documents are rows, also when an id
repeats or is null (the null id is the text '' for crc32); without training documents every
token is unseen; an empty table gives no rows.  Extra columns are not read.
"""
from __future__ import annotations

import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlog.llm.common import bounded_sample, store, utf8

#: Classes of single tokens, groups of the others, and rows of context vectors (tokens, then groups, then the begin).
WORDS, GROUPS, CONTEXTS, DIM = 512, 64, 8_192, 16
#: Tokens whose counts every task knows.
FREQUENT = 131_072
NOISE, BATCH, RATE = 64, 4_096, 0.3
START_DOCS, PARTS = 4_000, 16
#: Tokens that are scored or trained on in one step, and sums held by a task.
STEP_TOKENS, HELD = 60_000, 400_000
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: The end of a text; words hold no white space.
END = b"\n"
ROW = ("row bigint, id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double,"
       " rare array<binary>, times array<bigint>")


def tokens(text: bytes) -> list[bytes]:
    return [*text.translate(LOWER).split(), END]


def group_of(word: bytes) -> int:
    """Group of a token that is no class of its own: by its last two bytes."""
    tail = word[-2:]
    return (tail[-1] * 31 + (tail[0] if len(tail) > 1 else 0) * 17) * 2654435761 % (1 << 32) * GROUPS >> 32


class Numbers(dict):
    """Number of a token: its place among the frequent ones, or behind them its group."""

    def __init__(self, frequent: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(frequent))
        self.frequent = len(frequent)

    def __missing__(self, word: bytes) -> int:
        return self.frequent + group_of(word)


class Vocabulary:
    """Counts of the frequent tokens; of all the others only sums by group."""

    def __init__(self, frequent: list[tuple[bytes, int]], total: int, distinct: int, group_counts: dict[int, tuple[int, int]]):
        """frequent: most frequent first; group_counts: (tokens, occurrences) of each group outside of the first WORDS tokens."""
        self.total = total
        self.frequent = [w for w, _ in frequent]
        n = len(frequent)
        words, rows = min(WORDS, n), min(CONTEXTS, n)
        sums = np.array([group_counts.get(g, (0, 0)) for g in range(GROUPS)], dtype=np.float64)
        counts = np.array([c for _, c in frequent] + [0] * GROUPS, dtype=np.float64)
        group = np.array([group_of(w) for w in self.frequent] + list(range(GROUPS)), dtype=np.int64)
        # occurrences of a class; a group has 0.5 for each of its tokens and for one unseen
        self.mass = np.append(counts[:words] + 0.5, sums[:, 1] + 0.5 * (sums[:, 0] + 1))
        # by number: class, context row, share of the class and base score; tokens behind the frequent count as unseen
        at = np.arange(n + GROUPS)
        self.class_of = np.where(at < words, at, words + group)
        self.row_of = np.where(at < rows, at, rows + group)
        self.begin = rows + GROUPS
        self.share_of = np.where(at < words, 0.0, np.log10((counts + 0.5) / self.mass[self.class_of]))
        self.base_of = np.log10(counts + 0.5) - np.log10(total + 0.5 * (distinct + 1))


class Model:
    """Context vectors r, position weights c, class vectors q and biases b."""

    def __init__(self, vocab: Vocabulary, seed: int = 0):
        r = np.random.default_rng(seed)
        self.r = r.normal(0, 0.1, (vocab.begin + 1, DIM)).astype(np.float32)
        self.c = np.ones((2, DIM), dtype=np.float32)
        self.q = r.normal(0, 0.1, (len(vocab.mass), DIM)).astype(np.float32)
        self.noise = vocab.mass / vocab.mass.sum()
        self.b = np.log(self.noise).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.r, self.c, self.q, self.b]

    def factors(self) -> None:
        """exp of each context row's part of all scores, by position: the sum over classes of a context is then a
        product of two rows.  Each row is scaled by its largest score."""
        self.parts = []
        for k in (0, 1):
            s = (self.r * self.c[k]) @ self.q.T
            if k == 0:
                s += self.b
            most = s.max(axis=1)
            self.parts.append((np.exp(s - most[:, None]), most))

    def log_probabilities(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Normalised log-probability (natural) of each target after its last token and the one before it."""
        (e1, m1), (e2, m2) = self.parts
        out = np.empty(len(one))
        for lo in range(0, len(one), 512):
            i, j, t = one[lo:lo + 512], two[lo:lo + 512], target[lo:lo + 512]
            h = self.r[i] * self.c[0] + self.r[j] * self.c[1]
            total = np.einsum("ij,ij->i", e1[i], e2[j])
            # rows scaled apart can leave next to nothing: those are summed in full
            for x in np.flatnonzero(total < 1e-25):
                s = (h[x] @ self.q.T + self.b).astype(np.float64)
                total[x] = np.exp(s - m1[i[x]] - m2[j[x]]).sum() or 1e-300
            out[lo:lo + 512] = np.einsum("ij,ij->i", h, self.q[t]) + self.b[t] - np.log(total) - m1[i] - m2[j]
        return out

    def gradients(self, one, two, target, drawn):
        """Of the mean noise-contrastive loss of a batch against the drawn classes: by context row of one and of two, c, q, b."""
        r1, r2 = self.r[one], self.r[two]
        h = r1 * self.c[0] + r2 * self.c[1]
        shift = np.log(len(drawn) * self.noise).astype(np.float32)
        qt, qd = self.q[target], self.q[drawn]
        n = np.float32(len(target))
        up = -1 / (1 + np.exp(np.einsum("ij,ij->i", h, qt) + (self.b - shift)[target])) / n
        down = 1 / (1 + np.exp(-(h @ qd.T + (self.b - shift)[drawn]))) / n
        gh = up[:, None] * qt + down @ qd
        gq = _added(target, up[:, None] * h, len(self.q)) + _added(drawn, down.T @ h, len(self.q))
        gb = np.bincount(target, up, len(self.b)) + np.bincount(drawn, down.sum(axis=0), len(self.b))
        return gh * self.c[0], gh * self.c[1], np.stack([(gh * r1).sum(axis=0), (gh * r2).sum(axis=0)]), gq, gb.astype(np.float32)

    def loss(self, one, two, target, drawn) -> float:
        h = self.r[one] * self.c[0] + self.r[two] * self.c[1]
        shift = np.log(len(drawn) * self.noise)
        true = np.einsum("ij,ij->i", h, self.q[target]) + (self.b - shift)[target]
        false = h @ self.q[drawn].T + (self.b - shift)[drawn]
        return (np.logaddexp(0, -true).sum() + np.logaddexp(0, false).sum()) / len(target)

    def train(self, one, two, target, state: list[np.ndarray], r: np.random.Generator) -> None:
        """One step, each parameter's rate by its own past gradients."""
        drawn = np.searchsorted(np.cumsum(self.noise), r.random(NOISE) * 0.999999)
        g1, g2, gc, gq, gb = self.gradients(one, two, target, drawn)
        gr = _added(np.concatenate([one, two]), np.concatenate([g1, g2]), len(self.r))
        for value, g, past in zip(self.parameters(), (gr, gc, gq, gb), state):
            past += g * g
            value -= RATE * g / (np.sqrt(past) + np.float32(1e-6))


def _added(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows that belong to each of n places."""
    out = np.zeros((n, rows.shape[1]), dtype=np.float32)
    order = np.argsort(at.astype(np.uint16) if n < 65_536 else at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    out[at[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _contexts(texts, vocab: Vocabulary, number: Numbers):
    """(numbers, context row of the last token, of the one before, tokens of each text, tokens) of steps of texts."""
    held, size, words, n = [], [], [], 0

    def step():
        every, length = np.concatenate(held), np.array(size)
        start = np.cumsum(length) - length
        one, two = np.roll(vocab.row_of[every], 1), np.roll(vocab.row_of[every], 2)
        one[start] = two[start] = vocab.begin
        two[(start + 1)[length > 1]] = vocab.begin
        return every, one, two, length, words

    for text in texts:
        ws = tokens(text)
        held.append(np.fromiter(map(number.__getitem__, ws), dtype=np.int64, count=len(ws)))
        size.append(len(ws))
        words.append(ws)
        n += len(ws)
        if n >= STEP_TOKENS:
            yield step()
            held, size, words, n = [], [], [], 0
    if size:
        yield step()


def _trained(vocab: Vocabulary, texts, start: list[np.ndarray] | None, seed: int):
    """Parameters after the texts, and the number of tokens."""
    model = Model(vocab)
    if start is not None:
        model.r, model.c, model.q, model.b = (x.copy() for x in start)
    state = [np.full_like(p, 0.1 if start is None else 1.0) for p in model.parameters()]
    r = np.random.default_rng(seed)
    seen = 0
    for every, one, two, *_ in _contexts(texts, vocab, Numbers(vocab.frequent)):
        target = vocab.class_of[every]
        order = r.permutation(len(target))
        for lo in range(0, len(order), BATCH):
            some = order[lo:lo + BATCH]
            model.train(one[some], two[some], target[some], state, r)
        seen += len(target)
    return model.parameters(), seen


def _texts(batches, column: int):
    for b in batches:
        yield from utf8(b.column(column))


def _flat(parameters: list[np.ndarray]) -> bytes:
    return np.concatenate([p.ravel() for p in parameters]).astype(np.float64).tobytes()


def fit(train: DataFrame, vocab: Vocabulary) -> list[np.ndarray]:
    """Parameters from all texts of ``train`` (id, text)."""
    shapes = [p.shape for p in Model(vocab).parameters()]
    packed = pickle.dumps(vocab)
    kind = "part bigint, seen bigint, parameters binary"

    def unpacked(flat: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        return [x.reshape(s).astype(np.float32) for x, s in zip(np.split(flat, ends[:-1]), shapes)]

    def pass_over(start):
        def one_pass(batches):
            from pyspark import TaskContext

            number = TaskContext.get().partitionId()
            found, seen = _trained(pickle.loads(packed), _texts(batches, 0), start, 1 + number)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([number % PARTS]), pa.array([seen]), pa.array([_flat(found)], pa.binary())],
                                                 ["part", "seen", "parameters"])
        return one_pass

    def added(batches):
        total, seen = None, 0
        for b in batches:
            for n, flat in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                own = np.frombuffer(flat) * n
                total, seen = own if total is None else total + own, seen + n
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([seen]), pa.array([total.tobytes()], pa.binary())], ["part", "seen", "parameters"])

    first = bounded_sample(train, START_DOCS, "id", "text").select("text").mapInArrow(pass_over(None), kind).collect()  # one task, one row
    if not first:
        return Model(vocab).parameters()
    start = unpacked(np.frombuffer(max(first, key=lambda r: r[1])[2]))
    parts = store(train.select("text").mapInArrow(pass_over(start), kind), "lm-parameters")
    sums = parts.repartition(PARTS, "part").mapInArrow(added, kind).collect()  # PARTS rows at most
    return unpacked(sum(np.frombuffer(r[2]) for r in sums) / sum(r[1] for r in sums))


def count_tokens(train: DataFrame) -> DataFrame:
    """(word, n) of all texts; a task passes on sums."""
    def counted(batches):
        held: Counter = Counter()

        def rows():
            words, numbers = list(held), list(held.values())
            for at in range(0, len(words), 65_536):
                yield pa.RecordBatch.from_arrays([pa.array(words[at:at + 65_536], pa.binary()), pa.array(numbers[at:at + 65_536], pa.int64())], ["word", "n"])
            held.clear()

        for text in _texts(batches, 0):
            held.update(tokens(text))
            if len(held) > HELD:
                yield from rows()
        yield from rows()

    return train.select("text").mapInArrow(counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """What every task knows of the counts: those of FREQUENT tokens at most, and sums."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    step = F.floor(F.log2("n") * 16).cast("int")
    least, some = 0, 0
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # 16 rows a power of two
        some += r[1]
        if some > FREQUENT:
            least = r[0] + 1
            break
    frequent = sorted(((bytes(w), n) for w, n in counts.filter(step >= least).collect()), key=lambda x: (-x[1], x[0]))
    single = {w for w, _ in frequent[:WORDS]}

    def grouped(batches):
        sums = np.zeros((GROUPS, 2), dtype=np.int64)
        for b in batches:
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if w not in single:
                    sums[group_of(w)] += 1, n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(GROUPS)), pa.array(sums[:, 0].copy()), pa.array(sums[:, 1].copy())], ["g", "words", "n"])

    rows = counts.mapInArrow(grouped, "g bigint, words bigint, n bigint").groupBy("g").agg(F.sum("words"), F.sum("n")).collect()
    return Vocabulary(frequent, total, distinct, {r[0]: (r[1], r[2]) for r in rows})


def _scored(packed: bytes, parameters: list[np.ndarray]):
    """Per document what the model and the frequent counts give, and its other tokens."""
    def scan(batches):
        vocab = pickle.loads(packed)
        model, number = Model(vocab), Numbers(vocab.frequent)
        model.r, model.c, model.q, model.b = parameters
        model.factors()
        for b in batches:
            out = []
            for every, one, two, length, words in _contexts(utf8(b.column(3)), vocab, number):
                begin = np.cumsum(length) - length
                logs = model.log_probabilities(one, two, vocab.class_of[every]) / np.log(10) + vocab.share_of[every]
                base, score = (np.add.reduceat(x, begin).tolist() for x in (vocab.base_of[every], logs))
                rare = every >= number.frequent
                known = (length - np.add.reduceat(rare.astype(np.int64), begin)).tolist()
                at = np.flatnonzero(rare)
                owner = np.searchsorted(begin, at, side="right") - 1
                edge = np.searchsorted(owner, np.arange(len(length) + 1)).tolist()
                at = (at - begin[owner]).tolist()
                for i, ws in enumerate(words):
                    found = Counter(ws[k] for k in at[edge[i]:edge[i + 1]])
                    out.append((len(ws), known[i], base[i], score[i], list(found), list(found.values())))
            for lo in range(0, b.num_rows, 4_096):
                part = out[lo:lo + 4_096]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k).slice(lo, len(part)) for k in range(3)), *(pa.array([x[k] for x in part], t) for k, t in
                       enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))))],
                    ["row", "id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "times"])
    return scan


def score(docs: DataFrame, folds: int = 5, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; rows whose crc32(id) % folds is
    ``held_out`` teach nothing."""
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
    docs = docs.select(F.col(id_col).cast("long").alias("id"), (fold == held_out).alias("held_out"), F.col(text_col).alias("text"))
    train = docs.filter("not held_out").select("id", "text")
    counts = store(count_tokens(train), "lm-counts")
    vocab = vocabulary(counts)
    parameters = fit(train, vocab)
    packed = pickle.dumps(vocab)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "id", "held_out", "text").mapInArrow(_scored(packed, parameters), ROW)
    rows = store(rows, "lm-rows")
    pairs = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")) \
        .select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    more = pairs.join(counts, "word").groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(2 * F.col("n") + 1)).alias("more"))
    known, more_log = F.coalesce("known", F.lit(0)), F.coalesce("more", F.lit(0.0))
    return rows.join(more, "row", "left").select("id", "held_out", "n_tokens", (F.col("n_known") + known).alias("n_known"),
                                                 F.lit(vocab.total).cast("long").alias("train_tokens"), (F.col("base") + more_log).alias("base_score"),
                                                 (F.col("score") + more_log).alias("score"))
