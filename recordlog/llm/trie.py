"""Conversation prefix trie by range minima over sorted common prefixes.

A conversation is the sequence of its turns; a node of the trie is a distinct prefix.  Equal
conversations first become one row with a count.  The distinct ones are sorted over the cluster
and cut into blocks.  In a block, the common prefix (in turns) of each row with the row before
it goes into a sparse table; a candidate prefix (row, depth) then finds the first and the last
row that start with it by two binary searches over that table, each on its own, without a stack.
Counts are differences of running sums over these intervals, the smallest member is a second
sparse table's minimum.  In order of row and depth the candidates stand in preorder, so that a
subtree is an interval as well.

Only prefixes of a block's first or last row can go on in another block.  They are few (two
paths a block); one small task puts them together by the digest of the prefix.  At most
``MAX_BLOCKS`` blocks are made, whatever the size of the table.

Defined results: rows without a conv_id belong to no conversation; turns are ordered by turn
(null first), role and a digest of the text; null role or text is empty; repeated rows are
repeated turns; a conversation without turns ends at the root; an empty table gives no nodes.
Extra columns are not read.  A turn takes 20 bytes (digest and number of words), and a
conversation is one row of them, so texts of any length cost no more than that.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlog.llm.common import store, word_count

#: Bytes of a turn: 16 of a digest, 4 of its number of words.
TURN = 20
#: Distinct conversations of a block, more when there would be over MAX_BLOCKS blocks.
BLOCK_ROWS, MAX_BLOCKS = 8_192, 32_768
#: Member ids that are written out together: those of one range of ids.
ID_BITS = 12
NODE = ("conv bigint, depth bigint, parent bigint, up bigint, n bigint, children bigint, leaves bigint, saved bigint, words bigint,"
        " ending binary, block int, slot bigint, node binary, above binary")
OPEN = "conv bigint, depth bigint, parent bigint, n bigint, children bigint, leaves bigint, saved bigint, ending binary, block int, slot bigint"


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, 40 hexadecimal digits a turn."""
    role_of, text_of = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role_of).cast("string"), F.lit(":"), role_of, text_of).cast("binary"), 256), 1, 32)
    item = F.concat(digest, F.lpad(F.lower(F.hex(word_count(text_of))), 8, "0"))
    place = F.struct(F.col(turn).isNotNull().alias("a"), F.col(turn).cast("long").alias("b"), role_of.alias("c"), item.alias("item"))
    return turns.filter(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), place.alias("place")) \
        .groupBy("conv_id").agg(F.array_sort(F.collect_list("place"))["item"].alias("turns"))


def rebuilt(seqs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin with the first h turns of conversation c - c % every and go on with their own
    after the first h; h = crc32(c) % most."""
    heads = seqs.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("of"), F.slice("turns", 1, max(1, most - 1)).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    return seqs.withColumn("of", F.col("conv_id") - F.col("conv_id") % every).join(heads, "of", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h),
                            F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


class RangeMinimum:
    """Sparse table: minima of every run of a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half, below = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minimum of left..right, both included."""
        level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
        out = np.empty(len(left), dtype=self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][left[at]], self.levels[k][right[at] - (1 << k) + 1])
        return out

    def rightmost(self, row: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Last row up to which all values after ``row`` are ``least`` or more."""
        at, n = row.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(at + (1 << k) < n)
            go = fits[self.levels[k][at[fits] + 1] >= least[fits]]
            at[go] += 1 << k
        return at

    def leftmost(self, row: np.ndarray, least: np.ndarray) -> np.ndarray:
        """First row from which all values up to that of ``row`` are ``least`` or more."""
        at = row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(at >= 1 << k)
            go = fits[self.levels[k][at[fits] - (1 << k) + 1] >= least[fits]]
            at[go] -= 1 << k
        return at


def common_prefixes(items: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Turns that each row shares with the row before it; -1 for the first row."""
    begin = np.cumsum(length) - length
    found = np.full(len(length), -1, dtype=np.int64)
    if len(length) > 1:
        upto = np.minimum(length[:-1], length[1:])
        owner = np.repeat(np.arange(len(upto)), upto)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(upto) - upto, upto)
        differ = (items[begin[:-1][owner] + k] != items[begin[1:][owner] + k]).any(axis=1)
        found[1:] = upto
        np.minimum.at(found, owner[differ] + 1, k[differ])
    return found


def _digests(key: bytes) -> list[bytes]:
    """Digest of every prefix of a key, from none of its turns to all."""
    running, found = hashlib.sha256(), [hashlib.sha256().digest()[:16]]
    for at in range(0, len(key), TURN):
        running.update(key[at:at + TURN])
        found.append(running.copy().digest()[:16])
    return found


def _nodes(keys: list[bytes], counts: np.ndarray, convs: np.ndarray, block: int) -> pa.RecordBatch:
    """Nodes of a block's distinct, sorted conversations.  Those on the first or last row's path carry what the
    block alone knows, with slot, node and above; the others are final but for a parent on such a path (up)."""
    length = np.array([len(k) // TURN for k in keys])
    items = np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(-1, TURN)
    words_of = items[:, 16:].astype(np.int64) @ np.array([1 << 24, 1 << 16, 1 << 8, 1])
    shared = common_prefixes(items, length)
    prefix, smallest = RangeMinimum(shared), RangeMinimum(convs)
    new = length - shared
    base = np.append(0, np.cumsum(new))
    row = np.repeat(np.arange(len(keys)), new)
    depth = np.arange(base[-1]) - base[row] + shared[row] + 1
    left, right = prefix.leftmost(row, depth), prefix.rightmost(row, depth)

    def index(of_row, of_depth):
        first = prefix.leftmost(of_row, of_depth)
        return base[first] + of_depth - shared[first] - 1

    parent = np.where(depth > 0, index(row, np.maximum(depth - 1, 0)), -1)
    last = np.arange(length[-1] + 1)
    is_open = row == 0
    last_path = index(np.full(len(last), len(keys) - 1), last)
    is_open[last_path] = True

    running = np.append(0, np.cumsum(counts))
    n = running[right + 1] - running[left]
    conv = smallest.least(left, right)
    begin = np.cumsum(length) - length
    words = np.zeros(len(row), dtype=np.int64)
    words[depth > 0] = words_of[(begin[row] + depth - 1)[depth > 0]]
    children = np.bincount(parent[~is_open], minlength=len(row))
    after = base[right + 1]

    def below(values):
        total = np.append(0, np.cumsum(np.where(is_open, 0, values)))
        return total[after] - total[np.arange(len(row))]

    saved, leaves = below((n - 1) * words), below((children == 0).astype(np.int64))
    ends = np.flatnonzero(depth == length[row])
    ending = np.full(len(row), None, dtype=object)
    ending[ends] = [hashlib.sha256(keys[i]).digest()[:16] for i in row[ends]]
    node, above = np.full(len(row), None, dtype=object), np.full(len(row), None, dtype=object)
    for path, key in ((np.arange(base[1]), keys[0]), (last_path, keys[-1])):
        digests = _digests(key)
        node[path] = digests
        above[path[1:]] = digests[:-1]
    up_open = (parent >= 0) & is_open[np.maximum(parent, 0)]
    known = ~is_open & ~up_open
    return pa.RecordBatch.from_arrays([
        pa.array(conv), pa.array(depth), pa.array(conv[np.maximum(parent, 0)], mask=~known), pa.array(parent, mask=is_open | ~up_open),
        pa.array(n), pa.array(children), pa.array(leaves), pa.array(saved), pa.array(words), pa.array(ending, pa.binary()),
        pa.array(np.full(len(row), block, dtype=np.int32)), pa.array(np.arange(len(row)), mask=~is_open),
        pa.array(node, pa.binary()), pa.array(above, pa.binary())],
        ["conv", "depth", "parent", "up", "n", "children", "leaves", "saved", "words", "ending", "block", "slot", "node", "above"])


def _block_nodes(batches):
    """A partition is a block."""
    from pyspark import TaskContext

    keys, counts, convs = [], [], []
    for b in batches:
        keys += b.column(0).to_pylist()
        counts.append(b.column(1).to_numpy())
        convs.append(b.column(2).to_numpy())
    if keys:
        found = _nodes(keys, np.concatenate(counts), np.concatenate(convs), TaskContext.get().partitionId())
        for at in range(0, found.num_rows, 65_536):
            yield found.slice(at, 65_536)


def _joined(frames):
    """The nodes on block borders, put together; a row with slot -1 for each, and its smallest member for each block."""
    parts = list(frames)
    if not parts or not sum(map(len, parts)):
        return
    part = pd.concat(parts, ignore_index=True)
    every = part.groupby("node").agg(conv=("conv", "min"), depth=("depth", "first"), above=("above", "first"), n=("n", "sum"),
                                     children=("children", "sum"), leaves=("leaves", "sum"), saved=("saved", "sum"),
                                     words=("words", "first"), ending=("ending", "first"))
    at = {d: i for i, d in enumerate(every.index)}
    parent = np.array([at.get(a, -1) for a in every["above"]])
    depth, convs = every["depth"].to_numpy(), every["conv"].to_numpy()
    children = every["children"].to_numpy() + np.bincount(parent[parent >= 0], minlength=len(every))
    # what these nodes themselves add to their subtrees, from the deepest up
    saved, leaves = ((every["n"] - 1) * every["words"]).to_numpy(), (children == 0).astype(np.int64)
    order = np.argsort(-depth, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        some = some[parent[some] >= 0]
        np.add.at(saved, parent[some], saved[some])
        np.add.at(leaves, parent[some], leaves[some])
    out = pd.DataFrame({"conv": convs, "depth": depth, "parent": pd.array(np.where(parent >= 0, convs[parent], 0), dtype="Int64"),
                        "n": every["n"].to_numpy(), "children": children, "leaves": leaves + every["leaves"].to_numpy(),
                        "saved": saved + every["saved"].to_numpy(), "ending": every["ending"].to_numpy(), "block": -1, "slot": -1})
    out.loc[parent < 0, "parent"] = pd.NA
    yield out
    back = pd.DataFrame({"conv": every["conv"].reindex(part["node"]).to_numpy(), "block": part["block"], "slot": part["slot"]})
    for name in ("depth", "n", "children", "leaves", "saved"):
        back[name] = 0
    back["parent"], back["ending"] = pd.array([pd.NA] * len(back), dtype="Int64"), None
    yield back[["conv", "depth", "parent", "n", "children", "leaves", "saved", "ending", "block", "slot"]]


def _digest(key: str) -> Column:
    return F.unhex(F.substring(F.sha2(F.col(key), 256), 1, 32))


def member_hashes(members: DataFrame) -> DataFrame:
    """(ending, ends_sha256) of (ending, conv_id): SHA-256 of the ids of a group, ascending, comma-joined.

    Ids are written out by ranges of ids first; the rows of a group then pass through one hash, in order, piece by piece."""
    chunk = F.shiftright("conv_id", ID_BITS)
    pieces = members.groupBy("ending", chunk.alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def hashed(batches):
        now, running = None, None
        for b in batches:
            done = []
            for ending, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if ending != now:
                    if running is not None:
                        done.append((now, running.hexdigest()))
                    now, running = ending, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
                                             ["ending", "ends_sha256"])
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([running.hexdigest()], pa.string())], ["ending", "ends_sha256"])

    return pieces.repartition("ending").sortWithinPartitions("ending", "chunk").mapInArrow(hashed, "ending binary, ends_sha256 string")


def trie(seqs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row a node of the trie of ``seqs`` (conv_id, turns): conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs = store(seqs.select("conv_id", F.unhex(F.array_join("turns", "")).alias("key")), "trie-conversations")
    classes = store(convs.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv")), "trie-classes")
    rows = classes.count()
    blocks = max(1, min(MAX_BLOCKS, -(-rows // block_rows)))
    nodes = store(classes.repartitionByRange(blocks, "key").sortWithinPartitions("key").mapInArrow(_block_nodes, NODE), "trie-nodes")
    border = store(nodes.filter("slot IS NOT NULL").repartition(1).mapInPandas(_joined, OPEN), "trie-borders")
    seen = border.filter("slot >= 0").select(F.col("block"), F.col("slot").alias("up"), F.col("conv").alias("up_conv"))
    closed = nodes.filter("slot IS NULL").join(seen, ["block", "up"], "left") \
        .select("conv", "depth", F.coalesce("parent", "up_conv").alias("parent"), "n", "children", "leaves", "saved", "ending")
    every = closed.unionByName(border.filter("slot = -1").select(closed.columns))
    hashes = member_hashes(convs.select(_digest("key").alias("ending"), "conv_id"))
    return every.join(hashes, "ending", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
