"""Prefix trie of conversations, from sorted matrices of turn ids.

Conversations become rows of turn ids (128 bits of a hash of role and text). Spark deals them out
in ranges of their id sequences, so each shard holds a stretch of the sorted whole. A shard is
sorted as a padded matrix; where a column or one before it changes between neighbouring rows, a
node starts, and all figures of a depth come from segment sums. Only the nodes on the paths to a
shard's first and last row can go on in another shard: they are put together afterwards, in
order, by one stack no deeper than the trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchwright.session import stage

#: Turns that are compared in one matrix; longer sequences go on in a further matrix of the rows that have them.
WIDTH = 32
#: Two 64-bit numbers per turn. The padding sorts before every id, as a shorter sequence comes first.
PAD = np.iinfo(np.int64).min
SPACES = " \t\n\x0b\f\r"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ---- sequences ----------------------------------------------------------------------------------


def _words(text: Column) -> Column:
    inner = F.trim(text, F.lit(SPACES))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+", -1)))


def _half(digest: Column, start: int) -> Column:
    """Sixteen hex digits as a signed long; the padding's value is left to the padding."""
    value = F.conv(F.substring(digest, start, 16), 16, -10).cast("long")
    return F.when(value == int(PAD), value + 1).otherwise(value)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id and `turns`, its (id, id, words) in order of turn (null first; ties by the ids).

    Null roles and texts become empty. A null conv_id takes no part. A conversation is one row
    of 20 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length of the role keeps (role, text) apart from any other split of the same letters
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), _words(text).cast("int").alias("words")
    )
    item = F.struct(F.col("turn"), _half(F.col("digest"), 1).alias("a"), _half(F.col("digest"), 17).alias("b"), "words")
    made = rows.dropna(subset=["conv_id"]).groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("turns"))
    return made.select("conv_id", F.transform("turns", lambda t: F.struct(t.a.alias("a"), t.b.alias("b"), t.words.alias("words"))).alias("turns"))


def rebuilt(sequences: DataFrame, block: int = 20, shared: int = 4) -> DataFrame:
    """Sequences whose first h turns are those of the first conversation of their block.

    h is the unsigned crc32 of the decimal conv_id modulo `shared`; the own turns follow from
    the h-th on. A block whose first conversation is absent lends no turns.
    """
    base = (F.col("conv_id") - F.col("conv_id") % block).alias("base")
    heads = sequences.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, shared - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int").alias("h")
    own = sequences.select("conv_id", "turns", base, h).join(heads, "base", "left")
    none = F.array().cast(sequences.schema["turns"].dataType)
    lent = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.select("conv_id", F.concat(lent, rest).alias("turns"))


# ---- one shard ----------------------------------------------------------------------------------


@dataclass
class Rows:
    """Sequences of one shard, sorted: conv ids, lengths, and the flat turn ids and words in that order."""

    conv: np.ndarray
    length: np.ndarray
    ids: np.ndarray  # (turns, 2)
    words: np.ndarray

    def matrix(self, rows: np.ndarray, start: int) -> np.ndarray:
        """The ids of the turns start .. start + WIDTH of some rows, padded, one line per row."""
        offset = np.cumsum(self.length) - self.length
        col = np.arange(WIDTH)
        inside = start + col < self.length[rows, None]
        at = np.where(inside, offset[rows, None] + start + col, 0)
        out = np.full((len(rows), WIDTH, 2), PAD, np.int64)
        out[inside] = self.ids[at[inside]]
        return out.reshape(len(rows), 2 * WIDTH)

    def take(self, order: np.ndarray) -> Rows:
        length = self.length[order]
        offset = (np.cumsum(self.length) - self.length)[order]
        flat = np.repeat(offset - (np.cumsum(length) - length), length) + np.arange(length.sum())
        return Rows(self.conv[order], length, self.ids[flat], self.words[flat])


def _sorted(rows: Rows) -> tuple[Rows, np.ndarray]:
    """Rows in order of (ids, conv_id), and per row the depth (from 1) at which it first differs from the row before.

    A block of columns is sorted by lexsort. Rows that are longer than the block go on in the
    next one, within the groups of rows that are equal so far; padding keeps shorter rows first.
    """
    n = len(rows.conv)
    order = np.lexsort((rows.conv,))
    differs = np.full(n, np.iinfo(np.int64).max)
    group = np.zeros(n, np.int64)  # of positions: equal in all columns so far
    at = np.arange(n)  # the positions that still have columns
    start = 0
    while len(at):
        m = rows.matrix(order[at], start)
        on = rows.length[order[at]] > start + WIDTH  # of rows equal so far, those that end here come first
        by = np.lexsort((rows.conv[order[at]], on, *m.T[::-1], group[at]))
        order[at] = order[at][by]
        m = m[by].reshape(len(at), WIDTH, 2)
        # a change in a column holds for all later ones: the OR is accumulated along the row
        change = np.zeros((len(at), WIDTH), bool)
        change[1:] = (m[1:] != m[:-1]).any(axis=2)
        change[np.concatenate(([True], np.diff(at) != 1))] = True  # the row before ends earlier, or there is none
        change[1:][np.diff(group[at]) != 0] = True
        change = np.logical_or.accumulate(change, axis=1)
        first = np.where(change.any(axis=1), start + 1 + change.argmax(axis=1), np.iinfo(np.int64).max)
        differs[at] = np.minimum(differs[at], first)
        group[at] = np.cumsum(change[:, -1])
        start += WIDTH
        at = at[rows.length[order[at]] > start]
    return rows.take(order), differs


@dataclass
class Level:
    """The nodes of one depth in a shard, in order; arrays of equal length."""

    first: np.ndarray  # the first row of the node
    conv: np.ndarray
    convs: np.ndarray
    ends: np.ndarray  # members that end here: rows first .. first + ends
    words: np.ndarray
    parent: np.ndarray  # index in the level above
    children: np.ndarray = field(default=None)
    leaves: np.ndarray = field(default=None)
    saved: np.ndarray = field(default=None)


def levels(rows: Rows, differs: np.ndarray) -> list[Level]:
    """All nodes of a shard by depth, from the root; subtree figures are of this shard alone."""
    n = len(rows.conv)
    offset = np.cumsum(rows.length) - rows.length
    here = np.arange(n)  # rows of at least this depth
    found, owner = [], np.zeros(n, np.int64)  # node of each row in the level above
    depth = 0
    while len(here):
        starts_at = np.flatnonzero(differs[here] <= depth) if depth else np.array([0])
        first = here[starts_at]
        sizes = np.diff(np.append(starts_at, len(here)))
        ends = np.add.reduceat((rows.length[here] == depth).astype(np.int64), starts_at)
        words = rows.words[offset[first] + depth - 1] if depth else np.zeros(1, np.int64)
        found.append(Level(first, np.minimum.reduceat(rows.conv[here], starts_at), sizes, ends, words.astype(np.int64), owner[first]))
        owner = np.zeros(n, np.int64)
        owner[here] = np.repeat(np.arange(len(first)), sizes)
        depth += 1
        here = here[rows.length[here] >= depth]
    below = None
    for level in reversed(found):
        level.saved = (level.convs - 1) * level.words
        level.children, level.leaves = np.zeros(len(level.first), np.int64), np.zeros(len(level.first), np.int64)
        if below is not None:
            starts = np.flatnonzero(np.diff(below.parent, prepend=-1))  # children of one node lie together
            nodes = below.parent[starts]
            level.children[nodes] = np.diff(np.append(starts, len(below.parent)))
            level.leaves[nodes] = np.add.reduceat(below.leaves, starts)
            level.saved[nodes] += np.add.reduceat(below.saved, starts)
        level.leaves += level.children == 0
        below = level
    return found


#: A node that is whole in its shard has no `path`; `up` names the place of an open parent in the shard.
SHARD = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
     ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("shard", pa.int64()), ("up", pa.int64()),
     ("place", pa.int64()), ("path", pa.binary()), ("words", pa.int64()), ("ends", pa.list_(pa.int64()))]
)
SHARD_DDL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "shard long, up long, place long, path binary, words long, ends array<long>"
)


def _ids_sha(ids) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest() if len(ids) else EMPTY_SHA


def shard_nodes(rows: Rows, differs: np.ndarray, shard: int) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard. Those on the paths of its first and last row are open.

    An open node carries its members' number, its closed children and what their subtrees hold,
    its end ids and a digest of its path; `place` numbers the open nodes in order, parents first.
    """
    if not len(rows.conv):
        return
    tree = levels(rows, differs)
    digests: dict[tuple[int, int], bytes] = {}
    for row in (0, len(rows.conv) - 1):
        node, path = 0, hashlib.md5()
        digests[0, 0] = path.digest()
        start = int(rows.length[:row].sum())
        for depth in range(1, int(rows.length[row]) + 1):
            path.update(rows.ids[start + depth - 1].tobytes())
            node = int(np.searchsorted(tree[depth].first, row, "right")) - 1
            digests[depth, node] = path.digest()
    # at most two open nodes a depth; those of the first row come before those of the last
    place = {k: i for i, k in enumerate(sorted(digests, key=lambda k: (tree[k[0]].first[k[1]] > 0, k[0])))}
    for depth, level in enumerate(tree):
        n = len(level.first)
        above = tree[depth - 1] if depth else None
        opened = {i: place[depth, i] for d, i in digests if d == depth}
        children, leaves, saved = level.children.copy(), level.leaves.copy(), level.saved.copy()
        for i in opened:  # what is not the node's own and not in an open child stays with it
            below = [k for d, k in digests if d == depth + 1 and tree[d].parent[k] == i]
            own = (level.convs[i] - 1) * level.words[i]
            children[i] -= len(below)
            leaves[i] -= level.children[i] == 0
            saved[i] -= own
            for k in below:
                leaves[i] -= tree[depth + 1].leaves[k]
                saved[i] -= tree[depth + 1].saved[k]
        up = [place.get((depth - 1, int(p))) for p in level.parent] if depth else [None]
        shut = [i not in opened for i in range(n)]
        ended = [rows.conv[f : f + e] for f, e in zip(level.first.tolist(), level.ends.tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(level.conv), pa.array(np.full(n, depth)),
                pa.array([int(above.conv[p]) if u is None else None for p, u in zip(level.parent, up)] if depth else [None], pa.int64()),
                pa.array(level.convs), pa.array(children), pa.array(leaves), pa.array(saved),
                pa.array([_ids_sha(e) if s else None for e, s in zip(ended, shut)], pa.string()),
                pa.array(np.full(n, shard)), pa.array(up, pa.int64()),
                pa.array([opened.get(i) for i in range(n)], pa.int64()), pa.array([digests.get((depth, i)) for i in range(n)], pa.binary()),
                pa.array(level.words), pa.array([None if s else e for e, s in zip(ended, shut)], pa.list_(pa.int64())),
            ],
            schema=SHARD,
        )


def _read(batches: Iterator[pa.RecordBatch]) -> Rows:
    conv, length, ids, words = [], [], [], []
    for b in batches:
        lists = b.column(1)
        flat = lists.flatten()
        a, c, w = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        conv.append(b.column(0).to_numpy(zero_copy_only=False))
        length.append(np.diff(lists.offsets.to_numpy()).astype(np.int64))
        ids.append(np.stack((a, c), axis=1).astype(np.int64))
        words.append(w.astype(np.int32))
    if not conv:
        return Rows(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.int64), np.zeros(0, np.int32))
    return Rows(np.concatenate(conv), np.concatenate(length), np.concatenate(ids), np.concatenate(words))


# ---- putting shards together ----------------------------------------------------------------------

JOINED = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
     ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("shard", pa.int64()), ("place", pa.int64())]
)
JOINED_DDL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, shard long, place long"
)


@dataclass
class Open:
    """A node on the stack while shards are put together."""

    path: bytes
    depth: int
    words: int
    conv: int | None = None
    convs: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    any_end: bool = False
    ends: object = field(default_factory=hashlib.sha256)
    places: list[tuple[int, int]] = field(default_factory=list)
    waiting: list[dict] = field(default_factory=list)  # finished children, which lack only this node's conv_id

    def add(self, row: dict) -> None:
        self.conv = row["conv_id"] if self.conv is None else min(self.conv, row["conv_id"])
        self.convs += row["n_convs"]
        self.children += row["n_children"]
        self.leaves += row["n_leaves"]
        self.saved += row["saved_tokens"]
        self.places.append((row["shard"], row["place"]))
        if row["ends"]:
            self.ends.update(("," if self.any_end else "").encode() + ",".join(map(str, row["ends"])).encode())
            self.any_end = True


def _finish(node: Open, above: Open | None) -> Iterator[dict]:
    """The rows of a node that gets no more members: itself, and its conv_id for each of its places."""
    row = {
        "depth": node.depth, "conv_id": node.conv, "n_convs": node.convs, "n_children": node.children, "n_leaves": node.leaves + (node.children == 0),
        "saved_tokens": node.saved + (node.convs - 1) * node.words, "ends_sha256": node.ends.hexdigest(),
    }
    for child in node.waiting:
        yield child | {"parent_conv_id": node.conv}
    for shard, place in node.places:
        yield {"conv_id": node.conv, "shard": shard, "place": place}
    if above is None:
        yield row
    else:
        above.children += 1
        above.leaves += row["n_leaves"]
        above.saved += row["saved_tokens"]
        above.waiting.append(row)


def joined(rows: Iterator[dict]) -> Iterator[dict]:
    """Open nodes in order of (shard, place) to finished nodes and to the conv_id of every place.

    Shards follow each other in the order of the trie, so a node that goes on in the next shard
    is still on the stack; anything else ends the nodes of its depth and below.
    """
    stack: list[Open] = []
    for row in rows:
        d = row["depth"]
        if d < len(stack) and stack[d].path != row["path"]:
            while len(stack) > d:
                node = stack.pop()
                yield from _finish(node, stack[-1] if stack else None)
        if d == len(stack):
            stack.append(Open(row["path"], d, row["words"]))
        stack[d].add(row)
    while stack:
        node = stack.pop()
        yield from _finish(node, stack[-1] if stack else None)


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(sequences: DataFrame, shard_turns: int = 1 << 20, least_shards: int = 1) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    Takes conv_id and turns as `turns` or `rebuilt` give them. Shards hold about `shard_turns`
    turns (a longer sequence is a row like any other). Equal sequences are parted by conv_id, so
    copies of one conversation spread over shards. No sequence gives no node; a table with any
    gives a root, also where all are turnless.

    In one task, one row at a time, go only the open nodes: for each shard those on two paths, and
    the ids that end at them (the hash of a node's ids is one sequence).
    """
    sequences = stage(sequences, "trie-sequences")
    total = sequences.agg(F.coalesce(F.sum(F.size("turns") + 1), F.lit(0))).first()[0]
    shards = max(least_shards, -(-total // shard_turns))
    ids = F.transform("turns", lambda t: F.struct(t.a, t.b))
    dealt = sequences.withColumn("ids", ids).repartitionByRange(shards, "ids", "conv_id").select("conv_id", "turns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from shard_nodes(*_sorted(_read(batches)), TaskContext.get().partitionId())

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in joined(row for b in batches for i in range(b.num_rows) for row in b.slice(i, 1).to_pylist()):
            held.append({c: row.get(c) for c in JOINED.names})
            if len(held) == 4096:
                yield pa.RecordBatch.from_pylist(held, JOINED)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, JOINED)

    made = stage(dealt.mapInArrow(run, SHARD_DDL), "trie-shards")
    opened = made.where(F.col("path").isNotNull()).select("shard", "place", "path", "depth", "words", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
    whole = stage(opened.repartition(1).sortWithinPartitions("shard", "place").mapInArrow(join, JOINED_DDL), "trie-joined")
    closed = made.where(F.col("path").isNull())
    inside = closed.where(F.col("up").isNull()).select(*NODE)
    names = whole.where(F.col("place").isNotNull()).select("shard", F.col("place").alias("up"), F.col("conv_id").alias("above"))
    edge = closed.drop("parent_conv_id").where(F.col("up").isNotNull()).join(names, ["shard", "up"]).withColumnRenamed("above", "parent_conv_id").select(*NODE)
    return inside.unionByName(edge).unionByName(whole.where(F.col("place").isNull()).select(*NODE))
