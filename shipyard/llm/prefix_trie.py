"""The trie of all conversation prefixes, from balanced parentheses per shard.

A conversation is the sequence of the hashes of its turns; sorting these by range
(``turn_sequences``, ``prefix_trie``) puts conversations with a common prefix side
by side and gives every task one shard of bounded size, also where thousands of
conversations are equal: those are told apart by their id. In a shard the common
prefixes of neighbours give the trie's nodes in preorder, written as balanced
parentheses. Blocks of the excess with their minimum and maximum, and a tree of
pairs over them, find the closing parenthesis of every node, which delimits its
subtree; the rank of leaf pairs ``()`` in between counts leaves, and cumulative
arrays over preorder give members and savings.

A node with members in two shards lies on the last path of one and the first path
of the next. So the first and the last path of each shard, its spine, leaves the
shard with what hangs below it summed up; the spines of ``fan`` shards merge to one
trie, which is worked off the same way, and so on until one spine is left. A
parent on a spine is known only then; the nodes below fetch it by shard.

Results: null roles and texts count as empty; turns of equal number are ordered by
their hash; equal rows are turns each; rows without a conversation id take no part;
a conversation without turns is a member of the root alone; an empty table has no
nodes, not even a root. Other columns are left out. Two turns are the same if 128
bits of their SHA-256 are. A conversation is handled whole: 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipyard.llm.bytetext import flat
from shipyard.llm.common import ready, written

#: Turns of a shard on average, at most.
SHARD_TURNS = 250_000
#: Shards whose spines one task merges.
FAN = 1024
#: Parentheses of an excess block.
BLOCK = 64
#: Bytes of a turn's hash.
WIDTH = 16

NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: Nodes and spines on their way: a spine row (``side`` 1 first path, 2 last path,
#: 3 both) holds what does not lie below another node of the spine.
PARTS = (
    "side int, shard long, pos long, pid binary, parent_pid binary, conv_id long, depth long, size long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends binary"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()
NONE = np.iinfo(np.int64).max


class Parentheses:
    """Balanced parentheses of a tree given by the depths of its nodes in preorder."""

    def __init__(self, depth: np.ndarray, block: int = BLOCK):
        n = len(depth)
        closes = np.r_[depth[:-1] - depth[1:] + 1, depth[-1] + 1]
        self.open = np.arange(n) + np.cumsum(closes) - closes
        step = np.full(2 * n, -1, np.int64)
        step[self.open] = 1
        self.excess = np.cumsum(step)
        self.leaf = np.flatnonzero((step[:-1] == 1) & (step[1:] == -1))  # where a pair () begins
        self.block = block
        blocks = 1 << max(0, (-(-2 * n // block) - 1).bit_length())
        padded = np.full(blocks * block, NONE)
        padded[: 2 * n] = self.excess
        self.padded = padded
        low, high = padded.reshape(blocks, block).min(1), padded.reshape(blocks, block).max(1)
        self.levels = [(low, high)]
        while len(low) > 1:
            low, high = low.reshape(-1, 2).min(1), high.reshape(-1, 2).max(1)
            self.levels.append((low, high))

    def close(self) -> np.ndarray:
        """The closing parenthesis of every node: the first place behind it where the
        excess is one lower than at it."""
        target = self.excess[self.open] - 1
        out = np.full(len(target), -1)
        inner = np.flatnonzero((self.open + 1) % self.block)  # others begin a block anew
        self._scan(inner, self.open[inner] + 1, target, out)
        waiting = np.flatnonzero(out < 0)
        node, landed = self.open[waiting] // self.block, []
        for level, (low, high) in enumerate(self.levels[:-1]):  # up: the first sibling to the right that holds the target
            right = np.minimum(node + 1, len(low) - 1)
            here = (node % 2 == 0) & (low[right] <= target[waiting]) & (target[waiting] <= high[right])
            landed.append((level, waiting[here], right[here]))
            waiting, node = waiting[~here], node[~here] // 2
        which, at = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for level in range(len(self.levels) - 2, -1, -1):  # down: the first child that holds it
            _, more, place = landed[level]
            which, at = np.r_[which, more], np.r_[at, place]
            if level:
                low, high = self.levels[level - 1]
                first = (low[2 * at] <= target[which]) & (target[which] <= high[2 * at])
                at = 2 * at + ~first
        self._scan(which, at * self.block, target, out)
        return out

    def _scan(self, nodes: np.ndarray, at: np.ndarray, target: np.ndarray, out: np.ndarray) -> None:
        """Looks for the target of ``nodes`` from place ``at`` to the end of its block."""
        while len(nodes):
            hit = self.padded[at] == target[nodes]
            out[nodes[hit]] = at[hit]
            at = at + 1
            go = ~hit & (at % self.block != 0)
            nodes, at = nodes[go], at[go]

    def opened(self, at: np.ndarray) -> np.ndarray:
        """Opening parentheses up to and including place ``at``."""
        return (at + 1 + self.excess[at]) // 2


def _range_minima(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least of ``values[begin:end]`` for many non-empty ranges."""
    width = end - begin
    out, table, k = np.empty(len(begin), values.dtype), values, 0
    while True:
        here = np.flatnonzero((width >> k) == 1)
        out[here] = np.minimum(table[begin[here]], table[end[here] - (1 << k)])
        if not (width >> (k + 1)).any():
            return out
        table = np.minimum(table[: -(1 << k)], table[1 << k :])
        k += 1


def subtrees(depth, size, ends, least, more_children, more_leaves, more_saved) -> dict[str, np.ndarray]:
    """What every node of a trie in preorder stands for. ``ends``, ``least``: members
    that end at the node and their smallest id; ``more_*``: what hangs below a node
    besides the nodes given."""
    n = len(depth)
    pairs = Parentheses(depth)
    close = pairs.close()
    end = pairs.opened(close)  # preorder places [k, end[k]) are the subtree of node k
    order = np.argsort(depth, kind="stable")
    by_depth = depth[order] * (n + 1) + order
    parent = np.full(n, -1)
    inner = np.arange(1, n)
    parent[1:] = order[np.searchsorted(by_depth, (depth[1:] - 1) * (n + 1) + inner) - 1]
    children = np.bincount(parent[1:], minlength=n) + more_children

    def below(x: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(x)]
        return sums[end] - sums[:n]

    # Leaf pairs whose node has nothing else below it, ranked by place.
    counted = more_children[pairs.opened(pairs.leaf) - 1] == 0
    rank = np.zeros(2 * n + 1, np.int64)
    rank[1:][pairs.leaf[counted]] = 1
    rank = np.cumsum(rank)
    members = below(ends)
    return {
        "parent": parent,
        "conv_id": _range_minima(least, np.arange(n), end),
        "n_convs": members,
        "n_children": children,
        "n_leaves": rank[close] - rank[pairs.open] + below(more_leaves),
        "saved_tokens": below((members - 1) * size + more_saved),
    }


def _parts(shard, depth, size, ends, least, more, on_first, on_last, pid, ends_sha, ends_text) -> pa.Table:
    """The rows of ``PARTS`` of a trie: complete nodes, and the spine, ``on_first`` and ``on_last``."""
    got = subtrees(depth, size, ends, least, *more)
    spine = on_first | on_last
    parent, n = got["parent"], len(depth)
    under = np.flatnonzero(~spine & (parent >= 0))
    hanging = under[spine[parent[under]]]  # complete nodes right below the spine
    rest = {"n_convs": ends.copy(), "conv_id": least.copy(), "n_children": more[0].copy(), "n_leaves": more[1].copy(), "saved_tokens": more[2].copy()}
    for name in ("n_convs", "n_leaves", "saved_tokens"):
        np.add.at(rest[name], parent[hanging], got[name][hanging])
    np.add.at(rest["n_children"], parent[hanging], 1)
    np.minimum.at(rest["conv_id"], parent[hanging], got["conv_id"][hanging])
    value = {c: np.where(spine, rest[c], got[c]) for c in rest}
    above = parent.clip(0)
    open_parent = (parent >= 0) & spine[above]
    pids = np.full(n, None, object)
    for k, name in pid.items():
        pids[k] = name
    return pa.table(
        {
            "side": pa.array((on_first + 2 * on_last).astype(np.int32)),
            "shard": pa.array(np.full(n, shard, np.int64)),
            "pos": pa.array(np.arange(n)),
            "pid": pa.array(pids.tolist(), pa.binary()),
            "parent_pid": pa.array(np.where(open_parent, pids[above], None).tolist(), pa.binary()),
            "conv_id": pa.array(value["conv_id"], mask=value["conv_id"] == NONE),
            "depth": pa.array(depth),
            "size": pa.array(size),
            "parent_conv_id": pa.array(got["conv_id"][above], mask=(parent < 0) | spine[above]),
            "n_convs": pa.array(value["n_convs"]),
            "n_children": pa.array(value["n_children"]),
            "n_leaves": pa.array(value["n_leaves"]),
            "saved_tokens": pa.array(value["saved_tokens"]),
            "ends_sha256": pa.array(ends_sha, pa.string()),
            "ends": pa.array(ends_text, pa.binary()),
        }
    )


def _path_ids(key: bytes) -> list[bytes]:
    """An id for the prefix of every length of a conversation."""
    running, out = hashlib.sha256(), [hashlib.sha256(b"").digest()[:WIDTH]]
    for k in range(0, len(key), WIDTH):
        running.update(key[k : k + WIDTH])
        out.append(running.copy().digest()[:WIDTH])
    return out


def shard_parts(shard: int, rows: pa.Table) -> pa.Table:
    """The trie of a shard: ``rows`` (``key``, ``sizes``, ``conv_id``) in order."""
    buf, offsets = flat(rows["key"])
    turns = np.ascontiguousarray(buf).view("<u8").reshape(-1, 2)
    length = np.diff(offsets) // WIDTH
    first = offsets[:-1] // WIDTH
    owner = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(owner)) - first[owner]
    # Turns shared with the conversation before: up to the first that differs.
    comparable = (owner > 0) & (place < length[owner - 1])
    other = first[owner - 1] + place
    same = np.zeros(len(owner), bool)
    same[comparable] = (turns[comparable] == turns[other[comparable]]).all(1)
    shared = np.zeros(len(length), np.int64)
    filled = np.flatnonzero(length)
    if len(filled):
        shared[filled] = np.minimum.reduceat(np.where(same, NONE, place), first[filled])
    shared = np.minimum(shared, length)
    fresh = place >= shared[owner]
    depth = np.r_[0, place[fresh] + 1]
    sizes = rows["sizes"].combine_chunks()
    size = np.r_[0, sizes.flatten().to_numpy(zero_copy_only=False)[fresh]].astype(np.int64)
    end_node = np.cumsum(length - shared)  # the last node made so far; equal conversations make none
    conv = rows["conv_id"].to_numpy()
    n = len(depth)
    ends, least = np.bincount(end_node, minlength=n), np.full(n, NONE)
    np.minimum.at(least, end_node, conv)

    on_first, on_last = np.zeros(n, bool), np.zeros(n, bool)
    on_first[: length[0] + 1] = True
    last_of = np.zeros(int(depth.max()) + 1, np.int64)
    np.maximum.at(last_of, depth, np.arange(n))
    on_last[last_of[: length[-1] + 1]] = True
    raw = buf.tobytes()
    pid = dict(enumerate(_path_ids(raw[: offsets[1]])))
    pid |= dict(zip(last_of[: length[-1] + 1].tolist(), _path_ids(raw[offsets[-2] :]), strict=True))

    spine = on_first | on_last
    sha, text = np.full(n, NO_ENDS, object), np.full(n, None, object)
    begin = np.flatnonzero(np.r_[True, end_node[1:] != end_node[:-1]])
    decimal = [str(c) for c in conv.tolist()]
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(decimal)], strict=True):
        joined, node = ",".join(decimal[a:b]).encode(), int(end_node[a])
        if spine[node]:
            text[node] = joined
        else:
            sha[node] = hashlib.sha256(joined).hexdigest()
    none = np.zeros(n, np.int64)
    return _parts(shard, depth, size, ends, least, (none, none, none), on_first, on_last, pid, sha.tolist(), text.tolist())


def merged_parts(rows: pa.Table, fan: int, last: bool) -> pa.Table:
    """The spines of neighbouring shards as one trie; with ``last``, all its nodes are complete."""
    rows = rows.sort_by([("shard", "ascending"), ("pos", "ascending")])
    # Appending what is new keeps preorder: known nodes lie on the last path so far.
    seen: dict[bytes, int] = {}
    node = np.array([seen.setdefault(p, len(seen)) for p in rows["pid"].to_pylist()])
    n = len(seen)

    def column(name: str) -> np.ndarray:
        return rows[name].to_numpy()

    def summed(name: str) -> np.ndarray:
        out = np.zeros(n, np.int64)
        np.add.at(out, node, column(name))
        return out

    depth, size, least = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, NONE)
    depth[node], size[node] = column("depth"), column("size")
    np.minimum.at(least, node, rows["conv_id"].combine_chunks().fill_null(NONE).to_numpy())
    shard, side = column("shard"), column("side")
    on_first, on_last = np.zeros(n, bool), np.zeros(n, bool)
    if not last:
        on_first[node[(shard == shard[0]) & (side & 1 > 0)]] = True
        on_last[node[(shard == shard[-1]) & (side & 2 > 0)]] = True
    more = tuple(summed(c) for c in ("n_children", "n_leaves", "saved_tokens"))
    pid = {k: p for p, k in seen.items()}
    return _parts(int(shard[0]) // fan, depth, size, summed("n_convs"), least, more, on_first, on_last, pid, [None] * n, [None] * n)


def turn_sequences(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``: an array of (hash, code points) in the order of ``turn``, null first."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    hashed = turns.where("conv_id IS NOT NULL").select(
        "conv_id", F.struct("turn", F.unhex(F.substring(whole, 1, 2 * WIDTH)).alias("h"), F.length(text).alias("n")).alias("t")
    )
    ordered = hashed.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["h"].alias("h"), t["n"].alias("n"))).alias("turns"))


def _ends_sha(rows: DataFrame) -> DataFrame:
    """SHA-256 of the members of a node from the texts of its shards, read in order one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, running = None, None
        for batch in batches:
            done = []
            for p, text in zip(batch.column("pid").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if p == pid:
                    running.update(b",")
                else:
                    if running:
                        done.append((pid, running.hexdigest()))
                    pid, running = p, hashlib.sha256()
                running.update(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], names=["pid", "sha"])
        if running:
            yield pa.RecordBatch.from_arrays([pa.array([pid], pa.binary()), pa.array([running.hexdigest()])], names=["pid", "sha"])

    dealt = rows.select("pid", "shard", "ends").repartition("pid").sortWithinPartitions("pid", "shard")
    return dealt.mapInArrow(run, "pid binary, sha string")


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS, fan: int = FAN, shards: int | None = None) -> DataFrame:
    """``sequences`` (``conv_id`` a whole number, once each; ``turns`` as of
    ``turn_sequences``) to one row per node, ``NODES``. ``shards`` overrides their number."""
    spark = ready(sequences.sparkSession)
    keyed = written(
        sequences.select(
            F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["h"])), "")).alias("key"),
            F.transform("turns", lambda t: t["n"]).alias("sizes"),
            F.col("conv_id").cast("long").alias("conv_id"),
        ),
        "sequences",
    )
    if not shards:
        turns = keyed.agg(F.sum(F.size("sizes"))).first()[0] or 0
        shards = max(-(-turns // shard_turns), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from shard_parts(TaskContext.get().partitionId(), pa.Table.from_batches(held)).to_batches()

    ranged = keyed.repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = written(ranged.mapInArrow(run, PARTS), "shards")
    spine0 = parts.where("side > 0")
    spine, complete = spine0, []
    left = (spine0.agg(F.max("shard")).first()[0] or 0) + 1
    while True:
        last = left <= fan
        step = spine.withColumn("_group", F.expr(f"shard div {fan}")).groupBy("_group")
        merged = written(step.applyInArrow(_merge(fan, last), PARTS), "spines")
        complete.append(merged.where("side = 0"))
        if last:
            break
        spine, left = merged.where("side > 0"), -(-left // fan)
    upper = complete[0]
    for more in complete[1:]:
        upper = upper.unionByName(more)

    known = upper.select("pid", F.col("conv_id").alias("known"))
    above = known.withColumnRenamed("pid", "parent_pid")
    columns = [c.split()[0] for c in NODES.split(", ")]
    shas = _ends_sha(spine0.where("ends IS NOT NULL"))
    top = upper.drop("ends_sha256").join(above, "parent_pid", "left").join(shas, "pid", "left").select(
        *[
            F.coalesce("parent_conv_id", "known").alias(c) if c == "parent_conv_id" else F.coalesce("sha", F.lit(NO_ENDS)).alias(c) if c == "ends_sha256" else F.col(c)
            for c in columns
        ]
    )
    lower = parts.where("side = 0")
    # A parent on the spine is fetched by shard: the root's children are dealt out by it.
    by_shard = spine0.select("shard", "pid").join(known, "pid").withColumnRenamed("pid", "parent_pid")
    hanging = lower.where("parent_pid IS NOT NULL").drop("parent_conv_id").join(by_shard, ["shard", "parent_pid"])
    hanging = hanging.withColumnRenamed("known", "parent_conv_id").select(*columns)
    return lower.where("parent_pid IS NULL").select(*columns).unionByName(hanging).unionByName(top)


def _merge(fan: int, last: bool):
    def run(rows: pa.Table) -> pa.Table:
        return merged_parts(rows.drop_columns(["_group"]), fan, last)

    return run
