"""The prefix trie of conversations as balanced parentheses, shard by shard.

1. Every turn becomes a 16-byte digest of role and text; a conversation is the
   digests of its turns one after the other, its path.  Texts are read once and
   not moved.  Equal paths are one row with a count.
2. Paths are put in ranges of their byte order, the shards.  A shard's trie is
   its sorted paths' parentheses: going from one path to the next closes the
   nodes below their common prefix and opens the new ones.
3. In a shard, ``findclose`` over blocks of least excess delimits every subtree;
   counts of leaf pairs, of conversations and of savings are then differences
   of cumulative arrays.
4. Nodes that a shard shares with the one before or behind, its spine, have
   their numbers summed over shards; the spines together are a trie of their
   own, whose parentheses give what their subtrees save.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeloom.llm.common import written

WIDTH = 16  # bytes of a turn's digest
CHARS = 4  # bytes of a turn's number of code points
NO_ENDS = hashlib.sha256(b"").hexdigest()
# Turns, or ids, that are packed into one row at most.
PIECE = 1 << 16


class Parentheses:
    """A balanced sequence of 1 (open) and -1 (close), with the least excess of every block, and of 2, 4, 8, ... blocks."""

    BLOCK = 64

    def __init__(self, signs: np.ndarray):
        self.excess = np.cumsum(signs, dtype=np.int64)
        n = -(-len(signs) // self.BLOCK)
        padded = np.full(n * self.BLOCK, np.iinfo(np.int64).max)
        padded[: len(signs)] = self.excess
        self.levels = [padded.reshape(n, self.BLOCK).min(axis=1)]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            low = np.append(low, [np.iinfo(np.int64).max] * (len(low) % 2))
            self.levels.append(low.reshape(-1, 2).min(axis=1))

    def _within(self, start: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """Per start the first place from there to the end of its block whose excess is the goal, or -1."""
        out = np.full(len(start), -1)
        left, at = np.arange(len(start)), start.copy()
        while len(left):
            inside = at < len(self.excess)
            left, at = left[inside], at[inside]
            found = self.excess[at] == goal[left]
            out[left[found]] = at[found]
            left, at = left[~found], at[~found] + 1
            inside = at % self.BLOCK != 0
            left, at = left[inside], at[inside]
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where the parentheses that open at these places close: the next place with an excess less by 1."""
        goal = self.excess[opens] - 1
        close = np.full(len(opens), -1)
        here = (opens + 1) % self.BLOCK != 0
        close[here] = self._within(opens[here] + 1, goal[here])
        left = np.flatnonzero(close < 0)
        node = opens[left] // self.BLOCK + 1  # climb until a node's least excess is low enough, then go down again
        for level, least in enumerate(self.levels):
            if not len(left):
                break
            low = (node < len(least)) & (least[np.minimum(node, len(least) - 1)] <= goal[left])
            block = node[low]
            for below in range(level - 1, -1, -1):
                block = 2 * block
                block += self.levels[below][block] > goal[left[low]]
            close[left[low]] = self._within(block * self.BLOCK, goal[left[low]])
            left, node = left[~low], node[~low]
            node = (node + 1) // 2  # all before it at this level are done
        return close


def parentheses(depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a forest's depths in preorder: the place where each node opens, and the whole sequence."""
    n = len(depth)
    closes = np.maximum(np.concatenate(([0], depth[:-1] - depth[1:] + 1)), 0)
    opens = np.arange(n) + np.cumsum(closes)
    signs = np.full(2 * n, -1, np.int8)
    signs[opens] = 1
    return opens, signs


def subtree_sizes(depth: np.ndarray) -> np.ndarray:
    """Nodes of each subtree, from the depths in preorder."""
    opens, signs = parentheses(depth)
    return (Parentheses(signs).findclose(opens) - opens + 1) // 2


def _over(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of runs of values."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[start + size] - total[start]


def _parents(depth: np.ndarray) -> np.ndarray:
    """Per node in preorder its parent, or -1."""
    stack: list[int] = []
    parents = np.arange(len(depth)) - 1  # most nodes follow their parent
    for v in np.flatnonzero(np.diff(depth, prepend=depth[:1] - 1) <= 0):
        parents[v] = -2
    for v, (d, p) in enumerate(zip(depth.tolist(), parents.tolist(), strict=True)):
        del stack[d - depth[0] :]
        if p == -2:
            parents[v] = stack[-1] if stack else -1
        stack.append(v)
    return parents


class Paths:
    """Sorted distinct paths, as pairs of 64-bit halves of their turns' digests."""

    def __init__(self, paths: list[bytes]):
        self.sizes = np.array([len(p) // WIDTH for p in paths], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.turns = np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2)

    def common(self) -> np.ndarray:
        """Per path the turns that it shares with the one before; -1 for the first."""
        shared = np.zeros(len(self.sizes), np.int64)
        most = np.minimum(self.sizes[1:], self.sizes[:-1])
        left = np.flatnonzero(most > 0) + 1
        depth = 0
        while len(left):
            same = (self.turns[self.starts[left - 1] + depth] == self.turns[self.starts[left] + depth]).all(axis=1)
            depth += 1
            left = left[same]
            shared[left] = depth
            left = left[most[left - 1] > depth]
        shared[0] = -1
        return shared


def _shared_turns(a: bytes | None, b: bytes) -> int:
    """Turns that two paths begin with both; -1 if there is no first one."""
    if a is None:
        return -1
    n = min(len(a), len(b)) // WIDTH
    x, y = (np.frombuffer(p[: n * WIDTH], np.uint64).reshape(-1, 2) for p in (a, b))
    different = np.flatnonzero((x != y).any(axis=1))
    return int(different[0]) if len(different) else n


def _prefix_keys(path: bytes, depth: int) -> list[bytes]:
    """Keys of the prefixes of 0 to ``depth`` turns."""
    so_far = hashlib.sha256()
    keys = [so_far.digest()]
    for at in range(depth):
        so_far.update(path[at * WIDTH : (at + 1) * WIDTH])
        keys.append(so_far.copy().digest())
    return keys


NODES = (
    "shard int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, chars long, ends string"
)
_LONGS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "chars")
_NODES_ARROW = pa.schema(
    [("shard", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary())] + [(c, pa.int64()) for c in _LONGS] + [("ends", pa.string())]
)


def _shard(rows: pa.Table, bounds: pa.Table) -> pa.Table:
    """All nodes of one shard's paths; those of the spine have a key, and the numbers of this shard."""
    if not rows.num_rows:
        return _NODES_ARROW.empty_table()
    rows = rows.sort_by("path")
    bytes_of = rows.column("path").to_pylist()
    paths = Paths(bytes_of)
    common = paths.common()
    new = paths.sizes - common
    first = np.cumsum(new) - new  # of a path's new nodes
    path = np.repeat(np.arange(len(new)), new)
    depth = np.arange(len(path)) - first[path] + common[path] + 1
    last = first + new - 1  # where a path ends
    sizes = subtree_sizes(depth)
    start = np.arange(len(depth))
    parent = _parents(depth)

    before = _shared_turns(bounds.column("before")[0].as_py(), bytes_of[0])
    after = _shared_turns(bounds.column("after")[0].as_py(), bytes_of[-1])
    spine = np.zeros(len(depth), bool)
    spine[0] = True  # the root
    spine[1 : before + 1] = True
    right, v = [], int(last[-1])
    while v >= 0:
        right.append(v)
        v = int(parent[v])
    right.reverse()
    spine[right[: after + 1]] = True

    ending = np.zeros(len(depth), np.int64)
    ending[last] = np.asarray(rows.column("n"))
    n_convs = _over(ending, start, sizes)
    leaf = (sizes == 1) & ~spine
    chars = np.zeros(len(depth), np.int64)
    of_turns = np.frombuffer(b"".join(rows.column("chars").to_pylist()), np.uint32)
    below = depth > 0
    chars[below] = of_turns[(paths.starts[path] + depth - 1)[below]]
    own = np.where(spine, 0, (n_convs - 1) * chars)
    spans = _over((ending > 0).astype(np.int64), start, sizes)
    edges = np.stack([path, path + spans], axis=1).ravel()
    smallest = np.append(np.asarray(rows.column("conv_id")), np.iinfo(np.int64).max)
    conv_id = np.minimum.reduceat(smallest, edges)[::2]
    inner = parent[1:][~spine[1:]]
    children = np.bincount(inner, minlength=len(depth))
    of_spine = np.concatenate(([False], spine[parent[1:]])) & ~spine

    keys: list[bytes | None] = [None] * len(depth)
    for chain, deepest in ((list(range(max(before, 0) + 1)), max(before, 0)), (right, max(after, 0))):
        source = bytes_of[0] if chain is not right else bytes_of[-1]
        for v, key in zip(chain, _prefix_keys(source, deepest), strict=False):
            keys[v] = key
    ends: list[str | None] = [None] * len(depth)
    for v, x in zip(last.tolist(), rows.column("ends").to_pylist(), strict=True):
        ends[v] = x
    parent_keys = [keys[p] if o else None for p, o in zip(parent.tolist(), of_spine.tolist(), strict=True)]
    known = ~(of_spine | spine)
    return pa.table(
        {
            "shard": pa.array(np.full(len(depth), rows.column("shard")[0].as_py()), pa.int32()),
            "key": pa.array(keys, pa.binary()),
            "parent_key": pa.array(parent_keys, pa.binary()),
            "conv_id": conv_id,
            "depth": depth,
            "parent_conv_id": pa.array(conv_id[parent], pa.int64(), mask=~known),
            "n_convs": n_convs,
            "n_children": children,
            "n_leaves": _over(leaf.astype(np.int64), start, sizes),
            "saved_tokens": _over(own, start, sizes),
            "chars": chars,
            "ends": pa.array(ends, pa.string()),
        },
        schema=_NODES_ARROW,
    )


def _merged(rows: pa.Table) -> pa.Table:
    """The spines of all shards as one trie; a node's first shard and its depth give the preorder."""
    rows = rows.sort_by([("shard", "ascending"), ("depth", "ascending")])
    keys = rows.column("key").combine_chunks().dictionary_encode()
    group = np.asarray(keys.indices)
    n = len(keys.dictionary)
    head = np.unique(group, return_index=True)[1]
    depth = np.asarray(rows.column("depth"))[head]
    total = {}
    for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
        total[c] = np.zeros(n, np.int64)
        np.add.at(total[c], group, np.asarray(rows.column(c)))
    conv_id = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(conv_id, group, np.asarray(rows.column("conv_id")))
    ends: list[str | None] = [None] * n
    for g, x in zip(group.tolist(), rows.column("ends").to_pylist(), strict=True):
        ends[g] = x or ends[g]
    chars = np.asarray(rows.column("chars"))[head]
    parent = _parents(depth)
    children = total["n_children"] + np.bincount(parent[1:], minlength=n)
    saved = total["saved_tokens"] + _over((total["n_convs"] - 1) * chars, np.arange(n), subtree_sizes(depth))
    return pa.table(
        {
            "shard": pa.nulls(n, pa.int32()),
            "key": keys.dictionary,
            "parent_key": pa.nulls(n, pa.binary()),
            "conv_id": conv_id,
            "depth": depth,
            "parent_conv_id": pa.array(conv_id[parent], pa.int64(), mask=parent < 0),
            "n_convs": total["n_convs"],
            "n_children": children,
            "n_leaves": np.maximum(total["n_leaves"], 1),  # a root without turns is a leaf
            "saved_tokens": saved,
            "chars": chars,
            "ends": pa.array(ends, pa.string()),
        },
        schema=_NODES_ARROW,
    )


def _packed_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> a row per conversation and at most ``PIECE`` turns: digests and numbers of code points."""
    for conv, part, piece, rows in _pieces(batches, "conv_id"):
        digests = [b"".join(r.column("digest").to_pylist()) for r in rows]
        chars = [np.asarray(r.column("chars")).astype(np.uint32).tobytes() for r in rows]
        yield pa.RecordBatch.from_pydict(
            {
                "conv_id": pa.array([conv], pa.int64()),
                "part": pa.array([part], pa.int32()),
                "piece": pa.array([piece], pa.int32()),
                "path": pa.array([b"".join(digests)], pa.binary()),
                "chars": pa.array([b"".join(chars)], pa.binary()),
            }
        )


def _pieces(batches: Iterator[pa.RecordBatch], key_col: str):
    """(key, partition, number of the piece, its rows) of rows sorted by key."""
    key, part, piece, held, size = None, 0, 0, [], 0
    for batch in batches:
        keys = batch.column(key_col)
        values = keys.to_pylist()
        cuts = [i for i in range(1, len(values)) if values[i] != values[i - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(values)], strict=True):
            if a == b:
                continue
            if held and (values[a] != key or size >= PIECE):
                yield key, part, piece, held
                piece = piece + 1 if values[a] == key else 0
                held, size = [], 0
            key, part = values[a], batch.column("part")[a].as_py()
            held.append(batch.slice(a, b - a))
            size += b - a
    if held:
        yield key, part, piece, held


def _packed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids -> a row per path and at most ``PIECE`` ids: their decimals, comma-joined."""
    for key, part, piece, rows in _pieces(batches, "key"):
        ids = ",".join(str(x) for r in rows for x in r.column("conv_id").to_pylist())
        yield pa.RecordBatch.from_pydict(
            {
                "key": pa.array([key], pa.binary()),
                "part": pa.array([part], pa.int32()),
                "piece": pa.array([piece], pa.int32()),
                "ids": pa.array([ids], pa.string()),
            }
        )


def _digested_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by key, partition and number -> per key the running digest of all its ids."""
    key, digest, out = None, None, ([], [])
    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if k == key:
                digest.update(b"," + ids.encode())
                continue
            if digest:
                out[0].append(key)
                out[1].append(digest.hexdigest())
            key, digest = k, hashlib.sha256(ids.encode())
        if len(out[0]) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1])], ["key", "ends"])
            out = ([], [])
    if digest:
        out[0].append(key)
        out[1].append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1])], ["key", "ends"])


def _sorted_parts(rows: DataFrame, *keys) -> DataFrame:
    """Ranges of the keys, sorted, each row with the number of its range."""
    return rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*keys)


def _joined(pieces: Column, field: str) -> Column:
    """The binaries of a conversation's pieces as one; most have one piece."""
    one = F.element_at(pieces, 1)[field]
    return F.when(F.size(pieces) == 1, one).otherwise(F.unhex(F.array_join(F.transform(pieces, lambda p: F.hex(p[field])), "")))


def conversation_paths(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Per conversation: conv_id, its turns' digests (path) and numbers of code points (chars), in order of turn.

    Turns are sorted in ranges of (conversation, turn), so that a conversation
    with a third of all turns is sorted by many tasks; each packs what it has.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.substring(F.unhex(F.sha2(named.cast("binary"), 256)), 1, WIDTH).alias("digest"),
        F.length(text).alias("chars"),
    )
    rows = _sorted_parts(rows, "conv_id", F.col("turn").asc_nulls_first(), "digest")
    pieces = rows.drop("turn").mapInArrow(_packed_turns, "conv_id long, part int, piece int, path binary, chars binary")
    found = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "piece", "path", "chars"))).alias("p"))
    return found.select("conv_id", _joined(F.col("p"), "path").alias("path"), _joined(F.col("p"), "chars").alias("chars"))


def rebuilt(paths: DataFrame, hosted: Column, host: Column) -> DataFrame:
    """Paths whose first ``hosted`` turns are those of the conversation ``host`` (its id), if there is one."""
    hosts = paths.select(F.col("conv_id").alias("host"), F.col("path").alias("host_path"), F.col("chars").alias("host_chars"))
    rows = paths.withColumn("h", hosted).withColumn("host", host)
    most = F.lit(WIDTH * MOST_HOSTED)
    hosts = hosts.select("host", F.substring("host_path", F.lit(1), most).alias("host_path"), F.substring("host_chars", 1, CHARS * MOST_HOSTED).alias("host_chars"))
    rows = rows.join(hosts, "host", "left")

    def mixed(theirs: str, own: str, width: int) -> Column:
        n = (F.col("h") * width).cast("int")
        return F.concat(F.substring(F.coalesce(theirs, F.lit(b"")), F.lit(1), n), F.substring(own, n + 1, F.octet_length(own)))

    return rows.select("conv_id", mixed("host_path", "path", WIDTH).alias("path"), mixed("host_chars", "chars", CHARS).alias("chars"))


#: Turns that a conversation takes from its host at most.
MOST_HOSTED = 5


def trie(paths: DataFrame) -> DataFrame:
    """Per node of the trie of all paths (conv_id, path, chars): its numbers, as ``prefix_trie`` returns them."""
    rows = written(paths.withColumn("key", F.substring(F.unhex(F.sha2("path", 256)), 1, WIDTH)), "paths")
    ids = _sorted_parts(rows.select("key", "conv_id"), "key", "conv_id").mapInArrow(_packed_ids, "key binary, part int, piece int, ids string")
    ids = ids.repartition("key").sortWithinPartitions("key", "part", "piece").mapInArrow(_digested_ids, "key binary, ends string")
    once = rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), F.first("path").alias("path"), F.first("chars").alias("chars")
    )
    shards = once.join(ids, "key").drop("key").repartitionByRange("path").withColumn("shard", F.spark_partition_id())
    shards = written(shards, "shards")
    in_order = Window.orderBy("shard")  # a row per shard
    bounds = shards.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    bounds = bounds.select("shard", F.lag("high").over(in_order).alias("before"), F.lead("low").over(in_order).alias("after"))
    nodes = written(shards.groupBy("shard").cogroup(bounds.groupBy("shard")).applyInArrow(_shard, NODES), "nodes")
    spine = nodes.where(F.col("key").isNotNull())
    merged = written(spine.groupBy().applyInArrow(_merged, NODES), "spine")
    names = spine.select("shard", "key").join(merged.select("key", F.col("conv_id").alias("above")), "key")
    names = names.select("shard", F.col("key").alias("parent_key"), "above")
    inner = nodes.where(F.col("key").isNull())
    below = inner.where(F.col("parent_key").isNotNull()).join(names, ["shard", "parent_key"]).withColumn("parent_conv_id", F.col("above"))
    every = inner.where(F.col("parent_key").isNull()).unionByName(below.select(inner.columns)).unionByName(merged)
    return every.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame, hosted: Column | None = None, host: Column | None = None, id_col: str = "conv_id") -> DataFrame:
    """The trie of conversations: a row per distinct sequence of first turns (role, text), the empty one included.

    conv_id (the smallest of the conversations that begin so), depth, its
    parent's conv_id (null for the root), n_convs (how many begin so),
    n_children, n_leaves (childless nodes in the subtree, itself included),
    saved_tokens (sum over the subtree of (n_convs - 1) times the code points of
    the node's last text), ends_sha256 (digest of the ascending ids of those
    that are no longer).  With ``hosted`` and ``host``, columns over conv_id,
    every conversation's first turns are those of its host, at most
    ``MOST_HOSTED``.

    Turns are read in order of ``turn``, null first, ties by a digest of role
    and text; equal rows are turns of their own.  Null role and text are empty.
    Rows without conversation id are left out.  An empty table gives no rows.
    Other columns are not read, so their names cannot clash.

    A conversation is one row of 20 bytes a turn from step 2 on, whatever its
    texts hold; a row ends at 2 GB, 100 million turns.  The spines that one task
    merges have a row per shard and turn that it shares with its neighbours.
    """
    paths = written(conversation_paths(turns, id_col), "conversations")
    if host is not None:
        paths = rebuilt(paths, hosted, host)
    return trie(paths)
