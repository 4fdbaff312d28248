"""The trie of all prefixes of rebuilt conversations, with sharing and savings of each node.

Conversation c is rebuilt from the first h turns of conversation c - c % 5 and its own turns after its first h, where
h = crc32(decimal c) % 9. Turns become 16-byte digests in Spark, so texts are never shuffled; a conversation is a path
of digests. Copies of a path fold to one row with their number, and the paths are dealt to shards by range.

A shard writes the trie of its paths as balanced parentheses. Blocks of the excess with their minima, in a binary tree,
give the closing parenthesis of each node (``find_close``) and so its subtree; ranks count the leaf pairs ``()`` inside,
and differences of running sums in preorder give members and savings. Only nodes on the first or last path of a shard
can occur in another one as well: these two spines of each shard are merged in one small trie, and nodes right below a
spine look up their parent there.

Turns go by ``turn``, null first; turns of one number by role, then by the digest of role and text. Null role and text
are ''. Repeated rows are repeated turns. Rows without a conv_id belong to no conversation and are left out. Other
columns are not read. An empty table gives no rows. A worker holds the digests of one conversation and the paths of one
shard; the task that merges holds two paths a shard. The ids that end at one node are hashed in order, as a stream of
sorted blocks.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimspan.llm.common import written

#: Conversations of one family share the head of the first one; at most HEAD - 1 turns of it.
FAMILY, HEAD = 5, 9
#: Bytes of paths in a shard.
SHARD = 16 << 20
#: Ids of one block of a node's ends are within 2^BLOCK_BITS of each other.
BLOCK_BITS = 16
#: Positions under one minimum of the excess.
MIN_MAX_BLOCK = 64

_WIDTH = 16
_NO_ENDS = hashlib.sha256(b"").hexdigest()
_NOBODY = np.iinfo(np.int64).max

RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_PATHS = "conv_id long, path binary, sizes binary"
_SHARDS = (
    RESULT + ", parent_key binary, path binary, sizes array<long>, members array<long>, least array<long>, "
    "children array<long>, leaves array<long>, saved array<long>, ends array<string>"
)
_SPINES = RESULT + ", node_key binary"
_COLUMNS = [c.split()[0] for c in RESULT.split(", ")]


# ---------------------------------------------------------------- paths


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of rebuilt conversations, from turns in order of family, its first conversation first."""
    ids, paths, sizes, held = [], [], [], 0
    base = conv = None
    head = own = (bytearray(), array("q"))

    def finish() -> None:
        nonlocal held
        h = zlib.crc32(str(conv).encode()) % HEAD
        path = bytes(head[0][: h * _WIDTH] + own[0][h * _WIDTH :])
        ids.append(conv)
        paths.append(path)
        sizes.append((head[1][:h] + own[1][h:]).tobytes())
        held += len(path)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(paths, pa.binary()), pa.array(sizes, pa.binary())],
                                          names=["conv_id", "path", "sizes"])

    for batch in batches:
        for b, c, digest, size in zip(*(batch.column(n).to_pylist() for n in ("base", "conv_id", "digest", "size"))):
            if c != conv:
                if conv is not None:
                    finish()
                if b != base:
                    base, head = b, (bytearray(), array("q"))
                conv, own = c, (bytearray(), array("q"))
                if c == b:
                    head = own
            own[0].extend(digest)
            own[1].append(size)
        if held > 1 << 20:
            yield out()
            ids, paths, sizes, held = [], [], [], 0
    if conv is not None:
        finish()
    if ids:
        yield out()


def paths_of(conversations: DataFrame) -> DataFrame:
    """conv_id, path (a digest a turn) and sizes (UTF-8 bytes a turn, 8 bytes each) of the rebuilt conversations."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, _WIDTH).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    ).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    ordered = turns.repartition("base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "role", "digest"
    )
    return ordered.select("base", "conv_id", "digest", "size").mapInArrow(_rebuild, _PATHS)


# ---------------------------------------------------------------- balanced parentheses


class MinMaxTree:
    """Minima of the excess over blocks, and over pairs of blocks up to one root."""

    def __init__(self, excess: np.ndarray, block: int = MIN_MAX_BLOCK):
        self.block, n = block, -(-len(excess) // block)
        top = np.iinfo(excess.dtype).max
        self.excess = np.full(n * block, top, excess.dtype)
        self.excess[: len(excess)] = excess
        self.levels = [self.excess.reshape(n, block).min(1)]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            if len(low) % 2:
                low = self.levels[-1] = np.append(low, top)
            self.levels.append(low.reshape(-1, 2).min(1))

    def _scan(self, at: np.ndarray, goal: np.ndarray, found: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Go right from each place to the end of its block; returns the rows that found nothing there."""
        home, nothing = at // self.block, [rows[:0]]
        while len(rows):
            hit = self.excess[at] == goal[rows]
            found[rows[hit]] = at[hit]
            at, home, rows = at[~hit] + 1, home[~hit], rows[~hit]
            inside = at // self.block == home
            nothing.append(rows[~inside])
            at, home, rows = at[inside], home[inside], rows[inside]
        return np.concatenate(nothing)

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """For each opening place the first later one whose excess is one less."""
        goal = self.excess[opens] - 1
        found = np.full(len(opens), -1, np.int64)
        rows = np.arange(len(opens))
        last = (opens + 1) % self.block == 0  # nothing more in its block
        rows = np.concatenate([rows[last], self._scan(opens[~last] + 1, goal, found, rows[~last])])
        # Up: the next block whose minimum is low enough, under the lowest node that has one.
        node, at_level, level = opens[rows] // self.block + 1, np.zeros(len(rows), np.int64), 0
        active = np.arange(len(rows))
        while len(active):
            low = self.levels[level]
            hit = low[np.minimum(node[active], len(low) - 1)] <= goal[rows[active]]
            right = active[~hit & (node[active] % 2 == 0)]  # its right neighbour has the same parent
            next_hit = low[np.minimum(node[right] + 1, len(low) - 1)] <= goal[rows[right]]
            node[right[next_hit]] += 1
            done = np.concatenate([active[hit], right[next_hit]])
            at_level[done] = level
            active = np.setdiff1d(active, done, assume_unique=True)
            node[active] = node[active] // 2 + 1
            level += 1
        # Down: the left child where it is low enough.
        for level in range(len(self.levels) - 1, 0, -1):
            some = np.flatnonzero(at_level == level)
            child = 2 * node[some]
            node[some] = child + (self.levels[level - 1][child] > goal[rows[some]])
            at_level[some] = level - 1
        self._scan(node * self.block, goal, found, rows)
        return found


def least_in_ranges(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The minimum of each range, with one doubled level of minima at a time."""
    out = np.empty(len(begin), values.dtype)
    level = np.frexp((end - begin).astype(np.float64))[1] - 1
    for k in range(int(level.max(initial=-1)) + 1):
        some = np.flatnonzero(level == k)
        out[some] = np.minimum(values[begin[some]], values[end[some] - (1 << k)])
        if len(values) > 1 << k:
            values = np.minimum(values[: -(1 << k)], values[1 << k :])
    return out


def _shared(a: bytes, b: bytes) -> int:
    """The number of first turns that two paths have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // _WIDTH
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // _WIDTH


def _keys(path: bytes) -> list[bytes]:
    """A key of each prefix of a path, the empty one first."""
    h, out = hashlib.sha256(), [hashlib.sha256().digest()[:_WIDTH]]
    for k in range(0, len(path), _WIDTH):
        h.update(path[k : k + _WIDTH])
        out.append(h.copy().digest()[:_WIDTH])
    return out


class Trie:
    """The trie of distinct paths in ascending order, by preorder number; 0 is the root."""

    def __init__(self, paths: list[bytes], sizes: list[np.ndarray], copies: np.ndarray, least: np.ndarray):
        depth = np.array([len(p) // _WIDTH for p in paths], np.int64)
        shared = np.array([0, *map(_shared, paths, paths[1:])], np.int64)
        opened = depth - shared
        counts = np.empty(2 * len(paths), np.int64)  # opened and closed in turn, the root around all
        counts[0::2], counts[1::2] = opened, np.append(depth[:-1] - shared[1:], depth[-1] + 1)
        counts[0] += 1
        opening = np.repeat(np.arange(len(counts)) % 2 == 0, counts)
        excess = np.cumsum(np.where(opening, 1, -1)).astype(np.int32)
        opens = np.flatnonzero(opening)
        close = MinMaxTree(excess).find_close(opens)
        rank = np.cumsum(opening)
        self.n, self.first_depth = len(opens), int(depth[0])
        self.begin, self.end = np.arange(self.n), rank[close]
        self.depth = excess[opens].astype(np.int64) - 1
        # Leaf pairs: an opening parenthesis followed by its closing one.
        self.leaf = ~opening[opens + 1]
        self._pairs = opening & np.append(~opening[1:], False)
        self._opens, self._close = opens, close
        self.size = np.concatenate([[0], *(s[k:] for s, k in zip(sizes, shared))]).astype(np.int64)
        self.ends = np.cumsum(opened)  # the node at which each path ends
        weight, low = np.zeros(self.n, np.int64), np.full(self.n, _NOBODY, np.int64)
        weight[self.ends], low[self.ends] = copies, least
        self.members = self.inside(weight)
        self.least = least_in_ranges(low, self.begin, self.end)
        # The parent is the last node before that is one less deep.
        key = np.sort(self.depth * self.n + self.begin)
        goal = (self.depth[1:] - 1) * self.n + self.begin[1:]
        self.parent = np.append(-1, key[np.searchsorted(key, goal) - 1] % self.n)
        self.saved = (self.members - 1) * self.size

    def inside(self, values: np.ndarray) -> np.ndarray:
        """The sum over each node's subtree."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.end] - total[self.begin]

    def leaves(self, counted: np.ndarray) -> np.ndarray:
        """Leaf pairs inside each subtree, of the nodes that are ``counted``."""
        pairs = self._pairs.copy()
        pairs[self._opens[~counted]] = False
        rank = np.cumsum(pairs)
        return rank[self._close] - rank[self._opens] + pairs[self._opens]

    def children(self, counted: np.ndarray) -> np.ndarray:
        return np.bincount(self.parent[1:][counted[1:]], minlength=self.n)


# ---------------------------------------------------------------- shards


def _read_shard(batches: Iterator[pa.RecordBatch]):
    """Distinct paths, sizes, copies, least ids and hashes of ids of a shard; rows are in order of path and block."""
    paths, sizes, copies, least, hashes = [], [], [], [], []
    for batch in batches:
        for path, size, n, low, ids in zip(*(batch.column(c).to_pylist() for c in ("path", "sizes", "n", "low", "ids"))):
            if paths and paths[-1] == path:
                copies[-1] += n
                hashes[-1].update(b",")
            else:
                paths.append(path)
                sizes.append(np.frombuffer(size, "<i8"))
                copies.append(n)
                least.append(low)
                hashes.append(hashlib.sha256())
            hashes[-1].update(ids.encode())
    return paths, sizes, copies, least, [h.hexdigest() for h in hashes]


def _rows(columns: dict[str, pa.Array], n: int, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)


def _shard_schema() -> pa.Schema:
    long, text = pa.int64(), pa.string()
    plain = [(c, text if c == "ends_sha256" else long) for c in _COLUMNS]
    lists = [(c, pa.list_(long)) for c in ("sizes", "members", "least", "children", "leaves", "saved")]
    return pa.schema([*plain, ("parent_key", pa.binary()), ("path", pa.binary()), *lists, ("ends", pa.list_(text))])


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard that no other shard has, and its first and last path with what lies off them."""
    paths, sizes, copies, least, hashes = _read_shard(batches)
    if not paths:
        return
    trie, schema = Trie(paths, sizes, np.array(copies), np.array(least)), _shard_schema()
    first = trie.begin <= trie.first_depth
    last = trie.end == trie.n
    spine = first | last
    off = ~spine
    ends = np.full(trie.n, None, object)
    ends[trie.ends] = hashes

    known = {"members": trie.members, "least": trie.least, "children": trie.children(off), "leaves": trie.leaves(off),
             "saved": trie.inside(np.where(off, trie.saved, 0)), "sizes": trie.size, "ends": ends}
    spines = [(paths[0], np.flatnonzero(first), None)]
    if len(paths) > 1:  # what the first path has already is not counted again
        spines.append((paths[-1], np.flatnonzero(last), first))
    rows = {name: [] for name in known}
    for _, nodes, counted in spines:
        for name, values in known.items():
            part = values[nodes].copy()
            if counted is not None and name != "sizes":
                part[counted[nodes]] = None if name == "ends" else _NOBODY if name == "least" else 0
            rows[name].append(part.tolist())
    yield _rows({"path": pa.array([p for p, _, _ in spines], pa.binary())} | {n: pa.array(v, schema.field(n).type) for n, v in rows.items()}, len(spines), schema)

    nodes = np.flatnonzero(off)
    parent = trie.parent[nodes]
    below = spine[parent]
    keys = np.full(len(nodes), None, object)
    on_first = below & first[parent]
    names_first, names_last = _keys(paths[0]), _keys(paths[-1])
    keys[on_first] = [names_first[d] for d in trie.depth[parent[on_first]]]
    on_last = below & ~first[parent]
    keys[on_last] = [names_last[d] for d in trie.depth[parent[on_last]]]
    every = np.ones(trie.n, bool)
    columns = {
        "conv_id": pa.array(trie.least[nodes]), "depth": pa.array(trie.depth[nodes]),
        "parent_conv_id": pa.array(trie.least[parent], mask=below), "n_convs": pa.array(trie.members[nodes]),
        "n_children": pa.array(trie.children(every)[nodes].astype(np.int64)), "n_leaves": pa.array(trie.leaves(every)[nodes].astype(np.int64)),
        "saved_tokens": pa.array(trie.inside(trie.saved)[nodes]), "parent_key": pa.array(keys, pa.binary()),
        "ends_sha256": pa.array(np.where(ends[nodes] == None, _NO_ENDS, ends[nodes]), pa.string()),  # noqa: E711
    }
    whole = _rows(columns, len(nodes), schema)
    for k in range(0, len(nodes), 50_000):
        yield whole.slice(k, 50_000)


# ---------------------------------------------------------------- spines


def _merge(rows: pa.Table) -> pa.Table:
    """The nodes of all spines: sums over shards, with what lies off the spines added up from the deepest node."""
    names = ("path", "sizes", "members", "least", "children", "leaves", "saved", "ends")
    spines = sorted(zip(*(rows.column(n).to_pylist() for n in names)), key=lambda r: r[0])
    done: list[dict] = []
    stack: list[dict] = []

    def close() -> None:
        node = stack.pop()
        # What a shard counted off its spines is already in all nodes above; only the spines' own nodes are added up.
        node["own_saved"] += (node["members"] - 1) * node["size"]
        node["own_leaves"] += node["children"] == 0
        node["saved"] += node["own_saved"]
        node["leaves"] += node["own_leaves"]
        node["parent"] = None
        for child in node.pop("below"):
            child["parent"] = node["least"]
        if stack:
            up = stack[-1]
            up["own_saved"] += node["own_saved"]
            up["own_leaves"] += node["own_leaves"]
            up["children"] += 1
            up["below"].append(node)
        done.append(node)

    before = b""
    for path, sizes, members, least, children, leaves, saved, ends in spines:
        keys, same = _keys(path), _shared(before, path)
        while len(stack) > same + 1:
            close()
        for d, key in enumerate(keys):
            if d == len(stack):
                stack.append({"key": key, "depth": d, "size": sizes[d], "members": 0, "least": _NOBODY, "children": 0,
                              "leaves": 0, "saved": 0, "own_leaves": 0, "own_saved": 0, "ends": None, "below": []})
            node = stack[d]
            node["members"] += members[d]
            node["least"] = min(node["least"], least[d])
            node["children"] += children[d]
            node["leaves"] += leaves[d]
            node["saved"] += saved[d]
            node["ends"] = node["ends"] or ends[d]
        before = path
    while stack:
        close()
    sources = ("least", "depth", "parent", "members", "children", "leaves", "saved")
    out = {c: pa.array([node[s] for node in done], pa.int64()) for c, s in zip(_COLUMNS, sources)}
    out["ends_sha256"] = pa.array([node["ends"] or _NO_ENDS for node in done], pa.string())
    return pa.table(out | {"node_key": pa.array([node["key"] for node in done], pa.binary())})


def nodes(conversations: DataFrame, shard_bytes: int = SHARD) -> DataFrame:
    """Per node of the trie: its smallest member, depth, the parent's smallest member, members, children, leaves and
    savings of its subtree, and the hash of the ids that end there."""
    spark = conversations.sparkSession
    ids = F.sort_array(F.collect_list("conv_id"))
    folded = paths_of(conversations).groupBy("path", F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("low"),
        F.array_join(ids.cast("array<string>"), ",").alias("ids"),
    )
    folded = written(folded, "trie-paths")
    total = folded.agg(F.coalesce(F.sum(F.length("path")), F.lit(0))).first()[0]
    n_shards = max(spark.sparkContext.defaultParallelism, -(-total // shard_bytes))
    in_order = folded.repartitionByRange(n_shards, "path").sortWithinPartitions("path", "block")
    shards = written(in_order.select("path", "sizes", "n", "low", "ids").mapInArrow(_shard, _SHARDS), "trie-shards")
    # Two rows a shard, in one group.
    spines = shards.where("path is not null").withColumn("one", F.lit(True)).groupBy("one").applyInArrow(_merge, _SPINES)
    spines = written(spines, "trie-spines")
    inner = shards.where("path is null and parent_key is null").select(*_COLUMNS)
    below = shards.where("parent_key is not null").drop("parent_conv_id")
    parents = spines.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    below = below.join(parents, "parent_key").select(*_COLUMNS)
    return spines.select(*_COLUMNS).unionByName(inner).unionByName(below)
