"""A prefix trie over conversations, built from ternary search trees per range shard.

Turns are encoded by a dictionary, conversations become lists of turn ids, and equal lists are counted once. The distinct
lists are range-partitioned in their lexicographic order, so that a shard holds neighbouring paths of the trie. A task puts
its lists into ternary search trees (a bounded number of turns each; the median of a stretch goes in first, so the
search trees stay balanced) and walks them with a stack of its own. Nodes that only one shard can have are finished
there. What is left of a shard are the nodes on its first and on its last path; these meet their neighbours in groups of
shards, then groups of groups, until the root is finished too.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.arrow import table
from custlens.session import stage

TREE_TURNS = 200_000  # of a ternary search tree; memory of a task
FAN_IN = 32  # shards whose open paths meet in one task
BASE_OF = 100  # conversations of a block of ids share the first of them
MOST_SHARED = 6

_ROOT = bytes(16)
_FIELDS = [
    ("open", pa.bool_(), "boolean"), ("block", pa.int32(), "int"), ("left", pa.bool_(), "boolean"), ("right", pa.bool_(), "boolean"),
    ("key", pa.binary(), "binary"), ("parent_key", pa.binary(), "binary"), ("chars", pa.int64(), "long"), ("depth", pa.int64(), "long"),
    ("conv_id", pa.int64(), "long"), ("parent_conv_id", pa.int64(), "long"), ("n_convs", pa.int64(), "long"), ("n_children", pa.int64(), "long"),
    ("n_leaves", pa.int64(), "long"), ("saved_tokens", pa.int64(), "long"), ("path", pa.binary(), "binary"),
]
_SCHEMA = pa.schema([(name, kind) for name, kind, _ in _FIELDS])
_COLUMNS = ", ".join(f"{name} {kind}" for name, _, kind in _FIELDS)


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, path, ids, chars``: every conversation with the opening of its block of ids, as lists of turn ids.

    ``path`` is a digest of the ids. Texts go no further than the first projection: a turn is known by its SHA-256 and
    then by its number in the dictionary.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.length(text).alias("chars"),
    )
    dictionary = stage(known.groupBy("digest").agg(F.max("chars").alias("chars")).withColumn("id", F.monotonically_increasing_id()), "turn-dictionary")
    coded = known.drop("chars").join(dictionary, "digest")
    place = F.struct(F.col("turn").isNotNull().alias("a"), F.coalesce("turn", F.lit(0)).alias("b"), F.col("digest").alias("c"), "id", "chars")
    own = stage(coded.groupBy("conv_id").agg(F.array_sort(F.collect_list(place)).alias("t")).select("conv_id", F.col("t.id").alias("ids"), F.col("t.chars").alias("chars")), "conversations")
    first = own.filter(F.col("conv_id") % BASE_OF == 0).select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, MOST_SHARED).alias("base_ids"), F.slice("chars", 1, MOST_SHARED).alias("base_chars")
    )
    shared = (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).cast("int")
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE_OF).join(first, "base", "left")

    def opened(column: str, kind: str):
        opening = F.coalesce(F.slice(f"base_{column}", F.lit(1), shared), F.array().cast(f"array<{kind}>"))
        return F.concat(opening, F.slice(column, shared + 1, F.greatest(F.size(column), F.lit(1)))).alias(column)

    out = joined.select("conv_id", opened("ids", "bigint"), opened("chars", "int"))
    path = F.unhex(F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256))
    return out.select("conv_id", path.alias("path"), "ids", "chars")


class TernaryTree:
    """A ternary search tree over lists of integers. Node 0 is the empty list; a node's links are smaller, next, larger."""

    def __init__(self):
        self.turns, self.chars = [-1], [0]
        self.links = [-1, -1, -1]
        self.ends: dict[int, int] = {}

    def insert(self, ids: list[int], chars: list[int], number: int) -> None:
        turns, links = self.turns, self.links
        node = 0
        for turn, size in zip(ids, chars):
            at = 3 * node + 1
            while (node := links[at]) >= 0 and turns[node] != turn:
                at = 3 * node + (2 if turn > turns[node] else 0)
            if node < 0:
                links[at] = node = len(turns)
                turns.append(turn)
                self.chars.append(size)
                links += (-1, -1, -1)
        self.ends[node] = number

    @classmethod
    def balanced(cls, lists: list[tuple[list[int], list[int]]]) -> TernaryTree:
        """From ascending lists, the median of every stretch before its halves."""
        tree, waiting = cls(), [(0, len(lists))]
        while waiting:
            low, high = waiting.pop()
            if low < high:
                middle = (low + high) // 2
                tree.insert(*lists[middle], middle)
                waiting += [(low, middle), (middle + 1, high)]
        return tree

    def walk(self) -> tuple[list[int], list[int], list[int]]:
        """Nodes with parents before children; parent and depth of each node."""
        parent, depth = [-1] * len(self.turns), [0] * len(self.turns)
        order, waiting = [], [0]
        while waiting:
            node = waiting.pop()
            order.append(node)
            level = [self.links[3 * node + 1]]
            while level:
                child = level.pop()
                if child >= 0:
                    parent[child], depth[child] = node, depth[node] + 1
                    waiting.append(child)
                    level += (self.links[3 * child], self.links[3 * child + 2])
        return order, parent, depth

    def path(self, ids: list[int]) -> list[int]:
        nodes, node = [0], 0
        for turn in ids:
            node = self.links[3 * node + 1]
            while self.turns[node] != turn:
                node = self.links[3 * node + (2 if turn > self.turns[node] else 0)]
            nodes.append(node)
        return nodes


@dataclass
class Open:
    """A node that neighbouring shards may have too. Children, leaves and savings are those of finished children."""

    key: bytes
    parent_key: bytes | None
    chars: int
    depth: int
    least: int
    members: int
    children: int
    leaves: int
    saved: int
    path: bytes | None
    left: bool
    right: bool

    def row(self, block: int) -> tuple:
        return (True, block, self.left, self.right, self.key, self.parent_key, self.chars, self.depth, self.least, None, self.members, self.children, self.leaves, self.saved, self.path)

    def add(self, other: Open) -> None:
        self.least = min(self.least, other.least)
        self.members += other.members
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.path = self.path or other.path
        self.right = other.right  # of the later one


def shard_nodes(lists: list[tuple[list[int], list[int]]], paths: list[bytes], counts: list[int], least: list[int]) -> tuple[list[tuple], dict[bytes, Open]]:
    """Rows of the finished nodes, and the open ones on the first and last path, of ascending distinct lists."""
    tree = TernaryTree.balanced(lists)
    order, parent, depth = tree.walk()
    size = len(order)
    first, last = tree.path(lists[0][0]), tree.path(lists[-1][0])
    left, right = set(first), set(last)
    keys = {0: _ROOT}
    for nodes in (first, last):
        for above, node in zip(nodes, nodes[1:]):
            if node not in keys:
                keys[node] = hashlib.blake2b(keys[above] + tree.turns[node].to_bytes(8, "little", signed=True), digest_size=16).digest()
    members, smallest, children, leaves, saved = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size
    for node, number in tree.ends.items():
        members[node], smallest[node] = counts[number], least[number]
    for node in reversed(order):
        up = parent[node]
        if up >= 0:
            members[up] += members[node]
            smallest[up] = smallest[node] if smallest[up] is None else min(smallest[up], smallest[node])
        if node not in keys:
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * tree.chars[node]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    done, open_nodes = [], {}
    for node in order:
        end = tree.ends.get(node)
        path = None if end is None else paths[end]
        up = parent[node]
        if node in keys:
            key = keys[node]
            open_nodes[key] = Open(key, keys[up] if up >= 0 else None, tree.chars[node], depth[node], smallest[node], members[node], children[node], leaves[node], saved[node], path, node in left, node in right)
        else:
            above, above_key = (None, keys[up]) if up in keys else (smallest[up], None)
            done.append((False, 0, False, False, None, above_key, 0, depth[node], smallest[node], above, members[node], children[node], leaves[node], saved[node], path))
    return done, open_nodes


def merge_shards(shards: list[dict[bytes, Open]], close: bool = False) -> tuple[list[tuple], dict[bytes, Open]]:
    """Bring the open nodes of neighbouring shards (in order) together; finish those inside, or all with ``close``."""
    held: dict[bytes, Open] = {}
    lefts = {k for k, node in shards[0].items() if node.left}
    rights = {k for k, node in shards[-1].items() if node.right}
    for shard in shards:
        for key, node in shard.items():
            if key in held:
                held[key].add(node)
            else:
                held[key] = node
    done, still = [], {}
    for key, node in sorted(held.items(), key=lambda x: -x[1].depth):
        node.left, node.right = key in lefts, key in rights
        if not close and (node.left or node.right):
            still[key] = node
            continue
        leaves = node.leaves + (not node.children)
        saved = node.saved + (node.members - 1) * node.chars
        done.append((False, 0, False, False, key, node.parent_key, 0, node.depth, node.least, None, node.members, node.children, leaves, saved, node.path))
        if node.parent_key is not None:
            up = held[node.parent_key]
            up.children += 1
            up.leaves += leaves
            up.saved += saved
    return done, still


def _batches(rows: list[tuple], most: int = 20_000):
    for i in range(0, len(rows), most):
        part = rows[i : i + most]
        yield table(_SCHEMA, **{name: [r[k] for r in part] for k, name in enumerate(_SCHEMA.names)})


def _build(batches):
    """The trees of one range shard."""
    block = TaskContext.get().partitionId()
    held: dict[bytes, Open] = {}
    lists, paths, counts, least, size = [], [], [], [], 0

    def finish():
        nonlocal held
        done, opened = shard_nodes(lists, paths, counts, least)
        yield from _batches(done)
        if held:
            done, opened = merge_shards([held, opened])
            yield from _batches(done)
        held = opened

    for batch in batches:
        for path, ids, chars, n, first in zip(*(batch.column(c).to_pylist() for c in ("path", "ids", "chars", "n", "first"))):
            lists.append((ids, chars))
            paths.append(path)
            counts.append(n)
            least.append(first)
            size += len(ids) + 1
            if size >= TREE_TURNS:
                yield from finish()
                lists, paths, counts, least, size = [], [], [], [], 0
    if lists:
        yield from finish()
    yield from _batches([node.row(block) for node in held.values()])


def _merge(close: bool, level: int):
    def run(group: pa.Table) -> pa.Table:
        shards: dict[int, dict[bytes, Open]] = {}
        for r in group.sort_by("block").select(_SCHEMA.names).to_pylist():
            node = Open(r["key"], r["parent_key"], r["chars"], r["depth"], r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["path"], r["left"], r["right"])
            shards.setdefault(r["block"], {})[node.key] = node
        ordered = [shards[b] for b in sorted(shards)]
        done, still = merge_shards(ordered, close)
        number = min(shards) // FAN_IN
        rows = done + [node.row(number) for node in still.values()]
        return pa.Table.from_batches(list(_batches(rows)), schema=_SCHEMA)

    return run


def _end_digests(rebuilt: DataFrame) -> DataFrame:
    """``path, ends_sha256``: per path the digest of its conversation ids, streamed in ascending order."""
    out = pa.schema([("path", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches):
        now, digest = None, None
        for batch in batches:
            found: list[tuple[bytes, str]] = []
            for path, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path == now:
                    digest.update(b",%d" % conv)
                    continue
                if now is not None:
                    found.append((now, digest.hexdigest()))
                now, digest = path, hashlib.sha256(b"%d" % conv)
            if found:
                yield table(out, path=[p for p, _ in found], ends_sha256=[d for _, d in found])
        if now is not None:
            yield table(out, path=[now], ends_sha256=[digest.hexdigest()])

    ordered = rebuilt.select("path", "conv_id").repartition("path").sortWithinPartitions("path", "conv_id")
    return ordered.mapInArrow(run, "path binary, ends_sha256 string")


def conversation_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations of ``turns(conv_id, turn, role, text)``.

    Columns: ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Null roles and texts count as empty; null turns come first; turns with
    equal numbers are ordered by a digest of role and text. Rows with a null conversation id belong to no conversation
    and are left out. Repeated rows are turns of their own. A conversation whose turns all fall away ends at the root. No
    conversations give no rows, not even a root; other columns are not looked at.

    Memory of a task: one tree of ``TREE_TURNS`` turns plus the longest conversation, whose list of ids (12 bytes a turn)
    must fit a row. Ids of conversations with equal paths are counted before the shuffle; only their digest, which is
    sequential, streams through one task.
    """
    spark = turns.sparkSession
    rebuilt = stage(rebuilt_conversations(turns), "rebuilt", compression="zstd")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = rebuilt.groupBy("path").agg(F.first("ids").alias("ids"), F.first("chars").alias("chars"), F.count("*").alias("n"), F.min("conv_id").alias("first"))
    distinct = stage(distinct, "paths", compression="zstd")
    shards = distinct.repartitionByRange(parts, "ids").sortWithinPartitions("ids")
    levels = [stage(shards.mapInArrow(_build, _COLUMNS), "trie-nodes", compression="zstd")]
    blocks = shards.rdd.getNumPartitions()
    while True:
        close = blocks <= FAN_IN
        waiting = levels[-1].filter("open").withColumn("_group", (F.col("block") / FAN_IN).cast("int"))
        levels.append(stage(waiting.groupBy("_group").applyInArrow(_merge(close, len(levels)), _COLUMNS), "trie-nodes", compression="zstd"))
        blocks = -(-blocks // FAN_IN)
        if close:
            break
    nodes = levels[0]
    for more in levels[1:]:
        nodes = nodes.unionAll(more)
    nodes = nodes.filter("NOT open").select("key", "parent_key", "path", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    ends = nodes.filter("path IS NOT NULL").join(_end_digests(rebuilt), "path")
    inner = nodes.filter("path IS NULL").withColumn("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    nodes = stage(ends.unionByName(inner).drop("path"), "trie-nodes", compression="zstd")
    # Parents inside a tree are known already; those of nodes below an open path were finished later.
    above = nodes.filter("key IS NOT NULL").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    below = nodes.filter("parent_key IS NOT NULL").join(above, "parent_key").withColumn("parent_conv_id", F.col("_above"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return nodes.filter("parent_key IS NULL").select(*columns).unionAll(below.select(*columns))
