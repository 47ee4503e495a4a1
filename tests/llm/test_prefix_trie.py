import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from custlens.llm import prefix_trie
from custlens.llm.prefix_trie import conversation_trie, merge_shards, shard_nodes

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes_of(lists):
    """{conv_id: [(key, chars)]} to the rows of the trie, by sets of members."""
    members = defaultdict(set)
    chars = {}
    for conv, turns in lists.items():
        for d in range(len(turns) + 1):
            prefix = tuple(k for k, _ in turns[:d])
            members[prefix].add(conv)
            chars[prefix] = turns[d - 1][1] if d else 0
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * chars[p] for p in below)
        ends = ",".join(str(c) for c in sorted(convs) if len(lists[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(convs), len(prefix), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(x[2:], len(x[3])) for x in sorted(t, key=lambda x: x[:2])] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def test_a_trie_of_rebuilt_conversations(spark):
    draw = random.Random(4)
    rows = []
    for conv in [*range(0, 60), *range(120, 160), 205]:  # some blocks of ids lack their first conversation
        for turn in range(draw.randrange(1, 9)):
            rows.append((conv, turn, draw.choice(["user", "assistant", None]), draw.choice(["a", "bé", "", None, "\U0001f600 c"])))
    rows += [(conv, None, "system", "first") for conv in range(0, 60, 7)]
    rows += [(None, 1, "user", "x"), (205, 3, "user", "y" * 100_000)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, path string")
    got = conversation_trie(frame.repartition(5))
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == nodes_of(rebuilt(rows))


def test_no_conversations(spark):
    assert conversation_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_one_turnless_conversation(spark):
    assert zlib.crc32(b"101") % 6 > 0
    frame = spark.createDataFrame([(101, 0, "user", "gone")], "conv_id long, turn long, role string, text string")
    row = conversation_trie(frame).collect()
    assert [tuple(r) for r in row] == [(101, 0, None, 1, 0, 1, 0, hashlib.sha256(b"101").hexdigest())]


@pytest.mark.parametrize("block, fan", [(1, 2), (3, 2), (7, 5), (1000, 2)])
def test_trees_in_blocks_merge_to_the_same_trie(block, fan):
    draw = random.Random(block)
    lists = {c: [(draw.randrange(3), 0) for _ in range(draw.randrange(0, 7))] for c in range(300)}
    size = {k: 5 * k + 1 for k in range(3)}
    lists = {c: [(k, size[k]) for k, _ in t] for c, t in lists.items()}
    distinct = defaultdict(list)
    for c, t in lists.items():
        distinct[tuple(k for k, _ in t)].append(c)
    ordered = sorted(distinct)
    done, shards = [], []
    for i in range(0, len(ordered), block):
        part = ordered[i : i + block]
        rows, opened = shard_nodes([(list(p), [size[k] for k in p]) for p in part], [repr(p).encode() for p in part], [len(distinct[p]) for p in part], [min(distinct[p]) for p in part])
        done += rows
        shards.append(opened)
    while True:
        close = len(shards) <= fan
        merged = []
        for i in range(0, len(shards), fan):
            rows, opened = merge_shards(shards[i : i + fan], close)
            done += rows
            merged.append(opened)
        shards = merged
        if close:
            break
    names = prefix_trie._SCHEMA.names
    found = [dict(zip(names, r)) for r in done]
    least = {r["key"]: r["conv_id"] for r in found if r["key"] is not None}
    got = []
    for r in found:
        parent = r["parent_conv_id"] if r["parent_key"] is None else least[r["parent_key"]]
        ends = ",".join(map(str, sorted(distinct[eval(r["path"])]))) if r["path"] else ""
        got.append((r["conv_id"], r["depth"], parent, r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], hashlib.sha256(ends.encode()).hexdigest()))
    assert sorted(got, key=str) == nodes_of(lists)


def test_median_insertion_keeps_the_search_trees_flat():
    lists = [([i], [1]) for i in range(1023)]
    tree = prefix_trie.TernaryTree.balanced(lists)

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.links[3 * node]), height(tree.links[3 * node + 2]))

    assert height(tree.links[1]) == 10
