"""SimHash near-duplicates, linked through BK-trees.

Fingerprints that differ in at most ``radius`` bits agree in all but ``radius`` of ``blocks`` blocks of bits. Each
choice of agreeing blocks gives a key, and all fingerprints with a key form a shard with a BK-tree of its own: the
children of a node are keyed by their Hamming distance to it, and a search follows only the edges within the radius.
Only fingerprints that share a shard with another one are in trees. The trees are broadcast and every fingerprint is
searched where it lies, as long as they hold at most ``FOREST_ROWS`` rows, which is counted first. Beyond that, trees and
queries of a shard meet by a shuffle on the key, and a shard with very many fingerprints is split into several trees.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.arrow import table
from custlens.llm.components import components
from custlens.session import stage

TREE_SIZE = 20_000
FOREST_ROWS = 200_000  # rows of shards up to which trees are broadcast: about 50 bytes for each choice of blocks
_AT_ONCE = 200_000


def fingerprint(text: bytes, shingle: int) -> int:
    """64 bits by majority over the XXH64 hashes (seed 42) of word shingles; 0 without words."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, shingle):
        ones += _ones(hashes)
        n += len(hashes)
    return _majority(ones, n)


def shingle_hashes(text: bytes, shingle: int):
    """XXH64 (seed 42) of all word shingles, in arrays of bounded length. Fewer words: the whole sequence; none: nothing."""
    words = text.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, 100_000):
        part = slice(low, min(low + 100_000, n))
        yield np.array([digest(joined[a:b], 42) for a, b in zip(begins[part].tolist(), last[part].tolist())], np.uint64)


def _ones(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _majority(ones: np.ndarray, n: int) -> int:
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, shingle: int, name: str = "_fp", keep_text: bool = False) -> DataFrame:
    """``docs`` with a column ``name`` (64 bits as a long); the text column is carried on only if asked for."""
    kept = [f for f in docs.schema if keep_text or f.name != text_col]

    def add(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            out = np.fromiter((fingerprint((t.as_py() or "").encode(), shingle) for t in texts), np.uint64, len(texts))
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out.view(np.int64), pa.int64())], names=[*[f.name for f in kept], name])

    fields = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"`{name}` long"])
    return docs.mapInArrow(add, fields)


class Forest:
    """One BK-tree per group, over distinct fingerprints; groups are ascending integers."""

    def __init__(self, groups: np.ndarray, fingerprints: np.ndarray):
        self.fingerprints = fingerprints
        self.groups, roots = np.unique(groups, return_index=True)
        self.roots = roots
        node = roots[np.searchsorted(self.groups, groups)]
        waiting = np.ones(len(groups), bool)
        waiting[roots] = False
        waiting = np.flatnonzero(waiting)
        keys, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(waiting):
            # All points go one level down: the first with a new distance becomes the child, the others go below it.
            distance = np.bitwise_count(fingerprints[waiting] ^ fingerprints[node[waiting]])
            key, first, inverse = np.unique(node[waiting] * 65 + distance, return_index=True, return_inverse=True)
            child = waiting[first]
            keys.append(key)
            children.append(child)
            node[waiting] = child[inverse]
            placed = np.zeros(len(waiting), bool)
            placed[first] = True
            waiting = waiting[~placed]
        keys, children = np.concatenate(keys), np.concatenate(children)
        order = np.argsort(keys)
        self.edges, self.children = keys[order], children[order]  # edge: parent * 65 + distance

    def within(self, groups: np.ndarray, fingerprints: np.ndarray, radius: int):
        """(query, node) of all nodes of the query's group in the radius, a level of the trees at a time."""
        place = np.minimum(np.searchsorted(self.groups, groups), len(self.groups) - 1)
        query = np.flatnonzero(self.groups[place] == groups)
        node = self.roots[place[query]]
        while len(query):
            distance = np.bitwise_count(fingerprints[query] ^ self.fingerprints[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(distance - radius, 0), side="left")
            high = np.searchsorted(self.edges, node * 65 + np.minimum(distance + radius, 64), side="right")
            n = high - low
            before = np.cumsum(n) - n
            step = np.arange(int(n.sum())) - np.repeat(before, n)
            node = self.children[np.repeat(low, n) + step]
            query = np.repeat(query, n)


def _join_sets(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Bring the sets of a[i] and b[i] together; ``label`` points to the least member."""
    while True:
        a, b = label[a], label[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, shorter := label[label]):
            label[:] = shorter


def link_shards(group: np.ndarray, fp: np.ndarray, in_tree: np.ndarray, asks: np.ndarray, radius: int):
    """Stars (fingerprint, least fingerprint position) of what is linked inside each group."""
    _, groups = np.unique(group, return_inverse=True)
    tree = np.flatnonzero(in_tree)
    ask = np.flatnonzero(asks)
    forest = Forest(groups[tree], fp[tree])
    label = np.arange(len(fp))
    for part in _bounded(np.bincount(groups[tree], minlength=groups.max() + 1)[groups[ask]]):
        for query, node in forest.within(groups[ask[part]], fp[ask[part]], radius):
            _join_sets(label, ask[part][query], tree[node])
    hung = np.flatnonzero(label != np.arange(len(fp)))
    return fp[hung], fp[label[hung]]


class ShardTrees:
    """The BK-trees of all shards of ``fingerprints`` (distinct, ascending), a forest for each choice of blocks."""

    def __init__(self, masks: list[int], fingerprints: np.ndarray):
        self.fingerprints = fingerprints
        self.forests = []
        for mask in np.array(masks, np.int64).view(np.uint64):
            order = np.argsort(fingerprints & mask, kind="stable")
            groups = (fingerprints & mask)[order]
            size = np.unique(groups, return_counts=True)[1]
            self.forests.append((mask, order, Forest(groups, fingerprints[order]), size))

    def join(self, label: np.ndarray, asked: np.ndarray, radius: int) -> None:
        """Bring together, in ``label`` (one entry per fingerprint), what is within the radius of those asked for."""
        place = np.minimum(np.searchsorted(self.fingerprints, asked), len(self.fingerprints) - 1)
        place = place[self.fingerprints[place] == asked]  # others are alone in all of their shards
        for mask, order, forest, size in self.forests:
            groups = self.fingerprints[place] & mask
            for part in _bounded(size[np.searchsorted(forest.groups, groups)]):
                for query, node in forest.within(groups[part], self.fingerprints[place[part]], radius):
                    _join_sets(label, place[part][query], order[node])


def _bounded(answers: np.ndarray, most: int = 4_000_000):
    """Slices of questions that could give at most so many answers together (or one question alone)."""
    answers = np.cumsum(answers)
    start = 0
    while start < len(answers):
        before = answers[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(answers, before + most, side="right")))
        yield slice(start, stop)
        start = stop


def _masks(radius: int, blocks: int) -> list[int]:
    """One mask (signed, 64 bits) for each choice of blocks that agree."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return masks


def fingerprint_links(nodes: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Links ``(a, b)`` that connect all of ``nodes(_fp)`` (distinct) within the radius; not every pair is given."""
    masks = _masks(radius, blocks)
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("_fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])
    keyed = nodes.select("_fp", F.inline(keys))
    sizes = stage(keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).filter("n > 1"), "shards", compression="zstd")
    shared = keyed.join(sizes, ["choice", "bits"])
    if sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] <= FOREST_ROWS:
        return _links_by_broadcast(nodes, shared, masks, radius)
    return _links_by_shuffle(shared, radius)


def _links_by_broadcast(nodes: DataFrame, shared: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """All ``nodes`` go past the broadcast trees; a task hands back a star for each set that its nodes brought together."""
    found = shared.select("_fp").distinct().toArrow().column(0).to_numpy()  # at most FOREST_ROWS
    if not len(found):
        return nodes.select(F.col("_fp").alias("a"), F.col("_fp").alias("b")).limit(0)
    trees = nodes.sparkSession.sparkContext.broadcast(ShardTrees(masks, np.sort(found.view(np.uint64))))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batches):
        every = trees.value.fingerprints
        label = np.arange(len(every))
        for batch in batches:
            trees.value.join(label, batch.column(0).to_numpy().view(np.uint64), radius)
        hung = np.flatnonzero(label != np.arange(len(every)))
        yield table(out, a=every[hung].view(np.int64), b=every[label[hung]].view(np.int64))

    links = stage(nodes.select("_fp").mapInArrow(link, "a long, b long").distinct(), "links")
    trees.destroy()
    return links


def _links_by_shuffle(shared: DataFrame, radius: int) -> DataFrame:
    """Trees and questions of a shard meet in one task; crowded shards are several trees, each pair of which is asked once."""
    trees = F.ceil(F.col("n") / TREE_SIZE).cast("int")
    mine = F.pmod(F.xxhash64("_fp"), trees).cast("int")
    placed = shared.select("choice", "bits", "_fp", mine.alias("mine"), F.explode(F.sequence(F.lit(0), trees - 1)).alias("other")).select(
        "_fp",
        F.xxhash64("choice", "bits", F.least("mine", "other"), F.greatest("mine", "other")).alias("shard"),
        (F.col("mine") <= F.col("other")).alias("in_tree"),
        (F.col("mine") >= F.col("other")).alias("asks"),
    )
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batches):
        def run(t: pa.Table):
            fp = t.column("_fp").to_numpy().view(np.uint64)
            order = np.argsort(fp, kind="stable")  # the least label is then the least fingerprint
            take = lambda c: t.column(c).to_numpy(zero_copy_only=False)[order]
            a, b = link_shards(take("shard"), fp[order], take("in_tree"), take("asks"), radius)
            return table(out, a=a.view(np.int64), b=b.view(np.int64))

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < _AT_ONCE:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            shard = t.column("shard").to_numpy()
            cut = int(np.searchsorted(shard, shard[-1]))  # the last shard may go on in the next batch
            if cut:
                yield run(t.slice(0, cut))
            held = t.slice(cut).to_batches()
            rows = t.num_rows - cut
        if rows:
            yield run(pa.Table.from_batches(held).combine_chunks())

    return placed.repartition("shard").sortWithinPartitions("shard").mapInArrow(link, "a long, b long").distinct()


def _linked(prints: DataFrame, radius: int, blocks: int, least) -> DataFrame:
    """``(_fp, _first)``: for each distinct fingerprint the least ``least`` of its component."""
    nodes = stage(prints.groupBy("_fp").agg(F.min(least).alias("_mine")), "nodes")
    hung = components(fingerprint_links(nodes.select("_fp"), radius, blocks))
    labelled = nodes.join(hung.withColumnRenamed("node", "_fp"), "_fp", "left").withColumn("component", F.coalesce("component", "_fp"))
    labelled = stage(labelled, "labelled")
    first = labelled.groupBy("component").agg(F.min("_mine").alias("_first"))
    return labelled.join(first, "component").select("_fp", "_first")


def simhash_components(
    docs: DataFrame, shingle: int = 3, radius: int = 2, blocks: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Fingerprints link at ``radius`` or fewer differing bits; a component's id is the least document id that can be
    reached. Null and empty texts have fingerprint 0 and link like any other. Rows with a null id keep it and count for
    no component id. Repeated rows stay. No rows give no rows; other columns are not looked at.
    """
    prints = stage(with_fingerprints(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", shingle), "fingerprints")
    found = _linked(prints, radius, blocks, F.col("_id"))
    digits = F.lower(F.lpad(F.hex("_fp"), 16, "0"))
    return prints.join(found, "_fp", "left").select(F.col("_id").alias(id_col), digits.alias("fingerprint"), F.col("_first").alias("component_id"))


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 2, blocks: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component of ``simhash_components``: the one with the least id. Columns are unchanged.

    Rows with a null id give way to others; of rows with equal ids, or with none, any one stays. Texts without words share
    fingerprint 0, so one of them stays. No rows give no rows.
    """
    taken = set(docs.columns)
    fp, row = (next(n for n in (f"_{name}{i}" for i in range(len(taken) + 1)) if n not in taken) for name in ("fp", "row"))
    marked = stage(with_fingerprints(docs, text_col, shingle, fp, keep_text=True).withColumn(row, F.monotonically_increasing_id()), "fingerprints", compression="zstd")
    place = F.struct(F.col(id_col).isNull().alias("nameless"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    prints = marked.select(F.col(fp).alias("_fp"), place.alias("_place"))
    first = _linked(prints, radius, blocks, F.col("_place")).select("_fp", F.col("_first.row").alias("_kept"))
    dropped = stage(prints.join(first, "_fp").filter("_place.row <> _kept").select(F.col("_place.row").alias(row)), "near-copies", compression="zstd")
    return marked.join(dropped, row, "left_anti").select(*docs.columns)
