"""Random forests whose trees and rows stay off the driver.

Spark ML keeps every node of every tree as objects on the driver, about half a kilobyte each: a hundred trees of full depth
outgrow it at some ten thousand rows. Here rows are binned and packed into blocks. Nodes of more than ``LOCAL_ROWS`` weighted rows
are split level by level from histograms that are added up in the tasks; the rows of every smaller one meet in one
task, which grows its whole part of the tree. The parts are written to the shared folder; the driver holds the few large nodes
and a row per part. Scoring brings rows and parts together by a shuffle.

Trees are those of Spark ML's random forest: bootstrap by Poisson weights, at each node a fresh draw of the square root of the
number of features, the split of largest Gini gain, no row limit, sibling leaves of one prediction merged; a leaf votes with its shares.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.session import stage

BLOCK_ROWS = 100_000  # rows that are packed together
LOCAL_ROWS = 1_000_000  # weighted rows of a part that one task grows, about 60 MB
SCORED_ROWS = 4_000_000  # rows that a scoring task holds, about 60 MB
TREE_GROUPS = 32  # trees are dealt to so many tasks for each such stretch of rows
_CELLS = 2_000_000  # of histograms at once
_CHUNK = 1 << 18  # rows that are counted at once
_HELD = 4_000  # histograms of large nodes a task holds

_BLOCKS = pa.schema([("block", pa.int64()), ("bins", pa.binary()), ("label", pa.binary())])
_HISTOGRAMS = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("cells", pa.binary())])
_SPLITS = pa.schema(
    [("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("threshold", pa.int32()), ("gain", pa.float64())]
    + [("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64()))]
)
_BAGS = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("block", pa.int64()), ("bins", pa.binary()), ("label", pa.binary()), ("weight", pa.binary())])
_PARTS = pa.schema(
    [("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.binary()), ("threshold", pa.binary()), ("left", pa.binary()), ("counts", pa.binary())]
    + [("leaf", pa.bool_()), ("prediction", pa.int32()), ("gains", pa.list_(pa.float64()))]
)
_ASKED = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("bins", pa.binary())])
_VOTES = pa.schema([("block", pa.int64()), ("deal", pa.int32()), ("votes", pa.binary())])
_SCORES = pa.schema([("_row", pa.int64()), ("_votes", pa.list_(pa.float64()))])
_KINDS = {pa.int32(): "int", pa.int64(): "bigint", pa.float64(): "double", pa.binary(): "binary", pa.bool_(): "boolean"}


def _spelled(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {f'array<{_KINDS[f.type.value_type]}>' if pa.types.is_list(f.type) else _KINDS[f.type]}" for f in schema)


def _batch(schema: pa.Schema, rows: Sequence[Sequence]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for f, c in zip(schema, zip(*rows))] if rows else [pa.array([], f.type) for f in schema], schema=schema)


def _numbers(column: pa.Array) -> np.ndarray:
    if column.null_count:
        raise ValueError("features and labels of a forest must not be null")
    return column.to_numpy(zero_copy_only=False)


def _best(cells: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
    """Best splits of nodes: feature, threshold (last bin to the left), gain times weight, class weights left and right; feature -1 for none.

    ``cells`` is (nodes, features, bins, classes), ``chosen`` the number of each feature.
    """
    k, m, b, c = cells.shape
    before = cells.cumsum(axis=2)
    whole = before[:, 0, -1, :]
    left = before[:, :, :-1, :]
    right = whole[:, None, None, :] - left
    n_left, n_right, n = left.sum(axis=3), right.sum(axis=3), whole.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left**2).sum(axis=3) / n_left + (right**2).sum(axis=3) / n_right
    gain[(n_left == 0) | (n_right == 0)] = -np.inf
    gain = gain.reshape(k, -1)
    place = gain.argmax(axis=1)
    here = np.arange(k)
    q, t = place // (b - 1), place % (b - 1)
    l, r = left[here, q, t], right[here, q, t]
    best = gain[here, place] - (whole**2).sum(axis=1) / n
    # a gain above 0 means other shares on the left than in the whole; compared as whole numbers
    ok = np.isfinite(best) & (l * n[:, None] != whole * l.sum(axis=1)[:, None]).any(axis=1)
    return np.where(ok, chosen[here, q], -1), t, best, l, r


def _grow(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, n_bins: int, depth: int, most: int, draw: np.random.Generator):
    """A tree of up to ``depth`` levels below its root, ``most`` features tried at a node: feature (-1 in leaves), threshold, left child (the right one follows), class weights, gains.

    Children come after their parents, level by level.
    """
    n, width = bins.shape
    flat, kept = bins.ravel(), []
    rows, sizes = np.arange(n), np.array([n])
    counts = np.bincount(label, weight, classes)[None, :]
    offset = 0
    for level in range(depth + 1):
        k = len(counts)
        feature, threshold, left, gains = np.full(k, -1, np.int16), np.zeros(k, np.uint16), np.zeros(k, np.int32), np.zeros(k)
        kept.append((feature, threshold, left, counts, gains))
        active = np.flatnonzero(counts.max(axis=1) < counts.sum(axis=1)) if level < depth else np.zeros(0, np.int64)
        offset += k
        if not len(active):
            break
        chosen = np.sort(draw.random((len(active), width)).argpartition(most - 1, axis=1)[:, :most], axis=1) if most < width else np.tile(np.arange(width), (len(active), 1))
        ends = np.cumsum(sizes)
        next_rows, next_sizes, next_counts = [], [], []
        i, children = 0, 0
        while i < len(active):
            first = ends[i] - sizes[i]
            j = min(max(i + 1, int(np.searchsorted(ends, first + _CHUNK, side="right"))), i + max(1, _CELLS // (most * n_bins * classes)))
            r, size = rows[first : ends[j - 1]], sizes[i:j]
            own = np.repeat(np.arange(j - i), size)
            at, y, w = r * width, label[r], weight[r]
            cells = np.empty((j - i, most, n_bins, classes))
            for q in range(most):
                key = (own * n_bins + flat[at + chosen[i:j, q][own]]) * classes + y
                cells[:, q] = np.bincount(key, w, (j - i) * n_bins * classes).reshape(j - i, n_bins, classes)
            f, t, gain, low, high = _best(cells, chosen[i:j])
            split = f >= 0
            nodes = active[i:j][split]
            feature[nodes], threshold[nodes], gains[nodes] = f[split], t[split], gain[split]
            left[nodes] = offset + children + 2 * np.arange(len(nodes))
            children += 2 * len(nodes)
            # rows of a node: those that go left, then the others, both in their order
            is_left = flat[at + np.maximum(f, 0)[own]] <= t[own]
            begin = np.cumsum(size) - size
            so_far = np.cumsum(is_left)
            earlier = so_far[begin] - is_left[begin]
            n_left = np.append(so_far[begin[1:] - 1], so_far[-1]) - earlier
            lefts = so_far - earlier[own]
            place = np.where(is_left, begin[own] + lefts - 1, n_left[own] + np.arange(len(r)) - lefts)
            moved = np.empty_like(r)
            moved[place] = r
            both = np.stack([low, high], axis=1)
            goes_on = split[:, None] & (both.max(axis=2) < both.sum(axis=2)) & (level + 1 < depth)
            parts = np.stack([n_left, size - n_left], axis=1)
            next_rows.append(moved[np.repeat(goes_on.ravel(), parts.ravel())])
            next_sizes.append(parts[goes_on])
            next_counts.append(both[split].reshape(-1, classes))
            i = j
        rows, sizes, counts = np.concatenate(next_rows), np.concatenate(next_sizes), np.concatenate(next_counts)
        if not len(counts):
            break
    return _pruned(kept)


def _pruned(levels: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """The levels in a row, without the children of nodes whose children are leaves of one prediction."""
    feature, threshold, left, counts, gains = (np.concatenate(c) for c in zip(*levels))
    said = counts.argmax(axis=1)
    starts = np.cumsum([0, *(len(x[0]) for x in levels)])
    inner = [np.flatnonzero(feature[a:b] >= 0) + a for a, b in zip(starts[:-1], starts[1:])]
    for nodes in reversed(inner):
        l = left[nodes]
        feature[nodes[(feature[l] < 0) & (feature[l + 1] < 0) & (said[l] == said[l + 1])]] = -1
    stays = np.zeros(len(feature), bool)
    stays[0] = True
    for nodes in inner:
        l = left[nodes[stays[nodes] & (feature[nodes] >= 0)]]
        stays[l] = stays[l + 1] = True
    left = np.where(feature >= 0, (np.cumsum(stays) - 1)[left], 0).astype(np.int32)
    return feature[stays], threshold[stays], left[stays], counts[stays], gains[stays]


def _walk(feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    at = np.zeros(len(bins), np.int32)
    moving = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
    while len(moving):
        here = at[moving]
        to = left[here] + (bins[moving, feature[here]] > threshold[here])
        at[moving] = to
        moving = moving[feature[to] >= 0]
    return at


class Forest(Model, MLWritable, MLReadable):
    """Grown trees: their parts as a table in the shared folder, the large nodes above them and the importances here."""

    def __init__(self, parts: DataFrame, bins: list[str], classes: int, dtype: str, tops: dict[int, Sequence[Sequence]], importances: list[float]):
        super().__init__()
        self.parts, self.bins, self.classes, self.dtype, self.tops, self.importances = parts, bins, classes, dtype, tops, importances

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.importances)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Add ``rawPrediction`` (sums of shares), ``probability`` and ``prediction`` as Spark ML names them. Votes are counted at once."""
        classes, dtype, width = self.classes, self.dtype, len(self.bins)
        tops = {tree: (np.array(f, np.int16), np.array(t, np.uint16), np.array(l, np.int32), np.array(c, float)) for tree, (f, t, l, c) in self.tops.items()}
        numbered = stage(dataset.withColumn("_row", F.monotonically_increasing_id()), "forest-asked")
        pack = _pack(_ASKED, self.bins, dtype, ids=("_row", lambda c: _numbers(c).astype("<i8")))
        blocks = stage(numbered.select("_row", *self.bins).mapInArrow(pack, _spelled(_ASKED)), "forest-asked-blocks")
        stretches = max(1, -(-numbered.count() // SCORED_ROWS))
        deals = min(TREE_GROUPS, len(tops))
        stretch = F.pmod(F.xxhash64("block"), F.lit(stretches)).cast("int").alias("stretch")
        asked = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(deals - 1))).alias("deal"), stretch, "block", "bins")
        parts = self.parts.select(
            (F.col("tree") % deals).alias("deal"), F.explode(F.sequence(F.lit(0), F.lit(stretches - 1))).alias("stretch"),
            "tree", "node", "feature", "threshold", "left", "counts",
        )

        def vote(asked: pa.Table, parts: pa.Table) -> pa.Table:
            out = []
            if asked.num_rows:
                deal = asked.column("deal")[0].as_py()
                kinds = (("feature", "<i2"), ("threshold", "<u2"), ("left", "<i4"), ("counts", "<i4"))
                grown = {}
                for i, key in enumerate(zip(parts.column("tree").to_pylist(), parts.column("node").to_pylist())):
                    feature, threshold, left, counts = (np.frombuffer(parts.column(c)[i].as_buffer(), kind) for c, kind in kinds)
                    counts = counts.reshape(-1, classes)
                    grown[key] = feature, threshold, left, counts / counts.sum(axis=1, keepdims=True)
                for block, cell in zip(asked.column("block").to_pylist(), asked.column("bins")):
                    x = np.frombuffer(cell.as_buffer(), dtype).reshape(-1, width)
                    votes = np.zeros((len(x), classes))
                    for tree in range(deal, len(tops), deals):
                        *shape, counts = tops[tree]
                        at = _walk(*shape, x)
                        for node in np.unique(at).tolist():
                            here = np.flatnonzero(at == node) if len(shape[0]) > 1 else slice(None)
                            if (tree, node) in grown:
                                *own, shares = grown[tree, node]
                                votes[here] += shares[_walk(*own, x[here])]
                            elif counts[node].sum():
                                votes[here] += counts[node] / counts[node].sum()
                    out.append((block, deal, votes.tobytes()))
            return pa.Table.from_batches([_batch(_VOTES, out)])

        def add_up(votes: pa.Table, blocks: pa.Table) -> pa.Table:
            ids = np.frombuffer(blocks.column("ids")[0].as_buffer(), "<i8")
            whole = np.zeros((len(ids), classes))
            for cell in votes.sort_by("deal").column("votes"):  # always in the same order: sums of doubles
                whole += np.frombuffer(cell.as_buffer()).reshape(-1, classes)
            shares = pa.ListArray.from_arrays(pa.array(np.arange(0, whole.size + 1, classes), pa.int32()), pa.array(whole.ravel()))
            return pa.Table.from_arrays([pa.array(ids), shares], schema=_SCORES)

        key = ["deal", "stretch"]
        votes = asked.groupBy(*key).cogroup(parts.groupBy(*key)).applyInArrow(vote, _spelled(_VOTES))
        sums = votes.groupBy("block").cogroup(blocks.select("block", "ids").groupBy("block")).applyInArrow(add_up, _spelled(_SCORES))
        scored = numbered.join(stage(sums, "forest-votes"), "_row")
        whole = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
        return scored.select(
            *[F.col(c) for c in dataset.columns],
            array_to_vector("_votes").alias("rawPrediction"),
            array_to_vector(F.transform("_votes", lambda x: x / whole)).alias("probability"),
            (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double").alias("prediction"),
        )

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, forest: Forest):
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        f = self.forest
        kept = {"bins": f.bins, "classes": f.classes, "dtype": f.dtype, "tops": sorted(f.tops.items()), "importances": f.importances}
        DefaultParamsWriter.saveMetadata(f, path, self.sparkSession, extraMetadata={"forest": kept})
        f.parts.write.parquet(f"{path}/parts")


class _Reader(MLReader):
    def load(self, path: str) -> Forest:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        kept = metadata["forest"]
        parts = self.sparkSession.read.parquet(f"{path}/parts")
        forest = Forest(parts, kept["bins"], kept["classes"], kept["dtype"], dict(kept["tops"]), kept["importances"])
        forest._resetUid(metadata["uid"])
        return forest


class _Top:
    """The large nodes of a tree: as in :func:`_grow`, with the depth of each. Its leaves are parts, unless nothing is left to split."""

    def __init__(self):
        self.feature, self.threshold, self.left, self.depth, self.counts, self.gains = [-1], [0], [0], [0], [None], [0.0]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature, np.int16), np.array(self.threshold, np.uint16), np.array(self.left, np.int32)

    def split(self, node: int, feature: int, threshold: int, gain: float, left: list[int], right: list[int]) -> None:
        self.feature[node], self.threshold[node], self.left[node], self.gains[node] = feature, threshold, len(self.feature), gain
        self.counts[node] = [a + b for a, b in zip(left, right)]
        for counts in (left, right):
            for column, value in ((self.feature, -1), (self.threshold, 0), (self.left, 0), (self.depth, self.depth[node] + 1), (self.counts, list(counts)), (self.gains, 0.0)):
                column.append(value)


def _labels(column: pa.Array) -> np.ndarray:
    y = _numbers(column).astype(float)
    if ((y < 0) | (y > 99) | (y != np.floor(y))).any():
        raise ValueError("labels of a forest must be whole numbers from 0 to 99")
    return y.astype(np.uint8)


def _pack(schema: pa.Schema, bins: Sequence[str], dtype: str, **others):
    """Rows to blocks of about ``BLOCK_ROWS``: the columns ``bins`` in row order, and one array for each of ``others`` (column, function)."""

    def run(batches):
        held: dict[str, list[np.ndarray]] = defaultdict(list)
        size = number = 0
        task = TaskContext.get().partitionId() << 32

        def block():
            made = {"block": task + number} | {name: np.concatenate(x).tobytes() for name, x in held.items()}
            return _batch(schema, [[made[name] for name in schema.names]])

        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            held["bins"].append(np.stack([_numbers(column[c]) for c in bins], axis=1).astype(dtype))
            for name, (source, function) in others.items():
                held[name].append(function(column[source]))
            size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield block()
                held.clear()
                size, number = 0, number + 1
        if size:
            yield block()

    return run


def train(rows: DataFrame, bins: Sequence[str], label: str, trees: int, max_depth: int, n_bins: int, seed: int) -> Forest:
    """A forest on the columns ``bins`` (bin numbers from 0 to ``n_bins`` - 1, below 65,536) and ``label`` (whole numbers from 0)."""
    dtype = "u1" if n_bins <= 256 else "<u2"
    width, seed = len(bins), seed % (1 << 63)
    blocks = stage(rows.select(*bins, label).mapInArrow(_pack(_BLOCKS, bins, dtype, label=(label, _labels)), _spelled(_BLOCKS)), "forest-rows")
    n, top_label = rows.agg(F.count("*"), F.max(label)).first()
    classes = max(2, int(top_label) + 1)
    n_bins = max(2, n_bins)
    tops = {tree: _Top() for tree in range(trees)}
    most = math.ceil(math.sqrt(width)) if trees > 1 else width

    def bag(tree: int, block: int, size: int) -> np.ndarray:
        return np.random.default_rng([seed, tree, block]).poisson(1.0, size).astype(np.uint8)

    def unpacked(batches):
        for batch in batches:
            for block, x, y in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                yield block, np.frombuffer(x.as_buffer(), dtype).reshape(-1, width), np.frombuffer(y.as_buffer(), np.uint8)

    def chosen(tree: int, node: int) -> np.ndarray:
        return np.sort(np.random.default_rng([seed, tree, node, 1]).permutation(width)[:most])

    large = {tree: [0] for tree in tops} if n > LOCAL_ROWS else {}
    while large:
        shapes = {tree: tops[tree].arrays() for tree in large}

        def count(batches, large=large, shapes=shapes):
            held: dict[tuple[int, int], np.ndarray] = {}

            def flush():
                yield _batch(_HISTOGRAMS, [(*key, cells.tobytes()) for key, cells in held.items()])
                held.clear()

            for block, x, y in unpacked(batches):
                for tree, nodes in large.items():
                    w = bag(tree, block, len(y))
                    at = _walk(*shapes[tree], x)
                    for node in nodes:
                        here = np.flatnonzero(at == node)
                        cells = np.stack([np.bincount(x[here, f].astype(np.int64) * classes + y[here], w[here], n_bins * classes) for f in chosen(tree, node)])
                        held[tree, node] = held[tree, node] + cells if (tree, node) in held else cells
                    if len(held) >= _HELD:
                        yield from flush()
            if held:
                yield from flush()

        def decide(table: pa.Table) -> pa.Table:
            tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
            cells = sum(np.frombuffer(x.as_buffer()) for x in table.column("cells"))  # whole numbers: exact in any order
            f, t, gain, l, r = _best(cells.reshape(1, most, n_bins, classes), chosen(tree, node)[None, :])
            found = (tree, node, int(f[0]), int(t[0]), float(gain[0]), l[0].astype(int).tolist(), r[0].astype(int).tolist())
            return pa.Table.from_batches([_batch(_SPLITS, [found])])

        counted = blocks.mapInArrow(count, _spelled(_HISTOGRAMS))
        found = counted.groupBy("tree", "node").applyInArrow(decide, _spelled(_SPLITS)).collect()  # a row per large node
        large = defaultdict(list)
        for s in sorted(found, key=lambda s: (s.tree, s.node)):
            top = tops[s.tree]
            if s.feature < 0:
                top.counts[s.node] = [a + b for a, b in zip(s.left, s.right)]
                continue
            top.split(s.node, s.feature, s.threshold, s.gain, s.left, s.right)
            for node in (top.left[s.node], top.left[s.node] + 1):
                own = top.counts[node]
                if sum(own) > LOCAL_ROWS and max(own) < sum(own) and top.depth[node] < max_depth:
                    large[s.tree].append(node)
        large = dict(large)

    # A leaf of a top is a part: small, pure, at the last level or without a split. Only the first kind goes on growing; a
    # node without a split stays as it is.
    grown = {}
    for tree, top in tops.items():
        grown[tree] = [
            node for node, f in enumerate(top.feature)
            if f < 0 and (top.counts[node] is None or (sum(top.counts[node]) <= LOCAL_ROWS and max(top.counts[node]) < sum(top.counts[node]) and top.depth[node] < max_depth))
        ]
    shapes = {tree: top.arrays() for tree, top in tops.items()}
    depths = {tree: top.depth for tree, top in tops.items()}

    def scatter(batches):
        for block, x, y in unpacked(batches):
            for tree, nodes in grown.items():
                w = bag(tree, block, len(y))
                at = _walk(*shapes[tree], x)
                out = []
                for node in nodes:
                    here = np.flatnonzero((at == node) & (w > 0))
                    if len(here):
                        out.append((tree, node, block, x[here].tobytes(), y[here].tobytes(), w[here].tobytes()))
                if out:
                    yield _batch(_BAGS, out)

    def grow(table: pa.Table) -> pa.Table:
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        table = table.sort_by("block")
        x, y, w = (np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in table.column(c)]) for c, kind in (("bins", dtype), ("label", "u1"), ("weight", "u1")))
        feature, threshold, left, counts, gains = _grow(
            x.reshape(-1, width), y.astype(np.int64), w.astype(float), classes, n_bins, max_depth - depths[tree][node], most, np.random.default_rng([seed, tree, node, 2])
        )
        inner = feature >= 0
        by_feature = np.bincount(feature[inner], gains[inner], width)
        arrays = (feature.astype("<i2"), threshold.astype("<u2"), left.astype("<i4"), counts.astype("<i4"))
        return pa.Table.from_batches([_batch(_PARTS, [(tree, node, *(a.tobytes() for a in arrays), not inner[0], int(counts[0].argmax()), by_feature.tolist())])])

    tasks = min(2_000, 4 * sum(map(len, grown.values())))
    bags = blocks.mapInArrow(scatter, _spelled(_BAGS)).repartition(max(1, tasks), "tree", "node")
    parts = stage(bags.groupBy("tree", "node").applyInArrow(grow, _spelled(_PARTS)), "forest-parts")
    gains = {tree: np.zeros(width) for tree in tops}
    roots = {}
    for r in parts.select("tree", "node", "leaf", "prediction", "gains").collect():  # a row per part
        roots[r.tree, r.node] = (r.leaf, r.prediction, np.array(r.gains))
    nodes = {}
    for tree, top in tops.items():
        leaves = {}  # what a node predicts if it is a leaf
        for node in reversed(range(len(top.feature))):
            leaf, said, own = roots.get((tree, node), (True, int(np.argmax(top.counts[node] or [1])), None))
            if top.feature[node] >= 0:
                a, b = (leaves.get(top.left[node] + side) for side in (0, 1))
                leaf = a is not None and a == b
                if leaf:
                    top.feature[node] = -1
            if leaf:
                leaves[node] = said
        reached = [0]
        for node in reached:
            if top.feature[node] >= 0:
                gains[tree][top.feature[node]] += top.gains[node]
                reached += [top.left[node], top.left[node] + 1]
            elif (tree, node) in roots:
                gains[tree] += roots[tree, node][2]
        nodes[tree] = (top.feature, top.threshold, top.left, [c or [0] * classes for c in top.counts])
    shares = sum((g / g.sum() for g in gains.values() if g.sum() > 0), np.zeros(width))
    importances = shares / shares.sum() if shares.sum() > 0 else shares
    return Forest(parts, list(bins), classes, dtype, nodes, importances.tolist())
