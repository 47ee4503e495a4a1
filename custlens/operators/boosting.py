"""Boosted trees with second-order gains and regularised leaves, on histograms.

Features are cut into bins once. A level of a tree takes one scan: gradients and curvatures of the logistic loss are added up by
(node, feature, bin), in the tasks first, and only these sums, whose number depends on the tree and not on the rows, come to
the driver, which picks the splits. Leaf values follow from the sums of the level above, so they need no scan.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.functions.columns import require_columns
from custlens.session import spread_rows, stage

TASK_ROWS = 100_000  # rows that one task scans for a level, about
_STAGED_TREES = 8  # trees whose margins are added as expressions before they are written


@dataclass
class Node:
    """A leaf with its value, or rows whose ``feature`` is at most ``edge`` (bin ``cut`` or lower) to the left and others right."""

    value: float = 0.0
    feature: int = -1
    cut: int = -1
    edge: float = 0.0
    gain: float = 0.0
    left: Node | None = None
    right: Node | None = None


def _node(values: dict | None) -> Node | None:
    return None if values is None else Node(**{**values, "left": _node(values["left"]), "right": _node(values["right"])})


@dataclass
class BoostedModel:
    features: list[str]
    trees: list[Node] = field(default_factory=list)

    def _value(self, node: Node, goes_left) -> Column:
        if node.left is None:
            return F.lit(node.value)
        return F.when(goes_left(node), self._value(node.left, goes_left)).otherwise(self._value(node.right, goes_left))

    def margin(self) -> Column:
        """Log-odds from the features themselves. A missing value goes left, as the least one would."""

        def goes_left(node: Node) -> Column:
            value = F.col(self.features[node.feature]).cast("double")
            return value.isNull() | (value <= node.edge)

        parts = F.array(*[self._value(t, goes_left) for t in self.trees], F.lit(0.0))
        return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``predicted`` (0 or 1) and ``churn_probability``."""
        require_columns(df, self.features)
        p = 1 / (1 + F.exp(-self.margin()))
        return df.withColumn("churn_probability", p).withColumn("predicted", (F.col("churn_probability") >= 0.5).cast("int"))

    def importance(self) -> list[tuple[str, float]]:
        """Share of the total gain by feature, greatest first."""
        gains = dict.fromkeys(self.features, 0.0)

        def add(node: Node | None) -> None:
            if node is not None and node.left is not None:
                gains[self.features[node.feature]] += node.gain
                add(node.left)
                add(node.right)

        for tree in self.trees:
            add(tree)
        whole = sum(gains.values()) or 1.0
        return sorted(((f, g / whole) for f, g in gains.items()), key=lambda x: (-x[1], x[0]))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, json.dumps(asdict(t))) for i, t in enumerate(self.trees)] + [(-1, json.dumps(self.features))]
        spark.createDataFrame(rows, "place int, tree string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        rows = {r.place: json.loads(r.tree) for r in spark.read.schema("place int, tree string").parquet(path).collect()}
        return cls(rows.pop(-1), [_node(rows[i]) for i in sorted(rows)])


def best_split(g: np.ndarray, h: np.ndarray, penalty: float, least_gain: float, least_weight: float) -> tuple[float, int, int] | None:
    """(gain, feature, cut) of the best split of a node from its sums by (feature, bin); the first on ties."""
    whole_g, whole_h = g.sum(axis=1, keepdims=True), h.sum(axis=1, keepdims=True)
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    right_g, right_h = whole_g - left_g, whole_h - left_h
    gain = 0.5 * (left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - whole_g**2 / (whole_h + penalty)) - least_gain
    gain = np.where((left_h >= least_weight) & (right_h >= least_weight), gain, -np.inf)
    feature, cut = np.unravel_index(int(np.argmax(gain)), gain.shape) if gain.size else (0, 0)
    return (float(gain[feature, cut]), int(feature), int(cut)) if gain.size and gain[feature, cut] > 1e-12 else None


def _bin(feature: str, edges: list[float]) -> Column:
    """How many edges lie below the value; 0 for a missing one."""
    constants = F.array(*map(F.lit, edges)) if edges else F.array().cast("array<double>")
    return F.size(F.filter(constants, lambda edge: edge < F.col(feature).cast("double"))).cast("smallint")


def train(
    rows: DataFrame,
    features: Sequence[str],
    label: str = "churn",
    trees: int = 100,
    max_depth: int = 5,
    rate: float = 0.1,
    penalty: float = 1.0,
    least_gain: float = 0.0,
    least_weight: float = 1.0,
    max_bins: int = 256,
) -> BoostedModel:
    """Fit trees to the 0/1 ``label``, starting from even odds.

    A split's gain is half the rise of G^2 / (H + ``penalty``) over both sides, less ``least_gain``; both sides need a
    curvature H of ``least_weight``; a leaf is worth -``rate`` G / (H + ``penalty``). Bins lie between ``max_bins`` quantiles of
    each feature (within a ten-thousandth of the rows). Rows without a label are left out; a missing feature falls
    into the lowest bin. Training ends early when no tree can be split any more.
    """
    require_columns(rows, [label, *features])
    known = rows.filter(F.col(label).isNotNull())
    at = [i / max_bins for i in range(1, max_bins)]
    found = known.agg(*[F.percentile_approx(F.col(f).cast("double"), at, 10_000).alias(f"q{j}") for j, f in enumerate(features)]).first()
    edges = [sorted(set(found[f"q{j}"] or [])) for j in range(len(features))]
    n_bins = max(map(len, edges)) + 1
    bins = [_bin(f, e).alias(f"b{j}") for j, (f, e) in enumerate(zip(features, edges))]
    binned = known.select(F.col(label).cast("double").alias("y"), *bins, F.lit(0.0).alias("m"))
    state = stage(spread_rows(binned, TASK_ROWS, known.count()), "boosting")
    model = BoostedModel(list(features))
    recent: list[Node] = []

    def binned_left(node: Node) -> Column:
        return F.col(f"b{node.feature}") <= node.cut

    def margin() -> Column:
        total = F.col("m")
        for tree in recent:
            total = total + model._value(tree, binned_left)
        return total

    for _ in range(trees):
        root = Node()
        level: list[tuple[Node, Column | None]] = [(root, None)]
        for depth in range(max_depth + 1):
            sums = _histograms(state, margin(), [where for _, where in level], len(features), n_bins) if depth < max_depth and level else None
            following: list[tuple[Node, Column | None]] = []
            for i, (node, where) in enumerate(level if sums is not None else []):
                g, h = sums[0][i], sums[1][i]
                if depth == 0:
                    node.value = -rate * float(g[0].sum()) / (float(h[0].sum()) + penalty)
                split = best_split(g, h, penalty, least_gain, least_weight)
                if split is None:
                    continue
                node.gain, node.feature, node.cut = split
                node.edge = edges[node.feature][node.cut] if node.cut < len(edges[node.feature]) else float("inf")
                left_g, left_h = float(g[node.feature, : node.cut + 1].sum()), float(h[node.feature, : node.cut + 1].sum())
                right_g, right_h = float(g[node.feature].sum()) - left_g, float(h[node.feature].sum()) - left_h
                node.left, node.right = (Node(-rate * a / (b + penalty)) for a, b in ((left_g, left_h), (right_g, right_h)))
                condition = binned_left(node)
                following += [(child, c if where is None else where & c) for child, c in ((node.left, condition), (node.right, ~condition))]
            level = following
            if not level:
                break
        model.trees.append(root)
        recent.append(root)
        if root.left is None:
            break
        if len(recent) == _STAGED_TREES:
            state = stage(state.withColumn("m", margin()), "boosting")
            recent = []
    return model


def _histograms(state: DataFrame, margin: Column, nodes: list[Column | None], n_features: int, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradient and curvature by node, feature and bin, of the nodes that are still open."""
    node = F.lit(0)
    if nodes[0] is not None:
        node = F.coalesce(*[F.when(where, F.lit(i)) for i, where in enumerate(nodes)])
    p = 1 / (1 + F.exp(-margin))
    placed = state.withColumn("_node", node).filter("_node IS NOT NULL").withColumn("_p", p)
    cells = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"b{j}").alias("b")) for j in range(n_features)])).alias("cell")
    rows = placed.select("_node", (F.col("_p") - F.col("y")).alias("g"), (F.col("_p") * (1 - F.col("_p"))).alias("h"), cells)
    g, h = np.zeros((len(nodes), n_features, n_bins)), np.zeros((len(nodes), n_features, n_bins))
    for r in rows.groupBy("_node", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
        g[r._node, r.cell.j, r.cell.b], h[r._node, r.cell.j, r.cell.b] = r.g, r.h
    return g, h
