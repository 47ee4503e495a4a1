"""Second-order boosted trees against a plain version, row by row."""

import math
import random

import pytest

from custlens.operators import boosting


def plain(data, labels, trees, depth, rate, penalty, least_weight):
    """Exact greedy splits between all values; returns margins and the sorted leaf values of each tree."""
    margins, leaves = [0.0] * len(data), []
    for _ in range(trees):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g = [a - y for a, y in zip(p, labels)]
        h = [a * (1 - a) for a in p]
        found = []

        def grow(rows, level):
            G, H = sum(g[i] for i in rows), sum(h[i] for i in rows)
            best = None
            for f in range(len(data[0])) if level < depth else ():
                for cut in sorted({data[i][f] for i in rows})[:-1]:
                    left = [i for i in rows if data[i][f] <= cut]
                    a, b = sum(g[i] for i in left), sum(h[i] for i in left)
                    if b < least_weight or H - b < least_weight:
                        continue
                    gain = 0.5 * (a * a / (b + penalty) + (G - a) ** 2 / (H - b + penalty) - G * G / (H + penalty))
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                        best = gain, f, cut
            if best is None:
                value = -rate * G / (H + penalty)
                found.append(value)
                for i in rows:
                    margins[i] += value
                return
            _, f, cut = best
            grow([i for i in rows if data[i][f] <= cut], level + 1)
            grow([i for i in rows if data[i][f] > cut], level + 1)

        grow(list(range(len(data))), 0)
        leaves.append(sorted(found))
    return margins, leaves


def leaves_of(node):
    return [node.value] if node.left is None else leaves_of(node.left) + leaves_of(node.right)


@pytest.fixture
def data():
    draw = random.Random(7)
    rows = [(draw.randrange(12), draw.randrange(7), draw.random().__round__(1)) for _ in range(160)]
    return rows, [int(a > 6) ^ int(b > 4 and draw.random() < 0.8) for a, b, _ in rows]


def frame(spark, data):
    return spark.createDataFrame([(i, *map(float, r), y, "x") for i, (r, y) in enumerate(zip(*data))], "id int, a double, b double, c double, churn int, m string")


@pytest.mark.parametrize("penalty, least_weight", [(1.0, 1.0), (0.3, 0.0)])
def test_trees_as_by_brute_force(spark, data, tmp_path, penalty, least_weight):
    options = {"rate": 0.3, "penalty": penalty, "least_weight": least_weight}
    margins, leaves = plain(*data, trees=10, depth=3, **options)  # more trees than are kept as expressions
    model = boosting.train(frame(spark, data), ["a", "b", "c"], trees=10, max_depth=3, **options)
    assert len(model.trees) == 10
    for tree, want in zip(model.trees, leaves):
        assert sorted(leaves_of(tree)) == pytest.approx(want, abs=1e-9)
    got = {r.id: r.churn_probability for r in model.score(frame(spark, data)).collect()}
    assert [got[i] for i in range(len(margins))] == pytest.approx([1 / (1 + math.exp(-m)) for m in margins], abs=1e-9)
    model.save(spark, str(tmp_path / "trees"))
    again = boosting.BoostedModel.load(spark, str(tmp_path / "trees"))
    assert again.trees == model.trees and again.features == model.features
    assert sum(g for _, g in model.importance()) == pytest.approx(1) and model.importance()[0][0] in ("a", "b")


def test_labels_of_one_kind_and_missing_values(spark):
    rows = spark.createDataFrame([(1.0, 1), (2.0, 1), (None, 1), (3.0, None)], "a double, churn int")
    model = boosting.train(rows, ["a"])
    assert len(model.trees) == 1 and model.trees[0].left is None  # nothing to split
    assert [r.predicted for r in model.score(rows).collect()] == [1] * 4
    mixed = spark.createDataFrame([(None, 0)] * 20 + [(float(i), 1) for i in range(20)], "a double, churn int")
    model = boosting.train(mixed, ["a"], trees=3, max_bins=8)
    assert [r.predicted for r in model.score(mixed).filter("a IS NULL").collect()] == [0] * 20
