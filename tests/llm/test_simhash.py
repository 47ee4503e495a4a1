import random

import numpy as np
import plain
from conftest_llm import ODD
from pyspark.sql import functions as F

from custlens.llm import simhash
from custlens.llm.components import components


def edited(seed, n=300):
    """Texts in families: copies of a few originals with some words replaced."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    originals = [[draw.choice(vocabulary) for _ in range(draw.choice([3, 40, 120]))] for _ in range(20)]
    out = []
    for _ in range(n):
        words = list(draw.choice(originals))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 6])):
            words[draw.randrange(len(words))] = draw.choice(vocabulary)
        out.append(" ".join(words).upper() if draw.random() < 0.2 else "  ".join(words))
    return out


def test_trees_find_all_within_the_radius():
    draw = np.random.default_rng(2)
    near = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([near, near ^ np.uint64(1), near ^ np.uint64(6), near ^ np.uint64(1 << 40), draw.integers(0, 1 << 63, 400, dtype=np.uint64)]))
    groups = draw.integers(0, 3, len(fps))
    order = np.argsort(groups, kind="stable")
    fps, groups = fps[order], groups[order]
    forest = simhash.Forest(groups, fps)
    for radius in (0, 2, 20):
        found = {(int(q), int(n)) for a, b in forest.within(groups, fps, radius) for q, n in zip(a, b)}
        want = {(i, j) for i in range(len(fps)) for j in range(len(fps)) if groups[i] == groups[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
        assert found == want


def test_components_as_by_brute_force(docs, monkeypatch):
    texts = edited(1)
    for size, rows in ((20_000, 200_000), (20_000, 0), (7, 0)):  # trees broadcast; met by a shuffle; crowded shards split
        monkeypatch.setattr(simhash, "TREE_SIZE", size)
        monkeypatch.setattr(simhash, "FOREST_ROWS", rows)
        got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs(enumerate(texts))).collect()}
        prints, groups = plain.simhash_groups(texts)
        assert got == {i: (f"{int(p):016x}", g) for i, (p, g) in enumerate(zip(prints, groups))}


def test_both_ways_link_crowded_shards_alike(spark, monkeypatch):
    draw = np.random.default_rng(5)
    near = draw.integers(0, 1 << 63, 30, dtype=np.uint64)
    flips = np.uint64(1) << draw.integers(0, 64, (30, 40), dtype=np.uint64)
    steps = np.bitwise_xor.accumulate(np.concatenate([near[:, None], flips], axis=1), axis=1)  # chains, one bit a step
    fps = np.unique(np.concatenate([steps.ravel(), draw.integers(0, 1 << 63, 500, dtype=np.uint64)]))
    nodes = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "_fp long").repartition(5)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    label = np.arange(len(fps))
    while not np.array_equal(label, least := np.where(near, label[None, :], len(fps)).min(axis=1)):
        label = least
    want = {(int(a), int(b)) for i, a in enumerate(fps.view(np.int64)) for j, b in enumerate(fps.view(np.int64)) if i != j and label[i] == label[j]}
    for rows in (200_000, 0):
        monkeypatch.setattr(simhash, "FOREST_ROWS", rows)
        hung = components(simhash.fingerprint_links(nodes, 2, 4)).collect()
        sets = {}
        for r in hung:
            sets.setdefault(r.component, {r.component}).add(r.node)
        assert {(a, b) for s in sets.values() for a in s for b in s if a != b} == want


def test_odd_rows(odd, nothing):
    got = simhash.simhash_components(odd).toPandas()
    assert len(got) == len(ODD)
    assert set(got[got.fingerprint == "0" * 16].component_id) == {2} and (got.fingerprint == "0" * 16).sum() == 4
    assert simhash.simhash_components(nothing).count() == 0


def test_components_of_long_chains_and_repeats(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 100)] * 2
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_as_by_brute_force(docs):
    texts = edited(2)
    frame = docs(enumerate(texts)).withColumns({c: F.lit(1) for c in ("_fp", "_row", "_fp0", "_kept")})
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(plain.simhash_groups(texts)[1]))


def test_near_copies_of_odd_rows(odd, nothing):
    got = [r.doc_id for r in simhash.drop_near_duplicates(odd).collect()]
    # equal texts, and all texts without words: one each
    assert sorted(got, key=str) == sorted([1, 2, None, 7, 8], key=str)
    assert simhash.drop_near_duplicates(nothing).count() == 0
