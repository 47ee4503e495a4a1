import random

import numpy as np
import plain
from conftest_llm import ODD

from custlens.llm import decontamination as d


def texts_and_items(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["Zoë", "A1", "ß"]
    item = lambda n: " ".join(draw.choice(words) for _ in range(n))
    items = [(i, item(draw.choice([0, 1, 3, 9, 10, 11, 25, 60]))) for i in range(30)]
    items += [(90, items[5][1]), (91, None), (91, "..."), (None, item(12)), (5, items[5][1])]
    texts = []
    for _ in range(150):
        parts = [item(draw.randrange(12))]
        for _ in range(draw.randrange(3)):
            source = (draw.choice(items)[1] or "").split()
            at = draw.randrange(len(source) + 1)
            parts += [draw.choice([" ".join, "!\n".join])([w.upper() for w in source[at : at + draw.choice([5, 9, 10, 14, 40])]]), item(draw.randrange(4))]
        texts.append(", ".join(parts))
    return texts, items


def run(spark, docs, texts, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS window")
    rows = d.contamination(docs(enumerate(texts)), benchmark).collect()
    clean = d.drop_contaminated(docs(enumerate(texts)), benchmark)
    return rows, clean


def test_as_by_brute_force(spark, docs, monkeypatch):
    texts, items = texts_and_items(1)
    want = plain.contamination(texts, items)
    assert 10 < sum(w[-1] for w in want) <= len(texts)
    for size in (16_000_000, 3_000):  # the second: several slices
        monkeypatch.setattr(d, "BYTES_PER_SLICE", size)
        rows, clean = run(spark, docs, texts, items)
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}
        assert got == dict(enumerate(want))
        assert {r.doc_id for r in clean.collect()} == {i for i, w in enumerate(want) if not w[-1]}


def test_long_items_only(spark, docs):
    texts, items = texts_and_items(2)
    items = [(i, t) for i, t in items if t and len(t.split()) >= 10]
    rows, _ = run(spark, docs, texts, items)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == dict(enumerate(plain.contamination(texts, items)))


def test_every_window_keeps_a_fingerprint():
    draw = np.random.default_rng(1)
    for _ in range(50):
        hashes = draw.integers(0, 4, 80).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        begins = np.arange(len(hashes) - d.WINDOW + 1)
        everywhere = set(d.winnow(hashes, begins)[0].tolist())
        for at in begins.tolist():
            alone = d.winnow(hashes[at : at + d.WINDOW], np.array([0]))[0] + at
            assert set(alone.tolist()) <= everywhere


def test_odd_rows(spark, odd, nothing):
    benchmark = spark.createDataFrame([(1, "plain words plain"), (2, "long"), (3, "漢字")], "item_id long, text string")
    want = plain.contamination([t for _, t in ODD], [(1, "plain words plain"), (2, "long"), (3, "漢字")])
    got = sorted(((r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in d.contamination(odd, benchmark).collect()))
    assert got == sorted(want)
    empty = benchmark.limit(0)
    assert not any(r.contaminated for r in d.contamination(odd, empty).collect())
    assert d.drop_contaminated(odd, empty).count() == len(ODD)
    assert d.contamination(nothing, benchmark).count() == 0 == d.drop_contaminated(nothing, benchmark).count()


def test_one_slice_of_the_benchmark_is_held_at_a_time(spark, docs, monkeypatch):
    texts, items = texts_and_items(3)
    monkeypatch.setattr(d, "BYTES_PER_SLICE", 6_500)
    held, most = set(), []
    broadcast = spark.sparkContext.broadcast

    def counted(value):
        shared = broadcast(value)
        if isinstance(value, d.Windows):
            held.add(id(shared))
            most.append(len(held))
            destroy = shared.destroy
            shared.destroy = lambda blocking=False: (held.discard(id(shared)), destroy(blocking))
        return shared

    monkeypatch.setattr(spark.sparkContext, "broadcast", counted)
    rows, clean = run(spark, docs, texts, items)
    want = plain.contamination(texts, items)
    assert {r.doc_id: r.contaminated for r in rows} == {i: w[-1] for i, w in enumerate(want)}
    assert {r.doc_id for r in clean.collect()} == {i for i, w in enumerate(want) if not w[-1]}
    assert len(most) >= 10 and max(most) <= 2  # the last one of each function stays
