import zlib

import numpy as np
from conftest_llm import ODD
from pyspark.sql import functions as F

from custlens.llm import ring_shards as r


def one_by_one(loads, owners, room):
    """The rule row by row: in each round every arc offers its rows to the owner it has reached, in ring order."""
    room, filled = room.copy(), np.zeros(len(room), int)
    rows = [(a, i, a) for a, n in enumerate(loads) for i in range(n)]
    out = {}
    while rows:
        left = []
        for arc, i, at in rows:
            s = owners[at]
            if room[s]:
                room[s] -= 1
                out[arc, i] = (s, filled[s])
                filled[s] += 1
            else:
                left.append((arc, i, at))
        rows = []
        for arc, i, at in left:
            while not room[owners[at]]:
                at = (at + 1) % len(owners)
            rows.append((arc, i, at))
    return out


def test_stretches_follow_the_rule():
    draw = np.random.default_rng(3)
    for slack in (0, 0.1):
        owners = draw.integers(0, 5, 30)
        owners[:5] = range(5)
        loads = draw.integers(0, 9, 30) * (draw.random(30) < 0.7)
        loads[4] = 90  # a hot arc
        room = r.bounds(int(loads.sum()), 5, slack)
        got = {}
        for arc, low, high, shard, slot in r.place(loads, owners, room):
            got.update({(arc, i): (shard, slot + i - low) for i in range(low, high)})
        assert got == one_by_one(loads, owners, room)


def test_odd_rows(odd, nothing):
    got = r.shard_rows(odd, shards=3).toPandas()
    assert len(got) == len(ODD)
    counts = got.groupby("shard").size()
    assert counts.max() - counts.min() <= 1 and len(counts) == 3
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in ODD)
    assert sorted(zip(got["size"], got.text_crc32)) == want
    assert r.shard_rows(nothing).count() == 0


def test_one_text_in_a_third_of_rows(docs):
    got = r.shard_rows(docs([(i, "same" if i % 3 == 0 else f"text {i}") for i in range(999)])).toPandas()
    counts = got.groupby("shard").size()
    assert set(counts) == {24, 25} and len(counts) == 40


def test_equal_texts_meet_and_few_rows_move_when_there_is_room(docs):
    rows = docs([(i, f"text {i // 2}") for i in range(2000)])
    before = r.shard_rows(rows, shards=10, slack=0.3).toPandas().set_index("doc_id").shard
    after = r.shard_rows(rows, shards=11, slack=0.3).toPandas().set_index("doc_id").shard
    assert (before[before.index % 2 == 0].values == before[before.index % 2 == 1].values).mean() > 0.99
    assert (before != after).mean() < 0.25
    assert rows.select(F.count("*")).first()[0] == len(after)
