import hashlib

import numpy as np
from conftest_llm import ODD

from custlens.llm import exact_dedup as e


def test_filters_are_lossless_and_merge():
    draw = np.random.default_rng(1)
    parts = [draw.integers(0, 1 << 60, 500, dtype=np.uint64) >> np.uint64(k) for k in (0, 30, 58)]
    parts.append(np.array([0, 0, 5, (1 << 60) - 1], np.uint64))
    blobs = []
    for p in parts:
        values, counts = np.unique(p, return_counts=True)
        blob = e.build_filter(values, counts, 60)
        back, n = e.read_filter(blob)
        assert np.array_equal(back, values) and np.array_equal(n, counts)
        blobs.append(blob)
    back, n = e.read_filter(e.merge_filters(blobs, 60))
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    assert np.array_equal(back, values) and np.array_equal(n, counts)


def test_odd_rows(odd):
    got = e.exact_groups(odd).toPandas()
    assert len(got) == len(ODD)
    by_text = {}
    for i, t in ODD:
        by_text.setdefault(t or "", []).append(i)
    for r in got.itertuples():
        text = next(t for t in by_text if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(by_text[text])
    kept = got[got.kept]
    assert len(kept) == len(by_text) == kept.text_sha256.nunique()
    assert set(kept[kept.group_size == 3].doc_id) == {5, 3}  # the text; null, null with no id, and empty


def test_rows_that_stay_keep_their_columns(odd, nothing):
    kept = e.drop_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == len({t or "" for _, t in ODD})
    assert e.exact_groups(nothing).count() == 0 == e.drop_repeats(nothing).count()


def test_one_text_in_most_rows(docs):
    got = e.exact_groups(docs([(i, "same" if i % 3 else f"own {i}") for i in range(600)])).toPandas()
    assert got[got.kept].shape[0] == 201 and set(got[got.group_size > 1].keep_id) == {599}


def test_counting_sorts_a_few_times_what_it_counts(monkeypatch):
    draw = np.random.default_rng(4)
    rows = draw.integers(0, 1 << 63, 400_000, dtype=np.uint64)
    rows[::3] = rows[0]
    worked = []
    plain_sum = e._sum_by
    monkeypatch.setattr(e, "_sum_by", lambda f, c: worked.append(len(f)) or plain_sum(f, c))
    monkeypatch.setattr(e, "WAITING", 1 << 12)
    values, counts = e.count_fingerprints(rows[i : i + 1_000] for i in range(0, len(rows), 1_000))
    want = np.unique(rows, return_counts=True)
    assert np.array_equal(values, want[0]) and np.array_equal(counts, want[1])
    assert sum(worked) < 4 * len(rows)
    assert len(e.count_fingerprints([])[0]) == 0
