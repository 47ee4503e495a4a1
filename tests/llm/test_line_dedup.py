import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD

from custlens.llm import line_dedup
from custlens.llm.line_dedup import apply_bitmaps, drop_repeated_lines, keep_bitmaps

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least_chars=20, least_docs=3):
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(_LOWER)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(float("-inf") if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = float("-inf") if doc is None else doc
        kept = [x for x in lines if len(key(x)) < least_chars or len(holders[key(x)]) < least_docs or own == max(holders[key(x)])]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def rows_of(seed):
    draw = random.Random(seed)
    lines = [f"Line {i} that is long enough {'é' * (i % 3)}" for i in range(12)] + ["ééééééééééééééééééé", "short", "", "  License, all rights reserved.\t"]
    rows = [(i, "\n".join(draw.choice(["", " ", "\x0b"]) + draw.choice([str.upper, str])(draw.choice(lines)) for _ in range(draw.randrange(0, 20)))) for i in range(80)]
    hot = [(1000 + i, "The hot line of all documents\nown line number %d of it" % i) for i in range(300)]
    return rows + hot + ODD + [(3000, "The hot line of all documents\n" * 5_000), (None, lines[0]), (1005, "the hot line of all documents")]


def test_lines(spark, docs):
    rows = rows_of(2)
    got = drop_repeated_lines(docs(rows).repartition(7))
    assert got.columns == ["doc_id", "kept_text", "n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_other_bounds(spark, docs):
    rows = rows_of(3)
    bitmaps = keep_bitmaps(docs(rows), least_chars=5, least_docs=2)
    assert sorted((tuple(r) for r in apply_bitmaps(docs(rows), bitmaps).collect()), key=str) == plain(rows, 5, 2)


def test_nothing(nothing):
    assert drop_repeated_lines(nothing).count() == 0
    assert keep_bitmaps(nothing).count() == 0


@pytest.mark.parametrize("size, wait", [(1, 3), (3, 2), (50, 1000), (7, 1)])
def test_runs_cut_by_batches_and_tasks(monkeypatch, size, wait):
    """Every task and batch boundary gives the same lines to drop."""
    monkeypatch.setattr(line_dedup, "_LINE_ROWS", wait)
    draw = np.random.default_rng(size)
    rows = np.unique(np.column_stack([draw.integers(0, 6, 400), draw.integers(0, 2, 400), draw.integers(0, 9, 400), np.zeros(400, int), draw.integers(0, 5, 400)]), axis=0)
    rows = rows[np.lexsort((rows[:, 4], rows[:, 3], -rows[:, 2], rows[:, 1], rows[:, 0]))]
    docs = defaultdict(set)
    for a, b, doc, *_ in rows.tolist():
        docs[a, b].add(doc)
    want = [r for r in rows.tolist() if len(docs[r[0], r[1]]) >= 3 and r[2] < max(docs[r[0], r[1]])]
    found, largest, waiting = [], defaultdict(set), []
    for task in np.array_split(rows, 5):
        batches = [pa.RecordBatch.from_arrays([pa.array(part[:, k]) for k in range(5)], names=line_dedup._LINES.names) for part in np.array_split(task, -(-len(task) // size))]
        for marks in line_dedup._streamed(3)(iter(batches)):
            for kind, *row in zip(*(c.to_pylist() for c in marks.columns)):
                if kind == line_dedup._DROP:
                    found.append(row)
                elif kind == line_dedup._UNDECIDED:
                    waiting.append(row)
                else:
                    largest[row[0], row[1]].add(row[2])
    found += [r for r in waiting if len(largest[r[0], r[1]]) >= 3 and r[2] < max(largest[r[0], r[1]])]
    assert sorted(found) == sorted(want)
