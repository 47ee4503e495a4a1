import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from conftest_llm import ODD

from custlens.llm import packing, token_files
from custlens.llm.tokens import ChunkEncoder, public_tokenizer

PATH = public_tokenizer("byte_bpe_50k.json")

STRANGE = [
    "", " ", "\n\n\n", "a  b   c\t\td", "it's we'll 'tis ' s", "x  y z 　", "end \n ", "tab\t word", "\x1c a\x1db \x85c",
    "<|endoftext|> <|endoftext|>x", "1234567 12,5 $%&", "\u0085\u0085 a", "emoji \U0001f600\U0001f600 é", "y" * 300, " .. ,, !", "é è", "﻿ bom", "​ zero",
]


def test_ids_are_the_librarys():
    draw = random.Random(4)
    alphabet = "ab c\n\t.,' é漢1!\x1f  "
    texts = STRANGE + ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(3000)] + STRANGE
    want = plain.token_ids(texts, PATH)
    for cached in (400_000, 50):
        encoder = ChunkEncoder(PATH, cached)
        for start in range(0, len(texts), 40):
            ids, edges = encoder.encode(pa.array(texts[start : start + 40]))
            assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])] == want[start : start + 40]


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [0, 1, 2, 3], [7] * 600, list(range(0, 90_000, 7)), [0, 2**40, 2**40 + 1]])
def test_elias_fano_lists(values):
    blob = token_files.EliasFano.of(np.array(values, np.int64)).to_bytes()
    back, end = token_files.EliasFano.read(b"head" + blob, 4)
    assert end == len(blob) + 4 and back.all().tolist() == values
    assert [back[i] for i in range(len(values))] == values
    with pytest.raises(IndexError):
        back[len(values)]


def test_stretches_of_a_list():
    draw = np.random.default_rng(8)
    for most in (1, 3, 2000, 2**33):
        values = np.cumsum(draw.integers(0, most, 3000))
        whole = token_files.EliasFano.of(values)
        for first, last in [(0, 0), (0, 1), (255, 257), (256, 512), (511, 3000), (2999, 3000), *np.sort(draw.integers(0, 3001, (20, 2)), axis=1)]:
            assert whole.between(first, last).tolist() == values[first:last].tolist()


@pytest.mark.parametrize("size", [1, 7, 300, 4096])
def test_documents_of_a_file_in_stretches(size):
    draw = np.random.default_rng(5)
    lengths = draw.integers(1, 40, 900)
    starts = np.cumsum(lengths) - lengths
    names = [None] * 20 + np.sort(draw.integers(-(2**40), 2**40, 880)).tolist()
    file = token_files.TokenFile(token_files.write_file(np.arange(lengths.sum()) % 50_000, starts, names, 2))
    parts = list(file.stretches(size))
    assert max(len(p[0]) for p in parts) <= size
    assert [n for p in parts for n in p[0]] == names == file.doc_ids()
    assert np.concatenate([p[1] for p in parts]).tolist() == starts.tolist()
    assert np.concatenate([p[2] for p in parts]).tolist() == (starts + lengths).tolist()
    assert list(token_files.TokenFile(token_files.write_file(np.zeros(0), np.zeros(0), [], 2)).stretches(size)) == []


def test_boundaries_take_little_space():
    starts = np.cumsum(np.random.default_rng(6).integers(1, 2000, 10_000))
    assert len(token_files.EliasFano.of(starts).to_bytes()) < 10_000 * 13 / 8 * 1.1


def by_key(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=str)


def test_files_are_read_back(odd, nothing, monkeypatch):
    monkeypatch.setattr(token_files, "TOKENS_PER_FILE", 50)
    files = token_files.write_tokens(odd, PATH)
    rows = token_files.read_tokens(files).collect()
    ids = plain.token_ids([t for _, t in ODD], PATH)
    want = [{"doc_id": i, "n_tokens": len(x) + 1, "ids_crc32": plain.crc([*x, 0])} for (i, _), x in zip(ODD, ids)]
    assert by_key(rows, "doc_id", "n_tokens", "ids_crc32") == by_key(want, "doc_id", "n_tokens", "ids_crc32")
    at, last = 0, -1
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and (r.doc_id is None or r.doc_id >= last)
        at, last = at + r.n_tokens, last if r.doc_id is None else r.doc_id
    for r in files.collect():
        file = token_files.TokenFile(bytes(r.blob))
        assert len(file) == r.n_docs and sum(len(file[i]) for i in range(len(file))) == r.n_tokens
    assert token_files.read_tokens(token_files.write_tokens(nothing, PATH)).count() == 0


def check_packing(rows, pairs, capacity=1024):
    ids = plain.token_ids([t for _, t in pairs], PATH)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    want = []
    for (i, _), x in zip(pairs, ids):
        x = [*x, 2]
        cuts = [0, *range(len(x) % capacity or capacity, len(x) + 1, capacity)]
        want += [(i, k, a, b - a, plain.crc(x[a:b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    return len(by_sequence), -(-sum(len(x) + 1 for x in ids) // capacity)


def test_pieces_are_packed(odd, nothing):
    packed = packing.pack(odd, PATH, with_ids=True)
    check_packing(packed.collect(), ODD)
    whole = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == sum(r.length for r in packed.collect()) and max(len(r.ids) for r in whole) <= 1024
    assert packing.pack(nothing, PATH).count() == 0


def test_few_sequences():
    draw = np.random.default_rng(8)
    for lengths in (draw.integers(1, 1025, 20_000), np.minimum(1024, draw.lognormal(5, 1, 30_000).astype(int) + 1), np.full(999, 400), np.array([1024])):
        histogram = np.bincount(lengths, minlength=1025)
        contents = packing.plan(histogram, 1024)
        used = np.zeros(1025, int)
        for content, times in contents:
            assert sum(content) <= 1024
            for x in content:
                used[x] += times
        assert np.array_equal(used, histogram)
        n = sum(times for _, times in contents)
        assert n <= sum(packing.best_fit(histogram, 1024).values()) * 1.002 + 1  # best-fit decreasing alone
        assert n >= max(-(-int(lengths.sum()) // 1024), int((lengths > 512).sum()))


def test_repeats_solve_the_least_squares():
    patterns = packing.exact_patterns(12)
    assert all(sum(p) == 12 for p in patterns) and len(set(patterns)) == len(patterns)
    histogram = np.array([0, 5, 9, 4, 8, 2, 7, 3, 1, 0, 6, 2, 0.0])
    times = packing.fit_repeats(histogram, patterns, sweeps=400)
    matrix = np.array([[p.count(x) for p in patterns] for x in range(13)], float)
    pull = matrix.T @ (histogram - matrix @ np.array(times))  # optimal: no pull where used, no upward pull anywhere
    assert all(abs(g) < 1e-3 if t > 0 else g < 1e-3 for g, t in zip(pull, times))


def test_a_process_keeps_one_encoder():
    """Two hundred tasks in a worker process leave its memory as it was."""
    import subprocess
    import sys
    from pathlib import Path

    script = f"""
import resource
import pyarrow as pa
from custlens.llm.tokens import vocabulary_size, worker_encoder
def task(k):
    worker_encoder({PATH!r}).encode(pa.array(["some words of a text", "more words %d" % k]))
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
first = task(0)
print(max(task(k) for k in range(200)) - first, vocabulary_size({PATH!r}))
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[2], timeout=120)
    grown, size = out.stdout.split()
    assert float(grown) < 20 and int(size) > 50_000
