"""The registered queries and the pipeline on the smallest tables, against plain versions."""

import zlib
from pathlib import Path

import __spark_entry__ as entry_points
import corpus_pipeline
import numpy as np
import plain
import pyarrow as pa
import pytest
import test_scores
import test_tokens

from custlens.llm import quality
from custlens.llm.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables are not here")


@pytest.fixture(scope="module")
def pairs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_all_queries_are_registered():
    names = set(entry_points.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_simhash(spark, pairs):
    prints, groups = plain.simhash_groups([t for _, t in pairs])
    least = {}
    for (i, _), g in zip(pairs, groups):
        least[g] = min(i, least.get(g, i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash_bktree"](spark, FOLDER).collect()}
    assert got == {i: (f"{int(p):016x}", least[g]) for (i, _), p, g in zip(pairs, prints, groups)}


def test_token_files(spark, pairs):
    rows = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op2_elias_fano_tokens"](spark, FOLDER).collect()}
    at, want = 0, {}
    ids = plain.token_ids([t for _, t in pairs], test_tokens.PATH)
    for (i, _), x in sorted(zip(pairs, ids)):
        want[i] = (at, len(x) + 1, plain.crc([*x, 0]))
        at += len(x) + 1
    assert rows == want


def test_winnowing(spark, pairs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in QUERIES["op4_winnowing"](spark, FOLDER).collect()}
    assert got == dict(zip([i for i, _ in pairs], plain.contamination([t for _, t in pairs], items)))


def test_ring_shards(spark, pairs):
    got = QUERIES["op5_ring_shards"](spark, FOLDER).toPandas()
    counts = got.groupby("shard").size()
    assert len(got) == len(pairs) and len(counts) == 40 and counts.max() - counts.min() <= 1
    assert set(got.law) == {"rows"} and got.grown_shard.isna().all()
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_packing(spark, pairs):
    n, best = test_tokens.check_packing(QUERIES["op6_nnls_packing"](spark, FOLDER).collect(), pairs)
    assert n <= best * 1.02 + 1


def test_language_model(spark, pairs):
    rows = QUERIES["op9_recurrent_lm"](spark, FOLDER).collect()
    test_scores.check_base(rows, pairs)
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_language_model_beats_word_counts_on_unseen_documents(spark, size):
    rows = [r for r in QUERIES["op9_recurrent_lm"](spark, f"/root/testdata/{size}").collect() if r.held_out]
    gain = sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)
    better = sum(r.score > r.base_score for r in rows) / len(rows)
    assert gain > 0.15 and better > 0.85


def test_quality_as_by_a_plain_fit(spark):
    """The query at sf0.01 against gradient descent over all preference pairs, and against the labels it never saw."""
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op8_bradley_terry"](spark, folder).toPandas().set_index("doc_id")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert set(got.index) == set(texts) and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index]).all()

    x = {i: quality.features(pa.array([t], pa.string()))[0] for i, t in texts.items()}
    learnt = [i for i, q in labels.items() if i in x and q in (0, 1) and zlib.crc32(str(i).encode()) % 5]
    seen = np.array([x[i] for i in learnt])
    mean, scale = seen.mean(axis=0), seen.std(axis=0) + 1e-6
    z = {i: np.clip((v - mean) / scale, -8, 8) for i, v in x.items()}
    pairs = np.array([z[a] - z[b] for a in learnt if labels[a] for b in learnt if not labels[b]])
    weights = np.zeros(pairs.shape[1])
    for _ in range(3000):
        weights -= 0.5 * (1e-3 * weights - pairs.T @ (1 / (1 + np.exp(np.clip(pairs @ weights, -30, 30)))) / len(pairs))
    raw = {i: v @ weights for i, v in z.items()}
    cut = np.quantile([raw[i] for i in learnt], np.mean([not labels[i] for i in learnt]))
    plain_good = np.array([raw[i] >= cut for i in got.index])
    assert (plain_good == (got.predicted == 1)).mean() > 0.97
    ranks = np.argsort(np.argsort([raw[i] for i in got.index])), np.argsort(np.argsort(got.score.to_numpy()))
    assert np.corrcoef(*ranks)[0, 1] > 0.95

    unseen = [i for i, q in labels.items() if i in x and q in (0, 1) and got.held_out[i]]
    assert np.mean([got.predicted[i] == labels[i] for i in unseen]) > 0.95


def test_secrets(spark, pairs):
    test_scores.check_secrets(QUERIES["op10_grammar_secrets"](spark, FOLDER).collect(), pairs)


def test_pipeline(spark, pairs):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scores = quality.quality_scores(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r.doc_id for r in scores.filter("predicted = 1").collect()}
    kept = {}
    for i, text in sorted(p for p in pairs if p[0] in good):
        kept[text or ""] = i  # the largest id stays
    rows = sorted((i, t) for t, i in kept.items())
    groups = plain.simhash_groups([t for _, t in rows])[1]
    rows = [rows[g] for g in sorted(set(groups))]  # the least id stays
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = [r for r, leak in zip(rows, plain.contamination([t for _, t in rows], items)) if not leak[-1]]
    assert 0 < len(rows) < len(good) < len(pairs)
    test_tokens.check_packing(corpus_pipeline.run(spark, FOLDER).collect(), rows)


def test_stages_cope_with_odd_rows(spark, odd, nothing):
    for docs in (odd, nothing):
        for _, function in corpus_pipeline.STAGES[:-1]:
            out = function(spark, docs, FOLDER)
            assert out.columns == docs.columns
            out.count()
        corpus_pipeline.packed(spark, docs, FOLDER).count()
