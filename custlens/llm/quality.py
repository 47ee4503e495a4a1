"""Text quality by Bradley-Terry ranking.

A preference pair says that a document labelled good beats one labelled bad. Scores are linear in features of the whole
text, and the chance that one document beats another is the logistic function of the difference of their scores, so
the weights come from a logistic regression on feature differences without an intercept. A score becomes a decision
by a quantile of the training scores: as many documents fall below it as are labelled bad.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.order_stats import exact_quantiles
from custlens.llm.arrow import pieces, utf8
from custlens.llm.decontamination import Words
from custlens.session import stage

BLOCK_ROWS = 20_000  # training rows that are paired with each other, about
PAIRS = 100_000  # of a block

FEATURES = [
    "upper", "digits", "wide", "symbols", "marks", "pipes", "full_stops", "commas", "line_feeds", "spaces",
    "word_length", "again", "again_2", "distinct", "words", "top", "short", "upper_words",
]


def _member(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_UPPER = _member(bytes(range(65, 91)))
_CLASSES = [
    _UPPER,
    _member(b"0123456789"),
    _member(bytes(range(128, 256))),
    _member(b"#$%&*+<=>@[\\]^_`{}~/"),
    _member(b"!?;:\"'()-"),
    _member(b"|"),
    _member(b"."),
    _member(b","),
    _member(b"\n"),
    _member(b" \t\r"),
]


def features(column: pa.Array) -> np.ndarray:
    """One row of features per text. Shares are taken on a log scale; an empty text has zeros."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    sizes = np.maximum(np.diff(offsets), 1)

    def count(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[edges[1:]] - total[edges[:-1]]).astype(float)

    shares = [count(c[data], offsets) / sizes for c in _CLASSES]
    words = Words(data, offsets)
    edges, n_words = words.edges, np.diff(words.edges)
    per_word = np.maximum(n_words, 1)
    hashes = words.hashes()
    row = np.repeat(np.arange(n), n_words)
    lengths = words.ends - words.starts

    def same_as(back: int) -> np.ndarray:
        flags = np.zeros(len(hashes), bool)
        flags[back:] = (hashes[back:] == hashes[:-back]) & (row[back:] == row[:-back])
        return flags

    order = np.lexsort((hashes, row))
    first = np.ones(len(order), bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = np.bincount(row[order][first], minlength=n).astype(float)
    begins = np.flatnonzero(first)
    top = np.zeros(n)
    np.maximum.at(top, row[order][begins], np.diff(np.append(begins, len(order))))
    starts_upper = _UPPER[data[words.starts]] if len(words.starts) else np.zeros(0, bool)
    ends_upper = _UPPER[data[words.ends - 1]] if len(words.starts) else np.zeros(0, bool)
    table = [
        *(np.log1p(50 * s) for s in shares),
        count(lengths, edges) / per_word / 10,
        count(same_as(1), edges) / per_word if len(hashes) > 1 else np.zeros(n),
        count(same_as(2), edges) / per_word if len(hashes) > 2 else np.zeros(n),
        np.log1p(distinct) / np.log1p(np.maximum(n_words, 1)),
        np.log1p(n_words) / 10,
        top / per_word,
        count(lengths < 4, edges) / per_word,
        count(starts_upper & ends_upper & (lengths > 1), edges) / per_word,
    ]
    return np.stack(table, axis=1) if n else np.zeros((0, len(FEATURES)))


@dataclass
class Ranking:
    """Weights for standardised features, and the straight line from a raw score to the logit of the result."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the cut falls on the threshold."""
        logit = np.log(self.threshold / (1 - self.threshold)) + self.slope * (self.raw(x) - self.cut)
        return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, offset: float = 0.0) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums of gradient and curvature over rows, and their number."""
    p = 1 / (1 + np.exp(-np.clip(x @ w + offset, -30, 30)))
    return x.T @ (p - y), (x * (p * (1 - p))[:, None]).T @ x, len(y)


def _newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, int]], size: int, ridge: float, steps: int = 40) -> np.ndarray:
    """Logistic regression without an intercept, from the sums at given weights."""
    w = np.zeros(size)
    for _ in range(steps):
        gradient, curve, n = sums(w)
        step = np.linalg.solve(curve / n + ridge * np.eye(size), gradient / n + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(x: np.ndarray, good: np.ndarray, threshold: float = 0.3, pairs: int = PAIRS, ridge: float = 1e-3) -> Ranking:
    """Learn from labelled rows. With one kind of label only there is nothing to rank: that label's side of the cut is returned for all."""
    mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    scale = x.std(axis=0) + 1e-6 if len(x) else np.ones(x.shape[1])
    better, worse = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(better) or not len(worse):
        return Ranking(mean, scale, np.zeros(x.shape[1]), 0.5 if len(worse) else -0.5, 1.0, threshold)
    z = np.clip((x - mean) / scale, -8, 8)
    draw = np.random.default_rng(7)
    difference = z[draw.choice(better, pairs)] - z[draw.choice(worse, pairs)]
    weights = _newton(lambda w: _logistic(difference, np.ones(pairs), w), x.shape[1], ridge)
    raw = z @ weights
    cut = float(np.quantile(raw, len(worse) / len(x)))
    offset = float(np.log(threshold / (1 - threshold)))
    line = _newton(lambda w: _logistic((raw - cut)[:, None], good.astype(float), w, offset), 1, 1e-6)
    return Ranking(mean, scale, weights, cut, max(float(line[0]), 1e-3), threshold)


def held_out(id_col: str, folds: int = 5) -> Column:
    """Rows never learnt from: crc32 of the id as text is a multiple of ``folds``. A null id reads as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % folds == 0


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, x``: the features of every row, written once for training and scoring."""
    kind = docs.schema[id_col].dataType.simpleString()

    def measure(batches):
        for batch in batches:
            for part in pieces(batch, "_text"):
                x = features(part.column(part.schema.get_field_index("_text")))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("_id")), lists], names=["_id", "x"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return stage(rows.mapInArrow(measure, f"_id {kind}, x array<double>"), "quality-features")


def _block(table: pa.Table) -> pa.Table:
    """The rows of a block as one row, in an order of their own."""
    x, hashes = _matrix(table.column("x").combine_chunks()), table.column("hash").to_numpy()
    order = np.lexsort([*x.T[::-1], hashes])
    label = table.column("_label").to_numpy()[order].astype(np.int8)
    return pa.table({"label": pa.array([label.tobytes()], pa.binary()), "x": pa.array([x[order].tobytes()], pa.binary())})


def _blocks(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for label, x in zip(batch.column(0), batch.column(1)):
            yield np.frombuffer(label.as_py(), np.int8).astype(float), np.frombuffer(x.as_py(), float).reshape(-1, len(FEATURES))


def _added(blocks: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of some figures of each; tasks add up their own first, so that one row of each reaches the driver."""

    def add(batches):
        found = [of(label, x) for label, x in _blocks(batches)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([np.sum(found, axis=0)], pa.list_(pa.float64()))], names=["s"])

    return np.sum([r.s for r in blocks.mapInArrow(add, "s array<double>").collect()], axis=0)


def _paired(z: np.ndarray, label: np.ndarray, pairs: int) -> np.ndarray:
    """Differences of good and bad rows; all rows of a label take part equally often (but for one time)."""
    better, worse = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(better) or not len(worse):
        return np.zeros((0, z.shape[1]))
    draw, n = np.random.default_rng(7), max(pairs, len(better), len(worse))

    def cycles(rows: np.ndarray) -> np.ndarray:
        return np.concatenate([draw.permutation(rows) for _ in range(-(-n // len(rows)))])[:n]

    return z[cycles(better)] - z[cycles(worse)]


def fit_blocks(blocks: DataFrame, threshold: float = 0.3, pairs: int = PAIRS, ridge: float = 1e-3) -> Ranking:
    """:func:`fit` on all rows of all blocks: pairs are formed inside a block, all else covers all rows together."""
    size = len(FEATURES)
    found = _added(blocks, lambda label, x: np.concatenate([[len(x), (label == 1).sum()], x.sum(axis=0)]))
    n, good, mean = found[0], found[1], found[2:] / found[0]
    scale = np.sqrt(_added(blocks, lambda label, x: ((x - mean) ** 2).sum(axis=0)) / n) + 1e-6
    if good in (0, n):
        return Ranking(mean, scale, np.zeros(size), -0.5 if good else 0.5, 1.0, threshold)

    def flat(sums: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
        return np.concatenate([sums[0], sums[1].ravel(), [sums[2]]])

    def unflat(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        return s[:k], s[k:-1].reshape(k, k), s[-1]

    def of_pairs(w: np.ndarray):
        def of(label: np.ndarray, x: np.ndarray) -> np.ndarray:
            difference = _paired(np.clip((x - mean) / scale, -8, 8), label, pairs)
            return flat(_logistic(difference, np.ones(len(difference)), w))

        return unflat(_added(blocks, of), size)

    ranking = Ranking(mean, scale, _newton(of_pairs, size, ridge), 0.0, 1.0, threshold)

    def raw(batches):
        for _, x in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ranking.raw(x), pa.float64())], names=["raw"])

    ranking.cut = float(exact_quantiles(blocks.mapInArrow(raw, "raw double"), ["raw"], [float(1 - good / n)]).first()["raw_q"][0])
    offset = float(np.log(threshold / (1 - threshold)))

    def of_line(w: np.ndarray):
        return unflat(_added(blocks, lambda label, x: flat(_logistic((ranking.raw(x) - ranking.cut)[:, None], label, w, offset))), 1)

    ranking.slope = max(float(_newton(of_line, 1, 1e-6)[0]), 1e-3)
    return ranking


def train(found: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", rows: int = BLOCK_ROWS, threshold: float = 0.3) -> Ranking:
    """Learn from all labelled rows of :func:`measured` outside the held-out fold.

    Labels other than 0 and 1 and null labels are left out; of several labels of a document the largest counts. Up to ``rows``
    rows are fitted on the driver, more in blocks of about so many.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    usable = stage(found.join(known, "_id").select("_label", "x", "_id", F.xxhash64("_id").alias("hash")), "quality-training")
    n = usable.count()
    if n <= rows:
        # The same rows in the same order every time, whatever order the tasks end in.
        table = usable.orderBy("hash", "x").limit(rows).toArrow()
        x = np.array(table.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
        return fit(x, table.column("_label").to_numpy(), threshold)
    block = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(-(-n // rows))).alias("block")
    blocks = usable.select("_label", "x", "hash", block).groupBy("block").applyInArrow(_block, "label binary, x binary")
    return fit_blocks(stage(blocks, "quality-blocks"), threshold)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The id, ``held_out``, ``score`` (0 to 1, higher is better), ``predicted`` of every row.

    Scores depend on the text alone. Null texts count as empty and get a score too; repeated rows get the same. Without
    usable labels of both kinds all rows get one decision. No rows give no rows.
    """
    found = measured(docs, id_col, text_col)
    ranking = train(found, labels, id_col=id_col, threshold=threshold)

    def add(batches):
        for batch in batches:
            score = ranking.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=[id_col, "score"])

    scored = found.mapInArrow(add, f"`{id_col}` {found.schema['_id'].dataType.simpleString()}, score double")
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, columns unchanged."""
    known = docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col))
    ranking = train(measured(known, id_col, text_col), labels, id_col=id_col, threshold=threshold)

    def good(batches):
        for batch in batches:
            for part in pieces(batch, text_col):
                score = ranking.score(features(part.column(part.schema.get_field_index(text_col))))
                yield part.filter(pa.array(score >= threshold))

    return docs.mapInArrow(good, docs.schema)
