"""Repeated lines across documents, removed through per-document bitmaps.

Every line long enough gets a 128-bit hash of its key. The hashes are range-partitioned together with document and
position, so a line that a third of the corpus holds spreads over as many tasks as it needs, and each task streams its
lines: the first document of a hash (the largest id) keeps it, later ones lose it. A run of one hash that may go on in a
neighbouring task is left open with its three largest documents, which is all that the verdict over the whole run
needs. What comes back is not text but one compressed bitmap of kept lines per document.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.llm.arrow import pieces, table
from custlens.session import stage

NO_ID = -(2**63)  # a null document id: one document, less than all others
TEXT_BYTES = 8_000_000  # split at once
_LINE_ROWS = 200_000

_LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("text_hash", pa.int64()), ("pos", pa.int64())])
_MARKS = pa.schema([("kind", pa.int8()), *_LINES])
_MARK_COLUMNS = "kind tinyint, h1 long, h2 long, doc long, text_hash long, pos long"
_DROP, _UNDECIDED, _LARGEST = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """White space at both ends stripped, A-Z in lower case."""
    return line.strip().lower()  # of bytes, both know ASCII only


def _hashed_lines(least: int):
    def run(batches):
        digest = xxhash.xxh3_128_intdigest
        for batch in (p for b in batches for p in pieces(b, "_text", TEXT_BYTES)):
            hashes, docs, texts, places = [], [], [], []
            for doc, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if text.as_py() is None:
                    continue
                for place, line in enumerate(memoryview(text.as_buffer()).tobytes().split(b"\n")):
                    if len(line) < least:
                        continue
                    key = line_key(line)
                    if len(key) < least or not key.isascii() and len(key.decode()) < least:
                        continue
                    hashes.append(digest(key))
                    docs.append(doc)
                    texts.append(text_hash)
                    places.append(place)
                if len(hashes) >= _LINE_ROWS:
                    yield _line_rows(hashes, docs, texts, places)
                    hashes, docs, texts, places = [], [], [], []
            if hashes:
                yield _line_rows(hashes, docs, texts, places)

    return run


def _line_rows(hashes, docs, texts, places) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(h.to_bytes(16, "little") for h in hashes), "<i8").reshape(-1, 2)
    return table(_LINES, h1=halves[:, 0], h2=halves[:, 1], doc=docs, text_hash=texts, pos=places)


def _dropped(rows: np.ndarray, least_docs: int) -> np.ndarray:
    """Lines to drop of whole runs: those of all documents but the first, where enough documents have the hash."""
    if not len(rows):
        return rows
    new_run = np.ones(len(rows), bool)
    new_run[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    new_doc = new_run.copy()
    new_doc[1:] |= rows[1:, 2] != rows[:-1, 2]
    starts = np.flatnonzero(new_run)
    run = np.cumsum(new_run) - 1
    so_far = np.cumsum(new_doc)
    number = so_far - so_far[starts][run]  # of the document in its run, from 0
    n_docs = np.add.reduceat(new_doc, starts)
    return rows[(number > 0) & (n_docs[run] >= least_docs)]


def _marks(kind: int, rows: np.ndarray) -> pa.RecordBatch:
    return table(_MARKS, kind=np.full(len(rows), kind, np.int8), **{c: rows[:, k] for k, c in enumerate(_LINES.names)})


def _streamed(least_docs: int):
    """Drops of hashes that lie inside the task. Stretches of a hash that may have more lines elsewhere (the task's first and
    last hash, and one too long to wait for) go on undecided, each with its largest documents."""

    def undecided(rows: np.ndarray):
        yield _marks(_UNDECIDED, rows)
        first = rows[np.flatnonzero(np.append(True, rows[1:, 2] != rows[:-1, 2]))[:least_docs]]
        yield _marks(_LARGEST, first)

    def run(batches):
        tail, split = np.zeros((0, 5), np.int64), None
        for batch in batches:
            rows = np.concatenate([tail, np.column_stack([batch.column(c).to_numpy() for c in range(5)])])
            if not len(rows):
                continue
            split = tuple(rows[0, :2]) if split is None else split
            same = (rows[:, :2] == rows[-1, :2]).all(axis=1)
            cut = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                n = int((rows[:cut, :2] == split).all(axis=1).sum())  # ascending order: they come first
                if n:
                    yield from undecided(rows[:n])
                dropped = _dropped(rows[n:cut], least_docs)
                if len(dropped):
                    yield _marks(_DROP, dropped)
            tail = rows[cut:]
            if len(tail) >= _LINE_ROWS:
                yield from undecided(tail)
                split, tail = tuple(tail[0, :2]), tail[:0]
        if len(tail):
            yield from undecided(tail)

    return run


def _bitmaps(batches):
    """Positions of dropped lines, in order, to one row per document."""
    out = pa.schema([("doc", pa.int64()), ("text_hash", pa.int64()), ("n_dropped", pa.int64()), ("keep", pa.binary())])

    def rows(held):
        edges = np.flatnonzero(np.append(True, (held[1:, :2] != held[:-1, :2]).any(axis=1)))
        packed, n = [], []
        for a, b in zip(edges, np.append(edges[1:], len(held))):
            places = np.unique(held[a:b, 2])
            keep = np.ones((int(places[-1]) // 8 + 1) * 8, np.uint8)
            keep[places] = 0
            packed.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1))
            n.append(len(places))
        return table(out, doc=held[edges, 0], text_hash=held[edges, 1], n_dropped=n, keep=packed)

    tail = np.zeros((0, 3), np.int64)
    for batch in batches:
        held = np.concatenate([tail, np.column_stack([batch.column(c).to_numpy() for c in range(3)])])
        if not len(held):
            continue
        same = (held[:, :2] == held[-1, :2]).all(axis=1)
        cut = len(held) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield rows(held[:cut])
        tail = held[cut:]
    if len(tail):
        yield rows(tail)


def _identity(id_col: str, text_col: str) -> list[Column]:
    """What a document is known by: rows with equal id and text have equal lines, so they share a bitmap."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash")]


def keep_bitmaps(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, text_hash, n_dropped, keep`` of every document that loses lines.

    ``keep`` is a zlib-compressed bitmap, lowest bit first: 1 for lines that stay; lines beyond its end stay. Lines are what
    newlines separate. Lines whose key (see ``line_key``) has ``least_chars`` code points or more and occurs in
    ``least_docs`` documents or more go, except in the largest document id that has the key, where all of them stay. Rows with
    equal ids count as one document; rows with a null id count together as one below all others. Documents without
    repeated lines, null texts and empty tables give no rows; other columns are not looked at.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(*_identity(id_col, text_col), F.col(text_col).cast("string").alias("_text"))
    lines = stage(texts.mapInArrow(_hashed_lines(least_chars), _MARK_COLUMNS.partition(", ")[2]), "line-hashes", compression="zstd")
    order = ["h1", "h2", F.desc("doc"), "text_hash", "pos"]
    streamed = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_streamed(least_docs), _MARK_COLUMNS)
    marks = stage(streamed, "line-marks", compression="zstd")
    verdict = marks.filter(F.col("kind") == _LARGEST).groupBy("h1", "h2").agg(F.max("doc").alias("keeper"), F.count_distinct("doc").alias("n"))
    waiting = marks.filter(F.col("kind") == _UNDECIDED).join(verdict.filter(F.col("n") >= least_docs), ["h1", "h2"]).filter("doc < keeper")
    columns = ["doc", "text_hash", "pos"]
    drops = marks.filter(F.col("kind") == _DROP).select(*columns).unionAll(waiting.select(*columns))
    ordered = drops.repartition("doc", "text_hash").sortWithinPartitions(*columns)
    return ordered.mapInArrow(_bitmaps, "doc long, text_hash long, n_dropped long, keep binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped`` of every row. Null texts come back empty."""
    kind = docs.schema[id_col].dataType.simpleString()
    name = docs.schema[id_col].name
    texts = docs.select(F.col(id_col).alias("_id"), *_identity(id_col, text_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))

    def run(batches):
        for batch in (p for b in batches for p in pieces(b, "_text", TEXT_BYTES)):
            kept, n_lines, n_dropped = [], [], []
            for text, keep, n in zip(batch.column("_text"), batch.column("keep").to_pylist(), batch.column("n_dropped").to_pylist()):
                data = memoryview(text.as_buffer()).tobytes()
                n_lines.append(data.count(b"\n") + 1)
                n_dropped.append(n or 0)
                if keep is not None:
                    lines = data.split(b"\n")
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")[: len(lines)]
                    bits = np.append(bits, np.ones(len(lines) - len(bits), np.uint8))
                    data = b"\n".join([lines[i] for i in np.flatnonzero(bits).tolist()])
                kept.append(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=["_id", "kept_text", "n_lines", "n_dropped"],
            )

    # Texts meet their bitmaps by a shuffle at every size. Of what meets in a task, bitmaps are a small part by construction.
    joined = texts.join(bitmaps.hint("shuffle_hash"), ["doc", "text_hash"], "left").select("_id", "_text", "keep", "n_dropped")
    return joined.mapInArrow(run, f"_id {kind}, kept_text string, n_lines long, n_dropped long").withColumnRenamed("_id", name)


def drop_repeated_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``apply_bitmaps`` with the bitmaps of the same documents, which are written to the shared folder in between."""
    bitmaps = stage(keep_bitmaps(docs, least_chars, least_docs, id_col, text_col), "line-bitmaps", compression="zstd")
    return apply_bitmaps(docs, bitmaps, id_col, text_col)
