"""Packing documents into sequences by length patterns and non-negative least squares.

Patterns of two or three lengths that fill a sequence exactly are enumerated; how often each is to be used follows from
the histogram of lengths by non-negative least squares. The repeat counts are rounded down to whole sequences that the
histogram can serve, and what is left goes best-fit decreasing. All of this sees the histogram only, so its cost does
not depend on the number of documents. The plan is a table of stretches (the next r pieces of length l go to r
sequences in a row at offset o), and every piece finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.llm.arrow import pieces as cut_batch
from custlens.llm.arrow import table
from custlens.llm.tokens import TEXT_BYTES, worker_encoder
from custlens.session import stage

_RANKS = 1 << 40  # more pieces of one length than this don't fit the combined key


def exact_patterns(capacity: int) -> list[tuple[int, ...]]:
    """All patterns of two, then three lengths that fill the capacity."""
    two = [(a, capacity - a) for a in range(capacity // 2, 0, -1)]
    three = [(a, b, capacity - a - b) for a in range(1, capacity // 3 + 1) for b in range(a, (capacity - a) // 2 + 1)]
    return two + three


def fit_repeats(histogram: np.ndarray, patterns: list[tuple[int, ...]], sweeps: int = 8) -> list[float]:
    """Non-negative least squares: how often to use each pattern, by coordinate descent from zero.

    A sweep sets each pattern in turn to its best value with the others fixed, never below zero.
    """
    left = [float(x) for x in histogram]
    times = [0.0] * len(patterns)
    weights = [sum(p.count(x) ** 2 for x in set(p)) for p in patterns]
    active = range(len(patterns))
    for sweep in range(sweeps):
        for i in active:
            pattern = patterns[i]
            pull = 0.0
            for x in pattern:
                pull += left[x]
            change = pull / weights[i]
            if change < -times[i]:
                change = -times[i]
            if change:
                times[i] += change
                for x in pattern:
                    left[x] -= change
        if sweep % 2 == 0:  # next time only what is in use, then everything again
            active = [i for i in range(len(patterns)) if times[i] > 0]
        else:
            active = range(len(patterns))
    return times


def best_fit(histogram: np.ndarray, capacity: int) -> dict[tuple[int, ...], int]:
    """Best-fit decreasing on a histogram: how often each content of a sequence occurs."""
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)

    def put(content: tuple[int, ...], times: int) -> None:
        held = by_room[capacity - sum(content)]
        held[content] = held.get(content, 0) + times

    for length in range(capacity, 0, -1):
        left = int(histogram[length])
        room = length
        while left and room <= capacity:
            held = by_room[room]
            if not held:
                room += 1
                continue
            content, times = held.popitem()
            take = min(times, left)
            if take < times:
                held[content] = times - take
            put((*content, length), take)
            left -= take
            if room - length >= length:  # the new room is tighter and still fits
                room = min(room, length)
        each = capacity // length
        if left // each:
            put((length,) * each, left // each)
        if left % each:
            put((length,) * (left % each), 1)
    out: dict[tuple[int, ...], int] = defaultdict(int)
    for held in by_room.values():
        for content, times in held.items():
            out[content] += times
    return dict(out)


def plan(histogram: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Contents of sequences and how often each is used; together exactly the pieces of the histogram."""
    left = histogram.astype(np.int64).copy()
    used: dict[tuple[int, ...], int] = {}
    if left[capacity]:
        used[(capacity,)] = int(left[capacity])
        left[capacity] = 0
    patterns = exact_patterns(capacity)
    times = fit_repeats(left, patterns)
    for i in sorted((i for i, t in enumerate(times) if t >= 1), key=lambda i: (-times[i], i)):
        pattern = patterns[i]
        repeats = min(int(times[i]), *(int(left[x]) // pattern.count(x) for x in pattern))
        if repeats > 0:
            for x in pattern:
                left[x] -= repeats
            used[pattern] = used.get(pattern, 0) + repeats
    for content, n in best_fit(left, capacity).items():
        used[content] = used.get(content, 0) + n
    return sorted(used.items())


def stretches(contents: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending keys (length and first rank), first sequence and offset of each stretch of the plan."""
    ranks: dict[int, int] = defaultdict(int)
    keys, sequences, offsets = [], [], []
    sequence = 0
    for content, times in contents:
        offset = 0
        for length in content:
            keys.append(length * _RANKS + ranks[length])
            sequences.append(sequence)
            offsets.append(offset)
            ranks[length] += times
            offset += length
        sequence += times
    order = np.argsort(keys)
    return tuple(np.array(x, np.int64)[order] for x in (keys, sequences, offsets))


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str, with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents, numbered within each length and task: ``_id, piece, start, length, ids_crc32, part, rank``.

    A document is its ids and the end id. Longer ones are cut so that all pieces but the first are full.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("rank", pa.int64())]
    fields += [("ids", pa.list_(pa.int32()))] if with_ids else []

    def cut(batches):
        encoder = worker_encoder(tokenizer)
        counted = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for texts in cut_batch(batch, "_text", TEXT_BYTES):
                names = texts.column(0)
                flat, edges = encoder.encode(texts.column(1))
                sizes = np.diff(edges) + 1
                full = np.insert(flat, edges[1:], end_id).astype("<u4")
                n = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                head = sizes - (n - 1) * capacity
                start = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[row])
                at = (np.cumsum(sizes) - sizes)[row] + start
                order = np.argsort(length, kind="stable")
                ascending = length[order]
                rank = np.empty(len(row), np.int64)
                rank[order] = np.arange(len(row)) - np.searchsorted(ascending, ascending) + counted[ascending]
                counted += np.bincount(length, minlength=capacity + 1)
                cuts = list(zip(at.tolist(), (at + length).tolist()))
                more = {"ids": [full[a:b].astype(np.int32) for a, b in cuts]} if with_ids else {}
                schema = pa.schema([("_id", names.type), *fields])
                yield table(schema, _id=names.take(pa.array(row)), piece=piece, start=start, length=length, ids_crc32=[zlib.crc32(full[a:b]) for a, b in cuts], rank=rank, **more)

    columns = f"_id {kind}, piece int, start long, length long, ids_crc32 long, rank long" + (", ids array<int>" if with_ids else "")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return texts.mapInArrow(cut, columns).withColumn("part", F.spark_partition_id())


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens; one row per piece.

    Columns: the id, ``piece`` (from 0), ``start`` (the document's ids before it), ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` (place in the sequence, without gaps), and the ids themselves on request
    (``sequences`` joins them). Null and empty texts are the end id alone. Null ids and repeated rows are packed like
    any other. No rows give no rows; other columns are not looked at.
    """
    pieces = stage(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids), "pieces", compression="zstd")
    counts = stage(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # one row per length
        histogram[length] = n
    keys, sequences, offsets = stretches(plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).select(
        "_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"), *(["ids"] if with_ids else [])
    )

    def place(batches):
        for batch in batches:
            wanted = batch.column("length").to_numpy() * _RANKS + batch.column("rank").to_numpy()
            k = np.searchsorted(keys, wanted, side="right") - 1
            added = [pa.array(sequences[k] + wanted - keys[k], pa.int64()), pa.array(offsets[k], pa.int64())]
            kept = [f.name for f in batch.schema if f.name != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *added], names=[*kept, "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    columns = f"_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return ranked.mapInArrow(place, f"{columns}, sequence_id long, offset long").withColumnRenamed("_id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, from ``pack(..., with_ids=True)``."""
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(in_order, lambda p: p["ids"])).alias("ids"))
