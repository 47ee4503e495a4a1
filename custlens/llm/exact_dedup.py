"""Exact de-duplication with counting quotient filters.

Each task counts the 64-bit fingerprints of its rows in quotient filters: the high bits (quotient) are kept as
two bit rows, the low bits (remainder) in sorted runs, and counts above one beside them. A filter loses nothing
of a fingerprint, so the filters of many tasks merge by their sorted remainders. A fingerprint with a merged
count of one belongs to a text that nothing else equals; only rows of the other fingerprints are compared byte
by byte.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.session import stage

FINGERPRINTS_PER_SHARD = 2_000_000
WAITING = 1 << 16  # fingerprints that wait at least before they are counted
_HEAD = struct.Struct("<BBIQ")


def build_filter(fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A counting quotient filter of ascending distinct fingerprints of so many bits."""
    n = len(fingerprints)
    q = min(bits, max(1, int(n).bit_length()))
    r = bits - q
    quotients = (fingerprints >> np.uint64(r)).astype(np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotients] = True
    run_end = np.append(quotients[1:] != quotients[:-1], True)[:n]
    width = (r + 7) // 8
    low = (fingerprints & np.uint64((1 << r) - 1)).astype("<u8")
    remainders = low.view(np.uint8).reshape(n, 8)[:, :width]
    many = np.flatnonzero(counts > 1)
    return b"".join(
        [
            _HEAD.pack(q, bits, len(many), n),
            np.packbits(occupied).tobytes(),
            np.packbits(run_end).tobytes(),
            remainders.tobytes(),
            many.astype("<u4").tobytes(),
            counts[many].astype("<u8").tobytes(),
        ]
    )


def read_filter(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ascending fingerprints and their counts."""
    q, bits, n_many, n = _HEAD.unpack_from(blob)
    width = (bits - q + 7) // 8
    at = _HEAD.size

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return np.frombuffer(blob, np.uint8, size, at - size)

    occupied = np.flatnonzero(np.unpackbits(take(((1 << q) + 7) // 8), count=1 << q))
    run_end = np.unpackbits(take((n + 7) // 8), count=n)
    run = np.cumsum(run_end) - run_end
    low = np.zeros((n, 8), np.uint8)
    low[:, :width] = take(n * width).reshape(n, width)
    fingerprints = (occupied[run].astype(np.uint64) << np.uint64(bits - q)) | low.view("<u8").reshape(n).astype(np.uint64)
    counts = np.ones(n, np.int64)
    many = take(4 * n_many).view("<u4")
    counts[many] = take(8 * n_many).view("<u8").astype(np.int64)
    return fingerprints, counts


def _sum_by(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.append(True, fingerprints[1:] != fingerprints[:-1])[: len(fingerprints)])
    return fingerprints[first], np.add.reduceat(counts, first) if len(first) else counts


def merge_filters(blobs: list[bytes], bits: int) -> bytes:
    """The filter of all fingerprints in the given ones, counts added."""
    read = [read_filter(b) for b in blobs]
    return build_filter(*_sum_by(np.concatenate([f for f, _ in read]), np.concatenate([c for _, c in read])), bits)


def count_fingerprints(arrays: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct fingerprints and their counts. New ones wait until they are as many as those held, so that each
    is sorted again only when their number has doubled."""
    values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    waiting: list[np.ndarray] = []
    n = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        return _sum_by(np.concatenate([values, *waiting]), np.append(counts, np.ones(n, np.int64)))

    for new in arrays:
        waiting.append(new)
        n += len(new)
        if n >= max(len(values), WAITING):
            values, counts = merged()
            waiting, n = [], 0
    return merged()


def repeated_fingerprints(rows: DataFrame, column: str, shards: int) -> DataFrame:
    """Distinct values of a long column that occur more than once, by merged counting quotient filters."""
    shard_bits = max(0, (shards - 1).bit_length())
    bits = 64 - shard_bits

    def count(batches):
        columns = (batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64) for batch in batches)
        values, counts = count_fingerprints(c.view(np.uint64) for c in columns)
        shard = (values >> np.uint64(bits)).astype(np.int64) if shard_bits else np.zeros(len(values), np.int64)
        edges = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])[: len(shard)]), len(shard))
        inside = values & np.uint64((1 << bits) - 1)
        for a, b in zip(edges[:-1], edges[1:]):
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard[a]], pa.int32()), "filter": pa.array([build_filter(inside[a:b], counts[a:b], bits)], pa.binary())}
            )

    def merge(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        merged = merge_filters(group.column("filter").to_pylist(), bits)
        fingerprints, counts = read_filter(merged)
        more = fingerprints[counts > 1] | np.uint64((shard << bits) & (2**64 - 1))
        return pa.table({column: pa.array(more.view(np.int64), pa.int64())})

    filters = rows.select(column).mapInArrow(count, "shard int, filter binary")
    return filters.groupBy("shard").applyInArrow(merge, f"{column} long")


def _decide(docs: DataFrame, id_col: str, text_col: str, carried: Column | None) -> DataFrame:
    spark = docs.sparkSession
    carried = F.lit(None).cast("boolean") if carried is None else carried
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), carried.alias("_doc")).withColumn("_fp", F.xxhash64("_text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(partitions, rows.count() // FINGERPRINTS_PER_SHARD)
    repeated = stage(repeated_fingerprints(rows, "_fp", shards), "repeated")

    digest = F.sha2(F.encode("_text", "UTF-8"), 256).alias("text_sha256")
    alone = rows.select("_id", "_fp", digest, "_doc").join(repeated, "_fp", "left_anti")
    alone = alone.select(
        "_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", "_doc"
    )
    # The row number tells repeated rows apart; it only holds once the rows are written.
    numbered = rows.join(repeated, "_fp", "left_semi").withColumn("_row", F.monotonically_increasing_id())
    routed = stage(numbered, "routed", compression="zstd")
    best = F.max(F.struct(F.col("_id"), F.col("_row"))).alias("_best")
    # Written, so that the join shuffles both sides for itself and Spark can split the rows of a very frequent text.
    equal = stage(routed.groupBy("_fp", "_text").agg(best, F.count("*").alias("group_size")), "equal", compression="zstd")
    together = routed.join(equal, ["_fp", "_text"]).select(
        "_id",
        F.col("_best._id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_best._row")).alias("kept"),
        digest,
        "_doc",
    )
    return alone.unionByName(together)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of equal texts; in each the row with the largest id stays.

    One row per row of ``docs``: the id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. Null texts count
    as empty and equal each other. Of repeated rows (same id, same text) exactly one stays. A null id is smaller than
    any other. No rows give no rows; other columns are not looked at.
    """
    return _decide(docs, id_col, text_col, None).withColumnRenamed("_id", id_col).drop("_doc")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns."""
    kept = _decide(docs, id_col, text_col, F.struct(*[docs[c] for c in docs.columns])).filter("kept")
    return kept.select("_doc.*")
