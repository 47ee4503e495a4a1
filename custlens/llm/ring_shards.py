"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of the ring (virtual nodes). A row belongs to the arc in which the hash of its text
falls, so equal texts lie together, and each arc to the shard of its point. No shard takes more rows than its
bound: what an arc has beyond it goes on clockwise to the next shard with room. Arcs are stretches of the rows in
ring order, so the whole assignment is a small table of stretches, made from the number of rows per arc.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.arrow import table
from custlens.session import stage


def ring(shards: int, virtual_nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending points of the ring and the shard that owns the arc starting at each."""
    points = sorted(
        (int.from_bytes(hashlib.blake2b(f"{s}:{v}".encode(), digest_size=8).digest(), "big", signed=True), s)
        for s in range(shards)
        for v in range(virtual_nodes)
    )
    return np.array([p for p, _ in points], np.int64), np.array([s for _, s in points], np.int64)


def arc_of(positions: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Arc of each position; what lies before the first point belongs to the last arc, around the ring."""
    return np.searchsorted(points, positions, side="right") - 1


def bounds(rows: int, shards: int, slack: float) -> np.ndarray:
    """Most rows of each shard. Without slack they add up to all rows and differ by one at most."""
    if slack > 0:
        return np.full(shards, int(np.ceil(rows / shards * (1 + slack))), np.int64)
    return rows // shards + (np.arange(shards) < rows % shards)


def place(loads: np.ndarray, owners: np.ndarray, room: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Stretches (arc, from, to, shard, first slot) of the rows of each arc.

    In each round every arc offers what it has left to the owner it has reached; a full owner sends the rest one
    arc further. The size of the work depends on arcs and shards only.
    """
    arcs, room = len(owners), room.copy()
    filled = np.zeros(len(room), np.int64)
    made = []
    waiting = [(a, 0, int(n), a) for a, n in enumerate(loads) if n]
    while waiting:
        going_on = []
        for arc, low, high, at in waiting:
            shard = owners[at]
            take = min(high - low, int(room[shard]))
            if take:
                made.append((arc, low, low + take, int(shard), int(filled[shard])))
                room[shard] -= take
                filled[shard] += take
            if low + take < high:
                going_on.append((arc, low + take, high, at))
        waiting = []
        for arc, low, high, at in going_on:
            while not room[owners[at]]:
                at = (at + 1) % arcs
            waiting.append((arc, low, high, at))
    return sorted(made)


def shard_rows(
    docs: DataFrame, shards: int = 40, virtual_nodes: int = 128, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A shard and a slot (0, 1, ... in each shard) for every row.

    Columns: the id, ``size`` (UTF-8 bytes of the text, none for null, plus 16), ``text_crc32``, ``shard``, ``slot``. With
    ``slack`` zero the numbers of rows differ by one at most; with more, a shard holds up to ``1 + slack`` times
    the mean and fewer rows move when a shard is added. Repeated rows get a slot each; null ids are kept. No rows
    give no rows; other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    positions = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("_at"),
        F.monotonically_increasing_id().alias("_row"),
    )
    keys = ["_at", "_id", "_row"]
    # Written twice: before the range partitioning, which reads its input twice, and behind it, because places in
    # ring order must not change any more once they are counted.
    ordered = stage(
        stage(positions, "positions")
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("_id", "size", "text_crc32", "_at", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_within")),
        "ring-order",
    ).withColumn("_within", F.col("_within").bitwiseAND((1 << 33) - 1))

    points, owners = ring(shards, virtual_nodes)

    def count_arcs(batches):
        loads: dict[tuple[int, int], int] = {}
        for batch in batches:
            arcs = arc_of(batch.column(0).to_numpy(), points) % len(points)
            parts = batch.column(1).to_numpy().astype(np.int64)
            found, counts = np.unique(np.stack([parts, arcs]), axis=1, return_counts=True)
            for part, arc, n in zip(*found.tolist(), counts.tolist()):
                loads[part, arc] = loads.get((part, arc), 0) + n
        if loads:
            yield pa.RecordBatch.from_pydict(
                {"part": [p for p, _ in loads], "arc": [a for _, a in loads], "n": list(loads.values())}, pa.schema([("part", pa.int32()), ("arc", pa.int32()), ("n", pa.int64())])
            )

    loads = stage(ordered.select("_at", "_part").mapInArrow(count_arcs, "part int, arc int, n long"), "arc-loads")
    # One row per arc, and one per partition: both bounded by settings, not by the data.
    by_arc = np.zeros(len(points), np.int64)
    for arc, n in loads.groupBy("arc").agg(F.sum("n")).collect():
        by_arc[arc] = n
    by_part = sorted((r[0], r[1]) for r in loads.groupBy("part").agg(F.sum("n")).collect())
    offsets, total = {}, 0
    for part, n in by_part:
        offsets[part] = total
        total += n

    # Rows before the first point lie in the last arc but come first in ring order; they are that arc's first rows.
    wrapped = ordered.filter(F.col("_at") < int(points[0])).count()
    stretches = place(by_arc, owners, bounds(total, shards, slack))
    arc_start = np.cumsum(by_arc) - by_arc + wrapped
    starts, shard_of, slot_of = [], [], []

    def add(rank: int, shard: int, slot: int) -> None:
        starts.append(rank)
        shard_of.append(shard)
        slot_of.append(slot)

    last = len(points) - 1
    for arc, low, high, shard, slot in stretches:
        if arc < last:
            add(int(arc_start[arc]) + low, shard, slot)
            continue
        if low < wrapped:
            add(low, shard, slot)
        if high > wrapped:
            begin = max(low, wrapped)
            add(int(arc_start[arc]) + begin - wrapped, shard, slot + begin - low)
    order = np.argsort(starts, kind="stable")
    starts, shard_of, slot_of = (np.array(x, np.int64)[order] for x in (starts, shard_of, slot_of))
    out = pa.schema([("_id", ordered.select("_id").limit(0).toArrow().schema.field(0).type), ("size", pa.int64()), ("text_crc32", pa.int64()), ("shard", pa.int32()), ("slot", pa.int64())])

    def assign(batches):
        for batch in batches:
            ranks = np.array([offsets[p] for p in batch.column("_part").to_pylist()], np.int64) + batch.column("_within").to_numpy()
            k = np.searchsorted(starts, ranks, side="right") - 1
            yield table(out, _id=batch.column("_id"), size=batch.column("size"), text_crc32=batch.column("text_crc32"), shard=shard_of[k], slot=slot_of[k] + ranks - starts[k])

    kind = docs.schema[id_col].dataType.simpleString()
    assigned = ordered.drop("_at").mapInArrow(assign, f"_id {kind}, size long, text_crc32 long, shard int, slot long")
    return assigned.withColumnRenamed("_id", id_col)
