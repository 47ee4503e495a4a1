"""Token files: one id array per file with Elias-Fano coded document boundaries.

A file holds a stretch of documents in ascending id order: the token ids of all of them in a row (16 bits each where the
vocabulary allows), the document boundaries and the document ids, both as Elias-Fano lists. Such a list of n ascending
numbers below u keeps the low log2(u/n) bits of each as they are and the high bits in unary, about 2 + log2(u/n) bits a
number in all; a select over the unary part, with every 256th one remembered, gives any boundary without a table of
64-bit offsets. Files are rows of a Parquet table, so that any store Spark can write to holds them.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.arrow import pieces, table
from custlens.llm.tokens import TEXT_BYTES, vocabulary_size, worker_encoder
from custlens.session import stage

TOKENS_PER_FILE = 2_000_000
_MAGIC = b"CTF1"
_HEAD = struct.Struct("<4sBQQQqQQ")
_LIST = struct.Struct("<QQB")
_SAMPLE = 256


class EliasFano:
    """An ascending list of integers from 0 on (repeats allowed) in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, ((top + 1) // max(n, 1)).bit_length() - 1)
        kept = values.astype(np.uint64) & np.uint64((1 << low_bits) - 1)
        bits = (kept[:, None] >> np.arange(low_bits, dtype=np.uint64)[None, :]) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values.astype(np.uint64) >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros((top >> low_bits) + n + 1, np.uint8)
        unary[ones] = 1
        return cls(n, low_bits, low, np.packbits(unary, bitorder="little"), ones[::_SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return _LIST.pack(self.n, len(self.high), self.low_bits) + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, blob: bytes, at: int) -> tuple[EliasFano, int]:
        n, high_size, low_bits = _LIST.unpack_from(blob, at)
        at += _LIST.size
        parts = []
        for size, kind in (((n * low_bits + 7) // 8, np.uint8), (high_size, np.uint8), (4 * -(-n // _SAMPLE), "<u4")):
            parts.append(np.frombuffer(blob, np.uint8, size, at).view(kind))
            at += size
        return cls(n, low_bits, *parts), at

    def select(self, i: int) -> int:
        """Place of the i-th one of the unary part: from the sample before it on, byte by byte."""
        at = int(self.samples[i // _SAMPLE])
        missing = i % _SAMPLE
        byte = at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (ones := word.bit_count()) <= missing:
            missing -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(missing):
            word &= word - 1
        return byte * 8 + (word & -word).bit_length() - 1

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        start, value = i * self.low_bits, 0
        for k in range(self.low_bits):
            place = start + k
            value |= (int(self.low[place >> 3]) >> (place & 7) & 1) << k
        return (self.select(i) - i) << self.low_bits | value

    def between(self, first: int, last: int) -> np.ndarray:
        """Entries ``first`` to ``last - 1`` by one select of the sample before them; only their stretch of the list is read."""
        if first >= last:
            return np.zeros(0, np.int64)
        sample, after = first // _SAMPLE, -(-last // _SAMPLE)
        start = int(self.samples[sample])
        end = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        unary = np.unpackbits(self.high[start >> 3 : (end + 7) >> 3], bitorder="little")
        unary[: start & 7] = 0
        ones = np.flatnonzero(unary)[first - sample * _SAMPLE : last - sample * _SAMPLE] + (start & ~7)
        values = (ones - np.arange(first, last)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            start, end = first * self.low_bits, last * self.low_bits
            bits = np.unpackbits(self.low[start >> 3 : (end + 7) >> 3], bitorder="little")[start & 7 :][: end - start]
            bits = bits.reshape(-1, self.low_bits).astype(np.uint64)
            values |= (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return values.astype(np.int64)

    def all(self) -> np.ndarray:
        return self.between(0, self.n)


def write_file(ids: np.ndarray, starts: np.ndarray, doc_ids: list[int | None], width: int) -> bytes:
    """``starts`` of the documents in ``ids``; null document ids come first."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    bounds = EliasFano.of(np.asarray(starts, np.int64)).to_bytes()
    names = EliasFano.of(known.astype(np.uint64) - np.uint64(least & (2**64 - 1))).to_bytes()
    head = _HEAD.pack(_MAGIC, width, len(doc_ids), len(doc_ids) - len(known), len(ids), least, len(bounds), len(names))
    return head + bounds + names + ids.astype(f"<u{width}").tobytes()


class TokenFile:
    """A file read back: ``file[i]`` gives the ids of document i."""

    def __init__(self, blob: bytes):
        magic, width, self.n_docs, self._nulls, self.n_tokens, self._least, _, _ = _HEAD.unpack_from(blob)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        self.starts, at = EliasFano.read(blob, _HEAD.size)
        self._names, at = EliasFano.read(blob, at)
        self.ids = np.frombuffer(blob, f"<u{width}", self.n_tokens, at)

    def doc_ids(self) -> list[int | None]:
        return [None] * self._nulls + (self._names.all() + self._least).tolist()

    def stretches(self, size: int = 4096):
        """``(document ids, starts, ends)`` of ``size`` documents at a time, so that no table of all offsets is made."""
        for first in range(0, self.n_docs, size):
            last = min(first + size, self.n_docs)
            edges = self.starts.between(first, min(last + 1, self.n_docs))
            if last == self.n_docs:
                edges = np.append(edges, self.n_tokens)
            names = self._names.between(max(first - self._nulls, 0), max(last - self._nulls, 0)) + self._least
            yield [None] * (last - first - len(names)) + names.tolist(), edges[:-1], edges[1:]

    def __len__(self) -> int:
        return self.n_docs

    def __getitem__(self, i: int) -> np.ndarray:
        end = self.starts[i + 1] if i + 1 < self.n_docs else self.n_tokens
        return self.ids[self.starts[i] : end]


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all documents and write token files in ascending order of the (integer) document id.

    Returns the written table: ``part`` and ``file`` in order, ``first_token`` of the file in its part, ``n_docs``,
    ``n_tokens``, ``blob``. Null and empty texts are documents of the end id alone. Null ids come first; documents with the same
    id follow each other, ordered by a hash of the text. No rows give no files; other columns are not looked at.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_tie"), text.alias("_text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Where each part begins, from ids and hashes alone: texts are encoded once and shuffled once, as ids.
    order = keyed.select("_id", "_tie").repartitionByRange(parts, "_id", "_tie")
    begins = order.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(F.col("_id").isNotNull(), F.coalesce("_id", F.lit(0)), "_tie"))).collect()
    begins = sorted(tuple(r[1]) for r in begins)  # one per part
    schema = pa.schema([("part", pa.int32()), ("_id", pa.int64()), ("_tie", pa.int64()), ("ids", pa.binary())])
    size = vocabulary_size(tokenizer)
    width = 2 if max(size, end_id + 1) <= 1 << 16 else 4
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def encode(batches):
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            for rows in pieces(batch, "_text", TEXT_BYTES):
                ids, edges = encoder.encode(rows.column(2))
                ids = ids.astype(kind)
                part = [max(0, bisect_right(begins, (d is not None, d or 0, t)) - 1) for d, t in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())]
                blobs = [ids[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                yield table(schema, part=part, _id=rows.column(0), _tie=rows.column(1), ids=blobs)

    def write(batches):
        out = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("first_token", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("blob", pa.binary())])
        part, file, first = None, 0, 0
        held: list[np.ndarray] = []
        names: list[int | None] = []
        end = np.array([end_id], np.uint32)

        def flush():
            nonlocal file, first
            lengths = np.array([len(x) for x in held], np.int64)
            blob = write_file(np.concatenate(held), np.cumsum(lengths) - lengths, names, width)
            yield table(out, part=[part], file=[file], first_token=[first], n_docs=[len(names)], n_tokens=[int(lengths.sum())], blob=[blob])
            file, first = file + 1, first + int(lengths.sum())
            held.clear()
            names.clear()

        size = 0
        for batch in batches:
            for p, name, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if held and (p != part or size >= TOKENS_PER_FILE):
                    yield from flush()
                    size = 0
                if p != part:
                    part, file, first = p, 0, 0
                held.append(np.append(np.frombuffer(blob.as_buffer(), kind), end))
                names.append(name)
                size += len(held[-1])
        if held:
            yield from flush()

    encoded = keyed.mapInArrow(encode, "part int, _id long, _tie long, ids binary")
    ordered = encoded.repartitionById(parts, "part").sortWithinPartitions("part", "_id", "_tie").select("part", "_id", "ids")
    return stage(ordered.mapInArrow(write, "part int, file int, first_token long, n_docs long, n_tokens long, blob binary"), "token-files", compression="zstd")


def read_tokens(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The id, ``start``, ``n_tokens``, ``ids_crc32`` of every document, read from the files of ``write_tokens``.

    Offsets come from the Elias-Fano boundaries by select, a few thousand documents at a time.
    """
    totals = sorted(tuple(r) for r in files.groupBy("part").agg(F.sum("n_tokens")).collect())  # one per part
    before, total = {}, 0
    for part, n in totals:
        before[part] = total
        total += n
    schema = pa.schema([(id_col, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches):
        for batch in batches:
            for part, first, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                file = TokenFile(blob.as_buffer())
                for names, starts, ends in file.stretches():
                    crc = [zlib.crc32(file.ids[a:b].astype("<u4")) for a, b in zip(starts.tolist(), ends.tolist())]
                    columns = {id_col: names, "start": starts + (before[part] + first), "n_tokens": ends - starts, "ids_crc32": crc}
                    yield table(schema, **columns)

    return files.select("part", "first_token", "blob").mapInArrow(read, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")
