"""Texts as bytes in numpy, for functions that mapInArrow runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in a row and where each text starts (one entry more). Null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, most_bytes: int = 4_000_000):
    """The batch in stretches of about so many bytes of text (at least one row each)."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.cumsum(np.diff(utf8(column)[1]))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch from arrays, converted to the schema's types."""
    made = [c if isinstance(c := columns[f.name], pa.Array) and c.type == f.type else pa.array(columns[f.name], type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays(made, schema=schema)
