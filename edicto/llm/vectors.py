"""Integer vectors, packed: shared by the vector operators.

A vector's components are multiplied by a scale, floored and kept as whole
numbers in the fewest bytes that hold them: a tag for the number type, then
the components.  A vector that is null, or holds a null, a NaN, or a component
whose product with the scale isn't finite, is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.llm.common import id_of, release

TYPES = ("<i2", "<i4", "<f8")


def _pack(values: np.ndarray, lens: np.ndarray) -> list[bytes]:
    high = np.abs(values).max(initial=0)
    tag = 0 if high < 1 << 15 else 1 if high < 1 << 31 else 2
    data, size = values.astype(TYPES[tag]).tobytes(), np.dtype(TYPES[tag]).itemsize
    ends = (np.cumsum(lens) * size).tolist()
    head = bytes([tag])
    return [head + data[i:j] for i, j in zip([0, *ends], ends)]


def unpack(rows: list[bytes], width: int = 0) -> np.ndarray:
    """One row each, as doubles; shorter vectors get zeros at their end."""
    if rows and len({(len(r), r[:1]) for r in rows}) == 1:
        t = np.dtype(TYPES[rows[0][0]])
        own = np.frombuffer(b"".join(r[1:] for r in rows), dtype=t).reshape(len(rows), -1)
        if own.shape[1] >= width:
            return own.astype(np.float64)
    parts = [np.frombuffer(r, dtype=TYPES[r[0]], offset=1) for r in rows]
    out = np.zeros((len(rows), max([width, *map(len, parts)])))
    for i, p in enumerate(parts):
        out[i, :len(p)] = p
    return out


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths, without overflow in between."""
    high = np.abs(x).max(axis=1, initial=0)
    with np.errstate(over="ignore"):
        return high * np.sqrt(((x / np.where(high > 0, high, 1)[:, None]) ** 2).sum(axis=1))


def integer_vectors(df: DataFrame, scale: int, *, id_col: str = "vec_id", vec_col: str = "embedding",
                    label: Column | None = None) -> DataFrame:
    """`row_id, vec_id, vec, size, norm` of each vector that takes part, and its `label`."""
    rows = df.select(F.monotonically_increasing_id().alias("row_id"), id_of(id_col).alias("vec_id"),
                     F.col(f"`{vec_col}`").cast("array<double>").alias("v"), *([label.alias("label")] if label is not None else []))
    labelled = label is not None
    names = ["row_id", "vec_id", "vec", "size", "norm", *(["label"] if labelled else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            there = np.asarray(lists.is_valid())
            flat = lists.flatten()
            lens = np.where(there, np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)), 0).astype(np.int64)
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(scale * np.asarray(flat.fill_null(np.nan), dtype=np.float64))
            owner = np.repeat(np.arange(len(lens)), lens)
            there[owner[~np.isfinite(values)]] = False
            values, lens = values[there[owner]], lens[there]
            rest = batch.filter(pa.array(there))
            packed = _pack(values, lens)
            cols = [rest.column(0), rest.column(1), pa.array(packed, pa.binary()), pa.array(lens), pa.array(norms(unpack(packed)) if packed else np.zeros(0))]
            yield pa.RecordBatch.from_arrays(cols + ([rest.column(3)] if labelled else []), names=names)
        release()

    more = f", label {rows.schema['label'].dataType.simpleString()}" if labelled else ""
    return rows.mapInArrow(run, "row_id long, vec_id long, vec binary, size long, norm double" + more)
