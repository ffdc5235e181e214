"""Helpers shared by the training-data operators.

Input conventions, for every operator here: a null text counts as the empty
text, a null id stays null (and sorts after every other id), extra columns are
allowed and never clash, because operators read only the columns named by
their parameters and carry other columns inside one struct.
"""

from __future__ import annotations

import ctypes
import gc
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edicto.session import ensure_checkpoint_dir, importable  # noqa: F401

#: White space and words of the text contracts.
SPACE_RUN = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def release() -> None:
    """Give a Python worker's freed memory back to the system; called at the
    end of a task, because workers stay for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_HELD: dict[str, object] = {}


def held(key: str, build: Callable[[], object]):
    """What a Python worker keeps for its later tasks, one thing at a time:
    what an earlier stage left goes before the next is built."""
    if key not in _HELD:
        _HELD.clear()
        release()
        _HELD[key] = build()
    return _HELD[key]


def text_slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int, list[str]]]:
    """`start, end, texts` for ranges of about `limit` bytes of a text column;
    only one range at a time is held as strings.  Null counts as empty."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = total = 0
    for end, n in enumerate(sizes, 1):
        total += n
        if total >= limit or end == len(sizes):
            yield start, end, [t or "" for t in column.slice(start, end - start).to_pylist()]
            start, total = end, 0


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that `spark.checkpoint.dir` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, and
    what follows survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_of(name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def id_of(name: str) -> Column:
    return F.col(f"`{name}`").cast("long")


def words_of(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text that is not null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
