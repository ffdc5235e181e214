"""Dedup, counting and work-key operators.

"First wins" and "last wins" are expressed as aggregations
(`min_by` / `max_by` over a struct of the row) rather than a ranking
window: the aggregate runs partially on the map side, so a key holding a
third of all rows is reduced to one row per map task before the shuffle,
and no task ever holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.functions.text import ColumnOrName, col


def _pick_by_key(df: DataFrame, keys: Sequence[str], order: str, fn) -> DataFrame:
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    picked = df.groupBy(*keys).agg(fn(F.struct(*rest), F.col(order)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in cols])


def first_by_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Per key (nulls form one group), the row with the smallest
    `order` value: earlier captures of a run win."""
    return _pick_by_key(df, keys, order, F.min_by)


def last_by_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Per key, the row with the largest `order` (later link overwrites
    the earlier values, like a dict assignment)."""
    return _pick_by_key(df, keys, order, F.max_by)


def count_matches(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def distinct_keys(df: DataFrame, key: str = "work_key") -> DataFrame:
    """Each work key once."""
    return df.select(key).dropDuplicates([key])


def progress_by_day(df: DataFrame, day: str = "fecha") -> DataFrame:
    """Finished rows per day."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("n_rows"))


def work_key(
    juz_id: ColumnOrName, entidad: ColumnOrName, day_arg: ColumnOrName, juzgado: ColumnOrName
) -> Column:
    """juz_id + entidad + day code + last 10 chars of the court name,
    concatenated without separator."""
    return F.concat(col(juz_id), col(entidad), col(day_arg), F.right(col(juzgado), F.lit(10)))
