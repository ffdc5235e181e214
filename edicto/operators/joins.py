"""Join operators: checked broadcast, court lookups, anti/semi joins.

Existence tests use null-safe equality because a stored document equal on
a missing field also counts as a match.  No side is broadcast on a guess:
small sides are written first, so that their size in bytes is known when the
join is planned, and Spark's own limit (`spark.sql.autoBroadcastJoinThreshold`)
decides.  Beyond it the join is a sort-merge join with skew handling.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.session import written


def sized(df: DataFrame, name: str = "dimension") -> DataFrame:
    """A small side with a known size: written once and read back, so the
    planner broadcasts it if, and only if, its bytes are under the limit."""
    return written(df, name)


def known_bytes(df: DataFrame) -> int:
    """The bytes of a side of a known size, as the planner sees them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_broadcast(df: DataFrame) -> bool:
    """Whether Spark's limit lets a side of a known size be broadcast."""
    return known_bytes(df) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def grid_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join whose result is a product per key, with hot keys dealt out.

    A key's rows form a grid: a left row takes one line and goes to every
    column, a right row takes one column and goes to every line.  Each pair of
    rows meets in just one cell, and a key that holds everything fills all
    cells alike.  Four cells per shuffle partition; each side is copied only as
    often as the grid is wide, the square root of that."""
    side = math.ceil(math.sqrt(4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = lambda df: F.pmod(F.xxhash64(*df.columns), F.lit(side)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    rows = left.withColumn("_line", dealt(left)).withColumn("_column", every)
    cols = right.withColumn("_column", dealt(right)).withColumn("_line", every)
    return rows.join(cols, [*keys, "_line", "_column"], "inner").drop("_line", "_column")


def null_safe_condition(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys]
    )


def key_hash(keys: Sequence[str]) -> Column:
    """64 bits for the null-safe key: equal keys have equal hashes."""
    return F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))])


def _stored_matches(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of `existing` that may be in `new`.

    Of the batch only one long per distinct key takes part, written first:
    under Spark's broadcast limit the stored side is streamed through a semi
    join without a shuffle.  Equality of the keys themselves is tested by the
    caller on the few rows left."""
    hashes = written(new.select(key_hash(keys).alias("_h")).distinct(), "batch-keys")
    hit = existing.select(*keys).withColumn("_h", key_hash(keys)).join(hashes, "_h", "left_semi")
    return hit.select(*keys).distinct()


def absent_from(new: DataFrame, existing: DataFrame, keys: Sequence[str], is_written: bool = False) -> DataFrame:
    """Rows of `new` with no null-safe key match in `existing`.  `new` is
    written once, unless the caller has done so, and all steps read that copy."""
    new = new if is_written else written(new, "batch")
    present = _stored_matches(new, existing, keys)
    return new.join(present, null_safe_condition(new, present, keys), "left_anti")


def present_in(new: DataFrame, existing: DataFrame, keys: Sequence[str], is_written: bool = False) -> DataFrame:
    """Rows of `new` that already exist (the duplicates report)."""
    new = new if is_written else written(new, "batch")
    present = _stored_matches(new, existing, keys)
    return new.join(present, null_safe_condition(new, present, keys), "left_semi")
