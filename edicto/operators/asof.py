"""Court attributes as of a capture.

The dimension keeps one version of a court per change, with the interval in
which it holds.  Rows take the version that held when they were captured.  A
court that holds a third of all rows must not meet its versions in one task,
so the interval is cut into months and the join is an equality on (court,
month): a hot court's rows are dealt by month, and what a task buffers is that
month's versions of a court, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edicto.operators.joins import sized

FROM, TO = "valid_from", "valid_to"


def versions(captures: DataFrame, key: str, at: str, attrs: Sequence[str]) -> DataFrame:
    """`key, *attrs, valid_from, valid_to` from the dimension as captured time
    and again: captures that change nothing are merged, of two at one time the
    greater attributes hold, and the last version has no end.  The window runs
    over one court's captures, of which there are as many as listings."""
    own = captures.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).groupBy(key, F.col(at).alias(FROM)).agg(
        F.max(F.struct(*attrs)).alias("_now"))
    order = Window.partitionBy(key).orderBy(FROM)
    changed = own.withColumn("_was", F.lag("_now").over(order)).withColumn("_no", F.row_number().over(order))
    changed = changed.filter((F.col("_no") == 1) | ~F.col("_now").eqNullSafe(F.col("_was")))
    return changed.withColumn(TO, F.lead(FROM).over(order)).select(key, *[F.col("_now")[a].alias(a) for a in attrs], FROM, TO)


def _month(c: Column) -> Column:
    return (F.year(c) * 12 + F.month(c)).cast("int")


def as_of(rows: DataFrame, history: DataFrame, key: str, at: str, attrs: Sequence[str]) -> DataFrame:
    """`rows` with the `attrs` of the version that held at `at`.  Rows before
    the first version, of unknown keys, or without a time keep null attributes.
    `history` as `versions` gives it; columns of other names are not touched."""
    time = F.col(at).cast("timestamp_ntz")
    span = rows.agg(F.min(time).alias("first"), F.max(time).alias("last")).first()
    low, high = (F.lit(span[c]).cast("timestamp_ntz") for c in ("first", "last"))  # open ends stop at the rows' own span
    own = history.select(F.col(key).alias("_key"), F.struct(*attrs).alias("_attrs"),
                         F.col(FROM).cast("timestamp_ntz").alias("_from"), F.col(TO).cast("timestamp_ntz").alias("_to"))
    own = own.filter((F.col("_from") <= high) & (F.col("_to").isNull() | (F.col("_to") > low)))
    months = F.sequence(_month(F.greatest("_from", low)), _month(F.least(F.coalesce("_to", high), high)))
    own = sized(own.withColumn("_month", F.explode(months)), "versions")
    left = rows.withColumns({"_at": time, "_in": _month(time)})
    joined = left.join(own, (F.col(key) == F.col("_key")) & (F.col("_in") == F.col("_month"))
                       & (F.col("_at") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("_at") < F.col("_to"))), "left")
    keep = [c for c in rows.columns if c not in attrs]
    return joined.select(*[F.col(f"`{c}`") for c in keep], *[F.col("_attrs")[a].alias(a) for a in attrs])
