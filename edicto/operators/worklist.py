"""Work-list planning: which (court x day) pages still need reading.

A court's work days come from the calendar that governs it, so units are an
equi-join of calendar days with courts on `calendar_url` (on the bulletin
site every court shares one calendar, which makes this the full days x
courts list).  Days and courts are written first.  If the bytes of the smaller
side are under Spark's limit, it is broadcast and the other one dealt evenly over
all tasks, because a few rows make many units; beyond it days and courts of a
calendar are dealt over a grid of cells.  Either way one calendar that governs
all courts fills all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicto.functions.classify import classify_subject
from edicto.operators.joins import absent_from, grid_join, is_broadcast, known_bytes, sized
from edicto.operators.load import work_key


def plan_units(days: DataFrame, courts: DataFrame) -> DataFrame:
    """J1 + W2: one unit per (calendar day, court governed by that
    calendar) with its work key.

    days: calendar_url, day_arg, fecha.  courts: calendar_url, court_url,
    juz_id, entidad_code, juzgado."""
    c = sized(courts.select(
        "calendar_url", "court_url", "juz_id", "entidad_code", "juzgado",
        classify_subject("juzgado").alias("materia"),
    ))
    d = sized(days.select("calendar_url", "day_arg", "fecha"), "days")
    small, large = sorted((d, c), key=known_bytes)
    if is_broadcast(small):
        tasks = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        units = large.repartition(tasks).join(small, "calendar_url", "inner").select(*d.columns, *c.drop("calendar_url").columns)
    else:
        units = grid_join(d, c, ["calendar_url"])
    return units.withColumn(
        "work_key", work_key("juz_id", "entidad_code", "day_arg", "juzgado")
    )


def pending(units: DataFrame, ledger: DataFrame, key: str = "work_key") -> DataFrame:
    """Units whose key is not in the ledger.  The ledger only grows;
    a run's units are few, so their keys are broadcast against the ledger
    (no shuffle of the ledger) before the anti join."""
    return absent_from(units, ledger.select(F.col(key)), [key])
