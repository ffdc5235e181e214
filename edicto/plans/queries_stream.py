"""Registered streaming queries (R1-R3).  Each runs its stream to the end
(`availableNow`, in two arrivals of source files) and returns the sink."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicto.constants import DEDUP_KEYS
from edicto.operators import records as R
from edicto.plans import oracle as O
from edicto.plans.fixtures import fixture_courts, read_table
from edicto.plans.queries import _records_oracle, register
from edicto.plans.render import ROWS_PER_PAGE, day_pages
from edicto.session import shared_path
from edicto.sources import manifest as M
from edicto.sources.io import RECORDS_SINK_SCHEMA, read_records, write_captures
from edicto.streaming.ingest import (
    PAGE_KEY,
    PAGE_LEDGER_SCHEMA,
    dedup_within_watermark,
    ingest_captures,
    stream_append_if_absent,
    stream_first_captures,
)

EVENT_KEYS = ("user_id", "event_type", "day")
SECOND_ARRIVAL = "2024-01-15"


def _events(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("day"), "event_id", "ts", "value"
    )


@register(
    "stream_append_if_absent",
    "SELECT user_id, event_type, day, event_id, ts, value FROM (SELECT *, CAST(ts AS DATE) AS day, "
    "row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS rn "
    "FROM events) WHERE rn = 1",
)
def stream_append_if_absent_q(spark, sf_dir):
    """R1 + R2: events arrive in two groups of files; each availableNow run
    appends the first event per (user, type, day) not yet in the sink."""
    base = shared_path(spark, "stream_events", uuid.uuid4().hex)
    src, sink, ckpt = f"{base}/src", f"{base}/sink", f"{base}/ckpt"
    ev = _events(spark, sf_dir)
    for part in (ev.filter(F.col("day") < F.lit(SECOND_ARRIVAL)), ev.filter(F.col("day") >= F.lit(SECOND_ARRIVAL))):
        part.write.mode("append").parquet(src)
        stream_append_if_absent(spark, src, ev.schema, sink, ckpt, EVENT_KEYS, "event_id")
    return spark.read.parquet(sink).select(*ev.columns)


@register(
    "stream_dedup_watermark",
    "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events",
)
def stream_dedup_watermark_q(spark, sf_dir):
    """Bounded-state dedup (watermark of 62 days) over the event
    stream; the sink keeps one row per key."""
    base = shared_path(spark, "stream_wm", uuid.uuid4().hex)
    src, sink, ckpt = f"{base}/src", f"{base}/sink", f"{base}/ckpt"
    ev = _events(spark, sf_dir)
    for part in (ev.filter(F.col("day") < F.lit(SECOND_ARRIVAL)), ev.filter(F.col("day") >= F.lit(SECOND_ARRIVAL))):
        part.write.mode("append").parquet(src)
        stream = dedup_within_watermark(spark.readStream.schema(ev.schema).parquet(src), "ts", EVENT_KEYS)
        q = (
            stream.select(*EVENT_KEYS).writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start()
        )
        q.awaitTermination()
    return spark.read.parquet(sink)


@register(
    "stream_first_capture",
    "SELECT user_id, event_type, min_by(event_id, ts) AS event_id, min(ts) AS ts FROM (SELECT *, sum(CASE WHEN ts <= before + "
    "INTERVAL 2 DAY THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS run FROM (SELECT *, "
    "lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS before FROM events)) GROUP BY user_id, event_type, run",
)
def stream_first_capture_q(spark, sf_dir):
    """R3 under late data: events arrive up to three days late and out of
    order, in one file per four days of arrival; the first of each run of a
    (user, type) wins.  A last file without keys moves the watermark past all."""
    base = shared_path(spark, "stream_first", uuid.uuid4().hex)
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    late = F.pmod(F.xxhash64("event_id"), F.lit(3)).cast("int")
    ev = ev.withColumn("_slot", F.floor((F.unix_date(F.to_date("ts")) + late) / 4))
    for (slot,) in sorted(ev.select("_slot").distinct().collect()):
        ev.filter(F.col("_slot") == slot).drop("_slot").coalesce(1).write.mode("append").parquet(f"{base}/src")
    none = lambda c: F.lit(None).cast(ev.schema[c].dataType).alias(c)
    end = ev.agg((F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"))
    end.select(none("user_id"), none("event_type"), none("event_id"), "ts").write.mode("append").parquet(f"{base}/src")
    stream_first_captures(spark, f"{base}/src", ev.drop("_slot").schema, f"{base}/sink", f"{base}/ckpt", ("user_id", "event_type"),
                          "ts", "event_id", "2 days", "4 days", max_files=1)
    return spark.read.parquet(f"{base}/sink").select("user_id", "event_type", "event_id", "ts")


# Day pages dated before this arrive first; the second arrival re-captures
# the month before it too (the source re-reads the previous month each run).
CAPTURE_CUTOFF = "1998/01/01"
RECAPTURE_FROM = "1997/12/01"


def _ingest_sql() -> str:
    ctes, out = _records_oracle("fixture_rows", ("row_id",))
    cols = ", ".join(f'"{c}"' for c in R.RECORD_COLUMNS)
    keys = ", ".join(DEDUP_KEYS)
    url = (
        "(SELECT c.court_url FROM fixture_courts c WHERE c.court_no = f.court_no) || '&Fecha=' || f.fecha || "
        f"'&Pagina=' || CAST(f.row_id // {ROWS_PER_PAGE} AS VARCHAR)"
    )
    return (
        O.with_ctes(*ctes)
        + f"SELECT {cols}, substring(fecha, 1, 7) AS anio_mes FROM (SELECT r.*, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY r.url, r.row_id) AS rn FROM (SELECT o.*, {url} AS url FROM {out} o JOIN fixture_rows f "
        "ON o.row_id = f.row_id WHERE o.reject_reason IS NULL) r) WHERE rn = 1"
    )


def _ingest_replay_sql() -> str:
    ctes, out = _records_oracle("fixture_rows", ("row_id",))
    keys = ", ".join(DEDUP_KEYS)
    return (
        O.with_ctes(*ctes)
        + f"SELECT 'records' AS kind, count(*) AS n FROM (SELECT DISTINCT {keys} FROM {out} WHERE reject_reason IS NULL) "
        f"UNION ALL SELECT 'rejects', count(*) FROM {out} WHERE reject_reason IS NOT NULL"
    )


@register("ingest_records", _ingest_sql())
def ingest_records_q(spark, sf_dir):
    """R1 + R4 end to end: captured day pages arrive in two runs (the
    second re-captures the month before the cutoff, which the page ledger
    skips unparsed); records are appended if absent.  The insertion clock
    is left out of the result."""
    base = shared_path(spark, "ingest", uuid.uuid4().hex)
    caps, recs, quar, ckpt, seen = (
        f"{base}/{n}" for n in ("captures", "records", "quarantine", "ckpt", "pages_seen")
    )
    pages = day_pages(spark, sf_dir)
    courts = fixture_courts(spark)
    for part in (
        pages.filter(F.col("fecha") < F.lit(CAPTURE_CUTOFF)),
        pages.filter(F.col("fecha") >= F.lit(RECAPTURE_FROM)),
    ):
        write_captures(part, caps)
        ingest_captures(spark, caps, recs, quar, ckpt, courts, page_ledger_path=seen, key_index_path=f"{base}/keys")
    return read_records(spark, recs).select(*R.RECORD_COLUMNS, "anio_mes")


@register("ingest_replay", _ingest_replay_sql())
def ingest_replay_q(spark, sf_dir):
    """R1 + G1 + G2: all day pages ingested, the checkpoint lost, and ingested
    again without a page ledger: as many records and rejects as before."""
    base = shared_path(spark, "replay", uuid.uuid4().hex)
    caps, recs, quar = (f"{base}/{n}" for n in ("captures", "records", "quarantine"))
    write_captures(day_pages(spark, sf_dir), caps)
    for run in ("first", "second"):
        ingest_captures(spark, caps, recs, quar, f"{base}/{run}", fixture_courts(spark), max_files=4)
    count = lambda df, kind: df.groupBy().agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    return count(read_records(spark, recs), "records").unionByName(count(spark.read.parquet(quar), "rejects"))


class Crash:
    """Fails once `n` tables have been written."""

    def __init__(self, n: int):
        self.left = n

    def __call__(self, path: str) -> None:
        self.left -= 1
        if self.left == 0:
            raise RuntimeError(f"planned failure after writing {path}")


def _ingest_crash_sql() -> str:
    url = f"c.court_url || '&Fecha=' || f.fecha || '&Pagina=' || CAST(f.row_id // {ROWS_PER_PAGE} AS VARCHAR)"
    return (
        _ingest_replay_sql()
        + f" UNION ALL SELECT 'pages', count(DISTINCT {url}) FROM fixture_rows f JOIN fixture_courts c ON c.court_no = f.court_no "
        "UNION ALL SELECT 'torn', 0"
    )


@register("ingest_crash", _ingest_crash_sql())
def ingest_crash_q(spark, sf_dir):
    """G2 as one commit: runs that die after each table's write, in the first
    batch and in the second, then a run to the end.  `torn` counts the pages
    that readers saw in the quarantine, but not in the ledger, after a crash."""
    base = shared_path(spark, "crash", uuid.uuid4().hex)
    recs, quar, seen, manifest = (f"{base}/{n}" for n in ("records", "rejects", "pages", "manifest"))
    write_captures(day_pages(spark, sf_dir), f"{base}/captures")
    torn = 0
    for n in (1, 2, 3, 4, 0):  # 0: to the end
        try:
            ingest_captures(spark, f"{base}/captures", recs, quar, f"{base}/ckpt", fixture_courts(spark), page_ledger_path=seen,
                            manifest_path=manifest, max_files=4, after_write=Crash(n))
        except StreamingQueryException:
            if n == 0:
                raise
        ledger = M.read(spark, manifest, seen, PAGE_LEDGER_SCHEMA)
        torn += M.read(spark, manifest, quar, PAGE_LEDGER_SCHEMA).join(ledger, PAGE_KEY, "left_anti").select(*PAGE_KEY).distinct().count()
    count = lambda df, kind: df.groupBy().agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    return (count(M.read(spark, manifest, recs, RECORDS_SINK_SCHEMA), "records")
            .unionByName(count(M.read(spark, manifest, quar, PAGE_LEDGER_SCHEMA), "rejects"))
            .unionByName(count(ledger, "pages")).unionByName(spark.createDataFrame([("torn", torn)], "kind string, n long")))


def _unread_sql() -> str:
    kinds = ("html", "''", "'<html><table id=\"other\"><tr><td>' || html || '</td></tr></table></html>'")
    reasons = ("no_table", "empty_page", "no_rows")
    return " UNION ALL ".join(
        f"SELECT url || '#{i}-' || CAST(page_id AS VARCHAR) AS url, sha256({html}) AS content_hash, '{why}' AS reason FROM pages"
        for i, (html, why) in enumerate(zip(kinds, reasons)))


@register("page_quarantine", _unread_sql())
def page_quarantine_q(spark, sf_dir):
    """G1 for pages: none of these pages has result rows (each as it is, empty,
    and inside another table), so all are quarantined with the reason, once,
    and none enters the page ledger."""
    base = shared_path(spark, "unread", uuid.uuid4().hex)
    none = F.lit(None).cast("string")
    html = F.col("html")
    table = F.concat(F.lit('<html><table id="other"><tr><td>'), html, F.lit("</td></tr></table></html>"))
    pages = read_table(spark, sf_dir, "pages").select(
        "page_id", "url", F.posexplode(F.array(html, F.lit(""), table)).alias("n", "html"))
    pages = pages.select(
        F.concat("url", F.lit("#"), F.col("n").cast("string"), F.lit("-"), F.col("page_id").cast("string")).alias("url"),
        none.alias("court_url"), none.alias("calendar_url"), F.lit("day").alias("kind"), none.alias("fecha"),
        F.lit(None).cast("timestamp_ntz").alias("captured_at"), F.lit(200).alias("status"), "html")
    write_captures(pages, f"{base}/captures")
    for run in ("first", "second"):
        ingest_captures(spark, f"{base}/captures", f"{base}/records", f"{base}/quarantine", f"{base}/{run}", fixture_courts(spark),
                        f"{base}/ledger", f"{base}/pages")
    unread = spark.read.parquet(f"{base}/pages").select("url", "content_hash", "reason")
    ledger = spark.read.schema("url string, content_hash string").parquet(f"{base}/ledger").withColumn("reason", F.lit("ledger"))
    return unread.unionByName(ledger)
