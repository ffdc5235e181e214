"""Word lists of any length (L1, L4), unit planning without a broadcast (J1),
first capture under late data (R3)."""

import uuid

import pytest
from pyspark.sql import functions as F

from edicto.operators.joins import grid_join
from edicto.operators.keywords import BLOCK, classify_words
from edicto.operators.worklist import plan_units
from edicto.session import shared_path
from edicto.streaming.ingest import first_captures, stream_first_captures

WORDS = "word string, priority long, label string"


def brute(text, words):
    hits = [(p, label) for w, p, label in words if w is not None and text is not None and w in text]
    return min(hits)[1] if hits else None


@pytest.mark.parametrize("empty", [False, True])
def test_words_equal_brute_force(spark, empty):
    words = [("a", 9, "one"), ("civil", 2, "civil"), ("civ", 5, "short"), ("penal y civil", 1, "both"), ("ñandú", 3, "sign"),
             ("x" * 300, 0, "long"), (None, 0, "null"), ("civil", 2, "civic"), ("\n", 4, "line")] + ([("", 7, "all")] if empty else [])
    pad = "-" * (BLOCK - 3)
    texts = [None, "", "a", "juzgado civil", "penal y civil", "el ñandú", pad + "civil", pad + "penal y civi", "x" * 299, "x" * 300,
             pad + "x" * 300, "civi", "b\n", "-" * 20000 + "civ", "a", "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "label long, t string")  # a clashing name
    got = {r["label"]: r["found"] for r in classify_words(df, "t", spark.createDataFrame(words, WORDS), "found").collect()}
    assert got == {i: brute(t, words) for i, t in enumerate(texts)}


def test_no_words_and_no_texts(spark):
    none = spark.createDataFrame([], WORDS)
    texts = spark.createDataFrame([("a",), (None,)], "t string")
    assert [r["label"] for r in classify_words(texts, "t", none).collect()] == [None, None]
    some = spark.createDataFrame([("a", 1, "x")], WORDS)
    assert classify_words(texts.limit(0), "t", some).count() == 0


def test_many_words_are_one_lookup(spark):
    """The plan doesn't hold the words, however many there are."""
    words = spark.range(20000).select(F.concat(F.lit("w"), "id", F.lit("z")).alias("word"), F.col("id").alias("priority"), F.col("id").cast("string").alias("label"))
    df = spark.range(500).select("id", F.concat(F.lit("..w"), "id", F.lit("z..")).alias("t"))
    out = classify_words(df, "t", words)
    assert out.filter("label = cast(id AS string)").count() == 500
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 5000


def test_units_of_one_calendar_fill_all_tasks(spark):
    days = spark.range(200).select(F.lit("cal").alias("calendar_url"), F.col("id").cast("string").alias("day_arg"), F.lit("f").alias("fecha"))
    courts = spark.range(300).select(F.lit("cal").alias("calendar_url"), F.concat(F.lit("u"), "id").alias("court_url"), F.col("id").cast("string").alias("juz_id"),
                                     F.lit("e").alias("entidad_code"), F.concat(F.lit("juzgado civil "), F.col("id") + 1000).alias("juzgado"))
    plain = plan_units(days, courts)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        dealt = plan_units(days, courts)
        assert "Broadcast" not in dealt._jdf.queryExecution().executedPlan().toString()
        shares = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(shares) == 60000 and len(shares) == 8 and max(shares) < 0.3 * 60000
        assert dealt.select(*plain.columns).exceptAll(plain).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_grid_join_keeps_repeats_and_drops_null_keys(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, x long")
    right = spark.createDataFrame([("a", 7), ("a", 7), ("c", 8), (None, 9)], "k string, y long")
    assert grid_join(left, right, ["k"]).exceptAll(left.join(right, "k")).count() == 0
    assert grid_join(left, right, ["k"]).count() == 4


CAPTURES = "k string, ts timestamp_ntz, id long"


def _rows(spark, rows):
    return spark.createDataFrame([(k, t, i) for k, t, i in rows], "k string, t string, id long").select("k", F.col("t").cast("timestamp_ntz").alias("ts"), "id")


def test_earlier_capture_that_arrives_late_wins(spark):
    base = shared_path(spark, "first", uuid.uuid4().hex)
    arrivals = [
        [("a", "2024-01-10", 1), ("b", "2024-01-10", 2), (None, "2024-01-10", 3)],
        [("a", "2024-01-08", 4), ("a", "2024-01-14", 5), (None, "2024-01-09", 6), ("b", "2024-01-10", 0)],
        [("a", "2024-01-12", 7), ("c", None, 8)],
        [("z", "2024-06-01", 9)],
    ]
    for rows in arrivals:  # a run, and so a restart, per arrival
        _rows(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/src")
        stream_first_captures(spark, f"{base}/src", _rows(spark, rows).schema, f"{base}/sink", f"{base}/ckpt", ["k"], "ts", "id", "3 days", "10 days")
    got = {(r["k"], r["id"]) for r in spark.read.parquet(f"{base}/sink").collect()}
    assert got == {("a", 4), ("b", 0), (None, 6)}


def test_runs_meet_at_the_gap(spark):
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-03", 2), ("a", "2024-01-05 00:00:01", 3)]
    assert {r["id"] for r in first_captures(_rows(spark, rows), "ts", ["k"], "id", "2 days").collect()} == {1, 3}


def test_words_beyond_the_broadcast_limit_send_runs_not_places(spark, monkeypatch):
    """Each different run of letters is searched once, however often texts hold it."""
    from edicto.operators import keywords as K

    searched, written = [], K.written
    monkeypatch.setattr(K, "written", lambda df, name: (lambda w: (name == "word-pieces" and searched.append(w.count()), w)[1])(written(df, name)))
    words = spark.createDataFrame([("w%sord" % c * 2, i, c) for i, c in enumerate("abcdefg")] + [("zulu" * 5, 8, "z")], WORDS)
    rows = [(i, f"{i} " + "no 12 " * 50 + f"w{c}ordw{c}ord! " * 20 + "zulu" * 100) for i in range(40) for c in "abcdefg"]
    df = spark.createDataFrame(rows, "id long, t string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = sorted((r["id"], r["label"]) for r in classify_words(df, "t", words).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == sorted((i, c) for i, _ in rows[::7] for c in "abcdefg")
    assert searched and searched[0] < 20


def test_units_of_broadcast_sides_fill_all_tasks(spark):
    """The few days of a calendar are one partition; the courts are dealt."""
    days = spark.range(50).coalesce(1).select(F.lit("cal").alias("calendar_url"), F.col("id").cast("string").alias("day_arg"), F.lit("f").alias("fecha"))
    courts = spark.range(1600).coalesce(1).select(F.lit("cal").alias("calendar_url"), F.concat(F.lit("u"), "id").alias("court_url"), F.col("id").cast("string").alias("juz_id"),
                                                  F.lit("e").alias("entidad_code"), F.concat(F.lit("juzgado civil "), F.col("id") + 1000).alias("juzgado"))
    units = plan_units(days, courts)
    assert "BroadcastHashJoin" in units._jdf.queryExecution().executedPlan().toString()
    shares = [r["count"] for r in units.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(shares) == 80000 and len(shares) == 8 and max(shares) < 0.2 * 80000
    assert units.select("day_arg", "juz_id").distinct().count() == 80000
