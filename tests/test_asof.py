"""Attributes as of a capture, and the court history of listings."""

import datetime as dt

from pyspark.sql import functions as F

from edicto.functions.text import CLEAN_STEPS, clean_staged
from edicto.operators import asof as AO
from edicto.operators.html import build_courts
from edicto.plans.queries import SIGN_CASES


def day(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def captures(spark):
    return spark.createDataFrame([("a", "A", day(10)), ("a", "A", day(20)), ("a", "B", day(200)), ("a", None, day(300)), ("a", "B", day(300)),
                                  ("b", None, day(0)), ("b", "X", day(5)), (None, "Y", day(0)), ("c", "Z", None)], "k string, name string, t timestamp_ntz")


def test_versions(spark):
    got = {(r.k, r.name, r.valid_from, r.valid_to) for r in AO.versions(captures(spark), "k", "t", ["name"]).collect()}
    assert got == {("a", "A", day(10), day(200)), ("a", "B", day(200), None), ("b", None, day(0), day(5)), ("b", "X", day(5), None)}


def test_as_of(spark):
    rows = [("a", day(9)), ("a", day(10)), ("a", day(199)), ("a", day(200)), ("a", day(5000)), ("b", day(4)), ("b", day(5)), ("q", day(50)),
            (None, day(50)), ("a", None)]
    df = spark.createDataFrame([(k, t, "old", i) for i, (k, t) in enumerate(rows)], "k string, t timestamp_ntz, name string, _from_ int")
    out = AO.as_of(df, AO.versions(captures(spark), "k", "t", ["name"]), "k", "t", ["name"])
    assert [r.name for r in out.orderBy("_from_").collect()] == [None, "A", "A", "B", "B", None, "X", None, None, None]
    assert AO.as_of(df.limit(0), AO.versions(captures(spark), "k", "t", ["name"]), "k", "t", ["name"]).count() == 0


def test_hot_court_is_dealt_by_month(spark):
    """Without broadcasting, a court that holds all rows is spread over its months."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = spark.range(2400).select(F.lit("a").alias("k"), F.expr("timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, id)").alias("t"), "id")
        out = AO.as_of(rows, AO.versions(captures(spark), "k", "t", ["name"]), "k", "t", ["name"])
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 2400 and max(sizes) < 1200 and len(sizes) >= 6
        assert out.filter("name IS NULL").count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_court_history_of_listings(spark):
    page = "<table id='tblLaPaz'>" + "<a class='a' href='LiAcuerdos.aspx'>n</a>" * 3 + "<a class='a' href='LiAcuerdosBusqueda.aspx?JuzId=7'>{}</a></table>"
    df = spark.createDataFrame([("http://x/l", page.format(n), day(i)) for i, n in ((0, "Uno Civil"), (9, "Uno Civil"), (40, "Dos Penal"))],
                               "url string, html string, captured_at timestamp_ntz")
    own = AO.versions(build_courts(df, history=True), "court_url", "seen_at", ["juzgado", "materia"]).orderBy("valid_from").collect()
    assert [(r.juzgado, r.materia, r.valid_from, r.valid_to) for r in own] == [("Uno Civil", "CIVIL", day(0), day(40)), ("Dos Penal", "PENAL", day(40), None)]


def test_signs(spark):
    df = spark.createDataFrame([(s, w) for s, w in SIGN_CASES], "s string, w string")
    step = CLEAN_STEPS["t7_ascii_upper"]
    for r in df.select("s", "w", step("s").alias("t7"), step(F.concat(F.lit("x"), "s", F.lit("y"))).alias("in"),
                       clean_staged(F.concat(F.lit("x"), "s", F.lit("y"))).alias("staged")).collect():
        assert r.t7 == r.w and r["in"] == f"X{r.w}Y"
        assert r.staged == f"X{r.w}Y".replace('"', "'")
