"""Plan shape: pushdown, broadcast of the court dimension, map-side partial
aggregation for dedup, bounded cascades."""

import pytest

import __spark_entry__ as E
from edicto.constants import DEDUP_KEYS
from edicto.functions.text import clean, clean_staged
from edicto.operators import joins as J
from edicto.plans.queries import NULL_KEYS

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rolling_window_pushdown(spark):
    p = plan(E.queries()["rolling_window"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def test_records_broadcast_and_partial_dedup(spark):
    p = plan(E.queries()["bulletin_records"](spark, SF))
    assert "BroadcastHashJoin" in p
    assert p.count("SortAggregate") + p.count("HashAggregate") >= 2


def test_filter_on_a_cleaned_field_inlines_the_cascade_once(spark):
    """The optimizer moves the filter below the projections; each step names
    its input once, so the plan holds the cascade a few times, not hundreds."""
    whole = E.queries()["bulletin_records"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    for name in ("records_filtered_tipo", "records_filtered_fecha"):
        p = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert p.count("EXPEDIENTILLO") <= 4 * whole.count("EXPEDIENTILLO")
        assert len(p) < 4 * len(whole)


def test_store_is_not_shuffled(spark):
    p = plan(E.queries()["append_if_absent"](spark, SF))
    assert "LeftAnti" in p and "LeftSemi" in p
    stored = p[p.index("LeftSemi"):]
    assert "BroadcastHashJoin" in p[: p.index("LeftSemi") + 10] and "Exchange hashpartitioning" not in stored.split("BroadcastExchange")[0]


@pytest.mark.parametrize("drop", range(len(DEDUP_KEYS)))
def test_every_record_key_decides(spark, monkeypatch, drop):
    """Without any one of its keys the existence test would find other rows."""
    from edicto.plans import queries as Q

    keys = [k for k in DEDUP_KEYS if k != DEDUP_KEYS[drop]]
    new, stored = J.written(Q._batch(spark, SF), "t"), Q._stored(spark, SF)
    right = J.absent_from(new, stored, DEDUP_KEYS, is_written=True).count()
    assert right < new.count()
    assert J.absent_from(new, stored, keys, is_written=True).count() < right


@pytest.mark.parametrize("drop", NULL_KEYS)
def test_every_null_key_decides(spark, drop):
    from edicto.plans.fixtures import fixture_rows

    fx = J.written(fixture_rows(spark, SF).select("row_id", *NULL_KEYS), "t")
    new, old = fx.filter("row_id % 4 <> 1"), fx.filter("row_id % 4 = 1")
    right = J.absent_from(new, old, NULL_KEYS, is_written=True).count()
    assert 0 < right < new.count()
    assert J.absent_from(new, old, [k for k in NULL_KEYS if k != drop], is_written=True).count() < right


@pytest.mark.parametrize("name", ["record_shape", "bulletin_records"])
def test_generated_methods_are_compiled(spark, name):
    """The JVM only interprets methods beyond 8,000 bytes (HugeMethodLimit)."""
    df = E.queries()[name](spark, SF)
    df.collect()  # the final plan
    stages = df._jdf.queryExecution().debug().codegenToSeq().iterator()
    sizes = []
    while stages.hasNext():
        sizes.append(stages.next()._3().maxMethodCodeSize())
    assert sizes and max(sizes) < 8000


def test_node_lists_are_joined_once(spark):
    """Three cells and two of them together; no branch joins its list anew."""
    p = E.queries()["record_shape"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < p.count("array_join(n2") + p.count("array_join(numero_nodes") <= 4


def test_clean_staged_order_of_steps(spark):
    """T1 sees the first sign only, before stars and white space go."""
    cases = [".", "..A", ".  A", "  .A", " . A", "*.A", ".*A", "..", ". ", ".\n\nA,", ".*a@b.com,x", "áÉñÑü°€“日本”½",
             "ÁRBOL Ñandú, º,", "é", ".é", None, ""]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    for r in df.select("s", clean("s").alias("plain"), clean_staged("s").alias("staged")).collect():
        assert r.plain == r.staged, r.s
