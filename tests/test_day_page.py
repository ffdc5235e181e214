"""The one-pass reader of day pages against the Column functions it stands for."""

import random
import time

from pyspark.sql import functions as F

from edicto.constants import RESULTS_TABLE_ID as ID
from edicto.functions import day_page as D
from edicto.operators import html as HO

HEADS = (
    "", f"<html><table id='{ID}'><tbody><tr><td valign=top>", f"<a title='<table id={ID}>'>",
    f'<div><table><tr><td><TABLE a="<table>" ID = "{ID}" b><tbody>', f"<table id={ID}><tr><td valign>x</td></tr><tbody><tr>",
)
BITS = (
    "<table>", "</table>", "<TABLE id=x>", "</TABLE >", f"<table id={ID}>", "<tbody>", "</tbody>", "<TBODY class='>'>", "<tr>", "</tr>", "<TR x>",
    "<td valign>", "<td valign='top'>", "<td VALIGN=top title='</td>'>", "<td>", "</td>", "<th>", "</th>", "<thead>", "</tfoot>", "<td data-valign=1>",
    "<td a=", "<tr b='", "<tr b='>", '<table c="', "</table a=", "</tr a=<", "<td/valign/>", "<tdé>", "<td-x>", "<b title='<td>'>", "<br/>", "<!doctype x>",
    "<! <td>", "</ broken", "<", "<<", ">", "'", '"', "a", "b c", "1 < 2", "é", "&amp;", "&#65;", "&#x42;", "&nope;", "&#xD800;", "&#0;", "&;", "&lt;td&gt;",
    "\n", " ", "\x00", "=", "/", "<script>x<td></script>", "<!-- <tr> -->", "<style>", "😀",
)


def by_columns(df, *keep):
    rows = HO.table_rows(df, "html", ID, True, keep).select(*keep, "row_pos", HO.row_cells("row_html").alias("_c"))
    return rows.select(*keep, "row_pos", *[HO.cell_nodes("_c", k).alias(c) for k, c in enumerate(D.CELLS)])


def test_rows_are_those_of_the_column_functions(spark):
    rnd = random.Random(7)
    pages = [None, ""] + [rnd.choice(HEADS) + "".join(rnd.choice(BITS) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string").repartition(8, "i")
    got = {tuple(r) for r in HO.day_page_rows(df, keep=("i",)).select("i", "row_pos", F.to_json(F.struct(*D.CELLS))).collect()}
    want = {tuple(r) for r in by_columns(df, "i").select("i", "row_pos", F.to_json(F.struct(*D.CELLS))).collect()}
    assert len(want) > 1000 and got == want


def test_a_page_is_read_once_by_one_function(spark):
    plan = HO.day_page_rows(spark.createDataFrame([("<p>",)], "html string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp_extract_all" not in plan and "Filter" not in plan


def test_reading_takes_linear_time():
    table = f"<table id='{ID}'><tbody>"
    for unit in ("<tr><td valign>x", "<table><tr><td>y</table>", "<table>", "<tr b='", '<td a="', "<td a=", "<", "</td", "'", "&amp;", "<a x="):
        took = []
        for n in (20_000, 80_000):
            start = time.time()
            for cells in D.page_rows(table + unit * n, ID):
                for c in cells:
                    D.text_nodes(c)
            took.append(time.time() - start)
        assert took[1] < 1 or took[1] < 10 * took[0], unit
