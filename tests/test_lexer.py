"""Tags with signs of tags in their attribute values, broken quotes, long
pages, and pages as bytes."""

import time

import pytest
from pyspark.sql import functions as F

from edicto.functions import charset as CS
from edicto.functions import html as H
from edicto.operators import html as HO
from edicto.sources.io import read_captures


def one(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column.alias("x")).first().x


@pytest.mark.parametrize(("html", "nodes"), [
    ("<td valign='top' title='a > b'>1/20", ["1/20"]),
    ('<a href="/x" title="<b>">One</a> two', ["One", " two"]),
    ("1 < 2 and 3 > 2<br/>end", ["1 < 2 and 3 > 2", "end"]),
    ("<p title=it's>a</p><p class='b>c", ["a", "c"]),
    ('<p title="open>a</p>', ["a"]),
    ('<p a="1"b=\'>\'c>x', ["x"]),
    ("<p a= >x<!doctype y><?z?></ broken>end", ["x", "end"]),
    ("<x-y a=b/>t", ["t"]),
    ("<", ["<"]),
    ("<a b=<p>x", ["<a b=", "x"]),
    ("", []),
])
def test_text_nodes(spark, html, nodes):
    assert one(spark, html, H.text_nodes("html")) == nodes


@pytest.mark.parametrize(("tag", "value"), [
    ("<a title=\" href='no'\" href='/x'>", "/x"), ("<a data-href='no' href=/y/>", "/y/"), ('<a HREF = "a &amp; b" href="second">', "a & b"),
    ("<a title='href=no'>", None), ("<a hrefs='no'>", None), ("<a href=''>", ""), ('<a "href="x">', None),
])
def test_attributes(spark, tag, value):
    assert one(spark, tag + "t</a>", H.tag_attr("html", "href")) == value


def test_links(spark):
    html = "<a href='/x' title='a > b'>One</a><abbr>no</abbr><a title=\"</a>\" href='/y'><i title='>'>i</i>Two</a>"
    df = spark.createDataFrame([(html,)], "html string")
    assert [(r.href, r.text) for r in HO.extract_links(df).orderBy("pos").collect()] == [("/x", "One"), ("/y", "Two")]


def test_rows_and_cells(spark):
    html = ("<table title='<table id=t>' id=t><tbody><tr a='</tr>'><td title='<td>' valign=top>1<table><tr><td valign=x>in</table>"
            "<td data-valign='valign'>no<td valign='a > b'>2</tbody></table><table id=t><tbody><tr><td valign>later</table>")
    rows = one(spark, html, HO.result_rows("html", "t"))
    assert len(rows) == 1
    cells = one(spark, rows[0], HO.row_cells("html"))
    assert [one(spark, c, F.array_join(H.text_nodes("html"), "|")) for c in cells] == ["1|in", "2"]


def test_pieces_rebuild_the_page(spark):
    for html in ("", "a", "<nav>", "x<nav a='<nav>'>y</nav>z<navy>", "<nav", "<nav><nav></nav>", "</nav >t<NAV/>", "<nav a='open>x</nav>"):
        parts = one(spark, html, H.pieces("html", "nav"))
        assert "".join(parts) == html
        assert all(p.lower().startswith(("<nav", "</nav")) for p in parts[1:])


def sections(n):
    return "".join(f"<nav{' id=n%d' % i if i % 3 else ''}><a href='/{i}' title='</nav>'>t{i}</a>" + ("</nav>" if i % 4 else "") for i in range(n))


def brute(n):
    stack, out = [], []
    for i in range(n):
        stack.append(f"n{i}" if i % 3 else None)
        out.append((f"/{i}", next((x for x in stack if x is not None), None)))
        if i % 4:
            stack.pop()
    return out


def test_sections_in_linear_time(spark):
    took = {}
    for n in (2000, 16000, 16000):  # the first runs compile code
        df = spark.createDataFrame([(sections(n),)], "html string")
        start = time.time()
        rows = HO.section_links(df, tags=("nav",)).orderBy("order_key").collect()
        took[n] = time.time() - start
        assert [(r.href, r.section_id) for r in rows] == brute(n)
    assert took[16000] < 10


def test_a_long_broken_tag_is_read_in_linear_time(spark):
    for html in ("<a " + "x='1' " * 100_000, "<a title=\"" * 20_000, "<" * 200_000, "'" + '"' * 100_000 + "<p>x"):
        start = time.time()
        one(spark, html, F.size(H.text_nodes("html")) + F.size(H.pieces("html", "nav")))
        assert time.time() - start < 10


def decoded(spark, data, **more):
    df = spark.createDataFrame([(bytearray(data) if data is not None else None,)], "content binary")
    return df.select(CS.page_charset("content", **more).alias("c"), CS.decode_page("content", **more).alias("t")).first()


def test_page_charsets(spark):
    text = "<p>Señor – 5 €</p>"
    meta = '<meta charset="{}">'
    for data, want, name in [
        (text.encode(), text, "utf-8"), (b"\xef\xbb\xbf" + text.encode(), text, "utf-8"), (b"\xff\xfe" + text.encode("utf-16le"), text, "utf-16le"),
        (b"\xfe\xff" + (text + "\U0001f642").encode("utf-16be"), text + "\U0001f642", "utf-16be"), (text.encode("cp1252"), text, "windows-1252"),
        ((meta.format("latin1") + text).encode("cp1252"), meta.format("latin1") + text, "windows-1252"),
        ((meta.format("iso-8859-2") + "łódź").encode("iso-8859-2"), meta.format("iso-8859-2") + "łódź", "iso-8859-2"),
        ((meta.format("utf-16") + text).encode(), meta.format("utf-16") + text, "utf-8"),
        ((meta.format("x-unknown") + text).encode(), meta.format("x-unknown") + text, "utf-8"),
        (b"\xef\xbb\xbf" + (meta.format("koi8-r") + text).encode(), meta.format("koi8-r") + text, "utf-8"),
        ((" " * 2000 + meta.format("koi8-r") + "é").encode(), " " * 2000 + meta.format("koi8-r") + "é", "utf-8"),
        (b"", "", "utf-8"),
    ]:
        got = decoded(spark, data)
        assert (got.t, got.c) == (want, name)
    assert decoded(spark, None).t is None
    assert decoded(spark, "дом".encode("koi8-r"), header=F.lit("KOI8-R")).t == "дом"
    assert decoded(spark, b"\xe9\xff", fallback="iso-8859-15").t == "éÿ"


def test_bytes_that_are_no_text(spark):
    assert decoded(spark, b"\xef\xbb\xbfa\xffb").t == "a�b"
    assert decoded(spark, b"\xff\xfea\x00\x00\xd8b\x00c").t == "a�b�"
    assert decoded(spark, b"\xfe\xff\x00a\xdc\x00\xd8\x00\x00b").t == "a��b"


def test_page_files(spark, tmp_path):
    for name, data in (("a", "é".encode()), ("b", "é".encode("cp1252")), ("c", b"x")):
        (tmp_path / name).write_bytes(data)
    rows = read_captures(spark, str(tmp_path), "bytes").collect()
    assert sorted((r.url[-1], r.html, r.status) for r in rows) == [("a", "é", 200), ("b", "é", 200), ("c", "x", 200)]


def test_attribute_scans_the_page_once(spark):
    """However often the found tag is looked at, the plan names the page once."""
    df = spark.createDataFrame([('<p><input id="a" value="x &amp; y"><input id=\'a\' value=z>',), ("<p>",), (None,)], "html string")
    out = df.select(H.html_attr("html", "input", "value", id_="a").alias("v"))
    assert [r.v for r in out.collect()] == ["x & y", None, None]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


def test_text_nodes_split_the_fragment_once(spark):
    cases = [("a<b>&#65;&#x42;&amp;&nope;&#xD800;&;c</b><i></i> ", ["a", "AB&&nope;&#xD800;&;c", " "]), ("<b></b>", []), ("", []), (None, None)]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    out = df.select(H.text_nodes("t").alias("v"))
    assert [r.v for r in out.collect()] == [v for _, v in cases]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(t#") == 1
