"""Golden pages: listing, calendar and day page through the HTML operators."""

from pyspark.sql import functions as F

from edicto.functions import html as H
from edicto.operators import html as HO
from tests.golden import CALENDAR, DAY, LISTING, LISTING_URL


def test_build_courts(spark):
    df = spark.createDataFrame([(LISTING_URL, LISTING)], ["url", "html"])
    rows = {r.juz_id: r for r in HO.build_courts(df).collect()}
    assert set(rows) == {"1", "2", "3"}  # first 3 matching links skipped, class 'b' ignored
    assert rows["1"].entidad_code == "lapaz" and rows["3"].entidad_code == "loscabos"
    assert rows["1"].court_url.startswith("https://bulletins.example.org/AccesoLibre/LiAcuerdosBusqueda.aspx?")
    assert rows["3"].juzgado == "Primero Penal Renombrado"  # later link wins
    assert rows["1"].materia == "CIVIL" and rows["2"].materia == "FAMILIAR" and rows["3"].materia == "PENAL"


def test_calendar(spark):
    df = spark.createDataFrame([(CALENDAR,)], ["html"])
    prev, nxt = HO.calendar_nav("html")
    r = df.select(HO.calendar_year("html").alias("y"), prev.alias("p"), nxt.alias("n")).first()
    assert (r.y, r.p, r.n) == ("2022", "V8309", "V8370")
    days = HO.calendar_days(df).orderBy("day_arg").collect()
    assert [(d.day_arg, d.fecha, str(d.code_date)) for d in days] == [
        ("8367", "2022/11/28", "2022-11-28"), ("8368", "2022/11/29", "2022-11-29")]


def test_day_page(spark):
    df = spark.createDataFrame([(DAY,)], ["html"])
    rows = HO.day_page_rows(df).orderBy("row_pos").collect()
    assert len(rows) == 3
    assert rows[0].numero_nodes == ["EXPEDIENTE: 12/2020"]
    assert rows[0].n2 == ["ORDINARIO CIVIL.- JUAN PÉREZ VS ANA & CIA.- SE ADMITE", "SENTENCIA DEFINITIVA"]
    assert rows[0].n3 == ["Síntesis:\xa0uno"]
    assert rows[1].numero_nodes == [] and rows[1].n2 == []  # no valign cell
    assert rows[2].n2 == ["DIVORCIO.- ", "LUIS", " VS MARIA"]  # nested table text kept in the cell
    assert rows[2].n3 == []


def test_links_skip_and_filter(spark):
    df = spark.createDataFrame([(LISTING,)], ["html"])
    out = HO.extract_links(df, css_class="a", href_contains="LiAcuerdos", skip=3).collect()
    assert [r.text for r in out] == ["Primero Mercantil", "Segundo Familiar", "Primero Penal",
                                     "Primero Penal Renombrado"]
    assert all(F is not None for F in out)


def test_deep_nesting(spark):
    from tests.golden import DEEP

    df = spark.createDataFrame([(1, DEEP), (2, DAY)], ["page", "html"])
    rows = {(r.page, r.row_pos): r for r in HO.day_page_rows(df, keep=("page",)).collect()}
    assert rows[(1, 0)].n2 == ["A.- ", "HONDO", " VS B"] and rows[(1, 0)].n3 == ["sí"]
    assert rows[(1, 1)].numero_nodes == ["2/2020"] and rows[(1, 1)].n3 == []
    assert rows[(2, 2)].n2 == ["DIVORCIO.- ", "LUIS", " VS MARIA"]


def nested(depth):
    inner = "x"
    for _ in range(depth):
        inner = f'<table><tbody><tr><td valign="top">{inner}</td></tr></tbody></table>'
    return inner


def test_any_depth_and_missing_end_tags(spark):
    """Rows and cells of the result table, whatever nests in them and whichever end tags are missing."""
    open_, ids = '<table class="t" id="ctl00_ContentPlaceHolder1_tblResultados">', []
    for depth in range(5):
        for close in ("</td>", ""):
            for end in ("</tr>", ""):
                rows = "".join(f'<tr><td valign=top>{i}{close}<td>skip{close}<td valign=top>a{nested(depth)}b{close}{end}' for i in range(3))
                ids.append((depth, f'<p>y<table id="other"><tr><td valign=top>no</table>{open_}<tbody>{rows}</tbody></table><table><tr><td valign=top>no</table>'))
    df = spark.createDataFrame([(i, d, h) for i, (d, h) in enumerate(ids)], "page long, depth long, html string")
    got = HO.day_page_rows(df, keep=("page", "depth")).collect()
    assert len(got) == 3 * len(ids)
    for r in got:
        assert r.numero_nodes == [str(r.row_pos)] and r.n2 == ["a", "x", "b"] if r.depth else r.n2 == ["axb"]
    many = f"{open_}<tbody>" + "".join(f"<tr><td valign=top>{i}</td>" for i in range(5000)) + "</tbody></table>"
    assert HO.table_rows(spark.createDataFrame([(many,)], "html string")).count() == 5000


def test_page_reject(spark):
    table = '<table id="ctl00_ContentPlaceHolder1_tblResultados"><tbody>{}</tbody></table>'
    pages = [(None, "empty_page"), ("  ", "empty_page"), ("<p>x", "no_table"), ("<table><tr><td>1</table>", "no_rows"),
             (table.format(""), "no_rows"), (table.format("<tr><td>1"), None)]
    df = spark.createDataFrame(pages, "html string, want string")
    assert all(r.want == r.got for r in df.select("want", HO.page_reject("html").alias("got")).collect())


def test_sections_nest(spark):
    page = ('<a href="0">x</a><table id="tblLaPaz"><tr><td><a href="1">x</a><table><tr><td><a href="2">x</a></table><a href="3">x</a></table>'
            '<table><tr><td><table id="tblIn"><tr><td><a href="4">x</a></table><a href="5">x</a></table><a href="6">x</a>')
    rows = HO.section_links(spark.createDataFrame([(page,)], "html string"), tags=("table",)).orderBy("order_key").collect()
    assert [r.section_id for r in rows] == [None, "tblLaPaz", "tblLaPaz", "tblLaPaz", "tblIn", None, None]
    many = "<table id=t>" + "<tr><td><a href=q>x</a>" * 3 + "</table><table></table>" * 2300 + "<a href=z>y</a>"
    rows = HO.section_links(spark.createDataFrame([(many,)], "html string"), tags=("table",)).orderBy("order_key").collect()
    assert [r.section_id for r in rows] == ["t", "t", "t", None]


def test_character_references(spark):
    text = "P&#233;rez &#XE1;&#xf1 &agrave; &sect; &ndash; &amp;lt; &lt;b&gt; &nope; AT&T &#0; &#x110000; &#128578; &Ntilde;&apos;&"
    got = spark.createDataFrame([(text,)], "s string").select(H.unescape("s").alias("s")).first().s
    assert got == "Pérez áñ à § – &lt; <b> &nope; AT&T &#0; &#x110000; \U0001f642 Ñ'&"


def test_courts_of_two_captures(spark):
    later = LISTING.replace("Primero Mercantil", "Primero Mercantil y Civil")
    df = spark.createDataFrame([(LISTING_URL, "2024-02-01", later), (LISTING_URL, "2024-01-01", LISTING)], "url string, captured_at string, html string")
    rows = {r.juz_id: r for r in HO.build_courts(df, calendar_url="https://cal/").collect()}
    assert set(rows) == {"1", "2", "3"} and rows["1"].juzgado == "Primero Mercantil y Civil"
    assert all(r.calendar_url == "https://cal/" for r in rows.values())


def test_link_text_is_direct_text(spark):
    html = '<p><a href="/x"><b>Negrita</b> directo</a><a href="/y">uno<br>dos</a></p>'
    df = spark.createDataFrame([(html,)], ["html"])
    assert [r.text for r in HO.extract_links(df).orderBy("pos").collect()] == [" directo", "uno"]
