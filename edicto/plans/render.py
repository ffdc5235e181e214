"""Captured pages derived from the driver tables.

The bulletin site is not reachable, so captured pages are rendered by
Spark from the fixture rows (day pages) and from the months of `orders`
(calendar pages), in the page layout the parsers read.  Their number grows
with the tables, which makes the HTML operators' work scale with the data.
Captures follow the `captures(url, court_url, calendar_url, kind, fecha,
captured_at, status, html)` schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edicto.constants import CALENDAR_EPOCH, CALENDAR_TABLE_ID, MONTHS, RESULTS_TABLE_ID
from edicto.functions.dates import date_to_code
from edicto.operators.joins import sized
from edicto.plans.fixtures import SHARED_CALENDAR_URL, fixture_courts, fixture_rows, read_table

# Result rows per rendered day page (bulletins are paginated).  Pages group
# rows by (court, day, row_id div ROWS_PER_PAGE), so no page holds more than
# this many rows however skewed the (court, day) distribution is.
ROWS_PER_PAGE = 64
# The same for month pages: ids that one page spans.
IDS_PER_MONTH_PAGE = 1 << 16
POSTBACK = "javascript:__doPostBack('ctl00$ContentPlaceHolder1$Calendar1','{}')"


def esc(c: Column) -> Column:
    """HTML-escape text content; some accents become references, one of each
    kind (decimal, hexadecimal, named)."""
    for sign, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("í", "&#237;"), ("é", "&#xE9;"), ("ñ", "&ntilde;")):
        c = F.replace(c, F.lit(sign), F.lit(ref))
    return c


def _nested(row: Column) -> Column:
    """Tables nested 0 to 4 deep, by row number, with some end tags missing."""
    out = F.lit("")
    for depth in range(1, 5):
        inner = "x"
        for k in range(depth):
            inner = f'<table id="in"><tbody><tr><td valign="top">{inner}' + ("</td></tr>" if k % 2 else "") + "</tbody></table>"
        out = F.when(row % 5 == depth, F.lit(inner)).otherwise(out)
    return out


def _end(tag: str, row: Column) -> Column:
    """The end tag, missing in every third row."""
    return F.when(row % 3 == 2, F.lit("")).otherwise(F.lit(f"</{tag}>"))


def _postback(code: Column) -> Column:
    pre, post = POSTBACK.split("{}")
    return F.concat(F.lit(pre), code, F.lit(post))


def day_pages(spark: SparkSession, sf_dir: str, per: str = "day") -> DataFrame:
    """Captured day pages: one per (court, day, block of row ids), or with
    `per="month"` one per (court, month, wider block), dated its first day,
    with more rows.  The second cell of a row holds its id, its own day and
    nested tables; attribute values hold signs of tags."""
    k = F.col("row_id")
    row_html = F.concat(
        F.lit('<tr data-from="0 > 1"><td title="a > b" valign="top">'), F.coalesce(esc(F.col("numero")), F.lit("")),
        _end("td", k), F.lit("""<td class="n" data-also='<td valign="top">'>"""), k.cast("string"), F.lit("<br>"), F.col("fecha"), _nested(k),
        _end("td", k), F.lit("""<td valign='top' title='</td></tr><table id="no">'>"""),
        F.concat_ws('<br title=">">', esc(F.col("td2_first")), esc(F.col("td2_rest"))),
        _end("td", k), F.lit('<td valign=top title=">>">'), F.coalesce(esc(F.col("td3_first")), F.lit("")),
        _end("td", k), _end("tr", k),
    )
    day = F.col("fecha") if per == "day" else F.concat(F.substring("fecha", 1, 7), F.lit("/01"))
    block = (k / (ROWS_PER_PAGE if per == "day" else IDS_PER_MONTH_PAGE)).cast("long")
    rows = fixture_rows(spark, sf_dir).select(
        "court_no", day.alias("fecha"), block.alias("page_no"), F.struct("row_id", row_html.alias("h")).alias("r"),
    )
    pages = rows.groupBy("court_no", "fecha", "page_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["h"]), "").alias("body")
    )
    courts = sized(fixture_courts(spark).select("court_no", "court_url", "calendar_url"))
    html = F.concat(
        F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>Boletin</title></head><body>'
              '<form method="post"><input type="hidden" name="__VIEWSTATE" id="__VIEWSTATE" value="'),
        _state("v"), F.lit('"/><input value=\''), _state("e"),
        F.lit("' id='__EVENTVALIDATION' name=\"__EVENTVALIDATION\" type=hidden>"
              f'<table summary="1 > 0 <table>" id="{RESULTS_TABLE_ID}" width="100%"><tbody class=">">'),
        F.col("body"),
        F.lit("</tbody></table></form></body></html>"),
    )
    return pages.join(courts, "court_no").select(
        F.concat(F.col("court_url"), F.lit("&Fecha="), F.col("fecha"), F.lit("&Pagina="),
                 F.col("page_no").cast("string")).alias("url"),
        "court_url",
        "calendar_url",
        F.lit("day").alias("kind"),
        "fecha",
        F.to_timestamp(F.col("fecha"), "yyyy/MM/dd").cast("timestamp_ntz").alias("captured_at"),
        F.lit(200).alias("status"),
        html.alias("html"),
    )


def _state(kind: str) -> Column:
    """A form state value that differs from page to page."""
    return F.concat(F.lit(kind), F.replace("fecha", F.lit("/"), F.lit("")), F.lit("-"), F.col("court_no").cast("string"),
                    F.lit("-"), F.col("page_no").cast("string"), F.lit("=="))


def _month_names() -> Column:
    kv = []
    for k, v in MONTHS.items():
        kv += [F.lit(int(v)), F.lit(k[3:])]
    return F.create_map(*kv)


def calendar_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One captured calendar page per month present in `orders`."""
    months = (
        read_table(spark, sf_dir, "orders")
        .select(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
        .dropDuplicates(["month"])
    )
    m = F.col("month")
    name = F.try_element_at(_month_names(), F.month(m))
    days = F.sequence(m, F.last_day(m), F.expr("INTERVAL 1 DAY"))
    day_td = F.transform(
        days,
        lambda d: F.concat(
            F.lit('<td align="center" axis="<tr>"><a rel="x > y" href="'), _postback(date_to_code(d)),
            F.lit('" style="color:Black" title="'), F.dayofmonth(d).cast("string"),
            F.lit(" de "), name, F.lit('">'), F.dayofmonth(d).cast("string"), F.lit("</a></td>"),
        ),
    )
    n_weeks = F.ceil(F.size(days) / 7).cast("int")
    weeks = F.transform(
        F.sequence(F.lit(0), n_weeks - 1),
        lambda w: F.concat(F.lit("<tr>"), F.array_join(F.slice(day_td, w * 7 + 1, 7), ""), F.lit("</tr>")),
    )
    prev_code = F.concat(F.lit("V"), date_to_code(F.add_months(m, -1)))
    next_code = F.concat(F.lit("V"), date_to_code(F.add_months(m, 1)))
    header = F.concat(
        F.lit('<tr><td colspan="7"><table class="hdr" width="100%"><tr><td><a href="'),
        _postback(prev_code), F.lit('" title="Ir al mes anterior">&lt;</a></td><td align="center">'),
        name, F.lit(" de "), F.year(m).cast("string"),
        F.lit('</td><td align="right"><a href="'), _postback(next_code),
        F.lit('" title="Ir al mes siguiente">&gt;</a></td></tr></table></td></tr>'),
    )
    weekdays = "".join(f"<th>{d}</th>" for d in ("lu", "ma", "mi", "ju", "vi", "sá", "do"))
    html = F.concat(
        F.lit('<!DOCTYPE html><html><body><form method="post">'
              '<input type="hidden" name="__VIEWSTATE" id="__VIEWSTATE" value="dDwtMTA="/>'
              f'<table id="{CALENDAR_TABLE_ID}" cellspacing="0">'),
        header,
        F.lit(f"<tr>{weekdays}</tr>"),
        F.array_join(weeks, ""),
        F.lit("</table></form></body></html>"),
    )
    return months.select(
        F.concat(F.lit(SHARED_CALENDAR_URL), F.lit("&Mes="), F.date_format(m, "yyyy-MM")).alias("url"),
        F.lit(SHARED_CALENDAR_URL).alias("court_url"),
        F.lit(SHARED_CALENDAR_URL).alias("calendar_url"),
        F.lit("calendar").alias("kind"),
        F.date_format(m, "yyyy/MM/dd").alias("fecha"),
        m.cast("timestamp_ntz").alias("captured_at"),
        F.lit(200).alias("status"),
        html.alias("html"),
    )


LISTING_BASE = "https://bulletins.example.org/AccesoLibre/"
COURTS_PER_LISTING = 50
# Subject words appended to invented court names (so the listing carries
# every subject rule); chosen by supplier key modulo their count.
LISTING_SUBJECTS = ("Civil", "Familiar", "Penal", "Laboral", "Mercantil", "de Materia Administrativa")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Court listing pages rendered from `supplier` x `nation`: one page per
    (nation, block of COURTS_PER_LISTING supplier keys), a table
    `tbl<Nation>` of court links, three leading navigation links that match
    the court-link filter, one link of another class, and every seventh
    court listed again under a new name (the later link wins)."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    subj = F.element_at(F.array(*[F.lit(w) for w in LISTING_SUBJECTS]),
                        (F.col("s_suppkey") % len(LISTING_SUBJECTS) + 1).cast("int"))
    name = F.concat(F.col("s_name"), F.lit(" "), subj)
    href = F.concat(F.lit("LiAcuerdosBusqueda.aspx?MpioId="), F.col("n_nationkey").cast("string"),
                    F.lit("&amp;JuzId="), F.col("s_suppkey").cast("string"), F.lit("&amp;JuzDescrip=X"))
    link = F.concat(F.lit("""<tr><td><a class="a" title='</a> > <a class="a">' href=\""""), href, F.lit('">'), esc(name), F.lit("</a></td></tr>"))
    again = F.when(
        F.col("s_suppkey") % 7 == 0,
        F.concat(F.lit('<tr><td><a class="a" href="'), href, F.lit('">'), esc(name), F.lit(" Nuevo</a></td></tr>")),
    ).otherwise(F.lit(""))
    rows = j.select(
        "n_name", (F.col("s_suppkey") / COURTS_PER_LISTING).cast("long").alias("block"),
        F.struct("s_suppkey", F.concat(link, again).alias("h")).alias("r"),
    )
    pages = rows.groupBy("n_name", "block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["h"]), "").alias("body")
    )
    nav = "".join(
        f'<a class="a" href="LiAcuerdos.aspx?Vista={i}">{label}</a>'
        for i, label in enumerate(("Inicio", "Ayuda", "Contacto"))
    )
    section_id = F.concat(F.lit("tbl"), F.regexp_replace("n_name", " ", ""))
    html = F.concat(
        F.lit(f"<!DOCTYPE html><html><body><div>{nav}</div>"
              '<a class="b" href="LiAcuerdosBusqueda.aspx?JuzId=0">Otro</a><table id="'),
        section_id, F.lit('">'), F.col("body"), F.lit("</table></body></html>"),
    )
    return pages.select(
        F.concat(F.lit(LISTING_BASE + "LiAcuerdos.aspx?Entidad="), F.regexp_replace("n_name", " ", "+"),
                 F.lit("&Bloque="), F.col("block").cast("string")).alias("url"),
        html.alias("html"),
    )


PARTS_PER_PAGE = 40


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of known links, one per `part`: in no section, in one, or in
    sections nested in each other, with signs of tags in attribute values and
    links in comments and scripts, which are none."""
    part = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    link = F.concat(F.lit("""<a title="x > y" data-q='<a href="no">' href="/p?k="""), k.cast("string"), F.lit("""&amp;b=1"><b class=">">bold</b>"""),
                    esc(F.col("p_name")), F.lit("</a> 1 < 2 "))
    opens, ends = F.element_at(F.array(*[F.lit(x) for x, _ in LINK_SECTIONS]), (k % len(LINK_SECTIONS) + 1).cast("int")), F.element_at(
        F.array(*[F.lit(x) for _, x in LINK_SECTIONS]), (k % len(LINK_SECTIONS) + 1).cast("int"))
    rows = part.select((k / PARTS_PER_PAGE).cast("long").alias("page_no"), F.struct("p_partkey", F.concat(opens, link, ends).alias("h")).alias("r"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["h"]), "<!-- <nav><a href='c'>c</a> -->\n")
    return rows.groupBy("page_no").agg(F.concat(F.lit("<html><script>'<a href=s>s</a><article>'</script><body>"), body, F.lit("</body></html>")).alias("html"))


# Start and end tags around a link; the outermost section is the one that counts.
LINK_SECTIONS = (
    ("<p>", "</p>"),
    ('<nav title="</nav>">', "</nav>"),
    ("<article data-a='1 > 0' id=\"top\"><p>", "</p></article>"),
    ("<footer><nav id='in'>", "</nav></footer>"),
    ('<article title="<footer>"><footer></footer><nav><article>', "</article></nav></article>"),
)


EPOCH = CALENDAR_EPOCH
