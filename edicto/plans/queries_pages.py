"""Registered queries for pages, calendars, work lists, URLs, dates and
node lists (continuation of `queries`)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edicto.constants import RESULTS_TABLE_ID
from edicto.functions import html as H
from edicto.functions import text as TX
from edicto.functions import urls as U
from edicto.functions.charset import decode_page, encode_page
from edicto.functions.classify import classify_subject
from edicto.functions.dates import (
    code_to_date,
    current_month_only,
    date_to_code,
    day_code,
    month_code,
    month_range,
    parse_spanish_date,
    rolling_window,
    spanish_date_text,
)
from edicto.operators import html as HO
from edicto.operators.asof import as_of, versions
from edicto.operators import records as R
from edicto.operators.joins import sized
from edicto.operators.keywords import classify_words
from edicto.operators.load import distinct_keys, last_by_key, progress_by_day, work_key
from edicto.operators.worklist import pending, plan_units
from edicto.plans import oracle as O
from edicto.plans.fixtures import SHARED_CALENDAR_URL, fixture_courts, fixture_rows, read_table, spread, with_nodes
from edicto.plans.queries import FX, FX_COURTS, _records_sql_all, register
from edicto.plans.render import IDS_PER_MONTH_PAGE, PARTS_PER_PAGE, POSTBACK, ROWS_PER_PAGE, calendar_pages, day_pages, link_pages
from edicto.session import shared_path
from edicto.sources import manifest as M
from edicto.sources.io import append_ledger, read_captures, read_ledger, retry_candidates, write_captures

q = O.q
EPOCH_SQL = "DATE '2000-01-01'"

# --- DuckDB helpers for the HTML keys --------------------------------------------
# Patterns of the oracle's own, for the given pages (no '>' in attribute values).
SQL_A = r"(?is)<a\b[^>]*>.*?</a\s*>"
SQL_TAG = r"<[^>]*>"
SQL_CHILD = r"(?is)<[a-z][a-z0-9]*\b[^>]*>.*?</[a-z][a-z0-9]*\s*>"


def sql_attr(attr: str) -> str:
    return r"(?is)^<[a-z0-9]+\b[^>]*?\s" + attr + r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


# References that occur in the `pages` table, '&amp;' last.
PAGE_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def unescape_sql(e: str) -> str:
    for ent, ch in PAGE_REFERENCES:
        e = f"replace({e}, {q(ent)}, {q(ch)})"
    return e


def strip_noise_sql(e: str) -> str:
    return O.rx_replace(e, H.RX_NOISE, "")


def open_tag_sql(e: str) -> str:
    return f"regexp_extract({e}, '(?s)^(<[^>]*>)', 1)"


def tag_attr_sql(e: str, attr: str) -> str:
    t = open_tag_sql(e)
    p = sql_attr(attr)
    return (
        f"(CASE WHEN {O.rx_match(t, p)} THEN {unescape_sql(f'({O.rx(t, p, 1)} || {O.rx(t, p, 2)} || {O.rx(t, p, 3)})')} END)"
    )


def inner_sql(e: str) -> str:
    return f"regexp_extract({e}, {q(r'(?s)^<[^>]*>(.*)</[^>]*>\s*$')}, 1)"


def text_nodes_sql(frag: str) -> str:
    return (
        f"list_transform(list_filter(regexp_split_to_array({frag}, {q(SQL_TAG)}), lambda x: x <> ''), "
        f"lambda x: {unescape_sql('x')})"
    )


def link_text_sql(a: str) -> str:
    return f"({text_nodes_sql(O.rx_replace(inner_sql(a), SQL_CHILD, ''))})[1]"


def links_sql(html: str) -> str:
    return f"regexp_extract_all({strip_noise_sql(html)}, {q(SQL_A)}, 0)"


def unnest_pos(arr: str, pos: str = "pos", val: str = "a") -> str:
    return f"unnest(generate_series(0, len({arr}) - 1)) AS {pos}, unnest({arr}) AS {val}"


def postback_sql(code: str) -> str:
    pre, post = POSTBACK.split("{}")
    return f"{q(pre)} || {code} || {q(post)}"


# --- S1: page scan ------------------------------------------------------------------


SCAN_KIND_SQL = "CASE WHEN page_id % 3 = 0 THEN 'other' ELSE 'day' END"


@register("scan_pages", f"SELECT url, {SCAN_KIND_SQL} AS kind, CAST(page_id AS VARCHAR) AS fecha, sha256(html) AS html_sha256 FROM pages")
def scan_pages(spark, sf_dir):
    """Pages stored as captures (partitioned by kind) and scanned again."""
    path = shared_path(spark, "captures", uuid.uuid4().hex)
    none = F.lit(None).cast("string")
    write_captures(read_table(spark, sf_dir, "pages").select(
        "url", none.alias("court_url"), none.alias("calendar_url"), F.expr(SCAN_KIND_SQL).alias("kind"),
        F.col("page_id").cast("string").alias("fecha"), F.lit(None).cast("timestamp_ntz").alias("captured_at"),
        F.lit(200).alias("status"), "html"), path)
    return read_captures(spark, path).select("url", "kind", "fecha", F.sha2("html", 256).alias("html_sha256"))


# Pages as bytes: the encoding, the byte-order mark, and what stands in the
# place of the page's own declaration (None: as it is, and the mark wins).
BYTE_PAGES = (
    ("UTF-8", b"\xef\xbb\xbf", None), ("windows-1252", b"", 'charset="iso-8859-1"'), ("windows-1252", b"", "charset=windows-1252"),
    ("UTF-16LE", b"\xff\xfe", None), ("UTF-16BE", b"\xfe\xff", None), ("UTF-8", b"", 'name="none"'), ("windows-1252", b"", 'name="none"'),
    ("iso-8859-15", b"", "http-equiv=Content-Type content='text/html; charset=ISO-8859-15'"),
)
OWN_META = 'charset="utf-8"'


def _byte_page_sql() -> str:
    whens = " ".join(f"WHEN {i} THEN replace(html, {q(OWN_META)}, {q(meta)})" for i, (_, _, meta) in enumerate(BYTE_PAGES) if meta)
    text = f"(CASE page_id % {len(BYTE_PAGES)} {whens} ELSE html END)"
    return f"replace({text}, '</title>', ' €</title>')"


@register("scan_page_bytes", f"SELECT page_id, url, {_byte_page_sql()} AS html FROM pages")
def scan_page_bytes(spark, sf_dir):
    """Every page as bytes in one of several encodings, told by a
    byte-order mark, a declaration, or nothing, decoded to the text it was."""
    turn, data = F.col("page_id") % len(BYTE_PAGES), F.lit(None).cast("binary")
    for i, (charset, mark, _) in enumerate(BYTE_PAGES):
        own = F.concat(F.lit(mark), encode_page("text", charset))
        data = F.when(turn == i, F.coalesce(own, F.concat(F.lit(BYTE_PAGES[0][1]), F.encode("text", "UTF-8")))).otherwise(data)
    path = shared_path(spark, "bytes", uuid.uuid4().hex)
    (read_table(spark, sf_dir, "pages").select("page_id", "url", F.expr(_byte_page_sql()).alias("text"))
     .select("page_id", "url", data.alias("content")).write.parquet(path))
    return spark.read.parquet(path).select("page_id", "url", decode_page("content").alias("html"))


# --- H1-H3, H6, H7 on the pages table -------------------------------------------------


@register(
    "html_links",
    f"SELECT page_id, pos, {tag_attr_sql('a', 'href')} AS href, {link_text_sql('a')} AS text FROM "
    f"(SELECT page_id, {unnest_pos('arr')} FROM (SELECT page_id, {links_sql('html')} AS arr FROM pages) s) t",
)
def html_links(spark, sf_dir):
    df = HO.extract_links(read_table(spark, sf_dir, "pages"), "html", keep=("page_id",))
    return df.withColumn("pos", F.col("pos").cast("long"))


@register(
    "html_links_skip3",
    f"SELECT page_id, pos, {tag_attr_sql('a', 'href')} AS href, {link_text_sql('a')} AS text FROM "
    f"(SELECT page_id, {unnest_pos('arr')} FROM (SELECT page_id, list_filter({links_sql('html')}, "
    f"lambda a: coalesce(contains({tag_attr_sql('a', 'href')}, '/'), false)) AS arr FROM pages) s) t "
    "WHERE pos >= 3",
)
def html_links_skip3(spark, sf_dir):
    """H2: links whose href contains '/', first three dropped."""
    df = HO.extract_links(read_table(spark, sf_dir, "pages"), "html", href_contains="/", skip=3,
                          keep=("page_id",))
    return df.withColumn("pos", F.col("pos").cast("long"))


def _sections_sql() -> str:
    alt = "nav|article|footer"
    inside = O.rx("chunk", r"(?is)^(.*?)</(?:" + alt + r")\s*>")
    frag_links = "regexp_extract_all(coalesce(frag, ''), " + q(SQL_A) + ", 0)"
    return (
        f"WITH b AS (SELECT page_id, {strip_noise_sql('html')} AS body FROM pages),\n"
        f"c AS (SELECT page_id, regexp_split_to_array(body, {q('(?i)<(?:' + alt + r')\b')}) AS chunks, "
        f"regexp_extract_all(body, {q('(?i)<(' + alt + r')\b')}, 1) AS tags FROM b),\n"
        f"d AS (SELECT page_id, tags, {unnest_pos('chunks', 'chunk_no', 'chunk')} FROM c),\n"
        f"e AS (SELECT page_id, chunk_no, chunk, CASE WHEN chunk_no = 0 THEN NULL ELSE lower(tags[chunk_no]) END AS section FROM d),\n"
        f"f AS (SELECT page_id, chunk_no, section, CASE WHEN section IS NOT NULL THEN {inside} END AS inside, chunk FROM e),\n"
        f"g AS (SELECT page_id, chunk_no, 0 AS part, section, inside AS frag FROM f UNION ALL "
        f"SELECT page_id, chunk_no, 1 AS part, NULL AS section, CASE WHEN section IS NOT NULL "
        f"THEN substring(chunk, length(inside) + 1) ELSE chunk END AS frag FROM f),\n"
        f"h AS (SELECT page_id, chunk_no, part, section, {unnest_pos(frag_links, 'i', 'a')} FROM g)\n"
        f"SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY chunk_no, part, i) - 1 AS pos, section, "
        f"{tag_attr_sql('a', 'href')} AS href, {link_text_sql('a')} AS text FROM h"
    )


@register("html_sections", _sections_sql())
def html_sections(spark, sf_dir):
    """H3: links with their enclosing section (nav / article / footer)."""
    df = HO.section_links(read_table(spark, sf_dir, "pages"), "html", keep=("page_id",))
    pos = F.row_number().over(Window.partitionBy("page_id").orderBy("order_key")) - 1  # links of one page
    return df.select("page_id", pos.cast("long").alias("pos"), "section", "href", "text")


@register(
    "html_links_known",
    f"SELECT p_partkey // {PARTS_PER_PAGE} AS page_no, row_number() OVER (PARTITION BY p_partkey // {PARTS_PER_PAGE} ORDER BY p_partkey) - 1 AS pos, "
    "CASE p_partkey % 5 WHEN 1 THEN 'nav' WHEN 2 THEN 'article' WHEN 3 THEN 'footer' WHEN 4 THEN 'article' END AS section, "
    "CASE p_partkey % 5 WHEN 2 THEN 'top' WHEN 3 THEN 'in' END AS section_id, "
    "'/p?k=' || CAST(p_partkey AS VARCHAR) || '&b=1' AS href, p_name AS text FROM part",
)
def html_links_known(spark, sf_dir):
    """H1 + H3 + H7 on pages made of known links: the oracle is the raw data."""
    df = HO.section_links(link_pages(spark, sf_dir), "html", keep=("page_no",))
    pos = F.row_number().over(Window.partitionBy("page_no").orderBy("order_key")) - 1  # links of one page
    return df.select("page_no", pos.cast("long").alias("pos"), "section", "section_id", "href", "text")


ARTICLE_RX = r"(?is)<article\b[^>]*>(.*?)</article\s*>"


@register(
    "html_text_nodes",
    f"SELECT page_id, CAST(len(nodes) AS BIGINT) AS n_nodes, array_to_string(nodes, '|') AS text FROM "
    f"(SELECT page_id, {text_nodes_sql(f"array_to_string(regexp_extract_all({strip_noise_sql('html')}, {q(ARTICLE_RX)}, 1), '<br>')")} AS nodes FROM pages) t",
)
def html_text_nodes(spark, sf_dir):
    """H6: text nodes of all of each page's articles."""
    art = F.array_join(F.regexp_extract_all(H.strip_noise("html"), F.lit(ARTICLE_RX), F.lit(1)), "<br>")
    nodes = H.text_nodes(art)
    return read_table(spark, sf_dir, "pages").select(
        "page_id", F.size(nodes).cast("long").alias("n_nodes"), F.array_join(nodes, "|").alias("text")
    )


@register(
    "html_attr",
    "SELECT page_id, "
    f"{tag_attr_sql(O.rx('html', r'(?is)(<html\b[^>]*>)'), 'lang')} AS lang, "
    f"{tag_attr_sql(O.rx('html', r'(?is)(<meta\b[^>]*>)'), 'charset')} AS charset FROM pages",
)
def html_attr(spark, sf_dir):
    """H7: attributes by element (html/@lang, meta/@charset)."""
    return read_table(spark, sf_dir, "pages").select(
        "page_id", H.html_attr("html", "html", "lang").alias("lang"),
        H.html_attr("html", "meta", "charset").alias("charset"),
    )


# --- U1-U3 ----------------------------------------------------------------------------


def _url_join_sql(b: str, h: str) -> str:
    bd = O.rx(b, U.RX_BASE_DIR)
    dir_ = f"(CASE WHEN suffix({bd}, '/') THEN {bd} ELSE {bd} || '/' END)"
    return (
        f"(CASE WHEN {h} IS NULL THEN NULL "
        f"WHEN {h} = '' THEN {b} "
        f"WHEN {O.rx_match(h, U.RX_SCHEME)} THEN {h} "
        f"WHEN starts_with({h}, '//') THEN {O.rx(b, r'^([A-Za-z][A-Za-z0-9+.\-]*):')} || ':' || {h} "
        f"WHEN starts_with({h}, '/') THEN {O.rx(b, U.RX_ORIGIN)} || {h} "
        f"WHEN starts_with({h}, '?') THEN {O.rx(b, U.RX_BASE_NO_QUERY)} || {h} "
        f"WHEN starts_with({h}, '#') THEN {O.rx(b, U.RX_BASE_NO_FRAGMENT)} || {h} "
        f"ELSE {dir_} || {h} END)"
    )


@register(
    "url_join",
    f"SELECT page_id, pos, href, {_url_join_sql('url', 'href')} AS abs_url FROM "
    f"(SELECT page_id, url, pos, {tag_attr_sql('a', 'href')} AS href FROM "
    f"(SELECT page_id, url, {unnest_pos('arr')} FROM (SELECT page_id, url, {links_sql('html')} AS arr FROM pages) s) t) u",
)
def url_join_q(spark, sf_dir):
    """Every link made absolute against its page URL."""
    df = HO.extract_links(read_table(spark, sf_dir, "pages"), "html", keep=("page_id", "url"))
    return df.select("page_id", F.col("pos").cast("long").alias("pos"), "href",
                     U.url_join("url", "href").alias("abs_url"))


def _param_sql(name: str) -> str:
    qs = O.rx("url", r"^[^?#]*\?([^#]*)")
    v = O.rx(qs, r"(?:&|^)" + name + r"=([^&]*)")
    return f"nullif(url_decode(replace({v}, '+', ' ')), '')"


@register(
    "url_query_param",
    f"SELECT page_id, url, {_param_sql('utm_source')} AS utm_source, {_param_sql('page')} AS page, "
    f"{_param_sql('ref')} AS ref FROM pages",
)
def url_query_param(spark, sf_dir):
    """Decoded query parameters of each page URL."""
    return read_table(spark, sf_dir, "pages").select(
        "page_id", "url",
        U.query_param("url", "utm_source").alias("utm_source"),
        U.query_param("url", "page").alias("page"),
        U.query_param("url", "ref").alias("ref"),
    )


@register(
    "last_by_key",
    "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
)
def last_by_key_q(spark, sf_dir):
    """Per key the last entry wins (dict-assignment semantics)."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return last_by_key(o, ["o_custkey"], "o_orderkey")


# --- day pages: H4-H6 + E14 --------------------------------------------------------------


def _page_rows(spark, sf_dir) -> DataFrame:
    rows = HO.table_rows(day_pages(spark, sf_dir, per="month"), "html", RESULTS_TABLE_ID, True,
                         keep=("url", "court_url"))
    rows = rows.select("url", "court_url", "row_pos", HO.row_cells("row_html", "valign").alias("cells"), HO.row_cells("row_html", None).alias("all_cells"))
    rows = rows.withColumn("marks", H.text_nodes(F.get("all_cells", F.lit(1))))
    cells, all_cells, marks = F.col("cells"), F.col("all_cells"), F.col("marks")
    return rows.select(
        "url", "court_url", F.get(marks, 1).alias("fecha"), F.col("row_pos").cast("long").alias("row_pos"),
        F.get(marks, 0).cast("long").alias("row_id"),
        F.size(all_cells).cast("long").alias("n_cells"),
        F.size(cells).cast("long").alias("n_valign"),
        HO.cell_nodes(cells, 0).alias("numero_nodes"),
        HO.cell_nodes(cells, 1).alias("n2"),
        HO.cell_nodes(cells, 2).alias("n3"),
    )


def _page_url_sql() -> str:
    return (
        f"c.court_url || '&Fecha=' || f.fecha || '&Pagina=' || CAST(f.row_id // {ROWS_PER_PAGE} AS VARCHAR)"
    )


@register(
    "html_rows",
    FX_COURTS
    + f"SELECT c.court_url || '&Fecha=' || substring(f.fecha, 1, 7) || '/01&Pagina=' || CAST(f.row_id // {IDS_PER_MONTH_PAGE} AS VARCHAR) AS url, "
    f"CAST(row_number() OVER (PARTITION BY f.court_no, substring(f.fecha, 1, 7), f.row_id // {IDS_PER_MONTH_PAGE} ORDER BY f.row_id) - 1 AS BIGINT) AS row_pos, "
    "f.row_id, CAST(4 AS BIGINT) AS n_cells, CAST(3 AS BIGINT) AS n_valign, coalesce(f.numero, '') AS numero, "
    "concat_ws('|', f.td2_first, f.td2_rest) AS n2, coalesce(f.td3_first, '') AS n3 "
    "FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no",
)
def html_rows(spark, sf_dir):
    """H4 - H6: the rows of every captured page with many rows, nested tables,
    missing end tags and character references, against the raw texts."""
    return _page_rows(spark, sf_dir).select(
        "url", "row_pos", "row_id", "n_cells", "n_valign", F.array_join("numero_nodes", "|").alias("numero"),
        F.array_join("n2", "|").alias("n2"), F.array_join("n3", "|").alias("n3"))


@register("records_from_pages", _records_sql_all())
def records_from_pages(spark, sf_dir):
    """S1 + H4-H6 + E14: captured pages -> rows -> records."""
    rows = spread(_page_rows(spark, sf_dir)).select("court_url", "fecha", "row_id", "numero_nodes", "n2", "n3")
    return R.extract_records(rows, fixture_courts(spark), keep=("row_id",), on="court_url")


# --- calendar pages: H8-H10, D1, D4, J1, J3, W2 ----------------------------------------------

_MONTHS_CTE = (
    "m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)"
)
_DAYS_CTE = (
    "d AS (SELECT month, CAST(unnest(generate_series(CAST(month AS TIMESTAMP), "
    "CAST(last_day(month) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM m)"
)


def _code_sql(d: str) -> str:
    return f"CAST(date_diff('day', {EPOCH_SQL}, {d}) AS VARCHAR)"


def _cal_url_sql() -> str:
    return f"{q(SHARED_CALENDAR_URL + '&Mes=')} || strftime(month, '%Y-%m')"


def _days_select_sql() -> str:
    title = f"CAST(day(day) AS VARCHAR) || ' de ' || substring({O.month_name_sql('month(day)')}, 4)"
    return (
        f"SELECT {_cal_url_sql()} AS url, {title} AS title, {postback_sql(_code_sql('day'))} AS href, "
        f"{_code_sql('day')} AS day_arg, strftime(day, '%Y/%m/%d') AS fecha, day AS code_date FROM d"
    )


@register("calendar_days", f"WITH {_MONTHS_CTE}, {_DAYS_CTE} " + _days_select_sql())
def calendar_days_q(spark, sf_dir):
    """H8 + D1 + D4: day links of every calendar page."""
    return HO.calendar_days(calendar_pages(spark, sf_dir), "html", keep=("url",))


@register(
    "calendar_nav",
    f"WITH {_MONTHS_CTE} SELECT {_cal_url_sql()} AS url, CAST(year(month) AS VARCHAR) AS year, "
    f"'V' || {_code_sql('month - INTERVAL 1 MONTH')} AS prev_code, "
    f"'V' || {_code_sql('month + INTERVAL 1 MONTH')} AS next_code FROM m",
)
def calendar_nav_q(spark, sf_dir):
    """H9 + H10: header year and previous/next month codes."""
    prev, nxt = HO.calendar_nav("html")
    return calendar_pages(spark, sf_dir).select(
        "url", HO.calendar_year("html").alias("year"), prev.alias("prev_code"), nxt.alias("next_code")
    )


def _units(spark, sf_dir) -> DataFrame:
    days = HO.calendar_days(calendar_pages(spark, sf_dir), "html", keep=("calendar_url",))
    return plan_units(days, fixture_courts(spark))


_UNITS_CTE = (
    f"u AS (SELECT c.juz_id || c.entidad_code || {_code_sql('d.day')} || right(c.juzgado, 10) AS work_key, "
    f"c.court_url, strftime(d.day, '%Y/%m/%d') AS fecha, {_code_sql('d.day')} AS day_arg, "
    f"{O.classify_subject_sql('c.juzgado')} AS materia FROM d JOIN fixture_courts c ON c.calendar_url = {q(SHARED_CALENDAR_URL)})"
)


@register(
    "plan_units",
    f"WITH {_MONTHS_CTE}, {_DAYS_CTE}, {O.COURTS_CTE}, {_UNITS_CTE} SELECT * FROM u",
)
def plan_units_q(spark, sf_dir):
    """J1 + W2: calendar days x courts governed by that calendar."""
    return _units(spark, sf_dir).select("work_key", "court_url", "fecha", "day_arg", "materia")


def _fx_work_keys(spark, sf_dir) -> DataFrame:
    courts = sized(fixture_courts(spark).select("court_no", "juz_id", "entidad_code", "juzgado"))
    fx = fixture_rows(spark, sf_dir).join(courts, "court_no")
    day = date_to_code(F.to_date("fecha", "yyyy/MM/dd"))
    return fx.select("row_id", "fecha", work_key("juz_id", "entidad_code", day, "juzgado").alias("work_key"))


_FX_KEY_SQL = (
    "c.juz_id || c.entidad_code || " + _code_sql("strptime(f.fecha, '%Y/%m/%d')") + " || right(c.juzgado, 10)"
)


@register(
    "pending_units",
    f"WITH {_MONTHS_CTE}, {_DAYS_CTE}, {O.FX_CTE}, {O.COURTS_CTE}, {_UNITS_CTE}, "
    f"seen AS (SELECT DISTINCT {_FX_KEY_SQL} AS work_key FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no) "
    "SELECT * FROM u WHERE work_key NOT IN (SELECT work_key FROM seen)",
)
def pending_units_q(spark, sf_dir):
    """Planned units whose day page was not captured yet (ledger =
    work keys of the captured rows)."""
    units = _units(spark, sf_dir).select("work_key", "court_url", "fecha", "day_arg", "materia")
    return pending(units, _fx_work_keys(spark, sf_dir))


@register(
    "pending_units_merged",
    f"WITH {_MONTHS_CTE}, {_DAYS_CTE}, {O.FX_CTE}, {O.COURTS_CTE}, {_UNITS_CTE}, "
    f"seen AS (SELECT DISTINCT {_FX_KEY_SQL} AS work_key FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no) "
    "SELECT * FROM u WHERE work_key NOT IN (SELECT work_key FROM seen)",
)
def pending_units_merged_q(spark, sf_dir):
    """J3 against a ledger in levels (S2, S3): each year's work keys arrive as
    a batch of their own, and full levels are merged."""
    base = shared_path(spark, "ledger", uuid.uuid4().hex)
    path, manifest = f"{base}/ledger", f"{base}/manifest"
    keys = sized(_fx_work_keys(spark, sf_dir).select("work_key", F.substring("fecha", 1, 4).alias("year")).distinct(), "ledger-keys")
    schema = keys.select("work_key").schema
    for (year,) in sorted(keys.select("year").distinct().collect()):
        commit = M.begin(spark, manifest, [path])
        M.append(keys.filter(F.col("year") == year).select("work_key"), path, commit)
        M.publish(spark, manifest, commit, [path], year)
        M.merge(spark, manifest, path, schema, ["work_key"], fan=3)
    units = _units(spark, sf_dir).select("work_key", "court_url", "fecha", "day_arg", "materia")
    return pending(units, M.read(spark, manifest, path, schema))


@register(
    "work_key",
    FX_COURTS + f"SELECT f.row_id, {_FX_KEY_SQL} AS work_key FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no",
)
def work_key_q(spark, sf_dir):
    """Work key of each captured row's (court, day)."""
    return _fx_work_keys(spark, sf_dir).select("row_id", "work_key")


@register(
    "distinct_keys",
    FX_COURTS + f"SELECT DISTINCT {_FX_KEY_SQL} AS work_key FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no",
)
def distinct_keys_q(spark, sf_dir):
    """Each work key once."""
    return distinct_keys(_fx_work_keys(spark, sf_dir), "work_key")


@register(
    "ledger_scan",
    FX_COURTS + f"SELECT DISTINCT {_FX_KEY_SQL} AS work_key FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no",
)
def ledger_scan_q(spark, sf_dir):
    """S3 then S2: append the distinct work keys to a ledger in the shared
    folder, read the ledger back."""
    import uuid

    path = shared_path(spark, "ledger", uuid.uuid4().hex)
    append_ledger(distinct_keys(_fx_work_keys(spark, sf_dir), "work_key"), path)
    return read_ledger(spark, path)


@register(
    "rows_with_court",
    FX_COURTS + "SELECT f.row_id, f.court_no, c.juzgado, c.court_url, c.entidad_code "
    "FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no",
)
def rows_with_court_q(spark, sf_dir):
    """Court attributes onto every row (broadcast of the dimension)."""
    courts = sized(fixture_courts(spark).select("court_no", "juzgado", "court_url", "entidad_code"))
    return fixture_rows(spark, sf_dir).join(courts, "court_no").select(
        "row_id", "court_no", "juzgado", "court_url", "entidad_code"
    )


# The courts' listing is captured three times; the second time each court has another name.
RENAMED, RENAMED_AGAIN = "1997-06-15", "1999-02-20"


@register(
    "rows_with_court_asof",
    FX_COURTS + "SELECT f.row_id, f.court_no, CASE WHEN strptime(f.fecha, '%Y/%m/%d') < TIMESTAMP '1996-01-10' THEN NULL "
    f"WHEN strptime(f.fecha, '%Y/%m/%d') >= TIMESTAMP '{RENAMED}' AND strptime(f.fecha, '%Y/%m/%d') < TIMESTAMP '{RENAMED_AGAIN}' "
    "THEN c.juzgado || ' Bis' ELSE c.juzgado END AS juzgado FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no",
)
def rows_with_court_asof_q(spark, sf_dir):
    """Each row with its court's name as of the day it was captured: none
    before the first capture of the listing, another between two captures."""
    courts = fixture_courts(spark).select("court_no", "juzgado")
    seen = lambda when, name: courts.select("court_no", name.alias("juzgado"), F.lit(when).cast("timestamp_ntz").alias("seen_at"))
    old = F.col("juzgado")
    captures = seen("1996-01-10", old).unionByName(seen("1996-08-01", old)).unionByName(
        seen(RENAMED, F.concat(old, F.lit(" Bis")))).unionByName(seen(RENAMED_AGAIN, old))
    rows = fixture_rows(spark, sf_dir).select("row_id", "court_no", F.to_timestamp("fecha", "yyyy/MM/dd").cast("timestamp_ntz").alias("at"))
    return as_of(rows, versions(captures, "court_no", "seen_at", ["juzgado"]), "court_no", "at", ["juzgado"]).select("row_id", "court_no", "juzgado")


def _progress_sql() -> str:
    from edicto.plans.queries import _records_oracle

    ctes, out = _records_oracle("fixture_rows", ("row_id",))
    return O.with_ctes(*ctes) + f"SELECT fecha, count(*) AS n_rows FROM {out} WHERE reject_reason IS NULL GROUP BY fecha"


@register("progress_by_day", _progress_sql())
def progress_by_day_q(spark, sf_dir):
    """Valid records per day."""
    recs = R.valid(R.extract_records(with_nodes(fixture_rows(spark, sf_dir)), fixture_courts(spark), keep=("row_id",)))
    return progress_by_day(recs, "fecha")


# --- D1, D4-D7 -------------------------------------------------------------------------------


@register(
    "spanish_date",
    "SELECT o_orderkey, CAST(day(o_orderdate) AS VARCHAR) || ' ' || "
    f"{O.month_name_sql('month(o_orderdate)')} || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS raw, "
    "strftime(o_orderdate, '%Y/%m/%d') AS fecha FROM orders",
)
def spanish_date_q(spark, sf_dir):
    """Order dates rendered as calendar titles and parsed back."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", spanish_date_text("o_orderdate").alias("raw"))
    return o.select("o_orderkey", "raw", parse_spanish_date("raw").alias("fecha"))


@register(
    "calendar_code",
    f"SELECT o_orderkey, {_code_sql('o_orderdate')} AS day_arg, "
    f"'V' || {_code_sql('date_trunc(' + q('month') + ', o_orderdate)')} AS month_arg, "
    "CAST(o_orderdate AS DATE) AS code_date, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_date FROM orders",
)
def calendar_code_q(spark, sf_dir):
    """Day and month codes inside calendar links, decoded to dates."""
    from edicto.plans.render import _postback

    o = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    hrefs = o.select(
        "o_orderkey",
        _postback(date_to_code(d)).alias("h_day"),
        _postback(F.concat(F.lit("V"), date_to_code(F.trunc(d, "MM")))).alias("h_month"),
    )
    return hrefs.select(
        "o_orderkey",
        day_code("h_day").alias("day_arg"),
        month_code("h_month").alias("month_arg"),
        code_to_date(day_code("h_day")).alias("code_date"),
        code_to_date(month_code("h_month")).alias("month_date"),
    )


@register(
    "month_range",
    "SELECT o_custkey, CAST(unnest(generate_series(date_trunc('month', mn), date_trunc('month', mx) - INTERVAL 1 MONTH, "
    "INTERVAL 1 MONTH)) AS DATE) AS month FROM (SELECT o_custkey, min(o_orderdate) AS mn, max(o_orderdate) AS mx "
    "FROM orders GROUP BY o_custkey) t",
)
def month_range_q(spark, sf_dir):
    """Months from each customer's first order month (included) to the
    last order month (excluded)."""
    g = read_table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("mn"), F.max("o_orderdate").alias("mx")
    )
    return g.select("o_custkey", F.explode(month_range("mn", "mx")).alias("month"))


AS_OF = "1998-08-15"


@register(
    "rolling_window",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1998-07-01' AND o_orderdate < DATE '1998-09-01'",
)
def rolling_window_q(spark, sf_dir):
    """Orders of the previous and the current month of AS_OF."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return rolling_window(o, "o_orderdate", AS_OF)


@register(
    "current_month",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1998-08-01' AND o_orderdate < DATE '1998-09-01'",
)
def current_month_q(spark, sf_dir):
    """Orders of AS_OF's month only."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return current_month_only(o, "o_orderdate", AS_OF)


# --- S7 -----------------------------------------------------------------------------------------


@register(
    "retry_candidates",
    "SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS work_key, count(*) AS attempts "
    "FROM events GROUP BY 1 HAVING count(*) < 2 AND max(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) = 0",
)
def retry_candidates_q(spark, sf_dir):
    """(user, day) units whose only attempt failed."""
    ev = read_table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("work_key"),
        F.coalesce(F.col("event_type") != F.lit("error"), F.lit(False)).alias("ok"),
    )
    return retry_candidates(ev)


# --- A1-A8, L1 on documents -------------------------------------------------------------------


def _fxn(spark, sf_dir) -> DataFrame:
    return with_nodes(fixture_rows(spark, sf_dir))


@register(
    "join_nodes",
    "SELECT conv_id, string_agg(replace(text, chr(10), ' '), ' ' ORDER BY turn, role, text) AS joined FROM conversations GROUP BY conv_id",
)
def join_nodes_q(spark, sf_dir):
    """A1: the texts of each conversation, collected in order and joined."""
    c = read_table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("nodes"))
    return c.select("conv_id", F.translate(TX.join_nodes("nodes.text"), "\n", " ").alias("joined"))


@register(
    "array_concat",
    FX + "SELECT row_id, CAST((td2_first IS NOT NULL)::INT + (td2_rest IS NOT NULL)::INT + (td3_first IS NOT NULL)::INT AS BIGINT) "
    "AS n_nodes, concat_ws(' ', td2_first, td2_rest, td3_first) AS joined FROM fixture_rows",
)
def array_concat_q(spark, sf_dir):
    p = TX.concat_nodes("n2", "n3")
    return _fxn(spark, sf_dir).select("row_id", F.size(p).cast("long").alias("n_nodes"), TX.join_nodes(p).alias("joined"))


@register(
    "first_last_node",
    FX + "SELECT row_id, coalesce(td2_first, td2_rest) AS first_node, coalesce(td2_rest, td2_first) AS last_node FROM fixture_rows",
)
def first_last_node_q(spark, sf_dir):
    return _fxn(spark, sf_dir).select(
        "row_id", TX.first_node("n2").alias("first_node"), TX.last_node("n2").alias("last_node")
    )


@register(
    "map_compose",
    FX + "SELECT row_id, concat_ws(' ', "
    f"CASE WHEN td2_first IS NOT NULL THEN {O.clean_sql('td2_first')} END, "
    f"CASE WHEN td2_rest IS NOT NULL THEN {O.clean_sql('td2_rest')} END) AS cleaned FROM fixture_rows",
)
def map_compose_q(spark, sf_dir):
    """A4: MapCompose(clean) over the cell-2 nodes, then joined."""
    m = TX.map_compose("n2", lambda x: TX.clean_staged(x, null_as_empty=False))
    return _fxn(spark, sf_dir).select("row_id", TX.join_nodes(m).alias("cleaned"))


@register(
    "take_first",
    FX + "SELECT row_id, CASE WHEN numero IS NOT NULL AND numero <> '' THEN numero "
    "WHEN td3_first IS NOT NULL AND td3_first <> '' THEN td3_first "
    "WHEN td2_rest IS NOT NULL AND td2_rest <> '' THEN td2_rest END AS first_value FROM fixture_rows",
)
def take_first_q(spark, sf_dir):
    """A5: first non-null, non-empty value."""
    return fixture_rows(spark, sf_dir).select(
        "row_id", TX.take_first(F.array("numero", "td3_first", "td2_rest")).alias("first_value")
    )


@register(
    "split_first_last",
    FX + "SELECT row_id, split_part(td2_first, '.-', 1) AS before_dash, string_split(td2_first, '.-')[-1] AS after_dash, "
    "string_split(td2_first, ' VS')[-1] AS after_vs FROM fixture_rows",
)
def split_first_last_q(spark, sf_dir):
    """Split on a literal, first / last piece."""
    return fixture_rows(spark, sf_dir).select(
        "row_id",
        TX.before_first("td2_first", ".-").alias("before_dash"),
        TX.after_last("td2_first", ".-").alias("after_dash"),
        TX.after_last("td2_first", " VS").alias("after_vs"),
    )


@register(
    "split_two",
    FX + "SELECT row_id, len(string_split(td2_first, 'EN CONTRA DE')) = 2 AS in_two FROM fixture_rows",
)
def split_two_q(spark, sf_dir):
    """Text splits in exactly two on a literal."""
    return fixture_rows(spark, sf_dir).select("row_id", TX.splits_in_two("td2_first", "EN CONTRA DE").alias("in_two"))


@register(
    "classify_keywords",
    f"SELECT doc_id, {O.classify_subject_sql('text')} AS materia FROM documents",
)
def classify_keywords_q(spark, sf_dir):
    """L1 + L4 over the documents table."""
    return spread(read_table(spark, sf_dir, "documents")).select("doc_id", classify_subject("text").alias("materia"))


_WORDS_SQL = (
    "SELECT w AS word, min(conv_id) AS priority FROM (SELECT conv_id, unnest(regexp_extract_all(lower(text), '[a-z]{7,}')) AS w "
    "FROM conversations) GROUP BY w"
)


@register(
    "classify_words",
    f"SELECT doc_id, (SELECT min(priority) FROM ({_WORDS_SQL}) WHERE contains(lower(text), word)) AS conv_id FROM documents",
)
def classify_words_q(spark, sf_dir):
    """L1 + L4 with thousands of words: the first conversation any of whose
    longer words is a substring of the document."""
    said = read_table(spark, sf_dir, "conversations")
    words = said.select("conv_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{7,}"), F.lit(0))).alias("word"))
    words = words.groupBy("word").agg(F.min("conv_id").alias("priority")).withColumn("label", F.col("priority"))
    docs = spread(read_table(spark, sf_dir, "documents")).select("doc_id", F.lower("text").alias("t"))
    return classify_words(docs, "t", words, "conv_id").drop("t")


@register(
    "html_hidden_inputs",
    FX_COURTS
    + f"SELECT DISTINCT {_page_url_sql()} AS url, 'v' || s AS viewstate, 'e' || s AS eventvalidation FROM (SELECT *, "
    f"replace(fecha, '/', '') || '-' || CAST(court_no AS VARCHAR) || '-' || CAST(row_id // {ROWS_PER_PAGE} AS VARCHAR) || '==' AS s "
    "FROM fixture_rows) f JOIN fixture_courts c ON f.court_no = c.court_no",
)
def html_hidden_inputs(spark, sf_dir):
    """H7 by element id: the form state fields (`input#__VIEWSTATE`,
    `input#__EVENTVALIDATION`) of every captured day page."""
    return day_pages(spark, sf_dir).select(
        "url",
        H.html_attr("html", "input", "value", id_="__VIEWSTATE").alias("viewstate"),
        H.html_attr("html", "input", "value", id_="__EVENTVALIDATION").alias("eventvalidation"),
    )


def _courts_sql() -> str:
    from edicto.plans.render import LISTING_BASE, LISTING_SUBJECTS

    subj = "CASE s_suppkey % {} {} END".format(
        len(LISTING_SUBJECTS), " ".join(f"WHEN {i} THEN {q(w)}" for i, w in enumerate(LISTING_SUBJECTS))
    )
    name = f"s_name || ' ' || ({subj})"
    juzgado = f"CASE WHEN s_suppkey % 7 = 0 THEN {name} || ' Nuevo' ELSE {name} END"
    url = (
        f"{q(LISTING_BASE + 'LiAcuerdosBusqueda.aspx?MpioId=')} || CAST(n_nationkey AS VARCHAR) || "
        "'&JuzId=' || CAST(s_suppkey AS VARCHAR) || '&JuzDescrip=X'"
    )
    return (
        f"SELECT {url} AS court_url, {juzgado} AS juzgado, lower(replace(n_name, ' ', '')) AS entidad_code, "
        f"CAST(s_suppkey AS VARCHAR) AS juz_id, {O.classify_subject_sql(juzgado)} AS materia "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey"
    )


@register("build_courts", _courts_sql())
def build_courts_q(spark, sf_dir):
    """H1 + H2 + H3 + U1-U3 + L1: the court dimension from listing pages
    (navigation links skipped, municipality from the enclosing table id,
    absolute URL, JuzId parameter, subject from the name, later link wins)."""
    courts = HO.build_courts(_two_captures(spark, sf_dir))
    return courts.select("court_url", "juzgado", "entidad_code", "juz_id", "materia")


def _two_captures(spark, sf_dir) -> DataFrame:
    """Every listing captured twice; in the earlier capture all courts have another name."""
    from edicto.plans.render import listing_pages

    pages = listing_pages(spark, sf_dir)
    old = pages.withColumn("html", F.replace("html", F.lit("</a></td>"), F.lit(" Antiguo</a></td>")))
    return pages.withColumn("captured_at", F.lit("2024-02-01")).unionByName(old.withColumn("captured_at", F.lit("2024-01-01")))


@register(
    "plan_from_listing",
    f"WITH {_MONTHS_CTE}, {_DAYS_CTE}, c AS ({_courts_sql()}) "
    f"SELECT c.court_url, {_code_sql('d.day')} AS day_arg, c.juz_id || c.entidad_code || {_code_sql('d.day')} || right(c.juzgado, 10) "
    "AS work_key FROM c CROSS JOIN d",
)
def plan_from_listing(spark, sf_dir):
    """U3 + J1: from captured listings and calendars to work units."""
    courts = HO.build_courts(_two_captures(spark, sf_dir), calendar_url=SHARED_CALENDAR_URL)
    days = HO.calendar_days(calendar_pages(spark, sf_dir), "html", keep=("calendar_url",))
    return plan_units(days, courts).select("court_url", "day_arg", "work_key")
