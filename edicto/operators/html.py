"""HTML-to-rows operators (H1-H10) over a table of stored pages.

Each operator is DataFrame in, DataFrame out, built from `regexp_extract_all`
+ `posexplode`, so a page is processed inside one task with no shuffle and
the output position (`pos`) preserves document order.  Day pages, the bulk of
all pages, are read by an Arrow function (`functions.day_page`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.constants import CALENDAR_TABLE_ID, RESULTS_TABLE_ID
from edicto.functions import html as H
from edicto.functions.day_page import CELLS, day_rows
from edicto.functions.dates import code_to_date, day_code, month_code, parse_spanish_date
from edicto.functions.text import let


def links(html: str | Column, css_class: str | None = None,
          href_contains: str | None = None) -> Column:
    """Array of `<a>` elements (comments/scripts removed), optionally only
    those whose class equals `css_class` and whose href contains a token;
    filtering happens before numbering, as in `(//a[...])[n]`."""
    arr = H.anchors(H.strip_noise(html))
    if css_class is None and href_contains is None:
        return arr

    def keep(a: Column) -> Column:
        cond = F.lit(True)
        if css_class is not None:
            cond = cond & F.coalesce(H.tag_attr(a, "class") == F.lit(css_class), F.lit(False))
        if href_contains is not None:
            cond = cond & F.coalesce(H.tag_attr(a, "href").contains(href_contains), F.lit(False))
        return cond

    return F.filter(arr, keep)


def extract_links(df: DataFrame, html: str = "html", css_class: str | None = None,
                  href_contains: str | None = None, skip: int = 0,
                  keep: Sequence[str] = ()) -> DataFrame:
    """H1 + H2: one row per link: `pos` (0-based among the selected links),
    `href`, `text`; the first `skip` selected links are dropped."""
    out = df.select(*keep, F.posexplode(links(html, css_class, href_contains)).alias("pos", "a"))
    if skip:
        out = out.filter(F.col("pos") >= skip)
    return out.select(
        *keep, "pos", H.tag_attr("a", "href").alias("href"), H.link_text("a").alias("text")
    )


def section_links(df: DataFrame, html: str = "html",
                  tags: Sequence[str] = ("nav", "article", "footer"),
                  keep: Sequence[str] = ()) -> DataFrame:
    """H3: links with the section element around them: the tag of the
    outermost open section, and the id of the outermost open section that has
    one.  Sections may nest to any depth.  The page is cut at section tags; a
    fold in blocks carries the depth, and the section and id in force, along
    the pieces, in time linear in the page."""
    alt = "|".join(tags)
    none = F.lit(None).cast("string")
    state = "struct<depth:int,at:int,section:string,id:string>"
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), none.alias("section"), none.alias("id")).cast(state)

    def step(a: Column, p: Column) -> Column:
        x, opened = p["x"], p["d"] == 1
        facts = F.struct(F.greatest(a["depth"] + p["d"], F.lit(0)).alias("depth"), F.when(opened, H.tag_attr(x, "id")).alias("own"))

        def at_depth(f: Column) -> Column:
            depth, own = f["depth"], f["own"]
            section = F.when(opened & (a["depth"] == 0), F.lower(F.regexp_extract(x, rf"(?i)^<({alt}){H.NAME_END}", 1))).when(
                depth == 0, none).otherwise(a["section"])
            takes = a["id"].isNull() & own.isNotNull()
            id_ = F.when(takes, own).when(depth < a["at"], none).otherwise(a["id"])
            at = F.when(takes, depth).when(depth < a["at"], 0).otherwise(a["at"])
            return F.struct(depth.alias("depth"), at.alias("at"), section.alias("section"), id_.alias("id")).cast(state)

        return let(facts, at_depth)

    def emit(s: Column, p: Column) -> Column:
        return F.struct(p["x"].alias("frag"), s["section"].alias("section"), s["id"].alias("section_id"))

    found = H.fold_blocks(H.with_delta(H.pieces(H.strip_noise(html), alt)), start, step, emit)
    out = df.select(*keep, F.posexplode(found).alias("piece", "p"))
    out = out.select(
        *keep, "piece", "p.section", "p.section_id",
        F.posexplode(H.anchors("p.frag")).alias("i", "a"),
    )
    return out.select(
        *keep,
        F.struct("piece", "i").alias("order_key"),
        "section",
        "section_id",
        H.tag_attr("a", "href").alias("href"),
        H.link_text("a").alias("text"),
        H.tag_attr("a", "class").alias("css_class"),
    )


def build_courts(listing: DataFrame, html: str = "html", url: str = "url",
                 css_class: str = "a", href_contains: str = "LiAcuerdos", skip: int = 3,
                 calendar_url: str | Column | None = None, captured_at: str = "captured_at", history: bool = False) -> DataFrame:
    """Court dimension from listing pages: links of class `css_class`
    whose href contains `href_contains`, minus the first `skip` of each
    capture; municipality = id of the outermost table around the link,
    lower-cased without 'tbl'; absolute URL, JuzId query parameter and subject
    from the name; one row per URL, the later link winning (U3).

    A listing may be captured often: links are numbered within each capture
    (inside its row, without a shuffle), and a later capture wins over an
    earlier one.  With `history` every capture keeps its own row of a court,
    with its time as `seen_at` (for `operators.asof`).  `calendar_url` names the calendar that governs the courts;
    by default the listing's own column of that name, else null."""
    from edicto.functions.classify import classify_subject
    from edicto.functions.urls import query_param, url_join
    from edicto.operators.load import last_by_key

    if calendar_url is None:
        calendar_url = F.col("calendar_url") if "calendar_url" in listing.columns else F.lit(None)
    elif isinstance(calendar_url, str):
        calendar_url = F.lit(calendar_url)
    when = F.col(captured_at) if captured_at in listing.columns else F.lit(None).cast("timestamp")
    pages = listing.select(F.col(url).alias("listing_url"), F.col(html).alias("html"),
                           when.alias("seen_at"), calendar_url.cast("string").alias("calendar_url"),
                           F.monotonically_increasing_id().alias("capture"))
    ln = section_links(pages, "html", tags=("table",), keep=("listing_url", "seen_at", "calendar_url", "capture"))
    ln = ln.filter(
        (F.coalesce(F.col("css_class"), F.lit("")) == F.lit(css_class))
        & F.coalesce(F.col("href").contains(href_contains), F.lit(False))
    )
    # A capture is one row, its links are bounded by the page: numbering them
    # is an aggregate per capture, not a window over all captures of a URL.
    link = F.struct("order_key", "section_id", "href", "text")
    ln = ln.groupBy("listing_url", "seen_at", "calendar_url", "capture").agg(F.sort_array(F.collect_list(link)).alias("links"))
    ln = ln.select("listing_url", "seen_at", "calendar_url", F.posexplode(F.slice("links", skip + 1, 1 << 30)).alias("pos", "l"))
    court_url = url_join("listing_url", F.col("l.href"))
    courts = ln.select(
        court_url.alias("court_url"),
        F.col("l.text").alias("juzgado"),
        F.replace(F.lower("l.section_id"), F.lit("tbl"), F.lit("")).alias("entidad_code"),
        query_param(court_url, "JuzId").alias("juz_id"),
        classify_subject("l.text").alias("materia"),
        "listing_url",
        "calendar_url",
        "seen_at",
        F.struct("seen_at", "listing_url", "pos").alias("_order"),
    )
    courts = last_by_key(courts, ["court_url", *(["seen_at"] if history else [])], "_order").drop("_order")
    return courts.select("court_url", "juzgado", "entidad_code", "juz_id", "materia", "listing_url", "calendar_url", *(["seen_at"] if history else []))


def result_rows(html: str | Column, table_id: str = RESULTS_TABLE_ID, require_tbody: bool = True) -> Column:
    """H4: inner html of each row of `table[@id]/tbody/tr` (or
    `table[@id]/tr`).  Tables nested in a cell stay in it, to any depth; the
    end tags of rows, cells and bodies may be missing."""
    body = let(H.strip_noise(html), lambda h: H.table_body(h, table_id))
    if require_tbody:
        body = F.array_join(H.contents(body, "tbody", "tbody"), "</tr>")
    return H.contents(body, "tr", "tr|tbody|thead|tfoot")


def table_rows(df: DataFrame, html: str = "html", table_id: str = RESULTS_TABLE_ID,
               require_tbody: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """H4: one row per `tr` with `row_pos` and the row's inner html."""
    return df.select(*keep, F.posexplode(result_rows(html, table_id, require_tbody)).alias("row_pos", "row_html"))


def row_cells(row_html: str | Column, having_attr: str | None = "valign") -> Column:
    """H5: inner html of the row's cells (`td`), only those having
    `having_attr` when given."""
    return H.contents(row_html, "td", "t[dhr]", having_attr)


def cell_nodes(cells: str | Column, i: int) -> Column:
    """H6: text nodes of the i-th selected cell (0-based); [] if missing."""
    cell = F.get(H.col(cells), i)
    return F.coalesce(H.text_nodes(cell), F.array().cast("array<string>"))


def day_page_rows(df: DataFrame, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """H4-H6 for a day page: one row per result row with the node lists
    `numero_nodes`, `n2`, `n3` the extraction operators read.  They are those of
    `table_rows`, `row_cells` and `cell_nodes`, read in one pass over the page."""
    # not by way of a column: a filter on its size would read the page once more
    rows = df.select(*keep, F.posexplode(day_rows(html, RESULTS_TABLE_ID)).alias("row_pos", "_row"))
    return rows.select(*keep, "row_pos", *[F.col("_row")[c].alias(c) for c in CELLS])


def page_reject(html: str | Column) -> Column:
    """Why a captured day page cannot be read (null: it has rows)."""
    h = H.col(html)
    return (
        F.when(h.isNull() | (F.btrim(h) == ""), F.lit("empty_page"))
        .when(~h.rlike(rf"(?i){H.start_tag('table')}"), F.lit("no_table"))
        .when(F.coalesce(F.size(result_rows(h)), F.lit(0)) == 0, F.lit("no_rows"))
    )


# --- calendar pages (H8-H10) -------------------------------------------------------


def _calendar_body(html) -> Column:
    return let(H.strip_noise(html), lambda h: H.table_body(h, CALENDAR_TABLE_ID))


def _calendar_header(html) -> Column:
    """Inner html of the header table nested in the calendar's first row."""
    return F.regexp_extract(_calendar_body(html), rf"(?is){H.start_tag('x-table')}(.*?)</x-table\s*>", 1)


def calendar_year(html: str | Column) -> Column:
    """H9: last 4 characters of the first text node of the header's 2nd cell."""
    tds = H.contents(_calendar_header(html), "x-td", "x-t[dr]")
    first_text = F.get(H.text_nodes(F.get(tds, 1)), 0)
    return F.right(first_text, F.lit(4))


def calendar_nav(html: str | Column) -> tuple[Column, Column]:
    """(previous-month code, next-month code) from the header links."""
    a = H.anchors(_calendar_header(html))
    prev = month_code(H.tag_attr(F.get(a, 0), "href"))
    nxt = month_code(H.tag_attr(F.get(a, 1), "href"))
    return F.nullif(prev, F.lit("")), F.nullif(nxt, F.lit(""))


def calendar_days(df: DataFrame, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """H8: day links of a calendar page (`tr[position()>2]/td/a`) with
    title, href, day code, the date from title + header year (D1) and the
    date from the code."""
    body = F.regexp_replace(_calendar_body(html), r"(?is)<x-table\b.*?</x-table\s*>", "")
    rows = H.contents(body, "tr", "tr")
    out = df.select(*keep, calendar_year(html).alias("year"), F.posexplode(rows).alias("week", "tr"))
    out = out.filter(F.col("week") >= 2)
    out = out.select(
        *keep, "year", "week",
        F.posexplode(H.anchors("tr")).alias("i", "a"),
    )
    out = out.select(
        *keep, "year", "week", "i",
        H.tag_attr("a", "title").alias("title"),
        H.tag_attr("a", "href").alias("href"),
    )
    return out.select(
        *keep,
        "title",
        "href",
        day_code("href").alias("day_arg"),
        parse_spanish_date(F.concat_ws(" ", F.lower("title"), F.col("year"))).alias("fecha"),
        code_to_date(day_code("href")).alias("code_date"),
    )
