"""Main text by template deduction over equivalence classes (operator 8).

Pages of a host come from templates.  A token (a tag with its element path, or
a whole text) has an occurrence vector: how often it stands in each page of its
host.  Tokens with the same vector form an equivalence class; large, frequent
classes whose tokens nest properly are the template, and what lies between them
are slots with the pages' own text.  The deduction runs over all tokens; names
of elements, classes and ids take no part in it.

A vector as long as a host's pages is never built.  Each page adds a hash of
(page, count), the hashes are combined by exclusive or, which tasks can do in
part, and equal vectors have equal fingerprints.  So a host may have any number
of pages; its template is bounded by the size of a page.

Every class element that stands once in a page is a slot with the text that
lies in it and in no class element inside it, less the template's own texts.
The article is the slot with the most text; near ties go to one in an article
or main element.  It grows to a parent as long as that adds text: a slot beside
it that holds at least SHARE of the article's text, or is a paragraph or
heading; inside an article or main element also smaller ones.  Left out of the
article are: texts of the template; slots that vary in nothing or are mostly
links; and elements whose names tell of menus, adverts, forms, comments and the
like, but only if the template has them, too: a name on some page alone hides
nothing.

A host with under PAGES different pages is read by the template of its parent
domain, and if that has as few, by that of all such hosts.  A page that lacks
the article slot, or whose template has none, is read by its own article or main
element, and else whole; there names decide alone.

Defined results: null html counts as empty and has an empty text; a null URL,
or one without `://`, belongs to the empty host; elements nested deeper than
DEPTH share their ancestor's path; repeated rows are extracted each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicto.llm.bpe import slices
from edicto.llm.common import id_of, text_of, written
from edicto.llm.html_parse import MAIN, TEXT_LEVEL, Block, Page, parse
from edicto.llm.url_filter import host_of

#: A class is frequent if its tokens stand in this share of a host's pages;
#: its texts are the template's if it has elements and stands in ALMOST_ALL.
SUPPORT = 0.5
ALMOST_ALL = 0.8
#: Least number of a class's tokens, and of different pages that make a template.
CLASS_SIZE = 2
PAGES = 5
#: Slots with this share of the greatest tie with it.
TIE = 0.8
#: Share of the article's text that makes a slot beside it part of it.
SHARE = 0.05
#: Elements beside the article that belong to it whatever their length.
HEADS = TEXT_LEVEL | {"header", "hgroup", "figure"}

_STATS = "host string, token string, is_text boolean, vector long, pages long, total long, chars long, links long, named boolean"
_ELEMENT = "array<struct<path:string,chars:bigint,links:bigint,named:boolean,once:boolean>>"


def _hash(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                          "little", signed=True)


def _text_token(path: str, text: str) -> str:
    return f"{path}#{_hash(text):x}"


def _page_tokens(page: Page) -> dict[tuple[str, bool], list]:
    """Of each token of a page: count, characters of text inside, those of them in links, named."""
    out: dict[tuple[str, bool], list] = {}
    for path, _, named in page.tags:
        x = out.setdefault((path, False), [0, 0, 0, False])
        x[0] += 1
        x[3] |= named
    for b in page.blocks:
        x = out.setdefault((_text_token(b.path, b.text), True), [0, 0, 0, False])
        x[0] += 1
        x[1] += len(b.text)
        for path in dict.fromkeys(b.within):
            x = out[path, False]
            x[1] += len(b.text)
            x[2] += b.links
    return out


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token statistics, summed over what a task sees in a slice of its pages."""
    names = [c.split()[0] for c in _STATS.split(", ")]
    for batch in batches:
        hosts, keys, pages = (batch.column(i).to_pylist() for i in range(3))
        for i, j in slices(pages, 16_000_000):
            sums: dict[tuple[str, str, bool], list] = {}
            for host, key, source in zip(hosts[i:j], keys[i:j], pages[i:j]):
                sums.setdefault((host, "", False), [0, 0, 0, 0, 0, False])[1] += 1  # the empty token counts pages
                mark: dict[int, int] = {}  # the page's hash with each count
                for (token, is_text), (n, chars, links, named) in _page_tokens(parse(source)).items():
                    x = sums.setdefault((host, token, is_text), [0, 0, 0, 0, 0, False])
                    if n not in mark:
                        mark[n] = _hash(key, n)
                    x[0] ^= mark[n]
                    x[1] += 1
                    x[2] += n
                    x[3] += chars
                    x[4] += links
                    x[5] |= named
            rows = [(*k, *v) for k, v in sums.items()]
            kinds = [pa.string(), pa.string(), pa.bool_(), *[pa.int64()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def distinct_pages(pages: DataFrame) -> DataFrame:
    """`host, row, html` of each content of a host, from `host, html`.  Only
    contents that stand twice are grouped, after a partial grouping in the
    tasks; all other pages stay where they are."""
    keyed = pages.select("host", F.md5("html").alias("key"), "html")
    copied = written(keyed.groupBy("host", "key").agg(F.count("*").alias("n")).filter("n > 1").select("host", "key"), "copied-pages")
    once = keyed.join(copied, ["host", "key"], "left_anti")
    more = keyed.join(copied, ["host", "key"], "left_semi").groupBy("host", "key").agg(F.first("html").alias("html"))
    return once.unionByName(more).select("host", F.xxhash64("host", "key").alias("row"), "html")


def grouped(pages: DataFrame) -> DataFrame:
    """`host, team` for each host: the host itself if it has PAGES different
    pages, else its parent domain (`*.` and its last two labels) if that has
    them in hosts of the kind, else `*`."""
    n = pages.groupBy("host").agg(F.count("*").alias("n"))
    domain = F.concat(F.lit("*."), F.substring_index("host", ".", -2))
    few = n.filter(F.col("n") < PAGES).withColumn("domain", domain)
    domains = few.groupBy("domain").agg(F.sum("n").alias("all"))
    team = F.when(F.col("all") >= PAGES, F.col("domain")).otherwise(F.lit("*"))
    return n.filter(F.col("n") >= PAGES).select("host", F.col("host").alias("team")).unionByName(
        few.join(domains, "domain").select("host", team.alias("team")))


def templates(pages: DataFrame) -> DataFrame:
    """`team, elements, texts` from `host, row, html`, where `host` is a team:
    the class elements with their text, and the template's texts."""
    one = (pages.mapInArrow(_stats, _STATS).groupBy("host", "token", "is_text")
           .agg(F.bit_xor("vector").alias("vector"), *[F.sum(c).alias(c) for c in ("pages", "total", "chars", "links")], F.bool_or("named").alias("named")))
    one = written(one, "page-tokens")
    sizes = one.filter("token = ''").select("host", F.col("pages").alias("all")).filter(F.col("all") >= PAGES)
    frequent = one.filter("token <> ''").join(sizes, "host").filter(F.col("pages") >= SUPPORT * F.col("all"))
    # Equal vectors are one class.  An element's start and end tag carry the
    # same path, so a class nests properly where it has both.
    classes = (frequent.groupBy("host", "vector", "pages", "total").agg(F.count("*").alias("size"), F.count_if(~F.col("is_text")).alias("class_tags"))
               .filter(F.col("size") >= CLASS_SIZE).drop("size"))
    members = frequent.join(classes, ["host", "vector", "pages", "total"])
    path = F.regexp_replace("token", "^/", "").alias("path")
    # Their number per host is bounded by SUPPORT and the size of a page.
    paired = (members.filter("NOT is_text").groupBy("host", "vector", path)
              .agg(F.count("*").alias("tags"), F.max("chars").alias("chars"), F.max("links").alias("links"), F.bool_or("named").alias("named"),
                   F.bool_and(F.col("total") == F.col("pages")).alias("once"))
              .filter("tags = 2 AND (once OR named)").groupBy("host")
              .agg(F.sort_array(F.collect_list(F.struct("path", "chars", "links", "named", "once"))).cast(_ELEMENT).alias("elements")))
    texts = (members.filter("is_text AND class_tags >= 2").filter(F.col("pages") >= ALMOST_ALL * F.col("all")).groupBy("host")
             .agg(F.sort_array(F.collect_list(F.struct("token", "chars"))).alias("texts")))
    return sizes.select(F.col("host").alias("team")).join(paired.withColumnRenamed("host", "team"), "team", "left").join(
        texts.withColumnRenamed("host", "team"), "team", "left")


@dataclass(frozen=True)
class Template:
    root: str | None = None  # path of the article
    out: frozenset[str] = frozenset()  # elements in it that are none of it
    texts: frozenset[str] = frozenset()
    places: frozenset[str] = frozenset()  # paths of these texts


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1].split(".", 1)[0].split("~", 1)[0]


def decide(elements: list[dict], texts: list[dict]) -> Template:
    """Where the article is, from a team's class elements and template texts."""
    slots = {e["path"]: [e["chars"], e["links"], e["named"]] for e in elements if e["once"]}
    above = lambda p: [q for q in ("/".join(p.split("/")[:i]) for i in range(p.count("/"), 0, -1)) if q in slots]
    for t in texts:  # only what varies counts
        path = t["token"].rsplit("#", 1)[0]
        for q in ([path] if path in slots else []) + above(path):
            slots[q][0] -= t["chars"]
    parent = {p: next(iter(above(p)), None) for p in slots}
    kids: dict[str | None, list[str]] = {}
    for p, q in parent.items():
        kids.setdefault(q, []).append(p)
    own = {p: slots[p][0] - sum(slots[k][0] for k in kids.get(p, ())) for p in slots}

    def boiler(p: str) -> bool:
        chars, links, named = slots[p]
        return named or chars <= 0 or 2 * links > chars

    said = frozenset(t["token"] for t in texts)
    places = frozenset(t.rsplit("#", 1)[0] for t in said)
    named = {e["path"] for e in elements if e["named"]}
    able = [p for p in slots if own[p] > 0 and not boiler(p) and not any(boiler(q) for q in above(p))]
    if not able:
        return Template(texts=said, places=places)
    most = max(own[p] for p in able)
    in_main = lambda p: any(_name(q) in MAIN for q in [p, *above(p)])
    root = at = max((p for p in able if own[p] >= TIE * most), key=lambda p: (in_main(p), own[p], p))
    out: set[str] = set()
    while (up := parent[at]) is not None and not slots[up][2]:
        beside = [k for k in kids[up] if k != at]
        real = [k for k in beside if not boiler(k)]
        large = [k for k in real if _name(k) in HEADS or slots[k][0] >= SHARE * slots[root][0]]
        whole = any(_name(q) in MAIN for q in [up, *above(up)])
        if large or own[up] >= SHARE * slots[root][0] or whole and (real or own[up] > 0):
            out.update(k for k in beside if k not in (real if whole else large))
            root = up
        at = up
    out.update(k for p in slots if p == root or p.startswith(root + "/") for k in kids.get(p, ()) if 2 * slots[k][1] > slots[k][0] > 0 and _name(k) not in HEADS)
    out.update(p for p in named if p.startswith(root + "/"))
    return Template(root, frozenset(p for p in out if p != root and not root.startswith(p + "/")), said, places)


def page_blocks(source: str, template: Template = Template()) -> tuple[str, list[Block]]:
    """What decided (`slot`, `article` or `page`), and the article's blocks."""
    blocks = [b for b in parse(source).blocks if b.path not in template.places or _text_token(b.path, b.text) not in template.texts]
    if template.root is not None:
        inside = [b for b in blocks if template.root in b.within]
        if inside:
            return "slot", [b for b in inside if template.out.isdisjoint(b.within)]
    main = [b for b in blocks if b.main and not b.aside]
    if main:
        return "article", main
    return "page", [b for b in blocks if not b.aside]


def page_text(source: str, template: Template = Template()) -> str:
    """The article of one page, given its host's template."""
    return "\n\n".join(b.text for b in page_blocks(source, template)[1])


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", decided: bool = False) -> DataFrame:
    """One row per input row: `page_id, url, text, n_chars`, and with `decided`
    what decided: `slot`, `article` or `page`."""
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(id_of(id_col).alias("page_id"), url.alias("url"), host_of(url).alias("host"), text_of(html_col).alias("html"))
    contents = distinct_pages(rows.select("host", "html"))
    teams = written(grouped(contents.select("host")), "teams")  # a known size: one row per host
    found = written(templates(contents.join(teams, "host").select(F.col("team").alias("host"), "row", "html")), "templates")
    names = ["page_id", "url", "text", "n_chars", *(["decided_by"] if decided else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template] = {}
        for batch in batches:
            sources, team, elements, texts = (batch.column(c) for c in ("html", "team", "elements", "texts"))
            sources, team = sources.to_pylist(), team.to_pylist()
            if len(known) > 1000:
                known.clear()
            for i, j in slices(sources):
                by, said = [], []
                for k in range(i, j):
                    if team[k] not in known:
                        known[team[k]] = decide(elements[k].as_py() or [], texts[k].as_py() or [])
                    how, blocks = page_blocks(sources[k], known[team[k]])
                    by.append(how)
                    said.append("\n\n".join(b.text for b in blocks))
                ids, urls = batch.column("page_id").slice(i, j - i), batch.column("url").slice(i, j - i)
                cols = [ids, urls, pa.array(said, pa.string()), pa.array(map(len, said), pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(by, pa.string())] if decided else []), names=names)

    joined = rows.join(teams, "host", "left").join(found, "team", "left").select("page_id", "url", "html", "team", "elements", "texts")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long" + (", decided_by string" if decided else ""))
