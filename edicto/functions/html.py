"""HTML-to-values Column functions (regex over stored page text).

Pages are plain strings; elements are located with linear, case-insensitive,
dot-all patterns that stay in the JVM.  All of them are built from one token
pattern, a tag with its attributes as the HTML standard reads them: a quoted
value may hold any sign, so a '>' or a '<td>' in it ends and opens nothing.  Comments, scripts and styles are
removed before links or text are read, because their content is not part
of the document tree.  Elements nested in their own kind (tables in tables)
are paired by depth: `pieces` cuts a page at the tags of that kind and a fold
in blocks counts along the pieces, so any nesting depth is exact and the time
linear in the page.
"""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from edicto.functions.text import ColumnOrName, col, let

# Named character references of HTML 4 (name -> character), from the standard library.
NAMED = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}

RX_NOISE = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"

# A tag's attributes: blanks, names, and values in quotes or without.  A quote
# that is never closed counts as a sign like others, and a '<' outside quotes
# tells that the tag before it is broken.  So all of it takes linear time.
ATTR = r"""[^\s/><][^\s/>=<]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'><][^\s><]*+)?+)?+"""
ATTRS = rf"(?:[\s/]++|{ATTR})*+"
NAME_END = r"(?=[\s/>])"
ATTR_END = r"(?=[\s/>=])"
# Any tag behind its '<'.
ANY_TAG = rf"/?[a-zA-Z][^\s/><]*+{ATTRS}>"
# Tags, declarations and broken end tags; other '<' are text.
RX_TAG = rf"<(?:{ANY_TAG}|[!?/][^>]*+>)"


def start_tag(names: str) -> str:
    """A start tag of one of the elements `names` (alternatives)."""
    return rf"<(?:{names}){NAME_END}{ATTRS}>"


def up_to(names: str) -> str:
    """Everything before the next start or end tag of `names`, tag by tag."""
    return rf"(?:[^<]++|<(?!/?(?:{names}){NAME_END})(?:{ANY_TAG})?+)*+"


def before_attr(attr: str) -> str:
    """The attributes before the first one called `attr`."""
    return rf"(?:[\s/]++|(?!{attr}{ATTR_END}){ATTR})*+"


def each(names: str, wanted: str) -> str:
    """Pattern for `regexp_extract_all` that reads a page tag by tag, from match
    to match: group 1 of `wanted` where it fits at a tag of `names`, else ''."""
    return rf"(?i)\G{up_to(names)}(?:{wanted}|<(?:{ANY_TAG})?+)"


def find_all(html: ColumnOrName, names: str, wanted: str) -> Column:
    """Group 1 of `wanted` (never empty) at each tag of `names` where it fits."""
    return F.array_remove(F.regexp_extract_all(col(html), F.lit(each(names, wanted)), F.lit(1)), "")


def contents(html: ColumnOrName, name: str, ends: str, having: str | None = None) -> Column:
    """What follows each start tag `name` (with an attribute `having`), up to the
    next tag of `ends`."""
    h = re.escape(having or "")
    attr = "" if having is None else rf"(?={before_attr(h)}{h}{ATTR_END})"
    found = find_all(html, name, rf"<(?:{name}){NAME_END}{attr}{ATTRS}(>{up_to(ends)})")
    return F.transform(found, lambda x: F.substring(x, 2, 1 << 30))


def attr_pattern(attr: str) -> str:
    """Value of `attr` in an opening tag (double, single or no quotes)."""
    a = re.escape(attr)
    return rf"""(?is)^<[a-z][^\s/>]*+{before_attr(a)}{a}\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+))"""


RX_NOISE_START = r"(?i)<(?:!--|script\b|style\b)"


def strip_noise(html: ColumnOrName) -> Column:
    """Remove comments, <script> and <style> blocks.  A find-only test
    first, so pages without them are not rebuilt."""
    h = col(html)
    return F.when(h.rlike(RX_NOISE_START), F.regexp_replace(h, RX_NOISE, "")).otherwise(h)


RX_REFERENCE = r"^(?:#([0-9]{1,7});?|#[xX]([0-9a-fA-F]{1,6});?|([A-Za-z][A-Za-z0-9]*);)"


def _named() -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, NAMED)), F.array(*map(F.lit, NAMED.values())))


def _decoded(piece: Column) -> Column:
    """The text after an '&': its reference decoded, or as it was."""
    part = lambda i: F.regexp_extract(piece, RX_REFERENCE, i)
    digits = F.coalesce(F.nullif(part(1), F.lit("")).cast("int"), F.conv(F.nullif(part(2), F.lit("")), 16, 10).cast("int"))
    coded = let(digits, lambda code: F.when((code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF),
                                            F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))
    # a name that isn't known, '' among them, has no sign
    sign = F.coalesce(coded, F.try_element_at(_named(), part(3)))
    rest = F.substring(piece, F.length(part(0)) + 1, 1 << 30)
    return F.coalesce(F.concat(sign, rest), F.concat(F.lit("&"), piece))


def unescape(c: ColumnOrName) -> Column:
    """Decode character references: decimal, hexadecimal and named ones, each
    once ('&amp;lt;' becomes '&lt;').  What is no reference stays, and text
    without '&' is passed through."""
    decoded = lambda s: F.array_join(F.transform(F.split(s, "&"), lambda x, i: F.when(i == 0, x).otherwise(_decoded(x))), "")
    return let(col(c), lambda s: F.when(s.contains("&"), decoded(s)).otherwise(s))


def open_tag(element: ColumnOrName) -> Column:
    """The opening tag of an element string."""
    return F.regexp_extract(col(element), rf"^(<{ANY_TAG})", 1)


def tag_attr(element: ColumnOrName, attr: str) -> Column:
    """Attribute value from the opening tag of `element` (null if absent)."""
    p = attr_pattern(attr)

    def value(tag: Column) -> Column:
        v = F.concat(F.regexp_extract(tag, p, 1), F.regexp_extract(tag, p, 2), F.regexp_extract(tag, p, 3))
        return F.when(tag.rlike(p), unescape(v))

    return let(open_tag(element), value)  # the element, often cut from a whole page, is found once


def has_attr(element: ColumnOrName, attr: str) -> Column:
    a = re.escape(attr)
    return open_tag(element).rlike(rf"(?is)^<[a-z][^\s/>]*+{before_attr(a)}{a}{ATTR_END}")


def inner(element: ColumnOrName) -> Column:
    """Content between the opening and the closing tag."""
    return F.regexp_extract(col(element), rf"(?s)^<{ANY_TAG}(.*)</[^>]*>\s*$", 1)


def elements(html: ColumnOrName, tag: str) -> Column:
    """All `tag` elements (whole strings, lazy pairing) in document order."""
    t = re.escape(tag)
    return find_all(html, t, rf"({start_tag(t)}(?s:.*?)</{t}\s*>)")


def anchors(html: ColumnOrName) -> Column:
    """All links."""
    return elements(html, "a")


def open_tag_with_id(tag: str, id_: str) -> str:
    t, i = re.escape(tag), re.escape(id_)
    return rf"<{t}{NAME_END}{before_attr('id')}id\s*+=\s*+(?:\"{i}\"|'{i}'|{i}{NAME_END}){ATTRS}>"


# Joins pieces or text nodes of one fragment (a NUL cannot occur in HTML text).
_NODE_SEP = "\u0000"


def pieces(html: ColumnOrName, tags: str) -> Column:
    """The page cut before every start and end tag of `tags` (alternatives of
    a pattern); the first piece is what stands before all of them.  The page is
    read tag by tag, so signs in attribute values cut nothing."""
    plain = F.replace(col(html), F.lit(_NODE_SEP))
    marked = F.regexp_replace(plain, rf"(?i)({up_to(tags)})(?:(<(?:{ANY_TAG})?+)|\z)", f"$1{_NODE_SEP}$2")
    return F.split(F.rtrim(marked, F.lit(_NODE_SEP)), _NODE_SEP)


def with_delta(parts: Column) -> Column:
    """The `pieces` of a page as structs `x, d`; d is 1 on a start tag, -1 on
    an end tag and 0 for the text before all tags."""
    return F.transform(parts, lambda x, i: F.struct(
        x.alias("x"), F.when(i == 0, 0).when(x.startswith("</"), -1).otherwise(1).alias("d")))


# Pieces taken at a time: appending to a list copies it, so long lists are built in blocks.
BLOCK = 64


def fold_blocks(parts: Column, start: Column, step, emit) -> Column:
    """Walk along the structs `parts` with a small state: `step(state, part)`
    is the next state and `emit(state, part)` what this part gives.  One list,
    as long as `parts`; built block by block, in time linear in it."""

    def one(b: Column, p: Column) -> Column:
        return let(step(b["s"], p), lambda s: F.struct(s.alias("s"), F.array_append(b["out"], emit(s, p)).alias("out")))

    def block(a: Column, all_: Column, i: Column) -> Column:
        some = F.slice(all_, i * BLOCK + 1, BLOCK)
        return let(F.aggregate(some, F.struct(a["s"].alias("s"), F.slice(a["none"], 1, 0).alias("out")), one), lambda b: F.struct(
            b["s"].alias("s"), F.array_append(a["out"], b["out"]).alias("out"), a["none"].alias("none")))

    def run(all_: Column) -> Column:
        none = F.slice(F.transform(F.slice(all_, 1, 1), lambda p: emit(start, p)), 1, 0)
        return F.aggregate(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")),
                           F.struct(start.alias("s"), F.slice(F.array(none), 1, 0).alias("out"), none.alias("none")),
                           lambda a, i: block(a, all_, i), lambda a: F.flatten(a["out"]))

    return let(parts, run)


# Tags of a nested table are renamed, so that patterns for the outer table's
# rows and cells do not see them; as tags they vanish from text nodes anyway.
RX_TABLE_PARTS = r"(?i)<(/?)(table|thead|tbody|tfoot|tr|td|th)\b"
NESTED = "<$1x-$2"


def table_body(html: ColumnOrName, id_: str) -> Column:
    """Inner content of the first table whose id is `id_` ('' if there is
    none).  Tables nested in it, to any depth, stay as content with the names
    of their tags prefixed by 'x-'.  A missing end tag is read up to the end
    of the page."""
    opens = r"(?i)^" + open_tag_with_id("table", id_)
    none = F.array().cast("array<string>")

    def step(a: Column, x: Column, delta: Column) -> Column:
        now = F.when(a["depth"] > 0, a["depth"] + delta).when(
            (a["depth"] == 0) & (delta == 1) & x.rlike(opens), 1).otherwise(a["depth"])

        def at(depth: Column) -> Column:
            # the outer start tag goes; after a nested table's end the outer one goes on
            inside = F.when(a["depth"] == 0, F.regexp_replace(x, rf"^<{ANY_TAG}", "")).when(
                (depth == 1) & (delta == -1), F.concat(F.lit("</x-"), F.substring(x, 3, 1 << 30))).otherwise(
                F.regexp_replace(x, RX_TABLE_PARTS, NESTED))
            out = F.when(depth > 0, F.array_append(a["out"], inside)).otherwise(a["out"])
            # -1: the table has ended, nothing more is taken
            ended = (a["depth"] > 0) & (depth <= 0)
            return F.struct(F.when(ended, -1).otherwise(depth).alias("depth"), out.alias("out"))

        return let(now, at)

    def block(a: Column, parts: Column, i: Column) -> Column:
        inner = F.aggregate(F.slice(parts, i * BLOCK + 1, BLOCK), F.struct(a["depth"].alias("depth"), none.alias("out")),
                            lambda b, p: step(b, p["x"], p["d"]))
        return let(inner, lambda b: F.struct(b["depth"].alias("depth"), F.array_append(a["out"], F.array_join(b["out"], "")).alias("out")))

    found = let(with_delta(pieces(html, "table")), lambda parts: F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")), F.struct(F.lit(0).alias("depth"), none.alias("out")),
        lambda a, i: block(a, parts, i), lambda a: F.array_join(a["out"], "")))
    return F.when(col(html).rlike(r"(?i)" + open_tag_with_id("table", id_)), found).otherwise(F.lit(""))


def text_nodes(fragment: ColumnOrName) -> Column:
    """`//text()`: descendant text nodes in order, whitespace-only nodes
    kept, entities decoded.  The fragment is split at its tags once, and
    entities are decoded once per fragment, after tags are split off."""
    joined = F.array_join(F.array_remove(F.split(col(fragment), RX_TAG), ""), _NODE_SEP)
    # nodes aren't empty, so nothing is joined only where there is none
    return let(joined, lambda s: F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(unescape(s), _NODE_SEP)))


# A child element with its content (one level), removed to keep only the
# direct text of an element.
RX_CHILD_ELEMENT = rf"(?is)<[a-z][^\s/>]*+{ATTRS}>.*?</[a-z][a-z0-9]*\s*>"


def link_text(a: ColumnOrName) -> Column:
    """`./text()` of a link, first value: its first direct text node
    (text inside child elements such as <b> is not direct text)."""
    return F.get(text_nodes(F.regexp_replace(inner(a), RX_CHILD_ELEMENT, "")), 0)


def html_attr(html: ColumnOrName, tag: str, attr: str, id_: str | None = None) -> Column:
    """H7: `attr` of the first `tag` (optionally with a given id)."""
    tag_rx = start_tag(re.escape(tag)) if id_ is None else open_tag_with_id(tag, id_)
    return tag_attr(F.coalesce(F.get(find_all(html, re.escape(tag), f"({tag_rx})"), 0), F.lit("")), attr)
