"""Tokens of an HTML page: tags with their element path, and text blocks.

A small tokeniser for pages as they are found: unclosed elements, missing end
tags, raw script text and broken comments are read as browsers read them, as
far as text extraction needs it.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*)>", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
RAW = {n: re.compile(rf"</{n}[\s/>]", re.I) for n in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp")}

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody
td tfoot th thead title tr ul""".split())
IN_HEAD = frozenset("title meta link style script base noscript template head html".split())
#: An opening tag ends an open element of these names, up to the nearest element of BARRIER.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
BARRIER = frozenset("ul ol dl table select body article section div main nav".split())

#: Elements whose content is never shown as text.
UNSEEN = frozenset("""script style noscript template iframe object svg button select input textarea head title canvas audio video map""".split())
#: Elements, and words of class, id and role, that name what is no article.  They
#: say nothing alone: a template must confirm them, or be missing.
NOT_TEXT = frozenset("nav footer aside form dialog menu".split())
HINTS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent
notice notices gdpr popup modal overlay newsletter subscribe signup sidebar widget widgets menu nav navbar navigation breadcrumb
breadcrumbs masthead footer copyright comment comments reply replies respond disqus share sharing social related recommended
login search pagination pager toolbar contentinfo complementary dialog alert""".split())
#: Words of names that tell what another element has or does.
ABOUT = frozenset("has no with without open closed enabled disabled count toggle".split())
MAIN = frozenset(("article", "main"))
#: Ids of these name a text's parts, as link targets.
TEXT_LEVEL = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre span b i em strong a font u small q cite code".split())
PARTS = TEXT_LEVEL | {"section"}
#: Elements nested deeper count to the path of the element at this depth.
DEPTH = 100


@dataclass
class Element:
    name: str
    path: str
    unseen: bool  # no text, itself or by an ancestor
    named: bool  # its own names tell of something else than an article
    aside: bool  # named, or a page's header, itself or by an ancestor
    main: bool  # inside an article or main element
    link: bool  # inside a link
    depth: int
    seen: dict[str, int] = field(default_factory=dict)  # children by label


@dataclass
class Block:
    path: str
    text: str
    main: bool
    aside: bool
    links: int  # characters inside links
    place: int
    within: tuple[str, ...]  # paths of the open elements


@dataclass
class Page:
    tags: list[tuple[str, int, bool]] = field(default_factory=list)  # path token, place, named
    blocks: list[Block] = field(default_factory=list)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(text)}


def _marks(attrs: dict[str, str], keys: tuple[str, ...] = ("class", "id", "role")) -> set[str]:
    """Words of class, id and role.  Names that only tell of another element
    (`has-sidebar`, `comments-open`) give none."""
    out: set[str] = set()
    for name in " ".join(attrs.get(k, "") for k in keys).split():
        words = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower()
        words = [w for w in re.split(r"[^a-z0-9]+", words) if w]
        if not ABOUT.intersection(words):
            out.update(words, ["".join(words)])
    return out


def _element(name: str, attrs: dict[str, str], parent: Element | None) -> Element:
    marks = _marks(attrs, ("class", "role") if name in PARTS else ("class", "id", "role")) if attrs else set()
    root = name in ("html", "body")
    unseen = not root and (name in UNSEEN or bool(attrs) and (
        "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", attrs.get("style", "")))))
    named = not root and (name in NOT_TEXT or name != "main" and bool(marks & HINTS))
    inside = bool(parent and parent.main)
    # a page's header; an article's own holds its title
    header = not inside and not root and name not in MAIN and (name == "header" or "header" in marks)
    main = name in MAIN or "main" == attrs.get("role") or "articleBody" in attrs.get("itemprop", "")
    up = parent or Element("", "", False, False, False, False, False, 0)
    facts = (unseen or up.unseen, named, named or header or up.aside, inside or main, name == "a" or up.link)
    if up.depth >= DEPTH:  # deeper elements share their ancestor's path
        return Element(name, up.path, *facts, up.depth)
    label = name
    if attrs:
        label += "".join(f".{attrs[k].split()[0]}" for k in ("class", "id") if attrs.get(k, "").split())
    if name not in TEXT_LEVEL:  # elements that look alike are told apart by their order
        up.seen[label] = n = up.seen.get(label, 0) + 1
        label += f"~{n}" if n > 1 else ""
    return Element(name, f"{up.path}/{label}" if parent else label, *facts, up.depth + 1)


def parse(source: str) -> Page:
    """All tags with their paths, and all text blocks in page order."""
    page, stack, text, at = Page(), [], [], 0
    place = 0

    def flush() -> None:
        nonlocal place
        if text:
            said = " ".join("".join(t for t, _ in text).split())
            links = sum(len("".join(t.split())) for t, link in text if link)
            text.clear()
            if said:
                top = next((e for e in reversed(stack) if e.name in BLOCK), None)
                place += 1
                last = stack[-1] if stack else Element("", "", False, False, False, False, False, 0)
                page.blocks.append(Block(top.path if top else "", said, last.main, last.aside, links, place,
                                         tuple(e.path for e in stack[:DEPTH])))

    def close(k: int) -> None:
        nonlocal place
        while len(stack) > k:
            e = stack[-1]
            if e.name in BLOCK:
                flush()
            stack.pop()
            place += 1
            page.tags.append((f"/{e.path}", place, e.named))

    while at < len(source):
        m = TOKEN.search(source, at)
        stop = m.start() if m else len(source)
        if stop > at and not (stack and stack[-1].unseen):
            text.append((html.unescape(source[at:stop]), bool(stack and stack[-1].link)))
        if not m:
            break
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        if m["end"] or m["end2"]:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), None)
            if k is not None:
                if any(e.name in BLOCK for e in stack[k:]):
                    flush()
                close(k)
            elif name in BLOCK:
                flush()
            continue
        if name in BLOCK:
            flush()
        elif name == "br":
            text.append((" ", False))
        if stack and name not in IN_HEAD:
            k = next((i for i, e in enumerate(stack) if e.name == "head"), None)
            if k is not None:
                flush()
                close(k)
        if name in BLOCK and name != "hr":  # a paragraph ends where a block starts, with what is open inside it
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == "p" or stack[i].name in BARRIER), None)
            if k is not None and stack[k].name == "p":
                close(k)
        ended, i = None, len(stack) - 1
        while name in ENDS and i >= 0 and stack[i].name not in BARRIER:
            if stack[i].name in ENDS[name]:
                ended = i
            i -= 1
        if ended is not None:
            flush()
            close(ended)
        attrs = _attributes(m["attrs"] or m["attrs2"] or "") if m["attrs"] or m["attrs2"] else {}
        e = _element(name, attrs, stack[-1] if stack else None)
        place += 1
        page.tags.append((e.path, place, e.named))
        if name in VOID or (m["attrs"] or m["attrs2"] or "").endswith("/") and name not in BLOCK:
            continue
        if name in RAW:
            end = RAW[name].search(source, at)
            at = end.start() if end else len(source)
        stack.append(e)
    flush()
    close(0)
    return page
