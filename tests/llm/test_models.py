"""Operators 4 and 8, and the pipeline."""

import collections
import html as H
import itertools
import math
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline as CP
from edicto.llm import html_extract as HX
from edicto.llm import lm_score as LM
from edicto.llm.hmm import Hmm, expected_counts, log10_likelihoods
from edicto.llm.queries import QUERIES
from tests.llm.test_filters import brute_counts, brute_spans
from tests.llm.util import SF, empty, ids, near_classes, odd, read

# -- language model -----------------------------------------------------------


def model(rng, states, symbols):
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    return Hmm(norm(rng.random(states)), norm(rng.random((states, states))), norm(rng.random((states, symbols))).T.copy())


def paths(m, seq):
    for z in itertools.product(range(len(m.start)), repeat=len(seq)):
        p = m.start[z[0]] * m.emit[seq[0], z[0]]
        for t in range(1, len(seq)):
            p *= m.move[z[t - 1], z[t]] * m.emit[seq[t], z[t]]
        yield z, p


def test_forward_and_counts_are_exact():
    rng = np.random.default_rng(4)
    m = model(rng, 3, 5)
    seqs = [rng.integers(0, 5, n) for n in (1, 4, 2, 6, 4)] + [np.zeros(0, dtype=np.int64)]
    got, e = log10_likelihoods(m, seqs), expected_counts(m, seqs)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for k, s in enumerate(seqs[:-1]):
        total = sum(p for _, p in paths(m, s))
        assert math.isclose(got[k], math.log10(total), rel_tol=1e-12)
        for z, p in paths(m, s):
            start[z[0]] += p / total
            for t, x in enumerate(s):
                emit[x, z[t]] += p / total
                if t:
                    move[z[t - 1], z[t]] += p / total
    assert got[-1] == 0
    for a, b in ((e.start, start), (e.move, move), (e.emit, emit)):
        np.testing.assert_allclose(a, b, atol=1e-10)


def brute_base(rows):
    tokens = [[w for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())] + [b""] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = collections.Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
            for (i, _), ws, h in zip(rows, tokens, held)]


@pytest.mark.parametrize("source", ["documents", "odd"])
def test_scores(spark, source):
    docs = read(spark, "documents", "/root/testdata/sf0.01") if source == "documents" else odd(spark)
    key = lambda r: tuple(str(x) for x in r[:5])
    got = sorted((tuple(r) for r in LM.score(spark, docs).collect()), key=key)
    want = sorted(brute_base([(r.doc_id, r.text) for r in docs.collect()]), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert sorted(round(g[5], 4) for g in got) == sorted(round(w[5], 4) for w in want)
    if source == "documents":
        held = [g for g in got if g[1]]
        assert sum(g[6] for g in held) > sum(g[5] for g in held)  # likelier than by single words


def test_score_is_a_distribution(spark):
    """Over one-word texts, known words and the unknown of each bucket sum to one with every state's start."""
    rng = np.random.default_rng(0)
    m, counts = model(rng, 2, LM.BUCKETS), collections.Counter({"a": 3, "b": 1, "c": 2})
    inside = collections.Counter(LM.bucket_of(w.encode()) for w in counts for _ in range(counts[w] + 1))
    total = sum(10 ** log10_likelihoods(m, [np.array([b])])[0] * (sum(
        (counts[w] + 1) for w in counts if LM.bucket_of(w.encode()) == b) + 1) / (inside[b] + 1) for b in range(LM.BUCKETS))
    assert math.isclose(total, 1, rel_tol=1e-9)


def test_score_empty(spark):
    assert LM.score(spark, empty(spark)).count() == 0


# -- html ---------------------------------------------------------------------


def test_pages(spark):
    pages = read(spark, "pages")
    for r, page in zip(HX.extract(pages).orderBy("page_id").collect(), pages.orderBy("page_id").collect()):
        inside = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        parts = [" ".join(H.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)[^>]*>", inside)]
        want = "\n\n".join(x for x in parts if x)
        assert (r.page_id, r.url, r.text, r.n_chars) == (page.page_id, page.url, want, len(want))


def template_page(i, article):
    paragraphs = "".join(f"<p>{x}" for x in article)
    return (f"<html><head><title>t{i}</title><style>p{{}}</style></head><body class=page><div id=top>Our Site</div><div><a href=/>Home</a> "
            f"<a href=/x>About us</a></div><div class=cols><div class=c1><h2>Title {i}</h2>{paragraphs}</div>"
            f"<div class=c2><p>Read our most loved stories every single day</div></div>"
            f"<div class='user-comments'><p>first! {i}</div><form>Search</form><script>var a='</p>'</script><div>Made with care</div></body></html>")


def test_template_without_article_element(spark):
    arts = {i: [f"Paragraph {i} {k} " + " ".join(f"w{i * k + j}" for j in range(30)) for k in range(1, 3 + i % 3)] for i in range(12)}
    rows = [(i, f"http://site.example/{i}", template_page(i, a)) for i, a in arts.items()]
    rows += [(100, "http://one.example/", "<body><h1>Alone &eacute;&#65;</h1><p>Only   page<br>here<nav>menu</nav>"), (101, None, None), (102, "x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", HX.F.lit("x"))
    got = {r.page_id: r.text for r in HX.extract(pages).collect()}
    for i, a in arts.items():
        assert got[i] == "\n\n".join([f"Title {i}", *(" ".join(x.split()) for x in a)])
    assert got[100] == "Alone éA\n\nOnly page here" and got[101] == got[102] == ""
    assert HX.extract(pages.filter("1 = 0")).count() == 0


def test_pages_without_template():
    """Names decide alone where there is no template."""
    page = ("<main><header><h1>T</h1></header><article><p>a &lt;b&gt; <i>c</i>d<aside>no</aside><ul><li>x<li>y</ul>"
            "<div class='ad-box'>buy</div><pre>p\n q</pre><section><article>hi</article></section></article></main>"
            "<p>after</p><!-- <article>z</article> -->")
    assert HX.page_blocks(page)[0] == "article" and HX.page_text(page) == "T\n\na <b> cd\n\nx\n\ny\n\np q\n\nhi"
    assert HX.page_text("<p title='a>b'>q</p><p>r") == "q\n\nr"
    assert HX.page_text("<div class='content has-sidebar comments-open'>t<div id=sideBar>s</div><div class='side_bar'>u</div>") == "t"
    assert HX.page_text("<div>" * 5000 + "deep") == "deep"
    assert HX.page_text("<article>a<script>never ends </p> b") == "a"


def site(spark, pages, host="site.example"):
    rows = [(i, f"http://{host}/{i}", h) for i, h in enumerate(pages)]
    got = HX.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), decided=True).orderBy("page_id").collect()
    return [r.text for r in got], [r.decided_by for r in got]


def says(i, n, words=40):
    return " ".join(f"w{i}x{n}y{k}" for k in range(words))


def test_names_hide_nothing_that_the_template_lacks(spark):
    """Names of elements on single pages hide no text of the article."""
    extra = ["<div class='social history'>S {}</div>", "<div class='ad-hoc'>H {}</div>", "<ul class='menu'><li>R {}</ul>",
             "<figure class='banner'><figcaption>C {}</figcaption></figure>", "<aside>Q {}</aside>", "<form>F {}</form>", "<nav>N {}</nav>", ""]
    pages = [f"<body><nav><a href=/>Home {i}</a></nav><div class=a1><article><h1>T {i}</h1><p>{says(i, 1)}{x.format(i)}<p>{says(i, 2)}</article></div>"
             f"<footer>foot {i}</footer>" for i, x in enumerate(extra)]
    texts, by = site(spark, pages)
    for i, x in enumerate(extra):
        own = [re.sub("<[^>]*>", "", x).format(i)] if x else []
        assert texts[i] == "\n\n".join([f"T {i}", says(i, 1), *own, says(i, 2)])
    assert set(by) == {"slot"}


def test_leads_beside_the_article_stay_and_template_texts_go(spark):
    """A lead in a sibling, a stand-first outside the article element, and
    texts that every page has, inside the article."""
    pages = [f"<body><div class=top>Site {i}</div><div class=wrap><p class=first>First {i}</p><article><div class=lead>{says(i, 1, 12)}</div>"
             f"<div class=text><p>{says(i, 2)}<p>Brought to you by Site A staff<p>{says(i, 3)}<div class=call>Call us on 555 0100</div></div>"
             f"<div class=comments><p>me {i}</div><form>Write {i}</form><div class='ad'>Buy {i}</div></article></div>" for i in range(8)]
    texts, _ = site(spark, pages)
    assert texts == ["\n\n".join([f"First {i}", says(i, 1, 12), says(i, 2), says(i, 3)]) for i in range(8)]


def test_small_hosts_are_read_by_their_domain(spark):
    page = lambda i: f"<body><div>Welcome to the site</div><div>{says(i, 1)}<p>{says(i, 2)}</div><div>Made with care</div>"
    rows = [(i, f"http://h{i}.d.example/", page(i)) for i in range(6)] + [(10 + i, f"http://o{i}.e{i}.example/", page(10 + i)) for i in range(7)]
    for r in HX.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), decided=True).collect():
        assert r.text == f"{says(r.page_id, 1)}\n\n{says(r.page_id, 2)}" and r.decided_by == "slot"
    teams = {r.host: r.team for r in HX.grouped(spark.createDataFrame(
        [("a.x.org",)] * 5 + [("b.x.org",)] * 2 + [("c.x.org",)] * 3 + [("d.y.org",), ("",)], "host string")).collect()}
    assert teams == {"a.x.org": "a.x.org", "b.x.org": "*.x.org", "c.x.org": "*.x.org", "d.y.org": "*", "": "*"}


def brute_classes(pages):
    """Tokens with equal occurrence vectors, written out, that stand in half of the pages."""
    counts = [{t: n for (t, _), (n, *_) in HX._page_tokens(HX.parse(h)).items()} for h in pages]
    classes = collections.defaultdict(set)
    for token in set().union(*counts):
        vector = tuple(c.get(token, 0) for c in counts)
        if 2 * sum(map(bool, vector)) >= len(pages):
            classes[vector].add(token)
    return {v: ts for v, ts in classes.items() if len(ts) >= HX.CLASS_SIZE}


def test_classes_equal_written_out_vectors(spark):
    pages = sorted({template_page(i, [says(i, k) for k in range(1, 3 + i % 3)]) + ("<aside>x</aside>" if i % 4 else "") for i in range(12)})
    df = spark.createDataFrame([("h", i, p) for i, p in enumerate(pages)], "host string, row long, html string")
    got = HX.templates(df).first()
    want = brute_classes(pages)
    ends = {(v, t) for v, ts in want.items() for t in ts if t.startswith("/")}
    once = {t[1:] for v, t in ends if t[1:] in want[v] and max(v) == 1}
    assert {e.path for e in got.elements if e.once} == once and len(once) > 8
    texts = {t for v, ts in want.items() for t in ts if "#" in t and sum(map(bool, v)) >= 0.8 * len(pages) and sum("#" not in x for x in ts) >= 2}
    assert {t.token for t in got.texts} == texts and len(texts) == 5


def test_given_pages_without_their_names(spark):
    """With article, nav, footer and all classes taken away the template still finds the article."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    bare = pages.withColumn("html", HX.F.regexp_replace(HX.F.regexp_replace("html", "<(/?)(article|nav|footer)>", "<$1div>"), ' class="[^"]*"', ""))
    want = {r.page_id: r.text for r in HX.extract(pages).collect()}
    got = HX.extract(bare, decided=True).collect()
    # where a host's adverts are a fair share of its text, nothing else tells them from a lead
    assert sum(r.text == want[r.page_id] for r in got) >= 0.8 * len(got) and {r.decided_by for r in got} == {"slot"}
    assert all(want[r.page_id] in r.text for r in got)


def test_template_goes_before_article_element(spark):
    """Teasers in article elements are no article; ids of headings and sections hide nothing."""
    said = lambda i, n: " ".join(f"w{i * k * n}" for k in range(1, 60))

    def page(i):
        return (f"<body><div id=top>Our Site</div><div class=cols><div class=story><header><h1>Title {i}</h1></header><section id=search>"
                f"<h2 id=related-work>Work {i}</h2><p>{said(i, 1)}</section><section><p>{said(i, 2)}</section><div class=share>mail</div></div>"
                f"<div class=c2><article><p>teaser {i}</article><article><p>other {i}</article></div></div>")

    rows = [(i, f"http://site.example/{i}", page(i)) for i in range(1, 9)]
    got = {r.page_id: r.text for r in HX.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Title {i}\n\nWork {i}\n\n{said(i, 1)}\n\n{said(i, 2)}" for i in got} and len(got) == 8


def test_copies_are_one_page(spark):
    """Copies neither become a template nor cancel out."""
    said = lambda i, k: " ".join(f"w{i * 100 + k * 10 + j}" for j in range(20))
    copy = "<body><p>Once said</p><p>and told</p></body>"
    rows = [(i, None, copy) for i in range(5)] + [(10 + i, "http://m.example/a", copy) for i in range(6)]
    rows += [(20 + i, f"http://m.example/{i}", f"<body><p>{said(i, 1)}</p><p>{said(i, 2)}</p></body>") for i in range(4)]
    # A mirror whose rows differ in a date only: its paragraphs are in no class with tags.
    rows += [(30 + i, f"http://n.example/{i}", f"<body><p>{i}</p><p>Once said</p><p>and told</p></body>") for i in range(6)]
    rows += [(40 + i, f"http://n.example/x{i}", f"<body><p>{said(i, 1)}</p></body>") for i in range(4)]
    # Each page twice, with the same id, url and html.
    twice = [(50 + i, f"http://t.example/{i}", template_page(i, [said(i, k) for k in range(1, 8)])) for i in range(6)]
    got = {r.page_id: r.text for r in HX.extract(spark.createDataFrame(rows + twice * 2, "page_id long, url string, html string")).collect()}
    assert len(got) == 31 and all(got[i] == "Once said\n\nand told" for i in [*range(5), *range(10, 16)])
    assert all(got[20 + i] == f"{said(i, 1)}\n\n{said(i, 2)}" and got[40 + i] == said(i, 1) for i in range(4))
    assert all(got[30 + i] == f"{i}\n\nOnce said\n\nand told" for i in range(6))
    assert all(got[50 + i] == "\n\n".join([f"Title {i}", *(said(i, k) for k in range(1, 8))]) for i in range(6))
    pages = spark.createDataFrame(twice, "page_id long, host string, html string").select(HX.F.lit("h").alias("host"), "html")
    one, two = (HX.templates(HX.distinct_pages(x)).first() for x in (pages, pages.unionByName(pages)))
    assert one == two and HX.decide(one.elements, one.texts).root.endswith("div.c1")


# -- pipeline -----------------------------------------------------------------


def brute_pipeline(docs, verdict):
    kept = [d for d in docs if verdict[d[0]]]
    first = {}
    for d in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", d[1] or ""), d)
    kept = sorted(first.values())
    classes = near_classes([t for _, t in kept])
    return [d for k, d in enumerate(kept) if classes[k] == k]


def test_pipeline(spark):
    docs = read(spark, "documents")
    verdict = {r.doc_id: r.kept for r in QUERIES["op5_quality_rules"](spark, SF).collect()}
    assert not any(verdict[r.doc_id] for r in docs.collect() if brute_counts(r.text)[0] < 20)
    want = brute_pipeline([(r.doc_id, r.text) for r in docs.collect()], verdict)
    rows, at = [], docs
    for name, stage in CP.STAGES[:-1]:
        at = stage(spark, at, SF)
        assert at.columns == docs.columns
    masked = {r.doc_id: r.text for r in at.collect()}
    assert sorted(masked) == [i for i, _ in want]
    for i, text in want:
        assert (masked[i] == text) == (brute_spans(text) == "") and brute_spans(masked[i]) == ""
    rows = CP.run(spark, SF).collect()
    assert ids(rows) == sorted(masked) and all(r.n_tokens <= r.bucket_len for r in rows)


def test_pipeline_odd_rows(spark):
    at = odd(spark)
    for name, stage in CP.STAGES[:-1]:
        at = stage(spark, at, SF)
        assert at.columns == odd(spark).columns
    left = at.collect()
    assert ids(left) == [14, 17] and left[0].kept == "x"
    assert next(r.text for r in left if r.doc_id == 17).endswith("CLEAN59 [SECRET] end")
    at = empty(spark)
    for name, stage in CP.STAGES:
        at = stage(spark, at, SF)
    assert at.count() == 0
