"""Operators 2 and 6: exact and near duplicates against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from edicto.llm import bag_minhash as BM
from edicto.llm import exact_dedup as XD
from edicto.llm import near_dedup as ND
from edicto.llm.components import components
from tests.llm.util import ODD_IDS, SCHEMA, empty, ids, multiset, near_classes, odd, read


def sha(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def last(i):
    return (i is None, i or 0)


def test_exact_rows(spark):
    for docs in (odd(spark), read(spark, "documents")):
        rows = docs.collect()
        groups = collections.defaultdict(list)
        for r in rows:
            groups[sha(r.text)].append(r.doc_id)
        got = XD.dedup_rows(docs).select("*", F.lower(F.hex("digest")).alias("sha")).collect()
        assert ids(got) == ids(rows)
        kept = collections.Counter()
        for r in got:
            own = groups[r.sha]
            assert (r.group_size, r.keep_id) == (len(own), min(own, key=last))
            assert not r.kept or r.doc_id == r.keep_id
            kept[r.sha] += r.kept
        assert set(kept.values()) == {1} and set(kept) == set(groups)


def test_index_persists(spark):
    docs, table = read(spark, "documents"), XD.new_index_name()
    first = XD.dedup_rows(docs.filter("doc_id < 120"), table, 4).collect()
    size = spark.table(table).count()
    again = XD.dedup_rows(docs.filter("doc_id < 120"), table, 4).collect()
    assert spark.table(table).count() == size and not any(r.kept for r in again)
    assert {r.doc_id: r.keep_id for r in first} == {r.doc_id: r.keep_id for r in again}
    later = XD.dedup_rows(docs, table, 4).collect()
    own = {sha(r.text): r.doc_id for r in reversed(docs.filter("doc_id < 120").orderBy("doc_id").collect())}
    texts = {r.doc_id: sha(r.text) for r in docs.collect()}
    for r in later:
        if texts[r.doc_id] in own:
            assert not r.kept and r.keep_id == own[texts[r.doc_id]]
    assert spark.table(table).count() == len(set(texts.values()))


def test_repeat_after_failure(spark, monkeypatch):
    """A batch that failed behind the append keeps its rows when it is repeated under its name."""
    docs, table, append = read(spark, "documents"), XD.new_index_name(), XD.append_new
    XD.dedup_rows(docs.filter("doc_id < 60"), table, 4, batch="one")
    want = XD.dedup_rows(docs.filter("doc_id < 60"), batch="one").filter("kept").count()

    def fails(*args):
        append(*args)
        raise RuntimeError("behind the append")

    monkeypatch.setattr(XD, "append_new", fails)
    with pytest.raises(RuntimeError):
        XD.exact_dedup(docs, table, 4, batch="two")
    monkeypatch.undo()
    size = spark.table(table).count()
    again = ids(XD.exact_dedup(docs, table, 4, batch="two").collect())
    assert spark.table(table).count() == size and len(again) == size - want > 0
    assert not XD.exact_dedup(docs, table, 4, batch="three").count()


@pytest.mark.parametrize("partitions", [3, 8, 40])
def test_index_lasts_across_shuffle_settings(spark, partitions):
    docs, table, was = read(spark, "documents"), XD.new_index_name(), spark.conf.get("spark.sql.shuffle.partitions")
    first = XD.dedup_rows(docs.filter("doc_id < 120"), table, 5).filter("kept").count()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        later = XD.dedup_rows(docs, table).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert first + sum(r.kept for r in later) == len({sha(r.text) for r in docs.collect()}) == spark.table(table).count()
    assert XD.index_buckets(spark, table, 99) == 5


def test_batches_equal_one_run(spark):
    """Batches in the order of their ids give the rows of one run, whatever they share, and leave no index."""
    tables = {t.name for t in spark.catalog.listTables()}
    for docs in (odd(spark), read(spark, "documents"), empty(spark)):
        cols = ["doc_id", "keep_id", "group_size", "kept", "digest"]
        cut = [F.col("doc_id") <= 3, F.col("doc_id").between(4, 90), F.coalesce(F.col("doc_id") > 90, F.lit(True))]
        got = XD.dedup_batches([docs.filter(c) for c in cut]).select(*cols)
        key = lambda r: str(tuple(r))
        assert sorted(got.collect(), key=key) == sorted(XD.dedup_rows(docs).select(*cols).collect(), key=key)
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_index_side_is_not_shuffled(spark):
    table = XD.new_index_name()
    XD.dedup_rows(read(spark, "documents"), table, 8)
    groups = spark.table(table).select("digest").join(spark.table(table).select("digest").hint("merge"), "digest", "left_anti")
    assert "Exchange hashpartitioning" not in groups._jdf.queryExecution().executedPlan().toString()


def test_exact_dedup_keeps_columns(spark):
    docs = odd(spark)
    out = XD.exact_dedup(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len({sha(r.text) for r in docs.collect()}) == len({sha(r.text) for r in rows})
    assert XD.exact_dedup(empty(spark)).count() == 0 and XD.dedup_rows(empty(spark)).count() == 0


def edited(n, seed):
    """A large group of near copies on both sides of the threshold, copies, and others."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    out += out[:20] + [" ".join(f"y{rng.randrange(9000)}" for _ in range(60)) + " " + " ".join(base[:40]) for _ in range(30)]
    line = " ".join(f"l{i}" for i in range(9))
    return out + [" ".join([line] * k) for k in (8, 9, 10, 30, 31, 40)] + ["one two", "one two", "two one", "", "  "]


def check_classes(rows, docs):
    want = near_classes([t for _, t in docs])
    members = collections.defaultdict(list)
    for (i, _), c in zip(docs, want):
        members[c].append(i)
    by_id = {i: (min(members[c]), len(members[c])) for (i, _), c in zip(docs, want)}
    assert {r.doc_id: (r.class_id, r.class_size) for r in rows} == by_id
    assert sum(r.kept for r in rows) == len(members)


def test_near_classes_of_a_large_group(spark):
    docs = list(enumerate(edited(150, 5)))
    random.Random(1).shuffle(docs)
    rows = ND.near_rows(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in docs], SCHEMA)).collect()
    check_classes(rows, docs)


def test_near_classes_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(ND, "TILE_ITEMS", 700)
    docs = list(enumerate(edited(60, 8)))
    check_classes(ND.near_rows(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in docs], SCHEMA)).collect(), docs)


def test_near_classes_of_documents(spark):
    docs = read(spark, "documents")
    check_classes(ND.near_rows(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_near_odd_rows(spark):
    docs = odd(spark)
    rows = ND.near_rows(docs).collect()
    assert ids(rows) == ODD_IDS
    by = collections.defaultdict(list)
    for r in rows:
        by[r.class_id].append(r)
    assert len(by[1]) == 4 and sum(r.kept for r in by[1]) == 1 and all(r.class_size == 4 for r in by[1])
    assert len(by[4]) == 4 and len(by[8]) == 2  # no words; the long texts
    out = ND.near_dedup(docs)
    assert out.columns == docs.columns and out.count() == len(by)
    assert ND.near_rows(empty(spark)).count() == 0 and ND.near_dedup(empty(spark)).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng, errors = random.Random(2), []
    for trial in range(60):
        w = [f"{trial}-{rng.randrange(60)}" for _ in range(90)]
        v = [x if rng.random() > 0.03 else f"z{rng.random()}" for x in w] + (" a b c d e f" * rng.randrange(6)).split()
        texts = [" ".join(w) + " a b c d e f" * rng.randrange(6), " ".join(v)]
        a, b = map(multiset, texts)
        sig = BM.signatures(2, *BM.shingles(texts))
        errors.append(float((sig[0] == sig[1]).mean()) - len(a & b) / len(a | b))
        x, y = (set(s.tolist()) for s in BM.occurrences(texts))
        assert len(x & y) == len(a & b) and len(x | y) == len(a | b)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.06


def test_components_of_a_path_and_a_star(spark):
    links = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("b", f"c{i}") for i in range(30)] + [("d", "d"), (None, "e")]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert all(got[f"{i:03}"] == "000" for i in range(41)) and all(got[f"c{i}"] == "b" for i in range(30))
    assert "e" not in got and components(spark.createDataFrame([], "a string, b string")).count() == 0
