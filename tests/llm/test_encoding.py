"""Operators 1 and 7 against the tokenizers library and brute force."""

import hashlib
import itertools
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from edicto.llm import bpe, packing
from edicto.llm.common import text_slices
from tests.llm.util import ODD_IDS, empty, ids, odd, read

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def own():
    return bpe.PairIndexBpe(bpe.read_spec(FILE))


def expected(library, doc_id, text):
    ids_ = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids_, skip_special_tokens=False)
    return (doc_id, len(ids_), hashlib.sha256(struct.pack(f"<{len(ids_)}I", *ids_)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_encode_matches_library(spark, library):
    for docs in (odd(spark), read(spark, "documents")):
        got = sorted(map(str, map(tuple, bpe.encode(spark, docs, FILE).collect())))
        want = sorted(str(expected(library, r.doc_id, r.text)) for r in docs.collect())
        assert got == want


def test_decode_round_trip(spark):
    docs = odd(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    back = bpe.decode(spark, bpe.encode(spark, docs, FILE, out="ids"), FILE)
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text or "" for r in docs.collect()}


def test_empty_table(spark):
    assert bpe.encode(spark, empty(spark), FILE).count() == 0
    assert packing.pack_documents(spark, empty(spark), FILE).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aab'sll 1²\n\t\u00a0\u3000éß日🙂_.<|>endoftext\x1c")), max_size=40), min_size=1, max_size=5))
def test_any_text(library, own, texts):
    for t, got in zip(texts, own.encode_batch(texts)):
        want = library.encode(t, add_special_tokens=False).ids
        assert got.tolist() == want
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_overlapping_pairs_and_long_text_in_pieces(library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 50)
    small = bpe.PairIndexBpe(bpe.read_spec(FILE))
    for t in ("a" * 99, " ".join("don't stop  now" for _ in range(60)), "é " * 300 + "<|endoftext|>" + "x " * 200):
        assert small.encode_batch([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids
    assert small.count_batch(["aaaa", ""]) == [len(library.encode("aaaa").ids), 0]


def test_lengths_equal_the_pair_index(spark, own):
    docs = [r.text for r in read(spark, "documents").collect()]
    odd_texts = ["", "a<|endoftext|>b <|endoftext|>", "x" + " " * 5000 + "y", "\n\t " * 1500, "é🙂 ß" * 50, "don't  stop\u3000now"]
    texts = [t or "" for t in docs] + odd_texts
    v = bpe.read_spec(FILE)
    assert packing.rank_encoder(v) is not None
    assert packing.count_tokens(v, texts) == own.count_batch(texts)
    v.made = v.made[::-1].copy()  # ids that aren't ranks: no rank encoder
    assert packing.rank_encoder(v) is None


def test_lengths_cover_odd_rows(spark):
    got = packing.token_lengths(spark, odd(spark), FILE).collect()
    want = bpe.encode(spark, odd(spark), FILE, out="lengths").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_text_slices_cover_a_column():
    column = pa.array(["ab", None, "", "cdefgh", "i", "é"])
    for limit in (1, 3, 100):
        parts = list(text_slices(column, limit))
        assert [t for *_, p in parts for t in p] == ["ab", "", "", "cdefgh", "i", "é"]
        assert [0, *(j for _, j, _ in parts)] == [*(i for i, *_ in parts), 6]
    assert list(text_slices(pa.array([], pa.string()), 3)) == []


def test_boundaries_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(30):
        top = np.unique(rng.integers(1, 60, 8))
        count = rng.integers(1, 9, len(top))
        for k in (1, 2, 3, 20):
            ends = packing.best_boundaries(top, count, top * count, k)
            cost = lambda e: sum(c * (min(x for x in e if x >= t) - t) for t, c in zip(top, count))
            least = min(cost([*c, top[-1]]) for n in range(min(k, len(top))) for c in itertools.combinations(top[:-1], n))
            assert ends[-1] == top[-1] and len(ends) <= k and cost(ends) == least


def test_batches(spark):
    for docs in (odd(spark), read(spark, "documents")):
        rows = packing.pack_documents(spark, docs, FILE, buckets=4, budget=3000).collect()
        assert ids(rows) == ids(docs.collect())
        seen, per = set(), {}
        for r in rows:
            assert r.n_tokens <= r.bucket_len and (r.bucket, r.batch, r.slot) not in seen
            seen.add((r.bucket, r.batch, r.slot))
            per.setdefault((r.bucket, r.batch), []).append(r)
        for (bucket, batch), own in per.items():
            assert len(own) * own[0].bucket_len <= 3000 or len(own) == 1
            assert sorted(r.slot for r in own) == list(range(len(own)))
            full = max(1, 3000 // max(1, own[0].bucket_len))
            assert len(own) == full or (bucket, batch + 1) not in per


def test_bins_are_ordered(spark):
    bins = [r[0] for r in spark.range(0, 60_000, 7).select(packing.length_bin(F.col("id"))).collect()]
    assert bins == sorted(bins) and max(bins) < packing.EXACT + 5 * packing.STEPS


def test_odd_ids_kept(spark):
    assert ids(bpe.encode(spark, odd(spark), FILE, out="lengths").collect()) == ODD_IDS
