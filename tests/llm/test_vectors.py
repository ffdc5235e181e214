"""Operators 11 and 13 against brute force in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from edicto.llm import ball_codes as BC
from edicto.llm import top_k as TK
from edicto.llm.vectors import unpack
from tests.llm.util import CLASHES, read

SCHEMA = "vec_id long, embedding array<double>, label int"
LONG = (1 << 63) - 1


def odd_vectors(big=True):
    rng = random.Random(4)
    vec = lambda n, s=1.0: [rng.gauss(0, s) for _ in range(n)]
    base = vec(11)
    rows = [(0, base, 1), (0, base, 1), (50, base, 2), (7, base, None), (None, base, None), (3, [x * 2 for x in base], 1),
            (100, [0.0] * 11, 2), (4, [], 2), (5, None, 1), (6, [1.0, None], 1), (150, [float("nan")] * 11, 1), (8, [math.inf, 1.0], 1),
            (200, [-1.0], None), (-50, vec(3), 5), (9, vec(19), 5), (10, [1e308, 0.0], 5)]
    rows += [(11 + i, vec(11, 0.01 * (i + 1)), i % 3) for i in range(30)] + [(250 + i, [x + rng.gauss(0, 0.01) for x in base], 1) for i in range(9)]
    if big:
        rows += [(300, [1e13, -1e13, 5.0], 6), (301, [3e14, 1.0], 6), (350, [1e30], 6), (302, [-1e30, 2.0], 6), (303, [3e5] * 11, 6)]
    return rows


def numbers(rows, scale):
    out = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) and math.isfinite(scale * x) for x in v):
            out.append((i, [math.floor(scale * x) for x in v], label))
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumns({c: F.lit("x") for c in CLASHES if c != "label"})


def brute_top(rows, k, every=50):
    vs, out = numbers(rows, TK.SCALE), []
    for i, (q, x, _) in enumerate(vs):
        if q is not None and q % every == 0:
            scores = sorted((-min(max(sum(a * b for a, b in zip(x, y)), -LONG - 1), LONG), p is None, p or 0)
                            for j, (p, y, _) in enumerate(vs) if j != i)
            out += [(q, r + 1, None if null else p, -s) for r, (s, null, p) in enumerate(scores[:k])]
    return sorted(out, key=str)


def top(df, **more):
    return sorted((tuple(r) for r in TK.top_k(df, F.col("vec_id") % 50 == 0, **more).collect()), key=str)


@pytest.mark.parametrize("more", [{}, {"bucket_rows": 7, "query_rows": 2, "seeds": 3}, {"bucket_rows": 20, "seeds": 40, "k": 3}])
def test_top_k_of_odd_rows(spark, more):
    for big in (False, True):
        rows = odd_vectors(big)
        assert top(frame(spark, rows), **more) == brute_top(rows, more.get("k", TK.K))


def test_top_k_of_few_rows(spark):
    assert top(frame(spark, [(0, [1.0], 1)])) == [] and top(frame(spark, odd_vectors()).limit(0)) == []
    assert top(frame(spark, [(0, [1.0], 1), (1, [-2.0], 1)])) == [(0, 1, 1, -131072)]


def test_top_k_of_table(spark):
    docs = read(spark, "embeddings")
    assert top(docs, bucket_rows=60) == brute_top([tuple(r) for r in docs.select("vec_id", "embedding", "label").collect()], TK.K)


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n // 8, d))
    x = np.repeat(centre, 8, axis=0)[:n] + 0.01 * rng.normal(size=(n, d))
    x[::9] = rng.normal(size=x[::9].shape)  # like no other vector
    return np.floor(2560 * x / np.linalg.norm(x, axis=1)[:, None] * rng.uniform(0.98, 1, size=(n, 1)))


def test_bucket_routes_are_exact(monkeypatch):
    """Whatever route the bucket picks, what reaches the threshold is found; on
    groups of like vectors both routes are taken, and coordinates scan few rows."""
    x = clustered(640, 24, 1)
    order = np.argsort(-np.linalg.norm(x, axis=1))
    scanned, whole = [], TK.Bucket.by_coordinates

    def counted(self, unit, local):
        out = whole(self, unit, local)
        scanned.append(len(out) / len(self.rows))
        return out

    monkeypatch.setattr(TK.Bucket, "by_coordinates", counted)
    for own in (order, order[:160], order[160:]):
        bucket = TK.Bucket(own, own, np.zeros(len(own), bool), x[own])
        scores = x @ x[own].T
        scores[np.arange(640)[:, None] == own[None, :]] = -np.inf
        theta = np.sort(scores, axis=1)[:, -3]
        theta[::5] = -np.inf
        i, place, score = TK.search(np.arange(640), x, theta, bucket, 5)
        for q in range(640):
            want = sorted(((-s, p) for s, p in zip(scores[q], own) if s >= theta[q] and np.isfinite(s)))[:5]
            assert sorted(zip((-score[i == q]).tolist(), own[np.argsort(-np.linalg.norm(x[own], axis=1), kind="stable")][place[i == q]].tolist())) == want
    assert 100 < len(scanned) < 3 * 512 and np.mean(scanned) < 0.1


def brute_codes(rows):
    kept = sorted(numbers(rows, BC.SCALE), key=lambda r: (r[0] is None, r[0] or 0))
    width = -(-max([len(v) for _, v, _ in kept] + [1]) // 8) * 8
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in kept]
    w = width // 8
    part = lambda v, p: v[p * w:(p + 1) * w]
    books = [[part(v, p) for _, v, _ in kept[:16]] for p in range(8)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((dist(part(v, p), e), j) for j, e in enumerate(books[p])) for p in range(8)] for _, v, _ in kept]

    for _ in range(6):
        codes = assign()
        for p in range(8):
            for j in range(len(books[p])):
                own = [part(v, p) for (_, v, _), c in zip(kept, codes) if c[p][1] == j]
                if own:
                    books[p][j] = [sum(xs) // len(own) for xs in zip(*own)]
    codes = assign()
    error = [sum(d for d, _ in c) for c in codes]
    by = {}
    for (_, _, label), e in zip(kept, error):
        by[label] = by.get(label, 0) + min(e, LONG)
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{j:02x}" for _, j in c), min(e, LONG), min(by[label], LONG), sha) for (i, _, label), c, e in zip(kept, codes, error)), key=str)


def coded(df):
    return sorted((tuple(r) for r in BC.coded_rows(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def unique_ids(rows):
    """One row of an id, as the first codebook takes rows of one id by their bytes."""
    return [r for n, r in enumerate(rows) if r[0] not in [x[0] for x in rows[:n]]]


def test_codes_of_odd_rows(spark):
    for big in (False, True):
        rows = unique_ids(odd_vectors(big))
        assert coded(frame(spark, rows)) == brute_codes(rows)
    copies = odd_vectors(False)
    assert len(coded(frame(spark, copies))) == len(numbers(copies, BC.SCALE))


def test_codes_of_few_rows(spark):
    assert coded(frame(spark, odd_vectors()).limit(0)) == []
    for rows in ([(4, [], 1)], [(1, [0.5], None), (2, [0.5], None), (None, [-3.0, 1.0], 2)]):
        assert coded(frame(spark, rows, 1)) == brute_codes(rows)


def test_codes_of_table(spark):
    docs = read(spark, "embeddings")
    assert coded(docs) == brute_codes([tuple(r) for r in docs.select("vec_id", "embedding", "label").collect()])
    assert "label_error" in BC.coded_rows(docs, label_col=None).columns


def test_balls_skip_work_and_keep_ties():
    rng = np.random.default_rng(2)
    centre = rng.integers(-500, 500, size=(16, 6))
    x = (centre[rng.integers(0, 16, 4000)] + rng.integers(-40, 40, size=(4000, 6)))
    book = centre + rng.integers(-20, 20, size=centre.shape)
    book[5] = book[2]  # equal entries: the lower index wins
    was = BC.nearest(x, book + rng.integers(-9, 9, size=book.shape))[0]
    code, dist, compared = BC.ball_nearest(x, book, was)
    want, far = BC.nearest(x, book)
    assert (code == want).all() and (dist == far).all() and compared < 0.2 * 15 * len(x) and not (code == 5).any()
    line = np.arange(-50, 50).reshape(-1, 1)  # half-way points
    book = np.array([[10], [-10], [30], [-30]])
    for was in (np.zeros(100, int), np.full(100, 3), rng.integers(0, 4, 100)):
        assert (BC.ball_nearest(line, book, was)[0] == BC.nearest(line, book)[0]).all()


def test_unpack():
    assert unpack([b"\x00\x01\x00", b"\x01\x01\x00\x00\x00\x02\x00\x00\x00"]).tolist() == [[1, 0], [1, 2]]
    assert unpack([], 3).shape == (0, 3)
