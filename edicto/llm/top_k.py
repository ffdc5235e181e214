"""Exact top-k inner products by norm-bucketed retrieval (operator 11).

All vectors are put in order of their length and cut into buckets of vectors
of like length.  A query starts with a threshold: its k-th best score against
SEEDS of the longest vectors.  Buckets come in falling length, so those that
can hold a score of the threshold (query length x greatest length in the
bucket) are the first few; the query goes to these only.  In a bucket the
local threshold is the cosine that a vector of it must reach at least.  The
bucket weighs both ways of pruning on some of its queries and takes a limit
from that: queries of a lower local threshold scan the vectors whose own
length suffices; the others keep, in sorted coordinate lists, only vectors
whose focus coordinates can reach that cosine.  All that is left is verified
by its exact product.  Bounds have a slack for rounding, and only what is
strictly below a threshold is left out, so ties survive.

Queries and vectors meet in blocks (query block x bucket), so no task holds
all of either side; what leaves a block is at most k rows a query.

Defined results: vectors that are null or hold a null or non-finite component
(also after scaling) take no part; a shorter vector counts as having zeros at
its end; a query's own row is no candidate, a repeated row is; ties go to the
smaller id, a null id last; a row with a null id is no query; scores beyond a
long's range count as its ends; fewer than k candidates give as many rows; an
empty table gives none; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from edicto.llm.common import release, written
from edicto.llm.vectors import integer_vectors, norms, unpack

SCALE = 256
K = 5
EVERY = 50
#: Vectors in a bucket and queries in a block.
BUCKET_ROWS = 8192
QUERY_ROWS = 4096
#: Longest vectors that give a query its first threshold; broadcast.
SEEDS = 2048
#: Focus coordinates, queries that a bucket tries, and the share of the rows
#: that a coordinate range must stay under to be the better way.
FOCUS, TRIALS, SHARE = 3, 16, 0.2
#: Slack of bounds, against rounding.
SLACK = 1e-9
#: Products below this are exact in doubles.
EXACT = float(1 << 53)
#: Queries multiplied at once.
CHUNK = 256
LONG = (-(1 << 63), (1 << 63) - 1)


def products(q: np.ndarray, p: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products: doubles that hold whole numbers, or (where these could
    be rounded) longs from Python's integers."""
    if not exact:
        return q @ p.T
    whole = [[int(x) for x in row] for row in p]
    out = np.empty((len(q), len(p)), dtype=np.int64)
    for i, row in enumerate(q):
        own = [int(x) for x in row]
        out[i] = [min(max(sum(a * b for a, b in zip(own, r)), LONG[0]), LONG[1]) for r in whole]
    return out


class Bucket:
    """Vectors of like length, by falling length."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, null: np.ndarray, x: np.ndarray):
        norm = norms(x)
        order = np.argsort(-norm, kind="stable")
        self.rows, self.ids, self.null, self.x, self.norm = rows[order], ids[order], null[order], x[order], norm[order]
        self.top = float(self.norm[0]) if len(rows) else 0.0
        self.by_row = np.argsort(self.rows)
        self.unit: np.ndarray | None = None
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def place(self, rows: np.ndarray) -> np.ndarray:
        """Where given rows are in the bucket, or -1."""
        i = self.by_row[np.minimum(np.searchsorted(self.rows, rows, sorter=self.by_row), len(self.rows) - 1)]
        return np.where(self.rows[i] == rows, i, -1)

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The unit vectors' values at a coordinate in order, and their places."""
        if self.unit is None:
            self.unit = self.x / np.where(self.norm > 0, self.norm, 1)[:, None]
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = self.unit[order, f], order
        return self.lists[f]

    def ranges(self, unit: np.ndarray, local: float) -> list[tuple[int, int, int, float, float]]:
        """For each focus coordinate the part of its list that can reach the
        cosine `local`: (size, from, coordinate, least, most), smallest first."""
        out = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS].tolist():
            mid, half = unit[f] * local, float(np.sqrt(max(0.0, 1 - unit[f] ** 2) * max(0.0, 1 - local ** 2)))
            least, most = mid - half - SLACK, mid + half + SLACK
            values, _ = self.coordinate(f)
            i, j = np.searchsorted(values, least), np.searchsorted(values, most, side="right")
            out.append((int(j - i), int(i), f, least, most))
        return sorted(out)

    def limit(self, unit: np.ndarray, local: np.ndarray, reach: np.ndarray) -> float:
        """The local threshold from which on coordinates prune better than
        lengths, from trials on some of the queries; above 1 if none do."""
        use = np.flatnonzero(local > 0)
        use = use[np.argsort(local[use], kind="stable")]
        use = use[np.unique(np.linspace(0, len(use) - 1, TRIALS).astype(int))] if len(use) else use
        at = 2.0
        for i in use[::-1].tolist():
            if self.ranges(unit[i], float(local[i]))[0][0] > SHARE * reach[i]:
                break
            at = float(local[i])
        return at

    def by_coordinates(self, unit: np.ndarray, local: float) -> np.ndarray:
        """Places of the vectors whose focus coordinates can reach `local`."""
        (size, i, f, *_), *others = self.ranges(unit, local)
        places = self.lists[f][1][i:i + size]
        for _, _, g, least, most in others:
            v = self.unit[places, g]
            places = places[(v >= least) & (v <= most)]
        return places


def best(scores: np.ndarray, ids: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """The k places of highest score, ties to the smaller id, a null id last."""
    return np.lexsort((ids, null, ~scores))[:k]


def search(rows: np.ndarray, q: np.ndarray, theta: np.ndarray, bucket: Bucket, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, place, score) of up to k candidates a query that reach its threshold."""
    none = np.zeros(0, np.int64)
    if not len(rows) or not len(bucket.rows):
        return none, none, none
    length = norms(q)
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        reach = length * bucket.top
        local = np.where(reach > 0, theta / reach, np.where(theta > 0, np.inf, -np.inf))
        need = np.where(length > 0, theta / length, -np.inf)
    exact = not reach.max() < EXACT
    own = bucket.place(rows)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def take(i: int, places: np.ndarray, scores: np.ndarray) -> None:
        there = (scores >= theta[i]) & (places != own[i])
        places, scores = places[there], scores[there].astype(np.int64)
        top = best(scores, bucket.ids[places], bucket.null[places], k)
        found.append((np.full(len(top), i), places[top], scores[top]))

    # a float that is not a number never prunes
    alive = np.flatnonzero(~(local > 1 + SLACK))
    prefix = np.searchsorted(-bucket.norm, -(need * (1 - SLACK * np.sign(need))), side="right")
    prefix = np.where(np.isnan(need), len(bucket.norm), prefix)
    unit = q / np.where(length > 0, length, 1)[:, None]
    limit = 2.0 if exact else bucket.limit(unit[alive], local[alive], prefix[alive])
    narrow = (local[alive] >= limit) & (local[alive] > 0)
    for i in alive[narrow].tolist():
        places = bucket.by_coordinates(unit[i], float(min(local[i], 1.0)))
        take(i, places, bucket.x[places] @ q[i])
    wide = alive[~narrow]
    wide = wide[np.argsort(prefix[wide], kind="stable")]
    for at in range(0, len(wide), CHUNK):
        some = wide[at:at + CHUNK]
        n = int(prefix[some].max())
        scores = products(q[some], bucket.x[:n], exact)
        for i, row in zip(some.tolist(), scores):
            places = np.flatnonzero(row >= theta[i])
            if len(places) > 4 * k:  # one more than k, as the query's own row may be among them
                cut = np.partition(row[places], -(k + 1))[-(k + 1)]
                places = places[row[places] >= cut]
            take(i, places, row[places])
    if not found:
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _ids(column) -> tuple[np.ndarray, np.ndarray]:
    null = np.asarray(column.is_null())
    return np.asarray(column.fill_null(0), dtype=np.int64), null


def _bucket(table) -> Bucket:
    ids, null = _ids(table["vec_id"])
    return Bucket(np.asarray(table["row_id"], dtype=np.int64), ids, null, unpack(table["vec"].to_pylist()))


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, w - x.shape[1]))) if x.shape[1] < w else x for x in (a, b))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, *, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE,
          bucket_rows: int = BUCKET_ROWS, query_rows: int = QUERY_ROWS, seeds: int = SEEDS) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k highest integer products of each
    query; `is_query` is a condition on `vec_id`."""
    spark = vectors.sparkSession
    rows = written(integer_vectors(vectors, scale, id_col=id_col, vec_col=vec_col), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.coalesce(F.sum(is_query.cast("long")), F.lit(0))).first()
    buckets, blocks = -(-n // bucket_rows) or 1, -(-n_queries // query_rows) or 1
    own = written(rows.repartitionByRange(buckets, F.desc("norm"), "row_id").withColumn("bucket", F.spark_partition_id()), "norm-buckets")
    # one number for each bucket of vectors, and at most `seeds` vectors
    tops = [(r.bucket, r.top) for r in own.groupBy("bucket").agg(F.max("norm").alias("top")).orderBy("bucket").collect()]
    first = own.orderBy(F.desc("norm"), "row_id").limit(seeds).select("row_id", "vec_id", "vec").toArrow()
    shared = spark.sparkContext.broadcast((first, np.array([b for b, _ in tops], dtype=np.int64), np.array([t for _, t in tops])))

    def start(batches):
        first, numbers, top = shared.value
        for batch in batches:
            table = pa.Table.from_batches([batch])
            q = unpack(table["vec"].to_pylist())
            if not len(q):
                continue
            seed = _bucket(first)
            q, seed.x = _same_width(q, seed.x)
            theta = np.full(len(q), -np.inf)
            i, _, score = search(np.asarray(table["row_id"]), q, theta, seed, k)
            count = np.bincount(i, minlength=len(q))
            order = np.lexsort((~score, i))  # by query, best first
            full = np.flatnonzero(count >= k)
            low = score[order][(np.cumsum(count) - count + k - 1)[full]]
            theta[full] = [x - (abs(x) * SLACK if abs(x) >= EXACT else 0) for x in low.astype(float).tolist()]
            length = norms(q)
            with np.errstate(over="ignore", invalid="ignore"):
                goes = [numbers[~(length[j] * top * (1 + SLACK) < theta[j])] for j in range(len(q))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(theta), pa.array(goes, pa.list_(pa.int64()))],
                                             names=["q_row", "query_id", "q_vec", "theta", "buckets"])
        release()

    queries = (rows.filter(is_query).select("row_id", "vec_id", "vec")
               .mapInArrow(start, "q_row long, query_id long, q_vec binary, theta double, buckets array<long>"))
    queries = (queries.withColumn("block", F.pmod(F.xxhash64("q_row"), F.lit(blocks)))
               .select("q_row", "query_id", "q_vec", "theta", "block", F.explode("buckets").alias("bucket")))
    sides = own.select("row_id", "vec_id", "vec", F.col("bucket").cast("long").alias("bucket"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"q_row": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        bucket, q = _bucket(right), unpack(left["q_vec"].to_pylist())
        q, bucket.x = _same_width(q, bucket.x)
        row, query = np.asarray(left["q_row"]), np.asarray(left["query_id"])
        i, place, score = search(row, q, np.asarray(left["theta"]), bucket, k)
        return pa.table({"q_row": pa.array(row[i]), "query_id": pa.array(query[i]), "vec_id": pa.array(bucket.ids[place], mask=bucket.null[place]),
                         "score": pa.array(score)})

    found = (queries.groupBy("bucket", "block").cogroup(sides.groupBy("bucket", "block"))
             .applyInArrow(meet, "q_row long, query_id long, vec_id long, score long"))
    order = W.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
