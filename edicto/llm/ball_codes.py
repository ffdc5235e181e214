"""Vector compression by product codes with ball k-means (operator 13).

Vectors of whole components are cut into PARTS equal parts; each part position
has a codebook of ENTRIES entries, trained by ROUNDS rounds of k-means.  Every
vector keeps its codes from round to round.  In a round each task forms the
ball of every entry from the parts it holds: radius, the greatest distance of
a member to the entry as it is now.  Only entries nearer than twice the radius
are neighbours.  A member whose doubled distance is below that of the nearest
neighbour lies in the stable core and is not compared at all.  The others lie
in rings: a member's candidates are the neighbours up to its doubled distance,
found by a binary search in the entry's sorted neighbours, and exactly these
are compared.  All of it in whole numbers, where an entry left out is strictly
farther, so the codes are those of the plain method, ties included.

A task writes its vectors with their new codes, and one row of sums and counts
per (part, entry); these are added up in groups of tasks, so the driver gets a
fixed amount whatever the input.  A round's table replaces the one before.

Defined results: vectors that are null or hold a null or non-finite component
(also after scaling) are dropped; all vectors have the components of the
longest one, rounded up to a multiple of PARTS (PARTS at least), shorter ones
have zeros at their end; the first codebook takes the smallest ids, a null id
last, rows of one id by their bytes; with fewer vectors it has fewer entries; equal
labels include nulls; errors and their sums beyond a long's range count as its
end; repeated rows are kept; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicto.llm.common import discard, release, scratch_path, written
from edicto.llm.vectors import integer_vectors, unpack

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Sums of tasks are added up in so many groups before they reach the driver.
GROUPS = 32
#: A label is hot if it holds over one row in HOT; so at most HOT of them exist.
HOT = 1000
LONG = (1 << 63) - 1


def whole(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as whole numbers in which squared distances are exact: longs, or
    Python's integers where a long could overflow."""
    high = max(float(np.abs(x).max(initial=0)), *(abs(float(v)) for v in books.ravel().tolist())) if books.size else 0.0
    if 4 * high * high * x.shape[-1] * PARTS < 2.0 ** 62:
        return x.astype(np.int64), books.astype(np.int64)
    as_int = np.vectorize(int, otypes=[object])
    return (as_int(x) if x.size else x.astype(object)), books.astype(object)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return ((x - y) ** 2).sum(axis=-1)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part and its squared distance, by all entries."""
    code, dist = np.zeros(len(x), np.int64), squared(x, book[0])
    for j in range(1, len(book)):
        d = squared(x, book[j])
        less = (d < dist).astype(bool)  # ties stay with the lower index
        code[less], dist[less] = j, d[less]
    return code, dist


def ball_nearest(x: np.ndarray, book: np.ndarray, was: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """As `nearest`, from the entries the parts were assigned to; also how many
    distances to other entries were needed."""
    code, dist, compared = was.copy(), squared(x, book[was]), 0
    order = np.argsort(was, kind="stable")
    cuts = np.searchsorted(was[order], np.arange(len(book) + 1))
    for i in range(len(book)):
        ball = order[cuts[i]:cuts[i + 1]]
        if not len(ball):
            continue
        own = dist[ball]
        between = squared(book, book[i])
        radius = own.max()
        near = [j for j in np.argsort(between, kind="stable").tolist() if j != i and between[j] <= 4 * radius]  # neighbours
        ring = np.searchsorted(between[near], 4 * own, side="right") if near else np.zeros(len(ball), np.int64)
        for m, j in enumerate(near):  # the stable core has ring 0
            some = ball[ring > m]
            if not len(some):
                break
            compared += len(some)
            d = squared(x[some], book[j])
            less = ((d < dist[some]) | ((d == dist[some]) & (j < code[some]))).astype(bool)
            code[some[less]], dist[some[less]] = j, d[less]
    return code, dist, compared


def assign(x: np.ndarray, books: np.ndarray, was: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances (vectors x parts) of the vectors `x`."""
    parts = x.reshape(len(x), PARTS, -1)
    codes, dists = np.zeros((len(x), PARTS), np.int64), np.zeros((len(x), PARTS), x.dtype)
    for p in range(PARTS):
        codes[:, p], dists[:, p] = nearest(parts[:, p], books[p]) if was is None else ball_nearest(parts[:, p], books[p], was[:, p])[:2]
    return codes, dists


class Sums:
    """Counts and component sums per (part, entry), in Python's integers."""

    def __init__(self, entries: int, width: int):
        self.n = [[0] * entries for _ in range(PARTS)]
        self.s = [[[0] * width for _ in range(entries)] for _ in range(PARTS)]

    def add(self, x: np.ndarray, codes: np.ndarray) -> None:
        parts = x.reshape(len(x), PARTS, -1)
        for p in range(PARTS):
            for i in np.unique(codes[:, p]).tolist():
                own = codes[:, p] == i
                self.put(p, i, int(own.sum()), [int(v) for v in parts[own, p].sum(axis=0)])

    def put(self, p: int, i: int, n: int, s: list[int]) -> None:
        self.n[p][i] += n
        self.s[p][i] = [a + b for a, b in zip(self.s[p][i], s)]

    def merge(self, text: str) -> None:
        n, s = json.loads(text)
        for p in range(PARTS):
            for i in range(len(n[p])):
                self.put(p, i, n[p][i], s[p][i])

    def dump(self) -> str:
        return json.dumps([self.n, self.s])

    def books(self, old: np.ndarray) -> np.ndarray:
        """Floored means; an entry without parts stays."""
        new = old.copy()
        for p in range(PARTS):
            for i, n in enumerate(self.n[p]):
                if n:
                    new[p, i] = [v // n for v in self.s[p][i]]
        return new


def _step(rows: DataFrame, books: np.ndarray, width: int, last: bool) -> DataFrame:
    """One assignment.  In training: the vectors with their codes, and a row of
    `sums` for each task; at the end: `vec_id, label, code, error`."""
    shared = rows.sparkSession.sparkContext.broadcast(books)  # PARTS x ENTRIES entries
    kind = rows.schema["label"].dataType.simpleString()
    names = ["vec_id", "label", "code", "error"] if last else ["vec_id", "label", "vec", "codes", "sums"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, label_type = shared.value, None
        sums, seen = Sums(books.shape[1], books.shape[2]), False
        for batch in batches:
            n, label_type = len(batch), batch.column(1).type
            if not n:
                continue
            x, own = whole(unpack(batch.column(2).to_pylist(), width), books)
            known = batch.column(3).null_count == 0
            was = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(n, PARTS).astype(np.int64) if known else None
            codes, dists = assign(x, own, was)
            packed = [bytes(c) for c in codes.astype(np.uint8)]
            if last:
                error = [min(int(e), LONG) for e in dists.sum(axis=1)]
                cols = [batch.column(0), batch.column(1), pa.array([c.hex() for c in packed]), pa.array(error, pa.int64())]
            else:
                sums.add(x, codes)
                seen = True
                cols = [batch.column(0), batch.column(1), batch.column(2), pa.array(packed, pa.binary()), pa.nulls(n, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=names)
        if seen:
            cols = [pa.nulls(1, pa.int64()), pa.nulls(1, label_type), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([sums.dump()])]
            yield pa.RecordBatch.from_arrays(cols, names=names)
        release()

    return rows.select("vec_id", "label", "vec", "codes").mapInArrow(
        run, f"vec_id long, label {kind}, " + ("code string, error long" if last else "vec binary, codes binary, sums string"))


def _totals(table: DataFrame, entries: int, width: int) -> Sums:
    def add_up(group: pa.Table) -> pa.Table:
        total = Sums(entries, width)
        for text in group["sums"].to_pylist():
            total.merge(text)
        return pa.table({"sums": [total.dump()]})

    groups = (table.filter("sums IS NOT NULL").select("sums", F.pmod(F.xxhash64("sums"), F.lit(GROUPS)).alias("g"))
              .groupBy("g").applyInArrow(add_up, "sums string"))
    total = Sums(entries, width)
    for row in groups.collect():  # at most GROUPS rows of fixed size
        total.merge(row.sums)
    return total


def vector_codes(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
                 scale: int = SCALE, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """`vec_id, label, code, error` of every vector kept, and the codebooks
    (part x entry x component)."""
    spark = vectors.sparkSession
    label = F.col(f"`{label_col}`") if label_col else F.lit(None).cast("int")
    made = integer_vectors(vectors, scale, id_col=id_col, vec_col=vec_col, label=label).select("vec_id", "label", "vec", "size", F.lit(None).cast("binary").alias("codes"))
    path = scratch_path(spark, "codes")
    made.write.parquet(path)
    rows = spark.read.schema(made.schema).parquet(path)
    width = -(-(rows.agg(F.max("size")).first()[0] or 1) // PARTS) * PARTS
    first = [bytes(r.vec) for r in rows.orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).select("vec").collect()]
    if not first:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((PARTS, 0, 0), object)
    start = unpack(first, width).reshape(len(first), PARTS, -1).transpose(1, 0, 2)
    books = np.vectorize(int, otypes=[object])(start)
    for _ in range(rounds):
        step, new = _step(rows, books, width, False), scratch_path(spark, "codes")
        step.write.parquet(new)
        table = spark.read.schema(step.schema).parquet(new)
        books = _totals(table, *books.shape[1:]).books(books)
        discard(spark, path)
        rows, path = table.filter("sums IS NULL"), new
    out = written(_step(rows, books, width, True), "coded")
    discard(spark, path)
    return out, books


def codebooks_sha256(books: np.ndarray) -> str:
    """Digest of all components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def coded_rows(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    """`vec_id, code, error, label_error, codebooks_sha256` of every vector kept."""
    rows, books = vector_codes(vectors, id_col=id_col, vec_col=vec_col, label_col=label_col)
    most = F.lit(LONG).cast("decimal(38,0)")
    labels = written(rows.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"),
                                               F.count("*").alias("n")).withColumnRenamed("label", "of"), "label-errors")
    total = rows.count()
    hot = F.broadcast(labels.filter(F.col("n") * HOT > total))  # at most HOT labels
    cols = ["vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")]
    same = F.col("label").eqNullSafe(F.col("of"))
    return (rows.join(hot, same).select(*cols)
            .unionByName(rows.join(hot, same, "left_anti").join(labels.filter(F.col("n") * HOT <= total), same).select(*cols)))
