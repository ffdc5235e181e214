"""Packing into optimal length buckets (operator 7).

Lengths are token counts of a byte-level BPE vocabulary, taken by a rank encoder
(the same ids); texts that it can't take, or that hold a special token, go
through the pair index of operator 1.  A global histogram of lengths goes to a dynamic program that chooses the
bucket boundaries with the least padding.  Batches of a token budget then form
inside each bucket: a document's place in its bucket is the number of such
documents in earlier shards plus its place in its own shard, so batches are
full but for a bucket's last one and no task holds a whole bucket.

The histogram has one bin per length below EXACT and STEPS bins per doubling
beyond, so its size does not grow with the documents.  A bin's boundary is the
greatest length in it: nothing is cut, every document fits its bucket, and the
boundaries are optimal among the bins' edges.

Defined results: null or empty texts have length 0 and are packed too; ties
keep the order of the rows as stored; a document longer than the budget forms
a batch of its own; repeated rows are packed each; an empty table gives none.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from edicto.llm.bpe import Vocabulary, built, read_spec
from edicto.llm.common import held, id_of, release, text_of, text_slices, written
from edicto.llm.secrets import PATTERN

BUCKETS = 16
BUDGET = 65_536
EXACT = 2048
STEPS = 64
#: Bytes of texts counted at once.
SLICE = 4_000_000
#: tiktoken's splitter recurses along white space.
LONG_SPACE = re.compile(r"\s{2000}")


def rank_encoder(v: Vocabulary) -> tiktoken.Encoding | None:
    """The vocabulary as a rank encoder; None where an id isn't its entry's rank."""
    n = 256 + len(v.made)
    if sorted(v.of_byte.tolist()) != list(range(256)) or (v.made != np.arange(256, n)).any():
        return None
    data, ends = v.token_bytes.tobytes(), np.cumsum(v.token_len)[:n]
    ranks = {data[a:b]: i for i, (a, b) in enumerate(zip((ends - v.token_len[:n]).tolist(), ends.tolist()))}
    if len(ranks) < n:
        return None
    return tiktoken.Encoding("lengths", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(v: Vocabulary, texts: list[str]) -> list[int]:
    """The number of tokens of each text."""
    fast = held(f"lengths {v.name}", lambda: rank_encoder(v))

    def count(t: str) -> int:
        if fast is None or any(s in t for s in v.special) or LONG_SPACE.search(t):
            return built(v).count_batch([t])[0]
        return len(fast.encode_ordinary(t))

    return [count(t) for t in texts]


def token_lengths(spark: SparkSession, docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """`doc_id, n_tokens` of every whole text."""
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))  # of fixed size

    def run(batches):
        for batch in batches:
            for i, j, texts in text_slices(batch.column(1), SLICE):
                lens = pa.array(count_tokens(spec.value, texts), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lens], names=["doc_id", "n_tokens"])
        release()

    return docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long")


def length_bin(n: Column) -> Column:
    """Bins are ordered as their lengths."""
    high = EXACT + F.floor(F.log2(n / F.lit(float(EXACT))) * STEPS)
    return F.when(n < EXACT, n).otherwise(high).cast("long")


def best_boundaries(top: np.ndarray, count: np.ndarray, total: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most `buckets` buckets with the least padding.

    top: greatest length of each bin, ascending; count and total: documents
    and tokens in it.
    """
    n = len(top)
    rows = np.concatenate([[0], np.cumsum(count)]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum(total)]).astype(np.float64)
    best = np.full(n + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        nxt, cut = best.copy(), np.full(n + 1, -1)  # -1: as good with fewer buckets
        for j in range(1, n + 1):
            cost = best[:j] + (rows[j] - rows[:j]) * top[j - 1] - (tokens[j] - tokens[:j])
            i = int(np.argmin(cost))
            if cost[i] < nxt[j]:
                nxt[j], cut[j] = cost[i], i
        cuts.append(cut)
        best = nxt
    out, j, b = [], n, len(cuts) - 1
    while j > 0:
        if cuts[b][j] >= 0:
            out.append(int(top[j - 1]))
            j = int(cuts[b][j])
        b -= 1
    return out[::-1]


def pack(lengths: DataFrame, *, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """`doc_id, n_tokens, bucket, bucket_len, batch, slot` for each row of
    `doc_id, n_tokens`.  Batches are numbered within their bucket; a batch
    holds at most `budget` tokens with padding, or one document."""
    rows = written(lengths.select("doc_id", "n_tokens", F.monotonically_increasing_id().alias("row_id"))
                   .withColumn("bin", length_bin(F.col("n_tokens"))), "lengths")
    bins = (rows.groupBy("bin").agg(F.max("n_tokens").alias("top"), F.count("*").alias("n"), F.sum("n_tokens").alias("t"))
            .orderBy("bin").collect())  # at most EXACT + STEPS rows per doubling
    ends = best_boundaries(*(np.array([r[k] for r in bins], dtype=np.int64) for k in ("top", "n", "t")), buckets) if bins else [0]
    edges = F.array(*[F.lit(x).cast("long") for x in ends])
    bucket = F.size(F.filter(edges, lambda e: e < F.col("n_tokens")))
    rows = (rows.withColumn("bucket", bucket).withColumn("bucket_len", F.get(edges, F.col("bucket")))
            .withColumn("shard", F.shiftright("row_id", 33)))  # the task that wrote the row
    sizes = rows.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    before = W.partitionBy("bucket").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(W.partitionBy("bucket", "shard").orderBy("row_id")) - 1
    per_batch = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_len", F.lit(1))), F.lit(1))
    return (rows.withColumn("own", own).join(offsets, ["bucket", "shard"])
            .withColumn("rank", F.col("offset") + F.col("own"))
            .select("doc_id", "n_tokens", "bucket", "bucket_len", F.floor(F.col("rank") / per_batch).cast("long").alias("batch"),
                    (F.col("rank") % per_batch).cast("long").alias("slot")))


def pack_documents(spark: SparkSession, docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id",
                   text_col: str = "text", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Pack documents by their number of BPE tokens."""
    return pack(token_lengths(spark, docs, vocabulary, id_col=id_col, text_col=text_col), buckets=buckets, budget=budget)
