"""Document scores under a hidden Markov language model (operator 4).

Words are grouped into BUCKETS emission buckets by their hash; within a bucket
words keep their own smoothed counts, which cover the whole vocabulary:

    P(word | state) = P(bucket | state) * (c + 1) / (N_b + V_b + 1)

with c the word's training count, and N_b and V_b the bucket's training tokens
and distinct words.  So the states' tables have a fixed size and may be
broadcast, while every word of the corpus counts.  Each state is a proper
distribution over the known words and, per bucket, one for unknown words.

1. Each task turns a block of texts into word numbers and bucket numbers and
   writes them with the block's own vocabulary and training counts.
2. Counts meet by word: a block sends each distinct word once.
3. Baum-Welch: tasks run the scaled forward-backward recursion on the training
   documents and sum expected counts per bucket and state; the sums meet by
   bucket, and the new model of fixed size goes back to the tasks.
4. The forward recursion gives every text's exact sequence likelihood; word
   counts come back to the blocks, where a text's sums are formed.

Start values come from seed texts (the SEEDS training texts with the smallest
hashes, of which the STATES most different are taken); all counts and all
Baum-Welch passes cover all training texts.

Defined results: a null or empty text is the single end token; a null id
hashes as the empty text and trains; repeated rows count and are scored each;
without training texts all words are unknown; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from edicto.llm.bpe import slices
from edicto.llm.common import id_of, release, scratch_path, text_of, written
from edicto.llm.hmm import Hmm, expected_counts, log10_likelihoods

STATES = 8
BUCKETS = 1 << 14
ROUNDS = 3
SEEDS = 64
#: A state's emissions are smoothed by so many tokens of the base distribution.
SMOOTH = 2000.0
BLOCK_CHARS = 32_000_000
#: Documents whose recursion runs at once.
SYMBOLS = 4_000_000

_TOKENS = ("kind string, block long, doc_id long, held boolean, n_tokens long, ids binary, buckets binary, "
           "words array<string>, counts array<long>")


def bucket_of(word: bytes) -> int:
    """0 for the end token (the empty word), else by the word's CRC."""
    return 1 + zlib.crc32(word) % (BUCKETS - 1) if word else 0


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _TOKENS.split(", ")]
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids, held, texts = (batch.column(i) for i in range(3))
        texts = texts.to_pylist()
        for i, j in slices(texts, BLOCK_CHARS):
            number: dict[bytes, int] = {b"": 0}

            class Numbered(dict):
                def __missing__(self, w):
                    self[w] = number[w] = n = len(number)
                    return n

            look = Numbered(number).__getitem__
            rows = []
            for t in texts[i:j]:
                words = t.encode("utf-8", "surrogatepass").lower().split()
                words.append(b"")
                rows.append(np.fromiter(map(look, words), dtype=np.int32, count=len(words)))
            bucket = np.fromiter(map(bucket_of, number), dtype=np.uint16, count=len(number))
            count = np.zeros(len(number), dtype=np.int64)
            for r, h in zip(rows, held.slice(i, j - i).to_pylist()):
                if not h:
                    np.add.at(count, r, 1)
            n = j - i
            yield pa.RecordBatch.from_arrays([
                pa.array(["doc"] * n), pa.array([block] * n, pa.int64()), ids.slice(i, n), held.slice(i, n),
                pa.array([len(r) for r in rows], pa.int64()), pa.array([zlib.compress(r.tobytes(), 1) for r in rows], pa.binary()),
                pa.array([bucket[r].tobytes() for r in rows], pa.binary()),
                pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.list_(pa.int64()))], names=names)
            words = pa.array([[w.decode("utf-8", "surrogatepass") for w in number]], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([
                pa.array(["words"]), pa.array([block], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.bool_()),
                pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), words,
                pa.array([count], pa.list_(pa.int64()))], names=names)
            block += 1
    release()


def _sequences(column: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Runs of rows with about SYMBOLS bucket numbers."""
    rows = column.to_pylist()
    start = size = 0
    for i, r in enumerate(rows):
        size += len(r) // 2
        if size >= SYMBOLS or i + 1 == len(rows):
            yield start, i + 1, [np.frombuffer(x, dtype=np.uint16).astype(np.int64) for x in rows[start:i + 1]]
            start, size = i + 1, 0


def _seeded(docs: DataFrame, base: np.ndarray, states: int) -> Hmm:
    """Start values from the most different seed texts."""
    some = (docs.filter("NOT held AND n_tokens BETWEEN 50 AND 5000").orderBy(F.xxhash64("buckets"), "buckets").limit(SEEDS)
            .select("buckets").collect())  # SEEDS rows of 5000 numbers at most
    found = [np.bincount(np.frombuffer(r["buckets"], dtype=np.uint16), minlength=BUCKETS) for r in some]
    found = [h / h.sum() for h in found]
    picked: list[np.ndarray] = found[:1]
    while found and len(picked) < min(states, len(found)):
        near = [max(float(np.sqrt(h * p).sum()) for p in picked) for h in found]
        picked.append(found[int(np.argmin(near))])
    rng = np.random.default_rng(1)
    while len(picked) < states:
        noise = base * rng.uniform(0.5, 1.5, BUCKETS)
        picked.append(noise / noise.sum())
    stay = 0.9 if states > 1 else 1.0
    move = np.full((states, states), (1 - stay) / max(1, states - 1))
    np.fill_diagonal(move, stay)
    return Hmm(np.full(states, 1 / states), move, 0.5 * np.stack(picked, axis=1) + 0.5 * base[:, None])


def _maximised(counts: Hmm, base: np.ndarray) -> Hmm:
    """The M-step, smoothed: emissions by the base distribution, the rest by one count."""
    emit = counts.emit + SMOOTH * base[:, None]
    move, start = counts.move + 1, counts.start + 1
    return Hmm(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _expect(docs: DataFrame, model: Hmm) -> Hmm:
    """Expected counts of all training documents under the model."""
    states = len(model.start)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x STATES numbers
    cols = [f"e{k}" for k in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, _, seqs in _sequences(batch.column(0)):
                x = expected_counts(shared.value, seqs)
                total = x if total is None else Hmm(total.start + x.start, total.move + x.move, total.emit + x.emit)
        if total is not None:
            rows = np.concatenate([total.emit, total.move, total.start[None]])
            at = np.flatnonzero(rows.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(rows[at, k]) for k in range(states))], names=["row", *cols])

    sums = (docs.filter("NOT held").select("buckets").mapInArrow(run, ", ".join(["row long", *(f"{c} double" for c in cols)]))
            .groupBy("row").agg(*[F.sum(c).alias(c) for c in cols]).collect())  # BUCKETS + STATES + 1 rows
    rows = np.zeros((BUCKETS + states + 1, states))
    for r in sums:
        rows[r["row"]] = [r[c] for c in cols]
    return Hmm(rows[-1], rows[BUCKETS:-1], rows[:BUCKETS])


def score(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: `doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score` (log10)."""
    key = F.crc32(F.coalesce(id_of(id_col).cast("string"), F.lit("")).cast("binary"))
    path = scratch_path(spark, "lm-tokens")
    (docs.select(id_of(id_col).alias("doc_id"), (F.pmod(key, F.lit(7)) == 2).alias("held"), text_of(text_col).alias("text"))
     .mapInArrow(_tokenise, _TOKENS).write.partitionBy("kind").parquet(path))
    tokens = spark.read.schema(_TOKENS).parquet(path)
    texts = tokens.filter("kind = 'doc'")
    own = tokens.filter("kind = 'words'").select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("id", "w"))
    own = own.select("block", "id", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    # One exchange brings a word's blocks together (as many rows as blocks, whatever its count).
    word = W.partitionBy("word")
    bucket = F.when(F.col("word") == "", 0).otherwise(1 + F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(BUCKETS - 1)))
    counts = written(own.select("block", "id", "n", F.sum("n").over(word).alias("c"),
                                (F.row_number().over(word.orderBy("block")) == 1).alias("first"), bucket.cast("int").alias("b")), "lm-counts")
    per = np.zeros((BUCKETS, 2))
    new = F.count_if(F.col("first") & (F.col("c") > 0))
    for r in counts.groupBy("b").agg(F.sum("n").alias("n"), new.alias("v")).collect():  # BUCKETS rows
        per[r["b"]] = r["n"], r["v"]
    n_all, n_words = int(per[:, 0].sum()), int(per[:, 1].sum())
    inside = per.sum(axis=1) + 1
    base = inside / inside.sum()

    model = _seeded(texts, base, states)
    for _ in range(rounds if n_all else 0):
        model = _maximised(_expect(texts, model), base)
    shared = spark.sparkContext.broadcast((model, np.log10(inside)))

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm, log_inside = shared.value
        for batch in batches:
            for i, j, seqs in _sequences(batch.column("buckets")):
                value = log10_likelihoods(hmm, seqs) - [log_inside[s].sum() for s in seqs]
                part = batch.drop_columns(["buckets"]).slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value)], names=[*part.schema.names, "value"])

    def sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        c = np.zeros(len(right), dtype=np.int64)
        c[right["id"].to_numpy()] = right["c"].to_numpy()
        log_c = np.log10(c + 1.0)
        ids = [np.frombuffer(zlib.decompress(x), dtype=np.int32) for x in left["ids"]]
        word_sum = np.array([log_c[x].sum() for x in ids])
        return pd.DataFrame({
            "doc_id": left["doc_id"], "held_out": left["held"], "n_tokens": left["n_tokens"],
            "n_known": [int((c[x] > 0).sum()) for x in ids], "train_tokens": n_all,
            "base_score": word_sum - left["n_tokens"].to_numpy() * np.log10(n_all + n_words + 1.0),
            "score": word_sum + left["value"].to_numpy()})

    scored = texts.select("block", "doc_id", "held", "n_tokens", "ids", "buckets").mapInArrow(
        forward, "block long, doc_id long, held boolean, n_tokens long, ids binary, value double")
    return scored.groupBy("block").cogroup(counts.select("block", "id", "c").groupBy("block")).applyInPandas(
        sums, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
