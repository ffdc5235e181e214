"""Alignment of two tokenizers over every text (operator 12).

A is a byte-level BPE file, B a SentencePiece model.  Each task encodes the
texts of a slice with both and lays all tokens out in two flat arrays with the
byte offset at which each ends.  One state vector per side then holds where
every text of the slice has got to; each step links the current pair of every
text, advances the side (or both) that ends first, notes a cut where both end,
and drops the texts that are done.  A text of many tokens runs in several lanes
that start where both sides end, so a slice takes about LANE steps and not as
many as its longest text has tokens.

An id pair's count is the number of documents that hold it linked.  A document
leaves its task with its distinct pairs, sorted and packed; a task adds up the
documents per pair before anything is shuffled.  The best pairs of an A id
follow from the counts.  Pairs that hold at least 1/HEAD of all (document,
pair) entries are at most HEAD, and are looked up from a broadcast; all others
go through a join on the pair, where by the same bound no pair is hot.

Defined results: a null or empty text, and one whose joined token bytes differ
from space + text on either side, has no tokens: zeros and an empty
`groups_sha256`; special tokens' strings in a text are plain text; null and
repeated ids are kept, each row counts as a document; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edicto.llm.bpe import byte_alphabet, gather, slices
from edicto.llm.common import id_of, release, scratch_path, text_of

#: A text of more A tokens than this is cut into lanes where it can be.
LANE = 512
#: A lane starts at the first common end among so many A tokens.
LOOK = 64
#: Characters whose tokens are held at once.
SLICE = 1_500_000
#: Most pairs that are broadcast (9 bytes each).
HEAD = 1 << 20
#: (document, pair) entries that a task adds up at once.
ENTRIES = 4_000_000
#: tiktoken's splitter recurses along white space; texts with longer runs take the other library.
LONG_SPACE = re.compile(r"\s{2000}")

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


# -- the two tokenizers -------------------------------------------------------
@dataclass
class Files:
    """Both vocabulary files (about 3 MB), and the splitter of A."""

    name: str
    a: str
    b: bytes
    pattern: str


class Side:
    """The bytes of each id of one vocabulary."""

    def __init__(self, entries: list[bytes]):
        self.len = np.array([len(e) for e in entries], dtype=np.int64)
        self.at = np.cumsum(self.len) - self.len
        self.flat = np.frombuffer(b"".join(entries), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.at[ids], self.len[ids])


class Encoders:
    """Encoders of both vocabularies; built once per Python worker."""

    def __init__(self, files: Files):
        self.slow = tokenizers.Tokenizer.from_str(files.a)
        self.slow.encode_special_tokens = True
        spec, sign = json.loads(files.a), byte_alphabet()
        special = {t["id"] for t in spec["added_tokens"] if t["special"]}
        entry = {i: bytes(sign[c] for c in t) for t, i in spec["model"]["vocab"].items() if i not in special}
        a = [entry.get(i, b"") for i in range(max([*entry, *special]) + 1)]
        # Same ranks, so the same ids; only where an id is its entry's rank.
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        ranked = all(spec["model"]["vocab"][x + y] == i + 256 for i, (x, y) in enumerate(merges))
        self.fast = tiktoken.Encoding("a", pat_str=files.pattern, special_tokens={},
                                      mergeable_ranks={e: i for i, e in entry.items()}) if ranked and files.pattern else None
        self.piece = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        pieces = [self.piece.id_to_piece(i) for i in range(self.piece.get_piece_size())]
        b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.a, self.b = Side(a), Side(b)
        if len(a) * len(b) > 1 << 32:
            raise ValueError("pairs of these vocabularies don't fit 32 bits")

    def encode_a(self, text: str) -> np.ndarray:
        if self.fast is None or LONG_SPACE.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        return np.array(self.fast.encode_ordinary(text), dtype=np.int64)

    def encode_b(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, dtype=np.int64) for x in self.piece.encode(texts, num_threads=1)]


_BUILT: dict[str, Encoders] = {}


def built(files: Files) -> Encoders:
    if files.name not in _BUILT:
        _BUILT.clear()
        _BUILT[files.name] = Encoders(files)
    return _BUILT[files.name]


def read_files(a_path: str, b_path: str, pattern: str = "") -> Files:
    """Read both vocabulary files on the driver."""
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        a, b = f.read(), g.read()
    return Files(hashlib.sha256(a.encode() + b + pattern.encode()).hexdigest(), a, b, pattern)


# -- lockstep -----------------------------------------------------------------
def lanes(first: np.ndarray, count: np.ndarray, first_b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray,
          lane: int = LANE, look: int = LOOK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start in A, start in B and end in A of every lane: one per text, and more
    for long texts wherever both sides end within `look` tokens of a target."""
    extra = np.maximum(count - 1, 0) // lane
    k = np.arange(int(extra.sum())) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    target = np.repeat(first, extra) + k * lane
    last = np.repeat(first + count, extra) - 1
    # look at the ends of the tokens before each window position
    window = np.minimum(target[:, None] + np.arange(look)[None, :], last[:, None])
    ends = end_a[window - 1]
    at = np.searchsorted(end_b, ends)
    same = end_b[np.minimum(at, len(end_b) - 1)] == ends if len(end_b) else np.zeros(ends.shape, bool)
    hit = same.argmax(axis=1) if len(same) else np.zeros(0, np.int64)
    rows = np.flatnonzero(same[np.arange(len(hit)), hit]) if len(hit) else np.zeros(0, np.int64)
    start = np.concatenate([first, window[rows, hit[rows]]])
    start_b = np.concatenate([first_b, at[rows, hit[rows]] + 1])
    stop = np.concatenate([first + count, last[rows] + 1])
    start, keep = np.unique(start, return_index=True)
    stop, start_b = stop[keep], start_b[keep]
    if len(start):
        stop[:-1] = np.minimum(stop[:-1], start[1:])
    return start, start_b, stop


def lockstep(end_a: np.ndarray, end_b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray, stop_a: np.ndarray):
    """Advance all lanes together.  Returns the linked positions (A, B) and,
    for each position of either side, whether a cut follows it."""
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    link_a, link_b = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    ia, ib, stop = start_a.astype(np.int32), start_b.astype(np.int32), stop_a.astype(np.int32)
    live = ia < stop
    while True:
        if not live.all():
            ia, ib, stop = ia[live], ib[live], stop[live]
        if not len(ia):
            return np.concatenate(link_a), np.concatenate(link_b), cut_a, cut_b
        link_a.append(ia)
        link_b.append(ib)
        ea, eb = end_a[ia], end_b[ib]
        step_a, step_b = ea <= eb, eb <= ea
        both = step_a & step_b
        cut_a[ia[both]] = True
        cut_b[ib[both]] = True
        ia, ib = ia + step_a, ib + step_b
        live = ia < stop


#: Decimal digits of every id below 100,000, and how many it has.
def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    n, width = np.arange(size), max(1, len(str(max(size - 1, 0))))
    lens = np.maximum(1, np.ceil(np.log10(np.maximum(n, 1) + 0.5)).astype(np.int64))
    table = np.zeros((size, width), np.uint8)
    for k in range(width):  # digit k from the left
        shift = lens - 1 - k
        table[:, k] = np.where(shift >= 0, 48 + n // 10 ** np.maximum(shift, 0) % 10, 0)
    return table, lens


_DIGITS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def group_bytes(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`a1,a2|b1;a3|b2;` of all texts of a slice in one byte array, and the byte
    behind each group."""
    size = int(max(a.max(initial=0), b.max(initial=0))) + 1
    size = 1 << (size - 1).bit_length()
    table, lens = _DIGITS.setdefault(size, _digits(size))
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    per_a, per_b = np.bincount(group_a, minlength=int(cut_a.sum())), np.bincount(group_b, minlength=int(cut_b.sum()))
    place_a = np.arange(len(a)) + (np.cumsum(per_b) - per_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(per_a)[group_b]
    ids, sep = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
    ids[place_a], ids[place_b] = a, b
    sep[place_a], sep[place_b] = np.where(cut_a, ord("|"), ord(",")), np.where(cut_b, ord(";"), ord(","))
    size_of = lens[ids]
    ends = np.cumsum(size_of + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    at = ends - size_of - 1
    out[ends - 1] = sep
    for k in range(table.shape[1]):
        has = size_of > k
        out[at[has] + k] = table[ids[has], k]
    return out, ends[place_b[cut_b]]


# -- packed pair lists --------------------------------------------------------
def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers as four byte planes, which compress well if most are small."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)


def flat_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed lists, and how many each row has."""
    parts = [unpack(x) for x in column.to_pylist()]
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)).astype(np.int64), np.array([len(p) for p in parts], dtype=np.int64)


class Aligner:
    """Alignment of a slice of texts."""

    def __init__(self, enc: Encoders):
        self.enc = enc

    def tokens(self, texts: list[str]):
        """Ids of both sides, flat, with each text's counts (0 where a side
        does not give back the text)."""
        enc, whole = self.enc, [" " + t for t in texts]
        b_all = enc.encode_b(texts)
        out_a, out_b = [], []
        for text, b in zip(whole, b_all):
            a, data = enc.encode_a(text), text.encode()
            fits = len(text) > 1 and enc.a.joined(a).tobytes() == data and enc.b.joined(b).tobytes() == data
            out_a.append(a if fits else a[:0])
            out_b.append(b if fits else b[:0])
        n_a, n_b = (np.array([len(x) for x in xs], dtype=np.int64) for xs in (out_a, out_b))
        none = [np.zeros(0, np.int64)]
        return np.concatenate(out_a + none), np.concatenate(out_b + none), n_a, n_b

    def align(self, texts: list[str], lane: int = LANE):
        """For each text its counts, digest of groups, sorted distinct pairs and
        how often each is linked."""
        a, b, n_a, n_b = self.tokens(texts)
        end_a, end_b = np.cumsum(self.enc.a.len[a]), np.cumsum(self.enc.b.len[b])
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        has = n_a > 0
        link_a, link_b, cut_a, cut_b = lockstep(end_a, end_b, *lanes(first_a[has], n_a[has], first_b[has], end_a, end_b, lane))
        doc = np.repeat(np.arange(len(texts)), n_a)
        n_links, n_groups = np.bincount(doc[link_a], minlength=len(texts)), np.bincount(doc[cut_a], minlength=len(texts))
        width = len(self.enc.b.len)
        key = (doc[link_a] << 32) + a[link_a] * width + b[link_b]
        key.sort()
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        times, pairs, owner = np.diff(np.append(new, len(key))), key[new] & 0xFFFFFFFF, key[new] >> 32
        at = np.searchsorted(owner, np.arange(len(texts) + 1))
        text, behind = group_bytes(a, b, cut_a, cut_b)
        group_at = np.cumsum(n_groups)
        rows, start = [], 0
        for i in range(len(texts)):
            sha = ""
            if n_groups[i]:
                stop = int(behind[group_at[i] - 1])
                sha = hashlib.sha256(text[start:stop - 1].tobytes()).hexdigest()
                start = stop
            p, t = pairs[at[i]:at[i + 1]], times[at[i]:at[i + 1]]
            rows.append((int(n_a[i]), int(n_b[i]), int(n_groups[i]), int(n_links[i]), sha, pack(np.diff(p, prepend=0)), pack(t)))
        return rows


def aligned(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, *, pattern: str = "", id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: `row_id, doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, pairs, times`.  `pairs` holds the sorted distinct linked
    pairs `a * size of B + b` as packed differences, `times` how often each is
    linked.  `pattern` is A's splitter; with it texts are encoded by ranks."""
    files = spark.sparkContext.broadcast(read_files(a_path, b_path, pattern))  # of fixed size
    names = ["row_id", "doc_id", *COUNTS, "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(built(files.value))
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for i, j in slices(texts, SLICE):
                rows = list(zip(*aligner.align(texts[i:j])))
                types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), *(pa.array(x, t) for x, t in zip(rows, types))], names=names)
        release()

    return docs.select(F.monotonically_increasing_id().alias("row_id"), id_of(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, "row_id long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary")


def pair_counts(rows: DataFrame) -> DataFrame:
    """`pair, n`: the documents that hold each pair; added up per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, open_, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def add_up():
            flat = np.concatenate([pair, *open_])
            weight = np.concatenate([n, np.ones(len(flat) - len(pair), np.int64)])
            order = np.argsort(flat, kind="stable")
            flat, weight = flat[order], weight[order]
            new = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
            return flat[new], np.add.reduceat(weight, new) if len(new) else weight

        for batch in batches:
            for x in batch.column(0).to_pylist():
                open_.append(np.cumsum(unpack(x), dtype=np.int64))
                size += len(open_[-1])
                if size >= ENTRIES:
                    pair, n = add_up()
                    open_, size = [], 0
                    if len(pair) >= ENTRIES:
                        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])
                        pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair, n = add_up()
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])
        release()

    return rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def resolved(rows: DataFrame, head: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """For each document the sums over its pairs in `head` (`pair` null), and a
    row for each other pair with its `times`."""
    spark = rows.sparkSession
    known = spark.sparkContext.broadcast(head)  # at most HEAD pairs
    names = ["row_id", "pair", "times", "n_best", "count_sum"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = known.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            sizes = pc.binary_length(batch.column(1)).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(np.diff(np.cumsum(sizes) // (4 * ENTRIES))) + 1, [len(ids)]])
            for i, j in zip(starts, starts[1:]):
                own, per = flat_lists(batch.column(1).slice(i, j - i))
                times, _ = flat_lists(batch.column(2).slice(i, j - i))
                doc = np.repeat(np.arange(j - i), per)
                total = np.cumsum(own)
                before = np.concatenate([[0], total])[np.cumsum(per) - per]
                own = total - before[doc]  # differences to pairs
                at = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
                known_ = pair[at] == own if len(pair) else np.zeros(len(own), bool)
                at, k = at[known_], times[known_]
                n_best = np.bincount(doc[known_], weights=k * best[at], minlength=j - i).astype(np.int64)
                sums = np.zeros(j - i, np.int64)
                np.add.at(sums, doc[known_], k * count[at])
                none = pa.nulls(j - i, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j]), none, none, pa.array(n_best), pa.array(sums)], names=names)
                rest = ~known_
                none = pa.nulls(int(rest.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j][doc[rest]]), pa.array(own[rest]), pa.array(times[rest]), none, none], names=names)
        release()

    return rows.select("row_id", "pairs", "times").mapInArrow(run, "row_id long, pair long, times long, n_best long, count_sum long")


def align_documents(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, *, pattern: str = "", id_col: str = "doc_id",
                    text_col: str = "text", head: int = HEAD) -> DataFrame:
    """`doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`
    for every row of `docs`."""
    path, width = scratch_path(spark, "aligned"), sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    made = aligned(spark, docs, a_path, b_path, pattern=pattern, id_col=id_col, text_col=text_col)
    made.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(made.schema).parquet(path)
    counts = pair_counts(rows).withColumn("a", F.floor(F.col("pair") / width))
    counts = _stored(counts, "pair-counts")
    top = counts.groupBy("a").agg(F.max("n").alias("top"))  # one row per A id
    counts = _stored(counts.join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best")), "pair-best")
    total = counts.agg(F.sum("n")).first()[0] or 0
    table = counts.filter(F.col("n") * head >= total).toArrow().sort_by("pair")  # at most `head` rows by the bound
    known = tuple(table[c].to_numpy() for c in ("pair", "n", "best"))
    parts = _stored(resolved(rows, known), "pair-parts")
    rare = counts.filter(F.col("n") * head < total)
    rest = (parts.filter("pair IS NOT NULL").select("row_id", "pair", "times").join(rare, "pair")
            .select("row_id", (F.col("times") * F.col("best")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")))
    sums = (parts.filter("pair IS NULL").select("row_id", "n_best", "count_sum").unionByName(rest)
            .groupBy("row_id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return rows.drop("pairs", "times").join(sums, "row_id").select("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """As `written`, packed tighter."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
