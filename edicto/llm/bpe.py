"""Byte-level BPE encoding and decoding with a pair occurrence index (operator 1).

Each task gathers the words (pre-tokens) of a batch that it has not met, lays
their byte symbols out as linked lists in one array, and files every adjacent
pair that has a merge rank under that rank with all its positions.  Active
ranks are taken in ascending order; all occurrences of the pair merge at once
and the neighbours' new pairs are filed.  A merge only makes pairs of a higher
rank, since they contain the new token, so one ascending pass is complete.

Defined results: a null text counts as empty and has no ids; a special token's
string in a text becomes its id, as in the tokenizers library; null and
repeated ids are kept as they are; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from edicto.llm.common import id_of, release, text_of

#: Encoded words kept within a task, and by its worker for the next task.  The
#: first ones met are kept, since frequent words come early.
KEEP_WORDS = 400_000
KEEP_BETWEEN = 100_000
#: Texts beyond this length are split into words piece by piece.
PIECE = 1 << 20


@cache
def letters_and_numbers() -> tuple[str, str]:
    """Letters and numbers as ranges of a character class."""
    runs: dict[str, list[list[int]]] = {"L": [], "N": []}
    for c in range(sys.maxunicode + 1):
        own = runs.get(unicodedata.category(chr(c))[0])
        if own is not None:
            if own and own[-1][1] == c - 1:
                own[-1][1] = c
            else:
                own.append([c, c])
    return tuple("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs[k]) for k in "LN")


#: White space as the pattern's \s has it (Unicode White_Space).
SPACE = r"\t-\r \x85\xa0  -     　"


def _splitter(letters: str, numbers: str) -> re.Pattern:
    return re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACE}{letters}{numbers}]+"
                      rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


ASCII_WORDS = _splitter("A-Za-z", "0-9")
#: A space between two signs that aren't white space always starts a word.
SAFE_CUT = re.compile(rf"(?<=[^{SPACE}]) (?=[^{SPACE}])")


def byte_alphabet() -> dict[str, int]:
    """The printable sign that stands for each byte in vocabulary files:
    printable Latin-1 signs stand for themselves, the rest follow from 256 up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Numbered(dict):
    """Numbers its keys in the order of their first look-up."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


@dataclass
class Vocabulary:
    """The tables of a byte-level BPE file, of fixed size (about 4 MB)."""

    name: str
    special: dict[str, int]
    of_byte: np.ndarray  # token of each byte
    left: np.ndarray  # the merges in rank order
    right: np.ndarray
    made: np.ndarray
    token_len: np.ndarray
    token_bytes: np.ndarray
    classes: tuple[str, str]  # signs that count as letters and numbers


def read_spec(path: str) -> Vocabulary:
    """Read a vocabulary file on the driver."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    vocab, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    sign = byte_alphabet()
    token = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for t, i in vocab.items():
        token[i] = bytes(sign[c] for c in t)
    for t, i in special.items():
        token[i] = t.encode()
    pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
    ids = lambda tokens: np.array([vocab[t] for t in tokens], dtype=np.int64)
    return Vocabulary(
        hashlib.sha256(text.encode()).hexdigest(), special, ids(sorted(sign, key=sign.get)), ids(a for a, _ in pairs), ids(b for _, b in pairs),
        ids(a + b for a, b in pairs), np.array([len(t) for t in token], dtype=np.int64), np.frombuffer(b"".join(token), dtype=np.uint8),
        letters_and_numbers())


class PairIndexBpe:
    """Encoder and decoder of one vocabulary; built once per Python worker."""

    def __init__(self, v: Vocabulary):
        self.of_byte, self.left, self.right, self.made = v.of_byte, v.left, v.right, v.made
        self.special, self.classes, self.size = v.special, v.classes, len(v.token_len)
        keys = self.left * self.size + self.right
        self.by_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.by_key]
        self.token_len, self.token_bytes = v.token_len, v.token_bytes
        self.token_at = np.cumsum(v.token_len) - v.token_len
        self.any_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.words = Numbered()
        self.wide: re.Pattern | None = None
        self._forget()

    def _forget(self) -> None:
        self.words.clear()
        self.flat, self.at, self.len = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def trim(self, n: int) -> None:
        """Keep the first `n` words only."""
        if len(self.words) > n:
            self.words = Numbered(islice(self.words.items(), n))
            self.at, self.len = self.at[:n].copy(), self.len[:n].copy()
            self.flat = self.flat[:int(self.at[-1] + self.len[-1]) if n else 0].copy()

    # -- merging -------------------------------------------------------------
    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.by_key[i], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of each word's ids."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        lens = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        ends = np.cumsum(lens)
        sym = self.of_byte[np.frombuffer(b"".join(data), dtype=np.uint8)].astype(np.int32)
        nxt, prv = np.arange(1, len(sym) + 1, dtype=np.int32), np.arange(-1, len(sym) - 1, dtype=np.int32)
        nxt[ends - 1], prv[ends - lens] = -1, -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def file(pos: np.ndarray) -> None:
            ranks = self._ranks(sym[pos], sym[nxt[pos]])
            pos, ranks = pos[ranks >= 0], ranks[ranks >= 0]
            if not len(pos):
                return
            order = np.argsort(ranks, kind="stable")
            pos, ranks = pos[order], ranks[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for i, j in zip(cuts, cuts[1:]):
                r = int(ranks[i])
                if r in index:
                    index[r].append(pos[i:j])
                else:
                    index[r] = [pos[i:j]]
                    heapq.heappush(active, r)

        file(np.flatnonzero(nxt >= 0))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            a, b = self.left[r], self.right[r]
            pos = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            pos = pos[(sym[pos] == a) & (nxt[pos] >= 0)]
            pos = pos[sym[nxt[pos]] == b]
            if a == b and len(pos) > 1:  # of overlapping occurrences the left one merges
                keep, taken = [], -1
                for p, q in zip(pos.tolist(), nxt[pos].tolist()):
                    if p != taken:
                        keep.append(p)
                        taken = q
                pos = np.array(keep)
            if not len(pos):
                continue
            gone = nxt[pos]
            sym[pos], sym[gone] = self.made[r], -1
            after = nxt[gone]
            nxt[pos] = after
            has = after >= 0
            prv[after[has]] = pos[has]
            before = prv[pos]
            file(np.unique(np.concatenate([before[before >= 0], pos[has]])))
        alive = sym >= 0
        return sym[alive], np.add.reduceat(alive, ends - lens) if len(lens) else lens

    # -- words ---------------------------------------------------------------
    def split(self, text: str) -> Iterator[list[str]]:
        """The text's words, in lists that together make up the whole text."""
        at = 0
        for m in self.any_special.finditer(text) if self.any_special and "<" in text else ():
            yield from self._split_plain(text[at:m.start()])
            yield [m.group()]
            at = m.end()
        yield from self._split_plain(text[at:] if at else text)

    def _split_plain(self, text: str) -> Iterator[list[str]]:
        if text.isascii():
            find = ASCII_WORDS.findall
        else:
            self.wide = self.wide or _splitter(*self.classes)
            find = self.wide.findall
        at = 0
        while len(text) - at > 2 * PIECE:
            cut = SAFE_CUT.search(text, at + PIECE)
            if not cut:
                break
            yield find(text[at:cut.start()])
            at = cut.start()
        yield find(text[at:] if at else text)

    def number_words(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's words by number; words not met before are encoded."""
        if len(self.words) > KEEP_WORDS:
            self.trim(KEEP_BETWEEN)
        words, known = self.words, len(self.words)
        number = words.__getitem__
        rows = [np.concatenate([np.fromiter(map(number, ws), dtype=np.int32, count=len(ws)) for ws in self.split(t)]) for t in texts]
        if len(words) > known:
            fresh = list(words)[known:]
            plain = [w for w in fresh if w not in self.special]
            ids, lens = self.merge(plain)
            if len(plain) < len(fresh):
                parts, lens = iter(np.split(ids, np.cumsum(lens)[:-1]) if len(lens) else []), None
                each = [np.array([self.special[w]], np.int32) if w in self.special else next(parts) for w in fresh]
                ids, lens = np.concatenate(each), np.array([len(x) for x in each])
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(lens) - lens])
            self.flat, self.len = np.concatenate([self.flat, ids]), np.concatenate([self.len, lens])
        return rows

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return [gather(self.flat, self.at[r], self.len[r]) for r in self.number_words(texts)]

    def count_batch(self, texts: list[str]) -> list[int]:
        """The number of ids of each text."""
        return [int(self.len[r].sum()) for r in self.number_words(texts)]

    def decode(self, ids: np.ndarray) -> str:
        return gather(self.token_bytes, self.token_at[ids], self.token_len[ids]).tobytes().decode("utf-8", "replace")


def gather(flat: np.ndarray, at: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The pieces flat[at : at + len], one after the other."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(at - ends + lens, lens) + np.arange(total)]


_BUILT: dict[str, PairIndexBpe] = {}


def built(v: Vocabulary) -> PairIndexBpe:
    if v.name not in _BUILT:
        _BUILT.clear()
        _BUILT[v.name] = PairIndexBpe(v)
    return _BUILT[v.name]


#: Characters encoded at once.
SLICE = 6_000_000


def slices(texts: list[str], limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `limit` characters in each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(spark: SparkSession, docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
           out: str = "digests") -> DataFrame:
    """Encode every whole text.

    out: "ids" gives `doc_id, n_tokens, ids`; "lengths" gives `doc_id, n_tokens`;
    "digests" also decodes and gives `doc_id, n_tokens, ids_sha256,
    decoded_sha256`.  `vocabulary` is the path of a byte-level BPE file.
    """
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))  # of fixed size
    more = {"ids": ", ids array<int>", "lengths": "", "digests": ", ids_sha256 string, decoded_sha256 string"}[out]

    def run(batches):
        for batch in batches:
            bpe = built(spec.value)
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for i, j in slices(texts):
                if out == "lengths":
                    lens = bpe.count_batch(texts[i:j])
                else:
                    ids = bpe.encode_batch(texts[i:j])
                    lens = [len(x) for x in ids]
                cols = [keys.slice(i, j - i), pa.array(lens, pa.int64())]
                if out == "ids":
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                elif out == "digests":
                    cols.append(pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]))
                    cols.append(pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids]))
                names = ["doc_id", "n_tokens", *(x.split()[0] for x in more.split(", ")[1:])]
                yield pa.RecordBatch.from_arrays(cols, names=names)
        built(spec.value).trim(KEEP_BETWEEN)
        release()

    return docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long" + more)


def decode(spark: SparkSession, encoded: DataFrame, vocabulary: str) -> DataFrame:
    """`doc_id, text` from `doc_id, ids`; null ids count as none."""
    spec = spark.sparkContext.broadcast(read_spec(vocabulary))

    def run(batches):
        for batch in batches:
            bpe = built(spec.value)
            texts = [bpe.decode(np.array(x or [], dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
