"""Secret scans with a token-efficiency test (operator 3).

Three fixed patterns give the base spans.  The method adds spans of kind
`random`: runs of key-like signs that a tokenizer vocabulary compresses badly,
that is, with few characters per token, after known digests and identifiers
(hexadecimal digests, UUIDs, numbers) are set aside.  Runs of letters in one
case count by their words in small letters, which a vocabulary knows best.  Of
a run that is not random, each long piece between slashes is tested alone, so
that a key behind a path counts.  What overlaps a base span adds nothing.

Defined results: a null text counts as empty and has no spans; positions count
code points, ends are exclusive; repeated rows are scanned each; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edicto.llm.bpe import SLICE
from edicto.llm.common import held, id_of, release, text_of, text_slices

# The base patterns, and the least length of what they match.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so the least length can stand in the pattern
LEAST = {"assign": 6, "access": 20}

#: Candidates of the token test, and what is known not to be a secret.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_-])")
KNOWN = re.compile(r"[0-9a-f]+|[0-9A-F]+|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9_/+=-]+")
#: The pieces of a candidate, as long as a candidate at least.
PIECE = re.compile(r"[A-Za-z0-9+_-]{20,}={0,2}")
#: Runs of words, each in one case but for its first letter, and the words in them that can tell.
WORDS = re.compile(r"[^A-Za-z0-9]*+(?:(?>[A-Z]?[a-z]+|[A-Z]+)(?:[^A-Za-z0-9]++|\Z))++")
WORD = re.compile(r"[A-Za-z]{3,}")
#: Characters per token below which a candidate counts as random.
RATIO = 2.0

#: The pattern that splits text before the merges of the rank file (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Span = tuple[int, int, int]  # start, kind's place, end


def base_spans(text: str) -> list[Span]:
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    return out


def is_random(run: str, n_tokens) -> bool:
    """Whether a run has under RATIO characters per token."""
    if KNOWN.fullmatch(run):
        return False
    if WORDS.fullmatch(run):
        words = [w.lower() for w in WORD.findall(run)]
        return sum(map(len, words)) < RATIO * sum(map(n_tokens, words))
    return len(run) < RATIO * n_tokens(run)


def random_spans(text: str, n_tokens, base: list[Span]) -> list[Span]:
    """Spans whose characters per token fall below RATIO."""
    out = []
    free = lambda a, b: not any(x < b and a < z for x, _, z in base)
    for m in CANDIDATE.finditer(text):
        if free(*m.span()) and is_random(m.group(), n_tokens):
            out.append((m.start(), 3, m.end()))
        elif "/" in m.group():
            out += [(x.start(), 3, x.end()) for x in PIECE.finditer(text, *m.span()) if free(*x.span()) and is_random(x.group(), n_tokens)]
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{(*KINDS, 'random')[k]}:{a}:{b}" for a, k, b in spans)


def token_counter(ranks: str):
    """Token count under a tiktoken vocabulary, built once per Python worker."""
    def build():
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(str.split, ranks.splitlines())}
        return tiktoken.Encoding("secret-scan", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    encoder = held(f"secret-scan {hash(ranks)}", build)
    return lambda s: len(encoder.encode_ordinary(s))


def masked(text: str, spans: list[Span], mask: str) -> str:
    """The text with every span, or union of overlapping spans, replaced."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(spark: SparkSession, docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text",
         mask: str | None = None) -> DataFrame:
    """Per row `doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`;
    with `mask` instead `doc` (the input row as a struct), `masked` (its text
    with every span replaced; null if there is none) and `n_spans`."""
    with open(ranks_path, encoding="ascii") as f:
        ranks = spark.sparkContext.broadcast(f.read())  # a fixed file, under 1 MB

    def run(batches):
        for batch in batches:
            count = token_counter(ranks.value)
            texts = batch.column(1) if mask is None else batch.column(0).field(text_col)
            for i, j, part in text_slices(texts.cast(pa.string()), SLICE):
                rows = []
                for t in part:
                    base = base_spans(t)
                    every = base + random_spans(t, count, base)
                    every.sort()
                    if mask is not None:
                        rows.append((masked(t, every, mask) if every else None, len(every)))
                        continue
                    n = [sum(k == x for _, k, _ in every) for x in range(4)]
                    rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *cols], names=names)
        release()

    if mask is not None:
        names, kinds = ["doc", "masked", "n_spans"], [pa.string(), pa.int64()]
        rows = docs.select(F.struct("*").alias("doc"))
        return rows.mapInArrow(run, T.StructType([rows.schema["doc"], T.StructField("masked", T.StringType()),
                                                  T.StructField("n_spans", T.LongType())]))
    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2
    return docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")


def mask_secrets(spark: SparkSession, docs: DataFrame, ranks_path: str, *, text_col: str = "text",
                 chars_col: str = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """The input rows with every secret replaced by `mask`; rows without one
    are unchanged.  A column named `chars_col` follows the new text."""
    found = scan(spark, docs, ranks_path, text_col=text_col, mask=mask)
    new = {text_col: F.coalesce("masked", F.col(f"doc.`{text_col}`"))}
    if chars_col in docs.columns:
        new[chars_col] = F.coalesce(F.length("masked").cast(docs.schema[chars_col].dataType), F.col(f"doc.`{chars_col}`"))
    return found.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
