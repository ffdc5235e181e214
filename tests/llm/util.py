"""Small inputs with odd rows, and brute-force versions of the contracts."""

import collections
import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHES = ("digest", "row_id", "kept", "doc", "key", "words", "n_words", "bin", "label", "toxic", "comp", "batch", "id", "t", "w",
           "keep_id", "group_size", "masked", "bands", "host", "path", "rule", "block", "fold")
LONG = " ".join(f"word{i % 997} mot{i % 13}" for i in range(40_000))
CLEAN = " ".join(f"clean{i}" for i in range(60))
ROWS = [
    (1, "the cat  sat\ton the mat " * 6, "en", "a"), (2, "the cat sat on the mat " * 6, "en", "a"),
    (2, "the cat sat on the mat " * 6, "en", "a"), (None, "the cat sat on the mat " * 6, "en", None),
    (4, None, None, "a"), (5, "", "en", "a"), (6, " \n\t ", "en", "a"), (None, None, None, None),
    (8, LONG, "en", "b"), (9, "été naïve — 日本語 <|endoftext|> \U0001f642", "fr", "b"), (10, "one two", "en", "b"),
    (11, "a line here\n" * 30, "en", "b"), (12, "# $ % & " * 40, "en", "b"), (13, LONG + " tail", "en", "b"),
    (14, CLEAN, "en", "b"), (15, CLEAN.replace(" ", "  "), "en", "b"), (16, CLEAN + " more", "en", "b"),
    (17, CLEAN.upper() + " password=abcdef123 end", "en", None),
]


def odd(spark):
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHES})


def empty(spark):
    return odd(spark).filter("1 = 0")


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x or 0))


ODD_IDS = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x or 0))


def read(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def multiset(text):
    """The multiset of five-word shingles as a set of (shingle, occurrence)."""
    w, n, out = words(text), collections.Counter(), set()
    for i in range(max(1, len(w) - 4)) if w else ():
        g = tuple(w[i:i + 5])
        out.add((g, n[g]))
        n[g] += 1
    return out


def near_classes(docs):
    """doc number -> class number, by comparing all pairs of texts."""
    sets, head = [multiset(t) for t in docs], list(range(len(docs)))

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if words(docs[i]) == words(docs[j]) or 5 * (c := len(x & y)) >= 4 * (len(x) + len(y) - c) > 0:
                a, b = sorted((find(i), find(j)))
                head[b] = a
    return [find(i) for i in range(len(docs))]
