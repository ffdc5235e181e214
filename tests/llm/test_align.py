"""Operator 12 against a plain two-pointer merge over the two libraries' own tokens."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tokenizers

from edicto.llm import align as AL
from tests.llm.util import LONG, ODD_IDS, SCHEMA, empty, ids, odd, read

A_FILE, B_FILE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    a = tokenizers.Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    return a, b, byte


def tokens(tools, text):
    a, b, byte = tools
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[1:-1], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]
    want = (" " + text).encode()
    if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return [], []
    spans = lambda ids, bs: [(i, e - len(x), e) for i, x, e in zip(ids, bs, np.cumsum([len(x) for x in bs]).tolist())]
    return spans(ids_a, bytes_a), spans(ids_b, bytes_b)


def brute(tools, texts):
    docs, count = [], collections.Counter()
    for t in texts:
        a, b = tokens(tools, t or "")
        links, j0 = [], 0
        for i, s, e in a:
            while j0 < len(b) and b[j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(b) and b[j][1] < e:
                links.append((i, b[j][0]))
                j += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, x, y = [], 0, 0
        for c in cuts:
            left, right = [], []
            while x < len(a) and a[x][2] <= c:
                left.append(a[x][0])
                x += 1
            while y < len(b) and b[y][2] <= c:
                right.append(b[y][0])
                y += 1
            groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
        docs.append((a, b, links, groups))
        count.update(set(links))
    best = collections.defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "") for a, b, links, groups in docs]


def got(df):
    return sorted(((r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in df.collect()),
                  key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def want(tools, docs):
    rows = docs.select("doc_id", "text").collect()
    return sorted(zip([r.doc_id for r in rows], brute(tools, [r.text for r in rows])), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


@pytest.mark.parametrize("head", [AL.HEAD, 40, 1])
def test_documents(spark, tools, head):
    """With a small head most pairs take the join."""
    docs = read(spark, "documents")
    assert got(AL.align_documents(spark, docs, A_FILE, B_FILE, pattern=P.PATTERN, head=head)) == want(tools, docs)


def test_odd_rows(spark, tools):
    more = ["<|endoftext|> and <s> here </s> <unk>", "a▁b", "▁", " " * 5000 + "x", "\n" * 7, "a\0b", "éﬁ  　x﻿", "\U0001f642" * 40, "x" * 3000]
    docs = odd(spark).unionByName(spark.createDataFrame([(100 + i, t, "en", "a", 1) for i, t in enumerate(more)], SCHEMA), allowMissingColumns=True)
    rows = got(AL.align_documents(spark, docs, A_FILE, B_FILE, pattern=P.PATTERN))
    assert rows == want(tools, docs)
    by = dict(rows)
    assert by[5] == by[4] == (0, 0, 0, 0, 0, 0, "") and by[101][0] == 0 and by[100][0] > 0
    assert ids(AL.align_documents(spark, odd(spark), A_FILE, B_FILE).select("doc_id").collect()) == ODD_IDS
    assert AL.align_documents(spark, empty(spark), A_FILE, B_FILE, pattern=P.PATTERN).count() == 0


def test_lanes_do_not_change_results():
    al, rng = AL.Aligner(AL.Encoders(AL.read_files(A_FILE, B_FILE, P.PATTERN))), random.Random(3)
    texts = [LONG, "", "été naïve 日本語 " * 300, "x" * 4000, " ".join(rng.choice(["été", "don't", "日本", "12345", "\U0001f642"]) for _ in range(2000)), "a b"]
    whole = al.align(texts, 10**9)
    assert al.align(texts, 1) == al.align(texts, 7) == al.align(texts) == whole and whole[1][0] == 0


def test_both_encoders_of_a_agree():
    """By ranks or by the library: over signs of every kind."""
    enc = AL.Encoders(AL.read_files(A_FILE, B_FILE, P.PATTERN))
    assert enc.fast is not None and AL.Encoders(AL.read_files(A_FILE, B_FILE)).fast is None
    for c in [*range(0x3000), *range(0xF000, 0x10000), *range(0x1F600, 0x1F680)]:
        t = f"a{chr(c)}b 1{chr(c)}2 {chr(c)} {chr(c)}{chr(c)} !{chr(c)}? "
        assert enc.slow.encode(t, add_special_tokens=False).ids == enc.encode_a(t).tolist()
