"""Toxicity by a classifier chain (operator 10).

Categories are predicted one after the other by linear models over the
presence of words and of word beginnings (inflected and compound forms share
those).  Each later model also sees the probabilities of the categories before
it.  While training, those probabilities are out-of-fold: a text's value comes
from a model that did not see the text, so a later model learns how far
earlier ones can be trusted.  At scoring time the models fitted on all
training rows form the chain.

Labels give the last category, `toxic`.  The categories before it are kinds of
abuse: a toxic text belongs to a kind if it has one of the kind's terms
(KINDS, a parameter).  Models are logistic regressions with an L1 penalty on
the features that differ most between a category's texts and the others; each
is fitted in a task of its own on at most SAMPLE labelled texts, those with the
smallest hashes of their ids.  The cut on `p_toxic` has the best F1 on the
out-of-fold probabilities.

Defined results: a null text counts as empty; null labels don't count, and of
conflicting labels of an id the toxic one does; rows with the same text get
the same values; without labels of both kinds nothing is toxic and the
probabilities are null; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicto.llm.bpe import slices
from edicto.llm.common import id_of, text_of, written

SAMPLE = 8000
#: Hash range of the features; most a model may use; least difference between
#: the two classes, in standard deviations, and least number of texts.
FEATURES = 1 << 22
USED = 4096
DIFFERENCE = 5.0
TEXTS = 5
FOLDS = 3
PENALTY = 2e-4
STEPS = 400
#: Lengths of word beginnings.
HEADS = (4, 5)
#: Kinds of abuse before the last category, with general English terms.
KINDS = {
    "insult": ("idiot", "moron", "stupid", "dumb", "fool", "imbecile", "loser", "clown", "jerk", "freak"),
    "contempt": ("pathetic", "worthless", "disgusting", "trash", "garbage", "scum", "filth", "vermin", "disgrace", "useless"),
}
TERM = re.compile(r"[^\W_]+")


def hashed(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % FEATURES


def features_of(word: str) -> list[int]:
    """A word, and its beginnings if it is longer."""
    return [hashed(word), *(hashed(word[:n] + "*") for n in HEADS if len(word) > n)]


def terms_of(text: str) -> set[str]:
    return set(TERM.findall(text.lower()))


class Model:
    """A linear model: weights of hashed features, of earlier probabilities, and a bias."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, earlier: np.ndarray, bias: float):
        self.weight = dict(zip(ids.tolist(), weights.tolist()))
        self.earlier, self.bias = earlier, bias


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(rows: list[np.ndarray], dense: np.ndarray, y: np.ndarray) -> Model:
    """Proximal gradient steps on the logistic loss with an L1 penalty."""
    flat, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids, place = np.unique(flat, return_inverse=True)
    every, positive = np.bincount(place), np.bincount(place, weights=y[of])
    n, n1 = len(y), max(1.0, y.sum())
    p1, p0, p = positive / n1, (every - positive) / max(1.0, n - n1), every / n
    z = np.abs(p1 - p0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / max(1.0, n - n1)))
    good = np.flatnonzero((z >= DIFFERENCE) & (every >= TEXTS))
    good = np.sort(good[np.argsort(-z[good], kind="stable")][:USED])
    rank = np.full(len(ids), -1)
    rank[good] = np.arange(len(good))
    keep = rank[place] >= 0
    col, row, k, d = rank[place][keep], of[keep], len(good), dense.shape[1]
    dot = lambda w: np.bincount(row, weights=w[col], minlength=n) + dense @ w[k:k + d] + w[-1]

    def back(r):
        return np.concatenate([np.bincount(col, weights=r[row], minlength=k), dense.T @ r, [r.sum()]])

    v = np.ones(k + d + 1)  # the greatest curvature, by power iteration
    for _ in range(15):
        v = back(dot(v))
        v /= np.linalg.norm(v)
    step = 4 * n / max(1e-9, float(np.linalg.norm(back(dot(v)))))
    w = np.zeros(k + d + 1)
    w[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    ahead, t = w, 1.0
    for _ in range(STEPS):
        new = ahead - step * back(_sigmoid(dot(ahead)) - y) / n
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * PENALTY, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    used = np.flatnonzero(w[:k])
    return Model(ids[good[used]], w[used], w[k:k + d], float(w[-1]))


def margin(model: Model, ids, earlier) -> float:
    get = model.weight.get
    return sum(get(i, 0.0) for i in ids) + float(np.dot(model.earlier, earlier)) + model.bias


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The middle of the cuts with the best F1, and 0.5 if they hold it."""
    cuts = np.unique(np.concatenate([[0.0, 1.0], p]))
    cuts = (cuts[1:] + cuts[:-1]) / 2
    order = np.argsort(p, kind="stable")
    at = np.searchsorted(p[order], cuts)
    hits = y.sum() - np.concatenate([[0], np.cumsum(y[order])])[at]
    f1 = 2 * hits / np.maximum(1, (len(p) - at) + y.sum())
    best = cuts[f1 >= f1.max() - 1e-12]
    return float(np.clip(0.5, best.min(), best.max()))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, j in slices(texts):
            ids = [sorted({f for w in terms_of(t) for f in features_of(w)}) for t in texts[i:j]]
            terms = [sorted(terms_of(t) & {w for ws in KINDS.values() for w in ws}) for t in texts[i:j]]
            rest = batch.drop_columns(["text"]).slice(i, j - i)
            cols = [*rest.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(terms, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, names=[*rest.schema.names, "ids", "terms"])


def _chain(train: DataFrame, name: str, earlier: list[str]) -> tuple[Model, DataFrame]:
    """The model of a category on all rows, and the rows with their
    out-of-fold probabilities `p_<name>`."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        k = int(group["model"].iloc[0])
        group = group.sort_values("row")
        own = (group["fold"] != k).to_numpy()
        dense = group[earlier].to_numpy(dtype=float).reshape(len(group), len(earlier))
        rows, y = group["ids"].to_numpy(), group[f"y_{name}"].to_numpy(dtype=float)
        m = fit(list(rows[own]), dense[own], y[own]) if own.any() else Model(np.zeros(0), np.zeros(0), np.zeros(len(earlier)), 0.0)
        if k == FOLDS:  # the model of all rows
            key = [*m.weight, *range(-len(earlier) - 1, 0)]
            return pd.DataFrame({"row": key, "value": [*m.weight.values(), *m.earlier, m.bias], "weight": True})
        rest = np.flatnonzero(~own)
        p = [_sigmoid(margin(m, rows[i].tolist(), dense[i])) for i in rest]
        return pd.DataFrame({"row": group["row"].to_numpy()[rest], "value": p, "weight": False})

    fits = train.withColumn("model", F.explode(F.array(*map(F.lit, range(FOLDS + 1))))).groupBy("model").applyInPandas(
        one, "row long, value double, weight boolean")
    fits = written(fits, "toxic-fits")
    found = fits.filter("weight").collect()  # USED rows and a few at most
    weights = {r["row"]: r["value"] for r in found}
    tail = [weights[i] for i in range(-len(earlier) - 1, 0)]
    words = sorted(i for i in weights if i >= 0)
    model = Model(np.array(words), np.array([weights[i] for i in words]), np.array(tail[:-1]), tail[-1])
    return model, written(train.join(fits.filter("NOT weight").select("row", F.col("value").alias(f"p_{name}")), "row"), "toxic-chain")


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", kinds: dict[str, tuple[str, ...]] = KINDS, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: `doc_id`, a probability `p_<category>` for each
    category in order, and `toxic`."""
    names = [*kinds, "toxic"]
    rows = docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    known = (labels.select(id_of(id_col).alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label")))
    known = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "toxic-labels")
    picked = rows.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "label", "text")
    train = picked.mapInArrow(_features, "doc_id long, label int, ids array<int>, terms array<string>")
    y = {n: F.arrays_overlap("terms", F.array(*map(F.lit, t))) & (F.col("label") == 1) for n, t in kinds.items()}
    y["toxic"] = F.col("label") == 1
    train = written(train.select(F.col("doc_id").alias("row"), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).alias("fold"),
                                 "ids", *[c.cast("double").alias(f"y_{n}") for n, c in y.items()]), "toxic-train")
    if train.select("y_toxic").distinct().count() < 2:
        return rows.select("doc_id", *[F.lit(None).cast("double").alias(f"p_{n}") for n in names], F.lit(False).alias("toxic"))
    chain: list[Model] = []
    for name in names:
        model, train = _chain(train, name, [f"p_{n}" for n in names[:len(chain)]])
        chain.append(model)
    oof = train.select("p_toxic", "y_toxic").toPandas()  # `sample` rows at most
    cut = best_cut(oof["p_toxic"].to_numpy(), oof["y_toxic"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast((chain, cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, least = shared.value
        weighty = set().union(*(m.weight for m in models))
        seen: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for i, j in slices(texts):
                out: list[list[float]] = [[] for _ in models]
                for t in texts[i:j]:
                    own: set[int] = set()
                    for w in terms_of(t):
                        f = seen.get(w)
                        if f is None:
                            if len(seen) > 500_000:
                                seen.clear()
                            f = seen[w] = tuple(x for x in features_of(w) if x in weighty)
                        if f:
                            own.update(f)
                    ps: list[float] = []
                    for m, o in zip(models, out):
                        ps.append(float(_sigmoid(margin(m, sorted(own), ps))))
                        o.append(ps[-1])
                cols = [ids.slice(i, j - i), *(pa.array(o, pa.float64()) for o in out), pa.array([p >= least for p in out[-1]])]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *(f"p_{n}" for n in names), "toxic"])

    return rows.mapInArrow(run, ", ".join(["doc_id long", *(f"p_{n} double" for n in names), "toxic boolean"]))
