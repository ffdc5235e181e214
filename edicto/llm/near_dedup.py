"""Near-duplicate classes by BagMinHash, banding and verification (operator 6).

Two texts are linked if the multisets of their five-word shingles have a
weighted Jaccard similarity of THRESHOLD or more; classes are the connected
components of the links.  Texts with the same words collapse into one first,
so copies are never compared.  Steps:

1. Every text gets BANDS band keys and a sketch of one byte per register.
   A pair at the threshold shares no band with a probability below 2e-5.
2. Texts that share a key form a bucket.  A text's weight is the number of
   texts it meets in its buckets; each text is compared with the heaviest
   text of its buckets.  That links most of a group in linear time.
3. Where a bucket still holds several components, one text of each is compared
   with one of the bucket's heaviest component.
4. In buckets that even then hold several components, the pairs from different
   components are compared inside tasks, tile against tile, first by sketch
   and then by multiset; only links that connect components leave a task.

Every link is verified on the whole multisets (array intersection in the JVM).
Sketches only rule out pairs whose estimate lies below ESTIMATE, four standard
deviations under the threshold.  No bucket, partner or candidate is capped.
Buckets are never gathered: their sizes and heaviest texts come from aggregates
with a map-side part, and a tile holds about TILE_ITEMS multiset elements.

Defined results: a null text counts as empty; texts without words form one
class; a text of under five words is one shingle; null ids sort last, and a
class is named after its smallest id; of rows that repeat an id in one class
one is kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.llm import bag_minhash as BM
from edicto.llm.bpe import gather, slices
from edicto.llm.common import SPACE_RUN, SPACES, id_of, release, text_of, written
from edicto.llm.components import components

THRESHOLD = 0.8
#: Estimated similarity from which a pair is compared; at 0.8 the estimate has
#: a standard deviation of 0.027 (216 registers), so this is four of them below.
ESTIMATE = 0.69
#: Elements of a tile, and the band around the threshold that 32-bit hashes leave open.
TILE_ITEMS = 1_000_000
MARGIN = 0.005
SLICE_CHARS = 1_500_000


def words_key(text: Column) -> Column:
    """128 bits that stand for the text's sequence of words."""
    plain = F.regexp_replace(F.btrim(text, F.lit(SPACES)), SPACE_RUN, " ")
    return F.substring(F.unhex(F.sha2(plain, 256)), 1, 16)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rest = batch.drop_columns(["text"])
        for i, j in slices(texts, SLICE_CHARS):
            doc, h, count = BM.shingles(texts[i:j])
            keys, sketch = BM.bands(BM.signatures(j - i, doc, h, count))
            empty = np.bincount(doc, minlength=j - i) == 0
            offsets = np.concatenate([[0], np.cumsum(np.where(empty, 0, BM.BANDS))]).astype(np.int32)
            cols = {"bands": pa.ListArray.from_arrays(offsets, pa.array(keys[~empty].reshape(-1))),
                    "sketch": pa.array([r.tobytes() for r in sketch], pa.binary())}
            part = rest.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([*part.columns, *cols.values()], names=[*part.schema.names, *cols])
    release()


def _multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, j in slices(texts, SLICE_CHARS):
            sets = BM.occurrences(texts[i:j])
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            items = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets)))
            short = pa.array([s.astype(np.uint32).tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, j - i), items, short], names=["key", "items", "short"])
    release()


def estimated(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs `a, b` whose sketches agree in ESTIMATE of all places or more."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            x, y = (np.frombuffer(b"".join(p[c]), dtype=np.uint8).reshape(-1, BM.REGISTERS) for c in ("sa", "sb"))
            yield p.loc[(x == y).mean(axis=1) >= ESTIMATE, ["a", "b"]]

    both = (pairs.join(sketches.select(F.col("key").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(sketches.select(F.col("key").alias("b"), F.col("sketch").alias("sb")), "b"))
    return both.select("a", "b", "sa", "sb").mapInPandas(near, "a binary, b binary")


def verified(pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs `a, b` that are linked: overlap of the whole multisets."""
    near = estimated(pairs, sketches)
    both = (near.join(sets.select(F.col("key").alias("a"), F.col("items").alias("xs")), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("items").alias("ys")), "b"))
    common = F.size(F.array_intersect("xs", "ys"))
    union = F.size("xs") + F.size("ys") - F.col("common")
    linked = both.select("a", "b", "xs", "ys", common.alias("common")).filter(F.col("common") * 100 >= union * round(THRESHOLD * 100))
    return written(linked.select("a", "b"), "links")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def _with_component(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components."""
    comp = components(links)
    known = members.join(comp.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    known = written(known, "bucket-components")
    mixed = known.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("band")
    return known.join(mixed, "band")


def _linked(rows: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """Links between different components of two tiles of a bucket.

    Sketches rule pairs out, the rest is compared on whole multisets (32-bit
    hashes here; pairs within MARGIN of the threshold are left to the exact
    check that follows).  A sure link merges its components, so only links
    that connect something are returned."""
    comp, tile, i, j = pd.factorize(rows["comp"])[0], rows["tile"].to_numpy(), rows["i"].iloc[0], rows["j"].iloc[0]
    side = {t: np.flatnonzero(tile == t) for t in (i, j)}
    first = comp != np.bincount(comp).argmax()  # pairs with both sides in the largest component need no test
    s = np.frombuffer(b"".join(rows["sketch"]), dtype=np.uint8).reshape(-1, BM.REGISTERS)
    tests = []
    for x in np.flatnonzero(first).tolist():
        y = side[j if tile[x] == i else i]
        y = y[(comp[y] != comp[x]) & (~first[y] | (y > x))]
        if len(y) and len(y := y[np.count_nonzero(s[y] == s[x], axis=1) >= ESTIMATE * BM.REGISTERS]):
            tests.append((x, y))
    if not tests:
        return []
    key = rows["key"].to_numpy()
    items = [np.frombuffer(x, dtype=np.uint32) for x in rows["items"]]
    size = np.array([len(x) for x in items])
    code = np.unique(np.concatenate(items), return_inverse=True)[1]
    start = np.cumsum(size) - size
    mark = np.zeros(int(code.max(initial=-1)) + 1, dtype=bool)
    out = []
    for x, y in tests:
        y = y[comp[y] != comp[x]]
        if not len(y):
            continue
        own = code[start[x]:start[x] + size[x]]
        mark[own] = True
        common = np.add.reduceat(mark[gather(code, start[y], size[y])], np.cumsum(size[y]) - size[y])
        mark[own] = False
        alike = common / (size[x] + size[y] - common)
        for k in np.flatnonzero(alike >= THRESHOLD - MARGIN).tolist():
            if comp[y[k]] != comp[x]:
                out.append((key[x], key[y[k]]))
                if alike[k] >= THRESHOLD + MARGIN:
                    comp[comp == comp[y[k]]] = comp[x]
    return out


def _connect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """`_linked` for each group of a partition sorted by `band, i, j`; the
    last group of a batch waits for the next one."""
    rest: pd.DataFrame | None = None

    def links(rows: pd.DataFrame, cuts: list[int]) -> pd.DataFrame:
        found = [p for a, b in zip(cuts, cuts[1:]) if b - a > 1 for p in _linked(rows.iloc[a:b])]
        return pd.DataFrame(found, columns=["a", "b"])

    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        group = rows[["band", "i", "j"]].to_numpy()
        cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1).tolist()]
        yield links(rows, cuts)
        rest = rows.iloc[cuts[-1]:]
    if rest is not None:
        yield links(rest, [0, len(rest)])
    release()


def _tiles(members: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that may connect components of the buckets of `band, key, comp`.
    A tile holds about TILE_ITEMS multiset elements."""
    sized = members.join(sets.select("key", (F.octet_length("short") / 4).alias("n")), "key")
    sizes = sized.groupBy("band").agg(F.greatest(F.ceil(F.sum("n") / TILE_ITEMS).cast("long"), F.lit(1).cast("long")).alias("tiles"))
    placed = members.join(sizes, "band").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    copies = placed.withColumn("other", other).select(
        "band", "key", "comp", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
    return (copies.join(sketches, "key").join(sets.select("key", F.col("short").alias("items")), "key")
            .repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInPandas(_connect, "a binary, b binary"))


def near_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per input row: `doc_id, class_id, class_size, kept`; with
    `carry` also the input row as struct `doc`.  `class_id` is the smallest id
    of the class, and `kept` marks the one row that stands for it."""
    text = text_of(text_col)
    rows = docs.select(id_of(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row_id"), words_key(text).alias("key"),
                       text.alias("text"), *([F.struct("*").alias("doc")] if carry else []))
    source = rows
    if carry:
        rows = written(rows.select("doc_id", "row_id", "key", "doc"), "near-rows")
        source = rows.select("doc_id", "row_id", "key", text_of(f"doc`.`{text_col}").alias("text"))
    signed = written(source.mapInArrow(_sign, "doc_id long, row_id long, key binary, bands array<long>, sketch binary"), "signatures")
    texts = source.select("key", "text")

    # Texts that share a band with another text, with their buckets.
    # Copies collapse on the map side first, so a text held by many rows meets
    # in no task.
    once = signed.groupBy("key").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    bucket = once.select("key", F.explode("bands").alias("band"))
    shared = bucket.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(bucket.join(shared, "band"), "buckets")
    weight = members.groupBy("key").agg(F.sum("n").alias("weight"))
    members = written(members.join(weight, "key").select("band", "key", "weight"), "bucket-members")
    candidates = members.select("key").distinct()
    sketches = written(once.select("key", "sketch").join(candidates, "key", "left_semi"), "sketches")
    one_text = texts.groupBy("key").agg(F.first("text").alias("text"))
    sets = written(one_text.join(candidates, "key", "left_semi").select("key", "text").mapInArrow(_multisets, "key binary, items array<long>, short binary"), "multisets")

    rank = F.struct("weight", "key")
    heads = members.groupBy("band").agg(F.max(rank).alias("head"))
    best = members.join(heads, "band").groupBy("key").agg(F.max("head").alias("head"))
    tried = written(_ordered(best.select(F.col("key").alias("a"), F.col("head.key").alias("b"))), "pairs")
    links = verified(tried, sketches, sets)

    mixed = _with_component(members, links)
    firsts = mixed.groupBy("band", "comp").agg(F.max(rank).alias("first"))
    heads = firsts.groupBy("band").agg(F.max("first").alias("head"))
    pairs = _ordered(firsts.join(heads, "band").select(F.col("first.key").alias("a"), F.col("head.key").alias("b")))
    links = written(links.unionByName(verified(pairs.join(tried, ["a", "b"], "left_anti"), sketches, sets)), "links")

    mixed = written(_with_component(members, links).select("band", "key", "comp"), "bucket-rest")
    pairs = written(_ordered(_tiles(mixed, sketches, sets)), "pairs")
    links = links.unionByName(verified(pairs, sketches, sets))
    comp = components(links)

    # Classes, named after their smallest id; only texts with copies or links
    # need a look-up, and the hottest (fewer than 1000 by definition) are broadcast.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "row_id")
    each = signed.groupBy("key").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    each = each.join(comp.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    each = written(each, "near-texts")
    classes = each.groupBy("comp").agg(F.min("first").alias("head"), F.sum("n").alias("class_size")).filter("class_size > 1")
    found = written(each.select("key", "comp", "n").join(classes, "comp").select("key", "n", "head", "class_size"), "near-classes")
    total = F.lit(each.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    hot = F.broadcast(found.filter(F.col("n") * 1000 > total))
    slim = signed.select("doc_id", "row_id", "key")
    cols = ["doc_id", "row_id", F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.id")).alias("class_id"),
            F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
            F.coalesce(F.col("head.row_id") == F.col("row_id"), F.lit(True)).alias("kept")]
    out = (slim.join(hot, "key").select(*cols)
           .unionByName(slim.join(hot.select("key"), "key", "left_anti").join(found.filter(F.col("n") * 1000 <= total), "key", "left").select(*cols)))
    if not carry:
        return out.drop("row_id")
    dropped = written(out.filter("NOT kept").select("row_id"), "dropped")  # a known size: broadcast only if small
    return rows.join(dropped, "row_id", "left_anti").select("doc")


def near_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stand for their classes, with the input's columns."""
    return near_rows(docs, id_col=id_col, text_col=text_col, carry=True).select("doc.*")
