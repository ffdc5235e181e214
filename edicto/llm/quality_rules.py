"""Quality rules with adaptive thresholds (operator 5, native).

Per document, counts are taken with array functions.  Four ratios, in
thousandths, feed a mergeable quantile sketch: a histogram of bins with a
relative width of 1 % at most, whose counts add up over tasks, sources and
languages.  The quartiles of a document's language and source set a fence,
`q75 + REACH * (q75 - q25) + slack`; documents beyond a fence are rejected.
A language's sketch takes in that of all documents with the weight of PRIOR
documents, a source's sketch its language's likewise, so a small group leans on
the larger one and no size switches between them.  The weights are whole
numbers, so the blend is exact.

Defined results: a null text counts as empty and fails the base rule; null
language or source form a group of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from edicto.llm.common import SPACES, id_of, let, text_of, words_of, written

MIN_WORDS = 20
WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
REACH = 6
#: Documents that the larger group's sketch counts for in the smaller one's.
PRIOR = 50
#: Ratio in thousandths -> slack beyond the fence, in thousandths.
SLACK = {"symbol": 100, "dup_line": 100, "repeat": 300, "word_len": 4000}


def _window(words: Column, i: Column) -> Column:
    return F.slice(words, i + 1, WINDOW)


def _covered(positions: Column) -> Column:
    """Words covered by windows at the given ascending positions."""
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(p - a["last"], F.lit(WINDOW))).alias("n"))
    return F.aggregate(positions, start, step, lambda a: a["n"])


def repeat_words(words: Column) -> Column:
    """Words inside WINDOW-word windows that occur twice or more in the text.

    Window hashes tell in linear time whether a text has any repeat; only then
    are the windows themselves sorted and compared.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(_window(words, i)))
    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    grams = F.array_sort(F.transform(starts, lambda i: F.struct(F.array_join(_window(words, i), " ").alias("g"), i.alias("i"))))
    twice = let(grams, lambda s: F.filter(s, lambda x, j: F.coalesce(
        (F.get(s, j - 1)["g"] == x["g"]), F.lit(False)) | F.coalesce(F.get(s, j + 1)["g"] == x["g"], F.lit(False))))
    exact = _covered(F.array_sort(F.transform(twice, lambda x: x["i"])))
    return F.when(F.size(words) < 2, 0).when(F.size(words) <= WINDOW, 0).when(repeats, exact).otherwise(0).cast("long")


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`doc` (the input row as a struct) and the counts of the base rules."""
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return (docs.select(F.struct("*").alias("doc"), text_of(text_col).alias("t"))
            .select("doc", "t", words_of(F.col("t")).alias("w"))
            .select("doc",
                    F.size("w").cast("long").alias("n_words"),
                    F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
                    F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                    let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                    repeat_words(F.col("w")).alias("n_repeat_words"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))))


def _ratio(n: str) -> Column:
    return F.floor(1000 * F.col(n) / F.greatest("n_words", F.lit(1))).cast("long")


def _bin(v: Column) -> Column:
    """Three leading digits: bins no wider than 1 % of their value."""
    width = F.pow(F.lit(10.0), F.greatest(F.length(v.cast("string")) - 3, F.lit(0))).cast("long")
    return v - v % width


def _ratios() -> Column:
    return F.array(*[F.struct(F.lit(m).alias("metric"), _bin(_ratio(n)).alias("bin")) for m, n in (
        ("symbol", "n_symbols"), ("dup_line", "n_dup_lines"), ("repeat", "n_repeat_words"), ("word_len", "word_chars"))])


def thresholds(counted: DataFrame) -> DataFrame:
    """`lang, source, fence` (a map from ratio to its highest value allowed).

    `counted` has `lang`, `source` and the counts; documents that fail the
    base rule do not count.
    """
    cells = (counted.filter("NOT base_failed").select("lang", "source", F.explode(_ratios()).alias("r"))
             .groupBy("lang", "source", "r.metric", "r.bin").agg(F.count("*").alias("n")))
    groups = counted.select(_filled("lang"), _filled("source")).distinct()
    cells = written(cells.select(_filled("lang"), _filled("source"), "metric", "bin", "n"), "quality-sketch")  # bounded per group by its bins
    overall = _with_total(cells, ["metric"]).select("metric", "bin", F.col("n").alias("above"), F.col("all").alias("above_all"))
    by_lang = _blend(groups.select("lang").distinct(), overall, cells, ["lang"])
    by_lang = by_lang.withColumnsRenamed({"n": "above", "all": "above_all"})
    by_source = _blend(groups, by_lang, cells, ["lang", "source"])
    part = W.partitionBy("lang", "source", "metric")
    ranked = by_source.withColumn("upto", F.sum("n").over(part.orderBy("bin")))
    at = lambda q: F.min(F.when(100 * F.col("upto") >= q * F.col("all"), F.col("bin")))
    q = ranked.groupBy("lang", "source", "metric").agg(at(25).alias("q25"), at(75).alias("q75"))
    slack = F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv])[F.col("metric")]
    q = q.withColumn("f", F.col("q75") + REACH * (F.col("q75") - F.col("q25")) + slack)
    fences = q.groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("metric", "f"))).alias("fence"))
    plain = lambda c: F.when(F.col(c) != "", F.substring(c, 2, 2**31 - 1)).alias(c)
    return groups.join(fences, ["lang", "source"], "left").select(plain("lang"), plain("source"), "fence")


def _filled(c: str) -> Column:
    """A group's name as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(c)


def _with_total(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of the groups `keys`: `n` per bin and `all` of the group."""
    big = "decimal(38,0)"
    return (cells.groupBy(*dict.fromkeys([*keys, "metric"]), "bin").agg(F.sum("n").cast(big).alias("n"))
            .withColumn("all", F.sum("n").over(W.partitionBy(*dict.fromkeys([*keys, "metric"])))))


def _blend(groups: DataFrame, above: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of `groups`, each with that of its larger group (`above`,
    which shares all keys but the last) as PRIOR documents: bins of `above`
    with the weight `n * above_all + PRIOR * above` of `all`."""
    own = _with_total(cells, keys).withColumnRenamed("n", "own")
    total = own.groupBy(*keys, "metric").agg(F.max("all").alias("own_all"))
    metrics = groups.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in SLACK])))
    none = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (metrics.join(above, [*keys[:-1], "metric"]).join(total, [*keys, "metric"], "left")
            .join(own.drop("all"), [*keys, "metric", "bin"], "left")
            .select(*keys, "metric", "bin",
                    (none("own") * F.col("above_all") + PRIOR * F.col("above")).cast("decimal(38,0)").alias("n"),
                    ((none("own_all") + PRIOR) * F.col("above_all")).cast("decimal(38,0)").alias("all")))


def judge(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds `kept` to counts that have `lang` and `source`."""
    limits = limits.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "fence")
    joined = counted.join(limits, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    inside = F.lit(True)
    for m, n in (("symbol", "n_symbols"), ("dup_line", "n_dup_lines"), ("repeat", "n_repeat_words"), ("word_len", "word_chars")):
        inside = inside & F.coalesce(_bin(_ratio(n)) <= F.col("fence")[m], F.lit(True))
    # One expression over both sides of the join: no part of it moves below the
    # join, where the optimizer would take the counts a second time.
    return joined.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(inside)).drop("_l", "_s", "fence")


def _key(docs: DataFrame, name: str | None) -> Column:
    return F.col(f"doc.`{name}`").cast("string") if name in docs.columns else F.lit(None).cast("string")


def _counted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return with_counts(docs, text_col).select(
        "doc", F.col(f"doc.`{id_col}`").cast("long").alias("doc_id"),
        _key(docs, lang_col).alias("lang"), _key(docs, source_col).alias("source"), "n_words", "word_chars",
        "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def quality_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: `doc_id`, the counts, `base_failed` and `kept`."""
    counted = written(_counted(docs, id_col, text_col, lang_col, source_col).drop("doc"), "quality-counts")
    return judge(counted, written(thresholds(counted), "quality-fences")).drop("lang", "source")


def quality_filter(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The input rows that the rules keep, with the input's columns.  The
    counts are taken twice, for the thresholds and in the filter's own pass,
    so that no copy of the texts is written."""
    counted = _counted(docs, id_col, text_col, lang_col, source_col)
    limits = thresholds(written(counted.drop("doc"), "quality-counts"))
    return judge(counted, written(limits, "quality-fences")).filter("kept").select("doc.*")
