"""URL filters: rules first, then gradient-boosted trees (operator 9).

Lexical features (lengths, depth, digit ratio, entropy, parameter counts and
statistics of the host's last label) are column expressions.  The trees are
MLlib's, trained on labelled URLs; without other labels, the URLs that a rule
decides are the labelled ones.  Statistics of the last label come from all
labelled URLs, hashed into SUFFIX_BINS bins; the trees see the SAMPLE distinct
URLs whose hashes are smallest, so the bound does not depend on their order.

Defined results: a null URL, or one without `://`, has an empty host and path
and is judged by the trees; rows with the same URL get the same verdict; with
no labelled URL at all, the method allows; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.llm.common import id_of, let, written

#: Rule (host and path) -> verdict; fixed values of the contract.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
SAMPLE = 20_000
SUFFIX_BINS = 256
TREES = 16
DEPTH = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Host with A-Z in lower case; empty for null or without `://`."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits the host, or a host it belongs to, and the path."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # later ones win
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    size = F.greatest(F.length(text), F.lit(1))
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size
    parts = F.transform(F.array_distinct(F.split(text, "")), share)
    return F.aggregate(parts, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


FEATURES = ("url_len", "host_len", "path_len", "query_len", "depth", "labels", "hyphens", "params", "digits",
            "digit_ratio", "capital_ratio", "escapes", "entropy", "host_entropy", "suffix_len", "suffix_rate", "suffix_share")


def with_features(urls: DataFrame) -> DataFrame:
    """Adds all features but the suffix statistics to `url, host, path`."""
    u = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    size = F.greatest(F.length(u), F.lit(1))
    suffix = F.regexp_extract("host", r"([^.]*)$", 1)
    return urls.select(
        "*", F.length(u).alias("url_len"), F.length("host").alias("host_len"), F.length("path").alias("path_len"),
        F.length(query).alias("query_len"), _count(F.col("path"), "/").alias("depth"), _count(F.col("host"), "[.]").alias("labels"),
        _count(u, "-").alias("hyphens"), F.when(query == "", 0).otherwise(_count(query, "&") + 1).alias("params"),
        _count(u, "[0-9]").alias("digits"), (_count(u, "[0-9]") / size).alias("digit_ratio"),
        (_count(u, "[A-Z]") / size).alias("capital_ratio"), _count(u, "%[0-9A-Fa-f]{2}").alias("escapes"),
        let(u, _entropy).alias("entropy"), _entropy(F.col("host")).alias("host_entropy"), F.length(suffix).alias("suffix_len"),
        F.pmod(F.xxhash64(suffix), F.lit(SUFFIX_BINS)).cast("int").alias("suffix_bin"))


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, *, rules: dict[str, str] = RULES,
               id_col: str = "page_id", url_col: str = "url", sample: int = SAMPLE) -> DataFrame:
    """One row per input row: `page_id, host, path, rule, verdict, score`.

    labelled: `url, blocked`; by default the URLs that a rule decides.
    `score` is the trees' probability to block, null where a rule decides.
    """
    rows = pages.select(id_of(id_col).alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = written(rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)), "urls")
    verdict = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv])[F.col("rule")]
    if labelled is None:
        labelled = rows.filter("rule IS NOT NULL").select("url", (verdict == "block").alias("blocked"))
    known = labelled.select("url", F.col("blocked").cast("double").alias("label")).filter("url IS NOT NULL AND label IS NOT NULL")
    known = written(with_features(known.dropDuplicates(["url"]).withColumn("host", host_of(F.col("url")))
                                  .withColumn("path", path_of(F.col("url")))), "url-features")
    stats = {r["suffix_bin"]: r for r in known.groupBy("suffix_bin").agg(
        F.count("*").alias("n"), F.sum("label").alias("b")).collect()}  # SUFFIX_BINS rows at most
    total = sum(r["n"] for r in stats.values())
    ruled = rows.filter("rule IS NOT NULL").select("page_id", "host", "path", "rule", verdict.alias("verdict"),
                                                    F.lit(None).cast("double").alias("score"))
    open_ = rows.filter("rule IS NULL")
    if not total:
        return ruled.unionByName(open_.select("page_id", "host", "path", "rule", F.lit("allow").alias("verdict"),
                                              F.lit(None).cast("double").alias("score")))
    base = sum(r["b"] for r in stats.values()) / total
    rate = F.array(*[F.lit((stats[i]["b"] + 10 * base) / (stats[i]["n"] + 10) if i in stats else base) for i in range(SUFFIX_BINS)])
    share = F.array(*[F.lit(stats[i]["n"] / total if i in stats else 0.0) for i in range(SUFFIX_BINS)])
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    ready = lambda df: vector.transform(df.withColumn("suffix_rate", F.get(rate, F.col("suffix_bin")))
                                        .withColumn("suffix_share", F.get(share, F.col("suffix_bin"))))
    train = known.orderBy(F.xxhash64("url"), "url").limit(sample)
    train = written(ready(train).select("features", "label"), "url-sample")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1).fit(train)
    judged = model.transform(ready(with_features(open_)).select("page_id", "host", "path", "rule", "features"))
    block = F.get(F.col("p"), F.lit(1))
    judged = judged.select("page_id", "host", "path", "rule", vector_to_array("probability").alias("p"))
    return ruled.unionByName(judged.select("page_id", "host", "path", "rule",
                                           F.when(block >= 0.5, "block").otherwise("allow").alias("verdict"), block.alias("score")))
