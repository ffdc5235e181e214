"""L1 and L4 for word lists of any length.

`contains_any` tests one word after the other, which is right for the few
subject words of the courts.  Here the words are a table: every place of a
run of word signs is looked up once per key length (the shortest word's, doubled
as far as the words reach), so the cost doesn't depend on how many words there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.functions.text import let
from edicto.session import written

#: Characters of a run that are cut into places at a time.
BLOCK = 256


def _key_length(n: Column, shortest: int) -> Column:
    """The largest `shortest`, doubled any number of times, that is at most `n`."""
    return (shortest * F.pow(F.lit(2), F.length(F.bin(F.floor(n / shortest))) - 1)).cast("int")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _sign_class(signs: list[str]) -> str:
    """A character class of the given signs, neighbours as ranges."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, signs)):
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]"


def _pieces(df: DataFrame, text_col: str, signs: str, shortest: int, longest: int) -> DataFrame:
    """`_digest, _piece`: the runs of word signs that can hold a word, each once
    per text.  Long runs are cut into blocks, because counting characters up to
    a place takes time that grows with the place; a block sees the next one's start."""
    size = max(BLOCK, longest)
    runs = F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(f"{signs}{{{shortest},}}"), F.lit(0)))
    seen = df.filter(F.col(text_col).isNotNull()).select(_digest(F.col(text_col)).alias("_digest"), F.explode(runs).alias("_run"))
    after = lambda blocks, i: F.substring(F.coalesce(F.get(blocks, i + 1), F.lit("")), 1, longest - 1)
    cut = let(F.regexp_extract_all("_run", F.lit(f"(?s).{{1,{size}}}"), F.lit(0)),
              lambda blocks: F.transform(blocks, lambda b, i: F.concat(b, after(blocks, i))))
    return seen.select("_digest", F.explode(F.when(F.length("_run") <= size, F.array("_run")).otherwise(cut)).alias("_piece"))


def _places(pieces: DataFrame, lengths: list[int], longest: int) -> DataFrame:
    """`_no, _window, _size, _key`: every place of every piece, with the
    characters a word may take from there, once per key length it has room for."""
    place = pieces.select("_no", "_piece", F.explode(F.sequence(F.lit(1), F.length("_piece"))).alias("_at"))
    window = place.select("_no", F.substring("_piece", F.col("_at"), F.lit(longest)).alias("_window"))
    sizes = window.select("_no", "_window", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("_size"))
    return (sizes.filter(F.length("_window") >= F.col("_size"))
            .withColumn("_key", F.substring("_window", F.lit(1), F.col("_size"))))


def classify_words(df: DataFrame, text_col: str, words: DataFrame, label_col: str = "label") -> DataFrame:
    """`df` with `label_col`: of the words that are substrings of the text, the
    label of the one with the lowest (priority, label), or null.

    words: word, priority, label.  A word may be listed more than once; null
    words never hit, and the empty word hits every text that isn't null.  A null
    text has no label.  Words lie in runs of the signs that words are made of, so
    a text is cut to those runs and each different run of all texts is searched
    once, whatever the texts repeat; texts take the best of their runs.  Word
    lists and hits are written first and broadcast if their bytes are under
    Spark's limit.  Beyond it what is shuffled grows with the different runs:
    for words of letters those are the words of the texts, for phrases with
    spaces and all signs it may be every place of every text."""
    best = F.min(F.struct("priority", "label"))
    listed = written(words.filter("word IS NOT NULL").groupBy("word").agg(best.alias("_rule")), "words")
    filled = listed.filter("word <> ''")
    about = filled.agg(F.min(F.length("word")).alias("shortest"), F.max(F.length("word")).alias("longest")).first()
    empty = listed.filter("word = ''").first()  # one row: words are distinct
    always = F.lit(None).cast(listed.schema["_rule"].dataType)
    if empty is not None:
        rule = empty["_rule"]
        always = F.struct(F.lit(rule["priority"]).alias("priority"), F.lit(rule["label"]).alias("label")).cast(listed.schema["_rule"].dataType)
    shortest, longest = about["shortest"], about["longest"]
    if longest is None:
        return df.withColumn(label_col, F.when(F.col(text_col).isNotNull(), always["label"]))
    signs = [r[0] for r in filled.select(F.explode(F.split("word", ""))).distinct().collect()]  # an alphabet
    filled = filled.withColumn("_word_size", _key_length(F.length("word"), shortest))
    lengths = sorted(r[0] for r in filled.select("_word_size").distinct().collect())
    keyed = filled.withColumn("_word_key", F.substring("word", F.lit(1), F.col("_word_size")))

    pairs = _pieces(df, text_col, _sign_class(signs), shortest, longest)
    pieces = written(pairs.select("_piece").distinct().withColumn("_no", F.monotonically_increasing_id()), "word-pieces")
    hits = (_places(pieces, lengths, longest).join(
                keyed, (F.col("_size") == F.col("_word_size")) & (F.col("_key") == F.col("_word_key")) & F.startswith("_window", "word"))
            .groupBy("_no").agg(F.min("_rule").alias("_rule")))
    hits = written(pieces.join(written(hits, "word-hits"), "_no").select("_piece", "_rule"), "word-piece-hits")
    found = written(pairs.join(hits, "_piece").groupBy("_digest").agg(F.min("_rule").alias("_rule")), "word-texts")
    # the text itself takes no part in this join where the caller doesn't keep it
    marked = df.withColumns({"_digest": _digest(F.col(text_col)), "_given": F.col(text_col).isNotNull()})
    rule = F.when(F.col("_given"), F.least("_rule", always))
    return marked.join(found, "_digest", "left").select(*[F.col(f"`{c}`") for c in df.columns], rule["label"].alias(label_col))
