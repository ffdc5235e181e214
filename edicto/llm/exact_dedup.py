"""Exact deduplication against a persistent digest index (operator 2, native).

The index is a table bucketed and sorted by the SHA-256 digest of the
normalised text.  A batch is reduced to one row per digest (map-side minimum,
so a text that a third of all rows share costs one row per task), joined
against the index with a sort-merge anti join, and what is new is appended.
The index side of that join is read bucket by bucket, without a shuffle.

The bucket count is the index's own, so sessions with other shuffle settings
use it alike.  Batches that share an index are looked up in what the earlier
ones left.

Defined results: a null text counts as empty; of equal texts the row with the
smallest id stays, a null id counts as largest, and of rows that repeat one id
exactly one stays (`kept`); a text the index already holds from an earlier
batch keeps the id found then, and none of its rows stays; an empty batch
appends nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.llm.common import SPACE_RUN, id_of, text_of, written

#: A digest is hot if it holds over one row in HOT; so at most HOT of them exist.
HOT = 1000


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE_RUN, " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def new_index_name() -> str:
    return f"llm_digest_index_{uuid.uuid4().hex}"


def index_buckets(spark, table: str, buckets: int | None) -> int:
    """The bucket count of the index: its own if it exists, whatever this
    session's settings are; else it is made with `buckets`."""
    if spark.catalog.tableExists(table):
        own = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
        return int(own["data_type"])
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    empty = spark.createDataFrame([], "digest binary, keep_id long, batch string")
    empty.write.bucketBy(buckets, "digest").sortBy("digest").saveAsTable(table)
    return buckets


def append_new(groups: DataFrame, table: str, batch: str, buckets: int | None) -> None:
    """Append the digests of `groups` that the index lacks.  A second run with
    the same rows appends nothing, so a job may be repeated after a failure."""
    spark = groups.sparkSession
    buckets = index_buckets(spark, table, buckets)
    known = spark.table(table).select("digest")
    fresh = groups.join(known.hint("merge"), "digest", "left_anti")
    (fresh.select("digest", F.col("first.id").alias("keep_id"), F.lit(batch).alias("batch"))
     .repartition(buckets, "digest")
     .write.mode("append").bucketBy(buckets, "digest").sortBy("digest").saveAsTable(table))
    spark.catalog.refreshTable(table)


def look_up(rows: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """`rows` left-joined with `found` by digest.  Hot digests, at most HOT by
    their definition, are broadcast; each other holds under 1/HOT of the rows."""
    is_hot = F.col("group_size") * HOT > F.lit(total)
    hot = F.broadcast(found.filter(is_hot))
    rest = rows.join(hot.select("digest"), "digest", "left_anti").join(found.filter(~is_hot), "digest", "left")
    return rows.join(hot, "digest").unionByName(rest)


def dedup_rows(docs: DataFrame, table: str | None = None, buckets: int | None = None, *, batch: str | None = None,
               id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per input row: `doc_id, keep_id, group_size, kept, known, digest, row_id`,
    and with `carry` the input row as struct `doc`.

    `table` names the index; without one an index is made for this call.
    `buckets` counts only for a new index.  `group_size` counts the rows of this
    batch with the same text; `known` is true if an earlier batch had it.  `batch` names the batch
    in the index; a job that is repeated after a failure gives the same name
    and the same rows, and keeps what the first run would have kept.  Without
    a name each call is a batch of its own.
    """
    spark = docs.sparkSession
    table, own_table = table or new_index_name(), table is None
    batch = batch or uuid.uuid4().hex
    rows = docs.select(id_of(id_col).alias("doc_id"), digest(text_of(text_col)).alias("digest"),
                       F.monotonically_increasing_id().alias("row_id"),
                       *([F.struct("*").alias("doc")] if carry else []))
    rows = written(rows, "digests")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "row_id")
    groups = written(rows.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("group_size")),
                     "digest-groups")
    append_new(groups, table, batch, buckets)
    index = spark.table(table).select("digest", "keep_id", (F.col("batch") == batch).alias("fresh"))
    found = written(groups.join(index.hint("merge"), "digest")
                    .select("digest", "keep_id", "group_size", "fresh", F.col("first.row_id").alias("keep_row")),
                    "digest-found").filter("group_size > 1 OR NOT fresh")
    if own_table:  # nothing reads it any more
        spark.sql(f"DROP TABLE {table}")
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    decided = [F.coalesce("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id"))).alias("keep_id"),
               F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
               F.coalesce(F.col("fresh") & (F.col("keep_row") == F.col("row_id")), F.lit(True)).alias("kept"),
               F.coalesce(~F.col("fresh"), F.lit(False)).alias("known")]
    out = look_up(rows.select("doc_id", "digest", "row_id"), found, total).select("doc_id", *decided, "digest", "row_id")
    if not carry:
        return out
    dropped = written(out.filter("NOT kept").select("row_id"), "dropped")  # a known size: broadcast only if small
    return rows.join(dropped, "row_id", "left_anti").select("doc", "digest", "row_id")


def dedup_batches(batches: list[DataFrame], table: str | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `dedup_rows` for batches that arrive one after the other at one index;
    `group_size` counts the rows of all of them.  A text stays where it came
    first, so batches in the order of their ids keep the smallest id."""
    spark, own_table = batches[0].sparkSession, table is None
    table = table or new_index_name()
    out = [written(dedup_rows(b, table, batch=f"batch-{i:06d}", id_col=id_col, text_col=text_col), "batch-rows") for i, b in enumerate(batches)]
    if own_table:
        spark.sql(f"DROP TABLE {table}")
    rows = out[0]
    for b in out[1:]:
        rows = rows.unionByName(b)
    # only texts that a later batch met again have another size
    sizes = written(rows.groupBy("digest").agg(F.count("*").alias("group_size"), F.bool_or("known").alias("again"))
                    .filter("again").drop("again"), "batch-sizes")
    own = rows.withColumnRenamed("group_size", "own_size")
    return look_up(own, sizes, rows.count()).select("doc_id", "keep_id", F.coalesce("group_size", "own_size").alias("group_size"), "kept", "known", "digest")


def exact_dedup(docs: DataFrame, table: str | None = None, buckets: int | None = None, *, batch: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stay, with the input's columns; parameters as in `dedup_rows`."""
    return dedup_rows(docs, table, buckets, batch=batch, id_col=id_col, text_col=text_col, carry=True).select("doc.*")
