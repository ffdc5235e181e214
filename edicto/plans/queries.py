"""Registered queries: one per verifiable operator of the inventory.

Every query reads the driver tables (or data Spark derives from them), so
its work grows with the tables.  `QUERIES[name](spark, sf_dir)` returns a
DataFrame; `ORACLE[name]` is the DuckDB SQL giving the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edicto.constants import DEDUP_KEYS
from edicto.functions import extract as X
from edicto.functions.classify import classify_subject, map_code
from edicto.functions.dates import technical_ts
from edicto.functions.text import CLEAN_STEPS, clean, clean_staged
from edicto.operators import records as R
from edicto.operators.joins import absent_from, sized, present_in
from edicto.operators.load import count_matches, first_by_key
from edicto.plans import oracle as O
from edicto.plans.fixtures import (
    fixture_courts,
    fixture_dup,
    fixture_rows,
    read_table,
    spread,
    with_nodes,
)
from edicto.session import shared_path
from edicto.sources import key_index as KI
from edicto.sources.io import append_records, export_json, read_records, with_month

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _fx(spark, sf_dir) -> DataFrame:
    return with_nodes(fixture_rows(spark, sf_dir))


def _fx_court(spark, sf_dir) -> DataFrame:
    courts = fixture_courts(spark).select(
        "court_no", "juzgado", "entidad_code", classify_subject("juzgado").alias("materia")
    )
    return _fx(spark, sf_dir).join(sized(courts), "court_no")


FX = O.with_ctes(O.FX_CTE)
FX_COURTS = O.with_ctes(O.FX_CTE, O.COURTS_CTE)
FXC_FROM = (
    f"(SELECT f.*, c.juzgado, c.entidad_code, {O.classify_subject_sql('c.juzgado')} AS materia "
    "FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no) t"
)

# --- flagship and records -------------------------------------------------------


def bulletin_records_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E14 flagship: captured rows (every tenth captured twice) -> court
    join -> rule cascades -> clean -> valid rows -> first capture wins per
    record key."""
    rows = with_nodes(fixture_dup(spark, sf_dir))
    recs = R.extract_records(rows, fixture_courts(spark), keep=("seq_no", "row_id"))
    return first_by_key(R.valid(recs), DEDUP_KEYS, "seq_no")


def _records_oracle(source: str, keep: tuple[str, ...], extra_ctes=()) -> tuple[list[str], str]:
    ctes, out = O.records_ctes(source=source, keep=keep)
    return [O.FX_CTE, *extra_ctes, O.COURTS_CTE, *ctes], out


def _bulletin_sql() -> str:
    ctes, out = _records_oracle("fixture_dup", ("seq_no", "row_id"), (O.FX_DUP_CTE,))
    cols = ", ".join(["seq_no", "row_id", *[f'"{c}"' for c in R.RECORD_COLUMNS]])
    keys = ", ".join(DEDUP_KEYS)
    return (
        O.with_ctes(*ctes)
        + f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY seq_no) AS rn "
        f"FROM {out} WHERE reject_reason IS NULL) WHERE rn = 1"
    )


register("bulletin_records", _bulletin_sql())(bulletin_records_df)


def _records_sql_all() -> str:
    ctes, out = _records_oracle("fixture_rows", ("row_id",))
    return O.with_ctes(*ctes) + f"SELECT * FROM {out}"


@register("record_shape", _records_sql_all())
def record_shape(spark, sf_dir):
    """L3 + E14 on every fixture row, rejects included (with reason)."""
    return R.extract_records(_fx(spark, sf_dir), fixture_courts(spark), keep=("row_id",))


@register("records_filtered_tipo", _bulletin_sql() + " AND tipo = 'EXHORTO'")
def records_filtered_tipo(spark, sf_dir):
    """The flagship, filtered by its caller on an extracted and cleaned field."""
    return bulletin_records_df(spark, sf_dir).filter(F.col("tipo") == "EXHORTO")


@register("records_filtered_fecha", _bulletin_sql() + " AND fecha BETWEEN '1996/01/01' AND '1996/06/30' AND actor LIKE 'CUSTOMER%'")
def records_filtered_fecha(spark, sf_dir):
    """The flagship, filtered on the cleaned date and a party."""
    return bulletin_records_df(spark, sf_dir).filter(
        F.col("fecha").between("1996/01/01", "1996/06/30") & F.col("actor").startswith("CUSTOMER"))


def _quarantine_sql() -> str:
    ctes, out = _records_oracle("fixture_rows", ("row_id",))
    return O.with_ctes(*ctes) + f"SELECT row_id, reject_reason FROM {out} WHERE reject_reason IS NOT NULL"


@register("quarantine", _quarantine_sql())
def quarantine(spark, sf_dir):
    """G1: rows that cannot become records, with the reason."""
    recs = R.extract_records(_fx(spark, sf_dir), fixture_courts(spark), keep=("row_id",))
    return R.rejected(recs).select("row_id", R.REJECT_COLUMN)


# --- rule cascades one by one ------------------------------------------------------


@register(
    "case_number",
    FX + f"SELECT row_id, {O.case_number_sql(O.N_NUMERO)} AS case_number FROM fixture_rows",
)
def case_number_q(spark, sf_dir):
    return _fx(spark, sf_dir).select("row_id", X.case_number("numero_nodes").alias("case_number"))


@register(
    "case_type",
    FX + f"SELECT row_id, {O.case_type_sql(O.N2, O.N3)} AS case_type FROM fixture_rows",
)
def case_type_q(spark, sf_dir):
    return _fx(spark, sf_dir).select("row_id", X.case_type("n2", "n3").alias("case_type"))


_ACTOR_SQL, _HINT_SQL = O.claimant_sql(O.N2, "materia")


@register(
    "claimant",
    FX_COURTS + f"SELECT row_id, {_ACTOR_SQL} AS actor, {_HINT_SQL} AS demandado_hint FROM {FXC_FROM}",
)
def claimant_q(spark, sf_dir):
    actor, hint = X.claimant_parts("n2", "materia")
    return _fx_court(spark, sf_dir).select(
        "row_id", actor.alias("actor"), hint.alias("demandado_hint")
    )


_DEM_SQL, _PART_SQL = O.defendant_sql(O.N2, "demandado_hint")


@register(
    "defendant",
    FX_COURTS
    + f"SELECT row_id, {_DEM_SQL} AS demandado, {_PART_SQL} AS acuerdos_part FROM "
    f"(SELECT *, {_HINT_SQL} AS demandado_hint FROM {FXC_FROM}) u",
)
def defendant_q(spark, sf_dir):
    _, hint = X.claimant_parts("n2", "materia")
    df = _fx_court(spark, sf_dir).withColumn("demandado_hint", hint)
    dem, part = X.defendant_parts("n2", "demandado_hint")
    return df.select("row_id", dem.alias("demandado"), part.alias("acuerdos_part"))


@register(
    "rulings",
    FX_COURTS
    + "SELECT row_id, "
    + O.rulings_sql(O.N2, O.N3, "actor", "demandado", "acuerdos_part")
    + " AS acuerdos FROM (SELECT *, "
    + O.defendant_sql(O.N2, "demandado_hint")[0] + " AS demandado, "
    + O.defendant_sql(O.N2, "demandado_hint")[1] + " AS acuerdos_part FROM "
    f"(SELECT *, {_ACTOR_SQL} AS actor, {_HINT_SQL} AS demandado_hint FROM {FXC_FROM}) u) v",
)
def rulings_q(spark, sf_dir):
    df = R.extract_fields(_fx_court(spark, sf_dir))
    return df.select("row_id", F.col("_acuerdos").alias("acuerdos"))


@register(
    "origin_court",
    FX + f"SELECT row_id, {O.origin_court_sql(O.N2)} AS origin_court FROM fixture_rows",
)
def origin_court_q(spark, sf_dir):
    return _fx(spark, sf_dir).select("row_id", X.origin_court("n2").alias("origin_court"))


@register(
    "origin_case",
    FX + f"SELECT row_id, {O.origin_case_sql(O.N2)} AS origin_case FROM fixture_rows",
)
def origin_case_q(spark, sf_dir):
    return _fx(spark, sf_dir).select("row_id", X.origin_case("n2").alias("origin_case"))


# --- lookups -----------------------------------------------------------------------


@register(
    "classify_subject",
    FX_COURTS
    + f"SELECT f.row_id, c.juzgado, {O.classify_subject_sql('c.juzgado')} AS materia "
    "FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no",
)
def classify_subject_q(spark, sf_dir):
    courts = sized(fixture_courts(spark).select("court_no", "juzgado"))
    return (
        fixture_rows(spark, sf_dir)
        .join(courts, "court_no")
        .select("row_id", "juzgado", classify_subject("juzgado").alias("materia"))
    )


@register(
    "map_code",
    FX_COURTS
    + f"SELECT f.row_id, c.entidad_code, {O.map_code_sql('c.entidad_code')} AS entidad "
    "FROM fixture_rows f JOIN fixture_courts c ON f.court_no = c.court_no",
)
def map_code_q(spark, sf_dir):
    courts = sized(fixture_courts(spark).select("court_no", "entidad_code"))
    return (
        fixture_rows(spark, sf_dir)
        .join(courts, "court_no")
        .select("row_id", "entidad_code", map_code("entidad_code").alias("entidad"))
    )


@register(
    "technical_ts",
    FX + f"SELECT row_id, fecha, {O.technical_ts_sql('fecha')} AS fecha_tecnica FROM fixture_rows",
)
def technical_ts_q(spark, sf_dir):
    return fixture_rows(spark, sf_dir).select(
        "row_id", "fecha", technical_ts("fecha").alias("fecha_tecnica")
    )


# --- text normalisation over the documents table ------------------------------------


@register(
    "clean_text",
    f"SELECT doc_id, {O.clean_sql('text')} AS text_clean FROM documents",
)
def clean_text_q(spark, sf_dir):
    return spread(read_table(spark, sf_dir, "documents")).select(
        "doc_id", clean_staged("text").alias("text_clean")
    )


CLEAN_FIXTURE = {"td2_first": "td2_clean", "td2_rest": "rest_clean", "td3_first": "td3_clean", "numero": "numero_clean"}


@register(
    "clean_fixture",
    FX + f"SELECT row_id, {', '.join(f'{O.clean_sql(c)} AS {n}' for c, n in CLEAN_FIXTURE.items())} FROM fixture_rows",
)
def clean_fixture_q(spark, sf_dir):
    return fixture_rows(spark, sf_dir).select(
        "row_id", *[clean(c).alias(n) for c, n in CLEAN_FIXTURE.items()]
    )


def _step_query(step: str) -> Query:
    fn = CLEAN_STEPS[step]

    def q(spark, sf_dir):
        return spread(read_table(spark, sf_dir, "documents")).select("doc_id", fn("text").alias("value"))

    return q


for _step in CLEAN_STEPS:
    register(
        f"clean_{_step}",
        f"SELECT doc_id, {O.CLEAN_STEP_SQL[_step]('text')} AS value FROM documents",
    )(_step_query(_step))


# --- dedup / load ----------------------------------------------------------------


def _dup_records_sql() -> tuple[list[str], str]:
    return _records_oracle("fixture_dup", ("seq_no", "row_id"), (O.FX_DUP_CTE,))


def _dup_records(spark, sf_dir) -> DataFrame:
    rows = with_nodes(fixture_dup(spark, sf_dir))
    return R.valid(R.extract_records(rows, fixture_courts(spark), keep=("seq_no", "row_id")))


@register(
    "first_by_key",
    O.with_ctes(O.FX_CTE, O.FX_DUP_CTE)
    + "SELECT seq_no, row_id, court_no, fecha, numero FROM (SELECT *, row_number() OVER "
    "(PARTITION BY fecha, numero, court_no ORDER BY seq_no) AS rn FROM fixture_dup) WHERE rn = 1",
)
def first_by_key_q(spark, sf_dir):
    """G4 on the raw captured rows: key (fecha, numero, court_no)."""
    df = fixture_dup(spark, sf_dir).select("seq_no", "row_id", "court_no", "fecha", "numero")
    return first_by_key(df, ["fecha", "numero", "court_no"], "seq_no")


@register(
    "count_by_key",
    O.with_ctes(*_records_oracle("fixture_rows", ("row_id",))[0])
    + "SELECT fecha, entidad, tipo, count(*) AS n FROM rec_out WHERE reject_reason IS NULL "
    "GROUP BY fecha, entidad, tipo",
)
def count_by_key_q(spark, sf_dir):
    """Stored-document count per (fecha, entidad, tipo)."""
    recs = R.valid(R.extract_records(_fx(spark, sf_dir), fixture_courts(spark), keep=("row_id",)))
    return count_matches(recs, ["fecha", "entidad", "tipo"])


def _existing_new_sql() -> str:
    ctes, out = _dup_records_sql()
    keys = ", ".join(DEDUP_KEYS)
    cols = ", ".join(["seq_no", "row_id", *[f'"{c}"' for c in R.RECORD_COLUMNS]])
    return O.with_ctes(
        *ctes,
        f"new_batch AS (SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY seq_no) AS rn FROM {out} WHERE reject_reason IS NULL) WHERE rn = 1)",
    ) + "," + _existing_sql()


def _existing_sql() -> str:
    ctes, out = O.records_ctes(source="fixture_rows", keep=("row_id",))
    ctes = [c.replace("rec_", "ex_") for c in ctes]
    near = ", ".join(
        f"CASE WHEN row_id % 4 = 1 AND row_id // 20 % {len(DEDUP_KEYS)} = {i} THEN coalesce({k}, '') || 'X' ELSE {k} END AS {k}"
        for i, k in enumerate(DEDUP_KEYS))
    return ",\n".join(ctes) + f",\nexisting AS (SELECT {near} FROM ex_out WHERE reject_reason IS NULL AND row_id % 4 < 2)\n"


def _stored(spark, sf_dir) -> DataFrame:
    """What an earlier run stored: the valid records of every fourth row, and
    as many near misses, which differ from a record of the batch in one part
    of the key, each part in turn.  From an extraction of their own, written
    to a sink and read back from it."""
    rows = with_nodes(fixture_rows(spark, sf_dir).filter(F.col("row_id") % 4 < 2))
    recs = R.valid(R.extract_records(rows, fixture_courts(spark), keep=("row_id",)))
    part = F.floor(F.col("row_id") / 20) % len(DEDUP_KEYS)
    recs = recs.withColumns({
        k: F.when((F.col("row_id") % 4 == 1) & (part == i), F.concat(F.coalesce(k, F.lit("")), F.lit("X"))).otherwise(F.col(k))
        for i, k in enumerate(DEDUP_KEYS)})
    path = shared_path(spark, "stored", uuid.uuid4().hex)
    append_records(recs.drop("row_id"), path)
    return read_records(spark, path)


def _batch(spark, sf_dir) -> DataFrame:
    """The run's batch: the first capture per key."""
    return first_by_key(_dup_records(spark, sf_dir), DEDUP_KEYS, "seq_no")


_NULL_SAFE = " AND ".join(f"e.{k} IS NOT DISTINCT FROM n.{k}" for k in DEDUP_KEYS)


@register(
    "append_if_absent",
    _existing_new_sql()
    + f"SELECT n.* FROM new_batch n WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE {_NULL_SAFE})",
)
def append_if_absent_q(spark, sf_dir):
    """J4 + G4: first capture per key, minus keys already in the sink."""
    return absent_from(_batch(spark, sf_dir), _stored(spark, sf_dir), DEDUP_KEYS)


@register(
    "duplicate_report",
    _existing_new_sql()
    + f"SELECT n.* FROM new_batch n WHERE EXISTS (SELECT 1 FROM existing e WHERE {_NULL_SAFE})",
)
def duplicate_report_q(spark, sf_dir):
    """First capture per key that is already in the sink."""
    return present_in(_batch(spark, sf_dir), _stored(spark, sf_dir), DEDUP_KEYS)


def _indexed(spark, sf_dir) -> tuple[DataFrame, str]:
    """The batch with its months, and the key index of what is stored: built
    from the records of even ids, the others' keys appended."""
    stored, path = _stored(spark, sf_dir), shared_path(spark, "keys", uuid.uuid4().hex)
    odd = F.pmod(F.crc32(F.concat_ws("|", *DEDUP_KEYS).cast("binary")), F.lit(2)) == 1
    KI.rebuild(stored.filter(~odd), path, DEDUP_KEYS)
    KI.add_keys(stored.filter(odd), path, DEDUP_KEYS)
    KI.compact(spark, path, max_files=1)
    return with_month(sized(_batch(spark, sf_dir), "batch")), KI.open_index(spark, path)


@register("append_by_index", ORACLE["append_if_absent"])
def append_by_index_q(spark, sf_dir):
    """J4 + S5: as `append_if_absent`, against the lasting key index: the
    stored records aren't read."""
    new, table = _indexed(spark, sf_dir)
    return KI.absent_by_index(new, table, DEDUP_KEYS).drop("anio_mes")


@register("duplicates_by_index", ORACLE["duplicate_report"])
def duplicates_by_index_q(spark, sf_dir):
    """J5 + S5: as `duplicate_report`, against the lasting key index."""
    new, table = _indexed(spark, sf_dir)
    return KI.present_by_index(new, table, DEDUP_KEYS).drop("anio_mes")


# Every part of this key is null in some rows, and each part decides for some pair of rows.
NULL_KEYS = ("numero", "td2_rest", "td3_first", "court_no")


@register(
    "append_if_absent_nulls",
    FX + f"SELECT n.row_id, {', '.join('n.' + k for k in NULL_KEYS)} FROM fixture_rows n WHERE n.row_id % 4 <> 1 AND NOT EXISTS "
    "(SELECT 1 FROM fixture_rows e WHERE e.row_id % 4 = 1 AND "
    + " AND ".join(f"e.{k} IS NOT DISTINCT FROM n.{k}" for k in NULL_KEYS) + ")",
)
def append_if_absent_nulls(spark, sf_dir):
    """J4 on keys with nulls: a null equals a null and nothing else."""
    fx = fixture_rows(spark, sf_dir).select("row_id", *NULL_KEYS)
    return absent_from(fx.filter("row_id % 4 <> 1"), fx.filter("row_id % 4 = 1"), NULL_KEYS)


@register("export_json", FX + "SELECT row_id, fecha, numero, td2_first FROM fixture_rows")
def export_json_q(spark, sf_dir):
    """Records as UTF-8 JSON lines, read back."""
    path = shared_path(spark, "json", uuid.uuid4().hex)
    export_json(fixture_rows(spark, sf_dir).select("row_id", "fecha", "numero", "td2_first"), path)
    return spark.read.schema("row_id long, fecha string, numero string, td2_first string").json(path)


# Signs and what is left of them, as literal values.
SIGN_CASES = (
    ("ﬁ", "FI"), ("Ａｚ９", "AZ9"), ("ệ", "E"), ("½", " 1/2 "), ("⅔", "2/3"), ("①", "1"), ("𝐀𝓫", "AB"), ("№", "NO"), ("™", "TM"), ("ǅ", "DZ"),
    ("ǽ", "AE"), ("Ǿ", "O"), ("٣", "3"), ("−", "-"), ("‐", "-"), ("‟", '"'), ("e\u0301", "E"), ("ñÑ", "ÑÑ"), ("日本", ""), ("\U0001f642", ""),
    ("\u3000", " "), ("㎏", "KG"), ("ſt", "ST"), ("ﬄ", "FFL"), ("Ⅷ", "VIII"), ("\u200b", ""), ("ø", "O"), ("œ", "OE"), ("Đ", "D"),
)


@register(
    "transliterate",
    "SELECT doc_id, " + O.t7_sql("text") + " || c.reading AS upper_text FROM documents JOIN (VALUES "
    + ", ".join(f"({i}, {O.q(r)})" for i, (_, r) in enumerate(SIGN_CASES)) + f") c(n, reading) ON doc_id % {len(SIGN_CASES)} = c.n",
)
def transliterate_q(spark, sf_dir):
    """T7 on every document, with signs of all kinds behind its text."""
    sign = F.element_at(F.array(*[F.lit(s) for s, _ in SIGN_CASES]), (F.col("doc_id") % len(SIGN_CASES) + 1).cast("int"))
    docs = spread(read_table(spark, sf_dir, "documents")).select("doc_id", F.concat("text", sign).alias("t"))
    return docs.select("doc_id", CLEAN_STEPS["t7_ascii_upper"]("t").alias("upper_text"))
