"""Bulletin table rows -> 25-field records.

The extraction is staged as successive projections (one per dependency
level of the rule cascades) so every intermediate value is computed once per
row; Catalyst keeps the stages apart because the expressions are not cheap
to duplicate, and the whole chain still runs in one codegen stage with no
shuffle.  Court attributes come from the court dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicto.constants import EMPTY_FIELDS, FUERO, ORIGEN, RECORD_FIELDS
from edicto.functions.classify import classify_subject, map_code
from edicto.functions.dates import technical_ts
from edicto.functions.extract import (
    Nodes,
    case_number,
    case_type_of,
    claimant_parts,
    defendant_parts,
    origin_case,
    origin_court,
    rulings,
    staged,
)
from edicto.functions.text import concat_nodes, with_clean
from edicto.operators.joins import sized

# Output columns of `extract_records` (fecha_insercion is set at load time).
RECORD_COLUMNS = tuple(f for f in RECORD_FIELDS if f != "fecha_insercion")
REJECT_COLUMN = "reject_reason"


def court_dimension(courts: DataFrame, on: str = "court_no") -> DataFrame:
    """The court attributes that records carry, cleaned once per court and
    written, so that its size is known."""
    attrs = [c for c in ("court_no", "juzgado", "court_url", "juz_id", "entidad_code") if c != on]
    dim = courts.select(
        on,
        *attrs,
        classify_subject("juzgado").alias("materia"),
        map_code("entidad_code").alias("entidad_name"),
    )
    return sized(with_clean(dim, {"_clean_juzgado": "juzgado", "_clean_entidad": "entidad_name"}))


def with_court(rows: DataFrame, courts: DataFrame, on: str = "court_no") -> DataFrame:
    """Court attributes (name, subject, municipality) onto each row.
    The dimension is written first (unless it is one already); Spark broadcasts
    it if it is small enough."""
    return rows.join(courts if "_clean_juzgado" in courts.columns else court_dimension(courts, on), on, "inner")


def extract_fields(
    df: DataFrame,
    numero: str = "numero_nodes",
    n2: str = "n2",
    n3: str = "n3",
    materia: str = "materia",
    en_contra_de: bool = False,
) -> DataFrame:
    """E7-E13 as raw (uncleaned) columns `_expediente`, `_tipo`, `_actor`,
    `_demandado`, `_acuerdos`, `_origin_court`, `expediente_origen`."""
    df, of = staged(df, {"numero": F.col(numero), "n2": F.col(n2), "n3": F.col(n3), "both": concat_nodes(n2, n3)})
    actor, hint = claimant_parts(of["n2"], materia)
    df = df.withColumns(
        {
            "_expediente": case_number(of["numero"]),
            "_tipo": case_type_of(of["both"]),
            "_actor": actor,
            "_hint": hint,
            "_origin_court": origin_court(of["n2"]),
            "expediente_origen": origin_case(of["n2"]),
        }
    )
    demandado, acuerdos_part = defendant_parts(of["n2"], "_hint", en_contra_de=en_contra_de)
    df = df.withColumns({"_demandado": demandado, "_acuerdos_part": acuerdos_part})
    df = df.withColumn(
        "_acuerdos", rulings(of["n2"], of["n3"], "_actor", "_demandado", "_acuerdos_part")
    )
    return df.drop(*[f"_{k}_{f}" for k in of for f in Nodes._fields])


def reject_reason() -> F.Column:
    """G1: why a row cannot become a record (null = valid)."""
    return (
        F.when(F.col("_expediente").isNull(), F.lit("case_number"))
        .when(F.col("materia").isNull(), F.lit("subject"))
        .when(F.col("entidad_name").isNull(), F.lit("municipality"))
    )


CLEANED = {
    "actor": "_actor",
    "demandado": "_demandado",
    "expediente": "_expediente",
    "fecha": "fecha",
    "tipo": "_tipo",
    "acuerdos": "_acuerdos",
    "Organo_jurisdiccional_origen": "_origin_court",
}


def to_records(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Clean the raw fields and lay out the record in stored order, plus
    `keep` pass-through columns and the reject reason."""
    staged = df.withColumn(REJECT_COLUMN, reject_reason()).withColumn(
        "fecha_tecnica", technical_ts("fecha")
    )
    staged = with_clean(staged, {f"_clean_{k}": v for k, v in CLEANED.items()})
    cols = {k: F.col(f"_clean_{k}") for k in CLEANED}
    cols.update(
        {
            "juzgado": F.col("_clean_juzgado"),
            "entidad": F.col("_clean_entidad"),
            "fuero": F.lit(FUERO),
            "expediente_origen": F.col("expediente_origen"),
            "materia": F.col("materia"),
            "origen": F.lit(ORIGEN),
            "fecha_tecnica": F.col("fecha_tecnica"),
        }
    )
    for f in EMPTY_FIELDS:
        cols[f] = F.lit("")
    return staged.select(
        *keep, *[cols[f].alias(f) for f in RECORD_COLUMNS], REJECT_COLUMN
    )


def extract_records(
    rows: DataFrame,
    courts: DataFrame,
    keep: tuple[str, ...] = (),
    en_contra_de: bool = False,
    on: str = "court_no",
) -> DataFrame:
    """Rows with node lists (`numero_nodes`, `n2`, `n3`) and a court
    key -> records with `reject_reason` (null for valid rows)."""
    joined = with_court(rows, courts, on=on)
    return to_records(extract_fields(joined, en_contra_de=en_contra_de), keep=keep)


def valid(records: DataFrame) -> DataFrame:
    return records.filter(F.col(REJECT_COLUMN).isNull()).drop(REJECT_COLUMN)


def rejected(records: DataFrame) -> DataFrame:
    return records.filter(F.col(REJECT_COLUMN).isNotNull())
