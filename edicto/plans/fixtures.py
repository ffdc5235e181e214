"""Test inputs derived from the driver tables (FIXTURES.md).

`fixture_rows` turns every order into one bulletin table row (cell node
lists built from order, customer and nation values), so its size grows with
the `orders` table.  `fixture_courts` is the court dimension (12 courts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edicto.functions.text import nodes_of

# Court dimension of the fixture: (court_no, juzgado, entidad code, juz_id).
# Names are invented; codes cover every municipality plus an unknown one.
FIXTURE_COURTS = (
    (1, "Primero Mercantil", "lapaz", "1"),
    (2, "Segundo Civil y Familiar", "lapaz", "2"),
    (3, "Primero Familiar", "loscabos", "3"),
    (4, "Consignaciones", "loscabos", "4"),
    (5, "Primero Penal", "comondu", "5"),
    (6, "Justicia para Adolescentes", "comondu", "6"),
    (7, "Ejecución de Sanciones", "loreto", "7"),
    (8, "Tribunal Laboral", "loreto", "8"),
    (9, "Sala de Materia Administrativa", "mulege", "9"),
    (10, "Tercera Sala Unitaria Civil y de Justicia Administrativa (Materia Administrativa)", "mulege", "10"),
    (11, "Oficialía de Partes", "lapaz", "11"),
    (12, "Segundo Penal", "otra", "12"),
)
COURT_URL_PREFIX = "https://bulletins.example.org/AccesoLibre/LiAcuerdosBusqueda.aspx?JuzId="

COURTS_SCHEMA = T.StructType(
    [
        T.StructField("court_no", T.LongType(), False),
        T.StructField("juzgado", T.StringType(), False),
        T.StructField("entidad_code", T.StringType(), False),
        T.StructField("juz_id", T.StringType(), False),
        T.StructField("court_url", T.StringType(), False),
        T.StructField("calendar_url", T.StringType(), False),
    ]
)
# Every fixture court follows the same (shared) calendar, as on the site.
SHARED_CALENDAR_URL = COURT_URL_PREFIX + "1"


def fixture_courts(spark: SparkSession) -> DataFrame:
    rows = [
        (no, name, code, jid, COURT_URL_PREFIX + jid, SHARED_CALENDAR_URL)
        for no, name, code, jid in FIXTURE_COURTS
    ]
    return spark.createDataFrame(rows, COURTS_SCHEMA)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """For the driver's small single-file tables only: give CPU-heavy row work at least one partition per core when a
    local-mode input comes from fewer files than there are cores (small
    files that cannot be split further).  On a cluster the scan's file
    splits already give the parallelism and the file list is never pulled
    to the driver, so this is a no-op there.  Nothing is executed."""
    try:
        sc = df.sparkSession.sparkContext
    except Exception:  # no SparkContext on a Spark Connect client
        return df
    if not sc.master.startswith("local"):
        return df
    cores = sc.defaultParallelism
    if len(df.inputFiles()) < cores:
        return df.repartition(cores)
    return df


def fixture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic bulletin row per order (FIXTURES.md section 1)."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("o_orderkey")
    ks = k.cast("string")
    cn, nn = F.col("c_name"), F.col("n_name")
    numero = (
        F.when(k % 5 == 0, F.concat(F.lit("Expediente: "), ks, F.lit("/2020 Amparo 5/2021")))
        .when(k % 5 == 1, F.concat(F.lit("EXPEDIENTE: "), ks, F.lit("/2020")))
        .when(k % 5 == 2, F.lit("Amparo 7/2021 Expediente 12"))
        .when(k % 5 == 3, F.concat(ks, F.lit("/2020")))
    )
    m = k % 13
    td2_first = (
        F.when(m == 0, F.concat(F.lit("Juicio Ejecutivo Mercantil.- "), cn, F.lit(" VS "), nn))
        .when(m == 1, F.concat(F.lit("EXHORTO.- PROCEDENTE DEL JUZGADO PRIMERO, DEDUCIDO DEL EXPEDIENTE "), ks, F.lit("/2019")))
        .when(m == 2, F.concat(F.lit("Expedientillo 5 promovido por: "), cn, F.lit(" ante el Juzgado")))
        .when(m == 3, F.concat(F.lit("DELITO: ROBO.- PROMOVIDO POR "), cn, F.lit(" (X)")))
        .when(m == 4, F.concat(F.lit("ORDINARIO CIVIL.- LA PAZ, B.C.S. "), cn, F.lit(" VS "), nn, F.lit(".- SE ADMITE")))
        .when(m == 5, F.concat(F.lit("PROMOVIDO POR "), cn, F.lit(" EN CONTRA DE "), nn))
        .when(m == 6, F.concat(F.lit("DIVORCIO.- "), cn, F.lit(", "), nn, F.lit(" (ACUERDO)")))
        .when(m == 7, F.concat(F.lit(".SUCESORIO.- "), cn, F.lit(",")))
        .when(m == 8, F.concat(cn, F.lit(" VS "), nn))
        .when(m == 9, F.lit('***** Y ***** VS "Muñoz",  José'))
        .when(m == 10, F.lit("OFICIO NUMERO 12/2020 JUICIO DE AMPARO INDIRECTO 3/2021"))
        .when(m == 11, F.lit("JUICIO DE AMPARO: 9/2022 *a@b.com X"))
    )
    td2_rest = (
        F.when(k % 3 == 0, F.lit("(ACUERDO) SE ADMITE"))
        .when(k % 3 == 1, F.lit("SENTENCIA DEFINITIVA"))
    )
    td3_first = F.when(k % 4 == 0, F.concat(F.lit("Síntesis: "), F.col("o_orderpriority")))
    return j.select(
        k.alias("row_id"),
        (F.lit(1) + F.col("o_custkey") % 12).alias("court_no"),
        F.date_format("o_orderdate", "yyyy/MM/dd").alias("fecha"),
        numero.alias("numero"),
        td2_first.alias("td2_first"),
        td2_rest.alias("td2_rest"),
        td3_first.alias("td3_first"),
    )


def with_nodes(fx: DataFrame) -> DataFrame:
    """Add the node-list columns the extraction operators read."""
    return spread(fx).withColumns(
        {
            "numero_nodes": nodes_of("numero"),
            "n2": nodes_of("td2_first", "td2_rest"),
            "n3": nodes_of("td3_first"),
        }
    )


def fixture_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth row captured twice; `seq_no` is the capture order.
    One scan: the second capture is generated, not re-read."""
    fx = fixture_rows(spark, sf_dir)
    dup = F.explode(
        F.when(F.col("row_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    )
    return fx.withColumn("_dup", dup).select(
        (F.col("row_id") * 10 + F.col("_dup")).alias("seq_no"), *fx.columns
    )


# SQL text of the same fixtures for the DuckDB oracle.
FIXTURE_ROWS_SQL = """
SELECT o.o_orderkey AS row_id,
       1 + o.o_custkey % 12 AS court_no,
       cast(year(o.o_orderdate) AS varchar) || '/' || lpad(cast(month(o.o_orderdate) AS varchar), 2, '0') || '/' || lpad(cast(day(o.o_orderdate) AS varchar), 2, '0') AS fecha,
       CASE o.o_orderkey % 5
         WHEN 0 THEN 'Expediente: ' || cast(o.o_orderkey AS varchar) || '/2020 Amparo 5/2021'
         WHEN 1 THEN 'EXPEDIENTE: ' || cast(o.o_orderkey AS varchar) || '/2020'
         WHEN 2 THEN 'Amparo 7/2021 Expediente 12'
         WHEN 3 THEN cast(o.o_orderkey AS varchar) || '/2020' END AS numero,
       CASE o.o_orderkey % 13
         WHEN 0 THEN 'Juicio Ejecutivo Mercantil.- ' || c.c_name || ' VS ' || n.n_name
         WHEN 1 THEN 'EXHORTO.- PROCEDENTE DEL JUZGADO PRIMERO, DEDUCIDO DEL EXPEDIENTE ' || cast(o.o_orderkey AS varchar) || '/2019'
         WHEN 2 THEN 'Expedientillo 5 promovido por: ' || c.c_name || ' ante el Juzgado'
         WHEN 3 THEN 'DELITO: ROBO.- PROMOVIDO POR ' || c.c_name || ' (X)'
         WHEN 4 THEN 'ORDINARIO CIVIL.- LA PAZ, B.C.S. ' || c.c_name || ' VS ' || n.n_name || '.- SE ADMITE'
         WHEN 5 THEN 'PROMOVIDO POR ' || c.c_name || ' EN CONTRA DE ' || n.n_name
         WHEN 6 THEN 'DIVORCIO.- ' || c.c_name || ', ' || n.n_name || ' (ACUERDO)'
         WHEN 7 THEN '.SUCESORIO.- ' || c.c_name || ','
         WHEN 8 THEN c.c_name || ' VS ' || n.n_name
         WHEN 9 THEN '***** Y ***** VS "Muñoz",  José'
         WHEN 10 THEN 'OFICIO NUMERO 12/2020 JUICIO DE AMPARO INDIRECTO 3/2021'
         WHEN 11 THEN 'JUICIO DE AMPARO: 9/2022 *a@b.com X' END AS td2_first,
       CASE o.o_orderkey % 3 WHEN 0 THEN '(ACUERDO) SE ADMITE' WHEN 1 THEN 'SENTENCIA DEFINITIVA' END AS td2_rest,
       CASE o.o_orderkey % 4 WHEN 0 THEN 'Síntesis: ' || o.o_orderpriority END AS td3_first
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
"""

FIXTURE_DUP_SQL = """
SELECT row_id * 10 + dup AS seq_no, row_id, court_no, fecha, numero, td2_first, td2_rest, td3_first
FROM fixture_rows JOIN (SELECT 0 AS dup UNION ALL SELECT 1) d ON d.dup = 0 OR fixture_rows.row_id % 10 = 0
"""


def courts_values_sql() -> str:
    """The court dimension as a SQL VALUES list."""
    vals = ",\n  ".join(
        "({}, '{}', '{}', '{}', '{}', '{}')".format(
            no, name.replace("'", "''"), code, jid, COURT_URL_PREFIX + jid, SHARED_CALENDAR_URL
        )
        for no, name, code, jid in FIXTURE_COURTS
    )
    return (
        "SELECT * FROM (VALUES\n  " + vals + "\n) AS t(court_no, juzgado, entidad_code, juz_id, court_url, calendar_url)"
    )
