"""Golden rows (FIXTURES.md section 4): one case per cascade branch."""

import pytest
from pyspark.sql import functions as F

from edicto.functions import extract as X
from edicto.functions.dates import parse_spanish_date
from edicto.functions.text import clean, nodes_of


def one(spark, col, *values):
    cols = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], cols)
    return df.select(col.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "raw,expected",
    [("EXPEDIENTE: 12/2020 AMPARO 5/2021", ": 12/2020 "), ("AMPARO 5 EXPEDIENTE: 12", None),
     ("EXPEDIENTE: 5/2020", " 5/2020"), ("5/2020", "5/2020")],
)
def test_case_number(spark, raw, expected):
    assert one(spark, X.case_number(nodes_of("c0")), raw) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [("DELITO: ROBO.- JUAN", "DELITO: ROBO"), ("DELITO: ROBO - X", "DELITO: ROBO"),
     ("DELITO: A-B.- X", "DELITO: "), ("delito: robo.- x", ""),
     ("Expedientillo 5", "EXPEDIENTILLO"), ("EXHORTO.- X", "EXHORTO"),
     ("ORDINARIO.CIVIL.- X", "ORDINARIOCIVIL"), ("nada", "")],
)
def test_case_type(spark, raw, expected):
    assert one(spark, X.case_type(nodes_of("c0"), F.array().cast("array<string>")), raw) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [("LA PAZ, B.C.S. JUAN VS PEDRO", "JUAN "),
     ("EJEC.- LA PAZ B.C.S. JUAN VS PEDRO", " LA PAZ B.C.S. JUAN "),
     ("X B.C.S.JUAN VS P", "X B.C.S.JUAN "),
     ("LA PAZ B.C.S. BEVSA VS P", "BE"),
     ("EJECUTIVO.-JUAN VS PEDRO", "UAN "),
     ("12-20 JUAN VS P", ""),
     ("JUAN VS PEDRO", "JUAN")],
)
def test_claimant(spark, raw, expected):
    assert one(spark, X.claimant(nodes_of("c0"), F.lit("CIVIL")), raw) == expected


def test_claimant_penal_goes_to_defendant(spark):
    actor, hint = X.claimant_parts(nodes_of("c0"), F.lit("PENAL"))
    dem, _ = X.defendant_parts(nodes_of("c0"), hint)
    df = spark.createDataFrame([("PROMOVIDO POR ANA (X)",)], ["c0"])
    r = df.select(actor.alias("a"), dem.alias("d")).first()
    assert (r.a, r.d) == ("", " ANA ")


def test_defendant(spark):
    dem, part = X.defendant_parts(nodes_of("c0"), F.lit(""))
    df = spark.createDataFrame([("A VS B.- SE ADMITE",)], ["c0"])
    r = df.select(dem.alias("d"), part.alias("p")).first()
    assert (r.d, r.p) == (" B", " SE ADMITE")


def test_defendant_en_contra_de_option(spark):
    df = spark.createDataFrame([("PROMOVIDO POR A EN CONTRA DE B",)], ["c0"])
    parity, _ = X.defendant_parts(nodes_of("c0"), F.lit(""))
    fixed, _ = X.defendant_parts(nodes_of("c0"), F.lit(""), en_contra_de=True)
    r = df.select(parity.alias("p"), fixed.alias("f")).first()
    assert (r.p, r.f) == ("", " B")


def test_origin(spark):
    assert one(spark, X.origin_court(nodes_of("c0")), "X.- JUZ LA PAZ, B.C.S. Y B.C.S. Z") == " JUZ LA PAZ, B.C.S. Y B.C.S."
    assert one(spark, X.origin_case(nodes_of("c0")), "OFICIO NUMERO 12/2020 JUICIO DE AMPARO INDIRECTO 3/2021") == "12/2020"


def test_rulings(spark):
    n2 = F.array(F.lit("A VS B"), F.lit("SENTENCIA FIRME"))
    n3 = F.array(F.lit("nota"))
    r = one(spark, X.rulings(n2, n3, F.lit("A"), F.lit("B"), F.lit("")), 1)
    assert r == "A VS B SENTENCIA FIRME nota"


@pytest.mark.parametrize(
    "raw,expected",
    [(".A.B", "A.B"), (" .A", ".A"), ("A,B,", "AB"), ("J ***** Y ***** VS Z", "J  VS Z"),
     ("**a@b.com** ok.mx z", "Z"), ("a@b.com", "A@B.COM"), ('Ñandú "x"', "ÑANDU 'X'"),
     (None, ""), ("", ""), ("straße  æ\nx", "STRASSE AE X")],
)
def test_clean(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "c0 string")
    assert df.select(clean("c0").alias("o")).first().o == expected


def test_spanish_date(spark):
    assert one(spark, parse_spanish_date(F.col("c0")), "29 de noviembre 2022") == "2022/11/29"
    assert one(spark, parse_spanish_date(F.col("c0")), "5 de mayo 2021") == "2021/05/05"
    assert one(spark, parse_spanish_date(F.col("c0")), "5 de nada 2021") is None
