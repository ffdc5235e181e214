"""DuckDB SQL for the correctness oracle, generated from the same pattern
constants the Spark operators use.

Java-only syntax is removed for RE2 (`(?d)`: RE2's `.` already stops at
`\\n` only).  Node lists of the SQL fixture are separate nullable columns, so
no list dialect is needed: `first` = coalesce(a, b), `last` =
coalesce(b, a), `joined` = concat_ws(' ', a, b).
"""

from __future__ import annotations

from collections.abc import Sequence

from edicto.constants import (
    MONTHS,
    MUNICIPALITIES,
    SUBJECT_EXACT,
    SUBJECT_RULES,
    TRANSLIT_FROM,
    TRANSLIT_MULTI,
    TRANSLIT_TO,
)
from edicto.functions import extract as X
from edicto.functions import text as TX
from edicto.functions.dates import RX_DAY, RX_MONTH, RX_YEAR
from edicto.plans.fixtures import FIXTURE_DUP_SQL, FIXTURE_ROWS_SQL, courts_values_sql


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re2(p: str) -> str:
    return p.replace("(?d)", "")


def rx(e: str, p: str, g: int = 1) -> str:
    return f"regexp_extract({e}, {q(re2(p))}, {g})"


def rx_match(e: str, p: str) -> str:
    return f"regexp_matches({e}, {q(re2(p))})"


def rx_replace(e: str, p: str, r: str) -> str:
    return f"regexp_replace({e}, {q(re2(p))}, {q(r)}, 'g')"


def contains(e: str, s: str) -> str:
    return f"contains({e}, {q(s)})"


NL = "chr(10)"


class Nodes:
    """A node list made of nullable columns, in order."""

    def __init__(self, *cols: str):
        self.cols = cols

    def __add__(self, other: "Nodes") -> "Nodes":
        return Nodes(*self.cols, *other.cols)

    @property
    def nonempty(self) -> str:
        return "(" + " OR ".join(f"{c} IS NOT NULL" for c in self.cols) + ")"

    @property
    def first(self) -> str:
        return self.cols[0] if len(self.cols) == 1 else f"coalesce({', '.join(self.cols)})"

    @property
    def last(self) -> str:
        r = self.cols[::-1]
        return r[0] if len(r) == 1 else f"coalesce({', '.join(r)})"

    @property
    def joined(self) -> str:
        return f"concat_ws(' ', {', '.join(self.cols)})"

    @property
    def up(self) -> str:
        return f"translate(upper({self.joined}), {NL}, ' ')"


# --- text -------------------------------------------------------------------

CLEAN_STEP_SQL = {
    "t1_leading_dot": lambda e: f"regexp_replace({e}, {q(TX.RX_LEADING_DOT)}, '')",
    "t2_collapse_ws": lambda e: rx_replace(e, TX.RX_WS_RUN, " "),
    "t3_masked_email": lambda e: rx_replace(e, TX.RX_MASKED_EMAIL, ""),
    "t4_star_y_star": lambda e: rx_replace(e, TX.RX_STAR_Y_STAR, ""),
    "t5_drop_stars": lambda e: f"replace({e}, '*', '')",
    "t6_strip": lambda e: rx_replace(e, TX.RX_EDGE_WS, ""),
    "t7_ascii_upper": lambda e: t7_sql(e),
    "t8_trailing_comma": lambda e: f"(CASE WHEN suffix({e}, ',') THEN replace({e}, ',', '') ELSE {e} END)",
    "t9_quotes_newlines": lambda e: f"translate({e}, '\"' || {NL}, ''' ')",
}


def t7_sql(e: str) -> str:
    s = e
    for ch, rep in TRANSLIT_MULTI:
        s = f"replace({s}, {q(ch)}, {q(rep)})"
    s = f"translate({s}, {q(TRANSLIT_FROM)}, {q(TRANSLIT_TO)})"
    s = rx_replace(s, TX.RX_NON_ASCII, "")
    return f"upper({s})"


def clean_sql(e: str) -> str:
    s = e
    for name in (
        "t1_leading_dot", "t2_collapse_ws", "t3_masked_email", "t4_star_y_star",
        "t5_drop_stars", "t6_strip", "t7_ascii_upper",
    ):
        s = CLEAN_STEP_SQL[name](s)
    # T8 references its input three times: keep it in a lateral subquery
    # free form by repeating the expression (DuckDB eliminates the common
    # subexpression).
    s = CLEAN_STEP_SQL["t8_trailing_comma"](s)
    s = CLEAN_STEP_SQL["t9_quotes_newlines"](s)
    return f"coalesce({s}, '')"


# --- extraction ---------------------------------------------------------------


def case_number_sql(n: Nodes) -> str:
    s = n.up
    return (
        f"(CASE WHEN NOT {n.nonempty} THEN '' "
        f"WHEN {contains(s, 'EXPEDIENTE')} AND {contains(s, 'AMPARO')} THEN "
        f"(CASE WHEN {rx_match(s, X.RX_EXPEDIENTE_AMPARO)} THEN {rx(s, X.RX_EXPEDIENTE_AMPARO)} END) "
        f"WHEN {contains(s, 'EXPEDIENTE')} THEN replace({s}, 'EXPEDIENTE:', '') "
        f"ELSE {s} END)"
    )


def case_type_sql(n2: Nodes, n3: Nodes) -> str:
    p = n2 + n3
    p0 = p.first
    pj = f"translate({p.joined}, {NL}, ' ')"
    return (
        f"(CASE WHEN NOT {p.nonempty} THEN '' "
        f"WHEN {contains(f'upper({pj})', 'DELITO:')} THEN {rx(pj, X.RX_DELITO)} "
        f"WHEN {contains(f'upper(substring({p0}, 1, 15))', 'EXPEDIENTILLO')} THEN 'EXPEDIENTILLO' "
        f"WHEN {contains(f'upper({p0})', 'JUICIO EJECUTIVO MERCANTIL')} THEN 'JUICIO EJECUTIVO MERCANTIL' "
        f"WHEN {contains(f'upper({p0})', 'EJECUTIVO MERCANTIL')} THEN 'EJECUTIVO MERCANTIL' "
        f"WHEN {contains(f'upper(substring({p0}, 1, 8))', 'EXHORTO')} THEN 'EXHORTO' "
        f"WHEN {contains(p0, '.-')} THEN replace(split_part({p0}, '-', 1), '.', '') "
        f"ELSE '' END)"
    )


def claimant_sql(n2: Nodes, materia: str) -> tuple[str, str]:
    s = n2.up
    head = f"split_part({s}, ' VS', 1)"
    is_penal = f"coalesce(upper({materia}) = 'PENAL', false)"
    vs_rule = (
        f"(CASE WHEN {contains(head, 'B.C.S.')} OR {contains(head, 'BAJA CALIFORNIA SUR')} "
        f"THEN coalesce(nullif({rx(s, X.RX_BCS)}, ''), {rx(s, X.RX_BEFORE_VS)}) "
        f"WHEN {contains(head, '-')} THEN {rx(s, X.RX_HYPHEN)} ELSE {head} END)"
    )
    ante = rx_match(s, X.RX_PROMOVIDO_ANTE)
    actor = (
        f"(CASE WHEN NOT {n2.nonempty} THEN '' "
        f"WHEN {contains(s, ' VS')} THEN {vs_rule} "
        f"WHEN {contains(s, 'PROMOVIDO POR')} THEN "
        f"(CASE WHEN {ante} AND NOT {is_penal} THEN {rx(s, X.RX_PROMOVIDO_ANTE)} "
        f"WHEN {ante} THEN '' ELSE {rx(s, X.RX_PROMOVIDO_CONTRA)} END) "
        f"WHEN {contains(s, '.-')} AND {contains(s, ',')} AND {contains(s, '(ACUERDO)')} "
        f"THEN {rx(s, X.RX_ACUERDO)} "
        f"WHEN {contains(s, '.-')} THEN string_split({n2.first}, '.-')[-1] "
        f"ELSE '' END)"
    )
    hint = (
        f"(CASE WHEN {n2.nonempty} AND NOT {contains(s, ' VS')} AND {contains(s, 'PROMOVIDO POR')} "
        f"AND {ante} AND {is_penal} THEN {rx(s, X.RX_PROMOVIDO_ANTE)} ELSE '' END)"
    )
    return actor, hint


def defendant_sql(n2: Nodes, hint: str) -> tuple[str, str]:
    p = f"translate(upper({n2.first}), {NL}, ' ')"
    tail = f"string_split({p}, ' VS')[-1]"
    open_ = f"({hint} = '' AND {n2.nonempty})"
    dem = (
        f"(CASE WHEN {hint} <> '' THEN {hint} "
        f"WHEN {open_} AND {contains(p, ' VS')} THEN "
        f"(CASE WHEN {contains(tail, '.-')} THEN split_part({tail}, '.-', 1) ELSE {tail} END) "
        f"ELSE '' END)"
    )
    part = (
        f"(CASE WHEN {open_} AND {contains(p, ' VS')} AND {contains(tail, '.-')} "
        f"THEN string_split({tail}, '.-')[-1] ELSE '' END)"
    )
    return dem, part


def rulings_sql(n2: Nodes, n3: Nodes, actor: str, dem: str, part: str) -> str:
    last = n2.last
    j2 = n2.joined
    syn = f"(CASE WHEN {n3.nonempty} THEN ' ' || {n3.joined} ELSE '' END)"
    both = (
        f"(CASE WHEN {contains(f'upper({last})', 'SENTENCIA')} THEN {j2} "
        f"WHEN {contains(f'upper({last})', '(ACUERDO)')} THEN {last} ELSE '' END)"
    )
    return (
        f"(CASE WHEN NOT {n2.nonempty} THEN {part} "
        f"WHEN {actor} <> '' AND {dem} <> '' THEN {part} || {both} || {syn} "
        f"WHEN {actor} = '' AND {dem} = '' THEN {part} || {j2} || {syn} "
        f"WHEN {actor} <> '' THEN {part} || {last} || {syn} "
        f"ELSE {part} || {j2} || {syn} END)"
    )


def origin_court_sql(n2: Nodes) -> str:
    p0 = n2.first
    return (
        f"(CASE WHEN {n2.nonempty} THEN {rx(p0, X.RX_ORIGIN_COURT, 1)} || "
        f"{rx(p0, X.RX_ORIGIN_COURT, 2)} ELSE '' END)"
    )


def origin_case_sql(n2: Nodes) -> str:
    p0 = n2.first
    gate = " OR ".join(contains(p0, g) for g in X.ORIGIN_CASE_GATE)
    found = ", ".join(f"nullif({rx(p0, r)}, '')" for r in X.RX_ORIGIN_CASE)
    return (
        f"(CASE WHEN {n2.nonempty} AND ({gate}) THEN coalesce({found}, '') ELSE '' END)"
    )


# --- lookups and dates -----------------------------------------------------------


def classify_subject_sql(name: str) -> str:
    low = f"lower({name})"
    parts = [f"WHEN {low} = {q(SUBJECT_EXACT[0])} THEN {q(SUBJECT_EXACT[1])}"]
    for label, words in SUBJECT_RULES:
        cond = " OR ".join(contains(low, w) for w in words)
        parts.append(f"WHEN {cond} THEN {q(label)}")
    return "(CASE " + " ".join(parts) + " END)"


def map_code_sql(code: str) -> str:
    parts = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in MUNICIPALITIES.items())
    return f"(CASE {code} {parts} END)"


def months_case_sql(key: str) -> str:
    parts = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in MONTHS.items())
    return f"(CASE {key} {parts} END)"


def month_name_sql(month_no: str) -> str:
    parts = " ".join(f"WHEN {int(v)} THEN {q(k)}" for k, v in MONTHS.items())
    return f"(CASE {month_no} {parts} END)"


def spanish_date_sql(raw: str) -> str:
    d = rx(raw, RX_DAY)
    y = rx(raw, RX_YEAR)
    mk = rx_replace(rx(raw, RX_MONTH), TX.RX_EDGE_WS, "")
    m = months_case_sql(mk)
    return (
        f"(CASE WHEN {d} <> '' AND {y} <> '' AND {m} IS NOT NULL "
        f"THEN {y} || '/' || {m} || '/' || lpad({d}, 2, '0') END)"
    )


def technical_ts_sql(fecha: str) -> str:
    return f"try_strptime({fecha}, '%Y/%m/%d')"


# --- fixtures ---------------------------------------------------------------------

FX_CTE = f"fixture_rows AS ({FIXTURE_ROWS_SQL})"
FX_DUP_CTE = f"fixture_dup AS ({FIXTURE_DUP_SQL})"
COURTS_CTE = f"fixture_courts AS ({courts_values_sql()})"

N_NUMERO = Nodes("numero")
N2 = Nodes("td2_first", "td2_rest")
N3 = Nodes("td3_first")


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def records_ctes(source: str = "fixture_rows", keep: Sequence[str] = ("row_id",),
                 en_contra_de: bool = False) -> tuple[list[str], str]:
    """CTE chain computing records (with reject_reason) from a fixture
    relation; returns (ctes, name of the final relation)."""
    if en_contra_de:
        raise NotImplementedError
    actor, hint = claimant_sql(N2, "materia")
    b = (
        f"rec_b AS (SELECT f.*, c.juzgado, c.court_url, c.juz_id, c.entidad_code, "
        f"{classify_subject_sql('c.juzgado')} AS materia, {map_code_sql('c.entidad_code')} AS entidad_name "
        f"FROM {source} f JOIN fixture_courts c ON f.court_no = c.court_no)"
    )
    s1 = (
        f"rec_1 AS (SELECT *, {case_number_sql(N_NUMERO)} AS _expediente, "
        f"{case_type_sql(N2, N3)} AS _tipo, {actor} AS _actor, {hint} AS _hint, "
        f"{origin_court_sql(N2)} AS _origin_court, {origin_case_sql(N2)} AS expediente_origen FROM rec_b)"
    )
    dem, part = defendant_sql(N2, "_hint")
    s2 = f"rec_2 AS (SELECT *, {dem} AS _demandado, {part} AS _acuerdos_part FROM rec_1)"
    s3 = (
        f"rec_3 AS (SELECT *, {rulings_sql(N2, N3, '_actor', '_demandado', '_acuerdos_part')} AS _acuerdos FROM rec_2)"
    )
    from edicto.constants import EMPTY_FIELDS, FUERO, ORIGEN
    from edicto.operators.records import RECORD_COLUMNS

    cols = {
        "actor": clean_sql("_actor"),
        "demandado": clean_sql("_demandado"),
        "entidad": clean_sql("entidad_name"),
        "expediente": clean_sql("_expediente"),
        "fecha": clean_sql("fecha"),
        "fuero": q(FUERO),
        "juzgado": clean_sql("juzgado"),
        "tipo": clean_sql("_tipo"),
        "acuerdos": clean_sql("_acuerdos"),
        "Organo_jurisdiccional_origen": clean_sql("_origin_court"),
        "expediente_origen": "expediente_origen",
        "materia": "materia",
        "origen": q(ORIGEN),
        "fecha_tecnica": technical_ts_sql("fecha"),
    }
    for f in EMPTY_FIELDS:
        cols[f] = "''"
    reject = (
        "(CASE WHEN _expediente IS NULL THEN 'case_number' WHEN materia IS NULL THEN 'subject' "
        "WHEN entidad_name IS NULL THEN 'municipality' END)"
    )
    sel = ", ".join([*keep, *[f'{cols[f]} AS "{f}"' for f in RECORD_COLUMNS], f"{reject} AS reject_reason"])
    s4 = f"rec_out AS (SELECT {sel} FROM rec_3)"
    return [b, s1, s2, s3, s4], "rec_out"
