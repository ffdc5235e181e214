"""Field extraction rule cascades (case number, type, parties, rulings,
origin) as Column functions over text-node lists.

Inputs are node lists (``array<string>``): ``numero`` = text nodes of the
first cell, ``n2`` of the second, ``n3`` of the third.  In place of a list its
`Nodes` are taken, which name what the cascades read of it: the branches of a
``CASE`` share nothing, so a list is joined anew wherever one reads it, unless
a projection has done so before (`staged`).  Truth tests are on
the raw values, before `clean`.  A cascade is one ``CASE`` expression, so a
guard that matches but whose regex fails gives '' and does not fall
through, exactly like the source rules.
"""

from __future__ import annotations

from typing import NamedTuple, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.constants import WS
from edicto.functions.text import (
    ColumnOrName,
    memo,
    after_last,
    before_first,
    col,
    concat_nodes,
    first_node,
    join_nodes,
    last_node,
    nonempty,
    one_line,
    splits_in_two,
    take_first,
)

# FIXED VALUES: the source's extraction patterns, in cascade order, written
# for Java regex (`(?s)` where the source allows any character, `WS` where
# it says `\s`).  They must keep matching what the source matches.
RX_EXPEDIENTE_AMPARO = r"(?s)EXPEDIENTE(.*)AMPARO"
RX_DELITO = r"(?s)(DELITO:.*?)(?:.-)"
RX_BCS = (
    r"(?s)(?:B.C.S." + WS + "|BAJA" + WS + "CALIFORNIA" + WS + "SUR" + WS
    + r"|-)(.*?)(?:VS)"
)
RX_BEFORE_VS = r"(?s)(.*?)(?:VS)"
RX_HYPHEN = r"(?s)(?:[^0-9]-[^0-9])(.*?)(?:VS)"
RX_PROMOVIDO_ANTE = (
    r"(?s)(?:PROMOVIDO POR:|PROMOVIDO POR)(.*?)(?:ANTE" + WS + r"EL|\()"
)
RX_PROMOVIDO_CONTRA = r"(?s)(?:PROMOVIDO POR:|PROMOVIDO POR)(.*?)(?:EN CONTRA DE|,)"
RX_ACUERDO = r"(?s)(?:.-)(.*)(?:\(ACUERDO\))"
_ORIGIN_HEAD = r"(?s)(?:PROCEDENTE" + WS + "DEL|REMITIDO" + WS + r"POR EL|\.-)"
_ORIGIN_END = (
    "DEUCIDO" + WS + "DEL|DEDUCIDO" + WS + r"DEL|B\.C\.S\.|DERIVADO" + WS
    + "DE|BAJA" + WS + "CALIFORNIA" + WS + "SUR"
)
RX_ORIGIN_COURT = _ORIGIN_HEAD + "(.*)(" + _ORIGIN_END + ")"
# The same, middle and terminator as one group.
RX_ORIGIN_PHRASE = _ORIGIN_HEAD + "(.*(?:" + _ORIGIN_END + "))"
RX_ORIGIN_CASE = (
    "OFICIO" + WS + "NUMERO" + WS + "([0-9]+/[0-9]+)",
    "JUICIO" + WS + "DE" + WS + "AMPARO" + WS + "INDIRECTO" + WS + "([0-9]+/[0-9]+)",
    "EXPEDIENTE" + WS + "([0-9]+/[0-9]+)",
    "JUICIO" + WS + "DE" + WS + "AMPARO:" + WS + "([0-9]+/[0-9]+)",
)
ORIGIN_CASE_GATE = ("OFICIO NUMERO", "JUICIO DE AMPARO", "EXPEDIENTE ")


def _rx(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(c, pattern, group)


class Nodes(NamedTuple):
    """What the cascades read of a node list."""

    some: Column  # it has a node
    first: Column
    last: Column
    joined: Column
    up: Column  # joined, in upper case on one line
    up_first: Column

    @classmethod
    def of(cls, arr: ColumnOrName) -> Nodes:
        first, joined = first_node(arr), join_nodes(arr)
        return cls(nonempty(arr), first, last_node(arr), joined, one_line(F.upper(joined)), one_line(F.upper(first)))


ListOrNodes = Union[ColumnOrName, Nodes]


def nodes(arr: ListOrNodes) -> Nodes:
    return arr if isinstance(arr, Nodes) else Nodes.of(arr)


def staged(df: DataFrame, lists: dict[str, Column]) -> tuple[DataFrame, dict[str, Nodes]]:
    """The nodes of the lists as columns of `df`, made once per row; those that
    nothing reads are pruned."""
    names = {k: [f"_{k}_{f}" for f in Nodes._fields] for k in lists}
    df = df.withColumns({n: c for k, arr in lists.items() for n, c in zip(names[k], Nodes.of(arr))})
    return df, {k: Nodes(*map(F.col, ns)) for k, ns in names.items()}


@memo
def case_number(numero: ListOrNodes) -> Column:
    """E7.  Null means the source would have raised (AMPARO only before
    EXPEDIENTE): such rows go to quarantine."""
    numero = nodes(numero)
    s = numero.up
    return (
        F.when(~numero.some, F.lit(""))
        .when(
            s.contains("EXPEDIENTE") & s.contains("AMPARO"),
            F.when(s.rlike(RX_EXPEDIENTE_AMPARO), _rx(s, RX_EXPEDIENTE_AMPARO)),
        )
        .when(s.contains("EXPEDIENTE"), F.replace(s, F.lit("EXPEDIENTE:"), F.lit("")))
        .otherwise(s)
    )


@memo
def case_type(n2: ColumnOrName, n3: ColumnOrName) -> Column:
    """E8 over cell 2 + cell 3 nodes."""
    return case_type_of(concat_nodes(n2, n3))


def case_type_of(p: ListOrNodes) -> Column:
    """E8 over the nodes of both cells in one list."""
    p = nodes(p)
    p0 = p.first
    return (
        F.when(~p.some, F.lit(""))
        .when(p.up.contains("DELITO:"), _rx(one_line(p.joined), RX_DELITO))
        .when(F.upper(F.substring(p0, 1, 15)).contains("EXPEDIENTILLO"), F.lit("EXPEDIENTILLO"))
        .when(F.upper(p0).contains("JUICIO EJECUTIVO MERCANTIL"), F.lit("JUICIO EJECUTIVO MERCANTIL"))
        .when(F.upper(p0).contains("EJECUTIVO MERCANTIL"), F.lit("EJECUTIVO MERCANTIL"))
        .when(F.upper(F.substring(p0, 1, 8)).contains("EXHORTO"), F.lit("EXHORTO"))
        .when(p0.contains(".-"), F.replace(before_first(p0, "-"), F.lit("."), F.lit("")))
        .otherwise(F.lit(""))
    )


@memo
def claimant_parts(n2: ListOrNodes, materia: ColumnOrName) -> tuple[Column, Column]:
    """Returns (actor, demandado_hint).  The hint is filled only by the
    'PROMOVIDO POR ... ANTE EL' rule of criminal courts."""
    n2 = nodes(n2)
    materia = col(materia)
    s = n2.up
    head = before_first(s, " VS")
    is_penal = F.coalesce(F.upper(materia) == F.lit("PENAL"), F.lit(False))
    vs_rule = (
        F.when(
            head.contains("B.C.S.") | head.contains("BAJA CALIFORNIA SUR"),
            F.coalesce(F.nullif(_rx(s, RX_BCS), F.lit("")), _rx(s, RX_BEFORE_VS)),
        )
        .when(head.contains("-"), _rx(s, RX_HYPHEN))
        .otherwise(head)
    )
    ante = s.rlike(RX_PROMOVIDO_ANTE)
    actor = (
        F.when(~n2.some, F.lit(""))
        .when(s.contains(" VS"), vs_rule)
        .when(
            s.contains("PROMOVIDO POR"),
            F.when(ante & ~is_penal, _rx(s, RX_PROMOVIDO_ANTE))
            .when(ante, F.lit(""))
            .otherwise(_rx(s, RX_PROMOVIDO_CONTRA)),
        )
        .when(
            s.contains(".-") & s.contains(",") & s.contains("(ACUERDO)"),
            _rx(s, RX_ACUERDO),
        )
        .when(s.contains(".-"), after_last(n2.first, ".-"))
        .otherwise(F.lit(""))
    )
    hint = F.when(
        n2.some
        & ~s.contains(" VS")
        & s.contains("PROMOVIDO POR")
        & ante
        & is_penal,
        _rx(s, RX_PROMOVIDO_ANTE),
    ).otherwise(F.lit(""))
    return actor, hint


@memo
def claimant(n2: ListOrNodes, materia: ColumnOrName) -> Column:
    return claimant_parts(n2, materia)[0]


@memo
def defendant_parts(
    n2: ListOrNodes, demandado_hint: ColumnOrName, en_contra_de: bool = False
) -> tuple[Column, Column]:
    """Returns (demandado, acuerdos_part) from the first node of cell 2.

    With ``en_contra_de=True`` the 'EN CONTRA DE' split the source intended
    (but never reaches) is applied."""
    n2 = nodes(n2)
    hint = col(demandado_hint)
    p = n2.up_first
    tail = after_last(p, " VS")
    open_ = (hint == F.lit("")) & n2.some
    demandado = (
        F.when(hint != F.lit(""), hint)
        .when(
            open_ & p.contains(" VS"),
            F.when(tail.contains(".-"), before_first(tail, ".-")).otherwise(tail),
        )
    )
    if en_contra_de:
        demandado = demandado.when(
            open_ & p.contains("EN CONTRA DE") & splits_in_two(p, "EN CONTRA DE"),
            after_last(p, "EN CONTRA DE"),
        )
    demandado = demandado.otherwise(F.lit(""))
    acuerdos_part = F.when(
        open_ & p.contains(" VS") & tail.contains(".-"), after_last(tail, ".-")
    ).otherwise(F.lit(""))
    return demandado, acuerdos_part


@memo
def rulings(
    n2: ListOrNodes,
    n3: ListOrNodes,
    actor: ColumnOrName,
    demandado: ColumnOrName,
    acuerdos_part: ColumnOrName,
) -> Column:
    """E11."""
    n2, n3, a = nodes(n2), nodes(n3), col(acuerdos_part)
    has_a = col(actor) != F.lit("")
    has_d = col(demandado) != F.lit("")
    last = n2.last
    j2 = n2.joined
    syn = F.when(n3.some, F.concat(F.lit(" "), n3.joined)).otherwise(F.lit(""))
    both = (
        F.when(F.upper(last).contains("SENTENCIA"), j2)
        .when(F.upper(last).contains("(ACUERDO)"), last)
        .otherwise(F.lit(""))
    )
    return (
        F.when(~n2.some, a)
        .when(has_a & has_d, F.concat(a, both, syn))
        .when(~has_a & ~has_d, F.concat(a, j2, syn))
        .when(has_a, F.concat(a, last, syn))
        .otherwise(F.concat(a, j2, syn))
    )


@memo
def origin_court(n2: ListOrNodes) -> Column:
    """Middle + terminator of the origin-court phrase of node 0."""
    n2 = nodes(n2)
    return F.when(n2.some, _rx(n2.first, RX_ORIGIN_PHRASE)).otherwise(F.lit(""))


@memo
def origin_case(n2: ListOrNodes) -> Column:
    """First 'n/n' case number after one of four prefixes (not
    cleaned afterwards)."""
    n2 = nodes(n2)
    p0 = n2.first
    gate = p0.contains(ORIGIN_CASE_GATE[0])
    for g in ORIGIN_CASE_GATE[1:]:
        gate = gate | p0.contains(g)
    found = take_first(F.array(*[_rx(p0, rx) for rx in RX_ORIGIN_CASE]))
    return F.when(n2.some & gate, F.coalesce(found, F.lit(""))).otherwise(F.lit(""))
