"""Lookup and rule-based classification (L1, L2, L4) as Column functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from edicto.constants import MUNICIPALITIES, SUBJECT_EXACT, SUBJECT_RULES
from edicto.functions.text import ColumnOrName, col, memo


def contains_any(c: ColumnOrName, words: Sequence[str]) -> Column:
    """L4: true when any of `words` is a substring of `c`."""
    c = col(c)
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def classify_subject(
    name: ColumnOrName,
    rules: Sequence[tuple[str, Sequence[str]]] = SUBJECT_RULES,
    exact: tuple[str, str] | None = SUBJECT_EXACT,
) -> Column:
    """L1: subject of a court from its name.  Exact-name override, then the
    first rule whose keywords hit the lower-cased name.  No hit -> null
    (the caller quarantines the row)."""
    low = F.lower(col(name))
    expr = None
    if exact is not None:
        expr = F.when(low == F.lit(exact[0]), F.lit(exact[1]))
    for label, words in rules:
        cond = contains_any(low, words)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


@memo
def map_code(
    c: ColumnOrName, mapping: Mapping[str, str] = MUNICIPALITIES, default: str | None = None
) -> Column:
    """L2: code -> display name; an unknown or null code -> `default` (null: the
    row becomes a reject)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    name = F.try_element_at(F.create_map(*kv), col(c))
    return name if default is None else F.coalesce(name, F.lit(default))
