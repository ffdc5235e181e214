"""Text normalisation and node-list helpers as Column functions.

All functions take and return ``Column`` objects and use only built-in Spark
expressions, so they stay inside whole-stage codegen.  The `clean` chain
follows the bulletin rules step by step (T0-T9); the order is part of the
semantics.
"""

from __future__ import annotations

from typing import Callable, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicto.constants import (
    SIGN_READINGS,
    SIGNS,
    TRANSLIT_FROM,
    TRANSLIT_KEEP,
    TRANSLIT_MULTI,
    TRANSLIT_TO,
    WS,
    WS_CHARS,
)

ColumnOrName = Union[Column, str]

# FIXED VALUES: the source's normalisation patterns in step order, written
# for Java regex.  `(?d)` makes `.` stop at `\n` only, as in Python; Java's
# default `.` also stops at \r, U+0085, U+2028 and U+2029.
RX_LEADING_DOT = r"^\."
RX_WS_RUN = WS + "{2,}"
RX_MASKED_EMAIL = r"\*.*@.*\.[a-zA-Z]{2,4}"
RX_STAR_Y_STAR = r"[*]{5}" + WS + "Y" + WS + r"[*]{5}"
RX_EDGE_WS = "^" + WS + "+|" + WS + r"+\z"
# Between the readings of signs; no reading holds it.
_READING_SEP = "\x01"
RX_NON_ASCII = r"[^\x00-\x7F" + TRANSLIT_KEEP + "]"
RX_MULTI = "[" + "".join(ch for ch, _ in TRANSLIT_MULTI) + "]"
# The letters with marks of Spanish, and what each becomes.
SPANISH = tuple((ch, TRANSLIT_TO[TRANSLIT_FROM.index(ch)]) for ch in "áéíóúüÁÉÍÓÚÜ")


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` named, and so evaluated, once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def memo(fn):
    """Cache a Column builder called with plain (str/int/bool/None)
    arguments.  Unresolved Columns are immutable and session-free, so a
    built expression tree can be reused; this saves the many Python-to-JVM
    calls of rebuilding the same rule cascade for every query."""
    cache: dict = {}

    def wrapper(*args, **kwargs):
        plain = all(isinstance(a, (str, int, bool, type(None))) for a in (*args, *kwargs.values()))
        if not plain:
            return fn(*args, **kwargs)
        key = (args, tuple(sorted(kwargs.items())))
        if key not in cache:
            cache[key] = fn(*args, **kwargs)
        return cache[key]

    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    wrapper.__wrapped__ = fn
    return wrapper


# --- clean steps -------------------------------------------------------------


def t1_leading_dot(c: ColumnOrName) -> Column:
    """Remove one leading '.' (before any trimming)."""
    return F.regexp_replace(col(c), RX_LEADING_DOT, "")


def t2_collapse_ws(c: ColumnOrName) -> Column:
    """Runs of 2+ whitespace become one space; a single newline stays."""
    return F.regexp_replace(col(c), RX_WS_RUN, " ")


def t3_masked_email(c: ColumnOrName) -> Column:
    """From the first '*' of a line through the last '.tld' after an '@'."""
    return F.regexp_replace(col(c), "(?d)" + RX_MASKED_EMAIL, "")


def t4_star_y_star(c: ColumnOrName) -> Column:
    return F.regexp_replace(col(c), RX_STAR_Y_STAR, "")


def t5_drop_stars(c: ColumnOrName) -> Column:
    return F.replace(col(c), F.lit("*"), F.lit(""))


def t6_strip(c: ColumnOrName) -> Column:
    """Unicode strip: every whitespace character of Python's str.strip()
    from both ends (plain trim() only removes spaces)."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def t7_ascii_upper(c: ColumnOrName) -> Column:
    """Transliterate to ASCII (letters with marks, compatibility forms, digits
    of all scripts, common punctuation), keep Ñ, drop what has no ASCII reading,
    upper-case."""
    s = col(c)
    for ch, rep in TRANSLIT_MULTI:
        s = F.replace(s, F.lit(ch), F.lit(rep))
    return F.upper(let(F.translate(s, TRANSLIT_FROM, TRANSLIT_TO), _signs))


def _signs(s: Column) -> Column:
    """The signs that are left, one by one: looked up by their place in one
    string of signs, and dropped where it lacks them.  Rare, so behind a test."""
    readings = F.split(F.lit(_READING_SEP.join(SIGN_READINGS)), _READING_SEP)

    def read(x: Column) -> Column:
        at = F.instr(F.lit(SIGNS), x)
        return F.when((F.octet_length(x) == 1) | x.isin(*TRANSLIT_KEEP), x).when(at > 0, F.get(readings, at - 1)).otherwise(F.lit(""))

    return F.when(s.rlike(RX_NON_ASCII), F.array_join(F.transform(F.split(s, ""), read), "")).otherwise(s)


def t8_trailing_comma(c: ColumnOrName) -> Column:
    """If the text ends with ',', every comma goes (source behaviour)."""
    return let(col(c), lambda s: F.when(s.endswith(","), F.replace(s, F.lit(","), F.lit(""))).otherwise(s))


def t9_quotes_newlines(c: ColumnOrName) -> Column:
    return F.replace(F.replace(col(c), F.lit('"'), F.lit("'")), F.lit("\n"), F.lit(" "))


_PRE_STEPS = (
    t1_leading_dot,
    t2_collapse_ws,
    t3_masked_email,
    t4_star_y_star,
    t5_drop_stars,
    t6_strip,
    t7_ascii_upper,
)


@memo
def clean_pre(c: ColumnOrName) -> Column:
    """T1..T7: each step reads its input once, so the tree stays linear."""
    s = col(c)
    for step in _PRE_STEPS:
        s = step(s)
    return s


@memo
def clean_post(pre: ColumnOrName, null_as_empty: bool = True) -> Column:
    """T8, T9 and T0 on the output of `clean_pre`."""
    s = t9_quotes_newlines(t8_trailing_comma(pre))
    return F.coalesce(s, F.lit("")) if null_as_empty else s


@memo
def clean(c: ColumnOrName, null_as_empty: bool = True) -> Column:
    """Full normalisation T1..T9; T0: null -> '' (or null), '' -> ''."""
    return clean_post(clean_pre(c), null_as_empty)


def _dot_and_stars(s: Column) -> Column:
    """T1, T3..T5: the e-mail rule needs a '*' and an '@', the others a '*'."""
    dotless = F.when(s.startswith("."), F.substr(s, F.lit(2))).otherwise(s)
    mails = F.when(s.contains("@"), t3_masked_email(dotless)).otherwise(dotless)
    return F.when(s.contains("*"), t5_drop_stars(t4_star_y_star(mails))).otherwise(dotless)


def _replaced(s: Column, pairs) -> Column:
    for ch, rep in pairs:
        s = F.replace(s, F.lit(ch), F.lit(rep))
    return s


def _ascii(s: Column) -> Column:
    """T7 without the upper-casing: nothing runs for ASCII-only values (as many
    bytes as characters).  The letters of Spanish go by plain replacements, as
    `translate` looks up every character; it and the 1:n replacements (one
    pass each) run only for values that hold such a character after that."""

    def rest(t: Column) -> Column:
        multi = F.when(t.rlike(RX_MULTI), _replaced(t, TRANSLIT_MULTI)).otherwise(t)
        return F.when(t.rlike(RX_NON_ASCII), let(F.translate(multi, TRANSLIT_FROM, TRANSLIT_TO), _signs)).otherwise(t)

    return F.when(F.length(s) != F.octet_length(s), let(_replaced(s, SPANISH), rest)).otherwise(s)


@memo
def clean_staged(c: ColumnOrName, null_as_empty: bool = True) -> Column:
    """T1..T9 with guards.  Every step names its input once: steps that test
    it first bind it to a lambda variable.  So the tree stays linear in the
    size of its input, also where the optimizer inlines it into a filter.
    T2 goes before T1, which takes only the first sign, and no space."""
    s = let(t2_collapse_ws(c), _dot_and_stars)
    s = F.upper(let(t6_strip(s), _ascii))
    return clean_post(s, null_as_empty)


def with_clean(df: DataFrame, columns: dict[str, str], null_as_empty: bool = True) -> DataFrame:
    """Add cleaned columns {out: in}."""
    return df.withColumns({out: clean_staged(src, null_as_empty) for out, src in columns.items()})


CLEAN_STEPS: dict[str, Callable[[ColumnOrName], Column]] = {
    "t1_leading_dot": t1_leading_dot,
    "t2_collapse_ws": t2_collapse_ws,
    "t3_masked_email": t3_masked_email,
    "t4_star_y_star": t4_star_y_star,
    "t5_drop_stars": t5_drop_stars,
    "t6_strip": t6_strip,
    "t7_ascii_upper": t7_ascii_upper,
    "t8_trailing_comma": t8_trailing_comma,
    "t9_quotes_newlines": t9_quotes_newlines,
}


# --- node lists (A1-A8) ------------------------------------------------------


def join_nodes(arr: ColumnOrName, sep: str = " ") -> Column:
    """A1: ' '.join(nodes); null elements are skipped."""
    return F.array_join(col(arr), sep)


def one_line(c: ColumnOrName) -> Column:
    """Newline -> space."""
    return F.replace(col(c), F.lit("\n"), F.lit(" "))


def up(arr: ColumnOrName) -> Column:
    """Joined, upper-cased, newline -> space (the `UP(J(x))` form)."""
    return one_line(F.upper(join_nodes(arr)))


def concat_nodes(a: ColumnOrName, b: ColumnOrName) -> Column:
    """A2: list concatenation."""
    return F.concat(col(a), col(b))


def first_node(arr: ColumnOrName) -> Column:
    """A3: nodes[0], null on an empty list."""
    return F.get(col(arr), 0)


def last_node(arr: ColumnOrName) -> Column:
    """A3: nodes[-1], null on an empty list."""
    return F.try_element_at(col(arr), F.lit(-1))


def nonempty(arr: ColumnOrName) -> Column:
    return F.coalesce(F.size(col(arr)) > 0, F.lit(False))


def map_compose(arr: ColumnOrName, fn: Callable[[Column], Column]) -> Column:
    """A4: apply `fn` to every value and drop null results."""
    return F.array_compact(F.transform(col(arr), fn))


def take_first(arr: ColumnOrName) -> Column:
    """A5: first value that is neither null nor empty."""
    return F.get(
        F.filter(col(arr), lambda x: x.isNotNull() & (x != F.lit(""))), 0
    )


def before_first(c: ColumnOrName, delim: str) -> Column:
    """Str.split(delim)[0] for a literal delimiter."""
    return F.substring_index(col(c), delim, 1)


def after_last(c: ColumnOrName, delim: str) -> Column:
    """Str.split(delim)[-1] for a literal delimiter."""
    return F.substring_index(col(c), delim, -1)


def splits_in_two(c: ColumnOrName, delim: str) -> Column:
    """len(str.split(delim)) == 2 (exactly one occurrence)."""
    return F.size(F.split(col(c), r"\Q" + delim + r"\E")) == 2


def nodes_of(*cols: ColumnOrName) -> Column:
    """Build a node list from nullable columns, dropping nulls."""
    return F.filter(F.array(*[col(c) for c in cols]), lambda x: x.isNotNull())
