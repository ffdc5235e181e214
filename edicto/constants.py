"""Fixed values shared by the Spark operators and the DuckDB oracle SQL.

Everything under "FIXED VALUES" must stay equal to the values the bulletin
source uses (month names, municipality codes, subject keywords, constant
record fields); they are stated plainly and in their natural order.  Larger
tables (the transliteration map) are built from a rule instead.
"""

from __future__ import annotations

import unicodedata

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source system's values)
# ---------------------------------------------------------------------------

# Spanish month phrases as they appear in calendar titles ("29 de noviembre").
MONTHS = {
    "de enero": "01",
    "de febrero": "02",
    "de marzo": "03",
    "de abril": "04",
    "de mayo": "05",
    "de junio": "06",
    "de julio": "07",
    "de agosto": "08",
    "de septiembre": "09",
    "de octubre": "10",
    "de noviembre": "11",
    "de diciembre": "12",
}

# Municipality codes (section ids of the court listing) -> display names.
MUNICIPALITIES = {
    "lapaz": "LA PAZ",
    "loscabos": "LOS CABOS",
    "comondu": "COMONDU",
    "loreto": "LORETO",
    "mulege": "MULEGE",
}

# Court-name subject rules: exact-name override first, then the first rule
# whose keyword list hits (substring of the lower-cased name) wins.
SUBJECT_EXACT = (
    "tercera sala unitaria civil y de justicia administrativa (materia administrativa)",
    "ADMINISTRATIVA",
)
SUBJECT_RULES = (
    ("LABORAL", ("laboral",)),
    ("CIVIL", ("mercantil", "civil", "materia civil", "civil y familiar")),
    ("FAMILIAR", ("familiar", "consignaciones")),
    ("PENAL", ("penal", "adolescentes", "sanciones")),
    ("ADMINISTRATIVA", ("materia administrativa",)),
)

FUERO = "COMUN"
ORIGEN = "PODER JUDICIAL DEL ESTADO DE BAJA CALIFORNIA SUR"

# Dedup key of a stored record.
DEDUP_KEYS = ("fecha", "expediente", "entidad", "actor", "tipo")

# Record fields in stored order (23 strings + 2 timestamps).
RECORD_FIELDS = (
    "actor",
    "demandado",
    "entidad",
    "expediente",
    "fecha",
    "fuero",
    "juzgado",
    "tipo",
    "acuerdos",
    "monto",
    "fecha_presentacion",
    "actos_reclamados",
    "actos_reclamados_especificos",
    "Naturaleza_procedimiento",
    "Prestación_demandada",
    "Organo_jurisdiccional_origen",
    "expediente_origen",
    "materia",
    "submateria",
    "fecha_sentencia",
    "sentido_sentencia",
    "resoluciones",
    "origen",
    "fecha_insercion",
    "fecha_tecnica",
)
EMPTY_FIELDS = (
    "monto",
    "fecha_presentacion",
    "actos_reclamados",
    "actos_reclamados_especificos",
    "Naturaleza_procedimiento",
    "Prestación_demandada",
    "submateria",
    "fecha_sentencia",
    "sentido_sentencia",
    "resoluciones",
)

# Calendar codes count days from this epoch (V8370 -> 2022-12-01).
CALENDAR_EPOCH = "2000-01-01"

# Element ids of the bulletin site's pages.
CALENDAR_TABLE_ID = "ctl00_ContentPlaceHolder1_Calendar1"
RESULTS_TABLE_ID = "ctl00_ContentPlaceHolder1_tblResultados"

# ---------------------------------------------------------------------------
# Regex building blocks valid in both Java (Spark) and RE2 (DuckDB)
# ---------------------------------------------------------------------------

# Python's str whitespace (what `\s` and str.strip() match), spelled out,
# because Java and RE2 `\s` are ASCII-only.
WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# The same set as literal characters (for btrim).
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Characters whose transliteration is more than one letter or that have no
# canonical decomposition.  (character, replacement)
_TRANSLIT_SPECIAL = (
    ("Æ", "AE"), ("æ", "ae"), ("Ð", "D"), ("ð", "d"), ("Ø", "O"), ("ø", "o"),
    ("Þ", "Th"), ("þ", "th"), ("ß", "ss"), ("Đ", "D"), ("đ", "d"), ("Ħ", "H"),
    ("ħ", "h"), ("ı", "i"), ("Ĳ", "IJ"), ("ĳ", "ij"), ("ĸ", "q"), ("Ŀ", "L"),
    ("ŀ", "l"), ("Ł", "L"), ("ł", "l"), ("ŉ", "'n"), ("Ŋ", "NG"), ("ŋ", "ng"),
    ("Œ", "OE"), ("œ", "oe"), ("Ŧ", "T"), ("ŧ", "t"), ("ſ", "s"),
    (" ", " "), ("¡", "!"), ("¿", "?"), ("«", "<<"), ("»", ">>"),
    ("ª", "a"), ("º", "o"), ("°", "deg"), ("·", "*"), ("×", "x"), ("÷", "/"),
    ("‘", "'"), ("’", "'"), ("‚", ","), ("“", '"'),
    ("”", '"'), ("„", ",,"), ("–", "-"), ("—", "--"),
    ("…", "..."), ("€", "EUR"),
    ("¢", "C/"), ("£", "PS"), ("¤", "$?"), ("¥", "Y="), ("¦", "|"), ("§", "SS"),
    ("¨", '"'), ("©", "(c)"), ("¬", "!"), ("®", "(r)"), ("¯", "-"), ("±", "+-"),
    ("²", "2"), ("³", "3"), ("´", "'"), ("µ", "u"), ("¶", "P"), ("¸", ","),
    ("¹", "1"), ("¼", " 1/4 "), ("½", " 1/2 "), ("¾", " 3/4 "),
)
# Kept as-is by the transliteration step (upper-cased to Ñ afterwards).
TRANSLIT_KEEP = "ñÑ"


def _build_translit() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Rule: every letter of Latin-1 Supplement and Latin Extended-A maps to
    the ASCII letters of its compatibility decomposition; the special table
    overrides.  Returns (from_chars, to_chars) for a 1:1 `translate` and the
    1:n pairs for `replace`."""
    special = dict(_TRANSLIT_SPECIAL)
    one_to_one: dict[str, str] = {}
    for cp in list(range(0xC0, 0x100)) + list(range(0x100, 0x180)):
        ch = chr(cp)
        if ch in TRANSLIT_KEEP or ch in special:
            continue
        if not unicodedata.category(ch).startswith("L"):
            continue
        base = "".join(
            c for c in unicodedata.normalize("NFKD", ch) if ord(c) < 128
        )
        if len(base) == 1:
            one_to_one[ch] = base
        elif len(base) > 1:
            special[ch] = base
    multi = []
    for ch, rep in special.items():
        if len(rep) == 1:
            one_to_one[ch] = rep
        else:
            multi.append((ch, rep))
    src = "".join(one_to_one)
    dst = "".join(one_to_one[c] for c in src)
    return src, dst, tuple(multi)


TRANSLIT_FROM, TRANSLIT_TO, TRANSLIT_MULTI = _build_translit()


# Blocks whose signs have a Latin reading by rule: letters with marks, forms,
# full-width and mathematical signs, digits of all scripts, punctuation.
_SIGN_BLOCKS = ((0x80, 0x3400), (0xA640, 0xAB70), (0xF900, 0x10000), (0x10000, 0x12000), (0x1D400, 0x1D800), (0x1F100, 0x1F200))


_KNOWN_READINGS = dict(_TRANSLIT_SPECIAL) | dict(zip(TRANSLIT_FROM, TRANSLIT_TO))


def _sign(ch: str) -> str | None:
    """The ASCII reading of a sign, or None if it has none by rule: what its
    compatibility decomposition leaves without marks, its value if it is a
    digit, '-' for a dash, a quote for a quotation mark."""
    out = ""
    for c in unicodedata.normalize("NFKD", ch):
        kind, name = unicodedata.category(c), unicodedata.name(c, "")
        if ord(c) < 128:
            out += c
        elif kind == "Nd":
            out += str(unicodedata.digit(c))
        elif kind == "Pd" or c == "\u2212":
            out += "-"
        elif c == "\u2044":
            out += "/"
        elif "QUOTATION MARK" in name and kind in ("Pi", "Pf", "Ps", "Pe"):
            out += "'" if "SINGLE" in name else '"'
        elif c in _KNOWN_READINGS:
            out += _KNOWN_READINGS[c]
        elif kind not in ("Mn", "Me"):
            return None
    return out or None


def _build_signs() -> tuple[str, tuple[str, ...]]:
    """All signs with an ASCII reading that the tables above don't have, and their readings."""
    done = {*TRANSLIT_FROM, *TRANSLIT_KEEP, *(ch for ch, _ in TRANSLIT_MULTI)}
    signs = [chr(cp) for a, b in _SIGN_BLOCKS for cp in range(a, b) if not 0xD800 <= cp < 0xE000 and chr(cp) not in done]
    pairs = [(ch, reading) for ch in signs if (reading := _sign(ch)) is not None]
    return "".join(ch for ch, _ in pairs), tuple(r for _, r in pairs)


SIGNS, SIGN_READINGS = _build_signs()
