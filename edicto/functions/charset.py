"""Page bytes to text (S1), in the JVM.

The encoding of a page is told by, in this order: a byte-order mark, the
charset its transport named, a charset declared in its first kilobyte, and
else UTF-8 if the bytes are valid UTF-8, or a fallback.  Labels are read as browsers do: 'iso-8859-1' and 'ascii'
mean windows-1252, and a page that declares UTF-16 without a byte-order mark
is read as UTF-8.  Bytes that are no text in the encoding become U+FFFD.

Single-byte encodings are read as Latin-1 and then translated by a table made
from the encoding's own codec, so any of them needs one line in SINGLE_BYTE.
"""

from __future__ import annotations

import codecs

from pyspark.sql import Column
from pyspark.sql import functions as F

from edicto.functions.text import ColumnOrName, col, let

SINGLE_BYTE = ("windows-1252", "windows-1250", "windows-1251", "windows-1253", "windows-1254", "windows-1257",
               "iso-8859-2", "iso-8859-5", "iso-8859-7", "iso-8859-15", "koi8-r")
#: Labels that mean another encoding.
LABELS = {"iso-8859-1": "windows-1252", "iso8859-1": "windows-1252", "latin1": "windows-1252", "latin-1": "windows-1252", "l1": "windows-1252",
          "ascii": "windows-1252", "us-ascii": "windows-1252", "cp1252": "windows-1252", "x-cp1252": "windows-1252",
          "iso-8859-9": "windows-1254", "latin2": "iso-8859-2", "latin-9": "iso-8859-15", "utf8": "utf-8", "unicode": "utf-8",
          "utf-16": "utf-8", "utf-16le": "utf-8", "utf-16be": "utf-8", "cp1251": "windows-1251", "koi8": "koi8-r"}
MARKS = (("EFBBBF", "utf-8"), ("FFFE", "utf-16le"), ("FEFF", "utf-16be"))
#: Bytes in which a declaration counts.
HEAD = 1024
RX_DECLARED = r"""(?is)<meta\b[^>]*?\bcharset\s*=\s*["']?\s*([a-z0-9_.:-]+)"""


def _table(charset: str) -> tuple[str, str]:
    """Latin-1 signs and what the encoding has in their place.  A byte that it
    leaves open stays as it is."""
    pairs = [(chr(b), codecs.decode(bytes([b]), charset, "ignore")) for b in range(256)]
    pairs = [(a, b) for a, b in pairs if b and a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _latin1(content: Column) -> Column:
    return F.decode(content, "ISO-8859-1")


def _utf16(content: Column, big: bool) -> Column:
    """UTF-16; halves of pairs that stand alone, and a last odd byte, are replaced."""
    high, low = r"[\x{D8}-\x{DB}]", r"[\x{DC}-\x{DF}]"
    unit = (lambda h: f"{h}." if big else f".{h}")
    good = f"(?:{unit(r'[^\x{D8}-\x{DF}]')}|{unit(high)}{unit(low)})"
    bad = "ÿý" if big else "ýÿ"
    mended = F.regexp_replace(_latin1(content), rf"(?s)\G({good}*+)(?:{unit(r'[\x{D8}-\x{DF}]')}|.\z)", f"$1{bad}")
    return F.decode(F.encode(mended, "ISO-8859-1"), "UTF-16BE" if big else "UTF-16LE")


def page_charset(content: ColumnOrName, header: ColumnOrName | None = None, fallback: str = "windows-1252") -> Column:
    """The encoding of a page's bytes (a name that `decode_page` knows)."""
    data = col(content)
    marked = F.lit(None).cast("string")
    for mark, name in reversed(MARKS):
        marked = F.when(F.startswith(F.hex(F.substring(data, 1, len(mark) // 2)), F.lit(mark)), name).otherwise(marked)
    declared = F.nullif(F.regexp_extract(_latin1(F.substring(data, 1, HEAD)), RX_DECLARED, 1), F.lit(""))
    if header is not None:
        declared = F.coalesce(F.nullif(F.btrim(col(header)), F.lit("")), declared)
    labels = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])
    name = let(F.lower(declared), lambda d: F.coalesce(F.try_element_at(labels, d), d))
    name = F.when(name.isin("utf-8", *SINGLE_BYTE), name)
    return F.coalesce(marked, name, F.when(F.is_valid_utf8(data.cast("string")), "utf-8"), F.lit(LABELS.get(fallback.lower(), fallback.lower())))


def decode_page(content: ColumnOrName, header: ColumnOrName | None = None, fallback: str = "windows-1252") -> Column:
    """The text of a page's bytes, without its byte-order mark; null stays null."""
    data = col(content)

    def read(name: Column) -> Column:
        text = F.make_valid_utf8(data.cast("string"))
        for charset in SINGLE_BYTE:
            text = F.when(name == charset, F.translate(_latin1(data), *_table(charset))).otherwise(text)
        text = F.when(name == "utf-16le", _utf16(data, False)).when(name == "utf-16be", _utf16(data, True)).otherwise(text)
        return F.regexp_replace(text, r"^\x{FEFF}", "")

    return F.when(data.isNotNull(), let(page_charset(data, header, fallback), read))


def encode_page(text: ColumnOrName, charset: str) -> Column:
    """Bytes of a text in an encoding (null where it can't hold the text); the
    inverse of `decode_page`, for fixtures."""
    t, name = col(text), charset.lower()
    if name in SINGLE_BYTE:
        a, b = _table(name)
        back = F.translate(t, b, a)
        whole = F.translate(back, a, b) == t
        return F.when(whole & ~back.rlike(r"[^\x{00}-\x{FF}]"), F.encode(F.when(~back.rlike(r"[^\x{00}-\x{FF}]"), back), "ISO-8859-1"))
    return F.encode(t, charset.upper())
