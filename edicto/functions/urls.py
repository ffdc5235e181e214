"""URL functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from edicto.functions.text import ColumnOrName, col, let

RX_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
RX_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
RX_BASE_NO_QUERY = r"^([^?#]*)"
RX_BASE_NO_FRAGMENT = r"^([^#]*)"
RX_DOTS = r"^[^?#]*/\.\.?(?:[/?#]|$)"
RX_BASE_DIR = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(?:/[^?#]*/)?)"


def _resolved(url: Column) -> Column:
    """Dot segments of the path resolved: '.' goes, '..' takes the segment
    before it along, never above the root."""
    head = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(url, r"([?#].*)$", 1)
    parts = F.slice(F.split(path, "/"), 2, 1 << 30)
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda a, p: F.when(p == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))))
        .when(p == ".", a).otherwise(F.array_append(a, p)))
    # a path that ends in a dot segment names a folder
    folder = F.when(F.try_element_at(parts, F.lit(-1)).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(head, F.lit("/"), F.array_join(kept, "/"), folder, tail)


def url_join(base: ColumnOrName, href: ColumnOrName) -> Column:
    """Absolute URL of `href` relative to the page URL `base`.

    Handles scheme-absolute, network-path ('//host'), absolute-path,
    query-only, fragment-only, empty and plain relative references; dot
    segments of references with a path are resolved."""
    b, h = col(base), col(href)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(b, RX_ORIGIN, 1)
    base_dir = F.regexp_extract(b, RX_BASE_DIR, 1)
    dir_ = F.when(base_dir.endswith("/"), base_dir).otherwise(F.concat(base_dir, F.lit("/")))
    joined = F.when(h.startswith("/"), F.concat(origin, h)).otherwise(F.concat(dir_, h))
    return (
        F.when(h.isNull(), F.lit(None).cast("string"))
        .when(h == F.lit(""), b)
        .when(h.rlike(RX_SCHEME), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("?"), F.concat(F.regexp_extract(b, RX_BASE_NO_QUERY, 1), h))
        .when(h.startswith("#"), F.concat(F.regexp_extract(b, RX_BASE_NO_FRAGMENT, 1), h))
        .otherwise(let(joined, lambda u: F.when(u.rlike(RX_DOTS), _resolved(u)).otherwise(u)))
    )


def query_param(url: ColumnOrName, name: str) -> Column:
    """First value of query parameter `name`, plus- and percent-decoded;
    a missing or blank parameter gives null.  The query is read as text, so
    raw spaces, '|' or accents in it do no harm; a stray '%' stays as it is."""
    value = F.regexp_extract(col(url), r"^[^?#]*\?(?:[^#]*?&)?" + re.escape(name) + r"=([^&#]*)", 1)
    safe = F.regexp_replace(value, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.nullif(F.coalesce(F.try_url_decode(safe), value), F.lit(""))
