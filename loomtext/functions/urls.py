"""URL canonicalisation and parts, as Spark column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.functions.text import col_of, java_trim

# Prefixes stripped once each, in this order, after lower-casing.
URL_PREFIXES = ("http://", "https://", "www.", "wap.", "wap2.", "wap3.",
                "iphone.", "phone.", "3g.", "i.", "m.", "g.", "touch.", "webapp.")

# One optional group per prefix, in list order: a greedy optional group strips its
# prefix exactly when the sequential strip would.
PREFIX_REGEX = "^" + "".join(f"(?:{re.escape(p)})?" for p in URL_PREFIXES)


def canonical_url(url) -> Column:
    """Lower-case, then strip each known prefix once, in list order."""
    return F.regexp_replace(F.lower(col_of(url)), PREFIX_REGEX, "")


def _slashes(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("/"), F.lit("")))


def site_dirs(url) -> Column:
    """Canonical site plus at most two directories, cut at the first ``?``.

    Cut before the third ``/`` if there is one, else before the second, else before
    the first; no ``/`` keeps the whole text.
    """
    u = canonical_url(url)
    n = _slashes(u)
    cut = (F.when(n == 0, u).when(n == 1, F.substring_index(u, "/", 1))
           .when(n == 2, F.substring_index(u, "/", 2)).otherwise(F.substring_index(u, "/", 3)))
    return F.substring_index(cut, "?", 1)


def domain_parts(url) -> Column:
    """``struct(domain, p1, p2)`` from the first three ``/`` pieces, each trimmed;
    the domain is empty when it starts with ``.``."""
    parts = F.split(canonical_url(url), "/", 4)
    p0 = java_trim(F.get(parts, 0))
    domain = F.when((p0 == "") | p0.startswith("."), F.lit("")).otherwise(p0)
    p1 = F.coalesce(java_trim(F.get(parts, 1)), F.lit(""))
    p2 = F.coalesce(java_trim(F.get(parts, 2)), F.lit(""))
    return F.struct(domain.alias("domain"), p1.alias("p1"), p2.alias("p2"))


def domain_path(url) -> Column:
    """U4: ``struct(domain, path)``: host before any ``?``, and the first path segment
    before ``#`` (and before ``?`` when there is no further segment); a segment that
    starts with ``?`` gives an empty path."""
    parts = F.split(canonical_url(url), "/", 3)
    n = F.size(parts)
    domain = java_trim(F.substring_index(F.get(parts, 0), "?", 1))
    seg = F.get(parts, 1)
    path = (F.when(n <= 1, F.lit(""))
            .when(n == 2, F.substring_index(F.substring_index(seg, "?", 1), "#", 1))
            .otherwise(F.substring_index(seg, "#", 1)))
    path = F.when(path.startswith("?"), F.lit("")).otherwise(path)
    return F.struct(domain.alias("domain"), path.alias("path"))
