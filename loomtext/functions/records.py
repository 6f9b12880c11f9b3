"""Backtick-separated ``key=value`` browse records: field access and identity.

S3 (last field by prefix), P1 (first ``key=`` hit), U11 (record to key/value rows),
U6/U7/F8 (identity resolution). All are Spark column expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import col_of, java_split, java_trim
from loomtext.functions.arrays import explode_rows

FIELD_SEP = "`"


def last_field(line, key: str) -> Column:
    """S3: value of the *last* backtick field that starts with ``key=``; null if none."""
    prefix = key + "="
    hits = F.filter(F.split(col_of(line), FIELD_SEP), lambda x: x.startswith(prefix))
    return F.substring(F.try_element_at(hits, F.lit(-1)), len(prefix) + 1, 1 << 30)


def field_value(line, key: str, anchored: bool = True) -> Column:
    """Text after the first ``key=`` up to the next backtick; ``""`` if absent.

    ``anchored=False`` finds ``key=`` anywhere, so ``uid`` also hits ``xuid=``; the
    default only accepts it at the start of a field.
    """
    lead = "(?:^|`)" if anchored else ""
    return F.regexp_extract(col_of(line), f"{lead}{re.escape(key)}=([^`]*)", 1)


def record_pairs(df: DataFrame, line: str = "value", key_col: str = "rec_id") -> DataFrame:
    """U11 in long form: ``(rec_id, key, value)``, one row per distinct key.

    Fields are trimmed, empty ones skipped, split at the first ``=`` (no ``=`` gives
    an empty value); a repeated key keeps its last value. A record's fields are few and
    all in one row, so "last wins" is an array filter inside the row (a field survives
    when no later field has its key): no shuffle.
    """
    fields = F.filter(F.transform(F.split(F.col(line), FIELD_SEP), lambda f: java_trim(f)), lambda f: f != "")
    kv = F.transform(fields, lambda f: F.struct(
        F.substring_index(f, "=", 1).alias("key"),
        F.when(F.instr(f, "=") > 0, F.substring(f, F.instr(f, "=") + 1, 1 << 30)).otherwise(F.lit("")).alias("value")))
    staged = df.select(key_col, kv.alias("_kv"))
    last = F.filter(F.col("_kv"), lambda x, i: ~F.exists(
        F.slice(F.col("_kv"), i + 2, F.greatest(F.size(F.col("_kv")) - i - 1, F.lit(0))),
        lambda y: y["key"] == x["key"]))
    return explode_rows(staged, last, "_p", (key_col,)).select(
        key_col, F.col("_p.key").alias("key"), F.col("_p.value").alias("value"))


def valid_identity(c) -> Column:
    """F8: trimmed value when non-empty and not ``null`` in any case, else null."""
    t = java_trim(col_of(c))
    return F.when((t != "") & (F.lower(t) != "null"), t)


def serial_to_id(sn) -> Column:
    """Middle piece of ``a-b-c`` (``String.split`` rules), ``""`` otherwise."""
    parts = java_split(col_of(sn), "-")
    return F.when(F.size(parts) == 3, F.get(parts, 1)).otherwise(F.lit(""))


def resolve_identity(uid, imei, snid, sn) -> Column:
    """First valid of ``uid``, ``imei``, ``snid``; else the serial's middle piece
    when the serial is non-blank; else ``""``."""
    sn_t = java_trim(F.coalesce(col_of(sn), F.lit("")))
    from_sn = F.when(sn_t != "", serial_to_id(sn_t)).otherwise(F.lit(""))
    return F.coalesce(valid_identity(uid), valid_identity(imei), valid_identity(snid), from_sn)


def record_identity(line, anchored: bool = True) -> Column:
    """U6 applied to a raw record line through P1 field lookups."""
    fv = lambda k: field_value(line, k, anchored)
    return resolve_identity(fv("uid"), fv("imei"), fv("snid"), fv("sn"))
