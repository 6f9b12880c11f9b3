"""String column expressions with the JVM ``String`` semantics the record formats assume.

Spark SQL's ``split`` keeps trailing empty strings and its ``trim`` removes spaces only,
while ``String.split`` (limit 0) drops trailing empties and ``String.trim`` removes
every character up to U+0020. These helpers give the latter, as plain Spark columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters removed by String.trim(): U+0000 .. U+0020.
_EDGE_CTRL = r"^[\x00-\x20]+|[\x00-\x20]+$"
# Line terminators recognised by a text-file scan.
LINE_BREAK = r"\r\n|\r|\n"
# Default document tokenizer: runs of whitespace, full stops and commas.
DOC_TOKEN_SPLIT = r"[\s.,]+"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    """``String.trim()``: strip all characters <= U+0020 at both ends."""
    return F.regexp_replace(col_of(c), _EDGE_CTRL, "")


def java_blank(c) -> Column:
    """True when ``String.trim()`` of the value is empty."""
    return ~col_of(c).rlike(r"[^\x00-\x20]")


def java_split(c, regex: str) -> Column:
    """``String.split(regex)`` with limit 0.

    Trailing empty pieces are dropped; an empty input gives ``[""]``; an input made
    only of separators gives ``[]``.
    """
    c = col_of(c)
    parts = F.split(c, regex)
    from_end = F.array_position(F.reverse(F.transform(parts, lambda x: x != F.lit(""))), True)
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(from_end == 0, F.array().cast("array<string>"))
            .otherwise(F.slice(parts, F.lit(1), F.size(parts) - from_end + 1)))


def text_lines(c) -> Column:
    """Lines of a text blob as a text-file scan yields them.

    ``\\n``, ``\\r`` and ``\\r\\n`` end a line; a final terminator does not open an
    extra empty line; an empty blob has no lines.
    """
    return lines_of_parts(F.split(col_of(c), LINE_BREAK))


def lines_of_parts(parts) -> Column:
    """:func:`text_lines` from the already split pieces: ``[""]`` (an empty blob) gives
    no line, and a final empty piece (a trailing terminator) is dropped."""
    parts = col_of(parts)
    return (F.when(F.element_at(parts, -1) == F.lit(""), F.slice(parts, F.lit(1), F.size(parts) - 1))
            .otherwise(parts))


def whitespace_words(line) -> Column:
    """``line.split("\\\\s+")``: a leading blank gives one empty word, an empty line one
    empty word, a whitespace-only line none."""
    line = col_of(line)
    return (F.when(line.rlike(r"^\s+$"), F.array().cast("array<string>"))
            .otherwise(F.split(F.regexp_replace(line, r"\s+$", ""), r"\s+")))


def doc_tokens(text, pattern: str = DOC_TOKEN_SPLIT) -> Column:
    """Lower-cased tokens of a document, split on ``pattern``; empty pieces removed."""
    return F.filter(F.split(F.lower(col_of(text)), pattern), lambda x: x != F.lit(""))


def suffixed_tokens(value, suffix: str) -> Column:
    """Title / keyword tokens: delete ``'``, split on single spaces, drop
    blank pieces, append ``suffix`` (``_1`` for titles, ``_2`` for keywords). A missing
    field gives no tokens."""
    value = F.coalesce(col_of(value), F.lit(""))
    pieces = F.split(F.replace(value, F.lit("'"), F.lit("")), " ")
    kept = F.filter(pieces, lambda x: ~java_blank(x))
    return F.transform(kept, lambda x: F.concat(x, F.lit(suffix)))
