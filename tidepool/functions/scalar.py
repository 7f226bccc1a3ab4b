"""Column functions for the string and JSON helpers (F1-F7) and UTF-16 length.

All of them are compositions of built-in expressions, so they stay inside
whole-stage code generation and need no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default middle mark of abbreviate_middle.
DEFAULT_MIDDLE_MARK = "*.*"

# Java's basic Base64 decoder: standard alphabet, padding optional, no
# whitespace, and a lone trailing character is illegal.
_STRICT_BASE64 = (r"^([A-Za-z0-9+/]{4})*"
                  r"([A-Za-z0-9+/]{2}(==)?|[A-Za-z0-9+/]{3}=?)?$")


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_null_or_empty(c: Column | str) -> Column:
    """true for NULL or ``''``."""
    c = _as_col(c)
    return F.coalesce(c == "", F.lit(True))


def utf16_length(c: Column | str) -> Column:
    """Length in UTF-16 code units, as a JVM ``String.length`` counts.

    ``length`` counts code points, so a character beyond U+FFFF counts 2 here.
    """
    c = _as_col(c)
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("bigint")


def base64_encode(c: Column | str) -> Column:
    """Base64 of bytes (or of the UTF-8 bytes of a string) on one line.

    Spark may break long output into 76-character lines; those breaks are
    removed whatever the session setting is.
    """
    c = _as_col(c)
    return F.regexp_replace(F.base64(c), r"[\r\n]", "")


def base64_decode(c: Column | str, strict: bool = True) -> Column:
    """bytes from Base64 text.

    Illegal input fails the task when ``strict`` (the reference throws), or
    gives NULL otherwise. Missing padding is accepted.
    """
    c = _as_col(c)
    unpadded = F.regexp_replace(c, "=+$", "")
    padded = F.rpad(unpadded, (F.ceil(F.length(unpadded) / 4) * 4).cast("int"), "=")
    decoded = F.unbase64(padded)
    bad = F.concat(F.lit("Illegal base64 input: "), F.left(c, F.lit(40)))
    return (F.when(c.isNull(), F.lit(None).cast("binary"))
            .when(c.rlike(_STRICT_BASE64), decoded)
            .otherwise(F.raise_error(bad) if strict else F.lit(None).cast("binary")))


def json_element_empty(json_text: Column | str, path: str = "$") -> Column:
    """is the JSON element at ``path`` empty?

    Absent, JSON null, ``[]`` and ``""`` are empty; ``{}``, ``0``, ``false``
    and ``[null]`` are not. A NULL text has no element (true); text that is
    not JSON gives NULL.
    """
    text = _as_col(json_text)
    doc = F.try_parse_json(text)
    v = F.try_variant_get(doc, path, "variant")
    as_array = F.try_variant_get(v, "$", "array<variant>")
    is_string = F.schema_of_variant(v) == "STRING"
    empty_string = is_string & (F.try_variant_get(v, "$", "string") == "")
    empty = (v.isNull()
             | F.coalesce(F.is_variant_null(v), F.lit(False))
             | F.coalesce(F.size(as_array) == 0, F.lit(False))
             | F.coalesce(empty_string, F.lit(False)))
    return F.when(text.isNull() | doc.isNotNull(), empty)


def _utf16_part(units: Column, count: int, from_start: bool) -> Column:
    """Text of the first or last ``count`` UTF-16 units; half a surrogate pair becomes ``?``."""
    if count == 0:
        return F.lit("")
    size = 2 * count
    if from_start:
        part, edge = F.substring(units, 1, size), F.substring(units, size - 1, 1)
        rest = F.substring(units, 1, size - 2)
        cut, low, high = F.concat(F.decode(rest, "UTF-16BE"), F.lit("?")), "D8", "DB"
    else:
        part, edge = F.substring(units, -size, size), F.substring(units, -size, 1)
        rest = F.substring(units, -(size - 2), size - 2) if count > 1 else F.lit(b"")
        cut, low, high = F.concat(F.lit("?"), F.decode(rest, "UTF-16BE")), "DC", "DF"
    return F.when(F.hex(edge).between(low, high), cut).otherwise(F.decode(part, "UTF-16BE"))


def abbreviate_middle(c: Column | str, keep_start: int, keep_end: int,
                      middle_mark: str | None = DEFAULT_MIDDLE_MARK) -> Column:
    """keep the first ``keep_start`` and last ``keep_end`` characters.

    NULL or empty input gives ``''``; a NULL or empty mark is no mark; the
    text is returned unchanged when it is not longer than
    ``keep_start + keep_end + len(mark)``. Lengths are UTF-16 units, as a JVM
    string counts; a cut through a character beyond U+FFFF leaves a ``?``.
    """
    if keep_start < 0 or keep_end < 0:
        raise ValueError("keep_start and keep_end must be >= 0")
    mark = middle_mark or ""
    c = _as_col(c)
    limit = keep_start + keep_end + len(mark.encode("utf-16-be")) // 2
    # So many code points hold at least so many units: only the ends are encoded.
    start = _utf16_part(F.encode(F.left(c, F.lit(keep_start)), "UTF-16BE"), keep_start, True)
    end = _utf16_part(F.encode(F.right(c, F.lit(keep_end)), "UTF-16BE"), keep_end, False)
    short = (F.length(c) <= limit) & (utf16_length(c) <= limit)
    return (F.when(is_null_or_empty(c), F.lit(""))
            .when(short, c)
            .otherwise(F.concat(start, F.lit(mark), end)))
