"""Lines and tokens (P2, S1 line rule).

Tokenising follows Java's ``String.split(" ")``: leading and inner empty
tokens stay, trailing empty tokens are dropped, ``""`` gives one empty token
and a line of spaces gives none. Spark's ``split`` keeps trailing empties,
so the line is right-trimmed of spaces first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hadoop's line reader ends a line at \n, \r or \r\n; a final terminator
# does not open an empty last line.
_CR_BREAK = "\r\n?"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: Column | str) -> Column:
    """Array of the lines of a text, cut like a text file is cut into lines.

    ``''`` gives no lines, ``'a\\n'`` gives ``['a']``, ``'\\n'`` gives ``['']``.
    Carriage returns are rewritten to ``\\n`` only in texts that have one, so
    the common case splits on a single character without a regex scan.
    """
    text = _as_col(text)
    norm = (F.when(F.instr(text, "\r") > 0, F.regexp_replace(text, _CR_BREAK, "\n"))
            .otherwise(text))
    body = (F.when(norm.endswith("\n"), norm.substr(F.lit(1), F.length(norm) - 1))
            .otherwise(norm))
    return (F.when(text.isNull(), F.lit(None))
            .when(text == "", F.array().cast("array<string>"))
            .otherwise(F.split(body, "\n")))


def java_split(line: Column | str, sep: str = " ") -> Column:
    """Tokens of ``line`` as Java ``line.split(sep)`` gives them (sep is one space)."""
    if sep != " ":
        raise ValueError("only the single-space separator of the word jobs is supported")
    line = _as_col(line)
    trimmed = F.rtrim(line)  # Spark's rtrim removes ASCII spaces only
    return (F.when(line.isNull(), F.lit(None))
            .when(line == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ")))


def lines_of(df: DataFrame, text_col: str = "text", out: str = "value",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line of ``text_col`` (a text column read as if it were a file)."""
    return df.select(*keep, F.explode(split_lines(text_col)).alias(out))


def tokens(df: DataFrame, col: str = "value", out: str = "word",
           split_lines_first: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token.

    ``split_lines_first`` cuts at line breaks before splitting on spaces, as
    a text file or socket source does; byte records are not cut, so their
    newlines stay inside tokens.
    """
    if split_lines_first:
        df = df.select(*keep, F.explode(split_lines(col)).alias(col))
    return df.select(*keep, F.explode(java_split(col)).alias(out))
