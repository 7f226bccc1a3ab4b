"""Trade records: schemas, byte decoding and JSON codecs.

Parsing follows the coercions of a Jackson object mapper bound to a case
class: unknown fields are ignored, a missing or null number is 0, a missing
string is NULL, a JSON number given for a string field becomes its text, a
numeric string given for a number is parsed, and a fraction given for a
whole number is truncated. To get these from ``from_json`` every field is
read as text first and cast afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two record layouts, in declaration order.
TRADE_V1 = (("tickerSymbol", "string"), ("tradeType", "string"),
            ("price", "double"), ("quantity", "bigint"), ("id", "string"))
TRADE_V2 = (("symbol", "string"), ("trade", "string"),
            ("price", "double"), ("quantity", "bigint"), ("id", "string"))
LAYOUTS = {"v1": TRADE_V1, "v2": TRADE_V2}

# The human-readable trade line.
TRADE_LINE_FORMAT = "ID %s: %s %d shares of %s for $%.02f"

_CORRUPT = "_corrupt_record"


def layout(version: str) -> tuple[tuple[str, str], ...]:
    try:
        return LAYOUTS[version]
    except KeyError:
        raise ValueError(f"unknown trade layout {version!r}; use one of {sorted(LAYOUTS)}")


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType()}


def trade_schema(version: str = "v1") -> T.StructType:
    """The typed struct of a trade record."""
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in layout(version)])


def decode_utf8(value: Column | str) -> Column:
    """Bytes to text as UTF-8; invalid bytes become U+FFFD, as the JVM decodes."""
    value = F.col(value) if isinstance(value, str) else value
    return F.make_valid_utf8(value.cast("string"))


def _text_schema(version: str) -> T.StructType:
    fields = [T.StructField(n, T.StringType(), True) for n, _ in layout(version)]
    fields.append(T.StructField(_CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def _coerce(text: Column, type_name: str, on_bad: Column) -> Column:
    """Cast one field from its JSON text; ``on_bad`` is used for non-numbers."""
    if type_name == "string":
        return text
    as_double = text.try_cast("double")
    if type_name == "double":
        value, zero = as_double, F.lit(0.0)
    else:
        value = F.coalesce(text.try_cast("bigint"), as_double.try_cast("bigint"))
        zero = F.lit(0).cast("bigint")
    return (F.when(text.isNull(), zero)
            .when(value.isNotNull(), value)
            .otherwise(on_bad))


def _finish(raw: Column, json_text: Column, version: str, strict: bool) -> Column:
    """The trade struct from the all-text parse ``raw`` of ``json_text``."""
    shown = F.left(json_text, F.lit(200))
    if strict:
        not_number = F.raise_error(F.concat(F.lit("trade field is not a number: "), shown))
        record = F.struct(*[_coerce(raw.getField(n), t, not_number).alias(n)
                            for n, t in layout(version)])
        # A top-level value that is not an object parses to NULL: malformed too.
        malformed = F.raise_error(F.concat(F.lit("malformed trade JSON: "), shown))
        return (F.when(json_text.isNull(), F.lit(None))
                .when(raw.isNull(), malformed)
                .otherwise(record))
    fields, valid = [], raw.isNotNull() & raw.getField(_CORRUPT).isNull()
    for name, type_name in layout(version):
        value = _coerce(raw.getField(name), type_name, F.lit(None))
        fields.append(value.alias(name))
        if type_name != "string":
            valid = valid & value.isNotNull()
    return F.when(valid, F.struct(*fields))


def _raw_parse(json_text: Column, version: str, strict: bool) -> Column:
    if strict:
        return F.from_json(json_text, T.StructType(_text_schema(version).fields[:-1]),
                           {"mode": "FAILFAST"})
    return F.from_json(json_text, _text_schema(version),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def parse_trade(json_text: Column | str, version: str = "v1",
                strict: bool = True) -> Column:
    """P3/P4/F5 as one column expression (for small inputs and ad-hoc use).

    ``strict``: malformed JSON or a non-numeric number field fails the task.
    Tolerant: the whole record becomes NULL instead. On large inputs prefer
    ``parse_trades``, which parses each record once.
    """
    json_text = F.col(json_text) if isinstance(json_text, str) else json_text
    return _finish(_raw_parse(json_text, version, strict), json_text, version, strict)


def parse_trades(df: DataFrame, json_col: str | Column, out: str = "trade",
                 version: str = "v1", strict: bool = True) -> DataFrame:
    """Add the parsed trade struct ``out`` to ``df``.

    The JSON parser has no generated code and its result is read by every
    field coercion, so it runs in a projection of its own: once per record,
    with the coercions compiled in the next one.
    """
    text = F.col(json_col) if isinstance(json_col, str) else json_col
    staged = df.withColumn("_tp_json", text).withColumn(
        "_tp_raw", _raw_parse(F.col("_tp_json"), version, strict))
    return (staged.withColumn(out, _finish(F.col("_tp_raw"), F.col("_tp_json"), version, strict))
            .drop("_tp_raw", "_tp_json"))


def parse_trades_bytes(df: DataFrame, value_col: str = "value", out: str = "trade",
                       version: str = "v1", strict: bool = True) -> DataFrame:
    """P1 + P3/P4 over byte records."""
    return parse_trades(df, decode_utf8(value_col), out, version, strict)


def trade_struct(version: str = "v1", extra: tuple[str, ...] = ()) -> Column:
    """The trade columns of a DataFrame as one struct, in declaration order."""
    return F.struct(*[F.col(n) for n, _ in layout(version)], *[F.col(e) for e in extra])


def trade_to_json(version: str = "v1", extra: tuple[str, ...] = ()) -> Column:
    """JSON text of a trade in declaration order; NULL fields are written as null."""
    return F.to_json(trade_struct(version, extra), {"ignoreNullFields": "false"})


def trade_to_json_bytes(version: str = "v1", extra: tuple[str, ...] = ()) -> Column:
    """P5: UTF-8 bytes of ``trade_to_json``."""
    return F.encode(trade_to_json(version, extra), "UTF-8")


def trade_line(version: str = "v1") -> Column:
    """``ID <id>: <type> <quantity> shares of <symbol> for $<price>``."""
    symbol, kind, price, quantity, ident = (n for n, _ in layout(version))
    return F.format_string(TRADE_LINE_FORMAT, F.col(ident), F.col(kind),
                           F.col(quantity), F.col(symbol), F.col(price))


def trade_key(version: str = "v1") -> Column:
    """The symbol of a trade (NULL symbols stay one group)."""
    return F.col(layout(version)[0][0])


def payload(id_col: Column | str = "id", length: int = 1024, seed: int | None = None,
            deterministic: bool = True) -> Column:
    """A ``length``-character payload per record.

    The deterministic form repeats the SHA-256 hex of the id (64 characters);
    the random form is ``randstr`` (alphanumeric, seeded per partition).
    """
    if not deterministic:
        return F.randstr(F.lit(length), F.lit(seed if seed is not None else 0))
    id_col = F.col(id_col) if isinstance(id_col, str) else id_col
    reps = -(-length // 64)
    return F.left(F.repeat(F.sha2(id_col.cast("string"), 256), reps), F.lit(length))
