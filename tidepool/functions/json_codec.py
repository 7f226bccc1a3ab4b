"""JSON text of any record type and back, with an object mapper's coercions.

``parse_json`` compiles a schema, nested structs, arrays and maps included, to one
``from_json`` that reads every scalar as text, and casts of those texts:

- unknown fields are ignored; a field that is missing or null is NULL, or, where the schema
  says NOT NULL, the default of its type as for a JVM primitive (0, 0.0, false);
- a number or boolean given for a string becomes its text; a numeric string given for a number
  is parsed; a fraction given for a whole number is truncated;
- booleans are true and false, their texts in any case, or a number (0 is false);
- dates and timestamps are read from their ISO texts, binary values from Base64.

Strict parsing fails the task at malformed JSON or a value that does not fit; tolerant
parsing makes the whole record NULL. (A string field given an object or array gets its JSON
text: the parser cannot tell it from a string of that text.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_record"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_text(kind: T.DataType) -> T.DataType:
    """The type that ``kind`` is first parsed as: every scalar a string."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType), True)
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ValueError("JSON keys are strings: a map needs string keys")
        return T.MapType(T.StringType(), _as_text(kind.valueType), True)
    if isinstance(kind, (T.NumericType, T.BooleanType, T.StringType, T.DateType, T.TimestampType,
                         T.TimestampNTZType, T.BinaryType)):
        return T.StringType()
    raise ValueError(f"no JSON form for {kind.simpleString()}")


def _scalar(text: Column, kind: T.DataType) -> Column:
    """The value of a text, NULL if it has none."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        word, number = F.lower(F.trim(text)), text.try_cast("double")
        return F.when(word.isin("true", "false"), word == "true").otherwise(number != 0)
    if isinstance(kind, T.BinaryType):
        return F.when(text.rlike(r"^[A-Za-z0-9+/\s]*={0,2}$"), F.unbase64(text))
    if isinstance(kind, _WHOLE):
        return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))
    return text.try_cast(kind)


def _decoded(raw: Column, kind: T.DataType, nullable: bool) -> tuple[Column, Column]:
    """(value, whether everything in it fits) of a parsed ``raw``."""
    if isinstance(kind, T.StructType):
        parts = [(f.name, *_decoded(raw.getField(f.name), f.dataType, f.nullable)) for f in kind.fields]
        fits = F.lit(True)
        for _, _, ok in parts:
            fits = fits & ok
        value = F.struct(*(v.alias(n) for n, v, _ in parts))
        return F.when(raw.isNotNull(), value), raw.isNull() | fits
    if isinstance(kind, T.ArrayType):
        inner, empty = kind.elementType, kind.containsNull
        return (F.transform(raw, lambda x: _decoded(x, inner, empty)[0]),
                raw.isNull() | F.forall(raw, lambda x: _decoded(x, inner, empty)[1]))
    if isinstance(kind, T.MapType):
        inner, empty = kind.valueType, kind.valueContainsNull
        return (F.transform_values(raw, lambda _, x: _decoded(x, inner, empty)[0]),
                raw.isNull() | F.forall(F.map_values(raw), lambda x: _decoded(x, inner, empty)[1]))
    value, missing = _scalar(raw, kind), F.lit(None).cast(kind)
    if not nullable and isinstance(kind, (T.NumericType, T.BooleanType)):
        missing = F.lit(False if isinstance(kind, T.BooleanType) else 0).cast(kind)
    return F.when(raw.isNull(), missing).otherwise(value), raw.isNull() | value.isNotNull()


def parse_json(df: DataFrame, json_col: Column | str, schema: T.StructType | str, out: str = "record",
               strict: bool = True) -> DataFrame:
    """add ``out``, the typed record of each JSON text; a NULL text gives NULL.

    The parse has no generated code and is read by every cast, so it stands in a projection of its own.
    """
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    if _CORRUPT in schema.fieldNames():
        raise ValueError(f"{_CORRUPT} is the parser's own field")
    text = F.col(json_col) if isinstance(json_col, str) else json_col
    wanted = _as_text(schema)
    if strict:
        raw = F.from_json(F.col("_tp_json"), wanted, {"mode": "FAILFAST"})
    else:
        wanted = T.StructType([*wanted.fields, T.StructField(_CORRUPT, T.StringType(), True)])
        raw = F.from_json(F.col("_tp_json"), wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    staged = df.withColumn("_tp_json", text).withColumn("_tp_raw", raw)
    parsed = F.col("_tp_raw")
    value, fits = _decoded(parsed, schema, True)
    if strict:
        shown = F.left("_tp_json", F.lit(200))
        bad = F.raise_error(F.concat(F.lit("not a record of the schema: "), shown))
        record = F.when(F.col("_tp_json").isNull(), F.lit(None)).when(parsed.isNotNull() & fits, value).otherwise(bad)
    else:
        record = F.when(parsed.isNotNull() & parsed.getField(_CORRUPT).isNull() & fits, value)
    return staged.withColumn(out, record).drop("_tp_json", "_tp_raw")


def to_json_text(value: Column | str) -> Column:
    """JSON text of any value; NULL fields and elements are written as null, a NULL value as ``null``."""
    value = F.col(value) if isinstance(value, str) else value
    listed = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(listed, F.lit(2), F.length(listed) - 2)
