"""Inputs of the reference's jobs, derived from the driver's tables.

The reference reads text files, a tag CSV and trade JSON records; none of
these ship with it, so each is derived from a driver table (all rows, all
text) by a fixed rule, documented next to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import records
from tidepool.sources.files import read_table

# The letter blanked in the second copy of the text lines,
# the source whose tags are NULL, the period of emoji-suffixed tags.
BLANKED_LETTER = "e"
NULL_TAG_SOURCE = "src0"
EMOJI_PERIOD = 7
EMOJI = "\U0001F600"


def text_lines(spark: SparkSession, base_dir: str) -> DataFrame:
    """Lines: every document text, plus a copy with one frequent letter blanked.

    The copy brings double, leading and trailing spaces, which the word split
    has to treat like Java's ``split``. One column ``value``.
    """
    docs = read_table(spark, base_dir, "documents", ["text"], spread_out=True)
    both = F.array(F.col("text"), F.translate("text", BLANKED_LETTER, " "))
    return docs.select(F.explode(both).alias("value"))  # one scan for both copies


def tags(spark: SparkSession, base_dir: str, spread_out: bool = False) -> DataFrame:
    """Tag rows: movieId = lang, userId = source, tag = text of every document.

    Beside them: a NULL tag per document of one source under its own user (a
    group of only NULL tags), and every ``EMOJI_PERIOD``-th tag again with an
    emoji (two UTF-16 units) appended.
    """
    docs = read_table(spark, base_dir, "documents", ["doc_id", "lang", "source", "text"],
                      spread_out)
    none = F.lit(None).cast("string")

    def row(user: Column, tag: Column) -> Column:
        return F.struct(F.col("lang").alias("movieId"), user.alias("userId"), tag.alias("tag"))

    user = F.col("source")
    rows = F.array(row(user, F.col("text")),
                   F.when(user == NULL_TAG_SOURCE, row(F.concat(user, F.lit("-null")), none)),
                   F.when(F.col("doc_id") % EMOJI_PERIOD == 0,
                          row(user, F.concat("text", F.lit(EMOJI)))))
    # A plain array: Spark would test the size of a compacted one below the exchange.
    return docs.select(F.explode(rows).alias("r")).where("r IS NOT NULL").select("r.*")


# The trade columns and the source columns each one needs.
_TRADE_ID = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_TRADE_SOURCES = {
    "id": _TRADE_ID, "tickerSymbol": ("l_partkey",), "tradeType": ("l_returnflag",),
    "price": ("l_extendedprice",), "quantity": ("l_quantity",), "time": ("l_shipdate",),
    "l_partkey": ("l_partkey",), "l_orderkey": ("l_orderkey",), "l_quantity": ("l_quantity",),
    "l_tax": ("l_tax",),
}
TRADE_V1 = ("tickerSymbol", "tradeType", "price", "quantity", "id")


def trades(spark: SparkSession, base_dir: str, columns: tuple[str, ...] = TRADE_V1,
           spread_out: bool = True) -> DataFrame:
    """The asked ``columns`` of trade records (v1 layout) from ``lineitem``, plus ``time``
    and source columns if asked for; only the source columns they need are read.

    id = ``orderkey-linenumber-partkey-suppkey`` (unique), symbol = ``P<partkey>``.
    ``spread_out`` for heavy per-row work (JSON, hashing) before the first shuffle.
    """
    needed = list(dict.fromkeys(c for name in columns for c in _TRADE_SOURCES[name]))
    li = read_table(spark, base_dir, "lineitem", needed, spread_out)
    parts = [F.col(c).cast("string") for c in _TRADE_ID]
    exprs = {
        "id": F.concat_ws("-", *parts),
        "tickerSymbol": F.concat(F.lit("P"), F.col("l_partkey").cast("string")),
        "tradeType": F.col("l_returnflag"), "price": F.col("l_extendedprice"),
        "quantity": F.col("l_quantity").cast("bigint"), "time": F.col("l_shipdate"),
    }
    return li.select(*[exprs.get(c, F.col(c)).alias(c) for c in columns])


def trade_json_variants(trade_rows: DataFrame) -> DataFrame:
    """JSON texts of the trades in the shapes a producer may send, by ``l_partkey % 10``.

    0 cut short (malformed), 1 written in the v2 layout, 2 numeric id,
    3 price as a string, 4 fractional quantity, 5 only symbol and id,
    6 an unknown extra field, 7 a price that is not a number, else none.
    Every trade also gives its plain JSON; ``shape`` is -1 there.
    """
    t = trade_rows
    v1 = records.trade_to_json("v1")
    opts = {"ignoreNullFields": "false"}
    as_v2 = F.to_json(F.struct(F.col("tickerSymbol").alias("symbol"),
                               F.col("tradeType").alias("trade"), "price", "quantity", "id"), opts)
    numeric_id = F.to_json(F.struct("tickerSymbol", "tradeType", "price", "quantity",
                                    F.col("l_orderkey").alias("id")), opts)
    text_price = F.to_json(F.struct("tickerSymbol", "tradeType",
                                    F.col("price").cast("string").alias("price"),
                                    "quantity", "id"), opts)
    frac_qty = F.to_json(F.struct("tickerSymbol", "tradeType", "price",
                                  (F.col("l_quantity") + 0.5).alias("quantity"), "id"), opts)
    sparse = F.to_json(F.struct("tickerSymbol", "id"), opts)
    extra = F.to_json(F.struct("tickerSymbol", "tradeType", "price", "quantity", "id",
                               F.col("l_tax").alias("note")), opts)
    bad_price = F.to_json(F.struct("tickerSymbol", "tradeType", F.lit("n/a").alias("price"),
                                   "quantity", "id"), opts)
    case = F.col("l_partkey") % 10
    # The shapes are multiplied before any text is built, so each text is built once.
    shape = F.explode(F.array(F.lit(-1).cast("bigint"), case.cast("bigint"))).alias("shape")
    shaped = t.select("*", shape).where("shape < 8")
    text = F.when(F.col("shape") == -1, v1).when(F.col("shape") == 0, F.left(v1, F.lit(25)))
    for number, shape_text in enumerate((as_v2, numeric_id, text_price, frac_qty, sparse, extra, bad_price), 1):
        text = text.when(F.col("shape") == number, shape_text)
    return shaped.select(*t.columns, "shape", text.alias("json"))


# A record with every kind of nesting; NOT NULL marks JVM primitives.
ORDER_RECORD = """id STRING, part STRUCT<key: BIGINT NOT NULL, supplier: BIGINT NOT NULL>,
    amounts MAP<STRING, DOUBLE>, marks ARRAY<STRING>, open BOOLEAN NOT NULL, shipped TIMESTAMP_NTZ,
    lines ARRAY<STRUCT<no: INT NOT NULL, tax: DOUBLE NOT NULL, note: STRING>>"""


def order_records(spark: SparkSession, base_dir: str) -> DataFrame:
    """``lineitem`` rows as nested records of ``ORDER_RECORD`` (column ``record``)."""
    li = read_table(spark, base_dir, "lineitem", spread_out=True)
    key = F.struct(F.col("l_partkey").alias("key"), F.col("l_suppkey").alias("supplier"))
    amounts = F.create_map(F.lit("price"), F.col("l_extendedprice"), F.lit("discount"), F.col("l_discount"))
    line = F.struct(F.col("l_linenumber").alias("no"), F.col("l_tax").alias("tax"), F.lit(None).cast("string").alias("note"))
    return li.select(F.struct(
        F.concat_ws("-", *(F.col(c).cast("string") for c in _TRADE_ID)).alias("id"), key.alias("part"),
        amounts.alias("amounts"), F.array("l_returnflag", "l_linestatus").alias("marks"),
        (F.col("l_linestatus") == "O").alias("open"), F.col("l_shipdate").alias("shipped"),
        F.array(line).alias("lines")).alias("record"))


def trade_stream(spark: SparkSession, base_dir: str, spread_out: bool = False) -> DataFrame:
    """The trade stream (v2 layout) from ``events``: id = event_id as text.

    The string order of these ids differs from their numeric order.
    """
    ev = read_table(spark, base_dir, "events", ["event_type", "user_id", "value", "event_id",
                                                "ts"], spread_out)
    return ev.select(
        F.col("event_type").alias("symbol"),
        F.when(F.col("user_id") % 2 == 0, F.lit("BUY")).otherwise(F.lit("SELL")).alias("trade"),
        F.col("value").alias("price"),
        F.col("user_id").alias("quantity"),
        F.col("event_id").cast("string").alias("id"),
        F.col("ts"), F.col("event_id"))


def json_elements(spark: SparkSession, base_dir: str) -> DataFrame:
    """``events.props`` as they are (``copy`` 0) and, beside them, element ``k`` in every
    other shape, one per event in turn, text that is not JSON among them (``copy`` 1)."""
    ev = read_table(spark, base_dir, "events", ["event_id", "props"], spread_out=True)
    shapes = F.array(*[F.lit(s) for s in JSON_SHAPES])
    turn = F.element_at(shapes, (F.col("event_id") % len(JSON_SHAPES) + 1).cast("int"))
    return ev.select("event_id", F.posexplode(F.array("props", turn)).alias("copy", "doc"))


# Shapes of the element ``k``; the last two are no JSON.
JSON_SHAPES = ('{}', '{"k":null}', '{"k":[]}', '{"k":""}', '{"k":{}}', '{"k":"[]"}',
               '{"k":[null]}', '{"k":0}', '{"k":', 'k=1')


def wide_copies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row as it is (``copy`` 0) and again with one letter as an emoji (``copy`` 1)."""
    copies = F.array(F.col(text_col), F.translate(text_col, BLANKED_LETTER, EMOJI))
    rest = [c for c in docs.columns if c != text_col]
    return docs.select(*rest, F.posexplode(copies).alias("copy", text_col))
