"""The registered queries: the reference's jobs over the driver's tables.

Each function takes ``(spark, base_dir)`` and returns a DataFrame; nothing
is collected. Stream jobs appear here in their table form (a tumbling
window stands for a micro-batch), which the streaming tests compare with
the real streams.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import json_codec, records, scalar, text
from tidepool.operators import aggregates as agg
from tidepool.operators import latest, state, user_aggregate
from tidepool.plans import fixtures
from tidepool.sources.files import read_table

# Batch intervals of the stream jobs, the idle timeout, the
# start offset of the AtTimestamp start position.
WORD_BATCH = "2 seconds"
TRADE_BATCH = "5 seconds"
LIMITED_BATCH = "10 seconds"
IDLE_SECONDS = 300
START_HOURS_BACK = 5


def word_count(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences of each space-separated token of every text line."""
    words = text.tokens(fixtures.text_lines(spark, d), "value", "word", split_lines_first=True)
    return agg.word_count(words)


def record_word_count(spark: SparkSession, d: str) -> DataFrame:
    """P1 P2 A1 on byte records: each text as one UTF-8 record, decoded and split on
    spaces without cutting lines (newlines stay inside tokens, as in the stream jobs)."""
    docs = read_table(spark, d, "documents", ["text"], spread_out=True)
    recs = docs.select(F.encode("text", "UTF-8").alias("value"))
    lines = recs.select(records.decode_utf8("value").alias("line"))
    return agg.word_count(text.tokens(lines, "line", "word"))


def distinct_words(spark: SparkSession, d: str) -> DataFrame:
    """A2: number of distinct tokens."""
    return agg.distinct_count(word_count(spark, d))


def tag_size(spark: SparkSession, d: str) -> DataFrame:
    """Total UTF-16 tag length per (movie, user), user dropped."""
    return agg.tag_size(fixtures.tags(spark, d))


def trade_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Trade -> JSON bytes -> text -> strict parse -> fields."""
    t = fixtures.trades(spark, d)
    as_bytes = t.select(records.trade_to_json_bytes("v1").alias("value"))
    return records.parse_trades_bytes(as_bytes, "value", "r", "v1", strict=True).select("r.*")


def trade_parse_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """Tolerant parse of trade JSON in every producer shape.

    Malformed records and non-numeric prices give NULL fields
    (``parsed = false``); the source id is kept to identify the row.
    """
    columns = (*fixtures.TRADE_V1, "l_partkey", "l_orderkey", "l_quantity", "l_tax")
    t = fixtures.trade_json_variants(fixtures.trades(spark, d, columns))
    out = records.parse_trades(t.select(F.col("id").alias("source_id"), "shape", "json"), "json",
                               "r", "v1", strict=False)
    return out.select("source_id", "shape", "r.*", F.col("r").isNotNull().alias("parsed"))


def trade_json(spark: SparkSession, d: str) -> DataFrame:
    """The JSON text of every trade."""
    return fixtures.trades(spark, d).select("id", records.trade_to_json("v1").alias("json"))


def union_symbol_count(spark: SparkSession, d: str) -> DataFrame:
    """Trades per symbol over the union of two trade sources, duplicates kept."""
    first = fixtures.trades(spark, d, ("tickerSymbol",), spread_out=False)
    second = read_table(spark, d, "events", ["event_type"])
    both = agg.union_all(first.withColumnRenamed("tickerSymbol", "symbol"),
                         second.withColumnRenamed("event_type", "symbol"))
    return agg.word_count(both, "symbol")


def trade_line(spark: SparkSession, d: str) -> DataFrame:
    """The printable line of every trade."""
    t = fixtures.trades(spark, d)
    return t.select("id", records.trade_line("v1").alias("line"))


def symbol_count(spark: SparkSession, d: str) -> DataFrame:
    """Trades per symbol after a strict parse of their JSON bytes."""
    t = fixtures.trades(spark, d)
    as_bytes = t.select(records.trade_to_json_bytes("v1").alias("value"))
    parsed = records.parse_trades_bytes(as_bytes, "value", "r", "v1", strict=True)
    return agg.word_count(parsed.select(F.col("r.tickerSymbol").alias("tickerSymbol")),
                          "tickerSymbol")


def null_or_empty(spark: SparkSession, d: str) -> DataFrame:
    """F1 over a column with NULL, empty and other values."""
    docs = read_table(spark, d, "documents", ["doc_id", "lang", "text"])
    values = F.array(F.col("lang"), F.lit(""), F.lit(None).cast("string"), F.lit(" "), F.col("text"))
    rows = docs.select("doc_id", F.posexplode(values).alias("copy", "value"))
    return rows.select("doc_id", "copy", scalar.is_null_or_empty("value").alias("is_empty"))


def base64_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """One-line Base64 of every text and whether it decodes back."""
    docs = read_table(spark, d, "documents", ["doc_id", "text"], spread_out=True)
    b64 = scalar.base64_encode(F.encode("text", "UTF-8"))
    back = F.decode(scalar.base64_decode(b64, strict=True), "UTF-8")
    return docs.select("doc_id", b64.alias("b64"), (back == F.col("text")).alias("roundtrip_ok"))


def abbreviate_middle(spark: SparkSession, d: str) -> DataFrame:
    """middle-abbreviated texts and sources (with and without a mark), also of texts
    with characters of two UTF-16 units."""
    docs = read_table(spark, d, "documents", ["doc_id", "text", "source"], spread_out=True)
    return fixtures.wide_copies(docs).select(
        "doc_id", "copy",
        scalar.abbreviate_middle("text", 20, 10).alias("short_text"),
        scalar.abbreviate_middle("text", 20, 10, None).alias("short_text_nomark"),
        scalar.abbreviate_middle("source", 1, 0).alias("short_source"))


def json_elem_empty(spark: SparkSession, d: str) -> DataFrame:
    """is element ``k`` of each JSON document empty?"""
    docs = fixtures.json_elements(spark, d)
    return docs.select("event_id", "copy", scalar.json_element_empty("doc", "$.k").alias("is_empty"))


def symbol_count_per_batch(spark: SparkSession, d: str) -> DataFrame:
    """Trades per symbol per 5-second batch."""
    return agg.count_per_window(fixtures.trade_stream(spark, d), "ts", "symbol", TRADE_BATCH)


def word_count_per_batch(spark: SparkSession, d: str) -> DataFrame:
    """Words of the event records (type and properties) per 2-second batch."""
    ev = read_table(spark, d, "events", ["event_type", "props", "ts"], spread_out=True)
    recs = ev.select(F.encode(F.concat_ws(" ", "event_type", "props"), "UTF-8").alias("value"), "ts")
    lines = recs.select(records.decode_utf8("value").alias("record"), "ts")
    words = text.tokens(lines, "record", "word", split_lines_first=False, keep=("ts",))
    return agg.count_per_window(words, "ts", "word", WORD_BATCH)


def max_id_per_batch(spark: SparkSession, d: str) -> DataFrame:
    """Greatest trade id (string order) per 10-second batch."""
    return agg.max_string_per_window(fixtures.trade_stream(spark, d), "ts", "id", LIMITED_BATCH)


def batch_running_total(spark: SparkSession, d: str) -> DataFrame:
    """Rows per non-empty 10-second batch and the running total."""
    return agg.batch_running_totals(fixtures.trade_stream(spark, d), "ts", LIMITED_BATCH)


def distinct_symbols_running_total(spark: SparkSession, d: str) -> DataFrame:
    """A5 A8(a): distinct symbols per 5-second batch, summed over the batches so far."""
    per_symbol = agg.count_per_window(fixtures.trade_stream(spark, d), "ts", "symbol",
                                      TRADE_BATCH)
    per_batch = per_symbol.groupBy("window_start").agg(F.count(F.lit(1)).alias("n_symbols"))
    return agg.running_total(per_batch, "window_start", "n_symbols")


def _counted(spark: SparkSession, d: str) -> DataFrame:
    ev = read_table(spark, d, "events").select("event_type", "ts", "event_id")
    return state.running_counts(ev, "event_type", "ts", "event_id", IDLE_SECONDS)


def running_count(spark: SparkSession, d: str) -> DataFrame:
    """Running count per event type, one row per event, reset after 300 s idle."""
    return _counted(spark, d).select("event_type", "ts", "event_id", "n")


def idle_timeouts(spark: SparkSession, d: str) -> DataFrame:
    """One row per key timeout with the count it had."""
    return state.idle_timeouts(_counted(spark, d), "event_type", "ts", IDLE_SECONDS)


def state_output_count(spark: SparkSession, d: str) -> DataFrame:
    """A8(b): rows the keyed state function emits (counts plus timeouts) per key."""
    out = state.state_outputs(_counted(spark, d), "event_type", "ts", IDLE_SECONDS)
    return out.groupBy("event_type", "timed_out").agg(F.count(F.lit(1)).alias("n_rows"))


def start_at_timestamp(spark: SparkSession, d: str) -> DataFrame:
    """Trades arriving at or after (latest arrival - 5 hours).

    "Now" is the latest arrival, a scalar subquery: no job runs while the plan
    is built, and the bound still reaches the Parquet reader as a filter.
    """
    t = fixtures.trade_stream(spark, d)
    start = read_table(spark, d, "events", ["ts"]).agg(
        (F.max("ts") - F.expr(f"INTERVAL {START_HOURS_BACK} HOURS")).alias("start")).scalar()
    return t.where(F.col("ts") >= start).select("id", "symbol", "trade", "price", "quantity", "ts")


def latest_trade_per_key(spark: SparkSession, d: str) -> DataFrame:
    """P10 K2: the row an upsert-by-symbol table holds after all trades arrive in time order."""
    # Reduced map-side by its own shuffle, so nothing is spread before it.
    t = fixtures.trades(spark, d, ("tickerSymbol", "time", "id", "tradeType", "price", "quantity"),
                        spread_out=False)
    return latest.latest_per_key(t, "tickerSymbol", ["time", "id"])


def trade_v2_sink_rows(spark: SparkSession, d: str) -> DataFrame:
    """v2 trades as bytes -> strict parse -> payload -> sink columns,
    upserted by id (the table an id-keyed sink holds after every batch)."""
    t = fixtures.trade_stream(spark, d, spread_out=True)
    as_bytes = t.select(records.trade_to_json_bytes("v2").alias("value"), "ts")
    parsed = records.parse_trades_bytes(as_bytes, "value", "r", "v2", strict=True)
    columns = ["id", "symbol", "trade", "price", "quantity"]
    kept = latest.latest_per_key(parsed.select("r.*", "ts"), "id", ["ts"], columns + ["ts"])
    # The payload depends on the id only, so it is added after the upsert
    # reduction: same table, and no 1 KB strings through the aggregate.
    return kept.select(*columns, records.payload("id", 1024).alias("data"))


def word_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Words whose total over the lines of all documents differs from their total over
    the same documents as byte records (where line ends stay inside words)."""
    docs = read_table(spark, d, "documents", ["text"], spread_out=True)
    sent = agg.word_count(text.tokens(docs, "text", "word", split_lines_first=True))
    recs = docs.select(records.decode_utf8(F.encode("text", "UTF-8")).alias("line"))
    return agg.reconcile(sent, agg.word_count(text.tokens(recs, "line", "word")))


def trade_payload(spark: SparkSession, d: str) -> DataFrame:
    """Every trade with its 1024-character payload (deterministic form)."""
    t = fixtures.trades(spark, d, ("id",))
    return t.select("id", records.payload("id", 1024).alias("data"))


def nested_json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Nested records -> JSON text -> strict parse by schema -> fields."""
    written = fixtures.order_records(spark, d).select(json_codec.to_json_text("record").alias("json"))
    r = json_codec.parse_json(written, "json", fixtures.ORDER_RECORD, "r").select("r.*")
    return r.select("id", "part.key", "part.supplier", F.col("amounts")["price"].alias("price"),
                    F.col("amounts")["discount"].alias("discount"), F.array_join("marks", "").alias("marks"), "open", "shipped",
                    F.col("lines")[0]["no"].alias("line_no"), F.col("lines")[0]["tax"].alias("tax"),
                    F.col("lines")[0]["note"].isNull().alias("no_note"))


def event_props_typed(spark: SparkSession, d: str) -> DataFrame:
    """Event properties in every shape, read tolerantly as a whole-number field ``k``."""
    docs = fixtures.json_elements(spark, d)
    parsed = json_codec.parse_json(docs, "doc", "k BIGINT NOT NULL, more MAP<STRING, STRING>", "r", strict=False)
    return parsed.select("event_id", "copy", F.col("r").isNotNull().alias("parsed"), F.col("r.k").alias("k"))


def tag_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Number, total and greatest UTF-16 length of the tags of each (movie, user), by a user's aggregate."""
    tags = fixtures.tags(spark, d, spread_out=True)
    out = user_aggregate.aggregate(tags, ["movieId", "userId"], ["tag"], user_aggregate.TagStatistics("tag"),
                                   user_aggregate.TagStatistics.STATE, user_aggregate.TagStatistics.STATE)
    return out.withColumnRenamed("movieId", "movie").withColumnRenamed("userId", "user")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count": word_count,
    "distinct_words": distinct_words,
    "record_word_count": record_word_count,
    "tag_size": tag_size,
    "trade_json_roundtrip": trade_json_roundtrip,
    "trade_parse_tolerant": trade_parse_tolerant,
    "trade_line": trade_line,
    "symbol_count": symbol_count,
    "null_or_empty": null_or_empty,
    "base64_roundtrip": base64_roundtrip,
    "abbreviate_middle": abbreviate_middle,
    "json_elem_empty": json_elem_empty,
    "symbol_count_per_batch": symbol_count_per_batch,
    "word_count_per_batch": word_count_per_batch,
    "max_id_per_batch": max_id_per_batch,
    "batch_running_total": batch_running_total,
    "distinct_symbols_running_total": distinct_symbols_running_total,
    "running_count": running_count,
    "idle_timeouts": idle_timeouts,
    "state_output_count": state_output_count,
    "start_at_timestamp": start_at_timestamp,
    "latest_trade_per_key": latest_trade_per_key,
    "trade_v2_sink_rows": trade_v2_sink_rows,
    "word_reconcile": word_reconcile,
    "trade_json": trade_json,
    "union_symbol_count": union_symbol_count,
    "trade_payload": trade_payload,
    "nested_json_roundtrip": nested_json_roundtrip,
    "event_props_typed": event_props_typed,
    "tag_statistics": tag_statistics,
}
