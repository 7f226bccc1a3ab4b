"""One query per operator, over whole tables, with the digest columns its contract asks for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import (
    bpe,
    conversation_trie,
    dac,
    decontaminate,
    exact_dedup,
    kd_shard,
    language_id,
    mixing,
    periodic_runs,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
)
from tidepool.llm.common import table

URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)
SHARDS = 40
TOKENIZER = "byte_bpe_50k.json"


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def tokenizer_path() -> str:
    """The public tokenizer file, installed at one path on every executor."""
    return public_tokenizers.path(TOKENIZER)


def token_digests(decoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, the digests of ids and decoded text, and the columns named."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *more)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return token_digests(bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path()))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a quarter of the ids is held out of training."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(id_remainder("doc_id", 4) != 2))
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    return language_id.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score",
                                                    "entropy", "rejected")


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    placed = kd_shard.kd_shards(table(spark, sf_dir, "documents"), shards=SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 35-word windows."""
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Trained on the labels of documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where(id_remainder("doc_id", 5) != 0)
    return toxicity.fit(table(spark, sf_dir, "documents"), labels)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a fifth of the ids is held out of training."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir))
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum in files of directly addressable codes."""
    return dac.token_files(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equal texts, against an empty index."""
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), exact_dedup.fresh_index(spark), "documents")
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, 3 bits."""
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, whose first turns come from every fifth one."""
    keys = conversation_trie.turn_keys(table(spark, sf_dir, "conversations"))
    turns, members = conversation_trie.rebuilt(conversation_trie.in_order(keys))
    return conversation_trie.trie(turns, members)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts repeats a stretch of its words up to its end.

    With h = crc32 of the id, h % 10 = 0 and n words: words from a = (h / 10) % n on become
    the p = 1 + (n - a) / (3 + (h / 10) % 8) words from a on, again and again (at most 10 times).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"), F.when(chosen, words).alias("words"))
    cut = cut.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    cut = cut.withColumn("p", period.cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.lit(10)))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a")))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the longest one, and digests of all runs and of the collapsed text."""
    found = periodic_runs.collapse_runs(with_planted_runs(table(spark, sf_dir, "documents")), shortest=12)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    found = found.withColumn("best", best)
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of weights 3, 1, 2 and 150 % of all words takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_bpe, op3_language_id, op4_kd_shards, op5_substring_dedup, op6_toxicity,
                               op7_token_files, op8_exact_dedup, op9_decontaminate, op10_simhash,
                               op11_conversation_trie, op12_periodic_runs, op13_mixing)
}
