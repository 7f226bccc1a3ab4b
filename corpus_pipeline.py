"""The corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and keeps the columns of ``documents``, the last
one apart; ``run`` writes what a stage returns to the shared folder and reads it back as
the next one's ``docs``, so a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from tidepool.llm.common import materialize, table
from tidepool.llm.queries import id_remainder, token_digests, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose score reaches their language's threshold."""
    labels = table(spark, sf_dir, "labels").where(id_remainder("doc_id", 5) != 0)
    return toxicity.score(docs, toxicity.fit(docs, labels), keep_clean=True)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts that are equal without white space."""
    return exact_dedup.drop_copies(docs, exact_dedup.fresh_index(spark), "documents")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of fingerprints within 3 bits (3-word shingles)."""
    return simhash.drop_near_copies(docs, shingle=3, bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and decoded text of every document left."""
    return token_digests(bpe.encode_decode(docs, tokenizer_path()), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

ORACLE_SQL = None    # no stage but exact dedup can be put in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
