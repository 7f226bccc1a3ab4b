"""Test data: seeded word records (S8), re-aimed from the stream producer.

Each input row becomes one record of ``words_per_record`` words drawn from
a fixed five-word list and joined by single spaces, with the partition key
``partitionKey-<n>`` where ``n`` runs 1..records_per_round and repeats every
round. The draw is a Lehmer (Park-Miller) step over (seed, row id, word
position), written with plain integer arithmetic, so the same records can be
computed in SQL by any engine and the totals checked against it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The producer's word list, in its order.
WORDS = ("spark", "you", "are", "my", "father")

# Fixed value: the producer's partition keys, numbered from 1.
PARTITION_KEY = "partitionKey-"

# Park-Miller modulus and multipliers.
MODULUS = 2147483647
MULTIPLIER = 48271
POSITION_STEP = 16807


def pick_index(row_id: Column, position: Column, seed: int) -> Column:
    """Index into ``WORDS`` for word ``position`` (0-based) of record ``row_id``."""
    h = F.pmod(F.pmod(row_id.cast("bigint"), F.lit(MODULUS)) * MULTIPLIER
               + (position.cast("bigint") + 1) * POSITION_STEP + seed, F.lit(MODULUS))
    h = F.pmod(h * MULTIPLIER, F.lit(MODULUS))
    return F.pmod(h, F.lit(len(WORDS)))


def word_records(df: DataFrame, id_col: str, words_per_record: int = 10,
                 records_per_round: int = 1000, seed: int = 7,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per row of ``df`` (``record STRING, partition_key STRING``)."""
    word_list = F.array(*[F.lit(w) for w in WORDS])
    rid = F.col(id_col)
    chosen = F.transform(F.sequence(F.lit(0), F.lit(words_per_record - 1)),
                         lambda i: F.element_at(word_list, (pick_index(rid, i, seed) + 1).cast("int")))
    part = F.concat(F.lit(PARTITION_KEY),
                    (F.pmod(rid.cast("bigint"), F.lit(records_per_round)) + 1).cast("string"))
    return df.select(*keep, rid.alias(id_col), F.array_join(chosen, " ").alias("record"),
                     part.alias("partition_key"))


def generated_words(df: DataFrame, id_col: str, words_per_record: int = 10,
                    seed: int = 7, keep: tuple[str, ...] = ()) -> DataFrame:
    """The words of ``word_records`` one per row, without building the text.

    Used for the sender-side totals (A9): the same draw, exploded by position.
    """
    word_list = F.array(*[F.lit(w) for w in WORDS])
    pos = F.explode(F.sequence(F.lit(0), F.lit(words_per_record - 1))).alias("_pos")
    exploded = df.select(*keep, F.col(id_col), pos)
    return exploded.select(*keep, F.element_at(
        word_list, (pick_index(F.col(id_col), F.col("_pos"), seed) + 1).cast("int")).alias("word"))
