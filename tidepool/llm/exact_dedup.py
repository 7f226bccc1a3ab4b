"""Exact dedup against a persistent digest index (DataFrame operations only).

The index is a table bucketed and sorted by digest, one row per distinct
normalised text. A batch is reduced to one row per digest (partial aggregation
first, so a text that a third of all rows share costs one row a task), anti-joined
with the index by sort-merge (the index side needs no shuffle, its buckets are the
join's partitions) and what is new is appended. A first batch meets the empty table.

Batches have names. A batch is joined with the rows of the other batches, so one that
is run again, after a driver was lost before or after its append, gives the same
answer and appends only what is missing. A missing name is refused, and so is a name
under which the index holds other documents.

Defined cases: a null text is an empty text; of equal texts the one with the most
code points stays, then the smallest doc_id, a null doc_id last; of rows that agree
in all of that one stays. An empty table gives an empty result and an empty index.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import answer_by_key, materialize, one_of_each, shared_path


def normalized(text: Column) -> Column:
    """The text without blanks, tabs and line ends (null: empty)."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(normalized(text), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: row_id, doc_id, digest, n_chars; written to the shared folder."""
    return materialize(docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("doc_id"),
        digest_of(F.col(text_col)).alias("digest"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_chars")), "digests")


def representatives(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays and the size of its group."""
    best = F.min(F.struct(
        (-F.col("n_chars")).alias("longest"), F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("doc_id"), F.col("row_id").alias("row_id")))
    return (rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("keep_row"),
                    "group_size"))


class DigestIndex:
    """Distinct digests seen so far, as a table bucketed and sorted by digest.

    ``path`` places the files (a shared folder); without it they go to the
    warehouse. Each append adds one file to every bucket; ``compact`` merges them.
    """

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None):
        self.spark, self.name, self.path = spark, name, path
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def _write(self, rows: DataFrame, name: str, path: str | None) -> None:
        out = (rows.repartition(self.buckets, "digest").write.mode("append").format("parquet")
               .bucketBy(self.buckets, "digest").sortBy("digest"))
        (out.option("path", path) if path else out).saveAsTable(name)

    def create(self, groups: DataFrame) -> None:
        """An empty table for rows like ``groups``, unless there is one."""
        if not self.exists():
            empty = groups.where(F.lit(False)).withColumn("batch", F.lit("")).withColumn("batch_check", F.lit(0).cast("long"))
            self._write(empty, self.name, self.path)

    def new_of(self, groups: DataFrame, batch_name: str) -> DataFrame:
        """Rows of ``groups`` (one per digest) whose digest no other batch holds."""
        others = self.read().where(F.col("batch") != batch_name).select("digest")
        return groups.join(others.hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch_name: str) -> DataFrame:
        """Append what is new in ``groups`` and not yet there; returns all that is new in the batch."""
        if not batch_name:
            raise ValueError("a batch needs a name")
        self.create(groups)
        check = groups.agg(F.coalesce(F.bit_xor(F.xxhash64("digest", "group_size", "keep_id")), F.lit(0))).first()[0]
        own = self.read().where(F.col("batch") == batch_name)
        before = own.select("batch_check").first()
        if before is not None and before[0] != check:
            raise ValueError(f"batch name {batch_name!r} is taken by other documents")
        fresh = materialize(self.new_of(groups, batch_name), "new-digests")
        missing = fresh if before is None else fresh.join(own.select("digest").hint("merge"), "digest", "left_anti")
        self._write(missing.withColumn("batch", F.lit(batch_name)).withColumn("batch_check", F.lit(check).cast("long")),
                    self.name, self.path)
        return fresh

    def compact(self) -> None:
        """Rewrite the index with one file per bucket."""
        whole = materialize(self.read(), "index-copy")
        self.spark.sql(f"DROP TABLE {self.name}")
        self.path = shared_path(self.spark, "digest-index") if self.path else None
        self._write(whole, self.name, self.path)


def exact_dedup(docs: DataFrame, index: DigestIndex, batch_name: str,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deduplicate ``docs`` within themselves and against ``index``, then append.

    One row per row of ``docs``: row_id, doc_id, digest, n_chars, keep_id (null if another
    batch holds the text), group_size (in this batch) and kept.
    """
    rows = digests(docs, id_col, text_col)
    groups = materialize(representatives(rows), "digest-groups")
    fresh = index.append(groups, batch_name)
    marked = groups.select("digest", "group_size").join(fresh.select("digest", "keep_id", "keep_row"), "digest", "left")
    found = answer_by_key(rows, materialize(marked, "digest-answers"), "digest", "group_size")
    return found.withColumn("kept", F.coalesce(F.col("row_id") == F.col("keep_row"), F.lit(False)))


def fresh_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index under a new name, its files in the shared folder."""
    path = shared_path(spark, "digest-index")
    return DigestIndex(spark, "digest_index_" + path.rpartition("-")[2], path, buckets)


def drop_copies(docs: DataFrame, index: DigestIndex, batch_name: str,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Joined back by id and digest; of rows that agree in both one is taken.
    """
    kept = exact_dedup(docs, index, batch_name, id_col, text_col).where("kept")
    text = F.col(text_col)
    return one_of_each(docs, {"doc_id": F.col(id_col), "digest": digest_of(text),
                              "n_chars": F.length(F.coalesce(text, F.lit("")))}, kept)
