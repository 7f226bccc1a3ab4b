"""Mixing sources to target weights: Pareto order sampling (DataFrame operations only).

Targets: the mix holds ``share`` times all words; sources share it by weight, none above
``most`` times its own words, the excess going to the others by weight (``levels``: in
order of words a weight, the first source that stays below its cap fixes the level).

Whole copies: a source whose target is r times its words gives every document floor(r)
copies. The rest, F words, is a sample without replacement of unequal probabilities: a
document of b-bit size is included with min(1, c * b), c such that the expected words are
F, so long documents are repeated rather than short ones.

Order: documents are ranked by the odds of a random number over the odds of their
inclusion probability (certain ones first) and taken while their running words stay
within F; the last place goes to the document whose size comes closest to what is left.
The random number is a SHA-256 of seed and id, so reruns and other partitionings agree.

Running sums (``running_sums``) need no window over a source: rows are range-partitioned
by (group, order), summed inside each range, and a group that spans ranges carries its
sum into the next one (at most one carried row a range, which is broadcast). Facts of a
source reach its rows by ``answer_by_key``, hot ones broadcast.

Defined cases: a null text has no words and an empty one none, their ``taken`` is 0; a null
source is a source of its own, after all others; null ids draw one number, rows that agree
in id, size and source are exchangeable and taken one by one; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import answer_by_key, materialize

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
SEED = "mix"


def word_count(text: Column) -> Column:
    """Number of runs of characters other than blanks, tabs and line ends (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number strictly between 0 and 1 out of the first 52 bits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def running_sums(rows: DataFrame, group: list[str], order: list[str], values: list[str]) -> DataFrame:
    """``rows`` with ``sum_<value>`` of each value up to and with the row, by ``order`` inside ``group``.

    Order columns should tell rows apart; rows that agree in all get their sums in any order.
    """
    place = Window.partitionBy("range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranged = rows.repartitionByRange(*group, *order).withColumn("range", F.spark_partition_id())
    local = materialize(ranged.select("*", *(F.sum(v).over(place).alias(f"in_{v}") for v in values)), "running")
    before = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (local.groupBy("range", *group).agg(*(F.sum(v).alias(v) for v in values))
               .select("range", *group, *(F.sum(v).over(before).alias(f"before_{v}") for v in values))
               .where(F.col(f"before_{values[0]}").isNotNull()))
    out = local.join(F.broadcast(carried), ["range", *group], "left")
    return out.select(*rows.columns, *((F.col(f"in_{v}") + F.coalesce(f"before_{v}", F.lit(0))).alias(f"sum_{v}")
                                       for v in values))


def filled(rows: DataFrame, cap: str, weight: str, budget: Column) -> Column:
    """Level at which weight * level, at most ``cap`` each, add up to ``budget``, as a scalar of ``rows``.

    ``rows`` hold ``sum_<cap>`` and ``sum_<weight>`` in order of cap / weight.
    """
    whole = rows.agg(F.sum(weight)).scalar()
    level = (budget - (F.col(f"sum_{cap}") - F.col(cap))) / (whole - (F.col(f"sum_{weight}") - F.col(weight)))
    fits = rows.where(F.col(weight) > 0).where(level * F.col(weight) <= F.col(cap))
    return fits.agg(F.min_by(level, F.struct(f"sum_{cap}", f"sum_{weight}"))).scalar()


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target of every source, from rows (source, size)."""
    sources = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size"))
                          .withColumn("no_name", F.col("source").isNull()).withColumn("one", F.lit(1)), "sources")
    placed = running_sums(sources, [], ["no_name", "source"], ["one"])
    nth = (F.col("sum_one") - 1) % len(weights)
    weighed = placed.select("source", "source_size", (F.col("source_size") * most).alias("cap"),
                            F.element_at(F.array(*(F.lit(w) for w in weights)), nth.cast("int") + 1).alias("weight"))
    weighed = weighed.withColumn("steep", F.col("cap") / F.col("weight"))
    ordered = materialize(running_sums(weighed, [], ["steep", "source"], ["cap", "weight"]), "weighed")
    level = filled(ordered, "cap", "weight", ordered.agg(F.sum("source_size")).scalar() * share)
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return ordered.select("source", "source_size", target.alias("target"))


def inclusion(classes: DataFrame) -> DataFrame:
    """``classes`` (source, bits, words, extra) with the probability of one more copy of their documents.

    min(1, c * bits), where words * probability add up to ``extra`` over a source. A source
    has at most 63 classes, so a window over one is small.
    """
    by_source = Window.partitionBy("source_key")
    longer = by_source.orderBy(F.col("bits").desc()).rowsBetween(Window.unboundedPreceding, -1)
    weight = F.col("bits") * F.col("words")
    certain = F.coalesce(F.sum("words").over(longer), F.lit(0))
    rest = F.sum(weight).over(by_source) - F.coalesce(F.sum(weight).over(longer), F.lit(0))
    level = classes.select("*", F.when(rest > 0, (F.col("extra") - certain) / rest).alias("level"))
    fits = F.when(F.col("level") * F.col("bits") <= 1, F.struct((-F.col("bits")).alias("b"), F.col("level")))
    rate = F.min(fits).over(by_source)["level"]
    return (level.withColumn("rate", F.when(F.col("extra") > 0, F.least(F.lit(1.0), F.coalesce(
        F.greatest(rate, F.lit(0.0)) * F.col("bits"), F.lit(1.0)))).otherwise(0.0)).drop("level"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every row of ``docs``."""
    sized = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), F.monotonically_increasing_id().alias("row_id")), "sizes")
    source_key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))     # a null source has a key as well
    bits = F.when(F.col("size") > 0, F.length(F.conv(F.col("size").cast("string"), 10, 2))).otherwise(0)
    sized = sized.withColumn("source_key", source_key).withColumn("bits", bits)
    of_source = targets(sized, weights, share, most).withColumn("source_key", source_key).drop("source")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    of_source = of_source.withColumn("whole", whole.cast("long"))
    of_source = of_source.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    classes = sized.groupBy("source_key", "bits").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n_docs"))
    rated = inclusion(classes.join(of_source, "source_key"))
    bin_key = F.concat_ws("|", F.col("bits").cast("string"), F.col("source_key"))
    facts = materialize(rated.withColumn("bin", bin_key).select(
        "bin", "source_size", "target", "whole", "extra", "rate", "n_docs"), "rates")
    known = answer_by_key(sized.withColumn("bin", bin_key), facts, "bin", "n_docs")
    u = uniform(F.col("doc_id"), seed)
    odds = (u / (1 - u)) / (F.col("rate") / (1 - F.col("rate")))
    ranked = known.withColumn("odds", F.when(F.col("rate") >= 1, 0.0).when(F.col("rate") > 0, odds))
    ranked = ranked.select("doc_id", "source", "source_key", "size", "source_size", "target", "whole", "extra",
                           F.col("odds"), "row_id", F.when(F.col("rate") > 0, F.col("size")).otherwise(0).alias("adds"))
    placed = materialize(running_sums(ranked, ["source_key"], ["odds", "doc_id", "size", "row_id"], ["adds"]), "ranked")
    inside = (F.col("adds") > 0) & (F.col("sum_adds") <= F.col("extra"))
    left = placed.groupBy("source_key").agg(
        F.count(F.lit(1)).alias("rows_of_source"),
        (F.first("extra") - F.coalesce(F.max(F.when(inside, F.col("sum_adds"))), F.lit(0))).alias("left"))
    placed = answer_by_key(placed, materialize(left, "left"), "source_key", "rows_of_source")
    # Running words tell the rows of a source apart, so they name the one that takes the last place.
    outside = (F.col("adds") > 0) & ~inside
    off = F.abs(F.col("size") - F.col("left"))
    last = placed.where(outside).where(off < F.col("left")).groupBy("source_key").agg(
        F.min(F.struct(off.alias("off"), "sum_adds"))["sum_adds"].alias("place"))
    # Rows that cannot be last get keys of their own, so that no key is hot.
    place = F.when(outside, F.col("sum_adds")).otherwise(-F.col("row_id") - 1)
    marked = placed.withColumn("place", place).join(last.withColumn("is_last", F.lit(1)), ["source_key", "place"], "left")
    copies = F.col("whole") + inside.cast("long") + F.coalesce(F.col("is_last"), F.lit(0))
    return marked.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))
