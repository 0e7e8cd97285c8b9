"""Mixing sources to target weights by capped water-filling.

A document's size is its number of words. All sources together are to give ``budget`` times the words
there are, shared by weight; no source gives more than ``epochs`` times its own words, and what is cut
off goes to the others by weight until none is above its cap. The fixed point is one water level: with
sources ordered by cap over weight, the level follows from running sums over the (few) source rows.

Every document is taken a whole number of times, and the rest of a source's target is filled with one
more copy of documents in the order of a seeded digest, up to the one whose middle lies within the
target. Which digest that is comes from word counts by digest prefix, so that only the documents of one
prefix in each source are put in order; a hot source is spread over all prefixes.

Null texts have size 0 and are taken as often as any, giving no words. Null sources form a source of
their own, the last one. Rows that repeat id and text share one digest and are taken alike, so a target may be missed by half of the words of such a group. The result
depends on the rows alone, so reruns agree. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faremill.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
PREFIX = 3  # hex digits: 4,096 prefixes a source
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def order_digest(doc_id: Column, text: Column, seed: str) -> Column:
    """Where a document stands in the order of its source: by id and text, so rows without an id are told apart."""
    parts = F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit(""))
    return F.md5(F.concat(*parts).cast("binary"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], budget: float, epochs: float) -> DataFrame:
    """Target words of each source, from (source, words). Weights repeat over sources by code point, null last."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = sizes.withColumn("weight", F.element_at(cycle, (F.row_number().over(order) - 1) % len(weights) + 1))
    capped = placed.withColumn("cap", F.lit(float(epochs)) * F.col("words"))
    everything = W.partitionBy()
    filled = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    levels = capped.select(
        "*",
        (
            (F.lit(float(budget)) * F.sum("words").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("level"),
    )
    # the level of the first source that stays below its cap holds for all behind it
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "source", "level")))
    with_level = levels.withColumn("water", open_level.over(everything)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("water"), F.col("cap")))
    return with_level.select("source", F.col("words").alias("source_size"), target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...],
    budget: float = 1.5,
    epochs: float = 2.0,
    seed: str = SEED,
    text: str = "text",
) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target`` and ``repeats``, the number of times the row is taken.

    Columns of those names in ``docs`` are replaced; other names may be the same as ours.
    """
    made = ("size", "source_size", "target", "repeats")
    kept = [name for name in docs.columns if name not in made]
    key, prefix = order_digest(F.col("doc_id"), F.col(text), seed), F.col("_digest").substr(1, PREFIX)
    # the given columns travel in one struct, so that no name of ours can meet one of theirs
    sized = docs.select(F.struct(*kept).alias("given"), "source", n_words(F.col(text)).alias("size"), key.alias("_digest"))
    narrow = cut_lineage(
        sized.groupBy("source", prefix.alias("prefix")).agg(F.sum("size").alias("words"))
    )
    targets = source_targets(narrow.groupBy("source").agg(F.sum("words").alias("words")), weights, budget, epochs)
    share = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    shares = targets.select("*", share.alias("whole")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    by_prefix = W.partitionBy("source").orderBy("prefix")
    running = narrow.withColumn("stop", F.sum("words").over(by_prefix))
    joined = running.withColumnRenamed("source", "_source").join(
        shares, F.col("_source").eqNullSafe(F.col("source")), "right"
    )
    # the prefix in which the rest of the target ends, and the words of the prefixes before it
    cut = joined.groupBy("source", "source_size", "target", "whole", "rest").agg(
        F.min(F.when(F.col("stop") > F.col("rest"), F.struct("prefix", (F.col("stop") - F.col("words")).alias("start")))).alias("cut")
    )
    plan = cut_lineage(cut)  # one row a source: its file's size decides whether the joins below broadcast it
    cuts = plan.select(F.col("source").alias("_source"), "source_size", "target", "whole", "rest", "cut")
    located = sized.join(cuts, F.col("source").eqNullSafe(F.col("_source")))
    inside = located.filter(F.col("cut.prefix") == prefix).groupBy("_source", "_digest").agg(
        F.sum("size").alias("_words"), F.first("cut.start").alias("_start"), F.first("rest").alias("_rest")
    )
    ahead = F.sum("_words").over(W.partitionBy("_source").orderBy("_digest")) - F.col("_words")
    fits = F.col("_start") + ahead + F.col("_words") / 2 <= F.col("_rest")
    last = inside.select("_source", "_digest", fits.alias("_fits"))
    last = cut_lineage(last.filter("_fits").groupBy("_source").agg(F.max("_digest").alias("_last")))
    final = located.join(last.withColumnRenamed("_source", "_at"), F.col("_source").eqNullSafe(F.col("_at")), "left")
    extra = F.coalesce(
        F.when(F.col("cut").isNull(), F.lit(True))
        .when(prefix != F.col("cut.prefix"), prefix < F.col("cut.prefix"))
        .otherwise(F.col("_digest") <= F.col("_last")),
        F.lit(False),
    ) & (F.col("rest") > 0)
    return final.select("given.*", "size", "source_size", "target", (F.col("whole") + extra.cast("bigint")).alias("repeats"))
