"""Mixing sources to target weights by repetition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillforge.llm.common import staged, unwrapped, wrapped

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and the seed only; the same in every run."""
    hexed = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 8)
    return F.conv(hexed, 16, 10).cast("long") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """sizes (_source, source_size: one row per source) with target.

    Sources by code point, null last, take the weights in turn and share `share` of all sizes. No target passes `most`
    times its source's size; the excess goes to the others by weight. Sources sorted by most * size / weight are capped
    from the front; running sums give the level (words per weight) that is left after each. It rises while capping is
    due and falls after that, so the largest one holds. The windows see one row per source.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("w", F.get(cycle, (F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1) % len(weights)))
    order = W.orderBy(most * F.col("source_size") / F.col("w"), F.col("_source").asc_nulls_last())
    before, everything = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    total = F.sum("source_size").over(everything)
    capped = F.coalesce(F.sum("source_size").over(before), F.lit(0))
    open_weight = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    stepped = ranked.withColumn("level", (share * total - most * capped) / open_weight)
    level = F.max("level").over(everything)
    cap = most * F.col("source_size")
    return stepped.withColumn("target", F.least(cap, F.coalesce(level * F.col("w"), cap))).select("_source", "source_size", "target")


def copies(rate: Column, key: Column, seed: int) -> Column:
    """floor(rate), plus one with a chance of the rate's fraction."""
    return (F.floor(rate) + F.when(draw(key, seed) < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def with_copies(rows: DataFrame, source: str, size: str, key: str, weights: tuple[int, ...], share: float, most: float, seed: int) -> DataFrame:
    """rows with source_size, target and _copies. The sums per source are written first, so that the planner knows
    their size: it broadcasts them below its threshold and else splits the join where a source is hot."""
    sizes = rows.groupBy(F.col(source).alias("_source")).agg(F.sum(size).alias("source_size"))
    targets = staged(source_targets(staged(sizes, "source_sizes"), weights, share, most), "source_targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    out = rows.join(targets, rows[source].eqNullSafe(targets["_source"]), "left").drop("_source")
    return out.withColumn("_copies", copies(rate, F.col(key), seed))


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 8) -> DataFrame:
    """One row per row of docs: id, size, source_size, target (its source's) and taken (size times its copies).

    Null and empty texts have size 0, very long ones are counted whole. Sources that hold no words have target 0. Rows
    that repeat an id draw alike, and so do equal ids in every run. An empty table gives an empty result. Columns of docs
    that are not named are not read, so their names cannot clash. What a source takes scatters around its target by the
    root of the sum over its documents of size ** 2 * f * (1 - f), f being the fraction of its rate.
    """
    rows = staged(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_s"), word_count(F.col(text_col)).alias("size")), "sizes")
    out = with_copies(rows, "_s", "size", "_id", weights, share, most, seed)
    return out.select(F.col("_id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("_copies")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 8) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken. A document without words (null, empty or blank
    text) is never taken. Rows that repeat an id draw alike, null ids share one draw, null sources form one source; texts
    of any length are counted whole; an empty table stays empty, and other columns stay whatever their names are."""
    rows = wrapped(docs, _key=id_col, _s=source_col, _t=text_col).withColumn("_size", word_count(F.col("_t"))).drop("_t")
    out = with_copies(rows, "_s", "_size", "_key", weights, share, most, seed).where("_size > 0 and _copies > 0")
    return unwrapped(out.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))))
