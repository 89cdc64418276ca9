"""Missing prices: as-of lookup, repair from transactions, guarded write-back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def asof_price(fills: DataFrame, snapshots: DataFrame, by: str, time: str, price: str, bucket: str = "1 day") -> DataFrame:
    """fills with asof_price: the last price of their market at or before their time.

    A market's history is cut into buckets, so one busy market spreads over many tasks: the price is looked up within
    the bucket, and where that has none it is the last one carried over from earlier buckets, of which there is one row
    per market and bucket.
    """
    start = lambda: F.window(time, bucket)["start"]
    left = fills.withColumn("_b", start()).withColumns({"_p": F.lit(None).cast(snapshots.schema[price].dataType), "_is": F.lit(1)})
    right = snapshots.select(by, time, F.col(price).alias("_p")).withColumn("_b", start()).withColumn("_is", F.lit(0))
    within = W.partitionBy(by, "_b").orderBy(time, "_is").rowsBetween(W.unboundedPreceding, 0)
    found = right.unionByName(left, allowMissingColumns=True).withColumn("_last", F.last("_p", ignorenulls=True).over(within)).where("_is = 1")
    closing = right.groupBy(by, "_b").agg(F.max_by("_p", time).alias("_close"))
    buckets = left.select(by, "_b").union(closing.select(by, "_b")).distinct().join(closing, [by, "_b"], "left")
    earlier = W.partitionBy(by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    carried = buckets.select(by, "_b", F.last("_close", ignorenulls=True).over(earlier).alias("_carried"))
    out = found.join(carried, [by, "_b"], "left")
    return out.select(*fills.columns, F.coalesce("_last", "_carried").alias("asof_price"))


def group_by_signature(trades: DataFrame) -> DataFrame:
    return trades.groupBy("tx_signature").agg(F.sort_array(F.collect_list(F.struct("slab_address", "asset_index", "leg_index"))).alias("trades"))


def repair_prices(zero: DataFrame, prices: DataFrame) -> DataFrame:
    """Keys and new prices of trades without one: the first positive price (by pos) that their transaction has for
    their market. prices: tx_signature, slab_address, pos, price."""
    best = prices.where("price > 0").groupBy("tx_signature", "slab_address").agg(F.min_by("price", "pos").alias("new_price"))
    return zero.join(best, ["tx_signature", "slab_address"]).select("tx_signature", "asset_index", "leg_index", "new_price")


def apply_price_repairs(trades: DataFrame, updates: DataFrame) -> DataFrame:
    """trades with new prices written where the price is still 0."""
    both = trades.join(updates, ["tx_signature", "asset_index", "leg_index"], "left")
    price = F.when((F.col("price") == 0) & (F.col("new_price") > 0), F.col("new_price")).otherwise(F.col("price"))
    return both.withColumn("price", price).select(*trades.columns)


def run_summary(rows: DataFrame, **conditions: Column) -> DataFrame:
    """One row of counts, one per named condition."""
    return rows.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
