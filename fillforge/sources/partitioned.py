"""Trades in folders of network and day: scans read one network, writes replace the folders that they touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillforge.operators import repair
from fillforge.sources import scans

PARTS = ("network", "day")


def store(trades: DataFrame, path: str) -> None:
    """Writes trades into the folders of their network and day, which they replace; all others stay as they are. Rows are
    dealt by folder, and Spark splits the large ones and unites the small."""
    dealt = trades.withColumn("day", F.to_date("created_at")).hint("rebalance", *PARTS)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The trades; a condition on network or day reaches the listing of folders."""
    return spark.read.parquet(path)


def repair_stored(spark: SparkSession, path: str, prices: DataFrame, network: str) -> list[str]:
    """Writes the prices that transactions know into the stored trades of a network without one. Only the days that hold
    such a trade are read whole and written; returns them."""
    trades = read(spark, path).where(F.col("network") == network)
    fixes = repair.repair_prices(scans.scan_zero_price_trades(trades, network), prices)
    days = [r["day"] for r in trades.where("price = 0").join(fixes, ["tx_signature", "asset_index", "leg_index"], "left_semi").select("day").distinct().collect()]
    if days:
        store(repair.apply_price_repairs(trades.where(F.col("day").isin(days)), fixes).drop("day"), path)
    return sorted(map(str, days))
