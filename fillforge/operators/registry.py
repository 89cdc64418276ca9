"""Market registry: discovery, blocklist, lifecycle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillforge.functions.clean import clean_decimals, max_leverage
from fillforge.operators.mutate import upsert_ignore

DUST = 1_000_000


def union_scanners(*scans: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def dedupe_markets(discovered: DataFrame, key: str = "slab_address", order: str = "ord") -> DataFrame:
    """One row per market: the last one found."""
    rest = [c for c in discovered.columns if c != key]
    return discovered.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("x")).select(key, "x.*")


def build_blocklist(*parts: DataFrame) -> DataFrame:
    """Distinct slab_address of static, configured and retired lists."""
    return reduce(lambda a, b: a.unionByName(b), (p.select("slab_address") for p in parts)).where("slab_address is not null").distinct()


def retired(markets: DataFrame) -> DataFrame:
    return markets.where("keeper_status = 'retired'").select("slab_address")


def known_slab_filter(rows: DataFrame, registry: DataFrame) -> DataFrame:
    return rows.join(registry.select("slab_address").distinct(), "slab_address", "left_semi")


def blocked_filter(rows: DataFrame, blocklist: DataFrame) -> DataFrame:
    return rows.join(blocklist.select("slab_address").distinct(), "slab_address", "left_anti")


def drop_known_signatures(fills: DataFrame, trades: DataFrame) -> DataFrame:
    return fills.join(trades.select("tx_signature").distinct(), "tx_signature", "left_anti")


def missing_markets(discovered: DataFrame, markets: DataFrame, blocklist: DataFrame) -> DataFrame:
    """Discovered markets that are neither registered nor blocked."""
    return blocked_filter(discovered.join(markets.select("slab_address"), "slab_address", "left_anti"), blocklist)


def register_markets(markets: DataFrame, found: DataFrame, network: str) -> DataFrame:
    """Rows to insert for newly found markets; those already there are skipped."""
    rows = found.withColumns({"metadata_source": F.lit("auto"), "network": F.lit(network), "max_leverage": max_leverage(F.col("initial_margin_bps")), "decimals": clean_decimals(F.col("decimals"))})
    return upsert_ignore(markets, rows, ["slab_address"])


def market_lifecycle(markets: DataFrame, discovered: DataFrame, accounts: DataFrame, protect_manual: bool = False) -> DataFrame:
    """slab_address, action, status, indexer_excluded of every market after a sweep.

    accounts: slab_address, readable, vault, accounts of the account blobs that exist. An excluded market that is found
    again with a vault above DUST or any account is re-enabled and swept in the same cycle. A market in discovery is
    closed if its account is gone, or if its vault is at most DUST and it has no accounts; unreadable ones stay.
    """
    d = discovered.select("slab_address", F.lit(True).alias("_found")).distinct()
    a = accounts.select("slab_address", F.lit(True).alias("_there"), F.col("readable").alias("_ok"), F.col("vault").alias("_vault"), F.col("accounts").alias("_n"))
    both = markets.join(d, "slab_address", "left").join(a, "slab_address", "left")
    excluded = F.coalesce("indexer_excluded", F.lit(False))
    found, there, ok = (F.coalesce(c, F.lit(False)) for c in ("_found", "_there", "_ok"))
    live = ok & ((F.col("_vault") > DUST) | (F.col("_n") > 0))
    may = excluded & found & live & (F.lit(not protect_manual) | (F.col("metadata_source") == "auto"))
    close = ~excluded & found & (~there | (ok & ~live)) & (F.col("status") != "closed")
    action = F.when(may, "reenable").when(close, "close").otherwise("keep")
    out = both.withColumn("action", action)
    status = F.when(F.col("action") == "reenable", "active").when(F.col("action") == "close", "closed").otherwise(F.col("status"))
    flag = F.when(F.col("action") == "reenable", False).when(F.col("action") == "close", True).otherwise(F.col("indexer_excluded"))
    return out.select("slab_address", "action", status.alias("status"), flag.alias("indexer_excluded"))
