"""The pipelines, from operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fillforge.operators import decode, enrich, mutate, registry, repair, rollup
from fillforge.sources import deliveries, scans
from fillforge.streaming.ingest import Ingest


def ingest_job(raw: DataFrame, stored: DataFrame, programs: list[str], markets: DataFrame, blocklist: DataFrame, layouts: DataFrame, most: int = 500) -> tuple[DataFrame, DataFrame]:
    """Raw deliveries (body) to (new trades, rejected deliveries)."""
    good, bad = deliveries.validate_deliveries(deliveries.read_deliveries(raw), most)
    rows = decode.extract_trades(deliveries.transactions(good), programs, markets, blocklist, layouts)
    return mutate.upsert_ignore(stored, rows), bad


def ingest_batch(raw: DataFrame, job: Ingest, number: int, most: int = 500) -> dict[str, int]:
    """Stores raw deliveries (body) as a batch of the job's target, and returns its counters with `rejected`, all observed
    on the writes. Deliveries are validated once and written with the reason of their rejection, if any, below
    deliveries/batch=<number>; that table is the quarantine as well."""
    path, seen = f"{job.log.path}/deliveries/batch={number}", Observation()
    marked = deliveries.mark_deliveries(deliveries.read_deliveries(raw.select("body")), most).select("body", "reason")
    marked.observe(seen, F.count("reason").alias("rejected")).write.mode("overwrite").parquet(path)
    good = raw.sparkSession.read.schema("body string, reason string").parquet(path).where("reason is null").select("body")
    return job.store(deliveries.transactions(deliveries.read_deliveries(good)), number) | {"rejected": seen.get.get("rejected", 0)}


def rollup_job(stats: DataFrame, trades: DataFrame, markets: DataFrame, network: str, as_of: Column) -> DataFrame:
    """The market list with fresh 24h volumes."""
    return rollup.markets_with_stats(markets, rollup.market_stats_rollup(stats, trades, network, as_of))


def registration_job(snapshots: list[DataFrame], markets: DataFrame, listed: DataFrame, tokens: DataFrame, network: str) -> DataFrame:
    """Account snapshots to rows to insert for markets that are new and not blocked.

    tokens: ca, symbol, name, logo_url; a market's collateral and base are its columns mint_address and base_mint where
    the snapshots' registry columns carry them.
    """
    found = registry.dedupe_markets(registry.union_scanners(*snapshots))
    new = registry.missing_markets(found, markets, registry.build_blocklist(listed, registry.retired(markets)))
    named = new.join(enrich.resolve_identity(new, tokens), "slab_address")
    return registry.register_markets(markets, named, network)


def repair_job(trades: DataFrame, prices: DataFrame, network: str) -> DataFrame:
    """trades with the prices that their transactions know, where none was stored."""
    zero = scans.scan_zero_price_trades(trades, network)
    return repair.apply_price_repairs(trades, repair.repair_prices(zero, prices))


def repair_from_transactions_job(trades: DataFrame, txs: DataFrame, layouts: DataFrame, network: str) -> DataFrame:
    """trades with prices read from the account data of their own transactions where none was stored. Only transactions
    of trades without a price are opened."""
    zero = scans.scan_zero_price_trades(trades, network)
    wanted = txs.join(zero.select(F.col("tx_signature").alias("signature")).distinct(), "signature", "left_semi")
    prices = decode.transaction_prices(wanted, layouts).select(F.col("signature").alias("tx_signature"), "slab_address", F.lit(0).alias("pos"), "price")
    return repair.apply_price_repairs(trades, repair.repair_prices(zero, prices))


def ingest_outcomes(rows: DataFrame, stored: DataFrame, markets: DataFrame, blocklist: DataFrame, keys: list[str] = mutate.TRADE_KEY) -> DataFrame:
    """rows with `outcome` (see with_outcomes), for the counters of a run."""
    flag = lambda df, name: df.select("slab_address").distinct().withColumn(name, F.lit(True))
    flagged = rows.join(flag(markets, "known"), "slab_address", "left").join(flag(blocklist, "blocked"), "slab_address", "left")
    return mutate.with_outcomes(flagged, stored, keys).select(*rows.columns, "outcome")
