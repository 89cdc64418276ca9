"""Queries over rollups and table mutations, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from fillforge.operators import mutate, rollup
from fillforge.plans.fixtures import AS_OF, fx, fxd, mk, oracle, sg



def as_of():
    return F.expr(AS_OF)


INTERVALS = {"1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour", "4h": "4 hours", "1d": "1 day"}
KEY = "created_at, tx_signature, asset_index, leg_index"
FILLS = "NOT is_liquidation AND size IS NOT NULL"


def bars_sql(interval: str, where: str = "true") -> str:
    return f"""SELECT slab_address, time_bucket(INTERVAL '{interval}', created_at) AS bucket,
 first(price ORDER BY {KEY}) FILTER (WHERE price > 0) AS open, max(price) FILTER (WHERE price > 0) AS high,
 min(price) FILTER (WHERE price > 0) AS low, last(price ORDER BY {KEY}) FILTER (WHERE price > 0) AS close,
 CAST(sum(size) AS BIGINT) AS volume, count(*) AS trades FROM fx WHERE {FILLS} AND {where} GROUP BY ALL"""


VOLUME_SQL = f"""SELECT slab_address, CAST(sum(abs(size)) AS BIGINT) AS volume_24h, count(*) AS trade_count_24h FROM fx
 WHERE network = 'devnet' AND {FILLS} AND created_at >= {AS_OF} - INTERVAL 24 HOURS GROUP BY 1"""


def rollup_sql(missing: str) -> str:
    pick = lambda c: f"CASE WHEN v.slab_address IS NOT NULL THEN v.{c} ELSE {missing.format(c=c)} END AS {c}"
    return oracle(f"v AS ({VOLUME_SQL}) SELECT coalesce(s.slab_address, v.slab_address) AS slab_address, {pick('volume_24h')}, {pick('trade_count_24h')}, s.last_price FROM sg s FULL JOIN v ON s.slab_address = v.slab_address")


FROM, TO, CUT = (f"TIMESTAMP '2024-01-{d} 00:00:00'" for d in (15, 25, 20))


def refreshed(spark, d):
    trades = fx(spark, d)
    stored = rollup.candles(trades.where(f"created_at < {CUT}"), "1 hour")
    return rollup.refresh_candles(stored, trades, "1 hour", F.expr(FROM), F.expr(TO))


def slices(spark, d):
    trades = fx(spark, d)
    return trades.where("event_id % 10 < 7"), trades.where("event_id % 10 >= 4").union(trades.where("event_id % 10 >= 8"))


NEW = "n AS (SELECT DISTINCT * FROM fx WHERE event_id % 10 >= 4 AND NOT event_id % 10 < 7)"


def merge_paths(spark, d):
    trades = fx(spark, d)
    paths = trades.where("event_id % 3 <> 0").unionByName(trades.where("event_id % 3 <> 1")).unionByName(trades.where("event_id % 7 < 5"))
    return mutate.upsert_ignore(trades.limit(0), paths)


def fenced(spark, d):
    markets = mk(spark, d)
    patch = markets.where("logo_url is null and mainnet_ca is not null").selectExpr("slab_address", "'https://example.com/ca/' || mainnet_ca as logo_url", "cast(null as string) as symbol")
    new, _ = mutate.fenced_update(markets, patch, "slab_address", F.expr("metadata_source = 'auto' and network = 'devnet'"))
    return new.select("slab_address", "symbol", "logo_url", "metadata_source")


def fenced_keys(spark, d):
    markets = mk(spark, d)
    patch = markets.where("logo_url is null and mainnet_ca is not null").selectExpr("slab_address", "'x' as logo_url")
    return mutate.fenced_update(markets, patch, "slab_address", F.expr("metadata_source = 'auto' and network = 'devnet'"))[1]


def violations(spark, d):
    trades, markets = fx(spark, d), mk(spark, d)
    rules = {"side": F.col("side").isin("long", "short"), "price_known": F.col("price") > 0}
    _, bad = mutate.check_constraints(trades, rules, ["event_id"], {"fk_market": ("slab_address", markets.where("status <> 'closed'"), "slab_address")})
    _, more = mutate.check_constraints(markets, mutate.market_rules(), ["slab_address"])
    return bad.select(F.col("event_id").cast("string").alias("key"), "rule").union(more)


def changes(spark, d):
    markets = mk(spark, d).select("slab_address", "symbol", "status", "logo_url")
    old = markets.where("cast(substr(slab_address, 2) as int) % 10 <> 1")
    new = markets.where("cast(substr(slab_address, 2) as int) % 10 <> 2").withColumn("status", F.expr("case when status = 'paused' then 'active' else status end"))
    return old, new


def change_feed(spark, d):
    out = mutate.snapshot_changes(*changes(spark, d), "slab_address")
    return out.selectExpr("op", "slab_address", "old.status as old_status", "new.status as new_status", "old.logo_url as old_logo", "new.logo_url as new_logo")


CHANGES_SQL = """o AS (SELECT slab_address, symbol, status, logo_url FROM mk WHERE CAST(substr(slab_address, 2) AS INT) % 10 <> 1),
n AS (SELECT slab_address, symbol, CASE WHEN status = 'paused' THEN 'active' ELSE status END AS status, logo_url FROM mk WHERE CAST(substr(slab_address, 2) AS INT) % 10 <> 2)
"""


def touched(spark, d):
    old, new = changes(spark, d)
    stamped = old.withColumn("updated_at", F.expr("TIMESTAMP '2024-01-01 00:00:00'"))
    return mutate.touch_updated_at(stamped, new, "slab_address", as_of()).select("slab_address", "status", "updated_at")


def swapped(spark, d):
    markets = mk(spark, d)
    return mutate.guarded_swap(markets, markets.where("false")).select("slab_address", "status")


USD_SQL = f"""SELECT slab_address, CAST(sum(abs(size) * price) AS DOUBLE) / pow(10.0::DOUBLE, any_value(CASE WHEN decimals BETWEEN 0 AND 18 THEN decimals ELSE 6 END)) AS volume_24h_usd
 FROM fx JOIN (SELECT slab_address, decimals FROM mk) m USING (slab_address) WHERE network = 'devnet' AND {FILLS} AND created_at >= {AS_OF} - INTERVAL 24 HOURS GROUP BY 1"""



def as_text(df, *columns):
    """df with these columns as text, so that no comparison rounds them."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def usd_of_decimals(spark, d):
    trades = fxd(spark, d).withColumn("size", (F.col("size") / F.lit("100000000000000000000").cast("decimal(21,0)")).cast("decimal(38,0)"))
    return rollup.volume_24h_usd(trades, mk(spark, d), "devnet", as_of())


BARS_TEXT = bars_sql("1 hour").replace("FROM fx", "FROM fxd").replace("CAST(sum(size) AS BIGINT)", "sum(size)")

GUESSED = "metadata_source = 'auto' AND mainnet_ca IS NULL AND symbol = 'SOL' AND logo_url IS NULL AND network = 'devnet'"

QUERIES = {
    "volume_24h_by_slab": (lambda s, d: rollup.volume_24h_by_slab(fx(s, d), "devnet", as_of()), oracle(VOLUME_SQL)),
    "exact_volume": (lambda s, d: rollup.exact_volume(fx(s, d).withColumn("size_text", F.concat(F.col("size").cast("string"), F.lit("0" * 20)))), oracle(f"SELECT slab_address, CASE WHEN sum(size) = 0 THEN '0' ELSE CAST(sum(size) AS VARCHAR) || '{'0' * 20}' END AS volume FROM fx WHERE {FILLS} GROUP BY 1")),
    "market_stats_rollup": (lambda s, d: rollup.market_stats_rollup(sg(s, d), fx(s, d), "devnet", as_of()), rollup_sql("s.{c}")),
    "market_stats_rollup_reset": (lambda s, d: rollup.market_stats_rollup(sg(s, d), fx(s, d), "devnet", as_of(), True), rollup_sql("0")),
    "markets_with_stats": (lambda s, d: rollup.markets_with_stats(mk(s, d), sg(s, d)), oracle("SELECT m.*, s.volume_24h, s.trade_count_24h, s.last_price FROM mk m LEFT JOIN sg s USING (slab_address) WHERE NOT coalesce(indexer_excluded, false) AND status <> 'closed'")),
    **{f"candles_{k}": (lambda s, d, v=v: rollup.candles(fx(s, d), v), oracle(bars_sql(v))) for k, v in INTERVALS.items()},
    "candles_truncated_1h": (lambda s, d: rollup.candles_truncated(fx(s, d), "hour"), oracle(bars_sql("1 hour"))),
    "candles_rollup_1h": (lambda s, d: rollup.rollup_candles(rollup.candles(fx(s, d), "1 minute"), "1 hour"), oracle(bars_sql("1 hour"))),
    "candles_refresh_1h": (refreshed, oracle(f"x AS ({bars_sql('1 hour', f'created_at < {CUT}')}), y AS ({bars_sql('1 hour', f'created_at >= {FROM} AND created_at < {TO}')}) SELECT * FROM x WHERE NOT (bucket >= {FROM} AND bucket < {TO}) UNION ALL SELECT * FROM y")),
    "last_price": (lambda s, d: rollup.last_price(fx(s, d)), oracle(f"SELECT slab_address, last(price ORDER BY {KEY}) AS last_price FROM fx WHERE {FILLS} AND price > 0 GROUP BY 1")),
    "volume_24h_usd": (lambda s, d: rollup.volume_24h_usd(fx(s, d), mk(s, d), "devnet", as_of()), oracle(USD_SQL.replace("WHERE network", "WHERE fx.network"))),
    "leaderboard": (lambda s, d: rollup.leaderboard(fx(s, d)), oracle(f"b AS (SELECT trader, CAST(sum(abs(size)) AS BIGINT) AS volume, count(*) AS trades, count(DISTINCT slab_address) AS markets FROM fx WHERE {FILLS} GROUP BY 1 ORDER BY volume DESC, trader LIMIT 100) SELECT *, rank() OVER (ORDER BY volume DESC) AS rank FROM b")),
    "trader_history_top5": (lambda s, d: rollup.trader_history(fx(s, d), "trader", 5), oracle("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trader ORDER BY created_at DESC, tx_signature DESC, asset_index DESC, leg_index DESC) AS n FROM fx) WHERE n <= 5")),
    "market_history_top20": (lambda s, d: rollup.trader_history(fx(s, d), "slab_address", 20), oracle("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slab_address ORDER BY created_at DESC, tx_signature DESC, asset_index DESC, leg_index DESC) AS n FROM fx) WHERE n <= 20")),
    "volume_24h_decimal": (lambda s, d: as_text(rollup.volume_24h_by_slab(fxd(s, d), "devnet", as_of()), "volume_24h"), oracle(VOLUME_SQL.replace("FROM fx", "FROM fxd").replace("CAST(sum(abs(size)) AS BIGINT)", "CAST(sum(abs(size)) AS VARCHAR)"))),
    "candles_decimal_1h": (lambda s, d: as_text(rollup.candles(fxd(s, d), "1 hour"), "open", "high", "low", "close", "volume"), oracle(f"b AS ({BARS_TEXT}) SELECT slab_address, bucket, trades, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in ('open', 'high', 'low', 'close', 'volume'))} FROM b")),
    "leaderboard_decimal": (lambda s, d: as_text(rollup.leaderboard(fxd(s, d)), "volume"), oracle(f"b AS (SELECT trader, sum(abs(size)) AS volume, count(*) AS trades, count(DISTINCT slab_address) AS markets FROM fxd WHERE {FILLS} GROUP BY 1 ORDER BY volume DESC, trader LIMIT 100) SELECT trader, CAST(volume AS VARCHAR) AS volume, trades, markets, rank() OVER (ORDER BY volume DESC) AS rank FROM b")),
    "volume_24h_usd_decimal": (usd_of_decimals, oracle(USD_SQL.replace("WHERE network", "WHERE fx.network"))),
    "public_trades": (lambda s, d: rollup.public_trades(fx(s, d)), oracle("SELECT trader, size, created_at FROM fx")),
    "upsert_trades_ignore": (lambda s, d: mutate.upsert_ignore(*slices(s, d)), oracle(f"{NEW} SELECT * FROM n")),
    "upsert_inserted_keys": (lambda s, d: mutate.upsert_ignore(*slices(s, d)).select(mutate.trade_key().alias("trade_key")), oracle(f"{NEW} SELECT tx_signature || '|' || asset_index || '|' || leg_index AS trade_key FROM n")),
    "to_trade_rows": (lambda s, d: mutate.to_trade_row(fx(s, d).drop("network"), "devnet").drop("size_text"), oracle("SELECT slab_address, trader, side, size, price, fee, tx_signature, asset_index, leg_index, is_liquidation, 'devnet' AS network, created_at FROM fx")),
    "merge_three_paths": (merge_paths, oracle("SELECT * FROM fx")),
    "retain_trades": (lambda s, d: mutate.retain_days(fx(s, d), as_of(), 10), oracle(f"SELECT * FROM fx WHERE created_at >= {AS_OF} - INTERVAL 10 DAYS")),
    "fenced_update": (fenced, oracle("SELECT slab_address, symbol, CASE WHEN metadata_source = 'auto' AND network = 'devnet' AND logo_url IS NULL AND mainnet_ca IS NOT NULL THEN 'https://example.com/ca/' || mainnet_ca ELSE logo_url END AS logo_url, metadata_source FROM mk")),
    "fenced_update_keys": (fenced_keys, oracle("SELECT slab_address FROM mk WHERE metadata_source = 'auto' AND network = 'devnet' AND logo_url IS NULL AND mainnet_ca IS NOT NULL")),
    "reset_guessed_identity": (lambda s, d: mutate.reset_guessed_identity(mk(s, d)).select("slab_address", "symbol", "name"), oracle(f"SELECT slab_address, CASE WHEN {GUESSED} THEN 'UNKNOWN' ELSE symbol END AS symbol, CASE WHEN {GUESSED} THEN 'Market ' || left(slab_address, 8) ELSE name END AS name FROM mk")),
    "repair_decimals": (lambda s, d: mutate.repair_decimals(mk(s, d)).select("slab_address", "decimals"), oracle("SELECT slab_address, CAST(CASE WHEN decimals NOT BETWEEN 0 AND 18 THEN 6 ELSE decimals END AS INT) AS decimals FROM mk")),
    "reset_corrupt_stats": (lambda s, d: mutate.reset_corrupt_stats(sg(s, d), ["volume_24h", "last_price"], ["volume_24h", "trade_count_24h"], 480), oracle("SELECT slab_address, CASE WHEN volume_24h > 480 OR last_price > 480 THEN 0 ELSE volume_24h END AS volume_24h, CASE WHEN volume_24h > 480 OR last_price > 480 THEN 0 ELSE trade_count_24h END AS trade_count_24h, last_price FROM sg")),
    "cascade_delete": (lambda s, d: mutate.cascade_delete(fx(s, d), mk(s, d).where("status = 'active'")).select("event_id", "slab_address"), oracle("SELECT event_id, slab_address FROM fx WHERE slab_address IN (SELECT slab_address FROM mk WHERE status = 'active')")),
    "constraint_violations": (violations, oracle("""SELECT CAST(event_id AS VARCHAR) AS key, 'side' AS rule FROM fx WHERE side NOT IN ('long', 'short')
 UNION ALL SELECT CAST(event_id AS VARCHAR), 'price_known' FROM fx WHERE NOT price > 0
 UNION ALL SELECT CAST(event_id AS VARCHAR), 'fk_market' FROM fx WHERE slab_address NOT IN (SELECT slab_address FROM mk WHERE status <> 'closed')
 UNION ALL SELECT slab_address, 'hyperp_needs_pool' FROM mk WHERE oracle_mode = 'hyperp' AND dex_pool_address IS NULL""")),
    "snapshot_changes": (change_feed, oracle(CHANGES_SQL + "SELECT CASE WHEN o.slab_address IS NULL THEN 'INSERT' WHEN n.slab_address IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op, coalesce(o.slab_address, n.slab_address) AS slab_address, o.status AS old_status, n.status AS new_status, o.logo_url AS old_logo, n.logo_url AS new_logo FROM o FULL JOIN n ON o.slab_address = n.slab_address WHERE o.slab_address IS NULL OR n.slab_address IS NULL OR (o.symbol, o.status, o.logo_url) IS DISTINCT FROM (n.symbol, n.status, n.logo_url)")),
    "touch_updated_at": (touched, oracle(CHANGES_SQL + f"SELECT n.slab_address, n.status, CASE WHEN o.slab_address IS NULL OR (o.symbol, o.status, o.logo_url) IS DISTINCT FROM (n.symbol, n.status, n.logo_url) THEN {AS_OF} ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at FROM n LEFT JOIN o ON o.slab_address = n.slab_address")),
    "snapshot_swap_empty": (swapped, oracle("SELECT slab_address, status FROM mk")),
}
