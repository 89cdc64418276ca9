"""Queries over deliveries, decoding, registry, enrichment and repair, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from fillforge.functions import clean
from fillforge.functions.binary import abs_text, hex_le, i128_of_hex, le_bytes, u128_le, uint_le
from fillforge.operators import decode, enrich, registry, repair
from fillforge.plans import jobs
from fillforge.plans.fixtures import AS_OF, fx, mk, oracle, table
from fillforge.plans.rawdata import PROGRAM, account_data, address, address_sql, instruction, market_accounts, raw_transactions, token_pairs
from fillforge.plans.shared import shared_path, written
from fillforge.sources import deliveries, scans

BODIES = """SELECT event_id, CASE event_id % 8
 WHEN 0 THEN '{"signature":"a","instructions":[{"programId":"p","data":"d","accounts":["x"]}]}'
 WHEN 1 THEN '[{"signature":"a"},{"signature":"b","extra":{"k":1}}]'
 WHEN 2 THEN '{"signature":"a"'
 WHEN 3 THEN '[{"signature":"a"},{"signature":5}]'
 WHEN 4 THEN '[{"signature":"a","instructions":[{"' || CASE event_id % 3 WHEN 0 THEN 'constructor' WHEN 1 THEN 'prototype' ELSE '__proto__' END || '":null}]}]'
 WHEN 5 THEN '[{},{},{},{}]'
 WHEN 6 THEN '[{"innerInstructions":[{"instructions":[{"accounts":["x",7]}]}]}]'
 ELSE '[{"accountData":[{"account":null}]}]' END AS body FROM {events}"""


def validation(s, d):
    raw = s.sql(BODIES.replace("{", "{{").replace("}", "}}").replace("{{events}}", "{events}"), events=table(s, d, "events"))
    marked = deliveries.mark_deliveries(deliveries.read_deliveries(raw), 3)
    return marked.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"), F.sum(F.coalesce(F.size("items"), F.lit(0))).alias("txs"))


VALIDATION_SQL = """SELECT CASE WHEN k IN (0, 1) THEN 'ok' WHEN k = 2 THEN 'bad_json' WHEN k = 5 THEN 'too_many' ELSE 'invalid_format' END AS reason,
 count(*) AS n, CAST(sum(CASE k WHEN 1 THEN 2 WHEN 2 THEN 0 WHEN 3 THEN 2 WHEN 5 THEN 4 ELSE 1 END) AS BIGINT) AS txs FROM (SELECT event_id % 8 AS k FROM events) GROUP BY 1"""


def decoded(s, d, where):
    rows = instruction(fx(s, d).where(where)).select(address(F.col("tx_signature"), 64).alias("signature"), F.lit(False).alias("is_inner"), F.lit(0).alias("group_no"), F.col("event_id").cast("int").alias("ix"), "i.data", "i.accounts")
    return decode.with_bytes(rows)


def fills(s, d, where):
    return decode.decode_fills(decoded(s, d, where)).selectExpr("cast(ix as bigint) as event_id", "slab_address", "trader", "asset_index", "side", "size_text", "cast(size as bigint) as size")


FILLS_SQL = f"SELECT event_id, {address_sql('slab_address')} AS slab_address, {address_sql('trader')} AS trader, asset_index, side, CAST(size AS VARCHAR) AS size_text, size FROM fx WHERE NOT is_liquidation AND size <> 0 AND event_id % 2 = "


def liquidations(s, d):
    return decode.decode_liquidations(decoded(s, d, "true")).selectExpr("cast(ix as bigint) as event_id", "slab_address", "trader", "asset_index")


def no_layouts(s):
    return s.createDataFrame([], "data_len int, engine_price_off int, config_price_off int")


def extraction(s, d):
    trades = fx(s, d)
    txs = written(raw_transactions(trades, F.col("leg_index") == 2), "transactions")
    known = trades.select(address(F.col("slab_address")).alias("slab_address")).where("slab_address not like 'Mz3%'")
    blocked = known.where("slab_address like 'M17%'")
    out = decode.extract_trades(txs.union(txs), [PROGRAM], known, blocked, no_layouts(s))
    return out.selectExpr("slab_address", "trader", "side", "cast(size as bigint) as size", "size_text", "cast(price as double) as price", "cast(fee as double) as fee", "tx_signature", "asset_index", "leg_index", "is_liquidation")


EXTRACTION_SQL = f"""x AS (SELECT *, row_number() OVER (PARTITION BY tx_signature, trader, slab_address, side, size ORDER BY event_id) AS e FROM fx WHERE NOT is_liquidation AND size <> 0),
f AS (SELECT *, row_number() OVER (PARTITION BY tx_signature ORDER BY event_id) - 1 AS n FROM x WHERE leg_index <> 2 OR e = 1),
m AS (SELECT *, row_number() OVER (PARTITION BY tx_signature ORDER BY event_id) + 999 AS n FROM fx WHERE is_liquidation AND leg_index <> 2),
p AS (SELECT tx_signature, slab_address, first(price ORDER BY event_id) AS p FROM fx WHERE price > 0 GROUP BY ALL),
u AS (SELECT tx_signature, slab_address, trader, side, size, asset_index, n, is_liquidation FROM f UNION ALL SELECT tx_signature, slab_address, trader, NULL, NULL, asset_index, n, is_liquidation FROM m)
SELECT {address_sql('slab_address')} AS slab_address, {address_sql('trader')} AS trader, side, size, CAST(size AS VARCHAR) AS size_text,
 CASE WHEN NOT is_liquidation THEN CAST(coalesce(p, 0) AS DOUBLE) END AS price, CASE WHEN NOT is_liquidation THEN 0.0::DOUBLE END AS fee,
 {address_sql('tx_signature', 64)} AS tx_signature, asset_index, CAST(n AS INT) AS leg_index, is_liquidation
 FROM u LEFT JOIN p USING (tx_signature, slab_address) WHERE slab_address NOT LIKE 'M03' AND slab_address <> 'M17'"""


def leg_numbers(s, d):
    rows = fx(s, d).where("not is_liquidation").selectExpr("event_id", "tx_signature as signature", "leg_index = 2 as is_inner", "0 as group_no", "cast(event_id as int) as ix", "0 as leg", "is_liquidation")
    return decode.numbered(rows).select("event_id", "leg_index")


def echoes(s, d):
    rows = fx(s, d).where("not is_liquidation").selectExpr("event_id", "tx_signature as signature", "false as is_inner", "0 as group_no", "cast(event_id as int) as ix", "0 as leg", "trader", "slab_address", "side", "cast(size as string) as size_text")
    inner = rows.withColumn("is_inner", F.lit(True)).where("event_id % 2 = 0")
    more = inner.withColumn("trader", F.concat("trader", F.lit("x"))).withColumn("group_no", F.lit(1))
    return decode.drop_inner_echo(rows.union(inner).union(more).union(more.withColumn("group_no", F.lit(2)))).selectExpr("event_id", "is_inner", "trader")


ECHO_SQL = """SELECT event_id, false AS is_inner, trader FROM fx WHERE NOT is_liquidation
 UNION ALL SELECT min(event_id), true, trader || 'x' FROM fx WHERE NOT is_liquidation AND event_id % 2 = 0 GROUP BY tx_signature, trader, slab_address, side, size"""


def mark_prices(s, d):
    rows = fx(s, d).where("price is not null")
    accounts = rows.withColumn("a", account_data(rows)).select("event_id", decode.account_bytes(F.when(F.col("event_id") % 2 == 0, F.col("a.data")).otherwise(F.concat(F.lit('["'), F.col("a.data"), F.lit('","base64"]')))).alias("bytes"))
    old = F.concat(F.unhex(F.lit("11" * 10)), le_bytes(F.lit(0), 8), le_bytes(F.col("event_id"), 8))
    accounts = accounts.union(rows.where("event_id % 3 = 0").select((-F.col("event_id")).alias("event_id"), old.alias("bytes")))
    layouts = s.createDataFrame([(26, 10, 18)], "data_len int, engine_price_off int, config_price_off int")
    return decode.mark_prices(accounts, layouts).select("event_id", F.col("mark_price").cast("double").alias("mark_price"))


MARK_SQL = """SELECT event_id, CASE WHEN price > 0 THEN CAST(price AS DOUBLE) END AS mark_price FROM fx WHERE price IS NOT NULL
 UNION ALL SELECT -event_id, CASE WHEN event_id > 0 THEN event_id / 1000000.0::DOUBLE END FROM fx WHERE price IS NOT NULL AND event_id % 3 = 0"""


def wide_integers(s, d):
    data = F.concat(le_bytes(F.col("l_orderkey"), 8), le_bytes(-F.col("l_partkey") - 1, 16), le_bytes(F.col("l_suppkey"), 16))
    rows = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", data.alias("b")).withColumn("digits", hex_le(F.col("b"), 8, 16))
    signed = i128_of_hex(F.col("digits"))
    return rows.select("l_orderkey", "l_linenumber", uint_le(F.col("b"), 0, 8).cast("long").alias("u64"), signed["negative"].alias("negative"), abs_text(signed).alias("abs_text"), u128_le(F.col("b"), 24).cast("long").alias("u128"))


def accounts(s, d):
    out = scans.decode_markets(market_accounts(table(s, d, "supplier")))
    return out.selectExpr("slab_address", "version", "cast(vault as bigint) as vault", "cast(insurance as bigint) as insurance", "cast(c_tot as bigint) as c_tot", "cast(mark_price as double) as mark_price", "initial_margin_bps", "admin is not null as has_admin")


ACCOUNTS_SQL = """SELECT s_name AS slab_address, CAST(17 AS INT) AS version, CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE CAST(abs(CAST(round(s_acctbal * 100) AS BIGINT)) AS BIGINT) END AS vault,
 CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE CAST(s_suppkey AS BIGINT) END AS insurance, CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE CAST(s_nationkey AS BIGINT) END AS c_tot,
 CASE WHEN s_suppkey BETWEEN 1 AND 999999 THEN CAST(s_suppkey AS DOUBLE) END AS mark_price, CAST(500 AS BIGINT) AS initial_margin_bps, true AS has_admin FROM supplier WHERE s_suppkey % 5 <> 0"""


def known_accounts(s, d):
    snap = market_accounts(table(s, d, "supplier"))
    wanted = table(s, d, "supplier").where("s_nationkey < 10").select(F.col("s_name").alias("pubkey"))
    return scans.scan_known_accounts(snap, wanted, PROGRAM).select("pubkey", "slot")


def asset_logo(s, d):
    rows = table(s, d, "part").select("p_partkey", F.struct(F.struct(F.when(F.col("p_size") % 3 == 0, "https://a/i.png").when(F.col("p_size") % 3 == 1, "ftp://a/i").alias("image")).alias("links"), F.array(
        F.struct(F.lit("video/mp4").alias("mime"), F.lit("https://a/v").alias("uri"), F.lit(None).cast("string").alias("cdn_uri")),
        F.struct(F.when(F.col("p_size") % 2 == 0, "image/png").alias("mime"), F.lit("https://a/f").alias("uri"), F.when(F.col("p_size") % 5 == 0, "https://cdn/f").alias("cdn_uri")),
    ).alias("files")).alias("content"))
    return rows.select("p_partkey", clean.pick_asset_logo(F.col("content")).alias("logo"))


PAIRS_SQL = """p AS (SELECT p_brand AS ca, p_name, l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber = 4 THEN 0 ELSE CAST(l_extendedprice AS DOUBLE) END AS usd,
  CASE WHEN l_suppkey % 4 = 0 THEN 'https://example.com/' || l_suppkey END AS logo FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber NOT IN (2, 3)),
b AS (SELECT ca, first(p_name ORDER BY usd DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS name, first(logo ORDER BY usd DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) FILTER (WHERE logo IS NOT NULL) AS logo_url FROM p GROUP BY 1)
"""


def pairs(s, d):
    return enrich.best_pair(token_pairs(table(s, d, "lineitem"), table(s, d, "part")))


def fan_out(s, d):
    markets = mk(s, d).withColumn("mainnet_ca", F.expr("'Brand#' || (1 + cast(substr(slab_address, 2) as int) % 5) || (1 + cast(substr(slab_address, 2) as int) % 3)"))
    return enrich.fan_out_identity(markets, pairs(s, d))


def identity(s, d):
    markets = mk(s, d).selectExpr("slab_address", "mint_address", "oracle_mode = 'hyperp' as hyperp", "mainnet_ca as base_mint")
    tokens = table(s, d, "nation").where("n_nationkey % 3 <> 0").selectExpr("'C' || n_nationkey as ca", "n_name as symbol", "case when n_nationkey % 2 = 0 then n_name || ' coin' end as name", "'https://t/' || n_nationkey as logo_url")
    base = table(s, d, "nation").where("n_nationkey % 4 <> 0").selectExpr("'CA' || n_nationkey as ca", "'B' || n_name as symbol", "n_name as name", "case when n_nationkey % 5 = 0 then 'https://b/' || n_nationkey end as logo_url")
    return enrich.resolve_identity(markets, tokens.union(base))


IDENTITY_SQL = """t AS (SELECT 'C' || n_nationkey AS ca, n_name AS symbol, CASE WHEN n_nationkey % 2 = 0 THEN n_name || ' coin' END AS name, 'https://t/' || n_nationkey AS logo_url FROM nation WHERE n_nationkey % 3 <> 0
 UNION ALL SELECT 'CA' || n_nationkey, 'B' || n_name, n_name, CASE WHEN n_nationkey % 5 = 0 THEN 'https://b/' || n_nationkey END FROM nation WHERE n_nationkey % 4 <> 0)
SELECT slab_address, CASE WHEN oracle_mode <> 'hyperp' THEN coalesce(c.symbol, left(mint_address, 8)) ELSE coalesce(b.symbol, 'UNKNOWN') END AS symbol,
 CASE WHEN oracle_mode <> 'hyperp' THEN coalesce(c.name, 'Market ' || left(slab_address, 8)) WHEN b.symbol IS NOT NULL THEN b.symbol || '/' || coalesce(c.symbol, 'USDC') || ' Perpetual' ELSE 'Market ' || left(slab_address, 8) END AS name,
 CASE WHEN oracle_mode <> 'hyperp' THEN c.logo_url WHEN b.symbol IS NOT NULL THEN coalesce(b.logo_url, c.logo_url) END AS logo_url
 FROM mk LEFT JOIN t c ON c.ca = mint_address LEFT JOIN t b ON b.ca = mainnet_ca"""


def lifecycle(s, d):
    markets = mk(s, d)
    n = "cast(substr(slab_address, 2) as int)"
    found = markets.where(f"{n} % 6 <> 5")
    accounts = markets.where(f"{n} % 8 <> 3").selectExpr("slab_address", f"{n} % 10 <> 9 as readable", "vault", f"case when {n} % 16 = 7 then 1 else 0 end as accounts")
    return registry.market_lifecycle(markets, found, accounts)


LIFE_SQL = """x AS (SELECT *, CAST(substr(slab_address, 2) AS INT) AS n FROM mk),
y AS (SELECT *, n % 6 <> 5 AS found, n % 8 <> 3 AS there, n % 10 <> 9 AS ok, vault > 1000000 OR n % 16 = 7 AS live, coalesce(indexer_excluded, false) AS ex FROM x),
z AS (SELECT *, CASE WHEN ex AND found AND there AND ok AND live THEN 'reenable' WHEN NOT ex AND found AND status <> 'closed' AND (NOT there OR (ok AND NOT live)) THEN 'close' ELSE 'keep' END AS action FROM y)
SELECT slab_address, action, CASE action WHEN 'reenable' THEN 'active' WHEN 'close' THEN 'closed' ELSE status END AS status, CASE action WHEN 'reenable' THEN false WHEN 'close' THEN true ELSE indexer_excluded END AS indexer_excluded FROM z"""


def blocklist(s, d):
    listed = scans.parse_address_list(s.createDataFrame([(" M05, ,M07,M05 ",)], "x string"), "x").withColumnRenamed("address", "slab_address")
    return registry.build_blocklist(listed, registry.retired(mk(s, d)))


BLOCK_SQL = "SELECT unnest(['M05', 'M07']) AS slab_address UNION SELECT slab_address FROM mk WHERE keeper_status = 'retired'"


def missing(s, d):
    found = fx(s, d).select("slab_address").distinct().union(mk(s, d).select("slab_address")).distinct()
    return registry.missing_markets(found, mk(s, d).where("network = 'devnet'"), blocklist(s, d))


def registration(s, d):
    found = registry.missing_markets(mk(s, d), mk(s, d).where("status = 'paused'"), blocklist(s, d))
    return registry.register_markets(mk(s, d).where("status = 'paused'"), found, "devnet").select("slab_address", "metadata_source", "network", "max_leverage", "decimals")


def last_found(s, d):
    rows = fx(s, d).selectExpr("slab_address", "event_id as ord", "trader as admin", "size as vault")
    return registry.dedupe_markets(registry.union_scanners(rows.where("ord % 2 = 0"), rows.where("ord % 2 = 1")))


def repaired(s, d):
    trades = fx(s, d)
    zero = scans.scan_zero_price_trades(trades, "mainnet")
    prices = trades.selectExpr("tx_signature", "slab_address", "event_id as pos", "price").union(trades.selectExpr("tx_signature", "slab_address", "event_id + 1000000 as pos", "event_id % 2 as price"))
    return trades, repair.repair_prices(zero, prices)


REPAIR_SQL = """z AS (SELECT * FROM fx WHERE network = 'mainnet' AND price = 0),
c AS (SELECT tx_signature, slab_address, event_id AS pos, price FROM fx UNION ALL SELECT tx_signature, slab_address, event_id + 1000000, event_id % 2 FROM fx),
b AS (SELECT tx_signature, slab_address, first(price ORDER BY pos) AS new_price FROM c WHERE price > 0 GROUP BY ALL),
r AS (SELECT tx_signature, asset_index, leg_index, new_price FROM z JOIN b USING (tx_signature, slab_address))
"""


def applied(s, d):
    return repair.apply_price_repairs(*repaired(s, d)).select("event_id", "price")


def summary(s, d):
    out = repair.apply_price_repairs(*repaired(s, d)).where("network = 'mainnet'")
    return repair.run_summary(out, trades=F.lit(True), fills=~F.col("is_liquidation"), remaining_zeros=F.col("price") == 0)


def asof(s, d):
    trades = fx(s, d)
    snaps = trades.where("side = 'long'").groupBy("slab_address", "created_at").agg(F.max("price").alias("price"))
    fills_ = trades.where("side = 'short'").select("event_id", "slab_address", "created_at")
    return repair.asof_price(fills_, snaps, "slab_address", "created_at", "price")


ASOF_SQL = """q AS (SELECT slab_address, created_at, max(price) AS price FROM fx WHERE side = 'long' GROUP BY ALL), f AS (SELECT event_id, slab_address, created_at FROM fx WHERE side = 'short')
SELECT f.*, q.price AS asof_price FROM f ASOF LEFT JOIN q ON f.slab_address = q.slab_address AND f.created_at >= q.created_at"""


def signatures(s, d):
    rows = fx(s, d).selectExpr("slab_address", "tx_signature", "event_id as slot").where("slab_address <> 'M19'")
    cursors = rows.where("slot % 97 = 0 and slab_address < 'M15'").groupBy("slab_address").agg(F.min("slot").alias("slot"))
    return rows, cursors


SIG_SQL = """r AS (SELECT slab_address, tx_signature, event_id AS slot FROM fx WHERE slab_address <> 'M19'), c AS (SELECT slab_address, min(slot) AS slot FROM r WHERE slot % 97 = 0 AND slab_address < 'M15' GROUP BY 1),
n AS (SELECT r.*, row_number() OVER (PARTITION BY r.slab_address ORDER BY r.slot, tx_signature) AS k FROM r LEFT JOIN c USING (slab_address) WHERE c.slot IS NULL OR r.slot > c.slot)
"""


def scanned(s, d):
    return scans.incremental_scan(*signatures(s, d), 50)


def advanced(s, d):
    return scans.advance_cursor(signatures(s, d)[1], scanned(s, d))


def mints(s, d):
    pairs_ = table(s, d, "customer").selectExpr("'main' || c_custkey as mainnet_ca", "'dev' || (c_custkey + 7) as devnet_mint")
    wanted = table(s, d, "orders").selectExpr("case when o_orderkey % 2 = 0 then 'main' || o_custkey else 'dev' || o_custkey end as address")
    return enrich.mint_lookup(pairs_, wanted)


def transaction_filters(s, d):
    k = F.col("event_id") % 4
    signature = F.when(k == 0, address(F.col("tx_signature"), 64)).when(k == 1, address(F.col("tx_signature"), 88)).when(k == 2, address(F.col("tx_signature"), 63)).otherwise(F.concat(F.lit("0"), address(F.col("tx_signature"), 64)))
    txs = fx(s, d).select("event_id", signature.alias("signature"), F.when(F.col("event_id") % 5 == 0, "failed").alias("transactionError"))
    return decode.filter_signature(decode.filter_successful(txs)).select("event_id")


def size_range(s, d):
    """Zero, the smallest number (out of range), its neighbour, the largest one, and small ones."""
    halves = "case event_id % 5 when 2 then 1 when 3 then -1 when 4 then event_id else 0 end as low, case event_id % 5 when 1 then -9223372036854775807 - 1 when 2 then -9223372036854775807 - 1 when 3 then 9223372036854775807 else 0 end as high"
    rows = table(s, d, "events").selectExpr("event_id", *halves.split(", ")).select("event_id", F.concat(le_bytes(F.col("low"), 8), le_bytes(F.col("high"), 8)).alias("b"))
    sized = rows.withColumn("digits", hex_le(F.col("b"), 0, 16)).withColumn("size", i128_of_hex(F.col("digits"))).where(decode.in_range(F.col("digits")))
    return sized.select("event_id", decode.side_of(F.col("size")).alias("side"), abs_text(F.col("size")).alias("size_text"))


SIZE_RANGE_SQL = """SELECT event_id, CASE WHEN event_id % 5 = 2 THEN 'short' ELSE 'long' END AS side,
 CASE WHEN event_id % 5 = 4 THEN CAST(event_id AS VARCHAR) ELSE '170141183460469231731687303715884105727' END AS size_text FROM events WHERE event_id % 5 >= 2"""


def pubkeys(s, d):
    text = """case c_custkey % 4 when 0 then '"K' || c_custkey || '"' when 1 then '{"signer":true,"pubkey":"K' || c_custkey || '"}' when 2 then '{"other":1}' else 'null' end"""
    return table(s, d, "customer").selectExpr("c_custkey", f"parse_json({text}) as v").select("c_custkey", deliveries.normalize_pubkey(F.col("v")).alias("pubkey"))


def envelopes(s, d):
    """Keys as text, as objects, a program named by an instruction only, another program, a failure, another method."""
    body = """select '{"method":"' || case when event_id % 6 = 5 then 'other' else 'transactionNotification' end || '","params":{"result":{' || case when event_id % 2 = 0 then '"signature":"top' || event_id || '",' else '' end
     || '"transaction":{"signatures":["first' || event_id || '"],"message":{"accountKeys":[' || case event_id % 6 when 0 then '"x","prog"' when 1 then '{"pubkey":"prog"}' else '"x"' end
     || '],"instructions":[{"programId":"' || case when event_id % 6 in (2, 4, 5) then 'prog' else 'x' end || '"}]}},"meta":{"err":' || case when event_id % 6 = 4 then '{"InstructionError":[0]}' else 'null' end || '}}}}' as value from {events}"""
    raw = s.sql(body.replace("{", "{{").replace("}", "}}").replace("{{events}}", "{events}"), events=table(s, d, "events"))
    return deliveries.stream_envelopes(raw, programs=["prog"]).select("signature", F.size("instructions").cast("long").alias("n"))


def token_responses(s, d):
    body = """'[{"chainId":"c' || p_size % 3 || '","baseToken":{"address":"' || p_brand || '","symbol":"S"},"liquidity":{"usd":' || p_size || '}},{"info":{"imageUrl":"https://a/' || p_partkey || '"}}]'"""
    pairs_ = scans.read_token_pairs(table(s, d, "part").selectExpr("p_partkey as ca", f"{body} as body"))
    asset = """'{"content":{"metadata":{"symbol":"S' || p_size || '","name":"N"}},"token_info":{"decimals":' || p_size % 19 || '}}'"""
    assets = scans.read_assets(table(s, d, "part").selectExpr("p_partkey as ca", f"{asset} as body"))
    flat = pairs_.selectExpr("ca", "pos", "pair.chainId as chain", "pair.baseToken.address as address", "pair.liquidity.usd as usd", "pair.info.imageUrl as image")
    return flat.join(assets.selectExpr("ca", "asset.content.metadata.symbol as symbol", "asset.token_info.decimals as decimals"), "ca")


TOKEN_SQL = """SELECT p_partkey AS ca, CAST(pos AS INT) AS pos, CASE WHEN pos = 0 THEN 'c' || p_size % 3 END AS chain, CASE WHEN pos = 0 THEN p_brand END AS address, CASE WHEN pos = 0 THEN CAST(p_size AS DOUBLE) END AS usd,
 CASE WHEN pos = 1 THEN 'https://a/' || p_partkey END AS image, 'S' || p_size AS symbol, CAST(p_size % 19 AS INT) AS decimals FROM part, (SELECT unnest([0, 1]) AS pos)"""


def named(trades):
    """trades with keys as the raw transactions have them."""
    return trades.withColumns({"tx_signature": address(F.col("tx_signature"), 64), "slab_address": address(F.col("slab_address"))})


def marked_fills(s, d):
    fills_ = named(fx(s, d)).where("not is_liquidation").select("event_id", F.col("tx_signature").alias("signature"), "slab_address")
    prices = decode.transaction_prices(raw_transactions(fx(s, d), F.lit(False)), no_layouts(s))
    out = decode.attach_mark_price(fills_.where("event_id % 2 = 0"), prices).unionByName(decode.attach_mark_price(fills_.where("event_id % 2 = 1"), prices, required=True))
    return out.select("event_id", F.col("price").cast("double").alias("price"))


PRICES_SQL = "p AS (SELECT tx_signature, slab_address, first(price ORDER BY event_id) AS p FROM fx WHERE price > 0 GROUP BY ALL)\n"


def repaired_from_transactions(s, d):
    trades = named(fx(s, d))
    out = jobs.repair_from_transactions_job(trades, raw_transactions(fx(s, d), F.lit(False)), no_layouts(s), "mainnet")
    return out.select("event_id", F.col("price").cast("double").alias("price"))


def outcomes(s, d):
    trades = fx(s, d)
    marked = jobs.ingest_outcomes(trades, trades.where("event_id % 9 = 0"), mk(s, d).where("network = 'devnet'"), blocklist(s, d))
    return repair.run_summary(marked, **{x: F.col("outcome") == x for x in ("blocked", "failed", "skipped", "indexed")})


OUTCOMES_SQL = f"""k AS ({BLOCK_SQL}), o AS (SELECT CASE WHEN slab_address IN (SELECT slab_address FROM k) THEN 'blocked' WHEN slab_address NOT IN (SELECT slab_address FROM mk WHERE network = 'devnet') THEN 'failed'
 WHEN event_id % 9 = 0 THEN 'skipped' ELSE 'indexed' END AS o FROM fx)
SELECT {", ".join(f"count(*) FILTER (WHERE o = '{x}') AS {x}" for x in ("blocked", "failed", "skipped", "indexed"))} FROM o"""

SANE_SQL = "CASE WHEN v > 0 AND v < 1000000000000 THEN v END"
CTRL = "'[' || chr(1) || '-' || chr(31) || chr(127) || '<>]'"
QUERIES = {
    "delivery_validation": (validation, VALIDATION_SQL),
    "decode_single_fills": (lambda s, d: fills(s, d, "event_id % 2 = 0"), oracle(FILLS_SQL + "0")),
    "decode_batch_legs": (lambda s, d: fills(s, d, "event_id % 2 = 1"), oracle(FILLS_SQL + "1")),
    "decode_liquidations": (liquidations, oracle(f"SELECT event_id, {address_sql('slab_address')} AS slab_address, {address_sql('trader')} AS trader, asset_index FROM fx WHERE is_liquidation")),
    "trade_extraction": (extraction, oracle(EXTRACTION_SQL)),
    "leg_numbering": (leg_numbers, oracle("SELECT event_id, CAST(row_number() OVER (PARTITION BY tx_signature ORDER BY event_id) - 1 AS INT) AS leg_index FROM fx WHERE NOT is_liquidation")),
    "inner_echo": (echoes, oracle(ECHO_SQL)),
    "mark_price_from_account": (mark_prices, oracle(MARK_SQL)),
    "wide_integers": (wide_integers, "SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS BIGINT) AS u64, true AS negative, CAST(l_partkey + 1 AS VARCHAR) AS abs_text, CAST(l_suppkey AS BIGINT) AS u128 FROM lineitem"),
    "sane_price": (lambda s, d: table(s, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "cast((l_partkey - 100) * 7000000007 as bigint) as v").select("l_orderkey", "l_linenumber", clean.sane_price_e6(F.col("v")).alias("e6"), clean.price_from_e6(clean.sane_price_e6(F.col("v"))).cast("double").alias("price")), f"SELECT l_orderkey, l_linenumber, {SANE_SQL} AS e6, {SANE_SQL} / 1000000.0::DOUBLE AS price FROM (SELECT l_orderkey, l_linenumber, CAST((l_partkey - 100) * 7000000007 AS BIGINT) AS v FROM lineitem)"),
    "decode_markets": (accounts, ACCOUNTS_SQL),
    "scan_known_accounts": (known_accounts, "SELECT s_name AS pubkey, s_suppkey AS slot FROM supplier WHERE s_nationkey < 10"),
    "max_leverage": (lambda s, d: mk(s, d).select("slab_address", clean.max_leverage(F.col("initial_margin_bps")).alias("max_leverage")), oracle("SELECT slab_address, CAST(CASE WHEN initial_margin_bps > 0 THEN 10000 // initial_margin_bps ELSE 10 END AS INT) AS max_leverage FROM mk")),
    "clean_decimals": (lambda s, d: mk(s, d).select("slab_address", clean.clean_decimals(F.col("decimals")).alias("decimals")), oracle("SELECT slab_address, CAST(CASE WHEN decimals BETWEEN 0 AND 18 THEN decimals ELSE 6 END AS INT) AS decimals FROM mk")),
    "resolve_network": (lambda s, d: table(s, d, "customer").select("c_custkey", clean.resolve_network(F.expr("case c_custkey % 4 when 0 then ' MainNet ' when 1 then 'TESTNET' when 2 then 'x' end")).alias("network")), "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'mainnet' WHEN 1 THEN 'testnet' ELSE 'devnet' END AS network FROM customer"),
    "sanitize_text": (lambda s, d: table(s, d, "documents").select("doc_id", clean.sanitize_text(F.col("text"), 128).alias("name")), f"SELECT doc_id, nullif(substr(regexp_replace(regexp_replace(text, {CTRL}, '', 'g'), '^\\s+|\\s+$', '', 'g'), 1, 128), '') AS name FROM documents"),
    "sanitize_url": (lambda s, d: table(s, d, "pages").select("page_id", clean.sanitize_url(F.expr("case when page_id % 3 = 0 then replace(url, 'http', 'ftp') when page_id % 7 = 0 then upper(url) else url end")).alias("url")), "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 7 = 0 THEN upper(url) ELSE url END AS url FROM pages"),
    "pick_asset_logo": (asset_logo, "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'https://a/i.png' WHEN p_size % 5 = 0 THEN 'https://cdn/f' ELSE 'https://a/f' END AS logo FROM part"),
    "best_pair": (pairs, "WITH " + PAIRS_SQL + "SELECT ca, ca AS symbol, name, logo_url FROM b"),
    "fan_out_identity": (fan_out, oracle(PAIRS_SQL + ", m AS (SELECT *, 'Brand#' || (1 + CAST(substr(slab_address, 2) AS INT) % 5) || (1 + CAST(substr(slab_address, 2) AS INT) % 3) AS ca FROM mk) SELECT slab_address, ca AS symbol, b.name, b.logo_url FROM m JOIN b USING (ca)")),
    "resolve_identity": (identity, oracle(IDENTITY_SQL)),
    "metadata_candidates": (lambda s, d: scans.scan_metadata_candidates(mk(s, d), "devnet"), oracle("SELECT slab_address, mainnet_ca, symbol, name FROM mk WHERE network = 'devnet' AND metadata_source = 'auto' AND logo_url IS NULL AND mainnet_ca IS NOT NULL ORDER BY slab_address LIMIT 60")),
    "batch_assign": (lambda s, d: enrich.batch_assign(mk(s, d).select("slab_address"), 30, ["slab_address"], shared_path(s, "batches")), oracle("SELECT slab_address, CAST((row_number() OVER (ORDER BY slab_address) - 1) // 30 AS BIGINT) AS batch FROM mk")),
    "distinct_cas": (lambda s, d: enrich.distinct_cas(mk(s, d), valid="^CA[0-9]$"), oracle("SELECT DISTINCT mainnet_ca AS ca FROM mk WHERE length(mainnet_ca) = 3")),
    "blocklist": (blocklist, oracle(BLOCK_SQL)),
    "missing_markets": (missing, oracle(f"k AS ({BLOCK_SQL}), u AS (SELECT slab_address FROM fx UNION SELECT slab_address FROM mk) SELECT slab_address FROM u WHERE slab_address NOT IN (SELECT slab_address FROM mk WHERE network = 'devnet') AND slab_address NOT IN (SELECT slab_address FROM k)")),
    "register_markets": (registration, oracle(f"k AS ({BLOCK_SQL}) SELECT slab_address, 'auto' AS metadata_source, 'devnet' AS network, CAST(CASE WHEN initial_margin_bps > 0 THEN 10000 // initial_margin_bps ELSE 10 END AS INT) AS max_leverage, CAST(CASE WHEN decimals BETWEEN 0 AND 18 THEN decimals ELSE 6 END AS INT) AS decimals FROM mk WHERE status <> 'paused' AND slab_address NOT IN (SELECT slab_address FROM k)")),
    "known_slab_filter": (lambda s, d: registry.known_slab_filter(fx(s, d), mk(s, d).where("network = 'devnet'")).select("event_id"), oracle("SELECT event_id FROM fx WHERE slab_address IN (SELECT slab_address FROM mk WHERE network = 'devnet')")),
    "blocked_filter": (lambda s, d: registry.blocked_filter(fx(s, d), blocklist(s, d)).select("event_id"), oracle(f"k AS ({BLOCK_SQL}) SELECT event_id FROM fx WHERE slab_address NOT IN (SELECT slab_address FROM k)")),
    "drop_known_signatures": (lambda s, d: registry.drop_known_signatures(fx(s, d), fx(s, d).where("event_id % 9 = 0")).select("event_id"), oracle("SELECT event_id FROM fx WHERE tx_signature NOT IN (SELECT tx_signature FROM fx WHERE event_id % 9 = 0)")),
    "dedupe_markets": (last_found, oracle("SELECT slab_address, max(event_id) AS ord, last(trader ORDER BY event_id) AS admin, arg_max_null(size, event_id) AS vault FROM fx GROUP BY 1")),
    "market_lifecycle": (lifecycle, oracle(LIFE_SQL)),
    "zero_price_scan": (lambda s, d: scans.scan_zero_price_trades(fx(s, d), "mainnet"), oracle("SELECT tx_signature, slab_address, asset_index, leg_index, created_at FROM fx WHERE network = 'mainnet' AND price = 0")),
    "group_by_signature": (lambda s, d: repair.group_by_signature(scans.scan_zero_price_trades(fx(s, d), "mainnet")).select("tx_signature", F.size("trades").cast("long").alias("n"), F.col("trades")[0]["slab_address"].alias("first_slab")), oracle("SELECT tx_signature, count(*) AS n, first(slab_address ORDER BY slab_address, asset_index, leg_index) AS first_slab FROM fx WHERE network = 'mainnet' AND price = 0 GROUP BY 1")),
    "repair_prices": (lambda s, d: repaired(s, d)[1], oracle(REPAIR_SQL + "SELECT * FROM r")),
    "apply_price_repairs": (applied, oracle(REPAIR_SQL + "SELECT event_id, CASE WHEN price = 0 AND new_price > 0 THEN new_price ELSE price END AS price FROM fx LEFT JOIN r USING (tx_signature, asset_index, leg_index)")),
    "repair_summary": (summary, oracle(REPAIR_SQL + "SELECT count(*) AS trades, count(*) FILTER (WHERE NOT is_liquidation) AS fills, count(*) FILTER (WHERE CASE WHEN price = 0 AND new_price > 0 THEN new_price ELSE price END = 0) AS remaining_zeros FROM fx LEFT JOIN r USING (tx_signature, asset_index, leg_index) WHERE network = 'mainnet'")),
    "asof_price": (asof, oracle(ASOF_SQL)),
    "incremental_scan": (scanned, oracle(SIG_SQL + "SELECT slab_address, tx_signature, slot FROM n WHERE k <= 50")),
    "advance_cursor": (advanced, oracle(SIG_SQL + "SELECT slab_address, max(slot) AS slot FROM (SELECT slab_address, slot FROM c UNION ALL SELECT slab_address, slot FROM n WHERE k <= 50) GROUP BY 1")),
    "mint_lookup": (mints, "WITH w AS (SELECT DISTINCT CASE WHEN o_orderkey % 2 = 0 THEN 'main' || o_custkey ELSE 'dev' || o_custkey END AS address FROM orders), b AS (SELECT 'main' || c_custkey AS address, 'dev' || (c_custkey + 7) AS other FROM customer UNION ALL SELECT 'dev' || (c_custkey + 7), 'main' || c_custkey FROM customer) SELECT * FROM w JOIN b USING (address)"),
    "transaction_filters": (transaction_filters, "SELECT event_id FROM events WHERE event_id % 4 < 2 AND event_id % 5 <> 0"),
    "size_range": (size_range, SIZE_RANGE_SQL),
    "normalize_pubkey": (pubkeys, "SELECT c_custkey, CASE WHEN c_custkey % 4 < 2 THEN 'K' || c_custkey END AS pubkey FROM customer"),
    "stream_envelopes": (envelopes, "SELECT CASE WHEN event_id % 2 = 0 THEN 'top' ELSE 'first' END || event_id AS signature, CAST(1 AS BIGINT) AS n FROM events WHERE event_id % 6 < 3"),
    "token_responses": (token_responses, TOKEN_SQL),
    "attach_mark_price": (marked_fills, oracle(PRICES_SQL + "SELECT event_id, CAST(coalesce(p, 0) AS DOUBLE) AS price FROM fx LEFT JOIN p USING (tx_signature, slab_address) WHERE NOT is_liquidation AND (event_id % 2 = 0 OR p IS NOT NULL)")),
    "repair_from_transactions": (repaired_from_transactions, oracle(PRICES_SQL + "SELECT event_id, CAST(CASE WHEN network = 'mainnet' AND price = 0 THEN coalesce(p, price) ELSE price END AS DOUBLE) AS price FROM fx LEFT JOIN p USING (tx_signature, slab_address)")),
    "ingest_outcomes": (outcomes, oracle(OUTCOMES_SQL)),
}
