"""Raw deliveries, accounts and token responses built from the table views, for round trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillforge.functions.binary import le_bytes, to_base58
from fillforge.sources.scans import MAGIC

PROGRAM = "FiLLForgeProgram111111111111111111111111111"


def address(text: Column, size: int = 32) -> Column:
    """A base58-looking address for a short name; the alphabet has no 0."""
    return F.rpad(F.translate(text, "0", "z"), size, "A")


def address_sql(text: str, size: int = 32) -> str:
    return f"rpad(replace({text}, '0', 'z'), {size}, 'A')"


def signed_size() -> Column:
    return F.when(F.col("side") == "short", -F.col("size")).otherwise(F.col("size"))


def instruction(trades: DataFrame) -> DataFrame:
    """trades with `i`: singles for even ids, batches of one complete and one cut-off leg for odd ones, cranks for markers."""
    leg = F.concat(le_bytes(F.col("asset_index"), 2), le_bytes(signed_size(), 16))
    single = F.concat(F.unhex(F.lit("06")), leg)
    batch = F.concat(F.unhex(F.lit("4302")), leg, le_bytes(F.col("event_id"), 16), F.unhex(F.lit("0102")))
    crank = F.concat(F.unhex(F.lit("0501")), le_bytes(F.col("asset_index"), 2))
    data = F.when(F.col("is_liquidation"), crank).when(F.col("event_id") % 2 == 0, single).otherwise(batch)
    slab, trader, filler = address(F.col("slab_address")), address(F.col("trader")), address(F.lit("X"))
    accounts = F.when(F.col("is_liquidation"), F.array(filler, slab, trader)).when(F.col("event_id") % 2 == 0, F.array(trader, filler, slab)).otherwise(F.array(trader, slab))
    return trades.withColumn("i", F.struct(F.lit(PROGRAM).alias("programId"), to_base58(data).alias("data"), accounts.alias("accounts")))


def account_data(trades: DataFrame) -> Column:
    """Account text in base64: a versioned account of 256 bytes that holds the price in millionths."""
    raw = F.concat(F.unhex(F.lit(MAGIC)), F.unhex(F.lit("00" * 240)), le_bytes(F.col("price") * 1_000_000, 8))
    return F.struct(address(F.col("slab_address")).alias("account"), F.base64(raw).alias("data"))


def raw_transactions(trades: DataFrame, inner: Column) -> DataFrame:
    """One transaction per tx_signature with its trades in order of event_id; those where `inner` holds come as inner
    instructions."""
    rows = instruction(trades).withColumns({"a": account_data(trades), "inner": inner})
    listed = rows.groupBy("tx_signature").agg(F.sort_array(F.collect_list(F.struct("event_id", "inner", "i", "a"))).alias("x"))
    pick = lambda keep: F.transform(F.filter("x", keep), lambda e: e["i"])
    return listed.select(
        address(F.col("tx_signature"), 64).alias("signature"),
        F.lit(None).cast("string").alias("transactionError"),
        pick(lambda e: ~e["inner"]).alias("instructions"),
        F.array(F.struct(pick(lambda e: e["inner"]).alias("instructions"))).alias("innerInstructions"),
        F.transform("x", lambda e: e["a"]).alias("accountData"),
    )


def market_accounts(supplier: DataFrame) -> DataFrame:
    """Account snapshots with vault, insurance, c_tot and mark price from supplier; every fifth is another kind, every
    seventh is cut short."""
    cents = F.round(F.col("s_acctbal") * 100).cast("long")
    raw = F.concat(
        F.unhex(F.lit(MAGIC)), le_bytes(F.lit(17), 2), F.when(F.col("s_suppkey") % 5 == 0, F.unhex(F.lit("02"))).otherwise(F.unhex(F.lit("01"))),
        F.unhex(F.lit("00" * 5)), F.unhex(F.lit("07" * 32)), F.unhex(F.lit("00" * 200)), le_bytes(F.col("s_suppkey") * 1_000_000, 8),
        F.unhex(F.lit("00" * 477)), le_bytes(F.abs(cents), 16), le_bytes(F.col("s_suppkey"), 16), le_bytes(F.col("s_nationkey"), 16),
    )
    data = F.when(F.col("s_suppkey") % 7 == 0, F.substring(raw, 1, 300)).otherwise(raw)
    return supplier.select(F.col("s_name").alias("pubkey"), F.lit(PROGRAM).alias("owner"), F.col("s_suppkey").alias("slot"), data.alias("data"))


def token_pairs(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Rows ca, pos, pair: brands as tokens, line items as their pairs, liquidity from prices."""
    both = lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"])
    pos = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    pair = F.struct(
        F.when(F.col("l_linenumber") == 2, "base").when(F.col("l_linenumber") == 1, "solana").alias("chainId"),
        F.struct(F.when(F.col("l_linenumber") == 3, "other").otherwise(F.col("p_brand")).alias("address"), F.col("p_name").alias("name"), F.concat(F.lit("<"), F.col("p_brand"), F.lit(">")).alias("symbol")).alias("baseToken"),
        F.struct(F.when(F.col("l_suppkey") % 4 == 0, F.concat(F.lit("https://example.com/"), F.col("l_suppkey").cast("string"))).otherwise("javascript:x").alias("imageUrl")).alias("info"),
        F.struct(F.when(F.col("l_linenumber") != 4, F.col("l_extendedprice").cast("double")).alias("usd")).alias("liquidity"),
    )
    return both.select(F.col("p_brand").alias("ca"), pos.alias("pos"), pair.alias("pair"))
