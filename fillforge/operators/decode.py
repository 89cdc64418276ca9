"""From raw transactions to fills and liquidation markers: one job of column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillforge.functions.binary import ADDRESS, SIGNATURE, abs_decimal, abs_text, byte_at, from_base58, hex_le, i128_of_hex, uint_le
from fillforge.functions.clean import price_from_e6, sane_price_e6
from fillforge.sources.scans import MAGIC, OFFSETS

#: Fixed values of the instruction layout.
SINGLE, BATCH, CRANK, LIQUIDATE = (6, 10), (66, 67), 5, 1
MARKET_IS_THIRD = (6, 66)
LEG_BYTES, LEG_START, SINGLE_BYTES, CRANK_BYTES = 34, 2, 19, 4
MARKER_BASE = 1000
ORDER = ["is_inner", "group_no", "ix", "leg"]


def filter_successful(txs: DataFrame) -> DataFrame:
    return txs.where("transactionError is null")


def filter_signature(txs: DataFrame) -> DataFrame:
    return txs.where(F.col("signature").rlike(SIGNATURE))


def explode_instructions(txs: DataFrame, programs: list[str]) -> DataFrame:
    """signature, is_inner, group_no, ix, data, accounts of the programs' instructions: outer ones, then inner groups.
    Both come from one pass over the transactions."""
    group = lambda inner, number, rows: F.struct(F.lit(inner).alias("is_inner"), number.cast("int").alias("group_no"), rows.alias("rows"))
    outer = F.array(group(False, F.lit(0), F.col("instructions")))
    inner = F.transform("innerInstructions", lambda g, k: group(True, k, g["instructions"]))
    groups = txs.select("signature", F.explode(F.when(F.col("innerInstructions").isNull(), outer).otherwise(F.concat(outer, inner))).alias("g"))
    rows = groups.select("signature", "g.is_inner", "g.group_no", F.posexplode("g.rows").alias("ix", "i"))
    return rows.where(F.col("i.programId").isin(programs)).select("signature", "is_inner", "group_no", "ix", "i.data", "i.accounts")


def with_bytes(instructions: DataFrame) -> DataFrame:
    """Adds bytes and tag; instructions without any byte go."""
    decoded = instructions.withColumn("bytes", from_base58("data")).where("octet_length(bytes) > 0")
    return decoded.withColumn("tag", byte_at(F.col("bytes"), 0))


def side_of(size: Column) -> Column:
    return F.when(size["negative"], "short").otherwise("long")


def in_range(digits: Column) -> Column:
    """Not zero, and at most 2^127 - 1 either way, told from the 32 hex digits: a filter is moved below the columns that it
    names and computes them again, so it had better name one of them once."""
    return ~digits.isin("0" * 32, "8" + "0" * 31)


def decode_legs(decoded: DataFrame) -> DataFrame:
    """Legs of single and batch instructions, and markers (is_liquidation) of outer crank instructions whose action is
    liquidate; those carry no side and no amounts. A truncated last leg is left out, complete ones before it stay."""
    b, marker = F.col("bytes"), F.col("is_liquidation")
    legs = F.least(byte_at(b, 1), F.floor((F.octet_length(b) - LEG_START) / LEG_BYTES).cast("int"))
    cranked = (F.octet_length(b) >= CRANK_BYTES) & (byte_at(b, 1) == LIQUIDATE) & ~F.col("is_inner")
    single, batch, crank = F.col("tag").isin(*SINGLE), F.col("tag").isin(*BATCH), F.col("tag") == CRANK
    count = F.when(single & (F.octet_length(b) >= SINGLE_BYTES), 1).when(batch, legs).when(crank & cranked, 1).otherwise(0)
    each = decoded.withColumn("_n", count).where("_n > 0").withColumn("leg", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    start = F.when(single, 1).when(crank, 2).otherwise(LEG_START + F.col("leg") * LEG_BYTES)
    each = each.withColumns({"is_liquidation": crank, "_at": start}).withColumn("_hex", hex_le(b, F.col("_at") + 2, 16)).withColumn("_size", i128_of_hex(F.col("_hex"))).where(in_range(F.col("_hex")) | marker)
    trader = F.get("accounts", F.when(marker, 2).otherwise(0))
    slab = F.get("accounts", F.when(F.col("tag").isin(*MARKET_IS_THIRD), 2).otherwise(1))
    out = each.select("signature", *ORDER, trader.alias("trader"), slab.alias("slab_address"), uint_le(b, F.col("_at"), 2).cast("int").alias("asset_index"), side_of(F.col("_size")).alias("side"), abs_text(F.col("_size")).alias("size_text"), abs_decimal(F.col("_size")).alias("size"), "is_liquidation")
    out = out.withColumns({c: F.when(~marker, F.col(c)) for c in ("side", "size_text", "size")})
    return out.where(F.col("trader").rlike(ADDRESS) & F.col("slab_address").rlike(ADDRESS))


def decode_fills(decoded: DataFrame) -> DataFrame:
    return decode_legs(decoded).where("not is_liquidation").drop("is_liquidation")


def decode_liquidations(decoded: DataFrame) -> DataFrame:
    return decode_legs(decoded).where("is_liquidation").drop("is_liquidation", "side", "size_text", "size")


def drop_inner_echo(fills: DataFrame) -> DataFrame:
    """Without inner legs that equal an earlier fill of their transaction on trader, market, side and size."""
    same = W.partitionBy("signature", "trader", "slab_address", "side", "size_text").orderBy(*ORDER)
    return fills.withColumn("_n", F.row_number().over(same)).where("not is_inner or _n = 1").drop("_n")


def numbered(rows: DataFrame) -> DataFrame:
    """leg_index in the order of the transaction, whatever the registry knows: fills from 0, markers from MARKER_BASE."""
    base = F.when(F.col("is_liquidation"), MARKER_BASE).otherwise(0)
    return rows.withColumn("leg_index", (F.row_number().over(W.partitionBy("signature", "is_liquidation").orderBy(*ORDER)) - 1 + base).cast("int"))


def account_bytes(data: Column) -> Column:
    """Account data as base64 text or as an array of it and its encoding."""
    return F.try_to_binary(F.when(data.startswith("["), F.get_json_object(data, "$[0]")).otherwise(data), F.lit("base64"))


def mark_prices(accounts: DataFrame, layouts: DataFrame) -> DataFrame:
    """accounts (with `bytes`) with mark_price: of a versioned account at its fixed place, else where the layout for the
    account's length (data_len, engine_price_off, config_price_off) has it; the first sane value counts, else NULL."""
    b = F.col("bytes")
    versioned = F.hex(F.substring(b, 1, 8)) == MAGIC
    known = accounts.join(layouts, F.octet_length(b) == F.col("data_len"), "left")
    places = {"_versioned": OFFSETS["mark_price"], "_engine": F.col("engine_price_off"), "_config": F.col("config_price_off")}
    read = known.withColumns({name: uint_le(b, off, 8) for name, off in places.items()})  # each is named often below
    by_layout = F.coalesce(sane_price_e6(F.col("_engine")), sane_price_e6(F.col("_config")))
    price = F.when(versioned, sane_price_e6(F.col("_versioned"))).otherwise(by_layout)
    return read.withColumn("mark_price", price_from_e6(price)).drop(*layouts.columns, *places)


def transaction_prices(txs: DataFrame, layouts: DataFrame) -> DataFrame:
    """signature, slab_address, price: the first sane mark price among a transaction's accounts. Logs and balances
    never set one."""
    each = txs.select("signature", F.posexplode("accountData").alias("pos", "a")).select("signature", "pos", F.col("a.account").alias("slab_address"), account_bytes(F.col("a.data")).alias("bytes"))
    priced = mark_prices(each.where("bytes is not null"), layouts).where("mark_price is not null")
    return priced.groupBy("signature", "slab_address").agg(F.min_by("mark_price", "pos").alias("price"))


def attach_mark_price(fills: DataFrame, prices: DataFrame, required: bool = False) -> DataFrame:
    """Fills with the price of their transaction and market; 0 where there is none, or dropped if it is required."""
    both = fills.join(prices, ["signature", "slab_address"], "inner" if required else "left")
    return both.withColumn("price", F.coalesce("price", F.lit(0)).cast("decimal(38,6)"))


def flagged_trades(txs: DataFrame, programs: list[str], registry: DataFrame, blocklist: DataFrame, layouts: DataFrame) -> DataFrame:
    """Fills and markers of raw transactions, numbered and priced, with known (in the registry) and blocked.

    A transaction that comes twice counts once. Fills are numbered from 0 and markers from MARKER_BASE over the whole
    transaction before the registry is asked, so every path gives a leg the same key.
    """
    flag = lambda df, name: df.select("slab_address").distinct().withColumn(name, F.lit(True))
    good = filter_signature(filter_successful(txs)).dropDuplicates(["signature"])
    decoded = with_bytes(explode_instructions(good, programs))
    rows = numbered(drop_inner_echo(decode_legs(decoded)))
    rows = rows.join(flag(registry, "known"), "slab_address", "left").join(flag(blocklist, "blocked"), "slab_address", "left")
    fill = ~F.col("is_liquidation")
    priced = attach_mark_price(rows, transaction_prices(good, layouts))
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("known", "blocked")]
    return priced.select("slab_address", "trader", "side", "size", "size_text", F.when(fill, F.col("price")).alias("price"), F.when(fill, F.lit(0).cast("decimal(38,6)")).alias("fee"), F.col("signature").alias("tx_signature"), "asset_index", "leg_index", "is_liquidation", *flags)


def extract_trades(txs: DataFrame, programs: list[str], registry: DataFrame, blocklist: DataFrame, layouts: DataFrame) -> DataFrame:
    """The flagged_trades of known markets that are not blocked."""
    return flagged_trades(txs, programs, registry, blocklist, layouts).where("known and not blocked").drop("known", "blocked")
