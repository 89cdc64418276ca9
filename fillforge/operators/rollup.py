"""Rolling volume, candles, last prices, leaderboards and histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillforge.functions import wide
from fillforge.functions.clean import clean_decimals
from fillforge.operators.mutate import upsert_partial

FILLS = "not is_liquidation and size is not null"


def trade_order(time: str = "created_at") -> Column:
    """Ties in time are broken by the whole key."""
    return F.struct(time, "tx_signature", "asset_index", "leg_index")


def total(value: Column, df: DataFrame, column: str) -> Column:
    """A sum in the column's own kind (BIGINT or DECIMAL(38,0)): sums that overflow are NULL, never an error."""
    kind = df.schema[column].dataType.simpleString()
    return F.try_sum(value).cast("decimal(38,0)" if kind.startswith("decimal") else "long")


def volume_24h_by_slab(trades: DataFrame, network: str, as_of: Column) -> DataFrame:
    """volume_24h and trade_count_24h per market with fills in the last 24 hours; liquidation markers do not count."""
    recent = trades.where((F.col("network") == network) & F.expr(FILLS) & (F.col("created_at") >= as_of - F.expr("INTERVAL 24 HOURS")))
    return recent.groupBy("slab_address").agg(total(F.abs("size"), trades, "size").alias("volume_24h"), F.count("*").alias("trade_count_24h"))


def exact_volume(trades: DataFrame) -> DataFrame:
    """Sum of size_text per market as exact text, beyond DECIMAL(38,0): sums of 18-digit limbs, carried at the end."""
    digits = F.lpad(F.regexp_replace("size_text", "^-", ""), 54, "0")
    limbs = [F.sum(F.substring(digits, at, 18).cast("decimal(18,0)")).cast("decimal(38,0)").alias(c) for at, c in ((1, "h"), (19, "m"), (37, "l"))]
    sums = trades.where(FILLS).groupBy("slab_address").agg(*limbs)
    base = F.lit("1000000000000000000").cast("decimal(38,0)")
    rest = lambda c: (c % base).cast("decimal(38,0)")
    over = lambda c: F.floor(c / base).cast("decimal(38,0)")
    carried = sums.withColumn("m", F.col("m") + over(F.col("l"))).withColumn("l", rest(F.col("l")))
    carried = carried.withColumn("h", F.col("h") + over(F.col("m"))).withColumn("m", rest(F.col("m")))
    text = F.concat(F.col("h").cast("string"), *[F.lpad(F.col(c).cast("string"), 18, "0") for c in "ml"])
    return carried.select("slab_address", F.coalesce(F.nullif(F.ltrim(text, F.lit("0")), F.lit("")), F.lit("0")).alias("volume"))


def market_stats_rollup(stats: DataFrame, trades: DataFrame, network: str, as_of: Column, reset_missing: bool = False) -> DataFrame:
    """stats with the 24h volume put in. Markets without fills keep their last numbers, or get 0 with reset_missing."""
    columns = ["volume_24h", "trade_count_24h"]
    return upsert_partial(stats, volume_24h_by_slab(trades, network, as_of), "slab_address", columns, dict.fromkeys(columns, 0) if reset_missing else None)


def markets_with_stats(markets: DataFrame, stats: DataFrame) -> DataFrame:
    """Open markets that are not excluded, with their stats where they have any."""
    columns = [F.col(f"s.{c}") for c in stats.columns if c not in markets.columns]
    both = markets.alias("m").join(stats.alias("s"), F.col("m.slab_address") == F.col("s.slab_address"), "left")
    return both.where("not coalesce(m.indexer_excluded, false) and m.status <> 'closed'").select("m.*", *columns)


def bars(trades: DataFrame, bucket: Column, unpriced: bool = False) -> DataFrame:
    fills = trades.where(FILLS).withColumn("bucket", bucket)
    price = F.col("price") if unpriced else F.when(F.col("price") > 0, F.col("price"))
    at = F.when(price.isNotNull(), trade_order())
    aggs = [F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close")]
    return fills.groupBy("slab_address", "bucket").agg(*aggs, total(F.col("size"), trades, "size").alias("volume"), F.count("*").alias("trades"))


def candles(trades: DataFrame, interval: str, unpriced: bool = False) -> DataFrame:
    """Open, high, low, close, volume and count per market and bucket of `interval` (such as '5 minutes').

    Markers are left out. Prices of 0 are unknown and only count with unpriced=True; volume counts all fills.
    """
    return bars(trades, F.window("created_at", interval)["start"], unpriced)


def candles_truncated(trades: DataFrame, unit: str) -> DataFrame:
    """candles for the units that date_trunc knows (minute, hour, day)."""
    return bars(trades, F.date_trunc(unit, "created_at"))


def rollup_candles(fine: DataFrame, interval: str) -> DataFrame:
    """Coarser bars from finer ones."""
    w = F.window("bucket", interval)["start"]
    at = lambda c: F.when(F.col(c).isNotNull(), F.col("bucket"))
    aggs = [F.min_by("open", at("open")).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", at("close")).alias("close")]
    out = fine.withColumn("_b", w).groupBy("slab_address", F.col("_b").alias("bucket"))
    return out.agg(*aggs, total(F.col("volume"), fine, "volume").alias("volume"), F.sum("trades").cast("long").alias("trades"))


def refresh_candles(stored: DataFrame, trades: DataFrame, interval: str, start: Column, end: Column) -> DataFrame:
    """Stored bars with those of [start, end) made anew; start and end are bucket bounds."""
    inside = lambda c: (F.col(c) >= start) & (F.col(c) < end)
    return stored.where(~inside("bucket")).unionByName(candles(trades.where(inside("created_at")), interval))


def last_price(trades: DataFrame) -> DataFrame:
    fills = trades.where(f"{FILLS} and price > 0")
    return fills.groupBy("slab_address").agg(F.max_by("price", trade_order()).alias("last_price"))


def volume_24h_usd(trades: DataFrame, markets: DataFrame, network: str, as_of: Column) -> DataFrame:
    """Sum of size times price over the last 24 hours, in units of the market's decimals. Products are added in their own
    kind, BIGINT or DECIMAL; those and sums that overflow make the market's volume NULL."""
    recent = trades.where((F.col("network") == network) & F.expr(FILLS) & (F.col("created_at") >= as_of - F.expr("INTERVAL 24 HOURS")))
    usd = F.try_multiply(F.abs("size"), F.col("price"))
    whole = F.count(usd) == F.count("price")
    sums = recent.groupBy("slab_address").agg(F.when(whole, F.try_sum(usd)).alias("v"))
    both = sums.join(markets.select("slab_address", clean_decimals(F.col("decimals")).alias("d")), "slab_address")
    return both.select("slab_address", (F.col("v").cast("double") / F.pow(F.lit(10.0), F.col("d"))).alias("volume_24h_usd"))


def leaderboard(trades: DataFrame, top: int = 100) -> DataFrame:
    """The `top` traders by volume, with their rank. Only these rows meet in one window."""
    sums = trades.where(FILLS).groupBy("trader").agg(total(F.abs("size"), trades, "size").alias("volume"), F.count("*").alias("trades"), F.countDistinct("slab_address").alias("markets"))
    best = sums.orderBy(F.desc("volume"), "trader").limit(top)
    return best.withColumn("rank", F.rank().over(W.orderBy(F.desc("volume"))).cast("long"))


def trader_history(trades: DataFrame, by: str, n: int) -> DataFrame:
    """The n newest trades per trader or market; the window is cut to n rows before the shuffle."""
    order = W.partitionBy(by).orderBy(F.desc("created_at"), F.desc("tx_signature"), F.desc("asset_index"), F.desc("leg_index"))
    return trades.withColumn("n", F.row_number().over(order)).where(F.col("n") <= n).withColumn("n", F.col("n").cast("long"))


def public_trades(trades: DataFrame) -> DataFrame:
    return trades.select("trader", "size", "created_at")


#: Limbs of sizes (up to 45 digits, all 128-bit ones) and of prices in millionths.
SIZE_LIMBS = PRICE_LIMBS = 5


def wide_size(signed: bool = False) -> list[Column]:
    """size_text as limbs, as an absolute value unless signed."""
    return wide.limbs(F.col("size_text") if signed else F.ltrim("size_text", F.lit("-")), SIZE_LIMBS)


def by_number(number: str) -> list[Column]:
    """Descending order of whole numbers of zero or more in text."""
    return [F.length(number).desc(), F.desc(number)]


def wide_volume(trades: DataFrame, keys: list[str]) -> DataFrame:
    """Exact sum of size_text per keys, as text, and the count: beyond DECIMAL(38,0), with partial aggregation."""
    sums = trades.where("not is_liquidation and size_text is not null").groupBy(*keys).agg(wide.total(wide_size()).alias("v"), F.count("*").alias("trades"))
    return sums.select(*keys, wide.text(F.col("v")).alias("volume"), "trades")


def wide_candles(trades: DataFrame, interval: str) -> DataFrame:
    """candles() whose volume is the exact sum of size_text, as text."""
    bucketed = trades.where("not is_liquidation and size_text is not null").withColumn("bucket", F.window("created_at", interval)["start"])
    price = F.when(F.col("price") > 0, F.col("price"))
    at = F.when(price.isNotNull(), trade_order())
    aggs = [F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close")]
    out = bucketed.groupBy("slab_address", "bucket").agg(*aggs, wide.total(wide_size(signed=True)).alias("v"), F.count("*").alias("trades"))
    return out.withColumn("v", wide.text(F.col("v"))).withColumnRenamed("v", "volume")


def wide_leaderboard(trades: DataFrame, top: int = 100) -> DataFrame:
    """leaderboard() by the exact sums of size_text, which are text. Only the top rows meet in one window."""
    best = wide_volume(trades, ["trader"]).orderBy(*by_number("volume"), "trader").limit(top)
    return best.withColumn("rank", F.rank().over(W.orderBy(*by_number("volume"))).cast("long"))


def wide_volume_usd(trades: DataFrame, markets: DataFrame, network: str, as_of: Column) -> DataFrame:
    """volume_24h_usd() as exact text: the sum of size_text times the price, over ten to the market's decimals. Prices count
    in millionths; rows without a price are left out."""
    recent = trades.where((F.col("network") == network) & F.expr("not is_liquidation and size_text is not null and price is not null") & (F.col("created_at") >= as_of - F.expr("INTERVAL 24 HOURS")))
    millionths = wide.limbs(F.replace(F.col("price").cast("decimal(38,6)").cast("string"), F.lit("."), F.lit("")), PRICE_LIMBS)
    sums = recent.groupBy("slab_address").agg(wide.total(wide.product(wide_size(), millionths)).alias("v"))
    both = sums.join(markets.select("slab_address", clean_decimals(F.col("decimals")).alias("d")), "slab_address")
    return both.select("slab_address", wide.pointed(wide.text(F.col("v")), F.col("d") + 6).alias("volume_24h_usd"))
