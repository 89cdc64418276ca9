"""Token identity: pairs, assets, fallbacks, fan-out to markets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillforge.functions.binary import ADDRESS
from fillforge.functions.clean import pick_asset_logo, placeholder_name, placeholder_symbol, sanitize_text, sanitize_url
from fillforge.operators.numbering import numbered

SYMBOL, NAME = 32, 128


def distinct_cas(candidates: DataFrame, column: str = "mainnet_ca", valid: str = ADDRESS) -> DataFrame:
    return candidates.where(F.col(column).rlike(valid)).select(F.col(column).alias("ca")).distinct()


def best_pair(pairs: DataFrame) -> DataFrame:
    """ca, symbol, name, logo_url from rows ca, pos, pair.

    Only pairs on the right chain (or of none) in which the token is the base count, ranked by liquidity (missing: 0)
    and then by position. Symbol and name come from the first; the logo from the first that has a valid one. Min and
    max over the ranking replace a window, so a token with many pairs costs no sort.
    """
    rank = F.struct((-F.coalesce("pair.liquidity.usd", F.lit(0.0))).alias("l"), F.col("pos"))
    logo = sanitize_url(F.col("pair.info.imageUrl"))
    base = pairs.where("pair.baseToken.address = ca and coalesce(pair.chainId, 'solana') = 'solana'").withColumns({"_rank": rank, "_logo": logo})
    best = base.groupBy("ca").agg(F.min_by("pair.baseToken", "_rank").alias("t"), F.min_by("_logo", F.when(F.col("_logo").isNotNull(), F.col("_rank"))).alias("logo_url"))
    out = best.select("ca", sanitize_text(F.col("t.symbol"), SYMBOL).alias("symbol"), sanitize_text(F.col("t.name"), NAME).alias("name"), "logo_url")
    return out.where("symbol is not null or name is not null or logo_url is not null")


def asset_identity(assets: DataFrame) -> DataFrame:
    """ca, symbol, name, decimals, logo_url from rows ca, asset."""
    symbol = F.coalesce(F.col("asset.content.metadata.symbol"), F.col("asset.token_info.symbol"))
    return assets.select("ca", sanitize_text(symbol, SYMBOL).alias("symbol"), sanitize_text(F.col("asset.content.metadata.name"), NAME).alias("name"), F.col("asset.token_info.decimals").alias("decimals"), pick_asset_logo(F.col("asset.content")).alias("logo_url"))


def fan_out_identity(candidates: DataFrame, identities: DataFrame) -> DataFrame:
    """Patches for every market of a token: slab_address with symbol, name, logo_url, the market's own where unknown."""
    i = identities.select(F.col("ca").alias("_ca"), *[F.col(c).alias(f"_{c}") for c in ("symbol", "name", "logo_url")])
    both = candidates.join(i, candidates["mainnet_ca"] == i["_ca"])
    some = both.where("_symbol is not null or _name is not null or _logo_url is not null")
    return some.select("slab_address", F.coalesce("_symbol", "symbol").alias("symbol"), F.coalesce("_name", "name").alias("name"), F.col("_logo_url").alias("logo_url"))


def resolve_identity(markets: DataFrame, tokens: DataFrame) -> DataFrame:
    """slab_address, symbol, name, logo_url for new markets (slab_address, mint_address, hyperp, base_mint).

    tokens: ca, symbol, name, logo_url. A plain market takes its collateral's identity, else the mint's first eight
    characters and a placeholder name. A hyperp market takes the base token's as base/collateral Perpetual (USDC where
    the collateral is unknown), or a placeholder without logo.
    """
    t = lambda p: tokens.select(F.col("ca").alias(f"{p}ca"), F.col("symbol").alias(f"{p}symbol"), F.col("name").alias(f"{p}name"), F.col("logo_url").alias(f"{p}logo"))
    c, b = t("c_"), t("b_")
    both = markets.join(c, markets["mint_address"] == c["c_ca"], "left").join(b, markets["base_mint"] == b["b_ca"], "left")
    label = F.coalesce("c_symbol", F.lit("USDC"))
    has_base = F.col("b_symbol").isNotNull()
    symbol = F.when(~F.col("hyperp"), F.coalesce("c_symbol", F.left("mint_address", F.lit(8)))).when(has_base, F.col("b_symbol")).otherwise(placeholder_symbol())
    name = F.when(~F.col("hyperp"), F.coalesce("c_name", placeholder_name(F.col("slab_address")))).when(has_base, F.concat("b_symbol", F.lit("/"), label, F.lit(" Perpetual"))).otherwise(placeholder_name(F.col("slab_address")))
    logo = F.when(~F.col("hyperp"), F.col("c_logo")).when(has_base, F.coalesce("b_logo", "c_logo"))
    return both.select("slab_address", symbol.alias("symbol"), name.alias("name"), logo.alias("logo_url"))


def batch_assign(df: DataFrame, n: int, order: list[str], path: str) -> DataFrame:
    """df with batch: groups of n rows in a given order. path takes the sorted rows (see numbered())."""
    return numbered(df, order, path, "batch").withColumn("batch", F.floor(F.col("batch") / n).cast("long"))


def batch_by_hash(df: DataFrame, buckets: int, key: Column) -> DataFrame:
    return df.withColumn("batch", F.pmod(F.xxhash64(key), F.lit(buckets)))


def mint_lookup(mints: DataFrame, wanted: DataFrame) -> DataFrame:
    """address, other: the devnet mint of a mainnet address, or the mainnet address of a devnet mint."""
    both = mints.select(F.col("mainnet_ca").alias("address"), F.col("devnet_mint").alias("other")).union(mints.select("devnet_mint", "mainnet_ca"))
    return wanted.select("address").distinct().join(both, "address")
