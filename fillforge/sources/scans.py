"""Scans of accounts, signatures, lists and landed metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillforge.functions.binary import byte_at, to_base58, u128_le, uint_le
from fillforge.functions.clean import price_from_e6, sane_price_e6

#: Fixed values of the account layout: magic, kind, offsets in bytes.
MAGIC = "0036315643524550"
KIND_MARKET = 1
OFFSETS = {"version": 8, "kind": 10, "admin": 16, "mark_price": 248, "vault": 733, "insurance": 749, "c_tot": 765}
DEFAULT_MARGIN_BPS = 500

PAIR = "struct<chainId:string,baseToken:struct<address:string,name:string,symbol:string>,info:struct<imageUrl:string>,liquidity:struct<usd:double>>"
ASSET = "struct<content:struct<links:struct<image:string>,files:array<struct<mime:string,uri:string,cdn_uri:string>>,metadata:struct<symbol:string,name:string>>,token_info:struct<symbol:string,decimals:int>>"


def scan_accounts(snapshot: DataFrame, kind: int = KIND_MARKET) -> DataFrame:
    """Accounts of at least 11 bytes that carry the magic and the kind."""
    d = F.col("data")
    return snapshot.where((F.octet_length(d) >= 11) & (F.hex(F.substring(d, 1, 8)) == MAGIC) & (byte_at(d, OFFSETS["kind"]) == kind))


def scan_known_accounts(snapshot: DataFrame, addresses: DataFrame, owner: str) -> DataFrame:
    """The given accounts as far as they exist and belong to owner."""
    return snapshot.where(F.col("owner") == owner).join(addresses.select("pubkey").distinct(), "pubkey", "left_semi")


def decode_markets(snapshot: DataFrame) -> DataFrame:
    """Registry columns of market accounts; amounts are 0 where an account is too short to hold them."""
    d = F.col("data")
    amount = lambda c: F.when(F.octet_length(d) >= 781, u128_le(d, OFFSETS[c])).otherwise(0).cast("decimal(38,0)").alias(c)
    price = price_from_e6(sane_price_e6(uint_le(d, OFFSETS["mark_price"], 8))).alias("mark_price")
    admin = F.when(F.octet_length(d) >= 48, to_base58(F.substring(d, OFFSETS["admin"] + 1, 32))).alias("admin")
    return scan_accounts(snapshot).select(F.col("pubkey").alias("slab_address"), uint_le(d, OFFSETS["version"], 2).cast("int").alias("version"), admin, amount("vault"), amount("insurance"), amount("c_tot"), price, F.lit(DEFAULT_MARGIN_BPS).cast("long").alias("initial_margin_bps"))


def parse_address_list(rows: DataFrame, column: str) -> DataFrame:
    """The addresses of comma-separated lists, trimmed, without empty ones."""
    return rows.select(F.explode(F.transform(F.split(column, ","), lambda x: F.trim(x))).alias("address")).where("address <> ''")


def incremental_scan(signatures: DataFrame, cursors: DataFrame, limit: int | None = None) -> DataFrame:
    """Signatures (slab_address, tx_signature, slot) newer than their market's cursor (slab_address, slot).

    With a limit the oldest ones come first, so that nothing between the cursor and the newest is lost.
    """
    seen = cursors.select("slab_address", F.col("slot").alias("_cursor"))
    new = signatures.join(seen, "slab_address", "left").where("_cursor is null or slot > _cursor").drop("_cursor")
    if limit is None:
        return new
    order = W.partitionBy("slab_address").orderBy("slot", "tx_signature")
    return new.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= limit).drop("_n")


def advance_cursor(cursors: DataFrame, batch: DataFrame) -> DataFrame:
    """Cursors after a batch was stored: the newest slot per market, never going back."""
    both = cursors.select("slab_address", "slot").union(batch.select("slab_address", "slot"))
    return both.groupBy("slab_address").agg(F.max("slot").alias("slot"))


def scan_zero_price_trades(trades: DataFrame, network: str) -> DataFrame:
    rows = trades.where((F.col("network") == network) & (F.col("price") == 0) & F.col("tx_signature").isNotNull())
    return rows.select("tx_signature", "slab_address", "asset_index", "leg_index", "created_at").orderBy("created_at", "tx_signature", "asset_index", "leg_index")


def scan_metadata_candidates(markets: DataFrame, network: str, limit: int = 60) -> DataFrame:
    """Markets that may get a logo from their token: automatic metadata, no logo, a known address."""
    rows = markets.where((F.col("network") == network) & F.expr("metadata_source = 'auto' and logo_url is null and mainnet_ca is not null"))
    return rows.select("slab_address", "mainnet_ca", "symbol", "name").orderBy("slab_address").limit(limit)


def read_token_pairs(landed: DataFrame, column: str = "body") -> DataFrame:
    """Rows ca, pos, pair from landed responses (ca, body)."""
    return landed.select("ca", F.posexplode(F.from_json(column, f"array<{PAIR}>")).alias("pos", "pair"))


def read_assets(landed: DataFrame, column: str = "body") -> DataFrame:
    return landed.select("ca", F.from_json(column, ASSET).alias("asset"))


def exists(df: DataFrame) -> bool:
    return not df.limit(1).isEmpty()


def footer_counts(spark: SparkSession, path: str, by: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Count of the rows of a Parquet table, and least and largest values of columns, per folder column if wanted, from
    the files' footers: no row is read. The DataFrame belongs to a session of its own with aggregate push-down, so the
    caller's settings stay. Folder columns must come from the path. TIMESTAMP and text have no exact footers: not here."""
    probe = spark.newSession()
    probe.conf.set("spark.sql.sources.useV1SourceList", "")
    probe.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    ends = [f(c).alias(f"{name}_{c}") for c in columns or [] for f, name in ((F.min, "min"), (F.max, "max"))]
    return probe.read.parquet(path).groupBy(*(by or [])).agg(F.count("*").alias("n"), *ends)
