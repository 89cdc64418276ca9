"""Views over the test tables: trades (fx), markets (mk) and stored stats (sg). One SQL text serves Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

FX = """
SELECT event_id,
 'M' || lpad(CAST(user_id % 20 AS STRING), 2, '0') AS slab_address,
 'T' || CAST(user_id AS STRING) AS trader,
 CASE WHEN event_type IN ('click','view') THEN 'long' WHEN event_type IN ('signup','purchase') THEN 'short' END AS side,
 CASE WHEN event_type = 'error' THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END AS size,
 CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id * 7919 % 50 AS BIGINT) END AS price,
 CAST(0 AS BIGINT) AS fee,
 'S' || CAST(event_id - event_id % 3 AS STRING) AS tx_signature,
 CAST(user_id % 4 AS INT) AS asset_index,
 CAST(event_id % 3 AS INT) AS leg_index,
 event_type = 'error' AS is_liquidation,
 CASE WHEN event_id % 5 = 0 THEN 'mainnet' ELSE 'devnet' END AS network,
 ts AS created_at
FROM {events}
"""

#: The same trades in the exact kinds of a numeric store: sizes beyond BIGINT, prices with six places.
FXD = """
SELECT * REPLACE (CAST(CAST(size AS DECIMAL(17, 0)) * CAST(100000000000000000000 AS DECIMAL(21, 0)) AS DECIMAL(38, 0)) AS size, CAST(price AS DECIMAL(38, 6)) AS price) FROM fx
"""

MK = """
SELECT 'M' || CASE WHEN s_suppkey < 10 THEN '0' ELSE '' END || CAST(s_suppkey AS STRING) AS slab_address,
 'C' || CAST(s_nationkey AS STRING) AS mint_address,
 CASE WHEN s_suppkey % 4 = 0 THEN 'SOL' ELSE s_name END AS symbol,
 s_name AS name,
 CASE WHEN s_suppkey % 7 = 0 THEN 255 ELSE CAST(s_suppkey % 19 AS INT) END AS decimals,
 CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'CA' || CAST(s_nationkey AS STRING) END AS mainnet_ca,
 CASE WHEN s_suppkey % 5 = 0 THEN 'https://example.com/' || CAST(s_suppkey AS STRING) END AS logo_url,
 CASE WHEN s_suppkey % 6 = 0 THEN 'manual' ELSE 'auto' END AS metadata_source,
 CASE WHEN s_suppkey % 4 = 1 THEN 'hyperp' ELSE 'admin' END AS oracle_mode,
 CASE WHEN s_suppkey % 8 = 1 THEN 'P' || CAST(s_suppkey AS STRING) END AS dex_pool_address,
 CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_suppkey % 10 = 3 END AS indexer_excluded,
 CASE WHEN s_suppkey % 11 = 0 THEN 'closed' WHEN s_suppkey % 13 = 0 THEN 'paused' ELSE 'active' END AS status,
 CASE WHEN s_suppkey % 17 = 0 THEN 'retired' END AS keeper_status,
 CASE WHEN s_suppkey % 2 = 0 THEN 'devnet' ELSE 'mainnet' END AS network,
 CAST(round(s_acctbal * 200) AS BIGINT) AS vault,
 CAST(s_suppkey % 12 * 250 AS BIGINT) AS initial_margin_bps
FROM {supplier}
"""

SG = """
SELECT 'M' || CASE WHEN s_suppkey < 10 THEN '0' ELSE '' END || CAST(s_suppkey AS STRING) AS slab_address,
 CAST(s_suppkey * 10 AS BIGINT) AS volume_24h, CAST(s_suppkey AS BIGINT) AS trade_count_24h,
 CAST(s_suppkey % 50 AS BIGINT) AS last_price
FROM {supplier} WHERE s_suppkey % 3 = 1
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FX, events=table(spark, sf_dir, "events"))


def fxd(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = (F.col("size").cast("decimal(17,0)") * F.lit("100000000000000000000").cast("decimal(21,0)")).cast("decimal(38,0)")
    return fx(spark, sf_dir).withColumns({"size": size, "price": F.col("price").cast("decimal(38,6)")})


def mk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MK, supplier=table(spark, sf_dir, "supplier"))


def sg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SG, supplier=table(spark, sf_dir, "supplier"))


def oracle(body: str) -> str:
    """DuckDB SQL with the views that body names in front of it; body starts with SELECT or with further views."""
    views = [f"{n} AS ({sql.format(events='events', supplier='supplier')})" for n, sql in (("fx", FX), ("mk", MK), ("sg", SG), ("fxd", FXD))]
    return "WITH " + ",\n".join(views) + (",\n" if not body.lstrip().upper().startswith("SELECT") else "\n") + body
