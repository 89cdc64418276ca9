"""Queries over versioned, partitioned and keyed tables, exact amounts, and the three live paths as one."""

from __future__ import annotations

from pyspark.sql import functions as F

from fillforge.operators import rollup
from fillforge.operators.versions import Conflict, Versions
from fillforge.plans import jobs
from fillforge.plans.fixtures import AS_OF, fx, mk, oracle, table
from fillforge.plans.market_queries import EXTRACTION_SQL, no_layouts
from fillforge.plans.rawdata import PROGRAM, address, raw_transactions
from fillforge.plans.rollup_queries import FILLS, VOLUME_SQL, as_of, bars_sql
from fillforge.plans.shared import shared_path, written
from fillforge.plans.stream_queries import stored_columns
from fillforge.sources import live, partitioned, scans
from fillforge.streaming.ingest import Ingest
from fillforge.streaming.keyed import KeyedTarget


def registry(s, d):
    """Three scans in turn: the devnet markets, an empty one, and all; a rival that builds on an old version loses."""
    t, markets = Versions(s, shared_path(s, "registry")), mk(s, d)
    first = t.commit(markets.where("network = 'devnet'"), t.current())
    t.commit(markets.limit(0), first)
    t.commit(markets, first)
    try:
        t.commit(markets.where("status = 'closed'"), first)
    except Conflict:
        t.update(lambda rows: rows.where("status <> 'closed'"))
    return t


def registry_versions(s, d):
    t = registry(s, d)
    each = [t.read(n).agg(F.count("*").alias("markets"), F.sum("vault").alias("vault")).select(F.lit(n).cast("long").alias("version"), "markets", "vault", F.lit(n == t.current()).alias("is_current")) for n in t.numbers()]
    return each[0].union(each[1]).union(each[2])


VERSIONS_SQL = "SELECT CAST({n} AS BIGINT) AS version, count(*) AS markets, CAST(sum(vault) AS BIGINT) AS vault, {n} = 3 AS is_current FROM mk WHERE {w}"


def footers(s, d):
    """Rows and the range of ids of the events per half-day folder, from footers; the guard of the scan is a probe too."""
    path = shared_path(s, "events")
    events = table(s, d, "events")
    if not scans.exists(events):
        return s.createDataFrame([], "half long, n long, min_event_id long, max_event_id long")
    events.withColumn("half", F.col("event_id") % 2).hint("rebalance", "half").write.partitionBy("half").parquet(path)
    return scans.footer_counts(s, path, ["half"], ["event_id"]).withColumn("half", F.col("half").cast("long"))


def stored(s, d):
    path = shared_path(s, "trades")
    partitioned.store(fx(s, d), path)
    return path


def network_volume(s, d):
    return rollup.volume_24h_by_slab(partitioned.read(s, stored(s, d)), "devnet", as_of())


def network_repair(s, d):
    """Prices of the mainnet trades without one, from those of the same transaction and market plus one."""
    path = stored(s, d)
    trades = fx(s, d)
    prices = trades.where("price >= 0").selectExpr("tx_signature", "slab_address", "event_id as pos", "event_id % 40 as price")
    partitioned.repair_stored(s, path, prices, "mainnet")
    return partitioned.read(s, path).selectExpr("event_id", "cast(network as string) as network", "price")


REPAIRED_SQL = """p AS (SELECT tx_signature, slab_address, arg_min(event_id % 40, event_id) AS q FROM fx WHERE price >= 0 AND event_id % 40 > 0 GROUP BY ALL)
SELECT event_id, network, CASE WHEN network = 'mainnet' AND price = 0 THEN coalesce(q, 0) ELSE price END AS price FROM fx LEFT JOIN p USING (tx_signature, slab_address)"""


def wide_trades(s, d):
    """Sizes of 36 digits and more: the size, then the event's number in 35 places."""
    return fx(s, d).withColumn("size_text", F.concat(F.col("size").cast("string"), F.lpad(F.col("event_id").cast("string"), 35, "0")))


def wide_sql(hi: str, lo: str, zeros: int = 0) -> str:
    """A sum of such sizes as text, from the sums of its two parts."""
    return f"coalesce(nullif(ltrim(CAST({hi} AS VARCHAR) || lpad(CAST({lo} AS VARCHAR), 35, '0') || repeat('0', {zeros}), '0'), ''), '0')"


WIDE = wide_sql("sum(size)", "sum(event_id)")
WIDE_USD_SQL = f"""v AS (SELECT slab_address, {wide_sql('sum(size * price)', 'sum(event_id * price)', 6)} AS t FROM fx WHERE network = 'devnet' AND {FILLS} AND price IS NOT NULL AND created_at >= {AS_OF} - INTERVAL 24 HOURS GROUP BY 1),
w AS (SELECT slab_address, t, 6 + CASE WHEN decimals BETWEEN 0 AND 18 THEN decimals ELSE 6 END AS k FROM v JOIN mk USING (slab_address)),
x AS (SELECT slab_address, k, CASE WHEN length(t) <= k THEN lpad(t, k + 1, '0') ELSE t END AS t FROM w)
SELECT slab_address, left(t, length(t) - k) || CASE WHEN rtrim(right(t, k), '0') = '' THEN '' ELSE '.' || rtrim(right(t, k), '0') END AS volume_24h_usd FROM x"""
WIDE_BOARD_SQL = f"""b AS (SELECT trader, {WIDE} AS volume, count(*) AS trades FROM fx WHERE {FILLS} GROUP BY 1),
t AS (SELECT * FROM b ORDER BY length(volume) DESC, volume DESC, trader LIMIT 100)
SELECT *, rank() OVER (ORDER BY length(volume) DESC, volume DESC) AS rank FROM t"""


def live_ingest(s, d):
    """Each transaction comes by one, two or all of the three paths, whose files land in three folders, each half of them
    before a run of the stream. The result is the target."""
    trades = fx(s, d)
    txs = written(raw_transactions(trades, F.col("leg_index") == 2), "transactions")
    landed = {name: shared_path(s, name) for name in ("delivered", "notified", "polled")}
    spread = F.pmod(F.hash("signature"), F.lit(7))
    seen = lambda df, late: df.withColumn("seen_at", F.timestamp_seconds(F.lit(1_750_000_000 + late)))
    rpc_group = lambda g, i: F.struct(i.alias("index"), g["instructions"].alias("instructions"))
    result = F.struct(
        F.struct(F.array("signature").alias("signatures"), F.struct(F.array(F.lit(PROGRAM)).alias("accountKeys"), F.col("instructions")).alias("message")).alias("transaction"),
        F.struct(F.transform("innerInstructions", rpc_group).alias("innerInstructions")).alias("meta"),
        F.col("accountData"),
    )
    bodies = {
        "delivered": ((0, 1, 2, 3), 0, F.array(F.struct(*live.COLUMNS))),
        "notified": ((2, 3, 4, 5), 20, F.struct(F.lit("transactionNotification").alias("method"), F.struct(result.alias("result")).alias("params"))),
        "polled": ((0, 3, 5, 6), 90, F.struct(result.alias("result"))),
    }
    lags = {"delivered": "1 minute", "notified": "1 minute", "polled": "10 minutes"}
    known = trades.select(address(F.col("slab_address")).alias("slab_address")).where("slab_address not like 'Mz3%'").distinct()
    job = Ingest(KeyedTarget(s, shared_path(s, "target"), buckets=8, parts=("network",)), [PROGRAM], lambda: known, lambda: known.where("slab_address like 'M17%'"), no_layouts(s), network="devnet")
    checkpoint = shared_path(s, "checkpoint")
    for half in (0, 1):
        for name, (slots, late, body) in bodies.items():
            part = txs.where(spread.isin(*slots) & (F.pmod(F.hash("signature"), F.lit(2)) == half))
            seen(part.select(F.to_json(body).alias("body")), late).write.mode("append").parquet(landed[name])
        arriving = {name: s.readStream.schema("body string, seen_at timestamp").parquet(path) for name, path in landed.items()}
        job.run(live.live_transactions({name: (getattr(live, name)(df), lags[name]) for name, df in arriving.items()}), checkpoint)
    return stored_columns(job.target.read().where("network = 'devnet'"))


def ingest_counters(s, d):
    """The counters of two batches of deliveries: every other transaction and a bad delivery, then all of them."""
    trades = fx(s, d)
    txs = raw_transactions(trades, F.col("leg_index") == 2)
    bodies = written(txs.select("signature", F.to_json(F.array(F.struct(*live.COLUMNS))).alias("body")), "bodies")
    first = trades.where("floor(event_id / 3) % 2 = 0").select(address(F.col("tx_signature"), 64).alias("signature")).distinct()
    slabs = trades.select(address(F.col("slab_address")).alias("slab_address")).distinct()
    target = KeyedTarget(s, shared_path(s, "target"), buckets=8)
    job = Ingest(target, [PROGRAM], lambda: slabs.where("slab_address not like 'Mz3%'"), lambda: slabs.where("slab_address like 'M17%'"), no_layouts(s))
    one = bodies.join(first, "signature", "left_semi").select("body").union(s.sql("select '[5]' as body"))
    rows = [{"batch": n, **jobs.ingest_batch(raw, job, n)} for n, raw in enumerate((one, bodies.select("body")))]
    return s.createDataFrame(rows, "batch long, indexed long, skipped long, blocked long, failed long, rejected long")


COUNTERS_SQL = EXTRACTION_SQL[: EXTRACTION_SQL.index("SELECT rpad")] + """, b AS (SELECT *, CAST(substr(tx_signature, 2) AS BIGINT) // 3 % 2 = 0 AS early FROM u),
c AS (SELECT 0 AS batch, * FROM b WHERE early UNION ALL SELECT 1, * FROM b)
SELECT CAST(batch AS BIGINT) AS batch, count(*) FILTER (slab_address NOT IN ('M03', 'M17') AND (batch = 0 OR NOT early)) AS indexed,
 count(*) FILTER (slab_address NOT IN ('M03', 'M17') AND batch = 1 AND early) AS skipped, count(*) FILTER (slab_address = 'M17') AS blocked,
 count(*) FILTER (slab_address = 'M03') AS failed, CAST(1 - batch AS BIGINT) AS rejected FROM c GROUP BY batch"""

QUERIES = {
    "ingest_counters": (ingest_counters, oracle(COUNTERS_SQL)),
    "registry_versions": (registry_versions, oracle("SELECT * FROM (" + " UNION ALL ".join(VERSIONS_SQL.format(n=n, w=w) for n, w in ((1, "network = 'devnet'"), (2, "true"), (3, "status <> 'closed'"))) + ")")),
    "registry_changes": (lambda s, d: registry(s, d).changes(1, 3, "slab_address").select("op", "slab_address"), oracle("SELECT CASE WHEN network = 'devnet' THEN 'DELETE' ELSE 'INSERT' END AS op, slab_address FROM mk WHERE (network = 'devnet') <> (status <> 'closed')")),
    "footer_counts": (footers, "SELECT event_id % 2 AS half, count(*) AS n, min(event_id) AS min_event_id, max(event_id) AS max_event_id FROM events GROUP BY 1"),
    "network_volume": (network_volume, oracle(VOLUME_SQL)),
    "network_repair": (network_repair, oracle(REPAIRED_SQL)),
    "wide_volume": (lambda s, d: rollup.wide_volume(wide_trades(s, d), ["slab_address"]), oracle(f"SELECT slab_address, {WIDE} AS volume, count(*) AS trades FROM fx WHERE {FILLS} GROUP BY 1")),
    "wide_candles_1h": (lambda s, d: rollup.wide_candles(wide_trades(s, d), "1 hour"), oracle(bars_sql("1 hour").replace("CAST(sum(size) AS BIGINT)", WIDE))),
    "wide_leaderboard": (lambda s, d: rollup.wide_leaderboard(wide_trades(s, d)), oracle(WIDE_BOARD_SQL)),
    "wide_volume_usd": (lambda s, d: rollup.wide_volume_usd(wide_trades(s, d), mk(s, d), "devnet", as_of()), oracle(WIDE_USD_SQL)),
    "live_ingest": (live_ingest, oracle(EXTRACTION_SQL)),
}
