"""Queries over streams, which end when all input is read, and over claim gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from fillforge.plans.fixtures import FX, fx, oracle, table
from fillforge.plans.market_queries import EXTRACTION_SQL, no_layouts
from fillforge.plans.rawdata import PROGRAM, address, raw_transactions
from fillforge.plans.rollup_queries import bars_sql
from fillforge.plans.shared import shared_path, written
from fillforge.streaming import gates, streams
from fillforge.streaming.ingest import Ingest
from fillforge.streaming.keyed import KeyedTarget
from fillforge.streaming.late import LiveCandles


def events_stream(s, d):
    """The events table as a stream: a folder of files, or one file picked from its folder."""
    reader = s.readStream.schema(table(s, d, "events").schema)
    where = s._jvm.org.apache.hadoop.fs.Path(f"{d}/events.parquet")
    if where.getFileSystem(s._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        return reader.parquet(f"{d}/events.parquet")
    return reader.option("pathGlobFilter", "events.parquet").parquet(d)


def fx_stream(s, d):
    """Watermarks need TIMESTAMP; results are given back without a zone, as the table has them."""
    return s.sql(FX, events=events_stream(s, d)).withColumn("created_at", F.col("created_at").cast("timestamp"))


def unzoned(df, column):
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


def drained(s, name, stream, mode):
    out = shared_path(s, name)
    streams.run_to_end(stream.writeStream.outputMode(mode).foreachBatch(streams.into_batches(out)), shared_path(s, "checkpoint"))
    return s.read.parquet(out)


def candles(s, d):
    return unzoned(streams.latest(drained(s, "candles", streams.stream_candles(fx_stream(s, d), "1 hour", "40 days"), "update"), ["slab_address", "bucket"]), "bucket")


def dedupe(s, d):
    both = fx_stream(s, d).union(fx_stream(s, d).where("event_id % 3 <> 1"))
    return drained(s, "deduped", streams.stream_dedupe(both, "40 days"), "append").drop("batch").transform(unzoned, "created_at")


def rolling(s, d):
    panes = streams.latest(drained(s, "panes", streams.stream_panes(fx_stream(s, d), "10 minutes", "40 days"), "update"), ["slab_address", "pane"])
    return unzoned(streams.rolling_volume(panes, "24 hours", "6 hours"), "window_start")


ROLLING_SQL = """SELECT slab_address, time_bucket(INTERVAL 6 HOURS, created_at) - k * INTERVAL 6 HOURS AS window_start, CAST(sum(abs(size)) AS BIGINT) AS volume, count(*) AS trades
 FROM fx, (SELECT unnest([0, 1, 2, 3]) AS k) WHERE NOT is_liquidation AND size IS NOT NULL GROUP BY ALL"""


def ingest(s, d):
    """Three batches: each half of the transactions, and a third of them again. What a batch is made of lands whole, in as
    many files as it has, before the stream goes on."""
    trades = fx(s, d)
    txs = written(raw_transactions(trades, F.col("leg_index") == 2), "transactions")
    landed, target, checkpoint = (shared_path(s, x) for x in ("landed", "trades", "checkpoint"))
    known = trades.select(address(F.col("slab_address")).alias("slab_address")).where("slab_address not like 'Mz3%'").distinct()
    job = Ingest(KeyedTarget(s, target, buckets=8), [PROGRAM], lambda: known, lambda: known.where("slab_address like 'M17%'"), no_layouts(s))
    for part in ("hash(signature) % 2 = 0", "hash(signature) % 2 <> 0", "hash(signature) % 3 = 0"):
        txs.where(part).write.mode("append").parquet(landed)
        job.run(s.readStream.schema(txs.schema).parquet(landed), checkpoint)
    return stored_columns(job.target.read())


def stored_columns(out):
    return out.selectExpr("slab_address", "trader", "side", "cast(size as bigint) as size", "size_text", "cast(price as double) as price", "cast(fee as double) as fee", "tx_signature", "asset_index", "leg_index", "is_liquidation")


def growing_registry(s, d):
    """Two batches; the registry holds half of the markets at first and, from the sink of the first batch on, all. The
    result is what the sinks got: fills, no markers."""
    trades = fx(s, d)
    landed, target, known, sunk, checkpoint = (shared_path(s, x) for x in ("landed", "trades", "registry", "sunk", "checkpoint"))
    slabs = trades.select(address(F.col("slab_address")).alias("slab_address")).where("slab_address not like 'Mz3%'").distinct()
    slabs.where("slab_address like 'Mz%'").write.parquet(known)

    def sink(new, number):
        new.write.mode("overwrite").parquet(f"{sunk}/batch={number}")
        if number == 0:
            slabs.where("slab_address not like 'Mz%'").write.mode("append").parquet(known)

    blocked = slabs.where("slab_address like 'M17%'")
    job = Ingest(KeyedTarget(s, target, buckets=8), [PROGRAM], lambda: s.read.parquet(known), lambda: blocked, no_layouts(s), sink)
    for part in (0, 1):
        txs = raw_transactions(trades.where(f"floor(event_id / 3) % 2 = {part}"), F.col("leg_index") == 2)
        txs.write.mode("append").parquet(landed)
        job.run(s.readStream.schema(txs.schema).parquet(landed), checkpoint)
    return stored_columns(s.read.parquet(sunk))


def late_rows(s, d):
    """Three batches in turn: the days up to the 19th without every tenth row, the days after it, and the rows left out, which
    are all behind the watermark by then. The bars equal those of the whole table."""
    trades, landed = fx(s, d).withColumn("created_at", F.col("created_at").cast("timestamp")), shared_path(s, "landed")
    early = F.col("created_at") < F.lit("2024-01-20").cast("timestamp")
    live = LiveCandles(s, shared_path(s, "live"), "1 hour", "2 hours", lambda n: F.timestamp_seconds(F.lit(1_750_000_000 + n)))
    checkpoint = shared_path(s, "checkpoint")
    for part in (early & (F.col("event_id") % 10 != 0), ~early, early & (F.col("event_id") % 10 == 0)):
        trades.where(part).write.mode("append").parquet(landed)
        live.run(s.readStream.schema(trades.schema).parquet(landed), checkpoint)
    return unzoned(live.bars(), "bucket")


def claims(events):
    return events.selectExpr("event_id", "user_id as wallet", "event_type as fund_type", "ts as claimed_at")


def gate(s, d):
    gated = gates.anchored_gate(claims(table(s, d, "events")), ["wallet", "fund_type"], "claimed_at", shared_path(s, "gate"))
    return gated.where("accepted").select("wallet", "fund_type", "claimed_at")


def stream_gate(s, d):
    """The stream runs to the end of the table, and once more after a last claim that moves the watermark past all others."""
    rocks, store = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    closing, out, checkpoint = (shared_path(s, x) for x in ("closing", "gated", "checkpoint"))
    timed = lambda df: df.withColumn("claimed_at", F.col("claimed_at").cast("timestamp"))
    schema = timed(claims(table(s, d, "events"))).schema
    s.createDataFrame([], schema).write.parquet(closing)
    both = timed(claims(events_stream(s, d))).union(s.readStream.schema(schema).parquet(closing))
    before = s.conf.get(rocks)
    s.conf.set(rocks, store)
    try:
        for last in (False, True):
            if last:
                s.sql("select cast(null as bigint) event_id, cast(null as bigint) wallet, 'closing' fund_type, timestamp '2100-01-01 00:00:00' claimed_at").write.mode("append").parquet(closing)
            gated = gates.stream_anchored_gate(both, ["wallet", "fund_type"], "claimed_at")
            streams.run_to_end(gated.writeStream.outputMode("append").foreachBatch(streams.into_batches(out)), checkpoint)
    finally:
        s.conf.set(rocks, before)
    return s.read.parquet(out).where("accepted and fund_type <> 'closing'").select("wallet", "fund_type", "claimed_at").transform(unzoned, "claimed_at")


GATE_SQL = """WITH RECURSIVE c AS (SELECT user_id AS wallet, event_type AS fund_type, ts AS claimed_at FROM events),
g AS (SELECT wallet, fund_type, min(claimed_at) AS claimed_at FROM c GROUP BY ALL
 UNION ALL SELECT wallet, fund_type, claimed_at FROM (SELECT g.wallet, g.fund_type, c.claimed_at, row_number() OVER (PARTITION BY g.wallet, g.fund_type ORDER BY c.claimed_at) AS n
  FROM g JOIN c ON c.wallet IS NOT DISTINCT FROM g.wallet AND c.fund_type IS NOT DISTINCT FROM g.fund_type AND c.claimed_at >= g.claimed_at + INTERVAL 24 HOURS) WHERE n = 1)
SELECT * FROM g"""


def once(s, d):
    orders, items = table(s, d, "orders"), table(s, d, "lineitem")
    base = "timestamp '2024-01-01 00:00:00'"
    challenges = orders.selectExpr("o_orderkey as nonce", "o_custkey as deployer", "o_custkey % 5 as client_ip", f"case when o_orderkey % 6 = 0 then {base} end as used_at", f"{base} + make_interval(0, 0, 0, 3) as expires_at")
    asked = items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).selectExpr("l_orderkey * 10 + l_linenumber as claim_id", "l_orderkey as nonce", "o_custkey as deployer", "case when l_linenumber = 1 then -1 else o_custkey % 5 end as client_ip", f"{base} + make_interval(0, 0, 0, cast(l_suppkey % 6 as int)) as claimed_at")
    return gates.claim_once(challenges, asked.distinct())


ONCE_SQL = """WITH a AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS claim_id, l_orderkey AS nonce, l_linenumber, TIMESTAMP '2024-01-01 00:00:00' + (l_suppkey % 6) * INTERVAL 1 DAY AS claimed_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT claim_id, nonce, claimed_at FROM (SELECT *, row_number() OVER (PARTITION BY nonce ORDER BY claimed_at, claim_id) AS n FROM a WHERE nonce % 6 <> 0 AND l_linenumber <> 1 AND claimed_at <= TIMESTAMP '2024-01-04 00:00:00') WHERE n = 1"""

GROWING_SQL = EXTRACTION_SQL + """ AND NOT is_liquidation AND (CAST(substr(tx_signature, 2) AS BIGINT) // 3 % 2 = 1 OR slab_address < 'M10')"""

QUERIES = {
    "stream_candles_1h": (candles, oracle(bars_sql("1 hour"))),
    "stream_late_candles": (late_rows, oracle(bars_sql("1 hour"))),
    "stream_dedupe": (dedupe, oracle("SELECT * FROM fx")),
    "stream_rolling_volume": (rolling, oracle(ROLLING_SQL)),
    "stream_ingest": (ingest, oracle(EXTRACTION_SQL)),
    "stream_registry_refresh": (growing_registry, oracle(GROWING_SQL)),
    "claim_gate_24h": (gate, GATE_SQL),
    "stream_claim_gate": (stream_gate, GATE_SQL),
    "claim_once": (once, ONCE_SQL),
}
