"""Streaming candles, rolling volume and deduplication.

Sinks write each micro-batch into a folder of its own number: a replayed batch replaces its own output, nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fillforge.operators.mutate import TRADE_KEY
from fillforge.operators.rollup import bars, total


def run_to_end(writer, checkpoint: str) -> StreamingQuery:
    """Runs a stream over all that is available now and waits for it."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def into_batches(path: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


def latest(table: DataFrame, keys: list[str]) -> DataFrame:
    """The newest batch's row per key of a table that into_batches wrote."""
    rest = [c for c in table.columns if c not in (*keys, "batch")]
    return table.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("x")).select(*keys, "x.*")


def stream_candles(trades: DataFrame, interval: str, late: str) -> DataFrame:
    """Candles over a stream of trades, in update mode; buckets close when the watermark has passed them. Later rows go
    to refresh_candles."""
    return bars(trades.withWatermark("created_at", late), F.window("created_at", interval)["start"])


def stream_panes(trades: DataFrame, pane: str, late: str) -> DataFrame:
    """Volume and count per market and pane: what sliding windows are made of, one row instead of one per window."""
    fills = trades.where("not is_liquidation and size is not null").withWatermark("created_at", late)
    return fills.groupBy("slab_address", F.window("created_at", pane)["start"].alias("pane")).agg(total(F.abs("size"), trades, "size").alias("volume"), F.count("*").alias("trades"))


def rolling_volume(panes: DataFrame, length: str, slide: str) -> DataFrame:
    """Volume and count per market and sliding window, from panes."""
    w = F.window("pane", length, slide)
    out = panes.groupBy("slab_address", w.alias("w")).agg(total(F.col("volume"), panes, "volume").alias("volume"), F.sum("trades").cast("long").alias("trades"))
    return out.select("slab_address", F.col("w.start").alias("window_start"), "volume", "trades")


def stream_dedupe(paths: DataFrame, late: str, keys: list[str] = TRADE_KEY) -> DataFrame:
    """One row per key of a stream that unites redundant paths, as far as they lie within `late` of one another; what
    comes later meets upsert_ignore in the sink."""
    return paths.withWatermark("created_at", late).dropDuplicatesWithinWatermark(keys)
