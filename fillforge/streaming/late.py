"""Candles over a stream whose late rows are not lost: open bars grow, closed ones that a late row hits are made anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fillforge.operators.rollup import FILLS, total, trade_order
from fillforge.sources.files import Folder

BAR = ["slab_address", "bucket"]
SPREAD = 16  # shares of a day, each sorted and written by one task: not what a file of the input holds


def partial_bars(trades: DataFrame, interval: str) -> DataFrame:
    """Bars that can be merged: with the places in the order of trades of the first and the last price."""
    price = F.when(F.col("price") > 0, F.col("price"))
    at = F.when(price.isNotNull(), trade_order())
    fills = trades.where(FILLS).withColumn("bucket", F.window("created_at", interval)["start"])
    aggs = [F.min_by(price, at).alias("open"), F.min(at).alias("open_at"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.max(at).alias("close_at")]
    return fills.groupBy(*BAR).agg(*aggs, total(F.col("size"), trades, "size").alias("volume"), F.count("*").alias("trades"))


def merged_bars(bars: DataFrame) -> DataFrame:
    """One bar of all bars of a market and bucket, as if it were made of their trades. A volume that is NULL stays so."""
    volume = F.when(F.count("volume") == F.count("*"), total(F.col("volume"), bars, "volume"))
    aggs = [F.min_by("open", "open_at").alias("open"), F.min("open_at").alias("open_at"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "close_at").alias("close"), F.max("close_at").alias("close_at")]
    return bars.groupBy(*BAR).agg(*aggs, volume.alias("volume"), F.sum("trades").cast("long").alias("trades"))


class LiveCandles:
    """Bars of a stream of trades (created_at: the event's time), batch by batch, below one folder.

    trades/batch=<n>/day=<d> holds the rows with ingested_at beside their event's time, bars/batch=<n>/day=<d> what a batch
    changed, log/<n> its counters and the newest time seen so far. Rows before that time less `late` are late, as a
    watermark of `late` would call them. Bars of the other rows are merged into the stored ones, of which only days from
    the watermark on are read. Late rows make their bars dirty: these, and no others, are computed anew from the stored
    trades of their days. A batch that runs again replaces its own folders. Rows without time are stored (day is null)
    and belong to no bar. ingested_at gives a batch's time; nothing here asks the clock.
    """

    def __init__(self, spark: SparkSession, path: str, interval: str, late: str, ingested_at: Callable[[int], Column]):
        self.spark, self.folder, self.interval, self.late, self.ingested_at = spark, Folder(spark, path), interval, late, ingested_at

    def stored(self, kind: str, before: int, schema) -> DataFrame:
        """The rows of all batches before a number."""
        base = f"{self.folder.path}/{kind}"
        folders = [f"{base}/{n}" for n in self.folder.names(kind) if int(n.partition("=")[2]) < before]
        whole = T.StructType(schema.fields[:]).add("day", "date").add("batch", "long")
        return self.spark.read.schema(whole).option("basePath", base).parquet(*folders) if folders else self.spark.createDataFrame([], whole)

    def store(self, batch: DataFrame, number: int) -> None:
        write = lambda df, kind, time: df.withColumn("day", F.to_date(time)).write.mode("overwrite").partitionBy("day").parquet(f"{self.folder.path}/{kind}/batch={number}")
        rows = batch.withColumn("ingested_at", self.ingested_at(number))
        spread = rows.repartition(F.to_date("created_at"), F.pmod(F.xxhash64("created_at", "slab_address"), F.lit(SPREAD)))
        write(spread, "trades", "created_at")
        trades = self.stored("trades", number + 1, rows.schema)
        own = trades.where(F.col("batch") == number)
        done = [n for n in self.folder.names("log") if int(n) < number]
        seen = self.folder.read(f"log/{done[-1]}")["seen"] if done else None
        found = own.agg(F.max(F.unix_micros("created_at")).alias("seen")).first()["seen"]
        now = max((x for x in (seen, found) if x is not None), default=None)
        if seen is None:
            on_time, dirty, days = own, None, []
        else:
            mark = F.timestamp_micros(F.lit(seen)) - F.expr(f"INTERVAL {self.late}")
            on_time = own.where(F.col("created_at") >= mark)
            late = own.where(F.col("created_at") < mark).where(FILLS)
            dirty = late.select("slab_address", F.window("created_at", self.interval)["start"].alias("bucket"), F.col("day")).distinct()
            days = [r["day"] for r in dirty.select("day").distinct().collect()]
        new = partial_bars(on_time, self.interval)
        bars = self.stored("bars", number, new.schema)
        if seen is not None:
            open_days = F.col("day") >= F.to_date(mark - F.expr(f"INTERVAL {self.interval}"))
            latest = bars.where(open_days).join(new.select(*BAR), BAR, "left_semi").groupBy(*BAR).agg(F.max_by(F.struct(*new.columns[2:]), "batch").alias("x")).select(*BAR, "x.*")
            new = merged_bars(new.unionByName(latest))
        anew = 0
        if days:
            dirty = dirty.select(*BAR)
            new = new.join(dirty, BAR, "left_anti")
            again = trades.where(F.col("day").isin(days)).withColumn("bucket", F.window("created_at", self.interval)["start"]).join(dirty, BAR, "left_semi").drop("bucket")
            new = new.unionByName(partial_bars(again, self.interval))
            anew = dirty.count()
        write(new, "bars", "bucket")
        self.folder.write("schema", new.schema.jsonValue(), replace=True)
        self.folder.write(f"log/{number:012d}", {"seen": now, "dirty": anew, "days": sorted(str(x) for x in days)}, replace=True)

    def run(self, trades: DataFrame, checkpoint: str) -> StreamingQuery:
        query = trades.writeStream.foreachBatch(self.store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    def bars(self) -> DataFrame:
        """The newest state of every bar."""
        names = [*BAR, "open", "high", "low", "close", "volume", "trades"]
        schema = T.StructType.fromJson(self.folder.read("schema"))
        return self.stored("bars", 1 << 62, schema).groupBy(*BAR).agg(F.max_by(F.struct(*names[2:]), "batch").alias("x")).select(*BAR, "x.*")

    def counters(self) -> list[dict]:
        return [self.folder.read(f"log/{n}") for n in self.folder.names("log")]
