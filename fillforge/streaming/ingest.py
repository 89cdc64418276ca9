"""Ingest of raw transactions into a keyed table: each key once, each batch once, with counters of what became of its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fillforge.operators.decode import flagged_trades
from fillforge.operators.mutate import OUTCOMES, with_outcomes
from fillforge.sources.files import Folder
from fillforge.streaming.keyed import KeyedTarget


class Ingest:
    """Stores batches of raw transactions, by number. log/<n>-written holds a batch's counters (indexed, skipped, blocked,
    failed), log/<n>-emitted says that the sink has returned.

    A batch that runs again after a failure goes on where it stopped: before the first mark it is decoded and written anew
    into its own folders; between the marks its stored rows go to the sink again, under the same number; after both nothing
    happens. So the table holds each fill once, and a sink that keeps what it gets by number (into_batches does) as well.

    registry and blocklist are read for every batch, so new markets are known at once. The counters are observed on the
    write itself. check is called with the name of each step once it is done (tests let it fail).
    """

    def __init__(self, target: KeyedTarget, programs: list[str], registry: Callable[[], DataFrame], blocklist: Callable[[], DataFrame], layouts: DataFrame, sink: Callable[[DataFrame, int], None] | None = None, network: str | None = None, check: Callable[[str, int], None] = lambda step, number: None):
        self.target, self.programs, self.registry, self.blocklist, self.layouts = target, programs, registry, blocklist, layouts
        self.sink, self.network, self.check, self.log = sink, network, check, Folder(target.spark, target.folder.path)

    def store(self, batch: DataFrame, number: int) -> dict[str, int]:
        written, emitted = f"log/{number:012d}-written", f"log/{number:012d}-emitted"
        if not self.log.exists(written):
            rows = flagged_trades(batch, self.programs, self.registry(), self.blocklist(), self.layouts)
            if self.network:
                rows = rows.withColumn("network", F.lit(self.network))
            decoded = f"{self.log.path}/decoded/batch={number}"  # read twice below, decoded once
            rows.write.mode("overwrite").parquet(decoded)
            rows = self.target.spark.read.schema(rows.schema).parquet(decoded)
            stored = self.target.stored_keys(rows, number)
            seen = Observation()
            counted = with_outcomes(rows, stored, self.target.keys).observe(seen, *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
            self.target.write(counted.where("outcome = 'indexed'").drop("outcome", "known", "blocked"), number)
            self.log.delete(f"decoded/batch={number}")
            self.check("rows", number)
            self.log.write(written, {o: seen.get.get(o, 0) for o in OUTCOMES}, replace=True)
            self.check("written", number)
        if self.sink and not self.log.exists(emitted):
            self.sink(self.target.of([number]).where("not is_liquidation").drop("batch", "bucket"), number)  # markers are no trade events
            self.check("sunk", number)
            self.log.write(emitted, {}, replace=True)
            self.check("emitted", number)
        return self.log.read(written)

    def counters(self) -> list[dict[str, int]]:
        """The counters of each batch, in order."""
        return [{"batch": int(n.split("-")[0]), **self.log.read(f"log/{n}")} for n in self.log.names("log") if n.endswith("-written")]

    def run(self, raw: DataFrame, checkpoint: str) -> StreamingQuery:
        """Ingests a stream of raw transactions, as far as it is available now."""
        writer = raw.writeStream.foreachBatch(lambda batch, number: self.store(batch, number) and None)
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return query
