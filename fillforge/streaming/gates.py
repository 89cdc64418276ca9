"""Claim gates: anchored windows per key, and nonces that work once."""

from __future__ import annotations

import datetime as dt
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fillforge.operators.numbering import numbered


class Gate:
    """Lets max_n claims through per window; the first one after a window opens the next. Times are microseconds."""

    def __init__(self, hours: float, max_n: int, start: int | None = None, used: int = 0):
        self.length, self.max_n, self.start, self.used = round(hours * 3_600_000_000), max_n, start, used

    def admits(self, at: int) -> bool:
        if self.start is None or at >= self.start + self.length:
            self.start, self.used = at, 0
        self.used += 1
        return self.used <= self.max_n


#: Claims of a key up to which it is judged in one row.
FEW = 10_000


def anchored_gate(claims: DataFrame, keys: list[str], time: str, path: str, hours: float = 24, max_n: int = 1, few: int = FEW) -> DataFrame:
    """claims with `accepted`: at most max_n per key and window, where a window starts with the first claim after the
    last one ended. Nulls in a key column count as one value. A claim without time is never accepted. path is a new folder
    for the steps' tables. Keys with up to `few` claims are judged by folded_gate, all others by spread_gate."""
    dated, never = claims.where(F.col(time).isNotNull()), claims.where(F.col(time).isNull()).withColumn("accepted", F.lit(False))
    counts = dated.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > few).drop("_n")
    counts.write.parquet(f"{path}/busy")
    busy = claims.sparkSession.read.schema(counts.schema).parquet(f"{path}/busy")
    if busy.isEmpty():
        return folded_gate(dated, keys, time, hours, max_n).union(never)
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    part = lambda how: dated.alias("c").join(busy.alias("b"), same, how)
    return folded_gate(part("left_anti"), keys, time, hours, max_n).union(spread_gate(part("left_semi"), keys, time, path, hours, max_n)).union(never)


def folded_gate(claims: DataFrame, keys: list[str], time: str, hours: float, max_n: int) -> DataFrame:
    """The gate for keys whose claims fit in a row: sorted there, and folded from one window's start to the next."""
    length = F.lit(dt.timedelta(hours=hours))
    row = F.struct(*claims.columns)
    named = claims.select(F.struct(*keys).alias("_k"), F.struct(F.col(time).alias("t"), row.alias("row")).alias("x"))
    by_time = lambda a, b: F.when(a["t"] < b["t"], -1).when(a["t"] > b["t"], 1).otherwise(0)
    sorted_ = named.groupBy("_k").agg(F.array_sort(F.collect_list("x"), by_time).alias("xs"))
    none = F.struct(F.lit(None).cast(claims.schema[time].dataType).alias("start"), F.lit(0).alias("used"), F.lit(-1).alias("at"), F.array().cast("array<int>").alias("let_in"))

    def step(acc, x):
        opens = acc["start"].isNull() | (x["t"] >= acc["start"] + length)
        used, at = F.when(opens, 1).otherwise(acc["used"] + 1), acc["at"] + 1
        return F.struct(F.when(opens, x["t"]).otherwise(acc["start"]).alias("start"), used.alias("used"), at.alias("at"), F.when(used <= max_n, F.array_append(acc["let_in"], at)).otherwise(acc["let_in"]).alias("let_in"))

    judged = sorted_.select("xs", F.aggregate("xs", none, step)["let_in"].alias("let_in"))
    each = judged.select("let_in", F.posexplode("xs").alias("at", "x"))
    return each.select("x.row.*", F.array_contains("let_in", F.col("at")).alias("accepted"))


def spread_gate(claims: DataFrame, keys: list[str], time: str, path: str, hours: float, max_n: int) -> DataFrame:
    """The gate for keys with any number of claims, which never meet in one task.

    A window's end, as the number of the first claim at or after it, is found for all claims by one more sort: each claim is
    joined by a probe at its time plus the window, and what stands before a probe, less the probes, is the number. Starts
    are what can be reached over these pointers from the first claims of the keys; pointers that skip 1, 2, 4, ... windows
    reach them in as many rounds as the longest chain has binary digits. All steps deal rows by ranges of key and time or by
    claim.
    """
    spark = claims.sparkSession
    step = 0

    def kept(df: DataFrame, name: str) -> tuple[DataFrame, int]:
        nonlocal step
        step += 1
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/{step:03d}-{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{step:03d}-{name}"), seen.get.get("n", 0)

    dated = claims.select(F.struct(*claims.columns).alias("_row"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(time).alias("_t"))
    by = [c for c in dated.columns if c.startswith("_k")]
    rows = numbered(dated, [*by, "_t"], f"{path}/claims", "_g")
    probes = rows.select(*by, (F.col("_t") + F.lit(dt.timedelta(hours=hours))).alias("_t"), F.lit(0).alias("_kind"), "_g")
    both = probes.union(rows.select(*by, "_t", F.lit(1).alias("_kind"), "_g"))
    placed = numbered(both, [*by, "_t", "_kind", "_g"], f"{path}/ends", "_u").where("_kind = 0")
    ends, total = kept(placed.select(F.col("_g").alias("g"), (F.col("_u") - F.col("_g")).alias("end")), "ends")
    reached, n = kept(rows.groupBy(*by).agg(F.min("_g").alias("g")).select("g"), "reached")
    nodes = reached.union(ends.select("end")).distinct()
    skips, _ = kept(ends.join(nodes, "g", "left_semi").where(F.col("end") < total), "skips")
    while True:
        reached, more = kept(reached.union(reached.join(skips, "g").select("end")).distinct(), "reached")
        if more == n:
            break
        n = more
        further = skips.select(F.col("g").alias("end"), F.col("end").alias("later"))
        skips, _ = kept(skips.join(further, "end").select("g", F.col("later").alias("end")), "skips")
    let_in = reached.join(ends, "g").select(F.explode(F.sequence("g", F.least(F.col("g") + (max_n - 1), F.col("end") - 1))).alias("_g"), F.lit(True).alias("_in"))
    return rows.join(let_in, "_g", "left").select("_row.*", F.coalesce("_in", F.lit(False)).alias("accepted"))


#: Claims of a key that a task holds as rows, and those in one entry of its state.
HELD, ENTRY = 10_000, 1000


class GateProcessor(StatefulProcessor):
    """The gate of one key, whose claims come when the watermark has passed their panes, so none comes before an earlier
    one. Those of a batch are sorted and judged in one call. Where they are more than HELD, they lie in entries of the state
    until the batch is judged, and only their times are held. The gate itself, a window's start and the claims it let in,
    goes with a timer when a pane's length has passed since the window's end, as no claim from before it can come then: a
    key without claims leaves nothing behind."""

    def __init__(self, schema: T.StructType, hours: float, max_n: int, pane: float):
        self.schema, self.hours, self.max_n, self.at = schema, hours, max_n, schema.names.index("_us")
        self.pane = round(pane * 3_600_000_000)
        self.judged = Row(*schema.names, "accepted")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.gate = handle.getValueState("gate", "start long, used long")
        self.entries = handle.getMapState("entries", "no long", T.StructType([T.StructField("claims", T.ArrayType(self.schema))]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = [*islice(rows, HELD + 1)]
        gate = Gate(self.hours, self.max_n, *(self.gate.get() or (None, 0)))
        if len(held) <= HELD:
            for claim in sorted(held, key=itemgetter(self.at)):
                yield self.judged(*claim, gate.admits(claim[self.at]))
        else:
            yield from self.judge_many(chain(held, rows), gate)
        closing = gate.start + gate.length + self.pane
        if closing <= timerValues.getCurrentWatermarkInMs() * 1000:
            self.gate.clear()
        else:
            self.gate.update((gate.start, gate.used))
            self.handle.registerTimer(-(-closing // 1000))  # timers are as fine as milliseconds

    def judge_many(self, claims: Iterator[Row], gate: Gate) -> Iterator[Row]:
        times, n = array("q"), 0
        while entry := [tuple(c) for c in islice(claims, ENTRY)]:
            self.entries.updateValue((n,), (entry,))
            times.extend(c[self.at] for c in entry)
            n += 1
        let_in = Counter(at for at in map(int, np.sort(np.frombuffer(times, np.int64))) if gate.admits(at))
        for no in range(n):
            for claim in self.entries.getValue((no,))[0]:
                accepted = let_in[claim[self.at]] > 0
                let_in.subtract([claim[self.at]] if accepted else [])
                yield self.judged(*claim, accepted)
            self.entries.removeKey((no,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        gate = Gate(self.hours, self.max_n, *(self.gate.get() or (None, 0)))
        if gate.start is not None and gate.start + gate.length + self.pane <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            self.gate.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_anchored_gate(claims: DataFrame, keys: list[str], time: str, late: str = "1 hour", hours: float = 24, max_n: int = 1, pane: float = 1) -> DataFrame:
    """The gate over a stream, in append mode: a claim comes out, with `accepted`, once the watermark has passed the end of
    its pane (of `pane` hours), and claims may come in any order within `late`; what comes when its pane has gone is left out. Until then
    claims wait in an aggregation by key and pane. time must be a TIMESTAMP. Nulls in a key column count as one value; claims
    without time come out at once, not accepted. The state store must be RocksDB.
    """
    dated = claims.where(F.col(time).isNotNull()).withWatermark(time, late)
    rest = [c for c in claims.columns if c not in (*keys, time)]
    waiting = F.struct(F.unix_micros(time).alias("_us"), *rest)  # not the time itself, which would stay an event time
    released = dated.groupBy(*keys, F.window(time, f"{round(pane * 3600)} seconds").alias("_pane")).agg(F.collect_list(waiting).alias("_claims"))
    each = released.select(*keys, F.window_time("_pane").alias("_passed"), F.inline("_claims"))
    out = T.StructType([*each.schema.fields, T.StructField("accepted", T.BooleanType())])
    judged = each.groupBy(*keys).transformWithState(GateProcessor(each.schema, hours, max_n, pane), out, "append", "eventTime")
    judged = judged.withColumn(time, F.timestamp_micros("_us")).select(*claims.columns, "accepted")
    return judged.union(claims.where(F.col(time).isNull()).withColumn("accepted", F.lit(False)))


def claim_once(challenges: DataFrame, claims: DataFrame) -> DataFrame:
    """The claims that use up a challenge: same nonce, deployer and address, not used before, not expired; the first one
    in time wins."""
    open_ones = challenges.where("used_at is null").select("nonce", "deployer", "client_ip", "expires_at")
    both = claims.join(open_ones, ["nonce", "deployer", "client_ip"]).where("claimed_at <= expires_at")
    first = W.partitionBy("nonce").orderBy("claimed_at", "claim_id")
    return both.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("claim_id", "nonce", "claimed_at")
