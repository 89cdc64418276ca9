"""Versioned and keyed tables, ingest under failure, late rows, claim gates: state across batches, rivals and crashes."""

import datetime as dt
import os
import random
import threading

import pytest
from compare import rows_of, rows_of_sql
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import TimerValues

from fillforge.operators.decode import flagged_trades
from fillforge.operators.mutate import with_outcomes
from fillforge.operators.numbering import numbered
from fillforge.operators.versions import Conflict, Versions
from fillforge.plans import stream_queries, table_queries
from fillforge.plans.fixtures import fx, oracle
from fillforge.plans.market_queries import EXTRACTION_SQL, no_layouts
from fillforge.plans.rawdata import PROGRAM, address, raw_transactions
from fillforge.plans.shared import shared_path
from fillforge.plans.stream_queries import GATE_SQL, claims, stored_columns
from fillforge.sources.files import Folder, Taken
from fillforge.streaming import gates, streams
from fillforge.streaming.ingest import Ingest
from fillforge.streaming.keyed import KeyedTarget
from fillforge.streaming.late import LiveCandles

# versions


def registry(spark, *slabs):
    return spark.createDataFrame([(s, i) for i, s in enumerate(slabs)], "slab_address string, ord int")


def names(df):
    return sorted(r["slab_address"] for r in df.collect())


def test_versions_move_by_compare_and_swap(spark):
    t = Versions(spark, shared_path(spark, "registry"))
    assert t.current() == 0 and t.commit(registry(spark, "a", "b"), 0) == 1
    old = t.read()
    with pytest.raises(Conflict):
        t.commit(registry(spark, "z"), 0)
    assert t.orphans() == [] and t.commit(registry(spark, "c"), 1) == 2
    assert names(old) == ["a", "b"] and names(t.read()) == ["c"] and t.info(2)["rows"] == 1
    assert t.commit(registry(spark, "a").limit(0), 2) == 2 and t.current() == 2 and t.orphans() == []
    assert t.commit(registry(spark, "a").limit(0), 2, unless_empty=False) == 3 and t.read().count() == 0
    assert t.update(lambda rows: rows.union(registry(spark, "d"))) == 4 and names(t.read()) == ["d"]
    assert {(r["op"], r["slab_address"]) for r in t.changes(1, 4, "slab_address").collect()} == {("DELETE", "a"), ("DELETE", "b"), ("INSERT", "d")}


def test_rival_writers_lose_with_an_error(spark):
    t = Versions(spark, shared_path(spark, "registry"))
    t.commit(registry(spark, "a"), 0)
    found, start = [], threading.Barrier(4)

    def rival(i):
        rows = registry(spark, f"r{i}")
        start.wait()
        try:
            found.append(t.commit(rows, 1))
        except Conflict:
            found.append(None)

    threads = [threading.Thread(target=rival, args=(i,)) for i in range(4)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert sorted(found, key=str) == [2, None, None, None] and t.numbers() == [1, 2] and t.orphans() == []


def test_update_tries_again_from_the_newest(spark):
    t = Versions(spark, shared_path(spark, "registry"))
    t.commit(registry(spark, "a"), 0)

    def change(rows):
        if t.current() == 1:
            t.commit(rows.union(registry(spark, "rival")), 1)
        return rows.union(registry(spark, "mine"))

    assert t.update(change) == 3 and names(t.read()) == ["a", "mine", "rival"]


def test_cleaning_spares_the_newest_and_pinned_versions(spark):
    t = Versions(spark, shared_path(spark, "registry"))
    for i in range(5):
        t.commit(registry(spark, f"v{i}"), i)
    with t.pinned(2) as rows:
        assert t.clean(keep=2) == [1, 3] and names(rows) == ["v1"]
    assert t.clean(keep=2) == [2] and t.numbers() == [4, 5] and len(t.folder.names("data")) == 2
    with pytest.raises(KeyError):
        t.read(1)


def test_small_files_are_taken_once(spark):
    f = Folder(spark, shared_path(spark, "folder"))
    f.write("a/x", {"n": 1})
    with pytest.raises(Taken):
        f.write("a/x", {"n": 2})
    f.write("a/x", {"n": 3}, replace=True)
    assert f.read("a/x") == {"n": 3} and f.names("a") == ["x"] and f.names("none") == []


# numbers


def test_numbers_of_sorted_rows(spark):
    r = random.Random(2)
    values = [None, *[r.randrange(50) for _ in range(3000)]]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int")
    got = numbered(df.repartition(7), ["v", "i"], shared_path(spark, "numbered")).orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(len(values)))
    assert [(r["v"], r["i"]) for r in got] == sorted(((v, i) for i, v in enumerate(values)), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert numbered(df.limit(0), ["v"], shared_path(spark, "numbered")).count() == 0


# claim gates

CLAIM = "k long, kind string, at timestamp, id long"


def some_claims(n=1500, seed=4):
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    keys = [None, 2**53, 2**53 + 1, 7]
    return [(r.choice(keys), r.choice(["a", None]), start + dt.timedelta(minutes=r.randrange(60 * 24 * 20), microseconds=r.choice((0, 0, 1, 999))), i) for i in range(n)]


def brute_gate(rows, hours=24, max_n=1):
    """How many claims of each key and time get in."""
    out, now = {}, {}
    for k, kind, at, _ in sorted(rows, key=lambda x: x[2]):
        gate = now.setdefault((k, kind), gates.Gate(hours, max_n))
        if gate.admits(round((at - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)):
            out[k, kind, at] = out.get((k, kind, at), 0) + 1
    return out


def let_in(df):
    return {(r["k"], r["kind"], r["at"]): r["count"] for r in df.where("accepted").groupBy("k", "kind", "at").count().collect()}


@pytest.mark.parametrize("few", [0, 190, 10_000])
@pytest.mark.parametrize(("hours", "max_n"), [(24, 1), (5.5, 3)])
def test_gate_equals_brute_force(spark, hours, max_n, few):
    """All keys spread, some, and none."""
    rows = some_claims()
    df = spark.createDataFrame([*rows, (7, "a", None, -1), (None, None, None, -2)], CLAIM)
    got = gates.anchored_gate(df, ["k", "kind"], "at", shared_path(spark, "gate"), hours, max_n, few)
    assert got.count() == len(rows) + 2 and got.where("at is null and accepted").count() == 0
    assert let_in(got) == brute_gate(rows, hours, max_n)
    assert gates.anchored_gate(df.limit(0), ["k"], "at", shared_path(spark, "gate")).count() == 0


def test_one_hot_key_is_spread_over_tasks(spark):
    """The sorts deal rows by key and time: no partition of one key's claims holds much more than its share."""
    rows = spark.range(8000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("at"), "id")
    path = shared_path(spark, "gate")
    assert gates.anchored_gate(rows, ["k"], "at", path, few=100).where("accepted").count() == -(-8000 // (24 * 60))
    for name, n in (("claims", 8000), ("ends", 16000)):
        sizes = [r["count"] for r in spark.read.parquet(f"{path}/{name}").groupBy(F.shiftright("_id", 33)).count().collect()]
        assert len(sizes) == 4 and max(sizes) < n / 2


def test_null_wallets_get_one_claim(spark):
    rows = [(None, "a", dt.datetime(2024, 1, 1, h), h) for h in range(4)]
    assert let_in(gates.anchored_gate(spark.createDataFrame(rows, CLAIM), ["k", "kind"], "at", shared_path(spark, "gate"))) == {(None, "a", rows[0][2]): 1}


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(name, before)


def gated(spark, files, hours=24):
    """The stream's claims after these files, one per micro-batch, and a last one far ahead; and its checkpoint."""
    landed, out, checkpoint = (shared_path(spark, x) for x in ("claims", "gated", "checkpoint"))
    for rows in [*files, [(0, "closing", dt.datetime(2100, 1, 1), -1)]]:
        spark.createDataFrame(rows, CLAIM).coalesce(1).write.mode("append").parquet(landed)
        claims_ = spark.readStream.schema(CLAIM).option("maxFilesPerTrigger", 1).parquet(landed)
        stream = gates.stream_anchored_gate(claims_, ["k", "kind"], "at", "1 hour", hours)
        streams.run_to_end(stream.writeStream.outputMode("append").foreachBatch(streams.into_batches(out)), checkpoint)
    return spark.read.parquet(out).where("kind is null or kind <> 'closing'"), checkpoint


def test_four_batches_give_what_one_gives(spark, rocks):
    rows = sorted(some_claims(300), key=lambda x: x[2])
    parts = [rows[i : i + 75] for i in range(0, 300, 75)]
    for part in parts:
        random.Random(1).shuffle(part)
    got, checkpoint = gated(spark, [*parts, [(7, "a", None, -5)]])
    assert let_in(got) == brute_gate(rows) and got.count() == 301
    state = lambda v: spark.read.format("statestore").option("stateVarName", v).load(checkpoint)
    kept = [r["key"]["kind"] for r in state("gate").collect()]
    assert kept in ([], ["closing"])  # the gates of all idle keys are gone


def test_a_gate_stays_while_claims_of_its_window_wait(spark, rocks):
    """The watermark passes the window's end at 0:30 while the pane of a claim from 0:10 is open."""
    at = lambda day, hour, minute: dt.datetime(2024, 1, day, hour, minute)
    files = [[(7, "a", at(1, 0, 30), 0)], [(7, "a", at(2, 0, 10), 1), (7, "a", at(2, 1, 45), 2)], [(7, "b", at(2, 1, 50), 3)]]
    got, _ = gated(spark, files)
    assert let_in(got) == brute_gate([row for rows in files for row in rows]) and got.count() == 4


class Held:
    """A gate's state in memory, which counts its calls."""

    def __init__(self):
        self.calls, self.values = 0, {}

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def getMapState(self, name, *schemas):  # noqa: N802
        return self

    def call(self, change, *args):
        self.calls += 1
        return change(*args)

    def get(self):
        return self.call(self.values.get, None)

    def update(self, value):
        self.call(self.values.__setitem__, None, value)

    def clear(self):
        self.call(self.values.pop, None, None)

    def getValue(self, key):  # noqa: N802
        return self.call(self.values.get, key)

    def updateValue(self, key, value):  # noqa: N802
        self.call(self.values.__setitem__, key, value)

    def removeKey(self, key):  # noqa: N802
        self.call(self.values.pop, key)

    def registerTimer(self, ms):  # noqa: N802
        self.call(lambda: None)


@pytest.mark.parametrize("n", [3000, 25_500])
def test_a_key_takes_few_calls_of_the_state_store(n):
    """Calls grow with the entries of a busy key, not with its claims; its claims are all judged."""
    out = T.StructType().add("k", "long").add("_us", "long")
    r, state = random.Random(5), Held()
    claims_ = [Row(k=1, _us=r.randrange(n) * 60_000_000) for _ in range(n)]
    gate = gates.GateProcessor(out, 24, 1, 1)
    gate.init(state)
    got = [*gate.handleInputRows((1,), iter(claims_), TimerValues(0, 0))]
    plain, want = gates.Gate(24, 1), {}
    for us in sorted(c["_us"] for c in claims_):
        want[us] = want.get(us, 0) + plain.admits(us)
    seen = {us: 0 for us in want}
    for row in got:
        seen[row[1]] += row[2]
    assert len(got) == n and seen == want and list(state.values) == [None]
    assert state.calls <= 3 + 3 * -(-n // gates.ENTRY)


def test_stream_gate_sql_with_null_keys(spark, sf):
    """GATE_SQL and the batch form agree where keys are null, too."""
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("user_id", F.when(F.col("user_id") % 3 > 0, F.col("user_id")))
    path = shared_path(spark, "events")
    events.coalesce(1).write.parquet(path)
    names_, want = rows_of_sql(GATE_SQL.replace("FROM events", f"FROM '{path.removeprefix('file://')}/*.parquet'"), sf)
    got = gates.anchored_gate(claims(spark.read.parquet(path)), ["wallet", "fund_type"], "claimed_at", shared_path(spark, "gate"))
    assert rows_of(got.where("accepted").select(*names_)) == want


# the keyed table and the ingest


def test_a_batch_reads_only_what_it_may_touch(spark):
    """Fifty batches of new keys: the rows that are read stay few, and a key of an old batch is found in its folder."""
    t = KeyedTarget(spark, shared_path(spark, "keyed"), ["id"], buckets=4, parts=("network",))
    for n in range(50):
        rows = spark.range(n * 40, n * 40 + 40).select("id", F.lit("ab"[n % 2]).alias("network"))
        if n % 7 == 0 or n > 45:
            assert t.stored_keys(rows, n).count() <= 40
        t.write(rows, n)
    old = spark.createDataFrame([(81,), (10**6,), (None,)], "id long").withColumn("network", F.lit("a"))
    touched = t.touched(old, 50)
    assert 1 <= len(touched) <= 2 and touched[0][0] == 2
    stored = t.stored_keys(old, 50)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "batch" in filters and "bucket" in filters
    assert stored.where("id = 81").count() == 1 and stored.count() <= 40
    assert "network" in t.read().where("network = 'a'")._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert t.read().count() == 2000


def test_outcomes_follow_the_write(spark):
    schema = "tx_signature string, asset_index int, leg_index int, v int, known boolean, blocked boolean"
    rows = [(None, 0, 0, 1, True, False), (None, 0, 0, 1, True, False), ("a", 0, 0, 1, True, False), ("a", 0, 0, 2, True, False), ("b", 0, 0, 1, True, False), ("c", 0, 0, 1, True, True), ("c", 0, 0, 1, False, None), ("c", 0, 0, 2, True, None)]
    stored = spark.createDataFrame([("b", 0, 0), ("b", 0, 0), (None, 0, 0)], "tx_signature string, asset_index int, leg_index int")
    got = sorted((r["tx_signature"] or "", r["v"], r["outcome"]) for r in with_outcomes(spark.createDataFrame(rows, schema), stored).collect())
    assert got == [("", 1, "indexed"), ("", 1, "indexed"), ("a", 1, "indexed"), ("a", 2, "skipped"), ("b", 1, "skipped"), ("c", 1, "blocked"), ("c", 1, "failed"), ("c", 2, "indexed")]


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["rows", "written", "sunk", "emitted"])
def test_each_fill_once_whatever_fails(spark, sf, step):
    """The second batch fails after a step, before the checkpoint, and runs again; then the same files land once more."""
    trades = fx(spark, sf).where("event_id < 120")
    txs = raw_transactions(trades, F.col("leg_index") == 2)
    slabs = trades.select(address(F.col("slab_address")).alias("slab_address")).distinct()
    landed, sunk, checkpoint = (shared_path(spark, x) for x in ("landed", "sunk", "checkpoint"))
    for keep in ("hash(signature) % 2 = 0", "hash(signature) % 2 <> 0", "hash(signature) % 2 = 0"):
        txs.where(keep).coalesce(1).write.mode("append").parquet(landed)
    failed, calls = [], []

    def check(name, number):
        if (name, number) == (step, 1) and not failed:
            failed.append(name)
            raise Crash

    def sink(new, number):
        calls.append(number)
        streams.into_batches(sunk)(new, number)

    target = KeyedTarget(spark, shared_path(spark, "target"), buckets=2)
    known = lambda: slabs.where("slab_address not like 'Mz3%'")
    job = Ingest(target, [PROGRAM], known, lambda: slabs.where("slab_address like 'M17%'"), no_layouts(spark), sink, check=check)
    stream = spark.readStream.schema(txs.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    with pytest.raises(Exception, match="Crash"):
        job.run(stream, checkpoint)
    job.run(stream, checkpoint)
    want = rows_of_sql(oracle(EXTRACTION_SQL).replace("FROM events", "FROM (SELECT * FROM events WHERE event_id < 120)"), sf)[1]
    assert rows_of(stored_columns(target.read())) == want
    assert rows_of(stored_columns(spark.read.parquet(sunk))) == [r for r in want if r[sorted(stored_columns(target.read()).columns).index("is_liquidation")] is False]
    assert calls.count(1) == (2 if step == "sunk" else 1)
    counts = job.counters()
    assert sum(c["indexed"] for c in counts) == len(want) and counts[2]["indexed"] == 0 and counts[2]["skipped"] == counts[0]["indexed"]
    every = flagged_trades(txs, [PROGRAM], known(), job.blocklist(), no_layouts(spark))
    assert sum(c["failed"] + c["blocked"] for c in counts[:2]) + len(want) == every.count() > len(want)


# late rows


def test_late_rows_make_only_their_bars_anew(spark):
    at = lambda h, m=0: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, minutes=m)
    row = lambda i, slab, when, price: (slab, "t", "long", 10, price, f"S{i}", 0, 0, False, when)
    schema = "slab_address string, trader string, side string, size long, price long, tx_signature string, asset_index int, leg_index int, is_liquidation boolean, created_at timestamp"
    files = [
        [row(1, "a", at(1), 5), row(2, "a", at(50), 6), row(3, "b", at(50, 10), 7)],
        [row(4, "a", at(50, 5), 8), row(5, "a", at(1, 30), 9), row(6, "b", at(30), 1)],  # two of them late, of two days
        [row(7, "b", at(51), 2), row(8, "b", at(49, 59), 0), row(9, "a", None, 3)],
    ]
    live, landed = LiveCandles(spark, shared_path(spark, "live"), "1 hour", "3 hours", lambda n: F.timestamp_seconds(F.lit(n))), shared_path(spark, "landed")
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
    live.run(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed), shared_path(spark, "checkpoint"))
    assert [(c["dirty"], c["days"]) for c in live.counters()] == [(0, []), (2, ["2024-01-01", "2024-01-02"]), (0, [])]
    got = {(r["slab_address"], r["bucket"]): tuple(r)[2:] for r in live.bars().collect()}
    assert got == {
        ("a", at(1)): (5, 9, 5, 9, 20, 2), ("a", at(50)): (6, 8, 6, 8, 20, 2), ("b", at(50)): (7, 7, 7, 7, 10, 1), ("b", at(30)): (1, 1, 1, 1, 10, 1), ("b", at(51)): (2, 2, 2, 2, 10, 1), ("b", at(49)): (None, None, None, None, 10, 1),
    }
    again = spark.read.parquet(f"{live.folder.path}/bars").where("batch = 1").count()
    live.store(spark.createDataFrame(files[1], schema), 1)  # a batch that runs again
    assert spark.read.parquet(f"{live.folder.path}/bars").where("batch = 1").count() == again
    assert sorted({r["ingested_at"].timestamp() for r in spark.read.parquet(f"{live.folder.path}/trades").collect()}) == [0, 1, 2]


@pytest.mark.parametrize(("module", "name", "batches", "folders"), [(stream_queries, "growing_registry", 2, ["landed"]), (stream_queries, "ingest", 3, ["landed"]), (stream_queries, "late_rows", 3, ["landed"]), (table_queries, "live_ingest", 2, ["delivered", "notified", "polled"])])
def test_batches_land_in_as_many_files_as_they_have_tasks(spark, sf, monkeypatch, module, name, batches, folders):
    """No batch goes through one task on its way to the stream."""
    paths, path = {}, shared_path(spark, "events")
    spark.read.parquet(f"{sf}/events.parquet").repartition(4).write.parquet(f"{path}/events.parquet")
    monkeypatch.setattr(module, "shared_path", lambda s, kind: paths.setdefault(kind, shared_path(s, kind)))
    coalescing = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalescing, "false")
    try:
        getattr(module, name)(spark, path)
    finally:
        spark.conf.unset(coalescing)
    for folder in folders:
        assert sum(f.endswith(".parquet") for f in os.listdir(paths[folder].removeprefix("file://"))) > batches
