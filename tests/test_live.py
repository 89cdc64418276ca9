"""Exact amounts, partitioned tables, footers and the live paths."""

import datetime as dt
import decimal
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from fillforge.functions import wide
from fillforge.operators import rollup
from fillforge.plans.fixtures import fx
from fillforge.plans.rollup_queries import as_of
from fillforge.plans.shared import shared_path
from fillforge.sources import live, partitioned, scans


def numbers(n=200):
    r = random.Random(6)
    return [0, 1, -1, 10**9, -(10**9), 10**44, -(10**44), 2**127 - 1, -(2**127)] + [r.randrange(-(10 ** r.randrange(1, 45)), 10 ** r.randrange(1, 45)) for _ in range(n)]


def test_sums_and_products_equal_pythons(spark):
    r = random.Random(7)
    rows = [(i % 5, str(a), str(r.choice(numbers()))) for i, a in enumerate(numbers())]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    got = df.groupBy("k").agg(wide.text(wide.total(wide.limbs(F.col("a"), 5))).alias("s"), wide.text(wide.total(wide.product(wide.limbs(F.col("a"), 5), wide.limbs(F.col("b"), 5)))).alias("p"))
    want = {k: (str(sum(int(a) for i, a, _ in rows if i == k)), str(sum(int(a) * int(b) for i, a, b in rows if i == k))) for k in range(5)}
    assert {x["k"]: (x["s"], x["p"]) for x in got.collect()} == want


@pytest.mark.parametrize(("text", "want"), [("007", "7"), ("-0", "0"), ("", "0"), ("x", "0"), ("1.5", "0"), (None, "0"), ("1" * 46, "0"), ("0" * 60 + "12", "12")])
def test_what_is_no_number_is_left_out(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.agg(wide.text(wide.total(wide.limbs(F.col("t"), 5))).alias("s")).first()["s"] == want


@pytest.mark.parametrize(("text", "places", "want"), [("12345", 2, "123.45"), ("-5", 3, "-0.005"), ("1200", 2, "12"), ("0", 6, "0"), ("7", 0, "7"), ("-100", 1, "-10")])
def test_points_are_exact(spark, text, places, want):
    assert spark.createDataFrame([(text, places)], "t string, p int").select(wide.pointed(F.col("t"), F.col("p")).alias("x")).first()["x"] == want


def test_rollups_of_wide_amounts_match_python(spark):
    at = dt.datetime(2024, 1, 30, 12)
    big = 10**38 + 7
    rows = [("M", t, "short" if i % 2 else "long", str(big * (i + 1)), decimal.Decimal(p), "devnet", False, at, f"S{i}", 0, 0) for i, (t, p) in enumerate([("a", "0.000001"), ("b", "1234567.5"), ("a", "99999999999999999999999999999999.999999"), ("b", "3")])]
    rows += [("M", "c", None, None, None, "devnet", True, at, "S9", 0, 0), ("M", "c", "long", "5", None, "devnet", False, at, "S8", 0, 0)]
    schema = "slab_address string, trader string, side string, size_text string, price decimal(38,6), network string, is_liquidation boolean, created_at timestamp, tx_signature string, asset_index int, leg_index int"
    df = spark.createDataFrame(rows, schema)
    markets = spark.createDataFrame([("M", 18)], "slab_address string, decimals int")
    assert rollup.wide_volume(df, ["slab_address"]).first()["volume"] == str(10 * big + 5)
    assert [(r["trader"], r["volume"], r["rank"]) for r in rollup.wide_leaderboard(df).orderBy("rank").collect()] == [("b", str(6 * big), 1), ("a", str(4 * big), 2), ("c", "5", 3)]
    assert rollup.wide_candles(df, "1 hour").first()["volume"] == str(10 * big + 5)
    with decimal.localcontext(prec=120):
        usd = sum(int(r[3]) * r[4] for r in rows if r[4] is not None and r[3]) / decimal.Decimal(10) ** 18
        got = decimal.Decimal(rollup.wide_volume_usd(df, markets, "devnet", F.lit(dt.datetime(2024, 1, 31))).first()["volume_24h_usd"])
        assert got == usd


# partitions and footers


def files(path):
    path = path.removeprefix("file://")
    return {os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def partition_filters(df):
    return df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_one_network_is_read_and_written(spark, sf):
    path = shared_path(spark, "trades")
    partitioned.store(fx(spark, sf), path)
    trades = partitioned.read(spark, path)
    assert "network" in partition_filters(rollup.volume_24h_by_slab(trades, "devnet", as_of()))
    assert "network" in partition_filters(scans.scan_zero_price_trades(trades, "devnet"))
    before = files(path)
    zero = trades.where("network = 'mainnet' and price = 0").orderBy("created_at").first()
    prices = spark.createDataFrame([(zero["tx_signature"], zero["slab_address"], 0, 77)], "tx_signature string, slab_address string, pos long, price long")
    assert partitioned.repair_stored(spark, path, prices, "mainnet") == [str(zero["day"])]
    changed = {f.split("/part-")[0] for f in files(path) ^ before}
    assert changed == {f"network=mainnet/day={zero['day']}"}
    again = partitioned.read(spark, path)
    assert again.count() == fx(spark, sf).count() and again.where(F.col("event_id") == zero["event_id"]).first()["price"] == 77
    assert partitioned.repair_stored(spark, path, prices, "mainnet") == []


def test_counts_come_from_footers(spark, sf):
    path = shared_path(spark, "orders")
    spark.read.parquet(f"{sf}/orders.parquet").withColumn("p", F.col("o_orderkey") % 3).write.partitionBy("p").parquet(path)
    rows = spark.read.parquet(path)
    got = scans.footer_counts(spark, path, ["p"], ["o_custkey"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in rows.groupBy("p").agg(F.count("*"), F.min("o_custkey"), F.max("o_custkey")).collect())
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert scans.footer_counts(spark, path).first()["n"] == rows.count() and not scans.exists(rows.limit(0))


# live paths

RESULT = {
    "transaction": {"signatures": ["s1", "s2"], "message": {"accountKeys": ["k", {"pubkey": "p", "signer": True}], "instructions": [{"programId": "prog", "data": "d", "accounts": ["a", {"pubkey": "b"}]}, {"program": "system", "programId": "sys", "parsed": {"x": 1}}]}},
    "meta": {"err": None, "innerInstructions": [{"index": 3, "instructions": [{"programId": {"pubkey": "prog"}, "data": "late", "accounts": []}]}, {"index": 1, "instructions": [{"programId": "prog", "data": "soon", "accounts": ["c"]}]}]},
}


def said(spark, bodies):
    return spark.createDataFrame([(json.dumps(b) if not isinstance(b, str) else b, i) for i, b in enumerate(bodies)], "body string, i int")


def test_notifications_have_the_shape_of_transactions(spark):
    note = lambda r, method="transactionNotification": {"method": method, "params": {"result": r}}
    error = {**RESULT, "signature": "top", "meta": {"err": {"InstructionError": [0, 1]}}}
    got = live.notified(said(spark, [note(RESULT), note(error), note(RESULT, "other"), "{", note(None), {"method": "transactionNotification"}])).orderBy("i").collect()
    first, second = got
    assert first["signature"] == "s1" and first["transactionError"] is None and second["signature"] == "top" and "InstructionError" in second["transactionError"]
    assert [tuple(i) for i in first["instructions"]] == [("prog", "d", ["a", "b"]), ("sys", None, None)]
    assert [[i["data"] for i in g["instructions"]] for g in first["innerInstructions"]] == [["soon"], ["late"]] and first["innerInstructions"][1]["instructions"][0]["programId"] == "prog"
    assert first["accountData"] == [] and second["innerInstructions"] == [] and second["instructions"] == first["instructions"]
    assert [r["signature"] for r in live.polled(said(spark, [{"result": RESULT}, {"result": None}, {"error": 1}])).collect()] == ["s1"]


@pytest.mark.parametrize(("policy", "want"), [("min", 4), ("max", 4)])
def test_a_transaction_passes_once_from_three_paths(spark, policy, want):
    name = "spark.sql.streaming.multipleWatermarkPolicy"
    columns = "signature string, transactionError string, instructions array<string>, innerInstructions array<string>, accountData array<string>, seen_at timestamp"
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    row = lambda sig, s: (sig, None, [], [], [], at(s))
    paths = {"delivered": [row("a", 0), row("a", 1), row("b", 2)], "notified": [row("a", 3), row("c", 4)], "polled": [row("b", 50), row("c", 55), row("d", 60)]}
    folders = {k: shared_path(spark, k) for k in paths}
    for k, rows in paths.items():
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(folders[k])
    before = spark.conf.get(name, "min")
    spark.conf.set(name, policy)
    try:
        one = live.live_transactions({k: (spark.readStream.schema(columns).parquet(p), lag) for (k, p), lag in zip(folders.items(), ("1 minute", "1 minute", "10 minutes"), strict=True)})
        out = shared_path(spark, "out")
        one.writeStream.outputMode("append").option("checkpointLocation", shared_path(spark, "checkpoint")).trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    finally:
        spark.conf.set(name, before)
    got = [r["signature"] for r in spark.read.parquet(out).collect()]
    assert sorted(got) == ["a", "b", "c", "d"] and len(got) == want
