"""Boundary values and invariants of the operators."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from fillforge.functions import clean
from fillforge.functions.binary import abs_decimal, abs_text, decode58, decode58_all, encode58, encode58_all, from_base58, i128_parts, to_base58, u128_le, uint_le
from fillforge.operators import decode, enrich, mutate, registry, repair, rollup
from fillforge.plans import jobs
from fillforge.plans.fixtures import fx
from fillforge.plans.market_queries import no_layouts
from fillforge.plans.rawdata import PROGRAM, address, raw_transactions
from fillforge.sources import deliveries, scans


def le(n, size):
    return n.to_bytes(size, "little", signed=n < 0)


def one(df):
    return df.collect()[0]


def test_base58_of_many_texts():
    rng = random.Random(5)
    raw = [b"\0" * rng.choice((0, 0, 1, 3)) + rng.randbytes(rng.choice((0, 1, 2, 4, 19, 32, 64, 180, 300))) for _ in range(3000)]
    assert encode58_all([*raw, None, b"", b"\xff" * 250, b"\xff" * 251]) == [encode58(x) for x in [*raw, None, b"", b"\xff" * 250, b"\xff" * 251]]
    texts = [encode58(x) for x in raw] + [None, "", "1", "0", "z" * 5, "z" * 250, "1" * 7, "é" * 5, "ab\0"]
    assert decode58_all(texts) == [decode58(x) for x in texts] and decode58_all(texts)[: len(raw)] == raw


@pytest.mark.parametrize("n", [0, 1, -1, -5, 2**63, 2**64, 10**38 - 1, 10**38, 2**127 - 1, -(2**127), -(2**127) + 1])
def test_i128(spark, n):
    df = spark.createDataFrame([(bytearray(b"x" + le(n, 16)),)], "b binary")
    p = i128_parts(F.col("b"), 1)
    r = one(df.select(p["negative"].alias("neg"), abs_text(p).alias("t"), abs_decimal(p).alias("d")))
    assert (r["neg"], r["t"]) == (n < 0, str(abs(n)))
    assert (r["d"] is None) == (abs(n) >= 10**38) and (r["d"] is None or int(r["d"]) == abs(n))


@pytest.mark.parametrize("n", [0, 84_000_000, 10**12, 2**64 - 1])
def test_uint(spark, n):
    r = one(spark.createDataFrame([(bytearray(le(n, 8)),)], "b binary").select(uint_le(F.col("b"), 0, 8).alias("x"), uint_le(F.col("b"), 1, 8).alias("y"), u128_le(F.col("b"), 0).alias("z")))
    assert int(r["x"]) == n and r["y"] is None and r["z"] is None


def test_base58(spark):
    raw = [b"", b"\0\0", b"\0\x01", bytes(range(40)), b"\xff" * 33]
    assert [decode58(encode58(x)) for x in raw] == raw
    assert decode58("0OIl") is None
    rows = spark.createDataFrame([(bytearray(x),) for x in raw] + [(None,)], "b binary").select("b", from_base58(to_base58("b")).alias("c")).collect()
    assert all(r["b"] == r["c"] for r in rows)


def test_sane_price(spark):
    rows = spark.createDataFrame([(0,), (1,), (84_000_000,), (999_999_999_999,), (10**12,)], "p long").select(clean.sane_price_e6(F.col("p")).alias("x")).collect()
    assert [r["x"] for r in rows] == [None, 1, 84_000_000, 999_999_999_999, None]


def test_cleaning(spark):
    r = one(spark.range(1).select(
        clean.sanitize_text(F.lit("　a\u0007<b> "), 32).alias("a"), clean.sanitize_text(F.lit(" \n "), 32).alias("b"), clean.sanitize_url(F.lit("javascript:x")).alias("c"),
        clean.sanitize_url(F.lit("HTTPS://a/b")).alias("d"), clean.sanitize_url(F.lit("http://" + "a" * 600)).alias("e"), clean.max_leverage(F.lit(0)).alias("f"), clean.max_leverage(F.lit(20000)).alias("g"),
        clean.max_leverage(F.lit(None).cast("long")).alias("h"), clean.clean_decimals(F.lit(255)).alias("i"), clean.resolve_network(F.lit(None).cast("string")).alias("j"),
    ))
    assert list(r) == ["ab", None, None, "HTTPS://a/b", None, 10, 10, 10, 6, "devnet"]


TRADER, SLAB, OTHER = "T" * 32, "S" * 32, "X" * 32


def transaction(*outer, inner=(), sig="a" * 64, error=None, accounts=()):
    ix = lambda data, accs=(TRADER, SLAB, SLAB), program=PROGRAM: (program, encode58(data), list(accs))
    return (sig, error, [ix(*o) if isinstance(o, tuple) else ix(o) for o in outer], [([ix(i) for i in inner],)], list(accounts))


def extract(spark, *txs, known=(SLAB,), blocked=()):
    schema = deliveries.TRANSACTION.replace("struct<", "", 1)[:-1]
    df = spark.createDataFrame(list(txs), spark.sql(f"select from_json('', '{deliveries.TRANSACTION}') as x").schema["x"].dataType)
    assert schema
    slabs = lambda x: spark.createDataFrame([(s,) for s in x], "slab_address string")
    return decode.extract_trades(df, [PROGRAM], slabs(known), slabs(blocked), no_layouts(spark)).orderBy("leg_index").collect()


def single(size, asset=0, tag=6):
    return bytes([tag]) + le(asset, 2) + le(size, 16)


def batch(*sizes, cut=0):
    raw = b"".join(le(0, 2) + le(s, 16) + le(9, 16) for s in sizes)
    return bytes([66, len(sizes)]) + raw[: len(raw) - cut]


def test_decode_boundaries(spark):
    got = extract(spark, transaction(single(5), single(0), single(-5, 258), single(7, tag=35), single(3)[:18], batch(1, 2, 3, cut=1), batch(), single(-(2**127)), single(2**127 - 1)))
    assert [(r["leg_index"], r["side"], r["size_text"], r["asset_index"]) for r in got] == [(0, "long", "5", 0), (1, "short", "5", 258), (2, "long", "1", 0), (3, "long", "2", 0), (4, "long", str(2**127 - 1), 0)]
    assert got[-1]["size"] is None and got[0]["price"] == 0


def test_decode_liquidations_and_roles(spark):
    crank = lambda action: bytes([5, action, 2, 1])
    got = extract(spark, transaction((crank(1), (OTHER, SLAB, TRADER)), (crank(0), (OTHER, SLAB, TRADER)), (crank(1), (OTHER, SLAB)), (single(1), (TRADER,)), (single(4, tag=10), (TRADER, SLAB)), (single(1), (TRADER, SLAB, SLAB), OTHER)))
    assert [(r["leg_index"], r["is_liquidation"], r["asset_index"], r["side"]) for r in got] == [(0, False, 0, "long"), (1000, True, 258, None)]


def test_registry_comes_after_numbering(spark):
    two = transaction((single(1), (TRADER, OTHER, OTHER)), single(2))
    assert [(r["leg_index"], r["size_text"]) for r in extract(spark, two)] == [(1, "2")]
    assert extract(spark, two, blocked=(SLAB, OTHER)) == []
    assert extract(spark, transaction(single(1), error="x")) == [] and extract(spark, transaction(single(1), sig="0" * 64)) == []


def test_inner_echo_and_replay(spark):
    tx = transaction(single(1), single(1), inner=(single(1), single(2), single(2)))
    assert [r["size_text"] for r in extract(spark, tx, tx)] == ["1", "1", "2"]


def test_logs_never_set_prices(spark, sf):
    txs = raw_transactions(fx(spark, sf).limit(50), F.lit(False))
    known = txs.select(F.explode("accountData.account").alias("slab_address"))
    a = decode.extract_trades(txs, [PROGRAM], known, known.limit(0), no_layouts(spark))
    b = decode.extract_trades(txs.withColumn("logs", F.array(F.lit("price: 99"))), [PROGRAM], known, known.limit(0), no_layouts(spark))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_stream_envelopes(spark):
    note = '{"method":"transactionNotification","params":{"result":{"transaction":{"signatures":["s1"],"message":{"instructions":[]}},"meta":{"err":null}}}}'
    rows = [(note,), (note.replace('"err":null', '"err":{"x":1}'),), (note.replace("transactionNotification", "other"),), ("{",)]
    assert [r["signature"] for r in deliveries.stream_envelopes(spark.createDataFrame(rows, "value string")).collect()] == ["s1"]
    keys = spark.sql("select explode(array(parse_json('\"k\"'), parse_json('{\"pubkey\":\"p\"}'))) as v").select(deliveries.normalize_pubkey(F.col("v")).alias("k"))
    assert [r["k"] for r in keys.collect()] == ["k", "p"]


def test_ingest_job(spark):
    good = '{"signature":"%s","instructions":[{"programId":"%s","data":"%s","accounts":["%s","x","%s"]}]}' % ("b" * 64, PROGRAM, encode58(single(3)), TRADER, SLAB)
    raw = spark.createDataFrame([(good,), (f"[{good}]",), ("[5]",)], "body string")
    slabs = spark.createDataFrame([(SLAB,)], "slab_address string")
    stored = spark.createDataFrame([], "tx_signature string, asset_index int, leg_index int")
    new, bad = jobs.ingest_job(raw, stored, [PROGRAM], slabs, slabs.limit(0), no_layouts(spark))
    assert new.count() == 1 and [r["reason"] for r in bad.collect()] == ["invalid_format"]
    assert jobs.ingest_job(raw, new, [PROGRAM], slabs, slabs.limit(0), no_layouts(spark))[0].count() == 0


def test_upsert_null_signatures_never_conflict(spark):
    rows = spark.createDataFrame([(None, 0, 0, 1), (None, 0, 0, 1), ("a", 0, 0, 1), ("a", 0, 0, 2)], "tx_signature string, asset_index int, leg_index int, v int")
    assert mutate.upsert_ignore(rows.where("tx_signature = 'b'"), rows).count() == 3
    assert mutate.upsert_ignore(rows, rows).count() == 2


def test_constraints(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 3)], "k string, v int")
    good, bad = mutate.check_constraints(df, {"v": F.col("v") < 2}, ["k"], {"fk": ("k", df.where("k = 'a'"), "k")})
    assert [r["k"] for r in good.collect()] == ["a"]
    assert sorted((r["k"] or "", r["rule"]) for r in bad.collect()) == [("", "v"), ("b", "fk")]


@pytest.mark.parametrize(("vault", "n", "want"), [(1_000_000, 0, "close"), (1_000_001, 0, "keep"), (0, 1, "keep")])
def test_lifecycle_bounds(spark, vault, n, want):
    m = spark.createDataFrame([("a", False, "active", "auto"), ("b", True, "closed", "manual")], "slab_address string, indexer_excluded boolean, status string, metadata_source string")
    acc = spark.createDataFrame([("a", True, vault, n), ("b", True, vault, n)], "slab_address string, readable boolean, vault long, accounts int")
    got = {r["slab_address"]: r for r in registry.market_lifecycle(m, m, acc).collect()}
    assert got["a"]["action"] == want and got["b"]["action"] == ("keep" if want == "close" else "reenable")
    assert registry.market_lifecycle(m, m, acc, protect_manual=True).where("slab_address = 'b' and action <> 'keep'").count() == 0


def test_registration_job(spark):
    snap = spark.createDataFrame([("s1", 1, "mint", "base", True, 500, 6), ("s1", 2, "mint", "base", True, 250, 6), ("s2", 1, "mint", None, False, 0, 40)], "slab_address string, ord int, mint_address string, base_mint string, hyperp boolean, initial_margin_bps long, decimals int")
    tokens = spark.createDataFrame([("mint", "USD", "Dollar", None), ("base", "SOL", None, "https://l")], "ca string, symbol string, name string, logo_url string")
    markets = spark.createDataFrame([("s0", None)], "slab_address string, keeper_status string")
    got = {r["slab_address"]: r for r in jobs.registration_job([snap], markets, markets.limit(0), tokens, "devnet").collect()}
    assert (got["s1"]["name"], got["s1"]["max_leverage"], got["s2"]["symbol"], got["s2"]["decimals"], got["s2"]["max_leverage"]) == ("SOL/USD Perpetual", 40, "USD", 6, 10)


def test_last_found_wins_and_empty_scan_keeps_registry(spark):
    d = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "slab_address string, ord int, admin string")
    assert one(registry.dedupe_markets(d))["admin"] == "y"
    assert mutate.guarded_swap(d, d.limit(0)).count() == 2 and mutate.guarded_swap(d, d.limit(1)).count() == 1


def test_best_pair_without_any(spark):
    rows = spark.createDataFrame([("a", 0, (None, ("b", "n", "s"), (None,), (1.0,)))], f"ca string, pos int, pair {scans.PAIR}")
    assert enrich.best_pair(rows).count() == 0


def test_read_token_responses(spark):
    body = '[{"baseToken":{"address":"a","name":"N","symbol":"S"},"info":{},"liquidity":{"usd":3}},{"baseToken":{"address":"a"}}]'
    got = one(enrich.best_pair(scans.read_token_pairs(spark.createDataFrame([("a", body)], "ca string, body string"))))
    assert (got["symbol"], got["name"], got["logo_url"]) == ("S", "N", None)
    asset = '{"content":{"metadata":{"name":" n "},"files":[{"mime":"image/png","uri":"https://f"}]},"token_info":{"symbol":"T","decimals":9}}'
    got = one(enrich.asset_identity(scans.read_assets(spark.createDataFrame([("a", asset)], "ca string, body string"))))
    assert tuple(got) == ("a", "T", "n", 9, "https://f")


def test_asof_without_earlier_price(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    f = spark.createDataFrame([(1, "a", t(0)), (2, "a", t(5)), (3, "a", t(80)), (4, "b", t(5))], "id int, s string, at timestamp")
    p = spark.createDataFrame([("a", t(5), 7), ("a", t(30), 8)], "s string, at timestamp, p int")
    assert {r["id"]: r["asof_price"] for r in repair.asof_price(f, p, "s", "at", "p").collect()} == {1: None, 2: 7, 3: 8, 4: None}


def test_repair_job_writes_only_zero_prices(spark):
    trades = spark.createDataFrame([("x", "s", 0, 0, 0, "devnet", None), ("x", "s", 0, 1, 5, "devnet", None)], "tx_signature string, slab_address string, asset_index int, leg_index int, price int, network string, created_at timestamp")
    prices = spark.createDataFrame([("x", "s", 0, 0), ("x", "s", 1, 9)], "tx_signature string, slab_address string, pos int, price int")
    assert sorted(r["price"] for r in jobs.repair_job(trades, prices, "devnet").collect()) == [5, 9]


def test_exact_volume_beyond_decimal(spark):
    big = 2**127 - 1
    df = spark.createDataFrame([("s", str(big), False), ("s", str(big), False)], "slab_address string, size_text string, is_liquidation boolean").withColumn("size", F.lit(1))
    assert one(rollup.exact_volume(df))["volume"] == str(2 * big)


def test_filters_reach_the_scan(spark, sf):
    plan = rollup.volume_24h_by_slab(fx(spark, sf), "devnet", F.expr("TIMESTAMP '2024-01-31 00:00:00'"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "props:" not in plan


def test_addresses_are_valid(spark):
    from fillforge.functions.binary import ADDRESS, SIGNATURE

    assert one(spark.range(1).select(address(F.lit("M05")).rlike(ADDRESS).alias("a"), address(F.lit("S10"), 64).rlike(SIGNATURE).alias("b"))) == (True, True)


def test_overflow_gives_null(spark):
    """Sums and products beyond their kind are NULL, never an error."""
    when = dt.datetime(2024, 1, 30, 12)
    schema = "slab_address string, trader string, size {0}, price {1}, network string, is_liquidation boolean, created_at timestamp, tx_signature string, asset_index int, leg_index int"
    markets = spark.createDataFrame([("M", 6)], "slab_address string, decimals int")
    as_of = F.lit(dt.datetime(2024, 1, 31))
    whole, places = decimal.Decimal(10) ** 37, decimal.Decimal(5000000)
    for kinds, size, price in ((("bigint", "bigint"), 9 * 10**18, 5), (("decimal(38,0)", "decimal(38,6)"), 9 * whole, places)):
        trades = spark.createDataFrame([("M", "T", size, price, "devnet", False, when, f"S{i}", 0, 0) for i in range(2)], schema.format(*kinds))
        assert [r["volume_24h"] for r in rollup.volume_24h_by_slab(trades, "devnet", as_of).collect()] == [None]
        assert [r["volume_24h_usd"] for r in rollup.volume_24h_usd(trades, markets, "devnet", as_of).collect()] == [None]
        assert [r["volume"] for r in rollup.candles(trades, "1 hour").collect()] == [None] == [r["volume"] for r in rollup.leaderboard(trades).collect()]
    exact = spark.createDataFrame([("M", "T", decimal.Decimal(10) ** 25, decimal.Decimal("2.5"), "devnet", False, when, "S", 0, 0)], schema.format("decimal(38,0)", "decimal(38,6)"))
    assert rollup.volume_24h_usd(exact, markets, "devnet", as_of).first()["volume_24h_usd"] == 2.5e19


def test_an_integer_is_read_few_times(spark, sf):
    """The bytes of a 128-bit number are turned round once for the filter and once for all columns made of it."""
    from fillforge.plans.market_queries import size_range

    plan = size_range(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reverse(") + plan.count("regexp_extract_all(") <= 20  # the fixture's own bytes included


def test_an_accounts_price_is_read_few_times(spark):
    accounts = spark.createDataFrame([(bytearray(range(26)),)], "bytes binary")
    layouts = spark.createDataFrame([(26, 10, 18)], "data_len int, engine_price_off int, config_price_off int")
    out = decode.mark_prices(accounts, layouts).where("mark_price is not null")
    assert out.count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("reverse(") <= 12  # 9 in the filter, which is moved below, and one for each place
