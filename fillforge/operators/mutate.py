"""Table mutations as functions (target, source) -> new target, and table constraints.

Nothing here writes: callers put the result into a new version folder and switch over.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TRADE_KEY = ["tx_signature", "asset_index", "leg_index"]


def trade_key(sig: str = "tx_signature", asset: str = "asset_index", leg: str = "leg_index") -> Column:
    return F.concat_ws("|", F.coalesce(F.col(sig), F.lit("")), F.col(asset).cast("string"), F.col(leg).cast("string"))


def to_trade_row(fills: DataFrame, network: str) -> DataFrame:
    """The columns of the trades table: is_liquidation defaults to false, created_at to event_time."""
    have = set(fills.columns)
    flag = F.coalesce("is_liquidation", F.lit(False)) if "is_liquidation" in have else F.lit(False)
    cols = ["slab_address", "trader", "side", "size", "size_text", "price", "fee", "tx_signature", "asset_index", "leg_index"]
    kept = [F.col(c) if c in have else F.lit(None).alias(c) for c in cols]
    time = F.coalesce(*[F.col(c) for c in ("created_at", "event_time") if c in have])
    return fills.select(*kept, flag.alias("is_liquidation"), F.lit(network).alias("network"), time.alias("created_at"))


def upsert_ignore(existing: DataFrame, batch: DataFrame, keys: list[str] = TRADE_KEY, order: list[str] | None = None) -> DataFrame:
    """The rows of batch that an insert which skips known keys would write. Of rows with one key in the batch one stays,
    the first by `order` (all other columns by default). A key with a NULL never conflicts."""
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    first = W.partitionBy(*keys).orderBy(*(order or [c for c in batch.columns if c not in keys] or keys))
    keyed = batch.where(whole).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return keyed.join(existing.select(*keys), keys, "left_anti").select(*batch.columns).union(batch.where(~whole))


#: What can become of a row that is to be inserted.
OUTCOMES = ("indexed", "skipped", "blocked", "failed")


def with_outcomes(rows: DataFrame, stored: DataFrame, keys: list[str] = TRADE_KEY) -> DataFrame:
    """rows (with the flags known and blocked) with `outcome`, as upsert_ignore treats them: blocked, failed (unknown
    market), skipped (key stored already, or not the first row of its key) or indexed. A key with a NULL never conflicts,
    so each of its rows is indexed; such rows and those that are not inserted are spread, not gathered by key."""
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    competes = whole & F.coalesce("known", F.lit(False)) & ~F.coalesce("blocked", F.lit(False))
    rest = [c for c in rows.columns if c not in keys]
    marked = rows.join(stored.select(*keys, F.lit(True).alias("_seen")).distinct(), keys, "left")
    marked = marked.withColumns({"_competes": competes, "_spread": F.when(~competes, F.xxhash64(*rows.columns))})
    first = F.row_number().over(W.partitionBy(*keys, "_spread").orderBy(*rest)) == 1
    outcome = F.when(F.col("blocked"), "blocked").when(~F.coalesce("known", F.lit(False)), "failed")
    outcome = outcome.when(F.col("_competes") & (F.col("_seen").isNotNull() | ~F.col("_first")), "skipped").otherwise("indexed")
    return marked.withColumn("_first", first).withColumn("outcome", outcome).select(*rows.columns, "outcome")


def upsert_partial(target: DataFrame, source: DataFrame, key: str, columns: list[str], missing: dict[str, object] | None = None) -> DataFrame:
    """target with `columns` taken from source where source has the key; other columns and rows stay, new keys come in.

    missing: values for `columns` in the rows of target that source does not have (default: they stay).
    """
    s = source.select(F.col(key), F.lit(True).alias("_s"), *[F.col(c).alias(f"_{c}") for c in columns])
    t = target.withColumn("_t", F.lit(True))
    both = t.join(s, key, "full_outer")
    out = []
    for c in target.columns:
        if c == key or c not in columns:
            out.append(F.col(c))
        else:
            old = F.lit(missing[c]) if missing and c in missing else F.col(c)
            out.append(F.when(F.col("_s"), F.col(f"_{c}")).otherwise(old).cast(target.schema[c].dataType).alias(c))
    return both.select(*out)


def fenced_update(target: DataFrame, patch: DataFrame, key: str, guard: Column) -> tuple[DataFrame, DataFrame]:
    """target with the non-key columns of patch where the guard (on target) still holds, and the keys so updated.

    A NULL in patch leaves the column as it is.
    """
    columns = [c for c in patch.columns if c != key]
    p = patch.select(F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns])
    held = target.withColumn("_ok", F.coalesce(guard, F.lit(False))).join(p, key, "left")
    hit = F.col("_ok") & F.col("_hit").isNotNull()
    new = held.select(*[F.when(hit, F.coalesce(f"_{c}", c)).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])
    return new, held.where(hit).select(key)


def retain_days(trades: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    return trades.where(F.col("created_at") >= as_of - F.make_dt_interval(F.lit(days)))


def reset_guessed_identity(markets: DataFrame) -> DataFrame:
    """Markets that got the collateral's symbol without an address of their own fall back to placeholders."""
    guessed = (F.col("metadata_source") == "auto") & F.col("mainnet_ca").isNull() & (F.col("symbol") == "SOL") & F.col("logo_url").isNull() & (F.col("network") == "devnet")
    guessed = F.coalesce(guessed, F.lit(False))
    name = F.concat(F.lit("Market "), F.left("slab_address", F.lit(8)))
    return markets.withColumns({"symbol": F.when(guessed, "UNKNOWN").otherwise(F.col("symbol")), "name": F.when(guessed, name).otherwise(F.col("name"))})


def repair_decimals(markets: DataFrame) -> DataFrame:
    """decimals outside 0..18 become 6; unknown ones stay unknown."""
    return markets.withColumn("decimals", F.when(~F.col("decimals").between(0, 18), 6).otherwise(F.col("decimals")).cast("int"))


def reset_corrupt_stats(stats: DataFrame, probes: list[str], reset: list[str], limit: float = 5e17) -> DataFrame:
    """Rows in which any of `probes` is above the limit get 0 in the `reset` columns."""
    bad = reduce(lambda a, b: a | b, (F.coalesce(F.col(c) > limit, F.lit(False)) for c in probes))
    return stats.withColumns({c: F.when(bad, 0).otherwise(F.col(c)).cast(stats.schema[c].dataType) for c in reset})


def cascade_delete(children: DataFrame, parents: DataFrame, key: str = "slab_address") -> DataFrame:
    """Children whose parent is still there."""
    return children.join(parents.select(key), key, "left_semi")


def differs(columns: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a | b, (~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns))


def touch_updated_at(old: DataFrame, new: DataFrame, key: str, as_of: Column, column: str = "updated_at") -> DataFrame:
    """new with `column` stamped in rows that differ from old; unchanged rows keep the old stamp."""
    columns = [c for c in new.columns if c not in (key, column)]
    both = new.alias("n").join(old.alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"), "left")
    stamp = F.when(F.col(f"o.{key}").isNull() | differs(columns, "n", "o"), as_of).otherwise(F.col(f"o.{column}"))
    return both.select(F.col(f"n.{key}"), *[F.col(f"n.{c}") for c in columns], stamp.alias(column))


def snapshot_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Change feed: op (INSERT, UPDATE, DELETE), key, and the whole rows before and after as structs."""
    columns = [c for c in new.columns if c != key]
    both = old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    op = F.when(F.col(f"o.{key}").isNull(), "INSERT").when(F.col(f"n.{key}").isNull(), "DELETE").when(differs(columns, "o", "n"), "UPDATE")
    row = lambda s: F.when(F.col(f"{s}.{key}").isNotNull(), F.struct(*[F.col(f"{s}.{c}").alias(c) for c in [key, *columns]]))
    return both.select(op.alias("op"), F.coalesce(f"o.{key}", f"n.{key}").alias(key), row("o").alias("old"), row("n").alias("new")).where("op is not null")


def guarded_swap(old: DataFrame, new: DataFrame) -> DataFrame:
    """The registry to switch to: new unless the scan came back empty."""
    return old if new.isEmpty() else new


def check_constraints(df: DataFrame, rules: dict[str, Column], key: list[str], references: dict[str, tuple[str, DataFrame, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, violations): violations hold the key columns and the name of each broken rule.

    As in a CHECK, a rule that is NULL passes. references: rule name -> (column, parent table, parent's column).
    """
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()], F.lit(None).cast("string")))
    marked = df.withColumn("_broken", broken)
    for name, (column, parent, parent_key) in (references or {}).items():
        known = parent.select(F.col(parent_key).alias("_p")).distinct()
        marked = marked.join(known, marked[column] == known["_p"], "left")
        miss = F.col(column).isNotNull() & F.col("_p").isNull()
        marked = marked.withColumn("_broken", F.when(miss, F.array_append("_broken", F.lit(name))).otherwise(F.col("_broken"))).drop("_p")
    valid = marked.where(F.size("_broken") == 0).select(*df.columns)
    return valid, marked.select(*key, F.explode("_broken").alias("rule"))


#: Rules of the markets table.
def market_rules() -> dict[str, Column]:
    return {
        "network": F.col("network").isin("devnet", "mainnet"),
        "status": F.col("status").isin("active", "paused", "closed"),
        "metadata_source": F.col("metadata_source").isin("auto", "manual"),
        "oracle_mode": F.col("oracle_mode").isin("admin", "hyperp", "pyth"),
        "hyperp_needs_pool": (F.col("oracle_mode") != "hyperp") | F.col("dex_pool_address").isNotNull(),
        "slab_not_null": F.col("slab_address").isNotNull(),
    }
