"""Deliveries of raw transactions: parsing, validation and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSTRUCTION = "struct<programId:string,data:string,accounts:array<string>>"
TRANSACTION = f"struct<signature:string,transactionError:string,instructions:array<{INSTRUCTION}>,innerInstructions:array<struct<instructions:array<{INSTRUCTION}>>>,accountData:array<struct<account:string,data:string>>>"
POISON = ("__proto__", "constructor", "prototype")


def read_deliveries(raw: DataFrame, body: str = "body") -> DataFrame:
    """raw with `items`: the delivery as an array of VARIANT. A single object counts as a list of one; items is NULL for
    bad JSON."""
    parsed = raw.withColumn("_v", F.try_parse_json(F.trim(F.col(body))))
    return parsed.withColumn("items", F.expr("coalesce(try_variant_get(_v, '$', 'array<variant>'), case when _v is not null then array(_v) end)")).drop("_v")


def member(of: str, name: str) -> str:
    return f"try_variant_get({of}, '$.{name}', 'variant')"


def members(of: str, name: str) -> str:
    return f"try_variant_get({of}, '$.{name}', 'array<variant>')"


def text_or_missing(of: str, name: str) -> str:
    """SQL: the member is missing or text. JSON null is neither."""
    return f"coalesce(schema_of_variant({member(of, name)}) = 'STRING', true)"


def list_or_missing(of: str, name: str, each: str) -> str:
    """SQL: the member is missing, or a list of which each (a lambda) holds. JSON null is neither."""
    return f"({member(of, name)} is null or coalesce(forall({members(of, name)}, {each}), false))"


def clean_object(x: str) -> str:
    """SQL: x is an object (or array) without keys that poison prototypes. Only paths are looked up."""
    held = " or ".join(f"{member(x, key)} is not null" for key in POISON)
    return f"((try_variant_get({x}, '$', 'array<variant>') is not null or try_variant_get({x}, '$', 'map<string,variant>') is not null) and not ({held}))"


def good_instructions(x: str, var: str) -> str:
    accounts = list_or_missing(var, "accounts", "a -> coalesce(schema_of_variant(a) = 'STRING', false)")
    return list_or_missing(x, "instructions", f"{var} -> {clean_object(var)} and {text_or_missing(var, 'programId')} and {text_or_missing(var, 'data')} and {accounts}")


def good_transaction() -> str:
    inner = list_or_missing("tx", "innerInstructions", f"g -> {clean_object('g')} and {good_instructions('g', 'gi')}")
    data = list_or_missing("tx", "accountData", f"ad -> {clean_object('ad')} and {text_or_missing('ad', 'account')}")
    return f"{clean_object('tx')} and {text_or_missing('tx', 'signature')} and {good_instructions('tx', 'ix')} and {inner} and {data}"


def mark_deliveries(deliveries: DataFrame, most: int = 500) -> DataFrame:
    """deliveries with `reason`: NULL for valid ones, else bad_json, invalid_format or too_many. One bad transaction
    rejects its whole delivery. Types are judged on the VARIANT, as from_json would silently turn 5 into '5'."""
    return deliveries.withColumn("reason", F.expr(f"case when items is null then 'bad_json' when not forall(items, tx -> {good_transaction()}) then 'invalid_format' when size(items) > {most} then 'too_many' end"))


def validate_deliveries(deliveries: DataFrame, most: int = 500) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of mark_deliveries. A job that needs both writes the marked table once and splits what it reads."""
    marked = mark_deliveries(deliveries, most)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def transactions(valid: DataFrame) -> DataFrame:
    """One row per transaction of valid deliveries, in typed columns; other columns of the delivery stay."""
    rest = [c for c in valid.columns if c != "items"]
    typed = valid.select(*rest, F.explode(F.expr(f"from_json(to_json(items), 'array<{TRANSACTION}>')")).alias("tx"))
    return typed.select(*rest, "tx.*")


def stream_envelopes(raw: DataFrame, body: str = "value", programs: list[str] | None = None) -> DataFrame:
    """Notifications of successful transactions, if programs are given only those that name one of them among their
    account keys or instructions. Other methods and errors are left out; the signature stands at the top or is the first
    one of the transaction."""
    schema = "method string, params struct<result: struct<signature: string, transaction: struct<signatures: array<string>, message: struct<accountKeys: array<variant>, instructions: array<variant>>>, meta: struct<err: variant>>>"
    j = raw.withColumn("_j", F.from_json(body, schema)).where("_j.method = 'transactionNotification'").where("_j.params.result.meta.err is null or is_variant_null(_j.params.result.meta.err)")
    result = "_j.params.result"
    message = f"{result}.transaction.message"
    if programs is not None:
        keyed = F.exists(f"{message}.accountKeys", lambda k: normalize_pubkey(k).isin(programs))
        called = F.exists(f"{message}.instructions", lambda i: F.try_variant_get(i, "$.programId", "string").isin(programs))
        j = j.where(F.coalesce(keyed, F.lit(False)) | F.coalesce(called, F.lit(False)))
    return j.select(F.coalesce(f"{result}.signature", F.get(F.col(f"{result}.transaction.signatures"), F.lit(0))).alias("signature"), F.col(f"{message}.instructions").alias("instructions"))


def normalize_pubkey(value: Column) -> Column:
    """A key that is text, or an object with the text in `pubkey`; else NULL."""
    text = lambda path: F.when(F.schema_of_variant(F.try_variant_get(value, path, "variant")) == "STRING", F.try_variant_get(value, path, "string"))
    return F.coalesce(text("$.pubkey"), text("$"))
