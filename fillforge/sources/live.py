"""The live paths of raw transactions as one stream: pushed deliveries, notifications, and what is polled by signature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillforge.sources import deliveries

RPC_INSTRUCTION = "struct<programId:variant,data:string,accounts:array<variant>>"
RPC = f"struct<signature:string,transaction:struct<signatures:array<string>,message:struct<accountKeys:array<variant>,instructions:array<{RPC_INSTRUCTION}>>>,meta:struct<err:variant,innerInstructions:array<struct<index:int,instructions:array<{RPC_INSTRUCTION}>>>>,accountData:array<struct<account:string,data:string>>>"

COLUMNS = ["signature", "transactionError", "instructions", "innerInstructions", "accountData"]


def failed(err: Column) -> Column:
    """The error of a transaction as text, NULL for none (missing, or JSON null)."""
    return F.when(err.isNotNull() & ~F.is_variant_null(err), F.to_json(err))


def from_rpc(result: str) -> list[Column]:
    """The columns of a transaction from a column of kind RPC. Keys are text or objects with the text in `pubkey`; an
    instruction that the node has parsed carries no data and is passed over later; inner groups stand in the order of their
    instruction. Account data is not part of a response and is there only where a caller has put it in."""
    plain = lambda i: F.struct(deliveries.normalize_pubkey(i["programId"]).alias("programId"), i["data"].alias("data"), F.transform(i["accounts"], deliveries.normalize_pubkey).alias("accounts"))
    inner = F.transform(F.array_sort(F.transform(F.col(f"{result}.meta.innerInstructions"), lambda g: F.struct(g["index"].alias("index"), F.transform(g["instructions"], plain).alias("instructions")))), lambda g: F.struct(g["instructions"].alias("instructions")))
    return [
        F.coalesce(f"{result}.signature", F.get(F.col(f"{result}.transaction.signatures"), F.lit(0))).alias("signature"),
        failed(F.col(f"{result}.meta.err")).alias("transactionError"),
        F.transform(f"{result}.transaction.message.instructions", plain).alias("instructions"),
        F.coalesce(inner, F.array().cast(f"array<struct<instructions:array<{deliveries.INSTRUCTION}>>>")).alias("innerInstructions"),
        F.coalesce(f"{result}.accountData", F.array().cast("array<struct<account:string,data:string>>")).alias("accountData"),
    ]


def notified(raw: DataFrame, body: str = "body") -> DataFrame:
    """Transactions from notifications; messages of other methods, and such as are no JSON, go. Other columns stay."""
    rest = [c for c in raw.columns if c != body]
    parsed = raw.withColumn("_j", F.from_json(body, f"method string, params struct<result: {RPC}>")).where("_j.method = 'transactionNotification' and _j.params.result is not null")
    return parsed.select(*rest, *from_rpc("_j.params.result"))


def polled(raw: DataFrame, body: str = "body") -> DataFrame:
    """Transactions from responses to polls by signature (an answer's `result`); answers without one go."""
    rest = [c for c in raw.columns if c != body]
    parsed = raw.withColumn("_j", F.from_json(body, f"result {RPC}")).where("_j.result is not null")
    return parsed.select(*rest, *from_rpc("_j.result"))


def delivered(raw: DataFrame, body: str = "body", most: int = 500) -> DataFrame:
    """Transactions from valid deliveries; rejected ones go (mark_deliveries tells them)."""
    return deliveries.transactions(deliveries.validate_deliveries(deliveries.read_deliveries(raw, body), most)[0].drop(body))


def live_transactions(sources: dict[str, tuple[DataFrame, str]], time: str = "seen_at") -> DataFrame:
    """One stream of several: each with how far its rows may lag behind its newest (its watermark), and a transaction that
    comes by several of them, or more than once, passes once as far as it does so within its watermark (what comes later
    meets the keys of the target). sources: name -> (transactions with `time`, lag). Returns COLUMNS, time and path.

    The session's spark.sql.streaming.multipleWatermarkPolicy tells whether the stream's watermark is that of the slowest
    source (min: no row is dropped for another source's haste) or of the fastest (max: state goes sooner).
    """
    marked = [df.select(*COLUMNS, time, F.lit(name).alias("path")).withWatermark(time, lag) for name, (df, lag) in sources.items()]
    both = marked[0]
    for df in marked[1:]:
        both = both.unionByName(df)
    return both.dropDuplicatesWithinWatermark(["signature"])
