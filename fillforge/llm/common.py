"""Shared pieces: tables in the cluster's shared folder, shipping of this package, connected components."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one where that is unset and Spark
    runs in one process (tests). A cluster without the setting is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='fillforge-')}"
        spark.sparkContext.setCheckpointDir(found)
    where = spark._jvm.org.apache.hadoop.fs.Path(found)
    whole = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return re.sub("^file:/+", "file:///", whole).rstrip("/")  # with its scheme, as Arrow would take a bare path as local


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: lineage ends there and survives lost executors.
    Once it is written, the shuffle files that it came from are of no use and go."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    left_behind.setdefault(spark.sparkContext.applicationId, []).append(path)
    return out


#: Paths of the tables that this process has staged, by application.
left_behind: dict[str, list[str]] = {}


def release(spark: SparkSession) -> int:
    """Deletes all tables that this application has staged so far, and returns their number. For callers whose results are
    written: DataFrames of this subpackage read such tables until then."""
    paths = left_behind.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def unstage(df: DataFrame) -> None:
    """Deletes the files of a staged table that no later plan reads."""
    spark, path = df.sparkSession, df.staged_path
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def wrapped(docs: DataFrame, **columns: str) -> DataFrame:
    """docs with all its columns in one struct _row, so that no name of theirs clashes with one of ours, and the named
    ones again beside it. unwrapped() gives the columns of docs back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def unwrapped(rows: DataFrame) -> DataFrame:
    return rows.select("_row.*")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that Python tasks can import it."""
    app = spark.sparkContext.applicationId
    if getattr(ship, "done", None) == app:
        return
    top = Path(__file__).resolve().parents[1]
    out = os.path.join(tempfile.mkdtemp(prefix="fillforge-"), "fillforge_code.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in top.rglob("*.py"):
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(out)
    ship.done = app


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    edges: columns a, b (long). Returns node, component (its smallest reachable node) for each node that has an edge
    to another one. Self-links and nulls are left out. Rounds go on until nothing changes, which takes them some
    log(nodes) ** 2 at most. Every round is a groupBy-min and a join on the node, so a hub
    meets partial aggregation and a join that Spark may split; each round's edges are written to the shared folder.
    """
    flat = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, before = staged(flat, "edges"), None
    while True:
        sign = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if sign == before or not sign["n"]:
            break
        before = sign
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(small_least.select("u", F.col("m").alias("v"))).distinct()
        after = staged(small, "edges")
        unstage(now)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
