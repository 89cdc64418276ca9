"""A table of batches in which each key is stored once, and a batch reads only the parts that may hold its keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillforge.operators.mutate import TRADE_KEY
from fillforge.sources.files import Folder

BITS = 32768  # of a Bloom filter: what one bitmap of Spark's bitmap functions holds
HASHES = 4  # bits that a key sets


class KeyedTarget:
    """Rows below rows/batch=<n>/<parts>/bucket=<b>, where b comes from the key's hash, and for each bucket of each batch a
    Bloom filter of its keys in index/batch=<n>.

    A batch tests its keys against the filters of their buckets and reads the (batch, bucket) folders that may hold one of
    them, by partition filters; where keys are new, it reads next to nothing, however large the table is. The index takes
    up to 4 KB per bucket and batch. With up to BITS / 64 keys in a bucket of a batch, a filter says yes to a key that is
    not there in less than 2 of 10,000 cases; buckets should be chosen by that. A batch that is run again replaces its own
    folders and nothing else. parts: columns of low cardinality that become folders too, such as the network.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str] = TRADE_KEY, buckets: int = 64, parts: tuple[str, ...] = ()):
        self.spark, self.folder, self.keys, self.buckets, self.parts = spark, Folder(spark, path), keys, buckets, list(parts)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def bits(self) -> Column:
        """The places that a key has in its bucket's filter."""
        return F.array(*[F.pmod(F.xxhash64(*self.keys, F.lit(i)), F.lit(BITS)) for i in range(1, HASHES + 1)])

    def whole(self) -> Column:
        return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in self.keys))

    def batches(self) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in self.folder.names("index"))

    def read(self, before: int | None = None) -> DataFrame:
        """All stored rows, of batches before a number if it is given, with the folders' columns."""
        return self.of([n for n in self.batches() if before is None or n < before])

    def of(self, batches: list[int]) -> DataFrame:
        base = f"{self.folder.path}/rows"
        schema = T.StructType.fromJson(self.folder.read("schema")).add("batch", T.LongType()).add("bucket", T.IntegerType())
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/batch={n}" for n in batches])

    def touched(self, rows: DataFrame, before: int) -> list[tuple[int, int]]:
        """(batch, bucket) of all earlier folders that may hold a key of rows."""
        earlier = [n for n in self.batches() if n < before]
        if not earlier:
            return []
        base = f"{self.folder.path}/index"
        index = self.spark.read.option("basePath", base).parquet(*[f"{base}/batch={n}" for n in earlier])
        probes = rows.where(self.whole()).select(self.bucket().alias("bucket"), self.bits().alias("places")).distinct()
        byte = lambda p: F.conv(F.hex(F.substring(F.col("bits"), (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_set = F.forall("places", lambda p: F.floor(byte(p) / F.pow(F.lit(2), p % 8)) % 2 == 1)
        hits = probes.join(index, "bucket").where(is_set).select("batch", "bucket").distinct()
        return sorted((r["batch"], r["bucket"]) for r in hits.collect())  # at most one per folder of the table

    def stored_keys(self, rows: DataFrame, before: int) -> DataFrame:
        """The keys of earlier batches, from the folders that may hold a key of rows only."""
        touched = self.touched(rows, before)
        if not touched:
            return rows.select(*self.keys).limit(0)
        of_batch: dict[int, list[int]] = {}
        for n, b in touched:
            of_batch.setdefault(n, []).append(b)
        alike: dict[tuple[int, ...], list[int]] = {}
        for n, bs in of_batch.items():
            alike.setdefault(tuple(bs), []).append(n)
        picked = reduce(lambda a, b: a | b, (F.col("batch").isin(ns) & F.col("bucket").isin(list(bs)) for bs, ns in alike.items()))
        return self.of(sorted(of_batch)).where(picked).select(*self.keys)

    def write(self, rows: DataFrame, number: int) -> None:
        """Stores rows, whose keys are new, as a batch; the index comes last, so a batch without one is not there."""
        where = f"{self.folder.path}/rows/batch={number}"
        self.folder.write("schema", rows.schema.jsonValue(), replace=True)
        self.folder.delete(f"index/batch={number}")
        rows.withColumn("bucket", self.bucket()).write.mode("overwrite").partitionBy(*self.parts, "bucket").parquet(where)
        places = self.of([number]).where(self.whole()).select("bucket", F.explode(self.bits()).alias("place"))
        places.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")).write.mode("overwrite").parquet(f"{self.folder.path}/index/batch={number}")
