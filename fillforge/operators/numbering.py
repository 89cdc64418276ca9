"""Row numbers over a whole table without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: monotonically_increasing_id() counts rows from 0 in each partition, whose number stands above these bits.
LOCAL_BITS = 33


def numbered(df: DataFrame, order: list[Column | str], path: str, column: str = "n") -> DataFrame:
    """df with the place of each row in the given order, from 0, in `column`.

    Rows are dealt by ranges of the order, so a partition holds about as many as any other, sorted there and written to
    path with their place within it. The partitions' sizes, one row each, are added up; a row's number is its place and the
    rows of all partitions before. Rows that are equal in the order are numbered in no fixed order, but once for all.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt.withColumn("_id", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_id", LOCAL_BITS))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = sizes.select("_part", (F.sum("_rows").over(W.orderBy("_part")) - F.col("_rows")).alias("_before"))
    place = F.col("_id").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
    return rows.join(F.broadcast(before), "_part").withColumn(column, F.col("_before") + place).select(*df.columns, column)
