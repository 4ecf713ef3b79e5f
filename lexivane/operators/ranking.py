"""Numbering rows in an order without bringing them into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexivane.storage import written


def numbered(df: DataFrame, order: list, name: str, start: int = 1) -> DataFrame:
    """df with consecutive numbers in `order`, which must tell all rows apart.

    Rows are range-partitioned and sorted; a row's number is its place in its partition
    plus the rows of the partitions before. Only a count per partition is summed over all.
    """
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    placed = written(placed.withColumn("__part", F.shiftright("__id", 33)).withColumn("__at", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).drop("__id"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    # A row per partition: bounded by the number of partitions, whatever the table's size.
    numbers = placed.join(F.broadcast(offsets), "__part")
    return numbers.withColumn(name, F.col("__before") + F.col("__at") + start).drop("__part", "__at", "__before")
