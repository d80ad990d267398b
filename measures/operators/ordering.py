"""O1/O2 made visible: the place of each row in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measures.session import scratch_dir


def with_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """df with each row's place (from 1) in the order.  `order` should end in a
    unique key.

    Rows are sorted by ranges, a range per task, and written once; a row's
    place is its place in its range plus the rows of the ranges before.  One
    count per range is all that meets, and no task sees more than its range."""
    spark = df.sparkSession
    path = scratch_dir(spark, "ordered")
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id counts rows within a task, in order, and holds the task's number.
    sorted_.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_range", F.shiftright("_row", 33))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.alias("a").join(F.broadcast(sizes.alias("b")), F.expr("b._range < a._range"),
                                   "left").groupBy("a._range").agg(
        F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before"))
    within = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (rows.join(F.broadcast(before), "_range")
            .withColumn(name, within + F.col("_before")).drop("_row", "_range", "_before"))
