"""Running numbers over a whole table without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintwell.operators.scratch import staged


def numbered(df: DataFrame, order: list[str], to: str = "number") -> DataFrame:
    """df with a number from 1 in the given order, which should be total.

    Rows are dealt by ranges of the order and numbered within each range; only the ranges' row counts, one per partition,
    are summed up in one place.
    """
    dealt = staged(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_local", local).join(F.broadcast(before), "_part").select(*df.columns, (F.col("_before") + F.col("_local")).alias(to))
