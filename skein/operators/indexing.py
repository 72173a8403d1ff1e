"""Dense 0..n-1 index in a given order, without funnelling rows into one task.

A global ``row_number()`` window moves every row into one partition. Instead:

1. range-partition on the order key (sampled bounds, so a repeated key value does
   not make one partition huge) and sort within partitions;
2. tag rows with ``monotonically_increasing_id`` (partition id in the upper bits,
   row number in the partition in the lower 33 bits) and checkpoint, so that
   partition boundaries and row numbers stay fixed even if executors are lost;
3. count rows per partition and join the prefix sums of earlier partitions back
   on: a table of one row per partition, which Spark broadcasts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.rows import as_col
from skein.session import cut_lineage

_LOW_BITS = 33


def dense_index(df: DataFrame, order, name: str = "index",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order`` (ties broken
    arbitrarily but consistently; pass a unique order for a unique answer)."""
    order_cols = [as_col(c) for c in (order if isinstance(order, (list, tuple)) else [order])]
    spark = df.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(n_parts, *order_cols)
               .sortWithinPartitions(*order_cols)
               .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = cut_lineage(ordered)
    tagged = ordered.withColumn("_part", F.shiftright(F.col("_mid"), _LOW_BITS))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a running sum over them stays small
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_part").alias("_of"),
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    return (tagged.join(F.broadcast(offsets), F.col("_part") == F.col("_of"))
            .withColumn(name, F.col("_offset") + local).drop("_mid", "_part", "_of", "_offset"))
