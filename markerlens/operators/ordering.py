"""Order-dependent building blocks without a single-partition window.

``contiguous_index`` (DED-5) and ``exclusive_prefix_sum`` (AGG-10, AGG-12) both work in two
levels: the rows are range-partitioned and sorted on the order column, each partition
computes its local part, and a table with one row per *partition* (a bound fixed by the
partition count, never by the data) carries the offsets back by broadcast join.
The sorted frame is checkpointed to the shared checkpoint folder first, so both passes see
the same partitioning even if an executor is lost and a stage recomputes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from markerlens.session import checkpointed

_PID = "_ml_pid"
_LOCAL = "_ml_local"
_OFF = "_ml_off"


def _sorted_checkpoint(df: DataFrame, order_cols: list[str], partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    return checkpointed(ordered.withColumn(_PID, F.spark_partition_id()))


def _partition_offsets(per_pid: DataFrame, value: str) -> DataFrame:
    # One row per partition: the window runs over at most `partitions` rows.
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return per_pid.select(_PID, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long").alias(_OFF))


def contiguous_index(df: DataFrame, order_cols: list[str] | str, name: str = "id",
                     partitions: int | None = None) -> DataFrame:
    """DED-5: number rows 0..n-1 in ``order_cols`` order (order columns must be unique)."""
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    base = _sorted_checkpoint(df, cols, partitions)
    # monotonically_increasing_id = (partition id << 33) + row position within the partition.
    local = base.withColumn(_LOCAL, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
    counts = local.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    offsets = _partition_offsets(counts, "_n")
    out = local.join(F.broadcast(offsets), _PID, "left")
    return out.withColumn(name, (F.col(_OFF) + F.col(_LOCAL)).cast("long")).drop(_PID, _LOCAL, _OFF)


def exclusive_prefix_sum(df: DataFrame, order_cols: list[str] | str, value: str,
                         name: str = "before", partitions: int | None = None) -> DataFrame:
    """Sum of ``value`` over all rows strictly before each row in ``order_cols`` order."""
    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    base = _sorted_checkpoint(df, cols, partitions)
    # Within one partition: a window keyed by the partition id of a frame that is already
    # partitioned and sorted; AQE keeps it local to the partition's rows.
    w_local = Window.partitionBy(_PID).orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    local = base.withColumn(_LOCAL, F.coalesce(F.sum(value).over(w_local), F.lit(0)))
    totals = base.groupBy(_PID).agg(F.sum(value).alias("_t"))
    offsets = _partition_offsets(totals, "_t")
    out = local.join(F.broadcast(offsets), _PID, "left")
    return out.withColumn(name, (F.col(_OFF) + F.col(_LOCAL)).cast("long")).drop(_PID, _LOCAL, _OFF)


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row (broadcast; size is one row)."""
    return df.join(F.broadcast(scalars), how="left", on=F.lit(True))
