"""Global 1..N numbering without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY k)`` would pull every row into one task. Here
rows are range-partitioned on the order key and sorted inside each
partition; each row's position is its partition's offset (a running sum over
one count per partition, so bounded by the partition count) plus its
position inside the partition. The order key must be a total order.

The range-partitioned rows are reliably checkpointed before they are counted
and numbered, so both uses read the very same partitions (one shuffle, one
set of range bounds), and a lost executor cannot make them disagree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PID, _MID, _OFF, _CNT = "_part_id", "_part_pos", "_part_off", "_part_cnt"


def with_global_ordinal(df: DataFrame, order_by: list, out_col: str, start=1,
                        num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = start + 0-based position of the row in ``order_by`` order.

    ``start`` is an int or a Column (e.g. max existing code + 1)."""
    ensure_checkpoint_dir(df.sparkSession)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    # without an explicit count, AQE may merge adjacent ranges (order is kept,
    # and partition ids are taken after the merge)
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    tagged = (ranged
              .sortWithinPartitions(*order)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id())
              .checkpoint(eager=True))
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    start_col: Column = start if isinstance(start, Column) else F.lit(start)
    # one row per partition: a broadcast whose size is bounded by the partition count
    return (tagged.join(F.broadcast(offsets), _PID)
            .withColumn(out_col, (start_col + F.col(_OFF)
                                  + (F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)))
                        .cast("bigint"))
            .drop(_PID, _MID, _OFF))
