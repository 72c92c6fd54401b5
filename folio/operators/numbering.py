"""Running numbers (E1) that stay distributed when one group is huge.

``row_number() over (partition by g order by o)`` puts a whole group into one
task.  ``ordinal`` instead range-partitions on (g, o) and sorts each partition:
a row's place in its partition less the place of its group's first row there is
its local number, and the sizes of the group's slices (one row per task and
group) become offsets.  A group that holds a third of all rows is spread over a
third of the tasks.  The sliced rows are checkpointed to the shared checkpoint
folder once, so the slice sizes and the rows they number are the same data even
if a task is re-run; the rows are shuffled once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.session import checkpoint_dir

BROADCAST_SLICES = 100_000  # slice sizes are broadcast up to this many rows, joined by shuffle beyond


def ordinal(df: DataFrame, group_cols: list[str], order_cols: list[str], name: str = "n", base: int = 0) -> DataFrame:
    """Add ``name`` = position of the row inside its group under ``order_cols`` (+ base).

    ``order_cols`` should make the order total inside a group; ties are
    numbered in an arbitrary but consistent order.
    """
    g = list(group_cols)
    keys = g + list(order_cols)
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_dir(df.sparkSession)
    # the id holds the partition (above bit 33) and the place in it; both are stored (reliable checkpoint)
    sliced = df.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    sliced = sliced.withColumn("_slice", F.shiftright("_id", 33)).withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = sliced.groupBy("_slice", *g).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*g).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1) if g else Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first") + base).alias("_shift")
    offsets = sizes.select("_slice", *g, shift)
    if sizes.count() <= BROADCAST_SLICES:
        offsets = F.broadcast(offsets)
    same = reduce(lambda a, c: a & F.col(f"l.{c}").eqNullSafe(F.col(f"o.{c}")), g, F.col("l._slice") == F.col("o._slice"))
    out = sliced.alias("l").join(offsets.alias("o"), same).select("l.*", "o._shift")  # a null group is a group
    return out.withColumn(name, (F.col("_place") + F.col("_shift")).cast("long")).drop("_id", "_slice", "_place", "_shift")
