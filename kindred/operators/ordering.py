"""Places in a global order, without a window over the whole table.

The rows are range-partitioned and sorted, and each row's place inside its range is written down
once. Only one total per range is then needed to turn places into global ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import materialize

_PLACE_BITS = 33


def with_start(df: DataFrame, order: list[str], name: str, weight: str | None = None) -> DataFrame:
    """Add ``name``: the total weight of all rows that come before this one in ``order``.

    Without a weight every row counts one, so the result is the row's number from zero. ``order``
    should end in a unique column; rows equal in all of it are placed in no set order.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_place", _PLACE_BITS)),
        "order",
    )
    if weight is None:
        within = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
        total = F.count(F.lit(1))
    else:
        before = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        within = F.coalesce(F.sum(weight).over(before), F.lit(0))
        total = F.sum(weight)

    # One row per range: as many as there are shuffle partitions.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(total.alias("_total"))
        .select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_within", within)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, (F.col("_offset") + F.col("_within")).cast("long"))
        .drop("_range", "_place", "_within", "_offset")
    )


def row_numbers(df: DataFrame, order: list[str], name: str = "row") -> DataFrame:
    """Number the rows of ``df`` from zero in the given order."""
    return with_start(df, order, name)


def balanced_buckets(df: DataFrame, weight: str, buckets: int, tie: str) -> DataFrame:
    """Deal rows, lightest first, to ``buckets`` buckets in turn so that their loads are close."""
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    dealt = with_start(df, [weight, tie], "_turn")
    return dealt.withColumn("bucket", (F.col("_turn") % buckets).cast("int")).drop("_turn")


def bucket_loads(dealt: DataFrame, weight: str) -> DataFrame:
    """Total weight of each bucket."""
    return dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum(weight).alias("load"))


def load_spread(loads: DataFrame) -> DataFrame:
    """Heaviest bucket less the lightest."""
    return loads.agg((F.max("load") - F.min("load")).alias("spread"))


def by_work(setups: DataFrame) -> DataFrame:
    """Setups with their estimated work, least first."""
    work = F.col("k").cast("long") * F.col("max_iters")
    return setups.withColumn("work", work).orderBy("work", "run_id")
