"""Global row index and prefix sums without a single-partition sort.

``Window.orderBy`` without ``partitionBy`` moves every row into one task.  Here
rows are range-partitioned on the order key and sorted inside each partition;
each row's partition number and position are written with it to a parquet
table under the shared checkpoint folder, so the per-partition sums and the
id assignment read the very same values (and a lost executor re-reads the
table instead of re-sampling range bounds).  Per-partition sums (one row per
partition) become exclusive prefix sums that are joined back.

The number of range partitions is Spark's own (``spark.sql.shuffle.partitions``
or AQE's initial number), so AQE may coalesce small ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.session import stored


def _order(cols) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.col(c).asc_nulls_first() if isinstance(c, str) else c)
    return out


def _ranged(df: DataFrame, order_cols: list) -> DataFrame:
    """``df`` in range partitions, with ``_pid`` and the position ``_pos`` in it, written down."""
    keys = _order(order_cols)
    pid = F.spark_partition_id()
    tagged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "*", pid.alias("_pid"), (F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)).alias("_pos"))
    return stored(tagged, "row-index")


def _offsets(sums: DataFrame) -> DataFrame:
    """(_pid, _n) -> (_pid, _off): sums of the partitions before (one row per range partition)."""
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))


def with_row_index(df: DataFrame, order_cols: list, name: str = "delivery_id", offset: int = 1) -> DataFrame:
    """Append ``name`` = offset, offset+1, ... following ``order_cols``.

    Rows that tie on every order column get consecutive ids in an unspecified
    order; order by a total key (or by all columns) for reproducible ids.
    """
    rows = _ranged(df, order_cols)
    counts = rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # as many rows as range partitions: bounded by the session's partition number
    out = rows.join(F.broadcast(_offsets(counts)), "_pid")
    idx = (F.col("_off") + F.col("_pos") + F.lit(offset)).cast("bigint").alias(name)
    return out.select(idx, *[F.col(f"`{c}`") for c in df.columns])


def running_offsets(df: DataFrame, order_cols: list, weight: str, name: str, first: int = 1) -> DataFrame:
    """Append ``name`` = first + sum of ``weight`` over the rows before, following ``order_cols``."""
    rows = _ranged(df, order_cols)
    sums = rows.groupBy("_pid").agg(F.sum(weight).alias("_n"))
    inside = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("_in", F.coalesce(F.sum(weight).over(inside), F.lit(0))).join(F.broadcast(_offsets(sums)), "_pid")
    start = (F.col("_off") + F.col("_in") + F.lit(first)).cast("bigint").alias(name)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], start)


def surrogate_keys(df: DataFrame, order_cols: list, name: str) -> DataFrame:
    """row_number() over a global order, as bigint: 1..N without gaps."""
    return with_row_index(df, order_cols, name=name).select(*[F.col(f"`{c}`") for c in df.columns], name)
