"""Salting for joins that reuse one partitioning.

Plain joins are left to AQE, which broadcasts by size and splits skewed
sort-merge partitions.  The role joins share one explicit partitioning on the
match, which AQE does not split, and a match may hold a large share of the
rows.  Hot keys are found with a partial aggregate and written down, so that
Spark knows their size when it joins them back; at most
``total / rows_per_task`` keys can exceed ``rows_per_task`` rows.  Rows of a
hot key are spread over ``ceil(rows / rows_per_task)`` salts on the big side,
and the matching rows of the other side are copied once per salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.session import stored

# Rows one task should handle for a single key before it is split.
DEFAULT_ROWS_PER_TASK = 2_000_000

SALT = "_salt"


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int = DEFAULT_ROWS_PER_TASK, weight: str | None = None,
             least: int | None = None) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows (or ``least``, if that is
    smaller) and the number of salts each needs; with ``weight``, a row of
    ``df`` stands for so many rows."""
    counts = df.groupBy(*keys).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_rows"))
    return stored(counts.filter(F.col("_rows") > min(rows_per_task, least or rows_per_task))
                  .select(*keys, F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int").alias("_salts")), "hot-keys")


def salt_big_side(df: DataFrame, hot: DataFrame, keys: list[str], spread_cols: list[str],
                  null_spread: int | None = None) -> DataFrame:
    """Add ``_salt``: 0 for normal keys, hash(spread_cols) mod salts for hot ones.

    Rows with a null key can never match, so they are spread over
    ``null_spread`` salts as well (a null ``player_out`` on most balls would
    otherwise land in one shuffle partition).
    """
    joined = df.join(hot, keys, "left")
    spread = F.xxhash64(*[F.col(c) for c in spread_cols])
    n_null = null_spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    salt = (F.when(any_null, F.pmod(spread, F.lit(n_null)))
            .when(F.col("_salts").isNull(), F.lit(0))
            .otherwise(F.pmod(spread, F.col("_salts")))).cast("int")
    return joined.withColumn(SALT, salt).drop("_salts")


def salt_small_side(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Copy rows of hot keys once per salt; other rows get salt 0."""
    joined = df.join(hot, keys, "left")
    n = F.coalesce(F.col("_salts"), F.lit(1))
    return joined.withColumn(SALT, F.explode(F.sequence(F.lit(0), n - 1))).drop("_salts")
