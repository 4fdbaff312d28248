"""Pairs inside groups that may be very large."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows of one side that one join cell holds at most on average.
ROWS_PER_CELL = 4_000

#: Copies of a pair are written out in steps of this size.
COPIES_PER_STEP = 10_000


def fold_copies(df: DataFrame) -> DataFrame:
    """One row per distinct row and its number of ``_copies``."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))


def unfold_copies(df: DataFrame, copies: Column) -> DataFrame:
    """Repeat each row ``copies`` times, with only short arrays on the way."""
    steps = df.withColumn("_todo", copies).withColumn(
        "_step", F.explode(F.sequence(F.lit(0), F.expr(f"(_todo - 1) div {COPIES_PER_STEP}")))
    )
    left_over = F.col("_todo") - F.col("_step") * COPIES_PER_STEP
    return steps.withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(COPIES_PER_STEP), left_over).cast("int")))
    ).drop("_todo", "_step", "_copy")


def grid_join(left: DataFrame, right: DataFrame, keys: list[str], condition: Column, rows_per_cell: int) -> DataFrame:
    """Inner join on ``keys`` and ``condition``, with hot key groups cut into a grid of cells.

    Rows are counted per key on both sides. A key with n left and m right rows beyond
    ``rows_per_cell`` is split into ceil(n/r) x ceil(m/r) cells: each left row goes to one grid row
    (by hash of its values) and all its columns, each right row to one grid column and all its
    rows, so every pair meets in exactly one cell. Rows of a side must be distinct, otherwise
    copies share a cell; column names of the two sides must differ apart from ``keys``. The hot keys
    are a frame of the same plan, often an empty one; adaptive execution broadcasts or shuffles it.
    """
    left_counts = left.groupBy(*keys).agg(F.count("*").alias("_left_rows"))
    right_counts = right.groupBy(*keys).agg(F.count("*").alias("_right_rows"))
    hot = (
        left_counts.join(right_counts, keys)
        .filter((F.col("_left_rows") > rows_per_cell) | (F.col("_right_rows") > rows_per_cell))
        .select(
            *keys,
            F.ceil(F.col("_left_rows") / rows_per_cell).cast("int").alias("_grid_rows"),
            F.ceil(F.col("_right_rows") / rows_per_cell).cast("int").alias("_grid_columns"),
        )
    )

    def place(side: DataFrame, own: str, own_size: str, other: str, other_size: str) -> DataFrame:
        values = [c for c in side.columns if c not in keys]
        return (
            side.join(hot, keys, "left")
            .withColumn(own, F.pmod(F.xxhash64(*values), F.coalesce(own_size, F.lit(1))).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other_size, F.lit(1)) - 1)))
            .drop(own_size, other_size)
        )

    cells_left = place(left, "_cell_row", "_grid_rows", "_cell_column", "_grid_columns")
    cells_right = place(right, "_cell_column", "_grid_columns", "_cell_row", "_grid_rows")
    joined = cells_left.join(cells_right, [*keys, "_cell_row", "_cell_column"])
    return joined.filter(condition).drop("_cell_row", "_cell_column")


def pairs_within_days(df: DataFrame, keys: Sequence[str], date_col: str, days: int) -> DataFrame:
    """Number of row pairs at most ``days`` apart inside each key, without building a pair.

    Rows are first folded to one count per key and day; a range frame over those counts adds the
    partners on later days. A key has at most one row per calendar day at that point.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*keys, date_col]])
    per_day = (
        df.filter(present)
        .groupBy(*keys, F.unix_date(F.col(date_col)).alias("_day"))
        .agg(F.count("*").alias("_n"))
    )
    later = Window.partitionBy(*keys).orderBy("_day").rangeBetween(1, days)
    partners = F.coalesce(F.sum("_n").over(later), F.lit(0))
    # n(n-1)/2 on the same day + n * partners, doubled to stay whole; decimal so that it cannot overflow.
    n = F.col("_n").cast("decimal(18,0)")
    doubled = n * ((F.col("_n") - 1 + 2 * partners).cast("decimal(18,0)"))
    return per_day.select(doubled.alias("_pairs")).agg(
        F.coalesce(F.sum("_pairs") / 2, F.lit(0)).cast("decimal(38,0)").alias("pair_count")
    )
