"""Ranks and row numbers that never put one whole partition key into one task.

A plain ``rank().over(partitionBy(k))`` sorts all rows of ``k`` in a single task. Here equal values
are folded first, every value gets an order-preserving integer code, and codes are cut into slots
of ``2**SLOT_BITS``. A window sorts inside one slot only; the rows of all slots before it come from
running sums over slot totals, taken level by level so that no window sees more than
``2**SLOT_BITS`` rows, however the values are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SLOT_BITS = 17


def _levels(code_bits: int) -> int:
    return max(1, -(-(code_bits - SLOT_BITS) // SLOT_BITS))


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def _sums_before(
    totals: DataFrame, by: Sequence[str], sums: Sequence[str], descending: bool, levels: int
) -> DataFrame:
    """Per (by, _slot): the sums over all slots that come earlier in the order, as ``_before_*``."""
    order = F.col("_slot").desc() if descending else F.col("_slot").asc()
    parent = F.shiftright("_slot", SLOT_BITS) if levels > 1 else F.lit(0)
    inside = Window.partitionBy(*by, "_parent").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = totals.withColumn("_parent", parent).select(
        *by, "_slot", "_parent", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"_before_{s}") for s in sums]
    )
    if levels == 1:
        return local.drop("_parent")
    parents = totals.groupBy(*by, parent.alias("_slot")).agg(*[F.sum(s).alias(s) for s in sums])
    outer = _sums_before(parents, by, sums, descending, levels - 1).select(
        *[F.col(k).alias(f"_outer_{k}") for k in by],
        F.col("_slot").alias("_outer_slot"),
        *[F.col(f"_before_{s}").alias(f"_outer_{s}") for s in sums],
    )
    same = _null_safe(local, outer, [*[(k, f"_outer_{k}") for k in by], ("_parent", "_outer_slot")])
    return local.join(outer, same).select(
        *by, "_slot", *[(F.col(f"_before_{s}") + F.col(f"_outer_{s}")).alias(f"_before_{s}") for s in sums]
    )


def rank_descending(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    code: Column,
    code_bits: int,
    rank: str | None = None,
    dense_rank: str | None = None,
) -> DataFrame:
    """Add RANK and/or DENSE_RANK of ``value``, highest first, inside each ``by`` group.

    ``code`` is a whole number of at most ``code_bits`` bits that never falls while ``value`` rises.
    """
    keys = [*by, value]
    slot = F.shiftright(code.cast("bigint"), SLOT_BITS).alias("_slot")
    distinct = df.groupBy(*keys, slot).agg(F.count("*").alias("_rows"))
    totals = distinct.groupBy(*by, "_slot").agg(F.sum("_rows").alias("_rows"), F.count("*").alias("_values"))
    before = _sums_before(totals, by, ["_rows", "_values"], True, _levels(code_bits)).select(
        *[F.col(k).alias(f"_before_{k}") for k in by],
        F.col("_slot").alias("_before_slot"),
        "_before__rows",
        "_before__values",
    )
    inside = Window.partitionBy(*by, "_slot").orderBy(F.col(value).desc())
    rows_inside = F.sum("_rows").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    same_slot = _null_safe(distinct, before, [*[(k, f"_before_{k}") for k in by], ("_slot", "_before_slot")])
    added = []
    if rank:
        added.append((F.col("_before__rows") + F.coalesce(rows_inside, F.lit(0)) + 1).cast("bigint").alias(rank))
    if dense_rank:
        added.append((F.col("_before__values") + F.row_number().over(inside)).cast("bigint").alias(dense_rank))
    ranked = distinct.join(before, same_slot).select(*[F.col(k).alias(f"_rank_{k}") for k in keys], *added)
    same_value = _null_safe(df, ranked, [(k, f"_rank_{k}") for k in keys])
    return df.join(ranked, same_value).drop(*[f"_rank_{k}" for k in keys])


def dense_numbers(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number rows 1..n in the order of a unique 64-bit integer key."""
    rows = df.withColumn("_slot", F.shiftright(F.col(key).cast("bigint"), SLOT_BITS))
    totals = rows.groupBy("_slot").agg(F.count("*").alias("_rows"))
    before = _sums_before(totals, [], ["_rows"], False, _levels(64)).withColumnRenamed("_slot", "_before_slot")
    inside = Window.partitionBy("_slot").orderBy(key)
    return (
        rows.join(before, F.col("_slot") == F.col("_before_slot"))
        .withColumn(name, (F.col("_before__rows") + F.row_number().over(inside)).cast("bigint"))
        .drop("_slot", "_before_slot", "_before__rows")
    )
