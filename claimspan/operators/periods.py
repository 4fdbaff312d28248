"""Date periods per key: overlaps counted without pairs, merged periods, and the period in force on a day.

A period has a start day and a last day; without a last day it is open. Periods without key or start, and those that
end before they start, are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Days are numbered from 0001-01-01, and all of them lie below 2^DAY_BITS.
DAY_BITS = 22
_FIRST_DAY = 719_162


def _day(col: str | Column) -> Column:
    return F.unix_date(F.col(col) if isinstance(col, str) else col) + _FIRST_DAY


def _date(number: Column) -> Column:
    return F.date_from_unix_date((number - _FIRST_DAY).cast("int"))


def _sane(periods: DataFrame, by: str, start: str, end: str) -> DataFrame:
    closed = F.col(end).isNull() | (F.col(end) >= F.col(start))
    return periods.filter(F.col(by).isNotNull() & F.col(start).isNotNull() & closed)


def _changes(periods: DataFrame, by: str, start: str, end: str) -> DataFrame:
    """Per key and day: periods that start, and periods whose last day was the day before.

    Folded inside each task first, so a key with very many periods is one row a calendar day afterwards.
    """
    opened = F.struct(_day(start).alias("day"), F.lit(1).alias("starts"), F.lit(0).alias("ended"))
    closed = F.struct((_day(end) + 1).alias("day"), F.lit(0).alias("starts"), F.lit(1).alias("ended"))
    events = _sane(periods, by, start, end).select(by, F.inline(F.array_compact(F.array(opened, F.when(F.col(end).isNotNull(), closed)))))
    return events.groupBy(by, "day").agg(F.sum("starts").alias("starts"), F.sum("ended").alias("ended"))


def overlap_counts(periods: DataFrame, by: str = "provider_id", start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Periods per key and how many pairs of them share a day.

    Two periods share no day if one has ended before the other starts. Of all n (n - 1) / 2 pairs those are taken off:
    for each start, the periods that ended before it.
    """
    so_far = Window.partitionBy(by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    wide = "decimal(38,0)"
    apart = F.col("starts").cast(wide) * F.sum("ended").over(so_far).cast("decimal(18,0)")
    counted = _changes(periods, by, start, end).select(by, "starts", apart.alias("apart"))
    total = counted.groupBy(by).agg(F.sum("starts").alias("n"), F.sum("apart").alias("apart"))
    n = F.col("n").cast("decimal(18,0)")
    pairs = (n * (n - 1) / 2).cast(wide) - F.col("apart").cast(wide)
    return total.select(by, F.col("n").alias("periods"), pairs.cast("bigint").alias("overlapping_pairs"))


def merged_periods(periods: DataFrame, by: str = "provider_id", start: str = "start_date", end: str = "end_date") -> DataFrame:
    """The longest stretches of days that periods of a key cover without a gap, and how many periods make each.

    Periods that follow each other day by day are one stretch; an open period leaves its stretch without an end.
    """
    in_order = Window.partitionBy(by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    open_now = F.sum(F.col("starts") - F.col("ended")).over(in_order)
    swept = _changes(periods, by, start, end).withColumn("open", open_now)
    begins = (F.col("open") - F.col("starts") + F.col("ended")) == 0
    stretches = swept.withColumn("stretch", F.count_if(begins).over(in_order)).groupBy(by, "stretch").agg(
        F.min("day").alias("first"), F.max(F.struct("day", "open")).alias("last"), F.sum("starts").alias("n")
    )
    last_day = F.when(F.col("last.open") == 0, _date(F.col("last.day") - 1))
    return stretches.select(by, _date(F.col("first")).alias("period_start"), last_day.alias("period_end"), F.col("n").alias("periods"))


def in_force_on(
    rows: DataFrame, periods: DataFrame, key: str, on: str, columns: Sequence[str],
    start: str = "start_date", end: str = "end_date", inclusive: bool = False,
) -> DataFrame:
    """``rows`` with ``columns`` of the period of their key that is in force on the day ``on``, or NULL.

    A period is in force from its start until the day before its end (``inclusive``: until its end); of several the one
    that started last counts, then the highest by ``columns``. Every row comes out once.

    Days are the leaves of a binary tree. A period covers at most two nodes a level, a day lies under one node a level,
    so the search is an equi join on key and node: no pair of a row and a period that does not hold is made. Periods
    fold to one per node, rows to one per day, so a hot key is bounded by the calendar on both sides.
    """
    if inclusive:
        last = F.col(end).isNull() | (F.col(end) >= F.col(start))
    else:
        last = F.col(end).isNull() | (F.col(end) > F.col(start))
    begin = _day(start)
    stop = F.coalesce(_day(end) + (1 if inclusive else 0), F.lit(1 << DAY_BITS))
    spans = periods.filter(F.col(key).isNotNull() & F.col(start).isNotNull() & last).select(
        key, F.struct(F.col(start), *[F.col(c) for c in columns]).alias("_own"), begin.alias("_from"), stop.alias("_to"),
        F.explode(F.sequence(F.lit(0), F.lit(DAY_BITS))).alias("_level"),
    )
    size = F.expr("shiftleft(1, _level)")
    spans = spans.withColumn("_a", F.ceil(F.col("_from") / size).cast("int")).withColumn("_b", F.floor(F.col("_to") / size).cast("int"))
    inside = F.col("_a") < F.col("_b")
    made = F.array_compact(F.array(
        F.when(inside & (F.col("_a") % 2 == 1), F.col("_a")), F.when(inside & (F.col("_b") % 2 == 1), F.col("_b") - 1),
    ))
    nodes = spans.select(key, "_level", F.explode(made).alias("_node"), "_own")
    nodes = nodes.groupBy(key, "_level", "_node").agg(F.max("_own").alias("_own"))
    days = rows.filter(F.col(key).isNotNull() & F.col(on).isNotNull()).select(key, F.col(on)).distinct()
    probes = days.select(key, on, F.explode(F.sequence(F.lit(0), F.lit(DAY_BITS))).alias("_level"))
    probes = probes.withColumn("_node", F.call_function("shiftright", _day(on), F.col("_level")))
    found = probes.join(nodes, [key, "_level", "_node"]).groupBy(key, on).agg(F.max("_own").alias("_own"))
    return rows.join(found, [key, on], "left").select(*rows.columns, *[F.col(f"_own.{c}").alias(c) for c in columns])
