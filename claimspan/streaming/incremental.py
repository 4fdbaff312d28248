"""Control-table loads and re-delivery handling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimspan.operators import versions
from claimspan.operators.etl import latest_rows
from claimspan.operators.id_index import IdIndex
from claimspan.session import beside, remove_dir, scratch_dir
from claimspan.sources.readers import path_exists


@dataclass(frozen=True)
class Increment:
    rows: DataFrame
    watermark: date | None
    previous: date | None


@dataclass(frozen=True)
class IncrementalRun:
    loaded: int
    watermark: date | None
    previous: date | None


def load_since(
    source: DataFrame, watermark: date | None, date_col: str, tie: tuple[str, int] | None = None
) -> Increment:
    """Rows newer than the watermark up to the newest date seen now, and that date.

    The upper bound is fixed before the rows are read, so rows that arrive in between wait for the
    next run. ``tie`` = (id column, last loaded id) also takes rows of the watermark day with a
    higher id. Without newer rows the watermark stays as it was.
    """
    day = F.col(date_col)
    newer = F.lit(True) if watermark is None else day > F.lit(watermark)
    if tie is not None and watermark is not None:
        newer = newer | ((day == F.lit(watermark)) & (F.col(tie[0]) > tie[1]))
    newest = source.filter(newer).agg(F.max(day)).first()[0]
    if newest is None:
        return Increment(source.filter(F.lit(False)), watermark, watermark)
    return Increment(source.filter(newer & (day <= F.lit(newest))), newest, watermark)


def read_watermark(spark: SparkSession, path: str) -> date | None:
    """The newest date of the control table, or None before the first run."""
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).agg(F.max("last_loaded_date")).first()[0]


def write_watermark(spark: SparkSession, path: str, value: date) -> None:
    """Append the new date; the highest one counts, so a failed write never loses the old one."""
    spark.createDataFrame([(value,)], "last_loaded_date date").coalesce(1).write.mode("append").parquet(path)


def dedupe_append(
    target: DataFrame, batch: DataFrame, key: str | Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Rows of the batch to append: one per key, none whose key the target already holds."""
    keys = [key] if isinstance(key, str) else list(key)
    survivors = latest_rows(batch, keys, list(order))
    return survivors.join(target.select(*keys), keys, "left_anti")


def run_incremental(
    spark: SparkSession, source: DataFrame, target: str, control: str, date_col: str, key: str
) -> IncrementalRun:
    """One scheduled run: load from the watermark on, drop re-delivered keys, append, move the watermark.

    Rows of the watermark day are read again, since more of them may have arrived, and so are rows without
    a date, which no watermark covers; the key test keeps what the target holds from being appended twice.
    The newest date is fixed before the rows are read, and the watermark moves last, so a run that stops
    can be repeated.
    """
    watermark = read_watermark(spark, control)
    day = F.col(date_col)
    due = F.lit(True) if watermark is None else (day >= F.lit(watermark))
    newest = source.filter(due).agg(F.max(day)).first()[0] or watermark
    seen = F.lit(False) if newest is None else (day <= F.lit(newest))
    rows = latest_rows(source.filter((due & seen) | day.isNull()), [key], [date_col])
    if path_exists(spark, target):
        rows = dedupe_append(spark.read.parquet(target), rows, key, [date_col])
    staged = scratch_dir(spark, "increment", beside(target))
    try:
        rows.write.parquet(staged)
        rows = spark.read.schema(source.schema).parquet(staged)
        loaded = rows.count()
        if loaded:
            rows.write.mode("append").parquet(target)
    finally:
        remove_dir(spark, staged)
    if newest is not None and newest != watermark:
        write_watermark(spark, control, newest)
    return IncrementalRun(loaded, newest, watermark)


def day_digests(df: DataFrame, date_col: str, key: str) -> DataFrame:
    """Rows per day and a digest of their keys that does not depend on the order; folded inside each task.

    Reads two columns. The digest is a sum of hashes, so a key that is delivered twice changes it.
    """
    return df.groupBy(F.col(date_col).alias("day")).agg(
        F.count("*").alias("n"), F.sum(F.xxhash64(key).cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest")
    )


@dataclass(frozen=True)
class LateRun:
    loaded: int
    days: list[date | None]


def load_late_days(spark: SparkSession, source: DataFrame, target: str, days_store: str, date_col: str, key: str) -> LateRun:
    """Load what has arrived for any day, however early, and read only the days that have changed.

    The store at ``days_store`` keeps number and digest of the keys of each day as they were when the day was last
    loaded into ``target``. Days whose number or digest in the source differ, and new days, are read whole; the key
    test against the target's id index appends only what is missing. The digests are stored last, so a run that stops
    is repeated. Rows without a date are a day of their own.
    """
    with versions.change(spark, days_store) as change:
        change.replace("now", day_digests(source, date_col, key))
        now = change.read("now")
        if "days" in change.tables:
            before = change.read("days").alias("b")
            same = F.col("n.day").eqNullSafe(F.col("b.day")) & (F.col("n.n") == F.col("b.n")) & (F.col("n.digest") == F.col("b.digest"))
            changed = now.alias("n").join(before, same, "left_anti").select("n.day")
        else:
            changed = now.select("day")
        days = [r.day for r in changed.collect()]  # calendar days
        loaded = _append_days(spark, source, target, date_col, key, days) if days else 0
        change.rename("now", "days")
    return LateRun(loaded, sorted(days, key=str))


def _append_days(spark: SparkSession, source: DataFrame, target: str, date_col: str, key: str, days: list) -> int:
    dated = [d for d in days if d is not None]
    due = F.col(date_col).isin(dated) if dated else F.lit(False)
    if None in days:
        due = due | F.col(date_col).isNull()
    index = IdIndex(spark, f"{target.rstrip('/')}_ids")
    index.recover(spark.read.parquet(target).select(key) if path_exists(spark, target) else None)
    staged = scratch_dir(spark, "late-days", beside(target))
    try:
        latest_rows(source.filter(due), [key], [date_col]).write.parquet(f"{staged}/read")
        read = spark.read.schema(source.schema).parquet(f"{staged}/read")
        held = index.candidates(read.select(key)).withColumnRenamed("id", key)
        read.join(held, key, "left_anti").select(*source.columns).write.parquet(f"{staged}/fresh")
        fresh = spark.read.schema(source.schema).parquet(f"{staged}/fresh")
        loaded = fresh.count()
        if loaded:
            index.begin(fresh.select(key))
            fresh.write.mode("append").parquet(target)
            index.finish()
    finally:
        remove_dir(spark, staged)
    return loaded
