"""A daily summary with event-time watermark, state store and a side table of late rows.

Two streams, one behind the other. The first parts rows at the watermark: what is older than the latest event time of
all batches before, less the allowed delay, is late and goes to a side table; the rest goes on. The second aggregates
per day and group in Spark's state store, in update mode, and merges the groups that a batch has changed into the
result by key. Its own watermark follows from the same rows and never passes that of the first stream, so no row that
was on time there is dropped here, and state of days behind the watermark is given up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimspan.functions.measures import money
from claimspan.operators import versions
from claimspan.sources.readers import path_exists

ON_TIME, LATE, SEEN = "on-time", "late", "seen"
RESULT = "summary"


def part_late_rows(stream: DataFrame, event_time: str, delay: str, work: str) -> None:
    """Write the rows of all files that have arrived below ``work``: ``on-time``, ``late``, and ``seen`` (the latest
    event time so far), in a folder per batch, which a batch that runs again replaces. Rows without event time are late."""
    spark = stream.sparkSession

    def part(batch: DataFrame, number: int) -> None:
        latest = spark.read.parquet(f"{work}/{SEEN}/batch-{number - 1}").first()[0] if number else None
        mark = F.lit(latest) - F.expr(f"interval {delay}") if latest is not None else F.lit(None).cast("timestamp")
        marked = batch.withColumn("_late", F.col(event_time).isNull() | F.coalesce(F.col(event_time) < mark, F.lit(False)))
        staged = f"{work}/batch"
        marked.write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(marked.schema).parquet(staged)
        for name, wanted in ((LATE, F.col("_late")), (ON_TIME, ~F.col("_late"))):
            rows.filter(wanted).drop("_late").write.mode("overwrite").parquet(f"{work}/{name}/batch-{number}")
        so_far = F.greatest(F.max(event_time), F.lit(latest).cast("timestamp")).alias("latest")
        rows.filter(~F.col("_late")).agg(so_far).write.mode("overwrite").parquet(f"{work}/{SEEN}/batch-{number}")

    query = stream.writeStream.foreachBatch(part).option("checkpointLocation", f"{work}/checkpoint-parting").trigger(availableNow=True)
    query.start().awaitTermination()


def merge_daily_summary(stream: DataFrame, store: str, checkpoint: str, event_time: str, delay: str, by: str, amount: str) -> None:
    """Count and amount per day and group of all rows that have arrived, merged into the result by key.

    A batch hands over only the groups it has changed, with their whole totals, so one that runs again does no harm.
    """
    spark = stream.sparkSession
    day = F.window(event_time, "1 day")
    totals = stream.withWatermark(event_time, delay).groupBy(day.alias("day"), by).agg(
        F.count("*").alias("claim_count"), money(F.sum(amount)).alias("total_billed_amount")
    )

    def merge(changed: DataFrame, _: int) -> None:
        rows = changed.select(F.col("day.start").cast("date").alias("day"), by, "claim_count", "total_billed_amount")
        # The key is text, because a group may be NULL. A batch writes the years anew that it has changed.
        rows = rows.withColumn("group_key", F.to_json(F.struct("day", by))).withColumn("_year", F.year("day"))
        with versions.change(spark, store) as change:
            if RESULT in change.tables:
                change.merge(RESULT, rows, ["group_key"])
            else:
                change.replace(RESULT, rows, ["_year"])
        versions.prune(spark, store)

    query = totals.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def run_daily_summary(
    spark: SparkSession, stream: DataFrame, work: str, event_time: str, delay: str = "30 days",
    by: str = "claim_status", amount: str = "billed_amount",
) -> tuple[DataFrame, DataFrame]:
    """(summary per day and group, late rows) after all files that have arrived; run it again when more have.

    ``work`` holds checkpoints, batches and the result's version store.
    """
    part_late_rows(stream, event_time, delay, work)
    if not path_exists(spark, f"{work}/{ON_TIME}"):
        raise ValueError(f"no file has arrived yet, so {work} holds no result")
    on_time = spark.readStream.schema(stream.schema).parquet(f"{work}/{ON_TIME}/*")
    merge_daily_summary(on_time, f"{work}/result", f"{work}/checkpoint-summary", event_time, delay, by, amount)
    late = spark.read.schema(stream.schema).parquet(f"{work}/{LATE}/*")
    return versions.read(spark, f"{work}/result", RESULT).drop("group_key", "_year"), late
