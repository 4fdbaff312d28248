"""Late days of an incremental load, and the stateful summary over several batches, restarts and late rows."""

from datetime import date, datetime
from decimal import Decimal
import os

import pytest
from pyspark.sql import functions as F

from claimspan.operators import versions
from claimspan.streaming import files as streams, incremental, stateful

SCHEMA = "claim_id bigint, service_date date"


def day(d):
    return date(2026, 1, d)


def test_only_changed_days_are_read_and_each_row_loads_once(spark, tmp_path):
    source_dir, target, store = str(tmp_path / "source"), str(tmp_path / "claims"), str(tmp_path / "days")

    def deliver(*rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").partitionBy("service_date").parquet(source_dir)

    def run():
        source = spark.read.schema(SCHEMA).parquet(source_dir)
        return incremental.load_late_days(spark, source, target, store, "service_date", "claim_id")

    deliver((1, day(1)), (2, day(2)), (3, None))
    assert run() == incremental.LateRun(3, [day(1), day(2), None])
    assert run() == incremental.LateRun(0, [])
    deliver((4, day(1)), (5, day(9)), (2, day(2)))  # a late row, a new day, and a claim delivered again
    assert run() == incremental.LateRun(2, [day(1), day(2), day(9)])
    deliver((6, None))
    assert run() == incremental.LateRun(1, [None])
    assert sorted(r.claim_id for r in spark.read.parquet(target).collect()) == [1, 2, 3, 4, 5, 6]


def test_a_run_that_stops_is_repeated(spark, tmp_path, monkeypatch):
    target, store = str(tmp_path / "claims"), str(tmp_path / "days")
    source = spark.createDataFrame([(1, day(1)), (2, day(2))], SCHEMA)
    with monkeypatch.context() as m:  # the rows are appended, the digests are not stored
        plain = versions._point
        m.setattr(versions, "_point", lambda spark, at, version: (_ for _ in ()).throw(RuntimeError("stopped")) if at == store else plain(spark, at, version))
        with pytest.raises(RuntimeError, match="stopped"):
            incremental.load_late_days(spark, source, target, store, "service_date", "claim_id")
    assert spark.read.parquet(target).count() == 2
    assert incremental.load_late_days(spark, source, target, store, "service_date", "claim_id").loaded == 0
    assert incremental.load_late_days(spark, source, target, store, "service_date", "claim_id").days == []
    assert spark.read.parquet(target).count() == 2


ROW = "claim_status string, billed_amount decimal(10,2), service_time timestamp"


def test_stateful_summary_equals_batch_over_restarts(spark, tmp_path):
    work, in_dir = str(tmp_path / "work"), str(tmp_path / "in")

    def rows(*days):
        return [(["Denied", "Approved", None][k % 3], Decimal(k + d), datetime(2026, m, d, k % 24)) for m, d in days for k in range(7)]

    def deliver(data):
        spark.createDataFrame(data, ROW).coalesce(1).write.mode("append").parquet(in_dir)
        stream = streams.file_stream(spark, in_dir, spark.createDataFrame([], ROW).schema, file_format="parquet")
        return stateful.run_daily_summary(spark, stream, work, "service_time", "10 days")

    def batch(data):
        frame = spark.createDataFrame(data, ROW)
        return Counter_of(frame.groupBy(F.to_date("service_time").alias("day"), "claim_status").agg(F.count("*"), F.sum("billed_amount")))

    def Counter_of(frame):
        return sorted(map(tuple, frame.collect()), key=str)

    first, second = rows((1, 1), (1, 2), (1, 20)), rows((1, 15), (1, 21), (3, 1))
    deliver(first)
    # Of the second delivery the 15th is 5 days behind the 20th, so on time; of the third all before 19 February is late.
    deliver(second)
    third, late = rows((2, 25), (3, 2)), rows((1, 2), (2, 18)) + [("Denied", Decimal(1), None)]
    summary, side = deliver(third + late)
    assert Counter_of(summary) == batch(first + second + third)
    assert Counter_of(side) == sorted(late, key=str)
    summary, side = deliver(rows((3, 3)))
    assert Counter_of(summary) == batch(first + second + third + rows((3, 3))) and side.count() == len(late)
    assert os.path.isdir(f"{work}/checkpoint-summary/state")


def test_a_part_that_stops_is_repeated(spark, tmp_path, monkeypatch):
    work, in_dir = str(tmp_path / "work"), str(tmp_path / "in")
    spark.createDataFrame([("Denied", Decimal(1), datetime(2026, 1, 1))], ROW).write.parquet(in_dir)

    def run():
        stream = streams.file_stream(spark, in_dir, spark.createDataFrame([], ROW).schema, file_format="parquet")
        return stateful.run_daily_summary(spark, stream, work, "service_time")

    with monkeypatch.context() as m:  # the result is merged, the batch is not committed
        m.setattr(stateful.versions, "prune", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(Exception, match="stopped"):
            run()
    summary, side = run()
    assert [tuple(r) for r in summary.collect()] == [(date(2026, 1, 1), "Denied", 1, Decimal("1.00"))] and side.count() == 0
