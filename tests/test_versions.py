"""Version stores, and jobs on them that stop at any write and are repeated."""

from datetime import date, datetime
import os

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from claimspan.operators import etl, versions

RUN_AT = datetime(2026, 7, 1, 6, 0)


class Stopped(RuntimeError):
    pass


@pytest.fixture
def stop_at(monkeypatch):
    """Let the n-th Parquet write of a block fail, before it begins or inside one of its tasks."""

    def arm(n, inside_task):
        plain, seen = DataFrameWriter.parquet, []

        def parquet(self, path, *args, **kwargs):
            seen.append(path)
            if len(seen) != n:
                return plain(self, path, *args, **kwargs)
            if not inside_task:
                raise Stopped(path)
            broken = self._df.withColumn("_bad", F.raise_error(F.lit("task stopped")).cast("string"))
            return plain(broken.write.mode("append"), path)

        monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
        return seen

    yield arm
    monkeypatch.undo()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_readers_follow_the_pointer(spark, tmp_path):
    store = str(tmp_path / "s")
    assert versions.latest(spark, store).number == 0
    with versions.change(spark, store) as c:
        c.replace("a", spark.range(3))
        c.append("log", spark.range(1))
    first = versions.latest(spark, store)
    with versions.change(spark, store) as c:
        c.replace("a", spark.sql("select 'x' as text"))
        c.append("log", spark.range(5, 6))
    assert rows_of(versions.read(spark, store, "a")) == [("x",)]
    assert rows_of(versions.read(spark, store, "log")) == [(0,), (5,)]
    assert rows_of(versions.read(spark, store, "a", first)) == [(0,), (1,), (2,)]
    assert len(versions.latest(spark, store).tables["log"].folders()) == 2  # the first rows were not written again
    with pytest.raises(ValueError):
        versions.read(spark, store, "nothing")
    assert versions.prune(spark, store, keep=2) == []
    with versions.change(spark, store) as c:
        c.replace("log", spark.range(1))
    assert len(versions.prune(spark, store, keep=1)) == 1  # version 2 still holds table a
    assert rows_of(versions.read(spark, store, "a")) == [("x",)] and rows_of(versions.read(spark, store, "log")) == [(0,)]


def test_of_two_changes_at_a_time_one_fails(spark, tmp_path):
    store = str(tmp_path / "s")
    with versions.change(spark, store) as c:
        c.replace("a", spark.range(1))
    with pytest.raises(versions.ConcurrentChange):
        with versions.change(spark, store) as slow:
            slow.replace("a", spark.range(5))
            with versions.change(spark, store) as quick:
                quick.replace("a", spark.range(2))
    assert versions.read(spark, store, "a").count() == 2
    assert sorted(os.listdir(store))[0] == "_pointer" and len(os.listdir(store)) == 3


def test_upsert_with_null_and_odd_partition_values(spark, tmp_path):
    store, schema = str(tmp_path / "s"), "k long, v string, day string"
    etl.replace_version(spark.createDataFrame([(1, "old", None), (3, "old", "x:y"), (4, "old", "z"), (None, "n", "z")], schema), store, partition_by=["day"])
    before = versions.latest(spark, store).tables["data"].parts
    etl.upsert_table(spark, store, spark.createDataFrame([(1, "new", "a"), (3, "new", None), (5, "new", "a/b=c")], schema), ["k"])
    assert rows_of(versions.read(spark, store)) == [(1, "new", "a"), (3, "new", None), (4, "old", "z"), (5, "new", "a/b=c"), (None, "n", "z")]
    after = versions.latest(spark, store).tables["data"].parts
    assert sum(before[p] == after.get(p) for p in before) == 1  # that of "z" stays where it is
    etl.upsert_table(spark, str(tmp_path / "new"), spark.createDataFrame([(1, "a", "d"), (1, "b", "d")], schema), ["k"], ["v"])
    assert rows_of(versions.read(spark, str(tmp_path / "new"))) == [(1, "b", "d")]


@pytest.mark.parametrize("inside_task", [False, True])
@pytest.mark.parametrize("n", [1, 2])
def test_upsert_that_stops_leaves_the_old_version(spark, tmp_path, stop_at, monkeypatch, n, inside_task):
    store, schema = str(tmp_path / "s"), "k long, v string"
    etl.replace_version(spark.createDataFrame([(1, "old"), (2, "old")], schema), store)
    updates = spark.createDataFrame([(2, "new"), (3, "new")], schema)
    stop_at(n, inside_task)
    with pytest.raises(Exception, match="stopped" if inside_task else "s/v"):
        etl.upsert_table(spark, store, updates, ["k"])
    monkeypatch.undo()
    assert rows_of(versions.read(spark, store)) == [(1, "old"), (2, "old")] and len(os.listdir(store)) == 2
    etl.upsert_table(spark, store, updates, ["k"])
    assert rows_of(versions.read(spark, store)) == [(1, "old"), (2, "new"), (3, "new")]


def termination_store(spark, tmp_path):
    store = str(tmp_path / "providers")
    with versions.change(spark, store) as c:
        c.replace("providers", spark.createDataFrame([(1, None), (2, None)], "provider_id long, term_date date"))
        c.replace("contracts", spark.createDataFrame([(10, 1, date(2020, 1, 1), None), (11, 2, date(2020, 1, 1), None)],
                                                     "contract_id long, provider_id long, start_date date, end_date date"))
    requests = spark.createDataFrame([(1, date(2025, 1, 1), "me"), (9, date(2025, 1, 1), "me")], "provider_id long, term_date date, changed_by string")
    return store, requests


@pytest.mark.parametrize("n, inside_task", [(1, True), (2, False), (3, True), (4, False), (4, True)])
def test_termination_that_stops_changes_nothing(spark, tmp_path, stop_at, monkeypatch, n, inside_task):
    store, requests = termination_store(spark, tmp_path)
    stop_at(n, inside_task)
    with pytest.raises(Exception):
        etl.run_termination(spark, store, requests, RUN_AT)
    monkeypatch.undo()
    assert rows_of(versions.read(spark, store, "providers")) == [(1, None), (2, None)]
    assert versions.read(spark, store, "contracts").filter("end_date is not null").count() == 0
    for _ in range(2):
        outcomes = etl.run_termination(spark, store, requests, RUN_AT)
    assert {r.provider_id: r.error_number for r in outcomes.collect()} == {1: 0, 9: 50001}
    assert rows_of(versions.read(spark, store, "providers")) == [(1, date(2025, 1, 1)), (2, None)]
    assert {r.contract_id: r.end_date for r in versions.read(spark, store, "contracts").collect()} == {10: date(2025, 1, 1), 11: None}
    assert versions.read(spark, store, "change_log").count() == 1


REQUEST = "request_id long, member_name string, date_of_birth date, gender string, plan_type string, state string"
MEMBER = "member_id long, member_name string, date_of_birth date, gender string, plan_type string, state string, enrollment_date date, disenroll_date date"


# The fifth write closes the ledger with a table of no rows, so no task of it can fail.
@pytest.mark.parametrize("n, inside_task", [(1, True), (2, False), (3, True), (4, False), (4, True), (5, False)])
def test_enrollment_that_stops_gives_each_request_one_member(spark, tmp_path, stop_at, monkeypatch, n, inside_task):
    members, outcomes = str(tmp_path / "members"), str(tmp_path / "outcomes")
    spark.createDataFrame([(100, "Z", None, "M", "HMO", "TX", None, None)], MEMBER).write.parquet(members)
    requests = spark.createDataFrame([(7, "A", None, "M", "HMO", "TX"), (8, "B", None, "F", "PPO ", "TX"), (9, "C", None, "X", "PPO", "TX")], REQUEST)
    seen = stop_at(n, inside_task)
    with pytest.raises(Exception):
        etl.run_enrollment(spark, members, requests, outcomes, date(2026, 7, 1))
    assert len(seen) == n
    monkeypatch.undo()
    # Another request comes first, then the same ones again.
    etl.run_enrollment(spark, members, spark.createDataFrame([(1, "D", None, "U", "EPO", "TX")], REQUEST), outcomes, date(2026, 7, 2))
    for _ in range(2):
        etl.run_enrollment(spark, members, requests, outcomes, date(2026, 7, 3))
    got = spark.read.parquet(members).collect()
    assert sorted(r.member_name for r in got) == ["A", "B", "D", "Z"]
    assert sorted(r.member_id for r in got) == [100, 101, 102, 103]
    answers = spark.read.parquet(outcomes).collect()
    assert sorted((r.request_id, r.return_code) for r in answers) == [(1, 0), (7, 0), (8, 0), (9, -1)]
    named = {r.member_id: r.member_name for r in got}
    assert {r.request_id: named.get(r.new_member_id) for r in answers} == {1: "D", 7: "A", 8: "B", 9: None}


def test_requests_answered_before_the_ledger_stay_answered(spark, tmp_path):
    members, outcomes = str(tmp_path / "members"), str(tmp_path / "outcomes")
    spark.createDataFrame([(5, "A", None, "M", "HMO", "TX", None, None)], MEMBER).write.parquet(members)
    spark.createDataFrame([(7, 0, 5, None)], "request_id long, return_code int, new_member_id long, message string").write.parquet(outcomes)
    for _ in range(3):
        etl.run_enrollment(spark, members, spark.createDataFrame([(7, "A", None, "M", "HMO", "TX")], REQUEST), outcomes, date(2026, 7, 1))
    assert spark.read.parquet(members).count() == 1 and spark.read.parquet(outcomes).count() == 1
