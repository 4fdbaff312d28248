"""The index of loaded ids: what it opens, and loads and batches that stop."""

from datetime import datetime
import os

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from claimspan.operators import etl, versions
from claimspan.operators.id_index import IdIndex
from claimspan.sources.schemas import INBOUND_COLUMNS
from claimspan.streaming import files as streams

RUN_AT = datetime(2026, 7, 1, 6, 0)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "claim_id long")


def held(index, frame):
    return sorted(r.id for r in index.held(frame).collect())


def test_a_batch_opens_only_its_buckets(spark, tmp_path):
    index = IdIndex(spark, str(tmp_path / "ids"), buckets=16)
    assert held(index, ids(spark, 1, 2)) == []
    index.build(spark.range(0, 5000))
    everything = versions.read(spark, index.store, "ids").inputFiles()
    assert len(everything) == 16
    assert held(index, ids(spark, 3, 7000, None)) == [3]
    assert len(index.candidates(ids(spark, 3, 7000)).inputFiles()) <= 2
    plan = index.candidates(ids(spark, 3, 7000))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,3)" in plan
    many = spark.range(4900, 5100)
    assert held(index, many) == list(range(4900, 5000))


def test_files_of_a_bucket_are_merged_when_there_are_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("claimspan.operators.id_index.FILES", 3)
    index = IdIndex(spark, str(tmp_path / "ids"), buckets=1)
    for k in range(6):
        index.begin(ids(spark, k, k + 1))
        index.finish()
    assert held(index, spark.range(-3, 20)) == list(range(7))
    assert len(versions.read(spark, index.store, "ids").inputFiles()) <= 3


def test_announced_ids_count_only_if_the_table_has_them(spark, tmp_path):
    index = IdIndex(spark, str(tmp_path / "ids"))
    index.build(ids(spark, 1))
    index.begin(ids(spark, 2, 3))
    assert held(index, ids(spark, 1, 2, 3)) == [1]
    index.recover(ids(spark, 1, 3))
    assert held(index, ids(spark, 1, 2, 3)) == [1, 3]
    index.begin(ids(spark, 9), 4)
    index.resume(4)  # the same batch again
    assert held(index, ids(spark, 9)) == []
    index.begin(ids(spark, 9), 4)
    index.resume(5)
    assert held(index, ids(spark, 9)) == [9]


def inbound(path, *claims):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lines = [f"{c},1,10,2026-01-05,,,I10,99213,100.50,80,60.00,PAID," for c in claims]
    with open(path, "w") as f:
        f.write("\n".join([",".join(INBOUND_COLUMNS), *lines, ""]))
    return path


@pytest.fixture
def keys(spark):
    return spark.createDataFrame([(1,)], "member_id bigint"), spark.createDataFrame([(10,)], "provider_id bigint")


@pytest.mark.parametrize("after_append", [False, True])
def test_a_load_that_stops_around_its_append_loads_each_claim_once(spark, tmp_path, keys, monkeypatch, after_append):
    target = str(tmp_path / "claims")

    def load(path):
        return etl.load_new_claims(spark, path, *keys, target, str(tmp_path / "rejects"), str(tmp_path / "log"), RUN_AT)

    assert load(inbound(str(tmp_path / "a.csv"), 1, 2)).rows_inserted == 2
    with monkeypatch.context() as m:
        if after_append:
            m.setattr(IdIndex, "finish", lambda self: (_ for _ in ()).throw(RuntimeError("stopped")))
        else:
            plain = DataFrameWriter.parquet

            def parquet(self, path, *args, **kwargs):
                if path == target:
                    raise RuntimeError("stopped")
                return plain(self, path, *args, **kwargs)

            m.setattr(DataFrameWriter, "parquet", parquet)
        with pytest.raises(RuntimeError, match="stopped"):
            load(inbound(str(tmp_path / "b.csv"), 2, 3))
    again = load(inbound(str(tmp_path / "b.csv"), 2, 3))
    assert (again.rows_inserted, again.rows_rejected) == ((0, 2) if after_append else (1, 1))
    assert sorted(r.claim_id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_a_batch_that_runs_again_accepts_its_claims_again(spark, tmp_path, keys, monkeypatch):
    target, in_dir = str(tmp_path / "claims"), tmp_path / "in"

    def run():
        streams.start_claims_ingest(streams.inbound_stream(spark, str(in_dir)), *keys, target, str(tmp_path / "checkpoint")).awaitTermination()

    inbound(str(in_dir / "a.csv"), 1, 2)
    run()
    inbound(str(in_dir / "b.csv"), 2, 3)
    with monkeypatch.context() as m:  # stops when everything is written, before the batch is committed
        plain = streams.remove_dir
        m.setattr(streams, "remove_dir", lambda spark, path: (plain(spark, path), (_ for _ in ()).throw(RuntimeError("stopped"))))
        with pytest.raises(Exception, match="stopped"):
            run()
    run()
    inbound(str(in_dir / "c.csv"), 3, 4)
    run()
    rows = spark.read.parquet(target).filter(F.col("outcome") == "accepted").collect()
    assert sorted(r.conv_claim_id for r in rows) == [1, 2, 3, 4]
    assert spark.read.parquet(target).count() == 6
