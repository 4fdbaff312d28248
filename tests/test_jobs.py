"""Loads, change jobs, incremental runs and streams."""

from datetime import date, datetime
from decimal import Decimal
import os

import pytest
from pyspark.sql import functions as F

from claimspan.operators import etl
from claimspan.plans import files as plans
from claimspan.plans.registry import QUERIES
from claimspan.sources import readers
from claimspan.sources.schemas import INBOUND_COLUMNS
from claimspan.streaming import files as streams, incremental

RUN_AT = datetime(2026, 7, 1, 6, 0)


def line(claim_id="1", member="1", provider="10", day="2026-01-05", billed="100.50", status="PAID", reason=""):
    return ",".join([claim_id, member, provider, day, "", "", "I10", "99213", billed, "80", "60.00", status, reason])


def inbound(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write("\r\n".join([",".join(INBOUND_COLUMNS), *lines, ""]).encode("cp1252"))
    return path


@pytest.fixture
def keys(spark):
    members = spark.createDataFrame([(1,), (2,)], "member_id bigint")
    providers = spark.createDataFrame([(10,), (11,)], "provider_id bigint")
    return members, providers


def test_inbound_text_is_code_page_1252_without_quotes(spark, tmp_path):
    path = inbound(str(tmp_path / "in" / "c.csv"), line(reason='café €5 – "open'), line(claim_id="2"))
    rows = readers.read_inbound_claims(spark, path).orderBy("claim_id").collect()
    assert rows[0].denial_reason == 'café €5 – "open'
    assert rows[1].denial_reason is None and rows[1].admit_date is None
    assert rows[0].billed_amount == "100.50"


def test_conversion_errors(spark, tmp_path):
    path = inbound(
        str(tmp_path / "in" / "c.csv"),
        line(),
        line(claim_id="x7"),
        line(claim_id=""),
        line(billed="1e99", day="2026-02-30", status="SOMETHING FAR TOO LONG"),
    )
    rows = etl.convert_claims(readers.read_inbound_claims(spark, path)).collect()
    assert [r.conversion_errors for r in rows] == [
        "",
        "claim_id: not a whole number",
        "claim_id: missing",
        "billed_amount: not a numeric(10,2); claim_status: longer than 15; service_date: not a date",
    ]
    assert rows[0].conv_billed_amount == Decimal("100.50") and rows[0].conv_claim_status == "Approved"
    assert rows[0].conv_service_date == date(2026, 1, 5)


def test_fail_mode_stops_at_a_bad_value(spark, tmp_path):
    good = inbound(str(tmp_path / "a" / "c.csv"), line())
    bad = inbound(str(tmp_path / "b" / "c.csv"), line(claim_id="x7"))
    etl.convert_claims(readers.read_inbound_claims(spark, good), "fail").collect()
    with pytest.raises(Exception, match="claim_id: not a whole number"):
        etl.convert_claims(readers.read_inbound_claims(spark, bad), "fail").collect()
    with pytest.raises(ValueError):
        etl.convert_claims(readers.read_inbound_claims(spark, good), "ignore")


def load(spark, tmp_path, keys, path, archive=True, run_at=RUN_AT):
    base = str(tmp_path)
    return etl.load_new_claims(
        spark, path, *keys, f"{base}/claims", f"{base}/rejects", f"{base}/log", run_at,
        f"{base}/archive" if archive else None,
    )


def test_load_routes_archives_and_logs(spark, tmp_path, keys):
    path = inbound(
        str(tmp_path / "in" / "c.csv"),
        line(),
        line(claim_id="2", member="99"),
        line(claim_id="3", provider="99"),
        line(claim_id="4", billed="n/a"),
        line(claim_id="5", status="Denied", reason="Coding Error"),
        line(claim_id="5", status="Denied", reason="Coding Error"),  # repeated inside the file
        line(claim_id="5", status="Denied", reason="Coding Error"),
        line(claim_id="5", day="2025-12-31", status="Pending"),  # an older version
    )
    first = load(spark, tmp_path, keys, path)
    assert (first.source_rows, first.rows_inserted, first.rows_rejected) == (8, 2, 6)
    assert first.balanced and first.status == "Success"
    assert not os.path.exists(path) and len(os.listdir(tmp_path / "archive")) == 1
    rejects = spark.read.option("header", True).csv(str(tmp_path / "rejects"))
    assert sorted((r.claim_id, r.claim_status, r.reject_reason) for r in rejects.collect()) == [
        ("2", "PAID", "member not found"),
        ("3", "PAID", "provider not found"),
        ("4", "PAID", "billed_amount: not a numeric(10,2)"),
        ("5", "Denied", "claim repeated in file"),
        ("5", "Denied", "claim repeated in file"),
        ("5", "Pending", "claim repeated in file"),
    ]
    again = inbound(path, line(), line(claim_id="6", member="2"))
    second = load(spark, tmp_path, keys, again, run_at=datetime(2026, 7, 1, 9, 0))
    assert (second.rows_inserted, second.rows_rejected) == (1, 1) and second.balanced
    assert spark.read.option("header", True).csv(str(tmp_path / "rejects")).first().reject_reason == "claim already loaded"
    assert len(os.listdir(tmp_path / "archive")) == 2
    missing = load(spark, tmp_path, keys, path)
    assert missing.status == "No file"
    claims = spark.read.parquet(str(tmp_path / "claims"))
    assert sorted(r.claim_id for r in claims.collect()) == [1, 5, 6]
    log = spark.read.parquet(str(tmp_path / "log"))
    assert sorted(r.status for r in log.collect()) == ["No file", "Success", "Success"]


def test_settling_shuffles_no_row_that_is_rejected_already(spark, tmp_path, keys, conf):
    """Rows without an id would gather in one task, and only whole rows of ids that repeat are compared."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="8")
    blank = [line(claim_id="  ") for _ in range(600)]
    path = inbound(str(tmp_path / "in" / "c.csv"), *blank, *[line(claim_id=str(i)) for i in range(300)], line(claim_id="7", day="2026-01-06"))
    shuffled = []

    def stage(df, name):
        df.write.parquet(str(tmp_path / name))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        shuffled.append((name, plan))
        return spark.read.parquet(str(tmp_path / name))

    rows = stage(readers.read_inbound_claims(spark, path).withColumn("_row", F.monotonically_increasing_id()), "rows")
    classified = stage(etl.key_claims(rows, *keys), "classified")
    assert classified.columns == ["_row", "conv_claim_id", "reject_reason"]
    loaded = spark.range(250, 260).withColumnRenamed("id", "claim_id")
    settled = etl.settled_claims(etl.settle_claims(rows, classified, loaded, stage)).collect()
    reasons = {(r.conv_claim_id, str(r.conv_service_date), r.reject_reason) for r in settled}
    accepted = {(i, "2026-01-06" if i == 7 else "2026-01-05", None) for i in range(300) if not 250 <= i < 260}
    refused = {(i, "2026-01-05", "claim already loaded") for i in range(250, 260)}
    assert len(settled) == 901
    assert reasons == accepted | refused | {(None, "2026-01-05", "claim_id: missing"), (7, "2026-01-05", "claim repeated in file")}
    for name, plan in shuffled:
        if name in ("claims-ids", "claims-several", "claims-reasons"):
            lines = plan.splitlines()
            scans = [i for i, text in enumerate(lines) if "Relation [_row" in text and "reject_reason" in text]
            assert scans and all("null(reject_reason" in lines[i - 1] for i in scans), plan
            assert "denial_reason" not in plan or name == "claims-reasons", plan


def test_both_runs_of_the_load_job_read_one_file(spark, tmp_path, monkeypatch):
    columns = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    rows = [(i, 1, "O", 1.0, datetime(1999, 1, 1), "1-URGENT") for i in range(20)]
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("select 1L as c_custkey, 'n' as c_name, 's' as c_mktsegment, 1 as c_nationkey").write.parquet(str(tmp_path / "customer.parquet"))
    spark.sql("select id as s_suppkey, 'n' as s_name, 1 as s_nationkey from range(200)").write.parquet(str(tmp_path / "supplier.parquet"))
    write, written = plans.write_inbound, []
    monkeypatch.setattr(plans, "write_inbound", lambda t: written.append(write(t)) or written[-1])
    log = QUERIES["D5_run_log"](spark, str(tmp_path)).collect()
    assert sorted((r.rows_inserted, r.rows_rejected) for r in log) == [(0, 20), (20, 0)]
    assert len(written) == 1


def test_routing_is_a_partition(spark, keys):
    claims = spark.createDataFrame(
        [(i, [1, 2, 3, None][i % 4], [10, 99, None][i % 3]) for i in range(60)],
        "claim_id bigint, member_id bigint, provider_id bigint",
    )
    accepted, rejected = etl.route_claims(claims, keys[0].union(keys[0]), keys[1])
    assert accepted.count() + rejected.count() == 60
    assert accepted.filter("member_id not in (1, 2) or provider_id <> 10").count() == 0
    assert rejected.filter("reject_reason is null").count() == 0


def test_enroll_members(spark):
    members = spark.createDataFrame([(40,)], "member_id bigint")
    rows = [
        (9, "A", date(1990, 1, 1), "M", "PPO", "TX"),
        (3, "B", date(1990, 1, 1), "X", "NONE", "TX"),
        (5, "C", date(1990, 1, 1), "U", "HDHP", "TX"),
        (1, "D", date(1990, 1, 1), "F", "EPO   ", "TX"),
        (7, "E", date(1990, 1, 1), None, "HMO", "TX"),
    ]
    requests = spark.createDataFrame(
        rows, "request_id bigint, member_name string, date_of_birth date, gender string, plan_type string, state string"
    )
    new_rows, outcomes = etl.enroll_members(members, requests, date(2026, 7, 1))
    assert {r.member_name: (r.member_id, r.plan_type) for r in new_rows.collect()} == {
        "D": (41, "EPO"), "E": (42, "HMO"), "A": (43, "PPO"),
    }
    assert {r.request_id: (r.return_code, r.new_member_id) for r in outcomes.collect()} == {
        1: (0, 41), 3: (-1, None), 5: (-2, None), 7: (0, 42), 9: (0, 43),
    }
    empty = etl.enroll_members(members.filter("false"), requests, date(2026, 7, 1))[0]
    assert sorted(r.member_id for r in empty.collect()) == [1, 2, 3]


def test_terminate_providers(spark):
    providers = spark.createDataFrame([(1, None), (2, None)], "provider_id bigint, term_date date")
    contracts = spark.createDataFrame(
        [
            (10, 1, date(2020, 1, 1), None),
            (11, 1, date(2020, 1, 1), date(2021, 1, 1)),
            (12, 1, date(2027, 1, 1), None),
            (13, 2, date(2020, 1, 1), None),
        ],
        "contract_id bigint, provider_id bigint, start_date date, end_date date",
    )
    requests = spark.createDataFrame(
        [(1, date(2025, 12, 31), "admin"), (999, date(2025, 12, 31), "admin")],
        "provider_id bigint, term_date date, changed_by string",
    )
    done = etl.terminate_providers(providers, contracts, requests, RUN_AT)
    assert {r.provider_id: r.term_date for r in done.providers.collect()} == {1: date(2025, 12, 31), 2: None}
    assert {r.contract_id: (r.end_date, r.ends_before_start) for r in done.contracts.collect()} == {
        10: (date(2025, 12, 31), False),
        11: (date(2021, 1, 1), False),
        12: (date(2025, 12, 31), True),
        13: (None, False),
    }
    assert [r.notes for r in done.audit.collect()] == ["Provider terminated. Term Date set to 2025-12-31"]
    assert {r.provider_id: r.error_number for r in done.outcomes.collect()} == {1: 0, 999: 50001}


def test_upsert_keeps_every_other_row(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k bigint, v string")
    updates = spark.createDataFrame([(2, "B1", 1), (2, "B2", 2), (3, "C", 1)], "k bigint, v string, t int")
    merged = etl.upsert(target.withColumn("t", F.lit(0)), updates, ["k"], ["t"]).drop("t")
    assert sorted(((r.k or 0), r.v) for r in merged.collect()) == [(0, "n"), (1, "a"), (2, "B2"), (3, "C")]


def test_replace_table_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    etl.save_table(spark.range(3), "replaced", path=path)
    etl.append_table(spark.range(2), "replaced")
    assert spark.table("replaced").count() == 5
    etl.replace_table(spark.range(1).selectExpr("id as other", "'x' as text"), "replaced", path)
    assert spark.table("replaced").columns == ["other", "text"] and spark.table("replaced").count() == 1
    spark.sql("drop table replaced")


# ---------------------------------------------------------------- incremental


def test_incremental_runs_load_every_row_once(spark, tmp_path):
    schema = "claim_id bigint, service_date date"
    day = lambda d: date(2026, 1, d)
    target, control = str(tmp_path / "claims"), str(tmp_path / "watermark")
    source = spark.createDataFrame([(1, day(1)), (2, day(2)), (2, day(2))], schema)
    first = incremental.run_incremental(spark, source, target, control, "service_date", "claim_id")
    assert (first.previous, first.watermark) == (None, day(2))
    unchanged = incremental.run_incremental(spark, source, target, control, "service_date", "claim_id")
    assert unchanged.watermark == day(2) and unchanged.loaded == 0
    source = source.union(spark.createDataFrame([(3, day(5)), (1, day(6))], schema))  # 1 is delivered again
    incremental.run_incremental(spark, source, target, control, "service_date", "claim_id")
    assert incremental.read_watermark(spark, control) == day(6)
    assert sorted(r.claim_id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_a_run_that_stopped_before_the_watermark_moved_is_repeatable(spark, tmp_path, monkeypatch):
    source = spark.createDataFrame([(1, date(2026, 1, 1)), (2, date(2026, 1, 2))], "claim_id bigint, service_date date")
    target, control = str(tmp_path / "claims"), str(tmp_path / "watermark")
    with monkeypatch.context() as m:
        m.setattr(incremental, "write_watermark", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            incremental.run_incremental(spark, source, target, control, "service_date", "claim_id")
    incremental.run_incremental(spark, source, target, control, "service_date", "claim_id")
    assert spark.read.parquet(target).count() == 2


def test_tie_key_takes_late_rows_of_the_watermark_day(spark):
    source = spark.createDataFrame(
        [(1, date(2026, 1, 1)), (2, date(2026, 1, 1)), (3, date(2026, 1, 2))], "claim_id bigint, service_date date"
    )
    plain = incremental.load_since(source, date(2026, 1, 1), "service_date")
    assert [r.claim_id for r in plain.rows.collect()] == [3]
    tied = incremental.load_since(source, date(2026, 1, 1), "service_date", ("claim_id", 1))
    assert sorted(r.claim_id for r in tied.rows.collect()) == [2, 3]
    assert incremental.load_since(source, date(2026, 1, 2), "service_date").watermark == date(2026, 1, 2)


# ---------------------------------------------------------------- streams


def test_stream_ingest_survives_restart_and_redelivery(spark, tmp_path, keys):
    in_dir, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        streams.start_claims_ingest(
            streams.inbound_stream(spark, in_dir, str(tmp_path / "archive")), *keys, out, checkpoint
        ).awaitTermination()

    inbound(f"{in_dir}/a.csv", line(), line(claim_id="2", member="99"), line(claim_id=""), line(claim_id=""))
    run()
    run()
    inbound(f"{in_dir}/b.csv", line(), line(claim_id="3"))  # claim 1 again
    run()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.claim_id or "", r.outcome) for r in rows) == [
        ("", "rejected"), ("", "rejected"), ("1", "accepted"), ("1", "rejected"), ("2", "rejected"), ("3", "accepted"),
    ]


def test_stream_loses_no_row_and_accepts_an_id_once(spark, tmp_path, keys, monkeypatch):
    in_dir, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        streams.start_claims_ingest(streams.inbound_stream(spark, in_dir), *keys, out, checkpoint).awaitTermination()

    inbound(f"{in_dir}/a.csv", line(billed="n/a"), line(claim_id="  "), line(claim_id="  "), line(claim_id="11"))
    settle = streams.settle_claims
    with monkeypatch.context() as m:  # stops after staging, before anything is written
        m.setattr(streams, "settle_claims", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(Exception, match="stopped"):
            run()
    assert settle is streams.settle_claims
    run()
    inbound(f"{in_dir}/b.csv", line(billed="7.00"), line(claim_id=" 11"))
    run()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.conv_claim_id or 0, r.outcome, r.reject_reason or "") for r in rows) == [
        (0, "rejected", "claim_id: missing"), (0, "rejected", "claim_id: missing"),
        (1, "accepted", ""), (1, "rejected", "billed_amount: not a numeric(10,2)"),
        (11, "accepted", ""), (11, "rejected", "claim already loaded"),
    ]
    assert not os.listdir(tmp_path / "_staging" / "claimspan")


def test_late_and_undated_rows_load_once(spark, tmp_path):
    schema = "claim_id bigint, service_date date"
    target, control = str(tmp_path / "claims"), str(tmp_path / "watermark")
    run = lambda source: incremental.run_incremental(spark, source, target, control, "service_date", "claim_id")
    day = date(2026, 1, 1)
    assert run(spark.createDataFrame([(1, day), (2, None)], schema)).loaded == 2
    grown = spark.createDataFrame([(1, day), (2, None), (3, day), (4, None)], schema)
    assert run(grown).loaded == 2 and run(grown).loaded == 0
    assert sorted(r.claim_id for r in spark.read.parquet(target).collect()) == [1, 2, 3, 4]


def test_a_failing_archive_does_not_falsify_the_log(spark, tmp_path, keys, monkeypatch):
    path = inbound(str(tmp_path / "in" / "c.csv"), line(), line(claim_id="2", member="99"))
    monkeypatch.setattr(etl, "archive_file", lambda *a: (_ for _ in ()).throw(RuntimeError("no archive")))
    with pytest.raises(RuntimeError, match="no archive"):
        load(spark, tmp_path, keys, path)
    log = spark.read.parquet(str(tmp_path / "log")).collect()
    assert sorted((r.status, r.rows_inserted, r.rows_rejected) for r in log) == [("Not archived", 0, 0), ("Success", 1, 1)]
    assert not os.listdir(tmp_path / "_staging" / "claimspan")


def test_export_rejects_delimiters_and_goes_on(spark, tmp_path):
    from claimspan.operators import edi

    df = spark.createDataFrame([("1", "A*B"), ("2", "C")], "member_id string, last_name string")
    partners = dict.fromkeys(edi.PARTNER_KEYS, "X")
    edi.write_834(df, str(tmp_path / "out"), ["member_id"], partners, RUN_AT, rejects=str(tmp_path / "rejects"))
    refused = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [(r.member_id, r.reject_reason) for r in refused] == [("1", "last_name holds an X12 delimiter")]
    text = "".join(p.read_text() for p in (tmp_path / "out").rglob("*.txt"))
    assert "NM1*IL*1*C" in text and "A*B" not in text


def test_processed_files_are_archived(spark, tmp_path):
    in_dir, archive = tmp_path / "in", tmp_path / "archive"
    for i in range(3):
        inbound(str(in_dir / f"{i}.csv"), line(claim_id=str(i)))
        stream = streams.inbound_stream(spark, str(in_dir), str(archive))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "checkpoint")
        ).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    archived = [p.name for p in archive.rglob("*.csv")]
    assert "0.csv" in archived and "1.csv" in archived


def test_stream_summary_equals_batch(spark, tmp_path):
    data = spark.createDataFrame(
        [(["Approved", "Denied"][i % 2], Decimal(i)) for i in range(50)], "claim_status string, billed_amount decimal(10,2)"
    )
    data.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = streams.file_stream(spark, str(tmp_path / "in"), data.schema, file_format="parquet")
    result = streams.run_summary(streams.stream_summary(stream), str(tmp_path / "table"), str(tmp_path / "checkpoint"))
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, streams.stream_summary(data).collect()))
