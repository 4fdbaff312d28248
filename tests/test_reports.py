"""Edge cases of reports, audits and quality scores on small hand-made rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimspan.functions import measures as m
from claimspan.operators import analytics, audits, quality, reports, views, windows
from claimspan.plans import checks  # noqa: F401  (it fills the registry)
from claimspan.plans.registry import QUERIES
from claimspan.sources import readers

AS_OF = date(2026, 6, 30)

CLAIMS = "claim_id bigint, member_id bigint, provider_id bigint, payer_id bigint, service_date date," \
    " billed_amount decimal(10,2), claim_status string, denial_reason string"


@pytest.fixture(scope="module")
def claims(spark):
    day = lambda mth, d=1, y=2026: date(y, mth, d)
    money = Decimal
    rows = [
        (1, 1, 10, 1, day(1), money("100.00"), "Approved", None),
        (2, 1, 10, 1, day(2), money("10000.00"), "Denied", "Coding Error"),
        (3, 2, 10, 2, day(2), money("10000.01"), "Approved", "Billed amount corrected"),
        (4, 2, 11, None, day(4), money("300.00"), "Denied", None),
        (5, 3, 12, 1, day(4, 30), money("50.00"), "Pending", None),
        (6, 3, 99, 1, day(1, 1, 2025), money("75.00"), "Denied", "Duplicate Claim"),
    ]
    return spark.createDataFrame(rows, CLAIMS)


@pytest.fixture(scope="module")
def providers(spark):
    rows = [(10, "A", "S1"), (11, "B", "S1"), (12, "C", None), (13, "D", "S2")]
    return spark.createDataFrame(rows, "provider_id bigint, provider_name string, specialty string")


def test_status_spellings(spark):
    df = spark.createDataFrame([("DENIED",), (" Denied ",), ("PAID",), ("adjusted",), ("Pending",), (None,)], "s string")
    assert [r[0] for r in df.select(m.normalize_status("s")).collect()] == [
        "Denied", "Denied", "Approved", "Approved", "Pending", None,
    ]


def test_rate_denominators(claims):
    months = {r.service_month: r.denial_rate_pct for r in analytics.monthly_denial_rate(claims).collect()}
    assert months == {
        "2025-01": Decimal("100.00"), "2026-01": Decimal("0.00"), "2026-02": Decimal("50.00"), "2026-04": Decimal("100.00"),
    }
    total = {r.service_month: r.denial_rate_pct for r in analytics.monthly_denial_rate(claims, "total").collect()}
    assert total["2026-04"] == Decimal("50.00")
    with pytest.raises(ValueError):
        m.rate_base("some")


def test_percent_rounds_half_up_and_never_divides_by_zero(spark):
    df = spark.createDataFrame([(201, 20000), (1, 0), (1, 3)], "a bigint, b bigint")
    assert [r[0] for r in df.select(m.percent("a", "b")).collect()] == [Decimal("1.01"), None, Decimal("33.33")]


def test_ranking_by_specialty_keeps_null_specialty(claims, providers):
    rows = analytics.denial_rate_by_specialty(claims, providers).collect()
    assert {(r.provider_name, r.specialty): r.rank_within_specialty for r in rows} == {
        ("B", "S1"): 1, ("A", "S1"): 2, ("C", None): 1,
    }


def test_rolling_rate_spans_calendar_gaps(claims):
    rows = {r.service_month: (r.rolling_denied, r.rolling_adjudicated) for r in windows.rolling_denial_rate(claims).collect()}
    assert rows == {"2025-01": (1, 1), "2026-01": (0, 1), "2026-02": (1, 3), "2026-04": (2, 3)}


def test_prior_year_and_ytd(claims):
    prior = {r.service_month: r.billed_prior_year for r in windows.prior_year(claims).collect()}
    assert prior["2026-01"] == Decimal("75.00") and prior["2026-02"] is None
    ytd = {r.service_month: r.billed_ytd for r in windows.ytd(claims).collect()}
    assert ytd["2026-04"] == Decimal("20450.01") and ytd["2025-01"] == Decimal("75.00")


def test_lookup_parameters(spark, claims):
    assert [r.claim_id for r in reports.claim_lookup(claims, " 3 ").collect()] == [3]
    assert reports.claim_lookup(claims, "1", by="member_id").count() == 2
    for blank in ("", "  ", None):
        with pytest.raises(ValueError, match="enter a search value"):
            reports.claim_lookup(claims, blank)
    with pytest.raises(ValueError):
        reports.claim_lookup(claims, "1", by="payer_id")
    assert reports.claim_lookup_message(reports.claim_lookup(claims, "77")) == "No matching claim found."
    assert reports.claim_lookup_message(reports.claim_lookup(claims, "3")) == ""


def test_filter_column_whitelist(claims, providers):
    members = claims.select("member_id", F.lit("N").alias("member_name")).distinct()
    with pytest.raises(ValueError, match="Allowed"):
        reports.filter_claims(claims, members, providers, "member_id; drop table x", "1")
    extended = claims.withColumns({"diagnosis_code": F.lit("I10"), "paid_amount": F.lit(1)})
    found = reports.filter_claims(extended, members, providers, "diagnosis_code", "I10' or 1=1 --")
    assert found.count() == 0


def test_member_history_defaults(claims, providers):
    members = claims.select("member_id", F.lit("N").alias("member_name")).distinct()
    extended = claims.withColumns(
        {"diagnosis_code": F.lit("I10"), "procedure_code": F.lit("1"), "paid_amount": F.lit(1)}
    )
    rows = reports.member_claims(extended, members, providers, 1, as_of=AS_OF).collect()
    assert [r.claim_id for r in rows] == [2, 1]
    rows = reports.member_claims(extended, members, providers, 1, date(2026, 1, 1), date(2026, 1, 1)).collect()
    assert [r.claim_id for r in rows] == [1]
    with pytest.raises(ValueError):
        reports.member_claims(extended, members, providers, 1)


def test_high_dollar_is_strict(claims, spark):
    assert [r.claim_id for r in reports.high_dollar_alert(claims).collect()] == [3]
    assert reports.denial_summary(claims, 77).count() == 0


def test_filters_reach_the_scan(spark, claims, tmp_path):
    path = str(tmp_path / "claims")
    claims.write.parquet(path)
    stored = spark.read.parquet(path)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    alert = plan(reports.high_dollar_alert(stored))
    assert "GreaterThan(billed_amount,10000" in alert
    by_status = plan(views.claims_by_status(stored))
    assert "ReadSchema: struct<billed_amount:decimal(10,2),claim_status:string>" in by_status


def test_denial_categories(spark):
    rows = [("Coding Error",), ("",), ("  ",), (None,), ("something else",), ("No Prior Authorization",)]
    df = spark.createDataFrame(rows, "r string")
    assert [r[0] for r in df.select(analytics.denial_category("r")).collect()] == [
        "Administrative", "Other", "Other", "Other", "Other", "Authorization",
    ]


def test_top_reasons(claims):
    rows = analytics.top_denial_reasons(claims, 5).collect()
    assert [(r.denial_reason, r.denied_claims, r.share_pct) for r in rows] == [
        ("Coding Error", 1, Decimal("33.33")), ("Duplicate Claim", 1, Decimal("33.33")),
    ]


def test_active_contract_on_its_last_day(spark):
    providers = spark.createDataFrame([(1, "A", None), (2, "B", None), (3, "C", AS_OF)],
                                      "provider_id bigint, provider_name string, term_date date")
    for c in ("npi", "specialty", "network_status", "group_name", "effective_date"):
        providers = providers.withColumn(c, F.lit("x"))
    contracts = spark.createDataFrame(
        [(1, "FFS", None), (1, "VB", date(2030, 1, 1)), (2, "FFS", AS_OF)],
        "provider_id bigint, contract_type string, end_date date",
    ).withColumn("rate_modifier", F.lit(1))
    view = views.active_providers(providers, contracts, AS_OF).collect()
    assert sorted((r.provider_id, r.contract_type or "") for r in view) == [(1, "FFS"), (1, "VB"), (2, "")]
    audit = audits.providers_no_active_contract(providers, contracts, AS_OF).collect()
    assert [r.provider_id for r in audit] == [3]


def test_check_option(spark):
    df = spark.createDataFrame([("IN",), ("OUT",), (None,)], "network_status string")
    ok, lost = views.check_option(df, F.col("network_status") == "IN")
    assert ok.count() == 1 and lost.count() == 2


def test_whitespace_at_either_end(spark):
    df = spark.createDataFrame([(1, " a"), (2, "a "), (3, "a"), (4, None)], "id bigint, name string")
    assert sorted(r.id for r in audits.whitespace(df, "id", "name").collect()) == [1, 2]


def test_null_keys_are_orphans(claims, spark):
    payer = spark.createDataFrame([(1,)], "payer_id bigint")
    assert sorted(r.claim_id for r in audits.orphans(claims, payer, "payer_id", "payer_id").collect()) == [3, 4]
    assert audits.orphan_count(claims, payer, "payer_id", "payer_id").first()[0] == 2


def test_null_keys_group_as_duplicates(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    assert [tuple(r) for r in audits.duplicates(df, ["a", "b"]).collect()] == [(None, 1, 2)]


# ---------------------------------------------------------------- quality


def test_scores_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int")
    assert quality.completeness(empty, "a").first().score_pct is None
    assert quality.uniqueness(empty, "a").first().total_rows == 0
    report = quality.report(empty, [(quality.COMPLETENESS, "a", None), (quality.UNIQUENESS, "a", None)])
    assert [(r.score_pct, r["pass"]) for r in report.collect()] == [(None, False), (None, False)]


def test_validity_counts_case_and_null(spark):
    df = spark.createDataFrame([("Denied",), ("DENIED",), (None,), ("Pending",)], "s string")
    assert quality.validity(df, "s", ["Denied", "Pending"]).first().score_pct == Decimal("50.00")


def test_uniqueness_and_sketch(spark):
    df = spark.createDataFrame([(i % 7 or None,) for i in range(70)], "v int")
    assert quality.uniqueness(df, "v").first().distinct_values == 6
    assert quality.uniqueness(df, "v", approximate=True).first().distinct_values == 6


def test_integrity_counts_each_row_once(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    ref = spark.createDataFrame([(1,), (1,)], "id bigint")
    row = quality.integrity(df, "k", ref, "id").first()
    assert (row.total_rows, row.matched_rows) == (4, 2)


def test_json_lines(spark, tmp_path, conf):
    path = tmp_path / "c.json"
    lines = ['{"a": 1, "b": null}', "", '{"a": 1}', "not json", "[1]", '{"b": {"a": 1}}']
    path.write_text("\n".join(lines * 50))
    conf(spark__sql__files__maxPartitionBytes="300", spark__sql__files__openCostInBytes="1")
    rows = quality.json_required(readers.read_json_lines(spark, str(path)), "json", ["a", "b"]).collect()
    got = {r.record_index: (r.is_malformed, r.has_all_fields, r.missing_fields) for r in rows}
    expected = [
        (False, True, "None"), (False, False, "b"), (True, False, None), (True, False, None), (False, False, "a"),
    ]
    assert got == {i: expected[i % 5] for i in range(250)}


def test_unknown_checks_are_refused(spark):
    with pytest.raises(ValueError):
        quality.report(spark.range(1), [("Beauty", "id", None)])
    with pytest.raises((ValueError, IndexError)):
        quality.run_tests(spark.range(1), {"id": ["pretty"]})


def test_dim_date(spark):
    rows = readers.dim_date(spark, date(2024, 2, 28), date(2024, 3, 1)).collect()
    assert [r.date_key for r in rows] == [20240228, 20240229, 20240301]
    assert (rows[1].month_name, rows[1].calendar_quarter, rows[1].day_of_week) == ("February", 1, "Thursday")


def test_registry_payload_gaps(spark):
    providers = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "npi string")
    payloads = [
        ("1", '{"results":[{"basic":{"credential":"MD","status":"A"},"taxonomies":[{"desc":"T"}],'
              '"addresses":[{"address_purpose":"MAILING","city":"M"},{"address_purpose":"LOCATION","city":"L","state":"TX"}]}]}'),
        ("2", '{"results":[]}'),
        ("3", '{"results":[{"basic":{"status":"A"}}]}'),
    ]
    got = readers.enrich_registry(providers, spark.createDataFrame(payloads, "npi string, payload string"))
    assert {r.npi: tuple(r)[1:] for r in got.collect()} == {
        "1": ("MD", "A", "L", "TX", "T"),
        "2": (None,) * 5,
        "3": (None, "A", None, None, None),
        "4": (None,) * 5,
    }


def test_parent_join(spark):
    df = spark.createDataFrame([(1, "root", None), (2, "a", 1), (3, "b", 9)], "id bigint, name string, boss bigint")
    rows = {r.id: r.parent_name for r in analytics.parent_join(df, "id", "boss").collect()}
    assert rows == {1: None, 2: "root", 3: None}


def test_bucketed_table_needs_no_shuffle(spark, claims):
    from claimspan.operators import etl

    etl.save_table(claims, "bucketed_claims", bucket_by=(4, ["provider_id"]))
    stored = readers.table(spark, "bucketed_claims")
    plan = analytics.denial_rate_by_provider(stored)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    assert analytics.denial_rate_by_provider(stored).count() == 4
    spark.sql("drop table bucketed_claims")


def test_sums_of_a_very_large_table_fit(spark):
    """Folded sums near 10^17, as 10^12 claims would give."""
    huge = [(i, Decimal("99999999.99"), "Approved") for i in range(3)]
    claims = spark.createDataFrame(huge, "provider_id bigint, billed_amount decimal(10,2), claim_status string")
    total = F.sum(F.col("billed_amount").cast("decimal(20,2)") * F.lit(300_000_000).cast("decimal(10,0)"))
    row = claims.agg(m.money(total).alias("t"), m.money_mean(total, F.lit(900_000_000)).alias("a")).first()
    assert (row.t, row.a) == (Decimal("89999999991000000.00"), Decimal("99999999.99"))
    providers = spark.createDataFrame([(i, f"P{i}") for i in range(3)], "provider_id bigint, provider_name string")
    wide = claims.withColumn("billed_amount", (F.lit(10**17) + F.col("provider_id")).cast("decimal(20,2)"))
    ranks = {r.provider_name: r.provider_rank for r in windows.provider_rank(wide, providers).collect()}
    assert ranks == {"P2": 1, "P1": 2, "P0": 3}
    assert claims.agg(m.amount_percent(total, total * 2)).first()[0] == Decimal("50.00")


def test_record_index_counts_on_through_all_claims(spark, tmp_path, conf):
    conf(spark__sql__adaptive__enabled="false")  # several files
    ids = [*range(9_000, 31_000, 7), 12_345_678, None]
    rows = [(i, 1, "F", 1.0, datetime(1999, 1, 1), "1-URGENT") for i in ids[::-1]]
    columns = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, columns).repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    got = QUERIES["Q5_record_index"](spark, str(tmp_path)).collect()
    assert {r.claim_id: r.record_index for r in got} == {i: n for n, i in enumerate(ids)}
