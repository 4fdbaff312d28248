"""Registered queries: audits, quality scores, de-duplication, set operations and change jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from claimspan.operators import audits, etl, quality, versions
from claimspan.plans.bindings import AS_OF, CLAIM_COLUMNS, mean_sql, percent_sql
from claimspan.plans.registry import add
from claimspan.session import scratch_dir
from claimspan.sources import readers
from claimspan.streaming import incremental

TODAY = f"date '{AS_OF}'"
RUN_AT = datetime(2000, 6, 30, 12, 0)

# ---------------------------------------------------------------- audits

BUSINESS_KEY = ["member_id", "service_date", "diagnosis_code", "procedure_code", "billed_amount"]
add(
    "A7_duplicates",
    lambda t: audits.duplicates(t.claims_redelivered, BUSINESS_KEY),
    f"""select {', '.join(BUSINESS_KEY)}, count(*) as duplicate_count from claims_redelivered
        group by {', '.join(BUSINESS_KEY)} having count(*) > 1""",
)
NULL_COLUMNS = {
    "claims": ["diagnosis_code", "denial_reason", "payer_id"],
    "members": ["plan_type", "enrollment_date"],
    "providers": ["specialty"],
}
NULL_AUDIT = " union all ".join(
    f"""select '{table}' as table_name, '{c}' as column_name, count(*) as total_rows,
               count(*) - count({c}) as null_count, {percent_sql(f'(count(*) - count({c}))', 'count(*)')} as null_pct
        from {table}"""
    for table, columns in NULL_COLUMNS.items()
    for c in columns
)


def _null_audit(t):
    return audits.null_audit({name: (getattr(t, name), columns) for name, columns in NULL_COLUMNS.items()})


add("A8_null_audit", _null_audit, NULL_AUDIT)
add("U1_stacked_null_checks", lambda t: _null_audit(t).select("table_name", "column_name", "null_count"),
    f"select table_name, column_name, null_count from ({NULL_AUDIT})")
add(
    "A9_null_audit_by_decision",
    lambda t: audits.null_audit_by(t.authorizations, "decision", ["decision_date", "units_approved", "denial_reason"]),
    """select decision, count(*) as total_rows, count(*) - count(decision_date) as null_decision_date,
              count(*) - count(units_approved) as null_units_approved,
              count(*) - count(denial_reason) as null_denial_reason
       from authorizations group by decision""",
)
add(
    "A14_payer_coverage",
    lambda t: audits.payer_coverage(t.claims),
    "select payer_id, count(*) as claim_count from claims group by payer_id",
)
add(
    "A18_reason_by_status",
    lambda t: audits.reason_by_status(t.claims),
    """select claim_status, count(*) as total_claims, count(denial_reason) as reason_filled,
              count(*) - count(denial_reason) as reason_empty
       from claims group by claim_status""",
)
for _name, _table in (("A19_near_duplicate_summary", "claims"), ("A19_redelivered_summary", "claims_redelivered")):
    add(
        _name,
        lambda t, table=_table: audits.near_duplicate_summary(getattr(t, table), 7, ids_unique=table == "claims"),
        f"""select case when a.provider_id = b.provider_id then 'Same Provider' else 'Different Provider' end
                    as provider_match, count(*) as pair_count
            from {_table} a join {_table} b on a.member_id = b.member_id and a.claim_id < b.claim_id
             and abs(datediff('day', a.service_date, b.service_date)) <= 7
            group by 1""",
    )
ORPHANS = " union all ".join(
    f"""select 'claims with no matching {label}' as issue, count(*) as orphan_count from claims c
        where not exists (select 1 from {parent} p where p.{parent_key} = c.{key})"""
    for label, parent, parent_key, key in [
        ("provider", "providers", "provider_id", "provider_id"),
        ("payer", "payer", "payer_id", "payer_id"),
        ("member", "members", "member_id", "member_id"),
        ("diagnosis", "diagnosis", "icd10_code", "diagnosis_code"),
    ]
)
add(
    "U2_orphan_report",
    lambda t: audits.orphan_report(t.claims, t.providers, t.payer, t.members, t.diagnosis),
    ORPHANS,
)
add(
    "U3_date_ranges",
    lambda t: audits.date_ranges(t.claims, t.members, AS_OF),
    f"""select 'claims' as table_name, 'service_date' as column_name, count(*) as invalid_count,
               'future or too old' as issue_type
        from claims where service_date > {TODAY} or service_date < {TODAY} - interval 10 years
        union all
        select 'claims', 'load_timestamp', count(*), 'future dated' from claims
        where load_timestamp > cast({TODAY} as timestamp)
        union all
        select 'members', 'enrollment_date', count(*), 'future or too old' from members
        where enrollment_date > {TODAY} or enrollment_date < {TODAY} - interval 20 years""",
)

# ---------------------------------------------------------------- de-duplication and upsert

NO_TIME = [c for c in CLAIM_COLUMNS if c != "load_timestamp"]


def load_date():
    return F.col("load_timestamp").cast("date").alias("load_date")


ROW = f"{', '.join(NO_TIME)}, cast(load_timestamp as date) as load_date"
add(
    "U5_dedupe_rows",
    lambda t: etl.dedupe(t.claims_redelivered).select(*NO_TIME, load_date()),
    f"select {ROW} from (select distinct * from claims_redelivered)",
)
LATEST = """(select * from claims_redelivered
             qualify row_number() over (partition by claim_id order by load_timestamp desc) = 1)"""
add(
    "W9_dedupe_latest",
    lambda t: etl.dedupe_latest(t.claims_redelivered, ["claim_id"], ["load_timestamp"]).select(*NO_TIME, load_date()),
    f"select {ROW} from {LATEST}",
)


def _next_delivery(t):
    """Everything delivered again under ids 1000 higher: most update a claim, some are new."""
    return t.claims_redelivered.withColumn("claim_id", F.col("claim_id") + 1000)


NEXT_DELIVERY = """(select * replace (claim_id + 1000 as claim_id) from claims_redelivered
                    qualify row_number() over (partition by claim_id order by load_timestamp desc) = 1)"""
ORACLE_S9 = f"""with newer as {NEXT_DELIVERY}
        select {ROW} from (
          select * from newer union all select * from claims where claim_id not in (select claim_id from newer))"""
add(
    "S9_upsert",
    lambda t: etl.upsert(t.claims, _next_delivery(t), ["claim_id"], ["load_timestamp"]).select(
        *NO_TIME, load_date()
    ),
    ORACLE_S9,
)
def _upserted(t):
    """The same through the job, over a partitioned table; some partition values are NULL or hold a colon."""
    store = f"{scratch_dir(t.spark, 'upsert')}/claims"
    day = F.when(F.col("claim_id") % 3 > 0, F.concat(F.col("claim_status"), F.lit(": "), F.col("payer_id").cast("string")))
    etl.replace_version(t.claims.withColumn("kind", day), store, partition_by=["kind"])
    etl.upsert_table(t.spark, store, _next_delivery(t).withColumn("kind", day), ["claim_id"], ["load_timestamp"])
    return versions.read(t.spark, store).select(*NO_TIME, load_date())


add("S9_upsert_table", _upserted, ORACLE_S9)


def _incremental(t):
    """Approved claims first; then all claims, of which some have lost their date, in a source that has grown."""
    base = scratch_dir(t.spark, "incremental")
    late = F.when(F.col("claim_status") == "Pending", F.lit(None)).otherwise(F.col("service_date"))
    source = t.claims.select("claim_id", "claim_status", late.cast("date").alias("service_date"))
    for rows in (source.filter("claim_status = 'Approved'"), source, source):
        incremental.run_incremental(t.spark, rows, f"{base}/claims", f"{base}/control", "service_date", "claim_id")
    return t.spark.read.parquet(f"{base}/claims")


add(
    "T1_incremental_runs",
    _incremental,
    """select claim_id, claim_status, case when claim_status <> 'Pending' then service_date end as service_date
       from claims
       where claim_status in ('Approved', 'Pending')
          or service_date >= (select max(service_date) from claims where claim_status = 'Approved')""",
)
add(
    "T1_load_since",
    lambda t: (
        lambda step: step.rows.select("claim_id", "service_date", F.lit(step.watermark).alias("new_watermark"))
    )(incremental.load_since(t.claims, AS_OF, "service_date")),
    f"""select claim_id, service_date, (select max(service_date) from claims) as new_watermark
        from claims where service_date > {TODAY}""",
)
add(
    "T3_dedupe_append",
    lambda t: incremental.dedupe_append(t.claims, _next_delivery(t), "claim_id", ["load_timestamp"]).select(
        *NO_TIME, load_date()
    ),
    f"select {ROW} from {NEXT_DELIVERY} where claim_id not in (select claim_id from claims)",
)

# ---------------------------------------------------------------- quality scores


def scored(check: str, column: str, counted: str, expr: str, source: str = "claims") -> str:
    return f"""select '{check}' as "check", '{column}' as "column", count(*) as total_rows, {expr} as {counted},
                      {percent_sql(expr, 'count(*)')} as score_pct from {source}"""


IN_PAYER = "count(*) filter (where payer_id in (select payer_id from payer))"
VALID = "count(*) filter (where claim_status in ('Approved', 'Denied'))"
add(
    "A30_row_count",
    lambda t: quality.row_count(t.claims_redelivered),
    "select count(*) as row_count from claims_redelivered",
)
add(
    "Q1_completeness",
    lambda t: quality.completeness(t.claims, "denial_reason"),
    scored("Completeness", "denial_reason", "non_null_rows", "count(denial_reason)"),
)
add(
    "Q2_uniqueness",
    lambda t: quality.uniqueness(t.claims_redelivered, "claim_id"),
    scored("Uniqueness", "claim_id", "distinct_values", "count(distinct claim_id)", "claims_redelivered"),
)
add(
    "Q2_line_uniqueness",
    lambda t: quality.uniqueness(t.raw("lineitem"), "l_orderkey"),
    scored("Uniqueness", "l_orderkey", "distinct_values", "count(distinct l_orderkey)", "lineitem"),
)
add(
    "Q3_validity",
    lambda t: quality.validity(t.claims, "claim_status", ["Approved", "Denied"]),
    scored("Validity", "claim_status", "valid_rows", VALID),
)
add(
    "Q4_integrity",
    lambda t: quality.integrity(t.claims, "payer_id", t.payer, "payer_id"),
    scored("Integrity", "payer_id", "matched_rows", IN_PAYER),
)
add(
    "J12_membership",
    lambda t: quality.integrity(t.raw("lineitem"), "l_partkey", t.raw("part"), "p_partkey"),
    scored(
        "Integrity",
        "l_partkey",
        "matched_rows",
        "count(*) filter (where l_partkey in (select p_partkey from part))",
        "lineitem",
    ),
)
JSON_FIELDS = ["claim_id", "member_id", "payer_id", "denial_reason"]
add(
    "Q5_json_required",
    lambda t: quality.json_required(
        t.claims.select("claim_id", F.to_json(F.struct(*JSON_FIELDS)).alias("json")), "json", JSON_FIELDS
    ).select("claim_id", "is_malformed", "has_all_fields", "missing_fields"),
    """select claim_id, false as is_malformed, payer_id is not null and denial_reason is not null as has_all_fields,
              case when payer_id is null and denial_reason is null then 'payer_id,denial_reason'
                   when payer_id is null then 'payer_id'
                   when denial_reason is null then 'denial_reason' else 'None' end as missing_fields
       from claims""",
)


def _json_index(t):
    """Each record's place among all claims, which are written in claim order with a blank line after every record.

    The claims are written as a folder of files that follow one another, so that no task writes or numbers all of them.
    """
    path = scratch_dir(t.spark, "json-index")
    record = F.concat(F.to_json(F.struct("claim_id")), F.lit("\n"))
    in_order = F.col("claim_id").asc_nulls_last()
    ordered = t.claims.select("claim_id").repartitionByRange(in_order).sortWithinPartitions(in_order)
    ordered.select(record.alias("value")).write.text(path)
    found = readers.index_in_folder(readers.read_json_lines(t.spark, path))
    return found.select(F.get_json_object("json", "$.claim_id").cast("bigint").alias("claim_id"), "record_index")


add("Q5_record_index", _json_index, "select claim_id, row_number() over (order by claim_id) - 1 as record_index from claims")


def _json_file(t):
    """The same records through a file: read raw lines, number them, test their keys."""
    path = scratch_dir(t.spark, "json-lines")
    t.claims.select(F.to_json(F.struct(*JSON_FIELDS)).alias("value")).write.text(path)
    checked = quality.json_required(readers.read_json_lines(t.spark, path), "json", JSON_FIELDS)
    return checked.groupBy("missing_fields").agg(
        F.count("*").alias("records"), F.countDistinct("file", "record_index").alias("numbered")
    )


add(
    "Q5_json_file",
    _json_file,
    """select missing_fields, count(*) as records, count(*) as numbered from (
         select case when payer_id is null and denial_reason is null then 'payer_id,denial_reason'
                     when payer_id is null then 'payer_id'
                     when denial_reason is null then 'denial_reason' else 'None' end as missing_fields from claims)
       group by 1""",
)
add(
    "Q5_event_keys",
    lambda t: quality.json_required(t.raw("events").select("event_id", "props"), "props", ["k", "source"]).select(
        "event_id", "has_all_fields", "missing_fields"
    ),
    """select event_id, json_exists(props, '$.k') and json_exists(props, '$.source') as has_all_fields,
              case when json_exists(props, '$.k') and json_exists(props, '$.source') then 'None'
                   when json_exists(props, '$.k') then 'source'
                   when json_exists(props, '$.source') then 'k' else 'k,source' end as missing_fields
       from events""",
)


def _report(t):
    return quality.report(
        t.claims,
        [
            (quality.COMPLETENESS, "claim_id", None),
            (quality.COMPLETENESS, "denial_reason", None),
            (quality.UNIQUENESS, "claim_id", None),
            (quality.VALIDITY, "claim_status", ["Approved", "Denied", "Pending"]),
            (quality.INTEGRITY, "payer_id", (t.payer, "payer_id")),
        ],
    )


STATUS_OK = "count(*) filter (where claim_status in ('Approved', 'Denied', 'Pending'))"
REPORT = " union all ".join(
    f"""select '{check}' as "check", '{column}' as "column", {percent_sql(expr, 'count(*)')} as score_pct from claims"""
    for check, column, expr in [
        ("Completeness", "claim_id", "count(claim_id)"),
        ("Completeness", "denial_reason", "count(denial_reason)"),
        ("Uniqueness", "claim_id", "count(distinct claim_id)"),
        ("Validity", "claim_status", STATUS_OK),
        ("Integrity", "payer_id", IN_PAYER),
    ]
)
add("Q6_report", _report, f'select *, score_pct >= 95.0 as "pass" from ({REPORT})')
add(
    "Q7_column_tests",
    lambda t: quality.run_tests(
        t.claims_redelivered,
        {
            "claim_id": ["unique", "not_null"],
            "claim_status": ["not_null", ("accepted_values", ["Approved", "Denied"])],
            "payer_id": ["not_null"],
        },
    ),
    """select "column", test, failures, failures = 0 as passed from (
         select 'claim_id' as "column", 'unique' as test, count(*) as failures
           from (select claim_id from claims_redelivered group by 1 having count(*) > 1)
         union all select 'claim_id', 'not_null', count(*) - count(claim_id) from claims_redelivered
         union all select 'claim_status', 'not_null', count(*) - count(claim_status) from claims_redelivered
         union all select 'claim_status', 'accepted_values',
                          count(*) filter (where claim_status not in ('Approved', 'Denied')) from claims_redelivered
         union all select 'payer_id', 'not_null', count(*) - count(payer_id) from claims_redelivered)""",
)
add(
    "Q8_reconcile",
    lambda t: quality.reconcile(etl.classify_claims(t.claims, t.members, t.providers), stage="lookup"),
    """select 'lookup' as stage, count(*) as source_rows,
              count(*) filter (where m.member_id is not null and p.provider_id is not null) as loaded_rows,
              count(*) filter (where m.member_id is null or p.provider_id is null) as rejected_rows,
              true as balanced
       from claims c left join members m on m.member_id = c.member_id
                     left join providers p on p.provider_id = c.provider_id""",
)
add(
    "Q9_scorecard",
    lambda t: quality.scorecard(_report(t)),
    f"""select "check", count(*) as checks, {mean_sql('score_pct')} as score from ({REPORT}) group by 1""",
)


def _history(t):
    """One completeness score per claim status and load day, as a score history."""
    day = F.col("load_timestamp").cast("date")
    counted = t.claims.groupBy(day.alias("run_timestamp")).agg(
        F.count("*").alias("n"), F.count("payer_id").alias("payers"), F.count("denial_reason").alias("reasons")
    )
    rows = [
        F.struct(
            F.lit("Completeness").alias("check"),
            F.lit(c).alias("column"),
            quality.percent(counted[n], counted["n"]).alias("score_pct"),
        )
        for c, n in (("payer_id", "payers"), ("denial_reason", "reasons"))
    ]
    return counted.select("run_timestamp", F.inline(F.array(*rows)))


add(
    "Q10_latest_scores",
    lambda t: quality.latest_scores(_history(t)),
    f"""with days as (select cast(load_timestamp as date) as run_timestamp, * exclude (load_timestamp) from claims),
             last_day as (select * from days where run_timestamp = (select max(run_timestamp) from days))
        select run_timestamp, 'Completeness' as "check", 'payer_id' as "column",
               {percent_sql('count(payer_id)', 'count(*)')} as score_pct from last_day group by 1
        union all
        select run_timestamp, 'Completeness', 'denial_reason',
               {percent_sql('count(denial_reason)', 'count(*)')} from last_day group by 1""",
)
PROFILED = {"claim_id": True, "billed_amount": True, "claim_status": False, "service_date": False}
add(
    "A17_profile",
    lambda t: quality.profile(t.claims, list(PROFILED)),
    " union all ".join(
        f"""select '{c}' as "column", count({c}) as "count",
                   {f'cast(sum(cast({c} as decimal(38,2))) as double) / count({c})' if numeric else 'cast(null as double)'}
                     as mean,
                   {f'round(stddev_samp(cast({c} as double)), 4)' if numeric else 'cast(null as double)'} as stddev,
                   cast(min({c}) as varchar) as "min", cast(max({c}) as varchar) as "max"
            from claims"""
        for c, numeric in PROFILED.items()
    ),
)

# ---------------------------------------------------------------- routing and change jobs

ROUTED = """select c.claim_id, case when m.member_id is null then 'member not found'
                                    when p.provider_id is null then 'provider not found' end as reject_reason
            from claims c left join members m on m.member_id = c.member_id
                          left join providers p on p.provider_id = c.provider_id"""
add(
    "J11_routed_accepted",
    lambda t: etl.route_claims(t.claims, t.members, t.providers)[0].select("claim_id"),
    f"select claim_id from ({ROUTED}) where reject_reason is null",
)
add(
    "U4_merged_rejects",
    lambda t: etl.route_claims(t.claims, t.members, t.providers)[1].select("claim_id", "reject_reason"),
    f"select claim_id, reject_reason from ({ROUTED}) where reject_reason is not null",
)


def _requests(t):
    return t.raw("customer").selectExpr(
        "c_custkey as request_id",
        "c_name as member_name",
        "date'1990-05-15' as date_of_birth",
        "case c_custkey % 7 when 3 then 'X' when 4 then 'F' when 5 then 'U' else 'M' end as gender",
        "case c_custkey % 5 when 0 then 'HMO' when 1 then 'PPO ' when 2 then 'EPO' when 3 then 'HDHP' else 'PPO' end"
        " as plan_type",
        "'TX' as state",
    )


REQUESTS = """select c_custkey as request_id, c_name as member_name,
                     case when c_custkey % 7 = 3 then -1 when c_custkey % 5 = 3 then -2 else 0 end as return_code,
                     case c_custkey % 7 when 4 then 'F' when 5 then 'U' else 'M' end as gender,
                     case c_custkey % 5 when 0 then 'HMO' when 2 then 'EPO' else 'PPO' end as plan_type
              from customer"""
NEW_ID = "row_number() over (order by request_id) + (select max(member_id) from members)"
add(
    "D1_enrolled_members",
    lambda t: etl.enroll_members(t.members, _requests(t), AS_OF)[0],
    f"""select {NEW_ID} as member_id, member_name, date '1990-05-15' as date_of_birth, gender, plan_type,
               'TX' as state, {TODAY} as enrollment_date, cast(null as date) as disenroll_date
        from ({REQUESTS}) where return_code = 0""",
)
add(
    "D1_enroll_outcomes",
    lambda t: etl.enroll_members(t.members, _requests(t), AS_OF)[1],
    f"""select request_id, return_code, {NEW_ID} as new_member_id, cast(null as varchar) as message
        from ({REQUESTS}) where return_code = 0
        union all
        select request_id, return_code, null, case return_code when -1 then '{etl.BAD_GENDER}'
               else '{etl.BAD_PLAN}' end
        from ({REQUESTS}) where return_code < 0""",
)


def _term_requests(t):
    return t.raw("supplier").selectExpr(
        "s_suppkey * 3 as provider_id",
        "date_add(date'1999-06-30', cast(s_suppkey * 17 % 400 as int)) as term_date",
        "'admin' as changed_by",
    )


def _terminate(t):
    return etl.terminate_providers(t.providers, t.contracts, _term_requests(t), RUN_AT)


TERMS = """(select s_suppkey * 3 as provider_id, date '1999-06-30' + cast(s_suppkey * 17 % 400 as int) as new_term
            from supplier)"""
add(
    "D2_terminated_providers",
    lambda t: _terminate(t).providers.select("provider_id", "provider_name", "term_date"),
    f"""select p.provider_id, provider_name, coalesce(new_term, term_date) as term_date
        from providers p left join {TERMS} r on r.provider_id = p.provider_id""",
)
add(
    "D2_closed_contracts",
    lambda t: _terminate(t).contracts,
    f"""select c.*, coalesce(end_date < start_date, false) as ends_before_start from (
          select n.contract_id, n.provider_id, contract_type, rate_modifier, start_date,
                 case when p.provider_id is not null and new_term is not null
                       and (end_date is null or end_date > new_term) then new_term else end_date end as end_date
          from network_contracts n left join {TERMS} r on r.provider_id = n.provider_id
                                   left join providers p on p.provider_id = n.provider_id) c""",
)
add(
    "D2_change_log",
    lambda t: _terminate(t).audit.withColumn("change_date", F.col("change_date").cast("date")),
    f"""select 'providers' as table_name, 'UPDATE' as operation, provider_id as record_id, 'admin' as changed_by,
               {TODAY} as change_date, '{etl.TERMINATION_NOTE}' || cast(new_term as varchar) as notes
        from {TERMS} join providers using (provider_id)""",
)
add(
    "D2_outcomes",
    lambda t: _terminate(t).outcomes,
    f"""select r.provider_id, case when p.provider_id is null then {etl.PROVIDER_NOT_FOUND_CODE} else 0 end as error_number,
               case when p.provider_id is null then '{etl.PROVIDER_NOT_FOUND}'
                    else '{etl.TERMINATED}' end as message
        from {TERMS} r left join providers p on p.provider_id = r.provider_id""",
)
add(
    "D3_backfill_payer",
    lambda t: etl.backfill_payer(
        t.claims, t.members.select("member_id", (F.col("member_id") % 25).alias("payer_id"))
    ).select("claim_id", "payer_id"),
    "select claim_id, coalesce(payer_id, member_id % 25) as payer_id from claims",
)
add(
    "D3_backfill_load_ts",
    lambda t: etl.backfill_load_ts(
        t.claims.withColumn("load_timestamp", F.when(F.col("claim_status") != "Pending", F.col("load_timestamp")))
    ).select("claim_id", load_date()),
    """select claim_id, case when claim_status <> 'Pending' then cast(load_timestamp as date)
                             else service_date + 3 end as load_date from claims""",
)
add(
    "D4_convert_claims",
    lambda t: etl.convert_claims(t.inbound).withColumnRenamed("conversion_errors", "errors"),
    """select *, try_cast(claim_id as bigint) as conv_claim_id, cast(member_id as bigint) as conv_member_id,
              cast(provider_id as bigint) as conv_provider_id,
              try_cast(billed_amount as decimal(10,2)) as conv_billed_amount,
              cast(allowed_amount as decimal(10,2)) as conv_allowed_amount,
              cast(paid_amount as decimal(10,2)) as conv_paid_amount,
              case claim_status when 'PAID' then 'Approved' when 'DENIED' then 'Denied' else 'Pending' end
                as conv_claim_status,
              case when length(diagnosis_code) <= 10 then diagnosis_code end as conv_diagnosis_code,
              procedure_code as conv_procedure_code,
              try_cast(service_date as date) as conv_service_date,
              cast(null as date) as conv_admit_date, cast(null as date) as conv_discharge_date,
              concat_ws('; ', case when claim_id like 'C%' then 'claim_id: not a whole number' end,
                        case when billed_amount = 'n/a' then 'billed_amount: not a numeric(10,2)' end,
                        case when length(diagnosis_code) > 10 then 'diagnosis_code: longer than 10' end,
                        case when service_date = '2020-02-30' then 'service_date: not a date' end) as errors
       from inbound""",
)
add(
    "D6_dim_date",
    lambda t: readers.dim_date_for(t.claims, "service_date"),
    """select cast(strftime(d, '%Y%m%d') as int) as date_key, cast(d as date) as full_date,
              cast(year(d) as int) as calendar_year, cast(month(d) as int) as calendar_month,
              monthname(d) as month_name, cast(quarter(d) as int) as calendar_quarter, dayname(d) as day_of_week
       from (select unnest(generate_series(min(service_date), max(service_date), interval 1 day)) as d from claims)""",
)


def _enrolled(t):
    """The job over written tables, run twice: the second run finds every request answered."""
    base = scratch_dir(t.spark, "enrollment-job")
    t.members.write.parquet(f"{base}/members")
    for _ in range(2):
        etl.run_enrollment(t.spark, f"{base}/members", _requests(t), f"{base}/outcomes", AS_OF)
    members = t.spark.read.parquet(f"{base}/members").filter(F.col("enrollment_date") == F.lit(AS_OF))
    outcomes = t.spark.read.parquet(f"{base}/outcomes").filter("return_code = 0")
    return outcomes.join(members, outcomes.new_member_id == members.member_id, "left").select(
        "request_id", "new_member_id", "member_name", "plan_type", "gender"
    )


add(
    "D1_enrollment_job",
    _enrolled,
    f"""select request_id, {NEW_ID} as new_member_id, member_name, plan_type, gender
        from ({REQUESTS}) where return_code = 0""",
)


def _terminated(t):
    """The job over a version store, run twice; contracts and log entries of each provider afterwards."""
    store = scratch_dir(t.spark, "termination-job")
    with versions.change(t.spark, store) as change:
        change.replace("providers", t.providers)
        change.replace("contracts", t.contracts)
    for _ in range(2):
        etl.run_termination(t.spark, store, _term_requests(t), RUN_AT)
    read = lambda name: versions.read(t.spark, store, name)
    log = read("change_log").groupBy(F.col("record_id").alias("provider_id")).agg(F.count("*").alias("entries"))
    ends = read("contracts").groupBy("provider_id").agg(F.max("end_date").alias("last_end"))
    return (
        read("providers").select("provider_id", "term_date").join(log, "provider_id", "left").join(ends, "provider_id", "left")
    )


add(
    "D2_termination_job",
    _terminated,
    f"""with closed as (
          select n.provider_id, max(case when p.provider_id is not null and new_term is not null
                       and (end_date is null or end_date > new_term) then new_term else end_date end) as last_end
          from network_contracts n left join {TERMS} r on r.provider_id = n.provider_id
                                   left join providers p on p.provider_id = n.provider_id group by 1)
        select p.provider_id, coalesce(new_term, term_date) as term_date,
               case when new_term is not null then cast(1 as bigint) end as entries, last_end
        from providers p left join {TERMS} r on r.provider_id = p.provider_id
                         left join closed c on c.provider_id = p.provider_id""",
)
add(
    "A17_rate_profile",
    lambda t: quality.profile(
        t.raw("lineitem").select((F.col("l_quantity").cast("decimal(9,4)") * F.lit("1.0007").cast("decimal(5,4)")).cast("decimal(9,4)").alias("rate"))
    ).select("column", "count", "mean", "min", "max"),
    """select 'rate' as "column", count(*) as count, cast(sum(rate) as double) / count(*) as mean,
              cast(min(rate) as varchar) as min, cast(max(rate) as varchar) as max
       from (select cast(cast(l_quantity as decimal(9,4)) * cast(1.0007 as decimal(5,4)) as decimal(9,4)) as rate from lineitem)""",
)
