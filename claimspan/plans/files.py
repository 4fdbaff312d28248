"""Registered queries that write files to the shared scratch folder and read them back."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from claimspan.operators import edi, etl, versions, views
from claimspan.plans.bindings import AS_OF, CLAIM_COLUMNS, Tables, money_sql
from claimspan.plans.registry import add
from claimspan.session import scratch_dir
from claimspan.sources import readers
from claimspan.sources.schemas import ENROLLMENT_FIELDS, INBOUND_COLUMNS
from claimspan.streaming import files as streams

RUN_AT = datetime(2000, 6, 30, 12, 0)
FILE_COLUMNS = [c for c in CLAIM_COLUMNS if c != "load_timestamp"]
ALL_CLAIMS = f"select {', '.join(FILE_COLUMNS)} from claims"
FIELDS = ", ".join(ENROLLMENT_FIELDS)
TRADING_PARTNERS = {
    "sender": "TESTPAYROLL",
    "receiver": "TESTPLAN",
    "payer": "PLAN UNDER TEST",
    "payer_id": "P-1",
    "sponsor": "EMPLOYER UNDER TEST",
    "sponsor_id": "S-1",
}

# ---------------------------------------------------------------- claim files and tables


def _claims_csv(t: Tables) -> str:
    path = scratch_dir(t.spark, "claims-csv")
    t.claims.select(*FILE_COLUMNS).write.option("header", True).csv(path)
    return path


def _csv(t: Tables) -> DataFrame:
    return readers.read_claims_csv(t.spark, _claims_csv(t), t.claims.select(*FILE_COLUMNS).schema)


def _json(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "claims-json")
    t.claims.select(*FILE_COLUMNS).write.json(path)
    types = {"service_date": "date", "billed_amount": "decimal(10,2)", "allowed_amount": "decimal(10,2)",
             "paid_amount": "decimal(10,2)"}
    found = readers.read_json(t.spark, path)
    return found.select(*[F.col(c).cast(types[c]) if c in types else F.col(c) for c in FILE_COLUMNS])


def write_inbound(t: Tables) -> str:
    path = scratch_dir(t.spark, "inbound")
    t.inbound.write.option("header", True).option("quote", "").option("encoding", "iso-8859-1").csv(path)
    return path


def _table(t: Tables, rewrite) -> DataFrame:
    """Run ``rewrite(table name, new path)`` on a table of approved claims and return its final rows."""
    name = f"claimspan_{uuid4().hex[:12]}"
    etl.save_table(
        views.stg_claims(t.claims).filter("claim_status = 'Approved'"), name, path=scratch_dir(t.spark, name)
    )
    rewrite(name, scratch_dir(t.spark, name))
    schema = t.spark.table(name).schema
    location = t.spark.sql(f"describe formatted {name}").filter("col_name = 'Location'").first()["data_type"]
    t.spark.sql(f"drop table {name}")  # external: the files stay
    return t.spark.read.schema(schema).parquet(location)


def _copied(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "copy")
    etl.copy_table(t.claims.select(*FILE_COLUMNS), path)
    return t.spark.read.parquet(path)


def _saved(t: Tables) -> DataFrame:
    name = f"claimspan_{uuid4().hex[:12]}"
    path = scratch_dir(t.spark, name)
    etl.save_table(views.claims_by_status(t.claims), name, path=path)
    etl.save_table(views.stg_claims(t.claims), name, path=path)
    t.spark.sql(f"drop table {name}")  # external: the files stay
    return t.spark.read.parquet(path)


add("S1_read_csv", _csv, ALL_CLAIMS)
add(
    "S1_read_csv_inferred",
    lambda t: readers.read_claims_csv(t.spark, _claims_csv(t)).select(
        "claim_id", "member_id", "provider_id", "service_date", "claim_status", "denial_reason"
    ),
    """select cast(claim_id as integer) as claim_id, cast(member_id as integer) as member_id,
              cast(provider_id as integer) as provider_id, service_date, claim_status, denial_reason from claims""",
)
add("S2_read_json", _json, ALL_CLAIMS)
add(
    "S3_inbound_claims",
    lambda t: readers.read_inbound_claims(t.spark, write_inbound(t)),
    f"select {', '.join(INBOUND_COLUMNS)} from inbound",
)
add("S5_copy_table", _copied, ALL_CLAIMS)
add("S7_save_table", _saved, "select claim_id, member_id, provider_id, claim_status, billed_amount from claims")
add(
    "S8_append_table",
    lambda t: _table(
        t, lambda name, _: etl.append_table(views.stg_claims(t.claims).filter("claim_status <> 'Approved'"), name)
    ),
    "select claim_id, member_id, provider_id, claim_status, billed_amount from claims",
)
add(
    "S10_replace_table",
    lambda t: _table(
        t, lambda name, path: etl.replace_table(t.claims.select("claim_id", "payer_id"), name, path)
    ),
    "select claim_id, payer_id from claims",
)


def _replaced(t: Tables) -> DataFrame:
    """A table in a version store, whose rows and schema are replaced."""
    store = scratch_dir(t.spark, "replace-version")
    etl.replace_version(views.stg_claims(t.claims), store)
    etl.replace_version(t.claims.select("claim_id", "payer_id"), store)
    return versions.read(t.spark, store)


add("S10_replace_version", _replaced, "select claim_id, payer_id from claims")


def _registry(t: Tables) -> DataFrame:
    """Landed registry answers for every provider: some empty, some without a location address."""
    answers = t.raw("supplier").selectExpr(
        "cast(1000000000 + s_suppkey as string) as npi",
        """to_json(named_struct('results', if(s_suppkey % 6 = 0, array(), array(named_struct(
             'basic', named_struct('credential', if(s_suppkey % 4 = 0, null, 'MD'), 'status', 'A'),
             'taxonomies', if(s_suppkey % 5 = 0, array(), array(named_struct('desc', concat('T', s_nationkey)),
                                                                named_struct('desc', 'second'))),
             'addresses', array(
               named_struct('address_purpose', 'MAILING', 'city', 'MAILTOWN', 'state', 'MT'),
               named_struct('address_purpose', if(s_suppkey % 3 = 0, 'OTHER', 'LOCATION'),
                            'city', concat('CITY', s_nationkey), 'state', 'TX'))))))) as payload""",
    )
    path = scratch_dir(t.spark, "registry")
    answers.write.json(path)
    landed = t.spark.read.schema("npi string, payload string").json(path)
    return readers.enrich_registry(t.providers.select("provider_id", "npi"), landed)


add(
    "S14_enrich_registry",
    _registry,
    """select s_suppkey as provider_id, cast(1000000000 + s_suppkey as varchar) as npi,
              case when s_suppkey % 6 <> 0 and s_suppkey % 4 <> 0 then 'MD' end as npi_credential,
              case when s_suppkey % 6 <> 0 then 'A' end as npi_status,
              case when s_suppkey % 6 <> 0 and s_suppkey % 3 <> 0 then concat('CITY', cast(s_nationkey as varchar)) end
                as npi_city,
              case when s_suppkey % 6 <> 0 and s_suppkey % 3 <> 0 then 'TX' end as npi_state,
              case when s_suppkey % 6 <> 0 and s_suppkey % 5 <> 0 then concat('T', cast(s_nationkey as varchar)) end
                as npi_specialty
       from supplier""",
)

# ---------------------------------------------------------------- claim loads


def _loaded(t: Tables) -> tuple[DataFrame, str]:
    base, inbound = scratch_dir(t.spark, "load-job"), write_inbound(t)
    for _ in range(2):  # the second run must reject everything it finds loaded
        result = etl.load_new_claims(
            t.spark, inbound, t.members, t.providers, f"{base}/claims", f"{base}/rejects", f"{base}/log", RUN_AT
        )
        if not result.balanced:
            raise RuntimeError(f"load does not balance: {result}")
    return t.spark.read.parquet(f"{base}/claims"), base


INBOUND_OUTCOME = """
    select i.*, concat_ws('; ', case when i.claim_id like 'C%' then 'claim_id: not a whole number' end,
                          case when i.billed_amount = 'n/a' then 'billed_amount: not a numeric(10,2)' end,
                          case when length(i.diagnosis_code) > 10 then 'diagnosis_code: longer than 10' end,
                          case when i.service_date = '2020-02-30' then 'service_date: not a date' end) as errors,
           m.member_id is not null as member_ok, p.provider_id is not null as provider_ok
    from inbound i left join members m on cast(m.member_id as varchar) = i.member_id
                   left join providers p on cast(p.provider_id as varchar) = i.provider_id"""
add(
    "D5_load_new_claims",
    lambda t: _loaded(t)[0].drop("load_timestamp", "admit_date", "discharge_date"),
    f"""select cast(claim_id as bigint) as claim_id, cast(member_id as bigint) as member_id,
               cast(provider_id as bigint) as provider_id, cast(service_date as date) as service_date,
               diagnosis_code, procedure_code, cast(billed_amount as decimal(10,2)) as billed_amount,
               cast(allowed_amount as decimal(10,2)) as allowed_amount,
               cast(paid_amount as decimal(10,2)) as paid_amount,
               case claim_status when 'PAID' then 'Approved' when 'DENIED' then 'Denied' else 'Pending' end
                 as claim_status, denial_reason
        from ({INBOUND_OUTCOME}) where errors = '' and member_ok and provider_ok""",
)
add(
    "D5_run_log",
    lambda t: t.spark.read.parquet(f"{_loaded(t)[1]}/log").drop("run_timestamp"),
    f"""with o as ({INBOUND_OUTCOME}),
             n as (select count(*) filter (where errors = '' and member_ok and provider_ok) as ok,
                          count(*) filter (where not (errors = '' and member_ok and provider_ok)) as bad from o)
        select 'load_new_claims' as package_name, ok as rows_inserted, bad as rows_rejected, 'Success' as status from n
        union all select 'load_new_claims', 0, ok + bad, 'Success' from n""",
)


add(
    "D5_rejects",
    lambda t: t.spark.read.option("header", True).csv(f"{_loaded(t)[1]}/rejects").select("claim_id", "reject_reason"),
    f"""select claim_id, coalesce(nullif(errors, ''), case when not member_ok then 'member not found'
                                                       when not provider_ok then 'provider not found'
                                                       else 'claim already loaded' end) as reject_reason
        from ({INBOUND_OUTCOME})""",
)


def _stream_copy(t: Tables) -> DataFrame:
    """Arriving files -> stream -> table; processed files move to the archive."""
    base = scratch_dir(t.spark, "arrivals")
    schema = t.inbound.schema
    t.inbound.write.option("header", True).csv(f"{base}/in")
    stream = streams.file_stream(t.spark, f"{base}/in", schema, f"{base}/archive", header="true")
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return t.spark.read.schema(schema).parquet(f"{base}/out")


def _ingest(t: Tables) -> DataFrame:
    """Two deliveries: all claims, then all again with corrected amounts, padded ids and blank ids."""
    base = scratch_dir(t.spark, "ingest")

    def deliver(rows: DataFrame) -> None:
        options = {"header": True, "quote": "", "encoding": "iso-8859-1", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        rows.write.mode("append").options(**options).csv(f"{base}/in")
        stream = streams.inbound_stream(t.spark, f"{base}/in")
        streams.start_claims_ingest(stream, t.members, t.providers, f"{base}/claims", f"{base}/checkpoint").awaitTermination()

    deliver(t.inbound)
    changed = F.when(F.col("claim_status") == "DENIED", F.concat(F.lit(" "), "claim_id")).when(F.col("claim_status") == "PAID", F.lit("  "))
    corrected = F.when((F.col("claim_status") == "PENDING") & (F.col("billed_amount") == "n/a"), F.lit("10.00"))
    again = t.inbound.withColumn("claim_id", F.coalesce(changed, "claim_id"))
    deliver(again.withColumn("billed_amount", F.coalesce(corrected, "billed_amount")))
    return t.spark.read.parquet(f"{base}/claims").select(F.trim("claim_id").alias("claim_id"), "outcome", "reject_reason")


add("S12_file_arrival", _stream_copy, f"select {', '.join(INBOUND_COLUMNS)} from inbound")
FIRST_DELIVERY = f"""
    select claim_id, claim_status, errors, member_ok, provider_ok,
           coalesce(nullif(errors, ''), case when not member_ok then 'member not found'
                                             when not provider_ok then 'provider not found' end) as reason
    from ({INBOUND_OUTCOME})"""
add(
    "T2_stream_ingest",
    _ingest,
    f"""with first_one as ({FIRST_DELIVERY}),
        second_one as (
          select if(claim_status = 'PAID', '', claim_id) as claim_id, member_ok, provider_ok, reason is null as loaded,
                 case when claim_status = 'PAID'
                        then concat_ws('; ', nullif(regexp_replace(errors, '^claim_id: not a whole number(; )?', ''), ''),
                                       'claim_id: missing')
                      when claim_status = 'PENDING'
                        then array_to_string(list_filter(string_split(errors, '; '),
                                                         lambda x: x <> '' and not starts_with(x, 'billed_amount')), '; ')
                      else errors end as errors
          from first_one)
        select claim_id, case when reason is null then 'accepted' else 'rejected' end as outcome, reason as reject_reason
        from first_one
        union all
        select claim_id, case when r is null then 'accepted' else 'rejected' end, r from (
          select claim_id, coalesce(nullif(errors, ''), case when not member_ok then 'member not found'
                                                             when not provider_ok then 'provider not found'
                                                             when loaded then 'claim already loaded' end) as r
          from second_one)""",
)


def _stream_summary(t: Tables) -> DataFrame:
    schema = t.raw("orders").schema
    orders = streams.file_stream(t.spark, f"{t.sf_dir}/orders.parquet*", schema, file_format="parquet")
    summary = streams.stream_summary(t.claims_from(orders))
    base = scratch_dir(t.spark, "summary")
    return streams.run_summary(summary, f"{base}/table", f"{base}/checkpoint")


add(
    "T4_stream_summary",
    _stream_summary,
    f"""select claim_status, count(*) as claim_count, {money_sql('sum(billed_amount)')} as total_billed_amount
        from claims group by claim_status""",
)

# ---------------------------------------------------------------- enrollment files

EXPORT_FILES = 4


def export_834(t: Tables) -> str:
    path = scratch_dir(t.spark, "enrollment-834")
    edi.write_834(t.enrollment, path, ["last_name"], TRADING_PARTNERS, RUN_AT, files=EXPORT_FILES)
    return path


def _segment_sql() -> str:
    """Every member segment of the export as text."""
    programs = "case line_of_business when 'Medicaid' then 'MCD' when 'Medicare' then 'MCR'" \
        " when 'Marketplace' then 'MKP' when 'Duals' then 'DUL' else line_of_business end"
    parts = [
        ("'INS*Y*18*030*XN*A*E*N'", "true"),
        ("'REF*0F*' || member_id", "member_id <> ''"),
        (f"'REF*17*' || {programs}", "true"),
        ("'REF*1L*' || plan_code", "plan_code <> ''"),
        ("'DTP*348*D8*' || replace(coverage_effective_date, '-', '')", "true"),
        ("'DTP*349*D8*' || replace(term_date, '-', '')", "true"),
        ("'NM1*IL*1*' || last_name || '*' || first_name || '****' ||"
         " case when member_id <> '' then 'ZZ' else '' end || '*' || member_id", "true"),
        ("'PER*IP**TE*' || phone", "phone <> ''"),
        ("'HD*030**HLT*' || case when plan_code <> '' then plan_code else 'UNSPECIFIED' end", "true"),
    ]
    return " union all ".join(f"select {text} as segment from enrollment where {test}" for text, test in parts)


SEGMENTS = _segment_sql()
OUTSIDE = ("ISA", "GS", "ST", "BGN", "N1", "SE", "GE", "IEA")
add(
    "S4_read_segments",
    lambda t: edi.read_segments(t.spark, export_834(t)).groupBy("segment_id").agg(
        F.count("*").alias("segments"), F.sum(F.size("elements")).alias("elements")
    ),
    f"""select split_part(segment, '*', 1) as segment_id, count(*) as segments,
               cast(sum(length(segment) - length(replace(segment, '*', '')) + 1) as bigint) as elements
        from ({SEGMENTS}) group by 1
        union all select * from (values ('ISA', 4, 68), ('GS', 4, 36), ('ST', 4, 12), ('BGN', 4, 36), ('N1', 8, 40),
                                        ('SE', 4, 12), ('GE', 4, 12), ('IEA', 4, 12))""",
)
add(
    "S15_write_834",
    lambda t: edi.read_segments(t.spark, export_834(t))
    .filter(~F.col("segment_id").isin(*OUTSIDE))
    .select(F.array_join("elements", "*").alias("segment")),
    SEGMENTS,
)
add(
    "E1_segment_scan",
    lambda t: edi.read_segments(t.spark, export_834(t))
    .filter(F.col("segment_id").isin("REF", "DTP"))
    .groupBy("segment_id", F.get("elements", F.lit(1)).alias("qualifier"))
    .agg(F.count("*").alias("segments")),
    f"""select split_part(segment, '*', 1) as segment_id, split_part(segment, '*', 2) as qualifier,
               count(*) as segments
        from ({SEGMENTS}) where segment like 'REF*%' or segment like 'DTP*%' group by 1, 2""",
)
add(
    "E2_member_loops",
    lambda t: edi.member_loops(edi.read_segments(t.spark, export_834(t)))
    .groupBy("file", "loop_no")
    .agg(F.count("*").alias("segments_in_loop"))
    .groupBy("segments_in_loop")
    .agg(F.count("*").alias("loops")),
    """select cast(6 + cast(member_id <> '' as int) + cast(plan_code <> '' as int) + cast(phone <> '' as int) as bigint)
                as segments_in_loop, count(*) as loops
       from enrollment group by 1""",
)
add(
    "E3_parse_members",
    lambda t: edi.parse_834(t.spark, export_834(t)).select(*ENROLLMENT_FIELDS),
    f"select {FIELDS} from enrollment",
)
RULES = [
    ("trim(member_id) = ''", "CRITICAL", "member_id", "'Member ID is missing.'"),
    (
        "line_of_business not in ('Medicaid', 'Medicare', 'Marketplace', 'Duals')",
        "CRITICAL",
        "line_of_business",
        "'Line of Business ''' || line_of_business || ''' does not map to a recognized program"
        " (Medicaid/Medicare/Marketplace/Duals) and cannot be routed.'",
    ),
    (
        "try_cast(coverage_effective_date as date) is null",
        "CRITICAL",
        "coverage_effective_date",
        "'Coverage effective date ''' || coverage_effective_date || ''' is not a valid date.'",
    ),
    ("trim(phone) = ''", "WARNING", "phone", "'Phone number is missing.'"),
    ("trim(plan_code) = ''", "WARNING", "plan_code", "'Plan code is missing or ambiguous.'"),
    (
        f"cast(term_date as date) < date '{AS_OF}'",
        "WARNING",
        "term_date",
        "'Term date ' || term_date || ' is in the past relative to processing date.'",
    ),
]
ISSUES = " union all ".join(
    f"""select {FIELDS}, '{severity}' as severity, '{field}' as field, {text} as issue from enrollment where {test}"""
    for test, severity, field, text in RULES
)
CRITICAL = " or ".join(f"({test})" for test, severity, _, _ in RULES if severity == "CRITICAL")
WARNING = " or ".join(f"({test})" for test, severity, _, _ in RULES if severity == "WARNING")
DECIDED = f"""select {FIELDS}, case when {CRITICAL} then 'REJECTED' else 'LOADED' end as load_status,
                     case when not ({CRITICAL}) and ({WARNING}) then 'YES' else 'NO' end as flagged_for_review,
                     {' + '.join(f'cast(({test}) as int)' for test, _, _, _ in RULES)} as issue_count
              from enrollment"""
AUDIT = f"""select case when member_id = '' then '(missing)' else member_id end as member_id, severity, field, issue,
                   case when {CRITICAL} then 'REJECTED' else 'LOADED' end as outcome from ({ISSUES})
            union all
            select case when member_id = '' then '(missing)' else member_id end, 'NONE', '', 'No issues found.',
                   load_status from ({DECIDED}) where issue_count = 0"""


def _decided(t: Tables) -> DataFrame:
    return edi.decide(edi.validate(t.enrollment, AS_OF))


add(
    "E4_validate",
    lambda t: edi.validate(t.enrollment, AS_OF).select("last_name", F.posexplode("issues")).select(
        "last_name", "col.severity", "col.field", "col.issue"
    ),
    f"select last_name, severity, field, issue from ({ISSUES})",
)
add(
    "E5_route_loaded",
    lambda t: edi.route(_decided(t))[0],
    f"select * exclude (issue_count) from ({DECIDED}) where load_status = 'LOADED'",
)
add(
    "E5_route_rejected",
    lambda t: edi.route(_decided(t))[1],
    f"select * exclude (issue_count) from ({DECIDED}) where load_status = 'REJECTED'",
)
add("E6_audit_log", lambda t: edi.audit_log(_decided(t)), AUDIT)
add(
    "E7_summary",
    lambda t: edi.summary(_decided(t)),
    f"""select count(*) as total_records, count(*) filter (where load_status = 'LOADED') as loaded,
               count(*) filter (where flagged_for_review = 'YES') as flagged,
               count(*) filter (where load_status = 'REJECTED') as rejected,
               cast(sum(greatest(issue_count, 1)) as bigint) as audit_rows,
               count(*) filter (where member_id = '') as missing_member_id,
               count(*) filter (where plan_code = '') as missing_plan_code,
               count(*) filter (where phone = '') as missing_phone
        from ({DECIDED})""",
)
add(
    "E8_check_envelope",
    lambda t: edi.check_envelope(edi.read_segments(t.spark, export_834(t))).agg(
        F.count("*").alias("transactions"),
        F.sum("declared_count").alias("declared_count"),
        F.sum("segment_count").alias("segment_count"),
        F.every("matches").alias("all_match"),
    ),
    f"""select cast(4 as bigint) as transactions, count(*) + 20 as declared_count, count(*) + 20 as segment_count, true as all_match
        from ({SEGMENTS})""",
)


#: An interchange per customer, and what is wrong with every fortieth, by the remainder of the customer's key.
ENVELOPE_FAULTS = """
    1 ST unclosed; 1 GS closed before its content; 2 ST control numbers differ; 3 GS unclosed; 3 ISA closed before its content;
    4 ST unopened; 5 GS count differs; 6 ST control number repeated; 7 ISA unclosed; 8 GS control numbers differ;
    9 GS closed before its content; 10 ISA count differs; 11 ISA control number repeated"""


def _enveloped(t: Tables) -> str:
    path = scratch_dir(t.spark, "envelopes")
    rows = t.raw("customer").selectExpr("c_custkey as c", "c_custkey % 40 as fault")
    isa, gs, st = "concat('ISA', repeat('*0', 12), '*', c)", "concat('GS', repeat('*0', 5), '*', c)", "concat('ST*834*', c)"
    body = rows.selectExpr("c", "fault", f"""array_compact(array(
        {isa}, {gs}, {st}, 'INS*Y*18', concat('REF*0F*', c),
        if(fault in (1, 9), null, concat('SE*4*', if(fault = 2, c + 1, c))),
        if(fault in (4, 6), if(fault = 6, {st}, concat('SE*4*', c)), null), if(fault = 6, concat('SE*2*', c), null),
        if(fault = 3, null, concat('GE*', if(fault in (5, 6), 2, 1), '*', if(fault = 8, c + 1, c))),
        if(fault = 9, concat('SE*4*', c), null),
        if(fault = 7, null, concat('IEA*', if(fault = 10, 5, 1), '*', c)))) as segments""")
    twice = "if(fault = 11, concat(segments, segments), segments)"
    body.selectExpr("c", f"concat_ws('~\n', {twice}) as value").repartitionByRange("c").sortWithinPartitions("c").select(
        "value").write.option("lineSep", "~\n").text(path)
    return path


add(
    "E8_envelopes",
    lambda t: edi.envelope_issues(edi.read_segments(t.spark, _enveloped(t))).drop("file"),
    " union all ".join(
        f"select '{envelope}' as envelope, cast(c_custkey as varchar) as control_number, '{issue}' as issue from customer where c_custkey % 40 = {fault}"
        for fault, envelope, issue in (f.split(maxsplit=2) for f in ENVELOPE_FAULTS.split(";"))
    ),
)


def _written(t: Tables, *names: str) -> DataFrame:
    paths = edi.write_outputs(_decided(t), scratch_dir(t.spark, "outputs"))
    found = [
        t.spark.read.option("header", True).csv(paths[name]).fillna("").withColumn("file", F.lit(name)) for name in names
    ]
    return reduce(DataFrame.unionByName, found)


add(
    "S11_write_outputs",
    lambda t: _written(t, "enrollment_loaded", "enrollment_rejected"),
    f"""select * exclude (issue_count),
               case load_status when 'LOADED' then 'enrollment_loaded' else 'enrollment_rejected' end as file
        from ({DECIDED})""",
)
