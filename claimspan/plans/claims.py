"""Registered queries over claims: projections, joins, aggregates, windows and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from claimspan.functions import measures as m
from claimspan.operators import analytics, audits, reports, views, windows
from claimspan.plans.bindings import AS_OF, CLAIM_COLUMNS, cents_mean_sql, mean_sql, money_sql, percent_sql
from claimspan.plans.registry import add
from claimspan.sources import readers

TODAY = f"date '{AS_OF}'"
DENIED = "count(*) filter (where claim_status = 'Denied')"
APPROVED = "count(*) filter (where claim_status = 'Approved')"
PENDING = "count(*) filter (where claim_status = 'Pending')"
DECIDED = "count(*) filter (where claim_status in ('Denied', 'Approved'))"
BILLED = money_sql("sum(billed_amount)")
PAID = money_sql("sum(paid_amount)")
MONTH = "strftime(service_date, '%Y-%m')"
MONTH_INDEX = "(year(service_date) * 12 + month(service_date) - 1)"

# ---------------------------------------------------------------- scans

add(
    "S6_named_table",
    lambda t: readers.table(t.spark, f"{t.sf_dir}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey"),
    "select s_suppkey, s_name, s_nationkey from supplier",
)
add(
    "S13_claims_summary",
    lambda t: analytics.claims_summary(t.claims, AS_OF),
    f"""select claim_status, count(*) as total_claims, {BILLED} as total_billed,
               {money_sql('sum(allowed_amount)')} as total_allowed, {PAID} as total_paid,
               {cents_mean_sql('sum(billed_amount)', 'count(billed_amount)')} as avg_billed, {TODAY} as summary_date
        from claims group by claim_status""",
)

# ---------------------------------------------------------------- projections and filters

add(
    "P1_stg_claims",
    lambda t: views.stg_claims(t.claims),
    "select claim_id, member_id, provider_id, claim_status, billed_amount from claims",
)
add(
    "P2_count_denied",
    lambda t: analytics.count_status(t.claims, m.DENIED),
    "select count(*) as claim_count from claims where claim_status = 'Denied'",
)
add(
    "P3_in_network_providers",
    lambda t: views.in_network_providers(t.providers),
    """select provider_id, provider_name, specialty, network_status, npi from providers
       where network_status = 'IN'""",
)
add(
    "P3_check_option_violations",
    lambda t: views.check_option(
        t.providers.withColumn("network_status", F.when(F.col("term_date").isNull(), F.col("network_status"))),
        F.col("network_status") == "IN",
    )[1].select("provider_id", "network_status"),
    """select provider_id, case when term_date is null then network_status end as network_status from providers
       where not (term_date is null and network_status = 'IN')""",
)
add(
    "P4_is_active",
    lambda t: t.providers.select(
        "provider_id",
        views.is_active("term_date", AS_OF).alias("is_active"),
        views.is_active("term_date", date(2000, 12, 31)).alias("active_on_end_day"),
        views.is_active("term_date", date(2000, 12, 31), inclusive=True).alias("active_on_end_day_inclusive"),
    ),
    f"""select provider_id, term_date is null or term_date > {TODAY} as is_active,
               term_date is null or term_date > date '2000-12-31' as active_on_end_day,
               term_date is null or term_date >= date '2000-12-31' as active_on_end_day_inclusive
        from providers""",
)
add(
    "P5_claim_lookup_by_member",
    lambda t: reports.claim_lookup(t.claims, "7", by="member_id"),
    "select claim_id, member_id, claim_status, billed_amount from claims where member_id = 7",
)
add(
    "P5_claim_lookup",
    lambda t: reports.claim_lookup(t.claims, " 7 "),
    "select claim_id, member_id, claim_status, billed_amount from claims where claim_id = 7",
)
add(
    "P6_member_claims",
    lambda t: reports.member_claims(t.claims, t.members, t.providers, 139, as_of=AS_OF, start=date(1996, 1, 1)),
    f"""select claim_id, member_name, provider_name, specialty, service_date, diagnosis_code, procedure_code,
               billed_amount, paid_amount, claim_status, denial_reason
        from claims join members using (member_id) join providers using (provider_id)
        where member_id = 139 and service_date between date '1996-01-01' and {TODAY}""",
)
add(
    "P7_filter_claims",
    lambda t: reports.filter_claims(t.claims, t.members, t.providers, "claim_status", "Denied"),
    """select claim_id, member_name, provider_name, service_date, claim_status, diagnosis_code, paid_amount
       from claims join members using (member_id) join providers using (provider_id)
       where claim_status = 'Denied'""",
)
add(
    "P8_high_dollar_claims",
    lambda t: reports.high_dollar_claims(t.claims, t.diagnosis, 9),
    """select claim_id, service_date, billed_amount, claim_status, diagnosis_code,
              description as diagnosis_description, category as diagnosis_category
       from claims left join diagnosis on icd10_code = diagnosis_code
       where provider_id = 9 and billed_amount > 10000 and claim_status = 'Approved'""",
)
add(
    "P9_high_dollar_alert",
    lambda t: reports.high_dollar_alert(t.claims),
    """select claim_id, member_id, provider_id, service_date, billed_amount, claim_status from claims
       where billed_amount > 10000""",
)
add(
    "P9_order_alert",
    lambda t: reports.high_dollar_alert(stored_orders(t)),
    """select o_orderkey as claim_id, o_custkey as member_id, o_orderpriority as provider_id,
              cast(o_orderdate as date) as service_date,
              o_totalprice as billed_amount, o_orderstatus as claim_status
       from orders where o_totalprice > 10000""",
)
add(
    "P10_denied_missing_reason",
    lambda t: audits.denied_missing_reason(t.claims),
    """select count(*) as denied_without_reason from claims
       where claim_status = 'Denied' and denial_reason is null""",
)
add(
    "P11_reason_on_undenied",
    lambda t: audits.reason_on_undenied(t.claims),
    """select claim_id, claim_status, denial_reason from claims
       where claim_status <> 'Denied' and denial_reason is not null""",
)
add(
    "P12_pending_with_decision",
    lambda t: audits.pending_with_decision(t.authorizations),
    """select * from authorizations
       where decision = 'Pending' and decision_date is not null and units_approved is null""",
)


def stored_orders(t):
    """Orders as claims whose columns are compared as they are stored, so a filter reaches the scan."""
    names = {
        "o_orderkey": "claim_id", "o_custkey": "member_id", "o_orderpriority": "provider_id", "o_orderdate": "service_date",
        "o_totalprice": "billed_amount", "o_orderstatus": "claim_status",
    }
    orders = t.raw("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return orders.select(*[F.col(old).alias(new) for old, new in names.items()])


CATEGORY_EXAMPLE = {
    analytics.CLINICAL: ("1-URGENT",),
    analytics.AUTHORIZATION: ("2-HIGH",),
    analytics.ADMINISTRATIVE: ("3-MEDIUM", "4-NOT SPECIFIED"),
}
add(
    "P13_denial_category",
    lambda t: analytics.denials_by_category(t.claims, CATEGORY_EXAMPLE),
    f"""select case when denial_reason is null or trim(denial_reason) = '' then 'Other'
                    when denial_reason = '1-URGENT' then 'Clinical'
                    when denial_reason = '2-HIGH' then 'Authorization'
                    when denial_reason in ('3-MEDIUM', '4-NOT SPECIFIED') then 'Administrative'
                    else 'Other' end as denial_category,
               count(*) as denied_claims, {BILLED} as denied_amount
        from claims where claim_status = 'Denied' group by 1""",
)
SEED_REASONS = {
    "1-URGENT": "NOT medically necessary ",
    "2-HIGH": "Prior auth required",
    "3-MEDIUM": "Coding error",
    "4-NOT SPECIFIED": "Benefit maximum reached",
}
add(
    "P13_default_categories",
    lambda t: analytics.denials_by_category(t.claims.replace(SEED_REASONS, subset=["denial_reason"])),
    f"""select case denial_reason when '1-URGENT' then 'Clinical' when '2-HIGH' then 'Authorization'
                    when '3-MEDIUM' then 'Administrative' when '4-NOT SPECIFIED' then 'Financial'
                    else 'Other' end as denial_category,
               count(*) as denied_claims, {BILLED} as denied_amount
        from claims where claim_status = 'Denied' group by 1""",
)
add(
    "P14_contracts_expiring",
    lambda t: reports.contracts_expiring(t.contracts, date(1999, 12, 1)),
    """select *, cast(datediff('day', date '1999-12-01', end_date) as int) as days_left from network_contracts
       where end_date between date '1999-12-01' and date '1999-12-01' + 90""",
)
add(
    "P15_whitespace",
    lambda t: audits.whitespace(t.providers, "provider_id", "provider_name"),
    """select provider_id, provider_name, upper(trim(provider_name)) as cleaned_name,
              cast(length(provider_name) as int) as original_length,
              cast(length(trim(provider_name)) as int) as trimmed_length
       from providers where length(provider_name) <> length(trim(provider_name))""",
)

# ---------------------------------------------------------------- joins

add(
    "J1_claims_with_provider",
    lambda t: t.claims.join(t.providers, "provider_id").select(
        "claim_id", "provider_id", "network_status", "billed_amount"
    ),
    "select claim_id, provider_id, network_status, billed_amount from claims join providers using (provider_id)",
)
add(
    "J2_claims_with_provider_and_payer",
    lambda t: t.claims.join(t.providers, "provider_id")
    .join(t.payer, "payer_id")
    .select("claim_id", "specialty", "payer_name"),
    """select claim_id, specialty, payer_name
       from claims join providers using (provider_id) join payer using (payer_id)""",
)
add(
    "J3_active_providers",
    lambda t: views.active_providers(t.providers, t.contracts, AS_OF),
    f"""select p.provider_id, npi, provider_name, specialty, network_status, group_name, effective_date,
               contract_type, rate_modifier
        from providers p left join network_contracts n
          on n.provider_id = p.provider_id and (n.end_date is null or n.end_date > {TODAY})
        where p.term_date is null or p.term_date > {TODAY}""",
)
add(
    "J4_claims_per_provider",
    lambda t: views.provider_claim_summary(t.providers, t.claims).select("provider_id", "total_claims"),
    """select p.provider_id, count(c.claim_id) as total_claims
       from providers p left join claims c on c.provider_id = p.provider_id group by 1""",
)
add(
    "J5_claims_with_diagnosis",
    lambda t: t.claims.join(t.diagnosis, F.col("diagnosis_code") == F.col("icd10_code"), "left").select(
        "claim_id", "diagnosis_code", "description", "category"
    ),
    """select claim_id, diagnosis_code, description, category
       from claims left join diagnosis on icd10_code = diagnosis_code""",
)
add(
    "J6_orphans",
    lambda t: audits.orphans(t.claims, t.payer, "payer_id", "payer_id").select("claim_id", "payer_id"),
    """select claim_id, payer_id from claims c
       where not exists (select 1 from payer p where p.payer_id = c.payer_id)""",
)
add(
    "J7_providers_no_active_contract",
    lambda t: audits.providers_no_active_contract(t.providers, t.contracts, AS_OF),
    f"""select provider_id, provider_name from providers p where not exists (
          select 1 from network_contracts n where n.provider_id = p.provider_id
             and (n.end_date is null or n.end_date >= {TODAY}))""",
)
NEAR = """claims a join claims b on a.member_id = b.member_id and a.claim_id < b.claim_id
            and abs(datediff('day', a.service_date, b.service_date)) <= 7"""
for _name, _table in (("J8_near_duplicates", "claims"), ("J8_redelivered_pairs", "claims_redelivered")):
    add(
        _name,
        lambda t, table=_table: audits.near_duplicates(getattr(t, table), 7),
        f"""select a.claim_id as claim_id_1, b.claim_id as claim_id_2, a.member_id,
                   a.service_date as service_date_1, b.service_date as service_date_2,
                   cast(abs(datediff('day', a.service_date, b.service_date)) as int) as days_apart,
                   a.provider_id as provider_id_1, b.provider_id as provider_id_2,
                   a.billed_amount as billed_amount_1, b.billed_amount as billed_amount_2
            from {NEAR.replace('claims', _table)}""",
    )
add(
    "J9_near_duplicates_same_provider",
    lambda t: audits.near_duplicates(t.claims, 90, same_provider=True),
    f"""select a.claim_id as claim_id_1, b.claim_id as claim_id_2, a.member_id, a.provider_id,
               a.service_date as service_date_1, b.service_date as service_date_2,
               cast(abs(datediff('day', a.service_date, b.service_date)) as int) as days_apart,
               a.billed_amount as billed_amount_1, b.billed_amount as billed_amount_2
        from {NEAR.replace('<= 7', '<= 90')} and a.provider_id = b.provider_id""",
)
add(
    "J10_contract_overlaps",
    lambda t: audits.contract_overlaps(t.contracts),
    """select a.provider_id, a.contract_id as contract_id_1, b.contract_id as contract_id_2,
              a.start_date as start_date_1, a.end_date as end_date_1,
              b.start_date as start_date_2, b.end_date as end_date_2
       from network_contracts a join network_contracts b
         on a.provider_id = b.provider_id and a.contract_id < b.contract_id
       where a.start_date <= coalesce(b.end_date, date '9999-12-31')
         and b.start_date <= coalesce(a.end_date, date '9999-12-31')""",
)
add(
    "J13_parent_join",
    lambda t: analytics.parent_join(
        t.providers.select(
            "provider_id", "provider_name", F.expr("if(provider_id = 0, null, provider_id div 10)").alias("manager_id")
        ),
        "provider_id",
        "manager_id",
    ),
    """select c.provider_id, c.provider_name, c.manager_id, p.provider_name as parent_provider_name
       from (select *, case when provider_id <> 0 then provider_id // 10 end as manager_id from providers) c
       left join providers p on p.provider_id = c.manager_id""",
)

# ---------------------------------------------------------------- aggregates

add(
    "A1_provider_claim_summary",
    lambda t: views.provider_claim_summary(t.providers, t.claims),
    f"""select p.provider_id, provider_name, specialty, network_status, count(claim_id) as total_claims,
               {BILLED} as total_billed, {PAID} as total_paid, {DENIED} as denied_claims,
               {percent_sql(DENIED, 'count(claim_id)')} as denial_rate_pct
        from providers p left join claims c on c.provider_id = p.provider_id
        group by all""",
)
RATE_BY_NAME = f"""
    select provider_name, specialty, count(claim_id) as total_claims, {DENIED} as denied_claims,
           {percent_sql(DENIED, 'count(claim_id)')} as denial_rate_pct,
           rank() over (partition by specialty order by cast({DENIED} as double) / count(claim_id) desc)
             as rank_within_specialty
    from claims join providers using (provider_id) group by provider_name, specialty"""
add(
    "A2_denial_rate_by_specialty",
    lambda t: analytics.denial_rate_by_specialty(t.claims, t.providers),
    RATE_BY_NAME,
)
add(
    "A3_turnaround",
    lambda t: analytics.turnaround(t.claims, t.providers, t.payer),
    """select provider_name, specialty, payer_name, count(claim_id) as total_claims,
              cast(sum(days) // count(days) as int) as avg_days_to_load,
              cast(min(days) as int) as min_days, cast(max(days) as int) as max_days
       from (select *, datediff('day', service_date, load_timestamp) as days from claims)
       join providers using (provider_id) join payer using (payer_id)
       group by provider_name, specialty, payer_name""",
)
add(
    "A4_member_utilization",
    lambda t: analytics.member_utilization(t.claims, t.members),
    f"""select plan_type, count(distinct member_id) as member_count, count(claim_id) as total_claims,
               {BILLED} as total_billed,
               {cents_mean_sql('sum(billed_amount)', 'count(billed_amount)')} as avg_billed_per_claim,
               {cents_mean_sql('count(claim_id)', 'count(distinct member_id)')} as claims_per_member
        from claims join members using (member_id) group by plan_type""",
)
add(
    "A5_network_impact",
    lambda t: analytics.network_impact(t.claims, t.providers),
    f"""select network_status, count(claim_id) as total_claims, {DENIED} as denied_claims, {BILLED} as total_billed,
               {money_sql('sum(allowed_amount)')} as total_allowed,
               {percent_sql(DENIED, 'count(claim_id)')} as denial_rate_pct,
               {percent_sql('sum(allowed_amount) * 100', 'cast(sum(billed_amount) * 100 as hugeint)')}
                 as allowed_rate_pct
        from claims join providers using (provider_id) group by network_status""",
)
add(
    "A6_monthly_denials",
    lambda t: analytics.monthly_denials(t.claims),
    f"""select {MONTH} as service_month, denial_reason, count(claim_id) as denial_count
        from claims where claim_status = 'Denied' group by 1, 2""",
)
add(
    "A10_denial_summary",
    lambda t: reports.denial_summary(t.claims),
    f"""select payer_id, count(*) as total_claims, {DENIED} as denied_claims, {APPROVED} as approved_claims,
               {PENDING} as pending_claims, cast({DENIED} as double) / nullif({DECIDED}, 0) as denial_rate,
               {money_sql("sum(case when claim_status = 'Denied' then billed_amount else 0 end)")}
                 as denied_billed_amount,
               min(service_date) as earliest_service_date, max(service_date) as latest_service_date
        from claims where payer_id is not null group by payer_id""",
)
add(
    "A10_denial_summary_one_payer",
    lambda t: reports.denial_summary(t.claims, 5),
    f"""select payer_id, count(*) as total_claims, {DENIED} as denied_claims, {APPROVED} as approved_claims,
               {PENDING} as pending_claims, cast({DENIED} as double) / nullif({DECIDED}, 0) as denial_rate,
               {money_sql("sum(case when claim_status = 'Denied' then billed_amount else 0 end)")}
                 as denied_billed_amount,
               min(service_date) as earliest_service_date, max(service_date) as latest_service_date
        from claims where payer_id = 5 group by payer_id""",
)
add(
    "A11_denial_by_provider",
    lambda t: reports.denial_by_provider(t.claims, t.providers),
    f"""select provider_name, grouping(provider_name) = 1 as is_total, count(claim_id) as total_claims,
               {DENIED} as denied_claims,
               {money_sql("sum(case when claim_status = 'Denied' then billed_amount else 0 end)")}
                 as denied_billed_amount
        from claims join providers using (provider_id) group by rollup (provider_name)""",
)
add(
    "A12_claims_by_status",
    lambda t: views.claims_by_status(views.stg_claims(t.claims)),
    f"select claim_status, count(*) as claim_count, {BILLED} as total_billed_amount from claims group by claim_status",
)
add(
    "A13_provider_volume",
    lambda t: analytics.provider_volume(t.claims),
    f"""select provider_id, count(*) as claim_count, {mean_sql('billed_amount')} as avg_billed
        from claims group by provider_id""",
)
add(
    "A13_line_volume",
    lambda t: analytics.provider_volume(
        t.raw("lineitem").selectExpr(
            "l_suppkey as provider_id", "cast(l_extendedprice as decimal(12,2)) as billed_amount"
        )
    ),
    f"""select l_suppkey as provider_id, count(*) as claim_count,
               {mean_sql('cast(l_extendedprice as decimal(12,2))')} as avg_billed
        from lineitem group by 1""",
)
add(
    "A15_denial_rate_by_provider",
    lambda t: analytics.denial_rate_by_provider(t.claims),
    f"""select provider_id, count(claim_id) as total_claims, {DENIED} as denied_claims,
               {percent_sql(DENIED, 'count(claim_id)')} as denial_rate_pct
        from claims group by provider_id""",
)
add(
    "A15_line_return_rate",
    lambda t: analytics.denial_rate_by_provider(
        t.raw("lineitem").selectExpr(
            "l_orderkey as provider_id",
            "l_linenumber as claim_id",
            "if(l_returnflag = 'R', 'Denied', 'Approved') as claim_status",
        )
    ),
    f"""select l_orderkey as provider_id, count(l_linenumber) as total_claims,
               count(*) filter (where l_returnflag = 'R') as denied_claims,
               {percent_sql("count(*) filter (where l_returnflag = 'R')", 'count(l_linenumber)')} as denial_rate_pct
        from lineitem group by 1""",
)
add(
    "A16_member_totals",
    lambda t: analytics.member_totals(t.claims_redelivered),
    f"""select member_id, count(distinct claim_id) as total_claims, {BILLED} as total_billed
        from claims_redelivered group by member_id""",
)
add(
    "A20_top_denial_reasons",
    lambda t: analytics.top_denial_reasons(t.claims, 3),
    f"""with r as (select denial_reason, count(*) as denied_claims from claims
                   where claim_status = 'Denied' and denial_reason is not null group by 1)
        select denial_reason, denied_claims,
               {percent_sql('denied_claims', "(select count(*) from claims where claim_status = 'Denied')")} as share_pct
        from r order by denied_claims desc, denial_reason limit 3""",
)
add(
    "A21_reason_by_payer",
    lambda t: analytics.reason_by_payer(t.claims, t.payer),
    """select denial_reason, payer_name, count(*) as denied_claims
       from claims join payer using (payer_id) where claim_status = 'Denied' group by 1, 2""",
)
PAYERS = [f"NATION_{i}" for i in range(25)]
_per_payer = ", ".join(
    f"nullif(count(*) filter (where payer_name = '{p}'), 0) as {p}" for p in PAYERS
)
add(
    "A21_reason_by_payer_matrix",
    lambda t: analytics.reason_by_payer_matrix(t.claims, t.payer, PAYERS),
    f"""select denial_reason, {_per_payer}
        from claims join payer using (payer_id) where claim_status = 'Denied' group by 1""",
)
add(
    "A22_denied_by_category",
    lambda t: analytics.denied_by_category(t.claims, t.diagnosis),
    f"""select category, count(*) as denied_claims, {BILLED} as denied_amount
        from claims left join diagnosis on icd10_code = diagnosis_code
        where claim_status = 'Denied' group by 1""",
)
OVERVIEW = f"count(*) as total_claims, {BILLED} as total_billed, {PAID} as total_paid"
add(
    "A23_claims_overview",
    lambda t: analytics.claims_overview(t.claims, t.payer),
    f"""select 'total' as section, cast(null as varchar) as label, {OVERVIEW} from claims
        union all select 'month', {MONTH}, {OVERVIEW} from claims group by 2
        union all select 'payer', payer_name, {OVERVIEW} from claims left join payer using (payer_id) group by 2
        union all select 'status', claim_status, {OVERVIEW} from claims group by 2""",
)
add(
    "A24_member_totals",
    lambda t: analytics.member_breakdown(t.claims, t.members, ["member_name", "plan_type", "state"]),
    f"""select member_name, plan_type, state, count(*) as total_claims, {BILLED} as total_billed
        from claims join members using (member_id) group by 1, 2, 3""",
)
for _column in ("gender", "plan_type", "state"):
    add(
        f"A24_by_{_column}",
        lambda t, c=_column: analytics.member_breakdown(t.claims, t.members, [c]),
        f"""select {_column}, count(*) as total_claims, {BILLED} as total_billed
            from claims join members using (member_id) group by 1""",
    )
add(
    "A25_auth_turnaround",
    lambda t: analytics.auth_turnaround(t.authorizations),
    """select count(*) as decided_count,
              cast(sum(datediff('day', requested_date, decision_date)) as double)
                / count(datediff('day', requested_date, decision_date)) as avg_turnaround_days
       from authorizations where decision_date is not null and decision <> 'Pending'""",
)
add(
    "A25_auth_turnaround_by_provider",
    lambda t: analytics.auth_turnaround(t.authorizations, ["provider_id"]),
    """select provider_id, count(*) as decided_count,
              cast(sum(datediff('day', requested_date, decision_date)) as double)
                / count(datediff('day', requested_date, decision_date)) as avg_turnaround_days
       from authorizations where decision_date is not null and decision <> 'Pending' group by 1""",
)
for _column in ("provider_id", "auth_type"):
    _days = "case when decision <> 'Pending' then datediff('day', requested_date, decision_date) end"
    _approved = "count(*) filter (where decision = 'Approved')"
    add(
        f"A26_auth_approval_by_{_column}",
        lambda t, c=_column: analytics.auth_approval(t.authorizations, [c]),
        f"""select {_column}, count(*) as total_auths, {_approved} as approved_auths,
                   count(*) filter (where decision = 'Denied') as denied_auths,
                   count(*) filter (where decision = 'Pending') as pending_auths,
                   {percent_sql(_approved, "count(*) filter (where decision in ('Denied', 'Approved'))")}
                     as approval_rate_pct,
                   cast(sum({_days}) as double) / nullif(count({_days}), 0) as avg_decision_days
            from authorizations group by 1""",
    )
add(
    "A27_denial_analysis",
    lambda t: views.denial_analysis(t.claims, t.payer, t.providers),
    f"""select payer_name, provider_name, count(claim_id) as total_claims, {DENIED} as denied_claims,
               {percent_sql(DENIED, DECIDED)} as denial_rate_pct,
               {money_sql("sum(case when claim_status = 'Denied' then billed_amount else 0 end)")}
                 as total_denied_amount
        from claims join payer using (payer_id) join providers using (provider_id) group by 1, 2""",
)
add(
    "A28_denial_rate_vs_total",
    lambda t: analytics.denial_rate_vs_total(t.claims, t.providers, "specialty"),
    f"""select specialty, coalesce(cast({DENIED} as double) / nullif({DECIDED}, 0), 0.0) as denial_rate,
               (select coalesce(cast({DENIED} as double) / nullif({DECIDED}, 0), 0.0) from claims)
                 as denial_rate_all_providers
        from claims join providers using (provider_id) group by 1""",
)
add(
    "A29_drilldown",
    lambda t: analytics.drilldown(t.claims, t.payer, t.providers),
    """select claim_status, payer_name, provider_name,
              cast(3 - grouping(claim_status) - grouping(payer_name) - grouping(provider_name) as int) as depth,
              count(*) as total_claims
       from claims left join payer using (payer_id) left join providers using (provider_id)
       group by rollup (claim_status, payer_name, provider_name)""",
)
add(
    "A31_denial_rate_by_payer",
    lambda t: analytics.denial_rate_by(t.claims, t.payer, "payer_id", "payer_name"),
    f"""select payer_name, count(*) as total_claims, {DENIED} as denied_claims,
               {percent_sql(DENIED, DECIDED)} as denial_rate_pct
        from claims join payer using (payer_id) group by 1""",
)
add(
    "A31_denial_rate_by_specialty",
    lambda t: analytics.denial_rate_by(t.claims, t.providers, "provider_id", "specialty", "total"),
    f"""select specialty, count(*) as total_claims, {DENIED} as denied_claims,
               {percent_sql(DENIED, 'count(*)')} as denial_rate_pct
        from claims join providers using (provider_id) group by 1""",
)
add(
    "A32_weekly_summary",
    lambda t: reports.weekly_summary(t.claims),
    f"""select cast(date_trunc('week', service_date) as date) as week_start, count(*) as total_claims,
               {DENIED} as denied_claims, {BILLED} as total_billed, {PAID} as total_paid,
               strftime(date_trunc('week', service_date), '%m/%d/%Y') as week_label
        from claims group by 1, 6""",
)
add(
    "A33_monthly_denial_rate",
    lambda t: analytics.monthly_denial_rate(t.claims),
    f"""select {MONTH} as service_month, count(*) as total_claims, {DENIED} as denied_claims,
               {percent_sql(DENIED, DECIDED)} as denial_rate_pct
        from claims group by 1""",
)

# ---------------------------------------------------------------- windows

add(
    "W1_rank_within_specialty",
    lambda t: analytics.denial_rate_by_specialty(t.claims, t.providers).select(
        "provider_name", "specialty", "rank_within_specialty"
    ),
    f"select provider_name, specialty, rank_within_specialty from ({RATE_BY_NAME})",
)
add(
    "W2_contract_ranks",
    lambda t: windows.contract_ranks(t.contracts),
    """select contract_id, provider_id, contract_type, rate_modifier,
              rank() over (partition by contract_type order by rate_modifier desc) as rate_modifier_rank,
              dense_rank() over (partition by contract_type order by rate_modifier desc) as rate_modifier_dense_rank
       from network_contracts""",
)
add(
    "W3_denial_trend",
    lambda t: windows.denial_trend(t.claims),
    f"""with by_month as (select {MONTH} as service_month, denial_reason, count(claim_id) as denial_count
                          from claims where claim_status = 'Denied' group by 1, 2)
        select *, lag(denial_count) over w as prior_month_count,
               denial_count - lag(denial_count) over w as month_over_month_change
        from by_month window w as (partition by denial_reason order by service_month)""",
)
add(
    "W4_mom_denials",
    lambda t: windows.mom_denials(t.claims),
    f"""with by_month as (select {MONTH} as service_month, {DENIED} as denied_claims from claims group by 1)
        select *, denied_claims - lag(denied_claims) over (order by service_month) as mom_change from by_month""",
)
add(
    "W5_rolling_denial_rate",
    lambda t: windows.rolling_denial_rate(t.claims, 3),
    f"""with by_month as (select {MONTH} as service_month, {MONTH_INDEX} as i, {DENIED} as denied_claims,
                                 {DECIDED} as adjudicated_claims from claims group by 1, 2),
             rolled as (select a.service_month, any_value(a.denied_claims) as denied_claims,
                               any_value(a.adjudicated_claims) as adjudicated_claims,
                               cast(sum(b.denied_claims) as bigint) as rolling_denied,
                               cast(sum(b.adjudicated_claims) as bigint) as rolling_adjudicated
                        from by_month a join by_month b on b.i between a.i - 2 and a.i group by 1)
        select *, cast(rolling_denied as double) / nullif(rolling_adjudicated, 0) as rolling_denial_rate from rolled""",
)
add(
    "W6_prior_year",
    lambda t: windows.prior_year(t.claims),
    f"""with by_month as (select {MONTH} as service_month, {MONTH_INDEX} as i, {BILLED} as total_billed
                          from claims group by 1, 2)
        select a.service_month, a.total_billed, b.total_billed as billed_prior_year
        from by_month a left join by_month b on b.i = a.i - 12""",
)
add(
    "W7_ytd",
    lambda t: windows.ytd(t.claims),
    f"""with by_month as (select {MONTH} as service_month, {MONTH_INDEX} as i, {BILLED} as total_billed
                          from claims group by 1, 2)
        select a.service_month, any_value(a.total_billed) as total_billed,
               {money_sql('sum(b.total_billed)')} as billed_ytd
        from by_month a join by_month b on b.i // 12 = a.i // 12 and b.i <= a.i group by 1""",
)
add(
    "W8_provider_rank",
    lambda t: windows.provider_rank(t.claims, t.providers, m.has_status(m.DENIED)),
    f"""with totals as (select provider_name, {BILLED} as total_billed
                        from claims join providers using (provider_id) where claim_status = 'Denied' group by 1)
        select *, dense_rank() over (order by total_billed desc) as provider_rank from totals""",
)

# ---------------------------------------------------------------- sorts and limits

add(
    "O1_sorted_rates",
    lambda t: analytics.denial_rate_by_provider(t.claims).orderBy(
        F.col("denial_rate_pct").desc(), F.col("provider_id").asc()
    ),
    f"""select provider_id, count(claim_id) as total_claims, {DENIED} as denied_claims,
               {percent_sql(DENIED, 'count(claim_id)')} as denial_rate_pct
        from claims group by provider_id order by denial_rate_pct desc, provider_id""",
)
add(
    "O2_claims_list",
    lambda t: reports.claims_list(t.claims, 20),
    f"""select claim_id, provider_id, claim_status, {BILLED} as billed_amount
        from (select * from claims order by claim_id limit 20) group by 1, 2, 3""",
)
add(
    "O3_top_n",
    lambda t: analytics.top_n(
        t.claims.select("claim_id", "member_id", "billed_amount"), "billed_amount", 25, "claim_id"
    ),
    """select claim_id, member_id, billed_amount from claims
       order by billed_amount desc nulls last, claim_id limit 25""",
)
add(
    "O4_preview",
    lambda t: t.claims.select(*CLAIM_COLUMNS[:6]).orderBy("claim_id").limit(5),
    f"select {', '.join(CLAIM_COLUMNS[:6])} from claims order by claim_id limit 5",
)

# ---------------------------------------------------------------- scalars

add(
    "F0_scalars",
    lambda t: t.claims.select(
        "claim_id",
        m.normalize_status(F.concat(F.lit(" "), F.upper("claim_status"), F.lit(" "))).alias("status_normalized"),
        F.when(F.col("billed_amount") > 10000, "high").otherwise("normal").alias("band"),
        m.amount_percent("paid_amount", "billed_amount").alias("paid_pct"),
        F.coalesce("denial_reason", F.lit("none")).alias("reason_or_none"),
        F.col("billed_amount").cast("decimal(12,1)").alias("billed_1dp"),
        F.concat(F.lit("Served "), F.col("service_date").cast("string")).alias("served_text"),
        m.year_month("service_date").alias("service_month"),
        F.datediff("load_timestamp", "service_date").alias("days_to_load"),
        F.add_months("service_date", -120).alias("ten_years_before"),
        F.date_add("service_date", 3).alias("three_days_later"),
        F.abs(F.col("member_id") - F.col("provider_id")).alias("distance"),
        F.upper(F.trim(F.concat(F.lit(" "), F.col("procedure_code")))).alias("procedure_clean"),
        F.length("diagnosis_code").alias("diagnosis_length"),
        F.col("claim_status").isin("Denied", "Approved").alias("is_decided"),
        F.col("service_date").between(F.lit(date(1996, 1, 1)), F.lit(AS_OF)).alias("in_range"),
        F.round(F.col("billed_amount") * F.lit(1).cast("decimal(2,0)"), 1).cast("decimal(12,1)").alias("billed_round"),
        F.format_number(F.col("billed_amount"), 2).alias("billed_display"),
        F.date_format("service_date", "MM/dd/yyyy").alias("service_display"),
        F.try_to_date(F.concat(F.year("service_date").cast("string"), F.lit("-13-45")), "yyyy-MM-dd").alias("bad_date"),
        F.get(F.split("procedure_code", "X"), F.lit(1)).alias("procedure_number"),
        F.substring("procedure_code", 1, 2).alias("procedure_prefix"),
    ),
    f"""select claim_id, claim_status as status_normalized,
               case when billed_amount > 10000 then 'high' else 'normal' end as band,
               {percent_sql('paid_amount * 100', 'cast(billed_amount * 100 as hugeint)')} as paid_pct,
               coalesce(denial_reason, 'none') as reason_or_none, cast(billed_amount as decimal(12,1)) as billed_1dp,
               'Served ' || cast(service_date as varchar) as served_text, {MONTH} as service_month,
               cast(datediff('day', service_date, load_timestamp) as int) as days_to_load,
               cast(service_date - interval 10 years as date) as ten_years_before,
               service_date + 3 as three_days_later, abs(member_id - provider_id) as distance,
               upper(trim(' ' || procedure_code)) as procedure_clean, cast(length(diagnosis_code) as int) as diagnosis_length,
               claim_status in ('Denied', 'Approved') as is_decided,
               service_date between date '1996-01-01' and {TODAY} as in_range,
               cast(round(billed_amount, 1) as decimal(12,1)) as billed_round,
               format('{{:,.2f}}', cast(billed_amount as double)) as billed_display,
               strftime(service_date, '%m/%d/%Y') as service_display, cast(null as date) as bad_date,
               string_split(procedure_code, 'X')[2] as procedure_number, substr(procedure_code, 1, 2) as procedure_prefix
        from claims""",
)
