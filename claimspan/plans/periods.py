"""Registered queries: periods of contracts, hierarchies, stored sketches, late days and the stateful summary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from claimspan.operators import hierarchy, periods, quality, versions
from claimspan.plans.bindings import money_sql
from claimspan.plans.registry import add
from claimspan.session import scratch_dir
from claimspan.streaming import files as streams, incremental, stateful

# ---------------------------------------------------------------- contract periods

FAR = "date '9999-12-31'"
add(
    "J10_overlap_count",
    lambda t: periods.overlap_counts(t.contracts),
    f"""with sane as (select * from network_contracts where end_date is null or end_date >= start_date)
        select a.provider_id, count(distinct a.contract_id) as periods,
               count(*) filter (where a.contract_id < b.contract_id and a.start_date <= coalesce(b.end_date, {FAR})
                                  and b.start_date <= coalesce(a.end_date, {FAR})) as overlapping_pairs
        from sane a join sane b on a.provider_id = b.provider_id group by 1""",
)
# Claims that a member has at a provider, as periods of 60 days: many periods per key, long chains of overlaps.
STAYS = "(select member_id, service_date as start_date, case when claim_id % 89 <> 0 then service_date + 59 end as end_date from claims)"


def _stays(t):
    last = F.when(F.col("claim_id") % 89 != 0, F.date_add("service_date", 59))
    return t.claims.select("member_id", F.col("service_date").alias("start_date"), last.alias("end_date"))


MERGED = """with marked as (
              select *, max(coalesce(end_date, {far})) over (partition by {by} order by start_date, end_date
                                                             rows between unbounded preceding and 1 preceding) as covered
              from {table}),
            numbered as (
              select *, count(*) filter (where covered is null or covered < start_date - 1) over
                        (partition by {by} order by start_date, end_date rows unbounded preceding) as stretch from marked)
            select {by}, min(start_date) as period_start,
                   nullif(max(coalesce(end_date, {far})), {far}) as period_end, count(*) as periods
            from numbered group by {by}, stretch"""
add(
    "J10_merged_periods",
    lambda t: periods.merged_periods(t.contracts),
    MERGED.format(by="provider_id", far=FAR, table="(select * from network_contracts where end_date is null or end_date >= start_date)"),
)
add("J10_merged_stays", lambda t: periods.merged_periods(_stays(t), "member_id"), MERGED.format(by="member_id", far=FAR, table=STAYS))

TERMS = ["contract_id", "contract_type", "rate_modifier"]
add(
    "J3_contract_at_service",
    lambda t: periods.in_force_on(t.claims.select("claim_id", "provider_id", "service_date"), t.contracts, "provider_id", "service_date", TERMS),
    f"""select claim_id, c.provider_id, service_date, {', '.join(TERMS)}
        from claims c left join network_contracts n
          on n.provider_id = c.provider_id and n.start_date <= service_date and (n.end_date is null or n.end_date > service_date)
        qualify row_number() over (partition by claim_id order by start_date desc, contract_id desc) = 1""",
)

# ---------------------------------------------------------------- hierarchy

# Members report to the one with half their number; 5 and 11 report to each other and 0 to itself, so chains below them
# run into a cycle.
MANAGER = "case member_id when 1 then null when 5 then 11 else member_id {div} 2 end"
add(
    "J13_ancestors",
    lambda t: hierarchy.ancestors(t.members.select("member_id", F.expr(MANAGER.format(div="div")).alias("manager_id")), "member_id", "manager_id"),
    f"""select * from (with recursive links as (select member_id, {MANAGER.format(div='//')} as up from members),
        chain as (
          select member_id, up as ancestor, cast(1 as bigint) as distance, [up] as path from links where up is not null
          union all
          select c.member_id, l.up, c.distance + 1, list_append(path, l.up)
          from chain c join links l on l.member_id = c.ancestor where l.up is not null and not list_contains(path, l.up))
        select member_id, ancestor, distance, bool_or(ancestor in (0, 5, 11)) over (partition by member_id) as cyclic from chain)""",
)

# ---------------------------------------------------------------- stored sketches

PROFILED = ["billed_amount", "member_id", "provider_id"]
PROBABILITIES = [0.1, 0.25, 0.5, 0.75, 0.9]


def _merged_profile(t):
    """A sketch per load (the claims of a status), stored; the profile reads the stored states only.

    The quantiles are held against the claims: the share of values below each, and up to it, must enclose the
    probability up to the stated error.
    """
    store = scratch_dir(t.spark, "sketches")
    for status in ("Approved", "Denied", "Pending"):
        with versions.change(t.spark, store) as change:
            change.append("sketches", quality.profile_sketch(t.claims.filter(F.col("claim_status") == status), PROFILED))
    found = quality.merged_profile(versions.read(t.spark, store, "sketches"), PROBABILITIES)
    values = t.claims.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in PROFILED])))
    shares = values.join(F.broadcast(found), "column").groupBy("column", "probability").agg(  # a row per column and probability
        F.avg((F.col("value") < F.col("quantile")).cast("int")).alias("below"),
        F.avg((F.col("value") <= F.col("quantile")).cast("int")).alias("up_to"),
        F.count_distinct("value").alias("distinct_exact"),
    )
    p = F.col("probability")
    return found.join(shares, ["column", "probability"]).select(
        "column", "rows", "values", "least", "most", "probability",
        ((F.col("below") <= p + quality.RANK_ERROR) & (F.col("up_to") >= p - quality.RANK_ERROR)).alias("quantile_in_bounds"),
        (F.abs(F.col("distinct_values") - F.col("distinct_exact")) <= F.greatest(F.lit(2.0), 0.05 * F.col("distinct_exact"))).alias("distinct_in_bounds"),
    )


add(
    "A17_merged_profile",
    _merged_profile,
    " union all ".join(
        f"""select '{c}' as "column", count(*) as rows, count({c}) as "values", cast(min({c}) as double) as least,
                   cast(max({c}) as double) as most, cast({p} as double) as probability,
                   true as quantile_in_bounds, true as distinct_in_bounds from claims"""
        for c in PROFILED
        for p in PROBABILITIES
    ),
)

# ---------------------------------------------------------------- late days


def _late_days(t) -> tuple:
    """Claims in three deliveries, each with days of all years: the approved ones, all, and all again."""
    base = scratch_dir(t.spark, "late-days")
    claims = t.claims.select("claim_id", "claim_status", "service_date")
    first = claims.filter("claim_status = 'Approved' or claim_id % 5 > 0")
    runs = [incremental.load_late_days(t.spark, rows, f"{base}/claims", f"{base}/days", "service_date", "claim_id") for rows in (first, claims, claims)]
    return t.spark.read.parquet(f"{base}/claims"), runs


add("T1_late_days", lambda t: _late_days(t)[0], "select claim_id, claim_status, service_date from claims")


def _days_read(t):
    """The days that each run after the first has read."""
    runs = _late_days(t)[1]
    rows = [(k, d) for k, run in enumerate(runs) for d in run.days if k]  # calendar days
    return t.spark.createDataFrame(rows, "run int, service_date date")


add(
    "T1_days_read",
    _days_read,
    "select distinct cast(1 as int) as run, service_date from claims where claim_status <> 'Approved' and claim_id % 5 = 0",
)

# ---------------------------------------------------------------- stateful summary

DELIVERIES = [date(1997, 1, 1), date(1999, 1, 1), date(9999, 1, 1)]
DELAY = "30 days"


def _delivered(t):
    """Claims by year in three deliveries; some of the first years come with the last one. (summary, late rows)"""
    base = scratch_dir(t.spark, "daily-summary")
    event = F.col("service_date").cast("timestamp")
    claims = t.claims.select("claim_id", "claim_status", "billed_amount", event.alias("service_time"))
    late = (F.col("claim_id") % 7 == 0) & (F.col("service_time") < F.lit(DELIVERIES[0]))
    begin, result = None, None
    for k, stop in enumerate(DELIVERIES):
        due = F.col("service_time") < F.lit(stop)
        due = (due if begin is None else due & (F.col("service_time") >= F.lit(begin))) & ~late
        rows = claims.filter(due | late if k == len(DELIVERIES) - 1 else due)
        rows.write.mode("append").parquet(f"{base}/in")
        stream = streams.file_stream(t.spark, f"{base}/in", claims.schema, file_format="parquet")
        result = stateful.run_daily_summary(t.spark, stream, f"{base}/work", "service_time", DELAY)
        begin = stop
    return result


LATE_CLAIMS = f"claim_id % 7 = 0 and service_date < date '{DELIVERIES[0]}'"
add(
    "T4_stateful_summary",
    lambda t: _delivered(t)[0],
    f"""select service_date as day, claim_status, count(*) as claim_count, {money_sql('sum(billed_amount)')} as total_billed_amount
        from claims where not ({LATE_CLAIMS}) group by all""",
)
add("T4_late_rows", lambda t: _delivered(t)[1].select("claim_id"), f"select claim_id from claims where {LATE_CLAIMS}")
