"""Claim analytics. Facts are folded on their foreign keys first, dimensions join the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from claimspan.functions.measures import (
    APPROVED,
    DENIED,
    PENDING,
    amount_percent,
    as_column,
    fraction,
    has_status,
    is_adjudicated,
    is_blank,
    mean_from,
    money,
    money_mean,
    percent,
    rate_base,
    year_month,
)
from claimspan.functions.ranking import rank_descending

#: A ratio between 0 and 1 is ranked by its first 51 binary places; the rest orders ties inside.
RATE_BITS = 51


def count_status(claims: DataFrame, status: str) -> DataFrame:
    return claims.filter(has_status(status)).agg(F.count("*").alias("claim_count"))


def denial_rate_by_specialty(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Denial rate per provider name and specialty, ranked inside the specialty."""
    per_provider = claims.groupBy("provider_id").agg(
        F.count("claim_id").alias("claims_n"), F.count_if(has_status(DENIED)).alias("denied_n")
    )
    rates = (
        per_provider.join(providers.select("provider_id", "provider_name", "specialty"), "provider_id")
        .groupBy("provider_name", "specialty")
        .agg(F.sum("claims_n").alias("total_claims"), F.sum("denied_n").alias("denied_claims"))
        .withColumn("denial_rate_pct", percent("denied_claims", "total_claims"))
        .withColumn("_rate", fraction("denied_claims", "total_claims"))
    )
    ranked = rank_descending(
        rates,
        by=["specialty"],
        value="_rate",
        code=F.floor(F.col("_rate") * float(1 << RATE_BITS)),
        code_bits=RATE_BITS,
        rank="rank_within_specialty",
    )
    return ranked.drop("_rate").orderBy("specialty", "rank_within_specialty", "provider_name")


def turnaround(claims: DataFrame, providers: DataFrame, payer: DataFrame) -> DataFrame:
    """Days from service to load by provider, specialty and payer; the average is cut to whole days."""
    days = F.datediff("load_timestamp", "service_date")
    per_pair = claims.groupBy("provider_id", "payer_id").agg(
        F.count("claim_id").alias("claims_n"),
        F.sum(days).alias("days_sum"),
        F.count(days).alias("days_n"),
        F.min(days).alias("days_min"),
        F.max(days).alias("days_max"),
    )
    named = per_pair.join(providers.select("provider_id", "provider_name", "specialty"), "provider_id").join(
        payer.select("payer_id", "payer_name"), "payer_id"
    )
    whole_days = fraction(F.sum("days_sum"), F.sum("days_n")).cast("int")
    return (
        named.groupBy("provider_name", "specialty", "payer_name")
        .agg(
            F.sum("claims_n").alias("total_claims"),
            whole_days.alias("avg_days_to_load"),
            F.min("days_min").alias("min_days"),
            F.max("days_max").alias("max_days"),
        )
        .orderBy(F.col("avg_days_to_load").desc(), "provider_name", "specialty", "payer_name")
    )


def member_utilization(claims: DataFrame, members: DataFrame) -> DataFrame:
    """Claims, members and cost by plan type. One row per member leaves the fact table."""
    per_member = claims.groupBy("member_id").agg(
        F.count("claim_id").alias("claims_n"),
        F.sum("billed_amount").alias("billed"),
        F.count("billed_amount").alias("billed_n"),
    )
    claims_n, billed = F.sum("claims_n"), F.sum("billed")
    return (
        per_member.join(members.select("member_id", "plan_type"), "member_id")
        .groupBy("plan_type")
        .agg(
            F.count("member_id").alias("member_count"),
            claims_n.alias("total_claims"),
            money(billed).alias("total_billed"),
            money_mean(billed, F.sum("billed_n")).alias("avg_billed_per_claim"),
            money_mean(claims_n.cast("decimal(20,0)"), F.count("member_id")).alias("claims_per_member"),
        )
        .orderBy(F.col("total_billed").desc())
    )


def network_impact(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Denial and allowed rates by network status."""
    per_provider = claims.groupBy("provider_id").agg(
        F.count("claim_id").alias("claims_n"),
        F.count_if(has_status(DENIED)).alias("denied_n"),
        F.sum("billed_amount").alias("billed"),
        F.sum("allowed_amount").alias("allowed"),
    )
    return (
        per_provider.join(providers.select("provider_id", "network_status"), "provider_id")
        .groupBy("network_status")
        .agg(
            F.sum("claims_n").alias("total_claims"),
            F.sum("denied_n").alias("denied_claims"),
            money(F.sum("billed")).alias("total_billed"),
            money(F.sum("allowed")).alias("total_allowed"),
        )
        .withColumn("denial_rate_pct", percent("denied_claims", "total_claims"))
        .withColumn("allowed_rate_pct", amount_percent("total_allowed", "total_billed"))
        .orderBy(F.col("denial_rate_pct").desc())
    )


def monthly_denials(claims: DataFrame) -> DataFrame:
    """Denied claims per month and reason."""
    return (
        claims.filter(has_status(DENIED))
        .groupBy(year_month("service_date").alias("service_month"), "denial_reason")
        .agg(F.count("claim_id").alias("denial_count"))
    )


def provider_volume(claims: DataFrame) -> DataFrame:
    return (
        claims.groupBy("provider_id")
        .agg(
            F.count("*").alias("claim_count"),
            mean_from(F.sum("billed_amount"), F.count("billed_amount")).alias("avg_billed"),
        )
        .orderBy("provider_id")
    )


def denial_rate_by_provider(claims: DataFrame) -> DataFrame:
    return (
        claims.groupBy("provider_id")
        .agg(F.count("claim_id").alias("total_claims"), F.count_if(has_status(DENIED)).alias("denied_claims"))
        .withColumn("denial_rate_pct", percent("denied_claims", "total_claims"))
        .orderBy(F.col("denial_rate_pct").desc(), "provider_id")
    )


def member_totals(claims: DataFrame) -> DataFrame:
    """Distinct claims and billed amount per member.

    Folding to member and claim first keeps the distinct count exact and lets the claims of one
    hot member spread over all tasks.
    """
    per_claim = claims.groupBy("member_id", "claim_id").agg(F.sum("billed_amount").alias("billed"))
    return (
        per_claim.groupBy("member_id")
        .agg(F.count("claim_id").alias("total_claims"), money(F.sum("billed")).alias("total_billed"))
        .orderBy(F.col("total_billed").desc(), "member_id")
    )


def claims_summary(claims: DataFrame, as_of: date) -> DataFrame:
    """The summary table by status, stamped with its date."""
    return claims.groupBy("claim_status").agg(
        F.count("*").alias("total_claims"),
        money(F.sum("billed_amount")).alias("total_billed"),
        money(F.sum("allowed_amount")).alias("total_allowed"),
        money(F.sum("paid_amount")).alias("total_paid"),
        money_mean(F.sum("billed_amount"), F.count("billed_amount")).alias("avg_billed"),
        F.lit(as_of).alias("summary_date"),
    )


# The categories a denial reason is put into.
CLINICAL = "Clinical"
AUTHORIZATION = "Authorization"
ADMINISTRATIVE = "Administrative"
FINANCIAL = "Financial"
OTHER = "Other"

#: Reasons per category, tried in this order. Callers pass their own for other reason texts.
DENIAL_CATEGORIES: Mapping[str, Sequence[str]] = {
    CLINICAL: ("Not Medically Necessary", "Experimental Treatment", "Medical Necessity"),
    AUTHORIZATION: (
        "No Prior Authorization", "Authorization Expired", "Prior Authorization Required", "Prior auth required"
    ),
    ADMINISTRATIVE: ("Duplicate Claim", "Coding Error", "Missing Information", "Timely Filing"),
    FINANCIAL: ("Non-Covered Service", "Benefit Maximum Reached", "Coverage Terminated"),
}


def denial_category(reason: Column | str, mapping: Mapping[str, Sequence[str]] = DENIAL_CATEGORIES) -> Column:
    """Ordered bucketing without regard to case and outer blanks; a blank or unknown reason is Other."""
    reason = as_column(reason)
    result = F.when(is_blank(reason), F.lit(OTHER))
    for category, reasons in mapping.items():
        result = result.when(F.lower(F.trim(reason)).isin(*[r.strip().lower() for r in reasons]), F.lit(category))
    return result.otherwise(F.lit(OTHER))


def denials_by_category(claims: DataFrame, mapping: Mapping[str, Sequence[str]] = DENIAL_CATEGORIES) -> DataFrame:
    return (
        claims.filter(has_status(DENIED))
        .groupBy(denial_category("denial_reason", mapping).alias("denial_category"))
        .agg(F.count("*").alias("denied_claims"), money(F.sum("billed_amount")).alias("denied_amount"))
    )


def top_n(df: DataFrame, col: str, n: int, tie_break: str) -> DataFrame:
    """The n largest rows; sorted per task and merged, never fully sorted."""
    return df.orderBy(F.col(col).desc_nulls_last(), F.col(tie_break).asc()).limit(n)


def top_denial_reasons(claims: DataFrame, n: int = 1) -> DataFrame:
    """Leading denial reasons with their share of all denied claims."""
    denied = claims.filter(has_status(DENIED))
    by_reason = (
        denied.filter(F.col("denial_reason").isNotNull())
        .groupBy("denial_reason")
        .agg(F.count("*").alias("denied_claims"))
    )
    all_denied = denied.agg(F.count("*")).scalar()
    return top_n(by_reason, "denied_claims", n, "denial_reason").select(
        "denial_reason", "denied_claims", percent("denied_claims", all_denied).alias("share_pct")
    )


def reason_by_payer(claims: DataFrame, payer: DataFrame) -> DataFrame:
    """Denied claims by reason and payer name."""
    return (
        claims.filter(has_status(DENIED))
        .groupBy("denial_reason", "payer_id")
        .agg(F.count("*").alias("denied_n"))
        .join(payer.select("payer_id", "payer_name"), "payer_id")
        .groupBy("denial_reason", "payer_name")
        .agg(F.sum("denied_n").alias("denied_claims"))
    )


def reason_by_payer_matrix(claims: DataFrame, payer: DataFrame, payer_names: Sequence[str]) -> DataFrame:
    """``reason_by_payer`` with one column per named payer."""
    return (
        reason_by_payer(claims, payer)
        .groupBy("denial_reason")
        .pivot("payer_name", list(payer_names))
        .agg(F.sum("denied_claims"))
    )


def denied_by_category(claims: DataFrame, diagnosis: DataFrame) -> DataFrame:
    """Denied claims by diagnosis category; codes missing from the lookup fall under NULL."""
    return (
        claims.filter(has_status(DENIED))
        .groupBy("diagnosis_code")
        .agg(F.count("*").alias("denied_n"), F.sum("billed_amount").alias("billed"))
        .join(
            diagnosis.select(F.col("icd10_code").alias("diagnosis_code"), "category"),
            "diagnosis_code",
            "left",
        )
        .groupBy("category")
        .agg(F.sum("denied_n").alias("denied_claims"), money(F.sum("billed")).alias("denied_amount"))
    )


def claims_overview(claims: DataFrame, payer: DataFrame) -> DataFrame:
    """Totals overall, by month, by payer and by status as (section, label, ...) rows.

    One pass folds the facts to (month, payer, status); grouping sets run on that small frame.
    """
    folded = (
        claims.groupBy(year_month("service_date").alias("service_month"), "payer_id", "claim_status")
        .agg(
            F.count("*").alias("claims_n"),
            F.sum("billed_amount").alias("billed"),
            F.sum("paid_amount").alias("paid"),
        )
        .join(payer.select("payer_id", "payer_name"), "payer_id", "left")
    )
    month, name, status = F.col("service_month"), F.col("payer_name"), F.col("claim_status")
    sections = {0b011: ("month", month), 0b101: ("payer", name), 0b110: ("status", status)}
    section, label = F.lit("total"), F.lit(None).cast("string")
    for level, (title, col) in sections.items():
        section = F.when(F.col("_level") == level, title).otherwise(section)
        label = F.when(F.col("_level") == level, col).otherwise(label)
    return (
        folded.groupingSets([[month], [name], [status], []], month, name, status)
        .agg(
            F.grouping_id().alias("_level"),
            F.sum("claims_n").alias("total_claims"),
            money(F.sum("billed")).alias("total_billed"),
            money(F.sum("paid")).alias("total_paid"),
        )
        .select(section.alias("section"), label.alias("label"), "total_claims", "total_billed", "total_paid")
    )


def member_breakdown(claims: DataFrame, members: DataFrame, by: Sequence[str]) -> DataFrame:
    """Claims and billed amount by member columns (plan_type, gender, state, or the member itself)."""
    per_member = claims.groupBy("member_id").agg(
        F.count("*").alias("claims_n"), F.sum("billed_amount").alias("billed")
    )
    columns = list(dict.fromkeys(["member_id", *by]))
    return (
        per_member.join(members.select(*columns), "member_id")
        .groupBy(*by)
        .agg(F.sum("claims_n").alias("total_claims"), money(F.sum("billed")).alias("total_billed"))
    )


def auth_turnaround(auths: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average days to a decision; open rows and Pending rows with a stray date do not count."""
    days = F.datediff("decision_date", "requested_date")
    decided = auths.filter(F.col("decision_date").isNotNull() & (F.col("decision") != PENDING))
    return decided.groupBy(*by).agg(
        F.count("*").alias("decided_count"), mean_from(F.sum(days), F.count(days)).alias("avg_turnaround_days")
    )


def auth_approval(auths: DataFrame, by: Sequence[str], denominator: str = "adjudicated") -> DataFrame:
    """Authorization outcomes and approval rate, with average days to a decision."""
    days = F.when(F.col("decision") != PENDING, F.datediff("decision_date", "requested_date"))
    return auths.groupBy(*by).agg(
        F.count("*").alias("total_auths"),
        F.count_if(has_status(APPROVED, "decision")).alias("approved_auths"),
        F.count_if(has_status(DENIED, "decision")).alias("denied_auths"),
        F.count_if(has_status(PENDING, "decision")).alias("pending_auths"),
        percent(
            F.count_if(has_status(APPROVED, "decision")), F.count_if(rate_base(denominator, "decision"))
        ).alias("approval_rate_pct"),
        mean_from(F.sum(days), F.count(days)).alias("avg_decision_days"),
    )


def denial_rate_by(
    claims: DataFrame, dim: DataFrame, key: str, by: str, denominator: str = "adjudicated"
) -> DataFrame:
    """Denial rate by one column of a dimension table."""
    per_key = claims.groupBy(key).agg(
        F.count("*").alias("claims_n"),
        F.count_if(rate_base(denominator)).alias("base_n"),
        F.count_if(has_status(DENIED)).alias("denied_n"),
    )
    return (
        per_key.join(dim.select(key, by), key)
        .groupBy(by)
        .agg(
            F.sum("claims_n").alias("total_claims"),
            F.sum("denied_n").alias("denied_claims"),
            percent(F.sum("denied_n"), F.sum("base_n")).alias("denial_rate_pct"),
        )
    )


def denial_rate_vs_total(claims: DataFrame, providers: DataFrame, by: str) -> DataFrame:
    """Denial rate per provider attribute beside the rate over all claims; 0 where nothing is decided."""
    decided, denied = F.count_if(is_adjudicated()), F.count_if(has_status(DENIED))
    company = claims.agg(F.coalesce(fraction(denied, decided), F.lit(0.0))).scalar()
    per_provider = claims.groupBy("provider_id").agg(decided.alias("decided_n"), denied.alias("denied_n"))
    return (
        per_provider.join(providers.select("provider_id", by), "provider_id")
        .groupBy(by)
        .agg(F.coalesce(fraction(F.sum("denied_n"), F.sum("decided_n")), F.lit(0.0)).alias("denial_rate"))
        .withColumn("denial_rate_all_providers", company)
    )


def drilldown(claims: DataFrame, payer: DataFrame, providers: DataFrame) -> DataFrame:
    """Claim counts along total -> status -> payer -> provider; ``depth`` tells the level."""
    folded = (
        claims.groupBy("claim_status", "payer_id", "provider_id")
        .agg(F.count("*").alias("claims_n"))
        .join(payer.select("payer_id", "payer_name"), "payer_id", "left")
        .join(providers.select("provider_id", "provider_name"), "provider_id", "left")
    )
    level = F.grouping("claim_status") + F.grouping("payer_name") + F.grouping("provider_name")
    return folded.rollup("claim_status", "payer_name", "provider_name").agg(
        (3 - level).cast("int").alias("depth"), F.sum("claims_n").alias("total_claims")
    )


def monthly_denial_rate(claims: DataFrame, denominator: str = "adjudicated") -> DataFrame:
    """Denial rate per service month."""
    return claims.groupBy(year_month("service_date").alias("service_month")).agg(
        F.count("*").alias("total_claims"),
        F.count_if(has_status(DENIED)).alias("denied_claims"),
        percent(F.count_if(has_status(DENIED)), F.count_if(rate_base(denominator))).alias("denial_rate_pct"),
    )


def parent_join(df: DataFrame, id_col: str, parent_id_col: str) -> DataFrame:
    """Each row with its direct parent (one level); roots keep NULL."""
    parents = df.select(*[F.col(c).alias(f"parent_{c}") for c in df.columns])
    return df.join(parents, F.col(parent_id_col) == F.col(f"parent_{id_col}"), "left").drop(
        f"parent_{id_col}", f"parent_{parent_id_col}"
    )
