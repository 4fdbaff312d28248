"""Parameterized lookups and report data. Parameters are checked before any job starts.

Sorted results end in a unique column: a sort splits rows by key ranges, so a day or amount shared
by very many rows would otherwise end up in one task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from claimspan.functions.measures import APPROVED, DENIED, PENDING, fraction, has_status, is_adjudicated, money

# Messages, defaults and allowed parameter values of the lookups.
BLANK_SEARCH = "Please enter a search value."
NO_MATCH = "No matching claim found."
BAD_FILTER_COLUMN = "Invalid filter column. Allowed: claim_status, diagnosis_code."
FILTER_COLUMNS = ("claim_status", "diagnosis_code")
FIRST_DAY = date(2000, 1, 1)
HIGH_DOLLAR = 10_000


def claim_lookup(claims: DataFrame, value: object, by: str = "claim_id") -> DataFrame:
    """Claims with one claim id or member id: id, status and billed amount."""
    if by not in ("claim_id", "member_id"):
        raise ValueError("by must be claim_id or member_id")
    if value is None or not str(value).strip():
        raise ValueError(BLANK_SEARCH)
    return claims.filter(F.col(by) == F.lit(int(str(value)))).select(
        "claim_id", "member_id", "claim_status", "billed_amount"
    )


def claim_lookup_message(found: DataFrame) -> str:
    """The message beside a lookup result; empty when there is a result."""
    return "" if found.take(1) else NO_MATCH


def member_claims(
    claims: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    member_id: int,
    start: date | None = None,
    end: date | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """Claim history of one member, newest first. The filter reaches the scans of both tables."""
    last = end or as_of
    if last is None:
        raise ValueError("give end or as_of")
    kept = claims.filter(
        (F.col("member_id") == member_id) & F.col("service_date").between(F.lit(start or FIRST_DAY), F.lit(last))
    )
    return (
        kept.join(members.filter(F.col("member_id") == member_id).select("member_id", "member_name"), "member_id")
        .join(providers.select("provider_id", "provider_name", "specialty"), "provider_id")
        .select(
            "claim_id",
            "member_name",
            "provider_name",
            "specialty",
            "service_date",
            "diagnosis_code",
            "procedure_code",
            "billed_amount",
            "paid_amount",
            "claim_status",
            "denial_reason",
        )
        .orderBy(F.col("service_date").desc(), "claim_id")
    )


def filter_claims(
    claims: DataFrame, members: DataFrame, providers: DataFrame, column: str, value: str
) -> DataFrame:
    """Claims by a column from a fixed list; the value is bound as a literal, never as SQL text."""
    if column not in FILTER_COLUMNS:
        raise ValueError(BAD_FILTER_COLUMN)
    return (
        claims.filter(F.col(column) == F.lit(value))
        .join(members.select("member_id", "member_name"), "member_id")
        .join(providers.select("provider_id", "provider_name"), "provider_id")
        .select(
            "claim_id", "member_name", "provider_name", "service_date", "claim_status", "diagnosis_code", "paid_amount"
        )
        .orderBy(F.col("service_date").desc(), "claim_id")
    )


def high_dollar_claims(
    claims: DataFrame, diagnosis: DataFrame, provider_id: int, threshold: float = HIGH_DOLLAR
) -> DataFrame:
    """Approved claims of one provider above the threshold, with diagnosis text, largest first."""
    lookup = diagnosis.select(
        F.col("icd10_code").alias("diagnosis_code"),
        F.col("description").alias("diagnosis_description"),
        F.col("category").alias("diagnosis_category"),
    )
    return (
        claims.filter(
            (F.col("provider_id") == provider_id) & (F.col("billed_amount") > threshold) & has_status(APPROVED)
        )
        .select("claim_id", "service_date", "billed_amount", "claim_status", "diagnosis_code")
        .join(lookup, "diagnosis_code", "left")
        .orderBy(F.col("billed_amount").desc(), "claim_id")
    )


def high_dollar_alert(claims: DataFrame, threshold: float = HIGH_DOLLAR) -> DataFrame:
    """All claims above the threshold; the filter is pushed into the scan."""
    return claims.filter(F.col("billed_amount") > threshold).select(
        "claim_id", "member_id", "provider_id", "service_date", "billed_amount", "claim_status"
    )


def contracts_expiring(contracts: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    """Contracts ending from ``as_of`` to ``days`` later; open-ended ones never expire."""
    today = F.lit(as_of)
    return (
        contracts.filter(F.col("end_date").between(today, F.date_add(today, days)))
        .withColumn("days_left", F.datediff("end_date", today))
        .orderBy("end_date", "contract_id")
    )


def denial_summary(claims: DataFrame, payer_id: int | None = None) -> DataFrame:
    """Claim outcomes per payer; with ``payer_id`` only that payer (no row if it has no claims)."""
    kept = claims if payer_id is None else claims.filter(F.col("payer_id") == payer_id)
    denied = has_status(DENIED)
    return (
        kept.filter(F.col("payer_id").isNotNull())
        .groupBy("payer_id")
        .agg(
            F.count("*").alias("total_claims"),
            F.count_if(denied).alias("denied_claims"),
            F.count_if(has_status(APPROVED)).alias("approved_claims"),
            F.count_if(has_status(PENDING)).alias("pending_claims"),
            fraction(F.count_if(denied), F.count_if(is_adjudicated())).alias("denial_rate"),
            money(F.sum(F.when(denied, F.col("billed_amount")).otherwise(0))).alias("denied_billed_amount"),
            F.min("service_date").alias("earliest_service_date"),
            F.max("service_date").alias("latest_service_date"),
        )
    )


def denial_by_provider(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Denials per provider name and one grand-total row (``is_total``)."""
    denied = has_status(DENIED)
    per_provider = claims.groupBy("provider_id").agg(
        F.count("claim_id").alias("claims_n"),
        F.count_if(denied).alias("denied_n"),
        F.sum(F.when(denied, F.col("billed_amount")).otherwise(0)).alias("denied_billed"),
    )
    return (
        per_provider.join(providers.select("provider_id", "provider_name"), "provider_id")
        .rollup("provider_name")
        .agg(
            F.grouping("provider_name").cast("boolean").alias("is_total"),
            F.sum("claims_n").alias("total_claims"),
            F.sum("denied_n").alias("denied_claims"),
            money(F.sum("denied_billed")).alias("denied_billed_amount"),
        )
    )


def claims_list(claims: DataFrame, n: int = 20) -> DataFrame:
    """The first n claims by id, summed by claim, provider and status."""
    return (
        claims.select("claim_id", "provider_id", "billed_amount", "claim_status")
        .orderBy("claim_id")
        .limit(n)
        .groupBy("claim_id", "provider_id", "claim_status")
        .agg(money(F.sum("billed_amount")).alias("billed_amount"))
        .orderBy("claim_id", "provider_id", "claim_status")
    )


def weekly_summary(claims: DataFrame) -> DataFrame:
    """Claims per service week (Monday first) with the Monday as display text."""
    monday = F.date_trunc("week", F.col("service_date")).cast("date")
    return (
        claims.groupBy(monday.alias("week_start"))
        .agg(
            F.count("*").alias("total_claims"),
            F.count_if(has_status(DENIED)).alias("denied_claims"),
            money(F.sum("billed_amount")).alias("total_billed"),
            money(F.sum("paid_amount")).alias("total_paid"),
        )
        .withColumn("week_label", F.date_format("week_start", "MM/dd/yyyy"))
    )
