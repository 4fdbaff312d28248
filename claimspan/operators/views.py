"""Saved projections and aggregations over claims, providers and contracts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from claimspan.functions.measures import DENIED, as_column, has_status, money, percent, rate_base


def stg_claims(claims: DataFrame) -> DataFrame:
    return claims.select("claim_id", "member_id", "provider_id", "claim_status", "billed_amount")


def claims_by_status(staged: DataFrame) -> DataFrame:
    return staged.groupBy("claim_status").agg(
        F.count("*").alias("claim_count"), money(F.sum("billed_amount")).alias("total_billed_amount")
    )


def in_network_providers(providers: DataFrame) -> DataFrame:
    return providers.filter(F.col("network_status") == "IN").select(
        "provider_id", "provider_name", "specialty", "network_status", "npi"
    )


def check_option(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Split rows to write into those a filtered view would still show and those it would lose."""
    kept = F.coalesce(predicate, F.lit(False))
    return df.filter(kept), df.filter(~kept)


def is_active(end_col: Column | str, as_of: date, inclusive: bool = False) -> Column:
    """Open end, or an end after ``as_of`` (``inclusive``: on or after it)."""
    end = as_column(end_col)
    limit = F.lit(as_of)
    return end.isNull() | ((end >= limit) if inclusive else (end > limit))


def active_providers(providers: DataFrame, contracts: DataFrame, as_of: date) -> DataFrame:
    """Active providers with the terms of each active contract, or NULL terms without one.

    A left join, written as inner join plus anti join: a provider with a large share of all
    contracts is then a hot key of an inner join, which adaptive execution can split.
    """
    active = providers.filter(is_active("term_date", as_of)).select(
        "provider_id", "npi", "provider_name", "specialty", "network_status", "group_name", "effective_date"
    )
    terms = contracts.filter(is_active("end_date", as_of)).select("provider_id", "contract_type", "rate_modifier")
    without = active.join(terms.select("provider_id").distinct(), "provider_id", "left_anti")
    return active.join(terms, "provider_id").unionByName(without, allowMissingColumns=True)


def provider_claim_summary(providers: DataFrame, claims: DataFrame) -> DataFrame:
    """Volume, amounts and denial rate per provider, including providers without claims.

    Claims are folded to one row per provider before the join.
    """
    per_provider = claims.groupBy("provider_id").agg(
        F.count("claim_id").alias("claims_n"),
        F.sum("billed_amount").alias("billed"),
        F.sum("paid_amount").alias("paid"),
        F.count_if(has_status(DENIED)).alias("denied_n"),
    )
    total = F.coalesce("claims_n", F.lit(0))
    denied = F.coalesce("denied_n", F.lit(0))
    return providers.join(per_provider, "provider_id", "left").select(
        "provider_id",
        "provider_name",
        "specialty",
        "network_status",
        total.alias("total_claims"),
        money("billed").alias("total_billed"),
        money("paid").alias("total_paid"),
        denied.alias("denied_claims"),
        percent(denied, total).alias("denial_rate_pct"),
    )


def denial_analysis(
    claims: DataFrame, payer: DataFrame, providers: DataFrame, denominator: str = "adjudicated"
) -> DataFrame:
    """Denial rate and denied amount by payer and provider name."""
    per_pair = claims.groupBy("payer_id", "provider_id").agg(
        F.count("claim_id").alias("claims_n"),
        F.count_if(rate_base(denominator)).alias("base_n"),
        F.count_if(has_status(DENIED)).alias("denied_n"),
        F.sum(F.when(has_status(DENIED), F.col("billed_amount")).otherwise(0)).alias("denied_billed"),
    )
    return (
        per_pair.join(payer.select("payer_id", "payer_name"), "payer_id")
        .join(providers.select("provider_id", "provider_name"), "provider_id")
        .groupBy("payer_name", "provider_name")
        .agg(
            F.sum("claims_n").alias("total_claims"),
            F.sum("denied_n").alias("denied_claims"),
            percent(F.sum("denied_n"), F.sum("base_n")).alias("denial_rate_pct"),
            money(F.sum("denied_billed")).alias("total_denied_amount"),
        )
    )
