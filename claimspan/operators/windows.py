"""Window measures. Every window runs on an aggregate whose partitions are bounded by the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimspan.functions.measures import DENIED, fraction, has_status, is_adjudicated, money, month_index, year_month
from claimspan.functions.ranking import rank_descending
from claimspan.operators.analytics import monthly_denials


def contract_ranks(contracts: DataFrame) -> DataFrame:
    """RANK and DENSE_RANK of the rate modifier inside its contract type, highest first."""
    slim = contracts.select("contract_id", "provider_id", "contract_type", "rate_modifier")
    return rank_descending(
        slim,
        by=["contract_type"],
        value="rate_modifier",
        code=F.col("rate_modifier") * 10_000,
        code_bits=18,
        rank="rate_modifier_rank",
        dense_rank="rate_modifier_dense_rank",
    ).orderBy("contract_type", "rate_modifier_rank", "contract_id")


def denial_trend(claims: DataFrame) -> DataFrame:
    """Monthly denials per reason with the previous month that has any, and the change."""
    previous = F.lag("denial_count").over(Window.partitionBy("denial_reason").orderBy("service_month"))
    return (
        monthly_denials(claims)
        .withColumn("prior_month_count", previous)
        .withColumn("month_over_month_change", F.col("denial_count") - F.col("prior_month_count"))
        .orderBy("denial_reason", "service_month")
    )


def _by_month(claims: DataFrame, *measures: Column) -> DataFrame:
    return claims.groupBy(
        year_month("service_date").alias("service_month"), month_index("service_date").alias("_month")
    ).agg(*measures)


def mom_denials(claims: DataFrame) -> DataFrame:
    """Change in denied claims against the previous month that has claims."""
    months = _by_month(claims, F.count_if(has_status(DENIED)).alias("denied_claims"))
    change = F.col("denied_claims") - F.lag("denied_claims").over(Window.orderBy("_month"))
    return months.withColumn("mom_change", change).drop("_month")


def rolling_denial_rate(claims: DataFrame, months: int = 3) -> DataFrame:
    """Denied / decided over the trailing calendar months; sums first, then one division."""
    trailing = Window.orderBy("_month").rangeBetween(-(months - 1), 0)
    return (
        _by_month(
            claims,
            F.count_if(has_status(DENIED)).alias("denied_claims"),
            F.count_if(is_adjudicated()).alias("adjudicated_claims"),
        )
        .withColumn("rolling_denied", F.sum("denied_claims").over(trailing))
        .withColumn("rolling_adjudicated", F.sum("adjudicated_claims").over(trailing))
        .withColumn("rolling_denial_rate", fraction("rolling_denied", "rolling_adjudicated"))
        .drop("_month")
    )


def prior_year(claims: DataFrame) -> DataFrame:
    """Billed amount per month beside the same month one year earlier."""
    year_ago = Window.orderBy("_month").rangeBetween(-12, -12)
    return (
        _by_month(claims, money(F.sum("billed_amount")).alias("total_billed"))
        .withColumn("billed_prior_year", money(F.sum("total_billed").over(year_ago)))
        .drop("_month")
    )


def ytd(claims: DataFrame) -> DataFrame:
    """Billed amount per month and since the start of its year."""
    year = F.floor(F.col("_month") / 12)
    so_far = Window.partitionBy(year).orderBy("_month").rowsBetween(Window.unboundedPreceding, 0)
    return (
        _by_month(claims, money(F.sum("billed_amount")).alias("total_billed"))
        .withColumn("billed_ytd", money(F.sum("total_billed").over(so_far)))
        .drop("_month")
    )


def provider_rank(claims: DataFrame, providers: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Dense rank of providers by billed amount under the caller's claim filter."""
    kept = claims if predicate is None else claims.filter(predicate)
    totals = (
        kept.groupBy("provider_id")
        .agg(F.sum("billed_amount").alias("billed"))
        .join(providers.select("provider_id", "provider_name"), "provider_id")
        .groupBy("provider_name")
        .agg(money(F.sum("billed")).alias("total_billed"))
    )
    most = F.lit(9 * 10**16)  # whole cents up to here fit 64 bits; larger totals share one code
    inside = F.greatest(F.least(F.coalesce(F.col("total_billed"), F.lit(0)), most), -most)
    cents = (inside * 100).cast("bigint")
    return rank_descending(totals, [], "total_billed", code=cents, code_bits=64, dense_rank="provider_rank")
