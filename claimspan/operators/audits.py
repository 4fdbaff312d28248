"""Data-quality audits over claims, members, providers, contracts and authorizations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimspan.functions.measures import DENIED, PENDING, has_status, percent
from claimspan.functions.pairing import (
    ROWS_PER_CELL,
    fold_copies,
    grid_join,
    pairs_within_days,
    unfold_copies,
)
from claimspan.operators.views import is_active


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def denied_missing_reason(claims: DataFrame) -> DataFrame:
    return claims.filter(has_status(DENIED) & F.col("denial_reason").isNull()).agg(
        F.count("*").alias("denied_without_reason")
    )


def reason_on_undenied(claims: DataFrame) -> DataFrame:
    return claims.filter((F.col("claim_status") != DENIED) & F.col("denial_reason").isNotNull()).select(
        "claim_id", "claim_status", "denial_reason"
    )


def reason_by_status(claims: DataFrame) -> DataFrame:
    """Filled and empty denial reasons per claim status."""
    return claims.groupBy("claim_status").agg(
        F.count("*").alias("total_claims"),
        F.count("denial_reason").alias("reason_filled"),
        F.count_if(F.col("denial_reason").isNull()).alias("reason_empty"),
    )


def pending_with_decision(auths: DataFrame) -> DataFrame:
    """Authorizations still Pending although a decision date is set and no units are approved."""
    return auths.filter(
        (F.col("decision") == PENDING) & F.col("decision_date").isNotNull() & F.col("units_approved").isNull()
    )


def whitespace(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """Values with blanks at either end, the cleaned value and both lengths."""
    raw, cleaned = F.length(col), F.length(F.trim(F.col(col)))
    return df.filter(raw != cleaned).select(
        id_col,
        col,
        F.upper(F.trim(F.col(col))).alias("cleaned_name"),
        raw.alias("original_length"),
        cleaned.alias("trimmed_length"),
    )


# ---------------------------------------------------------------- referential integrity


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent; a NULL key has none."""
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.join(keys, child[child_key] == F.col("_parent_key"), "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Number of ``orphans``. One row per key is tested instead of every child row."""
    per_key = child.groupBy(child_key).agg(F.count("*").alias("_n"))
    return orphans(per_key, parent, child_key, parent_key).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_count")
    )


# The labels of the orphan report.
ORPHAN_LABELS = {
    "provider": "claims with no matching provider",
    "payer": "claims with no matching payer",
    "member": "claims with no matching member",
    "diagnosis": "claims with no matching diagnosis",
}


def orphan_report(
    claims: DataFrame, providers: DataFrame, payer: DataFrame, members: DataFrame, diagnosis: DataFrame
) -> DataFrame:
    checks = [
        ("provider", providers, "provider_id", "provider_id"),
        ("payer", payer, "payer_id", "payer_id"),
        ("member", members, "member_id", "member_id"),
        ("diagnosis", diagnosis, "diagnosis_code", "icd10_code"),
    ]
    return union_all(
        [
            orphan_count(claims, parent, child_key, parent_key).select(
                F.lit(ORPHAN_LABELS[name]).alias("issue"), "orphan_count"
            )
            for name, parent, child_key, parent_key in checks
        ]
    )


def providers_no_active_contract(providers: DataFrame, contracts: DataFrame, as_of: date) -> DataFrame:
    """Providers without a contract that is open or ends on or after ``as_of``."""
    active = contracts.filter(is_active("end_date", as_of, inclusive=True)).select("provider_id")
    return providers.join(active, "provider_id", "left_anti").select("provider_id", "provider_name")


# ---------------------------------------------------------------- duplicates


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once; NULL keys form groups too."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("duplicate_count"))
        .filter("duplicate_count > 1")
        .orderBy(F.col("duplicate_count").desc(), *keys)
    )


def _prefixed(frame: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return frame.select(*[F.col(c) if c in keys else F.col(c).alias(f"{prefix}{c}") for c in frame.columns])


def near_duplicates(
    claims: DataFrame, days: int = 7, same_provider: bool = False, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Pairs of claims of one member at most ``days`` apart, smaller claim id first.

    Dates fall into buckets of ``days + 1``; a claim can only meet a claim that is later (or on
    the same day) in its own bucket or the next one. The equi join on member and bucket keeps
    comparisons inside the band. Copies of a claim fold to one row, and ``grid_join`` splits member
    buckets with very many rows. The result lists every pair, so within the band of one member it grows
    with the square of its claims; ``near_duplicate_summary`` counts the pairs without building them.
    """
    width = days + 1
    slim = claims.select(
        "member_id",
        F.unix_date("service_date").alias("_day"),
        "claim_id",
        "provider_id",
        "service_date",
        "billed_amount",
    ).filter(
        F.col("member_id").isNotNull()
        & F.col("service_date").isNotNull()
        & F.col("claim_id").isNotNull()
        & (F.col("provider_id").isNotNull() if same_provider else F.lit(True))
    )
    keys = ["member_id", "_bucket"] + (["provider_id"] if same_provider else [])
    bucket = F.floor(F.col("_day") / width).cast("int")
    rows = fold_copies(slim)
    earlier = _prefixed(rows.withColumn("_bucket", F.explode(F.array(bucket, bucket + 1))), keys, "a_")
    later = _prefixed(rows.withColumn("_bucket", bucket), keys, "b_")
    gap = F.col("b__day") - F.col("a__day")
    in_band = ((gap > 0) & (gap <= days) & (F.col("a_claim_id") != F.col("b_claim_id"))) | (
        (gap == 0) & (F.col("a_claim_id") < F.col("b_claim_id"))
    )
    pairs = grid_join(earlier, later, keys, in_band, rows_per_cell)
    pairs = unfold_copies(pairs, F.col("a__copies") * F.col("b__copies"))
    a_first = F.col("a_claim_id") < F.col("b_claim_id")

    def both(column: str) -> list[Column]:
        a, b = F.col(f"a_{column}"), F.col(f"b_{column}")
        return [
            F.when(a_first, a).otherwise(b).alias(f"{column}_1"),
            F.when(a_first, b).otherwise(a).alias(f"{column}_2"),
        ]

    provider = [F.col("provider_id")] if same_provider else both("provider_id")
    return pairs.select(
        *both("claim_id"), "member_id", *both("service_date"), gap.alias("days_apart"), *provider, *both("billed_amount")
    )


# The labels of the near-duplicate summary.
SAME_PROVIDER = "Same Provider"
DIFFERENT_PROVIDER = "Different Provider"


def near_duplicate_summary(claims: DataFrame, days: int = 7, ids_unique: bool = False) -> DataFrame:
    """Near-duplicate pairs by provider match, counted from daily totals without building pairs.

    A pair with a missing provider counts as different. Copies of one claim are no pair; with
    ``ids_unique`` the caller promises there are none, which saves counting them.
    """
    valid = claims.filter(F.col("claim_id").isNotNull())

    def pairs(*keys: str) -> Column:
        count = pairs_within_days(valid, keys, "service_date", days).scalar()
        if ids_unique:
            return count
        return count - pairs_within_days(valid, [*keys, "claim_id"], "service_date", days).scalar()

    counts = claims.sparkSession.range(1).select(
        pairs("member_id").alias("_all"), pairs("member_id", "provider_id").alias("_same")
    )
    rows = [(SAME_PROVIDER, F.col("_same")), (DIFFERENT_PROVIDER, F.col("_all") - F.col("_same"))]
    return counts.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(label).alias("provider_match"), n.cast("bigint").alias("pair_count")) for label, n in rows]
            )
        )
    ).filter("pair_count > 0")


def contract_overlaps(contracts: DataFrame, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Pairs of contracts of one provider whose date ranges share a day (open end = no end).

    Of two overlapping ranges, the later start lies inside the other range. So each contract is
    listed under every calendar year it covers up to the last start in the table, and meets the
    contracts that start in that year. Providers with very many contracts are split like members
    in ``near_duplicates``.
    """
    slim = contracts.select("provider_id", "contract_id", "start_date", "end_date").filter(
        F.col("provider_id").isNotNull() & F.col("start_date").isNotNull()
    )
    keys = ["provider_id", "_year"]
    rows = fold_copies(slim)
    last_start = slim.agg(F.max("start_date")).scalar()
    covering = _prefixed(
        rows.withColumn("_last", F.least(F.coalesce("end_date", last_start), last_start))
        .filter(F.col("_last") >= F.col("start_date"))
        .withColumn("_year", F.explode(F.sequence(F.year("start_date"), F.year("_last"))))
        .drop("_last"),
        keys,
        "a_",
    )
    starting = _prefixed(rows.withColumn("_year", F.year("start_date")), keys, "b_")
    far = F.lit(date(9999, 12, 31))
    a_start, b_start = F.col("a_start_date"), F.col("b_start_date")
    a_id, b_id = F.col("a_contract_id"), F.col("b_contract_id")
    overlap = (
        ((a_start < b_start) & (a_id != b_id)) | ((a_start == b_start) & (a_id < b_id))
    ) & (b_start <= F.coalesce("a_end_date", far)) & (a_start <= F.coalesce("b_end_date", far))
    pairs = grid_join(covering, starting, keys, overlap, rows_per_cell)
    pairs = unfold_copies(pairs, F.col("a__copies") * F.col("b__copies"))
    a_first = a_id < b_id

    def pick(first: str, second: str, name: str) -> Column:
        return F.when(a_first, F.col(first)).otherwise(F.col(second)).alias(name)

    return pairs.select(
        "provider_id",
        pick("a_contract_id", "b_contract_id", "contract_id_1"),
        pick("b_contract_id", "a_contract_id", "contract_id_2"),
        pick("a_start_date", "b_start_date", "start_date_1"),
        pick("a_end_date", "b_end_date", "end_date_1"),
        pick("b_start_date", "a_start_date", "start_date_2"),
        pick("b_end_date", "a_end_date", "end_date_2"),
    )


# ---------------------------------------------------------------- NULL and date audits


def null_audit(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """NULL count and rate of each listed column; one pass per table, whatever its column count."""

    def one(table: str, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(f"_filled_{c}") for c in cols])
        rows = [
            F.struct(
                F.lit(c).alias("column_name"), (F.col("_rows") - F.col(f"_filled_{c}")).alias("null_count")
            )
            for c in cols
        ]
        return counts.select("_rows", F.inline(F.array(*rows))).select(
            F.lit(table).alias("table_name"),
            "column_name",
            F.col("_rows").alias("total_rows"),
            "null_count",
            percent("null_count", "_rows").alias("null_pct"),
        )

    return union_all([one(t, df, cols) for t, (df, cols) in tables.items()]).orderBy(F.col("null_pct").desc())


def null_audit_by(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(group).agg(
        F.count("*").alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]
    )


def payer_coverage(claims: DataFrame) -> DataFrame:
    """Claims per payer; the NULL row shows claims without one."""
    return claims.groupBy("payer_id").agg(F.count("*").alias("claim_count")).orderBy("payer_id")


# The issue labels of the date audit.
FUTURE_OR_TOO_OLD = "future or too old"
FUTURE_DATED = "future dated"


def date_ranges(claims: DataFrame, members: DataFrame, as_of: date) -> DataFrame:
    """Dates outside their plausible range: 10 years back for claims, 20 for enrollment."""
    today = F.lit(as_of)

    def outside(col: str, years: int) -> Column:
        return (F.col(col) > today) | (F.col(col) < F.add_months(today, -12 * years))

    def report(df: DataFrame, table: str, checks: Mapping[str, tuple[Column, str]]) -> DataFrame:
        counts = df.agg(*[F.count_if(test).alias(f"_{c}") for c, (test, _) in checks.items()])
        rows = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.col(f"_{c}").alias("invalid_count"),
                F.lit(label).alias("issue_type"),
            )
            for c, (_, label) in checks.items()
        ]
        return counts.select(F.inline(F.array(*rows)))

    claim_checks = {
        "service_date": (outside("service_date", 10), FUTURE_OR_TOO_OLD),
        "load_timestamp": (F.col("load_timestamp") > today.cast("timestamp"), FUTURE_DATED),
    }
    member_checks = {"enrollment_date": (outside("enrollment_date", 20), FUTURE_OR_TOO_OLD)}
    return (
        report(claims, "claims", claim_checks)
        .unionByName(report(members, "members", member_checks))
        .orderBy(F.col("invalid_count").desc())
    )
