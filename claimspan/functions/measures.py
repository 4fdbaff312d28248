"""Claim status, rate and average expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The claim statuses after normalization.
APPROVED = "Approved"
DENIED = "Denied"
PENDING = "Pending"

# Spellings met in source files and the status each one stands for.
STATUS_SYNONYMS = {
    "Paid": APPROVED,
    "Adjusted": APPROVED,
}


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_status(col: Column | str, synonyms: dict[str, str] | None = None) -> Column:
    """'DENIED ' -> 'Denied', 'PAID' -> 'Approved'. Done once at ingest, so that operators compare exactly."""
    status = F.initcap(F.trim(as_column(col)))
    mapped = None
    for spelling, meaning in (STATUS_SYNONYMS if synonyms is None else synonyms).items():
        test = status == spelling
        mapped = F.when(test, meaning) if mapped is None else mapped.when(test, meaning)
    return status if mapped is None else mapped.otherwise(status)


def has_status(status: str, col: Column | str = "claim_status") -> Column:
    return as_column(col) == status


def is_adjudicated(col: Column | str = "claim_status") -> Column:
    return as_column(col).isin(DENIED, APPROVED)


def rate_base(denominator: str, col: Column | str = "claim_status") -> Column:
    """Rows that count in a denial rate: every claim, or only the decided ones."""
    if denominator == "total":
        return F.lit(True)
    if denominator == "adjudicated":
        return is_adjudicated(col)
    raise ValueError(f"denominator must be 'total' or 'adjudicated', not {denominator!r}")


def percent(part: Column | str, whole: Column | str) -> Column:
    """part / whole * 100 as decimal(5,2), NULL when whole is 0. Exact decimal arithmetic."""
    return (_wide(part) * 100 / F.nullif(_wide(whole), F.lit(0))).cast("decimal(5,2)")


def amount_percent(part: Column | str, whole: Column | str) -> Column:
    """Like ``percent`` for money sums."""
    part, whole = money(part), money(whole)
    return (part * 100 / F.nullif(whole, F.lit(0))).cast("decimal(5,2)")


def fraction(part: Column | str, whole: Column | str) -> Column:
    """part / whole as a double from one division, NULL when whole is 0."""
    return as_column(part).cast("double") / F.nullif(as_column(whole).cast("double"), F.lit(0.0))


def mean_from(total: Column | str, n: Column | str) -> Column:
    """Average as one division of an exact decimal sum, so that partition order cannot change it."""
    return fraction(total, n)


def money_mean(total: Column | str, n: Column | str) -> Column:
    """Average rounded to cents."""
    return (as_column(total) / F.nullif(_wide(n), F.lit(0))).cast("decimal(18,2)")


def money(col: Column | str) -> Column:
    """Money sums leave every operator as decimal(20,2): 10^12 claims of 10^5 each still fit."""
    return as_column(col).cast("decimal(20,2)")


def _wide(col: Column | str) -> Column:
    return as_column(col).cast("decimal(20,0)")


def year_month(col: Column | str) -> Column:
    return F.date_format(as_column(col), "yyyy-MM")


def month_index(col: Column | str) -> Column:
    """Months since year 0, so that calendar gaps keep their width in range frames."""
    return F.year(as_column(col)) * 12 + F.month(as_column(col)) - 1


def is_blank(col: Column | str) -> Column:
    """Missing, empty or only white space."""
    return F.coalesce(strip(col) == "", F.lit(True))


def strip(col: Column | str) -> Column:
    return F.btrim(as_column(col), F.lit(" \t\n\r\x0b\x0c"))
