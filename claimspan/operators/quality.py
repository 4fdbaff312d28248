"""Data-quality scores as long (check, column, score) frames.

Completeness and validity of all columns of a table come from one aggregation. Uniqueness folds
each column to its distinct values first, so a value that fills a third of the table shrinks to
one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from claimspan.functions.measures import fraction, is_blank, mean_from, percent
from claimspan.operators.audits import orphan_count, union_all
from claimspan.operators.etl import latest_rows

# The check names and the pass mark.
COMPLETENESS = "Completeness"
UNIQUENESS = "Uniqueness"
VALIDITY = "Validity"
INTEGRITY = "Integrity"
PASS_MARK = 95.0


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def _result(df: DataFrame, check: str, column: str, counted: str) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        "total_rows",
        counted,
        percent(counted, "total_rows").alias("score_pct"),
    )


def completeness(df: DataFrame, col: str) -> DataFrame:
    """Share of rows where the column is filled."""
    counts = df.agg(F.count("*").alias("total_rows"), F.count(col).alias("non_null_rows"))
    return _result(counts, COMPLETENESS, col, "non_null_rows")


def _value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.col(col).alias("_value")).agg(F.count("*").alias("_n"))


def uniqueness(df: DataFrame, col: str, approximate: bool = False) -> DataFrame:
    """Share of distinct filled values. ``approximate`` trades exactness for a shuffle-free sketch."""
    if approximate:
        counts = df.agg(F.count("*").alias("total_rows"), F.approx_count_distinct(col).alias("distinct_values"))
    else:
        counts = _value_counts(df, col).agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), F.count("_value").alias("distinct_values")
        )
    return _result(counts, UNIQUENESS, col, "distinct_values")


def validity(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """Share of rows with an allowed value; NULL is not allowed, letter case counts."""
    counts = df.agg(
        F.count("*").alias("total_rows"), F.count_if(F.col(col).isin(list(values))).alias("valid_rows")
    )
    return _result(counts, VALIDITY, col, "valid_rows")


def integrity(df: DataFrame, fk: str, ref: DataFrame, ref_key: str) -> DataFrame:
    """Share of rows whose foreign key exists in the reference table."""
    per_key = df.groupBy(fk).agg(F.count("*").alias("_n"))
    keys = ref.select(F.col(ref_key).alias("_key")).distinct()
    flagged = per_key.join(keys, F.col(fk) == F.col("_key"), "left")
    counts = flagged.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("_key").isNotNull(), F.col("_n"))), F.lit(0)).alias("matched_rows"),
    )
    return _result(counts, INTEGRITY, fk, "matched_rows")


def json_required(df: DataFrame, json_col: str, fields: Sequence[str]) -> DataFrame:
    """Required keys per JSON record. A key with value null is present; blank lines are skipped.

    Text that is not a JSON object gets ``is_malformed`` instead of stopping the run.
    """
    keys = F.json_object_keys(json_col)
    missing = F.array_except(F.array(*[F.lit(f) for f in fields]), keys)
    return (
        df.filter(~is_blank(json_col))
        .withColumn("is_malformed", keys.isNull())
        .withColumn("has_all_fields", F.coalesce(F.size(missing) == 0, F.lit(False)))
        .withColumn(
            "missing_fields",
            F.when(F.col("is_malformed"), F.lit(None).cast("string"))
            .when(F.col("has_all_fields"), F.lit("None"))
            .otherwise(F.array_join(missing, ",")),
        )
    )


#: One check: (check name, column, argument). The argument is the allowed values for validity,
#: (reference frame, key) for integrity, and None otherwise.
Check = tuple[str, str, object]


def report(df: DataFrame, checks: Sequence[Check], threshold: float = PASS_MARK) -> DataFrame:
    """Score and pass mark per check. An empty table scores NULL and does not pass."""
    one_pass: list[tuple[str, str, Column]] = []
    separate: list[DataFrame] = []
    for check, col, argument in checks:
        if check == COMPLETENESS:
            one_pass.append((check, col, F.count(col)))
        elif check == VALIDITY:
            one_pass.append((check, col, F.count_if(F.col(col).isin(list(argument)))))
        elif check == UNIQUENESS:
            separate.append(uniqueness(df, col))
        elif check == INTEGRITY:
            separate.append(integrity(df, col, *argument))
        else:
            raise ValueError(f"unknown check {check!r}")
    scores = [s.select("check", "column", "score_pct") for s in separate]
    if one_pass:
        counts = df.agg(F.count("*").alias("_rows"), *[c.alias(f"_c{i}") for i, (_, _, c) in enumerate(one_pass)])
        rows = [
            F.struct(
                F.lit(check).alias("check"), F.lit(col).alias("column"), percent(f"_c{i}", "_rows").alias("score_pct")
            )
            for i, (check, col, _) in enumerate(one_pass)
        ]
        scores.insert(0, counts.select(F.inline(F.array(*rows))))
    passed = F.coalesce(F.col("score_pct") >= threshold, F.lit(False))
    return union_all(scores).withColumn("pass", passed)


def run_tests(df: DataFrame, spec: Mapping[str, Sequence[object]]) -> DataFrame:
    """Declared column tests as (column, test, failures) rows.

    ``spec`` maps a column to "not_null", "unique" or ("accepted_values", [...]).
    """
    one_pass: list[tuple[str, str, Column]] = []
    results: list[DataFrame] = []
    for col, tests in spec.items():
        for test in tests:
            if test == "not_null":
                one_pass.append((col, test, F.count_if(F.col(col).isNull())))
            elif test == "unique":
                repeated = F.count_if(F.col("_value").isNotNull() & (F.col("_n") > 1))
                results.append(
                    _value_counts(df, col).agg(repeated.alias("failures")).select(
                        F.lit(col).alias("column"), F.lit(test).alias("test"), "failures"
                    )
                )
            elif test[0] == "accepted_values":
                one_pass.append((col, test[0], F.count_if(~F.col(col).isin(list(test[1])))))
            else:
                raise ValueError(f"unknown test {test!r}")
    if one_pass:
        counts = df.agg(*[c.alias(f"_c{i}") for i, (_, _, c) in enumerate(one_pass)])
        rows = [
            F.struct(F.lit(col).alias("column"), F.lit(test).alias("test"), F.col(f"_c{i}").alias("failures"))
            for i, (col, test, _) in enumerate(one_pass)
        ]
        results.insert(0, counts.select(F.inline(F.array(*rows))))
    return union_all(results).withColumn("passed", F.col("failures") == 0)


def reconcile(classified: DataFrame, outcome: str = "reject_reason", stage: str = "load") -> DataFrame:
    """source = loaded + rejected, as one row: each classified row is loaded or, with an ``outcome``, rejected.

    One aggregate with conditional counts, so the rows are classified and read once.
    """
    rejected = F.count(outcome)
    return classified.agg(
        F.lit(stage).alias("stage"),
        F.count("*").alias("source_rows"),
        F.count_if(F.col(outcome).isNull()).alias("loaded_rows"),
        rejected.alias("rejected_rows"),
    ).withColumn("balanced", F.col("source_rows") == F.col("loaded_rows") + F.col("rejected_rows"))


def scorecard(scores: DataFrame) -> DataFrame:
    """One average score per check kind."""
    return scores.groupBy("check").agg(
        F.count("*").alias("checks"),
        mean_from(F.sum("score_pct"), F.count("score_pct")).alias("score"),
    )


def latest_scores(history: DataFrame) -> DataFrame:
    """The newest row per check and column of a score history."""
    return latest_rows(history, ["check", "column"], ["run_timestamp"])


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per column, in one aggregation."""
    names = list(cols or df.columns)
    aggregates: list[Column] = []
    rows: list[Column] = []
    for i, name in enumerate(names):
        kind = df.schema[name].dataType
        numeric = isinstance(kind, T.NumericType)
        exact = isinstance(kind, (T.DecimalType, T.IntegralType))
        scale = kind.scale if isinstance(kind, T.DecimalType) else 0
        total = F.sum(F.col(name).cast(f"decimal(38,{scale})") if exact else F.col(name)) if numeric else F.lit(None)
        spread = F.stddev(F.col(name).cast("double")) if numeric else F.lit(None)
        aggregates += [
            F.count(name).alias(f"_n{i}"),
            total.cast("double").alias(f"_sum{i}"),
            F.round(spread.cast("double"), 4).alias(f"_dev{i}"),
            F.min(name).cast("string").alias(f"_min{i}"),
            F.max(name).cast("string").alias(f"_max{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"_n{i}").alias("count"),
                fraction(f"_sum{i}", f"_n{i}").alias("mean"),
                F.col(f"_dev{i}").alias("stddev"),
                F.col(f"_min{i}").alias("min"),
                F.col(f"_max{i}").alias("max"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def schema_of(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types."""
    return df.dtypes


# Quantile sketches of size K and distinct-count sketches of 2^LG registers; their stated errors are those of the
# DataSketches library: a quantile's rank is off by at most RANK_ERROR, a distinct count by some 2 % (two deviations).
K, LG = 400, 14
RANK_ERROR = 0.01


def profile_sketch(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per numeric column: exact row and value counts and extremes, and the states of both sketches.

    The states of many loads merge to those of all rows, in any order (``merged_profile``), so a profile of everything
    reads a row per load and column. One aggregation; states fold inside each task.
    """
    aggregates, rows = [F.count("*").alias("_rows")], []
    for i, name in enumerate(cols):
        value = F.col(name).cast("double")
        aggregates += [
            F.count(name).alias(f"_n{i}"), F.min(value).alias(f"_min{i}"), F.max(value).alias(f"_max{i}"),
            F.hll_sketch_agg(F.col(name).cast("string"), LG).alias(f"_hll{i}"), F.kll_sketch_agg_double(value, K).alias(f"_kll{i}"),
        ]
        rows.append(F.struct(
            F.lit(name).alias("column"), F.col("_rows").alias("rows"), F.col(f"_n{i}").alias("values"),
            F.col(f"_min{i}").alias("least"), F.col(f"_max{i}").alias("most"),
            F.col(f"_hll{i}").alias("distinct_state"), F.col(f"_kll{i}").alias("quantile_state"),
        ))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def merged_profile(sketches: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """Per column and probability: exact counts and extremes of all loads, distinct values and the quantile by sketch."""
    merged = sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("values").alias("values"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_state")).alias("distinct_values"),
        F.kll_merge_agg_double("quantile_state").alias("_state"),
    )
    def quantile(p: float) -> Column:
        value = F.when(F.col("values") > 0, F.kll_sketch_get_quantile_double("_state", F.lit(p)))
        return F.struct(F.lit(p).alias("probability"), value.alias("quantile"))

    return merged.select(
        "column", "rows", "values", "least", "most", "distinct_values", F.inline(F.array(*[quantile(float(p)) for p in probabilities]))
    )
