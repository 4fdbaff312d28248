"""Operators on data where one key holds a large share of all rows, against brute force."""

from collections import Counter
from datetime import date, timedelta
from itertools import combinations
import random

import pytest
from pyspark.sql import Window, functions as F

from claimspan.functions import pairing
from claimspan.functions.ranking import dense_numbers, rank_descending
from claimspan.operators import audits, etl

DAY0 = date(2024, 1, 1)


def make_claims(spark, n=600, seed=3):
    """A third of all claims belong to member 0 and provider 0, many on one day."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        member = 0 if hot else rng.randrange(1, 40)
        provider = 0 if hot else (None if i % 50 == 1 else rng.randrange(1, 5))
        day = DAY0 if i % 5 == 0 else DAY0 + timedelta(days=rng.randrange(0, 400))
        rows.append((i, member, provider, day, float(i)))
    rows.append((n, None, 1, DAY0, 1.0))
    rows.append((n + 1, 1, 1, None, 1.0))
    return spark.createDataFrame(
        rows, "claim_id bigint, member_id bigint, provider_id bigint, service_date date, billed_amount double"
    ), rows


def brute_pairs(rows, days, same_provider=False):
    found = []
    for a, b in combinations(sorted(rows, key=lambda r: r[0]), 2):
        if a[0] == b[0]:
            continue
        if a[1] is None or a[1] != b[1] or None in (a[3], b[3]) or abs((a[3] - b[3]).days) > days:
            continue
        if same_provider and (a[2] is None or a[2] != b[2]):
            continue
        found.append((a[0], b[0], abs((a[3] - b[3]).days)))
    return Counter(found)


@pytest.mark.parametrize("same_provider", [False, True])
@pytest.mark.parametrize("rows_per_cell", [7, 10_000])
def test_near_duplicates_with_and_without_split_groups(spark, same_provider, rows_per_cell):
    claims, rows = make_claims(spark)
    pairs = audits.near_duplicates(claims, 7, same_provider, rows_per_cell=rows_per_cell)
    got = Counter((r.claim_id_1, r.claim_id_2, r.days_apart) for r in pairs.collect())
    assert got == brute_pairs(rows, 7, same_provider)


def test_pairs_start_no_job_while_they_are_planned(spark):
    claims, rows = make_claims(spark)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    spark.sparkContext.setJobGroup("pairs", "planning")
    pairs = audits.near_duplicates(claims, 7, rows_per_cell=2)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("pairs")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    assert Counter((r.claim_id_1, r.claim_id_2, r.days_apart) for r in pairs.collect()) == brute_pairs(rows, 7)


@pytest.mark.parametrize("rows_per_cell", [10, 10_000])
def test_copies_of_one_claim_never_pair_with_each_other(spark, rows_per_cell):
    """A third of the table is one claim delivered again and again, another id has many versions."""
    _, rows = make_claims(spark, 150)
    rows = rows + [(0, 0, 0, DAY0, 0.0)] * 70 + [(3, 0, 1, DAY0 + timedelta(days=i % 9), float(i)) for i in range(20)]
    claims = spark.createDataFrame(
        rows, "claim_id bigint, member_id bigint, provider_id bigint, service_date date, billed_amount double"
    )
    expected = brute_pairs(rows, 7)
    pairs = audits.near_duplicates(claims, 7, rows_per_cell=rows_per_cell)
    assert Counter((r.claim_id_1, r.claim_id_2, r.days_apart) for r in pairs.collect()) == expected
    same = sum(brute_pairs(rows, 7, True).values())
    got = {r.provider_match: r.pair_count for r in audits.near_duplicate_summary(claims, 7).collect()}
    assert got == {"Same Provider": same, "Different Provider": sum(expected.values()) - same}


def test_long_runs_of_copies_are_written_in_steps(spark, monkeypatch):
    monkeypatch.setattr(pairing, "COPIES_PER_STEP", 10)
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", 37)], "k string, n bigint")
    got = pairing.unfold_copies(df, F.col("n")).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in got} == {"a": 1, "b": 10, "c": 37}


def test_pairs_keep_their_sides_together(spark):
    claims, rows = make_claims(spark, 120)
    by_id = {r[0]: r for r in rows}
    for r in audits.near_duplicates(claims, 7, rows_per_cell=5).collect():
        a, b = by_id[r.claim_id_1], by_id[r.claim_id_2]
        assert r.claim_id_1 < r.claim_id_2
        assert (r.service_date_1, r.provider_id_1, r.billed_amount_1) == (a[3], a[2], a[4])
        assert (r.service_date_2, r.provider_id_2, r.billed_amount_2) == (b[3], b[2], b[4])


@pytest.mark.parametrize("days", [0, 1, 7, 30])
def test_pair_counts_equal_built_pairs(spark, days):
    claims, rows = make_claims(spark)
    total = sum(brute_pairs(rows, days).values())
    same = sum(brute_pairs(rows, days, True).values())
    got = {r.provider_match: r.pair_count for r in audits.near_duplicate_summary(claims, days).collect()}
    assert got == {"Same Provider": same, "Different Provider": total - same}


@pytest.mark.parametrize("rows_per_cell", [5, 10_000])
def test_contract_overlaps(spark, rows_per_cell):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        start = date(2000, 1, 1) + timedelta(days=rng.randrange(0, 6000))
        end = None if i % 9 == 0 else start + timedelta(days=rng.choice([-3, 0, 30, 400, 3000]))
        rows.append((i, 0 if i % 3 == 0 else rng.randrange(1, 30), start, end))
    contracts = spark.createDataFrame(rows, "contract_id bigint, provider_id bigint, start_date date, end_date date")
    far = date(9999, 12, 31)
    expected = Counter(
        (a[0], b[0])
        for a, b in combinations(rows, 2)
        if a[1] == b[1] and a[2] <= (b[3] or far) and b[2] <= (a[3] or far)
    )
    got = audits.contract_overlaps(contracts, rows_per_cell).collect()
    assert Counter((r.contract_id_1, r.contract_id_2) for r in got) == expected


@pytest.mark.parametrize("by", [[], ["kind"]])
def test_ranks_equal_plain_windows(spark, by):
    rng = random.Random(11)
    rows = [
        (i, "hot" if i % 3 else rng.choice(["a", None]), None if i % 41 == 0 else rng.choice([0, 5, 1 << 20, 1 << 45]) + i % 7)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "id bigint, kind string, v bigint")
    got = rank_descending(df, by, "v", F.col("v"), 64, "r", "d")
    w = Window.partitionBy(*by).orderBy(F.col("v").desc())
    expected = df.withColumn("r", F.rank().over(w)).withColumn("d", F.dense_rank().over(w))
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_dense_numbers_for_any_spread_of_keys(spark):
    keys = [-(1 << 62), -5, -1, 0, 1, 7, 1 << 17, (1 << 17) + 1, 1 << 34, 1 << 51, (1 << 62) + 3] + list(
        range(200_000, 260_000)
    )
    random.Random(1).shuffle(keys)
    got = dense_numbers(spark.createDataFrame([(k,) for k in keys], "k bigint"), "k", "n").orderBy("k").collect()
    assert [r.n for r in got] == list(range(1, len(keys) + 1))
    assert [r.k for r in got] == sorted(keys)


def test_latest_row_of_a_hot_key_uses_no_window(spark):
    rows = [(1 if i % 3 else i, i % 17, f"v{i:04}") for i in range(300)] + [(1, None, "zzz")]
    df = spark.createDataFrame(rows, "k bigint, t int, v string")
    latest = etl.latest_rows(df, ["k"], ["t"])
    assert "Window" not in latest._jdf.queryExecution().optimizedPlan().toString()
    expected = {}
    for k, t, v in rows:
        best = expected.get(k)
        if best is None or (-1 if t is None else t, v) > (-1 if best[0] is None else best[0], best[1]):
            expected[k] = (t, v)
    assert {r.k: (r.t, r.v) for r in latest.collect()} == expected
