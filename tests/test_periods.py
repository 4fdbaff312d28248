"""Period sweeps, contracts in force, hierarchies and stored sketches against brute force, with hot keys."""

from collections import Counter
from datetime import date, timedelta
from itertools import combinations
import random

import pytest
from pyspark.sql import functions as F

from claimspan.operators import hierarchy, periods, quality

PERIODS = "contract_id bigint, provider_id bigint, start_date date, end_date date"
DAY0 = date(2020, 1, 1)


def make_periods(n=300, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = DAY0 + timedelta(days=rng.randrange(0, 900))
        end = None if i % 23 == 0 else start + timedelta(days=rng.choice([-4, 0, 0, 6, 30, 200]))
        rows.append((i, 0 if i % 3 == 0 else rng.randrange(1, 30), start, end))
    rows += [(n, None, DAY0, None), (n + 1, 5, None, DAY0), (n + 2, 77, date(1, 1, 1), date(9999, 12, 31)), (n + 3, 78, DAY0, None)]
    rows += [(n + 4, 79, DAY0, DAY0 + timedelta(3)), (n + 5, 79, DAY0 + timedelta(4), DAY0 + timedelta(5)), (n + 6, 79, DAY0 + timedelta(7), None)]
    return rows


def sane(rows):
    return [r for r in rows if r[1] is not None and r[2] and (r[3] is None or r[3] >= r[2])]


def test_overlap_counts(spark):
    rows = make_periods()
    far = date.max
    pairs = Counter(a[1] for a, b in combinations(sane(rows), 2) if a[1] == b[1] and a[2] <= (b[3] or far) and b[2] <= (a[3] or far))
    expected = {k: (n, pairs[k]) for k, n in Counter(r[1] for r in sane(rows)).items()}
    got = periods.overlap_counts(spark.createDataFrame(rows, PERIODS)).collect()
    assert {r.provider_id: (r.periods, r.overlapping_pairs) for r in got} == expected and len(got) == len(expected)
    assert periods.overlap_counts(spark.createDataFrame([], PERIODS)).count() == 0


def test_merged_periods(spark):
    rows, expected = make_periods(), []
    for key in {r[1] for r in sane(rows)}:
        open_, n = None, 0
        for _, _, start, end in sorted((r for r in sane(rows) if r[1] == key), key=lambda r: (r[2], r[3] or date.max)):
            end = end or date.max
            if open_ and start <= (open_[1] if open_[1] == date.max else open_[1] + timedelta(1)):
                open_, n = (open_[0], max(open_[1], end)), n + 1
            else:
                expected += [(key, *open_, n)] if open_ else []
                open_, n = (start, end), 1
        expected.append((key, *open_, n))
    # A period that ends on the last day there is has an end; only open ones have none.
    expected = [(k, a, None if b == date.max and k != 77 else b, n) for k, a, b, n in expected]
    got = periods.merged_periods(spark.createDataFrame(rows, PERIODS)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("inclusive", [False, True])
def test_contract_in_force(spark, conf, inclusive):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    rows, rng = make_periods(), random.Random(9)
    claims = [(i, 0 if i % 3 == 0 else rng.randrange(0, 32), DAY0 + timedelta(days=rng.randrange(-5, 1000))) for i in range(500)]
    claims += [(900, None, DAY0), (901, 3, None), (902, 77, date(1, 1, 1)), (903, 77, date(9999, 12, 30)), (904, 78, date(9999, 12, 31)), (0, *claims[0][1:])]
    expected = []
    for i, key, day in claims:
        held = [(r[2], r[0]) for r in rows if key is not None and day and r[1] == key and r[2] and r[2] <= day
                and (r[3] is None or r[3] > day or (inclusive and r[3] == day))]
        expected.append((i, key, day, max(held)[1] if held else None))
    frame = spark.createDataFrame(claims, "claim_id bigint, provider_id bigint, service_date date")
    got = periods.in_force_on(frame, spark.createDataFrame(rows, PERIODS), "provider_id", "service_date", ["contract_id"], inclusive=inclusive)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def brute_ancestors(parents):
    out = set()
    for start in parents:
        chain, at = [], parents[start]
        while at is not None and at not in chain:
            chain.append(at)
            at = parents.get(at)
        out |= {(start, a, d, at is not None) for d, a in enumerate(chain, 1)}
    return out


def test_ancestors_to_any_depth_and_around_cycles(spark, tmp_path):
    rng = random.Random(4)
    parents = {0: None} | {i: 0 if i % 3 == 0 else rng.randrange(0, i) for i in range(1, 60)}  # a hot boss
    parents |= {i: i - 1 for i in range(1001, 1130)} | {1000: 5}  # a long chain
    parents |= {200: 201, 201: 202, 202: 200, 203: 200, 204: 203, 300: 300, 301: 300, 400: 999_999}  # cycles, a missing parent
    rows = [(k, v) for k, v in parents.items()] + [(None, 3)]
    frame = spark.createDataFrame(rows, "id bigint, boss bigint")
    got = [tuple(r) for r in hierarchy.ancestors(frame, "id", "boss", str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_ancestors(parents)
    assert hierarchy.ancestors(frame.limit(0), "id", "boss", str(tmp_path)).count() == 0


def test_merged_sketches_keep_their_bounds(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 17 != 0, (F.col("id") * 7919) % 10_007).alias("a"), F.col("id").cast("decimal(20,2)").alias("b"),
        F.lit(None).cast("int").alias("c"), (F.col("id") % 5).alias("load"),
    )
    parts = [quality.profile_sketch(rows.filter(F.col("load") == k), ["a", "b", "c"]) for k in range(5)]
    parts.append(quality.profile_sketch(rows.limit(0), ["a", "b", "c"]))
    sketches = parts[0]
    for part in parts[1:]:
        sketches = sketches.unionByName(part)
    got = quality.merged_profile(sketches, [0.01, 0.5, 0.99]).collect()
    exact = {c: sorted(float(r[0]) for r in rows.select(c).where(f"{c} is not null").collect()) for c in ("a", "b", "c")}
    assert len(got) == 9
    for r in got:
        values = exact[r.column]
        assert (r.rows, r["values"]) == (40_000, len(values))
        if not values:
            assert r.least is None and r.quantile is None and r.distinct_values == 0
            continue
        assert (r.least, r.most) == (values[0], values[-1])
        assert abs(r.distinct_values - len(set(values))) <= 0.05 * len(set(values))
        below, up_to = sum(v < r.quantile for v in values), sum(v <= r.quantile for v in values)
        assert below / len(values) <= r.probability + quality.RANK_ERROR and up_to / len(values) >= r.probability - quality.RANK_ERROR
