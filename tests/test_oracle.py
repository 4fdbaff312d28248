"""Every registered query against its oracle SQL, types included."""

import os
import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CORPUS = re.compile(r"op\d|pipeline")  # compared in tests/llm
QUERIES = {name: q for name, q in queries().items() if not CORPUS.match(name)}
ORACLE = {name: sql for name, sql in oracle_sql().items() if not CORPUS.match(name)}


#: Planted defects that are too rare for the smallest scale: no rows on both sides.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    problem = compare(spark, con, SF_DIR, QUERIES[name], ORACLE.get(name))
    assert problem == "" or (problem == "no rows" and name in MAY_BE_EMPTY), problem


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


BROADCAST_FREE = [
    "A1_provider_claim_summary",
    "A2_denial_rate_by_specialty",
    "A28_denial_rate_vs_total",
    "A29_drilldown",
    "J3_active_providers",
    "J8_near_duplicates",
    "J10_contract_overlaps",
    "J11_routed_accepted",
    "U2_orphan_report",
    "W8_provider_rank",
    "S9_upsert",
    "E3_parse_members",
]


@pytest.mark.parametrize("name", BROADCAST_FREE)
def test_same_result_when_nothing_is_small_enough_to_broadcast(spark, con, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    problem = compare(spark, con, SF_DIR, QUERIES[name], ORACLE[name])
    assert problem in ("", "no rows"), problem
