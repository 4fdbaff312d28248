"""Rows that share an id, and extra columns with names that the operators use."""

import random

import pytest

from claimspan.llm import line_dedup, substring_dedup, suffix_dedup
from claimspan.llm.common import prepare
import corpus_pipeline


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))


COPY, OWN, OTHER = prose(1, 60), prose(2, 60), prose(3, 60)
ROWS = [(0, COPY), (1, OWN), (1, COPY), (2, OTHER), (2, OTHER), (None, COPY)]
SCHEMA = "doc_id long, text string, row string, _row int, _gone int, _spans string, own int, code int, spans int"


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame([(i, t, "r", 1, 2, "s", 3, 4, 5) for i, t in ROWS], SCHEMA).repartition(2)


def kept(frame, docs):
    assert frame.columns == docs.columns
    assert all(tuple(r)[2:] == ("r", 1, 2, "s", 3, 4, 5) for r in frame.collect())
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def test_lines(docs):
    expected = [(0, COPY), (1, OWN), (1, ""), (2, OTHER), (2, OTHER), (None, COPY)]
    assert kept(line_dedup.remove(docs), docs) == sorted(expected, key=str)
    assert kept(corpus_pipeline.line_duplicates(docs.sparkSession, docs, ""), docs) == sorted([r for r in expected if r[1]], key=str)


def test_near_duplicates(docs):
    expected = [(0, COPY), (1, OWN), (2, OTHER), (2, OTHER), (None, COPY)]
    assert kept(corpus_pipeline.near_duplicates(docs.sparkSession, docs, ""), docs) == sorted(expected, key=str)


def test_units(docs):
    found = {(r.doc_id, r.text) for r in substring_dedup.deduplicate(docs).collect()}
    assert found == {(0, COPY), (1, OWN), (1, ""), (2, OTHER), (None, COPY)}
    told = {(r.doc_id, r.n_kept): (r.n_removed_units, r.n_repeated_units, r.longest_repeated) for r in substring_dedup.digests(docs).where("doc_id is not null").collect()}
    size = len(COPY)
    assert told == {(0, size): (0, 1, size), (1, size): (0, 0, 0), (1, 0): (1, 1, size), (2, size): (0, 0, 0)}


def test_strings(docs):
    removed = kept(suffix_dedup.remove(docs), docs)
    assert (1, OWN) in removed and (1, "") in removed and (0, "") in removed
