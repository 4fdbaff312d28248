"""Removal of repeated lines and paragraphs by global digests.

Texts are cut into units at line breaks (or blank lines). A unit is normalised (lower case, words joined by
single spaces) and hashed; digests are grouped over the whole corpus, the occurrence that ranks first (least
document id, then place) stays, and all others are removed. What is kept and removed is told by offsets into
the original text. Only digests and places are shuffled to find the repeats. Counting folds map-side, so a
line that a third of all documents share is one row per task; the repeats then meet their digest in a join,
whose hot keys adaptive execution splits. Texts are shuffled once, to meet the removed units, and only those
of documents that lose one.

Edge cases: a null or empty text has no units and gives itself; units with fewer than ``min_words`` words
are always kept; rows that share an id with different texts are documents of their own, equal rows one document;
rows without doc_id are left as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimspan.llm.common import _LOWER, Rolling, row_code, word_spans, written

MIN_WORDS = 1
BREAKS = {"line": re.compile(rb"\n"), "paragraph": re.compile(rb"\n[ \t\r]*(?:\n[ \t\r]*)+")}

OCCURRENCES = "row long, doc_id long, unit int, begin long, stop long, h1 long, h2 long"


def units(docs: DataFrame, by: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per unit with ``min_words`` words or more: place, byte offsets and a digest of 128 bits.

    The digest is over the hashes of the lower-cased words, so white space doesn't count.
    """

    def run(batches):
        rolling = [Rolling(7), Rolling(8)]
        for batch in batches:
            parts = []
            for doc_id, text, row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "row"))):
                if text:
                    parts.append((doc_id, *unit_digests(text, by, min_words, rolling), row))
            n = [len(p[1]) for p in parts]
            join = lambda k, kind: np.concatenate([p[k] for p in parts]).astype(kind) if parts else np.empty(0, kind)  # noqa: E731, B023
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(np.repeat(np.array([p[-1] for p in parts], np.int64), n)),
                    "doc_id": pa.array(np.repeat(np.array([p[0] for p in parts], np.int64), n)),
                    "unit": join(1, np.int32),
                    "begin": join(2, np.int64),
                    "stop": join(3, np.int64),
                    "h1": join(4, np.uint64).view(np.int64),
                    "h2": join(5, np.uint64).view(np.int64),
                }
            )

    return docs.where("doc_id is not null").select(row_code().alias("row"), "doc_id", "text").mapInArrow(run, OCCURRENCES)


def unit_digests(text: str, by: str, min_words: int, rolling: list[Rolling]) -> tuple[np.ndarray, ...]:
    """Number, begin, end (in bytes) and two hashes of each unit of a text that has enough words."""
    raw = text.encode()
    breaks = [(m.start(), m.end()) for m in BREAKS[by].finditer(raw)]
    begin = np.array([0, *(e for _, e in breaks)], np.int64)
    stop = np.array([*(b for b, _ in breaks), len(raw)], np.int64)
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    left, right = word_spans(data)
    first, last = np.searchsorted(left, begin), np.searchsorted(left, stop)
    keep = np.flatnonzero(last - first >= max(1, min_words))
    hashes = []
    for r in rolling:
        words = r.hash(r.sums(data), left, right)
        # A sequence of words is hashed as the sum of its words times powers, like the bytes of a word.
        if len(words) >= len(r.up):
            r._grow(2 * len(words) + 2)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * r.up[: len(words)])])
        hashes.append(r.hash(sums, first[keep], last[keep]))
    return keep, begin[keep], stop[keep], *hashes


def repeats(found: DataFrame) -> DataFrame:
    """Each occurrence of a digest that occurs more than once, with the first one and whether it is that."""
    place = F.struct("doc_id", "unit", "row")
    firsts = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    return found.join(firsts, ["h1", "h2"]).select(
        "row", "doc_id", "unit", "begin", "stop", F.col("first.doc_id").alias("first_doc_id"), F.col("first.unit").alias("first_unit"),
        (F.col("first") == place).alias("is_first"),
    )


def removed_spans(found: DataFrame) -> DataFrame:
    """Per row that holds a repeated unit: spans (the units it loses, in order), and number, bytes and the longest of
    its repeated units, first occurrences included."""
    lost = F.when(~F.col("is_first"), F.struct("begin", "stop", "first_doc_id", "first_unit"))
    size = F.col("stop") - F.col("begin")
    return repeats(found).dropDuplicates(["row", "unit"]).groupBy("row").agg(
        F.sort_array(F.collect_list(lost)).alias("spans"), F.count("*").alias("n_repeated_units"),
        F.sum(size).alias("n_repeated"), F.max(size).alias("longest_repeated"),
    )


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the units at ascending byte offsets; a unit takes the break after it along."""
    raw, out, at = text.encode(), [], 0
    for begin, stop in spans:
        out.append(raw[at:begin])
        rest = re.match(rb"[ \t\r]*\n(?:[ \t\r]*\n)*" if raw[stop : stop + 2].strip(b" \t\r")[:2] == b"\n\n" else rb"\n", raw[stop:])
        at = stop + (rest.end() if rest else 0)
    return b"".join([*out, raw[at:]]).decode()


def _kept(docs: DataFrame, by: str, min_words: int) -> DataFrame:
    """doc_id, the text without the repeats, and what ``removed_spans`` tells, of each row."""
    spans = removed_spans(written(units(docs, by, min_words), "units"))

    def run(batches):
        for batch in batches:
            spans = [[(s["begin"], s["stop"]) for s in x or []] for x in batch.column("spans").to_pylist()]
            texts = [x if not s or x is None else without(x, s) for x, s in zip(batch.column("text").to_pylist(), spans)]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    rows = docs.select(F.when(F.col("doc_id").isNotNull(), row_code()).alias("row"), "doc_id", "text")
    joined = rows.join(spans, "row", "left").drop("row")
    return joined.mapInArrow(run, joined.schema)


def deduplicate(docs: DataFrame, by: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without the repeats, and the removed spans with their first occurrence, of each row."""
    return _kept(docs, by, min_words).select("doc_id", "text", "spans")


def digests(docs: DataFrame, by: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: removed units and bytes, kept bytes, the removed spans, number, bytes and the longest of its
    repeated units (those that stay included), and the digest of the remaining text."""
    counts = ("n_repeated_units", "n_repeated", "longest_repeated")

    def run(batches):
        for batch in batches:
            spans = [x or [] for x in batch.column("spans").to_pylist()]
            texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_removed_units": pa.array([len(s) for s in spans], pa.int64()),
                    "n_removed": pa.array([sum(x["stop"] - x["begin"] for x in s) for s in spans], pa.int64()),
                    "n_kept": pa.array([len(t) for t in texts], pa.int64()),
                    "removed": pa.array([[[x["begin"], x["stop"], x["first_doc_id"]] for x in s] for s in spans], pa.list_(pa.list_(pa.int64()))),
                    "kept_sha256": [hashlib.sha256(t).hexdigest() for t in texts],
                    **{c: batch.column(c).fill_null(0) for c in counts},
                }
            )

    schema = "doc_id long, n_removed_units long, n_removed long, n_kept long, removed array<array<long>>, kept_sha256 string"
    return _kept(docs, by, min_words).mapInArrow(run, schema + "".join(f", {c} long" for c in counts))
