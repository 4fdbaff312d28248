"""Exact Jaccard join of word-shingle sets: rare-first prefix filtering with length, positional and suffix filters.

1. Shingles are counted by hash bucket over all documents; a document's shingles are ordered by (count, hash),
   rare ones first. Two sets that reach the threshold share a shingle in their prefixes.
2. Equal sets are folded into one class, represented by its least id. Only representatives go on.
3. Prefix shingles that two representatives share give the candidates. Length and position bound the overlap;
   the suffix filter compares counts of shingles by parts of the hash range, since sets differ by at least the
   sum of the differences of those counts.
4. A round links each document with one other one, the document of least hash among those it shares prefix
   shingles with. Documents of one component need no comparison with each other any more, so a large group of
   near copies takes about one comparison per document. Rounds go on while many candidates are left; then
   every candidate pair in different components is verified, once. Nothing is capped or sampled.
5. Verification computes both sets from the whole texts. Texts travel only for documents that stand in a pair.

Edge cases: texts without words (null, empty, white space) have no shingles and link with nothing; with fewer
words than a shingle, all words are the one shingle; rows without a doc_id are left alone and get no component;
rows that share a doc_id are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimspan.llm.common import Rolling, mix, only_documents, shingle_hashes, text_batches, written
from claimspan.llm.components import components, merged

SHINGLE, PERCENT = 4, 85
#: Hash buckets of the counts that order the shingles, in blocks that travel as one row.
COUNT_BITS, BLOCK_BITS = 20, 12
#: Parts of the hash range that the suffix filter counts.
PARTS = 256
#: Rounds of links to leaders before what is left is compared.
ROUNDS = 2
#: Documents under one shingle up to which their pairs are joined; larger groups are compared in blocks of BLOCK.
SMALL_GROUP, BLOCK = 32, 1024

RECORDS = f"doc_id long, n_shingles long, d1 long, d2 long, prefix array<long>, parts array<short>"


def bucket_counts(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """How many documents hold a shingle of each hash bucket, up to 65,535; 2 MiB whatever the corpus."""
    n, width = 1 << COUNT_BITS, 1 << BLOCK_BITS

    def run(batches):
        rolling, counts = Rolling(), np.zeros(n, np.int64)
        for _, texts in text_batches(batches):
            for text in texts:
                found = (shingle_hashes(text, size, rolling) & np.uint64(n - 1)).astype(np.int64)
                counts += np.bincount(found, minlength=n) if len(found) > n // 8 else 0
                if len(found) <= n // 8:
                    np.add.at(counts, found, 1)
        for k in range(n // width):
            part = counts[k * width : (k + 1) * width]
            at = np.flatnonzero(part)
            if len(at):
                yield _block(k, at, part[at])

    def merged(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, at, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = sums.setdefault(k, np.zeros(width, np.int64))
                own[np.frombuffer(at, "<u2")] += np.frombuffer(c, "<u4")
        for k, c in sums.items():
            yield _block(k, np.arange(width), np.minimum(c, 65_535))

    def _block(k, at, c):
        columns = {"block": pa.array([k], pa.int32()), "at": pa.array([at.astype("<u2").tobytes()], pa.binary()), "n": pa.array([c.astype("<u4").tobytes()], pa.binary())}
        return pa.RecordBatch.from_pydict(columns)

    schema = "block int, at binary, n binary"
    out = np.zeros(n, np.uint16)
    for r in docs.select("text").mapInArrow(run, schema).repartition(64, "block").mapInArrow(merged, schema).collect():
        out[r.block * width : (r.block + 1) * width] = np.frombuffer(r.n, "<u4")
    return out


def records(docs: DataFrame, counts: np.ndarray, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: set size, 128-bit digest of the set, prefix in rare-first order and counts by part."""
    given = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        rolling = Rolling()
        for batch, texts in text_batches(batches):
            n, d1, d2, prefix, parts = [], [], [], [], []
            for text in texts:
                h = shingle_hashes(text, size, rolling)
                n.append(len(h))
                d1.append(int(mix(h).sum(dtype=np.uint64).astype(np.int64)))
                d2.append(int(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)))
                order = np.argsort(given.value[(h & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)], kind="stable")
                first = len(h) - -(-percent * len(h) // 100) + 1 if len(h) else 0
                prefix.append(h[order[:first]].view(np.int64))
                parts.append(np.minimum(np.bincount((mix(h) >> np.uint64(56)).astype(np.int64), minlength=PARTS), 32_767).astype(np.int16))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array(n, pa.int64()),
                    "d1": pa.array(d1, pa.int64()),
                    "d2": pa.array(d2, pa.int64()),
                    "prefix": pa.array(prefix, pa.list_(pa.int64())),
                    "parts": pa.array(parts, pa.list_(pa.int16())),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, RECORDS)


def _least_overlap(n: Column, m: Column, percent: int) -> Column:
    """The least intersection at which sets of these sizes reach the threshold."""
    return F.ceil(percent * (n + m) / F.lit(100 + percent))


def _same_length(a: str, b: str, percent: int) -> Column:
    """Length filter."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _candidates(pairs: DataFrame, a: str, b: str, percent: int) -> DataFrame:
    """(a, b, shared) of the pairs that may reach the threshold, from one row per shingle that both prefixes hold.

    Positional filter: the first common shingle stands at i and j, so the overlap is at most 1 + min(n-i-1, m-j-1).
    Of the set whose prefix ends first in the order, only shingles behind its prefix can be common beside those
    counted; so the overlap is at most their number plus the length of that rest.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    reach = F.least(n - F.col(f"{a}.pos"), m - F.col(f"{b}.pos"))
    counted = pairs.groupBy(F.col(f"{a}.doc").alias("a"), F.col(f"{b}.doc").alias("b"), n.alias("n"), m.alias("m")).agg(
        F.count("*").alias("shared"), F.max(reach).alias("reach")
    )
    need = _least_overlap(F.col("n"), F.col("m"), percent)
    rest = F.ceil(percent * F.greatest("n", "m") / F.lit(100)) - 1
    return counted.where((F.col("reach") >= need) & (F.col("shared") + rest >= need)).select("a", "b", "shared")


def _suffix_filter(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, ...) whose counts by part differ by no more than the sets may."""
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("parts").alias(f"p_{x}"))
    apart = F.aggregate(F.zip_with("p_a", "p_b", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda s, x: s + x)
    # A count that reached its bound says less; then the filter lets the pair pass.
    full = F.exists("p_a", lambda x: x == 32_767) | F.exists("p_b", lambda x: x == 32_767)
    most = F.col("n_a") + F.col("n_b") - 2 * _least_overlap(F.col("n_a"), F.col("n_b"), percent)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(full | (apart <= most)).drop("n_a", "n_b", "p_a", "p_b")


def verify(pairs: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that reach the threshold, computed from the whole texts; each is computed once."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id")))
    texts = written(only_documents(docs, ids, "text"), "texts")
    both = pairs.join(texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b").join(texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")

    def run(batches):
        rolling, known = Rolling(), OrderedDict()

        def shingles(text: str | None) -> np.ndarray:
            if text not in known:
                known[text] = shingle_hashes((text or "").encode(), size, rolling)
                if len(known) > 64:
                    known.popitem(last=False)
            return known[text]

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                p, q = shingles(x), shingles(y)
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(common > 0 and 100 * common >= percent * (len(p) + len(q) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def _round(shared: DataFrame, sets: DataFrame, seed: int, percent: int) -> DataFrame:
    """(a, b): each document with a leader, under another label, that it shares most shingles with.

    A shingle's leader is the document of most common shingles in its prefix, so one with few changes of its own.
    A round only has to find links quickly; what it leaves out is left to ``_remaining``.
    """
    member = F.struct(F.col("common").alias("rank"), F.xxhash64(F.lit(seed), "doc").alias("order"), "doc", "n", "pos", "label")
    common = shared.groupBy("doc").agg((F.count("*") * 1000 / F.max("n")).cast("long").alias("common"))
    leaders = shared.join(common, "doc").groupBy("token").agg(F.max(member).alias("leader"))
    p, q = shared.alias("p"), leaders.select("token", "leader.*").alias("q")
    pairs = p.join(q, "token").where((F.col("p.label") != F.col("q.label")) & _same_length("p", "q", percent))
    best = _candidates(pairs, "q", "p", percent).groupBy("b").agg(F.max(F.struct("shared", "a")).alias("best"))
    return _suffix_filter(best.select("best.a", "b"), sets, percent)


def _unresolved(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of shingles that stand under several labels, with their labels."""
    now = shared.select("token", "doc", "n", "pos").join(labels.withColumnRenamed("id", "doc"), "doc")
    mixed = now.groupBy("token").agg((F.min("label") != F.max("label")).alias("mixed")).where("mixed").select("token")
    return now.join(mixed, "token", "left_semi").select("token", "doc", "n", "pos", "label")


def _remaining(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs under different labels that pass the filters.

    Pairs under shingles of few documents are joined and counted; groups of more documents are compared in blocks.
    """
    sizes = written(shared.groupBy("token").agg(F.count("*").alias("size")), "sizes")
    few = shared.join(sizes.where(f"size <= {SMALL_GROUP}").select("token"), "token")
    p, q = few.alias("p"), few.alias("q")
    pairs = p.join(q, "token").where((F.col("p.label") != F.col("q.label")) & (F.col("p.doc") < F.col("q.doc")) & _same_length("p", "q", percent))
    # Shingles of large groups are not counted here, so the overlap is bounded by position alone.
    reach = F.least(F.col("p.n") - F.col("p.pos"), F.col("q.n") - F.col("q.pos"))
    joined = pairs.where(reach >= _least_overlap(F.col("p.n"), F.col("q.n"), percent)).select(F.col("p.doc").alias("a"), F.col("q.doc").alias("b"))
    joined = _suffix_filter(joined.distinct(), sets, percent)
    return joined.union(_in_blocks(shared, sizes.where(f"size > {SMALL_GROUP}"), sets, percent)).distinct()


def _in_blocks(shared: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The same for shingles of many documents, whose pairs would be too many rows.

    The documents of a shingle are dealt into blocks, and each two blocks meet in one group, which applies the length
    and suffix filters to all its pairs at once and gives those that pass.
    """
    grid = sizes.select("token", F.ceil(F.col("size") / BLOCK).cast("int").alias("k"))
    parts = sets.select(F.col("doc_id").alias("doc"), "parts")
    rows = shared.join(grid, "token").join(parts, "doc").withColumn("own", F.pmod(F.xxhash64("doc"), F.col("k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    dealt = rows.select("token", "doc", "n", "label", "parts", "own", other).select(
        "token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "doc", "n", "label", "parts"
    )

    def block(found: pa.Table) -> pa.Table:
        column = lambda name: found.column(name).to_numpy()
        doc, n, label = column("doc"), column("n"), column("label")
        parts = found.column("parts").combine_chunks().flatten().to_numpy().reshape(-1, PARTS).astype(np.int16)
        a, b = [], []
        for k in range(len(doc)):
            total = n[k] + n
            need = -(-percent * total // (100 + percent))
            fits = (100 * np.minimum(n[k], n) >= percent * np.maximum(n[k], n)) & (label != label[k]) & (doc > doc[k])
            at = np.flatnonzero(fits)
            if len(at):
                apart = np.abs(parts[at] - parts[k]).sum(axis=1, dtype=np.int64)
                at = at[apart <= total[at] - 2 * need[at]]
                a.append(np.full(len(at), doc[k]))
                b.append(doc[at])
        join = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        return pa.table({"a": join(a), "b": join(b)})

    return dealt.groupBy("token", "i", "j").applyInArrow(block, "a long, b long").distinct()


def join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least doc_id that is reachable by links."""
    sets = written(records(docs, bucket_counts(docs, size), size, percent), "sets")
    some = sets.where("n_shingles > 0 and doc_id is not null")
    classes = written(some.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("id")), "classes")
    heads = some.join(classes.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    tokens = heads.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    twice = tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    shared = written(tokens.join(twice, "token", "left_semi").select("token", "doc", "n", "pos"), "shared")
    ids = shared.select(F.col("doc").alias("id")).distinct()
    slim = written(some.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").select("doc_id", "n_shingles", "parts"), "parts")

    labels = written(ids.withColumn("label", F.col("id")), "labels")
    links, left = None, shared.withColumn("label", F.col("doc"))
    for seed in range(ROUNDS):
        found = written(verify(written(_round(left, slim, seed, percent), "round"), docs, size, percent), "links")
        links = found if links is None else links.union(found)
        side = lambda x: labels.select(F.col("id").alias(x), F.col("label").alias(f"l{x}"))  # noqa: E731, B023
        between = found.join(side("a"), "a").join(side("b"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
        labels = written(merged(labels, between), "labels")
        left = written(_unresolved(left, labels), "unresolved")
    rest = written(_remaining(left, slim, percent), "rest")
    links = links.union(verify(rest, docs, size, percent))
    groups = components(links, "components").withColumnRenamed("id", "head")
    member = sets.select("doc_id", "n_shingles", "d1", "d2").join(classes.withColumnRenamed("id", "head"), ["d1", "d2", "n_shingles"], "left")
    member = member.join(groups, "head", "left")
    linked = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("component", "head"))
    return member.select("doc_id", "n_shingles", F.coalesce(linked, "doc_id").alias("component_id"))
