"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products inside them, components.

Centroids are fitted on at most SAMPLE vectors; every vector is then assigned. A vector is a member of each
cell whose centroid is at most MARGIN less similar to it than its nearest one, and owned by the nearest cell.
In a cell all owned vectors are compared with all members, in blocks, so a cell that holds a third of all
vectors is many small groups. Equal vectors are folded into one with a weight first. A block gives counts and
a spanning forest of its links, never the pairs.

Two vectors are compared if either is a member of the cell that owns the other. For cosines of 0.9 and more
that misses only pairs whose nearest centroids differ by more than MARGIN for both; the tests measure the
recall against brute force. Cosines are computed in double precision.

The work is the members per cell times the vectors; within a cell of near copies it is the square of its
size, which counting each vector's links needs.

Edge cases: null or zero vectors, and vectors with null or non-finite components, link with nothing; vectors
of different lengths are never compared; rows without an id have no component and are not kept; repeated rows
are copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimspan.llm.common import mix, written
from claimspan.llm.components import components

THRESHOLD = 0.9
SAMPLE = 20_000
#: Vectors per cell that the number of cells aims at, and the number of cells at most.
PER_CELL, MAX_CELLS = 200, 2048
MARGIN = 0.15
ROUNDS = 5
#: Vectors on either side of a block.
BLOCK = 1024


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """``k`` unit centroids of the unit rows of ``x``."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(x[a : a + 2048] @ centroids.T).argmax(axis=1) for a in range(0, len(x), 2048)])
        order = np.argsort(nearest, kind="stable")
        used, first = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(x[order], first, axis=0)
        norm = np.linalg.norm(sums, axis=1)
        centroids[used[norm > 0]] = sums[norm > 0] / norm[norm > 0, None]
    return centroids


def _valid(vector: F.Column) -> F.Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes(vectors: DataFrame) -> DataFrame:
    """id, weight and vector of each distinct valid vector; the id is the least of its copies."""
    good = vectors.where(F.col("vec_id").isNotNull() & _valid(F.col("embedding")))
    return good.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))


def fit(distinct: DataFrame, per_cell: int = PER_CELL, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Centroids by vector length, from the ``sample`` vectors with the least hash of their id."""
    total = distinct.count()
    rows = distinct.orderBy(F.xxhash64("id"), "id").limit(sample).select("embedding").collect()
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(len(r.embedding), []).append(r.embedding)
    cells = {n: min(MAX_CELLS, len(x), max(1, round(total * len(x) / len(rows) / per_cell))) for n, x in by_length.items()}
    return {n: spherical_kmeans(_unit(x), cells[n]) for n, x in by_length.items()}


def assign(distinct: DataFrame, centroids: dict[int, np.ndarray], margin: float = MARGIN) -> DataFrame:
    """id, weight, embedding, own cell, member cells and the least similarity of a member of each vector.

    Cells are numbered after the vector's length; a length that the sample lacks is one cell.
    """
    given = distinct.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        for batch in batches:
            rows = batch.column("embedding").to_pylist()
            lengths = np.array([len(x) for x in rows])
            own, cells, least = np.zeros(len(rows), np.int64), [[]] * len(rows), np.zeros(len(rows))
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                if n not in given.value:
                    own[at], least[at] = int(n) << 20, -2.0
                    for k in at:
                        cells[k] = [int(n) << 20]
                    continue
                near = _unit([rows[k] for k in at]) @ given.value[n].T
                least[at] = near.max(axis=1) - margin
                own[at] = (int(n) << 20) + near.argmax(axis=1)
                for k, row in zip(at, near):
                    cells[k] = ((int(n) << 20) + np.flatnonzero(row >= least[k])).tolist()
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "weight": batch.column("weight"),
                    "embedding": batch.column("embedding"),
                    "own": own,
                    "cells": pa.array(cells, pa.list_(pa.int64())),
                    "least": least,
                }
            )

    kind = dict(distinct.dtypes)["embedding"]
    return distinct.select("id", "weight", "embedding").mapInArrow(run, f"id long, weight long, embedding {kind}, own long, cells array<long>, least double")


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least id that each row and column of a block reaches by its links."""
    big = np.iinfo(np.int64).max
    while True:
        new_right = np.minimum(right, np.where(linked, left[:, None], big).min(axis=0))
        new_left = np.minimum(left, np.where(linked, new_right[None, :], big).min(axis=1))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def compare(assigned: DataFrame, centroids: dict[int, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """(id, links, root): the links of a vector within a block, and a vector it is connected with."""
    spark = assigned.sparkSession
    sizes = assigned.select("own", F.explode("cells").alias("cell")).groupBy("cell").agg(
        F.count("*").alias("members"), F.sum((F.col("own") == F.col("cell")).cast("int")).alias("owned")
    )
    # One row per cell: MAX_CELLS for each vector length.
    blocks = {r.cell: (-(-r.owned // BLOCK), -(-r.members // BLOCK)) for r in sizes.collect() if r.owned}
    given, shared = spark.sparkContext.broadcast(centroids), spark.sparkContext.broadcast(blocks)
    kind = dict(assigned.dtypes)["embedding"]
    schema = f"cell long, i int, j int, owner boolean, id long, weight long, embedding {kind}, own long, least double"

    def deal(batches):
        for batch in batches:
            h = (mix(batch.column("id").to_numpy(zero_copy_only=False).astype(np.uint64)) >> np.uint64(20)).astype(np.int64)
            take, cell, i, j, owner = [], [], [], [], []
            for k, (own, cells) in enumerate(zip(batch.column("own").to_pylist(), batch.column("cells").to_pylist())):
                rows, columns = shared.value[own]
                for c in range(columns):
                    take.append(k), cell.append(own), i.append(h[k] % rows), j.append(c), owner.append(True)
                for other in cells:
                    if other in shared.value:
                        rows, columns = shared.value[other]
                        for r in range(rows):
                            take.append(k), cell.append(other), i.append(r), j.append(h[k] % columns), owner.append(False)
            for at in range(0, len(take), 10_000):
                part = slice(at, at + 10_000)
                picked = batch.take(pa.array(take[part], pa.int64()))
                yield pa.RecordBatch.from_pydict(
                    {
                        "cell": pa.array(cell[part], pa.int64()),
                        "i": pa.array(i[part], pa.int32()),
                        "j": pa.array(j[part], pa.int32()),
                        "owner": pa.array(owner[part], pa.bool_()),
                        **{n: picked.column(n) for n in ("id", "weight", "embedding", "own", "least")},
                    }
                )

    def block(rows: pa.Table) -> pa.Table:
        owner = rows.column("owner").to_numpy(zero_copy_only=False).astype(bool)
        column = lambda name: rows.column(name).to_numpy(zero_copy_only=False)
        ids, weight, own, least = column("id"), column("weight"), column("own"), column("least")
        empty = pa.table({n: pa.array([], pa.int64()) for n in ("id", "links", "root")})
        if owner.all() or not owner.any():
            return empty
        unit = _unit(rows.column("embedding").to_pylist())
        left, right = ids[owner], ids[~owner]
        linked = (unit[owner] @ unit[~owner].T >= threshold) & (left[:, None] != right[None, :])
        if not linked.any():
            return empty
        links_left = (linked * weight[~owner]).sum(axis=1)
        # The right vector counts the pair itself, in the cell that owns it, unless the left one is no member there.
        cell = rows.column("cell")[0].as_py()
        centroids = given.value.get(cell >> 20)
        alone = np.zeros_like(linked)
        away = np.flatnonzero((own[~owner] != cell) & linked.any(axis=0))
        if len(away) and centroids is not None:
            near = unit[owner] @ centroids[own[~owner][away] & ((1 << 20) - 1)].T
            alone[:, away] = linked[:, away] & (near < least[owner][:, None])
        links_right = (alone * weight[owner][:, None]).sum(axis=0)
        root_left, root_right = _forest(linked, left, right)
        some_left, some_right = linked.any(axis=1), linked.any(axis=0)
        join = lambda a, b: pa.array(np.concatenate([a[some_left], b[some_right]]).astype(np.int64))
        return pa.table({"id": join(left, right), "links": join(links_left, links_right), "root": join(root_left, root_right)})

    dealt = assigned.mapInArrow(deal, schema)
    return dealt.groupBy("cell", "i", "j").applyInArrow(block, "id long, links long, root long")


def deduplicate(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding)."""
    distinct = written(classes(vectors), "classes")
    centroids = fit(distinct)
    assigned = written(assign(distinct, centroids), "assigned")
    found = written(compare(assigned, centroids, threshold), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select("id", "root"), "vectors")
    known = (
        distinct.join(links, "id", "left")
        .join(groups, "id", "left")
        .select(
            "embedding",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    rows = vectors.select("vec_id", F.when(F.col("vec_id").isNotNull() & _valid(F.col("embedding")), F.col("embedding")).alias("embedding"))
    result = rows.join(known, "embedding", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
