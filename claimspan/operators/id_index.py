"""An index of the ids that a table holds, in files by bucket, so that a batch opens only the buckets it can hit.

The ids of a load fall into buckets by their hash; each bucket gets a sorted file with a Parquet Bloom filter. A batch
reads the buckets of its own ids only; the ids of a small batch also go to the scan as equality filters, which row
groups answer from their Bloom filters.

The index stands beside a table that has no pointer to switch, so a load announces its ids first (``begin``), appends
its rows, and then closes the entry (``finish``): files move into the index without being written again. After a stop
the announced ids, and only those, are compared with the table (``recover``), or dropped where the same batch runs
again and replaces its rows (``resume``). Rows that others write into the table are not known: ``build`` reads all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimspan.operators import versions

BUCKETS = 16
#: Files of a bucket after which its ids are written anew as one.
FILES = 32
#: Batches of up to so many ids are also looked up by value.
BY_VALUE = 64
#: Writer options of the files of an index.
BLOOM = {"parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.expected.ndv#id": "20000"}


class IdIndex:
    """The index at ``store``, a version store: table ``ids``, and ``open-<tag>`` for announced ids.

    Choose ``buckets`` so that the ids of a bucket make a file of usual size; a store keeps the number it began with.
    """

    def __init__(self, spark: SparkSession, store: str, buckets: int = BUCKETS):
        self.spark, self.store, self.buckets = spark, store.rstrip("/"), buckets

    def _bucketed(self, ids: DataFrame) -> DataFrame:
        """The ids of the first column with their buckets."""
        rows = ids.select(F.col(ids.columns[0]).alias("id")).where("id is not null")
        return rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int"))

    def _rows(self, ids: DataFrame) -> DataFrame:
        """Distinct ids of the first column with their buckets, one sorted file a bucket."""
        return self._bucketed(ids).repartition("bucket").distinct().sortWithinPartitions("bucket", "id")

    def _state(self) -> tuple[bool, str | None]:
        """Whether there are ids, and the name of the table of announced ones."""
        tables = versions.latest(self.spark, self.store).tables
        return "ids" in tables, next((n for n in tables if n.startswith("open-")), None)

    def build(self, ids: DataFrame) -> None:
        """The index of all ids of a table, in place of what there is."""
        with versions.change(self.spark, self.store) as change:
            change.replace("ids", self._rows(ids), ["bucket"], BLOOM)

    def candidates(self, ids: DataFrame) -> DataFrame:
        """``id`` of the buckets that some of ``ids`` fall into; with few ids only those that are equal to one."""
        state = versions.latest(self.spark, self.store)
        rows = self._bucketed(ids)
        if "ids" not in state.tables:
            return rows.select("id").limit(0)
        hit = [r.bucket for r in rows.select("bucket").distinct().collect()]  # as many rows as there are buckets
        found = versions.read_parts(self.spark, self.store, "ids", [{"bucket": b} for b in hit], state).select("id")
        few = [r.id for r in rows.select("id").distinct().limit(BY_VALUE + 1).collect()]
        return found.where(reduce(Column.__or__, [F.col("id") == i for i in few])) if 0 < len(few) <= BY_VALUE else found

    def held(self, ids: DataFrame) -> DataFrame:
        """``id`` of those of ``ids`` that the index holds."""
        wanted = ids.select(F.col(ids.columns[0]).alias("id"))
        return self.candidates(ids).join(wanted, "id", "left_semi").distinct()

    # ---------------------------------------------------------------- loads

    def begin(self, ids: DataFrame, tag: int = 0) -> None:
        """Announce the ids that a load, or the batch numbered ``tag``, is about to write."""
        with versions.change(self.spark, self.store) as change:
            change.replace(f"open-{tag}", self._rows(ids), ["bucket"], BLOOM)

    def finish(self) -> None:
        """The announced rows are in the table."""
        _, announced = self._state()
        if announced is None:
            return
        with versions.change(self.spark, self.store) as change:
            change.adopt("ids", announced)
            if max((len(f) for f in change.tables["ids"].parts.values()), default=0) > FILES:
                change.replace("ids", self._rows(change.read("ids").select("id")), ["bucket"], BLOOM)
        versions.prune(self.spark, self.store)

    def recover(self, table_ids: DataFrame | None) -> None:
        """Before a load: build the index where there is none; after a stop, keep the announced ids that the table has."""
        there, announced = self._state()
        if announced is not None:
            with versions.change(self.spark, self.store) as change:
                if table_ids is not None:
                    known = table_ids.select(F.col(table_ids.columns[0]).alias("id"))
                    rows = change.read(announced).select("id").join(known, "id", "left_semi")
                    change.replace(announced, self._rows(rows), ["bucket"], BLOOM)
                    change.adopt("ids", announced)
                change.drop(announced)
        elif not there and table_ids is not None:
            self.build(table_ids)

    def resume(self, tag: int) -> None:
        """Before batch ``tag``: an earlier batch is complete; the same one runs again and replaces what it wrote."""
        _, announced = self._state()
        if announced == f"open-{tag}":
            with versions.change(self.spark, self.store) as change:
                change.drop(announced)
        elif announced is not None:
            self.finish()
