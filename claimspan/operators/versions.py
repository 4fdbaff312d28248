"""Tables that switch from one version to the next at once.

A store is a folder. Each change writes new folders below ``store/v<number>-<token>`` and never touches older ones; a
pointer file ``store/_pointer/<number>``, made last by a rename that fails where the name is taken, lists the folders of
every table of the store. Readers take the highest pointer. So a change that stops anywhere leaves the version before
it as it was, tables of one store change together, and of two changes at the same time one fails and can be repeated.

Partition folders are named by a hash of the values, and the columns stay in the files: no path is made from a value,
and values that share a folder do no harm.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from claimspan.session import remove_dir

_PART = "_part"


class ConcurrentChange(RuntimeError):
    """Another change of the store was finished first; repeat this one."""


@dataclass(frozen=True)
class Table:
    """The folders of a table, by partition folder name ('' where it has none), and its schema."""

    schema: str
    partition_by: tuple[str, ...] = ()
    parts: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def folders(self, parts: Iterable[str] | None = None) -> list[str]:
        names = self.parts if parts is None else [p for p in parts if p in self.parts]
        return [f for p in sorted(names) for f in self.parts[p]]


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)


# ---------------------------------------------------------------- files


def _path(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def _read_text(spark: SparkSession, file: str) -> str:
    path, fs = _path(spark, file)
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _point(spark: SparkSession, store: str, version: Version) -> None:
    """Write the pointer beside its place and rename it there; a pointer that exists is never replaced."""
    jvm = spark.sparkContext._jvm
    goal, fs = _path(spark, f"{store}/_pointer/{version.number:012d}")
    draft, _ = _path(spark, f"{store}/_pointer/.draft-{uuid.uuid4().hex}")
    tables = {n: {"schema": t.schema, "partition_by": t.partition_by, "parts": t.parts} for n, t in version.tables.items()}
    stream = fs.create(draft, False)
    try:
        stream.write(json.dumps({"tables": tables}).encode())
    finally:
        stream.close()
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(goal), no_overwrite)
    except Exception as error:
        fs.delete(draft, False)
        if fs.exists(goal):
            raise ConcurrentChange(f"version {version.number} of {store} exists") from error
        raise


# ---------------------------------------------------------------- reading


def latest(spark: SparkSession, store: str) -> Version:
    """The newest version; number 0 without tables before the first change."""
    numbers = [int(n) for n in _names(spark, f"{store}/_pointer") if n.isdigit()]
    return at(spark, store, max(numbers)) if numbers else Version()


def at(spark: SparkSession, store: str, number: int) -> Version:
    """An older version, as long as ``prune`` has kept it."""
    saved = json.loads(_read_text(spark, f"{store}/_pointer/{number:012d}"))["tables"]
    tables = {
        n: Table(t["schema"], tuple(t["partition_by"]), {p: tuple(f) for p, f in t["parts"].items()}) for n, t in saved.items()
    }
    return Version(number, tables)


def _frame(spark: SparkSession, store: str, table: Table, parts: Iterable[str] | None = None) -> DataFrame:
    schema, folders = T.StructType.fromJson(json.loads(table.schema)), table.folders(parts)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{store}/{f}" for f in folders])


def read(spark: SparkSession, store: str, name: str = "data", version: Version | None = None) -> DataFrame:
    """A table of the newest version, or of a given one."""
    version = version or latest(spark, store)
    if name not in version.tables:
        raise ValueError(f"{store} has no table {name!r} in version {version.number}")
    return _frame(spark, store, version.tables[name])


def read_parts(
    spark: SparkSession, store: str, name: str, values: Sequence[dict[str, object]], version: Version | None = None
) -> DataFrame:
    """The rows in the partitions of the given values; no file of another partition is opened.

    Partitions share a folder where their values share a hash, so filter by the values too where that matters.
    """
    table = (version or latest(spark, store)).tables[name]
    columns = T.StructType.fromJson(json.loads(table.schema))
    kinds = T.StructType([columns[c] for c in table.partition_by])
    wanted = spark.createDataFrame([tuple(v[c] for c in table.partition_by) for v in values], kinds)
    return _frame(spark, store, table, {r[0] for r in wanted.select(F.hex(F.xxhash64(*table.partition_by))).collect()})


# ---------------------------------------------------------------- changing


class Change:
    """The next version in the making: ``with change(spark, store) as c: c.replace(...); c.append(...)``.

    Tables that are not named stay as they are. Nothing is visible before the block ends; if it raises, the folder of
    this change is removed and the store is as before.
    """

    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.store = spark, store.rstrip("/")
        self.before = latest(spark, self.store)
        self.number = self.before.number + 1
        self.tables = dict(self.before.tables)
        self.folder = f"v{self.number:012d}-{uuid.uuid4().hex[:12]}"

    def read(self, name: str = "data") -> DataFrame:
        """A table as this change has left it so far."""
        return _frame(self.spark, self.store, self.tables[name])

    def _write(
        self, name: str, df: DataFrame, partition_by: Sequence[str], options: dict[str, str] | None = None
    ) -> dict[str, tuple[str, ...]]:
        folder = f"{self.folder}/{name}-{uuid.uuid4().hex[:6]}"
        if not partition_by:
            df.write.options(**(options or {})).parquet(f"{self.store}/{folder}")
            return {"": (folder,)}
        part = F.hex(F.xxhash64(*partition_by))
        df.withColumn(_PART, part).write.options(**(options or {})).partitionBy(_PART).parquet(f"{self.store}/{folder}")
        names = [n for n in _names(self.spark, f"{self.store}/{folder}") if n.startswith(f"{_PART}=")]
        return {n.split("=", 1)[1]: (f"{folder}/{n}",) for n in names}

    def replace(
        self, name: str, df: DataFrame, partition_by: Sequence[str] = (), options: dict[str, str] | None = None
    ) -> None:
        """New rows and a new schema in place of the table, which need not exist; ``options`` go to the writer."""
        self.tables[name] = Table(df.schema.json(), tuple(partition_by), self._write(name, df, partition_by, options))

    def adopt(self, name: str, source: str) -> None:
        """The files of table ``source``, of the same schema and partitions, go over to ``name``, which need not exist."""
        more = self.tables.pop(source)
        old = self.tables.get(name, replace(more, parts={}))
        parts = {p: old.parts.get(p, ()) + more.parts.get(p, ()) for p in [*old.parts, *more.parts]}
        self.tables[name] = replace(old, parts=parts)

    def rename(self, source: str, name: str) -> None:
        """Table ``source`` takes the place of ``name``; no file is written."""
        self.tables[name] = self.tables.pop(source)

    def drop(self, name: str) -> None:
        self.tables.pop(name, None)

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """More rows; the first ones make the table."""
        old = self.tables.get(name)
        if old is None:
            return self.replace(name, df, partition_by)
        columns = [f.name for f in T.StructType.fromJson(json.loads(old.schema)).fields]
        new = self._write(name, df.select(*columns), old.partition_by)
        parts = {p: old.parts.get(p, ()) + new.get(p, ()) for p in [*old.parts, *new]}
        self.tables[name] = replace(old, parts=parts)

    def merge(self, name: str, updates: DataFrame, keys: Sequence[str]) -> None:
        """Rows of ``updates`` (one per key) in place of those with their keys, or beside the others.

        Of a partitioned table only the partitions that hold or get an updated row are written again; the others stay
        in the folders where they are. A row without a full key matches nothing.
        """
        old = self.tables[name]
        columns = [f.name for f in T.StructType.fromJson(json.loads(old.schema)).fields]
        self.replace("_updates", updates.select(*columns))
        newest = self.read("_updates")
        touched = None
        if old.partition_by:
            part = F.hex(F.xxhash64(*old.partition_by)).alias(_PART)
            hit = self.read(name).join(newest.select(*keys), list(keys), "left_semi").select(part)
            rows = hit.unionByName(newest.select(part)).distinct().collect()  # one row a partition of the table
            touched = [r[0] for r in rows]
        kept = _frame(self.spark, self.store, old, touched).join(newest.select(*keys), list(keys), "left_anti")
        new = self._write(name, kept.unionByName(newest).select(*columns), old.partition_by)
        parts = {p: f for p, f in old.parts.items() if touched is not None and p not in touched}
        self.tables[name] = replace(old, parts=parts | new)
        updates_folder = self.tables.pop("_updates").folders()[0]
        remove_dir(self.spark, f"{self.store}/{updates_folder}")

    def __enter__(self) -> Change:
        return self

    def __exit__(self, kind, error, trace) -> None:
        try:
            if kind is None:
                _point(self.spark, self.store, Version(self.number, self.tables))
                return
        except BaseException:
            self._remove()
            raise
        self._remove()

    def _remove(self) -> None:
        remove_dir(self.spark, f"{self.store}/{self.folder}")


def change(spark: SparkSession, store: str) -> Change:
    return Change(spark, store)


def prune(spark: SparkSession, store: str, keep: int = 2) -> list[str]:
    """Remove folders that none of the newest ``keep`` versions names, and the pointers of older versions.

    Folders of a change that is still in the making have a higher number than the newest version and stay.
    """
    store = store.rstrip("/")
    numbers = sorted(int(n) for n in _names(spark, f"{store}/_pointer") if n.isdigit())
    if not numbers:
        return []
    kept = [at(spark, store, n) for n in numbers[-max(1, keep):]]
    used = {f.split("/", 1)[0] for v in kept for t in v.tables.values() for f in t.folders()}
    for n in numbers[: -max(1, keep)]:
        remove_dir(spark, f"{store}/_pointer/{n:012d}")
    gone = [n for n in _names(spark, store) if n.startswith("v") and n not in used and int(n[1:13]) <= numbers[-1]]
    for name in gone:
        remove_dir(spark, f"{store}/{name}")
    return gone
