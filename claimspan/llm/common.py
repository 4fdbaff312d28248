"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
import atexit
import gc
import os
from pathlib import Path
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: White space between words, as a character class and as characters.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Bits of the document filter of ``only_documents``; 1 MiB whatever the input.
FILTER_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_code():
    """A code of the id and text of a row: rows that share an id differ in it, equal rows do not."""
    return F.xxhash64("doc_id", "text")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless PYTHONPATH already names its folder."""
    root, app = Path(__file__).resolve().parents[2], spark.sparkContext.applicationId
    if app in _shipped or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _shipped.add(app)
    own = tempfile.mkdtemp()  # only the driver reads it: Spark's file server sends it on
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    name = Path(__file__).resolve().parents[1].name
    spark.sparkContext.addPyFile(shutil.make_archive(f"{own}/{name}", "zip", root, name))


#: Rows in one batch that goes to Python; some documents are very long.
BATCH_ROWS = "1000"
#: Characters of a plan's description that the driver keeps.
PLAN_TEXT = "20000"


def prepare(spark: SparkSession) -> None:
    """What the Python workers need before an operator of this subpackage runs."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    # Spark keeps the text of every plan it has run; those with a table of counts as a constant have megabytes.
    spark.conf.set("spark.sql.maxPlanStringLength", PLAN_TEXT)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: the lineage ends at those files.

    The files stay until ``clear`` or the folder's own retention removes them, because later jobs,
    also those after a lost executor, read them.
    """
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``written`` behind their last use: no result that is still to be read may depend on them."""
    for table in tables:
        _remove(table.sparkSession, table.written_to)
    if tables:
        settle(tables[0].sparkSession)


def settle(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of the steps that are written: it does so when the driver collects their plans,
    which by itself it may do only every half an hour."""
    gc.collect()
    spark._jvm.System.gc()


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application. No result that is still to be read may depend on them."""
    _remove(spark, folder(spark, "x").rsplit("/", 1)[0])


def text_batches(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch with its texts as UTF-8 bytes; null is empty."""
    for batch in batches:
        yield batch, [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


def by_size(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``limit`` bytes each; a longer text is a range of its own."""
    groups = np.cumsum([0, *map(len, texts)])[:-1] // limit
    bounds = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(texts)]
    return ((a, b) for a, b in zip(bounds, bounds[1:]) if a < b)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values under which close values end far apart (multiply, shift and xor)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """64-bit polynomial hashes of substrings, from one running sum over the bytes.

    Byte values go through a table of random numbers first; the multiplier is odd, so it has an
    inverse modulo 2^64 and ``hash(a, b)`` does not depend on where the substring stands.
    """

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(2**62, 2**63)) * 2 + 1
        self.inverse = pow(self.base, -1, 2**64)
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) + 1 > len(self.up):
            self._grow(2 * len(data) + 2)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=out[1:])
        return out

    def hash(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))

    def windows(self, sums: np.ndarray, width: int) -> np.ndarray:
        """The hash of each window of so many bytes."""
        n = len(sums) - width
        return mix((sums[width:] - sums[:n]) * self.down[:n] + np.uint64(width))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word ``[^\\x20\\x09-\\x0D]+`` in the bytes of a text."""
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~_IS_SPACE[data]
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def shingle_hashes(text: bytes, size: int, rolling: Rolling) -> np.ndarray:
    """The distinct hashes, ascending, of all ``size`` consecutive words; A-Z is lower-cased.

    A text with fewer words has one shingle, of all its words; a text without words has none.
    """
    data = _LOWER[np.frombuffer(text, np.uint8)]
    begin, end = word_spans(data)
    if not len(begin):
        return np.empty(0, np.uint64)
    words = rolling.hash(rolling.sums(data), begin, end)
    n = max(1, len(words) - size + 1)
    out = np.full(n, min(size, len(words)), np.uint64)
    for k in range(min(size, len(words))):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return np.unique(out)


def _bits(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)


def id_filter(ids: DataFrame):
    """A broadcast bit set of the ids in the first column: FILTER_BITS, about 1 MiB, whatever the input.

    ``maybe_in(bits)`` and ``surely_not_in(bits)`` part a table by it. A full bit set only parts less.
    """

    def bits(batches):
        seen = np.zeros(FILTER_BITS, bool)
        for b in batches:
            seen[_bits(b.column(0).to_numpy(zero_copy_only=False))] = True
        packed = np.packbits(seen).reshape(64, -1)
        rows = [k for k in range(64) if packed[k].any()]
        yield pa.RecordBatch.from_pydict({"part": pa.array(rows, pa.int32()), "bits": pa.array([packed[k].tobytes() for k in rows], pa.binary())})

    def merged(batches):
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = np.frombuffer(v, np.uint8)
                parts[k] = parts[k] | v if k in parts else v
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(parts), pa.int32()), "bits": pa.array([v.tobytes() for v in parts.values()], pa.binary())})

    schema = "part int, bits binary"
    seen = np.zeros((64, FILTER_BITS // 512), np.uint8)
    ids = ids.select(F.col(ids.columns[0]).cast("long").alias("id")).where("id is not null")
    for row in ids.mapInArrow(bits, schema).repartition(16, "part").mapInArrow(merged, schema).collect():
        seen[row.part] = np.frombuffer(row.bits, np.uint8)
    return ids.sparkSession.sparkContext.broadcast(np.unpackbits(seen.reshape(-1)).astype(bool))


def filtered(docs: DataFrame, column: str, bits, inside: bool = True) -> DataFrame:
    """The rows whose id may be in the bit set, or those whose id surely is not; no id is null."""

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(bits.value[_bits(b.column(column).to_numpy(zero_copy_only=False))] == inside))

    return docs.mapInArrow(run, docs.schema)


def only_documents(docs: DataFrame, ids: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` and ``columns`` of the documents whose id occurs in ``ids``.

    The bit set drops most other documents before their texts are shuffled; the semi join makes it exact.
    """
    ids = ids.select(F.col(ids.columns[0]).cast("long").alias("doc_id"))
    kept = docs.where("doc_id is not null").select("doc_id", *columns)
    return filtered(kept, "doc_id", id_filter(ids)).join(ids, "doc_id", "left_semi")
