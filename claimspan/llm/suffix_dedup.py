"""Removal of every byte that a long repeated string covers, by column-wise construction of suffix orders.

A text is cut where its content says: the anchor of a window of LENGTH bytes is its leftmost CORE-byte substring
of least hash. Windows in a row with one anchor make a segment. Equal windows have equal anchors at the same
place, so segments are grouped by the hash of their anchor:

* an anchor that occurs once, or only in one segment text, needs no comparison;
* the different segment texts of an anchor are lined up at it, and the Burrows-Wheeler transform of the collection
  is built by columns: the last LENGTH bytes from the anchor on are sorted as the segments' end symbols, then each
  round inserts, for every segment, the symbol one place further to the left. A round reads the transform, the
  common prefixes and the suffixes' names from files, and writes them anew in order. Suffixes whose common prefix
  with a neighbour reaches LENGTH are repeated windows.

One task works on a block of segments at a time. Anchors with more than MAX_SEGMENTS different segments are not
sorted in one task; their windows are grouped by digests, which gives the same result. The files are private to
a block and removed with it.

Edge cases: null and empty texts have 0 bytes and nothing is removed; texts shorter than LENGTH cannot repeat;
rows that share a doc_id, and repeated rows, are documents of their own; a null doc_id is carried along; an empty
table gives an empty result. Matches never cross documents.
"""

from __future__ import annotations

import hashlib
from pathlib import Path
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimspan.llm.common import Rolling, filtered, id_filter, only_documents, row_code, text_batches, written

LENGTH = 400
#: Bytes of an anchor, by the length of a window.
CORE_SHARE = 0.5
#: Window starts that are worked on at a time in a very long text.
CHUNK = 1 << 19
#: Different segments of one anchor that one task sorts at most, and segments in a block.
MAX_SEGMENTS, BLOCK = 5000, 1500

_PLACE = np.uint64((1 << 20) - 1)


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        v = np.minimum(v[:-done], v[done:])
        done *= 2
    return np.minimum(v[: len(v) - (width - done)], v[width - done :]) if done < width else v


def segments(data: np.ndarray, length: int, anchors: Rolling, texts: Rolling, chunk: int = CHUNK) -> tuple[np.ndarray, ...]:
    """First window, number of windows, place and hash of the anchor, and digest, of each segment of a text."""
    core = int(length * CORE_SHARE)
    out = []
    for at in range(0, max(0, len(data) - length + 1), chunk):
        part = data[at : at + chunk + length - 1]
        hashes, sums = anchors.windows(anchors.sums(part), core), texts.sums(part)
        place = (_sliding_least((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), length - core + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:], len(place))
        out.append((first + at, last - first, place[first] + at, hashes[place[first]], texts.hash(sums, first, last + length - 1)))
    if not out:
        return tuple(np.empty(0, k) for k in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out))


OCCURRENCES = "row long, first long, n int, place long, anchor long, digest long"


def occurrences(rows: DataFrame, length: int, chunk: int | None = None) -> DataFrame:
    """The segments of all rows (doc_id: number of the row, text)."""
    chunk = chunk or CHUNK  # here, not in the workers, so that a changed value reaches them

    def run(batches):
        anchors, texts = Rolling(7), Rolling(8)
        for batch, raw in text_batches(batches):
            found = [segments(np.frombuffer(x, np.uint8), length, anchors, texts, chunk) for x in raw]
            n = [len(x[0]) for x in found]
            join = lambda k: np.concatenate([x[k] for x in found]) if found else np.empty(0, np.int64)  # noqa: E731, B023
            yield pa.RecordBatch.from_pydict(
                {
                    "row": np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), n),
                    "first": join(0),
                    "n": join(1).astype(np.int32),
                    "place": join(2),
                    "anchor": join(3).view(np.int64),
                    "digest": join(4).view(np.int64),
                }
            )

    return rows.where(F.octet_length("text") >= length).mapInArrow(run, OCCURRENCES)


class Columns:
    """Transform, common prefixes and names of the suffixes so far, in order, in files that each round writes anew.

    A round's files are new ones and the old ones go: a file that is cut and written again would be forced to disk
    when it is closed, while one that goes soon never has to be.
    """

    FILES = {"symbol": np.uint8, "common": np.int16, "name": np.int32}

    def __init__(self, folder: str):
        self.folder, self.round = Path(folder), 0

    def _path(self, what: str) -> Path:
        return self.folder / f"{what}-{self.round}"

    def read(self, what: str) -> np.ndarray:
        return np.fromfile(self._path(what), self.FILES[what])

    def write(self, **columns: np.ndarray) -> None:
        old = [self._path(what) for what in columns]
        self.round += 1
        for what, values in columns.items():
            values.astype(self.FILES[what], copy=False).tofile(self._path(what))
        for path in old:
            path.unlink(missing_ok=True)


def _common_prefix(tails: list[bytes]) -> np.ndarray:
    """Common prefix of each string with the one before it."""
    out = np.zeros(len(tails), np.int64)
    for k in range(1, len(tails)):
        a, b = tails[k - 1], tails[k]
        n = min(len(a), len(b))
        if a[:n] == b[:n]:
            out[k] = n
        else:
            x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
            out[k] = x.argmax()
    return out


def repeated_windows(texts: list[bytes], lead: list[int], length: int, folder: str) -> list[np.ndarray]:
    """For each text, at how many places before its anchor a window begins that is repeated in the collection.

    Every window that another text has at the same place is found.

    ``lead`` is the number of bytes in front of the anchor. Column-wise construction: the order starts with the
    tails (from the anchor on), as end symbols less than any byte; round r inserts the suffixes that begin r bytes
    before the anchor. A suffix c + x stands at (number of lesser symbols in the transform) + (number of c before x),
    and its common prefix is one more than the least one between x and the last suffix before x that c precedes.
    """
    count, lead_of = len(texts), np.array(lead)
    tails = [t[n : n + length] for t, n in zip(texts, lead)]
    order = np.array(sorted(range(count), key=tails.__getitem__))
    files = Columns(folder)
    common = _common_prefix([tails[k] for k in order])
    # What precedes a suffix is known once that is inserted; ranks count only those ``extended`` suffixes.
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    files.write(symbol=np.zeros(count, np.uint8), common=common, name=order << 16)
    extended = np.zeros(count, bool)
    alive = np.arange(count)
    for r in range(1, int(lead_of.max(initial=0)) + 1):
        alive = alive[lead_of[alive] >= r]
        symbol, common, name = files.read("symbol"), files.read("common"), files.read("name")
        at = place[alive]
        symbol[at] = [texts[k][lead[k] - r] for k in alive.tolist()]
        extended[at] = True
        # Places of extended suffixes by symbol, in order: where each one's extension stands after the end symbols.
        by_symbol = np.flatnonzero(extended)
        by_symbol = by_symbol[np.argsort(symbol[by_symbol], kind="stable")]
        rank = np.empty(len(symbol), np.int64)
        rank[by_symbol] = np.arange(len(by_symbol))
        new = np.sort(rank[at])
        # A new suffix and the one after it get the least common prefix since the last place of the same symbol.
        touched = np.unique(np.append(new, new + 1))
        touched = touched[touched < len(by_symbol)]
        here, before = by_symbol[touched], by_symbol[np.maximum(touched - 1, 0)]
        same = (touched > 0) & (symbol[here] == symbol[before])
        least = np.zeros(len(touched), np.int64)
        if same.any():
            bounds = np.stack([before[same] + 1, here[same] + 1], axis=1).reshape(-1)
            least[same] = 1 + np.minimum.reduceat(np.append(common, 0), bounds)[::2]
        grown = np.zeros(count + len(by_symbol), bool)
        grown[count + new] = True
        merged = {}
        by_place = alive[np.argsort(rank[at])]
        for what, old, inserted in (("symbol", symbol, 0), ("common", common, 0), ("name", name, ((by_place << 16) + r).astype(np.int32)), ("extended", extended, False)):
            merged[what] = np.empty(len(grown), old.dtype)
            merged[what][~grown] = old
            merged[what][grown] = inserted
        merged["common"][count + touched] = np.minimum(least, 32_767)
        place = np.where(np.isin(np.arange(count), alive), place, 0)
        place[by_place] = count + new
        extended = merged.pop("extended")
        files.write(**merged)
    common, name = files.read("common"), files.read("name")
    joined = common >= length
    repeated = joined | np.append(joined[1:], False)
    which, depth = name[repeated] >> 16, (name[repeated] & 0xFFFF).astype(np.int64)
    order = np.argsort(which, kind="stable")
    ends = np.searchsorted(which[order], np.arange(count), "right")
    return [np.sort(x) for x in np.split(depth[order], ends[:-1])]


def _ranges(places: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as (first, one past the last)."""
    if not len(places):
        return []
    places = np.sort(places)
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    return [(int(x[0]), int(x[-1]) + 1) for x in np.split(places, cut)]


_RANGES = "array<struct<a:int,b:int>>"


def _sorted_blocks(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, digest, ranges of repeated windows) of the different segments of each anchor."""

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "lead", "n", "data"))):
                if len(rows) >= BLOCK and row[0] != rows[-1][0]:
                    yield solved(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield solved(rows)

    def solved(rows):
        with tempfile.TemporaryDirectory() as folder:
            found = repeated_windows([r[4] for r in rows], [r[2] for r in rows], length, folder)
        out = []
        for (_, _, lead, n, _), depth in zip(rows, found):
            start = lead - depth  # window starts, counted from the segment's first window
            out.append([{"a": a, "b": b} for a, b in _ranges(start[(start >= 0) & (start < n)])])
        return pa.RecordBatch.from_pydict(
            {
                "anchor": pa.array([r[0] for r in rows], pa.int64()),
                "digest": pa.array([r[1] for r in rows], pa.int64()),
                "ranges": pa.array(out, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
            }
        )

    # The anchor heads the texts, so texts of different anchors share no window.
    dealt = texts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, f"anchor long, digest long, ranges {_RANGES}")


def _by_digest(texts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many different segments: windows are grouped by digests of 128 bits."""

    def run(batches):
        one, two = Rolling(9), Rolling(10)
        for batch in batches:
            for anchor, digest, n, data in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "n", "data"))):
                raw = np.frombuffer(data, np.uint8)
                at = np.arange(n)
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": np.full(n, anchor),
                        "digest": np.full(n, digest),
                        "at": at.astype(np.int32),
                        "h1": one.hash(one.sums(raw), at, at + length).view(np.int64),
                        "h2": two.hash(two.sums(raw), at, at + length).view(np.int64),
                    }
                )

    windows = texts.mapInArrow(run, "anchor long, digest long, at int, h1 long, h2 long")
    twice = windows.groupBy("anchor", "h1", "h2").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    found = windows.join(twice, ["anchor", "h1", "h2"]).groupBy("anchor", "digest").agg(F.sort_array(F.collect_set("at")).alias("at"))
    return found.select("anchor", "digest", F.transform("at", lambda x: F.struct(x.alias("a"), (x + 1).alias("b"))).alias("ranges"))


def repeated_spans(rows: DataFrame, length: int = LENGTH, chunk: int | None = None) -> DataFrame:
    """(row, spans) of the rows (doc_id: number of the row, text) that hold repeated strings.

    Spans are (begin, end) in bytes of the union of all repeated strings of ``length`` bytes.
    """
    found = written(occurrences(rows, length, chunk), "segments")
    anchors = found.groupBy("anchor").agg(F.count("*").alias("c"), (F.min("digest") != F.max("digest")).alias("several"))
    shared = written(found.join(anchors.where("c > 1").drop("c"), "anchor"), "shared")
    texts = shared.where("several").groupBy("anchor", "digest").agg(F.count("*").alias("c"), F.min(F.struct("row", "first", "place", "n")).alias("own"))
    texts = written(texts.select("anchor", "digest", "c", "own.*"), "texts")
    many = texts.groupBy("anchor").count().where(f"count > {MAX_SEGMENTS}").select("anchor")
    per_row = texts.groupBy(F.col("row").alias("doc_id")).agg(F.collect_list(F.struct("anchor", "digest", "first", "place", "n")).alias("own"))

    def cut(batches):
        for batch, raw in text_batches(batches):
            out = {k: [] for k in ("anchor", "digest", "lead", "n", "data")}
            for text, own in zip(raw, batch.column("own").to_pylist()):
                for s in own:
                    out["anchor"].append(s["anchor"])
                    out["digest"].append(s["digest"])
                    out["lead"].append(s["place"] - s["first"])
                    out["n"].append(s["n"])
                    # Up to the last window's end: what follows is another segment's, maybe one of the same anchor here.
                    out["data"].append(text[s["first"] : s["first"] + s["n"] + length - 1])
            kinds = {"anchor": pa.int64(), "digest": pa.int64(), "lead": pa.int32(), "n": pa.int32(), "data": pa.binary()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in out.items()})

    needed = only_documents(rows, per_row, "text").join(per_row, "doc_id")
    data = written(needed.select("text", "own").mapInArrow(cut, "anchor long, digest long, lead int, n int, data binary"), "cuts")
    solved = _sorted_blocks(data.join(many, "anchor", "left_anti"), length)
    if many.take(1):
        solved = solved.union(_by_digest(data.join(many, "anchor"), length))
    solved = solved.join(texts.select("anchor", "digest", "c"), ["anchor", "digest"], "right")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b")))
    part = shared.where("several").join(solved, ["anchor", "digest"]).select("row", "first", F.when(F.col("c") > 1, whole).otherwise(F.col("ranges")).alias("r"))
    part = part.union(shared.where("not several").select("row", "first", whole.alias("r")))
    spans = part.select("row", "first", F.explode("r").alias("r")).select("row", F.struct((F.col("first") + F.col("r.a")).alias("begin"), (F.col("first") + F.col("r.b") + (length - 1)).alias("end")).alias("s"))
    return spans.groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("spans"))


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ascending spans with those that touch joined."""
    out: list[list[int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _rows(docs: DataFrame, *columns: str) -> DataFrame:
    """The rows with a number in place of the id; equal rows have equal numbers, as they have equal repeats."""
    return docs.select(row_code().alias("_row"), "doc_id", "text", *columns)


def with_spans(docs: DataFrame, length: int = LENGTH, columns: tuple[str, ...] = (), chunk: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows that surely hold no repeat, and the others with their spans (null: none)."""
    rows = _rows(docs, *columns)
    spans = written(repeated_spans(rows.select(F.col("_row").alias("doc_id"), "text"), length, chunk), "spans")
    spans = spans.select(F.col("row").alias("_row"), F.col("spans").alias("_spans"))
    bits = id_filter(spans)
    return filtered(rows, "_row", bits, inside=False), filtered(rows, "_row", bits).join(spans, "_row", "left")


def digests(docs: DataFrame, length: int = LENGTH, chunk: int | None = None) -> DataFrame:
    """Per document: bytes, removed bytes, maximal removed runs and the digest of the remaining bytes."""

    def run(batches):
        for batch, raw in text_batches(batches):
            all_spans = batch.column("_spans").to_pylist() if "_spans" in batch.schema.names else [None] * len(raw)
            out = {"n_removed": [], "n_spans": [], "kept_sha256": []}
            for text, found in zip(raw, all_spans):
                spans, at, digest = union_of([(s["begin"], s["end"]) for s in found or []]), 0, hashlib.sha256()
                for a, b in spans:
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                out["n_removed"].append(sum(b - a for a, b in spans))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(digest.hexdigest())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array([len(x) for x in raw], pa.int64()),
                    "n_removed": pa.array(out["n_removed"], pa.int64()),
                    "n_spans": pa.array(out["n_spans"], pa.int64()),
                    "kept_sha256": pa.array(out["kept_sha256"], pa.string()),
                }
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    clean, touched = with_spans(docs, length, chunk=chunk)
    return clean.select("doc_id", "text").mapInArrow(run, schema).union(touched.select("doc_id", "text", "_spans").mapInArrow(run, schema))


def remaining_text(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; a character stays whole where a span covers only some of its bytes."""
    out, at = [], 0
    for a, b in union_of(spans):
        while a < len(text) and text[a] & 0xC0 == 0x80:
            a += 1
        while b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append(text[at:a])
            at = b
    return b"".join([*out, text[at:]]).decode()


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with all repeated strings removed from ``text``; other columns stay as they are, whatever their names."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]

    def run(batches):
        for batch, raw in text_batches(batches):
            spans = [[(s["begin"], s["end"]) for s in x or []] for x in batch.column("_spans").to_pylist()]
            old = batch.column("text").to_pylist()
            texts = [x if not s else remaining_text(r, s) for x, r, s in zip(old, raw, spans)]
            columns = {c: pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in batch.schema.names if c not in ("_row", "_spans")}
            yield pa.RecordBatch.from_pydict(columns)

    own = [f"own_{k}" for k in range(len(others))]
    named = docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in zip(others, own)])
    clean, touched = with_spans(named, length, tuple(own))
    clean = clean.drop("_row")
    back = dict(zip(others, own))
    return clean.union(touched.mapInArrow(run, clean.schema)).select(*[F.col(back.get(c, c)).alias(c) for c in docs.columns])
