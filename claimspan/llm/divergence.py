"""Source divergence audit: how far the word frequencies of each source differ from those of others in its language.

Tasks count the terms of their own documents: terms of up to 8 or 16 bytes are packed into one or two 64-bit words and
radix-sorted, longer ones go to buckets by length that are sorted as byte strings; runs are counted in numpy. The
counted runs, not the texts, are shuffled by term. A term is kept for a language if at least ``min_docs`` of its
documents hold it.

With ``n`` occurrences of a kept term in a group (a source of a language, or the whole language), ``N`` occurrences of
all V kept terms there, p = 1 + floor(10^9 (n + 1) / (N + V)); a term adds floor((p - q)^2 / q). Everything is whole
numbers, so results do not depend on the order of the work.

Pairs of sources are summed in cells: sources of a language are dealt to blocks, terms to slots, and a cell holds two
blocks and a slot. A cell adds, for each pair of its sources, what its terms differ from a pair of terms that neither
source has; V times that constant is added in the end, so absent terms are never listed.

Null text, lang and source count as ''. Texts without a term count as documents of their group; repeated rows count
as documents of their own; ``doc_id`` and other columns are not read. A language with one source has no pairs; one
without kept terms has pairs of value 0 and no term rows. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from claimspan.llm.common import text_batches, written

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
#: Bytes of text that a task counts at a time.
BUFFER = 12 << 20
#: Sources of a block, and entries (source, term) of a slot, on average.
BLOCK, SLOT = 64, 100_000
#: Numbers in one array of a cell's sums.
STEP = 1 << 21

COUNTED = "lang string, source string, term string, n long, docs long"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_TERM = np.zeros(258, np.int8)
_IN_TERM[65:91] = _IN_TERM[97:123] = _IN_TERM[128:256] = 1


# ---------------------------------------------------------------- counting inside a task


def term_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of letters A-Z, a-z and bytes beyond ASCII."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _IN_TERM[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows of 64-bit words, the first word first: passes over 16-bit digits, last digit first.

    A digit that all rows share needs no pass.
    """
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(changes: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row, rows and documents of each run of one term in one group; rows are in order of term, group, document."""
    first = changes.copy()
    first[1:] |= group[1:] != group[:-1]
    new_doc = first.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(first)
    return at, np.diff(np.append(at, len(first))), np.add.reduceat(new_doc.astype(np.int64), at)


def count_terms(texts: list[bytes], groups: list[int]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, group, occurrences, documents) of some texts, in one part for each bucket of lengths.

    The texts are taken in order of their groups, so a stable sort by term leaves each term's rows in order of group
    and document.
    """
    by_group = sorted(range(len(texts)), key=groups.__getitem__)
    raw = b"\0".join([*(texts[k] for k in by_group), bytes(8)])  # no term reaches over the zeros
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    begin, end = term_spans(data)
    if not len(begin):
        return
    text_ends = np.cumsum([len(texts[k]) + 1 for k in by_group])
    doc = np.searchsorted(text_ends, begin, "right")
    group = np.array([groups[k] for k in by_group])[doc]
    size = end - begin
    eight = np.ndarray((len(data) - 7,), ">u8", buffer=data.tobytes(), strides=(1,))

    def packed(at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The first n <= 8 bytes from each place, as the high bytes of a word."""
        shift = (np.uint64(8) * (8 - n).astype(np.uint64)).astype(np.uint64)
        return (eight[at].astype(np.uint64) >> shift) << shift

    for low, high in ((0, 8), (8, 16)):
        rows = np.flatnonzero((size > low) & (size <= high))
        if not len(rows):
            continue
        words = [packed(begin[rows], np.minimum(size[rows], 8))]
        if high == 16:
            words.append(packed(begin[rows] + 8, size[rows] - 8))
        order = radix_order(words)
        rows, words = rows[order], [w[order] for w in words]
        changes = np.zeros(len(rows), bool)
        changes[0] = True
        for w in words:
            changes[1:] |= w[1:] != w[:-1]
        at, n, docs = _runs(changes, group[rows], doc[rows])
        terms = np.stack([w[at] for w in words], 1).astype(">u8").view(f"S{high}").ravel().tolist()
        yield terms, group[rows][at], n, docs

    width = 32
    while (size > width // 2).any():
        rows = np.flatnonzero((size > width // 2) & (size <= width))
        if len(rows):
            values = _wide(data, begin[rows], size[rows], width)
            order = np.argsort(values, kind="stable")
            rows, values = rows[order], values[order]
            changes = np.ones(len(rows), bool)
            changes[1:] = values[1:] != values[:-1]
            at, n, docs = _runs(changes, group[rows], doc[rows])
            yield values[at].tolist(), group[rows][at], n, docs
        width *= 2


def _wide(data: np.ndarray, begin: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """Terms of at most ``width`` bytes as byte strings of that width."""
    out = np.zeros((len(begin), width), np.uint8)
    if width > 128:
        for k, (at, n) in enumerate(zip(begin.tolist(), size.tolist())):
            out[k, :n] = data[at : at + n]
        return out.view(f"S{width}").ravel()
    column = np.arange(width)
    for low in range(0, len(begin), 1 << 14):
        some = slice(low, low + (1 << 14))
        at = np.minimum(begin[some, None] + column, len(data) - 1)
        out[some] = np.where(column < size[some, None], data[at], 0)
    return out.view(f"S{width}").ravel()


def _chunks(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in pieces of about ``size`` bytes that end behind a term."""
    begin = 0
    while len(text) - begin > size:
        after = np.frombuffer(text, np.uint8, offset=begin + size)
        stop, step = None, 1 << 16
        for k in range(0, len(after), step):
            outside = np.flatnonzero(_IN_TERM[after[k : k + step]] == 0)
            if len(outside):
                stop = begin + size + k + int(outside[0])
                break
        if stop is None:
            break
        yield text[begin:stop]
        begin = stop
    yield text[begin:]


def _count_batches(batches: Iterator[pa.RecordBatch], buffer: int) -> Iterator[pa.RecordBatch]:
    """COUNTED rows of the documents of a task; each group also has a row whose term is a space and its source."""
    numbers: dict[tuple[str, str], int] = {}
    names: list[tuple[str, str]] = []
    texts, groups, held = [], [], 0

    def rows(parts, seen=None):
        for terms, group, n, docs in parts:
            if seen is not None:  # a further piece of one document: it holds each term once
                docs = np.array([t not in seen for t in terms], np.int64)
                seen.update(terms)
            own = [pa.array([name[k] for name in names], pa.string()).take(pa.array(group)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    for batch, bodies in text_batches(batches):
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), bodies):
            number = numbers.setdefault((lang, source), len(names))
            if number == len(names):
                names.append((lang, source))
            if len(text) > buffer:
                seen: set[bytes] = set()
                for piece in _chunks(text, buffer):
                    yield from rows(count_terms([piece], [number]), seen)
                continue
            texts.append(text)
            groups.append(number)
            held += len(text)
            if held > buffer:
                yield from rows(count_terms(texts, groups))
                texts, groups, held = [], [], 0
    if texts:
        yield from rows(count_terms(texts, groups))
    if names:
        none = np.zeros(len(names), np.int64)
        yield from rows([([b" " + source.encode() for _, source in names], np.arange(len(names)), none, none)])


# ---------------------------------------------------------------- sums of a cell


def _cell(entries: pa.Table) -> pa.Table:
    """Sums over the terms of a cell, for each pair of its sources: f(p, q) less f of the two absent terms.

    Rows without a term give the p of an absent term of each source of both blocks.
    """
    first = entries.column("block_a")[0].as_py()
    second = entries.column("block_b")[0].as_py()
    source = entries.column("source").combine_chunks().dictionary_encode()
    names = source.dictionary.to_pylist()
    source = source.indices.to_numpy()
    p, block = entries.column("p").to_numpy(), entries.column("block").to_numpy()
    header = entries.column("term").combine_chunks().is_null().to_numpy(zero_copy_only=False)
    absent, blocks = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    absent[source[header]], blocks[source[header]] = p[header], block[header]
    coded = entries.column("term").combine_chunks().filter(pa.array(~header)).dictionary_encode()
    term, n_terms = coded.indices.to_numpy(), len(coded.dictionary)
    source, p = source[~header], p[~header]
    left, right = np.flatnonzero(blocks == first), np.flatnonzero(blocks == second)
    sums = np.zeros((len(left), len(right)), np.int64)
    back = np.zeros((len(right), len(left)), np.int64)

    def f(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x - y) ** 2 // y

    order = np.argsort(term, kind="stable")
    term, source, p = term[order], source[order], p[order]
    step = max(1, STEP // max(1, len(left) * len(right)))
    for low in range(0, n_terms, step):
        high = min(low + step, n_terms)
        at = slice(*np.searchsorted(term, [low, high]))
        table = np.repeat(absent[:, None], high - low, 1)
        table[source[at], term[at] - low] = p[at]
        for k in range(len(left)):
            x = table[left[k]][None, :]
            sums[k] += f(x, table[right]).sum(1)
            if first != second:
                back[:, k] += f(table[right], x).sum(1)
    sums -= n_terms * f(absent[left][:, None], absent[right][None, :])
    out = [(names[a], names[b], int(sums[i, j])) for i, a in enumerate(left) for j, b in enumerate(right) if a != b]
    if first != second:
        back -= n_terms * f(absent[right][:, None], absent[left][None, :])
        out += [(names[b], names[a], int(back[j, i])) for i, a in enumerate(left) for j, b in enumerate(right)]
    lang = entries.column("lang")[0].as_py()
    return pa.table({
        "lang": pa.array([lang] * len(out), pa.string()), "source": pa.array([a for a, _, _ in out], pa.string()),
        "item": pa.array([b for _, b, _ in out], pa.string()), "part_value": pa.array([v for _, _, v in out], pa.int64()),
    })


# ---------------------------------------------------------------- the audit


def _share(n, total, size):
    """1 + floor(10^9 (n + 1) / (total + size)), in whole numbers of any length."""
    big = "decimal(38,0)"
    return F.expr(f"cast(1 + ({SCALE} * cast({n} + 1 as {big})) div cast({total} + {size} as {big}) as bigint)")


def _f(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, buffer: int = BUFFER, block: int = BLOCK, slot: int = SLOT) -> DataFrame:
    """lang, source, part, item, value, rank of the ``pair`` and ``term`` parts.

    ``pair``: each other source of the language with the summed f, all ranks. ``term``: the kept terms that the
    source has more often than the language, with f against the language's share, ranks to ``top``. Ranks go by value
    descending, then item by its UTF-8 bytes.
    """
    text = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    runs = text.mapInArrow(lambda batches: _count_batches(batches, buffer), COUNTED)
    # Runs are dealt by term, so that the sums over sources need no further shuffle.
    counted = runs.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    over = Window.partitionBy("lang", "term")
    is_term = ~F.startswith("term", F.lit(" "))
    entries = counted.select("*", F.sum("n").over(over).alias("lang_n"), F.sum("docs").over(over).alias("lang_docs"),
                             (is_term & (F.col("source") == F.min("source").over(over))).alias("first"))
    entries = entries.where(~is_term | (F.col("lang_docs") >= min_docs)).select("lang", "source", "term", "n", "lang_n", "first")
    entries = written(entries, "divergence-terms")
    kept = entries.where(is_term)

    groups = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("rows"), F.count_if("first").alias("firsts"))
    langs = groups.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.count("*").alias("sources"), F.sum("rows").alias("lang_rows"), F.sum("firsts").alias("size")
    )
    # One row a group; p of an absent term is 0 where nothing is kept.
    stats = groups.join(langs, "lang").withColumn("absent", F.when(F.col("size") > 0, _share("0", "total", "size")).otherwise(0))
    stats = stats.withColumn("blocks", F.ceil(F.col("sources") / block).cast("int")).withColumn("slots", F.ceil(F.col("lang_rows") / slot).cast("int"))
    stats = stats.withColumn("block", F.expr("cast(pmod(xxhash64(source), blocks) as int)"))
    stats = written(stats.select("lang", "source", "total", "lang_total", "size", "absent", "blocks", "slots", "block"), "divergence-groups")

    shares = kept.join(stats, ["lang", "source"]).withColumn("p", _share("n", "total", "size"))

    terms = shares.withColumn("q", _share("lang_n", "lang_total", "size")).where("n > 0 and p > q")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f("p", "q").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    entry_slot = F.expr("cast(pmod(xxhash64(term), slots) as int)")
    cells = shares.select("lang", "source", "term", "p", "block", "blocks", entry_slot.alias("slot"))
    heads = stats.where("size > 0").withColumn("slot", F.explode(F.expr("sequence(0, slots - 1)")))
    cells = cells.unionByName(heads.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"), "block", "blocks", "slot"))
    cells = cells.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = cells.select("lang", "source", "term", "p", "block", "slot", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"))
    sums = cells.groupBy("lang", "block_a", "block_b", "slot").applyInArrow(_cell, "lang string, source string, item string, part_value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("part_value").alias("differing"))

    one = stats.select("lang", "source", "size", F.col("absent").alias("p"))
    two = stats.select("lang", F.col("source").alias("item"), F.col("absent").alias("q"))
    pairs = one.join(two, "lang").where("source <> item").join(sums, ["lang", "source", "item"], "left")
    value = F.when(F.col("size") > 0, F.coalesce("differing", F.lit(0)) + F.col("size") * _f("p", "greatest(q, 1)")).otherwise(0)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
