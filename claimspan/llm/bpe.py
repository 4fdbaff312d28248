"""Byte-level BPE encoding and decoding in DuckDB, inside the tasks of a Spark job.

Encoding: a recursive query holds one row per token of a word and its position. Each step joins
neighbouring tokens with the merge table, takes each word's leftmost pair of least rank and contracts it,
until no word has a pair left. Distinct words are encoded once per worker. Decoding: token rows are joined
with the vocabulary and their bytes concatenated by an ordered aggregation. No shuffle; a task holds a
batch of documents and a bounded table of words.

Edge cases: a null or empty text has no tokens; bytes, ids and digests are then those of nothing. A word
that is itself a token is that token. Words of more than LONG_WORD bytes would need as many steps as they
have bytes, each over the whole word; they are merged in the same order by a heap. Repeated rows and null
ids are coded one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimspan.llm.common import text_batches
from claimspan.llm.pieces import ChunkTable, compiled

LONG_WORD = 256
#: Words in one recursive query, and tokens in one decoding query, at most (but for a single document).
WORDS, TOKENS = 20_000, 400_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: Squared bytes of the words in one recursive query: its rounds hold at most half as many rows.
WORK = 8_000_000

#: The leftmost pair of least rank of each word of a table, packed as rank, place and place of the second token.
_BEST = """
    SELECT p.word, min((m.made::bigint << 40) | (p.pos::bigint << 20) | p.after) AS best
    FROM (SELECT word, pos, tok, lead(tok) OVER w AS next_tok, lead(pos) OVER w AS after
          FROM {0} WINDOW w AS (PARTITION BY word ORDER BY pos)) p
    JOIN merges m ON p.tok = m.a AND p.next_tok = m.b GROUP BY p.word
"""
# A round carries on the words that still have a pair; a word without one is given out in that round.
_ENCODE = f"""
WITH RECURSIVE step AS (
    SELECT s.word, s.pos, s.tok, b.best FROM start s LEFT JOIN ({_BEST.format("start")}) b USING (word)
    UNION ALL
    (WITH now AS MATERIALIZED (
        SELECT word, pos, CASE WHEN pos = (best >> 20) & 1048575 THEN (best >> 40)::int ELSE tok END AS tok
        FROM step WHERE best IS NOT NULL AND pos <> best & 1048575)
    SELECT s.word, s.pos, s.tok, b.best FROM now s LEFT JOIN ({_BEST.format("now")}) b USING (word))
)
SELECT word, tok FROM step WHERE best IS NULL ORDER BY word, pos
"""

_DECODE = """
SELECT t.doc, string_agg(v.piece, '' ORDER BY t.pos) AS text FROM tokens t JOIN vocabulary v USING (id) GROUP BY t.doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Coder:
    """One worker's DuckDB connection with the merge table and vocabulary of a rank file."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.findall = compiled(pattern).findall
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        pairs = [
            (self.ranks[t[:k]], self.ranks[t[k:]], r)
            for t, r in self.ranks.items()
            for k in range(1, len(t))
            if t[:k] in self.ranks and t[k:] in self.ranks
        ]
        merges = pa.table({n: pa.array(c, pa.int32()) for n, c in zip(("a", "b", "made"), zip(*pairs))})
        # Each byte stands as the character 256 places on, so no byte is special in a string.
        vocabulary = pa.table(
            {
                "id": pa.array(self.ranks.values(), pa.int32()),
                "piece": pa.array(["".join(chr(256 + b) for b in t) for t in self.ranks], pa.string()),
            }
        )
        self._keep("merges", merges)
        self._keep("vocabulary", vocabulary)
        self.table = ChunkTable(self._chunks)

    def _keep(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, by way of the distinct words that the pattern finds in them."""
        number: dict[str, int] = {}
        found = [[number.setdefault(w, len(number)) for w in self.findall(c.decode())] for c in chunks]
        ids = self.words([w.encode() for w in number])
        coded = [[i for w in words for i in ids[w]] for words in found]
        return np.array([i for c in coded for i in c], np.uint32), np.fromiter(map(len, coded), np.int64, len(coded))

    def words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        out: list = [None] * len(words)
        todo = []
        for k, w in enumerate(words):
            if w in self.ranks:
                out[k] = [self.ranks[w]]
            elif len(w) > LONG_WORD:
                out[k] = self._long(w)
            else:
                todo.append(k)
        todo.sort(key=lambda k: len(words[k]))  # words of one query take about as many rounds
        sizes = np.array([len(words[k]) for k in todo], np.int64)
        query = np.maximum(np.cumsum(sizes**2) // WORK, np.arange(len(todo)) // WORDS)
        bounds = [0, *(np.flatnonzero(np.diff(query)) + 1).tolist(), len(todo)]
        for part in (todo[a:b] for a, b in zip(bounds, bounds[1:]) if a < b):
            lengths = np.array([len(words[k]) for k in part])
            first = np.cumsum(lengths) - lengths
            start = pa.table(
                {
                    "word": np.repeat(np.arange(len(part), dtype=np.int32), lengths),
                    "pos": (np.arange(lengths.sum()) - np.repeat(first, lengths)).astype(np.int32),
                    "tok": self.byte[np.frombuffer(b"".join(words[k] for k in part), np.uint8)],
                }
            )
            self.db.register("start", start)
            done = self.db.execute(_ENCODE).fetchnumpy()
            self.db.unregister("start")
            ends, ids = np.searchsorted(done["word"], np.arange(len(part)), "right").tolist(), done["tok"].tolist()
            for k, a, b in zip(part, [0, *ends], ends):
                out[k] = ids[a:b]
        return out

    def _long(self, word: bytes) -> list[int]:
        """The same merges in the same order, from a heap of (rank, place); for words of very many bytes."""
        part = [word[k : k + 1] for k in range(len(word))]
        before, after = list(range(-1, len(word) - 1)), list(range(1, len(word) + 1))
        heap: list[tuple[int, int, bytes]] = []

        def push(k: int) -> None:
            if 0 <= k and after[k] < len(part):
                pair = part[k] + part[after[k]]
                if pair in self.ranks:
                    heapq.heappush(heap, (self.ranks[pair], k, pair))

        for k in range(len(word)):
            push(k)
        while heap:
            _, k, pair = heapq.heappop(heap)
            if not part[k] or after[k] >= len(part) or part[k] + part[after[k]] != pair:
                continue
            gone = after[k]
            part[k], part[gone], after[k] = pair, b"", after[gone]
            if after[k] < len(part):
                before[after[k]] = k
            push(before[k])
            push(k)
        return [self.ranks[p] for p in part if p]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        out = [b""] * len(ids)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        groups = np.cumsum(lengths) // TOKENS
        for g in np.unique(groups):
            part = np.flatnonzero(groups == g)
            n = lengths[part]
            if not n.sum():
                continue
            tokens = pa.table(
                {
                    "doc": np.repeat(part.astype(np.int32), n),
                    "pos": np.arange(n.sum(), dtype=np.int64),
                    "id": np.concatenate([ids[k] for k in part]).astype(np.int32),
                }
            )
            self.db.register("tokens", tokens)
            rows = self.db.execute(_DECODE).fetchall()
            self.db.unregister("tokens")
            for doc, text in rows:
                out[doc] = (np.frombuffer(text.encode("utf-16-le"), "<u2") - 256).astype(np.uint8).tobytes()
        return out


_coders: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    """The worker's coder for a rank file."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = Coder(path, pattern)
    return _coders[path, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of each document."""

    def run(batches):
        for batch, texts in text_batches(batches):
            ids = coder(ranks, pattern).table.batch(texts)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "ids": pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))}
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and data (the bytes) of each list of ids; a null list has none."""

    def run(batches):
        for batch in batches:
            ids = [np.array(i if i is not None else [], np.int32) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "data": pa.array(coder(ranks, pattern).decode(ids), pa.binary())}
            )

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Number of tokens, and digests of the ids and of what they decode to, of each document.

    Both directions run in one task, so the ids do not travel.
    """

    def run(batches):
        for batch, texts in text_batches(batches):
            own = coder(ranks, pattern)
            ids = own.table.batch(texts)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                    "ids_sha256": [hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids],
                    "decoded_sha256": [hashlib.sha256(b).hexdigest() for b in own.decode(ids)],
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
