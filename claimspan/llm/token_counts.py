"""Token counts of whole texts: batches of about equal bytes go to the tokenizer library, only lengths come back.

A text is cut in front of white space that follows a printable ASCII character. No match of the tokenizers' patterns
reaches over such a place from the left, so the tokens of the pieces are those of the text (``Counter`` says which
tokenizers are cut where). The cuts serve twice: a text longer than a batch is split at one, and inside a batch the
distinct pieces are encoded once, by the library itself, and their lengths summed per text.

Null text counts as empty; empty texts have no tokens. A text without a safe place is encoded as it is, whatever its
length. Rows are counted one by one: repeated rows and rows without an id are returned like all others, and columns
other than ``doc_id`` and ``text`` are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimspan.llm.common import text_batches

LIMIT = 512
#: Bytes that go through one round of cutting and encoding.
BATCH = 4 << 20
#: Pieces up to this size are remembered with their lengths; at most so many, then a worker starts anew.
SHORT, REMEMBERED = 48, 1_000_000

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

_PRINTABLE = np.zeros(256, bool)
_PRINTABLE[0x21:0x7F] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True

_counters: dict[str, "Counter"] = {}


def _json_lengths(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """The library's lengths for a ``.json`` file, and whether its texts may be cut in front of white space."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task a core already
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    steps = str(tokenizer.pre_tokenizer)
    known = "ByteLevel" in steps and "add_prefix_space=False" in steps and all(
        not (t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content))
        for t in tokenizer.get_added_tokens_decoder().values()
    )
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], known


def _model_lengths(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """The library's lengths for a ``.model`` file, and whether its texts may be cut at a space, which then goes:
    each piece gets the mark of a leading space from the model, and no token has that mark inside."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    inner = any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size()))
    joined = all(model.encode(f"{a} {b}") == model.encode(a) + model.encode(b) for a, b in (("ab", "cd"), ("x.", "1)"), ("<s>", "Q")))
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], joined and not inner


class Counter:
    """Lengths of texts under one tokenizer file, in one worker.

    ``.json`` files with a byte-level pattern are cut in front of a space or line break after a printable ASCII
    character; ``.model`` files at a single space between two printable ASCII characters, without that space. All
    others are encoded whole.
    """

    def __init__(self, path: str, batch: int = BATCH):
        self.drop = path.endswith(".model")
        self.lengths, self.cuttable = (_model_lengths if self.drop else _json_lengths)(path)
        self.batch, self.known = batch, {}
        self.place = re.compile(rb"[\x21-\x7e] (?=[\x21-\x7e])" if self.drop else rb"[\x21-\x7e](?=[ \n])")

    def split(self, text: bytes) -> Iterator[bytes]:
        """A long text in pieces of about a batch, cut at safe places."""
        begin = 0
        while self.cuttable and len(text) - begin > self.batch:
            found = self.place.search(text, begin + self.batch)
            if not found:
                break
            yield text[begin : found.start() + 1]
            begin = found.end()
        yield text[begin:]

    def rounds(self, texts: list[bytes]) -> Iterator[tuple[list[bytes], list[int]]]:
        """Pieces of texts with the numbers of their texts, about a batch of bytes each time."""
        pieces, numbers, size = [], [], 0
        for k, text in enumerate(texts):
            for piece in self.split(text):
                if size and size + len(piece) > self.batch:
                    yield pieces, numbers
                    pieces, numbers, size = [], [], 0
                pieces.append(piece)
                numbers.append(k)
                size += len(piece)
        if pieces:
            yield pieces, numbers

    def _distinct(self, chunks: list[bytes]) -> np.ndarray:
        """The length of each of some distinct chunks; short ones are looked up first."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        get = self.known.get
        out = [get(c) for c in chunks]
        new = [k for k, n in enumerate(out) if n is None]
        if new:
            for k, n in zip(new, self.lengths([chunks[k].decode() for k in new])):
                out[k] = n
                if len(chunks[k]) <= SHORT:
                    self.known[chunks[k]] = n
        return np.array(out, np.int64)

    def _count(self, pieces: list[bytes]) -> np.ndarray:
        if not self.cuttable:
            return np.array(self.lengths([p.decode() for p in pieces]), np.int64)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out, full = np.zeros(len(pieces), np.int64), sizes > 0
        if not full.any():
            return out
        raw = b"".join(pieces)
        data = np.frombuffer(raw, np.uint8)
        starts = (np.cumsum(sizes) - sizes)[full]
        cut = np.zeros(len(data), bool)
        cut[1:] = _PRINTABLE[data[:-1]] & _BLANK[data[1:]]
        if self.drop:
            cut &= data == 0x20
            cut[:-1] &= _PRINTABLE[data[1:]]
            cut[np.append(starts[1:], len(data)) - 1] = False  # a space that ends its piece stays
        cut[starts] = False
        first = np.zeros(len(data), bool)
        first[starts] = True
        at = np.flatnonzero(cut | first)
        # Chunks and the dropped spaces between them alternate in one array over the joined bytes; every other
        # value is a chunk.
        bounds = np.empty(2 * len(at), np.int32)
        bounds[0::2] = at + (cut[at] if self.drop else 0)
        bounds[1::2] = np.append(at[1:], len(data))
        both = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
        coded = both.take(pa.array(np.arange(0, len(bounds) - 1, 2))).dictionary_encode()
        counts = self._distinct(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        out[full] = np.add.reduceat(counts, np.flatnonzero(first[at]))
        return out

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        for pieces, numbers in self.rounds(texts):
            np.add.at(total, numbers, self._count(pieces))
        return total


def counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: UTF-8 bytes, tokens under the file at ``path``, and whether these are more than ``limit``.

    Special strings in a text are read as the library does by default. No shuffle; one worker holds a batch of rows
    and about BATCH bytes of pieces at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path)
        for batch, texts in text_batches(batches):
            n = _counters[path](texts)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sizes), pa.array(n), pa.array(n > limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
