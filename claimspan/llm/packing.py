"""Packing of tokenized documents into sequences of a fixed length.

Documents keep their order; a sequence is a window of the token stream of one partition. Where to cut
is a dynamic program over the ends of documents and sentences, and over a grid inside sentences: a
sequence costs its padding plus a penalty for the boundary it is cut at. The least cost of reaching a
cut is a sliding-window minimum, kept in a monotone queue. The stream is cut in blocks of whole
documents; the rest of a block goes into sequences whose lengths are powers of two, which need no
padding, or is padded, whichever costs less. Each partition is packed on its own, without a shuffle.

Edge cases: a null or empty text is a document of the end token alone; repeated rows are packed one by
one; a null doc_id is carried along; an empty table gives no pieces.
"""

from __future__ import annotations

from collections import deque
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from claimspan.llm.common import text_batches
from claimspan.llm.pieces import ChunkTable

LENGTH = 2048
END_TOKEN = 1
#: Cost of a cut, in padding tokens: at the end of a document or sentence, and inside a sentence.
SENTENCE_PENALTY, INSIDE_PENALTY = 2, 24
#: Cuts inside sentences are tried at multiples of this.
GRID = 64
#: Tokens after which a block of whole documents is packed.
BLOCK = 1 << 20

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_tables: dict[str, tuple[ChunkTable, np.ndarray]] = {}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """The tokens of a byte-level BPE file by their bytes, if each merge makes the token of the next id.

    Ids are then the ranks of the merges, and a rank encoder gives the ids that the file defines.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if [model["vocab"].get(m) for m in merges] != list(range(256, 256 + len(merges))):
        return None
    return {bytes(byte[c] for c in token): k for token, k in model["vocab"].items() if k < 256 + len(merges)}


def single_encoder(one):
    def encode(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        coded = [one(c.decode()) for c in chunks]
        return np.array([i for ids in coded for i in ids], np.uint32), np.fromiter(map(len, coded), np.int64, len(coded))

    return encode


def joined_encoder(one, ranks: dict[bytes, int]):
    """Encodes many chunks as one text and parts the ids by the lengths of their tokens.

    Only chunks that begin with a space or line break and end with another character may be joined.
    """
    token_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, k in ranks.items():
        token_bytes[k] = len(token)
    single = single_encoder(one)

    def encode(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(chunks) < 3 or not all(c[0] in b" \n" and c[-1] > 32 for c in chunks):
            joined = [k for k, c in enumerate(chunks) if c[0] in b" \n" and c[-1] > 32]
            if len(joined) < 3:
                return single(chunks)
            rest = sorted(set(range(len(chunks))) - set(joined))
            parts: list = [None] * len(chunks)
            for places in (joined, rest):
                ids, n = (encode if places is joined else single)([chunks[k] for k in places])
                for k, part in zip(places, np.split(ids, np.cumsum(n)[:-1])):
                    parts[k] = part
            return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        ids = np.array(one(b"".join(chunks).decode()), np.uint32)
        ends = np.searchsorted(np.cumsum(token_bytes[ids]), np.cumsum([len(c) for c in chunks])) + 1
        return ids, np.diff(ends, prepend=0)

    return encode


def chunk_table(path: str) -> tuple[ChunkTable, np.ndarray]:
    """The worker's encoder for the tokenizer file at ``path``, and which ids end a sentence.

    Special tokens in a text are ordinary text.
    """
    if path not in _tables:
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        ranks = ranks_of(path)
        if ranks:
            import tiktoken

            coder = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            encode = joined_encoder(coder.encode_ordinary, ranks)
        else:
            encode = single_encoder(lambda text: tokenizer.encode(text, add_special_tokens=False).ids)

        ends = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, k in tokenizer.get_vocab().items():
            ends[k] = token[-1] in ".!?\u010a"
        _tables[path] = ChunkTable(encode), ends
    return _tables[path]


def cuts(total: int, document_ends: np.ndarray, sentence_ends: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Ascending ends of the sequences over a stream of ``total`` tokens, at least cost.

    With g[i] = cost(i) + place(i), a cut at place c costs min(g[i] : c - length <= place(i) < c) + length - c
    + penalty(c); the queue holds the i of that window with ascending g.
    """
    if not total:
        return np.empty(0, np.int64)
    kind = np.full(total + 1, -1, np.int16)
    kind[GRID:total:GRID] = INSIDE_PENALTY
    kind[sentence_ends] = SENTENCE_PENALTY
    kind[document_ends] = 0
    kind[0] = kind[total] = 0
    places = np.flatnonzero(kind >= 0)
    penalty, place = kind[places].tolist(), places.tolist()
    last = len(place) - 1
    g, came = [0] * len(place), [0] * len(place)
    queue = deque([0])
    for j in range(1, last):
        low = place[j] - length
        while place[queue[0]] < low:
            queue.popleft()
        came[j] = queue[0]
        g[j] = value = g[queue[0]] + length + penalty[j]
        while queue and g[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    best = None
    for i in range(last - 1, -1, -1):  # the end of the block: pad, or cut what is left into powers of two
        rest = total - place[i]
        if rest > length:
            break
        split = INSIDE_PENALTY * (rest.bit_count() - 1)
        cost = g[i] - place[i] + min(length - rest, split)
        if best is None or cost < best[0]:
            best = cost, i, split < length - rest
    out, (_, i, split) = [total], best
    if split:
        rest = total - place[i]
        while rest & (rest - 1):
            out.append(out[-1] - (rest & -rest))
            rest &= rest - 1
    while i:
        out.append(place[i])
        i = came[i]
    return np.array(out[::-1], np.int64)


def pieces(document_tokens: list[int], ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stream position, length, document and sequence number, start in the document, offset in the sequence of each piece."""
    document_ends = np.cumsum(document_tokens)
    bounds = np.union1d(document_ends, ends)
    begin = np.concatenate([[0], bounds[:-1]]).astype(np.int64)
    document = np.searchsorted(document_ends, begin, "right")
    sequence = np.searchsorted(ends, begin, "right")
    return (
        begin,
        bounds - begin,
        document,
        sequence,
        begin - (document_ends - document_tokens)[document],
        begin - np.concatenate([[0], ends])[sequence],
    )


def _block(doc_ids: list, tokens: list[np.ndarray], sentences: list[np.ndarray], first: int) -> tuple[pa.RecordBatch, int]:
    lengths = [len(t) for t in tokens]
    ids, document_ends = np.concatenate(tokens), np.cumsum(lengths)
    shifted = [s + e - n for s, e, n in zip(sentences, document_ends, lengths)]
    ends = cuts(len(ids), document_ends, np.concatenate(shifted).astype(np.int64))
    begin, length, document, sequence, start, offset = pieces(lengths, ends)
    stream = memoryview(ids.astype("<u4").tobytes())
    crc = [zlib.crc32(stream[4 * b : 4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist())]
    columns = {
        "doc_id": pa.array(doc_ids, pa.int64()).take(pa.array(document)),
        "start": start,
        "length": length,
        "ids_crc32": np.array(crc, np.int64),
        "doc_tokens": np.array(lengths, np.int64)[document],
        "sequence_id": sequence + first,
        "offset": offset,
    }
    return pa.RecordBatch.from_pydict(columns), first + len(ends)


def pack(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) in sequences of at most LENGTH tokens, by the tokenizer file at ``tokenizer``.

    ``sequence_id`` holds the partition in its upper 31 bits. A sequence lies in one partition.
    """

    def run(batches):
        table, ends_sentence = chunk_table(tokenizer)
        number = TaskContext.get().partitionId() << 33
        doc_ids, tokens, sentences, total = [], [], [], 0
        for batch, texts in text_batches(batches):
            coded = table.batch(texts)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coded):
                doc_ids.append(doc_id)
                tokens.append(np.append(ids, np.uint32(END_TOKEN)))
                sentences.append(np.flatnonzero(ends_sentence[ids]) + 1)
                total += len(ids) + 1
                if total >= BLOCK:
                    out, number = _block(doc_ids, tokens, sentences, number)
                    yield out
                    doc_ids, tokens, sentences, total = [], [], [], 0
        if doc_ids:
            yield _block(doc_ids, tokens, sentences, number)[0]

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
