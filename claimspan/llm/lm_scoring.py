"""Masked pseudo-likelihood: a bidirectional window network predicts every word from the words on both sides.

The network is trained with numpy on all words of the corpus. Every task starts from the same weights, trains
on its own documents and gives its weights and number of words; the weights are averaged block by block in a
shuffle, so what is gathered grows with the input and the result, the weights, has a fixed size. A document's
score is the sum of the conditional log-probabilities of its words.

The network tells the ``KNOWN`` most frequent words of the corpus, counted over all documents, and ``BUCKETS`` hash
buckets of the others apart; the probability of those is that of their class times that in the class, classes being
runs of similar frequency. A word in a bucket has the bucket's probability times its own share of the bucket's words,
count / (words of the bucket + 1), the rest being left to unseen words. The counts of all words are a table that is
joined to the documents' words, so the vocabulary is that of the corpus.

Edge cases: a null or empty text has no words, a log-likelihood of 0 and no mean; a null doc_id is scored like
any other; repeated rows are scored (and trained on) one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimspan.llm.common import _LOWER, Rolling, by_size, mix, text_batches, word_spans, written

CLASSES, CLASS_SIZE = 32, 32
SIZE = CLASSES * CLASS_SIZE
BUCKETS = 64
KNOWN = SIZE - BUCKETS
#: Places of the window, relative to the word that is left out.
WINDOW = (-2, -1, 1, 2)
HIDDEN = 16
ROUNDS, RATE, STEP = 1, 0.08, 16_384
#: Weights per row that travels, and bytes of text that are worked on at a time.
BLOCK, BYTES = 4096, 2 << 20

def word_hashes(texts: list[bytes], rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the number of words of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = _LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    begin, end = word_spans(data)
    starts = np.cumsum(lengths + 1) - lengths - 1
    counts = np.diff(np.append(np.searchsorted(begin, starts), len(begin)))
    return rolling.hash(rolling.sums(data), begin, end), counts


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, n): the hash and the number of occurrences of each word of the corpus."""

    def run(batches):
        rolling, sums = Rolling(), {}
        for _, texts in text_batches(batches):
            for a, b in by_size(texts, BYTES):
                for h, n in zip(*(x.tolist() for x in np.unique(word_hashes(texts[a:b], rolling)[0], return_counts=True))):
                    sums[h] = sums.get(h, 0) + n
            if len(sums) > 400_000:
                yield counted(sums)
                sums = {}
        yield counted(sums)

    def counted(sums):
        return pa.RecordBatch.from_pydict(
            {"h": np.array(list(sums), np.uint64).view(np.int64), "n": np.array(list(sums.values()), np.int64)}
        )

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def known_words(docs: DataFrame, known: int = KNOWN, counts: DataFrame | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the most frequent words, their counts, and the number of all words."""
    counts = word_counts(docs) if counts is None else counts
    # One row that carries the total comes with the KNOWN most frequent ones.
    rows = counts.orderBy(F.desc("n"), "h").limit(known).collect()
    total = counts.agg(F.sum("n")).first()[0] or 0
    return np.array([r.h for r in rows], np.int64).view(np.uint64), np.array([r.n for r in rows], np.int64), total


@dataclass
class Vocabulary:
    """Word hash -> number: known words by descending frequency, then the buckets; SIZE stands for no word."""

    hashes: np.ndarray

    def __post_init__(self):
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        other = KNOWN + (mix(h) % np.uint64(BUCKETS)).astype(np.int64)
        if not len(self.sorted):
            return other
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[at] == h, self.order[at], other)


class Network:
    """All weights in one vector; the attributes are views of its parts."""

    SHAPES = {
        "inputs": (len(WINDOW), SIZE + 1, HIDDEN),
        "bias": (HIDDEN,),
        "classes": (HIDDEN, CLASSES),
        "class_bias": (CLASSES,),
        "words": (CLASSES, HIDDEN, CLASS_SIZE),
        "word_bias": (CLASSES, CLASS_SIZE),
    }

    def __init__(self, weights: np.ndarray):
        self.weights, at = weights, 0
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, weights[at : at + n].reshape(shape))
            at += n

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.SHAPES.values())

    @classmethod
    def fresh(cls, counts: np.ndarray, total: int) -> Network:
        """Small random weights; the output biases give the words' frequencies."""
        net = cls((np.random.default_rng(5).standard_normal(cls.size()) * 0.1).astype(np.float32))
        n = np.ones(SIZE)
        n[: len(counts)] += counts
        n[KNOWN:] += max(0, total - int(counts.sum())) / BUCKETS
        n = n.reshape(CLASSES, CLASS_SIZE)
        net.class_bias[:] = np.log(n.sum(axis=1) / n.sum())
        net.word_bias[:] = np.log(n / n.sum(axis=1, keepdims=True))
        return net

    def hidden(self, contexts: np.ndarray) -> np.ndarray:
        total = self.bias + self.inputs[0][contexts[0]]
        for k in range(1, len(WINDOW)):
            total += self.inputs[k][contexts[k]]
        return np.tanh(total, out=total)

    def forward(self, contexts: np.ndarray, targets: np.ndarray, gradient: Network | None = None) -> np.ndarray:
        """Log-probability of each target; ``gradient`` gets the mean gradient of the loss added."""
        of_class, in_class = targets // CLASS_SIZE, targets % CLASS_SIZE
        h = self.hidden(contexts)
        rows = np.arange(len(targets))
        p = _softmax(h @ self.classes + self.class_bias)
        out = np.log(p[rows, of_class])
        order = np.argsort(of_class.astype(np.int8), kind="stable")
        bounds = np.searchsorted(of_class[order], np.arange(CLASSES + 1))
        if gradient is not None:
            p[rows, of_class] -= 1
            p /= len(targets)
            gradient.classes += h.T @ p
            gradient.class_bias += p.sum(axis=0)
            back = p @ self.classes.T
        for c in range(CLASSES):
            at = order[bounds[c] : bounds[c + 1]]
            if not len(at):
                continue
            q, hc, k = _softmax(h[at] @ self.words[c] + self.word_bias[c]), h[at], np.arange(len(at))
            out[at] += np.log(q[k, in_class[at]])
            if gradient is not None:
                q[k, in_class[at]] -= 1
                q /= len(targets)
                gradient.words[c] += hc.T @ q
                gradient.word_bias[c] += q.sum(axis=0)
                back[at] += q @ self.words[c].T
        if gradient is not None:
            back *= 1 - h * h
            gradient.bias += back.sum(axis=0)
            for k in range(len(WINDOW)):
                around = contexts[k].astype(np.int16)
                order = np.argsort(around, kind="stable")
                around = around[order]
                first = np.flatnonzero(np.append(True, around[1:] != around[:-1]))
                gradient.inputs[k][around[first]] += np.add.reduceat(back[order], first, axis=0)
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return np.maximum(x, 1e-30, out=x)


def windows(numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The words around each word, one row per place of the window; a place beyond the document holds SIZE."""
    reach = max(WINDOW)
    places = np.arange(len(numbers)) + reach * (1 + np.repeat(np.arange(len(counts)), counts))
    padded = np.full(len(numbers) + reach * (len(counts) + 1), SIZE, np.int64)
    padded[places] = numbers
    return np.stack([padded[places + k] for k in WINDOW])


def train(docs: DataFrame, vocabulary: Vocabulary, net: Network) -> Network:
    """One round: each task trains on its documents from ``net``; the mean of their weights, by words."""

    def run(batches):
        own, rolling, rng = Network(net.weights.copy()), Rolling(), np.random.default_rng(9)
        squares, seen = np.full(Network.size(), 1e-4, np.float32), 0
        for _, texts in text_batches(batches):
            for a, b in by_size(texts, BYTES):
                h, counts = word_hashes(texts[a:b], rolling)
                numbers = vocabulary.numbers(h)
                around, order = windows(numbers, counts), rng.permutation(len(numbers))
                for at in range(0, len(order), STEP):
                    part = order[at : at + STEP]
                    gradient = Network(np.zeros(Network.size(), np.float32))
                    own.forward(around[:, part], numbers[part], gradient)
                    g = gradient.weights
                    squares += g * g
                    own.weights -= RATE * g / np.sqrt(squares)
                seen += len(numbers)
        if seen:
            for k in range(0, Network.size(), BLOCK):
                yield _row(k // BLOCK, seen, own.weights[k : k + BLOCK].astype(np.float64) * seen)

    def added(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            for k, n, w in zip(*(batch.column(c).to_pylist() for c in range(3))):
                old = sums.setdefault(k, [0, 0.0])
                old[0] += n
                old[1] = old[1] + np.frombuffer(w)
        for k, (n, w) in sums.items():
            yield _row(k, n, w)

    def _row(block, n, w):
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "n": pa.array([n], pa.int64()), "w": pa.array([w.tobytes()], pa.binary())})

    schema = "block int, n long, w binary"
    made = Network(net.weights.copy())
    sums = docs.select("text").mapInArrow(run, schema).repartition(-(-Network.size() // BLOCK), "block").mapInArrow(added, schema)
    for r in sums.collect():  # as many bytes as the network has, whatever the corpus
        made.weights[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.w) / r.n
    return made


def fit(docs: DataFrame, rounds: int = ROUNDS, counts: DataFrame | None = None) -> tuple[Vocabulary, Network]:
    hashes, n, total = known_words(docs, counts=counts)
    vocabulary, net = Vocabulary(hashes), Network.fresh(n, total)
    for _ in range(rounds):
        net = train(docs, vocabulary, net)
    return vocabulary, net


def shares(counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(h, share): the log-probability of each word outside the known ones, given its bucket."""

    def buckets(batches):
        for batch in batches:
            h, n = (batch.column(c).to_numpy() for c in ("h", "n"))
            number = vocabulary.numbers(h.view(np.uint64))
            other = number >= KNOWN
            yield pa.RecordBatch.from_pydict({"h": h[other], "n": n[other], "bucket": (number[other] - KNOWN).astype(np.int32)})

    found = counts.select("h", "n").mapInArrow(buckets, "h long, n long, bucket int")
    sums = {r.bucket: r.n for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # BUCKETS rows at most
    totals = F.array(*[F.lit(float(sums.get(k, 0) + 1)) for k in range(BUCKETS)])
    return found.select("h", F.log(F.col("n") / F.get(totals, F.col("bucket"))).alias("share"))


def log_probs(texts: list[bytes], vocabulary: Vocabulary, net: Network, rolling: Rolling) -> tuple[np.ndarray, ...]:
    """Sum of the conditional log-probabilities of the words' numbers, and number of words, of each text; then the
    words outside the known ones: numbers of different ones by text, their hashes and how often each occurs there."""
    h, counts = word_hashes(texts, rolling)
    numbers = vocabulary.numbers(h)
    around = windows(numbers, counts)
    parts = [net.forward(around[:, at : at + STEP], numbers[at : at + STEP]) for at in range(0, len(numbers), STEP)]
    sums = np.concatenate([[0.0], np.cumsum(np.concatenate([np.empty(0, np.float32), *parts]), dtype=np.float64)])
    ends = np.cumsum(counts)
    other = numbers >= KNOWN
    which, words = np.repeat(np.arange(len(texts)), counts)[other], h[other]
    order = np.lexsort((words, which))
    which, words = which[order], words[order]
    first = np.flatnonzero(np.append(np.ones(min(1, len(words)), bool), (which[1:] != which[:-1]) | (words[1:] != words[:-1])))
    times = np.diff(np.append(first, len(words)))
    return sums[ends] - sums[ends - counts], counts, np.bincount(which[first], minlength=len(texts)), words[first].view(np.int64), times


def score(docs: DataFrame, vocabulary: Vocabulary, net: Network, own: DataFrame | None = None) -> DataFrame:
    """The scores by the words' numbers; with ``own``, the ``shares`` of the same corpus, by the words themselves."""

    with_words = own is not None  # the workers cannot have the frame itself

    def run(batches):
        rolling = Rolling()
        for batch, texts in text_batches(batches):
            found = [log_probs(texts[a:b], vocabulary, net, rolling) for a, b in by_size(texts, BYTES)]
            join = lambda k, kind: np.concatenate([np.empty(0, kind), *(x[k] for x in found)])  # noqa: E731, B023
            columns = {"doc_id": batch.column("doc_id"), "n_words": join(1, np.int64), "log_likelihood": join(0, np.float64)}
            if with_words:
                offsets = np.append(0, np.cumsum(join(2, np.int64))).astype(np.int32)
                columns["words"] = pa.ListArray.from_arrays(offsets, pa.array(join(3, np.int64)))
                columns["times"] = pa.ListArray.from_arrays(offsets, pa.array(join(4, np.int64).astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_words long, log_likelihood double" + (", words array<long>, times array<int>" if with_words else "")
    made = docs.select("doc_id", "text").mapInArrow(run, schema)
    if with_words:
        # Numbered in the files, so that both uses see the same numbers.
        rows = written(made.withColumn("row", F.monotonically_increasing_id()), "classes")
        each = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("h"), "x.times")
        more = each.join(own, "h").groupBy("row").agg(F.sum(F.col("times") * F.col("share")).alias("more"))
        made = rows.drop("words", "times").join(more, "row", "left")
        made = made.withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce("more", F.lit(0.0)))
    made = made.select("doc_id", "n_words", F.round("log_likelihood", 4).alias("log_likelihood"))
    mean = F.when(F.col("n_words") > 0, F.round(F.col("log_likelihood") / F.col("n_words"), 6))
    return made.withColumn("mean_log_prob", mean)


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    counts = written(word_counts(docs), "counts")
    vocabulary, net = fit(docs, counts=counts)
    return score(docs, vocabulary, net, shares(counts, vocabulary))
