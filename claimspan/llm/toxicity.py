"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, negation, reported speech, clause end, other). Small
transducers read the symbols one after the other and rewrite them: negation marks an insult or threat
that it covers, reported speech one that is quoted, target one that is aimed at somebody. Their
composition is one deterministic machine; it leaves one label per matched clause. A document's score is
the logistic of its weighted label counts.

Words and stems of the insult class are learned from labelled rows, on top of the seed lists; so are the
weights, drawn towards fixed prior weights. At most LABEL_BOUND labelled rows are used, those with the
least hash of their id, and never a held-out row. Scoring reads every text once, without a shuffle.

Edge cases: a null or empty text has no clause and gets the score of the bias; a null doc_id is scored
and counts as not held out; repeated rows are scored one by one; without labels the prior weights stand;
an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from itertools import product
import math
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LABEL_BOUND = 20_000
PREDICT_FROM = 0.7
#: A word or stem is an insult if so many toxic rows hold it, and this share of all rows that hold it is toxic.
MIN_TOXIC, MIN_SHARE, MAX_ENTRIES = 5, 0.97, 2000
STEM_SHARE = 0.01
#: Lengths of the word beginnings that may be stems.
STEMS = (4, 5, 6)

# The seed lists and prior weights of the grammar.
INSULTS = "idiot moron stupid loser scum trash pathetic worthless disgusting clown imbecile dumb".split()
THREATS = "kill hurt destroy smash beat strangle stab shoot murder burn".split()
TARGETS = "you your yours u he she they them him her his their these those people everyone".split()
NEGATIONS = "not no never isn aren wasn weren don doesn didn neither nor without hardly".split()
REPORTED = "said says wrote writes claimed claims quoted quotes reported reports told called".split()
PRIOR = {"bias": -3.0, "I": 4.0, "It": 5.0, "In": 1.5, "Ir": 1.5, "H": 1.0, "Ht": 4.0, "Hn": 0.0, "Hr": 0.5}

LABELS = [k for k in PRIOR if k != "bias"]
_WORD = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_STOP = re.compile(r"[.!?;:\n]")
_LETTERS = re.compile(r"[^\W\d_]+")


class Transducer:
    """A deterministic transducer: ``step(state, symbol)`` gives the next state and the symbol written.

    States and symbols are few; ``table`` lists all steps, so that machines can be composed and run.
    """

    def __init__(self, start, states, symbols, step):
        self.start = start
        self.table = {(s, x): step(s, x) for s, x in product(states, symbols)}

    def then(self, other: Transducer) -> Transducer:
        """The machine that feeds what this one writes to ``other``; only reachable states are built."""
        symbols = {x for _, x in self.table}
        made = Transducer((self.start, other.start), (), (), None)
        todo, seen = [made.start], {made.start}
        while todo:
            a, b = state = todo.pop()
            for x in symbols:
                a2, y = self.table[a, x]
                b2, z = other.table[b, y]
                made.table[state, x] = (a2, b2), z
                if (a2, b2) not in seen:
                    seen.add((a2, b2))
                    todo.append((a2, b2))
        return made

    def run(self, symbols) -> list[str]:
        state, out = self.start, []
        for x in symbols:
            state, y = self.table[state, x]
            out.append(y)
        return out


_BASE = ["I", "H", "T", "N", "R", ".", "o"]
_MARKED = [*_BASE, "In", "Hn", "Ir", "Hr", "It", "Ht"]
_NEGATION_REACH = 3


def _negation() -> Transducer:
    """An insult or threat up to three words after a negation is negated."""

    def step(left, x):
        if x == "N":
            return _NEGATION_REACH, "o"
        if x == ".":
            return 0, x
        return max(0, left - 1), x + "n" if left and x in "IH" else x

    return Transducer(0, range(_NEGATION_REACH + 1), _MARKED, step)


def _reported() -> Transducer:
    """What follows a verb of speech in the clause is quoted."""

    def step(said, x):
        if x in ("R", "."):
            return x == "R", "o" if x == "R" else x
        return said, x + "r" if said and x in ("I", "H") else x

    return Transducer(False, (False, True), _MARKED, step)


def _target() -> Transducer:
    """An insult or threat in a clause with a target is aimed; the target may stand in front."""

    def step(seen, x):
        if x in ("T", "."):
            return x == "T", "o" if x == "T" else x
        return seen, x + "t" if seen and x in ("I", "H") else x

    return Transducer(False, (False, True), _MARKED, step)


#: Most telling label first.
_ORDER = ["Ht", "It", "I", "H", "In", "Ir", "Hr", "Hn"]


def _clause() -> Transducer:
    """Holds the most telling label of a clause and writes it where the clause ends."""

    def step(held, x):
        if x == ".":
            return None, held or "o"
        if x in _ORDER and (held is None or _ORDER.index(x) < _ORDER.index(held)):
            return x, "o"
        return held, "o"

    return Transducer(None, [None, *_ORDER], _MARKED, step)


def grammar() -> Transducer:
    return _negation().then(_reported()).then(_target()).then(_clause())


@dataclass
class Lexicon:
    """Words and stems (word beginnings) of the insult class."""

    words: frozenset[str]
    stems: frozenset[str]

    def symbol(self, word: str) -> str:
        if not word[0].isalpha():
            return "."
        if word in self.words or any(word[:n] in self.stems for n in STEMS):
            return "I"
        return _SEEDS.get(word, "o")


_SEEDS = {w: "H" for w in THREATS} | {w: "T" for w in TARGETS} | {w: "N" for w in NEGATIONS} | {w: "R" for w in REPORTED}


class Matcher:
    """Label counts of a text. Only the clauses that hold an insult or threat are read by the grammar."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.machine = lexicon, grammar()
        self.find = ahocorasick.Automaton()
        for w in [*lexicon.words, *lexicon.stems, *THREATS]:
            self.find.add_word(w, len(w))
        self.find.make_automaton()

    def counts(self, text: str) -> Counter:
        text, found, done = text.lower(), Counter(), -1
        stops = [m.start() for m in _STOP.finditer(text)]
        for last, n in self.find.iter(text):
            begin = last - n + 1
            if begin < done or (begin and text[begin - 1].isalpha()):
                continue
            k = bisect_left(stops, begin)
            start, done = stops[k - 1] + 1 if k else 0, stops[k] if k < len(stops) else len(text)
            symbols = [self.lexicon.symbol(w) for w in _WORD.findall(text[start:done])]
            found.update(x for x in self.machine.run([*symbols, "."]) if x != "o" and x != ".")
        return found


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, bound: int = LABEL_BOUND) -> DataFrame:
    """(toxic, text) of at most ``bound`` labelled documents that are not held out; their ids are broadcast."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    one = one.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    some = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select(F.col("_toxic").alias("toxic"), "text")


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Words and stems that almost only toxic rows hold.

    A word beginning is a stem if STEM_SHARE of the toxic rows hold it and it goes on in several ways: no longer
    beginning or word covers half of it.
    """

    def features(batches):
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                words = set(_LETTERS.findall((text or "").lower()))
                held = {w + "$" for w in words if len(w) >= 3} | {w[:n] for w in words for n in STEMS if len(w) >= n} | {""}
                (toxic if label else clean).update(held)
            if len(toxic) + len(clean) > 300_000:
                yield counted(toxic, clean)
                toxic, clean = Counter(), Counter()
        yield counted(toxic, clean)

    def counted(toxic, clean):
        keys = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_pydict(
            {"feature": pa.array(keys, pa.string()), "toxic": pa.array([toxic[k] for k in keys], pa.int64()), "clean": pa.array([clean[k] for k in keys], pa.int64())}
        )

    sums = rows.mapInArrow(features, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    good = (F.col("toxic") >= MIN_TOXIC) & (F.col("toxic") >= MIN_SHARE * (F.col("toxic") + F.col("clean")))
    rows_found = sums.where(good | (F.col("feature") == "")).orderBy(F.desc("toxic"), "feature").limit(MAX_ENTRIES).collect()
    found = {r.feature: r.toxic for r in rows_found}
    enough = max(MIN_TOXIC, STEM_SHARE * found.pop("", 0))
    stems: set[str] = set()
    likely: set[str] = set()  # beginnings that must also explain rows which nothing else explains
    for stem in sorted((f for f in found if f[-1] != "$"), key=len):
        longer = max((n for f, n in found.items() if len(f) > len(stem) and f.startswith(stem)), default=0)
        if any(stem[:n] in stems for n in STEMS) or longer >= 0.9 * found[stem]:
            continue
        (stems if found[stem] >= enough and longer < 0.5 * found[stem] else likely).add(stem)
    words = {f for f in found if f[-1] == "$" and not any(f[:n] in stems for n in STEMS)}
    told = _telling(rows, stems, sorted(words | likely, key=lambda f: (-found[f], f)))
    return Lexicon(frozenset({f[:-1] for f in told if f[-1] == "$"} | set(INSULTS)), frozenset(stems | (told & likely)))


def _telling(rows: DataFrame, stems: set[str], ranked: list[str]) -> set[str]:
    """Of the entries, by descending count, those that explain MIN_TOXIC toxic rows which no stem or earlier entry explains.

    So a rare word that copies of one toxic text share is not taken for an insult.
    """
    number = {f: k for k, f in enumerate(ranked)}

    def held(batches):
        for batch in batches:
            out = []
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                if label:
                    words = set(_LETTERS.findall((text or "").lower()))
                    if words.isdisjoint(INSULTS) and not any(w[:n] in stems for w in words for n in STEMS):
                        keys = {w + "$" for w in words} | {w[:n] for w in words for n in STEMS}
                        out.append(sorted(number[k] for k in keys if k in number))
            yield pa.RecordBatch.from_pydict({"held": pa.array(out, pa.list_(pa.int32()))})

    sets = [set(r.held) for r in rows.mapInArrow(held, "held array<int>").collect()]  # LABEL_BOUND rows at most
    taken = set()
    for k, entry in enumerate(ranked):
        if sum(k in x for x in sets) >= MIN_TOXIC:
            taken.add(entry)
            sets = [x for x in sets if k not in x]
    return taken


def learn_weights(rows: DataFrame, lexicon: Lexicon, pull: float = 1.0, steps: int = 30) -> dict[str, float]:
    """Logistic regression on the label counts by Newton steps, drawn towards the prior weights."""

    def features(batches):
        matcher, sums = Matcher(lexicon), Counter()
        for batch in batches:
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                found = matcher.counts(text or "")
                sums[(label, *(min(found[k], 3) for k in LABELS))] += 1
        yield pa.RecordBatch.from_pydict(
            {"x": pa.array([list(k) for k in sums], pa.list_(pa.int32())), "n": pa.array(list(sums.values()), pa.int64())}
        )

    cells = rows.mapInArrow(features, "x array<int>, n long").groupBy("x").agg(F.sum("n").alias("n")).collect()  # LABEL_BOUND rows at most
    prior = np.array(list(PRIOR.values()))
    if not cells:
        return dict(PRIOR)
    x = np.array([[1, *c.x[1:]] for c in sorted(cells, key=lambda c: c.x)], float)
    y = np.array([c.x[0] for c in sorted(cells, key=lambda c: c.x)], float)
    n = np.array([c.n for c in sorted(cells, key=lambda c: c.x)], float)
    w = prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + pull * (w - prior)
        w = w - np.linalg.solve((x.T * (n * p * (1 - p))) @ x + pull * np.eye(len(w)), gradient).clip(-2, 2)
    return dict(zip(PRIOR, w.round(6).tolist()))


def score(docs: DataFrame, lexicon: Lexicon, weights: dict[str, float], threshold: float = PREDICT_FROM) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, and the number of matched clauses."""

    def run(batches):
        matcher = Matcher(lexicon)
        for batch in batches:
            found = [matcher.counts(text or "") for text in batch.column("text").to_pylist()]
            total = [weights["bias"] + sum(weights[k] * min(c[k], 3) for k in LABELS) for c in found]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "score": pa.array([round(1 / (1 + math.exp(-max(-30.0, min(30.0, t)))), 6) for t in total], pa.float64()),
                    "n_clauses": pa.array([sum(c.values()) for c in found], pa.int64()),
                }
            )

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, n_clauses long")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_clauses"
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = labelled(docs, labels)
    lexicon = learn_lexicon(rows)
    return score(docs, lexicon, learn_weights(rows, lexicon))
