"""The clause search of the grammar: linear in the text, and the clauses are those of a plain split."""

import random
import re
import time

from claimspan.llm import toxicity


def plain_clauses(text):
    return re.split(r"[.!?;:\n]", text)


def make_text(rng, n):
    parts = []
    for _ in range(n):
        clause = [rng.choice(["the", "paper", "was", "read", "you", "are", "not", "an", "idiot", "stupid", "said", "kill"]) for _ in range(rng.randint(1, 9))]
        parts.append(" ".join(clause) + rng.choice([".", "!", ";", "\n", ": ", "? "]))
    return " ".join(parts)


def _counter():
    return toxicity.Matcher(toxicity.Lexicon(frozenset({"idiot", "stupid"}), frozenset()))


def test_counts_of_a_text_are_those_of_its_clauses():
    own = _counter()
    text = make_text(random.Random(3), 400)
    total = sum((own.counts(c) for c in plain_clauses(text)), start=type(own.counts(""))())
    assert own.counts(text) == total and sum(total.values()) > 50


def test_time_is_linear_in_the_text():
    own = _counter()
    texts = [make_text(random.Random(4), n) for n in (4_000, 16_000)]
    own.counts(texts[0])
    spent = []
    for text in texts:
        begin = time.perf_counter()
        own.counts(text)
        spent.append(time.perf_counter() - begin)
    assert spent[1] < 12 * spent[0]  # sixteen times and more where it is quadratic
