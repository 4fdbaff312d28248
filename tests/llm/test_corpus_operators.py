"""The corpus operators against brute force, exact round trips and held-out rows, and their edge cases."""

from collections import Counter, defaultdict
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions
import tiktoken
from tokenizers import Tokenizer
import xxhash

from claimspan.llm import (
    bpe, embedding_dedup, line_dedup, lm_scoring, ngram_join, packing, quality_rules, substring_dedup, suffix_dedup, toxicity,
)
from claimspan.llm.common import prepare
from claimspan.llm.components import components
import corpus_pipeline

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = [a + b for a in ("ra", "te", "lo", "mi", "sü", "ne", "ko") for b in ("na", "ri", "do", "ßel", "mo", "ta", "be", "")]
SCHEMA = "doc_id long, text string, lang string, n int, row string, text_b string"


def prose(rng, n, stop=True):
    words = [rng.choice(WORDS) for _ in range(n)]
    return " ".join(w + ("." if stop and k % 9 == 8 else "") for k, w in enumerate(words))


def make_rows(seed=1):
    """(doc_id, text): prose, exact and near copies, a shared passage, odd texts."""
    rng = random.Random(seed)
    out, passage = [], prose(rng, 90)
    for _ in range(40):
        lines = [prose(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.3:
            lines.insert(rng.randint(0, len(lines)), passage)
        out.append("\n".join(lines))
    out += out[:5] + [out[0]] * 6
    for text in out[3:12]:
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    out += [None, "", " \t\n", "x", "\n\n", "é" * 700, prose(rng, 20_000), "Ab  c\r\nd  e f 's'll\x00 <|endoftext|>"]
    return list(enumerate(out))


ROWS = make_rows()
REPEATED = ROWS + ROWS[:2] + [(None, ROWS[4][1]), (None, None)]


@pytest.fixture(scope="module")
def session(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="module")
def docs(session):
    """With repeated rows, rows without an id, and columns whose names the operators use themselves."""
    return session.createDataFrame([(i, t, "en", 1, "r", "b") for i, t in REPEATED], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def plain(session):
    return session.createDataFrame([(i, t, "en", 1, "r", "b") for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(session):
    return session.createDataFrame([], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def groups_of(ids, pairs):
    """id -> least id it is connected with."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


# ---------------------------------------------------------------- components


def test_components_of_chains_stars_and_loops(session):
    rng = random.Random(4)
    pairs = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(60)] + [(7, 7)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    frame = session.createDataFrame(pairs + [(None, 3)], "a long, b long")
    expected = groups_of({x for p in pairs for x in p if p[0] != p[1]}, pairs)
    assert {r.id: r.component for r in components(frame).collect()} == expected
    assert components(frame.limit(0)).count() == 0


# ---------------------------------------------------------------- 1 LM scoring


def test_training_raises_the_likelihood(session, docs):
    hashes, counts, total = lm_scoring.known_words(docs)
    assert total == sum(len(words_of(t)) for _, t in REPEATED) and len(hashes) == len(counts) <= lm_scoring.KNOWN
    vocabulary, fresh = lm_scoring.Vocabulary(hashes), lm_scoring.Network.fresh(counts, total)
    trained = lm_scoring.train(docs, vocabulary, fresh)
    sums = [lm_scoring.score(docs, vocabulary, net).agg({"log_likelihood": "sum"}).first()[0] for net in (fresh, trained)]
    assert sums[1] > sums[0]
    rows = lm_scoring.score(docs, vocabulary, trained).collect()
    assert Counter((r.doc_id, r.n_words) for r in rows) == Counter((i, len(words_of(t))) for i, t in REPEATED)
    assert all((r.mean_log_prob is None) == (r.n_words == 0) and r.log_likelihood <= 0 for r in rows)


def test_words_outside_the_known_ones_have_their_own_probability(session):
    rng = random.Random(3)
    common = [f"{a}{k}" for a in WORDS for k in range(60)]
    weights = [1 / (k + 20) for k in range(len(common))]
    texts = [" ".join(rng.choices(common, weights, k=150)) for _ in range(300)]
    texts += [" ".join(f"zq{rng.randrange(10**12)}" for _ in range(150)), texts[0], "", None]
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).persist()
    counts = lm_scoring.word_counts(docs).persist()
    vocabulary, net = lm_scoring.fit(docs, counts=counts)
    by_number = {r.doc_id: r.log_likelihood for r in lm_scoring.score(docs, vocabulary, net).collect()}
    found = {r.doc_id: r for r in lm_scoring.score(docs, vocabulary, net, lm_scoring.shares(counts, vocabulary)).collect()}
    numbers = {}
    for t in texts:
        for w in set((t or "").split()):
            h = lm_scoring.word_hashes([w.encode()], lm_scoring.Rolling())[0]
            numbers[w] = int(vocabulary.numbers(h)[0])
    n, size = Counter(w for t in texts for w in (t or "").split()), Counter()
    for w, c in n.items():
        size[numbers[w]] += c
    for i, t in enumerate(texts):
        more = sum(np.log(n[w] / (size[numbers[w]] + 1)) for w in (t or "").split() if numbers[w] >= lm_scoring.KNOWN)
        assert found[i].log_likelihood == pytest.approx(by_number[i] + more, abs=2e-3)
    assert found[300].mean_log_prob < min(found[i].mean_log_prob for i in range(300))
    whole = {r.doc_id: r.mean_log_prob for r in lm_scoring.pseudo_likelihood(docs).collect()}
    assert len(whole) == len(texts) and whole[300] < min(whole[i] for i in range(300))


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    net = lm_scoring.Network(rng.standard_normal(lm_scoring.Network.size()) * 0.3)
    around, targets = rng.integers(0, lm_scoring.SIZE + 1, (len(lm_scoring.WINDOW), 50)), rng.integers(0, lm_scoring.SIZE, 50)
    gradient = lm_scoring.Network(np.zeros(lm_scoring.Network.size()))
    net.forward(around, targets, gradient)
    for k in np.argsort(-np.abs(gradient.weights))[[0, 5, 50, 300]]:
        loss = []
        for step in (1e-5, -1e-5):
            moved = net.weights.copy()
            moved[k] += step
            loss.append(-lm_scoring.Network(moved).forward(around, targets).mean())
        assert (loss[0] - loss[1]) / 2e-5 == pytest.approx(gradient.weights[k], rel=1e-3)


def test_probabilities_of_a_word_sum_to_one():
    net = lm_scoring.Network(np.random.default_rng(2).standard_normal(lm_scoring.Network.size()) * 0.2)
    around = np.tile(np.array([[3], [lm_scoring.SIZE], [9], [70]]), lm_scoring.SIZE)
    assert np.exp(net.forward(around, np.arange(lm_scoring.SIZE))).sum() == pytest.approx(1)


# ---------------------------------------------------------------- 2 substring dedup


@pytest.mark.parametrize("by", ["line", "paragraph"])
def test_units_are_removed_but_for_the_first(session, plain, by):
    rows = {r.doc_id: r for r in substring_dedup.deduplicate(plain, by).collect()}
    seen, expected = {}, defaultdict(list)
    for doc_id, text in sorted(ROWS):
        raw = (text or "").encode()
        breaks = [(m.start(), m.end()) for m in substring_dedup.BREAKS[by].finditer(raw)]
        for a, b in zip([0, *(e for _, e in breaks)], [*(s for s, _ in breaks), len(raw)]):
            low = bytes(c + 32 if 65 <= c <= 90 else c for c in raw[a:b])
            key = tuple(re.findall(rb"[^\x20\x09-\x0D]+", low))
            if len(key) >= substring_dedup.MIN_WORDS:
                if key in seen:
                    expected[doc_id].append((a, b, seen[key]))
                else:
                    seen[key] = doc_id
    assert expected
    for doc_id, text in ROWS:
        r = rows[doc_id]
        assert [(s.begin, s.stop, s.first_doc_id) for s in r.spans or []] == expected[doc_id]
        if not expected[doc_id]:
            assert r.text == text
        kept = (text or "").encode()
        for a, b, _ in reversed(expected[doc_id]):
            kept = kept[:a] + kept[b:]
        assert words_of(r.text) == words_of(kept.decode())


# ---------------------------------------------------------------- 3 suffix dedup


def covered(texts, length):
    count = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                mark[k : k + length] = b"\1" * length
        out.append(mark)
    return out


@pytest.mark.parametrize("length, bound", [(60, 5000), (60, 1), (400, 5000)])
def test_every_repeated_byte_is_removed(session, docs, monkeypatch, length, bound):
    monkeypatch.setattr(suffix_dedup, "MAX_SEGMENTS", bound)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 5000)
    raw = [(i, (t or "").encode()) for i, t in REPEATED]
    expected = []
    for (i, t), mark in zip(raw, covered([t for _, t in raw], length)):
        kept = bytes(b for b, m in zip(t, mark) if not m)
        expected.append((i, len(t), sum(mark), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    rows = suffix_dedup.digests(docs, length).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == Counter(expected)


@pytest.mark.parametrize("bound", [5000, 1])
def test_texts_of_several_chunks_lose_only_what_repeats(session, monkeypatch, bound):
    monkeypatch.setattr(suffix_dedup, "MAX_SEGMENTS", bound)
    rng = random.Random(21)
    unique = ["".join(rng.choice("abcdefgh") for _ in range(6000)) for _ in range(4)]
    texts = [*unique[:3], unique[3], unique[3][700:3900] + unique[0][900:1500]]
    frame = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    marks = covered([t.encode() for t in texts], 100)
    expected = {i: int(np.sum(m)) for i, m in enumerate(marks)}
    assert expected[1] == 0 and expected[4] > 0
    found = {r.doc_id: r.n_removed for r in suffix_dedup.digests(frame, 100, chunk=1000).collect()}
    assert found == expected


def test_sorted_columns_find_windows_at_the_same_place(tmp_path):
    rng = random.Random(2)
    for _ in range(150):
        length, lead = rng.choice([4, 6, 9]), rng.randint(0, 7)
        base = "".join(rng.choice("ab") for _ in range(lead + 2 * length))
        texts, leads = [], []
        for _ in range(rng.randint(2, 8)):
            n = rng.randint(0, lead)
            t = list(base[lead - n : lead + length])
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = rng.choice("abc")
            texts.append("".join(t).encode())
            leads.append(n)
        for k, depths in enumerate(suffix_dedup.repeated_windows(texts, leads, length, str(tmp_path))):
            window = lambda j, r: texts[j][leads[j] - r :][:length] if r <= leads[j] else b""  # noqa: E731, B023
            same = {r for r in range(leads[k] + 1) if len(window(k, r)) == length and any(window(j, r) == window(k, r) for j in range(len(texts)) if j != k)}
            assert same <= set(depths.tolist())
            everywhere = Counter(window(j, r) for j in range(len(texts)) for r in range(leads[j] + 1))
            assert all(everywhere[window(k, r)] > 1 for r in depths.tolist())


def test_characters_stay_whole():
    assert suffix_dedup.remaining_text("aéb".encode(), [(0, 2)]) == "éb"
    assert suffix_dedup.remaining_text("aéb".encode(), [(2, 4)]) == "aé"
    assert suffix_dedup.remaining_text("aéb".encode(), [(0, 1), (1, 4)]) == ""


# ---------------------------------------------------------------- 4 quality rules


def spark_hash(value, seed=42):
    data = value.encode() if isinstance(value, str) else int(value).to_bytes(8, "little", signed=True)
    h = xxhash.xxh64_intdigest(data, seed=seed % 2**64)
    return h - 2**64 if h >= 2**63 else h


def codes(words):
    one = [spark_hash(w) for w in words]
    ends = [spark_hash_int(1, spark_hash(w[-2:])) for w in words]
    two = [spark_hash(b, spark_hash(a)) for a, b in zip(one, one[1:])]
    return one + ends + two


def spark_hash_int(value, seed):
    h = xxh64_of_int(value, seed % 2**64)
    return h - 2**64 if h >= 2**63 else h


def xxh64_of_int(value, seed):
    return xxhash.xxh64_intdigest(int(value).to_bytes(4, "little", signed=True), seed=seed)


def test_quality_counts_scores_and_verdicts(session, docs):
    good = [i for i, t in ROWS if t and i % 2 == 0]
    labels = session.createDataFrame([(i, int(i in good), 0) for i, _ in ROWS] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    n, g = Counter(), Counter()
    for i, t in REPEATED:
        c = Counter(x % quality_rules.BUCKETS for x in codes(words_of(t)))
        n += c
        g += c if i in good else Counter()
    size, one = quality_rules.BUCKETS, quality_rules.SMOOTHING
    ratio = [
        np.log((g[b] + one) / (g.total() + one * size)) - np.log((n[b] + one) / (n.total() + one * size)) if n[b] else 0.0 for b in range(size)
    ]
    rows = sorted(quality_rules.rate(docs, labels).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words))
    for r, (i, t) in zip(rows, sorted(REPEATED, key=lambda x: (x[0] is None, x[0] or 0, len(words_of(x[1])))), strict=True):
        w = words_of(t)
        seen = Counter(zip(w, w[1:], w[2:]))
        cover = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        counts = (i, len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))
        assert (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        all_codes = codes(w)
        mean = sum(ratio[c % size] for c in all_codes) / len(all_codes) if w else 0.0
        assert r.score == pytest.approx(mean, abs=1e-5)
        assert r.base_failed == failed and r.kept == (not failed and r.score >= quality_rules.THRESHOLD)


# ---------------------------------------------------------------- 5 packing


def test_pieces_hold_every_id_once(session, docs):
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    pieces = packing.pack(docs, JSON).collect()
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_TOKEN] for _, t in REPEATED}
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_document[p.doc_id, p.doc_tokens].append(p)
        by_sequence[p.sequence_id].append(p)
    expected = Counter()
    for i, t in REPEATED:
        expected[i, len(ids[t])] += len(ids[t])
    assert {k: sum(p.length for p in v) for k, v in by_document.items()} == dict(expected)
    text_of = {(i, len(ids[t])): t for i, t in REPEATED}
    for key, found in by_document.items():
        own = ids[text_of[key]]
        copies = expected[key] // len(own)
        assert Counter(k for p in found for k in range(p.start, p.start + p.length)) == Counter(dict.fromkeys(range(len(own)), copies))
        for p in found:
            assert p.ids_crc32 == zlib.crc32(np.array(own[p.start : p.start + p.length], "<u4").tobytes())
    padding = total = 0
    for found in by_sequence.values():
        found.sort(key=lambda p: p.offset)
        assert [p.offset for p in found] == [sum(q.length for q in found[:k]) for k in range(len(found))]
        n = sum(p.length for p in found)
        assert 0 < n <= packing.LENGTH
        padding, total = padding + (0 if n & (n - 1) == 0 else packing.LENGTH - n), total + n
    assert padding < 0.02 * total


def test_cuts_cost_the_least():
    """Against a dynamic program over all candidate cuts without a queue."""
    rng = random.Random(3)
    for _ in range(40):
        total, length = rng.randint(1, 400), 50
        ends = sorted(rng.sample(range(1, total + 1), min(total, rng.randint(1, 6))))
        ends[-1] = total
        stops = np.array(sorted(rng.sample(range(1, total + 1), min(total, rng.randint(0, 30)))), np.int64)
        kind = dict.fromkeys(range(packing.GRID, total, packing.GRID), packing.INSIDE_PENALTY)
        kind |= dict.fromkeys(stops.tolist(), packing.SENTENCE_PENALTY) | dict.fromkeys(ends, 0)
        places = [0, *sorted(k for k in kind if k < total)]
        if any(b - a > length for a, b in zip(places, [*places[1:], total])):
            continue
        cost = {0: 0}
        for c in places[1:]:
            cost[c] = min(cost[p] + length - (c - p) for p in places if 0 < c - p <= length) + kind[c]
        last = {p: min(length - (total - p), packing.INSIDE_PENALTY * ((total - p).bit_count() - 1)) for p in places if total - p <= length}
        best = min(cost[p] + x for p, x in last.items())
        got = packing.cuts(total, np.array(ends), stops, length).tolist()
        assert got[-1] == total and all(0 < b - a <= length for a, b in zip([0, *got], got))
        tried = []
        for k in range(len(got)):  # the tail begins somewhere; the rest is plain windows
            head, tail = got[:k], np.diff([([0] + got)[k], *got[k:]])
            if all(h in cost for h in head) and (len(tail) == 1 or all(x & (x - 1) == 0 for x in tail.tolist())):
                paid = sum(length - (b - a) + kind[b] for a, b in zip([0, *head], head))
                rest = total - ([0] + got)[k]
                tried.append(paid + min(length - rest, packing.INSIDE_PENALTY * (len(tail) - 1) if rest.bit_count() == len(tail) else 10**9) if rest <= length else 10**9)
        assert min(tried) == best


# ---------------------------------------------------------------- 6 embeddings


def test_links_and_groups_equal_brute_force(session, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((150, 16))
    near = base[rng.integers(0, 8, 120)] + 0.12 * rng.standard_normal((120, 16))
    x = np.concatenate([base, near, base[:5], base[:3] * 2.5]).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, [1.0, 2.0]), (905, [1.0, 2.0]), (906, []), (None, rows[0][1]), (907, [float("inf")] + [0.0] * 15)]
    frame = session.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<float>, label int")
    found = {r.vec_id: r for r in embedding_dedup.deduplicate(frame).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = unit @ unit.T >= embedding_dedup.THRESHOLD
    np.fill_diagonal(linked, False)
    expected = groups_of(range(len(x)), np.argwhere(linked))
    assert linked.sum() > 500
    right = sum(found[k].n_links == linked[k].sum() and found[k].component_id == expected[k] for k in range(len(x)))
    assert right >= 0.98 * len(x)
    for k in (900, 901, 902, 903, 906, 907):
        assert (found[k].n_links, found[k].component_id, found[k].kept) == (0, k, True)
    assert (found[905].n_links, found[905].component_id, found[905].kept) == (1, 904, False)
    assert found[None].component_id is None and not found[None].kept
    assert embedding_dedup.deduplicate(frame.limit(0)).count() == 0


# ---------------------------------------------------------------- 7 lines


def test_line_groups_equal_brute_force(session, plain):
    lines = [(i, k, [w for w in re.split(r"[\s!-/:-@\[-`{-~]+", x.lower()) if w]) for i, t in ROWS for k, x in enumerate((t or "").split("\n"))]
    lines = [(i, k, tuple(w)) for i, k, w in lines if len(w) >= line_dedup.MIN_WORDS]
    first = {}
    for i, k, w in sorted(lines):
        first.setdefault(w, (i, k))
    distinct, pairs = list(first), []

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for p in range(len(distinct)):
        for q in range(p):
            a, b = distinct[p], distinct[q]
            if 100 * (max(len(a), len(b)) - edits(a, b)) >= line_dedup.PERCENT * max(len(a), len(b)):
                pairs.append((first[a], first[b]))
    assert pairs
    group = groups_of(first.values(), pairs)
    expected = {(i, k): group[first[w]] for i, k, w in lines}
    rows = line_dedup.find(plain).collect()
    assert {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in rows} == expected
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.first_doc_id, r.first_line_no)) for r in rows)


def test_lines_of_the_declared_similarity_are_found(session):
    rng, rows, expected = random.Random(12), [], {}

    def replaced(line, places):
        return [f"new{rng.randrange(10**12)}" if k in places else w for k, w in enumerate(line)]

    for n, changed in ((6, 1), (10, 1), (10, 2), (20, 1), (20, 4), (30, 1), (50, 5), (50, 10), (200, 40), (700, 140)):
        for _ in range(8):
            i, line = len(rows), [f"{rng.choice(WORDS)}{rng.randrange(300)}" for _ in range(n)]
            some, too_many = rng.sample(range(n), changed), rng.sample(range(n), n // 5 + 1)
            for x in (line, replaced(line, some), [w for k, w in enumerate(line) if k not in some], replaced(line, too_many)):
                rows.append((len(rows), " ".join(x)))
            expected |= {i: i, i + 1: i, i + 2: i, i + 3: i + 3}
    frame = session.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.first_doc_id for r in line_dedup.find(frame).collect()} == expected


def test_lines_that_only_share_words_are_not_fetched_for_comparison(session, monkeypatch):
    fetched, sketches = [], line_dedup._sketches
    monkeypatch.setattr(line_dedup, "_sketches", lambda docs, heads: (fetched.append(heads.count()), sketches(docs, heads))[1])
    # All lines have the same 41 words; as 41 is a prime, no two of them have the same word behind the same word.
    rows = [(k, " ".join(f"word{i * (k + 1) % 41}" for i in range(41))) for k in range(40)]
    rows.append((40, " ".join(["new", *rows[7][1].split()[1:]])))
    frame = session.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.first_doc_id for r in line_dedup.find(frame).collect()} == {k: k for k in range(40)} | {40: 7}
    assert fetched == [2]


def test_pairs_at_the_border_of_the_similarity_share_a_key(session):
    rng, rows, expected = random.Random(15), [], {}
    for n in range(line_dedup.MIN_WORDS, 42):
        line = [f"{rng.choice(WORDS)}{rng.randrange(10**9)}" for _ in range(n)]
        for m in range(n, n * 100 // line_dedup.PERCENT + 1):
            edits = m * (100 - line_dedup.PERCENT) // 100
            # New words stand among the old ones, evenly, and replace others, so that as few pairs as possible stay.
            places = set(rng.sample(range(m), m - n))
            old = iter(line)
            longer = [f"new{rng.randrange(10**12)}" if k in places else next(old) for k in range(m)]
            for k in rng.sample([k for k in range(m) if k not in places], edits - (m - n)):
                longer[k] = f"new{rng.randrange(10**12)}"
            own = [f"{w}x{m}" if w in line else w for w in longer]
            expected |= {len(rows): len(rows), len(rows) + 1: len(rows)}
            rows += [(len(rows), " ".join(f"{w}x{m}" for w in line)), (len(rows) + 1, " ".join(own))]
    frame = session.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.first_doc_id for r in line_dedup.find(frame).collect()} == expected


def test_texts_are_cut_into_words_once(plain, monkeypatch):
    monkeypatch.setattr(line_dedup, "_counts", lambda found: functions.expr("array_repeat(0L, 8192)"))
    found = line_dedup.lines(plain)
    for made in (found, line_dedup.rare_pairs(found)):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1


def test_long_lines_that_share_pairs_of_words_are_not_fetched_for_comparison(session, monkeypatch):
    fetched, sketches = [], line_dedup._sketches
    monkeypatch.setattr(line_dedup, "_sketches", lambda found, heads: (fetched.append(heads.count()), sketches(found, heads))[1])
    rng = random.Random(17)
    rows = [(k, " ".join(rng.sample([f"word{i}" for i in range(400)], 180))) for k in range(30)]
    keys = [{*zip(w, w[1:])} for w in (t.split() for _, t in rows)]
    assert any(a & b for k, a in enumerate(keys) for b in keys[:k])
    frame = session.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.first_doc_id for r in line_dedup.find(frame).collect()} == {k: k for k in range(30)}
    assert fetched == [0]


def test_no_plan_of_line_dedup_holds_a_large_constant(session, plain):
    ids = session.createDataFrame([(k,) for k in range(500)], "doc_id long")
    for held in (line_dedup._counts(line_dedup.lines(plain)), line_dedup._document_filter(ids, "doc_id")):
        assert len(str(held)) < 200_000
    chosen = session.range(0, 2000, 1).withColumnRenamed("id", "doc_id").where(line_dedup._document_filter(ids, "doc_id"))
    assert {r.doc_id for r in chosen.collect()} >= set(range(500)) and chosen.count() < 600


def test_near_copies_of_very_long_lines_are_found(session):
    rng = random.Random(13)
    n = line_dedup.MAX_WORDS + 1500
    line, other = ([f"{rng.choice(WORDS)}{rng.randrange(300)}" for _ in range(n)] for _ in range(2))
    near = [f"new{k}" if k % 10 == 3 else w for k, w in enumerate(line)]
    far = [f"own{k}" if k % 4 == 1 else w for k, w in enumerate(line)]
    rows = [(k, " ".join(x)) for k, x in enumerate((line, near, far, other, other, line[: line_dedup.MAX_WORDS - 50]))]
    frame = session.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_words, r.first_doc_id) for r in line_dedup.find(frame).collect()}
    assert found == {0: (n, 0), 1: (n, 0), 2: (n, 2), 3: (n, 3), 4: (n, 3), 5: (line_dedup.MAX_WORDS - 50, 0)}


def test_lines_are_taken_out_of_texts(session, nothing):
    line = "one two three four five six"
    rows = [(1, f"{line}\nshort\n{line.upper()}."), (2, f"{line}\nof its own, that line is here"), (3, None), (None, line), (4, "")]
    frame = session.createDataFrame([(i, t, "en", 1, "r", "b") for i, t in rows], SCHEMA)
    kept = {r.doc_id: r.text for r in line_dedup.remove(frame).collect()}
    assert kept == {1: f"{line}\nshort", 2: "of its own, that line is here", 3: None, None: line, 4: ""}
    assert line_dedup.remove(nothing).columns == nothing.columns and line_dedup.find(nothing).count() == 0


# ---------------------------------------------------------------- 8 BPE


def test_ids_are_those_of_the_library_and_decode_to_the_text(session, docs):
    ranks = bpe.read_ranks(RANKS)
    coder = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    expected = Counter((i, tuple(coder.encode_ordinary(t or ""))) for i, t in REPEATED)
    assert Counter((r.doc_id, tuple(r.ids)) for r in coded.collect()) == expected
    texts = Counter((i, (t or "").encode()) for i, t in REPEATED)
    assert Counter((r.doc_id, bytes(r.data)) for r in bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect()) == texts
    own = bpe.coder(RANKS, public_tokenizers.PATTERN)
    long_word = "".join(random.Random(5).choice("abcdeé") for _ in range(900))
    assert own.words([long_word.encode()]) == [coder.encode_ordinary(long_word)]
    rows = bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, r.decoded_sha256) for r in rows) == Counter((i, hashlib.sha256(t).hexdigest()) for i, t in texts.elements())


# ---------------------------------------------------------------- 9 toxicity


def test_grammar_marks_clauses():
    matcher = toxicity.Matcher(toxicity.Lexicon(frozenset({"idiot"}), frozenset({"vequ"})))
    assert matcher.counts("You are an idiot. Fine") == {"It": 1}
    assert matcher.counts("it is not an idiot; she said idiot!\nidiotic vequation") == {"In": 1, "Ir": 1, "I": 1}
    assert matcher.counts("they will kill you, all of them") == {"Ht": 1}
    assert not matcher.counts("videoidiot overkill") and not matcher.counts("")


def test_held_out_rows_are_never_learned_from(session):
    rng = random.Random(8)
    bad = ["grumbletart", "vilewort"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = [rng.choice(WORDS) for _ in range(30)]
        if toxic:
            words[rng.randrange(30)] = rng.choice([*bad, "schnuck" + rng.choice(WORDS) + rng.choice(WORDS)])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic if zlib.crc32(str(i).encode()) % 3 != 1 else i % 2)))
    docs = session.createDataFrame(rows + [(5000, None), (5001, ""), (None, "grumbletart")], "doc_id long, text string")
    scored = toxicity.toxicity(docs, session.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scored)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored if r.doc_id is not None)
    wrong = [r.doc_id for r in scored if r.doc_id is not None and r.doc_id < 900 and r.predicted != int(r.doc_id % 6 == 0)]
    assert len(wrong) <= 9 and len(scored) == 903
    unlabelled = toxicity.toxicity(docs, session.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert unlabelled.filter("doc_id >= 5000 and predicted = 0").count() == 2


# ---------------------------------------------------------------- 10 Jaccard join


@pytest.mark.parametrize("small, block", [(32, 1024), (1, 3)])
def test_join_equals_brute_force(session, plain, small, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", small)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    sets = {}
    for i, t in ROWS:
        w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    expected = groups_of(sets, pairs)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(plain).collect()}
    assert found == {i: (len(sets[i]), expected[i]) for i in sets} and len(set(expected.values())) < len(sets)


def test_many_near_copies_make_one_group(session):
    rng = random.Random(6)
    base = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(200)]
    texts = [" ".join(base)] * 20
    for _ in range(60):
        words = list(base)
        words[rng.randrange(200)] = "new" + str(rng.randrange(10**6))
        texts.append(" ".join(words))
    frame = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.component_id for r in ngram_join.join(frame).collect()} == {0}


# ---------------------------------------------------------------- all of them


def test_odd_rows_and_empty_tables(session, docs, nothing):
    labels = session.createDataFrame([], "doc_id long, quality int, toxic int")
    per_row = [
        lambda d: lm_scoring.pseudo_likelihood(d),
        lambda d: substring_dedup.digests(d),
        lambda d: suffix_dedup.remove(d, 60),
        lambda d: quality_rules.rate(d, labels),
        lambda d: toxicity.toxicity(d, labels),
        lambda d: ngram_join.join(d),
        lambda d: line_dedup.remove(d),
        lambda d: bpe.digests(d, RANKS, public_tokenizers.PATTERN),
    ]
    for operator in per_row:
        assert operator(docs).count() >= len(REPEATED)
        assert operator(nothing).count() == 0
    assert packing.pack(nothing, JSON).count() == 0


def test_pipeline_stages_keep_the_columns(session, plain):
    folder = session.conf.get("spark.checkpoint.dir") + "/tables"
    session.createDataFrame([(i, 1, 0) for i, _ in ROWS], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    plain.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    docs, left = session.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(session, docs, folder)
        assert docs.columns == plain.columns
        left.append({r.doc_id: r.text for r in docs.collect()})
    assert all(set(b) <= set(a) for a, b in zip(left, left[1:])) and 0 < len(left[-1]) < len(ROWS)
    pieces = corpus_pipeline.run(session, folder)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == set(left[-1])
