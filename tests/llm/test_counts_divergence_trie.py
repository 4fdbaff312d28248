"""Token counts, source divergence and the conversation trie against brute force, and their edge cases."""

from collections import Counter, defaultdict
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from claimspan.llm import conversation_trie, divergence, token_counts
from claimspan.llm.common import prepare

SYLLABLES = ["ra", "te", "lo", "mi", "sü", "ne", "ko", "ßel", "日", "x"]


@pytest.fixture(scope="module")
def session(spark):
    prepare(spark)
    return spark


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) + rng.choice(["", "", ".", ","]) for _ in range(n))


# ---------------------------------------------------------------- token counts

ODD_TEXTS = [
    None, "", " ", "\n\n", "a  b", " a", "a ", "x <|endoftext|> y<|endoftext|>", "<|startoftext|> z", "café au lait b   c", "a\n\nb \n c\td",
    "<s> a b</s> ▁ x", "日本 語 a b", "it's I'll we 'd", "a\x00 b\x7f c", "ﬁ x é é a", "a b 　c", "tab\tx y", "🙂 🙂🙂 a 🙂",
]


def library_length(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    tokenizer = Tokenizer.from_file(path)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library_on_whole_texts(session, name):
    rng = random.Random(5)
    texts = ODD_TEXTS + [prose(rng, rng.randint(1, 300)) for _ in range(60)] + ["é" * 900, prose(rng, 30_000), "q" * 5_000]
    rows = [(k if k % 7 else None, t, 1, "n") for k, t in enumerate(texts + texts[:9])]
    docs = session.createDataFrame(rows, "doc_id long, text string, n_tokens int, piece string").repartition(3)
    length = library_length(name)
    want = Counter()
    for k, text, *_ in rows:
        n = length(text or "")
        want[k, len((text or "").encode()), n, n > 512] += 1
    result = token_counts.counts(docs, public_tokenizers.path(name))
    assert result.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(map(tuple, result.collect())) == want
    counter = token_counts.Counter(public_tokenizers.path(name), batch=40)  # every long text is split
    assert counter.cuttable
    assert counter([(t or "").encode() for t in texts]).tolist() == [length(t or "") for t in texts]


def test_pieces_of_a_long_text_are_balanced_and_keep_every_byte():
    counter = token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json"), batch=1000)
    text = prose(random.Random(2), 4000).encode()
    pieces = list(counter.split(text))
    assert b"".join(pieces) == text and max(map(len, pieces)) < 1100
    rounds = list(counter.rounds([text, b"", b"a"] * 3))
    assert all(sum(map(len, p)) <= 2100 for p, _ in rounds)


def test_counts_of_an_empty_table(session):
    empty = session.createDataFrame([], "doc_id long, text string")
    assert token_counts.counts(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# ---------------------------------------------------------------- source divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_divergence(rows, min_docs=3, top=200):
    found, groups = defaultdict(Counter), set()
    docs = defaultdict(set)
    for k, (lang, source, text) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)):
            found[lang, source][term] += 1
            docs[lang, term].add(k)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), d in docs.items() if x == lang and len(d) >= min_docs]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        whole = sum((found[lang, s] for s in sources), Counter())
        q, p = shares(whole), {s: shares(found[lang, s]) for s in sources}

        def rank(source, part, items, limit):
            for r, (v, item) in enumerate(sorted(((v, i) for i, v in items), key=lambda x: (-x[0], x[1].encode()))[:limit], 1):
                out.add((lang, source, part, item, v, r))

        for s in sources:
            rank(s, "pair", [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s], None)
            rank(s, "term", [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if found[lang, s][t] and p[s][t] > q[t]], top)
    return out


def divergence_rows(rng):
    long_terms = ["abcdefgh", "abcdefghi", "q" * 16, "q" * 17, "ü" * 30, "z" * 33, "z" * 700, "Z" * 700]
    rows = []
    for k in range(260):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", "s2", "Ω", "", None])
        words = [prose(rng, rng.randint(0, 40)), rng.choice(long_terms), rng.choice(["A1B2C3 A", "x_y-z", "É é É", ""])]
        rows.append((lang, source, " ".join(words)))
    rows += rows[:5] + [("en", "s9", None), ("en", "s9", ""), ("xx", "only", "one two"), ("yy", "a", "1 2 3"), ("yy", "b", None), (None, None, None)]
    rows.append(("en", "s1", prose(rng, 5_000)))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"buffer": 900, "block": 2, "slot": 37, "top": 5}])
def test_divergence_equals_brute_force(session, sizes):
    rows = divergence_rows(random.Random(11))
    docs = session.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int").repartition(4)
    result = divergence.audit(docs, **sizes)
    assert result.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in result.collect()]
    assert len(got) == len(set(got)) and set(got) == brute_divergence(rows, top=sizes.get("top", 200))


def test_divergence_of_an_empty_table(session):
    assert divergence.audit(session.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_radix_order_is_the_stable_order_of_words():
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 2**63, 500, dtype=np.uint64) << np.uint64(1) for _ in range(2)]
    for w in words:
        w[::3] = w[0]
    assert (divergence.radix_order(words) == np.lexsort(words[::-1])).all()


# ---------------------------------------------------------------- conversation trie


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            own[c].append((turn is not None, turn or 0, role or "", digest, text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members, children = defaultdict(list), Counter()
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = Counter(), Counter()
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1].encode()) if node else 0
    return Counter(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(node)).encode()).hexdigest())
        for node, m in members.items()
    )


def conversation_rows(rng):
    texts, rows = ["Hello", "", "ünï", None, "bye " * 50], []
    for c in [*range(-7, 160), 10**12, 10**12 + 1]:
        if c % 13 == 4:
            continue  # some families lack their first conversation
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", None])
            text = rng.choice(texts) if turn < 4 else f"{rng.random()}"
            rows.append((c, rng.choice([turn, turn, turn, None, 3]), role, text))
    for c in range(200_000, 200_400, 5):  # a large group of equal conversations, over several blocks of ids
        rows += [(c * 1_000, t, "user", "the same") for t in range(3)]
    rows += rows[:4]
    rows += [(None, 1, "user", "nobody"), (77_000_005, 0, "user", "long")] + [(77_000_005, k, "user", f"t{k % 3}") for k in range(1500)]
    return rows


@pytest.mark.parametrize("shard_bytes", [conversation_trie.SHARD, 600])
def test_trie_equals_brute_force(session, shard_bytes):
    rows = conversation_rows(random.Random(8))
    turns = session.createDataFrame([(*r, "x", b"p") for r in rows], "conv_id long, turn long, role string, text string, base string, path binary").repartition(5)
    result = conversation_trie.nodes(turns, shard_bytes)
    assert result.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(map(tuple, result.collect())) == brute_trie(rows)


def test_trie_of_an_empty_table_and_of_one_turnless_conversation(session):
    schema = "conv_id long, turn long, role string, text string"
    assert conversation_trie.nodes(session.createDataFrame([], schema)).count() == 0
    alone = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    (row,) = conversation_trie.nodes(session.createDataFrame([(alone, 0, "user", "x")], schema)).collect()
    assert tuple(row) == (alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())


def test_find_close_matches_a_stack():
    rng = random.Random(1)
    for block in (2, 3, 64):
        for _ in range(30):
            bits, depth = [1], 1
            while depth:
                bit = int(rng.random() < (0.5 if len(bits) < 400 else 0))
                bits.append(bit)
                depth += 1 if bit else -1
            want, stack = {}, []
            for k, bit in enumerate(bits):
                if bit:
                    stack.append(k)
                else:
                    want[stack.pop()] = k
            excess = np.cumsum(np.where(np.array(bits) == 1, 1, -1)).astype(np.int32)
            opens = np.flatnonzero(np.array(bits))
            assert conversation_trie.MinMaxTree(excess, block).find_close(opens).tolist() == [want[k] for k in opens]


@pytest.mark.parametrize("name", ["op12_source_divergence", "op13_conversation_trie"])
def test_query_matches_oracle(session, name):
    from __spark_entry__ import oracle_sql, queries
    from compare import compare, oracle

    sf_dir = "/root/testdata/sf0.001"
    assert compare(session, oracle(sf_dir), sf_dir, queries()[name], oracle_sql()[name]) == ""
