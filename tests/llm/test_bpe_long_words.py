"""Many long words in one batch: bounded queries, ids equal to the library's."""

import random

import public_tokenizers
import pytest
import tiktoken

from claimspan.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.mark.parametrize("alphabet, size, count", [("abcdefghijklmnop", 250, 700), ("日本語中文字漢", 80, 400), ("aA0+/b", 255, 100), ("xyz", 2000, 40)])
def test_many_distinct_long_words(alphabet, size, count):
    rng = random.Random(size)
    words = ["".join(rng.choice(alphabet) for _ in range(size)) for _ in range(count)] + ["ab", "日本", "zq" * 9]
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=".+", mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    assert coder.words([w.encode() for w in words]) == [library.encode_ordinary(w) for w in words]
