"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimspan.llm import bpe, conversation_trie, divergence, embedding_dedup, line_dedup, lm_scoring, ngram_join, packing, quality_rules, substring_dedup, suffix_dedup, token_counts, toxicity
from claimspan.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        return build

    return add


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


@query("op6_embedding_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicate(table(spark, sf_dir, "embeddings"))


@query("op1_lm_scoring")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.pseudo_likelihood(table(spark, sf_dir, "documents"))


@query("op10_ngram_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


@query("op3_suffix_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.find(table(spark, sf_dir, "documents"))


@query("op11_token_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op12_source_divergence")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLE["op12_source_divergence"] = """
with words as (
    select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
    from documents),
found as (select d, lang, source, unnest(terms) as term from words),
kept as (select lang, term, count(*)::hugeint as n from found group by all having count(distinct d) >= 3),
sizes as (select lang, count(*)::hugeint as v from kept group by all),
parts as (select distinct lang, source from words),
counts as (
    select p.lang, p.source, k.term, count(f.term)::hugeint as n
    from parts p join kept k using (lang) left join found f on f.lang = p.lang and f.source = p.source and f.term = k.term group by all),
totals as (select lang, source, sum(n)::hugeint as total from counts group by all),
shares as (
    select c.lang, c.source, c.term, c.n, 1 + 1000000000 * (c.n + 1) // (t.total + s.v) as p
    from counts c join totals t using (lang, source) join sizes s using (lang)),
whole as (
    select k.lang, k.term, 1 + 1000000000 * (k.n + 1) // (sum(k.n) over (partition by k.lang) + s.v)::hugeint as q
    from kept k join sizes s using (lang)),
pairs as (
    select a.lang, a.source, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) as value
    from parts a join parts b on a.lang = b.lang and a.source <> b.source
    left join shares x on x.lang = a.lang and x.source = a.source
    left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term group by all),
ranked as (
    select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
    union all
    (select x.lang, x.source, 'term', x.term, (x.p - w.q) * (x.p - w.q) // w.q as value,
            row_number() over (partition by x.lang, x.source order by value desc, x.term) as rank
     from shares x join whole w using (lang, term) where x.n > 0 and x.p > w.q qualify rank <= 200))
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked
"""


@query("op13_conversation_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.nodes(table(spark, sf_dir, "conversations"))


# The CRC is that of zlib: reflected polynomial 0xEDB88320, one list_reduce step a byte and eight a bit.
ORACLE["op13_conversation_trie"] = """
with turns as (
    select conv_id, turn, coalesce(role, '') as r, strlen(coalesce(text, '')) as size,
           substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) as digest
    from conversations where conv_id is not null),
own as (
    select conv_id, list(digest order by turn nulls first, r, digest) as digests, list(size order by turn nulls first, r, digest) as sizes
    from turns group by conv_id),
heads as (
    select *, xor(4294967295, list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda s: ascii(s)::bigint),
               lambda crc, byte: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::bigint[], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)),
               4294967295::bigint)) % 9 as h
    from own),
rebuilt as (
    select c.conv_id, list_concat(coalesce(b.digests, [])[1:c.h], c.digests[c.h + 1:]) as digests,
           list_concat(coalesce(b.sizes, [])[1:c.h], c.sizes[c.h + 1:]) as sizes
    from heads c left join own b on b.conv_id = c.conv_id - c.conv_id % 5),
prefixes as (
    select conv_id, len(digests) as n, array_to_string(digests, '') as path, sizes, unnest(range(0, len(digests) + 1)) as depth from rebuilt),
nodes as (
    select left(path, 32 * depth) as node, depth, min(conv_id) as conv_id, count(*) as n_convs,
           coalesce(any_value(case when depth > 0 then sizes[depth] end), 0) as size,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where n = depth), '')) as ends_sha256
    from prefixes group by all),
children as (select left(node, 32 * (depth - 1)) as node, count(*) as n from nodes where depth > 0 group by all),
counted as (select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c using (node)),
upwards as (select left(node, 32 * k) as node, n_children, (n_convs - 1) * size as saved
            from (select *, unnest(range(0, depth + 1)) as k from counted)),
subtrees as (select node, count(*) filter (where n_children = 0) as n_leaves, sum(saved) as saved_tokens from upwards group by node)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::bigint as saved_tokens, n.ends_sha256
from counted n join subtrees s using (node)
left join nodes p on n.depth > 0 and p.node = left(n.node, 32 * (n.depth - 1))
"""
