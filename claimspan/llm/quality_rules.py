"""Quality rules: base counts per document, and a log-likelihood ratio of hashed n-grams.

Two multinomials over the same hashed n-grams are compared: one counted over trusted documents, one
over the whole corpus. A document is kept if it passes the base rules and the mean log ratio of its
n-grams reaches a threshold. DataFrame functions only; the corpus is read twice and no text, word or
n-gram is shuffled, only one row per bucket and task.

Edge cases: a null or empty text has no words, so it fails the base rules, with score 0; a null
doc_id is kept as it is; repeated rows are scored one by one; extra columns do not matter. An empty
table gives an empty result, and without trusted documents every score is 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from claimspan.llm.common import SPACE, SPACE_CHARS

#: Hash buckets of the n-grams; also the proven bound of what the driver collects.
BUCKETS = 1 << 13
#: Trusted documents that the target multinomial is fitted on at most, those with the least hash of their id.
TRUSTED_BOUND = 20_000
#: Pseudo-count of each bucket.
SMOOTHING = 1.0
#: Documents whose mean log ratio is below this go.
THRESHOLD = -0.35
MIN_WORDS = 50
#: A position in a text takes so many low bits of the packed window codes.
_POSITION_BITS = 31

SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def _pairs(left: Column, right: Column, skip: int, body) -> Column:
    """``body`` of each element of ``left`` and the element of ``right`` that stands ``skip`` places further on."""
    n = F.greatest(F.size(right) - skip, F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, skip + 1, n), body)


def _word_code(word: Column) -> Column:
    return F.xxhash64(word)


def _ending_code(word: Column) -> Column:
    return F.xxhash64(F.right(word, F.lit(2)), F.lit(1))


def _two(codes: Column) -> Column:
    """Codes of two consecutive words, from those of the words."""
    return _pairs(codes, codes, 1, lambda a, b: F.xxhash64(a, b))


def _bucket(code: Column) -> Column:
    return F.pmod(code, F.lit(BUCKETS)).cast("int")


def trusted_ids(labels: DataFrame, bound: int = TRUSTED_BOUND) -> DataFrame:
    """Ids of the documents labelled as good, ``bound`` at most, chosen by the hash of the id."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def log_ratios(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """log(p_trusted / p_corpus) of each bucket; ``trusted`` holds TRUSTED_BOUND ids at most and is broadcast."""
    marked = docs.join(F.broadcast(trusted.withColumn("_good", F.lit(1))), "doc_id", "left")
    step = marked.select("_good", words(F.col("text")).alias("_w"))
    step = step.select("_good", F.transform("_w", _word_code).alias("_u"), F.transform("_w", _ending_code).alias("_e"))
    grams = step.select("_good", F.explode(F.concat("_u", "_e", _two(F.col("_u")))).alias("code"))
    found = grams.groupBy(_bucket(F.col("code")).alias("bucket")).agg(F.count("*").alias("n"), F.count("_good").alias("good"))
    rows = found.collect()  # BUCKETS rows at most
    all_n, all_good = sum(r.n for r in rows), sum(r.good for r in rows)
    ratios = [0.0] * BUCKETS
    if all_good:
        good_weight, weight = math.log(all_good + SMOOTHING * BUCKETS), math.log(all_n + SMOOTHING * BUCKETS)
        for r in rows:
            ratios[r.bucket] = round(math.log(r.good + SMOOTHING) - good_weight - math.log(r.n + SMOOTHING) + weight, 9)
    return ratios


def _repeated(codes: Column) -> Column:
    """Ascending positions whose 64-bit code stands at two positions or more.

    Codes are sorted as one long each (upper bits of the code, position); neighbours with equal upper
    bits are candidates, and only those are sorted by their whole codes.
    """
    low = (1 << _POSITION_BITS) - 1
    packed = F.sort_array(F.transform(codes, lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
    same = lambda a, b: a.bitwiseXOR(b).between(0, low)
    later = lambda s: F.array_compact(_pairs(s, s, 1, lambda a, b: F.when(same(a, b), b)))
    earlier = lambda s: F.array_compact(_pairs(s, s, 1, lambda a, b: F.when(same(a, b), a)))
    place = lambda x: x.bitwiseAND(F.lit(low)).cast("int")

    code = lambda x: F.get(codes, place(x))

    def exact(c: Column) -> Column:
        found = F.sort_array(F.transform(c, lambda x: F.struct(code(x).alias("h"), place(x).alias("p"))))
        equal = lambda x, y: y.isNotNull() & (x["h"] == y["h"])
        twice = _let(found, lambda s: F.filter(s, lambda x, i: equal(x, F.get(s, i + 1)) | ((i > 0) & equal(x, F.get(s, F.greatest(i - 1, F.lit(0)))))))
        return F.sort_array(F.transform(twice, lambda x: x["p"]))

    def positions(c: Column) -> Column:
        """Different codes with equal upper bits are rare; only then the candidates are sorted by whole codes."""
        n = lambda value: F.size(F.array_distinct(F.transform(c, value)))
        clean = n(code) == n(lambda x: F.shiftright(x, _POSITION_BITS))
        return F.when(clean, F.sort_array(F.transform(c, place))).otherwise(exact(c))

    def candidates(s: Column) -> Column:
        return _let(later(s), lambda x: F.when(F.size(x) > 0, _let(F.array_union(x, earlier(s)), positions)))

    return _let(packed, candidates)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _symbols(text: Column) -> Column:
    plain = text
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    return F.coalesce(F.length(text) - F.length(plain), F.lit(0)).cast("long")


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    return F.coalesce(_let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("long")


def _repeat_words(threes: Column) -> Column:
    """Words covered by repeated windows of three words: the union of [p, p + 3) over their positions."""
    covered = _let(
        _repeated(threes),
        lambda p: F.aggregate(
            _pairs(p, p, 1, lambda a, b: F.least(F.lit(3), b - a)), F.when(F.size(p) > 0, 3).otherwise(0), lambda s, x: s + x
        ),
    )
    return F.coalesce(covered, F.lit(0)).cast("long")


def quality(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """Base counts, score and verdict of each row of ``docs``, with the columns named in ``keep``.

    Each step drops what the next ones don't need, so no array is carried further than it is used.
    """
    ratio = F.split(F.lit(", ".join(map(str, ratios))), ", ").cast("array<double>")
    add = lambda code: lambda s, x: s + F.get(ratio, _bucket(code(x)))
    total = lambda items, code=lambda x: x: F.aggregate(items, F.lit(0.0), add(code))
    text = F.col("text")
    columns = list(dict.fromkeys(["doc_id", *keep]))
    step = docs.select(*columns, _symbols(text).alias("n_symbols"), _dup_lines(text).alias("n_dup_lines"), words(text).alias("_w"))
    counts = ["n_symbols", "n_dup_lines"]
    step = step.select(
        *columns,
        *counts,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        total(F.col("_w"), _ending_code).alias("_se"),
        F.transform("_w", _word_code).alias("_u"),
    )
    counts += ["n_words", "word_chars"]
    step = step.select(*columns, *counts, (F.col("_se") + total(F.col("_u"))).alias("_sum"), "_u", _two(F.col("_u")).alias("_b"))
    step = step.select(
        *columns,
        *counts,
        (F.col("_sum") + total(F.col("_b"))).alias("_sum"),
        _pairs(F.col("_b"), F.col("_u"), 2, lambda a, b: F.xxhash64(a, b)).alias("_t"),
    )
    n = 3 * F.col("n_words") - 1
    scored = step.select(
        *columns,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        _repeat_words(F.col("_t")).alias("n_repeat_words"),
        F.when(F.col("n_words") > 0, F.round(F.col("_sum") / n, 6)).otherwise(0.0).alias("score"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def rate(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, keep: tuple[str, ...] = ()) -> DataFrame:
    """``quality`` with ratios from all of ``docs`` and its documents that ``labels`` trusts."""
    return quality(docs, log_ratios(docs, trusted_ids(labels)), threshold, keep)
