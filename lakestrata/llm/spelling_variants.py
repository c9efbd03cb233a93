"""Spelling variants: words one edit apart, found by PartEnum signatures.

A word's letters form a multiset, written as a binary vector over (letter,
how-manieth of its kind). One inserted or deleted letter changes one bit, one
replaced letter two, so near words have Hamming distance two or less. PartEnum
parts the dimensions into ``PARTS`` pieces; at most two of them differ, so at
least one choice of PARTS - 2 pieces is equal in both words, and every such
choice is a signature. A signature is bound to the word's first or last
``EDGE`` letters, which loses nothing: one edit leaves one of the two ends as
it is in words of at least 2 * EDGE letters. Signatures meet in an equi-join,
whose condition verifies the edit distance, so only near pairs leave it. Word
counts are summed per task before the shuffle.

Forms have at least ``ratio`` times the word's count, so following them ends;
roots come from pointer doubling, in the logarithm of the longest chain.

Defined cases: a null text has no words; a null id counts as the empty text in
the noise hash; repeated rows count as often as they are there; of near words
with equal counts the smallest in code-point order is the form; an empty table
gives an empty result; other columns are ignored. The runs of one text are
held at once, about twenty times its size.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import common as C

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Pieces that a letter vector is parted into; letters of a word's ends that a signature is bound to.
PARTS, EDGE = 4, 3


def runs(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word): the maximal letter runs of at least ``least`` code points, A-Z in lower case."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))
    return docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("word")).select(
        "id", F.translate("word", UPPER, LOWER).alias("word"))


def with_noise(words: DataFrame, every: int) -> DataFrame:
    """(word): where ``every`` divides the crc32 of ``id:word``, one code point is deleted."""
    h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
    at = (F.col("h") % F.char_length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
    return words.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("word")).alias("word"))


def word_counts(docs: DataFrame, min_length: int = 6, min_count: int = 5, noise: int = 199, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n) of the words long and frequent enough, over all documents."""
    words = with_noise(runs(docs, min_length, id_col, text_col), noise).where(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _let(value: Column, body) -> Column:
    """``body`` over a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def signatures(word: Column, parts: int = PARTS, edge: int = EDGE) -> Column:
    """Array of the 64-bit signatures of a word."""
    ends = (F.substring(word, F.lit(1), F.lit(edge)), F.substring(word, F.char_length(word) - edge + 1, F.lit(edge)))
    chosen = list(combinations(range(parts), parts - 2))

    def pieces(bits: Column) -> Column:
        def piece(j: int) -> Column:
            return F.array_join(F.filter(bits, lambda b: F.pmod(F.xxhash64(b), F.lit(parts)) == j), "")
        return F.array(*[piece(j) for j in range(parts)])

    def signed(p: Column) -> Column:
        return F.array(*[F.xxhash64(F.lit(2 * k + side), end, *[F.get(p, F.lit(j)) for j in some])
                         for k, some in enumerate(chosen) for side, end in enumerate(ends)])

    def bits(letters: Column) -> Column:
        return F.transform(letters, lambda x, i: F.concat(x, (i + 1 - F.array_position(letters, x)).cast("string")))

    letters = F.array_sort(F.transform(F.sequence(F.lit(1), F.char_length(word)), lambda i: F.substring(word, i, F.lit(1))))
    return _let(letters, lambda x: _let(bits(x), lambda y: _let(pieces(y), signed)))


def near_pairs(words: DataFrame, parts: int = PARTS, edge: int = EDGE) -> DataFrame:
    """(u, v, nu, nv), u < v: each pair of words that differ by one edit, once. Words have 2 * ``edge`` code points or more."""
    signed = words.select(F.explode(signatures(F.col("word"), parts, edge)).alias("key"), "word", "n")
    a = signed.select("key", F.col("word").alias("u"), F.col("n").alias("nu"))
    b = signed.select("key", F.col("word").alias("v"), F.col("n").alias("nv"))
    # equal lengths and counts are cheap to hold against each other; the distance is computed for what is left
    close = F.abs(F.char_length("u") - F.char_length("v")) <= 1
    met = a.hint("merge").join(b, (a["key"] == b["key"]) & (F.col("u") < F.col("v")) & close & (F.levenshtein("u", "v", 1) == 1))
    return met.groupBy("u", "v").agg(F.first("nu").alias("nu"), F.first("nv").alias("nv"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words of ``forms`` (word, form): the last form reached."""
    now = C.written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        then = C.written(now.join(up, now["root"] == up["at"], "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if then.where("moved").limit(1).count() == 0:
            return then.select("word", "root")
        now = then.select("word", "root")


def spelling_variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, ratio: int = 5, noise: int = 199,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that counts."""
    words = C.written(word_counts(docs, min_length, min_count, noise, id_col, text_col), "spelling-words")
    pairs = near_pairs(words, edge=min(EDGE, min_length // 2))
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("u").alias("word"), F.col("v").alias("near"), F.col("nv").alias("near_n")),
        F.struct(F.col("v").alias("word"), F.col("u").alias("near"), F.col("nu").alias("near_n")))).alias("p")).select("p.*")
    top = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    joined = words.join(top, "word", "left")
    good = -F.col("top.less") >= ratio * F.col("n")
    named = C.written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("top.near")).alias("form"),
                                    F.when(good, -F.col("top.less")).alias("form_n")), "spelling-forms")
    last = roots(named.where("form IS NOT NULL"))
    return named.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(C.documents(spark, sf_dir))
