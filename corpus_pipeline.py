"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the rows that it keeps with
the columns of ``docs``; the last returns the packed pieces. A stage's
decisions take effect in its own output, which is written as Parquet and read
again before the next. Rows are never sampled or capped.

1. language id: rejected documents go (no letter, or unlike every language).
2. line dedup: later copies of repeated line runs are deleted; a document that
   loses its last line with a word goes.
3. SimHash near-dedup: one document of each class stays, the smallest id.
4. benchmark decontamination: the spans of benchmark passages are cut out; a
   document that loses its last word goes.
5. best-fit packing: what is left, as pieces in sequences of 2048 tokens.

Defined cases: null and empty texts are rejected by stage 1; an empty table
passes through all stages as one; other columns pass through to stage 5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import common, decontamination, language_id, line_dedup, packing, simhash


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    found, name = language_id.identify(docs, language_id.learn(docs))
    return found.where(~F.col(name)["rejected"]).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    found, name = line_dedup.line_dedup(docs)
    emptied = (F.col(name)["n_removed"] > 0) & ~F.col("text").rlike(line_dedup.WORD)
    return found.where(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return simhash.near_dedup(docs, shingle=4, bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    found, name = decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    all_hit = (F.col(name)["n_hit"] > 0) & (F.col(name)["n_hit"] == F.col(name)["n_words"])
    return decontamination.without_spans(found.where(~all_hit), name).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    common.prepare(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: SQL cannot express the learned language models or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.written(docs, name)
    return docs
