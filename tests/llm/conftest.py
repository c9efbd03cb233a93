import re

import pytest
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use for themselves
    T.StructField("id", T.StringType()), T.StructField("language", T.StringType()), T.StructField("rank", T.LongType()),
    T.StructField("contamination", T.StringType()), T.StructField("h", T.LongType()), T.StructField("line_dedup", T.StringType()),
])


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return WORD.findall(text or "")


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table with clashing extra columns from (doc_id, text) or (doc_id, text, lang) tuples."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), "x", None, 1, "c", None, "l") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts) if full else spark.createDataFrame([], DOCS)

    return make


@pytest.fixture(scope="session")
def small_docs(sf_dir):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    return [(r["doc_id"], r["text"], r["lang"]) for r in t]


#: Nulls, empty and blank texts, ties, repeated rows, odd characters, one word, one very long text.
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id here"), (None, None), (5, "a\x00b ▁x  y"),
    (6, "word " * 30_000), (7, "x" * 50_000), (8, "İß≠ 梦🙂 <|endoftext|> <s>"), (9, "a\n\n\nb\r\nc"), (10, "same text"), (11, "same text"),
]


@pytest.fixture(scope="session")
def edge_rows():
    return EDGES
