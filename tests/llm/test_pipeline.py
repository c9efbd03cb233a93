import corpus_pipeline as P
from lakestrata.llm import common as C


def staged(spark, docs, sf_dir):
    out = [docs]
    for name, stage in P.STAGES:
        out.append(C.written(stage(spark, out[-1], sf_dir), name))
    return out


def test_stages_keep_columns_and_clean_rows(spark, sf_dir, make_docs, small_docs, edge_rows):
    rows = [*small_docs, *((i and i + 10_000, t) for i, t in edge_rows)]
    docs = make_docs(rows)
    out = staged(spark, docs, sf_dir)
    for df in out[1:-1]:
        assert df.columns == docs.columns
    counts = [df.count() for df in out[:-1]]
    assert counts == sorted(counts, reverse=True)
    packed = out[-1]
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in out[-2].select("doc_id").distinct().collect()}
    # a document whose text is like no other's keeps it through all stages
    alone = " ".join(f"uniqueword{k}" for k in range(60))
    again = staged(spark, make_docs([*rows, (99_999, alone, "en")]), sf_dir)
    assert {r.doc_id: r.text for r in again[-2].collect()}[99_999] == alone
    assert again[-2].count() == counts[-1] + 1


def test_empty_table(spark, sf_dir, make_docs):
    for df in staged(spark, make_docs([]), sf_dir):
        assert df.count() == 0


def test_run_equals_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = staged(spark, docs, sf_dir)[-1]
    assert sorted(P.run(spark, sf_dir).drop("sequence_id", "offset").collect()) == sorted(want.drop("sequence_id", "offset").collect())


def test_copies_and_leaks_go(spark, sf_dir, make_docs, small_docs):
    import pyarrow.parquet as pq

    item = pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()[0]["text"]
    base = small_docs[3]
    near = (80_002, base[1].replace(" ", "  ", 3) + " moreword", base[2])
    rows = [*small_docs, (80_001, base[1], base[2]), near, (80_003, "some words ahead " + item + " some words behind", "en")]
    texts = {r.doc_id: r.text for r in staged(spark, make_docs(rows), sf_dir)[-2].collect()}
    assert 80_001 not in texts and base[0] in texts
    assert 80_003 not in texts or item.split("\n")[0] not in texts[80_003]
