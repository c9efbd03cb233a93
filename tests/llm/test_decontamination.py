import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lakestrata.llm import decontamination as D
from tests.llm.conftest import lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items):
    w = WORD.findall(lower(text or ""))
    hit, found = set(), set()
    for item, t in items:
        v = WORD.findall(lower(t or ""))
        for k in range(max(1, len(v) - 9) if v else 0):
            x = v[k:k + 10]
            for a in range(len(w) - len(x) + 1):
                if w[a:a + len(x)] == x:
                    hit |= set(range(a, a + len(x)))
                    found.add("null" if item is None else str(item))
    return (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))


def test_index_against_naive_search():
    rng = np.random.default_rng(1)
    for n in (1, 2, 40, 400):
        text = np.append(rng.integers(1, 6, n), 0)
        assert D.suffix_array(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())
        index = D.FMIndex(text, sample=3)
        queries = [rng.integers(1, 8, m) for m in (1, 1, 2, 2, 3, 4)] + [text[:n][-5:]]
        symbols = np.zeros((len(queries), 5), np.int64)
        for k, q in enumerate(queries):
            symbols[k, :len(q)] = q[::-1]
        low, high = index.search(symbols, np.array([len(q) for q in queries]))
        for q, a, b in zip(queries, low, high):
            want = [i for i in range(n) if text[i:i + len(q)].tolist() == q.tolist()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def corpus():
    rng = random.Random(6)
    vocabulary = ["a", "b", "c", "dé", "e9"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(8, 14)))) for k in range(12)]
    items += [(50, "b"), (51, None), (52, "!!! ,"), (None, "zz yy"), (3, "second text of three"), (3, items[3][1]), (60, "Ünï, Cödé")]
    rows = [(100 + k, ", ".join(rng.choice([*vocabulary, "Q"]) for _ in range(rng.randint(0, 60)))) for k in range(60)]
    rows += [(300, "x " + items[0][1].upper().replace("É", "é") + " y " + items[1][1] + "-" + items[2][1]), (301, "ZZ...YY zz"), (302, "ünï cödé Ünï cödé")]
    return rows, items


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 60])
def test_matches_brute_force(spark, make_docs, edge_rows, block):
    rows, items = corpus()
    items = [x for x in items if x[0] != 50] if block > 100 else items
    rows = rows + edge_rows
    docs = make_docs(rows)
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, contamination string")
    found, name = D.decontaminate(docs, table, block_bytes=block)
    assert found.columns == [*docs.columns, name] and name not in docs.columns
    got = D.digest(found, name).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr((i, *brute(t, items))) for i, t in rows)
    # the cut texts hold no window any more that stood whole in them, and clean texts are as they were
    cut = D.without_spans(found, name)
    assert cut.columns == docs.columns
    clean = {(r.doc_id, r.text) for r in cut.collect()}
    for i, t in rows:
        n, hit = brute(t, items)[:2]
        if not hit:
            assert (i, t) in clean
        else:
            assert any(i == j and len(WORD.findall(lower(u))) == n - hit for j, u in clean)


def test_empty_inputs(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    found, name = D.decontaminate(make_docs([(1, "a b"), (2, None)]), none)
    assert [r.contaminated for r in D.digest(found, name).collect()] == [False, False]
    found, name = D.decontaminate(make_docs([]), none)
    assert found.count() == 0


def test_documents(spark, sf_dir, small_docs):
    import pyarrow.parquet as pq

    items = [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()]
    windows = {}
    for i, t in items:
        v = WORD.findall(lower(t))
        for k in range(max(1, len(v) - 9) if v else 0):
            windows.setdefault(tuple(v[k:k + 10]), set()).add(str(i))
    want = []
    for i, t, _ in small_docs:
        w = WORD.findall(lower(t))
        at = [k for k in range(len(w) - 9) if tuple(w[k:k + 10]) in windows]
        hit = {k + j for k in at for j in range(10)}
        found = set().union(*(windows[tuple(w[k:k + 10])] for k in at))
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert min(map(len, windows)) == 10
    assert sorted(tuple(r) for r in D.query(spark, sf_dir).collect()) == sorted(want)
    assert any(x[-1] for x in want)


def test_plain_keeps_byte_places():
    t = pa.array(["Aé-B\n", "", "ß_9"])
    assert D.plain(t).to_pylist() == ["aé b ", "", "ß 9"]
