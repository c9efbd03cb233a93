import collections

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm import quality_rules as Q
from tests.llm.conftest import WORD, words


def brute(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    cover = {k + j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n#\t", max_size=40), max_size=8))
def test_counts_match_brute_force(texts):
    got = Q.count_texts(pa.array(texts, pa.string()))
    assert list(zip(*(got[k].tolist() for k in Q.COUNTS[:5]))) == [brute(t) for t in texts]


def test_edges_and_query_shape(spark, make_docs, edge_rows):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = Q.quality_rules(make_docs(edge_rows), labels).collect()
    assert len(out) == len(edge_rows)
    want = collections.Counter((i, *brute(t)) for i, t in edge_rows)
    assert collections.Counter((r.doc_id, *(r[k] for k in Q.COUNTS[:5])) for r in out) == want
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)  # nothing was learned
    assert Q.quality_rules(make_docs([]), labels).count() == 0


def test_learned_rules_find_junk_and_spare_clean(spark, make_docs):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, labels = [], []
    for k in range(240):
        w = rng.choice(vocabulary, 80).tolist()
        junk = k % 4 == 0
        rows.append((k, " | ".join(w) if junk else " ".join(w)))
        labels.append((k, 0 if junk else 1, 0))
    labels += [(0, None, None), (1, 0, 0)]  # a null label, and an id with contradicting labels
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    assert Q.learn(docs, table)
    kept = {r.doc_id: r.kept for r in Q.quality_rules(docs, table).collect()}
    assert all(kept[k] == (k % 4 != 0) for k in range(240))


def test_rules_become_one_jvm_expression(spark):
    rules = [[Q.Condition("upper_share", True, 0.5)], [Q.Condition("symbols_per_word", True, 0.2), Q.Condition("n_words", False, 90.0)]]
    counts = spark.createDataFrame([(1, 60, 100, 0, 0, 0, 90, 0, 60), (2, 60, 100, 30, 0, 0, 0, 0, 60), (3, 95, 100, 30, 0, 0, 0, 0, 60)],
                                   ["doc_id", *Q.COUNTS])
    out = Q.apply_rules(counts, rules)
    assert "Python" not in out._jdf.queryExecution().toString()
    assert [r.rule for r in out.orderBy("doc_id").collect()] == [1, 2, 0]


def test_sample_bound_is_kept():
    x = {"f": np.arange(50.0)}
    assert Q.learn_rules(x, np.zeros(50, bool), np.zeros(50, bool)) == []  # one class only
    rules = Q.learn_rules(x, np.arange(50) < 20, np.arange(50) % 3 == 2)
    assert rules and not rules[0][0].at_least
    assert pytest.approx(rules[0][0].threshold, abs=1.5) == 19.5


def test_rules_do_not_depend_on_the_order_of_repeated_ids(spark, make_docs):
    rows = [(k % 60, ("| " if k % 2 and k % 60 < 30 else "word ") * (60 + k % 7)) for k in range(240)]
    labels = spark.createDataFrame([(i, int(i >= 30)) for i in range(60)], "doc_id long, quality int")
    one, two = (Q.learn(make_docs(x, 4), labels) for x in (rows, rows[::-1]))
    assert one == two
