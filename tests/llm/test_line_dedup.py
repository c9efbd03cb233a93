import hashlib
import random
import re

from pyspark.sql import functions as F

from lakestrata.llm import line_dedup as D
from tests.llm.conftest import words


def brute(rows, k=D.MIN_LINES, most=D.MIN_WORDS):
    """(n_removed, kept text) for each distinct (id, text)."""
    def order(r):
        return (r[0] is not None, r[0] or 0)

    texts = sorted({(i, t) for i, t in rows if t is not None}, key=order)
    assert len({i for i, _ in texts}) == len(texts)  # ids name texts here
    seen, gone = set(), {}
    lines = {i: [(n, x) for n, x in enumerate(t.split("\n")) if words(x)] for i, t in texts}
    for i, _ in texts:
        drop = set()
        for p in range(len(lines[i])):
            run = tuple(x for _, x in lines[i][p:p + k])
            if len(run) == k:
                drop |= {p + j for j in range(k)} if run in seen else set()
                seen.add(run)
            one = lines[i][p][1]
            if len(words(one)) >= most:
                drop |= {p} if (one,) in seen else set()
                seen.add((one,))
        gone[i] = {lines[i][p][0] for p in drop}
    out = {}
    for i, t in texts:
        kept = [x for n, x in enumerate(t.split("\n")) if n not in gone[i]]
        out[i] = (len(gone[i]), t if not gone[i] else "\n".join(kept) if any(words(x) for x in kept) else "")
    return out


def check(rows, found, name):
    want = brute(rows)
    out = found.select("doc_id", "text", f"{name}.*").collect()
    assert len(out) == len(rows)
    for r in out:
        if r.text is None:
            assert (r.n_lines, r.n_removed) == (0, 0)
        else:
            assert (r.n_removed, r.text) == want[r.doc_id], r.doc_id


def test_edges(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    found, name = D.line_dedup(docs)
    assert found.columns == [*docs.columns, name] and name not in docs.columns
    check(edge_rows, found, name)
    empty, name = D.line_dedup(make_docs([]))
    assert empty.count() == 0


def test_repeats_ties_and_blank_lines(make_docs):
    rng = random.Random(4)
    pool = ["a", "b", "c", "", "  ", "long " * 25, "tail x", "d"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(120)]
    rows += [(500, "hot\n" * 400), (501, "hot\n" * 3)]
    rows += [(600 + k, "hot line\nnext %d\nhot line" % (k % 3)) for k in range(100)]
    check(rows, *D.line_dedup(make_docs(rows, 5)))


def test_other_lengths(make_docs):
    rows = [(1, "a\nb\nc\nd\ne\nf"), (2, "x\na\nb\nc\nd\ny"), (3, "b\nc\nd\ne\nf\na")]
    for k in (1, 2, 4, 5):
        found, name = D.line_dedup(make_docs(rows), min_lines=k)
        want = brute(rows, k)
        assert {r.doc_id: (r[name].n_removed, r.text) for r in found.collect()} == want


def test_maximal_runs(make_docs):
    rng = random.Random(11)
    base = ["line %d" % rng.randint(0, 3) for _ in range(90)]
    rows = [(k, "\n".join(base[rng.randint(0, 40):rng.randint(50, 90)] + [f"own {k}"] + base[:rng.randint(0, 30)]))
            for k in range(25)]
    rows += [(30, "\n".join(base)), (31, "hot\n" * 200), (32, "one\ntwo"), (None, "\n".join(base)), (33, "\n".join(base))]
    rows += [rows[3], rows[-1]]  # repeated rows are one text
    lines = {i: [x for x in t.split("\n") if words(x)] for i, t in rows}
    docs = make_docs(rows, 4).select(F.col("doc_id").alias("id"), "text")
    for least in (1, 3, 5):
        found = D.ranked_suffixes(docs, least)
        assert found[-1][0] >= 90  # doubled up to the longest repeat: line "hot", 199 times
        runs = D.maximal_runs(found, least).collect()
        covered = {}
        for r in runs:
            a, b = lines[r.id][r.pos:], lines[r.source.id][r.source.pos:]
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert r.length == same >= least
            covered.setdefault(r.id, set()).update(range(r.pos, r.pos + r.length))
        assert len({(r.id, r.pos) for r in runs}) == len(runs)
        want = brute([*{i: (i, t) for i, t in rows}.values()], least, 10 ** 9)
        assert {i: n for i, (n, _) in want.items() if n} == {i: len(x) for i, x in covered.items()}


def test_no_repeated_line(make_docs):
    docs = make_docs([(1, "a\nb"), (2, "c"), (3, None), (1, "a\nb")])
    found, name = D.line_dedup(docs)
    assert D.ranked_suffixes(docs.select(F.col("doc_id").alias("id"), "text")) == []
    assert sorted((r.doc_id, r.text, r[name].n_removed) for r in found.collect() if r.text) == [
        (1, "a\nb", 0), (1, "a\nb", 0), (2, "c", 0)]


def test_documents(spark, sf_dir, small_docs):
    want = brute([(i, t) for i, t, _ in small_docs])
    out = D.query(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in out} == \
        {i: (n, hashlib.sha256(t.encode()).hexdigest()) for i, (n, t) in want.items()}


def test_plan_is_native(spark, sf_dir):
    plan = D.query(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
