import random
import re
import zlib
from collections import Counter

from lakestrata.llm import spelling_variants as S
from tests.llm.conftest import lower


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, min_length=6, min_count=5, ratio=5, noise=199):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % noise == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= min_length and k >= min_count}
    out = {}
    for w, k in n.items():
        near = [v for v in n if one_edit(w, v)]
        top = min(near, key=lambda v: (-n[v], v), default=None)
        form = top if top is not None and n[top] >= ratio * k else None
        out[w] = [form, w, k, len(near), n[form] if form else None]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return sorted((w, *row) for w, row in out.items())


def found(docs, **how):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in S.spelling_variants(docs, **how).collect())


def key(rows):
    return [tuple("" if x is None else x for x in r) for r in rows]


def test_edges_match_brute_force(make_docs, edge_rows):
    rows = edge_rows + [(i, t) for i, t in (
        (20, "colour " * 200 + "color colors " * 30 + "colours colore kolour " * 6), (21, "straße Straße STRASSE strasse " * 8),
        (22, "naïvely naively NAÏVELY nàively " * 7), (23, "abcdef " * 625 + "abcdeg " * 125 + "abcdgg " * 25 + "abcggg " * 5),
        (24, "letter lettre " * 9), (25, "aaaaaa aaaaaaa aaaaaaaa " * 5), (25, "aaaaaa aaaaaaa aaaaaaaa " * 5), (26, "×÷×÷×÷ ×÷×÷×× " * 6))]
    want = brute(rows)
    assert key(found(make_docs(rows))) == key(want)
    roots = {w: r for w, _, r, *_ in want}
    assert roots["abcggg"] == "abcdef" and roots["colours"] == "colour"
    assert found(make_docs([])) == []


def test_noise_deletes_one_code_point(make_docs):
    rows = [(i, "überall misspelling") for i in range(1500)]
    want = brute(rows, noise=7, min_count=1)
    assert len(want) > 10 and key(found(make_docs(rows), noise=7, min_count=1)) == key(want)


def test_whole_small_table(make_docs, small_docs):
    rows = [(i, t) for i, t, _ in small_docs]
    assert key(found(make_docs(rows))) == key(brute(rows))


def test_pairs_are_exact(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(400)})
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    want = sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))
    assert len(want) > 200
    for parts in (4, 5):
        assert sorted((r.u, r.v) for r in S.near_pairs(table, parts).collect()) == want
