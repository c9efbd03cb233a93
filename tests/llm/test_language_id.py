import unicodedata
import zlib

import numpy as np
import pyarrow as pa

from lakestrata.llm import language_id as L


def slow_kn(train, text):
    """Kneser-Ney by dictionaries for one text; train is a list of texts."""
    def chars(t):
        s = "".join(c if c.isalpha() else " " for c in unicodedata.normalize("NFC", t).lower())
        return " " + " ".join(s.split()) + " " if s.split() else " "

    grams = {}
    for t in train:
        s = "   " + chars(t)
        for k in range(4, len(s)):
            grams[s[k - 3:k + 1]] = grams.get(s[k - 3:k + 1], 0) + 1
    levels, now = {}, grams
    for order in range(4, 0, -1):
        levels[order] = now
        below = {}
        for g in now:
            below[g[1:]] = below.get(g[1:], 0) + 1
        now = below
    symbols = max(2, len(levels[1]) + 1)

    def prob(g, order):
        if order == 0:
            return 1 / symbols
        level, part = levels[order], g[-order:]
        n1, n2 = sum(v == 1 for v in level.values()), sum(v == 2 for v in level.values())
        d = min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5
        own = {k: v for k, v in level.items() if k[:-1] == part[:-1]}
        total = sum(own.values())
        lower = prob(g, order - 1)
        return max(own.get(part, 0) - d, 0) / total + d * len(own) / total * lower if total else lower

    s = "   " + chars(text)
    return -np.mean([np.log(prob(s[k - 3:k + 1], 4)) for k in range(4, len(s))])


def test_entropy_matches_a_slow_model():
    train = ["The cat sat.", "the hat, the rat", "Été à la mer"]
    keys, _ = L.grams(pa.array(train))
    model = L.Model(["x"], [L.KneserNey(keys, np.ones(len(keys)))], np.zeros(1), np.ones(1))
    texts = ["that cat", "zzz", "La mère  a 12 chats!"]
    got = model.entropies(pa.array(texts))[0][:, 0]
    assert np.allclose(got, [slow_kn(train, t) for t in texts])


def test_probabilities_sum_to_one():
    keys, _ = L.grams(pa.array(["abab abba", "b a bb"]))
    m = L.KneserNey(keys, np.ones(len(keys)))
    context = np.uint64(ord("a") << 32 | ord("b") << 16)
    letters = [0x20, ord("a"), ord("b"), ord("q")]
    p = np.exp(m.log_prob(np.array([int(context) | x for x in letters], np.uint64)))
    assert abs(p.sum() - 1) < 1e-9


def test_held_out_accuracy_and_edges(spark, make_docs, edge_rows, small_docs):
    rows = [*small_docs, *((i and i + 10_000, t) for i, t in edge_rows), (30_000, "qzxv kjwq xzzq vvkq jjxz " * 40, None)]
    docs = make_docs(rows)
    model = L.learn(docs)
    found, name = L.identify(docs, model)
    assert found.columns[:-1] == docs.columns and name not in docs.columns
    out = found.select("doc_id", "lang", "text", f"{name}.*").collect()
    assert len(out) == len(rows)
    held = [r for r in out if r.lang and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert held and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert not any(r.rejected for r in out if r.lang)
    for r in out:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert 0 <= r.score <= 1 and (r.lang_pred != "und" or r.rejected)
    assert next(r for r in out if r.doc_id == 30_000).rejected


def test_without_labels_or_rows(make_docs):
    for rows in ([(1, "some text"), (2, None)], []):
        docs = make_docs(rows)
        found, name = L.identify(docs, L.learn(docs))
        assert sorted((r.doc_id, r.p, r.x) for r in found.selectExpr("doc_id", f"{name}.lang_pred p", f"{name}.rejected x").collect()) == \
            [(i, "und", t is None) for i, t in rows]


def test_prediction_ignores_labels(make_docs, small_docs):
    model = L.learn(make_docs(small_docs))
    blank = make_docs([(None, t, None) for _, t, _ in small_docs[:20]], 1)
    found, name = L.identify(blank, model)
    assert {r[0] for r in found.select(f"{name}.lang_pred").collect()} <= set(model.names)


def test_sample_of_repeated_ids_is_the_same_in_any_order(make_docs):
    rows = [(k % 40, f"text {chr(97 + k % 26)} {k}", "en" if k % 3 else "de") for k in range(400)]
    got = []
    for some in (rows, rows[::-1]):
        docs = make_docs([(i, t) for i, t, _ in some], 3).drop("lang")
        langs = {t: x for _, t, x in some}
        frame = docs.sparkSession.createDataFrame(list(langs.items()), "text string, lang string")
        found = L.sample(docs.select("doc_id", "text").join(frame, "text"), "doc_id", "text", "lang", 10, 1000).collect()
        got.append(sorted((r.id, r.lang, r.text, r["rank"], r.held) for r in found))
        assert 0 < len({(i, x) for i, x, *_ in got[-1]}) == len(found) <= 20
        assert all(t == min(u for i, u, y in rows if (i, y) == (d, x)) for d, x, t, *_ in got[-1])
    assert got[0] == got[1]
