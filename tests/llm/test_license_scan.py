import re

from lakestrata.llm import license_scan as L
from lakestrata.llm.license_templates import TEMPLATES


def grams(text):
    w = re.sub(r"[^a-z0-9]+", " ", text.translate(str.maketrans(L.UPPER, L.LOWER))).split()
    return set(zip(w, w[1:]))


def brute(text):
    low = (text or "").translate(str.maketrans(L.UPPER, L.LOWER))
    plain = re.sub(" ?\n ?", "\n", re.sub("[^a-z0-9\n]+", " ", low))
    parts = {" ".join(p.split()) for p in [*plain.split("\n"), *re.split("\n\n+", plain), plain]}
    found = []
    for p in parts:
        for name, t in TEMPLATES.items():
            a, b = grams(p), grams(t)
            if a and 2 * len(a & b) / (len(a) + len(b)) >= 0.8:
                found.append((round(2 * len(a & b) / (len(a) + len(b)), 9), name))
    return sorted(found)


def rows():
    wrapped = "\n".join(re.findall(r".{1,60}(?:\s|$)", " ".join(TEMPLATES["mit"].split())))
    return [(20, "Some words\nReleased under the MIT License.\nmore"), (21, wrapped), (22, "intro here\n\n" + wrapped + "\n\nend of it"),
            (23, TEMPLATES["isc"].replace("purpose", "aim").upper()), (24, "all rights reserved all rights reserved"),
            (25, "All rights reserved.\nAll rights reserved.\nLicensed under CC BY-NC 4.0."), (26, "license")]


def test_matches_brute_force(make_docs, edge_rows):
    table = [*edge_rows, *rows()]
    out = L.license_scan(make_docs(table)).collect()
    assert sorted((str(r.doc_id), sorted((round(m.score, 9), m.name) for m in r.matches)) for r in out) == \
        sorted((str(i), with_runs(t)) for i, t in table)
    best = {r.doc_id: r.best_license for r in out}
    assert best[20] == "mit-line" and best[21] == "mit" and best[22] == "mit" and best[23] == "isc" and best[26] is None
    assert L.license_scan(make_docs([])).count() == 0


def all_runs(text, name):
    """The best Dice of any run of words with the bigrams of a template, with as many others as fit."""
    w = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    pairs, t = list(zip(w, w[1:])), grams(TEMPLATES[name])
    best = 0.0
    if len(t & set(pairs)) < len(t) * 2 / 3 - 1e-9:
        return best  # no run can reach 0.8
    for i in range(len(pairs)):
        run, others = set(), 0
        for p in pairs[i:]:
            run.add(p)
            others += p not in t
            if others > len(t) / 2:
                break
            best = max(best, 2 * len(run & t) / (len(run) + len(t)))
    return best


def with_runs(text):
    """What passages match, and the runs that score more than they do."""
    found = brute(text)
    for name in TEMPLATES:
        score = all_runs(text or "", name)
        if score >= 0.8 and score > max((s for s, n in found if n == name), default=0.0) + 1e-9:
            found.append((round(score, 9), name))
    return sorted(found)


def test_licences_in_their_usual_layout_within_longer_documents(make_docs):
    filler = " ".join(f"word{i}" for i in range(400))
    mit = " ".join(TEMPLATES["mit"].split())
    mit = mit.replace(" The above", "\n\nThe above").replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    bsd = " ".join(TEMPLATES["bsd-2-clause"].split()).replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n\n2. ")
    bsd = bsd.replace(" THIS SOFTWARE IS", "\n\nTHIS SOFTWARE IS").replace("COPYRIGHT HOLDERS", "REGENTS")
    gpl = " ".join(TEMPLATES["gpl-3.0-notice"].split())
    gpl = gpl.replace(" This program is distributed", "\n\nThis program is distributed").replace(" You should", "\n\nYou should")
    texts = {1: ("mit", mit), 2: ("bsd-2-clause", bsd), 3: ("gpl-3.0-notice", gpl),
             4: ("all-rights-reserved", "Copyright 2020 Example Inc. All rights reserved. And so on."),
             5: ("mit-line", "This small tool is released under the MIT License, and so on and on.")}
    table = [(k, f"{filler}\n\n{t}\n\n{filler}") for k, (_, t) in texts.items()]
    table += [(6, "all rights of all the others are all reserved rights"), (7, f"{filler} {filler}")]
    out = {r.doc_id: r for r in L.license_scan(make_docs(table)).collect()}
    for k, text in table:
        if k in texts:
            assert out[k].best_license == texts[k][0] and not brute(text)
            assert round(out[k].best_score, 9) == round(all_runs(text, texts[k][0]), 9)
        assert out[k].licenses == [n for n in sorted(TEMPLATES) if all_runs(text, n) >= 0.8]


def test_each_template_is_named_as_itself_and_not_as_its_neighbour(make_docs):
    filler = " ".join(f"word{i}" for i in range(300))
    names = sorted(TEMPLATES)
    table = [(k, f"{filler}\n\n{' '.join(TEMPLATES[n].split())}\n\n{filler}") for k, n in enumerate(names)]
    table += [(1_000 + k, f"{filler} {' '.join(TEMPLATES[n].split())} {filler}") for k, n in enumerate(names)]
    out = {r.doc_id: r for r in L.license_scan(make_docs(table)).collect()}
    part = {"apache-2.0-notice": "apache-2.0-line"}  # the line opens the notice: both score 1, the first name wins
    for k, row in out.items():
        assert row.best_license == part.get(names[k % 1_000], names[k % 1_000]) and row.best_score == 1.0
        assert names[k % 1_000] in row.licenses


def test_a_weak_passage_does_not_hide_a_better_run(make_docs):
    isc = " ".join(TEMPLATES["isc"].split())
    more = " ".join(f"word{i}" for i in range(44))
    row = L.license_scan(make_docs([(1, f"{isc} {more}")])).first()
    assert row.best_license == "isc" and row.best_score == 1.0 and row.licenses == ["isc"]


def test_runs_in_a_long_text_of_template_words(make_docs):
    import time

    bsd = re.sub(r"[^a-z0-9]+", " ", TEMPLATES["bsd-2-clause"].lower()).split()
    text = " ".join(f"{bsd[i % (len(bsd) - 1)]} {bsd[i % (len(bsd) - 1) + 1]} x{i}" for i in range(70_000))
    docs = make_docs([(1, text), (2, text + " " + TEMPLATES["isc"])], 2).cache()
    docs.count()
    begun = time.time()
    out = {r.doc_id: r.licenses for r in L.license_scan(docs).collect()}
    assert len(text) > 1_000_000 and out == {1: [], 2: ["isc"]}
    assert time.time() - begun < 60


def test_plan_is_native_and_has_no_shuffle(spark, sf_dir):
    plan = L.query(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Exchange", plan.split("Physical Plan")[-1])
