"""Licence scans: passages compared to licence templates by bigram Dice.

The passages of a text are its lines, its paragraphs (parted by lines without
a letter or digit) and the whole text. A passage is normalised (A-Z in lower
case, all but letters a-z and digits as one space) and becomes the set of its
word bigrams. For each template, the sizes alone bound the Dice coefficient
2|A n B| / (|A| + |B|): a template is compared only if the smaller set is at
least t / (2 - t) of the larger. Everything is one projection of built-in
higher-order functions inside the scan: no shuffle and no Python.

The bigrams of a passage are bigrams of its text, so a template can only be
matched where the text has t / (2 - t) of its n bigrams; one intersection with
all templates' bigrams tells which ones these are, and for most texts there is
none. Each of them is also looked for in runs of words, across lines and
paragraphs or inside a longer line; a run that scores more than the passages is
one more match. A run grows no worse by bigrams of the template, so only ends of
stretches of such bigrams are tried; up to n (1 / (t / (2 - t)) - 1) other
bigrams, counted with repeats, may lie inside, and as each gap between stretches
holds one at least, a begin has no more ends than that: the runs tried grow in
proportion to the text. The oracle SQL knows passages only: texts in which a run
scores more than they do differ from it.

Defined cases: null and empty texts and passages of fewer than two words match
nothing; of equal scores the first template name wins; repeated rows are
judged one by one; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import common as C
from lakestrata.llm.license_templates import TEMPLATES

THRESHOLD = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_bigrams(templates: dict[str, str]) -> dict[str, list[str]]:
    """The bigram sets of the templates, in the normal form of passages."""
    out = {}
    for name, text in sorted(templates.items()):
        words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
        out[name] = list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))
    return out


def _let(value: Column, body) -> Column:
    """``body`` over a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _in_order(passage: Column) -> Column:
    return _let(
        F.split(passage, " "),
        lambda w: F.zip_with(
            F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
            lambda a, b: F.concat(a, F.lit(" "), b)))


def _bigrams(passage: Column) -> Column:
    return F.array_distinct(_in_order(passage))


def _plain(text: Column) -> Column:
    plain = F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9\n]+", " ")
    return F.coalesce(F.regexp_replace(plain, " ?\n ?", "\n"), F.lit(""))


def _flat(plain: Column) -> Column:
    return F.trim(F.regexp_replace(plain, "[ \n]+", " "))


def _cut(plain: Column) -> Column:
    return F.filter(F.array_distinct(F.concat(
        F.transform(F.split(plain, "\n"), lambda x: F.trim(x)), F.transform(F.split(plain, "\n\n+"), _flat),
        F.array(_flat(plain)))), lambda x: F.contains(x, F.lit(" ")))


def passages(text: Column) -> Column:
    """Normalised lines, paragraphs and the whole of a text, without repeats."""
    return _let(_plain(text), _cut)


def _best_run(grams: Column, t: Column, score, least: float) -> Column:
    """The highest score of a run of a text's bigrams (in their order, with repeats) with one template."""
    others = t["n"] * F.lit(1 / least - 1) + F.lit(1e-9)

    def of_hits(hit):  # numbers of the hits that begin and that end a stretch
        every = F.sequence(F.lit(1), F.size(hit))
        first = F.filter(every, lambda j: (j == 1) | (hit[j - 1] - hit[F.greatest(j - 2, F.lit(0))] > 1))
        last = F.filter(every, lambda j: (j == F.size(hit)) | (hit[F.least(j, F.size(hit) - 1)] - hit[j - 1] > 1))
        return _let(first, lambda begin: _let(last, lambda end: of_stretches(hit, begin, end)))

    def of_stretches(hit, begin, end):
        def runs(k):
            i = begin[k - 1]

            def fits(j):
                own = j - i + 1
                return (own >= t["n"] * F.lit(least) - F.lit(1e-9)) & (hit[j - 1] - hit[i - 1] + 1 - own <= others)

            return F.array_max(F.transform(
                F.filter(F.slice(end, k, F.floor(others).cast("int") + 1), fits),
                lambda j: score(t, F.array_distinct(F.slice(grams, hit[i - 1], hit[j - 1] - hit[i - 1] + 1)))))

        return F.array_max(F.transform(F.sequence(F.lit(1), F.size(begin)), runs))

    return _let(F.filter(F.sequence(F.lit(1), F.size(grams)), lambda i: F.array_contains(t["bigrams"], grams[i - 1])), of_hits)


def matches(text: Column, templates: dict[str, str], threshold: float) -> Column:
    """Array of (score, name) of all passages, and of runs of words, and templates at or over the threshold."""
    known = {k: v for k, v in template_bigrams(templates).items() if v}
    table = F.array(*(F.struct(F.lit(k).alias("name"), F.array(*map(F.lit, v)).alias("bigrams"), F.lit(len(v)).alias("n"))
                      for k, v in known.items()))
    pool = F.array(*map(F.lit, dict.fromkeys(b for v in known.values() for b in v)))
    least = threshold / (2 - threshold)

    def score(t, grams):
        small, large = F.least(F.size(grams), t["n"]), F.greatest(F.size(grams), t["n"])
        shared = F.size(F.array_intersect(t["bigrams"], grams))
        return F.when(small >= large * F.lit(least) - F.lit(1e-9), 2 * shared / (small + large)).otherwise(F.lit(0.0))

    def over(scores):
        return F.filter(scores, lambda m: m["score"] >= F.lit(threshold))

    def scored(likely, one):
        return over(F.transform(likely, lambda t: F.struct(one(t).alias("score"), t["name"].alias("name"))))

    def in_passages(plain, likely):
        return F.flatten(F.transform(_cut(plain), lambda x: _let(_bigrams(x), lambda g: scored(likely, lambda t: score(t, g)))))

    def in_runs(grams, likely, found):
        def best(name):
            return F.coalesce(F.array_max(F.transform(F.filter(found, lambda m: m["name"] == name), lambda m: m["score"])), F.lit(0.0))

        left = F.filter(likely, lambda t: best(t["name"]) < F.lit(1.0))
        return F.filter(scored(left, lambda t: _best_run(grams, t, score, least)), lambda m: m["score"] > best(m["name"]) + F.lit(1e-9))

    def in_text(plain, grams, likely):
        none = F.filter(F.array(F.struct(F.lit(0.0).alias("score"), F.lit("").alias("name"))), lambda m: F.lit(False))
        return F.when(F.size(likely) == 0, none).otherwise(
            _let(in_passages(plain, likely), lambda found: F.concat(found, in_runs(grams, likely, found))))

    def candidates(shared):
        return F.filter(table, lambda t: (F.size(shared) >= t["n"] * F.lit(least) - F.lit(1e-9))
                        & (F.size(F.array_intersect(t["bigrams"], shared)) >= t["n"] * F.lit(least) - F.lit(1e-9)))

    return _let(_plain(text), lambda p: _let(_in_order(_flat(p)), lambda grams: _let(
        _let(F.array_intersect(pool, grams), candidates), lambda likely: in_text(p, grams, likely))))


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, matches [(score, name)], licenses (sorted names), best_license, best_score of every row."""
    found = docs.select(F.col(id_col).alias(id_col), matches(F.col(text_col), templates, threshold).alias("matches"))
    best = F.array_max("matches.score")
    return found.select(
        id_col, "matches",
        F.array_sort(F.array_distinct("matches.name")).alias("licenses"),
        F.array_min(F.transform(F.filter("matches", lambda m: m["score"] == best), lambda m: m["name"])).alias("best_license"),
        best.alias("best_score"))


def query(spark, sf_dir: str) -> DataFrame:
    found = license_scan(C.documents(spark, sf_dir))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"),
                        F.concat_ws(",", "licenses").alias("licenses"), "best_license",
                        F.round("best_score", 9).alias("best_score"))


def sql(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same scan for DuckDB."""
    rows = ", ".join(f"('{k}', [{', '.join(repr(b) for b in v)}])" for k, v in template_bigrams(templates).items())
    return f"""
WITH templates(name, bigrams) AS (VALUES {rows}),
plain AS (
  SELECT doc_id, regexp_replace(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
         '[^a-z0-9' || chr(10) || ']+', ' ', 'g'), ' ?' || chr(10) || ' ?', chr(10), 'g') AS p,
         row_number() OVER () AS r
  FROM documents),
passages AS (
  SELECT DISTINCT r, x FROM (
    SELECT r, unnest(list_concat(
      list_transform(string_split(p, chr(10)), lambda x: trim(x)),
      list_transform(string_split_regex(p, chr(10) || chr(10) || '+'), lambda x: trim(regexp_replace(x, '[ ' || chr(10) || ']+', ' ', 'g'))),
      [trim(regexp_replace(p, '[ ' || chr(10) || ']+', ' ', 'g'))])) AS x
    FROM plain) WHERE contains(x, ' ')),
words AS (SELECT r, x, string_split(x, ' ') AS w FROM passages),
grams AS (
  SELECT r, x, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words),
scored AS (
  SELECT r, name, 2.0 * len(list_intersect(bigrams, g))::DOUBLE / (len(bigrams) + len(g)) AS score
  FROM grams JOIN templates ON len(g) BETWEEN len(bigrams) * {threshold / (2 - threshold) - 1e-6}
                                     AND len(bigrams) * {(2 - threshold) / threshold + 1e-6}),
found AS (SELECT r, name, score FROM scored WHERE score >= {threshold}),
best AS (SELECT r, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, max(score) AS s FROM found GROUP BY r),
named AS (SELECT found.r, min(name) AS best_license FROM found JOIN best ON found.r = best.r AND score = s GROUP BY found.r)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(licenses, '') AS licenses, best_license, round(s, 9) AS best_score
FROM plain LEFT JOIN best ON plain.r = best.r LEFT JOIN named ON plain.r = named.r
"""
