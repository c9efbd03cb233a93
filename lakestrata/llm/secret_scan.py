"""Secret scans: patterns, and guess costs of values in a credential context.

Three patterns give the base spans. The method adds values that a wider context
introduces (a credential's name and ``:`` or ``=``, or the password of a URL)
and that are hard to guess: dynamic programming over the value finds its
cheapest segmentation, where a segment's guesses are

* a word: all words of the corpus over the word's count there, and the number
  of ways to write as many capitals;
* a date or a year: the days (150 years of 365), the separators;
* a repeat: the offset (16) and the length (100) of a copy of what stands before;
* a keyboard walk: the 47 keys, and the 8 directions for each turn;
* brute force: the size of its class (26, 26, 10, 33, 100) for each character;

times the five kinds. All but words and dates extend from character to
character, so the time is linear in the value's length.

The words come from all documents, without the words of the values themselves.
Only the letter pieces of the distinct values are counted: they are broadcast
to the words where their number is within ``BROADCAST_PIECES``, else the words
are counted per task first and joined by a shuffle.

Defined cases: null and empty texts have no spans; rows with equal or null ids
are scanned one by one; an added span is dropped only where it lies within a
base span; places are code points of the whole text; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import common as C

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# a run that is too short holds no shorter match that is long enough, so the lengths can stand in the patterns
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{12,}"), re.compile(r"[0-9a-f]{32,}")
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|(?:api|access|private)[_-]?key|credentials?|authorization)["']?\x20*(?::=|=>|[:=])\x20*"""
    r"""(?:(?:bearer|basic)\x20+)?(?:"([^"\s]+)"|'([^'\s]+)'|([^\s"'<>,;]+))|://[^\s:/@]*:([^\s/@]+)@""", re.I | re.A)
#: What any match has in it (for the quick look at a whole text).
HINT = r"pass(word|wd|phrase|code)|pwd|secret|token|key|credential|authorization|akia|://|[0-9a-f]{32}"
#: log10 of the guesses from which a value counts as a secret.
THRESHOLD = 10.0
SHORT_WORD, LONG_WORD, BROADCAST_PIECES = 3, 24, 200_000

# --- guess cost -------------------------------------------------------------------

#: The keys of a US keyboard, row by row.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
#: What the shift key gives, row by row.
SHIFTED = ("~!@#$%^&*()_+", "QWERTYUIOP{}|", "ASDFGHJKL:\"", "ZXCVBNM<>?")
#: Rows below the first start one key in, so a key's neighbours are those one step away in slanted places.
PLACE = {key: (x + (y > 0), y) for keys in (ROWS, SHIFTED) for y, row in enumerate(keys) for x, key in enumerate(row)}
STEPS = {(-1, 0), (1, 0), (0, -1), (1, -1), (0, 1), (-1, 1), (0, 0)}
DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01]))?|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d")
KIND, TURN, COPY, OFFSETS = math.log10(5), math.log10(8), math.log10(1600), 16


def _class_cost(c: str) -> float:
    if c.isascii():
        return math.log10(26 if c.isalpha() else 10 if c.isdigit() else 33)
    return 2.0


def _lower(value: str) -> str:
    """Lower case, character for character."""
    return "".join(x if len(x := c.lower()) == 1 else c for c in value)


def _capitals(word: str) -> float:
    """log10 of the ways to write a word with at most as many capitals."""
    up = sum(c.isupper() for c in word)
    if up == 0:
        return 0.0
    if up == len(word) or (up == 1 and word[0].isupper()):
        return math.log10(2)
    return math.log10(sum(math.comb(len(word), k) for k in range(1, min(up, len(word) - up) + 1)))


def log_guesses(value: str, words: dict[str, float]) -> float:
    """log10 of the guesses of the cheapest segmentation; ``words`` has the log10 guesses of each known word."""
    n, low = len(value), _lower(value)
    inf = math.inf
    best, brute, walk = [0.0] + [inf] * n, [inf] * (n + 1), [inf] * (n + 1)
    copy = [[inf] * (n + 1) for _ in range(OFFSETS + 1)] if n > 1 else []
    dates: dict[int, list[tuple[int, float]]] = {}
    for i, c in enumerate(value):
        if c in "0123456789" and (m := DATE.match(value, i)):
            cost = math.log10(150) + (math.log10(365) if m.end() - i > 4 else 0) + (math.log10(4) if m[1] or m[2] else 0)
            dates.setdefault(m.end(), []).append((i, cost))
    step = None
    for j in range(1, n + 1):
        c = value[j - 1]
        brute[j] = min(brute[j - 1], best[j - 1] + KIND) + _class_cost(c)
        got = brute[j]
        for i, cost in dates.get(j, ()):
            got = min(got, best[i] + KIND + cost)
        for size in range(SHORT_WORD, min(j, LONG_WORD) + 1):
            if (cost := words.get(low[j - size: j])) is not None:
                got = min(got, best[j - size] + KIND + cost + _capitals(value[j - size: j]))
        if j > 1:
            a, b = PLACE.get(value[j - 2]), PLACE.get(c)
            last, step = step, ((b[0] - a[0], b[1] - a[1]) if a and b else None)
            if step in STEPS:
                on = walk[j - 1] + (0.0 if step == last else TURN)  # three keys or more
                got = min(got, on)
                walk[j] = min(on, best[j - 2] + KIND + math.log10(47) + TURN)
            for p in range(1, min(OFFSETS, j - 1) + 1):
                if value[j - 1 - p] == c:
                    row = copy[p]
                    row[j] = min(row[j - 1], best[j - 1] + KIND + COPY)
                    got = min(got, row[j])
        best[j] = got
    return best[n]


def pieces(value: str) -> set[str]:
    """The letter substrings of a value that may be words."""
    out = set()
    for run in re.findall("[a-zà-ÿ]+", _lower(value)):
        for size in range(SHORT_WORD, min(len(run), LONG_WORD) + 1):
            out.update(run[i: i + size] for i in range(len(run) - size + 1))
    return out


# --- scan ---------------------------------------------------------------------------

def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def context_values(text: str) -> list[tuple[int, int, str]]:
    """(start, end, value) of what stands in a credential context."""
    return [(m.start(m.lastindex), m.end(m.lastindex), m[m.lastindex]) for m in CONTEXT.finditer(text)]


SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
VALUE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])


def _scan(texts: pa.Array) -> list[pa.Array]:
    hint = pc.match_substring_regex(texts, HINT, ignore_case=True).to_numpy(zero_copy_only=False)
    spans, values = [[]] * len(texts), [[]] * len(texts)
    for k in np.flatnonzero(hint):
        text = texts[int(k)].as_py()
        spans[k] = [dict(zip(("start", "kind", "end"), s)) for s in base_spans(text)]
        values[k] = [dict(zip(("start", "end", "value"), v)) for v in context_values(text)]
    return [pa.array(spans, pa.list_(SPAN)), pa.array(values, pa.list_(VALUE))]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, base, found): base spans and context values of every text; ``row`` numbers the rows."""
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = "base array<struct<start:int,kind:int,end:int>>, found array<struct<start:int,end:int,value:string>>"
    out = C.annotated(slim, "text", "scan", fields, _scan)
    return out.select("row", "id", "scan.base", "scan.found")


def corpus_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word): all runs of at least SHORT_WORD letters, in lower case."""
    return docs.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(f"[a-zà-ÿ]{{{SHORT_WORD},}}"), F.lit(0))).alias("word"))


def piece_counts(words: DataFrame, wanted: DataFrame, few: int = BROADCAST_PIECES) -> tuple[DataFrame, int]:
    """(word, n) of the ``wanted`` words in the corpus, and the number of all its words."""
    if wanted.count() <= few:  # of LONG_WORD letters at most
        known = wanted.select(F.col("word").alias("piece"))
        counts = words.join(F.broadcast(known), words["word"] == known["piece"], "left").groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
        counts = C.written(counts.withColumnRenamed("piece", "word"), "secret-words")
        kept = counts.where("word IS NOT NULL")
    else:
        counts = C.written(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "secret-words")
        kept = counts.join(wanted.select("word"), "word", "left_semi")
    return kept, counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]


def value_costs(values: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(value, log_guesses) of the distinct ``values`` (value, n); words are counted in ``docs``."""
    def cut(batches):
        for b in batches:
            for value, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = Counter(w for w in re.findall("[a-zà-ÿ]+", _lower(value)) if len(w) >= SHORT_WORD)
                got = sorted(pieces(value))
                for k in range(0, len(got), 10_000):
                    part = got[k: k + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([value] * len(part)), pa.array(part), pa.array([n * own[w] for w in part], pa.int64())],
                        names=["value", "word", "own"])

    cuts = C.written(values.select("value", "n").mapInArrow(cut, "value string, word string, own long"), "secret-pieces")
    wanted = C.written(cuts.groupBy("word").agg(F.sum("own").alias("own")), "secret-wanted")
    counts, total = piece_counts(corpus_words(docs, text_col), wanted)
    known = counts.join(wanted, "word").where("n > own").select("word", F.log10(F.lit(float(max(total, 1))) / (F.col("n") - F.col("own"))).alias("cost"))
    listed = cuts.join(known, "word").groupBy("value").agg(F.collect_list(F.struct("word", "cost")).alias("words"))

    def cost(batches):
        for b in batches:
            got = [log_guesses(v, {x["word"]: x["cost"] for x in w or ()}) for v, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], names=["value", "log_guesses"])

    return values.join(listed, "value", "left").select("value", "words").mapInArrow(cost, "value string, log_guesses double")


def _joined(spans):
    """``kind:start:end`` of all spans, in order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans, n_values, log_guesses) of every row: base spans, all spans, context values and the greatest guess cost of one."""
    rows = C.written(scan(docs, id_col, text_col), "secret-scan")
    met = rows.where(F.size("found") > 0).select("row", "id", "base", F.explode("found").alias("v")).select("row", "id", "base", "v.*")
    values = C.written(met.groupBy("value").agg(F.count(F.lit(1)).alias("n")), "secret-values")
    costs = C.written(value_costs(values, docs, text_col), "secret-costs")
    inside = F.exists("base", lambda b: (b["start"] <= F.col("start")) & (F.col("end") <= b["end"]))
    span = F.when((F.col("log_guesses") >= threshold) & ~inside, F.struct("start", F.lit(3).alias("kind"), "end"))
    judged = met.join(costs, "value").withColumn("added", span).groupBy("row").agg(
        F.first("id").alias("id"), F.first("base").alias("base"), F.collect_list("added").alias("added"),
        F.count(F.lit(1)).alias("n_values"), F.max("log_guesses").alias("log_guesses"))
    return judged.select("id", "base", F.array_sort(F.concat("base", "added")).alias("spans"), "n_values", "log_guesses").unionByName(
        rows.where(F.size("found") == 0).select("id", "base", F.col("base").alias("spans"), F.lit(0).cast("long").alias("n_values"),
                                                F.lit(None).cast("double").alias("log_guesses")))


def query(spark, sf_dir: str) -> DataFrame:
    found = secrets(C.documents(spark, sf_dir))

    def number(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"), number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        number(3).alias("n_guess"), "n_values", F.col("log_guesses").alias("max_log10_guesses"))
