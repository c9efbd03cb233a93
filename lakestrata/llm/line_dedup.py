"""Line dedup: repeated line runs by a distributed suffix array.

The lines of a text that have a word form a sequence of line ids. Prefix
doubling ranks the suffixes of all sequences by their first 1, 2, 4, ...
lines: the rank at depth 2h is the place of the pair (rank at depth h here,
rank at depth h from h lines on) in the sorted order of all such pairs. Ranks
are given to the distinct pairs, not to positions, so a line that a third of
all texts hold is one row when ranks are sorted, and positions of unique pairs
leave at once: no longer repeat starts there. Depths go through ``min_lines``
and double until no pair repeats.

Equal ranks at a depth are an interval of the suffix array whose longest
common prefix has that many lines or more. A suffix is a later copy where its
interval has an earlier position, by (id, hash of the text, line); the first
position of the deepest such interval is its source. Suffixes whose source
moves along with them line by line are one run; the common prefix of the run's
first suffix with its source, found exactly by descending through the ranks
from the deepest on, is the maximal run. Lines of these runs are deleted.

A run counts if it has ``min_lines`` lines, or if one line of it has
``min_words`` words by itself.

Only DataFrame functions are used. Each depth writes its (few) repeated pairs
and positions to the shared folder, so both inputs of a join are shuffled for
it and Spark can split a hot rank's partition. The number of depths is the
logarithm of the longest repeat.

Defined cases: lines without a word never count and stay where they are; a
text whose lines with words are all deleted becomes empty; null texts stay
null; rows with equal id and text are one text, so neither is a copy of the
other; null ids order first; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm import common as C

MIN_LINES = 3
MIN_WORDS = 20
WORD = r"[^\x20\x09-\x0D]"


def _let(value, body):
    return F.element_at(F.transform(F.array(value), body), 1)


def _numbered(text):
    """(number of the line in the text, line) of the lines that have a word."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("at"), x.alias("line"))),
                    lambda x: x["line"].rlike(WORD))


def _place():
    return F.struct("id", "h", "pos")


def _ranked(positions: DataFrame, keys: list[str], kept: list[str]) -> DataFrame | None:
    """Positions of repeated keys with the rank of the key and its first place; None if no key repeats."""
    groups = (positions.groupBy(*keys).agg(F.min(_place()).alias("first"), F.max(_place()).alias("final"))
              .where(F.col("first") < F.col("final")).drop("final").orderBy(*keys)
              .withColumn("rank", F.monotonically_increasing_id()))
    groups = C.written(groups, "lines-rank")
    if groups.isEmpty():
        return None
    return C.written(positions.join(groups, keys).select("id", "h", "pos", "rank", "first", *kept), "lines-pos")


def line_positions(docs: DataFrame) -> DataFrame:
    """(id, h, pos, a, b, words): the lines with words of each text; (a, b) is a 128-bit line id."""
    lines = docs.select("id", F.xxhash64("text").alias("h"), F.posexplode(_numbered(F.col("text"))).alias("pos", "item"))
    line = F.col("item.line")
    return lines.select("id", "h", "pos", F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"),
                        F.size(F.split(F.btrim(line, F.lit(" \t\n\x0b\f\r")), r"[\x20\x09-\x0D]+")).alias("words"))


def ranked_suffixes(docs: DataFrame, min_lines: int = MIN_LINES) -> list[tuple[int, DataFrame]]:
    """For each depth, the suffixes (id, h, pos, rank, first) that share their first lines; depth 1 has ``words`` too."""
    found, depth, ranked = [], 1, _ranked(line_positions(docs), ["a", "b"], ["words"])
    while ranked is not None:
        found.append((depth, ranked))
        step = depth if depth >= min_lines else min(depth, min_lines - depth)
        ahead = Window.partitionBy("id", "h").orderBy("pos").rangeBetween(step, step)
        pairs = ranked.select("id", "h", "pos", F.col("rank").alias("r1"), F.max("rank").over(ahead).alias("r2"))
        ranked = _ranked(pairs.where("r2 is not null"), ["r1", "r2"], [])
        depth += step
    return found


def _run_starts(found: list[tuple[int, DataFrame]], min_lines: int) -> DataFrame:
    """(id, h, pos, source, length): later copies whose source doesn't go on from the line before; length is a depth."""
    later = reduce(DataFrame.unionByName, [
        t.where(F.col("first") < _place()).select("id", "h", "pos", F.lit(d).alias("length"), "first")
        for d, t in found if d >= min_lines])
    best = later.groupBy("id", "h", "pos").agg(F.max("length").alias("length"), F.max_by("first", "length").alias("source"))
    before = F.lag(F.struct("pos", "source")).over(Window.partitionBy("id", "h").orderBy("pos"))
    moved = F.struct((F.col("pos") - 1).alias("pos"), F.struct(
        F.col("source.id").alias("id"), F.col("source.h").alias("h"), (F.col("source.pos") - 1).alias("pos")).alias("source"))
    return best.withColumn("on", before.eqNullSafe(moved)).where("not on").drop("on")


def maximal_runs(found: list[tuple[int, DataFrame]], min_lines: int = MIN_LINES) -> DataFrame | None:
    """(id, h, pos, length, source): each run of lines that is a later copy of the lines at ``source``, as long as both agree.

    ``found`` comes from :func:`ranked_suffixes`; positions count the lines with a word. None if there is no such run.
    """
    if not found or found[-1][0] < min_lines:
        return None
    runs = C.written(_run_starts(found, min_lines), "lines-runs")
    for depth, ranked in reversed(found[:-1]):  # a run is shorter than twice the depth where it was last a copy
        ranks = ranked.groupBy(F.struct("id", "h").alias("key"), "pos").agg(F.max("rank").alias("rank"))
        here, there = (ranks.select(F.col("key").alias(f"k{x}"), F.col("pos").alias(f"p{x}"), F.col("rank").alias(f"r{x}"))
                       for x in "12")
        at = F.col("length")
        longer = (runs.join(here, (F.struct("id", "h") == F.col("k1")) & (F.col("pos") + at == F.col("p1")), "left")
                  .join(there, (F.struct("source.id", "source.h") == F.col("k2"))
                        & (F.col("source.pos") + at == F.col("p2")), "left"))
        length = at + F.when(F.col("r1") == F.col("r2"), depth).otherwise(0)
        runs = C.written(longer.select("id", "h", "pos", length.alias("length"), "source"), "lines-runs")
    return runs


def later_copies(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame | None:
    """(id, h, gone): the numbers, among lines with a word, of the deleted lines of a text; None if no line repeats."""
    found = ranked_suffixes(docs, min_lines)
    if not found:
        return None
    cut = found[0][1].where((F.col("first") < _place()) & (F.col("words") >= min_words))
    cut = cut.select("id", "h", "pos", (F.col("pos") + 1).alias("end"))
    runs = maximal_runs(found, min_lines)
    if runs is not None:
        cut = cut.unionByName(runs.select("id", "h", "pos", (F.col("pos") + F.col("length")).alias("end")))
    # runs may overlap: each adds the lines beyond the furthest end before it
    past = Window.partitionBy("id", "h").orderBy("pos", "end").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("pos", F.greatest("pos", F.coalesce(F.max("end").over(past), F.lit(0)))).where("pos < end")
    lines = F.sequence(F.col("pos"), F.col("end") - 1)
    return cut.groupBy("id", "h").agg(F.array_sort(F.flatten(F.collect_list(lines))).alias("gone"))


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, id_col: str = "doc_id",
               text_col: str = "text") -> tuple[DataFrame, str]:
    """All columns of ``docs`` with the kept text, a struct of n_lines, n_removed and n_runs, and that struct's name."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    name, key, gone, other_id, other_key = (
        C.fresh(docs, x) for x in ("line_dedup", "line_key", "line_gone", "line_id", "line_other"))
    later = later_copies(slim, min_lines, min_words)
    if later is None:  # no line repeats
        later = slim.limit(0).select("id", F.lit(0).cast("long").alias("h"), F.array().cast("array<int>").alias("gone"))
    later = later.select(F.col("id").alias(other_id), F.col("h").alias(other_key), F.col("gone").alias(gone))
    text = F.col(text_col)
    joined = docs.withColumn(key, F.xxhash64(text_col)).join(
        later.hint("shuffle_hash"),
        F.col(id_col).eqNullSafe(F.col(other_id)) & (F.col(key) == F.col(other_key)), "left")
    at = _let(_numbered(text), lambda n: F.transform(gone, lambda p: n[p]["at"]))
    left = _let(F.split(text, "\n"), lambda s: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(s) - 1), at), lambda i: s[i]))
    kept = _let(left, lambda s: F.when(F.exists(s, lambda x: x.rlike(WORD)), F.array_join(s, "\n")).otherwise(F.lit("")))
    starts = F.size(F.filter(gone, lambda p, i: (i == 0) | (F.element_at(gone, F.greatest(i, F.lit(1))) != p - 1)))
    none = F.col(gone).isNull()
    info = F.struct(
        F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.when(none, 0).otherwise(F.size(gone)).cast("long").alias("n_removed"),
        F.when(none, 0).otherwise(starts).cast("long").alias("n_runs"))
    out = [F.when(none, text).otherwise(kept).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return joined.select(*out, info.alias(name)), name


def query(spark, sf_dir: str) -> DataFrame:
    out, name = line_dedup(C.documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", f"{name}.n_lines", f"{name}.n_removed", f"{name}.n_runs",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def sql(min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> str:
    """The same result for DuckDB: windows of ``min_lines`` lines compared as texts."""
    ahead = "".join(f", lead(line, {k}) OVER w AS l{k}" for k in range(1, min_lines))
    rest = "".join(f", l{k}" for k in range(1, min_lines))
    ws = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH docs AS (SELECT DISTINCT doc_id, text FROM documents),
raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM docs),
seq AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS pos FROM raw
        WHERE length(trim(line, {ws})) > 0),
runs AS (SELECT doc_id, pos, line{ahead} FROM seq WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
later AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY line{rest} ORDER BY doc_id, pos) > 1 AS late
          FROM runs WHERE l{min_lines - 1} IS NOT NULL),
alone AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) > 1 AS late
          FROM seq WHERE len(string_split_regex(trim(line, {ws}), '[\\x20\\x09-\\x0D]+')) >= {min_words}),
gone AS (SELECT doc_id, unnest(range(pos, pos + {min_lines})) AS pos FROM later WHERE late
         UNION SELECT doc_id, pos FROM alone WHERE late),
islands AS (SELECT doc_id, count(*) AS n, count(*) FILTER (prev IS NULL OR prev <> pos - 1) AS runs
            FROM (SELECT *, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS prev FROM gone) GROUP BY doc_id),
kept AS (SELECT raw.doc_id, string_agg(raw.line, chr(10) ORDER BY raw.ln) AS t, count(seq.pos) AS word_lines
         FROM raw LEFT JOIN seq USING (doc_id, ln) LEFT JOIN gone ON gone.doc_id = seq.doc_id AND gone.pos = seq.pos
         WHERE gone.pos IS NULL GROUP BY raw.doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(i.n, 0)::BIGINT AS n_removed,
       coalesce(i.runs, 0)::BIGINT AS n_runs,
       sha256(CASE WHEN i.n IS NULL THEN coalesce(d.text, '') WHEN k.word_lines > 0 THEN k.t ELSE '' END) AS kept_sha256
FROM documents d LEFT JOIN islands i ON d.doc_id = i.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
