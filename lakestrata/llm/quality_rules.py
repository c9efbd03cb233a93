"""Quality rules: a learned decision list over text statistics.

``statistics`` counts five base numbers and three helpers for each text.
``learn`` fits an ordered list of threshold conjunctions by sequential
covering on a bounded, documented sample of labelled rows: a rule is grown
condition by condition (FOIL gain) on two thirds of the sample, pruned from
its end on the other third, and taken while it stays precise there; rows that
it covers leave the sample. ``apply_rules`` emits the list as one ordered
Spark ``CASE WHEN`` expression, so the verdict is computed in the JVM.

Defined cases: null or empty text has zero counts and fails the base check;
null labels are left out, as are ids with contradicting labels; without rows
of both classes the list is empty and only the base check decides; repeated
rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import common as C

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_distinct")
#: Most labelled rows that the list is learned from, by smallest hash of the id.
TRAIN_ROWS = 20_000
#: A rule must be right on this share of the rows that it covers.
MIN_PRECISION = 0.97


def _table(values: bytes) -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[list(values)] = 1
    return t


_SYMBOLS, _UPPER, _MARKS = _table(b"#*$%&|<>"), _table(bytes(range(0x41, 0x5B))), _table(b"!?.,;:")
_CHARS = np.ones(256, np.int64)
_CHARS[0x80:0xC0] = 0  # continuation bytes
_CHARS[list(C.SPACE_BYTES)] = 0


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of each text (no nulls)."""
    n = len(texts)
    body, offsets = C.raw(texts)
    words, row = C.words(texts)
    code, _ = C.codes(words)
    a, b, c, doc = code[:-2], code[1:-1], code[2:], row[:-2]
    inside = np.flatnonzero(doc == row[2:]) if len(code) > 2 else np.zeros(0, np.int64)
    twice = inside[C.repeated(doc[inside], a[inside], b[inside], c[inside])] if len(inside) else inside
    covered = np.zeros(len(code), bool)
    for k in range(3):
        covered[twice + k] = True
    pairs = np.unique((row << 32) | code) if len(code) else np.zeros(0, np.int64)

    lines = pc.split_pattern(texts, "\n")
    flat = lines.flatten()
    line_row = np.repeat(np.arange(n), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0)
    line_row = line_row[full.to_numpy(zero_copy_only=False)]
    line_code, _ = C.codes(flat.filter(full))
    first = np.unique((line_row << 32) | line_code)
    return {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": _sums(_CHARS[body], offsets),
        "n_symbols": _sums(_SYMBOLS[body], offsets),
        "n_dup_lines": np.bincount(line_row, minlength=n) - np.bincount(first >> 32, minlength=n),
        "n_repeat_words": np.bincount(row[covered], minlength=n),
        "n_upper": _sums(_UPPER[body], offsets),
        "n_marks": _sums(_MARKS[body], offsets),
        "n_distinct": np.bincount(pairs >> 32, minlength=n),
    }


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and the columns of COUNTS (long)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches):
        for part in C.slices(batches, "text"):
            got = count_texts(C.text_of(part, "text"))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(got[k].astype(np.int64)) for k in COUNTS)], names=["id", *COUNTS])

    out = slim.mapInArrow(run, ", ".join([f"id {kind}", *(f"{k} long" for k in COUNTS)]))
    return out.withColumnRenamed("id", id_col)


def ratios(get) -> dict:
    """The quantities that conditions test, from a getter of counts.

    Works on numpy arrays and on Spark columns alike, so learning and the
    emitted expression use the same arithmetic.
    """
    words = get("n_words") + 1.0
    chars = get("word_chars") + 1.0
    return {
        "n_words": get("n_words") * 1.0,
        "word_length": chars / words,
        "symbols_per_word": get("n_symbols") / words,
        "dup_lines_per_word": get("n_dup_lines") / words,
        "repeat_share": get("n_repeat_words") / words,
        "upper_share": get("n_upper") / chars,
        "marks_per_word": get("n_marks") / words,
        "distinct_share": get("n_distinct") / words,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.at_least else x[self.feature] < self.threshold

    def column(self, x: dict[str, Column]) -> Column:
        v = F.lit(self.threshold)
        return x[self.feature] >= v if self.at_least else x[self.feature] < v


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> list[Condition]:
    rule: list[Condition] = []
    live = np.ones(len(bad), bool)
    while len(rule) < most and (~bad[live]).any() and bad[live].any():
        p0, n0 = bad[live].sum(), (~bad[live]).sum()
        base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for name, values in x.items():
            v, y = values[live], bad[live]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            cut = np.flatnonzero(v[1:] != v[:-1]) + 1
            if len(cut) > 256:
                cut = cut[np.linspace(0, len(cut) - 1, 256).astype(int)]
            below = np.concatenate(([0], np.cumsum(y)))[cut]
            for at_least, p, total in ((False, below, cut), (True, p0 - below, len(v) - cut)):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1e-12) / total) - base), -1.0)
                if len(gain) and gain.max() > best[0]:
                    k = int(gain.argmax())
                    best = (gain[k], Condition(name, at_least, float((v[cut[k] - 1] + v[cut[k]]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        live &= best[1].mask(x)
    return rule


def _covers(rule: list[Condition], x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        out &= c.mask(x)
    return out


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray, prune_fold: np.ndarray, max_rules: int = 12,
                max_conditions: int = 4, min_precision: float = MIN_PRECISION, min_rows: int = 5) -> list[list[Condition]]:
    """The decision list: each rule names rows to reject."""
    rules: list[list[Condition]] = []
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules:
        g, h = left & ~prune_fold, left & prune_fold
        if bad[g].sum() < min_rows or (~bad[g]).sum() == 0:
            break
        rule = _grow({k: v[g] for k, v in x.items()}, bad[g], max_conditions)

        def worth(r):
            hit = _covers(r, x) & h
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - n) / max(1, p + n)

        options = [rule[:k] for k in range(1, len(rule) + 1)]
        if not options:
            break
        rule = max(options, key=lambda r: (worth(r), -len(r)))
        hit = _covers(rule, x) & left
        if (hit & bad).sum() < min_rows or (hit & bad).sum() < min_precision * hit.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", **options) -> list[list[Condition]]:
    """Fit the list on at most ``train_rows`` labelled documents (0 means bad)."""
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("low"), F.max(label_col).alias("high"))
              .where("low = high").select("id", "low")
              .orderBy(F.xxhash64("id"), "id").limit(train_rows))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), "id"))  # at most train_rows ids
    found = statistics(rows, "id", "text")
    one = F.min(F.struct(*[c for c in found.columns if c != "id"])).alias("one")  # of an id's texts the least counts
    counts = (found.groupBy("id").agg(one).select("id", "one.*")
              .join(F.broadcast(chosen), "id").orderBy("id").toPandas())
    x = ratios(lambda k: counts[k].to_numpy(np.float64))
    bad = counts["low"].to_numpy() == 0
    return learn_rules(x, bad, np.arange(len(bad)) % 3 == 2, **options)


def apply_rules(counts: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """Adds base_failed, rule (1-based number of the first rule met, 0 if none) and kept."""
    x = ratios(lambda k: F.col(k))
    verdict = F
    for k, rule in enumerate(rules, 1):
        met = F.lit(True)
        for c in rule:
            met = met & c.column(x)
        verdict = verdict.when(met, k)
    number = verdict.otherwise(0) if rules else F.lit(0)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (counts.withColumn("base_failed", failed).withColumn("rule", number)
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Statistics, base check and verdict of every document."""
    return apply_rules(statistics(docs), learn(docs, labels, **options))


def query(spark, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality_rules(docs, labels)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "rule")
