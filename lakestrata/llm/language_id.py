"""Language identification by interpolated Kneser-Ney character models.

Texts become letters of a lower-cased alphabet (composed accents) with one
space between words.
For each language the 4-gram counts of a training sample give a Kneser-Ney
model: raw counts at order 4, continuation counts (distinct characters in
front) below, one absolute discount an order, interpolated down to a uniform
distribution. N-grams are 16 bits a character in one 64-bit key; a model is a
sorted key array with parallel value arrays for each order, and a probability
is a few binary searches. A text gets the language of the lowest cross-entropy
per character. Distinct 4-grams of a slice are scored once for all texts.

The sample is the documents of a language with the smallest hash of their id,
at most ``train_docs`` of them with at most ``train_chars`` characters each;
this bounds what is collected and broadcast (a language whose labelled texts
are all longer is not learned, so it is never the answer; an id with several
texts of a language counts once, with the least of them). One in five of the sample is not
counted but calibrates rejection: a text is rejected if its cross-entropy is
further above the language's mean than any calibration text of its length
allows (deviations shrink with the square root of the length), with a margin.

Defined cases: null texts and texts without a letter are ``und`` with score 0
and rejected; without any labelled document nothing is learned and all are
``und`` but only texts without a letter are rejected; of equal cross-entropies
the first language name wins; repeated rows are judged one by one; other
columns pass through.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm import common as C

ORDER = 4
TRAIN_DOCS = 1_000
TRAIN_CHARS = 20_000
#: Rejection: calibration deviations are widened by this factor, and this share of the mean is always allowed (texts of two languages keep below it).
MARGIN, SLACK = 1.5, 1.0
FIELDS = "lang_pred string, score double, cross_entropy double, rejected boolean"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point: its 16-bit symbol if it is a letter, else the space's."""
    if not _LETTER:
        table = np.full(0x110000, 0x20, np.uint16)
        for k in range(0x110000):
            if chr(k).isalpha():
                table[k] = max(0x21, (k ^ (k >> 16)) & 0xFFFF)
        _LETTER.append(table)
    return _LETTER[0]


def _composed(texts: pa.Array) -> pa.Array:
    """Texts with accents as one character with their letter (NFC)."""
    values = texts.to_pylist()
    if all(unicodedata.is_normalized("NFC", v) for v in values):
        return texts
    return pa.array([unicodedata.normalize("NFC", v) for v in values], texts.type)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """4-gram keys of all texts and the row of each; a text begins and ends with a space."""
    low = pc.binary_join_element_wise(" ", pc.utf8_lower(_composed(texts)), pc.cast(pa.scalar(" "), texts.type), "")
    size = pc.utf8_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    body, _ = C.raw(low)
    points = np.frombuffer(body.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = _letters()[points]
    row = np.repeat(np.arange(len(texts)), size)
    space = symbol == 0x20
    keep = ~(space & np.concatenate(([False], space[:-1] & (row[1:] == row[:-1]))))
    symbol, row = symbol[keep].astype(np.uint64), row[keep]
    pad = np.uint64(0x20)  # before the first character of a text stand spaces
    key = symbol.copy()
    for back in range(1, ORDER):
        before = np.full(len(symbol), pad)
        if len(symbol) > back:
            before[back:] = np.where(row[back:] == row[:-back], symbol[:-back], pad)
        key |= before << np.uint64(16 * back)
    real = np.ones(len(row), bool)
    real[:1] = False
    real[1:] = row[1:] == row[:-1]  # the leading space is given
    return key[real], row[real]


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if len(keys) == 0:
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sums of their values."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(inverse, weights=values, minlength=len(distinct))


class KneserNey:
    """Sorted hash arrays of one language."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.levels = []  # from order 4 down to 1
        keys, counts = _summed(keys, counts)
        for order in range(ORDER, 0, -1):
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
            context = keys >> np.uint64(16)
            seen, total = _summed(context, counts)
            _, kinds = _summed(context, np.ones(len(keys)))
            self.levels.append((keys, counts, seen, total, kinds, discount))
            mask = np.uint64((1 << 16 * (order - 1)) - 1)
            keys, counts = _summed(keys & mask, np.ones(len(keys)))  # distinct characters in front
        self.symbols = max(2, len(self.levels[-1][0]) + 1)

    def log_prob(self, keys: np.ndarray) -> np.ndarray:
        p = np.full(len(keys), 1.0 / self.symbols)
        for order in range(1, ORDER + 1):
            k, c, seen, total, kinds, d = self.levels[ORDER - order]
            part = keys if order == ORDER else keys & np.uint64((1 << 16 * order) - 1)
            context = part >> np.uint64(16)
            n = _lookup(seen, total, context)
            back = np.where(n > 0, d * _lookup(seen, kinds, context) / np.maximum(n, 1), 1.0)
            p = np.maximum(_lookup(k, c, part) - d, 0) / np.maximum(n, 1) + back * p
        return np.log(p)


@dataclass
class Model:
    """Languages with their arrays and what calibration found."""

    names: list[str]
    models: list[KneserNey]
    mean: np.ndarray
    spread: np.ndarray

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per character (texts x languages), characters and letters of each text."""
        n = len(texts)
        key, row = grams(texts)
        code = pa.array(key).dictionary_encode()
        distinct = code.dictionary.to_numpy()
        index = code.indices.to_numpy(zero_copy_only=False)
        size = np.bincount(row, minlength=n)
        letters = np.bincount(row[(key & np.uint64(0xFFFF)) != 0x20], minlength=n)
        out = np.zeros((n, len(self.names)))
        for k, m in enumerate(self.models):
            out[:, k] = -np.bincount(row, weights=m.log_prob(distinct)[index], minlength=n) / np.maximum(size, 1)
        return out, size, letters

    def predict(self, texts: pa.Array) -> list[pa.Array]:
        entropy, size, letters = self.entropies(texts)
        n, some = len(texts), letters > 0
        if not self.names:
            zero = np.zeros(n)
            return [pa.array(["und"] * n, pa.string()), pa.array(zero), pa.array(zero), pa.array(~some)]
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(n), best]
        weight = np.exp(-(entropy - low[:, None]) * np.minimum(size, 200)[:, None])
        score = np.where(some, 1 / weight.sum(axis=1), 0.0)
        allowed = np.maximum(SLACK * self.mean[best], MARGIN * self.spread[best] / np.sqrt(np.maximum(size, 1)))
        names = np.array([*self.names, "und"], object)
        return [pa.array(names[np.where(some, best, len(self.names))], pa.string()), pa.array(score),
                pa.array(np.where(some, low, 0.0)), pa.array(~some | (low > self.mean[best] + allowed))]


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, train_docs: int, train_chars: int) -> DataFrame:
    """(id, text, lang, held): the bounded training sample; held rows calibrate."""
    fit = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & (C.id_remainder("id") != 0)
        & (F.length("text") <= train_chars) & F.col("text").rlike(r"\p{L}"))
    # a share of each language by hash, about twice the bound, before the exact rank: the rank's
    # tasks then get as many rows at every corpus size
    sizes = fit.groupBy("lang").agg(F.count("*").alias("n"))
    place = F.shiftrightunsigned(F.xxhash64("id"), 1) / F.lit(float(1 << 63))
    near = (fit.select("id", "lang").join(F.broadcast(sizes), "lang")  # one row a language
            .where(place * F.col("n") <= 2.0 * train_docs).select("id", "lang").distinct())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned(F.xxhash64("id"), 1), "id"))
    chosen = near.withColumn("rank", rank).where(F.col("rank") <= train_docs)
    rows = fit.join(F.broadcast(chosen.select("id", "lang", "rank")), ["id", "lang"])  # train_docs ids a language
    return (rows.groupBy("id", "lang", "rank").agg(F.min("text").alias("text"))  # of an id's texts the least
            .withColumn("held", F.pmod("rank", F.lit(5)) == 0))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> Model:
    """Fit the models: Spark counts the n-grams of the sample, the driver gets the (bounded) sums."""
    chosen = C.written(sample(docs, id_col, text_col, lang_col, train_docs, train_chars), "language-sample")

    def count(batches):
        for part in C.slices(batches, "text"):
            key, row = grams(C.text_of(part, "text"))
            lang = part.column(part.schema.get_field_index("lang")).dictionary_encode()
            lang_of = lang.indices.to_numpy(zero_copy_only=False)
            for k, name in enumerate(lang.dictionary.to_pylist()):
                distinct, n = np.unique(key[lang_of[row] == k], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(distinct), pa.string()), pa.array(distinct.view(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"])

    counts = (chosen.where(~F.col("held")).mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).orderBy("lang").toPandas())
    names = sorted(counts["lang"].unique().tolist())
    models = []
    for name in names:
        own = counts[counts["lang"] == name]
        models.append(KneserNey(own["gram"].to_numpy().view(np.uint64), own["n"].to_numpy(np.float64)))
    model = Model(names, models, np.zeros(len(names)), np.zeros(len(names)))
    if not names:
        return model
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def calibrate(batches):
        for part in C.slices(batches, "text"):
            entropy, size, _ = sent.value.entropies(C.text_of(part, "text"))
            lang = part.column(part.schema.get_field_index("lang")).to_pylist()
            known = {x: k for k, x in enumerate(sent.value.names)}
            own = np.array([entropy[i, known[x]] if x in known else np.nan for i, x in enumerate(lang)])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(own), pa.array(size)],
                                             names=["lang", "entropy", "size"])

    got = chosen.where("held").mapInArrow(calibrate, "lang string, entropy double, size long").toPandas()
    for k, name in enumerate(names):
        own = got[(got["lang"] == name) & got["entropy"].notna()]
        if len(own) >= 5:
            model.mean[k] = np.average(own["entropy"], weights=own["size"])
            model.spread[k] = max(1.0, ((own["entropy"] - model.mean[k]) * np.sqrt(own["size"])).max())
        else:  # too few to calibrate: never reject a text with letters
            model.spread[k] = np.inf
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column of FIELDS, and the name of that column."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    name = C.fresh(docs, "language")
    return C.annotated(docs, text_col, name, FIELDS, lambda texts: sent.value.predict(texts)), name


def query(spark, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    found, name = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", (C.id_remainder() == 0).alias("held_out"), f"{name}.lang_pred", f"{name}.score",
                        f"{name}.cross_entropy", f"{name}.rejected")
