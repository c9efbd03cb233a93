"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded slice of a partition. Its words become numbers: the place
of a word in the (small) vocabulary of the benchmark, or a break. Stretches of
known words that are shorter than the shortest window cannot hold one and are
left out before indexing; this drops nothing that could match. Over the rest
the shard builds a suffix array (prefix doubling in numpy), its
Burrows-Wheeler transform as a wavelet matrix with rank directories, and every
SAMPLE-th suffix position. All windows of the benchmark are searched backward
at the same time, one symbol a step; their occurrences are located by walking
back to a sampled position, and overlapping occurrences merge to spans.

The benchmark is sent to the executors in blocks of at most BLOCK_BYTES of
text. One block is one pass without any shuffle; a larger benchmark takes one
pass for each block, with the rows written to the shared folder in between.

Defined cases: null or wordless texts and items have no words and no hits;
repeated items count once, an item id that occurs with several texts counts
for all of them; null item ids are named "null"; repeated rows are judged one
by one; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm import common as C

WINDOW = 10
SAMPLE = 8
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 4 << 20

_PLAIN = np.full(256, 0x20, np.uint8)
for _b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _PLAIN[_b] = _b
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)


def plain(texts: pa.Array) -> pa.Array:
    """Words (digits, letters, everything beyond ASCII; A-Z in lower case) with spaces between, byte for byte."""
    body, offsets = C.raw(texts)
    return C.rebuilt(_PLAIN[body], offsets)


class Queries:
    """The distinct windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        table: dict[tuple[str, ...], set[str]] = {}
        for item, text in items:
            words = plain(pa.array([text], pa.string()))[0].as_py().split()
            for k in range(max(1, len(words) - window + 1) if words else 0):
                table.setdefault(tuple(words[k: k + window]), set()).add(item)
        self.windows = sorted(table)
        self.items = [sorted(table[w]) for w in self.windows]
        names = sorted({x for w in self.windows for x in w})
        number = {x: k + 2 for k, x in enumerate(names)}  # 1 is the break, 0 the end of a shard
        self.vocabulary = pa.array(names, pa.string())
        self.length = np.array([len(w) for w in self.windows], np.int64)
        self.symbols = np.zeros((len(self.windows), window), np.int64)  # from the last word to the first
        for k, w in enumerate(self.windows):
            self.symbols[k, : len(w)] = [number[x] for x in reversed(w)]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling until every suffix has a rank of its own."""
    n, h = len(text), 1
    rank = text.astype(np.int64)
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - h)] = rank[h:] + 1
        key = rank * (int(rank.max(initial=0)) + 2 + int(ahead.max(initial=0))) + ahead
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1]))) if n else order
        rank = np.empty(n, np.int64)
        rank[order] = new
        h *= 2
        if n == 0 or new[-1] == n - 1:
            return order


class FMIndex:
    """Backward search and locate over small numbers that end with the only 0."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        order = suffix_array(text)
        last = text[order - 1]
        self.n = len(text)
        counts = np.bincount(text)
        self.start = np.concatenate(([0], np.cumsum(counts)))
        self.bits = max(1, int(text.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        row = last
        for bit in range(self.bits - 1, -1, -1):
            b = (row >> bit) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(b))).astype(np.int32))
            self.zeros.append(int(self.n - b.sum()))
            row = np.concatenate((row[b == 0], row[b == 1]))
        self.last = last
        kept = np.flatnonzero(order % sample == 0)
        self.kept, self.position, self.sample = kept, order[kept], sample

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol is in the transform before each row."""
        low, high = np.zeros_like(row), row
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> bit) & 1).astype(bool)
            ones, zeros = self.ones[level], self.zeros[level]
            low = np.where(one, zeros + ones[low], low - ones[low])
            high = np.where(one, zeros + ones[high], high - ones[high])
        return high - low

    def search(self, symbols: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row interval of each query; symbols run from the last word to the first."""
        low, high = np.zeros(len(length), np.int64), np.full(len(length), self.n, np.int64)
        live = np.arange(len(length))
        for k in range(symbols.shape[1]):
            live = live[(length[live] > k) & (low[live] < high[live])]
            if len(live) == 0:
                break
            s = symbols[live, k]
            known = s < len(self.start) - 1
            low[live[~known]] = high[live[~known]] = 0
            live, s = live[known], s[known]
            low[live] = self.start[s] + self.rank(s, low[live])
            high[live] = self.start[s] + self.rank(s, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by steps back to a sampled one."""
        out, steps, live, row = np.full(len(rows), -1, np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(live):
            at = np.minimum(np.searchsorted(self.kept, row), len(self.kept) - 1)
            found = self.kept[at] == row
            out[live[found]] = self.position[at[found]] + steps
            live, row = live[~found], row[~found]
            symbol = self.last[row]
            row = self.start[symbol] + self.rank(symbol, row)
            steps += 1
        return out


def shard_hits(texts: pa.Array, q: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row of each word, hit mask of each word, row and window of each distinct pair found, words)."""
    clean = plain(texts)
    words, row = C.words(clean)
    n = len(row)
    hit = np.zeros(n, bool)
    none = np.zeros(0, np.int64)
    if n == 0 or len(q.windows) == 0:
        return row, hit, none, none, clean
    symbol = pc.fill_null(pc.index_in(words, value_set=q.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    known = symbol > 0
    first = known & np.concatenate(([True], (row[1:] != row[:-1]) | ~known[:-1]))
    begin = np.flatnonzero(first)
    final = known & np.concatenate(((row[1:] != row[:-1]) | ~known[1:], [True]))
    size = np.flatnonzero(final) + 1 - begin
    enough = size >= q.length.min()
    begin, size = begin[enough], size[enough]
    if len(begin) == 0:
        return row, hit, none, none, clean
    # each stretch and a break after it
    place = np.repeat(begin, size + 1) + C.spans(size + 1)
    text = symbol[np.minimum(place, n - 1)] + 1
    text[np.cumsum(size + 1) - 1] = 1
    index = FMIndex(np.append(text, 0))
    low, high = index.search(q.symbols, q.length)
    found = high - low
    window = np.repeat(np.arange(len(found)), found)
    at = place[index.locate(np.repeat(low, found) + C.spans(found))]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + q.length[window], -1)
    hit = np.cumsum(edge[:-1]) > 0
    pairs = np.unique(row[at] * len(found) + window)
    return row, hit, pairs // len(found), pairs % len(found), clean


def _word_bytes(clean: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and byte after the last of every word, over all texts, and the texts' offsets."""
    body, offsets = C.raw(clean)
    inside = body != 0x20
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside & (edge[:-1] | np.concatenate(([True], ~inside[:-1]))))
    stop = np.flatnonzero(inside & (edge[1:] | np.concatenate((~inside[1:], [True])))) + 1
    return start, stop, offsets


def _result(texts: pa.Array, q: Queries, before: pa.StructArray | None = None) -> pa.StructArray:
    """FIELDS of each text; ``before`` holds what earlier blocks of the benchmark found."""
    n = len(texts)
    row, hit, pair_row, pair_window, clean = shard_hits(texts, q)
    items: list[list[str]] = [[] for _ in range(n)] if before is None else before.field("items").to_pylist()
    for r, w in zip(pair_row.tolist(), pair_window.tolist()):
        items[r].extend(q.items[w])
    items = [sorted(set(x)) for x in items]
    word_start, word_stop, offsets = _word_bytes(clean)
    if before is not None:  # words inside earlier spans are hit too
        known, each = before.field("starts"), pc.list_value_length(before.field("starts")).to_numpy(zero_copy_only=False)
        base = np.repeat(offsets[:-1], each)
        a = base + known.flatten().to_numpy(zero_copy_only=False)
        b = base + before.field("stops").flatten().to_numpy(zero_copy_only=False)
        edge = np.zeros(len(hit) + 1, np.int64)
        np.add.at(edge, np.searchsorted(word_start, a), 1)
        np.add.at(edge, np.searchsorted(word_start, b), -1)
        hit = hit | (np.cumsum(edge[:-1]) > 0)
    other = row[1:] != row[:-1]
    head = hit & np.concatenate(([True], other | ~hit[:-1]))[: len(hit)]
    tail = hit & np.concatenate((other | ~hit[1:], [True]))[: len(hit)]
    span_row = row[head]
    ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(span_row, minlength=n)))).astype(np.int32))
    return pa.StructArray.from_arrays([
        pa.array(np.bincount(row, minlength=n).astype(np.int64)),
        pa.array(np.bincount(row[hit], minlength=n).astype(np.int64)),
        pa.ListArray.from_arrays(ends, pa.array(word_start[head] - offsets[span_row])),
        pa.ListArray.from_arrays(ends, pa.array(word_stop[tail] - offsets[span_row])),
        pa.array(items, pa.list_(pa.string())),
    ], names=["n_words", "n_hit", "starts", "stops", "items"])


FIELDS = "n_words long, n_hit long, starts array<long>, stops array<long>, items array<string>"


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """Lists of (item, text), each of about ``block_bytes`` of text, read one after the other."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else items
        yield [(r.item, r.text) for r in part.collect()], k + 1 == n


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id",
                  text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of FIELDS (spans are byte offsets), and the name of that column."""
    spark, name = docs.sparkSession, C.fresh(docs, "contamination")
    found, schema = docs, T.StructType([*docs.schema.fields, T.StructField(name, T.StructType.fromDDL(FIELDS))])
    for items, final in _blocks(benchmark, item_col, "text", block_bytes):
        sent = spark.sparkContext.broadcast(Queries(items, window))  # block_bytes of text at most

        def run(batches, sent=sent):
            for part in C.slices(batches, text_col, SHARD_BYTES):
                columns = dict(zip(part.schema.names, part.columns))
                columns[name] = _result(C.text_of(part, text_col), sent.value, columns.get(name))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        found = found.mapInArrow(run, schema)
        if not final:
            found = C.written(found, "decontaminate")
    return found, name


def _cut(texts, starts, stops):
    out = []
    for t, a, b in zip(texts, starts, stops):
        if t is None or len(a) == 0:
            out.append(t)
            continue
        body, kept, at = t.encode(), [], 0
        for s, e in zip(a, b):
            kept.append(body[at:s])
            at = e
        out.append(b"".join([*kept, body[at:]]).decode())
    return out


def without_spans(found: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """The texts with all hit spans cut out; the struct column goes."""
    columns = [c for c in found.columns if c != name]
    kind = found.select(*columns).schema

    def run(batches):
        for b in batches:
            s = b.column(b.schema.get_field_index(name))
            k = b.schema.get_field_index(text_col)
            got = pa.array(_cut(b.column(k).to_pylist(), s.field("starts").to_pylist(), s.field("stops").to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [got if c == text_col else b.column(b.schema.get_field_index(c)) for c in columns], names=columns)

    return found.mapInArrow(run, kind)


def query(spark, sf_dir: str) -> DataFrame:
    found, name = decontaminate(C.documents(spark, sf_dir).select("doc_id", "text"),
                                spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return digest(found, name)


def digest(found: DataFrame, name: str) -> DataFrame:
    c = F.col(name)
    joined = F.array_join(F.array_sort(c["items"]), ",")
    return found.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"),
                        F.size(c["items"]).cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"),
                        (c["n_hit"] > 0).alias("contaminated"))
