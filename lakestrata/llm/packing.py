"""Best-fit packing with Martello-Toth reduction.

Documents are tokenised, ended with id 0, and cut into pieces of ``capacity``
only where they are longer. How many pieces there are of each length (at most
``capacity`` numbers, whatever the corpus size) is all that packing needs:

* ``reduce`` fixes sets that dominate every alternative for one of their
  items: an item that nothing fits beside, an item with the piece that fills
  its sequence, an item with the largest piece that fits when no two others
  fit or no two others reach that size. They are taken for whole length
  classes at once, and the instance shrinks.
* ``best_fit`` places the remainder by decreasing length into the fullest
  sequences that still have room, again class by class.

Both emit runs: pieces number a .. b of a length go to sequences s .. s + b - a
at one offset. Spark numbers the pieces of a length: each task counts its own,
and a sum over the tasks before it is added by a join. A broadcast table of
the runs (bounded by ``capacity``) then gives each piece its place.

Defined cases: null or empty text is one piece with id 0; an empty table gives
an empty result; repeated rows are packed one by one; rows with a null id are
packed too; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm import common as C

CAPACITY = 2048
#: Words whose ids a Python worker remembers; it starts anew beyond.
CACHE = 600_000
#: Words that the library encodes in one call (its results take about 1 KB a word).
BATCH = 4_096
#: Words of letters alone that the library gets as one string.
JOINED = 256
#: A letter and the punctuation behind it at the end of a word (letters of Latin script whose lower case is one letter).
WORD_END = (r"([a-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])"
            r"([!-&(-/:-@\[-`{-~]+)([ \t\n\x0B\f\r]|$)")
#: A word that the tokenizer's normaliser leaves as it is and does not part.
LETTERS = r"^[a-z\x{DF}-\x{F6}\x{F8}-\x{FF}]+$"


# --- packing of length classes ----------------------------------------------

class Runs:
    """Open runs of placed pieces: (length, first rank, count, first sequence, offset)."""

    def __init__(self, counts: np.ndarray):
        self.taken = np.zeros(len(counts), np.int64)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0

    def open(self, n: int) -> int:
        first = self.sequences
        self.sequences += n
        return first

    def place(self, length: int, n: int, sequence: int, offset: int) -> None:
        self.rows.append((length, int(self.taken[length]), n, sequence, offset))
        self.taken[length] += n


def reduce(counts: np.ndarray, capacity: int, runs: Runs) -> np.ndarray:
    """Fix dominating sets; returns the counts of what is left."""
    left = counts.copy()
    for j in range(capacity, 0, -1):
        while left[j]:
            left[j] -= 1  # the others, without this item
            others = np.flatnonzero(left)
            small = np.repeat(others[:3], np.minimum(left[others[:3]], 3))[:3]
            most = int((np.cumsum(small) <= capacity - j).sum())  # 3: three or more fit beside it
            fits = others[others <= capacity - j]
            top = int(fits[-1]) if len(fits) else 0
            left[j] += 1
            if most == 0:
                n, mate = int(left[j]), 0
            elif most == 1 or top == capacity - j:
                n, mate = (int(left[j]) // 2 if top == j else int(min(left[j], left[top]))), top
            elif most == 2 and top >= _best_pair(left, j, capacity - j):
                n, mate = (int(left[j]) // 2 if top == j else int(min(left[j], left[top]))), top
            else:
                break
            first = runs.open(n)
            runs.place(j, n, first, 0)
            left[j] -= n
            if mate:
                runs.place(mate, n, first, j)
                left[mate] -= n
    return left


def _best_pair(left: np.ndarray, j: int, room: int) -> int:
    """The largest sum of two other items that fit in ``room``."""
    free = left.copy()
    free[j] -= 1
    sizes = np.flatnonzero(free)
    sizes = sizes[sizes <= room]
    partner = np.searchsorted(sizes, room - sizes, side="right") - 1
    best = 0
    for a, k in zip(sizes.tolist(), partner.tolist()):
        while k >= 0 and sizes[k] == a and free[a] < 2:
            k -= 1
        if k >= 0:
            best = max(best, a + int(sizes[k]))
    return best


def best_fit(left: np.ndarray, capacity: int, runs: Runs) -> None:
    """Place the rest by decreasing length in the fullest sequences with room."""
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> (first sequence, count)

    def fill(length, n, free, first, bins) -> int:
        """Put up to n pieces in the given sequences; returns how many."""
        per = free // length
        full = min(bins, n // per)
        for k in range(per if full else 0):
            runs.place(length, full, first, capacity - free + k * length)
        if full:
            room.setdefault(free - per * length, []).append((first, full))
        rest = min(n - full * per, per - 1) if full < bins else 0
        for k in range(rest):
            runs.place(length, 1, first + full, capacity - free + k * length)
        used = full + (rest > 0)
        if rest:
            room.setdefault(free - rest * length, []).append((first + full, 1))
        if used < bins:
            room.setdefault(free, []).append((first + used, bins - used))
        return full * per + rest

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            tight = min((r for r, b in room.items() if r >= length and b), default=None)
            if tight is None:
                bins = -(-n // (capacity // length))
                n -= fill(length, n, capacity, runs.open(bins), bins)
            else:
                first, bins = room[tight].pop()
                n -= fill(length, n, tight, first, bins)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first rank, count, first sequence, offset) for the pieces counted."""
    runs = Runs(counts)
    best_fit(reduce(counts, capacity, runs), capacity, runs)
    rows = np.array(runs.rows, np.int64).reshape(-1, 5)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


# --- tokens -------------------------------------------------------------------

class Encoder:
    """Ids of whole texts, encoded word by distinct word.

    The tokenizer lower-cases, drops white space, and parts letters from
    punctuation, so a text may be cut at ASCII white space, take A-Z in lower
    case and part punctuation (without the apostrophe, which some endings
    begin with) at the end of a word from a letter before it without changing
    its ids. Texts that may hold a special token's string ("<|") keep their
    case. New words of letters alone go to the library many to a string: each
    ends with its only token of a word's end.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[k for t, k in vocab.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = _binary(np.zeros(1, "<u4"), np.ones(1, np.int64))  # place 0: the end of a text

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, names: list[str], letters: np.ndarray) -> pa.Array:
        """Ids of new words, the ones of letters first."""
        flat, size = [], []
        n = int(letters.sum())
        for k in range(0, n, BATCH):
            some = names[k: min(k + BATCH, n)]
            ids = list(chain.from_iterable(self._encoded([" ".join(some[j: j + JOINED]) for j in range(0, len(some), JOINED)])))
            flat.append(np.array(ids, "<u4"))
            size.append(np.diff(np.flatnonzero(self.closes[flat[-1]]), prepend=-1))
        for k in range(n, len(names), BATCH):
            ids = self._encoded(names[k: k + BATCH])
            size.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), "<u4", int(size[-1].sum())))
        return _binary(np.concatenate(flat), np.concatenate(size))

    def words(self, distinct: pa.Array) -> np.ndarray:
        """Place of each word in the remembered ids."""
        if len(self.slot) > CACHE:
            self._forget()
        names = distinct.to_numpy(zero_copy_only=False).tolist()
        slots = np.fromiter(map(self.slot.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(slots < 0)
        if len(new):
            letters = pc.match_substring_regex(distinct.take(pa.array(new)), LETTERS).to_numpy(zero_copy_only=False)
            order = np.argsort(~letters, kind="stable")
            new = new[order]
            fresh = [names[k] for k in new.tolist()]
            slots[new] = np.arange(len(self.ids), len(self.ids) + len(new))
            self.ids = pa.concat_arrays([self.ids, self._fresh(fresh, letters)])
            self.slot.update(zip(fresh, slots[new].tolist()))
        return slots

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each ended with 0, and n + 1 offsets."""
        special = pc.match_substring(texts, "<|")
        plain = pc.replace_substring_regex(pc.ascii_lower(texts), WORD_END, r"\1 \2\3")
        words, row = C.words(pc.if_else(special, texts, plain))
        code, distinct = C.codes(words)
        slot = np.zeros(len(code) + len(texts), np.int64)
        if len(code):
            slot[np.arange(len(code)) + row] = self.words(distinct)[code]
        taken = self.ids.take(pa.array(slot))
        _, offsets, data = taken.buffers()
        ends = np.cumsum(np.bincount(row, minlength=len(texts)) + 1)
        offsets = np.frombuffer(offsets, np.int64, len(slot) + 1)[np.concatenate(([0], ends))] // 4
        return np.frombuffer(data, "<u4", int(offsets[-1])) if len(slot) else np.zeros(0, "<u4"), offsets


def _binary(ids: np.ndarray, size: np.ndarray) -> pa.Array:
    """Ids of one word after the other as one binary value a word."""
    ends = np.concatenate(([0], np.cumsum(size))) * 4
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(ids)])


_ENCODERS: dict[str, Encoder] = {}


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of every row with the task that made them (part) and its count of that length so far (local)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches):
        if tokenizer_file not in _ENCODERS:
            _ENCODERS[tokenizer_file] = Encoder(tokenizer_file)
        encoder, seen = _ENCODERS[tokenizer_file], np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for piece in C.slices(batches, "text"):
            ids, offsets = encoder.encode(C.text_of(piece, "text"))
            size = np.diff(offsets)
            n = -(-size // capacity)
            row, number = np.repeat(np.arange(len(size)), n), C.spans(n)
            start = number * capacity
            length = np.minimum(capacity, size[row] - start)
            begin = (offsets[:-1][row] + start) * 4
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[a: a + b]) for a, b in zip(begin.tolist(), (length * 4).tolist())]
            order = np.argsort(length, kind="stable")  # ranks of equal lengths
            ranked = length[order]
            local = np.empty(len(length), np.int64)
            local[order] = np.arange(len(order)) - np.searchsorted(ranked, ranked) + seen[ranked]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [part_ids(piece, row), *(pa.array(x, pa.int64()) for x in (number, start, length, crc, local)),
                 pa.array(np.full(len(row), part, np.int64))],
                names=["id", "piece", "start", "length", "ids_crc32", "local", "part"])

    def part_ids(piece, row):
        return piece.column(0).take(pa.array(row))

    return slim.mapInArrow(run, f"id {kind}, piece long, start long, length long, ids_crc32 long, local long, part long")


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = C.written(pieces(docs, tokenizer_file, capacity, id_col, text_col), "pack")
    by_task = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_task = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    table = spark.sparkContext.broadcast(plan(counts, capacity))  # bounded by capacity, not by the corpus
    names = ["id", "piece", "start", "length", "ids_crc32", "rank"]
    ranked = cut.join(by_task, ["part", "length"]).select(*names[:-1], (F.col("local") + F.col("before")).alias("rank"))
    kind = ranked.schema["id"].dataType.simpleString()

    def place(batches):
        rows = table.value
        key = (rows[:, 0] << 48) | rows[:, 1]
        for b in batches:
            length, rank = (b.column(k).to_numpy() for k in (3, 5))
            run = rows[np.searchsorted(key, (length << 48) | rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1).cast(pa.int32()), *(b.column(k) for k in (2, 3, 4)),
                 pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])],
                names=[*names[:-1], "sequence_id", "offset"])

    out = ranked.mapInArrow(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, "
                                   "sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(C.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
