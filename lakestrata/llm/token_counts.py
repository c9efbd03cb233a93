"""Token counts: rank-synchronous byte-pair merging in numpy.

A text is one sequence with every space written as U+2581 and one more in
front. No piece of the vocabulary holds that sign after another character, so
no merge crosses from a word into the next sign: the sequence falls apart into
pre-tokens (a run of signs and the characters up to the next one) that can be
merged alone. The distinct pre-tokens of a slice lie as ragged symbol arrays
in one flat numpy array; in each round every pre-token merges its lowest-rank
pair (the leftmost one of equal rank), all pre-tokens at once, until none has
a pair. A symbol that is a piece counts one token, any other character as
many as its UTF-8 bytes (byte fallback).

Pre-tokens of more than LONG symbols (a text without spaces) are merged with
a heap, which takes n log n steps instead of a round for each merge.

Defined cases: null text counts as empty (no tokens); repeated rows are
counted one by one; strings of special tokens in a text are ordinary text, as
the library treats them; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import common as C

SIGN = "▁"
LONG = 64
#: Pre-tokens that are merged together (their arrays fit the processor's cache).
BATCH = 8_192
#: Pre-tokens that a Python worker remembers; it starts anew beyond.
CACHE = 400_000
NONE = np.iinfo(np.int64).max


class Merger:
    """Merge tables of a sentencepiece BPE model."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        pieces = {sp.id_to_piece(i): i for i in ids}
        if any(SIGN in p.lstrip(SIGN) for p in pieces):
            raise ValueError("pieces of this model reach over word starts")
        scores = sorted({sp.get_score(i) for i in ids}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        self.size = sp.get_piece_size()
        self.pieces = pieces
        self.pair_list: dict[tuple[int, int], tuple[int, int]] = {}
        for p, i in pieces.items():  # every way to cut a piece in two pieces is a pair that can merge
            for cut in range(1, len(p)):
                a, b = pieces.get(p[:cut]), pieces.get(p[cut:])
                if a is not None and b is not None:
                    self.pair_list[a, b] = (rank[sp.get_score(i)], i)
        # a character that is no piece can still be half of one
        chars = sorted({c for p in pieces for c in p} - set(pieces))
        self.extra = {c: self.size + k for k, c in enumerate(chars)}
        every = pieces | self.extra
        for p, i in pieces.items():
            for cut in range(1, len(p)):
                a, b = every.get(p[:cut]), every.get(p[cut:])
                if a is not None and b is not None:
                    self.pair_list[a, b] = (rank[sp.get_score(i)], i)
        keys = np.array([(a << 32) | b for a, b in self.pair_list], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array([r for r, _ in self.pair_list.values()], np.int64)[order]
        self.made = np.array([m for _, m in self.pair_list.values()], np.int64)[order]
        top = 1 + max([ord(c) for c in every if len(c) == 1], default=0)
        self.char_id = np.full(top, -1, np.int64)
        for c, i in every.items():
            if len(c) == 1:
                self.char_id[ord(c)] = i
        self.cache: dict[str, int] = {}

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbol of each code point; a foreign one is -1 - its byte count."""
        out = np.where(points < len(self.char_id), self.char_id[np.minimum(points, len(self.char_id) - 1)], -1)
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        return np.where(out < 0, -1 - width, out)

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; NONE where it can't merge."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(ok, self.ranks[at], NONE), self.made[at]

    def weigh(self, symbols: np.ndarray) -> np.ndarray:
        """Tokens that a final symbol counts for."""
        foreign = np.array([len(c.encode()) for c in self.extra] or [0], np.int64)
        out = np.ones(len(symbols), np.int64)
        out[symbols < 0] = -1 - symbols[symbols < 0]
        half = symbols >= self.size
        out[half] = foreign[symbols[half] - self.size]
        return out

    def count_short(self, tokens: list[str]) -> np.ndarray:
        """Rank-synchronous merging of many pre-tokens."""
        lengths = np.array([len(t) for t in tokens], np.int64)
        points = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sym, owner = self.symbols(points), np.repeat(np.arange(len(tokens)), lengths)
        total = np.zeros(len(tokens), np.int64)
        last = np.ones(len(sym), bool)  # the last symbol of its pre-token has no pair
        last[:-1] = owner[1:] != owner[:-1]
        rank, made = np.full(len(sym), NONE), np.zeros(len(sym), np.int64)
        rank[:-1], made[:-1] = self.look(sym[:-1], sym[1:])
        rank[last] = NONE
        while len(sym):
            ends = np.flatnonzero(last)
            sizes = np.diff(ends, prepend=-1)
            low = np.minimum.reduceat(rank, ends - sizes + 1)
            wanted = np.repeat(low, sizes)
            done = wanted == NONE
            if done.any():  # pre-tokens without a pair leave with what survived
                total += np.bincount(owner[done], weights=self.weigh(sym[done]), minlength=len(tokens)).astype(np.int64)
            place = np.flatnonzero((rank == wanted) & ~done)
            lead = place[np.diff(owner[place], prepend=-1) != 0]
            sym[lead] = made[lead]
            last[lead] = last[lead + 1]
            keep = ~done
            keep[lead + 1] = False
            at = (np.cumsum(keep) - 1)[lead]  # where the merged symbols are now
            sym, owner, last, rank, made = sym[keep], owner[keep], last[keep], rank[keep], made[keep]
            # only the pairs beside a merged symbol are new
            before = at[at > 0] - 1
            changed = np.concatenate((at, before[~last[before]]))
            changed = changed[changed < len(sym) - 1]
            rank[at] = NONE
            if len(changed):
                rank[changed], made[changed] = self.look(sym[changed], sym[changed + 1])
                rank[changed[last[changed]]] = NONE
        return total

    def count_long(self, token: str) -> int:
        """The same merges of one long pre-token, taken from a heap."""
        sym = self.symbols(np.frombuffer(token.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)).tolist()
        n = len(sym)
        left, right, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        heap = []

        def offer(i):
            j = right[i]
            if j >= 0 and (pair := self.pair_list.get((sym[i], sym[j]))):
                heapq.heappush(heap, (pair[0], i, sym[i], sym[j], j, pair[1]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b, j, made = heapq.heappop(heap)
            if not (alive[i] and alive[j] and right[i] == j and sym[i] == a and sym[j] == b):
                continue
            sym[i], alive[j], right[i] = made, False, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return int(self.weigh(np.array([s for s, ok in zip(sym, alive) if ok], np.int64)).sum())

    def count_tokens(self, tokens: list[str]) -> np.ndarray:
        """Token counts of distinct pre-tokens, remembered between slices."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        get = self.cache.get
        out = np.array([get(t, -1) for t in tokens], np.int64)
        new = np.flatnonzero(out < 0)
        if len(new):
            short = [k for k in new.tolist() if len(tokens[k]) <= LONG]
            for k in range(0, len(short), BATCH):
                out[short[k: k + BATCH]] = self.count_short([tokens[j] for j in short[k: k + BATCH]])
            for k in new.tolist():
                if len(tokens[k]) > LONG:
                    out[k] = self.count_long(tokens[k])
                else:
                    self.cache[tokens[k]] = int(out[k])
        return out

    def count_texts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text (no nulls)."""
        signed = pc.binary_join_element_wise("", pc.replace_substring(texts, " ", SIGN), SIGN)
        filled = pc.replace_with_mask(signed, pc.equal(pc.binary_length(texts), 0), pa.scalar("", signed.type))
        lists = pc.split_pattern(filled, SIGN)  # "" stands for one more sign in front of what follows
        flat = lists.flatten()
        row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        empty = pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        code, distinct = C.codes(flat)
        names = distinct.to_pylist()
        counts = self.count_tokens([SIGN + t for t in names])
        value = counts[code] if len(code) else code
        # The part before a text's first sign is always empty and no token. A run of
        # signs shows as empty parts: they and the next word are one pre-token.
        first = np.ones(len(row), bool)
        first[1:] = row[1:] != row[:-1]
        value = np.where(first, 0, value)
        blank = empty & ~first
        if blank.any():
            last = np.ones(len(row), bool)
            last[:-1] = first[1:]
            begin = blank & ~np.concatenate(([False], blank[:-1]))
            runs = np.flatnonzero(begin)
            where = np.flatnonzero(~blank | last)
            stop = where[np.searchsorted(where, runs)]  # the word that ends the run, or the text's last part
            value[blank] = 0
            rows = [(int(stop[k] - runs[k]), names[code[stop[k]]]) for k in range(len(runs))]
            value[stop] = self.count_tokens([SIGN * (n + 1) + t for n, t in rows])
        return np.bincount(row, weights=value, minlength=len(texts)).astype(np.int64)


_MERGERS: dict[str, Merger] = {}


def merger(model_file: str) -> Merger:
    """One per Python worker and model."""
    if model_file not in _MERGERS:
        _MERGERS[model_file] = Merger(model_file)
    return _MERGERS[model_file]


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, n_bytes and n_tokens of every row of ``docs``."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches):
        m = merger(model_file)
        for part in C.slices(batches, "text"):
            texts = C.text_of(part, "text")
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(m.count_texts(texts))],
                names=["id", "n_bytes", "n_tokens"])

    out = slim.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts(C.documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)
