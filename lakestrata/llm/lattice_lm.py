"""LM scoring: marginal likelihood over a lattice of subwords.

A word (with a sign for its start) has many segmentations into pieces of an
existing vocabulary. Each piece has a unigram probability; the probability of
the word is the sum over all segmentations, by a forward recursion in log
space. Because no piece crosses a word start, the probability of a text is the
product over its words and one end token. Characters that are no piece fall
back to the pieces of their UTF-8 bytes.

Piece probabilities start from the vocabulary's own scores (its ranks, as a
Zipf prior) and are fitted by expectation maximisation on all words of all
training documents, each distinct word weighted with its uses. ``score`` is
the lattice's log probability of the text. Beside it ``mixture_score`` adds
each training word as one edge of its own: P(w) = max(c - D, 0) / N + D V / N *
lattice(w), with absolute discount D.

Spark counts words by blocks of texts: a block's row holds its texts as
numbers of the block's own words, so texts are read once. Word totals are one
aggregation with map-side sums; each distinct word runs through the lattice
once, then totals and logs are joined to the (block, word) rows and cogrouped
with the texts of their block. Both inputs of that join come straight from
files, so Spark can split the partition of a common word. All that grows with
the corpus (words, blocks) stays in Spark; the driver gets one row of totals
and at most one row for each piece.

Defined cases: null text is empty and scores its end token; with no training
document N and V are 0 and the lattice alone scores; a null id is in no fold
and not trained on; repeated rows each count and are scored one by one; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import common as C

SIGN = "▁"
BLOCK_BYTES = 16 << 20
ROUNDS = 2
#: Words that one forward pass holds; longer words than LONG are walked one by one.
BATCH, LONG = 20_000, 48
#: Characters of a long word whose lattice is held at once in expectation maximisation.
STRIP = 1024
NONE = -np.inf


class Pieces:
    """The vocabulary as sorted substring hashes."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.byte = np.full(256, -1, np.int64)
        names, score = [], np.zeros(n + 1)
        for i in range(n):
            score[i] = sp.get_score(i)
            if sp.is_byte(i):
                self.byte[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                names.append((sp.id_to_piece(i), i))
        self.end, self.size = n, n + 1
        self.longest = max(len(p) for p, _ in names)
        rank = np.empty(n)
        rank[np.argsort(-score[:n], kind="stable")] = np.arange(n)
        self.prior = np.append(1.0 / (rank + 10.0), 1.0 / 10.0)
        self.prior /= self.prior.sum()
        hashes = np.array([int(self._hash_all([p])[0]) for p, _ in names], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array([i for _, i in names], np.int64)[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces share a hash")

    @staticmethod
    def _hash_all(pieces: list[str]) -> np.ndarray:
        out = np.zeros(len(pieces), np.uint64)
        for k, p in enumerate(pieces):
            h = np.zeros(1, np.uint64)
            for c in p:
                h = C.mix(h + np.uint64(ord(c) + 1))
            out[k] = h[0]
        return out

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Piece ids (characters x lengths; -1: none), byte log weights by character, word starts and sizes."""
        size = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        start = np.cumsum(size) - size
        left = np.repeat(start + size, size) - np.arange(len(points))  # characters to the word's end
        ids = np.full((len(points), self.longest), -1, np.int64)
        h, at = np.zeros(len(points), np.uint64), np.arange(len(points))
        for k in range(self.longest):
            at = at[left[at] > k]
            if len(at) == 0:
                break
            h[at] = C.mix(h[at] + points[at + k].astype(np.uint64) + np.uint64(1))
            spot = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
            ids[at, k] = np.where(self.hashes[spot] == h[at], self.ids[spot], -1)
        return ids, points, start, size

    def byte_ids(self, point: int) -> list[int]:
        return self.byte[list(chr(point).encode("utf-8", "surrogatepass"))].tolist()

    def weights(self, words: list[str], logp: np.ndarray):
        """Log weight of each edge; characters that are no piece get their bytes as the edge of length 1."""
        ids, points, start, size = self.edges(words)
        w = np.where(ids >= 0, logp[ids], NONE)
        foreign = np.flatnonzero(ids[:, 0] < 0)
        for point in np.unique(points[foreign]).tolist():
            w[foreign[points[foreign] == point], 0] = logp[self.byte_ids(point)].sum()
        return ids, points, w, start, size, foreign

    def forward(self, w: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Log sums over all segmentations of every prefix: words x (longest + 1)."""
        top = int(size.max(initial=0))
        alpha = np.full((len(size), top + 1), NONE)
        alpha[:, 0] = 0.0
        for t in range(1, top + 1):
            live = np.flatnonzero(size >= t)
            total = np.full(len(live), NONE)
            for k in range(1, min(t, self.longest) + 1):
                total = np.logaddexp(total, alpha[live, t - k] + w[start[live] + t - k, k - 1])
            alpha[live, t] = total
        return alpha

    def backward(self, w: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        top = int(size.max(initial=0))
        beta = np.full((len(size), top + 1), NONE)
        beta[np.arange(len(size)), size] = 0.0
        for t in range(top - 1, -1, -1):
            live = np.flatnonzero(size > t)
            total = np.full(len(live), NONE)
            for k in range(1, min(top - t, self.longest) + 1):
                total = np.logaddexp(total, np.where(t + k <= size[live], beta[live, t + k] + w[start[live] + t, k - 1], NONE))
            beta[live, t] = total
        return beta

    def _long(self, word: str, logp: np.ndarray) -> float:
        _, _, w, _, _, _ = self.weights([word], logp)
        alpha = np.full(len(word) + 1, NONE)
        alpha[0] = 0.0
        for t in range(1, len(word) + 1):
            k = np.arange(1, min(t, self.longest) + 1)
            alpha[t] = np.logaddexp.reduce(alpha[t - k] + w[t - k, k - 1])
        return float(alpha[-1])

    def log_prob(self, words: list[str], logp: np.ndarray) -> np.ndarray:
        """Log probability of each word over all its segmentations."""
        out = np.zeros(len(words))
        sizes = np.array([len(x) for x in words], np.int64)
        order = np.argsort(sizes, kind="stable")
        short = order[sizes[order] <= LONG]
        for k in range(0, len(short), BATCH):
            some = short[k: k + BATCH]
            _, _, w, start, size, _ = self.weights([words[i] for i in some], logp)
            alpha = self.forward(w, start, size)
            out[some] = alpha[np.arange(len(some)), size]
        for i in order[sizes[order] > LONG].tolist():
            out[i] = self._long(words[i], logp)
        return out

    def _add(self, total: np.ndarray, piece: np.ndarray, points: np.ndarray, p: np.ndarray) -> None:
        """Adds expected uses of edges; an edge that is no piece counts for the bytes of its character."""
        own = piece >= 0
        total += np.bincount(piece[own], weights=p[own], minlength=self.size)
        if not own.all():
            for point, x in zip(points[~own].tolist(), p[~own].tolist()):
                for b in self.byte_ids(point):
                    total[b] += x

    def _expected_long(self, word: str, uses: float, logp: np.ndarray, total: np.ndarray) -> None:
        """Adds the expected pieces of all uses of one long word; its lattice is held by strips."""
        n = len(word)

        def strip(a):
            m = min(STRIP, n - a)
            ids, points, w, _, _, _ = self.weights([word[a: a + m + self.longest]], logp)
            return ids[:m], points[:m], w[:m]

        alpha, beta = np.full(n + 1, NONE), np.full(n + self.longest + 1, NONE)
        alpha[0] = beta[n] = 0.0
        for a in range(0, n, STRIP):
            for i, w in enumerate(strip(a)[2], a):
                to = alpha[i + 1: i + 1 + self.longest]
                np.logaddexp(to, alpha[i] + w[: len(to)], out=to)
        for a in reversed(range(0, n, STRIP)):
            ids, points, w = strip(a)
            for i in range(a + len(w) - 1, a - 1, -1):
                beta[i] = np.logaddexp.reduce(w[i - a] + beta[i + 1: i + 1 + self.longest])
            for k in range(self.longest):
                at = np.flatnonzero(np.isfinite(w[:, k]))
                if len(at):
                    p = np.exp(alpha[a + at] + w[at, k] + beta[a + at + k + 1] - alpha[n])
                    self._add(total, ids[at, k], points[at], p * uses)

    def expected(self, words: list[str], logp: np.ndarray, uses: np.ndarray | None = None) -> np.ndarray:
        """Expected uses of each piece over the words, each used once or as often as ``uses`` says."""
        total = np.zeros(self.size)
        times = np.ones(len(words)) if uses is None else np.asarray(uses, float)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        every, times = [words[i] for i in order], times[order]
        while every and len(every[-1]) > STRIP:
            self._expected_long(every.pop(), times[len(every)], logp, total)
        k = 0
        while k < len(every):
            stop = k + 1  # words of at most BATCH * LONG characters with their padding
            while stop < len(every) and stop - k < BATCH and (stop - k + 1) * len(every[stop]) <= BATCH * LONG:
                stop += 1
            ids, points, w, start, size, _ = self.weights(every[k:stop], logp)
            n_uses, k = times[k:stop], stop
            alpha, beta = self.forward(w, start, size), self.backward(w, start, size)
            whole = alpha[np.arange(len(size)), size]
            owner = np.repeat(np.arange(len(size)), size)
            inside = np.arange(len(points)) - start[owner]
            for n in range(1, self.longest + 1):
                at = np.flatnonzero((inside + n <= size[owner]) & np.isfinite(w[:, n - 1]))
                if len(at) == 0:
                    continue
                o = owner[at]
                p = np.exp(alpha[o, inside[at]] + w[at, n - 1] + beta[o, inside[at] + n] - whole[o])
                self._add(total, ids[at, n - 1], points[at], p * n_uses[o])
        return total


_PIECES: dict[str, Pieces] = {}


def pieces(model_file: str) -> Pieces:
    if model_file not in _PIECES:
        _PIECES[model_file] = Pieces(model_file)
    return _PIECES[model_file]


# --- blocks -------------------------------------------------------------------

def _packed(columns: dict[str, pa.Array]) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table(columns)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(body)).read_all()


def blocks(docs: DataFrame, held_out, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Rows of two kinds: a block's texts (body, trained), and its words (word, code, n: uses in training)."""
    slim = docs.select(F.col(id_col).alias("id"), held_out.alias("held"), F.col(text_col).alias("text"))

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in _regrouped(batches, block_bytes):
            block = (part << 24) + number
            number += 1
            texts = C.lower_ascii(C.text_of(batch, "text"))
            words, row = C.words(texts)
            code, names = C.codes(words)
            held = pc.fill_null(batch.column(1), True).to_numpy(zero_copy_only=False)
            n = np.bincount(code[~held[row]], minlength=len(names)) if len(code) else np.zeros(len(names), np.int64)
            size = np.bincount(row, minlength=len(texts))
            body = _packed({"id": batch.column(0), "held": batch.column(1), "codes": pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(code.astype(np.int32)))})
            one = pa.nulls(1, pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([body], pa.binary()), pa.array([int((~held).sum())], pa.int64()), one,
                 pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64())], names=names_)
            for k in range(0, len(names), 100_000):
                some = names.slice(k, 100_000)
                m = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, block)), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), some,
                     pa.array(np.arange(k, k + m, dtype=np.int32)), pa.array(n[k: k + m].astype(np.int64))], names=names_)

    names_ = ["block", "body", "trained", "word", "code", "n"]
    return slim.mapInArrow(run, "block long, body binary, trained long, word string, code int, n long")


def _regrouped(batches, limit: int):
    """Batches joined to blocks of about ``limit`` bytes of text (one text is never cut)."""
    held, size = [], 0
    for part in C.slices(batches, "text", limit):
        n = pc.sum(pc.binary_length(part.column(2))).as_py() or 0
        if held and size + n > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(part)
        size += n
    if held:
        yield pa.concat_batches(held)


@dataclass
class Model:
    """What every task needs: totals of the training words and log probabilities of the pieces."""

    tokens: int
    kinds: int
    ends: int
    discount: float
    logp: np.ndarray

    def word_logs(self, count: np.ndarray, lattice: np.ndarray) -> np.ndarray:
        """Natural log probability of words with their training counts and lattice logs."""
        if self.tokens == 0:
            return lattice
        free = np.log(self.discount * self.kinds / self.tokens) + lattice
        own = np.where(count > 0, np.log(np.maximum(count - self.discount, 1e-300) / self.tokens), NONE)
        return np.logaddexp(own, free)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.kinds + 1)))


def fit(totals: DataFrame, ends: int, model_file: str, rounds: int = ROUNDS) -> Model:
    """Totals and piece probabilities from (word, c), one row a word; c: its uses in training."""
    seen = totals.where("c > 0")
    row = seen.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("n1"),
                   F.count(F.when(F.col("c") == 2, 1)).alias("n2")).first()
    tokens, kinds = (row.n or 0) + ends, row.v + (ends > 0)
    discount = min(0.95, max(0.1, row.n1 / (row.n1 + 2 * row.n2))) if row.n1 else 0.5
    p = pieces(model_file)
    logp = np.log(p.prior)
    for _ in range(rounds if kinds else 0):
        sent = totals.sparkSession.sparkContext.broadcast(logp)  # one number for each piece

        def count(batches):
            own, total = pieces(model_file), None
            for b in batches:
                got = own.expected([SIGN + w for w in b.column(0).to_pylist()], sent.value, b.column(1).to_numpy())
                total = got if total is None else total + got
            if total is not None:
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "n"])

        got = np.zeros(p.size)
        for r in (seen.select("word", "c").mapInArrow(count, "piece long, n double")
                  .groupBy("piece").agg(F.sum("n").alias("n")).collect()):
            got[r.piece] = r.n  # at most one row for each piece
        got[p.end] += ends
        mass = 0.01 * got.sum() + 1
        logp = np.log((got + mass * p.prior) / (got.sum() + mass))
    return Model(int(tokens), int(kinds), ends, float(discount), logp)


def lm_scores(docs: DataFrame, model_file: str, held_out=None, id_col: str = "doc_id", text_col: str = "text",
              block_bytes: int = BLOCK_BYTES, rounds: int = ROUNDS) -> DataFrame:
    """Id, held_out, n_tokens, n_known, train_tokens, base_score, score, mixture_score of every row."""
    spark = docs.sparkSession
    held_out = C.id_remainder(id_col) == 1 if held_out is None else held_out
    made = C.written(blocks(docs, held_out, id_col, text_col, block_bytes), "lm-blocks")
    texts = made.where("body is not null").select("block", "body", "trained")
    uses = made.where("body is null").select("word", "block", "code", "n")
    totals = C.written(uses.groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    ends = texts.agg(F.sum("trained")).first()[0] or 0
    model = fit(totals, ends, model_file, rounds)
    sent = spark.sparkContext.broadcast(model)  # one number for each piece

    def score(batches):
        own, m = pieces(model_file), sent.value
        for b in batches:
            lattice = own.log_prob([SIGN + w for w in b.column(0).to_pylist()], m.logp)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lattice)], names=["word", "c", "lattice"])

    logs = C.written(totals.mapInArrow(score, "word string, c long, lattice double"), "lm-logs")
    scored = uses.join(logs, "word").select(F.col("block").alias("block"), "code", "c", "lattice")
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        m, n = sent.value, right.num_rows
        code = right["code"].to_numpy()
        c, lattice = np.zeros(n, np.int64), np.zeros(n)
        for out, name in ((c, "c"), (lattice, "lattice")):
            out[code] = right[name].to_numpy()
        base, mixture = m.base(c), m.word_logs(c, lattice)
        parts = []
        for body in left["body"].to_pylist():  # one, as block numbers are distinct
            t = _unpacked(body)
            codes = t["codes"].combine_chunks()
            flat = codes.flatten().to_numpy(zero_copy_only=False)
            size = codes.value_lengths().to_numpy(zero_copy_only=False)
            row, k = np.repeat(np.arange(len(size)), size), len(size)

            def sums(x, row=row, flat=flat, k=k):
                return np.bincount(row, weights=x[flat], minlength=k) if len(flat) else np.zeros(k)

            end = np.array([m.ends])
            end_lattice = np.array([m.logp[-1]])
            parts.append(pa.table({
                "id": t["id"], "held_out": t["held"], "n_tokens": pa.array(size.astype(np.int64) + 1),
                "n_known": pa.array(sums((c > 0).astype(float)).astype(np.int64) + int(m.ends > 0)),
                "train_tokens": pa.array(np.full(k, m.tokens)),
                "base_score": pa.array(sums(base) + m.base(end)[0]),
                "score": pa.array((sums(lattice) + end_lattice[0]) / np.log(10)),
                "mixture_score": pa.array((sums(mixture) + m.word_logs(end, end_lattice)[0]) / np.log(10))}))
        return pa.concat_tables(parts)

    fields = (f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double, mixture_score double")
    out = texts.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(total, fields)
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return lm_scores(C.documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
