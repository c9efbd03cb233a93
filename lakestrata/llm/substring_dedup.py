"""Suffix-array dedup: exact shared substrings through run-length indexes.

Bytes of a text go if a string of ``span`` bytes that covers them also starts
in a text with a smaller id. A corpus is never indexed as a whole; its texts
are packed into blocks, and three steps narrow down what an index must hold:

1. Content-defined chunks. A chunk owns the windows (strings of ``span``
   bytes) that start in it. A chunk whose bytes, up to the end of its last
   window, equal those of a chunk in an earlier text is settled: all its
   windows go. This takes copies and near copies at the cost of a hash a chunk.
2. Anchors. Each window left is named by its least 24-byte substring hash, so equal
   windows share an anchor. Blocks send their sorted, distinct anchor hashes
   by ranges of the hash; a range tells each block which of its anchors some
   other text has too. Windows with other anchors are unique.
3. Run-length indexes. The windows that are left are sent as segments (the
   bytes of neighbouring windows with one anchor) to their anchor's range.
   There equal segments become one, and the rest form a text: its suffix array
   gives the Burrows-Wheeler transform, kept as runs with the suffix
   position at each run's ends. Only there a common prefix with the suffix
   above is compared; between samples it falls by one a byte, so matching
   statistics of the whole text stream from the samples. Rows whose statistic
   reaches ``span`` form intervals of equal windows, and windows that are not
   in the first text of their interval go.

An anchor at more than ``hot_places`` places (the ends of a passage that many
texts share, a frequent phrase) sends no segments: each of its windows goes to
the range of the hash of the whole window, where equal windows meet, so no range
grows with a hot anchor.

Hashes only choose what to compare: 48-bit anchors that collide cost work, not
correctness, and chunks, segments and windows of hot anchors are told apart by
128 bits.

Defined cases: null text is empty; texts shorter than ``span`` stay whole;
rows of equal id are one text for the rule (neither is smaller); a null id is
larger than every other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm import common as C

SPAN = 50
GRAM = 24
BLOCK_BYTES = 2 << 20
#: Text bytes of the corpus for each range of anchor hashes.
RANGE_BYTES = 4 << 20
#: Places of an anchor from which on its windows are spread by their own hashes.
HOT_PLACES = 4096
#: Places that are hashed together: what they need stays in a core's cache.
STEP = 1 << 14
CHUNK_MASK = np.uint64(511)
LAST = np.iinfo(np.int64).max


# --- packing ----------------------------------------------------------------

def packed(columns: dict[str, pa.Array] | pa.RecordBatch) -> bytes:
    """An Arrow stream, compressed as one: a block sends a small piece to each range, and a codec a column costs more than it."""
    import zstandard

    sink = pa.BufferOutputStream()
    table = columns if isinstance(columns, pa.RecordBatch) else pa.table(columns)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write(table)
    return zstandard.ZstdCompressor(level=5).compress(sink.getvalue())


def unpacked(body: bytes) -> pa.Table:
    import zstandard

    return pa.ipc.open_stream(pa.py_buffer(zstandard.ZstdDecompressor().decompress(body))).read_all().combine_chunks()


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as compressed byte planes of their differences."""
    import zstandard

    step = np.diff(values, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=3).compress(step.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_sorted(body: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


# --- one block ----------------------------------------------------------------

_BYTE = C.mix(np.arange(1, 257, dtype=np.uint64))


def gram_hashes(body: np.ndarray) -> np.ndarray:
    """64-bit hash of every substring of GRAM bytes."""
    out = np.empty(max(0, len(body) - GRAM + 1), np.uint64)
    for a in range(0, len(out), STEP):
        out[a: a + STEP] = _step_hashes(body[a: a + STEP + GRAM - 1])
    return out


def _step_hashes(body: np.ndarray) -> np.ndarray:
    """Put together from powers of two."""
    h, power, n = _BYTE[body], np.uint64(0x9E3779B97F4A7C15), 1
    out, size = None, 0
    while True:
        if GRAM & n:  # the part of n bytes behind what is there
            if out is None:
                out = h
            else:
                m = min(len(out), len(h) - size)
                out = out[:m] * power + h[size: size + m]
            size += n
        n *= 2
        if n > GRAM:
            return C.mix(out)
        h = h[: -(n // 2)] * power + h[n // 2:]
        power = power * power


class Block:
    """Texts of a block as bytes with everything that follows from their content."""

    def __init__(self, texts: pa.Array, order: np.ndarray, span: int):
        self.body, self.offsets = C.raw(texts)
        self.order, self.span, n = order, span, len(self.body)
        size = np.diff(self.offsets)
        windows = np.maximum(size - span + 1, 0)  # of each text
        edge = np.zeros(n + 1, np.int8)
        some = windows > 0
        edge[self.offsets[:-1][some]] += 1
        edge[(self.offsets[:-1] + windows)[some]] -= 1
        self.valid = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)  # bytes at which a window starts
        self.start = np.flatnonzero(self.valid)
        self.owner = np.repeat(np.arange(len(size), dtype=np.int32), windows)
        if len(self.start) == 0:
            self.hash = np.zeros(0, np.uint64)
            return
        with np.errstate(over="ignore"):
            self.hash = gram_hashes(self.body)

    def chunks(self) -> tuple[np.ndarray, np.ndarray]:
        """First window start and number of windows of each chunk."""
        if len(self.start) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cut = np.flatnonzero((self.hash & CHUNK_MASK) == 0)
        near = (np.diff(cut) <= GRAM) & (self.hash[cut[1:]] == self.hash[cut[:-1]])  # short periods cut nowhere
        bad = np.zeros(len(cut), bool)
        bad[1:] |= near
        bad[:-1] |= near
        cut = cut[~bad]
        first = np.flatnonzero(np.diff(self.owner, prepend=-1))
        at = np.union1d(np.searchsorted(self.start, cut[self.valid[cut]]), first)
        return self.start[at], np.diff(np.append(at, len(self.start)))

    def anchors(self) -> np.ndarray:
        """Of each window the place of its least gram (the last of equal ones)."""
        if len(self.start) == 0:
            return np.zeros(0, np.int64)
        full, grams = np.uint64(0xFFFFFFFF), self.span - GRAM + 1
        out = np.empty(len(self.hash) - grams + 1, np.int64)
        for a in range(0, len(out), STEP):
            h, n = self.hash[a: a + STEP + grams - 1], 1
            key = (h >> np.uint64(32) << np.uint64(32)) | (full - np.arange(a, a + len(h), dtype=np.uint64))
            while 2 * n <= grams:
                key = np.minimum(key[:-n], key[n:])
                n *= 2
            if n < grams:
                key = np.minimum(key[: len(key) - (grams - n)], key[grams - n:])
            out[a: a + STEP] = full - (key & full)
        return out[self.start]

    def used(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct anchors and, for each window, the number of its own among them."""
        mark = np.zeros(len(self.body), bool)
        mark[at] = True
        return np.flatnonzero(mark), (np.cumsum(mark, dtype=np.int32) - 1)[at]

    def names(self, at: np.ndarray) -> np.ndarray:
        """48-bit names of anchors; other bits than those that order them come first."""
        return C.mix(self.hash[at] + np.uint64(1)) >> np.uint64(16)


def _digests(body: bytes, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    from xxhash import xxh3_128_intdigest

    got = [xxh3_128_intdigest(body[a:b]) for a, b in zip(begin.tolist(), stop.tolist())]
    low = np.array([x & 0xFFFFFFFFFFFFFFFF for x in got], np.uint64)
    return np.array([x >> 64 for x in got], np.uint64).view(np.int64), low.view(np.int64)


def _regrouped(batches, limit: int):
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


BLOCK_FIELDS = ("block long, body binary, start int, n int, h1 long, h2 long, rank long, range long")


def _row(size: int, **given) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "body": pa.binary(), "start": pa.int32(), "n": pa.int32(), "h1": pa.int64(),
             "h2": pa.int64(), "rank": pa.int64(), "range": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array(given[k], t) if k in given else pa.nulls(size, t) for k, t in kinds.items()], names=list(kinds))


def _blocks(docs: DataFrame, span: int, block_bytes: int) -> DataFrame:
    """Two kinds of rows: bodies (start null) and chunks."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in _regrouped(batches, block_bytes):
            block = (part << 24) + number
            number += 1
            texts, rank = C.text_of(batch, "text"), batch.column(1).to_numpy()
            yield _row(1, block=[block], body=[packed({"id": batch.column(0), "rank": batch.column(1), "text": texts})])
            b = Block(texts, rank, span)
            start, n = b.chunks()
            if len(start) == 0:
                continue
            h1, h2 = _digests(b.body.tobytes(), start, start + n + span - 1)
            text = np.searchsorted(b.offsets, start, side="right") - 1
            yield _row(len(start), block=np.full(len(start), block), start=start, n=n, h1=h1, h2=h2, rank=rank[text])

    return docs.mapInArrow(run, BLOCK_FIELDS)


def _opened(body: bytes, settled: pa.Table, span: int) -> tuple[Block, np.ndarray]:
    """A block and the mask of its windows that no settled chunk owns."""
    t = unpacked(body)
    b = Block(t["text"].chunk(0) if t.num_rows else pa.array([], pa.string()), t["rank"].to_numpy(), span)
    return b, ~_marked(b, settled["start"].to_numpy(), settled["n"].to_numpy())


def _anchors(left: pa.Table, right: pa.Table, span: int, ranges: int) -> pa.Table:
    """The anchors of a block's open windows, sorted, by ranges.

    The lowest bit says that two of its texts have one, the four above it hold
    the logarithm of the number of its places in the block.
    """
    out = [_row(0)]
    for block, body in zip(left["block"].to_pylist(), left["body"].to_pylist()):
        b, open_ = _opened(body, right, span)
        at = b.used(b.anchors()[open_])[0]
        if len(at) == 0:
            continue
        name, own = b.names(at), b.order[np.searchsorted(b.offsets, at, side="right") - 1]
        order = np.lexsort((own, name))
        name, own = name[order], own[order]
        head = np.flatnonzero(np.diff(name, prepend=~name[:1]) != 0)
        several = np.minimum.reduceat(own, head) != np.maximum.reduceat(own, head)
        places = np.minimum(np.ceil(np.log2(np.diff(np.append(head, len(name))))), 15).astype(np.uint64)
        value = (name[head] << np.uint64(5)) | (places << np.uint64(1)) | several.astype(np.uint64)
        which = _range_of(name[head], ranges)
        edges = np.flatnonzero(np.diff(which, prepend=-1))
        out.append(_row(len(edges), block=np.full(len(edges), block), range=which[edges],
                        body=[pack_sorted(x) for x in np.split(value, edges[1:])]))
    return pa.Table.from_batches(out)


def _range_of(name: np.ndarray, ranges: int) -> np.ndarray:
    return ((name >> np.uint64(16)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _shared(table: pa.Table, hot_places: int) -> pa.Table:
    """For each block the anchors of one range that occur in two texts or more; the lowest bit says that one is hot."""
    blocks, values = table["block"].to_pylist(), [unpack_sorted(x) for x in table["body"].to_pylist()]
    every = np.sort(np.concatenate(values))
    name = every >> np.uint64(5)
    first = np.concatenate(([True], name[1:] != name[:-1]))
    head = np.flatnonzero(first)
    size = np.diff(np.append(head, len(name)))
    flagged = np.maximum.reduceat(every & np.uint64(1), head) == 1
    places = np.add.reduceat(np.uint64(1) << ((every >> np.uint64(1)) & np.uint64(15)), head)
    shared = (size > 1) | flagged
    known, hot = name[head][shared], (places > hot_places)[shared].astype(np.uint64)
    out = []
    for v in values:
        own = v >> np.uint64(5)
        at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
        out.append(((own << np.uint64(1)) | hot[at])[known[at] == own] if len(known) else own[:0])
    keep = [k for k, x in enumerate(out) if len(x)]
    return pa.table({"block": pa.array([blocks[k] for k in keep], pa.int64()),
                     "body": pa.array([pack_sorted(out[k]) for k in keep], pa.binary())})


def _segments(left: pa.Table, right: pa.Table, span: int, ranges: int) -> list[pa.RecordBatch]:
    """Windows of a block that are not settled and have a shared anchor, as segments for the ranges.

    Windows with a hot anchor go one by one to further ranges, by their own hashes.
    """
    out = []
    sets = [unpack_sorted(x) for x in right["body"].to_pylist() if x is not None]
    if not sets:
        return out
    known = np.sort(np.concatenate(sets))
    known, hot = known >> np.uint64(1), (known & np.uint64(1)).astype(bool)
    settled = right.filter(pc.is_valid(right["start"]))
    for block, body in zip(left["block"].to_pylist(), left["body"].to_pylist()):
        b, open_ = _opened(body, settled, span)
        if not open_.any():
            continue
        at = b.anchors()
        used, inverse = b.used(at)
        name = b.names(used)
        spot = np.minimum(np.searchsorted(known, name), len(known) - 1)
        data = b.body.tobytes()
        live = open_ & (known[spot] == name)[inverse]
        single = np.flatnonzero(live & hot[spot][inverse])
        if len(single):
            start, rank = b.start[single], b.order[b.owner[single]]
            h1, h2 = _digests(data, start, start + span)
            again = rank > _least(h1, h2, rank)
            if again.any():
                first, n = _joined(start[again])
                out.append(_row(len(first), block=np.full(len(first), block), start=first, n=n))
            which = ranges + _range_of(h1.view(np.uint64) >> np.uint64(16), ranges)
            out.append(_by_range(block, which, ~again, {"start": start.astype(np.int32), "rank": rank, "h1": h1, "h2": h2}))
        live = np.flatnonzero(live & ~hot[spot][inverse])
        if len(live) == 0:
            continue
        head = np.flatnonzero(np.concatenate(([True], (np.diff(live) != 1) | (np.diff(at[live]) != 0) | (np.diff(b.owner[live]) != 0))))
        first = live[head]
        n = np.diff(np.append(head, len(live)))
        start, rank = b.start[first], b.order[b.owner[first]]
        stop = start + n + span - 1
        h1, h2 = _digests(data, start, stop)
        again = rank > _least(h1, h2, rank)  # an earlier text of this block has the same segment
        if again.any():
            out.append(_row(int(again.sum()), block=np.full(int(again.sum()), block), start=start[again], n=n[again]))
        which = _range_of(name[inverse[first]], ranges)
        out.append(_by_range(block, which, ~again, {
            "start": start.astype(np.int32), "rank": rank, "anchor": name[inverse[first]].view(np.int64), "h1": h1, "h2": h2,
            "data": pa.array([data[i:j] for i, j in zip(start.tolist(), stop.tolist())], pa.binary())}))
    return out


def _least(h1: np.ndarray, h2: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of each row the smallest rank among the rows of its hash."""
    group = np.lexsort((rank, h2, h1))
    new = np.concatenate(([True], (np.diff(h1[group]) != 0) | (np.diff(h2[group]) != 0)))
    least = np.empty(len(group), np.int64)
    least[group] = rank[group][np.flatnonzero(new)][np.cumsum(new) - 1]
    return least


def _joined(start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted window starts as runs (first, n); windows of two texts are never neighbours."""
    head = np.flatnonzero(np.diff(start, prepend=-2) != 1)
    return start[head], np.diff(np.append(head, len(start)))


def _by_range(block: int, which: np.ndarray, mask: np.ndarray, columns: dict) -> pa.RecordBatch:
    """A row for each range with the rows that go there, in their order."""
    rows = np.flatnonzero(mask)
    rows = rows[np.argsort(which[rows], kind="stable")]
    edges = np.flatnonzero(np.diff(which[rows], prepend=-1))
    every = pa.RecordBatch.from_pydict({k: pa.array(v).take(pa.array(rows)) for k, v in columns.items()})
    bodies = [packed(every.slice(a, b - a)) for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(rows)])]
    return _row(len(edges), block=np.full(len(edges), block), range=which[rows[edges]], body=bodies)


def _marked(b: Block, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Mask of the windows in runs of n windows from the given starts."""
    edge = np.zeros(len(b.start) + 1, np.int64)
    first = np.searchsorted(b.start, start)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + n, -1)
    return np.cumsum(edge[:-1]) > 0


# --- run-length index -----------------------------------------------------------

def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of symbols below 512, by doubling from seven packed symbols on."""
    n = len(text)
    wide = np.concatenate((text.astype(np.uint64), np.zeros(7, np.uint64)))
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = (key << np.uint64(9)) | wide[k: n + k]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
    rank[order] = new
    h = 7
    while new[-1] < n - 1:
        # only suffixes of unsettled ranks move, inside their rank's rows
        tied = np.zeros(n, bool)
        same = new[1:] == new[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        rows = np.flatnonzero(tied)
        place = order[rows]
        ahead = np.where(place + h < n, rank[np.minimum(place + h, n - 1)] + 1, 0)
        sub = np.lexsort((ahead, new[rows]))
        order[rows] = place[sub]
        step = np.concatenate(([True], same == False))  # noqa: E712
        a, g = ahead[sub], new[rows][sub]
        split = np.zeros(n, bool)
        split[rows[1:]] = (a[1:] != a[:-1]) & (g[1:] == g[:-1])
        new = np.cumsum(step | split) - 1
        rank[order] = new
        h *= 2
    return order


class RunLengthIndex:
    """Runs of the Burrows-Wheeler transform with sampled ends."""

    def __init__(self, text: np.ndarray):
        self.text, n = text, len(text)
        order = suffix_array(text)
        transform = text[order - 1]
        self.head = np.flatnonzero(np.concatenate(([True], transform[1:] != transform[:-1])))  # run starts
        self.symbol = transform[self.head]
        self.first = order[self.head]  # suffix positions at run starts ...
        self.last = order[np.append(self.head[1:], n) - 1]  # ... and at run ends
        self.order = order

    def matching(self, starts: np.ndarray, most: int) -> np.ndarray:
        """For each position, the common prefix with the suffix above it in the array.

        Exact inside a segment of up to ``most`` symbols: besides the run
        starts, the segments' ``starts`` are sampled, so a statistic never
        comes from another segment's sample.
        """
        n = len(self.text)
        row_of = np.empty(n, np.int64)
        row_of[self.order] = np.arange(n)
        rows = row_of[starts]
        place = np.concatenate((self.first, starts))
        above = np.concatenate(([-1], self.last[:-1], np.where(rows > 0, self.order[rows - 1], -1)))
        place, once = np.unique(place, return_index=True)
        above = above[once]
        length, live = np.zeros(len(above), np.int64), np.flatnonzero(above >= 0)
        for k in range(most):
            a, b = place[live] + k, above[live] + k
            same = (a < n) & (b < n)
            same[same] = self.text[a[same]] == self.text[b[same]]
            live = live[same]
            if len(live) == 0:
                break
            length[live] += 1
        run = np.searchsorted(place, np.arange(n), side="right") - 1
        # between samples the prefix falls by one a symbol
        return np.where(run >= 0, np.maximum(length[run] - (np.arange(n) - place[run]), 0), 0)


def later_windows(segments: list[bytes], rank: np.ndarray, span: int) -> list[np.ndarray]:
    """Per segment, a mask of its windows that also lie in a segment of a smaller rank."""
    size = np.array([len(s) for s in segments], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    text = np.zeros(int((size + 1).sum()) + 1, np.int64)
    body = np.frombuffer(b"\0".join([*segments, b""]), np.uint8).astype(np.int64) + 2
    text[: len(body)] = body
    text[begin + size] = 1  # a break after each segment, 0 at the end of all
    index = RunLengthIndex(text)
    longest = int(size.max())
    prefix = index.matching(begin, longest)[index.order]
    head = np.flatnonzero(prefix < span)
    head = head if len(head) and head[0] == 0 else np.append(0, head)
    of = np.append(np.repeat(np.arange(len(size)), size + 1), len(size))
    own = np.append(rank, LAST)[of][index.order]
    least = np.minimum.reduceat(own, head)
    row_least = np.repeat(least, np.diff(np.append(head, len(own))))
    late = np.zeros(len(text), bool)
    late[index.order] = row_least < own
    return [late[a: a + n - span + 1] for a, n in zip(begin.tolist(), size.tolist())]


def _indexed(table: pa.Table, span: int) -> pa.Table:
    """Runs of windows (block, start, n) of one range that go."""
    parts = [unpacked(x) for x in table["body"].to_pylist()]
    block = np.repeat(table["block"].to_numpy(), [p.num_rows for p in parts])
    t = pa.concat_tables(parts).combine_chunks()
    start, rank, h1, h2 = (t[k].to_numpy() for k in ("start", "rank", "h1", "h2"))
    if "data" not in t.column_names:  # windows of hot anchors
        late = rank > _least(h1, h2, rank)
        return pa.table({"block": pa.array(block[late], pa.int64()), "start": pa.array(start[late], pa.int32()),
                         "n": pa.array(np.ones(int(late.sum()), np.int32))})
    anchor = t["anchor"].to_numpy()
    data, n = t["data"], pc.binary_length(t["data"]).to_numpy().astype(np.int64) - span + 1
    order = np.lexsort((rank, h2, h1, anchor))
    new = np.concatenate(([True], (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0) | (np.diff(anchor[order]) != 0)))
    kind = np.empty(len(order), np.int64)  # number of the distinct segment
    kind[order] = np.cumsum(new) - 1
    rep = order[new]  # its copy of the smallest rank
    _, inverse, alone = np.unique(anchor[rep], return_inverse=True, return_counts=True)
    several = np.flatnonzero(alone[inverse] > 1)  # anchors with two different segments
    several = several[np.argsort(rank[rep[several]], kind="stable")]
    masks: dict[int, np.ndarray] = {}
    if len(several):
        got = later_windows(data.take(pa.array(rep[several])).to_pylist(), rank[rep[several]], span)
        masks = {k: m for k, m in zip(several.tolist(), got) if m.any()}
    late = rank > rank[rep[kind]]  # equal segment, earlier text
    out_block, out_start, out_n = block[late].tolist(), start[late].tolist(), n[late].tolist()
    for i in np.flatnonzero(~late & np.isin(kind, list(masks))).tolist() if masks else []:
        m = np.diff(np.concatenate(([0], masks[int(kind[i])].view(np.int8), [0])))
        for a, b in zip(np.flatnonzero(m == 1).tolist(), np.flatnonzero(m == -1).tolist()):
            out_block.append(block[i])
            out_start.append(start[i] + a)
            out_n.append(b - a)
    return pa.table({"block": pa.array(out_block, pa.int64()), "start": pa.array(out_start, pa.int32()),
                     "n": pa.array(out_n, pa.int32())})


# --- result -------------------------------------------------------------------------

def _removed(left: pa.Table, right: pa.Table, span: int, kind: pa.DataType) -> pa.Table:
    """(id, n_bytes, starts, stops, kept_sha256) of the texts of a block."""
    names = ["id", "n_bytes", "starts", "stops", "kept_sha256"]
    out = [pa.table([pa.array([], t) for t in (kind, pa.int64(), *[pa.list_(pa.int64())] * 2, pa.string())], names)]
    for body in left["body"].to_pylist():
        t = unpacked(body)
        texts = t["text"].chunk(0) if t.num_rows else pa.array([], pa.string())
        bytes_, offsets = C.raw(texts)
        edge = np.zeros(len(bytes_) + 1, np.int64)
        if right.num_rows:
            a = right["start"].to_numpy().astype(np.int64)
            np.add.at(edge, a, 1)
            np.add.at(edge, a + right["n"].to_numpy() + span - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        first, last = gone.copy(), gone.copy()  # bytes at which a removed run begins, and ends
        some = np.diff(offsets) > 0
        before, behind = gone[:-1].copy(), gone[1:].copy()
        inner = offsets[:-1][some][1:]  # a run ends with its text
        before[inner - 1] = False
        behind[inner - 1] = False
        first[1:] &= ~before
        last[:-1] &= ~behind
        starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
        owner = np.searchsorted(offsets, starts, side="right") - 1
        lists = pa.array(np.searchsorted(starts, offsets).astype(np.int32))
        data = bytes_[~gone].tobytes()
        kept = offsets - np.concatenate(([0], np.cumsum(gone)))[offsets]
        out.append(pa.table([
            t["id"].cast(kind), np.diff(offsets),
            *(pa.ListArray.from_arrays(lists, pa.array(x - offsets[owner])) for x in (starts, stops)),
            pa.array([hashlib.sha256(data[i:j]).hexdigest() for i, j in zip(kept[:-1].tolist(), kept[1:].tolist())], pa.string())],
            names))
    return pa.concat_tables(out)


def removed_spans(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES, hot_places: int = HOT_PLACES) -> DataFrame:
    """Id, n_bytes, starts, stops (byte spans that go) and kept_sha256 of every row."""
    from pyspark.sql.pandas.types import to_arrow_type

    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("rank"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = slim.schema["id"].dataType
    kind = to_arrow_type(id_type)
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, total // range_bytes)
    made = C.written(_blocks(slim, span, block_bytes), "spans-blocks")
    bodies = made.where("start is null").select("block", "body")
    chunks = made.where("start is not null").select("block", "start", "n", "h1", "h2", "rank")
    earliest = C.written(chunks.groupBy("h1", "h2").agg(F.min("rank").alias("first"), F.count("*").alias("copies"))
                         .where("copies > 1").drop("copies"), "spans-chunks")
    settled = C.written(chunks.join(earliest, ["h1", "h2"]).where("rank > first").select("block", "start", "n"), "spans-settled")
    anchors = bodies.groupBy("block").cogroup(settled.groupBy("block")).applyInArrow(
        lambda a, b: _anchors(a, b, span, ranges), BLOCK_FIELDS)
    shared = anchors.select("range", "block", "body").groupBy("range").applyInArrow(
        lambda t: _shared(t, hot_places), "block long, body binary")
    told = settled.select("block", "start", "n", F.lit(None).cast("binary").alias("body")).unionByName(
        shared.select("block", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("n"), "body"))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        got = _segments(left, right, span, ranges)
        return pa.Table.from_batches(got) if got else pa.Table.from_batches([_row(0)])

    sent = C.written(bodies.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(cut, BLOCK_FIELDS), "spans-segments")
    found = (sent.where("range is not null").select("range", "block", "body").groupBy("range")
             .applyInArrow(lambda t: _indexed(t, span), "block long, start int, n int"))
    gone = settled.unionByName(sent.where("range is null").select("block", "start", "n")).unionByName(found)
    out = bodies.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(
        lambda a, b: _removed(a, b, span, kind),
        f"id {id_type.simpleString()}, n_bytes long, starts array<long>, stops array<long>, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    found = removed_spans(C.documents(spark, sf_dir))
    gone = F.aggregate(F.zip_with("starts", "stops", lambda a, b: b - a), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), "kept_sha256")
