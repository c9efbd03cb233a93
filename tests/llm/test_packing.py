import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm import packing as P

FILE = public_tokenizers.path("word_bpe_49k.json")


def layout(counts, capacity):
    """(sequence -> [(offset, length)]) of a plan."""
    out = defaultdict(list)
    for length, rank, n, first, offset in P.plan(counts, capacity).tolist():
        for k in range(n):
            out[first + k].append((offset, length))
    return out


def fewest(sizes, capacity):
    """Exact minimum of bins, by search."""
    best = len(sizes)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + sizes[k] <= capacity:
                go(k + 1, [*bins[:i], bins[i] + sizes[k], *bins[i + 1:]])
        go(k + 1, [*bins, sizes[k]])

    go(0, [])
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_plan_places_every_piece_once_and_reduction_is_safe(sizes):
    counts = np.bincount(sizes, minlength=21)
    bins = layout(counts, 20)
    assert sorted(n for b in bins.values() for _, n in b) == sorted(sizes)
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 20
    # dominance: fixing sets keeps the optimum
    runs = P.Runs(counts)
    left = P.reduce(counts.copy(), 20, runs)
    rest = sorted(np.repeat(np.arange(21), left).tolist(), reverse=True)
    assert runs.sequences + fewest(rest, 20) == fewest(sorted(sizes, reverse=True), 20)


def test_many_pieces_stay_near_the_bound():
    rng = np.random.default_rng(3)
    sizes = np.minimum(2048, rng.geometric(0.002, 50_000))
    counts = np.bincount(sizes, minlength=2049)
    n = P.plan(counts)[:, 3:4].size and len(layout(counts, 2048))
    assert n <= 1.002 * -(-int(sizes.sum()) // 2048) + 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aBtheé.,;:!?' \n<|>-0İßΣ̸梦", max_size=40), max_size=5))
def test_ids_match_the_library(texts):
    encoder = P.Encoder(FILE)
    ids, offsets = encoder.encode(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, offsets, offsets[1:]):
        assert ids[a:b].tolist() == [*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 0]


def test_new_words_of_letters_share_a_call():
    rng = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyzßàéöøÿ")
    names = list(dict.fromkeys("".join(rng.choice(letters, rng.integers(1, 12))) for _ in range(3000)))
    texts = [" ".join(names[k: k + 40]) + end for k, end in zip(range(0, len(names), 40), ["", " ", ".", "$$$ #", "...'s", "\t it's 10%", "é̸"] * 99)]
    encoder = P.Encoder(FILE)
    library, sent = encoder.tokenizer, []

    class Counting:
        def encode_batch_fast(self, given, **more):
            sent.extend(given)
            return library.encode_batch_fast(given, **more)

    encoder.tokenizer = Counting()
    for some in (texts[:30], texts, [], ["", "a"]):
        ids, offsets = encoder.encode(pa.array(some, pa.string()))
        assert len(ids) == offsets[-1] and len(offsets) == len(some) + 1
        for t, a, b in zip(some, offsets, offsets[1:]):
            assert ids[a:b].tolist() == [*library.encode(t, add_special_tokens=False).ids, 0]
    assert len(sent) < len(names) / 20


def check(rows, out):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(str(i), k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(np.array(ids[k:k + 2048], "<u4").tobytes()))
                 for k in range(0, len(ids), 2048)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    by = defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for b in by.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 2048


def test_operator(make_docs, edge_rows, small_docs):
    rows = [*edge_rows, *((i, t) for i, t, _ in small_docs)]
    check(rows, P.pack(make_docs(rows, 5), FILE).collect())
    assert P.pack(make_docs([]), FILE).count() == 0
