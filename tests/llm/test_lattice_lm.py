import collections
import functools
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import lattice_lm as L
from tests.llm.conftest import lower, words

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@functools.cache
def vocabulary():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}


def slow_pieces(word, p):
    """Every piece that some segmentation can use."""
    ids, points, _, _ = p.edges([word])
    return {int(i) for i in ids[ids >= 0]} | {b for t, x in zip(ids[:, 0], points) if t < 0 for b in p.byte_ids(int(x))}


def slow_uses(word, piece, logp, p, whole):
    """Expected uses of a piece: the slope of the log likelihood in its log probability."""
    step = 1e-4
    up, down = logp.copy(), logp.copy()
    up[piece] += step
    down[piece] -= step
    return (slow_word(word, up, p) - slow_word(word, down, p)) / (2 * step)


def slow_word(word, logp, p):
    """Sum over all segmentations by recursion."""
    known = vocabulary()

    def go(t):
        if not t:
            return 1.0
        total = sum(math.exp(logp[known[t[:k]]]) * go(t[k:]) for k in range(1, min(16, len(t)) + 1) if t[:k] in known)
        if t[0] not in known:
            total += math.exp(sum(logp[i] for i in p.byte_ids(ord(t[0])))) * go(t[1:])
        return total

    return math.log(go(word))


def test_forward_sums_all_segmentations():
    p = L.pieces(MODEL)
    logp = np.log(p.prior)
    some = ["▁the", "▁thehat", "▁a\U0001f680b", "▁", "▁éañ", "▁\x01x"]
    assert np.allclose(p.log_prob(some, logp), [slow_word(w, logp, p) for w in some])
    long = "▁" + "ab" * 60
    w = p.weights([long], logp)
    assert np.isclose(p.log_prob([long], logp)[0], p.forward(w[2], w[3], w[4])[0, -1])


def test_expected_uses_cover_every_character():
    p = L.pieces(MODEL)
    some = ["▁hello", "▁theatre", "▁x"]
    got = p.expected(some, np.log(p.prior))
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    used = np.flatnonzero(got)
    assert np.isclose(sum(got[i] * len(sp.id_to_piece(int(i))) for i in used), sum(map(len, some)))


def brute(rows):
    tokens = [[*words(lower(t or "")), None] for _, t in rows]
    fold = [None if i is None else zlib.crc32(str(i).encode()) % 5 for i, _ in rows]
    c = collections.Counter(x for w, f in zip(tokens, fold) if f not in (1, None) for x in w)
    n, v = sum(c.values()), len(c)
    return [(str(i), None if f is None else f == 1, len(w), sum(c[x] > 0 for x in w), n,
             round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 5)) for (i, _), f, w in zip(rows, fold, tokens)]


@pytest.mark.parametrize("block", [1 << 24, 2000])
def test_counts_and_base_match_brute_force(make_docs, edge_rows, small_docs, block):
    rows = [*edge_rows, *((i + 100, t) for i, t, _ in small_docs[:60])]
    out = L.lm_scores(make_docs(rows), MODEL, block_bytes=block, rounds=1).collect()
    assert sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out), key=repr) == \
        sorted(brute(rows), key=repr)
    assert all(math.isfinite(r.score) and r.score < 0 and r.mixture_score >= r.score - 2 * r.n_tokens for r in out)


@pytest.mark.parametrize("rounds,block", [(0, 1 << 24), (2, 2000)])
def test_score_is_the_likelihood_over_all_segmentations(make_docs, rounds, block):
    """EM and scores by recursion in plain Python, over whole texts."""
    texts = ["the cat\tsat", "The hat", "", None, "café \U0001f680b the the", "x1 <s> ▁y", "cats", "the cat sat " * 3]
    rows = [(i, t) for i, t in enumerate(texts * 3)]
    p = L.pieces(MODEL)
    train = [words(lower(t or "")) for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    used, logp = collections.Counter(w for t in train for w in t), np.log(p.prior)
    for _ in range(rounds):
        got = np.zeros(p.size)
        for w, n in used.items():
            whole = slow_word("▁" + w, logp, p)
            for i in slow_pieces("▁" + w, p):
                got[i] += n * slow_uses("▁" + w, i, logp, p, whole)
        got[p.end] += len(train)
        mass = 0.01 * got.sum() + 1
        logp = np.log((got + mass * p.prior) / (got.sum() + mass))
    want = {i: (sum(slow_word("▁" + w, logp, p) for w in words(lower(t or ""))) + logp[-1]) / math.log(10) for i, t in rows}
    out = {r.doc_id: r.score for r in L.lm_scores(make_docs(rows), MODEL, block_bytes=block, rounds=rounds).collect()}
    assert out.keys() == want.keys() and all(math.isclose(out[i], want[i], rel_tol=1e-6) for i in want)


def test_no_training_rows_and_empty_table(make_docs):
    only = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    out = L.lm_scores(make_docs([(i, "some words") for i in only]), MODEL).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in out] == [(0, 0, 0.0)] * 3
    assert all(math.isfinite(r.score) for r in out)
    assert L.lm_scores(make_docs([]), MODEL).count() == 0


def test_held_out_text_is_likelier_than_shuffled_letters(make_docs, small_docs):
    rng = np.random.default_rng(2)
    held = [i for i, _, _ in small_docs if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(i, t) for i, t, _ in small_docs]
    texts = dict(rows)
    noise = {10_000 + k: " ".join("".join(rng.permutation(list(w))) for w in words(texts[i])) for k, i in enumerate(held)}
    fold = {i: j for i, j in zip(noise, held)}
    out = {r.doc_id: r.score for r in L.lm_scores(
        make_docs([*rows, *noise.items()]), MODEL,
        held_out=F.expr("doc_id >= 10000 or crc32(cast(cast(doc_id as string) as binary)) % 5 = 1"),
    ).collect()}
    assert np.mean([out[j] > out[i] for i, j in fold.items() if len(words(texts[j])) > 3]) > 0.95


def test_expectation_counts_long_words():
    import numpy as np
    import public_tokenizers

    p = L.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    logp = np.log(p.prior)
    rng = np.random.default_rng(5)
    for n in (49, 300, 1024, 1025, 2600):
        word = L.SIGN + "".join(rng.choice(list("abcdeinrst梦é🙂語"), n - 1))
        ids, points, w, _, _, foreign = p.weights([word], logp)
        a, b = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        a[0] = b[n] = 0.0
        for t in range(1, n + 1):
            for k in range(1, min(t, p.longest) + 1):
                a[t] = np.logaddexp(a[t], a[t - k] + w[t - k, k - 1])
        for t in range(n - 1, -1, -1):
            for k in range(1, min(n - t, p.longest) + 1):
                b[t] = np.logaddexp(b[t], w[t, k - 1] + b[t + k])
        want = np.zeros(p.size)
        for t in range(n):
            for k in range(1, min(n - t, p.longest) + 1):
                x = np.exp(a[t] + w[t, k - 1] + b[t + k] - a[n])
                for piece in [ids[t, k - 1]] if ids[t, k - 1] >= 0 else p.byte_ids(points[t]) if k == 1 else []:
                    want[piece] += x
        got = p.expected([word, "short"], logp) - p.expected(["short"], logp)
        assert want.sum() > 0 and np.allclose(got, want, atol=1e-8)
