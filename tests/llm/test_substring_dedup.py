import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm import substring_dedup as S


def brute(rows, span):
    big = 1 << 62
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - span + 1):
            key = b[k:k + span]
            first[key] = min(first.get(key, big), big if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - span + 1):
            if first[b[k:k + span]] < (big if i is None else i):
                gone[k:k + span] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((str(i), len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_bytes, sum(b - a for a, b in zip(r.starts, r.stops)), len(r.starts), r.kept_sha256) for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=24).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=12, unique=True), st.integers(1, 6))
def test_run_length_index_against_brute_force(segments, span):
    segments = [s for s in segments if len(s) >= span]
    if not segments:
        return
    rank = np.arange(len(segments)) // 2
    first = {}
    for s, r in zip(segments, rank):
        for k in range(len(s) - span + 1):
            first.setdefault(s[k:k + span], r)
    for s, r, mask in zip(segments, rank, S.later_windows(segments, rank, span)):
        assert mask.tolist() == [first[s[k:k + span]] < r for k in range(len(s) - span + 1)]


def test_suffix_array():
    rng = np.random.default_rng(0)
    for n in (1, 30, 300):
        text = np.append(rng.integers(1, 4, n), 0)
        assert S.suffix_array(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())


def corpus():
    rng = random.Random(8)

    def prose(n):
        return "".join(rng.choice("abcdeé 🙂\n") for _ in range(n))

    passage, page = prose(70), prose(3000)
    rows = [(k, prose(rng.randint(0, 400))) for k in range(20)]
    rows += [(100 + k, prose(50) + passage + prose(60)) for k in range(30)]  # a hot passage
    rows += [(200 + k, page) for k in range(5)]  # exact copies
    for k in range(10):  # near copies
        at = rng.randrange(2900)
        rows.append((300 - k, page[:at] + prose(5) + page[at + 3:]))
    rows += [(400, "a" * 3000), (401, "ab" * 900), (402, "b" + "a" * 700 + "c"), (403, passage + passage), (404, page[500:900] * 3)]
    return rows


@pytest.mark.parametrize("block,ranges", [(S.BLOCK_BYTES, S.RANGE_BYTES), (4000, 3000)])
def test_operator_matches_brute_force(make_docs, edge_rows, block, ranges):
    rows = [*[(i, (t or "")[:2000] if t else t) for i, t in edge_rows], *corpus()]
    df = S.removed_spans(make_docs(rows, 4), block_bytes=block, range_bytes=ranges)
    assert got(df) == brute(rows, S.SPAN)


def test_empty_table(make_docs):
    assert S.removed_spans(make_docs([])).count() == 0


def test_documents(spark, sf_dir, small_docs):
    rows = [(i, t) for i, t, _ in small_docs]
    out = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.query(spark, sf_dir).collect())
    assert out == brute(rows, S.SPAN)


def hot_rows():
    """A passage and a phrase of less than a span between texts that differ: one anchor, a segment of its own in each text."""
    rng = random.Random(3)

    def prose(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    passage, phrase = prose(90), prose(30)
    return [(k, prose(80) + (passage if k % 2 else phrase) + prose(80)) for k in range(120)]


@pytest.mark.parametrize("places", [0, 20])
def test_hot_anchors_match_brute_force(make_docs, places):
    rows = [*corpus(), *[(1000 + i, t) for i, t in hot_rows()]]
    df = S.removed_spans(make_docs(rows, 4), block_bytes=4000, range_bytes=3000, hot_places=places)
    assert got(df) == brute(rows, S.SPAN)


def test_no_range_gets_all_segments_of_a_hot_anchor():
    import pyarrow as pa

    rows, ranges = hot_rows(), 16
    none = pa.table({"start": pa.array([], pa.int32()), "n": pa.array([], pa.int32())})
    blocks = [pa.table({"block": [k], "body": pa.array([S.packed({
        "id": pa.array([i for i, _ in some]), "rank": pa.array([i for i, _ in some]),
        "text": pa.array([t for _, t in some])})], pa.binary())}) for k, some in enumerate((rows[:60], rows[60:]))]
    anchors = pa.concat_tables([S._anchors(b, none, S.SPAN, ranges) for b in blocks])
    shared = pa.concat_tables([S._shared(anchors.filter(pa.compute.equal(anchors["range"], r)), 20)
                               for r in set(anchors["range"].to_pylist())])
    sent = []
    for k, b in enumerate(blocks):
        bodies = shared.filter(pa.compute.equal(shared["block"], k))["body"]
        told = pa.table({"start": pa.nulls(len(bodies), pa.int32()), "n": pa.nulls(len(bodies), pa.int32()), "body": bodies})
        sent += [r for batch in S._segments(b, told, S.SPAN, ranges) for r in batch.to_pylist() if r["range"] is not None]
    most = {}
    for r in sent:
        t = S.unpacked(r["body"])
        for name in t["anchor"].to_pylist() if "anchor" in t.column_names else []:
            most[name] = most.get(name, 0) + 1
    assert max(most.values(), default=0) <= 20
    spread = [r for r in sent if r["range"] >= ranges]
    assert len({r["range"] for r in spread}) > ranges // 2


def test_a_small_piece_is_not_mostly_frame():
    import pyarrow as pa

    row = {"start": pa.array([7], pa.int32()), "rank": pa.array([1]), "anchor": pa.array([2]), "h1": pa.array([3]),
           "h2": pa.array([4]), "data": pa.array([b"x" * 60], pa.binary())}
    assert len(S.packed(row)) < 600
    assert S.unpacked(S.packed(row)).to_pydict() == {k: v.to_pylist() for k, v in row.items()}


@pytest.mark.parametrize("step", [1, 7, 64])
def test_steps_do_not_show(monkeypatch, step):
    import pyarrow as pa

    texts = pa.array([t for _, t in corpus()[:40]], pa.string())
    whole = S.Block(texts, np.arange(40), S.SPAN)
    at = whole.anchors()
    monkeypatch.setattr(S, "STEP", step)
    parts = S.Block(texts, np.arange(40), S.SPAN)
    assert parts.hash.tolist() == whole.hash.tolist()
    assert parts.anchors().tolist() == at.tolist()
    for start, place in zip(whole.start.tolist(), at.tolist()):
        grams = whole.hash[start: start + S.SPAN - S.GRAM + 1] >> np.uint64(32)
        assert place == start + len(grams) - 1 - int(grams[::-1].argmin())
