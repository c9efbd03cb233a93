import math

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.llm import hard_negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score double, slot int, block string"


def table(spark, rows, parts=3):
    full = [(i, None if v is None else [None if x is None else float(x) for x in v], y, "x", 0.0, 1, "b") for i, v, y in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)


def brute(rows, every=50, move=True, positives=5, negatives=3, low=50, high=95):
    kept = {}
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if move and i % 7 == 0 else y
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        kept[i] = min(kept.get(i, (y, q)), (y, q))
    out = []
    for a, (y, q) in kept.items():
        if a % every:
            continue
        score = {i: sum(x * z for x, z in zip(q, p)) for i, (_, p) in kept.items()}
        best = sorted((i for i in kept if i != a and kept[i][0] == y), key=lambda i: (-score[i], i))[:positives]
        for p in best:
            fit = sorted((i for i in kept if kept[i][0] != y and low * score[p] <= 100 * score[i] <= high * score[p]),
                         key=lambda i: (-score[i], i))[:negatives]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fit)]
    return sorted(out)


def label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def found(df, every=50, **how):
    out = N.mine(df, lambda i: i % every == 0, label=label(), **how)
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in out.collect())


def clustered(n, dims, seed=3, spread=0.1):
    """Vectors of a few directions and very different lengths, with ties."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    v = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dims))
    v *= rng.choice([0.05, 0.3, 1.0], n)[:, None] / np.sqrt(dims)
    v[n // 2: n // 2 + n // 10] = v[n // 2]  # a group of copies
    return [(i, v[i].tolist(), int(y)) for i, y in enumerate(rng.integers(0, 4, n))]


def test_edges_match_brute_force(spark):
    rows = clustered(300, 8)
    rows += [(None, [0.1] * 8, 1), (1000, None, 1), (1050, [0.1] * 8, None), (1100, [0.1, None] + [0.2] * 6, 2), (1150, [math.inf] * 8, 2),
             (1200, [math.nan] * 8, 2), (1250, [], 3), (1300, [0.5, 0.5], 3), (1350, [0.0] * 8, 0), (50, [0.2] * 8, 9), (50, rows[50][1], rows[50][2]),
             (1400, [0.3] * 8, 9), (1401, [-0.3] * 8, 9), (-50, rows[10][1], 1)]
    assert found(table(spark, rows)) == brute(rows)
    assert found(table(spark, [])) == []
    assert found(table(spark, [(7, [0.1], 1), (8, [0.1], 1)])) == []


def test_many_shards_and_blocks(spark, monkeypatch):
    rows = clustered(700, 16, seed=5)
    monkeypatch.setattr(N, "SHARD_VALUES", 1500)
    assert found(table(spark, rows), every=5, positives=3, negatives=2) == brute(rows, every=5, positives=3, negatives=2)


def test_one_label_and_copies_only(spark):
    rows = [(i, [0.5, 0.25], 1 if i % 3 else 2) for i in range(200)]
    assert found(table(spark, rows), percent=(50, 100)) == brute(rows, high=100)
    assert found(table(spark, [(i, [0.5, 0.25], 1) for i in range(1, 60) if i % 7])) == []


def sides(rows):
    ids, v, y = zip(*rows)
    return np.array(ids), np.array(y), np.floor(256 * np.array(v))


def test_lists_prune_and_lose_nothing():
    """Close clusters: the sorted lists leave a small part to be verified, and the result is that of all pairs."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 32))
    v = centres[rng.integers(0, 60, 3000)] + 0.05 * rng.normal(size=(3000, 32))
    v /= np.sqrt((v * v).sum(1))[:, None]
    rows = (np.arange(3000), rng.integers(0, 3, 3000), np.floor(256 * v))
    anchors = tuple(x[::30] for x in rows)
    low, high = np.full((100, 1), 0.95) * (anchors[2] ** 2).sum(1)[:, None], np.full((100, 1), np.inf)
    seen = []
    a, _, ids, score = N.search(rows, anchors, low, high, False, 4, verified=seen)
    all_scores = anchors[2] @ rows[2].T
    want = []
    for k in range(100):
        fit = [i for i in range(3000) if rows[1][i] != anchors[1][k] and all_scores[k, i] >= low[k, 0]]
        want += [(k, i, all_scores[k, i]) for i in sorted(fit, key=lambda i: (-all_scores[k, i], i))[:4]]
    assert sorted(zip(a.tolist(), ids.tolist(), score.tolist())) == sorted(want)
    assert sum(seen) < 0.35 * all_scores.size


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 6), st.integers(2, 60), st.floats(0.2, 0.99), st.booleans())
def test_search_is_exact(seed, dims, n, part, same):
    rng = np.random.default_rng(seed)
    v = np.floor(rng.normal(size=(n, dims)) * rng.choice([1, 20, 300], n)[:, None])
    rows = (rng.permutation(n), rng.integers(0, 2, n), v)
    anchors = tuple(x[: max(1, n // 3)] for x in rows)
    top = (anchors[2] @ v.T).max(1)[:, None]
    low, high = np.hstack([np.floor(part * top), np.floor(0.1 * top)]), np.hstack([top, np.floor(0.8 * top)])
    old, N.FIRST_ROWS, N.BUCKET_ROWS = (N.FIRST_ROWS, N.BUCKET_ROWS), 3, 12
    try:
        a, s, ids, score = N.search(rows, anchors, low, high, same, 2)
    finally:
        N.FIRST_ROWS, N.BUCKET_ROWS = old
    want = []
    for k in range(len(anchors[0])):
        sc = v @ anchors[2][k]
        for slot in (0, 1):
            fit = [j for j in range(n) if rows[0][j] != anchors[0][k] and (rows[1][j] == anchors[1][k]) == same
                   and low[k, slot] <= sc[j] <= high[k, slot]]
            want += [(k, slot, rows[0][j], sc[j]) for j in sorted(fit, key=lambda j: (-sc[j], rows[0][j]))[:2]]
    assert sorted(zip(a.tolist(), s.tolist(), ids.tolist(), score.tolist())) == sorted(want)


def test_whole_table_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    want = con.execute(N.sql()).fetchall()
    got = N.query(spark, sf_dir)
    assert len(want) > 20
    assert sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == sorted(want)
