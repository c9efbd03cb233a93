import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm import simhash as H
from lakestrata.llm.components import components
from tests.llm.conftest import lower, words


def fingerprint(text, k=4):
    w = words(lower(text or ""))
    parts = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    votes = sum(np.array([(xxhash.xxh64_intdigest(p, 42) >> b) & 1 for b in range(64)]) for p in parts) if parts else np.zeros(64)
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(parts))


def classes(points, bits):
    """Least reachable index of each fingerprint."""
    label = list(range(len(points)))
    p = np.array(points, np.uint64)
    changed = True
    while changed:
        changed = False
        for a in range(len(p)):
            near = np.flatnonzero(np.bitwise_count(p ^ p[a]) <= bits)
            m = min(label[i] for i in near)
            for i in near:
                changed |= label[i] != m
                label[i] = m
    return label


def test_edges_match_brute_force(make_docs, edge_rows):
    out = H.classes(make_docs(edge_rows)).collect()
    assert len(out) == len(edge_rows)
    fps = [fingerprint(t) for _, t in edge_rows]
    label = classes(fps, 4)
    want = sorted((str(i), format(f, "016x"), str(min((edge_rows[j][0] for j in range(len(label)) if label[j] == c and edge_rows[j][0]), default=None)))
                  for (i, _), f, c in zip(edge_rows, fps, label))
    assert sorted((str(r.id), format(r.fp & (2**64 - 1), "016x"), str(r.component_id)) for r in out) == want
    assert H.classes(make_docs([])).count() == 0


def clusters(rng, n):
    """Chains and balls of near points, and random ones."""
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 30])):
            out.append(x)
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
    return out


def test_sharded_links_keep_every_component(spark):
    rng = random.Random(1)
    points = sorted(set(clusters(rng, 3000)))
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    links = H.link_points(table, 4, shard_points=100)  # 32 shards of each tree
    roots = {r.node: r.root for r in components(links).collect()}
    mine = [roots.get(x, x) for x in signed]
    label = classes(points, 4)
    assert len(set(zip(mine, label))) == len(set(mine)) == len(set(label))
    assert links.count() <= 5 * len(points)  # a forest for each tree, not pairs


def test_dense_shards_are_dealt_further(spark, monkeypatch):
    """Many near copies of one text agree on most bits: their shards are split, and no link is lost."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    points = {centre}
    while len(points) < 1500:
        x = centre
        for b in rng.sample(range(64), rng.randint(1, 9)):
            x ^= 1 << b
        points.add(x)
    points = sorted(points | set(clusters(rng, 500)))
    monkeypatch.setattr(H, "HOT", 1)
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    links = H.link_points(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, shard_points=150)
    assert "point" in links._jdf.queryExecution().toString()  # trees of single shards
    roots = {r.node: r.root for r in components(links).collect()}
    mine, label = [roots.get(x, x) for x in signed], classes(points, 4)
    assert len(set(zip(mine, label))) == len(set(mine)) == len(set(label))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=4), st.sampled_from([10**3, 10**8, 10**12]))
def test_near_points_agree_on_a_choice(point, flips, n):
    other = point
    for b in flips:
        other ^= 1 << b
    masks = H.choices(4, n)
    assert len(masks) == {10**3: 5, 10**8: 15, 10**12: 35}[n]
    assert any(point & m == other & m for m in masks)


def test_rows_a_point_do_not_grow(spark):
    rng = np.random.default_rng(0)
    for n in (2000, 16000):
        fps = rng.integers(-2**63, 2**63 - 1, n)
        tree = [H.top_tree(fps.view(np.uint64) & np.uint64(m), 6) for m in H.choices(4, n)]
        rows = sum(len(H.deal(fps.view(np.uint64) & np.uint64(m), t, 6, 0)[0]) for m, t in zip(H.choices(4, n), tree))
        assert rows == 5 * n


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40, unique=True), st.integers(0, 20))
def test_shard_search_is_exact(points, bits):
    p = np.array(sorted(points), np.uint64)
    old, H.LEAF = H.LEAF, 2
    try:
        a, b = H.shard_forest(p, np.zeros(len(p), bool), bits)
    finally:
        H.LEAF = old
    label = classes(p.tolist(), bits)
    root = dict(zip(a.tolist(), b.tolist()))
    mine = [root.get(x, x) for x in p.tolist()]
    assert mine == [int(p[k]) for k in label]


def test_one_of_each_class_stays(make_docs):
    text = " ".join(f"w{k}" for k in range(300))
    rows = [(7, text), (3, text), (3, text), (9, text + " end"), (12, "quite another text of its own"), (None, "null id text alone here now"),
            (None, "second text without id at all"), (20, ""), (21, None)]
    docs = make_docs(rows)
    kept = H.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("3", text), ("12", rows[4][1]), ("None", rows[5][1]), ("None", rows[6][1]), ("20", "")])


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(301)} | {1000 + k: 1000 for k in range(400)}
