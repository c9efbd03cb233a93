"""SimHash near-duplicates, found exactly with vantage-point trees.

A fingerprint takes the majority of each bit over the XXH64 hashes of a text's
word shingles. Equal fingerprints become one point first, so a group of copies
costs one row. The 64 bits are parted into ``bits`` + c groups; two points
within ``bits`` of each other agree on c of them at least. For each choice of c
groups a vantage-point tree parts the points by their distance on these bits
alone: points that agree there stand at the same distance of every vantage
point, so by the triangle inequality a linked pair lies on one side of every
boundary of that tree, and no point visits a second shard. A point thus makes
as many rows as there are choices (5 for c = 1, at 4 bits), at any number of
points; c grows only where the groups' bits would be too few to part the points
(above 67 million), and changes cost, never links. Beyond the tree's depth a
shard is parted by a hash of the chosen bits.

A shard compares with a second tree over the full distance, where a point
within ``bits`` of a boundary is sought on both sides. A shard of many points
that agree on the chosen bits (near copies of one text) is dealt over several
tasks by the top of such a tree, fitted in a task on a bounded sample of the
shard; points near a boundary visit the later shard as well. Links leave a
shard as a forest (each point and the least point it reaches there), never as
all pairs; a star-based pass joins the forests.

Defined cases: a text of fewer words than a shingle is one shingle, one
without words (or null) has fingerprint zero and links like any other; of
documents with equal ids all rows count; the component id is the smallest
non-null id reached; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm import common as C
from lakestrata.llm.components import components

SHINGLE, BITS = 4, 4
#: Points that a shard holds on average; times that many it is dealt out further; points by which a choice of groups may exceed its values.
SHARD_POINTS, HOT, FULL = 1024, 4, 16_384
#: Points that a tree is fitted on at most, and the depth of the top trees at most.
SAMPLE_POINTS, DEPTH = 65_536, 12
LEAF = 192


def fingerprints(texts: pa.Array, shingle: int = SHINGLE, seed: int = 42) -> np.ndarray:
    """64-bit fingerprint of each text (no nulls)."""
    from xxhash import xxh64_intdigest

    words, row = C.words(C.lower_ascii(texts))
    n, count = len(texts), np.bincount(row, minlength=len(texts))
    out = np.zeros(n, np.uint64)
    if len(row) == 0:
        return out
    body, offsets = C.raw(pc.binary_join_element_wise(words, pa.scalar("", words.type), " "))
    body = body.tobytes()
    parts = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    first = np.cumsum(count) - count
    begin = np.repeat(first, parts) + C.spans(parts)
    stop = np.minimum(begin + shingle, np.repeat(first + count, parts))
    size = 1 << 16
    ones = np.zeros((n, 64), np.int64)
    owner = np.repeat(np.arange(n), parts)
    a, b = offsets[begin], offsets[stop] - 1
    for k in range(0, len(begin), size):  # bounded bit matrices
        h = np.array([xxh64_intdigest(body[i:j], seed) for i, j in zip(a[k: k + size].tolist(), b[k: k + size].tolist())], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
        own = owner[k: k + size]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    major = (2 * ones > parts[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1).view(np.uint64).ravel()


def row_key(id_col: str, text_col: str):
    """Two 64-bit hashes that name a row by id and text; never null."""
    return F.xxhash64(id_col, text_col), F.xxhash64(F.lit(1), F.col(text_col), F.col(id_col))


def fingerprint_table(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, k1, k2, fp) of every row; (k1, k2) is a hash of id and text, fp the fingerprint as a signed long."""
    k1, k2 = row_key(id_col, text_col)
    slim = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches):
        for part in C.slices(batches, "text"):
            fp = fingerprints(C.text_of(part, "text"), shingle)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(fp.view(np.int64))], names=["id", "k1", "k2", "fp"])

    return slim.mapInArrow(run, f"id {kind}, k1 long, k2 long, fp long")


# --- vantage-point trees --------------------------------------------------------

def _distance(points: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ point).astype(np.int64)


def top_tree(sample: np.ndarray, depth: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a complete binary tree (node k has children 2k + 1 and 2k + 2)."""
    rng = np.random.default_rng(seed)
    point, radius = np.zeros((1 << depth) - 1, np.uint64), np.zeros((1 << depth) - 1, np.int64)
    parts = {0: sample}
    for node in range(len(point)):
        own = parts.pop(node)
        point[node] = rng.choice(own) if len(own) else rng.integers(0, 1 << 63, dtype=np.uint64)
        d = _distance(own, point[node])
        radius[node] = int(np.median(d)) if len(own) else 32
        parts[2 * node + 1], parts[2 * node + 2] = own[d <= radius[node]], own[d > radius[node]]
    return point, radius


def deal(points: np.ndarray, tree: tuple[np.ndarray, np.ndarray], depth: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the point, shard, visits) for a home shard and every later shard that may hold a partner."""
    vantage, radius = tree
    who, node, home = np.arange(len(points)), np.zeros(len(points), np.int64), np.ones(len(points), bool)
    for _ in range(depth):
        d = np.bitwise_count(points[who] ^ vantage[node]).astype(np.int64)
        r = radius[node]
        inner, outer = d <= r + bits, d > r - bits
        who, home, node = (np.concatenate(x) for x in (
            (who[inner], who[outer]), (home[inner] & (d <= r)[inner], home[outer] & (d > r)[outer]),
            (2 * node[inner] + 1, 2 * node[outer] + 2)))
    shard = node - ((1 << depth) - 1)
    own = np.zeros(len(points), np.int64)
    own[who[home]] = shard[home]
    keep = home | (shard > own[who])
    return who[keep], shard[keep], ~home[keep]


class Links:
    """Least reachable label of each point, kept while links arrive in batches."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        while True:
            open_ = a != b
            if not open_.any():
                return
            a, b = a[open_], b[open_]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while True:  # pointer jumping
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up
            a, b = self.label[a], self.label[b]


def search(points: np.ndarray, homes: np.ndarray, queries: np.ndarray, bits: int, links: Links, rng) -> None:
    """Link all of ``queries`` to all of ``homes`` (places in ``points``) within ``bits``."""
    stack = [(homes, queries)]
    while stack:
        p, q = stack.pop()
        if len(p) == 0 or len(q) == 0:
            continue
        if len(p) > LEAF:
            for _ in range(3):
                v = points[rng.choice(p)]
                d = _distance(points[p], v)
                r = int(np.median(d))
                inner = d <= r
                if not inner.all():
                    break
            if not inner.all():
                e = _distance(points[q], v)
                stack += [(p[inner], q[e <= r + bits]), (p[~inner], q[e > r - bits])]
                continue
        width = max(1, (1 << 19) // len(q))
        for k in range(0, len(p), width):
            near = np.bitwise_count(points[p[k: k + width], None] ^ points[None, q]) <= bits
            i, j = np.nonzero(near)
            links.add(p[k: k + width][i], q[j])


def shard_forest(points: np.ndarray, visits: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(point, least point linked to it here) for the points that have a link."""
    order = np.argsort(points, kind="stable")
    points, visits = points[order], visits[order]
    links = Links(len(points))
    search(points, np.flatnonzero(~visits), np.arange(len(points)), bits, links, np.random.default_rng(11))
    linked = np.flatnonzero(links.label != np.arange(len(points)))
    return points[linked], points[links.label[linked]]


def choices(bits: int, n: int) -> list[int]:
    """Masks of the bits on some of which any two of ``n`` points within ``bits`` of each other agree."""
    c = 1
    while True:
        groups = [sum(1 << int(b) for b in part) for part in np.array_split(np.arange(64), bits + c)]
        masks = [sum(some) for some in combinations(groups, c)]
        if n <= FULL << min(m.bit_count() for m in masks) or c == 3 or bits + c >= 63:
            return masks
        c += 1


def _depth(n: int, size: int, most: int) -> int:
    depth = 0
    while n > size << depth and depth < most:
        depth += 1
    return depth


def _forest(table: pa.Table, bits: int) -> pa.Table:
    visits = table["visits"].to_numpy() if "visits" in table.column_names else np.zeros(table.num_rows, bool)
    a, b = shard_forest(table["fp"].to_numpy().view(np.uint64), visits, bits)
    return pa.table({"u": pa.array(a.view(np.int64)), "v": pa.array(b.view(np.int64))})


def _dealt_further(hot: DataFrame, bits: int, most: int) -> DataFrame:
    """(shard, part, fp, visits): points of large shards (shard, fp, size), by the top of a full-distance tree each."""
    sample = hot.withColumn("turn", F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("fp")))).where(F.col("turn") <= SAMPLE_POINTS // 8)

    def fit(table: pa.Table) -> pa.Table:
        depth = _depth(table["size"][0].as_py(), most, DEPTH)
        point, radius = top_tree(table["fp"].to_numpy().view(np.uint64), depth)
        return pa.table({"at": table["shard"][:1], "point": pa.array([point.tobytes()], pa.binary()), "radius": pa.array([radius.tobytes()], pa.binary())})

    trees = C.written(sample.groupBy("shard").applyInArrow(fit, "at long, point binary, radius binary"), "simhash-trees")

    def route(batches):
        for b in batches:
            at, fp = b.column(0).to_numpy(), b.column(1).to_numpy()
            for shard in np.unique(at):
                own = np.flatnonzero(at == shard)
                point, radius = (np.frombuffer(b.column(k)[int(own[0])].as_py(), kind) for k, kind in ((2, np.uint64), (3, np.int64)))
                who, part, visits = deal(fp[own].view(np.uint64), (point, radius), (len(point) + 1).bit_length() - 1, bits)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), shard)), pa.array(part), pa.array(fp[own][who]), pa.array(visits)],
                                                 names=["shard", "part", "fp", "visits"])

    met = hot.join(trees, F.col("shard") == F.col("at")).select("shard", "fp", "point", "radius")
    return met.mapInArrow(route, "shard long, part long, fp long, visits boolean")


def link_points(points: DataFrame, bits: int = BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(u, v): a forest for each shard over the distinct ``fp`` of ``points``."""
    spark, n = points.sparkSession, points.count()
    masks, depth = choices(bits, n), _depth(n, shard_points, DEPTH)
    more = max(1, n // (shard_points << depth))  # parts of a leaf, by a hash of the chosen bits
    # a hash share of about SAMPLE_POINTS points: what a task sends shrinks as the table grows
    some = points.where(F.pmod(F.xxhash64("fp"), F.lit(max(1, n // SAMPLE_POINTS))) == 0).limit(2 * SAMPLE_POINTS)
    sample = some.toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    trees = spark.sparkContext.broadcast([top_tree(sample & np.uint64(m), depth) for m in masks])

    def route(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            for k, mask in enumerate(masks):
                own = fp.view(np.uint64) & np.uint64(mask)
                who, leaf, _ = deal(own, trees.value[k], depth, 0)
                shard = (leaf * more + (C.mix(own[who]) % np.uint64(more)).astype(np.int64)) * len(masks) + k
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fp[who])], names=["shard", "fp"])

    routed = C.written(points.select("fp").mapInArrow(route, "shard long, fp long"), "simhash-routed")
    most = HOT * shard_points
    large = C.written(routed.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > most), "simhash-large")
    links = routed.join(large, "shard", "left_anti").groupBy("shard").applyInArrow(lambda t: _forest(t, bits), "u long, v long")
    if large.isEmpty():
        return links
    parts = _dealt_further(routed.join(large, "shard"), bits, most)
    return links.unionByName(parts.groupBy("shard", "part").applyInArrow(lambda t: _forest(t, bits), "u long, v long"))


def classes(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, k1, k2, fp, root, component_id) of every row; root names the class of linked fingerprints."""
    rows = C.written(fingerprint_table(docs, shingle, id_col, text_col), "simhash")
    points = C.written(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-points")
    roots = C.written(components(link_points(points, bits)), "simhash-roots")
    points = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = points.groupBy("root").agg(F.min("first").alias("component_id"))
    named = C.written(points.join(least, "root").select("fp", "root", "component_id"), "simhash-classes")
    return rows.join(named, "fp")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row of each class: the one with the smallest id (null ids last); of equal ids any one."""
    first = classes(docs, shingle, bits, id_col, text_col).groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")).alias("first"))
    a, b, rank = C.fresh(docs, "row_key_1"), C.fresh(docs, "row_key_2"), C.fresh(docs, "copy_rank")
    stay = C.written(first.select(F.col("first.k1").alias(a), F.col("first.k2").alias(b)), "simhash-stay")
    k1, k2 = row_key(id_col, text_col)
    kept = docs.withColumn(a, k1).withColumn(b, k2).join(stay.hint("shuffle_hash"), [a, b], "left_semi")
    # of equal rows one stays; the numbering uses the partitions of the join
    number = F.row_number().over(Window.partitionBy(a, b).orderBy(a))
    return kept.withColumn(rank, number).where(F.col(rank) == 1).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    found = classes(C.documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
