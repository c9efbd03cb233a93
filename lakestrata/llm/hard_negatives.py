"""Hard negatives by length buckets and sorted coordinate lists (LEMP style), exact.

An anchor's positives are its best rows of the same label; its hard negatives,
for each positive, are the best rows of other labels whose score lies in a band
of percentages of the positive's score. Scores are inner products of integers.

The rows are range-partitioned by (label, length, id) into shards, the anchors
into blocks, and each (shard, block) pair that can matter is one task: a stated
set of queries against all rows, in blocks. A pair is left out where the label
ranges exclude each other or where the greatest lengths cannot reach the lowest
score asked for. Inside a task the shard's rows, longest first, form length
buckets. A bucket keeps each coordinate of its unit vectors as a sorted list.
With ``floor`` the lowest score that still matters to an anchor (the band's
bottom, or the running k-th best), a bucket of greatest length L asks for a
cosine of at least t = floor / (|anchor| L), so a row's coordinate f must lie
within arccos(t) of the anchor's, as angles. These feasible ranges of the
anchor's largest ("focus") coordinates are cut out of the sorted lists and
intersected; what remains is verified by exact inner products. Where no range
excludes much, all of the bucket is verified by one matrix product.

Defined cases: a row takes no part if its id, label or vector is null, or a
component is null or not finite; of rows with one id the least by (label,
vector) counts; shorter vectors are padded with zeros; an anchor without
positives, or a positive without negatives, gives no row; a positive with a
negative score has an empty band; scores are exact below 2 ** 53 and clipped at
2 ** 53; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm import common as C

#: Components that a shard or a block of anchors holds, about (4 MB as doubles).
SHARD_VALUES = 1 << 19
#: Rows of the first (unpruned) and of the largest length buckets; anchors verified by one matrix product.
FIRST_ROWS, BUCKET_ROWS, CHUNK = 128, 2048, 128
#: Focus coordinates of an anchor; share of a bucket up to which candidates are cut out of the lists.
FOCUS, FEW = 5, 0.25
LIMIT = float(1 << 53)


# --- inside a task ----------------------------------------------------------------

def feasible(a: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values that one coordinate of a unit vector may have if its cosine with a unit vector of coordinate ``a`` is ``t`` or more."""
    alpha, tau = np.arccos(np.clip(a, -1, 1)), np.arccos(np.clip(t, -1, 1))
    return np.cos(np.minimum(np.pi, alpha + tau)) - 1e-9, np.cos(np.maximum(0, alpha - tau)) + 1e-9


class Bucket:
    """Rows of similar length with a sorted list of each coordinate of their unit vectors."""

    def __init__(self, matrix: np.ndarray, norm: np.ndarray, place: np.ndarray):
        self.place, self.matrix, self.length = place, matrix[place], float(norm[place].max())
        self._lists = None
        self._norm = norm[place]

    def lists(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self._lists is None:
            unit = (self.matrix / np.maximum(self._norm, 1e-300)[:, None]).T
            order = np.argsort(unit, axis=1)
            rank = np.empty_like(order)
            np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
            self._lists = order, np.take_along_axis(unit, order, axis=1), rank
        return self._lists

    def ranges(self, unit: np.ndarray, focus: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place (exclusive) in the lists of the focus coordinates of each anchor."""
        _, value, _ = self.lists()
        low, high = feasible(np.take_along_axis(unit, focus, 1), t[:, None])
        first, last = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
        for f in np.unique(focus):
            at = focus == f
            first[at] = np.searchsorted(value[f], low[at], "left")
            last[at] = np.searchsorted(value[f], high[at], "right")
        return first, last

    def candidates(self, focus: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Rows inside all the ranges of one anchor, from the shortest range on."""
        order, _, rank = self.lists()
        turn = np.argsort(last - first)
        got = order[focus[turn[0]], first[turn[0]]: last[turn[0]]]
        for k in turn[1:]:
            r = rank[focus[k], got]
            got = got[(r >= first[k]) & (r < last[k])]
        return got


def buckets(matrix: np.ndarray, norm: np.ndarray, ids: np.ndarray):
    """Length buckets of a shard, longest rows first, small ones first."""
    order, start, size = np.lexsort((ids, -norm)), 0, FIRST_ROWS
    while start < len(order):
        yield Bucket(matrix, norm, order[start: start + size])
        start, size = start + size, min(BUCKET_ROWS, 2 * size)


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    start = np.maximum.accumulate(np.where(np.diff(g, prepend=-1) != 0, np.arange(len(g)), 0))
    return order[np.arange(len(g)) - start < k]


def search(rows: tuple, anchors: tuple, low: np.ndarray, high: np.ndarray, same: bool, k: int,
           verified: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, slot, row id, score) of the first ``k`` rows in each band.

    ``rows`` and ``anchors`` are (ids, labels, matrix); ``low`` and ``high``
    are the bands, one column for each slot (low > high: none). ``same``: rows
    of the anchor's label, else of others; never the anchor itself.
    """
    ids, labels, matrix = rows
    a_ids, a_labels, a_matrix = anchors
    slots = low.shape[1]
    norm, a_norm = np.sqrt((matrix * matrix).sum(1)), np.sqrt((a_matrix * a_matrix).sum(1))
    unit = a_matrix / np.maximum(a_norm, 1e-300)[:, None]
    focus = np.argsort(-np.abs(unit), axis=1)[:, :FOCUS]
    theta = np.where(low <= high, low, np.inf)
    none = np.zeros(0)
    g, s, i = none.astype(np.int64), none, none.astype(np.int64)  # the best so far, by anchor * slots + slot
    for bucket in buckets(matrix, norm, ids):
        floor = theta.min(axis=1)
        reach = a_norm * bucket.length
        live = np.flatnonzero(floor <= reach * (1 + 1e-9) + 1e-6)
        t = np.where(floor[live] > 0, floor[live] / np.maximum(reach[live], 1e-300), -1.0)
        dense, found_a, found_r, found_s = live, [], [], []
        tight = np.flatnonzero(t > 0)
        if len(tight) and focus.shape[1]:
            first, last = bucket.ranges(unit[live[tight]], focus[live[tight]], t[tight])
            few = (last - first).min(axis=1) <= FEW * len(bucket.place)
            for j in np.flatnonzero(few):
                a = live[tight[j]]
                r = bucket.candidates(focus[a], first[j], last[j])
                if verified is not None:
                    verified.append(len(r))
                found_a.append(np.full(len(r), a))
                found_r.append(r)
                found_s.append(bucket.matrix[r] @ a_matrix[a])
            dense = np.delete(live, tight[few])
        for c in range(0, len(dense), CHUNK):
            part = dense[c: c + CHUNK]
            scores = a_matrix[part] @ bucket.matrix.T
            if verified is not None:
                verified.append(scores.size)
            fits = (scores >= floor[part][:, None]) & ((labels[bucket.place][None, :] == a_labels[part][:, None]) == same)
            a, r = np.nonzero(fits)
            found_a.append(part[a])
            found_r.append(r)
            found_s.append(scores[a, r])
        if not found_a:
            continue
        a, r, score = np.concatenate(found_a), bucket.place[np.concatenate(found_r)], np.clip(np.concatenate(found_s), -LIMIT, LIMIT)
        fits = ((labels[r] == a_labels[a]) == same) & (ids[r] != a_ids[a])
        a, r, score = a[fits], r[fits], score[fits]
        for slot in range(slots):
            band = (score >= theta[a, slot]) & (score <= high[a, slot])
            g = np.concatenate([g, a[band] * slots + slot])
            s, i = np.concatenate([s, score[band]]), np.concatenate([i, ids[r[band]]])
        keep = best(g, s, i, k)
        g, s, i = g[keep], s[keep], i[keep]
        full = np.flatnonzero(np.diff(g, append=-1) != 0)  # the last of a group is its worst
        whole = full[np.bincount(g, minlength=1)[g[full]] == k]
        at = g[whole] // slots, g[whole] % slots
        theta[at] = np.maximum(theta[at], s[whole])
    return g // slots, g % slots, i, s


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``width``."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths())
    flat = np.asarray(lists.flatten(), dtype=np.float64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), C.spans(sizes)] = flat
    return out


def _sides(rows: pa.Table, anchors: pa.Table) -> tuple[tuple, tuple]:
    """(ids, label codes, matrix) of both."""
    sides = (rows, anchors)
    width = max([int(np.asarray(t["v"].combine_chunks().value_lengths()).max()) for t in sides])
    names = pa.chunked_array([c for t in sides for c in t["label"].chunks]).combine_chunks().dictionary_encode()
    code = names.indices.to_numpy(zero_copy_only=False)
    cut = (0, rows.num_rows, rows.num_rows + anchors.num_rows)
    return tuple((t["id"].to_numpy(), code[cut[k]: cut[k + 1]], _matrix(t["v"], width)) for k, t in enumerate(sides))


# --- the job --------------------------------------------------------------------

def vectors(rows: DataFrame, id_col: str, label: Column, vec_col: str, scale: float) -> DataFrame:
    """(id, label, v, norm) of the rows that take part; one row for each id."""
    finite = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(math.inf)))
    scaled = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    took = rows.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), label.alias("label"), scaled.alias("v")).where("label IS NOT NULL")
    one = took.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.label", "row.v")
    return one.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))


def _dealt(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` in range partitions of about SHARD_VALUES components, numbered by ``name``."""
    size = rows.agg(F.coalesce(F.sum(F.size("v")), F.lit(0)).alias("values")).first()["values"]
    parts = rows.repartitionByRange(max(1, -(-size // SHARD_VALUES)), *order)
    return C.written(parts.withColumn(name, F.spark_partition_id()), f"hard-negatives-{name}")


def _ends(rows: DataFrame, name: str, *more: Column) -> DataFrame:
    return rows.groupBy(name).agg(F.min("label").alias(f"{name}_from"), F.max("label").alias(f"{name}_to"),
                                  F.max("norm").alias(f"{name}_norm"), *more)


def _grid(shards: DataFrame, blocks: DataFrame, fits: Column) -> DataFrame:
    """The (shard, block) pairs that ``fits`` keeps: metadata, one row a task."""
    last = shards.agg(F.coalesce(F.max("shard"), F.lit(-1)).alias("last")).first()["last"]
    if last < 0:
        return shards.join(blocks, F.lit(False)).select("shard", "block")
    wide = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last))))
    return C.written(wide.join(shards, "shard").where(fits).select("shard", "block"), "hard-negatives-grid")


def _tasks(rows: DataFrame, anchors: DataFrame, grid: DataFrame, fn, schema: str) -> DataFrame:
    left = rows.select("shard", "id", "label", "v").join(grid, "shard").groupBy("shard", "block")
    right = anchors.join(grid.toDF("to_shard", "to_block"), F.col("block") == F.col("to_block")).drop("block").groupBy("to_shard", "to_block")

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in schema.split(", ")]
        if a.num_rows == 0 or b.num_rows == 0:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        return pa.table(dict(zip(names, (pa.array(x, pa.int64()) for x in fn(a, b)))))

    return left.cogroup(right).applyInArrow(run, schema)


def mine(rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, percent: tuple[int, int] = (50, 95),
         id_col: str = "vec_id", label: Column | None = None, vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` takes the id column and says which rows are anchors; the
    negatives of a positive of score p score ``percent`` of p, ends included.
    """
    low_pct, high_pct = percent
    table = C.written(vectors(rows, id_col, F.col("label") if label is None else label, vec_col, scale), "hard-negatives-vectors")
    shards = _dealt(table, [F.col("label"), F.desc("norm"), F.col("id")], "shard")
    anchors = _dealt(table.where(is_anchor(F.col("id"))), [F.col("label"), F.col("id")], "block")
    shard_ends = C.written(_ends(shards, "shard"), "hard-negatives-ends")

    def positives_of(a: pa.Table, b: pa.Table):
        r, q = _sides(a, b)
        free = np.full((len(q[0]), 1), -np.inf), np.full((len(q[0]), 1), np.inf)
        who, _, ids, score = search(r, q, *free, True, positives)
        return q[0][who], ids, score.astype(np.int64)

    overlap = (F.col("shard_from") <= F.col("block_to")) & (F.col("shard_to") >= F.col("block_from"))
    found = _tasks(shards, anchors.select("block", "id", "label", "v"), _grid(shard_ends, _ends(anchors, "block"), overlap),
                   positives_of, "anchor long, id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= positives)
    listed = ranked.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "id", "score"))).alias("pos"))
    full = C.written(anchors.join(listed.select(F.col("anchor").alias("id"), "pos"), "id").select(
        "block", "id", "label", "v", "norm", F.col("pos.id").alias("pos_id"), F.col("pos.score").alias("pos_score")), "hard-negatives-positives")

    def negatives_of(a: pa.Table, b: pa.Table):
        r, q = _sides(a, b)
        score = b["pos_score"].combine_chunks()
        sizes = np.asarray(score.value_lengths())
        flat = np.asarray(score.flatten(), dtype=np.int64)
        at = np.repeat(np.arange(len(sizes)), sizes), C.spans(sizes)
        low, high = np.full((len(sizes), positives), np.inf), np.full((len(sizes), positives), -np.inf)
        low[at], high[at] = -((-low_pct * flat) // 100), (high_pct * flat) // 100
        who, slot, ids, got = search(r, q, low, high, False, negatives)
        return q[0][who], slot, ids, got.astype(np.int64)

    bottom = F.ceil(F.array_min("pos_score") * low_pct / 100)  # the least score that any positive of the anchor asks for
    blocks = _ends(full, "block", F.min(F.when(bottom > 0, bottom).otherwise(0)).alias("bottom"))
    others = ((F.col("shard_from") != F.col("shard_to")) | (F.col("block_from") != F.col("block_to")) | (F.col("shard_from") != F.col("block_from")))
    fits = others & (F.col("bottom") <= F.col("block_norm") * F.col("shard_norm") * (1 + 1e-9) + 1e-6)
    found = _tasks(shards, full.drop("norm", "pos_id"), _grid(shard_ends, blocks, fits), negatives_of,
                   "anchor long, slot long, id long, score long")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    known = full.select("id", F.posexplode(F.arrays_zip("pos_id", "pos_score")).alias("slot", "pos")).select(
        F.col("id").alias("anchor"), F.col("slot").cast("long"), "pos")
    return ranked.join(known, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), F.col("pos.pos_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), F.col("pos.pos_score").alias("positive_score"), F.col("score").alias("negative_score"))


def query(spark, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 50 == 0, label=moved)


def sql() -> str:
    """DuckDB SQL for the rows of ``query``."""
    return """
WITH base AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM base a JOIN base b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3"""
