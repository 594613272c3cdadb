"""Hard negatives for contrastive training: rows of another label that score nearly as high as a positive.

Anchors meet all rows in blocks (a matrix product for each pair of blocks). A first pass finds each anchor's positives; a
second one, which knows them, keeps of each block only what can be returned: the first few rows below each positive.
Positives and these candidates are dealt out by anchor and sorted within partitions by (anchor, descending score,
positives first, id); an iterator runs down each anchor's scores, opens a window at every positive and gives the
negatives that fall into open windows. It holds the open windows of one anchor and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, ship

#: Bytes of numbers in a block of anchors, in a block of rows, and in a piece of their products.
ANCHOR_BYTES, ROW_BYTES, TILE_BYTES = 16 << 20, 32 << 20, 32 << 20
#: Components are held to this, so that a product of 32,768 of them fits a long. Embeddings don't come near.
LIMIT = 1 << 24
FOUND = "anchor long, score long, kind int, id long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.least(F.greatest(F.floor(x.cast("double") * scale), F.lit(-LIMIT)), F.lit(LIMIT)).cast("int"))


def usable(vector: Column) -> Column:
    """Whether the vector and all its components are there and finite."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of numbers; shorter ones end in zeros."""
    lists = column.combine_chunks()
    out, sizes = np.zeros((len(lists), width)), np.diff(lists.offsets.to_numpy())
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _products(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first row of a, products of some rows of a with all of b); exact."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] >= 1 << 53:
        a, b = a.astype(np.int64), b.astype(np.int64)
    step, turned = max(1, TILE_BYTES // (8 * max(1, len(b)))), np.ascontiguousarray(b.T)
    for at in range(0, len(a), step):
        yield at, (a[at : at + step] @ turned).astype(np.int64)


def _columns(t: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.ChunkedArray]:
    t = t.take(pa.array(np.argsort(t.column("id").to_numpy(), kind="stable")))
    return t.column("id").to_numpy(), t.column("label").to_numpy(), t.column("v")


def _found(rows: list[tuple[int, np.ndarray, np.ndarray]], kind: int) -> pa.Table:
    score = np.concatenate([np.empty(0, np.int64), *(r[1] for r in rows)])
    ids = np.concatenate([np.empty(0, np.int64), *(r[2] for r in rows)])
    anchor = np.repeat(np.array([r[0] for r in rows], np.int64), [len(r[1]) for r in rows])
    return pa.table([pa.array(anchor), pa.array(score), pa.array(np.full(len(ids), kind, np.int32)), pa.array(ids)], ["anchor", "score", "kind", "id"])


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first by descending score; ids ascend, so that the stable order settles ties."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    return some[np.argsort(-score[some], kind="stable")[:k]]


def _positives(width: int, k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not len(rows) or not len(anchors):
            return _found([], 0)
        (ids, labels, v), (a_ids, a_labels, a_v) = _columns(rows), _columns(anchors)
        out = []
        for at, s in _products(_matrix(a_v, width), _matrix(v, width)):
            for j in range(len(s)):
                same = np.flatnonzero((labels == a_labels[at + j]) & (ids != a_ids[at + j]))
                best = same[_best(s[j][same], ids[same], k)]
                out.append((a_ids[at + j], s[j][best], ids[best]))
        return _found(out, 0)

    return run


def _negatives(width: int, k: int, least: int, most: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not len(rows) or not len(anchors):
            return _found([], 1)
        ids, labels, v = _columns(rows)
        anchors = anchors.take(pa.array(np.argsort(anchors.column("id").to_numpy(), kind="stable")))
        a_ids, a_labels, bounds = anchors.column("id").to_numpy(), anchors.column("label").to_numpy(), anchors.column("bounds").to_pylist()
        out = []
        for at, s in _products(_matrix(anchors.column("v"), width), _matrix(v, width)):
            for j in range(len(s)):
                tops = np.unique(np.array(bounds[at + j], np.int64))
                some = np.flatnonzero((labels != a_labels[at + j]) & (100 * s[j] >= least * tops[0]) & (100 * s[j] <= most * tops[-1]))
                if not len(some):
                    continue
                down = some[np.argsort(-s[j][some], kind="stable")]
                falling = -100 * s[j][down]
                kept = set()
                for top in tops.tolist():  # the first k of each window
                    first = int(np.searchsorted(falling, -most * top))
                    last = int(np.searchsorted(falling, -least * top, side="right"))
                    kept.update(range(first, min(first + k, last)))
                chosen = down[np.array(sorted(kept), np.int64)]
                out.append((a_ids[at + j], s[j][chosen], ids[chosen]))
        return _found(out, 1)

    return run


def _windows(k: int, least: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened = None, []  # [id, score, negatives given] of positives whose window is open or still to come
        names = [c.split()[0] for c in MINED.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for b in batches:
            out: list[tuple] = []
            for a, score, kind, i in zip(*(b.column(c).to_pylist() for c in ("anchor", "score", "kind", "id")), strict=True):
                if a != anchor:
                    anchor, opened = a, []
                if kind == 0:
                    opened.append([i, score, 0])
                    continue
                opened = [w for w in opened if w[2] < k and least * w[1] <= 100 * score]  # scores fall: what is below stays so
                for w in opened:
                    if 100 * score <= most * w[1]:
                        w[2] += 1
                        out.append((a, w[0], w[2], i, w[1], score))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], names)

    return run


def mined(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """For each anchor and each of its first positives (rows of its label), the first negatives (rows of another label)
    whose score s satisfies least * p <= 100 * s <= most * p, p the positive's score; most is 100 at most.

    vectors: (id long, label, v array of integers); anchors: a condition on its columns. Scores are exact inner products;
    higher ones come first, ties by smaller id. Null ids, labels or vectors take no part. Of rows that share an id the
    least (label, v) stands, so repeated rows count once. Shorter vectors end in zeros. No rows, no anchors or no
    positives give no rows. Other columns of vectors are ignored.

    Anchors and rows are dealt out into blocks of a bounded size by a hash of the id, so no block follows a label or a
    group of copies; each pair of blocks is one group. What leaves a pair of blocks is at most `positives`, then
    positives * negatives rows for each anchor.
    """
    if most > 100:
        raise ValueError("negatives above their positive would come before it")
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    rows = saved(rows.select(F.col("id").cast("long").alias("id"), F.col("r.label").cast("long").alias("label"), "r.v").withColumn("anchor", F.coalesce(anchors, F.lit(False))), "vectors")
    n, m, width = rows.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("v"))).first()
    width = max(1, width or 0)
    a_blocks = max(1, -(-m * 8 * width // ANCHOR_BYTES))
    r_blocks = max(-(-n * 8 * width // ROW_BYTES), -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // a_blocks))
    every = lambda k, name: F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(name)
    mine = lambda k, name: F.pmod(F.xxhash64("id", F.lit(name)), F.lit(k)).cast("int").alias(name)
    left = rows.select("id", "label", "v", mine(r_blocks, "r"), every(a_blocks, "a")).groupBy("a", "r")
    chosen = rows.where("anchor").select(*(F.col(c).alias(c) for c in ("id", "label", "v")))

    def in_blocks(some: DataFrame, run) -> DataFrame:
        return left.cogroup(some.select("*", mine(a_blocks, "a"), every(r_blocks, "r")).groupBy("a", "r")).applyInArrow(run, FOUND)

    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    best = saved(in_blocks(chosen, _positives(width, positives)).withColumn("place", place).where(F.col("place") <= positives).drop("place"), "positives")
    bounds = best.groupBy(F.col("anchor").alias("id")).agg(F.collect_list("score").alias("bounds"))
    below = in_blocks(chosen.join(bounds, "id"), _negatives(width, negatives, least, most))
    pairs = best.unionByName(below).repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "kind", "id")
    return pairs.mapInArrow(_windows(negatives, least, most), MINED)
