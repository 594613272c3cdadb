"""Hard negatives against a plain version."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from axonlake.llm import hard_negatives
from axonlake.llm import queries as Q

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, v int"


def expected(rows, positives=5, negatives=5):
    vecs = {}
    for i, e, label in rows:
        if i is None or e is None or label is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        x = ((label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(np.float32(c)))) for c in e])
        vecs[i] = min(x, vecs.get(i, x))
    out = []
    for a in (i for i in vecs if i % 100 == 0):
        dot = lambda i: sum(p * q for p, q in zip(vecs[a][1], vecs[i][1]))  # noqa: E731, B023, B905
        scored = sorted((-dot(i), i) for i in vecs if i != a)
        for s, p in [x for x in scored if vecs[x[1]][0] == vecs[a][0]][:positives]:
            near = [x for x in scored if vecs[x[1]][0] != vecs[a][0] and -80 * s <= -100 * x[0] <= -100 * s]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n) in enumerate(near[:negatives])]
    return sorted(out)


def found(spark, folder, rows):
    spark.createDataFrame([(i, e, label, "x", 1) for i, e, label in rows], SCHEMA).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    x = Q.op13_hard_negative_mining(spark, str(folder))
    assert dict(x.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    return sorted(tuple(r) for r in x.collect())


def vectors(n, labels, seed, near=0.3):
    r = np.random.default_rng(seed)
    base = r.normal(size=8)
    return [(i, (base * near + r.normal(size=8) * 0.3).astype(np.float32).tolist(), int(r.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("labels", [2, 6])
@pytest.mark.parametrize("near", [0.0, 0.5])
def test_against_brute_force(spark, tmp_path, labels, near):
    rows = vectors(450, labels, labels, near)
    want = expected(rows)
    assert want and found(spark, tmp_path, rows) == want


def test_ties_copies_and_odd_rows(spark, tmp_path):
    r = random.Random(2)
    rows = vectors(120, 3, 9)
    rows += [(i, rows[0][1], r.randrange(3)) for i in range(150, 320)]  # one vector a hundred times
    rows += [(400, None, 1), (500, rows[3][1], None), (None, rows[3][1], 1), (600, [float("nan")] * 8, 1), (601, [float("inf")] + [0.0] * 7, 1), (602, [None, *rows[4][1][1:]], 2)]
    rows += [rows[5], rows[100], (7, rows[9][1], 2), (700, [], 0), (701, [0.5, -0.25], 0)]
    assert found(spark, tmp_path, rows) == expected(rows)


def test_small_blocks(spark, monkeypatch):
    rows = vectors(700, 4, 3, 0.4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    x = df.select(F.col("vec_id").alias("id"), F.col("label"), hard_negatives.integers(F.col("embedding"), 256).alias("v"))
    one = sorted(map(tuple, hard_negatives.mined(x, F.col("id") % 50 == 0).collect()))
    for name, size in (("ANCHOR_BYTES", 300), ("ROW_BYTES", 4000), ("TILE_BYTES", 900)):
        monkeypatch.setattr(hard_negatives, name, size)
    assert one and sorted(map(tuple, hard_negatives.mined(x, F.col("id") % 50 == 0).collect())) == one


@pytest.mark.parametrize("rows", [[], [(1, [0.5], 1)], [(100, [0.5], 1)], [(100, [0.5], 1), (101, [0.5], 1)], [(100, [0.0], 1), (101, [0.0], 1), (102, [0.0], 2)], [(100, [0.5], 1), (101, [-0.5], 1), (102, [-0.45], 2)]])
def test_few_rows(spark, tmp_path, rows):
    assert found(spark, tmp_path, rows) == expected(rows)


def test_exact_beyond_doubles(spark):
    big = hard_negatives.LIMIT
    rows = [(0, 0, [big, big - 1, 1]), (1, 0, [big, big, 3]), (2, 1, [big, big - 1, 2]), (3, 1, [big - 1, big, 7])]
    got = hard_negatives.mined(spark.createDataFrame(rows, "id long, label int, v array<int>"), F.col("id") == 0).collect()
    dot = lambda a, b: sum(x * y for x, y in zip(rows[a][2], rows[b][2], strict=True))
    assert [(r.positive_score, r.negative_id, r.negative_score) for r in got] == [(dot(0, 1), n, dot(0, n)) for _, n in sorted((-dot(0, n), n) for n in (2, 3))]
