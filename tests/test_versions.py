"""Versioned tables: a refresh equals the full build, and leaves what did not change untouched."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from axonlake.functions.scalars import range_of
from axonlake.operators import stats
from axonlake.plans import refresh
from axonlake.sources import adapter, versions

FOLDER = "/root/testdata/sf0.001"


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/**/part-*", recursive=True)}


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65])
def test_range_of(spark, n):
    lows = [-(1 << 63)] + [k * k * 10**12 for k in range(1, n)]
    keys = [None, -(1 << 63), -5, 0, 10**12 - 1, 10**12, (1 << 63) - 1] + [low + d for low in lows[1:] for d in (-1, 0, 1)]
    x = spark.createDataFrame([(k,) for k in keys], "k long").select("k", range_of(F.col("k"), lows).alias("r"))
    assert {(r.k, r.r) for r in x.collect()} == {(k, None if k is None else sum(low <= k for low in lows) - 1) for k in keys}


def test_refresh_equals_full_build(spark, tmp_path):
    r = random.Random(1)
    old = {k * 7 - 500: r.randrange(100) for k in range(2000)}
    path = f"file://{tmp_path}/t"
    frame = lambda d: spark.createDataFrame(sorted(d.items()), "body long, n int")
    m = versions.create(frame(old), path, "body", 200, {"uuid": "a"})
    assert rows(versions.read(spark, path)) == sorted(old.items()) and len(m.ranges) >= 8 and sum(x[2] for x in m.ranges) == 2000
    before = files(f"{tmp_path}/t")
    new = dict(old)
    stale = [k for k in old if 1000 < k < 1400] + [10**9, -10**9]  # changed, gone and new bodies
    for k in stale:
        if k % 3:
            new[k] = -1
        else:
            new.pop(k, None)
    changed = {k: v for k, v in new.items() if k in stale} | {5: 99}  # 5 isn't stale, so it stays as it is
    versions.refresh(spark, path, spark.createDataFrame([(k,) for k in [*stale, *stale, None]], "body long"), frame(changed), {"uuid": "b"})
    assert rows(versions.read(spark, path)) == sorted(new.items())
    assert rows(versions.read(spark, path, version=0)) == sorted(old.items())
    after = files(f"{tmp_path}/t")
    assert {f: t for f, t in after.items() if f in before} == before
    m1 = versions.manifest(spark, path)
    assert m1.version == 1 and m1.source == {"uuid": "b"} and 2 <= sum(x[1] == 1 for x in m1.ranges) < len(m1.ranges) / 2
    assert rows(versions.read(spark, path, least=1001, most=1399)) == sorted((k, v) for k, v in new.items() if 1000 < k < 1400)


def test_ranges_grow_and_empty(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    frame = lambda keys: spark.createDataFrame([(k, k % 5) for k in keys], "body long, n int")
    versions.create(frame([]), path, "body", 50)
    assert rows(versions.read(spark, path)) == []
    versions.refresh(spark, path, frame(range(1000)), frame(range(1000)))
    m = versions.manifest(spark, path)
    assert len(m.ranges) > 8 and max(x[2] for x in m.ranges) <= 110 and versions.read(spark, path).count() == 1000
    versions.refresh(spark, path, frame(range(0, 500)), frame([]))
    assert rows(versions.read(spark, path)) == [(k, k % 5) for k in range(500, 1000)]
    kept = versions.manifest(spark, path)
    versions.refresh(spark, path, frame([]), frame(range(10)), {"mutation": 9})
    last = versions.manifest(spark, path)
    assert last.ranges == kept.ranges and last.source == {"mutation": 9} and last.version == kept.version + 1
    with pytest.raises(ValueError):
        versions.create(frame([1]), path, "body")
    with pytest.raises(ValueError):
        versions.manifest(spark, path, 77)
    assert versions.versions(spark, f"file://{tmp_path}/none") == []


def test_body_counts(spark, tmp_path):
    syn = adapter.partners(spark, FOLDER)
    points = adapter.points(syn)
    gone = F.col("pre_id") % 640 == 0
    old = syn.where(~gone)
    path = f"file://{tmp_path}/counts"
    none = spark.createDataFrame([], "version int, changed long, created long")
    refresh.body_counts(spark, path, adapter.points(old), old, none, 5, 100)
    ends = syn.where(gone).select(F.lit(7).alias("version"), F.col("body_pre").alias("changed"), F.col("body_post").alias("created"))
    before = files(f"{tmp_path}/counts")
    assert refresh.body_counts(spark, path, points, syn, ends, 5).version == 0
    m = refresh.body_counts(spark, path, points, syn, ends, 7)
    assert m.version == 1 and m.source == {"mutation": 7}
    assert rows(versions.read(spark, path)) == rows(stats.body_stats(points, syn))
    after = files(f"{tmp_path}/counts")
    assert {f: t for f, t in after.items() if f in before} == before


def test_sizes_keep_what_was_not_fetched(spark, tmp_path):
    path = f"file://{tmp_path}/sizes"
    frame = lambda d: spark.createDataFrame(list(d.items()), "body long, size long")
    refresh.sizes(spark, path, frame({1: 10, 2: 20, 3: 30}))
    refresh.sizes(spark, path, frame({2: 21, 4: 40, 3: 31}), spark.createDataFrame([(1,), (2,), (4,)], "body long"))
    assert rows(versions.read(spark, path)) == [(1, 10), (2, 21), (3, 30), (4, 40)]


def test_changes_of_a_refresh_are_computed_once(spark, tmp_path):
    path, seen = str(tmp_path / "once"), spark.sparkContext.accumulator(0)
    points = spark.createDataFrame([(5, "PreSyn"), (6, "PostSyn"), (9, "PostSyn")], "body long, kind string")
    partners = spark.createDataFrame([(5, 6), (5, 9)], "body_pre long, body_post long")

    def told(body):
        seen.add(1)
        return body

    changes = spark.createDataFrame([(2, 5, 6)], "version int, changed long, created long")
    changes = changes.withColumn("changed", F.udf(told, "long").asNondeterministic()("changed"))
    refresh.body_counts(spark, path, points, partners, changes, 1)
    refresh.body_counts(spark, path, points, partners, changes, 2)
    assert seen.value == 1
    assert {tuple(r) for r in versions.read(spark, path).collect()} == {(5, 1, 0, 2, 0, 2), (6, 0, 1, 0, 1, 1), (9, 0, 1, 0, 1, 1)}
