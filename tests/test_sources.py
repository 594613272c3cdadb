"""Arrow files with pushdown, log tails, volumes."""

import json
import random

import pytest
from pyspark.sql import functions as F

from axonlake.operators import logs, rois
from axonlake.sources import readers, sinks, volumes


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('arrow')}/t"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    x = spark.range(0, 2000, 1, 2).select(F.col("id").alias("point_id"), (F.col("id") % 7).cast("int").alias("kind"), F.concat(F.lit("t"), F.col("id") % 3).alias("name"), F.when(F.col("id") % 5 > 0, F.col("id") * 0.5).alias("v"))
    sinks.arrow(x, path)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("test", ["point_id >= 1850", "point_id > 100 AND point_id < 120 AND kind = 3", "point_id IN (5, 6, 1999, 7000)", "name = 't1' AND point_id <= 20", "point_id = 77 OR kind = 2", "v > 900", "point_id < 0", "v IS NULL AND kind <> 1"])
def test_filters_change_nothing(spark, table, test):
    whole = readers.arrow(spark, table)
    assert rows(whole.where(test)) == sorted([r for r in rows(spark.createDataFrame(whole.collect(), whole.schema).where(test))], key=str)


def test_pushed_filters_skip_batches(spark, table):
    x = readers.arrow(spark, table).where("point_id >= 1850 AND point_id < 1950 AND v > 0")
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert "1850" not in plan and "1950" not in plan and "v#" in plan.split("Filter")[1]  # the source has taken them over
    assert x.rdd.getNumPartitions() == 2 and readers.arrow(spark, table).rdd.getNumPartitions() == 20
    assert readers.arrow(spark, table).where("point_id > 5000").count() == 0
    assert readers.arrow(spark, table).where("kind >= 6").count() == 285


def test_columns_are_chosen(spark, table):
    x = readers.arrow(spark, table, ["name", "point_id"])
    assert x.columns == ["name", "point_id"] and rows(x.where("point_id < 3")) == [("t0", 0), ("t1", 1), ("t2", 2)]
    r = readers._ArrowReader(table, ["name"])
    assert list(r.pushFilters([readers.EqualTo(("kind",), 2), readers.EqualTo(("v",), 0.5)])) == [readers.EqualTo(("v",), 0.5)]
    got = [b for p in r.partitions() for b in r.read(p)]
    assert {c for b in got for c in b.schema.names} == {"name"} and sum(b.num_rows for b in got) == 286


def log(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        text = "".join(r.choice(['x', '\\n{', ' {"', '\n{x', "é", '\n', '\\L', '{"']) for _ in range(r.randrange(30)))
        body = json.dumps({"uri": f"/u{i}", "status": 200, "time": i, "user": f"p{i % 5}"})[:-1]
        out.append(body + ', "debug": "' + text.replace('\n{"', "\n ").replace('"', "'") + '"}')
    return out


@pytest.mark.parametrize("step", [7, 64, 1000, 10**6])
@pytest.mark.parametrize("chunk", [5, 1 << 20])
def test_ranges_give_each_message_once(tmp_path, monkeypatch, step, chunk):
    monkeypatch.setattr(readers, "CHUNK", chunk)
    messages = [m.encode() for m in log(60, 3)]
    for lead in (b"", b'the end of a message {"\n'):
        data = lead + b"\n".join(messages) + b"\n"
        (tmp_path / "log").write_bytes(data)
        starts, at = [], len(lead)
        for m in messages:
            starts.append(at)
            at += len(m) + 1
        for tail in (0, 1, 90, len(data) // 2, len(data) - 1, len(data) + 5):
            r = readers._TailReader(str(tmp_path / "log"), tail, step)
            got = [v for p in r.partitions() for b in r.read(p) for v in b.column(0).to_pylist()]
            least = len(data) - tail if 0 < tail < len(data) else 0
            assert got == [m.decode() for m, s in zip(messages, starts, strict=True) if s >= least]


def test_tail_equals_batch(spark, tmp_path):
    messages = log(300, 9)
    (tmp_path / "log").write_text("\n".join(messages))
    size = (tmp_path / "log").stat().st_size
    key = lambda df: sorted((r.time, r.uri, r.debug) for r in df.collect())
    whole = key(logs.parsed(logs.messages(spark, str(tmp_path / "log"))))
    assert whole and key(logs.parsed(readers.log_tail(spark, str(tmp_path / "log"), 0, 500))) == whole
    tail = key(logs.parsed(readers.log_tail(spark, f"file://{tmp_path}/log", size // 3, 700)))
    assert tail == whole[-len(tail):] and 60 < len(tail) < 160
    (tmp_path / "empty").write_text("")
    assert readers.log_tail(spark, str(tmp_path / "empty")).count() == 0


def test_volume(spark, tmp_path):
    r = random.Random(6)
    voxels = {(r.randrange(-40, 70), r.randrange(70), x): r.randrange(4) for _ in range(300) for a in [r.randrange(60)] for x in range(a, a + r.randrange(1, 12))}
    v = spark.createDataFrame([(*k, n) for k, n in voxels.items()], "bz int, by int, bx int, label int")
    path, built = f"file://{tmp_path}/v", []

    def build():
        built.append(1)
        return v

    points = spark.createDataFrame([(z * 32 + r.randrange(32), y * 32 + r.randrange(32), x * 32 + r.randrange(32)) for z, y, x in [*list(voxels)[:200], *[(r.randrange(-90, 120), r.randrange(90), r.randrange(90)) for _ in range(300)]]], "z int, y int, x int")
    want = rows(rois.from_volume(points, v, "a"))
    for ids, times in (({"A": 1}, 1), ({"A": 1}, 1), ({"A": 1, "B": 2}, 2), ({"A": 1, "B": 2}, 2)):
        blocks, box = volumes.cached(spark, path, ids, build)
        assert len(built) == times and box["voxels"] == sum(n != 0 for n in voxels.values())
        assert rows(rois.from_volume(points, volumes.near(blocks, box, points), "a")) == want
    inside = points.where("z BETWEEN 0 AND 1500 AND y < 1500 AND x < 1500")
    got = volumes.near(blocks, box, inside)
    assert got.count() < box["voxels"] and "GreaterThanOrEqual(k" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(rois.from_volume(inside, got, "a")) == rows(rois.from_volume(inside, v, "a"))
    assert volumes.load(spark, path, {"A": 2}) is None and volumes.load(spark, f"{path}/none", {}) is None
    empty = volumes.cached(spark, f"file://{tmp_path}/e", {}, lambda: v.where("label = 0"))
    assert rows(rois.from_volume(points, volumes.near(*empty, points), "a")) == sorted([(*t, 0) for t in rows(points)], key=str)


def test_lines_and_orders_meet_by_pre_id(spark):
    """Connections are dealt out by pre_id itself, which what comes next by pre_id can use, not by the line's order."""
    from axonlake.sources import adapter

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = adapter.partners(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(pre_id" in plan and "hashpartitioning(l_orderkey" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
