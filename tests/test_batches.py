"""Groups dealt to files, node files by region combination, ranks and sums by group."""

import csv
import glob
import io
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from axonlake.operators import batches, reports, windows
from axonlake.sources import sinks


def dealt(sizes, files):
    """The rule, group by group."""
    n = sum(sizes.values())
    share = -(-n // files)
    big = [s for s in sizes.values() if s >= share]
    share = max(1, (n - sum(big) + files - 1) // max(1, files - len(big)))
    at, raw = 0, {}
    for key, size in sorted(sizes.items(), key=lambda x: (x[1], x[0]), reverse=True):
        raw[key] = at // share
        at += size
    number = {r: k for k, r in enumerate(sorted(set(raw.values())))}
    return {k: number[r] for k, r in raw.items()}


@pytest.mark.parametrize("files", [1, 2, 7, 40, 10_000])
def test_dealt_by_the_rule(spark, files):
    r = random.Random(files)
    keys = ["hot"] * 900 + [f"g{r.randrange(60) ** 2 // 50}" for _ in range(1800)]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "body long, rois string").repartition(5)
    got = batches.of_groups(df, "rois", files).collect()
    assert {x.rois: x.batch for x in got} == dealt(Counter(keys), files)
    assert {x.rois: x.size for x in got} == Counter(keys)
    rows = Counter(x.batch for x in batches.with_batch(df, "rois", batches.of_groups(df, "rois", files)).collect())
    assert sum(rows.values()) == len(keys) and set(rows) == set(range(len(rows)))
    assert len(rows) <= files + 1


def test_odd_groups(spark):
    assert batches.of_groups(spark.createDataFrame([], "body long, rois string"), "rois", 3).collect() == []
    x = spark.createDataFrame([(1, None), (2, None), (3, "a")], "body long, rois string")
    plan = batches.of_groups(x, "rois", 2)
    assert {r.rois: r.batch for r in plan.collect()} == {None: 0, "a": 1}
    assert batches.with_batch(x, "rois", plan).count() == 3
    with pytest.raises(ValueError):
        batches.of_groups(x, "rois", 0)


def read_batches(path):
    """{batch: (header, rows, files)} as an importer reads them."""
    out = {}
    for folder in glob.glob(f"{path}/rows/batch=*"):
        k = int(folder.rsplit("=", 1)[1])
        (head,) = glob.glob(f"{path}/headers/batch={k}/part-*")
        header = next(csv.reader(open(head)))
        files = glob.glob(f"{folder}/part-*")
        rows = [r for f in files for r in csv.reader(io.StringIO(open(f, newline="").read()))]
        out[k] = header, rows, len(files)
    return out


def test_node_files(spark, tmp_path):
    r = random.Random(4)
    combos = ["", "ME(R)", "LO(L),ME(R)", "A,B,C"] + [f"A,R{k:02}" for k in range(40)]
    rows = [(i, 'say "hi", ok' if i % 5 else None, [1, 2], i % 2 == 0, i * 10**6, "ME(R)" if i % 3 == 0 else r.choice(combos)) for i in range(3000)]
    df = spark.createDataFrame(rows, "body long, note string, xs array<int>, ok boolean, size long, rois string").withColumn("label", F.lit("Segment;Neuron"))
    told = sinks.node_batches(df.repartition(6), "rois", "segments", str(tmp_path), 12, rows_a_file=200, measured=True)
    got = read_batches(tmp_path)
    expected = dealt(Counter(x[-1] for x in rows), 12)
    assert {x.batch: x.rows for x in told.collect()} == {k: len(v[1]) for k, v in got.items()} == Counter(expected[x[-1]] for x in rows)
    seen = set()
    for k, (header, lines, _) in got.items():
        assert header[:6] == [":ID(Body-ID)", "note:string", "xs:int[]", "ok:boolean", "size:long", ":LABEL"]
        flags = [h.removesuffix(":boolean") for h in header[6:]]
        assert flags == sorted({n for c, b in expected.items() if b == k for n in c.split(",") if n})
        for line in lines:
            i = int(line[0])
            x = rows[i]
            seen.add(i)
            assert line[1:6] == ["" if x[1] is None else x[1], "1;2", str(x[3]).lower(), str(x[4]), "Segment;Neuron"]
            assert [n for n, f in zip(flags, line[6:], strict=True) if f == "true"] == sorted(n for n in x[5].split(",") if n)
    assert len(seen) == 3000
    hot = got[expected["ME(R)"]]
    assert hot[2] >= 4 and max(len(open(f).readlines()) for f in glob.glob(f"{tmp_path}/rows/*/part-*")) <= 1000 // 3


def test_ranks_and_sums_by_group(spark):
    r = random.Random(8)
    rows = [(r.choice(["a", "b", None, "hot", "hot", "hot"]), r.choice([None, 1, 2, 3]), i) for i in range(2500)] + [("one", 1, 9999)]
    df = spark.createDataFrame(rows, "g string, k int, t long").repartition(7)
    want, sums = {}, {}
    for g in {x[0] for x in rows}:
        total = 0
        for n, x in enumerate(sorted((x for x in rows if x[0] == g), key=lambda x: (x[1] is None, -(x[1] or 0), x[2]))):
            total += x[2] % 11
            want[x[2]], sums[x[2]] = n + 1, total
    x = windows.ranked_within(df, ["g"], ["k"], "t")
    assert {y.t: y["rank"] for y in x.collect()} == want
    block, windows.BLOCK = windows.BLOCK, 50
    got = windows.running_within(x.withColumn("v", F.col("t") % 11), ["g"], "rank", ["v"]).collect()
    windows.BLOCK = block
    assert {y.t: y.v for y in got} == sums


def test_decimation_is_bounded(spark):
    r = random.Random(2)
    rows, at = [], 0.0
    for report, n in (("long", 5000), ("short", 30)):
        at = 0.0
        for k in range(1, n + 1):
            at += r.random() / n
            rows.append((report, k, k * 7, 29 - k * 10 // n, at))
    curves = spark.createDataFrame(rows, "report string, rnk int, body int, status_rank int, traced_conn_frac double")
    kept = defaultdict(dict)
    for x in reports.decimated(curves, 100).collect():
        assert x.rnk not in kept[x.report]
        kept[x.report][x.rnk] = x.traced_conn_frac
    assert len(kept["short"]) == 30 and len(kept["long"]) <= 100 + 11 + 1
    for report, n in (("long", 5000), ("short", 30)):
        assert {1, n} <= set(kept[report])
        for s in {x[3] for x in rows if x[0] == report}:  # a status's last point stands
            assert max(x[1] for x in rows if x[0] == report and x[3] == s) in kept[report]
        ranks = sorted(kept[report])
        assert max(b - a for a, b in zip(ranks, ranks[1:])) <= -(-n // 100)
        for x in rows:  # the step function of the kept points is off by what one range adds at most
            if x[0] == report:
                below = max(k for k in ranks if k <= x[1])
                assert 0 <= x[4] - kept[report][below] <= (n // 100 + 1) / n


def test_modes_and_empty_reports(spark):
    points = spark.createDataFrame([(1, 10, "PreSyn", "A"), (2, 20, "PostSyn", "A"), (3, 20, "PostSyn", "B")], "point_id long, body long, kind string, roi string")
    partners = spark.createDataFrame([(1, 2, 10, 20, "A"), (1, 3, 10, 20, "B")], "pre_id long, post_id long, body_pre long, body_post long, roi string")
    ann = spark.createDataFrame([(10, 28), (30, 20), (40, 5)], "body long, status_rank int")
    present = spark.createDataFrame([(30, "A"), (99, "A")], "body long, roi string")
    spec = {"a": ["A"], "none": ["C"]}
    got = lambda mode: {(r.report, r.rnk): r.body for r in reports.forecast(points, partners, ann, spec, "roi", mode, present).collect()}
    assert got("none") == {("a", 1): 10, ("a", 2): 20}
    assert got("element-presence") == {("a", 1): 10, ("a", 2): 30, ("a", 3): 20}
    assert got("all") == {("a", 1): 10, ("a", 2): 30, ("a", 3): 40, ("a", 4): 20} | {("none", k + 1): b for k, b in enumerate((10, 30, 40))}
    with pytest.raises(ValueError):
        reports.forecast(points, partners, ann, spec, "roi", "some")
    assert reports.forecast(points.where("false"), partners.where("false"), ann, spec).count() == 0


def test_batch_queries_read_the_tables_once(spark):
    """Names are saved: what groups them and what joins them doesn't shuffle connections twice."""
    from axonlake import queries_more  # noqa: F401  registers them
    from axonlake.queries import QUERIES

    for name in ("w07_batches", "snk02_batch_flags"):
        assert not [f for f in QUERIES[name](spark, "/root/testdata/sf0.001").inputFiles() if "lineitem" in f]


def test_flags_of_every_file(spark):
    """Every body has its row, those of the first file too, with a flag for each region that its file holds."""
    from axonlake import queries_more  # noqa: F401  registers them
    from axonlake.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rois = {r.body: r.rois for r in QUERIES["a10_body_rois"](spark, folder).collect()}
    batch = dealt(Counter(rois.values()), queries_more.FILES)
    held = defaultdict(set)
    for combination, k in batch.items():
        held[k].update(combination.split(","))
    want = {b: (batch[x], ";".join(f"{r}={'true' if r in x.split(',') else ''}" for r in sorted(held[batch[x]]))) for b, x in rois.items()}
    got = QUERIES["snk02_batch_flags"](spark, folder).collect()
    assert len(got) == len(rois) and {r.body: (r.batch, r.flags) for r in got} == want
    assert Counter(r.batch for r in got)[0] > len(got) / queries_more.FILES


def test_flags_of_bodies_without_regions(spark, tmp_path):
    """Where some bodies lie in no region, their file has a flag without a name, as in SQL."""
    import shutil

    from axonlake import queries_more  # noqa: F401  registers them
    from axonlake.queries import QUERIES, SQL

    from .oracle import connect, difference

    source, folder = "/root/testdata/sf0.001", str(tmp_path / "tables")
    shutil.copytree(source, folder, ignore=shutil.ignore_patterns("nation*", "lineitem*"))
    con = connect(source)
    con.execute(f"COPY (SELECT * REPLACE ((CASE WHEN n_nationkey % 5 = 0 THEN 4 ELSE n_regionkey END)::INT AS n_regionkey) FROM nation) TO '{folder}/nation.parquet'")
    con.execute(f"COPY (SELECT * FROM lineitem WHERE l_orderkey % 40 = 0) TO '{folder}/lineitem.parquet'")
    assert difference(spark, connect(folder), folder, QUERIES["snk02_batch_flags"], SQL["snk02_batch_flags"]) == ""
    assert QUERIES["snk02_batch_flags"](spark, folder).where("flags LIKE '=true%'").count()
