"""Examples from the domain's documentation, contracts, sources and sinks."""

import json
import os
import pathlib
import random
import re
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from axonlake.functions import scalars
from axonlake.functions.constants import SIMPLE_STATUS, STATUS_RANK, STATUSES
from axonlake.operators import annotations, connectome, diff, graph, logs, nt, plotdata, reports, rois, stats, synapses, windows
from axonlake.plans import config, products
from axonlake.sources import adapter, readers, sinks

FOLDER = "/root/testdata/sf0.001"


def test_parent_regions(spark):
    u = "<unspecified>"
    rows = [(1, "Brain", "ME(R)", "ME_layer_1_R"), (2, "Brain", u, u), (3, "VNC", "ANm", u), (4, "VNC", u, u), (5, u, u, u), (6, "MB(R)", u, u)]
    x = rois.with_parents(spark.createDataFrame(rows, "i int, shell string, primary string, sub string"), {"sub": ("primary", ["ANm"]), "primary": ("shell", ["Brain", "VNC", "MB(R)"])})
    got = [(r.primary, r.sub) for r in x.orderBy("i").collect()]
    assert got == [("ME(R)", "ME_layer_1_R"), ("Brain-unspecified", u), ("ANm", "ANm-unspecified"), ("VNC-unspecified", u), (u, u), ("MB-unspecified(R)", u)]
    with pytest.raises(ValueError):
        scalars.parent_fallback(F.col("a"), F.col("b"), ["x-unspecified"])


def test_statuses():
    assert len(STATUSES) == 30 and STATUS_RANK["Sensory Anchor"] == 15 and STATUS_RANK["Leaves"] == 20
    assert SIMPLE_STATUS["Orphan hotknife"] == "Orphan" and SIMPLE_STATUS["Primary Anchor"] == "Anchor" and SIMPLE_STATUS["Finalized"] == "Traced"


def test_hierarchy():
    assert graph.hierarchy({"A": {"B": None, "C": {"D": None, "E": None}}}) == {"name": "A", "children": [{"name": "B"}, {"name": "C", "children": [{"name": "D"}, {"name": "E"}]}]}
    assert graph.parents({"A": {"B": None}}) == {"A": None, "B": "A"}
    with pytest.raises(ValueError):
        graph.hierarchy({"A": None, "B": None})


def test_point_forms(spark):
    forms = ["123, 456, 789", "[123, 456, 789]", "{x: 123, y: 456, z: 789}", '{"coordinates": [123, 456, 789], "k": 1}', "else", None]
    x = spark.createDataFrame([(i, s) for i, s in enumerate(forms)], "i int, s string")
    got = [r.p for r in x.select("i", scalars.parse_point(F.col("s")).alias("p")).orderBy("i").collect()]
    assert got == [[123.0, 456.0, 789.0]] * 4 + [None, None]


def test_templates(spark):
    x = spark.createDataFrame([(1234,), (0,)], "x long")
    got = x.select(scalars.label_template("C_{x // 100}_{x % 100}", F.col("x")).alias("n"), scalars.label_formula("x // 100", F.col("x")).alias("p")).collect()
    assert [tuple(r) for r in got] == [("C_12_34", 12), ("C_0_0", None)]
    for bad in ("{y}", "plain", "{__import__('os')}"):
        with pytest.raises(ValueError):
            scalars.label_template(bad, F.col("x"))


def test_float_threshold_and_null_kinds(spark):
    p = spark.createDataFrame([(1, "PreSyn", 0.7), (2, "PostSyn", 0.69), (3, None, 0.9)], "point_id long, kind string, conf float")
    s = spark.createDataFrame([(1, 2, 0.7, 0.7)], "pre_id long, post_id long, conf_pre float, conf_post float")
    a, b = synapses.confident(p, s, 0.7)
    assert {r.point_id for r in a.collect()} == {1, 3} and b.count() == 1
    assert synapses.check_kinds(p.where("point_id < 3")).count() == 2
    with pytest.raises(Exception, match="PreSyn or PostSyn"):
        synapses.check_kinds(p).collect()
    assert {r.point_id for r in synapses.drop_fake(p, s)[0].collect()} == {1, 2, 3}


def test_argmax_and_integral(spark):
    x = spark.createDataFrame([(0.1, 0.5), (0.5, 0.5), (float("nan"), 0.1), (None, None)], "a double, b double")
    assert [r[0] for r in x.select(scalars.argmax_name(F.array("a", "b"), ["a", "b"])).collect()] == ["b", "a", "b", None]
    y = spark.createDataFrame([(2.0,), (2.5,), (None,)], "a double")
    assert [r[0] for r in y.select(scalars.integral(F.col("a"))).collect()] == [2, None, None]


def test_names():
    assert scalars.camel_case("soma_position") == "somaPosition" and scalars.snake_case("consensusNt") == "consensus_nt"
    assert annotations.graph_names(["soma_position", "drop_me", "inst"], {"drop_me": "", "inst": "instance"}) == {"somaLocation": ["soma_position"], "instance": ["inst"]}
    assert nt.normalised_names(["nts_8.gaba", "nt_dopmaine_prob", "other"], {"dopmaine": "dopamine"}) == {"nts_8.gaba": "nt_gaba_prob", "nt_dopmaine_prob": "nt_dopamine_prob"}


def test_graph_annotations(spark):
    x = spark.createDataFrame([(1, "Traced", "", 1.0), (2, "Odd", "", None)], "body long, status_label string, empty string, size double")
    y = annotations.graph_annotations(x, {})
    assert set(y.columns) == {"body", "statusLabel", "size", "status"}
    assert {r.body: r.status for r in y.collect()} == {1: "Traced", 2: "Odd"}


def test_union_conflict(spark):
    with pytest.raises(ValueError):
        rois.union_of(spark.createDataFrame([("a",)], "r string"), "r", {"u": ["a"], "v": ["a"]}, "w")


def test_index_script():
    plan = graph.index_plan(["bodyId", "type", "secret"], ["ME(R)", "AL(L)"], ["secret", "AL(L)"])
    assert plan == {"properties": ["type"], "rois": ["ME(R)"]}
    assert "`demo_Neuron`" in graph.index_script("demo", plan)


def test_log_source(spark, tmp_path):
    text = 'tail of a message"}\n{"uri": "/a", "status": 200, "time": 5, "user": "u", "debug": "MATCH\nRETURN \\d"}\n{"uri": "/b", "status": 200, "time": 9, "user": "u", "debug": "x"}\n'
    (tmp_path / "log.txt").write_text(text)
    got = logs.parsed(logs.messages(spark, str(tmp_path / "log.txt"))).orderBy("time").collect()
    assert [(r.uri, r.debug) for r in got] == [("/a", "MATCH\nRETURN \\d"), ("/b", "x")]
    last = logs.last_per_user(logs.parsed(logs.messages(spark, str(tmp_path / "log.txt"))), "user", ("time",)).collect()
    assert [(r.uri, r.requests) for r in last] == [("/b", 2)]


def test_arrow_source_and_sinks(spark, tmp_path):
    import pyarrow as pa

    t = pa.table({"point_id": pa.array([1, 2, 3], pa.uint64()), "kind": pa.array(["PreSyn", "PostSyn", "PreSyn"]).dictionary_encode()})
    with pa.OSFile(str(tmp_path / "p.feather"), "wb") as f, pa.ipc.new_file(f, t.schema) as w:
        w.write_table(t, max_chunksize=2)
    x = readers.arrow(spark, str(tmp_path / "p.feather"))
    assert dict(x.dtypes) == {"point_id": "bigint", "kind": "string"} and sorted(r.point_id for r in x.collect()) == [1, 2, 3]
    sinks.arrow(x, str(tmp_path / "q.feather"))
    assert readers.arrow(spark, str(tmp_path / "q.feather")).count() == 3
    sinks.arrow(spark.range(100, numPartitions=3), str(tmp_path / "r"))
    assert sorted(r.id for r in readers.arrow(spark, str(tmp_path / "r")).collect()) == list(range(100))
    sinks.importer_csv(spark.createDataFrame([(1, ["a", "b"], True, "Segment")], "body long, tags array<string>, ok boolean, label string"), "segments", str(tmp_path / "csv"))
    y = spark.read.csv(str(tmp_path / "csv"), header=True)
    assert y.columns == [":ID(Body-ID)", "tags:string[]", "ok:boolean", ":LABEL"] and tuple(y.first()) == ("1", "a;b", "true", "Segment")
    (tmp_path / "ids.json").write_text(json.dumps({"ME": 1}))
    assert readers.region_ids(str(tmp_path / "ids.json")) == {"ME": 1}
    with pytest.raises(ValueError):
        readers.required(x, "nothing")
    assert sinks.viewer_state('{"a": "$TAG"}', {"$TAG": "v1"}) == '{"a": "v1"}'


def test_products(spark):
    syn = adapter.partners(spark, FOLDER)
    points, ann = adapter.points(syn), adapter.annotations(spark, FOLDER)
    flat = products.flat(points, syn, ann, "shell_roi")
    assert flat["weights"].selectExpr("sum(weight)").first()[0] == flat["partners"].count()
    limits = {"conf": 0, "high_accuracy": 5, "high_precision": 8, "neuron": {"synweight": 100}, "excluded": []}
    g = products.property_graph(points, syn, ann.withColumn("status", F.lit("Traced")), ["primary_roi", "shell_roi"], limits, "demo", "v1", {"ALL": {"ASIA": None}})
    ids = g["sets"].select("id")
    assert g["set_to_set"].join(ids, F.col("start_id") == F.col("id"), "left_anti").count() == 0
    assert g["set_to_synapse"].join(ids, "id", "left_anti").count() == 0
    assert g["meta"].count() == 1 and json.loads(g["meta"].first().roiHierarchy)["name"] == "ALL"
    c = products.completeness(points, syn, ann, "shell_roi", {"all": [], "asia": ["ASIA"]})
    assert {r.report for r in c["syn-counts"].collect()} == {"all", "asia"} and c["status"].where("report = 'asia'").count() > 0


def test_curve_ends_at_one(spark):
    syn = adapter.partners(spark, FOLDER)
    ann = syn.select(F.explode(F.array("body_pre", "body_post")).alias("body")).distinct().withColumn("status_rank", F.lit(5))
    last = reports.completeness(adapter.points(syn), syn, ann).orderBy(F.desc("rnk")).first()
    assert all(abs(last[c] - 1) < 1e-9 for c in last.asDict() if c.startswith("traced_"))


def test_curves_have_all_bodies(spark):
    """More bodies than the command's default stop: without one no rank is left out."""
    n = 1_000_003
    points = spark.range(n).select(F.col("id").alias("point_id"), F.col("id").alias("body"), F.lit("PreSyn").alias("kind"), F.lit("A").alias("roi"))
    ann, syn = points.select("body", F.lit(5).alias("status_rank")), spark.createDataFrame([(1, 2, 1, n - 1, "A")], "pre_id long, post_id long, body_pre long, body_post long, roi string")
    for curve in (reports.completeness(points, syn, ann), reports.forecast(points, syn, ann, {"all": []})):
        assert curve.agg(F.count("*"), F.max("rnk"), F.max("traced_conn_frac")).first()[:] == (n, n, 1.0)


def test_in_bounds_takes_all_connections(spark):
    """Against brute force, without a limit on confidence."""
    from axonlake.queries import QUERIES

    syn = adapter.partners(spark, FOLDER).collect()
    bodies = {b for r in syn if r.primary_roi in ("NATION_3", "NATION_7") for b in (r.body_pre, r.body_post)}
    want = {(r.pre_id, r.post_id) for r in syn if r.body_pre in bodies or r.body_post in bodies}
    assert {tuple(r) for r in QUERIES["f08_in_bounds"](spark, FOLDER).collect()} == want


def test_rounding_is_that_of_sql(spark):
    import duckdb

    for k in (6_000_000, 36_000_000):
        got = spark.range(k // 60).select(scalars.rounded(F.col("id") / k, 6).alias("x")).collect()
        want = duckdb.connect().execute(f"SELECT round(i / {k}, 6) FROM range({k // 60}) t(i) ORDER BY i").fetchall()
        assert [r.x for r in got] == [w[0] for w in want]


def test_snapshot_command(spark, tmp_path):
    syn = adapter.partners(spark, FOLDER)
    adapter.points(syn).write.parquet(f"{tmp_path}/points")
    syn.select("pre_id", "post_id").write.parquet(f"{tmp_path}/partners")
    adapter.annotations(spark, FOLDER).withColumn("status", F.lit("Traced")).write.parquet(f"{tmp_path}/ann")
    c = {"points": f"{tmp_path}/points", "partners": f"{tmp_path}/partners", "annotations": f"{tmp_path}/ann", "output": f"{tmp_path}/out", "roisets": ["primary_roi", "shell_roi"], "products": ["flat", "graph"], "tag": "v1"}
    (tmp_path / "c.json").write_text(json.dumps(c))
    assert config.main([str(tmp_path / "c.json")]) == 0
    assert spark.read.parquet(f"{tmp_path}/out/flat/weights").count() > 0 and spark.read.csv(f"{tmp_path}/out/graph/connections", header=True).columns[:2] == [":START_ID(Body-ID)", ":END_ID(Body-ID)"]
    with pytest.raises(ValueError):
        config.Config(zone="moon")


def test_stream_equals_batch(spark, tmp_path):
    from axonlake import streaming

    e = spark.read.parquet(f"{FOLDER}/events.parquet")
    e.repartition(3).write.parquet(f"{tmp_path}/in")
    s = streaming.last_per_user(streaming.events(spark, f"{tmp_path}/in"), "user_id", ("ts", "event_id"))
    q = s.writeStream.format("memory").queryName("last_requests").outputMode("complete").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r.user_id, r.event_id, r.requests) for r in spark.table("last_requests").collect()}
    assert got == {(r.user_id, r.event_id, r.requests) for r in logs.last_per_user(e, "user_id", ("ts", "event_id")).collect()}


def test_without_corpus_package(tmp_path):
    """Nothing outside axonlake.llm imports it: a copy without it and the pipeline still has the other queries."""
    root = pathlib.Path(__file__).resolve().parents[1]
    shutil.copytree(root / "axonlake", tmp_path / "axonlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q) and not any(k.startswith('op1_') or k == 'pipeline' for k in q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}).returncode == 0


def test_plot_data_and_diff_edges(spark):
    x = spark.createDataFrame([("LegNp(T3)(L)", 1.0), ("LegNp(T3)(R)", 3.0), ("ANm", 2.0)], "name string, v double")
    got = {r.base: (r.L, r.R, r.C, r.mean, r.residual, r.min_side) for r in plotdata.by_side(x, "name", "v").collect()}
    assert got == {"LegNp(T3)": (1.0, 3.0, None, 2.0, 1.0, "L"), "ANm": (None, None, 2.0, None, None, None)}
    a = spark.createDataFrame([(1, None, 1.0), (2, "x", None)], "k int, s string, f double")
    assert diff.change_mask(a, a, "k").count() == 0
    assert stats.union_all(a, x).count() == 5 and connectome.weighted(spark.createDataFrame([(None, 1)], "body_pre int, body_post int")).count() == 0


def test_all_products_by_command(spark, tmp_path):
    syn = adapter.partners(spark, FOLDER)
    adapter.points(syn).write.parquet(f"{tmp_path}/points")
    syn.select("pre_id", "post_id").write.parquet(f"{tmp_path}/partners")
    adapter.annotations(spark, FOLDER).withColumn("status", F.lit("Traced")).withColumn("cell_type", F.col("type")).write.parquet(f"{tmp_path}/ann")
    e = readers.with_point_ids(adapter.elements(spark, FOLDER))
    e.write.parquet(f"{tmp_path}/elm")
    e.groupBy("body").agg(F.min("point_id").alias("source_id"), F.max("point_id").alias("target_id")).write.parquet(f"{tmp_path}/far")
    adapter.nt_points(spark, FOLDER).withColumn("point_id", F.col("vec_id") * 64).write.parquet(f"{tmp_path}/nt")
    truth = spark.createDataFrame([(f"T{i}", adapter.TRANSMITTERS[i % 4]) for i in range(12)], "cell_type string, ground_truth string")
    truth.write.parquet(f"{tmp_path}/truth")
    truth.limit(2).select("cell_type", F.col("ground_truth").alias("consensus_nt"), F.lit("a").alias("nt_reference"), F.lit("").alias("other_nt"), F.lit("").alias("other_nt_reference")).write.parquet(f"{tmp_path}/exp")
    c = {
        "points": f"{tmp_path}/points", "partners": f"{tmp_path}/partners", "annotations": f"{tmp_path}/ann", "elements": f"{tmp_path}/elm", "element_distances": f"{tmp_path}/far", "element_kinds": ["O", "F"], "output": f"{tmp_path}/out",
        "transmitters": f"{tmp_path}/nt", "transmitter_names": adapter.TRANSMITTERS, "transmitter_truth": f"{tmp_path}/truth", "transmitter_experimental": f"{tmp_path}/exp",
        "roisets": ["primary_roi", "shell_roi"], "region_flags": ["ASIA"], "report_roiset": "shell_roi", "reports": {"all": [], "asia": ["ASIA"]}, "report_subsets": {"one": ["asia"]}, "report_points": 50, "report_bodies": "all", "products": ["flat", "graph", "reports", "transmitters"], "tag": "v1", "high_accuracy": 5, "high_precision": 8, "graph_format": "parquet",
    }
    (tmp_path / "c.json").write_text(json.dumps(c))
    assert config.main([str(tmp_path / "c.json"), "-c"]) == 0 and not (tmp_path / "out").exists()
    assert config.main([str(tmp_path / "c.json")]) == 0
    segments = spark.read.parquet(f"{tmp_path}/out/graph/segments")
    assert {"roiInfo", "total", "O", "F", "ASIA", "label", "predictedNt", "bodyId", "cellType"} <= set(segments.columns) and segments.where("label LIKE '%Neuron;snapshot_Neuron'").count() > 0 and segments.groupBy("body").count().where("count > 1").count() == 0
    assert spark.read.parquet(f"{tmp_path}/out/graph/close_to").where("distance >= 0").count() == e.select("body").distinct().count()
    assert "roiInfo" in spark.read.parquet(f"{tmp_path}/out/graph/connections").columns
    status = spark.read.parquet(f"{tmp_path}/out/reports/status")
    assert {r.report for r in status.select("report").distinct().collect()} == {"all", "asia"} and spark.read.parquet(f"{tmp_path}/out/reports/summaries").select("subset").distinct().count() == 2
    assert spark.read.parquet(f"{tmp_path}/out/reports/curves-plotted").groupBy("report").count().agg(F.max("count")).first()[0] <= 50 + 30 + 1
    assert spark.read.parquet(f"{tmp_path}/out/flat/status-counts").collect() and "bodyType" not in spark.read.parquet(f"{tmp_path}/out/flat/body-annotations").columns
    nodes = spark.read.parquet(f"{tmp_path}/out/graph/synapses")
    assert set(adapter.TRANSMITTERS) <= set(nodes.columns) and nodes.where("gaba IS NOT NULL").count() > 0
    assert spark.read.parquet(f"{tmp_path}/out/transmitters/confusion").count() == 49


def test_loaded_hierarchy(tmp_path):
    (tmp_path / "h.json").write_text('{"A": ["B", "C"], "D": {}}')
    regions = {"primary": ["ME", "LO"]}.__getitem__
    tree = graph.loaded_hierarchy({"ALL": {"x": "roiset://primary", "y": str(tmp_path / "h.json"), "z": None}}, regions, readers.json_file)
    assert tree == {"ALL": {"x": {"ME": None, "LO": None}, "y": {"A": {"B": None, "C": None}, "D": None}, "z": None}}
    assert graph.parents(tree)["B"] == "A" and graph.loaded_hierarchy({}, regions, readers.json_file) is None
    for bad in ("h.txt", 5):
        with pytest.raises(ValueError):
            graph.loaded_hierarchy({"ALL": bad}, regions, readers.json_file)


def test_exported_names(spark):
    x = spark.createDataFrame([(1, 2, "a", "Segment;Neuron")], "body long, status_rank int, ME_R string, label string")
    y = graph.exported(x, "d", {"status_rank": "rank"}, ("ME_R",))
    assert y.columns == ["body", "rank", "ME_R", "label", "bodyId"] and y.first().label == "Segment;d_Segment;Neuron;d_Neuron"
    with pytest.raises(ValueError, match="bodyId|statusRank"):
        graph.exported(x.withColumn("statusRank", F.lit(1)), "d")


def test_ranks_cross_partitions(spark):
    r = random.Random(3)
    rows = [(r.randrange(5), r.randrange(3), r.randrange(10**15)) for _ in range(3000)] + [(None, 1, 5), (2, None, 6)]
    got = {(x.a, x.b, x.t): x.rank for x in windows.ranked(spark.createDataFrame(rows, "a int, b int, t long"), ["a", "b"], "t").collect()}
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] is None, -(x[1] or 0), x[2]))
    assert got == {x: k + 1 for k, x in enumerate(order)}
    x = spark.range(1, 2001).select(F.col("id").alias("rnk"), (F.col("id") % 7).alias("n"))
    block, windows.BLOCK = windows.BLOCK, 64
    sums = {y.rnk: y.n for y in windows.running(x, "rnk", ["n"]).collect()}
    windows.BLOCK = block
    assert sums == {k: sum(j % 7 for j in range(1, k + 1)) for k in range(1, 2001)}
    assert windows.ranked(spark.createDataFrame([], "a int, b int, t long"), ["a"], "t").collect() == []


def test_checks_that_must_fail(spark):
    points = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "point_id long, r_label int")
    assert {x.point_id: x.r for x in rois.named(points, "r", {"ME": 1, "LO": 2}).collect()} == {1: "LO", 2: "<unspecified>", 3: "ME"}
    with pytest.raises(Exception, match="has no name"):
        rois.named(points, "r", {"ME": 1}).collect()
    p = spark.createDataFrame([(1, "gaba"), (1, "gaba"), (1, "x")], "body long, pred1 string")
    m = spark.createDataFrame([("gaba", "gaba", 0.5)], "ground_truth string, pred1 string, p double")
    with pytest.raises(Exception, match="lacks a pair"):
        nt.group_confidence(p, nt.mode(p, "body"), m, "body").collect()
