"""Queries of windows, order, scalars, composites, differences, reports and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import scalars
from .functions.constants import SIMPLE_STATUS, STATUSES
from .operators import annotations, batches, connectome, diff, graph, logs, nt, plotdata, reports, rois, rows, stats, synapses
from .queries import ANN, CAP, COMP, CONF, ELM, LONG, MODES, NAMES, NT, POINTS, PRED, ROISETS, SIDES, STATS, SYN, TRUTH, _COUNTS, _matrix, _pred, _sides, of, query, simple
from .sources import shared
from .sources.adapter import TRANSMITTERS

# Neurotransmitter chain

LIMITS = {"body_confidence": 0.2, "body_presyn": 3, "celltype_confidence": 0.2, "celltype_presyn": 12}
GROUPS = """bmode AS (SELECT body, pred1 AS gp FROM (SELECT body, pred1, row_number() OVER (PARTITION BY body ORDER BY count(*) DESC, pred1) AS r FROM pred GROUP BY 1, 2) WHERE r = 1),
 tmode AS (SELECT cell_type, CASE WHEN cell_type IS NOT NULL THEN pred1 END AS gp FROM (SELECT cell_type, pred1, row_number() OVER (PARTITION BY cell_type ORDER BY count(*) DESC, pred1) AS r FROM pred GROUP BY 1, 2) WHERE r = 1),
 ball AS (SELECT pred.body, any_value(pred.cell_type) AS cell_type, any_value(gp) AS gp, coalesce(avg(p), 0) AS confidence, count(pred.pred1) AS n FROM pred JOIN bmode USING (body) LEFT JOIN conf ON conf.ground_truth = gp AND conf.pred1 = pred.pred1 GROUP BY pred.body),
 tall AS (SELECT pred.cell_type, any_value(gp) AS gp, coalesce(avg(p), 0) AS confidence, count(pred.pred1) AS n FROM pred JOIN tmode ON pred.cell_type IS NOT DISTINCT FROM tmode.cell_type LEFT JOIN conf ON conf.ground_truth = gp AND conf.pred1 = pred.pred1 GROUP BY pred.cell_type),
 bfin AS (SELECT body, cell_type, CASE WHEN confidence < 0.2 OR n < 3 THEN 'unclear' ELSE coalesce(gp, 'unclear') END AS top, confidence, n FROM ball),
 tfin AS (SELECT t.cell_type, CASE WHEN confidence < 0.2 OR n < CASE WHEN coalesce(cells, 0) <= 1 THEN 3 ELSE 12 END THEN 'unclear' ELSE coalesce(gp, 'unclear') END AS top, confidence, n, coalesce(cells, 0) AS cells FROM tall t LEFT JOIN (SELECT cell_type, count(*) AS cells FROM ball WHERE cell_type IS NOT NULL GROUP BY 1) c ON c.cell_type = t.cell_type)"""
CHAIN = (NT, PRED, TRUTH, CONF, GROUPS)


def _groups(w):
    p = _pred(w)
    ann = w.nt.select("body", "cell_type").distinct()
    m = _matrix(w, p)
    return nt.erased(nt.group_predictions(p, ann, m, "body"), nt.group_predictions(p, ann, m, "cell_type"), LIMITS)


def _bodies(w):
    b, t = _groups(w)
    return nt.with_type_predictions(b, t)


ROUND = lambda c: scalars.rounded(F.col(c), 6).alias(c)
simple("a18_type_thresholds", "SELECT cell_type, top AS top_pred, cells AS num_cells, n AS num_tbar_nt_predictions, round(confidence, 6) AS confidence FROM tfin", *CHAIN)(lambda w: _groups(w)[1].select("cell_type", "top_pred", "num_cells", "num_tbar_nt_predictions", ROUND("confidence")))
simple("p23_erase_unreliable", "SELECT body, top AS top_pred, round(confidence, 6) AS confidence, n AS num_tbar_nt_predictions FROM bfin", *CHAIN)(lambda w: _groups(w)[0].select("body", "top_pred", ROUND("confidence"), "num_tbar_nt_predictions"))
simple(
    "p24_consensus",
    "SELECT b.body, b.cell_type, b.top AS predicted_nt, t.top AS celltype_predicted_nt, b.n AS total_nt_predictions, t.n AS celltype_total_nt_predictions, CASE WHEN b.cell_type = 'T3' THEN 'histamine' WHEN CASE WHEN b.cell_type IS NULL THEN b.top ELSE t.top END = 'octopamine' THEN 'unclear' ELSE CASE WHEN b.cell_type IS NULL THEN b.top ELSE t.top END END AS consensus_nt FROM bfin b LEFT JOIN tfin t ON b.cell_type IS NOT DISTINCT FROM t.cell_type",
    *CHAIN,
)(lambda w: nt.with_consensus(_bodies(w), {"octopamine": "unclear"}, w.spark.createDataFrame([("T3", "histamine")], "cell_type string, consensus_nt string")).select("body", "cell_type", "predicted_nt", "celltype_predicted_nt", "total_nt_predictions", "celltype_total_nt_predictions", "consensus_nt"))
simple("p25_retyped", "SELECT b.body, CASE WHEN cell_type <> CASE WHEN b.body % 5 = 0 THEN 'T0' ELSE cell_type END THEN NULL ELSE top END AS predicted_nt FROM bfin b", *CHAIN)(lambda w: nt.kept_if_same_type(_bodies(w), w.nt.select("body", F.when(F.col("body") % 5 == 0, F.lit("T0")).otherwise(F.col("cell_type")).alias("type")).distinct()).select("body", "predicted_nt"))
simple("j14_confusion_lookup", "SELECT vec_id, round(p, 6) AS p FROM pred JOIN modes USING (body) JOIN conf ON conf.ground_truth = group_pred AND conf.pred1 = pred.pred1", NT, PRED, MODES, TRUTH, CONF)(
    lambda w: (lambda p, m: p.join(nt.mode(p, "body"), "body").join(m.withColumnRenamed("ground_truth", "group_pred"), ["group_pred", "pred1"]).select("vec_id", scalars.rounded(F.col("p"), 6).alias("p")))(_pred(w), _matrix(w, _pred(w)))
)
simple("p22_rescale", "SELECT vec_id, trunc(scores[1]::DOUBLE * 1000)::INT AS scaled FROM nt", NT)(lambda w: w.nt.select("vec_id", scalars.rescaled(F.col(TRANSMITTERS[0]), 1000).alias("scaled")))

# Windows and order

simple("w01_first_per_group", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")(lambda w: rows.greatest_of(w.table("orders"), "o_custkey", "o_orderkey", "o_totalprice"))
simple("w02_first_by_zyx", "SELECT body, z, y, x FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY z, y, x) AS r FROM elm) WHERE r = 1", ELM)(lambda w: annotations.first_per_body(w.elements.select("body", "z", "y", "x").distinct()).select("body", "z", "y", "x"))
BEST = "ORDER BY status_rank DESC, synweight DESC, pre DESC, post DESC, body"
CURVE = f"""rk AS (SELECT s.*, status_rank, row_number() OVER ({BEST.replace('body', 's.body')}) AS rnk FROM body_stats s JOIN ann USING (body)),
 cn AS (SELECT greatest(a.rnk, b.rnk) AS rnk, count(*) AS conn FROM syn JOIN rk a ON a.body = body_pre JOIN rk b ON b.body = body_post GROUP BY 1),
 curve AS (SELECT rk.rnk, body, status_rank, sum(pre) OVER w / (SELECT count(*) FROM points WHERE kind='PreSyn') AS traced_presyn_frac, sum(post) OVER w / (SELECT count(*) FROM syn) AS traced_postsyn_frac,
 sum(synweight) OVER w / (2 * (SELECT count(*) FROM syn)) AS traced_synweight_frac, sum(coalesce(conn, 0)) OVER w / (SELECT count(*) FROM syn) AS traced_conn_frac FROM rk LEFT JOIN cn USING (rnk) WINDOW w AS (ORDER BY rk.rnk ROWS UNBOUNDED PRECEDING))"""
FRACS = ["traced_presyn_frac", "traced_postsyn_frac", "traced_synweight_frac", "traced_conn_frac"]
_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in FRACS)
WORLD = (SYN, POINTS, ANN, STATS, CURVE)


def _curve(w, stop=None):
    return reports.completeness(*w.both, w.ann, stop)


simple("x01_completeness", f"SELECT rnk::BIGINT AS rnk, body, status_rank, {_ROUNDED} FROM curve", *WORLD)(lambda w: _curve(w).select(F.col("rnk").cast("long").alias("rnk"), "body", "status_rank", *map(ROUND, FRACS)))
simple("x02_ranked_stats", "SELECT body, row_number() OVER (ORDER BY synweight DESC, pre DESC, post DESC, body) AS rank, synweight FROM body_stats", SYN, POINTS, STATS)(lambda w: stats.ranked(stats.body_stats(*w.both), w.ann).select("body", F.col("rank").cast("long").alias("rank"), "synweight"))
simple("w03_last_per_status", f"SELECT status_rank, {_ROUNDED} FROM curve c WHERE rnk = (SELECT max(rnk) FROM curve d WHERE d.status_rank = c.status_rank)", *WORLD)(lambda w: reports.by_status(_curve(w)).select("status_rank", *map(ROUND, FRACS)))
ST = "st AS (SELECT p_brand AS name, (p_partkey * 7 % 30)::INT AS status_rank, max(p_size)::DOUBLE AS v FROM part GROUP BY 1, 2)"
FILL = "fill AS (SELECT n.name, s.status_rank, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY n.name ORDER BY s.status_rank DESC ROWS UNBOUNDED PRECEDING), 0) AS v FROM (SELECT DISTINCT name FROM st) n, (SELECT DISTINCT status_rank FROM st) s LEFT JOIN st ON st.name = n.name AND st.status_rank = s.status_rank)"


def _st(w):
    return w.table("part").groupBy(F.col("p_brand").alias("name"), (F.col("p_partkey") * 7 % 30).cast("int").alias("status_rank")).agg(F.max("p_size").cast("double").alias("v"))


simple("w04_fill_statuses", "SELECT * FROM fill", ST, FILL)(lambda w: reports.filled(_st(w), "name", "v"))
simple("w05_decumulate", "SELECT name, status_rank, v - lag(v, 1, 0) OVER (PARTITION BY name ORDER BY status_rank DESC) AS v FROM fill", ST, FILL)(lambda w: reports.steps(reports.filled(_st(w), "name", "v"), "name", "v"))
simple("w06_batches", "SELECT body_pre, body_post, (dense_rank() OVER (ORDER BY body_pre) - 1) // 40 AS batch FROM (SELECT DISTINCT body_pre, body_post FROM syn)", SYN)(lambda w: graph.batches(w.syn.select("body_pre", "body_post").distinct(), "body_pre", 40))
simple("w07_group_sizes", "SELECT body, rois, count(*) OVER (PARTITION BY rois) AS roiset_size FROM (SELECT body, coalesce(string_agg(roi, ',' ORDER BY roi) FILTER (roi <> '<unspecified>'), '') AS rois FROM regional WHERE roi IN ('ASIA', 'AFRICA', 'NATION_1', 'NATION_2') OR roi = '<unspecified>' GROUP BY body)", SYN, POINTS, LONG)(
    lambda w: rows.with_group_size(stats.region_names(stats.body_region_stats(*w.both, ROISETS).where("roi IN ('ASIA', 'AFRICA', 'NATION_1', 'NATION_2', '<unspecified>')")), "rois", "roiset_size")
)
simple("w08_stop_at_rank", "SELECT rnk::BIGINT AS rnk, body FROM rk WHERE rnk <= 25", *WORLD)(lambda w: _curve(w, 25).select(F.col("rnk").cast("long").alias("rnk"), "body"))
simple("w09_bar_edges", "SELECT n_name, n_regionkey, (sum(n_regionkey + 1) OVER (ORDER BY n_nationkey ROWS UNBOUNDED PRECEDING))::BIGINT AS edge FROM nation")(lambda w: plotdata.bar_edges(w.table("nation").withColumn("width", F.col("n_regionkey") + 1), "n_nationkey", "width").select("n_name", "n_regionkey", "edge"))
simple("w10_first_non_null", "SELECT p_partkey, coalesce(CASE WHEN p_size > 30 THEN p_type END, CASE WHEN p_size > 10 THEN p_brand END, p_name) AS name FROM part")(lambda w: annotations.coalesced(w.table("part").select("p_partkey", F.when(F.col("p_size") > 30, F.col("p_type")).alias("a"), F.when(F.col("p_size") > 10, F.col("p_brand")).alias("b"), F.col("p_name").alias("c")), "name", ["a", "b", "c"]).select("p_partkey", "name"))
simple("o01_sorted", "SELECT body, status_rank FROM ann ORDER BY status_rank DESC, body", ANN)(lambda w: rows.in_order(w.ann.select("body", "status_rank"), ["status_rank"], "body"))
simple("o02_top_k", "SELECT body, synweight FROM body_stats ORDER BY synweight DESC, body LIMIT 20", SYN, POINTS, STATS)(lambda w: rows.first_of(stats.body_stats(*w.both).select("body", "synweight"), ["synweight"], "body", 20))
simple("o03_union_all", "SELECT body, type, status_rank FROM ann UNION ALL SELECT body, NULL, NULL FROM (SELECT DISTINCT body FROM elm)", ANN, ELM)(lambda w: stats.union_all(w.ann, w.elements.select("body").distinct()))
simple("o04_union_distinct", "SELECT pre_id AS point_id FROM syn UNION SELECT post_id FROM syn", SYN)(lambda w: synapses.ends_of(w.syn))
simple("o05_difference", "SELECT body FROM ann WHERE body NOT IN (SELECT body_pre FROM syn)", SYN, ANN)(lambda w: rows.without_key(w.ann.select("body"), w.syn.withColumnRenamed("body_pre", "body"), "body"))
simple("o06_distinct", "SELECT DISTINCT pre_id, body_post FROM syn", SYN)(lambda w: rows.once_each(w.syn, "pre_id", "body_post"))

# Scalars

simple("p01_encode_decode", f"SELECT DISTINCT z, y, x, (z::BIGINT << 42) | (y << 21) | x AS point_id FROM elm", ELM)(
    lambda w: w.elements.select(scalars.encode_point(F.col("z"), F.col("y"), F.col("x")).alias("point_id")).distinct().select("point_id", *(c.cast("int" if n == "z" else "long").alias(n) for n, c in scalars.decode_point(F.col("point_id")).items()))
)
simple("p02_fill_compartment", "SELECT point_id, coalesce(nullif(compartment, 'linker'), 'unknown') AS compartment FROM points", SYN, POINTS)(lambda w: w.both[0].select("point_id", scalars.fill_compartment(F.nullif("compartment", F.lit("linker"))).alias("compartment")))
simple("p03_roi_labels", "SELECT point_id, p.primary_roi, primary_roi_label FROM points p JOIN (SELECT primary_roi, (row_number() OVER (ORDER BY primary_roi <> '<unspecified>', primary_roi) - 1)::INT AS primary_roi_label FROM (SELECT DISTINCT primary_roi FROM points)) l ON p.primary_roi = l.primary_roi", SYN, POINTS)(lambda w: rois.with_labels(w.both[0].select("point_id", "primary_roi"), "primary_roi"))
simple("p04_template", "SELECT p_partkey, 'ME_R_col_' || p_partkey // 100 || '_' || p_partkey % 100 AS name FROM part")(lambda w: w.table("part").select("p_partkey", scalars.label_template("ME_R_col_{x // 100}_{x % 100}", F.col("p_partkey")).alias("name")))
simple("p05_unions", "SELECT post_id, CASE WHEN primary_roi IN ('NATION_1','NATION_2') THEN 'U1' WHEN primary_roi = 'NATION_3' THEN 'U2' ELSE '<unspecified>' END AS big FROM syn", SYN)(lambda w: rois.union_of(w.syn, "primary_roi", {"U1": ["NATION_1", "NATION_2"], "U2": ["NATION_3"]}, "big").select("post_id", "big"))
simple("p06_rename", "SELECT post_id, CASE shell_roi WHEN 'ASIA' THEN 'Asia(L)' ELSE shell_roi END AS shell_roi FROM syn", SYN)(lambda w: rois.renamed(w.syn, "shell_roi", {"ASIA": "Asia(L)"}).select("post_id", "shell_roi"))
simple("p07_parent_rois", "SELECT CASE WHEN primary_roi = '<unspecified>' AND s IN ('ASIA', 'AFRICA(R)') THEN CASE WHEN s LIKE '%(R)' THEN left(s, -3) || '-unspecified(R)' ELSE s || '-unspecified' END ELSE primary_roi END AS primary_roi, count(*) AS n FROM (SELECT primary_roi, CASE shell_roi WHEN 'AFRICA' THEN 'AFRICA(R)' ELSE shell_roi END AS s FROM syn) GROUP BY 1", SYN)(
    lambda w: rois.with_parents(rois.renamed(w.syn, "shell_roi", {"AFRICA": "AFRICA(R)"}), {"primary_roi": ("shell_roi", ["ASIA", "AFRICA(R)"])}).groupBy("primary_roi").agg(F.count("*").alias("n"))
)
simple("p08_replace", "SELECT body, CASE type WHEN 'ECONOMY' THEN 'E' ELSE type END AS kind FROM ann", ANN)(lambda w: annotations.replaced(w.ann, {"type": {"ECONOMY": "E"}}, {"type": "kind"}, ("status_rank",)))
simple("p09_numeric", "SELECT c_custkey, try_cast(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE c_custkey::VARCHAR END AS BIGINT) AS v FROM customer")(lambda w: w.table("customer").select("c_custkey", annotations.numeric(F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).otherwise(F.col("c_custkey").cast("string")), "bigint").alias("v")))
_LABEL = "list_extract([" + ",".join(f"'{s}'" for s in STATUSES) + "], status_rank + 1)"
_SIMPLE = "list_extract([" + ",".join(f"'{SIMPLE_STATUS[s]}'" for s in STATUSES) + "], status_rank + 1)"
simple("p11_simple_status", f"SELECT body, {_LABEL} AS label, nullif({_SIMPLE}, '') AS status FROM ann", ANN)(lambda w: (lambda x: x.select("body", "label", scalars.simple_status(F.col("label")).alias("status")))(w.ann.select("body", F.element_at(F.array(*map(F.lit, STATUSES)), F.col("status_rank") + 1).alias("label"))))
simple("p12_points", "SELECT DISTINCT body, z, y, x, CASE body % 5 WHEN 4 THEN NULL ELSE [x, y, z]::DOUBLE[] END::VARCHAR AS point FROM elm", ELM)(
    lambda w: (lambda x, y, z: w.elements.select("body", "z", "y", "x", F.when(F.col("body") % 5 == 0, F.concat_ws(", ", x, y, z)).when(F.col("body") % 5 == 1, F.concat(F.lit("["), F.concat_ws(", ", x, y, z), F.lit("]"))).when(F.col("body") % 5 == 2, F.concat(F.lit("{x: "), x, F.lit(", y: "), y, F.lit(", z: "), z, F.lit("}"))).when(F.col("body") % 5 == 3, F.concat(F.lit('{"coordinates": ['), F.concat_ws(", ", x, y, z), F.lit("]}"))).otherwise(F.lit("nowhere")).alias("s")).distinct().select("body", "z", "y", "x", F.when(scalars.parse_point(F.col("s")).isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(scalars.parse_point(F.col("s")), lambda v: v.cast("string")), ", "), F.lit("]"))).alias("point")))(F.col("x").cast("string"), F.col("y").cast("string"), F.col("z").cast("string"))
)
simple("p14_int_columns", "SELECT p_partkey, try_cast(p_brand AS INT) AS brand, try_cast(replace(p_brand, 'Brand#', '') AS INT) AS number FROM part")(lambda w: w.table("part").select("p_partkey", annotations.numeric(F.col("p_brand"), "int").alias("brand"), annotations.numeric(F.replace("p_brand", F.lit("Brand#"), F.lit("")), "int").alias("number")))
simple("p15_neuron_label", "SELECT body, (coalesce(synweight >= 400, FALSE) OR coalesce(pre >= 130, FALSE) OR type IS NOT NULL OR coalesce(status IN ('Traced'), FALSE)) AND NOT coalesce(status IN ('Orphan'), FALSE) AS is_neuron FROM (SELECT s.*, type, nullif(" + _SIMPLE + ", '') AS status FROM body_stats s LEFT JOIN ann USING (body))", SYN, POINTS, ANN, STATS)(
    lambda w: stats.body_stats(*w.both).join(w.ann.withColumn("status", scalars.simple_status(F.element_at(F.array(*map(F.lit, STATUSES)), F.col("status_rank") + 1))), "body", "left").select("body", graph.is_neuron({"synweight": 400, "pre": 130}, ["type"], ["Traced"], ["Orphan"]).alias("is_neuron"))
)
simple("p16_roi_flags", "SELECT body, bool_or(roi = 'ASIA') OR NULL AS \"ASIA\", bool_or(roi = 'AFRICA') OR NULL AS \"AFRICA\" FROM regional GROUP BY body", SYN, POINTS, LONG)(lambda w: stats.flags(stats.body_region_stats(*w.both, ROISETS), ["ASIA", "AFRICA"]))
simple("p17_label_property", "SELECT p_partkey, CASE WHEN p_partkey <> 0 THEN p_partkey // 100 END AS col FROM part")(lambda w: w.table("part").select("p_partkey", scalars.label_formula("x // 100", F.col("p_partkey")).alias("col")))
simple("p18_element_set_ids", "SELECT DISTINCT body || '_' || type AS id FROM elm", ELM)(lambda w: graph.element_sets(w.elements.withColumn("point_id", F.lit(0)), w.ann)[0].select("id"))
simple("p19_location", "SELECT z, y, x, '{x:' || x || ', y:' || y || ', z:' || z || '}' AS location FROM elm", ELM)(lambda w: w.elements.select("z", "y", "x", scalars.point_string(F.col("x"), F.col("y"), F.col("z")).alias("location")))
simple("p20_booleans", "SELECT body, CASE WHEN status_rank >= 15 THEN 'true' WHEN status_rank < 15 THEN 'false' END AS significant FROM ann", ANN)(lambda w: w.ann.select("body", scalars.lower_boolean(F.col("status_rank") >= 15).alias("significant")))
simple("p21_integral", "SELECT p_partkey, CASE WHEN p_retailprice % 1 = 0 THEN p_retailprice::BIGINT END AS price FROM part")(lambda w: w.table("part").select("p_partkey", scalars.integral(F.col("p_retailprice")).alias("price")))
simple("p28_sides", "SELECT name, CASE WHEN name LIKE '%(L)' OR name LIKE '%(R)' THEN left(name, -3) ELSE name END AS base, CASE WHEN name LIKE '%(L)' THEN 'L' WHEN name LIKE '%(R)' THEN 'R' ELSE 'C' END AS side FROM sides", SIDES)(lambda w: _sides(w).select("name", scalars.side_of(F.col("name"))[0].alias("base"), scalars.side_of(F.col("name"))[1].alias("side")))
simple("p29_local_time", "SELECT o_orderkey, to_timestamp(o_orderkey * 86400) AT TIME ZONE 'America/New_York' AS t FROM orders")(lambda w: w.table("orders").select("o_orderkey", scalars.local_time(F.col("o_orderkey") * 86400, "America/New_York").alias("t")))

# Composites

SURE = """sure AS (SELECT * FROM syn WHERE conf_post >= 4),
 sure_rows AS (SELECT body, 'primary_roi' AS roiset, primary_roi AS roi, CASE WHEN kind='PreSyn' THEN 0 ELSE 1 END AS tag FROM points UNION ALL SELECT body, 'shell_roi', shell_roi, CASE WHEN kind='PreSyn' THEN 0 ELSE 1 END FROM points
 UNION ALL SELECT body_pre, 'primary_roi', primary_roi, 2 FROM sure UNION ALL SELECT body_pre, 'shell_roi', shell_roi, 2 FROM sure),
 sure_regional AS (SELECT body, roi, count(*) FILTER (tag=0) AS pre, count(*) FILTER (tag=1) AS post, count(*) FILTER (tag=2) AS downstream, count(*) FILTER (tag=1) AS upstream, count(*) FILTER (tag>0) AS synweight FROM sure_rows WHERE roi <> '<unspecified>' OR roiset = 'primary_roi' GROUP BY body, roi),
 sure_info AS (SELECT body, '{' || coalesce(string_agg('"' || roi || '":{' || substr(x, 2) || '}', ',' ORDER BY roi) FILTER (roi <> '<unspecified>'), '') || '}' AS "roiInfo", coalesce(string_agg(roi, ',' ORDER BY roi) FILTER (roi <> '<unspecified>'), '') AS rois FROM (SELECT body, roi, """ + _COUNTS + """ AS x FROM sure_regional) GROUP BY body),
 sure_stats AS (SELECT body, sum(pre)::BIGINT AS pre, sum(post)::BIGINT AS post, sum(down)::BIGINT AS downstream, sum(post)::BIGINT AS upstream, (sum(post)+sum(down))::BIGINT AS synweight FROM (SELECT body, (kind='PreSyn')::INT AS pre, (kind='PostSyn')::INT AS post, 0 AS down FROM points UNION ALL SELECT body_pre, 0, 0, 1 FROM sure) GROUP BY body),
 counted AS (SELECT body, count(*) AS total, count(*) FILTER (type='O') AS "O", count(*) FILTER (type='F') AS "F" FROM elm GROUP BY body),
 sized AS (SELECT o_custkey * 100003 AS body, count(*) AS size FROM orders GROUP BY 1)"""
FLAGS = ["ASIA", "EUROPE", "NATION_1"]
_FLAGS = ", ".join(f"CASE WHEN list_contains(string_split(rois, ','), '{r}') THEN TRUE END AS \"{r}\"" for r in FLAGS)


def _segments(w, **more):
    ann = w.ann.withColumn("status", scalars.simple_status(F.element_at(F.array(*map(F.lit, STATUSES)), F.col("status_rank") + 1)))
    sizes = w.table("orders").groupBy((F.col("o_custkey") * 100003).alias("body")).agg(F.count("*").alias("size"))
    return graph.segments(*w.both, ann, ROISETS, 4, {"synweight": 100}, ["Glia"], FLAGS, w.elements, ["O", "F"], sizes, **more)


_SEGMENT = f"""SELECT body, coalesce(s.pre, 0) AS pre, coalesce(s.post, 0) AS post, coalesce(s.downstream, 0) AS downstream, coalesce(s.upstream, 0) AS upstream, coalesce(s.synweight, 0) AS synweight, coalesce(total, 0) AS total, coalesce("O", 0) AS "O", coalesce("F", 0) AS "F", "roiInfo", rois, type, status_rank, nullif(status, '') AS status, size, {_FLAGS},
 CASE WHEN (coalesce(s.synweight, 0) >= 100 OR type IS NOT NULL) AND NOT coalesce(status = 'Glia', FALSE) THEN 'Segment;Neuron' ELSE 'Segment' END AS label
 FROM {{}} LEFT JOIN counted USING (body) LEFT JOIN sure_info USING (body) LEFT JOIN (SELECT *, """ + _SIMPLE + """ AS status FROM ann) a USING (body) LEFT JOIN sized USING (body)"""
simple("g01_segments", _SEGMENT.format("sure_stats s"), SYN, POINTS, ANN, ELM, SURE)(_segments)
simple("g01_segments_annotated", _SEGMENT.format("(SELECT coalesce(x.body, y.body) AS body, x.* EXCLUDE (body) FROM sure_stats x FULL JOIN (SELECT DISTINCT body FROM ann) y ON x.body = y.body) s"), SYN, POINTS, ANN, ELM, SURE)(lambda w: _segments(w, annotated=True))
simple(
    "g01_exported",
    f"""SELECT body, body AS "bodyId", pre, post, downstream, upstream, synweight, type AS "cellType", status_rank AS "statusRank", status, CASE label WHEN 'Segment' THEN 'Segment;demo_Segment' ELSE 'Segment;demo_Segment;Neuron;demo_Neuron' END AS label FROM ({_SEGMENT.format("sure_stats s")})""",
    SYN, POINTS, ANN, ELM, SURE,
)(lambda w: graph.exported(_segments(w).select("body", *stats.COUNTS, "type", "status_rank", "status", "rois", "label"), "demo", {"type": "cellType", "rois": ""}))
simple("p13_typed_headers", """SELECT unnest(['o_orderkey:' || CASE WHEN max(abs(o_orderkey)) < 2147483648 THEN 'int' ELSE 'long' END, 'big:' || CASE WHEN max(abs(o_custkey)) * 100003 * 1000 < 2147483648 THEN 'int' ELSE 'long' END, 'o_totalprice:float', ':LABEL', 'o_orderpriority:string', 'tags:string[]']) AS header FROM orders""")(
    lambda w: w.spark.createDataFrame([(h,) for h in graph.typed_names(w.table("orders").select("o_orderkey", (F.col("o_custkey") * 100003000).alias("big"), "o_totalprice", F.col("o_orderstatus").alias("label"), "o_orderpriority", F.array("o_clerk").alias("tags") if "o_clerk" in w.table("orders").columns else F.array("o_orderpriority").alias("tags")), {"label": ":LABEL"}, measured=True).values()], "header string")
)
simple("g02_connects_to", f"SELECT body_pre, body_post, count(*) AS \"weightHR\", count(*) FILTER (conf_post >= 5) AS weight, count(*) FILTER (conf_post >= 8) AS \"weightHP\", {COMP} FROM syn WHERE body_pre <> 0 AND body_post <> 0 GROUP BY 1, 2", SYN)(lambda w: graph.connects_to(w.syn, 5, 8))
simple("g02_connects_to_regions", f"""SELECT w.*, i."roiInfo" FROM (SELECT body_pre, body_post, count(*) AS "weightHR", count(*) FILTER (conf_post >= 5) AS weight, count(*) FILTER (conf_post >= 8) AS "weightHP", {COMP} FROM syn WHERE body_pre <> 0 AND body_post <> 0 GROUP BY 1, 2) w JOIN (SELECT body_pre, body_post, '{{' || coalesce(string_agg('"' || roi || '":{{"post":' || n || '}}', ',' ORDER BY roi) FILTER (roi <> '<unspecified>' AND n > 0), '') || '}}' AS "roiInfo" FROM (SELECT body_pre, body_post, roi, count(*) FILTER (conf_post >= 5) AS n FROM (SELECT body_pre, body_post, conf_post, 'primary_roi' AS roiset, primary_roi AS roi FROM syn UNION ALL SELECT body_pre, body_post, conf_post, 'shell_roi', shell_roi FROM syn) WHERE roi <> '<unspecified>' OR roiset = 'primary_roi' GROUP BY 1, 2, 3) GROUP BY 1, 2) i USING (body_pre, body_post)""", SYN)(lambda w: graph.connects_to(w.syn, 5, 8, ROISETS))
simple("g03_synapse_sets", "SELECT DISTINCT body_pre || '_' || body_post || u AS id FROM syn, (VALUES ('_pre'), ('_post')) t(u)", SYN)(lambda w: graph.synapse_sets(connectome.weighted(w.syn)))
simple("g03_set_to_set", "SELECT DISTINCT body_pre || '_' || body_post || '_pre' AS start_id, body_pre || '_' || body_post || '_post' AS end_id FROM syn", SYN)(lambda w: graph.set_to_set(connectome.weighted(w.syn)))
simple("g03_neuron_to_set", "SELECT DISTINCT body_pre AS body, body_pre || '_' || body_post || '_pre' AS id FROM syn UNION ALL SELECT DISTINCT body_post, body_pre || '_' || body_post || '_post' FROM syn", SYN)(lambda w: graph.neuron_to_set(connectome.weighted(w.syn)))
simple("g03_set_to_synapse", "SELECT DISTINCT body_pre || '_' || body_post || '_pre' AS id, pre_id AS point_id FROM syn UNION ALL SELECT body_pre || '_' || body_post || '_post', post_id FROM syn", SYN)(lambda w: graph.set_to_synapse(w.syn))
_XYZ = "'{x:' || x || ', y:' || y || ', z:' || z || '}' AS location"
simple("g04_synapses", f"SELECT point_id, CASE kind WHEN 'PreSyn' THEN 'pre' ELSE 'post' END AS type, 'Synapse' AS label, conf AS confidence, body AS \"bodyId\", {_XYZ}, primary_roi, shell_roi, CASE WHEN shell_roi = 'ASIA' THEN TRUE END AS \"ASIA\", CASE WHEN primary_roi = 'NATION_1' THEN TRUE END AS \"NATION_1\" FROM (SELECT *, point_id >> 42 AS z, (point_id >> 21) & 2097151 AS y, point_id & 2097151 AS x FROM points)", SYN, POINTS)(lambda w: graph.synapses(w.both[0], ROISETS, ["ASIA", "NATION_1"]))
simple("g05_elements", f"SELECT (z::BIGINT << 42) | (y << 21) | x AS point_id, type, {_XYZ}, roi, CASE WHEN roi = 'R7' THEN TRUE END AS \"R7\" FROM elm", ELM)(lambda w: graph.elements(w.elements.withColumn("point_id", scalars.encode_point(F.col("z"), F.col("y"), F.col("x"))), ["roi"], ["R7"]))


def _close(w):
    e = w.elements.withColumn("point_id", scalars.encode_point(F.col("z"), F.col("y"), F.col("x")))
    return graph.close_to(e.groupBy("body").agg(F.min("point_id").alias("source_id"), F.max("point_id").alias("target_id"))).withColumn("distance", scalars.rounded(F.col("distance"), 4))


simple("g05_close_to", "SELECT a AS source_id, b AS target_id, round(sqrt(((a >> 42) - (b >> 42))::DOUBLE ** 2 + (((a >> 21) & 2097151) - ((b >> 21) & 2097151))::DOUBLE ** 2 + ((a & 2097151) - (b & 2097151))::DOUBLE ** 2), 4) AS distance FROM (SELECT min((z::BIGINT << 42) | (y << 21) | x) AS a, max((z::BIGINT << 42) | (y << 21) | x) AS b FROM elm GROUP BY body)", ELM)(_close)
simple("g06_element_sets", "SELECT DISTINCT body, body || '_' || type AS id FROM elm WHERE body IN (SELECT body FROM ann WHERE status_rank > 10)", ELM, ANN)(lambda w: graph.element_sets(w.elements.withColumn("point_id", F.lit(0)), w.ann.where("status_rank > 10"))[1])
_TREE = {"ALL": {"ASIA": None, "AFRICA": None}}


def _meta(w):
    r = stats.body_region_stats(*w.both, ROISETS)
    shown = [{"id": "bodyId", "choices": None}, {"id": "type", "name": "cell type", "choices": None}]
    return graph.meta(stats.dataset_totals(r), stats.region_totals(r), "demo", "v1", _TREE, ["ASIA", "AFRICA"], {"bodyId": "long"}, shown, ["AFRICA"], ["AFRICA"], {"ASIA": "the east"}, postHighAccuracyThreshold=0.5, voxelSize=[4, 4, 4])


_META = {"hideDataSet": "false", "voxelSize": "'4;4;4'", "voxelUnits": "'nanometers'", "info": "''", "logo": "''", "description": "''", "meshHost": "''", "postHighAccuracyThreshold": "0.5::DOUBLE", "preHPThreshold": "0::DOUBLE", "postHPThreshold": "0::DOUBLE", "nonHierarchicalROIs": "''", "overviewRois": "''", "overviewOrder": "'clustered'", "neuronColumnsVisible": """'["bodyId", "type", "status"]'""", "uuid": "'unknown'", "latestMutationId": "0", "lastDatabaseEdit": "'unknown'", "dataset": "'demo'", "tag": "'v1'", "primaryRois": "'AFRICA;ASIA'", "superLevelRois": "'AFRICA;ASIA'", "neuronProperties": """'{"bodyId": "long"}'""",
         "roiHierarchy": """'{"name": "ALL", "children": [{"name": "ASIA"}, {"name": "AFRICA"}]}'""", "neuronColumnsOrdered": """'[{"id": "bodyId", "choices": null, "visible": true, "name": "bodyId"}, {"id": "type", "name": "cell type", "choices": null, "visible": true}]'"""}
simple("g07_meta", f"""SELECT {", ".join(f'{v} AS "{k}"' for k, v in _META.items())}, (SELECT sum(pre)::BIGINT FROM regional) AS "totalPreCount", (SELECT sum(post)::BIGINT FROM regional) AS "totalPostCount", (SELECT '{{' || string_agg('"' || roi || '":{{"description":"' || CASE roi WHEN 'ASIA' THEN 'the east' ELSE '' END || '","excludeFromOverview":' || (roi = 'AFRICA') || ',"isNerve":' || (roi = 'AFRICA') || ',"isPrimary":' || (roi IN ('ASIA', 'AFRICA')) || CASE WHEN roi IN ('ASIA', 'AFRICA') THEN ',"parent":"ALL"' ELSE '' END || ',"post":' || post || ',"pre":' || pre || '}}', ',' ORDER BY roi) || '}}' FROM (SELECT roi, sum(pre)::BIGINT AS pre, sum(post)::BIGINT AS post FROM regional WHERE roi <> '<unspecified>' GROUP BY roi)) AS "roiInfo" """, SYN, POINTS, LONG)(_meta)


def _copy(w):
    c = w.table("customer")
    return c.select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), F.when(F.col("c_custkey") % 10 == 0, F.col("c_acctbal") + 5).otherwise(F.col("c_acctbal") * (1 + 1e-9)).alias("c_acctbal"), "c_nationkey").where("c_custkey % 13 <> 0")


COPY = "old AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 5 ELSE c_acctbal * (1 + 1e-9) END AS c_acctbal, c_nationkey FROM customer WHERE c_custkey % 13 <> 0)"
MASK = "mask AS (SELECT c_custkey, n.c_mktsegment IS DISTINCT FROM o.c_mktsegment AS c_mktsegment, NOT coalesce(abs(n.c_acctbal - o.c_acctbal) <= 1e-8 + 1e-5 * abs(o.c_acctbal), n.c_acctbal IS NULL AND o.c_acctbal IS NULL) AS c_acctbal, n.c_nationkey IS DISTINCT FROM o.c_nationkey AS c_nationkey FROM customer n JOIN old o USING (c_custkey))"
simple("d01_change_mask", "SELECT * FROM mask WHERE c_mktsegment OR c_acctbal OR c_nationkey", COPY, MASK)(lambda w: diff.change_mask(w.table("customer"), _copy(w), "c_custkey"))
simple("d02_comparable_rows", "SELECT c_custkey FROM customer JOIN old USING (c_custkey)", COPY)(lambda w: w.table("customer").join(_copy(w), "c_custkey").select("c_custkey"))
simple("d03_changed_cells", "SELECT c_custkey, 'c_mktsegment' AS \"column\", o.c_mktsegment AS old, n.c_mktsegment AS new FROM customer n JOIN old o USING (c_custkey) WHERE n.c_mktsegment IS DISTINCT FROM o.c_mktsegment", COPY)(lambda w: diff.changed_cells(w.table("customer"), _copy(w), "c_custkey", ("c_acctbal",)))
simple("p30_commands", "SELECT c_custkey, 'MATCH (n:`demo_Segment` {bodyId: ' || c_custkey || '}) SET n.`c_mktsegment` = ''' || n.c_mktsegment || '''' AS command FROM customer n JOIN old o USING (c_custkey) WHERE n.c_mktsegment IS DISTINCT FROM o.c_mktsegment", COPY)(lambda w: diff.commands(w.table("customer").drop("c_acctbal"), _copy(w).drop("c_acctbal"), "c_custkey", "demo"))
simple("b01_presence", "SELECT DISTINCT body, 'roi' AS roiset, roi, type AS element FROM elm WHERE roi <> '<unspecified>'", ELM)(lambda w: annotations.presence(w.elements.withColumnRenamed("type", "element"), ["roi"]))
REP = {"east": ["ASIA", "EUROPE"], "all": []}
simple("r01_report_flags", "SELECT report, captured_pre, captured_post, count(*) AS n FROM (SELECT 'east' AS report, * FROM cap WHERE shell_roi IN ('ASIA', 'EUROPE') UNION ALL SELECT 'all', * FROM cap WHERE shell_roi <> '<unspecified>') GROUP BY 1, 2, 3", SYN, ANN, CAP)(lambda w: reports.in_reports(reports.with_capture(w.syn, w.ann, 15), REP, "shell_roi").groupBy("report", "captured_pre", "captured_post").agg(F.count("*").alias("n")))
simple("r02_status_matrix", "SELECT name, max(d) FILTER (status_rank = 28) AS s28, max(d) FILTER (status_rank = 21) AS s21, max(d) FILTER (status_rank = 14) AS s14 FROM (SELECT name, status_rank, v - lag(v, 1, 0) OVER (PARTITION BY name ORDER BY status_rank DESC) AS d FROM fill) GROUP BY name", ST, FILL)(
    lambda w: reports.steps(reports.filled(_st(w), "name", "v"), "name", "v").groupBy("name").pivot("status_rank", [28, 21, 14]).agg(F.max("v")).select("name", *(F.col(str(k)).alias(f"s{k}") for k in (28, 21, 14)))
)


# Logs: events written as the lines of a request log


def _log(w):
    e = w.table("events")
    debug = F.when(F.col("event_id") % 3 == 0, F.lit("a\nb")).when(F.col("event_id") % 3 == 1, F.lit("c\\d")).otherwise(F.lit("x"))
    return e.select(F.concat(F.lit('{"uri": "/u'), F.col("user_id"), F.lit('", "status": 200, "time": '), F.unix_timestamp("ts"), F.lit(', "user": "'), F.col("user_id"), F.lit('", "debug": "'), debug, F.lit('"}')).alias("value"))


simple("log02_repair", "SELECT '/u' || user_id AS uri, floor(epoch(ts))::DOUBLE AS time, CASE event_id % 3 WHEN 0 THEN 'a' || chr(10) || 'b' WHEN 1 THEN 'c\\d' ELSE 'x' END AS debug FROM events")(lambda w: logs.parsed(_log(w)).select("uri", "time", "debug"))
simple("log04_last_request", "SELECT user_id::VARCHAR AS \"user\", max(floor(epoch(ts)))::DOUBLE AS time, count(*) AS requests FROM events GROUP BY 1")(lambda w: logs.last_per_user(logs.parsed(_log(w)).select("user", "time"), "user", ("time",)))

# Node files by region combination

GROUPED = """named AS (SELECT body, coalesce(string_agg(roi, ',' ORDER BY roi) FILTER (roi <> '<unspecified>'), '') AS rois FROM regional GROUP BY body),
 combos AS (SELECT rois, count(*) AS size FROM named GROUP BY 1),
 share0 AS (SELECT (sum(size)::BIGINT + {n} - 1) // {n} AS s0, sum(size)::BIGINT AS total FROM combos),
 alone AS (SELECT count(*) AS k, coalesce(sum(size), 0)::BIGINT AS big FROM combos, share0 WHERE size >= s0),
 share AS (SELECT greatest(1, (total - big + {n} - 1) // greatest(1, {n} - k)) AS s FROM share0, alone),
 dealt AS (SELECT rois, size, (sum(size) OVER (ORDER BY size DESC, rois DESC ROWS UNBOUNDED PRECEDING)::BIGINT - size) // s AS raw FROM combos, share),
 batched AS (SELECT rois, size, (dense_rank() OVER (ORDER BY raw) - 1)::INT AS batch FROM dealt)"""
FILES = 12


def _named(w):
    return stats.region_names(stats.body_region_stats(*w.both, ROISETS))


def _batched(w):
    x = shared.saved(_named(w), "named")  # grouped and joined
    return batches.with_batch(x, "rois", batches.of_groups(x, "rois", FILES))


simple("w07_batches", "SELECT body, rois, batch FROM named JOIN batched USING (rois)", SYN, POINTS, LONG, GROUPED.format(n=FILES))(lambda w: _batched(w).select("body", "rois", "batch"))
simple("w07_batch_sizes", "SELECT rois, size, batch FROM batched", SYN, POINTS, LONG, GROUPED.format(n=FILES))(lambda w: batches.of_groups(_named(w), "rois", FILES))
simple("w07_few_files", "SELECT rois, size, batch FROM batched", SYN, POINTS, LONG, GROUPED.format(n=2))(lambda w: batches.of_groups(_named(w), "rois", 2))
simple(
    "snk02_batch_regions",
    "SELECT batch, sum(size)::BIGINT AS rows, count(*) AS combinations, coalesce((SELECT string_agg(DISTINCT r, ';' ORDER BY r) FROM (SELECT batch AS b, unnest(string_split(rois, ',')) AS r FROM batched) WHERE b = batch AND r <> ''), '') AS regions FROM batched GROUP BY batch",
    SYN, POINTS, LONG, GROUPED.format(n=FILES),
)(lambda w: batches.regions(batches.of_groups(_named(w), "rois", FILES), "rois").withColumn("regions", F.array_join("regions", ";")))
simple(
    "snk02_batch_flags",
    "SELECT body, batch, array_to_string(list_transform(list_sort(list_distinct(flatten((SELECT list(string_split(rois, ',')) FROM batched b WHERE b.batch = x.batch)))), lambda r: CASE WHEN list_contains(string_split(x.rois, ','), r) THEN r || '=true' ELSE r || '=' END), ';') AS flags FROM named x0 JOIN batched x USING (rois)",
    SYN, POINTS, LONG, GROUPED.format(n=FILES),
)(lambda w: _flags(w))


def _flags(w):
    x = shared.saved(_named(w), "named")  # grouped and joined
    plan = batches.of_groups(x, "rois", FILES)
    y = batches.with_batch(x, "rois", plan).join(batches.regions(plan, "rois", unnamed=True), "batch")
    return y.select("body", "batch", F.array_join(F.zip_with("regions", batches.flags(F.col("rois"), F.col("regions")), lambda r, f: F.concat(r, F.lit("="), f)), ";").alias("flags"))


# All reports in one plan: pre points lie in regions by their number

RPOINTS = """rpoints AS (SELECT point_id, body, kind, CASE WHEN kind = 'PreSyn' THEN list_extract(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE'], (point_id // 64 % 4 + 1)::INT) ELSE shell_roi END AS roi FROM points),
 rsyn AS (SELECT *, shell_roi AS roi FROM syn)"""
SPEC = {"east": ["ASIA", "EUROPE"], "all": [], "south": ["AFRICA", "AMERICA", "ASIA"], "nowhere": ["ATLANTIS"]}
SUBSETS = {"whole": ["all", "east", "south", "nowhere"], "halves": ["south", "east"]}
PRESENT = "present AS (SELECT DISTINCT body, CASE roi WHEN 'R7' THEN 'ASIA' WHEN 'R8' THEN 'AFRICA' ELSE '<unspecified>' END AS roi FROM elm)"


def _in(table: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS report, * FROM {table} WHERE " + (f"roi IN ({', '.join(map(repr, rs))})" if rs else "roi <> '<unspecified>'") for n, rs in SPEC.items())


def _forecast_sql(more: str = "") -> str:
    return f"""rp AS ({_in("rpoints")}), rs AS ({_in("rsyn")}),
 rb AS (SELECT report, body, sum(pre)::BIGINT AS pre, sum(post)::BIGINT AS post, (sum(post) + sum(down))::BIGINT AS synweight, sum(down)::BIGINT AS down FROM (SELECT report, body, (kind = 'PreSyn')::INT AS pre, (kind = 'PostSyn')::INT AS post, 0 AS down FROM rp UNION ALL SELECT report, body_pre, 0, 0, 1 FROM rs {more}) GROUP BY 1, 2),
 rr AS (SELECT rb.*, status_rank, row_number() OVER (PARTITION BY report ORDER BY status_rank DESC NULLS LAST, synweight DESC, pre DESC, post DESC, rb.body) AS rnk FROM rb LEFT JOIN ann USING (body)),
 rc AS (SELECT rs.report, greatest(a.rnk, b.rnk) AS rnk, count(*) AS conn FROM rs JOIN rr a ON a.report = rs.report AND a.body = body_pre JOIN rr b ON b.report = rs.report AND b.body = body_post GROUP BY 1, 2),
 rt AS (SELECT report, sum(pre) AS t_pre, sum(post) AS t_post, sum(down) AS t_conn FROM rb GROUP BY 1),
 rcurve AS (SELECT report, rnk, body, status_rank, pre, post, synweight, coalesce(conn, 0) AS conn, sum(pre) OVER w / nullif(t_pre, 0) AS traced_presyn_frac, sum(post) OVER w / nullif(t_post, 0) AS traced_postsyn_frac, sum(synweight) OVER w / nullif(t_post + t_conn, 0) AS traced_synweight_frac, sum(coalesce(conn, 0)) OVER w / nullif(t_conn, 0) AS traced_conn_frac
  FROM rr LEFT JOIN rc USING (report, rnk) JOIN rt USING (report) WINDOW w AS (PARTITION BY report ORDER BY rnk ROWS UNBOUNDED PRECEDING))"""


RWORLD = (SYN, POINTS, ANN, RPOINTS)
RCOUNTS = "rcounts AS (SELECT report, count(*) FILTER (kind = 'PreSyn') AS \"PreSyn\", count(*) FILTER (kind = 'PostSyn') AS \"PostSyn\" FROM rp GROUP BY 1)"


def _region_world(w):
    p, s = w.both
    place = F.element_at(F.array(*map(F.lit, ("AFRICA", "AMERICA", "ASIA", "EUROPE"))), (F.floor(F.col("point_id") / 64) % 4 + 1).cast("int"))
    return p.select("point_id", "body", "kind", F.when(F.col("kind") == "PreSyn", place).otherwise(F.col("shell_roi")).alias("roi")), s.withColumn("roi", F.col("shell_roi"))


def _present(w):
    return w.elements.select("body", F.when(F.col("roi") == "R7", F.lit("ASIA")).when(F.col("roi") == "R8", F.lit("AFRICA")).otherwise(F.lit("<unspecified>")).alias("roi"))


def _forecast(w, mode="none", stop=None):
    return reports.forecast(*_region_world(w), w.ann, SPEC, "roi", mode, _present(w), stop)


_CURVE = f"SELECT report, rnk, body, status_rank, pre, post, synweight, conn, {_ROUNDED} FROM rcurve"
_curve_of = lambda x: x.select("report", F.col("rnk").cast("long").alias("rnk"), "body", "status_rank", "pre", "post", "synweight", "conn", *map(ROUND, FRACS))
simple("x01_reports", _CURVE, *RWORLD, _forecast_sql())(lambda w: _curve_of(_forecast(w)))
simple("x01_reports_presence", _CURVE, *RWORLD, ELM, PRESENT, _forecast_sql("UNION ALL SELECT report, body, 0, 0, 0 FROM (" + _in("present") + ") WHERE body IN (SELECT body FROM ann)"))(lambda w: _curve_of(_forecast(w, "element-presence")))
simple("x01_reports_all", _CURVE, *RWORLD, _forecast_sql("UNION ALL SELECT report, body, 0, 0, 0 FROM ann, (VALUES " + ", ".join(f"('{n}')" for n in SPEC) + ") v(report)"))(lambda w: _curve_of(_forecast(w, "all")))
simple("w08_reports_stop", "SELECT report, rnk, body FROM rr WHERE rnk <= 30", *RWORLD, _forecast_sql())(lambda w: _forecast(w, stop=30).select("report", F.col("rnk").cast("long").alias("rnk"), "body"))
simple("w03_reports_by_status", f"SELECT report, status_rank, {_ROUNDED} FROM rcurve c WHERE rnk = (SELECT max(rnk) FROM rcurve d WHERE d.report = c.report AND d.status_rank IS NOT DISTINCT FROM c.status_rank)", *RWORLD, _forecast_sql())(lambda w: reports.by_status(_forecast(w), "report").select("report", "status_rank", *map(ROUND, FRACS)))
_FAMILY = " UNION ALL ".join(f"SELECT report, '{f}' AS family, status_rank, coalesce({f}, 0) AS value FROM last" for f in FRACS)
_SUBSETS = ", ".join(f"('{n}', {k}, '{r}')" for n, rs in SUBSETS.items() for k, r in enumerate(rs))
simple(
    "r02_summaries",
    "SELECT subset, report_index, report, family, cumulative, status_rank, round(value, 6) AS value, \"PreSyn\", \"PostSyn\" FROM (SELECT *, TRUE AS cumulative FROM whole UNION ALL SELECT report, family, status_rank, value - lag(value, 1, 0) OVER (PARTITION BY report, family ORDER BY status_rank DESC), FALSE FROM whole) JOIN listed USING (report) LEFT JOIN rcounts USING (report)",
    *RWORLD, _forecast_sql(), RCOUNTS,
    "last AS (SELECT * FROM rcurve c WHERE status_rank > 9 AND rnk = (SELECT max(rnk) FROM rcurve d WHERE d.report = c.report AND d.status_rank = c.status_rank))",
    f"long AS ({_FAMILY})",
    "whole AS (SELECT k.report, k.family, s.status_rank, coalesce(last_value(value IGNORE NULLS) OVER (PARTITION BY k.report, k.family ORDER BY s.status_rank DESC ROWS UNBOUNDED PRECEDING), 0) AS value FROM (SELECT DISTINCT report, family FROM long) k, (SELECT DISTINCT status_rank FROM long) s LEFT JOIN long l ON l.report = k.report AND l.family = k.family AND l.status_rank = s.status_rank)",
    f"listed AS (SELECT * FROM (VALUES {_SUBSETS}) t(subset, report_index, report))",
)(lambda w: reports.summaries(_forecast(w), reports.syn_counts(reports.in_reports(_region_world(w)[0], SPEC), "report"), SUBSETS).withColumn("value", scalars.rounded(F.col("value"), 6)))
simple("a20_capture_by_report", "SELECT report, body_pre, count(*) FILTER (captured_post) AS captured, count(*) FILTER (NOT captured_post) AS not_captured, count(*) AS downstream, count(DISTINCT pre_id) AS presyn, round(count(*) FILTER (captured_post) / count(*), 6) AS capture_frac FROM (" + _in("(SELECT *, shell_roi AS roi FROM cap)") + ") WHERE captured_pre GROUP BY ALL", SYN, ANN, CAP)(
    lambda w: reports.downstream_capture(reports.in_reports(reports.with_capture(w.syn, w.ann, 15), SPEC, "shell_roi"), "report").withColumn("capture_frac", scalars.rounded(F.col("capture_frac"), 6))
)
simple("x06_decimated", "SELECT DISTINCT report, rnk, body, round(traced_conn_frac, 6) AS traced_conn_frac FROM rcurve c JOIN (SELECT report AS r, max(rnk) AS n FROM rcurve GROUP BY 1) ON r = report WHERE rnk = 1 OR rnk = n OR floor((rnk - 1) * 40 / greatest(n, 40)) <> floor(rnk * 40 / greatest(n, 40)) OR rnk IN (SELECT max(rnk) FROM rcurve d WHERE d.report = c.report GROUP BY status_rank)", *RWORLD, _forecast_sql())(
    lambda w: reports.decimated(_forecast(w), 40).select("report", F.col("rnk").cast("long").alias("rnk"), "body", ROUND("traced_conn_frac"))
)
