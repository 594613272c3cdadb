"""One query for each operator over the star-schema tables, and plain SQL with the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import scalars
from .functions.constants import NT_LIMITS, STATUSES
from .operators import annotations, connectome, diff, graph, logs, nt, plotdata, reports, rois, rows, stats, synapses
from .sources import adapter
from .sources.adapter import TRANSMITTERS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SYN = """syn AS (SELECT l.l_orderkey*64 AS pre_id,
 l.l_orderkey*64 + row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber,l.l_partkey,l.l_suppkey,l.l_shipdate,l.l_extendedprice,l.l_quantity) AS post_id,
 o.o_custkey * 100003 AS body_pre, l.l_partkey * 100003 AS body_post, CAST(ROUND(l.l_discount*100) AS INT) AS conf_post,
 CASE o.o_orderstatus WHEN 'F' THEN 'axon' WHEN 'O' THEN 'dendrite' ELSE 'unknown' END AS compartment_pre,
 CASE l.l_returnflag WHEN 'A' THEN 'axon' WHEN 'N' THEN 'dendrite' ELSE 'linker' END AS compartment_post,
 CASE WHEN n.n_nationkey % 5 = 0 THEN '<unspecified>' ELSE n.n_name END AS primary_roi,
 CASE WHEN r.r_regionkey = 4 THEN '<unspecified>' ELSE r.r_name END AS shell_roi
 FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN supplier s ON l.l_suppkey=s.s_suppkey
 JOIN nation n ON s.s_nationkey=n.n_nationkey JOIN region r ON n.n_regionkey=r.r_regionkey)"""
POINTS = """points AS (SELECT DISTINCT pre_id AS point_id, body_pre AS body, 'PreSyn' AS kind, 10 AS conf, compartment_pre AS compartment, '<unspecified>' AS primary_roi, '<unspecified>' AS shell_roi FROM syn
 UNION ALL SELECT post_id, body_post, 'PostSyn', conf_post, compartment_post, primary_roi, shell_roi FROM syn)"""
ANN = """ann AS (SELECT p_partkey * 100003 AS body, CAST((p_partkey*7) % 30 AS INT) AS status_rank, CASE WHEN p_size>45 THEN NULL ELSE p_type END AS type FROM part)"""
ELM = """elm AS (SELECT DISTINCT date_diff('day', DATE '1995-01-01', l_shipdate::DATE)::INT + 4000 AS z, l_partkey AS y, l_suppkey AS x, l_partkey * 100003 AS body, l_linestatus AS type,
 CASE WHEN s_nationkey % 5 = 0 THEN '<unspecified>' ELSE 'R' || s_nationkey END AS roi FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
NT = "nt AS (SELECT vec_id, vec_id // 8 * 100003 AS body, CASE WHEN (vec_id // 8) % 7 <> 0 THEN 'T' || (vec_id // 8) % 12 END AS cell_type, CASE WHEN vec_id % 97 = 0 THEN 'train' ELSE 'test' END AS split, embedding[1:7] AS scores FROM embeddings)"
NAMES = "[" + ",".join(f"'{n}'" for n in TRANSMITTERS) + "]"
PRED = f"pred AS (SELECT *, list_extract({NAMES}, list_position(scores, list_max(scores))) AS pred1 FROM nt)"
LONG = """region_rows AS (SELECT body, 'primary_roi' AS roiset, primary_roi AS roi, CASE WHEN kind='PreSyn' THEN 0 ELSE 1 END AS tag FROM points
 UNION ALL SELECT body, 'shell_roi', shell_roi, CASE WHEN kind='PreSyn' THEN 0 ELSE 1 END FROM points
 UNION ALL SELECT body_pre, 'primary_roi', primary_roi, 2 FROM syn UNION ALL SELECT body_pre, 'shell_roi', shell_roi, 2 FROM syn),
 regional AS (SELECT body, roi, count(*) FILTER (tag=0) AS pre, count(*) FILTER (tag=1) AS post, count(*) FILTER (tag=2) AS downstream, count(*) FILTER (tag=1) AS upstream, count(*) FILTER (tag>0) AS synweight
 FROM region_rows WHERE roi <> '<unspecified>' OR roiset = 'primary_roi' GROUP BY body, roi)"""
STATS = """body_stats AS (SELECT body, sum(pre)::BIGINT AS pre, sum(post)::BIGINT AS post, sum(down)::BIGINT AS downstream, sum(post)::BIGINT AS upstream, (sum(post)+sum(down))::BIGINT AS synweight FROM (
 SELECT body, (kind='PreSyn')::INT AS pre, (kind='PostSyn')::INT AS post, 0 AS down FROM points UNION ALL SELECT body_pre, 0, 0, 1 FROM syn) GROUP BY body)"""
ROISETS = ["primary_roi", "shell_roi"]


def query(name: str, sql: str | None, *ctes: str):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + sql
        return f

    return add


class World:
    """The domain tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    @property
    def syn(self) -> DataFrame:
        return adapter.partners(self.spark, self.dir)

    @property
    def both(self) -> tuple[DataFrame, DataFrame]:
        s = self.syn
        return adapter.points(s), s

    @property
    def ann(self) -> DataFrame:
        return adapter.annotations(self.spark, self.dir)

    def table(self, name: str) -> DataFrame:
        return adapter.read(self.spark, self.dir, name)

    @property
    def nt(self) -> DataFrame:
        return adapter.nt_points(self.spark, self.dir)

    @property
    def elements(self) -> DataFrame:
        return adapter.elements(self.spark, self.dir)


def of(f):
    """A query over the domain tables."""
    return lambda spark, sf_dir: f(World(spark, sf_dir))


def simple(name: str, sql: str, *ctes: str):
    return lambda f: query(name, sql, *ctes)(of(f))


# Filters and semi-joins

simple("f01_fake", "SELECT point_id, body, kind FROM (SELECT point_id, body, CASE WHEN body = 700021 THEN 'Fake' ELSE kind END AS kind FROM points) WHERE kind <> 'Fake'", SYN, POINTS)(
    lambda w: synapses.drop_fake(w.both[0].select("point_id", "body", F.when(F.col("body") == 700021, F.lit("Fake")).otherwise(F.col("kind")).alias("kind")), w.syn)[0]
)
simple("f01_fake_partners", "SELECT pre_id, post_id FROM syn WHERE pre_id <> 0 AND post_id <> 0", SYN)(lambda w: synapses.drop_fake(w.both[0], w.syn)[1].select("pre_id", "post_id"))
simple("f03_zone", "SELECT z, y, x FROM elm WHERE z < 5000", ELM)(
    lambda w: synapses.in_zone(w.elements.withColumn("point_id", scalars.encode_point(F.col("z"), F.col("y"), F.col("x"))), w.syn, "brain", 5000)[0].select("z", "y", "x")
)
simple("f04_confidence", "SELECT point_id, kind, conf FROM points WHERE conf >= 5", SYN, POINTS)(lambda w: synapses.confident(w.both[0], w.syn.withColumn("conf_pre", F.lit(10)), 5, "int")[0].select("point_id", "kind", "conf"))
simple("f04_confidence_partners", "SELECT pre_id, post_id, conf_post FROM syn WHERE conf_post >= 5", SYN)(lambda w: synapses.confident(w.both[0], w.syn.withColumn("conf_pre", F.lit(10)), 5, "int")[1].select("pre_id", "post_id", "conf_post"))
simple("f05_body0", "SELECT pre_id, post_id, body_pre, body_post FROM syn WHERE body_pre <> 0 AND body_post <> 0", SYN)(lambda w: synapses.drop_body_zero(*w.both)[1].select("pre_id", "post_id", "body_pre", "body_post"))
simple("f06_self_consistency", "SELECT point_id FROM points WHERE point_id IN (SELECT pre_id FROM good UNION ALL SELECT post_id FROM good)", SYN, POINTS, "good AS (SELECT * FROM syn WHERE compartment_pre <> 'unknown' AND compartment_post <> 'linker')")(
    lambda w: synapses.self_consistent(w.both[0].where("compartment NOT IN ('unknown', 'linker')"), w.syn)[0].select("point_id")
)
simple("f07_restrict_roi", "SELECT pre_id, post_id, shell_roi FROM syn WHERE shell_roi = 'ASIA'", SYN)(lambda w: synapses.in_region(*w.both, "shell_roi", "ASIA")[1].select("pre_id", "post_id", "shell_roi"))
simple("f07_restrict_roi_points", "SELECT point_id FROM points WHERE point_id IN (SELECT pre_id FROM syn WHERE shell_roi <> '<unspecified>' UNION SELECT post_id FROM syn WHERE shell_roi <> '<unspecified>')", SYN, POINTS)(lambda w: synapses.in_region(*w.both, "shell_roi")[0].select("point_id"))
BOUNDS = "inb AS (SELECT body_pre AS b FROM syn WHERE primary_roi IN ('NATION_3','NATION_7') UNION SELECT body_post FROM syn WHERE primary_roi IN ('NATION_3','NATION_7'))"
simple("f08_in_bounds", "SELECT pre_id, post_id FROM syn WHERE body_pre IN (SELECT b FROM inb) OR body_post IN (SELECT b FROM inb)", SYN, BOUNDS)(
    lambda w: synapses.in_bounds(w.both[0], w.syn, "primary_roi", ["NATION_3", "NATION_7"])[1].select("pre_id", "post_id")
)
ELM_ID = "(z::BIGINT << 42) | (y << 21) | x"


def _distances(w):
    e = w.elements.withColumn("point_id", scalars.encode_point(F.col("z"), F.col("y"), F.col("x")))
    d = e.groupBy("body").agg(F.min("point_id").alias("source_id"), F.max("point_id").alias("target_id"))
    return annotations.elements_in(e, "roi", d.select("source_id", "target_id"), w.both[0])[1]


simple(
    "f09_elements",
    f"""SELECT a.id AS source_id, b.id AS target_id FROM (SELECT body, min({ELM_ID}) AS s, max({ELM_ID}) AS t FROM elm GROUP BY body) d JOIN ids a ON a.id = d.s JOIN ids b ON b.id = d.t""",
    ELM,
    f"ids AS (SELECT DISTINCT id FROM (SELECT {ELM_ID} AS id FROM elm WHERE roi <> '<unspecified>' UNION ALL SELECT l_orderkey * 64 + unnest(range(0, n + 1)) FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)))",
)(lambda w: _distances(w).select("source_id", "target_id"))
for _n, _least in (("significant", 15), ("traced", 20)):
    simple(f"f10_{_n}", f"SELECT pre_id, post_id FROM syn WHERE body_pre IN (SELECT body FROM ann WHERE status_rank >= {_least}) AND body_post IN (SELECT body FROM ann WHERE status_rank >= {_least})", SYN, ANN)(
        lambda w, k=_least: connectome.of_status(w.syn, w.ann, k).select("pre_id", "post_id")
    )
for _mode, _sql in (("all", "TRUE"), ("element_presence", "body IN (SELECT body FROM points WHERE shell_roi='ASIA') OR body IN (SELECT body FROM elm WHERE roi = 'R7')"), ("none", "body IN (SELECT body FROM points WHERE shell_roi='ASIA')")):
    simple(f"f11_report_annotations_{_mode}", f"SELECT body, status_rank FROM ann WHERE {_sql}", SYN, POINTS, ANN, ELM)(
        lambda w, m=_mode.replace("_", "-"): reports.annotations_for(w.ann, w.both[0].where("shell_roi = 'ASIA'"), w.elements.where("roi = 'R7'"), m).select("body", "status_rank")
    )
simple("f12_nt_bodies", "SELECT body, type FROM ann WHERE body IN (SELECT body FROM points WHERE primary_roi = 'NATION_3' AND conf = 4)", SYN, POINTS, ANN)(lambda w: rows.with_key(w.ann, w.both[0].where("primary_roi = 'NATION_3' AND conf = 4"), "body").select("body", "type"))
simple("f13_nt_annotations", "SELECT body, type FROM ann WHERE type IS NOT NULL AND body IN (SELECT body FROM nt)", ANN, NT)(lambda w: rows.with_key(w.ann.where("type IS NOT NULL"), w.nt, "body").select("body", "type"))
simple("f14_not_training", "SELECT vec_id, body FROM nt WHERE body NOT IN (SELECT body FROM nt WHERE split = 'train')", NT)(lambda w: nt.not_training(w.nt).select("vec_id", "body"))
simple("f15_status_exclusion", "SELECT body, type FROM ann WHERE type NOT IN ('ECONOMY', 'PROMO') OR type IS NULL", ANN)(lambda w: rows.without_values(w.ann, "type", ["ECONOMY", "PROMO"]).select("body", "type"))
simple("f16_retention", "SELECT o_orderkey FROM orders WHERE regexp_matches(o_orderpriority, '^[1-3]-') AND date_diff('day', o_orderdate::DATE, DATE '2001-01-01') > 500")(lambda w: rows.retained(w.table("orders"), "o_orderpriority", "^[1-3]-", "o_orderdate", "2001-01-01", 500).select("o_orderkey"))

# Joins

simple("j01_conf", "SELECT s.pre_id, s.post_id, 10 AS conf_pre, s.conf_post FROM syn s", SYN)(lambda w: synapses.with_ends(w.syn, w.both[0], "conf").select("pre_id", "post_id", "conf_pre", "conf_post"))
simple("j02_bodies", "SELECT pre_id, post_id, body_pre, body_post FROM syn", SYN)(lambda w: synapses.with_ends(w.syn.drop("body_pre", "body_post"), w.both[0], "body").select("pre_id", "post_id", "body_pre", "body_post"))
simple("j03_partner_rois", "SELECT pre_id, post_id, primary_roi, shell_roi FROM syn", SYN)(lambda w: synapses.with_regions(w.syn.drop(*ROISETS), w.both[0], ROISETS).select("pre_id", "post_id", *ROISETS))
simple("j04_compartments", "SELECT pre_id, post_id, compartment_pre, compartment_post FROM syn", SYN)(lambda w: synapses.with_ends(w.syn, w.both[0], "compartment").select("pre_id", "post_id", "compartment_pre", "compartment_post"))
simple("j05_types", "SELECT c.*, a.type AS type_pre, b.type AS type_post FROM (SELECT body_pre, body_post, count(*) AS weight FROM syn GROUP BY ALL) c LEFT JOIN ann a ON a.body = body_pre LEFT JOIN ann b ON b.body = body_post", SYN, ANN)(lambda w: connectome.with_types(connectome.weighted(w.syn), w.ann).select("body_pre", "body_post", "weight", "type_pre", "type_post"))
simple("j06_segment_wide", "SELECT s.body, synweight, type, status_rank, size FROM body_stats s LEFT JOIN ann USING (body) LEFT JOIN (SELECT o_custkey * 100003 AS body, count(*) AS size FROM orders GROUP BY 1) z USING (body)", SYN, POINTS, ANN, STATS)(
    lambda w: stats.with_properties(stats.body_stats(*w.both), w.ann, w.table("orders").groupBy((F.col("o_custkey") * 100003).alias("body")).agg(F.count("*").alias("size"))).select("body", "synweight", "type", "status_rank", "size")
)
simple("j07_outer_concat", "SELECT coalesce(a.body, b.body) AS body, coalesce(na, 0) AS n_in, coalesce(nb, 0) AS n_out FROM (SELECT body_post AS body, count(*) AS na FROM syn GROUP BY 1) a FULL JOIN (SELECT body_pre AS body, count(*) AS nb FROM syn WHERE compartment_pre = 'axon' GROUP BY 1) b ON a.body = b.body", SYN)(
    lambda w: stats.counts_of({"n_in": (w.syn, "body_post"), "n_out": (w.syn.where("compartment_pre = 'axon'"), "body_pre")}, "body")
)
simple("j08_combine_first", "SELECT coalesce(a.body, b.body) AS body, coalesce(a.size, b.size) AS size FROM (SELECT o_custkey AS body, count(*) AS size FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) a FULL JOIN (SELECT c_custkey AS body, 1000::BIGINT AS size FROM customer) b ON a.body = b.body")(
    lambda w: annotations.combined(w.table("orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("body")).agg(F.count("*").alias("size")), w.table("customer").select(F.col("c_custkey").alias("body"), F.lit(1000).cast("long").alias("size")), "body", "size")
)
simple("j09_stale", "SELECT o_custkey AS body FROM orders WHERE year(o_orderdate) > 1998 AND year(o_orderdate) <= 2000 UNION SELECT o_orderkey FROM orders WHERE year(o_orderdate) > 1998 AND year(o_orderdate) <= 2000 AND o_orderstatus = 'F'")(
    lambda w: annotations.stale(w.table("orders").select(F.year("o_orderdate").alias("version"), F.col("o_custkey").alias("changed"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("created")), 1998, 2000)
)
simple("j10_point_annotations", "SELECT coalesce(a.body, p.body) AS body, p.y AS type, a.status_rank FROM ann a FULL JOIN (SELECT body, y FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY z, y, x) AS n FROM elm WHERE type = 'O') WHERE n = 1) p ON a.body = p.body", ANN, ELM)(
    lambda w: annotations.with_point_annotations(w.ann, w.elements.where("type = 'O'"), "y").select("body", F.col("y").alias("type"), "status_rank") if "y" in w.ann.columns else annotations.with_point_annotations(w.ann.withColumn("y", F.lit(None).cast("long")).drop("type"), w.elements.where("type = 'O'"), "y").select("body", F.col("y").alias("type"), "status_rank")
)
simple("j11_align", "SELECT coalesce(u.body, d.body) AS body, coalesce(up, 0) + coalesce(down, 0) AS synweight FROM (SELECT body_post AS body, count(*) AS up FROM syn GROUP BY 1) u FULL JOIN (SELECT body_pre AS body, count(*) AS down FROM syn GROUP BY 1) d ON u.body = d.body", SYN)(
    lambda w: stats.counts_of({"up": (w.syn, "body_post"), "down": (w.syn, "body_pre")}, "body").select("body", (F.col("up") + F.col("down")).alias("synweight"))
)
simple("j12_null_safe", "SELECT b.body, b.cell_type, t.n FROM (SELECT DISTINCT body, cell_type FROM nt) b LEFT JOIN (SELECT cell_type, count(*) AS n FROM nt GROUP BY 1) t ON b.cell_type IS NOT DISTINCT FROM t.cell_type", NT)(
    lambda w: rows.join_null_safe(w.nt.select("body", "cell_type").distinct(), w.nt.groupBy("cell_type").agg(F.count("*").alias("n")), "cell_type")
)
simple("j13_map", "SELECT primary_roi, CASE primary_roi WHEN 'NATION_1' THEN 'one' WHEN 'NATION_2' THEN 'two' END AS label, count(*) AS n FROM syn GROUP BY ALL", SYN)(lambda w: w.syn.groupBy("primary_roi", scalars.literal_map({"NATION_1": "one", "NATION_2": "two"}, F.col("primary_roi")).alias("label")).agg(F.count("*").alias("n")))
simple("j15_synset_ids", "SELECT DISTINCT body_pre || '_' || body_post || '_pre' AS pre, body_pre || '_' || body_post || '_post' AS post FROM syn", SYN)(lambda w: connectome.weighted(w.syn).select(graph.synset_ids()[0].alias("pre"), graph.synset_ids()[1].alias("post")))
simple("j16_presyn_nt", "SELECT point_id, vec_id FROM points LEFT JOIN nt ON vec_id * 64 = point_id WHERE kind = 'PreSyn'", SYN, POINTS, NT)(lambda w: nt.of_points(w.both[0], w.nt.select("vec_id", (F.col("vec_id") * 64).alias("point_id"))).select("point_id", "vec_id"))
simple("j17_report_join", "SELECT shell_roi AS name, count(*) FILTER (kind='PreSyn') AS PreSyn, count(*) FILTER (kind='PostSyn') AS PostSyn, CASE shell_roi WHEN 'ASIA' THEN 0 WHEN 'AFRICA' THEN 1 END AS report_index FROM points GROUP BY shell_roi", SYN, POINTS)(
    lambda w: reports.syn_counts(w.both[0].withColumnRenamed("shell_roi", "name"), "name").withColumn("report_index", scalars.literal_map({"ASIA": 0, "AFRICA": 1}, F.col("name")))
)
VOX = "vox AS (SELECT z >> 5 AS bz, y >> 5 AS b_y, x >> 5 AS bx, min(roi) AS roi, min(y % 7) AS label FROM elm WHERE roi <> '<unspecified>' GROUP BY ALL)"
simple("j18_voxel_roi", "SELECT z, y, x, type, coalesce(label, 0)::INT AS v_label FROM elm LEFT JOIN vox ON z >> 5 = bz AND y >> 5 = b_y AND x >> 5 = bx", ELM, VOX)(
    lambda w: rois.from_volume(w.elements, w.elements.where("roi <> '<unspecified>'").groupBy(F.shiftright("z", 5).alias("bz"), F.shiftright("y", 5).alias("by"), F.shiftright("x", 5).alias("bx")).agg(F.min(F.col("y") % 7).alias("label")), "v").select("z", "y", "x", "type", "v_label")
)
simple("j19_relabel", "SELECT point_id, coalesce(m.body, p.body) AS body FROM points p LEFT JOIN (SELECT p_partkey * 100003 AS sv, p_size::BIGINT AS body FROM part WHERE p_size > 25) m ON p.body = m.sv", SYN, POINTS)(
    lambda w: synapses.relabelled(w.both[0].withColumnRenamed("body", "sv"), w.table("part").where("p_size > 25").select((F.col("p_partkey") * 100003).alias("sv"), F.col("p_size").cast("long").alias("body"))).select("point_id", "body")
)

# Aggregations

COMP = ", ".join(f"count(*) FILTER (compartment_pre='{a}' AND compartment_post='{b}') AS {n}" for n, (a, b) in {"weightAxonDendrite": ("axon", "dendrite"), "weightAxonAxon": ("axon", "axon"), "weightDendriteDendrite": ("dendrite", "dendrite"), "weightDendriteAxon": ("dendrite", "axon")}.items())
simple("a01_weighted_connectome", "SELECT body_pre, body_post, count(*) AS weight FROM syn GROUP BY 1, 2", SYN)(lambda w: connectome.weighted(w.syn))
simple("a02_compartment_weights", f"SELECT body_pre, body_post, count(*) AS weight, {COMP} FROM syn GROUP BY 1, 2", SYN)(lambda w: connectome.weighted(w.syn, compartments=True))
for _k, (_ha, _hp) in {"a03_confidence_weights": (5, 8), "a03_confidence_weights_swapped": (8, 5)}.items():
    simple(_k, f"SELECT body_pre, body_post, count(*) AS \"weightHR\", count(*) FILTER (conf_post >= {_ha} OR conf_post >= {_hp}) AS weight, count(*) FILTER (conf_post >= {_hp}) AS \"weightHP\" FROM syn GROUP BY 1, 2", SYN)(lambda w, a=_ha, p=_hp: connectome.confidence_weights(w.syn, a, p))
simple("a04_body_stats", "SELECT * FROM body_stats", SYN, POINTS, STATS)(lambda w: stats.body_stats(*w.both))
simple("a05_body_roi_stats", "SELECT * FROM regional", SYN, POINTS, LONG)(lambda w: stats.body_region_stats(*w.both, ROISETS))
simple("a06_compartment_in_out", "SELECT body, count(*) FILTER (c='axon' AND way='In') AS \"axonIn\", count(*) FILTER (c='axon' AND way='Out') AS \"axonOut\", count(*) FILTER (c='dendrite' AND way='In') AS \"dendriteIn\", count(*) FILTER (c='dendrite' AND way='Out') AS \"dendriteOut\" FROM (SELECT body, 'In' AS way, compartment AS c FROM points WHERE kind='PostSyn' UNION ALL SELECT body_pre, 'Out', compartment_pre FROM syn) GROUP BY body", SYN, POINTS)(lambda w: stats.compartment_counts(*w.both))
simple("a07_element_totals", "SELECT body, count(*) AS total, count(*) FILTER (type='O') AS \"O\", count(*) FILTER (type='F') AS \"F\" FROM elm GROUP BY body", ELM)(lambda w: stats.element_counts(w.elements, ["O", "F"]))
simple("a07_element_pivot", "SELECT body, roi, count(*) FILTER (type='O') AS \"O\", count(*) FILTER (type='F') AS \"F\" FROM elm GROUP BY body, roi", ELM)(lambda w: stats.element_pivot(w.elements, ["O", "F"]))
simple("a08_roi_totals", "SELECT roi, sum(pre)::BIGINT AS pre, sum(post)::BIGINT AS post FROM regional WHERE roi <> '<unspecified>' GROUP BY roi", SYN, POINTS, LONG)(lambda w: stats.region_totals(stats.body_region_stats(*w.both, ROISETS)))
simple("a08_dataset_totals", "SELECT sum(pre)::BIGINT AS pre, sum(post)::BIGINT AS post FROM regional WHERE roi IN ('ASIA', 'AFRICA')", SYN, POINTS, LONG)(lambda w: stats.dataset_totals(stats.body_region_stats(*w.both, ROISETS), ["ASIA", "AFRICA"]))
simple("a09_pair_roi_counts", "SELECT body_pre, body_post, roi, count(*) AS post FROM (SELECT body_pre, body_post, 'primary_roi' AS roiset, primary_roi AS roi FROM syn UNION ALL SELECT body_pre, body_post, 'shell_roi', shell_roi FROM syn) WHERE roi <> '<unspecified>' OR roiset = 'primary_roi' GROUP BY 1, 2, 3", SYN)(lambda w: connectome.regional(w.syn, ROISETS))
simple("a09_pair_roi_info", "SELECT body_pre, body_post, '{' || coalesce(string_agg('\"' || roi || '\":{\"post\":' || n || '}', ',' ORDER BY roi) FILTER (roi <> '<unspecified>'), '') || '}' AS \"roiInfo\" FROM (SELECT body_pre, body_post, roi, count(*) AS n FROM (SELECT body_pre, body_post, 'primary_roi' AS roiset, primary_roi AS roi FROM syn UNION ALL SELECT body_pre, body_post, 'shell_roi', shell_roi FROM syn) WHERE roi <> '<unspecified>' OR roiset = 'primary_roi' GROUP BY 1, 2, 3) GROUP BY 1, 2", SYN)(lambda w: connectome.pair_region_info(w.syn, ROISETS))
_COUNTS = " || ".join(f"CASE WHEN {c} <> 0 THEN ',\"{c}\":' || {c} ELSE '' END" for c in stats.COUNTS)
simple("a10_body_roi_info", f"SELECT body, '{{' || coalesce(string_agg('\"' || roi || '\":{{' || substr(x, 2) || '}}', ',' ORDER BY roi) FILTER (roi <> '<unspecified>'), '') || '}}' AS \"roiInfo\" FROM (SELECT body, roi, {_COUNTS} AS x FROM regional) GROUP BY body", SYN, POINTS, LONG)(lambda w: stats.region_info(stats.body_region_stats(*w.both, ROISETS)).drop("roiset_hash"))
simple("a10_body_rois", "SELECT body, coalesce(string_agg(roi, ',' ORDER BY roi) FILTER (roi <> '<unspecified>'), '') AS rois FROM regional GROUP BY body", SYN, POINTS, LONG)(lambda w: stats.region_names(stats.body_region_stats(*w.both, ROISETS)))
simple("a11_ranked_body_stats", "SELECT s.*, status_rank, type, row_number() OVER (ORDER BY synweight DESC, pre DESC, post DESC, s.body) AS rank FROM body_stats s LEFT JOIN ann USING (body)", SYN, POINTS, ANN, STATS)(lambda w: stats.ranked(stats.body_stats(*w.both), w.ann).withColumn("rank", F.col("rank").cast("long")))
_STATUS = "list_extract([" + ",".join(f"'{s}'" for s in STATUSES) + "], status_rank + 1)"
simple("a12_status_counts", f"SELECT status, count(*) AS n FROM (SELECT {_STATUS} AS status FROM ann) WHERE status <> '' GROUP BY status", ANN)(lambda w: annotations.status_counts(w.ann.withColumn("status", F.element_at(F.array(*map(F.lit, STATUSES)), F.col("status_rank") + 1))))
simple("a13_argmax", "SELECT vec_id, pred1 FROM pred", NT, PRED)(lambda w: nt.predicted(w.nt, TRANSMITTERS, TRANSMITTERS).select("vec_id", "pred1"))
MODES = "modes AS (SELECT body, pred1 AS group_pred FROM (SELECT body, pred1, row_number() OVER (PARTITION BY body ORDER BY count(*) DESC, pred1) AS r FROM pred GROUP BY body, pred1) WHERE r = 1)"
simple("a14_mode", "SELECT * FROM modes", NT, PRED, MODES)(lambda w: nt.mode(nt.predicted(w.nt, TRANSMITTERS, TRANSMITTERS), "body"))
TRUTH = "truth AS (SELECT 'T' || i AS cell_type, list_extract(" + NAMES + ", (i % 4 + 1)::INT) AS ground_truth FROM range(12) t(i))"
CONF = f"conf AS (SELECT g.x AS ground_truth, p.x AS pred1, coalesce(n / nullif(sum(n) OVER (PARTITION BY g.x), 0), 0)::DOUBLE AS p FROM (SELECT unnest({NAMES}) AS x) g, (SELECT unnest({NAMES}) AS x) p LEFT JOIN (SELECT ground_truth, pred1, count(*) AS n FROM pred JOIN truth USING (cell_type) WHERE body NOT IN (SELECT body FROM nt WHERE split = 'train') GROUP BY 1, 2) c ON c.ground_truth = g.x AND c.pred1 = p.x)"


def _truth(w):
    return w.spark.createDataFrame([(f"T{i}", TRANSMITTERS[i % 4]) for i in range(12)], "cell_type string, ground_truth string")


def _matrix(w, p):
    return nt.confusion(nt.not_training(p), _truth(w), TRANSMITTERS)


def _pred(w):
    return nt.predicted(w.nt, TRANSMITTERS, TRANSMITTERS)


simple("a15_confusion", "SELECT ground_truth, pred1, round(p, 6) AS p FROM conf", NT, PRED, TRUTH, CONF)(lambda w: _matrix(w, _pred(w)).withColumn("p", scalars.rounded(F.col("p"), 6)))
simple("a16_group_confidence", "SELECT body, round(avg(p), 6) AS confidence, count(pred.pred1) AS num_tbar_nt_predictions FROM pred JOIN modes USING (body) LEFT JOIN conf ON conf.ground_truth = group_pred AND conf.pred1 = pred.pred1 GROUP BY body", NT, PRED, MODES, TRUTH, CONF)(
    lambda w: (lambda p: nt.group_confidence(p, nt.mode(p, "body"), _matrix(w, p), "body").withColumn("confidence", scalars.rounded(F.col("confidence"), 6)))(_pred(w))
)
simple("a17_prediction_counts", "SELECT cell_type, count(pred1) AS n FROM pred GROUP BY cell_type", NT, PRED)(lambda w: nt.prediction_counts(_pred(w), "cell_type"))
simple("a19_distinct", "SELECT body_pre, count(DISTINCT pre_id) AS presyn, count(DISTINCT shell_roi) AS regions FROM syn GROUP BY 1", SYN)(lambda w: rows.distinct_counts(w.syn, "body_pre", {"presyn": "pre_id", "regions": "shell_roi"}))
CAP = "cap AS (SELECT s.*, body_pre IN (SELECT body FROM ann WHERE status_rank >= 15) AS captured_pre, body_post IN (SELECT body FROM ann WHERE status_rank >= 15) AS captured_post FROM syn s)"
simple("a20_downstream_capture", "SELECT body_pre, count(*) FILTER (captured_post) AS captured, count(*) FILTER (NOT captured_post) AS not_captured, count(*) AS downstream, count(DISTINCT pre_id) AS presyn, round(count(*) FILTER (captured_post) / count(*), 6) AS capture_frac FROM cap WHERE captured_pre GROUP BY body_pre", SYN, ANN, CAP)(lambda w: reports.downstream_capture(reports.with_capture(w.syn, w.ann, 15)).withColumn("capture_frac", scalars.rounded(F.col("capture_frac"), 6)))
simple("a21_syn_counts", "SELECT primary_roi, count(*) FILTER (kind='PreSyn') AS \"PreSyn\", count(*) FILTER (kind='PostSyn') AS \"PostSyn\" FROM points GROUP BY 1", SYN, POINTS)(lambda w: reports.syn_counts(w.both[0], "primary_roi"))
simple("a22_latest", "SELECT max(greatest(l_shipdate, o_orderdate)) AS latest FROM lineitem JOIN orders ON l_orderkey = o_orderkey")(lambda w: w.table("lineitem").join(w.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).transform(rows.latest, "l_shipdate", "o_orderdate"))
simple("a23_mean_scores", "SELECT body, " + ", ".join(f"round(avg(scores[{k + 1}]::DOUBLE), 5) AS {n}" for k, n in enumerate(TRANSMITTERS)) + " FROM nt GROUP BY body", NT)(lambda w: nt.mean_scores(w.nt, TRANSMITTERS).select("body", *(scalars.rounded(F.col(n), 5).alias(n) for n in TRANSMITTERS)))
SIDES = "sides AS (SELECT p_name || CASE p_partkey % 3 WHEN 0 THEN '(L)' WHEN 1 THEN '(R)' ELSE '' END AS name, max(p_size) AS v FROM part GROUP BY 1)"


def _sides(w):
    suffix = F.when(F.col("p_partkey") % 3 == 0, F.lit("(L)")).when(F.col("p_partkey") % 3 == 1, F.lit("(R)")).otherwise(F.lit(""))
    return w.table("part").groupBy(F.concat("p_name", suffix).alias("name")).agg(F.max("p_size").alias("v"))


simple(
    "a24_side_pivot",
    """SELECT base, "L", "R", "C", CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN (l + r) / 2 END AS mean, greatest(l, r) - CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN (l + r) / 2 END AS residual,
 CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN CASE WHEN l <= r THEN 'L' ELSE 'R' END END AS min_side, CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN CASE WHEN l <= r THEN 'R' ELSE 'L' END END AS max_side
 FROM (SELECT base, max(v) FILTER (side='L') AS "L", max(v) FILTER (side='R') AS "R", max(v) FILTER (side='C') AS "C" FROM (SELECT CASE WHEN name LIKE '%(L)' OR name LIKE '%(R)' THEN left(name, -3) ELSE name END AS base, CASE WHEN name LIKE '%(L)' THEN 'L' WHEN name LIKE '%(R)' THEN 'R' ELSE 'C' END AS side, v FROM sides) GROUP BY base)""",
    SIDES,
)(lambda w: plotdata.by_side(_sides(w), "name", "v"))
simple("a25_weighted_mean", "SELECT round(sum(p_size * p_retailprice) / sum(p_retailprice), 6) AS mean FROM part")(lambda w: plotdata.weighted_mean(w.table("part"), "p_size", "p_retailprice").select(scalars.rounded(F.col("mean"), 6).alias("mean")))
simple("a26_choices", "SELECT string_agg(DISTINCT type, ';' ORDER BY type) AS choices FROM ann", ANN)(lambda w: annotations.choices(w.ann, "type"))
simple("a27_last_per_user", "SELECT event_id, user_id, event_type, value, n AS requests FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE r = 1")(lambda w: logs.last_per_user(w.table("events"), "user_id", ("ts", "event_id")).select("event_id", "user_id", "event_type", "value", "requests"))
simple("a27_first_per_user", "SELECT event_id, user_id, n AS requests FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE r = 1")(lambda w: logs.last_per_user(w.table("events"), "user_id", ("ts", "event_id"), "first").select("event_id", "user_id", "requests"))
simple("a28_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")(lambda w: rois.duplicates(w.table("lineitem"), "l_orderkey", "l_linenumber"))
simple("snk06_multi_split", "SELECT body, count(DISTINCT part) AS splits FROM (SELECT body, CASE vec_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN CASE WHEN body % 4 = 0 THEN 'test' ELSE 'train' END END AS part FROM nt) GROUP BY body HAVING count(DISTINCT part) > 1", NT)(
    lambda w: nt.multi_split(w.nt.select("body", F.when(F.col("vec_id") % 3 == 0, F.lit("train")).when((F.col("vec_id") % 3 == 1) & (F.col("body") % 4 == 0), F.lit("test")).when(F.col("vec_id") % 3 == 1, F.lit("train")).alias("split")))
)
