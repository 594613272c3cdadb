"""Queries of tables that are kept between runs and of other sources: refreshes, volumes, Arrow files, log tails, labels."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .functions import scalars
from .operators import annotations, labels, logs, rois
from .plans import refresh
from .queries import ELM, POINTS, STATS, SYN, VOX, simple
from .sources import adapter, readers, shared, sinks, versions, volumes


def _folder(w) -> str:
    """A new folder that all executors share."""
    return f"{shared.folder(w.spark)}/axonlake-{w.spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


# Incremental refresh: the last weeks' orders are changes to a table of counts as it was before them

CUT = "2001-07-20"


def _refreshed(w):
    """Path of body counts that were built before the cut and refreshed with the bodies of later orders."""
    partners = shared.saved(w.syn.select("pre_id", "body_pre", "body_post", "compartment_pre"), "partners")  # what counts need
    late = w.table("orders").select((F.col("o_orderkey") * 64).alias("pre_id"), (F.col("o_orderdate") >= CUT).alias("late"))
    syn = shared.saved(partners.join(late, "pre_id"), "dated")
    old, path = syn.where("NOT late").drop("late"), f"{_folder(w)}/counts"
    changes = syn.where("late").select(F.lit(2).alias("version"), F.col("body_pre").alias("changed"), F.col("body_post").alias("created"))
    refresh.body_counts(w.spark, path, adapter.ends(old), old, changes, 1, rows_a_range=1000)
    refresh.body_counts(w.spark, path, adapter.ends(partners), partners, changes, 2)
    return path


OLD = f"syn AS (SELECT s.* FROM all_syn s JOIN orders ON o_orderkey * 64 = pre_id WHERE o_orderdate < TIMESTAMP '{CUT}')"
simple("x05_refresh", "SELECT * FROM body_stats", SYN, POINTS, STATS)(lambda w: versions.read(w.spark, _refreshed(w)))
simple("x05_before_refresh", "SELECT * FROM body_stats", SYN.replace("syn AS", "all_syn AS", 1), OLD, POINTS, STATS)(lambda w: versions.read(w.spark, _refreshed(w), version=0))


def _size_cache(w):
    path = f"{_folder(w)}/sizes"
    size = lambda c, k: w.table("orders").groupBy((F.col(c) * adapter.STEP).alias("body")).agg((F.count("*") * k).alias("size"))
    refresh.sizes(w.spark, path, size("o_custkey", 1))
    o = w.table("orders").select(F.year("o_orderdate").alias("version"), (F.col("o_custkey") * adapter.STEP).alias("changed"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") * adapter.STEP).alias("created"))
    refresh.sizes(w.spark, path, size("o_custkey", 100).unionByName(size("o_orderkey", 7).join(size("o_custkey", 1).select("body"), "body", "left_anti")), annotations.stale(o, 1998, 2000))
    return versions.read(w.spark, path)


simple(
    "j09_size_cache",
    "SELECT coalesce(n.body, c.body) AS body, coalesce(n.size, c.size) AS size FROM (SELECT * FROM fetched WHERE body IN (SELECT body FROM stale)) n FULL JOIN cache c ON n.body = c.body",
    "stale AS (SELECT o_custkey * 100003 AS body FROM orders WHERE year(o_orderdate) > 1998 AND year(o_orderdate) <= 2000 UNION SELECT o_orderkey * 100003 FROM orders WHERE year(o_orderdate) > 1998 AND year(o_orderdate) <= 2000 AND o_orderstatus = 'F')",
    "cache AS (SELECT o_custkey * 100003 AS body, count(*) AS size FROM orders GROUP BY 1)",
    "fetched AS (SELECT body, size * 100 AS size FROM cache UNION ALL SELECT o_orderkey * 100003, count(*) * 7 FROM orders WHERE o_orderkey * 100003 NOT IN (SELECT body FROM cache) GROUP BY 1)",
)(_size_cache)

# Region volumes


def _voxels(w):
    e = w.elements.where("roi <> '<unspecified>'")
    return e.groupBy(*(F.shiftright(a, 5).alias(f"b{a}") for a in "zyx")).agg(F.min(F.col("y") % 7).alias("label"))


def _through_cache(w, ids):
    """Labels of the elements from a volume that was saved for ids before, with {"a": 1} in between."""
    path = f"{_folder(w)}/volume"
    volumes.cached(w.spark, path, ids, lambda: _voxels(w))
    blocks, box = volumes.cached(w.spark, path, {"a": 1}, lambda: _voxels(w).withColumn("label", F.lit(9)))
    return rois.from_volume(w.elements, volumes.near(blocks, box, w.elements), "v").select("z", "y", "x", "type", "v_label")


_J18 = "SELECT z, y, x, type, coalesce({}, 0)::INT AS v_label FROM elm LEFT JOIN vox ON z >> 5 = bz AND y >> 5 = b_y AND x >> 5 = bx"
simple("j18_cached_volume", _J18.format("label"), ELM, VOX)(lambda w: _through_cache(w, {"a": 1}))
simple("j18_rebuilt_volume", _J18.format("CASE WHEN label IS NOT NULL THEN 9 END"), ELM, VOX)(lambda w: _through_cache(w, {"a": 2}))
simple(
    "src5_block_runs",
    "SELECT bz >> 5 AS kz, b_y >> 5 AS ky, bx >> 5 AS kx, count(*) FILTER (fresh) AS runs, count(*) AS voxels FROM (SELECT *, coalesce(lag(bx) OVER w <> bx - 1 OR lag(label) OVER w <> label, TRUE) AS fresh FROM vox WHERE label <> 0 WINDOW w AS (PARTITION BY bz, b_y, bx >> 5 ORDER BY bx)) GROUP BY 1, 2, 3",
    ELM, VOX,
)(lambda w: volumes.runs(_voxels(w)).select("kz", "ky", "kx", F.size("runs").cast("long").alias("runs"), F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["n"]).alias("voxels")))

# Arrow files: all connections written, and read back as far as a filter and some columns need


def _as_arrow(w):
    path = f"{_folder(w)}/partners"
    sinks.arrow(w.syn.select("pre_id", "post_id", "body_pre", "body_post", "conf_post", "primary_roi").sort("post_id"), path)
    return path


simple("src1_arrow_pushdown", "SELECT post_id, body_post FROM syn WHERE post_id >= 10000 AND post_id < 60000 AND conf_post IN (3, 4, 7)", SYN)(
    lambda w: readers.arrow(w.spark, _as_arrow(w), ["post_id", "body_post", "conf_post"]).where("post_id >= 10000 AND post_id < 60000 AND conf_post IN (3, 4, 7)").select("post_id", "body_post")
)
simple("src1_arrow_whole", "SELECT pre_id, post_id, body_pre, body_post, conf_post, primary_roi FROM syn", SYN)(lambda w: readers.arrow(w.spark, _as_arrow(w)))

# The last bytes of a request log that is written from the events


def _log_tail(w, share):
    """Messages of the last bytes of a log of all events, one file, in order of time; share of its bytes."""
    text = F.concat(F.lit('{"uri": "/u'), F.col("user_id"), F.lit('", "status": 200, "time": '), F.col("event_id"), F.lit(', "user": "'), F.col("user_id"), F.lit('", "debug": "'), F.when(F.col("event_id") % 3 == 0, F.lit("a\nb {\nc")).otherwise(F.lit("x")), F.lit('"}'))
    path = f"{_folder(w)}/log"
    w.table("events").select(text.alias("value"), "event_id").repartitionByRange("event_id").sortWithinPartitions("event_id").select("value").write.text(path)
    return logs.parsed(readers.log_tail(w.spark, path, share, 200_000))


simple("log03_whole_log", "SELECT '/u' || user_id AS uri, event_id::DOUBLE AS time, CASE event_id % 3 WHEN 0 THEN 'a' || chr(10) || 'b {' || chr(10) || 'c' ELSE 'x' END AS debug FROM events")(lambda w: _log_tail(w, 0).select("uri", "time", "debug"))

# Region labels

GIVEN = {"NATION_21": 4, "NATION_3": 9, "NATION_12": 2}
simple(
    "p03_stable_labels",
    "SELECT roi, label FROM (VALUES ('NATION_21', 4), ('NATION_3', 9), ('NATION_12', 2)) t(roi, label) UNION ALL SELECT roi, (9 + row_number() OVER (ORDER BY roi))::INT FROM (SELECT DISTINCT primary_roi AS roi FROM points) WHERE roi NOT IN ('NATION_21', 'NATION_3', 'NATION_12', '<unspecified>') UNION ALL SELECT '<unspecified>', 0",
    SYN, POINTS,
)(lambda w: labels.allocated(labels.names_in(w.both[0], "primary_roi"), labels.table_of(w.spark, GIVEN)))
_LABELS = "lab AS (SELECT roi, label FROM (SELECT roi, (9 + row_number() OVER (ORDER BY roi))::INT AS label FROM (SELECT DISTINCT primary_roi AS roi FROM points) WHERE roi NOT IN ('NATION_21', 'NATION_3', 'NATION_12', '<unspecified>')) UNION ALL SELECT * FROM (VALUES ('NATION_21', 4), ('NATION_3', 9), ('NATION_12', 2), ('<unspecified>', 0)) t)"
simple("p03_labelled_points", "SELECT point_id, primary_roi, label AS primary_roi_label FROM points JOIN lab ON roi = primary_roi", SYN, POINTS, _LABELS)(
    lambda w: (lambda p: labels.labelled(p, "primary_roi", labels.allocated(labels.names_in(p, "primary_roi"), labels.table_of(w.spark, GIVEN))))(w.both[0].select("point_id", "primary_roi"))
)
simple("p03_template_names", "SELECT p_partkey, CASE WHEN p_size % 11 = 0 THEN '<unspecified>' ELSE 'col_' || p_size % 11 // 3 || '_' || p_size % 11 % 3 END AS column, (p_size % 11)::INT AS column_label FROM part")(
    lambda w: labels.loaded(w.table("part").select("p_partkey", (F.col("p_size") % 11).cast("int").alias("column_label")), "column", template="col_{x // 3}_{x % 3}")[0].select("p_partkey", "column", "column_label")
)


def _parent_labels(w):
    p = w.syn.select(F.col("post_id").alias("point_id"), "primary_roi", F.when(F.col("shell_roi") == "AFRICA", F.lit("AFRICA(R)")).otherwise(F.col("shell_roi")).alias("shell_roi"))
    p, own = labels.loaded(p, "primary_roi")
    p, shell = labels.loaded(p, "shell_roi")
    return labels.with_parent_labels(p, {"primary_roi": own, "shell_roi": shell}, {"primary_roi": ("shell_roi", ["ASIA", "AFRICA(R)"])})


simple(
    "p07_parent_labels",
    "SELECT x.post_id AS point_id, x.p AS primary_roi, label AS primary_roi_label FROM filled x JOIN plab ON plab.roi = x.p",
    SYN,
    "filled AS (SELECT post_id, CASE WHEN primary_roi = '<unspecified>' AND shell_roi = 'ASIA' THEN 'ASIA-unspecified' WHEN primary_roi = '<unspecified>' AND shell_roi = 'AFRICA' THEN 'AFRICA-unspecified(R)' ELSE primary_roi END AS p FROM syn)",
    "first AS (SELECT roi, (row_number() OVER (ORDER BY roi))::INT AS label FROM (SELECT DISTINCT primary_roi AS roi FROM syn WHERE primary_roi <> '<unspecified>'))",
    "plab AS (SELECT * FROM first UNION ALL SELECT roi, ((SELECT max(label) FROM first) + row_number() OVER (ORDER BY roi))::INT FROM (SELECT DISTINCT p AS roi FROM filled WHERE p LIKE '%-unspecified%') UNION ALL SELECT '<unspecified>', 0)",
)(lambda w: _parent_labels(w)[0].select("point_id", "primary_roi", "primary_roi_label"))
