"""Completeness reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import STATUS_RANK, UNSPECIFIED
from ..sources import shared
from . import stats, windows
from .stats import body_stats

#: The four families of shares, by the count whose share they are.
FAMILIES = {"traced_presyn_frac": "pre", "traced_postsyn_frac": "post", "traced_synweight_frac": "synweight", "traced_conn_frac": "conn"}


def with_capture(partners: DataFrame, ann: DataFrame, least: int) -> DataFrame:
    """partners with captured_pre and captured_post."""
    good = ann.where(F.col("status_rank") >= least)
    for side in ("pre", "post"):
        partners = partners.join(good.select(F.col("body").alias(f"body_{side}"), F.lit(True).alias(f"captured_{side}")), f"body_{side}", "left")
    return partners.na.fill(False, ["captured_pre", "captured_post"])


def in_reports(df: DataFrame, reports: dict[str, list[str]], roi: str = "roi") -> DataFrame:
    """Rows by report: a row is in each report that lists its region; an empty list takes every named region."""
    named = F.col(roi) != UNSPECIFIED
    tests = F.array(*(F.when(F.col(roi).isin(rois) if rois else named, F.lit(name)) for name, rois in reports.items()))
    return df.withColumn("report", F.explode(F.array_compact(tests)))


def annotations_for(ann: DataFrame, points: DataFrame, present: DataFrame | None, mode: str) -> DataFrame:
    """Annotations of bodies that have a synapse or, by mode (all, element-presence, none), an element there."""
    if mode == "all":
        return ann
    bodies = points.select("body")
    if mode == "element-presence" and present is not None:
        bodies = bodies.union(present.select("body"))
    return ann.join(bodies.distinct(), "body", "left_semi")


def syn_counts(points: DataFrame, *keys: str) -> DataFrame:
    return points.groupBy(*keys).pivot("kind", ["PreSyn", "PostSyn"]).agg(F.count(F.lit(1))).na.fill(0, ["PreSyn", "PostSyn"])


def downstream_capture(partners: DataFrame, *keys: str) -> DataFrame:
    """Of each captured upstream body (by keys): captured and other connections, distinct outputs, and the captured share."""
    x = partners.where("captured_pre").groupBy(*keys, "body_pre").agg(F.count_if("captured_post").alias("captured"), F.count_if(~F.col("captured_post")).alias("not_captured"), F.count("*").alias("downstream"), F.countDistinct("pre_id").alias("presyn"))
    return x.withColumn("capture_frac", F.col("captured") / F.col("downstream"))


def upto(ranked: DataFrame, stop_at: int | None) -> DataFrame:
    """Rows as far as rank stop_at, all if it is None."""
    return ranked if stop_at is None else ranked.where(F.col("rnk") <= stop_at)


def completeness(points: DataFrame, partners: DataFrame, ann: DataFrame, stop_at: int | None = None) -> DataFrame:
    """The completeness curve: bodies ranked by status, synweight, pre and post (ties by body); at each rank the shares
    of PreSyn, PostSyn, synweight and connections whose bodies are ranked no later.

    A connection is captured at the later of its bodies' ranks. Ranks and running sums are taken in blocks, so no task
    sees all bodies. The curve ends at rank stop_at; by default it has all bodies.
    """
    s = body_stats(points, partners).join(ann.select("body", "status_rank"), "body")
    r = upto(windows.ranked(s, ["status_rank", "synweight", "pre", "post"], "body", "rnk"), stop_at)
    both = partners.select("body_pre", "body_post")
    for side in ("pre", "post"):
        both = both.join(r.select(F.col("body").alias(f"body_{side}"), F.col("rnk").alias(f"r_{side}")), f"body_{side}")
    captured = both.groupBy(F.greatest("r_pre", "r_post").alias("rnk")).agg(F.count("*").alias("conn"))
    x = r.join(captured, "rnk", "left").na.fill(0, ["conn"])
    total = points.agg(F.count_if(F.col("kind") == "PreSyn").alias("t_pre"), F.count_if(F.col("kind") == "PostSyn").alias("t_post"))
    n = partners.agg(F.count("*").alias("t_conn"))
    t, c = total.first(), n.first()["t_conn"]
    x = windows.running(x, "rnk", ["pre", "post", "synweight", "conn"])
    share = lambda col, of, name: F.try_divide(F.col(col).cast("double"), F.lit(of)).alias(f"traced_{name}_frac")
    return x.select("rnk", "body", "status_rank", share("pre", t["t_pre"], "presyn"), share("post", t["t_post"], "postsyn"), share("synweight", t["t_post"] + c, "synweight"), share("conn", c, "conn"))


def present_in_reports(ann: DataFrame, present: DataFrame | None, spec: dict[str, list[str]], mode: str) -> DataFrame:
    """(report, body): annotated bodies that a report lists though they may have no synapse there; by mode all of them
    (all), those with an element in its regions (element-presence; present has body and roi), or none."""
    if mode == "all":
        return ann.select("body", F.explode(F.array(*map(F.lit, spec))).alias("report")).select("report", "body")
    if mode == "element-presence" and present is not None:
        return in_reports(present, spec).join(ann, "body", "left_semi").select("report", "body").distinct()
    if mode not in ("none", "element-presence"):
        raise ValueError(f"no such mode: {mode}")
    return ann.select(F.lit("").alias("report"), "body").where("false")


def forecast(points: DataFrame, partners: DataFrame, ann: DataFrame, spec: dict[str, list[str]], roi: str = "roi", mode: str = "none", present: DataFrame | None = None, stop_at: int | None = None) -> DataFrame:
    """The completeness curves of all reports in one plan: (report, rnk, body, status_rank, pre, post, synweight, conn and
    the four cumulative shares).

    spec: report -> its regions, none for every named one; a point or connection counts in each report that lists its
    region. In each report bodies with a synapse there, or present by mode, are ranked by status (unknown last),
    synweight, pre and post, ties by body, as far as rank stop_at (None: all). A connection is captured at the later of its bodies'
    ranks. Shares are of all of the report; null where it has none. Reports share every shuffle: ranks restart and sums
    start anew at a report's edge, wherever ranges and blocks are cut, so the number of reports adds rows but no jobs.
    Two tables are saved when this is called, with a row for each body of a report: the ranks, and then what is captured
    at them; points and partners are read once for each.
    """
    p, q = in_reports(points, spec, roi), in_reports(partners, spec, roi)
    own = stats._tagged(p, q, "report").unionByName(present_in_reports(ann, present, spec, mode).withColumn("tag", F.lit(3)))
    counts = stats._counts(own, "report", "body").drop("upstream")
    x = counts.join(ann.select("body", "status_rank"), "body", "left")
    every = windows.ranked_within(x, ["report"], ["status_rank", "synweight", "pre", "post"], "body", "rnk")
    r = upto(every, stop_at)
    both = q.select("report", "body_pre", "body_post")
    for side in ("pre", "post"):
        both = both.join(r.select("report", F.col("body").alias(f"body_{side}"), F.col("rnk").alias(f"r_{side}")), ["report", f"body_{side}"])
    captured = both.groupBy("report", F.greatest("r_pre", "r_post").alias("rnk")).agg(F.count("*").alias("conn"))
    x = shared.saved(r.join(captured, ["report", "rnk"], "left").na.fill(0, ["conn"]), "captured")
    sums = windows.running_within(x.select("*", *(F.col(c).alias(f"upto_{c}") for c in FAMILIES.values())), ["report"], "rnk", [f"upto_{c}" for c in FAMILIES.values()])
    totals = every.groupBy("report").agg(F.sum("pre").alias("all_pre"), F.sum("post").alias("all_post"), F.sum("downstream").alias("all_conn"))
    totals = totals.withColumn("all_synweight", F.col("all_post") + F.col("all_conn"))
    share = lambda c: F.try_divide(F.col(f"upto_{c}").cast("double"), F.col(f"all_{c}"))
    return sums.join(totals, "report").select("report", "rnk", "body", "status_rank", *FAMILIES.values(), *(share(c).alias(f) for f, c in FAMILIES.items()))


def decimated(curves: DataFrame, points: int = 20_000) -> DataFrame:
    """At most about `points` rows of each report's curve: the first, the last of each range of ranks, and the last of
    each status, so that ends and steps stand where they were. A range has at most 1/points of the report's ranks, so no
    row that is left out lies further from a kept one. One aggregation and two of its bounded results."""
    sizes = curves.groupBy("report").agg(F.max("rnk").alias("_n"))
    x = curves.join(sizes, "report").withColumn("_range", F.floor((F.col("rnk") - 1) * points / F.greatest("_n", F.lit(points))))
    row = F.struct(*(c for c in curves.columns if c != "report"))
    ends = x.groupBy("report", "_range").agg(F.max_by(row, "rnk").alias("_r")).select("report", "_r")
    first = curves.where("rnk = 1").select("report", row.alias("_r"))
    steps_ = curves.groupBy("report", "status_rank").agg(F.max_by(row, "rnk").alias("_r")).select("report", "_r")
    return ends.union(first).union(steps_).distinct().select("report", "_r.*")


def summaries(curves: DataFrame, counts: DataFrame, subsets: dict[str, list[str]]) -> DataFrame:
    """What the bar charts of capture show: (subset, report_index, report, family, cumulative, status_rank, value, PreSyn,
    PostSyn), for each subset its reports in order.

    Statuses better than the empty one that any report has; a report without one takes the value of the next better.
    Cumulative values, and their differences from the best status on. counts: syn_counts() by report.
    """
    s = by_status(curves.where(F.col("status_rank") > STATUS_RANK[""]), "report")
    long = s.select("report", "status_rank", F.explode(F.create_map(*(x for f in FAMILIES for x in (F.lit(f), F.coalesce(f, F.lit(0.0)))))).alias("family", "value"))
    whole = filled(long, ["report", "family"], "value")
    both = whole.withColumn("cumulative", F.lit(True)).unionByName(steps(whole, ["report", "family"], "value").withColumn("cumulative", F.lit(False)))
    listed = curves.sparkSession.createDataFrame([(name, k, r) for name, rs in subsets.items() for k, r in enumerate(rs)], "subset string, report_index int, report string")
    return both.join(listed, "report").join(counts, "report", "left").select("subset", "report_index", "report", "family", "cumulative", "status_rank", "value", "PreSyn", "PostSyn")


def by_status(curve: DataFrame, *keys: str) -> DataFrame:
    """The last point of the curve for each status."""
    stats = [c for c in curve.columns if c.startswith("traced_")]
    return curve.groupBy(*keys, "status_rank").agg(*(F.max_by(c, "rnk").alias(c) for c in stats))


def filled(stats: DataFrame, key: str | list[str], value: str) -> DataFrame:
    """Every key with every status that any has: missing ones take the value of the next better status, else 0. The
    scaffold has keys times statuses rows, both small."""
    keys = [key] if isinstance(key, str) else key
    scaffold = stats.groupBy(*keys).agg(F.lit(1).alias("one")).select(*keys).join(F.broadcast(stats.agg(F.collect_set("status_rank").alias("s"))), F.lit(True)).select(*keys, F.explode("s").alias("status_rank"))
    down = Window.partitionBy(*keys).orderBy(F.desc("status_rank"))
    x = scaffold.join(stats, [*keys, "status_rank"], "left")
    return x.select(*keys, "status_rank", F.coalesce(F.last(value, ignorenulls=True).over(down), F.lit(0.0)).alias(value))


def steps(stats: DataFrame, key: str | list[str], value: str) -> DataFrame:
    """Cumulative values by status as differences, from the best status on."""
    keys = [key] if isinstance(key, str) else key
    down = Window.partitionBy(*keys).orderBy(F.desc("status_rank"))
    return stats.select(*keys, "status_rank", (F.col(value) - F.lag(value, 1, 0.0).over(down)).alias(value))
