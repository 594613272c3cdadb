"""Region labels: stable, complete and one-to-one, or an error."""

import pytest

from axonlake.operators import labels

U = "<unspecified>"


def table(df):
    return {r.roi: r.label for r in df.collect()}


def points(spark, names, more="roi"):
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], f"point_id long, {more} string")


def test_labels_stay_and_new_ones_follow(spark):
    first = labels.allocated(labels.names_in(points(spark, ["ME", None, "LO", "ME"]), "roi"), labels.table_of(spark, {}))
    assert table(first) == {U: 0, "LO": 1, "ME": 2}
    later = labels.allocated(labels.names_in(points(spark, ["AL", "ME", "ZZ"]), "roi"), first)
    assert table(later) == {U: 0, "LO": 1, "ME": 2, "AL": 3, "ZZ": 4}
    assert table(labels.allocated(labels.names_in(points(spark, ["a"]), "roi"), labels.table_of(spark, {"x": 70}))) == {"x": 70, "a": 71}
    assert table(labels.allocated(labels.names_in(points(spark, []), "roi"), labels.table_of(spark, {}))) == {}


@pytest.mark.parametrize("ids", [{"ME": 1, "LO": 1}, {"ME": 0, "LO": 2}, {"ME": 1, "LO": None}, {"ME": 1, "LO": 2, U: 3}])
def test_bad_tables_fail(spark, ids):
    with pytest.raises(Exception, match="not one-to-one"):
        labels.labelled(points(spark, ["ME"]), "roi", labels.table_of(spark, ids)).collect()


def test_loaded(spark):
    p, t = labels.loaded(points(spark, ["ME", None, "LO"]), "roi", {"ME": 5, "LO": 3})
    assert [(r.roi, r.roi_label) for r in p.orderBy("point_id").collect()] == [("ME", 5), (U, 0), ("LO", 3)] and table(t) == {U: 0, "ME": 5, "LO": 3}
    with pytest.raises(Exception, match="has no label: LO"):
        labels.loaded(points(spark, ["ME", "LO"]), "roi", {"ME": 5})[0].collect()
    q = spark.createDataFrame([(1, 12), (2, 0), (3, None)], "point_id long, roi_label int")
    p, t = labels.loaded(q, "roi", template="col_{x // 5}")
    assert {r.point_id: (r.roi, r.roi_label) for r in p.collect()} == {1: ("col_2", 12), 2: (U, 0), 3: (U, 0)}
    p, _ = labels.loaded(q, "roi", {"A": 12})
    assert {r.point_id: r.roi for r in p.collect()} == {1: "A", 2: U, 3: U}
    with pytest.raises(Exception, match="has no name: 12"):
        labels.loaded(q, "roi", {"A": 11})[0].collect()
    with pytest.raises(Exception, match="not one-to-one"):  # a template that gives one name to two labels
        labels.loaded(spark.createDataFrame([(1, 12), (2, 13)], "point_id long, roi_label int"), "roi", template="col_{x // 5}")[0].collect()
    for bad in ({"roiset": "other"}, {"roiset": "roi", "template": "c{x}"}):
        with pytest.raises(ValueError):
            labels.loaded(points(spark, ["ME"]), **bad)
    with pytest.raises(ValueError):
        labels.loaded(q, "roi")


def test_renamed_and_duplicates(spark):
    p, t = labels.loaded(points(spark, ["ME", "LO"]), "roi")
    p, t = labels.renamed(p, "roi", t, {"ME": "Medulla"})
    assert table(t) == {"LO": 1, "Medulla": 2} and {(r.roi, r.roi_label) for r in p.collect()} == {("Medulla", 2), ("LO", 1)}
    with pytest.raises(Exception, match="not one-to-one"):
        labels.renamed(p, "roi", t, {"LO": "Medulla"})[1].collect()
    labels.distinct_across({"a": labels.table_of(spark, {"x": 1, U: 0}), "b": labels.table_of(spark, {"y": 1, U: 0})})
    with pytest.raises(ValueError, match="x"):
        labels.distinct_across({"a": labels.table_of(spark, {"x": 1}), "b": labels.table_of(spark, {"x": 2})})


def test_parents_in_order(spark):
    rows = [(1, "Brain", "ME(R)", "L1"), (2, "Brain", U, U), (3, "VNC", "ANm", U), (4, "VNC", U, U), (5, U, U, U), (6, "MB(R)", U, U)]
    p = spark.createDataFrame(rows, "point_id long, shell string, primary string, sub string")
    tables = {}
    for r in ("shell", "primary", "sub"):
        p, tables[r] = labels.loaded(p, r)
    p, tables = labels.with_parent_labels(p, tables, {"sub": ("primary", ["ANm"]), "primary": ("shell", ["Brain", "VNC", "MB(R)"])})
    assert table(tables["primary"]) == {U: 0, "ANm": 1, "ME(R)": 2, "Brain-unspecified": 3, "MB-unspecified(R)": 4, "VNC-unspecified": 5}
    got = {r.point_id: (r.primary, r.primary_label, r.sub, r.sub_label) for r in p.collect()}
    assert got[2] == ("Brain-unspecified", 3, U, 0) and got[3] == ("ANm", 1, "ANm-unspecified", 2) and got[5] == (U, 0, U, 0) and got[6][1] == 4
    q, own = labels.loaded(p.where("point_id = 4").select("point_id", "shell").withColumn("primary", p["shell"]).withColumn("primary", labels.F.lit(U)), "primary")
    q, own = labels.with_parent_labels(q, {"primary": own}, {"primary": ("shell", ["VNC"])})
    assert table(own["primary"]) == {"VNC-unspecified": 1} and q.first().primary_label == 1
