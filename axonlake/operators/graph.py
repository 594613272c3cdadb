"""Property-graph nodes and edges."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import camel_case, decode_point, literal_map, point_string
from . import connectome, stats, windows


def synset_ids() -> tuple[Column, Column]:
    pair = F.concat_ws("_", F.col("body_pre").cast("string"), F.col("body_post").cast("string"))
    return F.concat(pair, F.lit("_pre")), F.concat(pair, F.lit("_post"))


def is_neuron(thresholds: dict[str, int], properties: list[str], statuses: list[str], excluded: list[str]) -> Column:
    """Any count at its threshold, any listed property, or a listed status, and no excluded status."""
    tests = [F.coalesce(F.col(c) >= n, F.lit(False)) for c, n in thresholds.items()] + [F.col(p).isNotNull() for p in properties] + [F.coalesce(F.col("status").isin(statuses), F.lit(False))]
    some = tests[0]
    for t in tests[1:]:
        some = some | t
    return some & ~F.coalesce(F.col("status").isin(excluded), F.lit(False))


def region_flags(names: Column, rois: list[str]) -> list[Column]:
    """A column for each region: true where the comma-joined names hold it, else null."""
    held = F.split(names, ",")
    return [F.when(F.array_contains(held, r), F.lit(True)).alias(r) for r in rois]


def segments(
    points: DataFrame,
    partners: DataFrame,
    ann: DataFrame,
    roisets: list[str],
    min_conf: float,
    thresholds: dict[str, int],
    excluded: list[str],
    flags: list[str] | None = None,
    elements: DataFrame | None = None,
    kinds: list[str] | None = None,
    sizes: DataFrame | None = None,
    transmitters: DataFrame | None = None,
    annotated: bool = False,
) -> DataFrame:
    """Segment nodes: counts (the confidence limit holds for partners only), annotations, regions (names, JSON counts, a
    flag for each region in flags) and the label; with elements their counts in all and by kind, with sizes the size,
    with transmitters those columns, which replace annotations of the same name. annotated keeps bodies that only ann
    has, with zero counts."""
    sure = partners.where(F.col("conf_post") >= min_conf)
    by_region = stats.body_region_stats(points, sure, roisets)
    regions = stats.regions(by_region)
    x = stats.body_stats(points, sure)
    if annotated:
        x = x.join(ann.select("body").distinct(), "body", "full").na.fill(0, list(stats.COUNTS))
    if elements is not None:
        x = x.join(stats.element_counts(elements, kinds or []), "body", "left").na.fill(0, ["total", *(kinds or [])])
    if transmitters is not None:
        ann = ann.drop(*(c for c in transmitters.columns if c != "body"))
    for more in (regions, ann, transmitters, sizes):
        x = x if more is None else x.join(more, "body", "left")
    neuron = is_neuron(thresholds, ["type"], [], excluded)
    return x.select("*", *region_flags(F.col("rois"), flags or []), F.when(neuron, F.lit("Segment;Neuron")).otherwise(F.lit("Segment")).alias("label"))


def dataset_labels(label: Column, dataset: str) -> Column:
    """Labels joined by semicolons, each followed by the dataset's own form of it."""
    return F.array_join(F.transform(F.split(label, ";"), lambda x: F.concat(x, F.lit(f";{dataset}_"), x)), ";")


def exported(nodes: DataFrame, dataset: str, names: dict[str, str] | None = None, fixed: tuple[str, ...] = ()) -> DataFrame:
    """Nodes as the importer gets them: labels with the dataset's own, bodyId beside the key body, and properties in camel
    case; names override that (an empty one drops the column), and fixed columns, such as regions, keep theirs. Two
    columns can't get one name."""
    given, key = names or {}, [c for c in ("body", "point_id") if c in nodes.columns][:1]
    as_is = {*fixed, *key, "label"}
    out = {c: given.get(c, c if c in as_is else camel_case(c)) for c in nodes.columns}
    kept = [n for n in out.values() if n]
    if twice := sorted({n for n in kept if kept.count(n) > 1}):
        raise ValueError(f"several columns would be {twice}")
    own = [F.col("body").alias("bodyId")] if key == ["body"] and "bodyId" not in kept else []
    value = lambda c: dataset_labels(F.col(c), dataset) if c == "label" else F.col(c)
    return nodes.select(*(value(c).alias(n) for c, n in out.items() if n), *own)


def connects_to(partners: DataFrame, high_accuracy: float, high_precision: float, roisets: list[str] | None = None) -> DataFrame:
    """ConnectsTo edges between bodies other than 0, with confidence and compartment weights; with roisets also roiInfo,
    the counts by region of connections from high_accuracy on."""
    x = partners.where("body_pre <> 0 AND body_post <> 0")
    weights = connectome.confidence_weights(x, high_accuracy, high_precision, compartments=True)
    if not roisets:
        return weights
    info = connectome.pair_region_info(x, roisets, high_accuracy)
    return weights.join(info, ["body_pre", "body_post"], "left").na.fill("{}", ["roiInfo"])


def synapse_sets(weights: DataFrame) -> DataFrame:
    pre, post = synset_ids()
    return weights.select(F.explode(F.array(pre, post)).alias("id"))


def set_to_set(weights: DataFrame) -> DataFrame:
    pre, post = synset_ids()
    return weights.select(pre.alias("start_id"), post.alias("end_id"))


def neuron_to_set(weights: DataFrame) -> DataFrame:
    pre, post = synset_ids()
    return weights.select(F.explode(F.array(F.struct(F.col("body_pre").alias("body"), pre.alias("id")), F.struct(F.col("body_post").alias("body"), post.alias("id")))).alias("e")).select("e.body", "e.id")


def set_to_synapse(partners: DataFrame) -> DataFrame:
    """Post sets hold their connections' post points; pre sets each pre point once."""
    pre, post = synset_ids()
    first = partners.dropDuplicates(["pre_id", "body_post"]).select(pre.alias("id"), F.col("pre_id").alias("point_id"))
    return first.union(partners.select(post.alias("id"), F.col("post_id").alias("point_id")))


def _location() -> Column:
    return point_string(F.col("x"), F.col("y"), F.col("z")).alias("location")


def _regions(roisets: list[str], flags: list[str]) -> list[Column]:
    """The region columns themselves, and a flag for each region in flags, true where a point lies in it."""
    return [F.col(r) for r in roisets] + [F.when(F.array_contains(F.array(*roisets), r), F.lit(True)).alias(r) for r in flags]


def synapses(points: DataFrame, roisets: list[str], flags: list[str] | None = None, transmitters: DataFrame | None = None) -> DataFrame:
    """Synapse nodes: type, label, confidence and body if points have them, the location, regions; transmitter columns by
    point."""
    kind = F.when(F.col("kind") == "PreSyn", F.lit("pre")).otherwise(F.lit("post"))
    at = decode_point(F.col("point_id"))
    x = points if {"x", "y", "z"} <= set(points.columns) else points.select("*", *(at[c].alias(c) for c in "zyx" if c not in points.columns))
    more = [F.col(c).alias(n) for c, n in (("conf", "confidence"), ("body", "bodyId")) if c in points.columns]
    y = x.select("point_id", kind.alias("type"), F.lit("Synapse").alias("label"), *more, _location(), *_regions(roisets, flags or []))
    return y if transmitters is None else y.join(transmitters, "point_id", "left")


def elements(points: DataFrame, roisets: list[str] | None = None, flags: list[str] | None = None) -> DataFrame:
    """Element nodes: type, location and regions."""
    return points.select("point_id", "type", _location(), *_regions(roisets or [], flags or []))


def close_to(distances: DataFrame) -> DataFrame:
    """CloseTo edges from element distances; a missing distance is that of the points."""
    a, b = (decode_point(F.col(c)) for c in ("source_id", "target_id"))
    far = F.sqrt(sum((F.pow((a[c] - b[c]).cast("double"), F.lit(2.0)) for c in "zyx"), F.lit(0.0)))
    given = F.col("distance").cast("double") if "distance" in distances.columns else F.lit(None).cast("double")
    return distances.select("source_id", "target_id", F.coalesce(given, far).alias("distance"))


def element_sets(points: DataFrame, bodies: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, body to set, set to element): a set for each body and type; bodies hold theirs if they are segments."""
    named = points.withColumn("id", F.concat_ws("_", F.col("body").cast("string"), "type"))
    sets = named.select("id", "body", "type").dropDuplicates(["id"])
    return sets, sets.join(bodies.select("body").distinct(), "body", "left_semi").select("body", "id"), named.select("id", "point_id")


def batches(df: DataFrame, key: str, size: int = 10_000) -> DataFrame:
    """Batch numbers of keys in order, size keys each."""
    numbered = windows.ranked(df.select(key).distinct(), [], key, "batch")
    return df.join(numbered.withColumn("batch", F.floor((F.col("batch") - 1) / size)), key)


#: Graph type suffixes by Spark type.
SUFFIXES = {"string": "string", "boolean": "boolean", "float": "float", "double": "float", "tinyint": "int", "smallint": "int", "int": "int", "bigint": "long", "array<string>": "string[]", "array<double>": "float[]", "array<float>": "float[]", "array<int>": "int[]", "array<bigint>": "int[]"}


def typed_names(df: DataFrame, special: dict[str, str], measured: bool = False) -> dict[str, str]:
    """Column -> header for the bulk importer; special headers (ids, labels) win. measured: longs whose values all fit
    into an int are ints; their extremes come from one pass over the table."""
    kinds = {c: SUFFIXES.get(t, "string") for c, t in df.dtypes}
    longs = [c for c, k in kinds.items() if k == "long" and c not in special]
    if measured and longs:
        most = df.agg(*(F.max(F.abs(c)).alias(c) for c in longs)).first()
        kinds |= {c: "int" for c in longs if (most[c] or 0) < 1 << 31}
    return {c: special.get(c, f"{c}:{k}") for c, k in kinds.items()}


def for_csv(df: DataFrame, special: dict[str, str], measured: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """df with importer headers and arrays joined by semicolons, but for the columns in keep."""
    names, kinds = typed_names(df, special, measured), dict(df.dtypes)
    value = lambda c: F.array_join(F.col(c).cast("array<string>"), ";") if kinds[c].startswith("array") and c not in keep else F.col(c)
    return df.select(*(value(c).alias(n) for c, n in names.items()))


def hierarchy(tree: dict) -> dict:
    """{A: {B: None}} as {name: A, children: [{name: B}]}; there must be one root."""
    def node(name, children):
        return {"name": name, **({"children": [node(n, c) for n, c in children.items()]} if children else {})}

    if len(tree) != 1:
        raise ValueError("a hierarchy has one root")
    return node(*next(iter(tree.items())))


def loaded_hierarchy(tree, regions: Callable[[str], list[str]], read: Callable[[str], object]) -> dict | None:
    """A tree of regions from what settings may give: nested dicts, a list of leaves, roiset://NAME for all regions of a
    roiset, or the name of a .json file that holds any of these. Empty ones are None."""
    if tree is None or tree == {}:
        return None
    if isinstance(tree, str):
        if tree.startswith("roiset://"):
            return {r: None for r in regions(tree.removeprefix("roiset://"))}
        if tree.endswith(".json"):
            return loaded_hierarchy(read(tree), regions, read)
        raise ValueError(f"no such hierarchy: {tree}")
    if isinstance(tree, dict):
        return {k: loaded_hierarchy(v, regions, read) for k, v in tree.items()}
    if isinstance(tree, list):
        return {k: None for k in tree}
    raise ValueError(f"no such hierarchy: {tree!r}")


def parents(tree: dict, above: str | None = None) -> dict[str, str | None]:
    out = {}
    for name, children in tree.items():
        out[name] = above
        out |= parents(children or {}, name)
    return out


#: The properties of the Meta node that a configuration gives, and what they are without one.
META = {
    "hideDataSet": False, "voxelSize": [8.0, 8.0, 8.0], "voxelUnits": "nanometers", "info": "", "logo": "", "description": "", "meshHost": "",
    "postHighAccuracyThreshold": 0.0, "preHPThreshold": 0.0, "postHPThreshold": 0.0, "nonHierarchicalROIs": [], "overviewRois": [], "overviewOrder": "clustered",
    "neuronColumnsVisible": ["bodyId", "type", "status"], "uuid": "unknown", "latestMutationId": 0, "lastDatabaseEdit": "unknown",
}


def region_properties(by_region: DataFrame, tree: dict, primary: list[str], nerves: list[str], hidden: list[str], told: dict[str, str]) -> DataFrame:
    """(roi, info) of every region that has counts, in the order of names: description, flags, parent, counts."""
    is_in = lambda names: F.col("roi").isin(names) if names else F.lit(False)
    fields = F.struct(
        F.coalesce(literal_map(told, F.col("roi")), F.lit("")).alias("description") if told else F.lit("").alias("description"),
        is_in(hidden).alias("excludeFromOverview"),
        is_in(nerves).alias("isNerve"),
        is_in(primary).alias("isPrimary"),
        literal_map({k: v for k, v in parents(tree).items() if v} or {"": ""}, F.col("roi")).alias("parent"),
        "post",
        "pre",
    )
    return by_region.select("roi", fields.alias("info"))


def meta(totals: DataFrame, by_region: DataFrame, dataset: str, tag: str, tree: dict, primary: list[str], columns: dict[str, str] | None = None, shown: list[dict] | None = None, nerves: list[str] | None = None, hidden: list[str] | None = None, told: dict[str, str] | None = None, **given) -> DataFrame:
    """One row with the 27 properties of the Meta node. columns: the segments' properties and their types; shown: the
    neuron columns in order, whose visible and name are filled in; given overrides META. Region totals are folded into
    JSON in Spark."""
    if unknown := set(given) - set(META):
        raise ValueError(f"no such properties: {sorted(unknown)}")
    fixed = META | given
    visible = fixed["neuronColumnsVisible"]
    ordered = [{**c, "visible": c["id"] in visible, "name": c.get("name") or c["id"]} for c in shown or []]
    as_text = {k: json.dumps(v) if k == "neuronColumnsVisible" else ";".join(map(str, v)) if isinstance(v, list) else v for k, v in fixed.items()}
    names = ";".join(sorted(primary))
    own = {"dataset": dataset, "tag": tag, "primaryRois": names, "superLevelRois": names, "roiHierarchy": json.dumps(hierarchy(tree)), "neuronProperties": json.dumps(columns or {}), "neuronColumnsOrdered": json.dumps([{k: v for k, v in c.items() if k != "description" or v} for c in ordered])}
    regions = region_properties(by_region, tree, primary, nerves or [], hidden or [], told or {})
    info = regions.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("roi", "info"))))).alias("roiInfo"))
    x = totals.select(F.col("pre").alias("totalPreCount"), F.col("post").alias("totalPostCount")).join(F.broadcast(info), F.lit(True))
    return x.select(*(F.lit(v).alias(k) for k, v in (own | as_text).items()), "totalPreCount", "totalPostCount", "roiInfo")


def index_plan(columns: list[str], rois: list[str], excluded: list[str]) -> dict[str, list[str]]:
    """Properties and regions to index."""
    return {"properties": [c for c in columns if c not in {*excluded, "bodyId", "body"}], "rois": sorted(set(rois) - set(excluded))}


def index_script(dataset: str, plan: dict[str, list[str]]) -> str:
    """Cypher statements that create the indexes."""
    out = [f"CREATE CONSTRAINT IF NOT EXISTS FOR (n:`{dataset}_Neuron`) REQUIRE n.bodyId IS UNIQUE;"]
    for label in ("Neuron", "Segment"):
        out += [f"CREATE INDEX IF NOT EXISTS FOR (n:`{dataset}_{label}`) ON (n.`{p}`);" for p in plan["properties"] + plan["rois"]]
    return "\n".join(out)
