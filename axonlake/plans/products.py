"""The four products of a snapshot: flat connectome, property graph, completeness reports, neurotransmitters.

Each function returns named DataFrames that run when they are written, but for ranks, which are taken by ranges of a
table that is saved when the function is called. Outputs that share labelled points and partners read the same frames,
which a caller may persist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import SIGNIFICANT, TRACED
from ..operators import annotations, connectome, graph, nt, reports, stats, synapses
from ..sources import shared


def flat(points: DataFrame, partners: DataFrame, ann: DataFrame, roiset: str | None = None) -> dict[str, DataFrame]:
    """Points, partners, weights (all, significant, traced) and ranked body counts."""
    if roiset:
        points, partners = synapses.in_region(points, partners, roiset)
    out = {"points": points, "partners": partners, "weights": connectome.weighted(partners, compartments=True)}
    for name, least in (("significant", SIGNIFICANT), ("traced", TRACED)):
        some = connectome.of_status(partners, ann, least)
        out |= {f"partners-{name}": some, f"weights-{name}": connectome.with_types(connectome.weighted(some, compartments=True), ann)}
    return out | {"body-stats": stats.ranked(stats.body_stats(points, partners), ann)}


def property_graph(
    points: DataFrame,
    partners: DataFrame,
    ann: DataFrame,
    roisets: list[str],
    limits: dict,
    dataset: str,
    tag: str,
    tree: dict,
    primary: list[str] | None = None,
    meta: dict | None = None,
    elements: DataFrame | None = None,
    kinds: list[str] | None = None,
    distances: DataFrame | None = None,
    sizes: DataFrame | None = None,
    transmitters: DataFrame | None = None,
    flags: list[str] | None = None,
    annotated: bool = False,
    point_transmitters: DataFrame | None = None,
    names: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Nodes and edges. Totals come before, edges after connections outside the main roiset are left out. Elements and
    their distances give element nodes, sets and CloseTo edges; transmitters are columns of bodies, point_transmitters of
    synapses (by point_id). Node properties are in camel case but for names, which override that."""
    points, partners = synapses.drop_body_zero(points, partners)
    by_region = stats.body_region_stats(points, partners, roisets)
    segments = graph.segments(points, partners, ann, roisets, limits["conf"], limits["neuron"], limits["excluded"], flags, elements, kinds, sizes, transmitters, annotated)
    as_nodes = lambda df, *fixed: graph.exported(df, dataset, names, (*fixed, *roisets, *(flags or []), "rois"))
    nodes = as_nodes(segments, *(kinds or []))
    node = graph.meta(stats.dataset_totals(by_region), stats.region_totals(by_region), dataset, tag, tree, primary or list(tree), {n.split(":")[0]: n.split(":")[1] for n in graph.typed_names(nodes, {}).values()}, **(meta or {}))
    points, partners = synapses.in_region(points, partners, roisets[0])
    weights = graph.connects_to(partners, limits["high_accuracy"], limits["high_precision"], roisets)
    out = {
        "segments": nodes,
        "meta": node,
        "connections": weights,
        "sets": graph.synapse_sets(weights),
        "set_to_set": graph.set_to_set(weights),
        "neuron_to_set": graph.neuron_to_set(weights),
        "set_to_synapse": graph.set_to_synapse(partners),
        "synapses": as_nodes(graph.synapses(points, roisets, flags, point_transmitters).withColumn("label", F.lit("Synapse;Element"))),
        "synapse_connections": partners.select("pre_id", "post_id"),
    }
    if elements is None:
        return out
    sets, body_sets, set_elements = graph.element_sets(elements, segments)
    out |= {"elements": as_nodes(graph.elements(elements, [r for r in roisets if r in elements.columns]).withColumn("label", F.lit("Element"))), "element_sets": sets.select("id", "type"), "neuron_to_element_set": body_sets, "element_set_to_element": set_elements}
    return out if distances is None else out | {"close_to": graph.close_to(distances)}


def completeness(
    points: DataFrame,
    partners: DataFrame,
    ann: DataFrame,
    roi: str,
    spec: dict[str, list[str]],
    least: int = SIGNIFICANT,
    mode: str = "none",
    present: DataFrame | None = None,
    subsets: dict[str, list[str]] | None = None,
    stop_at: int = 1_000_000,
    plotted: int = 20_000,
) -> dict[str, DataFrame]:
    """Of all reports together, each table keyed by report: synapse counts, downstream capture, the curves (whole and at
    most `plotted` points of each), their values at each status, and the summaries of all reports and of subsets in
    their order. The curves are saved once, as three outputs read them."""
    inside = reports.in_reports(points, spec, roi)
    captured = reports.in_reports(reports.with_capture(partners, ann, least), spec, roi)
    counts = reports.syn_counts(inside, "report")
    curves = shared.saved(reports.forecast(points, partners, ann, spec, roi, mode, present, stop_at), "curves")
    return {
        "syn-counts": counts,
        "capture": reports.downstream_capture(captured, "report"),
        "curves": curves,
        "curves-plotted": reports.decimated(curves, plotted),
        "status": reports.by_status(curves, "report"),
        "summaries": reports.summaries(curves, counts, {roi: list(spec), **(subsets or {})}),
    }


def neurotransmitters(points: DataFrame, ann: DataFrame, truth: DataFrame, experimental: DataFrame, names: list[str], override: dict[str, str]) -> dict[str, DataFrame]:
    """Confusion matrix, the predictions of points and of bodies with consensus, and bodies in several parts of the split."""
    p = nt.predicted(points, names, names)
    matrix = nt.confusion(nt.not_training(p), truth, names)
    bodies, types = (nt.group_predictions(p, ann, matrix, g) for g in ("body", "cell_type"))
    bodies, types = nt.erased(bodies, types)
    return {"confusion": matrix, "points": p, "multi-split-bodies": nt.multi_split(points), "bodies": nt.with_consensus(nt.with_type_predictions(bodies, types), override, experimental)}


def annotations_of(ann: DataFrame, explicit: dict[str, str]) -> dict[str, DataFrame]:
    """Annotations under export names; with status, the bodies by status."""
    out = {"body-annotations": annotations.graph_annotations(ann, explicit)}
    return out | ({"status-counts": annotations.status_counts(ann)} if {"status", "status_rank"} <= set(ann.columns) else {})
