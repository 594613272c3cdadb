"""Configuration and command line of a snapshot."""

from __future__ import annotations

import argparse
import json
import os
from dataclasses import dataclass, field, fields

PRODUCTS = ("flat", "graph", "reports", "transmitters")


@dataclass
class Config:
    """What a snapshot reads, keeps and writes. Unknown keys are errors."""

    points: str = ""
    partners: str = ""
    annotations: str = ""
    elements: str = ""
    element_distances: str = ""
    element_kinds: list[str] = field(default_factory=list)
    sizes: str = ""
    transmitters: str = ""
    transmitter_names: list[str] = field(default_factory=list)
    transmitter_truth: str = ""
    transmitter_experimental: str = ""
    transmitter_override: dict[str, str] = field(default_factory=dict)
    output: str = "snapshot"
    dataset: str = "snapshot"
    tag: str = ""
    zone: str = ""
    min_confidence: float = 0.0
    high_accuracy: float = 0.0
    high_precision: float = 0.0
    keep_body_zero: bool = False
    annotated_bodies: bool = False
    roiset: str = ""
    roisets: list[str] = field(default_factory=list)
    roi_labels: dict[str, dict[str, int]] = field(default_factory=dict)
    roi_templates: dict[str, str] = field(default_factory=dict)
    parent_rois: dict[str, list] = field(default_factory=dict)
    region_flags: list[str] = field(default_factory=list)
    hierarchy: dict = field(default_factory=dict)
    primary_rois: list[str] = field(default_factory=list)
    meta: dict = field(default_factory=dict)
    replace_values: dict[str, dict[str, str]] = field(default_factory=dict)
    report_roiset: str = ""
    reports: dict[str, list[str]] = field(default_factory=dict)
    report_subsets: dict[str, list[str]] = field(default_factory=dict)
    report_bodies: str = "none"
    report_stop_at: int = 1_000_000
    report_points: int = 20_000
    property_names: dict[str, str] = field(default_factory=dict)
    node_files: int = 100
    graph_format: str = "csv"
    products: list[str] = field(default_factory=lambda: ["flat"])

    def __post_init__(self):
        if self.zone not in ("", "brain", "vnc"):
            raise ValueError(f"no such zone: {self.zone}")
        if unknown := set(self.products) - set(PRODUCTS):
            raise ValueError(f"no such products: {sorted(unknown)}")
        if self.graph_format not in ("csv", "parquet"):
            raise ValueError(f"no such format: {self.graph_format}")
        if self.report_bodies not in ("all", "element-presence", "none"):
            raise ValueError(f"no such choice of bodies: {self.report_bodies}")
        if unknown := {r for rs in self.report_subsets.values() for r in rs} - set(self.reports):
            raise ValueError(f"subsets of unknown reports: {sorted(unknown)}")
        if self.node_files < 1:
            raise ValueError("node_files is at least 1")
        if "reports" in self.products and not (self.report_roiset and self.reports):
            raise ValueError("reports need report_roiset and reports")
        if "transmitters" in self.products and not (self.transmitters and self.transmitter_names and self.transmitter_truth):
            raise ValueError("transmitters need transmitters, transmitter_names and transmitter_truth")

    @classmethod
    def load(cls, path: str, overrides: list[str] | None = None) -> Config:
        """From JSON, or from YAML where that library is present: sections as in settings.SCHEMA, or all fields flat.
        overrides are section.name=value texts, for sections only."""
        from . import settings

        with open(path) as f:
            if path.endswith((".yaml", ".yml")):
                try:
                    import yaml
                except ImportError as x:
                    raise ValueError("YAML settings need the yaml library; give JSON") from x
                given = yaml.safe_load(f) or {}
            else:
                given = json.load(f)
        if not isinstance(given, dict):
            raise ValueError("settings must be a section")
        if overrides or set(given) <= set(settings.SCHEMA):
            return settings.config(settings.override(given, overrides or []), os.path.dirname(os.path.abspath(path)))
        if unknown := set(given) - {x.name for x in fields(cls)}:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**given)


def prepared(spark, c: Config):
    """(points, partners, annotations) as the products take them: filtered, self-consistent, with bodies, confidences,
    compartments and regions at both ends. Partners take all columns from points in one join a side, and the result is
    saved once, as every output reads it."""
    from ..operators import annotations, labels, rois, synapses
    from ..sources import readers, shared

    points, partners = readers.with_point_ids(spark.read.parquet(c.points)), spark.read.parquet(c.partners)
    ann = readers.required(spark.read.parquet(c.annotations), "body")
    points, partners = synapses.drop_fake(synapses.check_kinds(points), partners)
    points, partners = synapses.in_zone(points, partners, c.zone)
    tables = {}
    for roiset in dict.fromkeys([*c.roi_labels, *c.roi_templates]):
        points, tables[roiset] = labels.loaded(points, roiset, c.roi_labels.get(roiset), c.roi_templates.get(roiset))
    if tables:
        labels.distinct_across(tables)
    parents = {k: (parent, names) for k, (parent, names) in c.parent_rois.items()}
    if parents and set(parents) <= set(tables):
        points, tables = labels.with_parent_labels(points, tables, parents)
    elif parents:
        points = rois.with_parents(points, parents)
    own = [x for x in ("conf", "body", "compartment") if x in points.columns]
    partners = synapses.with_ends(partners, points, *own, regions=[r for r in c.roisets if r in points.columns])
    points, partners = synapses.confident(points, partners, c.min_confidence)
    if not c.keep_body_zero:
        points, partners = synapses.drop_body_zero(points, partners)
    points, partners = synapses.self_consistent(points, partners)
    if c.replace_values:
        ann = annotations.replaced(ann, c.replace_values)
    return shared.saved(points, "points"), shared.saved(partners, "partners"), ann


def write(spark, c: Config) -> None:
    from ..operators import annotations, graph, labels
    from ..sources import readers, shared, sinks
    from . import products

    from . import settings

    spark.createDataFrame([(settings.resolved(c),)], "value string").coalesce(1).write.mode("overwrite").text(f"{c.output}/settings")
    points, partners, ann = prepared(spark, c)
    read = lambda p: spark.read.parquet(p) if p else None
    bodies = by_point = None
    elements = read(c.elements)
    elements = readers.with_point_ids(elements) if elements is not None else None
    if "transmitters" in c.products:
        out = products.neurotransmitters(read(c.transmitters), ann, read(c.transmitter_truth), read(c.transmitter_experimental), c.transmitter_names, c.transmitter_override)
        for name, df in out.items():
            sinks.parquet(df, f"{c.output}/transmitters/{name}")
        bodies = spark.read.parquet(f"{c.output}/transmitters/bodies").drop("cell_type")
        by_point = spark.read.parquet(f"{c.output}/transmitters/points")
        by_point = by_point.select("point_id", *c.transmitter_names) if "point_id" in by_point.columns else None
    if "flat" in c.products:
        for name, df in products.flat(points, partners, ann, c.roiset or None).items():
            sinks.parquet(df, f"{c.output}/flat/{name}")
        for name, df in products.annotations_of(ann, c.property_names).items():
            sinks.parquet(df, f"{c.output}/flat/{name}")
    if "reports" in c.products:
        present = annotations.presence(elements.withColumnRenamed("type", "element"), [c.report_roiset]) if elements is not None and c.report_roiset in elements.columns else None
        for name, df in products.completeness(points, partners, ann, c.report_roiset, c.reports, mode=c.report_bodies, present=present, subsets=c.report_subsets, stop_at=c.report_stop_at, plotted=c.report_points).items():
            sinks.parquet(df, f"{c.output}/reports/{name}")
    if "graph" in c.products:
        limits = {"conf": c.high_accuracy, "high_accuracy": c.high_accuracy, "high_precision": c.high_precision, "neuron": {"synweight": 100, "pre": 100, "post": 100}, "excluded": ["Unimportant", "Glia"]}
        tree = graph.loaded_hierarchy(c.hierarchy, lambda r: labels.region_list(points, r), readers.json_file) or {c.tag or "all": {r: None for r in c.roisets}}
        more = {"names": c.property_names, "point_transmitters": by_point, "elements": elements, "kinds": c.element_kinds, "distances": read(c.element_distances), "sizes": read(c.sizes), "transmitters": bodies, "flags": c.region_flags, "annotated": c.annotated_bodies}
        for name, df in products.property_graph(points, partners, ann, c.roisets, limits, c.dataset, c.tag, tree, c.primary_rois, c.meta, **more).items():
            if c.graph_format == "csv" and name == "segments":
                sinks.node_batches(shared.saved(df, "segments"), "rois", "segments", f"{c.output}/graph/{name}", c.node_files, measured=True)
            elif c.graph_format == "csv":
                sinks.importer_csv(df, name, f"{c.output}/graph/{name}")
            else:
                sinks.parquet(df, f"{c.output}/graph/{name}")
    shared.clean(spark)


def main(args: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    p = argparse.ArgumentParser(description="Write the products of a connectome snapshot.")
    p.add_argument("config", nargs="?")
    p.add_argument("-d", "--defaults", action="store_true", help="print the default settings")
    p.add_argument("-y", "--commented", action="store_true", help="print the default settings as YAML with what they are")
    p.add_argument("-m", "--meta", action="store_true", help="print the default properties of the Meta node")
    p.add_argument("-r", "--resolved", action="store_true", help="print the settings with all defaults, and write nothing")
    p.add_argument("-t", "--tag", action="store_true", help="print the snapshot's tag, and write nothing")
    p.add_argument("-f", "--folder", action="store_true", help="print the folder of the products, and write nothing")
    p.add_argument("-c", "--check", action="store_true", help="check the settings and write nothing")
    p.add_argument("-s", "--set", action="append", default=[], metavar="SECTION.NAME=VALUE", help="set one setting, as JSON or text")
    a = p.parse_args(args)
    from ..operators.graph import META
    from . import settings

    if a.commented:
        print(settings.commented())
    elif a.meta:
        print(json.dumps(META, indent=2))
    elif a.defaults or not a.config:
        print(settings.resolved(Config()))
    else:
        c = Config.load(a.config, a.set)
        if a.resolved:
            print(settings.resolved(c))
        elif a.tag or a.folder:
            print(c.tag if a.tag else c.output)
        elif not a.check:
            write(SparkSession.builder.getOrCreate(), c)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
