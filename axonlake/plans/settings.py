"""Nested settings: sections with defaults, checked and filled in, overridden by the command, and written out as resolved."""

from __future__ import annotations

import json
import os
from dataclasses import MISSING, fields

from .config import Config

#: Section -> name -> (field of Config, what it is), or another section.
SCHEMA: dict = {
    "inputs": {
        "points": ("points", "synapse points: point_id or z, y, x; kind; body; conf; regions or their labels"),
        "partners": ("partners", "connections: pre_id and post_id"),
        "annotations": ("annotations", "bodies with status and other properties"),
        "sizes": ("sizes", "body sizes: body and size"),
        "zone": ("zone", "brain, vnc or nothing for both"),
        "min-confidence": ("min_confidence", "points and connections below it are left out"),
        "keep-body-zero": ("keep_body_zero", "keep points of body 0"),
        "replace-values": ("replace_values", "column -> value -> what replaces it, in annotations"),
        "elements": {
            "points": ("elements", "element points: body, type, regions"),
            "distances": ("element_distances", "source_id, target_id and perhaps distance"),
            "kinds": ("element_kinds", "types that are counted for each body"),
        },
        "transmitters": {
            "points": ("transmitters", "points with a score for each transmitter"),
            "names": ("transmitter_names", "the columns of the scores"),
            "truth": ("transmitter_truth", "cell_type and ground_truth"),
            "experimental": ("transmitter_experimental", "cell types whose transmitter is known"),
            "override": ("transmitter_override", "prediction -> what replaces it"),
        },
        "regions": {
            "roisets": ("roisets", "columns of regions; the first limits the graph"),
            "labels": ("roi_labels", "roiset -> region -> label, complete"),
            "templates": ("roi_templates", "roiset -> a name made from the label x"),
            "parents": ("parent_rois", "roiset -> [parent roiset, its regions]"),
            "hierarchy": ("hierarchy", "a tree of regions with one root"),
            "primary": ("primary_rois", "regions that are primary"),
        },
    },
    "outputs": {
        "products": ("products", "any of flat, graph, reports, transmitters"),
        "flat": {
            "roiset": ("roiset", "connections outside its regions are left out"),
            "property-names": ("property_names", "annotation column -> name in the export, empty to drop it"),
        },
        "graph": {
            "dataset": ("dataset", "name of the dataset"),
            "format": ("graph_format", "csv for the importer, or parquet"),
            "node-files": ("node_files", "at most so many batches of segments"),
            "high-accuracy": ("high_accuracy", "confidence from which a connection counts"),
            "high-precision": ("high_precision", "confidence from which it counts twice over"),
            "flags": ("region_flags", "regions that have a column of their own"),
            "annotated-bodies": ("annotated_bodies", "also bodies without synapses"),
            "meta": ("meta", "properties of the Meta node"),
        },
        "reports": {
            "roiset": ("report_roiset", "whose regions the reports list"),
            "reports": ("reports", "report -> its regions, none for all"),
            "subsets": ("report_subsets", "summary -> its reports in order"),
            "bodies": ("report_bodies", "annotated bodies without synapses: all, element-presence or none"),
            "stop-at": ("report_stop_at", "last rank of a curve"),
            "points": ("report_points", "points of a curve that is plotted"),
        },
    },
    "job": {
        "tag": ("tag", "version of the snapshot"),
        "output": ("output", "folder of the products"),
    },
}
#: Fields that are paths; relative ones are taken from the folder of the settings.
PATHS = ("points", "partners", "annotations", "sizes", "elements", "element_distances", "transmitters", "transmitter_truth", "transmitter_experimental", "output")


def _defaults() -> dict:
    return {f.name: f.default if f.default is not MISSING else f.default_factory() for f in fields(Config)}


def nested(values: dict, schema: dict = SCHEMA) -> dict:
    """Config values by section."""
    return {k: nested(values, v) if isinstance(v, dict) else values[v[0]] for k, v in schema.items()}


def flat(given: dict, schema: dict = SCHEMA, where: str = "") -> dict:
    """Config values from sections, which may leave anything out. Unknown names and values of another kind than the
    default are errors that say where."""
    if not isinstance(given, dict):
        raise ValueError(f"{where.rstrip('.') or 'settings'} must be a section")
    defaults, out = _defaults(), {}
    for k, v in given.items():
        if k not in schema:
            raise ValueError(f"unknown setting: {where}{k}; there are {', '.join(schema)}")
        if isinstance(schema[k], dict):
            out |= flat(v, schema[k], f"{where}{k}.") if v is not None else {}
            continue
        name = schema[k][0]
        out[name] = _checked(v, defaults[name], f"{where}{k}")
    return out


def _checked(value, default, where: str):
    """The value, if it is of the default's kind; an integer will do for a number, and null is the default."""
    if value is None:
        return default
    if isinstance(default, float) and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if not isinstance(value, type(default)) or isinstance(value, bool) != isinstance(default, bool):
        raise ValueError(f"{where} must be {type(default).__name__}, not {type(value).__name__}")
    return value


def override(given: dict, texts: list[str]) -> dict:
    """given with section.name=value texts applied; a value is JSON, or else a text."""
    out = json.loads(json.dumps(given))
    for text in texts:
        path, eq, value = text.partition("=")
        if not eq:
            raise ValueError(f"not a setting: {text}")
        *sections, name = path.split(".")
        at = out
        for s in sections:
            at = at.setdefault(s, {})
            if not isinstance(at, dict):
                raise ValueError(f"{s} in {path} is no section")
        try:
            at[name] = json.loads(value)
        except ValueError:
            at[name] = value
    return out


def config(given: dict, folder: str = "") -> Config:
    """The checked Config of nested settings; relative paths are taken from folder."""
    values = flat(given)
    for name in PATHS:
        p = values.get(name)
        if p and folder and "://" not in p and not p.startswith("file:") and not os.path.isabs(p):
            values[name] = os.path.join(folder, p)
    return Config(**values)


def resolved(c: Config) -> str:
    """All settings of c, given or not, as nested JSON that config() takes back."""
    return json.dumps(nested(c.__dict__), indent=2)


def commented(schema: dict = SCHEMA, depth: int = 0) -> str:
    """The defaults as YAML with what each setting is."""
    values, lines = _defaults(), []
    for k, v in schema.items():
        pad = "  " * depth
        if isinstance(v, dict):
            lines += [f"{pad}{k}:", commented(v, depth + 1)]
        else:
            lines += [f"{pad}# {v[1]}", f"{pad}{k}: {json.dumps(values[v[0]])}"]
    return "\n".join(lines)
