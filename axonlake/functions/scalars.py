"""Scalar building blocks as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import SIMPLE_STATUS, STATUS_RANK, UNSPECIFIED

AXIS = 21  # bits of a coordinate; three fill 63 bits, so ids are never negative


def rounded(x: Column, places: int) -> Column:
    """x rounded as SQL engines round doubles: scaled, then to the nearest whole number, halves away from zero. Spark's own
    round takes the shortest decimal form of x instead, which is a half where the scaled double is just below one."""
    return F.round(x * float(10**places)) / float(10**places)


def encode_point(z: Column, y: Column, x: Column) -> Column:
    """Point id with z most significant, so ids sort by z, y, x."""
    part = lambda c: c.cast("long").bitwiseAND(F.lit((1 << AXIS) - 1))
    return F.shiftleft(part(z), 2 * AXIS).bitwiseOR(F.shiftleft(part(y), AXIS)).bitwiseOR(part(x))


def decode_point(point_id: Column) -> dict[str, Column]:
    mask = F.lit((1 << AXIS) - 1)
    return {c: F.shiftright(point_id, k * AXIS).bitwiseAND(mask) for c, k in (("z", 2), ("y", 1), ("x", 0))}


def literal_map(mapping: dict, key: Column, default: Column | None = None) -> Column:
    """Look-up in a small mapping that is part of the plan; what is missing is null or the default."""
    if not mapping:
        return F.lit(None) if default is None else default
    found = F.element_at(F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv)), key)
    return found if default is None else F.coalesce(found, default)


def status_rank(status: Column) -> Column:
    return literal_map(STATUS_RANK, status)


def simple_status(status: Column) -> Column:
    """The simplified status; unknown labels stay, the empty one becomes null."""
    return F.nullif(literal_map(SIMPLE_STATUS, status, status), F.lit(""))


def fill_compartment(c: Column) -> Column:
    return F.coalesce(c, F.lit("unknown"))


def parent_fallback(child: Column, parent: Column, parent_rois: list[str]) -> Column:
    """The child region, or where that is unspecified and the parent is one of parent_rois, the parent's name with
    -unspecified before an optional (L) or (R)."""
    if any("unspecified" in r for r in parent_rois):
        raise ValueError("parent regions can't have 'unspecified' in their names")
    base, side = F.regexp_extract(parent, r"^(.+?)(\([LR]\))?$", 1), F.regexp_extract(parent, r"^(.+?)(\([LR]\))?$", 2)
    return F.when((child == UNSPECIFIED) & parent.isin(parent_rois), F.concat(base, F.lit("-unspecified"), side)).otherwise(child)


def side_of(name: Column) -> tuple[Column, Column]:
    """(base, side) of names that end in (L), (R), _L or _R; side C for the others."""
    side = F.regexp_extract(name, r"(?:\(([LR])\)|_([LR]))$", 1)
    other = F.regexp_extract(name, r"(?:\(([LR])\)|_([LR]))$", 2)
    found = F.concat(side, other)
    return F.regexp_replace(name, r"(?:\([LR]\)|_[LR])$", ""), F.when(found == "", F.lit("C")).otherwise(found)


def point_string(x: Column, y: Column, z: Column) -> Column:
    return F.format_string("{x:%d, y:%d, z:%d}", x, y, z)


def parse_point(text: Column) -> Column:
    """array<double> [x, y, z] from '1, 2, 3', '[1, 2, 3]', '{x: 1, y: 2, z: 3}' or a JSON object with coordinates;
    anything else is null."""
    number = r"[-+]?[0-9]+(?:\.[0-9]+)?"
    plain = text.rlike(rf"^\s*\[?\s*{number}\s*,\s*{number}\s*,\s*{number}\s*\]?\s*$")
    keyed = text.rlike(rf"^\s*\{{\s*x:\s*{number}\s*,\s*y:\s*{number}\s*,\s*z:\s*{number}\s*\}}\s*$")
    inner = F.regexp_extract(text, rf'"coordinates"\s*:\s*\[\s*({number}\s*,\s*{number}\s*,\s*{number})\s*\]', 1)
    source = F.when(plain | keyed, text).when(inner != "", inner)
    return F.transform(F.regexp_extract_all(source, F.lit(f"({number})"), F.lit(1)), lambda v: v.cast("double"))


_TEMPLATE = re.compile(r"\{\s*x\s*(?:(//|%|\+|-|\*)\s*([0-9]+)\s*)?\}")


def label_template(template: str, label: Column) -> Column:
    """A name from a template on x such as 'ME_R_col_{x // 100}_{x % 100}', compiled from a small grammar."""
    parts, at = [], 0
    for m in _TEMPLATE.finditer(template):
        parts.append(F.lit(template[at : m.start()]))
        x, n = label.cast("long"), int(m[2] or 0)
        value = {None: x, "//": F.floor(x / n) if n else x, "%": F.pmod(x, F.lit(n or 1)), "+": x + n, "-": x - n, "*": x * n}[m[1]]
        parts.append(value.cast("long").cast("string"))
        at = m.end()
    rest = template[at:]
    if "{" in rest or "}" in rest or not parts:
        raise ValueError(f"not a template on x: {template}")
    return F.concat(*parts, F.lit(rest))


def label_formula(formula: str, label: Column) -> Column:
    """An integer property of a label such as 'x // 100'; null for label 0."""
    m = _TEMPLATE.fullmatch("{" + formula + "}")
    if not m:
        raise ValueError(f"not a formula on x: {formula}")
    return F.when(label != 0, label_template("{" + formula + "}", label).cast("long"))


def rescaled(c: Column, factor: float) -> Column:
    return (c * factor).cast("int")


def integral(c: Column) -> Column:
    """A float as a long where it is integral, else null."""
    return F.when(c % 1 == 0, c.cast("long"))


def argmax_name(values: Column, names: list[str]) -> Column:
    """Name of the greatest value, the first of ties; NaN and null count as missing, all missing gives null."""
    clean = F.transform(values, lambda v: F.when(~F.isnan(v), v))
    top = F.array_max(clean)
    return F.when(top.isNotNull(), F.element_at(F.array(*(F.lit(n) for n in names)), F.array_position(clean, top).cast("int")))


def is_close(a: Column, b: Column) -> Column:
    """Numbers as good as equal: |a - b| <= 1e-8 + 1e-5 |b|."""
    return F.abs(a - b) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(b)


def local_time(seconds: Column, zone: str) -> Column:
    return F.from_utc_timestamp(F.timestamp_seconds(seconds), zone)


def cypher_literal(c: Column, kind: str) -> Column:
    """A value as it is written in a Cypher command."""
    if kind == "string":
        return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.coalesce(c.cast("string"), F.lit("null"))


def camel_case(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w[:1].upper() + w[1:] for w in rest)


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def lower_boolean(c: Column) -> Column:
    """true or false as the importer spells them; null stays null."""
    return F.when(c, F.lit("true")).when(~c, F.lit("false"))


def range_of(key: Column, lows: list[int]) -> Column:
    """Which of the ranges that begin at lows (ascending) holds the key, from 0: a binary search by halving steps. Keys
    below the first are in it; null for null."""
    steps = [1 << k for k in range(max(1, len(lows)).bit_length() - 1, -1, -1)]
    table = F.lit(list(lows))
    place = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(F.get(table, at + step) <= key, at + step).otherwise(at))
    return F.when(key.isNotNull(), place)
