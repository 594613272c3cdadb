"""Differences between two annotation tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import cypher_literal, is_close

FLOATS = ("float", "double")


def comparable(new: DataFrame, old: DataFrame, key: str, excluded: tuple[str, ...] = ()) -> list[str]:
    """Columns that both have, in the new table's order."""
    return [c for c in new.columns if c in set(old.columns) - {key, *excluded}]


def _changed(c: str, floats: bool) -> Column:
    a, b = F.col(f"n.{c}"), F.col(f"o.{c}")
    same = a.eqNullSafe(b) | F.coalesce(is_close(a, b), F.lit(False)) if floats else a.eqNullSafe(b)
    return ~same


def change_mask(new: DataFrame, old: DataFrame, key: str, excluded: tuple[str, ...] = ()) -> DataFrame:
    """(key, column...): of the keys that both have, which columns changed; null equals null, floats compare closely;
    unchanged rows are left out."""
    cols, kinds = comparable(new, old, key, excluded), dict(new.dtypes)
    x = new.alias("n").join(old.alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"))
    mask = x.select(F.col(f"n.{key}").alias(key), *(_changed(c, kinds[c] in FLOATS).alias(c) for c in cols))
    return mask.where(reduce(lambda p, q: p | q, [F.col(c) for c in cols]))


def changed_cells(new: DataFrame, old: DataFrame, key: str, excluded: tuple[str, ...] = ()) -> DataFrame:
    """(key, column, old, new) as strings, one row for each changed cell."""
    cols, kinds = comparable(new, old, key, excluded), dict(new.dtypes)
    x = new.alias("n").join(old.alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"))
    cell = lambda c: F.when(_changed(c, kinds[c] in FLOATS), F.struct(F.lit(c).alias("column"), F.col(f"o.{c}").cast("string").alias("old"), F.col(f"n.{c}").cast("string").alias("new")))
    return x.select(F.col(f"n.{key}").alias(key), F.explode(F.array_compact(F.array(*map(cell, cols)))).alias("c")).select(key, "c.*")


def commands(new: DataFrame, old: DataFrame, key: str, dataset: str) -> DataFrame:
    """(key, command): the statement that sets each row's changed properties."""
    cols, kinds = comparable(new, old, key), dict(new.dtypes)
    x = new.alias("n").join(old.alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"))
    part = lambda c: F.when(_changed(c, kinds[c] in FLOATS), F.concat(F.lit(f"n.`{c}` = "), cypher_literal(F.col(f"n.{c}"), kinds[c])))
    sets = F.concat_ws(", ", *map(part, cols))
    y = x.select(F.col(f"n.{key}").alias(key), sets.alias("sets")).where("sets <> ''")
    return y.select(key, F.concat(F.lit(f"MATCH (n:`{dataset}_Segment` {{bodyId: "), F.col(key).cast("string"), F.lit("}) SET "), F.col("sets")).alias("command"))
