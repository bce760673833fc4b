"""Identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _joined(parts: list[Column]) -> Column:
    # concat, not concat_ws: a missing part makes the whole name null.
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit("."), part]
    return F.concat(*pieces)


def plain_name(*parts: Column) -> Column:
    """Dotted name without quoting."""
    return _joined(list(parts))


def quoted_name(*parts: Column) -> Column:
    """Dotted name, every part in back-quotes; embedded back-quotes doubled."""
    tick = F.lit("`")
    return _joined([F.concat(tick, F.replace(p, tick, F.lit("``")), tick) for p in parts])


def object_id(*parts: Column) -> Column:
    """Case-folded key of an object; a part holding a dot is quoted, so keys never clash."""
    folded = [F.upper(p) for p in parts]
    return _joined([F.when(p.contains("."), F.concat(F.lit('"'), p, F.lit('"'))).otherwise(p) for p in folded])


def with_destination(
    objects: DataFrame,
    lower: bool = True,
    *,
    catalog: str = "dst_cat",
    schema: str = "schema",
    name: str = "name",
) -> DataFrame:
    """Add the destination schema, name, and both spellings of the full name."""
    fold = F.lower if lower else (lambda c: c)
    out = objects.withColumns({"dst_schema": fold(F.col(schema)), "dst_name": fold(F.col(name))})
    parts = (F.col(catalog), F.col("dst_schema"), F.col("dst_name"))
    return out.withColumns({"dst_fq": quoted_name(*parts), "dst_plain": plain_name(*parts)})


def with_clash(objects: DataFrame, column: str = "n_same") -> DataFrame:
    """Add how many objects end at an object's destination, in any case: more than one must not be written."""
    at = F.lower("dst_plain")
    several = objects.groupBy(at.alias("_at")).agg(F.count(F.lit(1)).alias(column)).filter(F.col(column) > 1)
    counted = objects.join(several, at == F.col("_at"), "left")
    return counted.select(*objects.columns, F.coalesce(column, F.lit(1)).alias(column))
