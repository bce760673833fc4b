"""Type correction of copied columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type names by what becomes of them, and the sizes that decide.
TIME_TYPES = ("TIME",)
NTZ_TYPES = ("TIMESTAMP_NTZ", "TIMESTAMP WITHOUT TIME ZONE")
NUMBER_TYPES = ("NUMBER", "DECIMAL", "NUMERIC")
DEFAULT_PRECISION = 38
INT_PRECISION = 9
# Characters of a time of day (HH:MM:SS), and of the date and blank before it in a timestamp's text.
TIME_LENGTH, DATE_LENGTH = 8, 11
TIME_TEXT = "time_text"


def type_plan(columns: DataFrame) -> DataFrame:
    """Target type per column, null where the source type stays.

    ``time_text`` is HH:MM:SS text. Whole numbers become ``int`` up to nine
    digits and ``bigint`` above; a missing or zero precision counts as 38.
    """
    kind = F.upper("data_type")
    precision = F.coalesce(F.nullif(F.col("numeric_precision"), F.lit(0)), F.lit(DEFAULT_PRECISION))
    whole = kind.isin(*NUMBER_TYPES) & (F.coalesce("numeric_scale", F.lit(0)) == 0)
    target = (
        F.when(kind.isin(*TIME_TYPES), TIME_TEXT)
        .when(kind.isin(*NTZ_TYPES), "timestamp_ntz")
        .when(whole & (precision <= INT_PRECISION), "int")
        .when(whole, "bigint")
    )
    return columns.withColumn("target_type", target)


def plans_by_table(plan: DataFrame, *keys: str) -> DataFrame:
    """Each table's plan as one ordered array.

    Grouped whole on purpose: a table's columns are a list it already holds as its schema.
    """
    entry = F.struct("column_ordinal", "column_name", "target_type")
    return plan.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("columns"))


def time_text(value: Column, kind: T.DataType) -> Column:
    first = DATE_LENGTH + 1 if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else 1
    return F.substring(value.cast("string"), first, TIME_LENGTH)


def _entries(plan: DataFrame | Iterable[Row]) -> list[Row]:
    # The plan of one table: as many rows as it has columns.
    rows = plan.collect() if isinstance(plan, DataFrame) else list(plan)
    return sorted(rows, key=lambda r: r.column_ordinal)


def _fitted(value: Column, kind: T.DataType, target: str) -> Column:
    """The value as ``target``, null where that cannot hold it: too large, not a number, or with a fraction."""
    cast = value.try_cast(target)
    if target not in ("int", "bigint") or isinstance(kind, T.IntegralType):
        return cast
    if isinstance(kind, T.StringType):
        # A text is read as a decimal first, so its fraction is seen as well.
        value = value.try_cast("decimal(38,18)")
        cast = value.try_cast(target)
    return F.when(cast == value, cast)


def _exact_cast(name: str, value: Column, kind: T.DataType, target: str) -> Column:
    cast = _fitted(value, kind, target)
    lost = F.concat(F.lit(f"column {name} does not fit {target}: "), value.cast("string"))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(lost).cast(target)).otherwise(cast)


def apply_type_plan(df: DataFrame, plan: DataFrame | Iterable[Row], strict: bool = True) -> DataFrame:
    """Select the planned columns in order, each cast to its target, in one pass.

    Columns the plan does not know follow unchanged; one it knows and the data
    lacks is an error. A value that does not fit its target, too large or with a fraction that would be
    lost, raises in any ANSI mode; with ``strict=False`` it becomes null (see :func:`overflow_counts`).
    """
    fields = {f.name.lower(): f for f in df.schema.fields}
    entries = _entries(plan)
    missing = [e.column_name for e in entries if e.column_name.lower() not in fields]
    if missing:
        raise ValueError(f"planned columns are not in the data: {missing}")
    out = []
    for entry in entries:
        field = fields.pop(entry.column_name.lower())
        value = F.col(f"`{field.name}`")
        if entry.target_type == TIME_TEXT:
            value = time_text(value, field.dataType)
        elif entry.target_type and strict:
            value = _exact_cast(field.name, value, field.dataType, entry.target_type)
        elif entry.target_type:
            value = _fitted(value, field.dataType, entry.target_type)
        out.append(value.alias(field.name))
    return df.select(*out, *[F.col(f"`{f.name}`") for f in fields.values()])


def overflow_counts(df: DataFrame, plan: DataFrame | Iterable[Row]) -> DataFrame:
    """How many values of each cast column its target cannot hold, in one scan; no rows for a plan without casts."""
    casts = [e for e in _entries(plan) if e.target_type and e.target_type != TIME_TEXT]
    if not casts:
        return df.sparkSession.createDataFrame([], "column_name string, n_overflow bigint")
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    counts, pairs = [], []
    for i, entry in enumerate(casts):
        value = F.col(f"`{entry.column_name}`")
        fitted = _fitted(value, kinds[entry.column_name.lower()], entry.target_type)
        counts.append(F.count_if(value.isNotNull() & fitted.isNull()).alias(f"c{i}"))
        pairs.append(F.struct(F.lit(entry.column_name).alias("column_name"), F.col(f"c{i}").alias("n_overflow")))
    return df.agg(*counts).select(F.inline(F.array(*pairs)))
