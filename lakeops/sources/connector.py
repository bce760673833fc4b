"""Scans through a warehouse connector, or of a catalog the session can name.

``fmt`` is any Spark data source that takes ``query`` and ``dbtable`` options
(``jdbc`` or a vendor's own). With ``fmt=None`` the source is a federated
catalog, and the same calls go through Spark's own catalog.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce
from itertools import pairwise

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.typing_plan import TIME_TEXT

# Fixed value: how the source writes a time of day as text.
TIME_AS_TEXT = "TO_VARCHAR({column}, 'HH24:MI:SS')"

# The columns each metadata view is read for.
METADATA_COLUMNS = {
    "tables": "table_schema, table_name, table_type",
    "views": "table_schema, table_name, view_definition",
    "columns": "table_schema, table_name, column_name, data_type, numeric_precision, numeric_scale, "
    "ordinal_position AS column_ordinal",
    "procedures": "procedure_schema, procedure_name, argument_signature, data_type AS return_type, "
    "procedure_language, procedure_definition, comment",
}
WHOLE = ("column_ordinal", "numeric_precision", "numeric_scale")


def connector_options(
    base: Mapping[str, str],
    database: str | None = None,
    schema: str | None = None,
    *,
    database_key: str = "database",
    schema_key: str = "schema",
) -> dict[str, str]:
    """Caller's connection options, plus database and schema where given."""
    extra = {database_key: database, schema_key: schema}
    return {**base, **{k: v for k, v in extra.items() if v}}


def quoted(name: str, mark: str = '"') -> str:
    return mark + name.replace(mark, mark * 2) + mark


def quoted_table(schema: str, table: str, mark: str = '"') -> str:
    return f"{quoted(schema, mark)}.{quoted(table, mark)}"


# Column, lower bound, upper bound, number of parts. The bounds only place the
# cuts: rows outside them, and nulls, fall into the end parts.
Split = tuple[str, object, object, int]


def _split_options(split: Split) -> dict[str, object]:
    column, lower, upper, parts = split
    return {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": parts}


def scan_query(
    spark: SparkSession,
    fmt: str | None,
    options: Mapping[str, str] | None,
    sql: str,
    *,
    split: Split | None = None,
) -> DataFrame:
    """Rows of a query the source itself runs; ``split`` reads them in parallel ranges."""
    if fmt is None:
        return spark.sql(sql)
    reader = spark.read.format(fmt).options(**(options or {}))
    if split:
        # Sources take ranges for a table only, so the query stands in for one.
        return reader.option("dbtable", f"({sql}) source").options(**_split_options(split)).load()
    return reader.option("query", sql).load()


def scan_table(
    spark: SparkSession,
    fmt: str | None,
    options: Mapping[str, str] | None,
    schema: str,
    table: str,
    *,
    split: Split | None = None,
) -> DataFrame:
    """A whole table; ``split`` reads it in parallel ranges."""
    if fmt is None:
        return spark.table(quoted_table(schema, table, "`"))
    reader = spark.read.format(fmt).options(**(options or {})).option("dbtable", quoted_table(schema, table))
    return (reader.options(**_split_options(split)) if split else reader).load()


def split_by(
    spark: SparkSession, fmt: str | None, options: Mapping[str, str], schema: str, table: str, column: str, part_rows: int
) -> Split | None:
    """Ranges over a numeric or date column, about ``part_rows`` rows each; bounds and rows are asked from the source.

    None for a table without values in the column, which is read as one range.
    """
    mark = "`" if fmt is None else '"'
    name = quoted(column, mark)
    bounds = f"SELECT MIN({name}) AS low, MAX({name}) AS high, COUNT(*) AS n FROM {quoted_table(schema, table, mark)}"
    low, high, n = scan_query(spark, fmt, options, bounds).first()
    return None if low is None else (column, low, high, max(1, -(-int(n) // part_rows)))


def _literal(value: object) -> str:
    """A bound as SQL text."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    return f"DATE '{value}'" if isinstance(value, date) else str(value)


def depth_ranges(
    spark: SparkSession, fmt: str | None, options: Mapping[str, str], schema: str, table: str, column: str, part_rows: int
) -> list[str]:
    """Conditions that part a table into ranges of about ``part_rows`` rows each by a numeric or date column.

    The bounds are quantiles of a sketch over the whole column, which alone is
    read, in slices; so a skewed column makes even ranges, but for a single
    value, which stays in one. Rows without a value are a range of their own.
    Empty without values: then the table is one range.
    """
    mark = "`" if fmt is None else '"'
    name, place = quoted(column, mark), quoted_table(schema, table, mark)
    first = split_by(spark, fmt, options, schema, table, column, part_rows)
    if first is None:
        return []
    parts = first[3]
    # The session's own catalog splits a scan by its files.
    values = scan_query(spark, fmt, options, f"SELECT {name} AS k FROM {place}", split=None if fmt is None else ("k", *first[1:]))
    shares = [k / parts for k in range(1, parts)]
    sketch = F.approx_percentile("k", shares, max(10_000, 100 * parts)) if shares else F.array()
    row = values.agg(sketch.alias("cuts"), F.count_if(F.col("k").isNull()).alias("nulls"), F.min("k").alias("low")).first()
    cuts = [_literal(c) for c in sorted({c for c in row.cuts or [] if c != row.low})]
    ranges = [f"{name} >= {a} AND {name} < {b}" for a, b in pairwise(cuts)]
    ends = [f"{name} < {cuts[0]}", *ranges, f"{name} >= {cuts[-1]}"] if cuts else [f"{name} IS NOT NULL"]
    return ends + [f"{name} IS NULL"] * (row.nulls > 0)


def scan_ranges(
    spark: SparkSession, fmt: str | None, options: Mapping[str, str] | None, source: str, ranges: Sequence[str]
) -> DataFrame:
    """A whole table or query in parts, one for each of ``ranges``; ``source`` stands after FROM."""
    if fmt == "jdbc":
        own = dict(options or {})
        return spark.read.jdbc(own.pop("url"), source, predicates=list(ranges), properties=own)
    parts = [scan_query(spark, fmt, options, f"SELECT * FROM {source} WHERE {r}") for r in ranges]
    return reduce(DataFrame.union, parts)


def typed_query(schema: str, table: str, columns: Iterable[Row], time_as_text: str = TIME_AS_TEXT) -> str | None:
    """Source query that turns time-of-day columns into text, in column order; None without such columns."""
    columns = sorted(columns, key=lambda c: c.column_ordinal)
    if not any(c.target_type == TIME_TEXT for c in columns):
        return None

    def expression(c: Row) -> str:
        name = quoted(c.column_name)
        return f"{time_as_text.format(column=name)} AS {name}" if c.target_type == TIME_TEXT else name

    return f"SELECT {', '.join(map(expression, columns))} FROM {quoted_table(schema, table)}"


def table_reader(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    *,
    database_key: str = "database",
    time_as_text: str = TIME_AS_TEXT,
    part_rows: int = 1_000_000,
    even: bool = False,
) -> Callable[[Row], DataFrame]:
    """Reader for a bulk copy: scans the source table of one object (``src_db``, ``schema``, ``name``).

    Where the object's type plan has times of day, the source formats them,
    since not every connector has a type for them. An object with a
    ``split_column`` is read in ranges of it, as many as its rows ask for at
    ``part_rows`` each: a plain JDBC scan is one task, however large the table,
    so an object without the column is read with a warning. Ranges are equal
    slices of the column, or with ``even`` hold equal numbers of rows, for one
    more read of that column.
    """

    def read(o: Row) -> DataFrame:
        opts = connector_options(options, o.src_db, database_key=database_key)
        column = getattr(o, "split_column", None)
        split = split_by(spark, fmt, opts, o.schema, o.name, column, part_rows) if column and not even else None
        if fmt == "jdbc" and not column:
            warnings.warn(f"{o.src_db}.{o.schema}.{o.name} is read by one task; name a split_column for it", stacklevel=2)
        sql = typed_query(o.schema, o.name, getattr(o, "columns", None) or [], time_as_text)
        ranges = depth_ranges(spark, fmt, opts, o.schema, o.name, column, part_rows) if column and even else []
        if ranges:
            return scan_ranges(spark, fmt, opts, f"({sql}) source" if sql else quoted_table(o.schema, o.name), ranges)
        if sql:
            return scan_query(spark, fmt, opts, sql, split=split)
        return scan_table(spark, fmt, opts, o.schema, o.name, split=split)

    return read


def scan_metadata(
    spark: SparkSession,
    fmt: str | None,
    options: Mapping[str, str] | None,
    databases: Iterable[str],
    view: str,
    *,
    database_key: str = "database",
    refused: dict[str, str] | None = None,
) -> DataFrame:
    """One metadata view of every database, with lower-case columns and ``src_db``.

    A database that refuses raises, or with ``refused`` is left out and noted
    there with its error. One query per database, all in one plan: definitions and columns of all
    objects come in the same pass, never one query per object.
    """

    def one(database: str) -> DataFrame:
        sql = f"SELECT {METADATA_COLUMNS[view]} FROM {database}.information_schema.{view}"
        opts = connector_options(options or {}, database, database_key=database_key)
        rows = scan_query(spark, fmt, opts, sql)
        return rows.toDF(*[c.lower() for c in rows.columns]).withColumn("src_db", F.lit(database))

    found = []
    for database in databases:
        try:
            found.append(one(database))
        except Exception as error:
            if refused is None:
                raise
            refused[database] = str(error)
    if not found:
        names = [c.split(" as ")[-1].strip() for c in METADATA_COLUMNS[view].lower().split(",")] + ["src_db"]
        return spark.createDataFrame([], ", ".join(f"{n} {'bigint' if n in WHOLE else 'string'}" for n in names))
    return reduce(DataFrame.unionByName, found)
