"""Copies that say what they wrote: rows and a checksum for each column, taken while writing, to compare with later."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.names import with_clash, with_destination
from lakeops.parallel import run_each
from lakeops.session import spooled
from lakeops.sinks.tables import OUTCOME_SCHEMA, TABLE_CREATED, copy_each, overwrite_table

CHECKED_SCHEMA = f"{OUTCOME_SCHEMA}, checksums map<string, string>"
DIFFERENCES = "`table` string, column_name string, expected string, found string, same boolean"
ROWS = "_rows"


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def checksum(field: T.StructField) -> Column:
    """Sum of the hashes of a column's values: the same for every order of the rows, another for a changed or missing one.

    Hashes are 64 bits wide and summed in 38 digits, which hold 10^19 rows. Maps are hashed as JSON text.
    """
    value = F.col(f"`{field.name.replace('`', '``')}`")
    value = value if _hashable(field.dataType) else F.to_json(F.struct(value.alias("v")))
    return F.coalesce(F.sum(F.xxhash64(value).cast("decimal(38,0)")), F.lit(0)).cast("string")


def _measures(schema: T.StructType) -> list[Column]:
    return [F.count(F.lit(1)).alias(ROWS), *(checksum(f).alias(f"c{k}") for k, f in enumerate(schema))]


def observed_overwrite(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet") -> tuple[int, dict[str, str]]:
    """Replace a table; its rows and checksums are taken by the tasks that write it, with no second read."""
    seen = Observation()
    overwrite_table(df.observe(seen, *_measures(df.schema)), name, fmt)
    got = seen.get
    return got[ROWS], {f.name: got[f"c{k}"] for k, f in enumerate(df.schema)}


def copy_verified(
    spark: SparkSession,
    objects: DataFrame,
    reader: Callable[[Row], DataFrame],
    parallelism: int = 4,
    *,
    lower: bool = True,
    fmt: str = "parquet",
    strict: bool = True,
) -> DataFrame:
    """``copy_tables`` whose outcomes have the checksums of what the source gave, for :func:`verify_copies`."""
    placed = with_clash(with_destination(objects, lower))
    outcomes = copy_each(spark, placed, reader, parallelism, fmt=fmt, strict=strict, write=observed_overwrite)
    return spooled(spark, (o if len(o) == 6 else (*o, None) for o in outcomes), CHECKED_SCHEMA)


def verify_copies(spark: SparkSession, copied: DataFrame, parallelism: int = 4) -> DataFrame:
    """The tables of :func:`copy_verified` as they are now: one row for each column, and one for the rows of each table.

    One read of each table. A column that is not there, or a table that can't be read, has null ``found``.
    """

    def compare(o: Row) -> list[tuple]:
        expected = {None: str(o.rows), **o.checksums}
        try:
            table = spark.table(".".join(f"`{p}`" for p in o.table.split(".")))
            got = table.agg(*_measures(table.schema)).first()
            found = {None: str(got[ROWS]), **{f.name: got[f"c{k}"] for k, f in enumerate(table.schema)}}
        except Exception:
            found = {}
        return [(o.table, c, e, found.get(c), found.get(c) == e) for c, e in expected.items()]

    def every() -> Iterator[tuple]:
        done = copied.filter(F.col("status") == TABLE_CREATED).select("table", "rows", "checksums")
        for some in run_each(done.toLocalIterator(), compare, parallelism):
            yield from some

    return spooled(spark, every(), DIFFERENCES)
