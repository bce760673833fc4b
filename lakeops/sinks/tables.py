"""Table writes: snapshots, staging, bulk copies and their counts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import batched

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.names import with_clash, with_destination
from lakeops.operators.typing_plan import apply_type_plan
from lakeops.parallel import run_each
from lakeops.session import remove_path, spooled
from lakeops.sources.catalog import full_name, name_parts, table_detail

# Outcomes of a copy.
TABLE_CREATED = "table_created"
FAILED = "failed"
# Tables counted in one plan.
COUNTED_AT_ONCE = 32
# Formats without transactions of their own: a snapshot is a folder of its own, and the table points to it.
FILE_FORMATS = ("parquet", "orc", "avro", "json", "csv")
SESSION_CATALOG = "spark_catalog"
PREVIOUS = "lakeops.previous"

OUTCOME_SCHEMA = "`table` string, kind string, status string, `rows` bigint, error string"

Outcome = tuple[str, str, str, int | None, str | None]


def _versions(spark: SparkSession, name: str) -> tuple[str, str, str] | None:
    """Database, table and folder of snapshots of a table of the session's catalog; None for other catalogs."""
    parts = name_parts(name)
    catalog = parts[0] if len(parts) == 3 else spark.catalog.currentCatalog()
    if catalog != SESSION_CATALOG or len(parts) > 3:
        return None
    database = parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()
    base = spark.catalog.getDatabase(full_name(catalog, database)).locationUri
    return database, parts[-1], f"{base.rstrip('/')}/{parts[-1]}.versions"


def _same_columns(one: T.StructType, other: T.StructType) -> bool:
    return [(f.name, f.dataType.simpleString()) for f in one] == [(f.name, f.dataType.simpleString()) for f in other]


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Replace a table, its schema included, at once.

    With a file format the rows are written to a new folder first, and the table
    is pointed to it when all are there: a write that fails or is killed leaves
    the old rows as they were, and readers never see a part. Only a change of
    columns needs two statements, which write no data: the table is made under
    another name, then takes the old one's place. The rows before stay until the
    next replacement, for readers that have begun. Other formats, and tables of
    other catalogs, are replaced by their own writer. One writer at a time.
    """
    place = _versions(spark := df.sparkSession, name) if fmt in FILE_FORMATS else None
    if place is None:
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
        return
    database, table, versions = place
    path = f"{versions}/{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).save(path)
        _point_to(spark, database, table, path, fmt, df.schema)
    except Exception:
        remove_path(spark, path)
        raise


def _point_to(spark: SparkSession, database: str, table: str, path: str, fmt: str, schema: T.StructType) -> None:
    full = full_name(SESSION_CATALOG, database, table)
    if not spark.catalog.tableExists(full):
        spark.catalog.createTable(full, path=path, source=fmt, schema=schema)
        return
    before = table_detail(spark, full)
    if before.get("type") == "VIEW":
        raise ValueError(f"{full} is a view")
    oldest = spark.sql(f"SHOW TBLPROPERTIES {full}").filter(F.col("key") == PREVIOUS).first()
    if before.get("provider") == fmt and _same_columns(spark.table(full).schema, schema):
        spark.sql(f"ALTER TABLE {full} SET LOCATION {_text(path)}")
    else:
        other = f"{table}__{uuid.uuid4().hex[:8]}"
        spark.catalog.createTable(full_name(SESSION_CATALOG, database, other), path=path, source=fmt, schema=schema)
        spark.sql(f"DROP TABLE {full}")
        spark.sql(f"ALTER TABLE {full_name(SESSION_CATALOG, database, other)} RENAME TO {full_name(database, table)}")
    spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ({_text(PREVIOUS)} = {_text(before['location'])})")
    spark.catalog.refreshTable(full)
    if oldest and f"/{table}.versions/" in oldest.value:
        remove_path(spark, oldest.value)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_schemas(spark: SparkSession, objects: DataFrame) -> dict[str, str]:
    """Create the destination schemas; returns the error of each that failed."""
    errors = {}
    for row in objects.select("dst_cat", "dst_schema").distinct().toLocalIterator():
        name = full_name(row.dst_cat, row.dst_schema)
        try:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
        except Exception as error:
            errors[name] = str(error)
    return errors


def row_count(spark: SparkSession, name: str) -> int:
    # No columns are read: a parquet count comes from the file footers.
    return spark.table(name).count()


def counted_overwrite(spark: SparkSession, df: DataFrame, name: str, fmt: str) -> tuple[int]:
    overwrite_table(df, name, fmt)
    return (row_count(spark, name),)


def outcomes_frame(spark: SparkSession, outcomes: Iterable[Outcome]) -> DataFrame:
    """Outcomes as rows, kept in the shared folder as they come."""
    return spooled(spark, outcomes, OUTCOME_SCHEMA)


def refuse_clash(o: Row) -> None:
    """Raise for an object whose destination other objects have as well; one that nobody counted passes."""
    if getattr(o, "n_same", 1) > 1:
        raise ValueError(f"{o.n_same} objects of the source would be written to {o.dst_plain}; none is")


def copy_each(
    spark: SparkSession,
    objects: DataFrame,
    reader: Callable[[Row], DataFrame],
    parallelism: int = 4,
    *,
    fmt: str = "parquet",
    strict: bool = True,
    write: Callable[[SparkSession, DataFrame, str, str], tuple] | None = None,
) -> Iterator[Outcome]:
    """Copy every table of ``objects``; yields one outcome each, as they finish.

    ``objects`` has a destination, and optionally ``columns``, its type plan as
    an array, and ``n_same`` (see ``with_clash``): objects with the same
    destination all fail and none is written. One write job per table, a few at a time; a failure is an
    outcome and stops nothing. ``write`` puts rows into a table of a format and
    returns their number, and what else an outcome is to end with.
    """
    write = write or counted_overwrite
    no_schema = ensure_schemas(spark, objects)

    def copy(o: Row) -> Outcome:
        try:
            refuse_clash(o)
            schema_error = no_schema.get(full_name(o.dst_cat, o.dst_schema))
            if schema_error:
                raise RuntimeError(schema_error)
            df = reader(o)
            if getattr(o, "columns", None):
                df = apply_type_plan(df, o.columns, strict)
            rows, *more = write(spark, df, o.dst_fq, fmt)
            return (o.dst_plain, "table", TABLE_CREATED, rows, None, *more)
        except Exception as error:
            return (o.dst_plain, "table", FAILED, None, str(error))

    return run_each(objects.toLocalIterator(), copy, parallelism)


def copy_tables(
    spark: SparkSession,
    objects: DataFrame,
    reader: Callable[[Row], DataFrame],
    parallelism: int = 4,
    *,
    lower: bool = True,
    fmt: str = "parquet",
    strict: bool = True,
) -> DataFrame:
    """Copy every table of ``objects``; the result has one outcome row per table."""
    placed = with_clash(with_destination(objects, lower))
    return outcomes_frame(spark, copy_each(spark, placed, reader, parallelism, fmt=fmt, strict=strict))


def copy_counts(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Row count of each table, a few tables in one plan at a time."""

    def counted() -> Iterator[tuple[str, int]]:
        for some in batched(names, COUNTED_AT_ONCE):
            counts = [spark.table(n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table"), "n_rows") for n in some]
            yield from (tuple(r) for r in reduce(DataFrame.unionByName, counts).collect())

    return spooled(spark, counted(), "`table` string, n_rows bigint")
