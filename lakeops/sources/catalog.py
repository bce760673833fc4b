"""Databases, tables and views of a catalog the Spark session can see.

Catalog commands run on the driver and return names and definitions, never
table rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeops.parallel import run_each
from lakeops.session import spooled

# Schemas that belong to the system.
SYSTEM_SCHEMAS = ("information_schema", "pg_catalog", "sys")

FOUND_SCHEMA = "catalog string, database string, name string"
CLASSIFIED_SCHEMA = "catalog string, database string, name string, kind string, ddl string, error string, home array<string>"


def full_name(*parts: str | None) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts if p)


def name_parts(name: str) -> list[str]:
    """Parts of a dotted name, back-quoted or not."""
    return [quoted.replace("``", "`") if quoted else bare for quoted, bare in re.findall(r"`((?:[^`]|``)+)`|([^.`]+)", name)]


def list_schemas(
    spark: SparkSession, catalog: str | None = None, skip_schemas: Iterable[str] = SYSTEM_SCHEMAS
) -> DataFrame:
    """Schemas of a catalog (column ``database``) but for the system's own, in any case."""
    where = f" IN {full_name(catalog)}" if catalog else ""
    listed = spark.sql(f"SHOW SCHEMAS{where}").toDF("database")
    return listed.filter(~F.lower("database").isin([s.lower() for s in skip_schemas]))


def discover_spark(
    spark: SparkSession,
    databases: Iterable[str],
    skip_schemas: Iterable[str] = SYSTEM_SCHEMAS,
    *,
    catalog: str | None = None,
) -> DataFrame:
    """Tables and views of the given databases; temporary views are not listed."""
    skipped = {s.lower() for s in skip_schemas}

    def found() -> Iterator[tuple[str | None, str, str]]:
        for database in databases:
            if database.lower() not in skipped:
                listed = spark.sql(f"SHOW TABLES IN {full_name(catalog, database)}").filter("NOT isTemporary")
                yield from ((catalog, database, r.tableName) for r in listed.toLocalIterator())

    return spooled(spark, found(), FOUND_SCHEMA)


def table_detail(spark: SparkSession, full: str) -> dict[str, str]:
    """What the catalog says of a table or view, by heading in lower case."""
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()
    # A column may itself be called "type": only rows after this heading describe the object.
    heading = next(i for i, r in enumerate(detail) if r.col_name == "# Detailed Table Information")
    found: dict[str, str] = {}
    for r in detail[heading + 1 :]:
        found.setdefault(r.col_name.strip().lower(), (r.data_type or "").strip())
    return found


def _classify(spark: SparkSession, o: Row) -> tuple:
    full = full_name(o.catalog, o.database, o.name)
    try:
        detail = table_detail(spark, full)
        if detail.get("type", "").upper() != "VIEW":
            return (*o, "table", None, None, None)
        ddl = spark.sql(f"SHOW CREATE TABLE {full}").first()[0]
        if not ddl:
            raise ValueError(f"no definition for {full}")
        # Where its short names are looked for; a catalog that doesn't say keeps to the view's own database.
        home = name_parts(detail.get("view catalog and namespace", "")) or [*((o.catalog,) if o.catalog else ()), o.database]
        return (*o, "view", ddl, None, home)
    except Exception as error:
        # Unknown is not "table": a view must not be copied as rows by mistake.
        return (*o, "failed", None, str(error), None)


def classify_spark(spark: SparkSession, objects: DataFrame, parallelism: int = 4) -> DataFrame:
    """Kind of each object of :func:`discover_spark`; views with their definition and ``home``, the database of its short names."""
    names = objects.select("catalog", "database", "name").toLocalIterator()
    return spooled(spark, run_each(names, lambda o: _classify(spark, o), parallelism), CLASSIFIED_SCHEMA)
