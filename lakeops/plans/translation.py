"""Translation of stored procedures in one call: scan, stage, translate, write."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from lakeops.operators.procedures import stage_procedures, to_review, translate
from lakeops.sinks.tables import overwrite_table
from lakeops.sources.connector import scan_metadata


def translate_procedures(
    spark: SparkSession,
    mapping: DataFrame,
    procedures: DataFrame,
    staging_table: str,
    translated_table: str,
    *,
    fn: Callable[[list[str]], list[str]] | None = None,
    instruction: str | None = None,
    tasks: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Stage the procedures of mapped databases, translate them, and return what waits for review.

    ``procedures`` is the metadata view with ``src_db``. Both tables are
    replaced; translation reads the staged table, so a call that fails can be
    repeated without the source. See ``translate`` for ``fn``.
    """
    overwrite_table(stage_procedures(procedures, mapping), staging_table, fmt)
    translated = translate(spark.table(staging_table), fn, instruction=instruction, tasks=tasks)
    overwrite_table(translated, translated_table, fmt)
    return to_review(spark.table(translated_table))


def translate_warehouse(
    spark: SparkSession,
    mapping: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    staging_table: str,
    translated_table: str,
    *,
    database_key: str = "database",
    **how,
) -> DataFrame:
    """The same with the metadata scanned through one connector."""
    databases = [pair.source_database for pair in mapping.toLocalIterator()]
    found = scan_metadata(spark, fmt, options, databases, "procedures", database_key=database_key)
    return translate_procedures(spark, mapping, found, staging_table, translated_table, **how)
