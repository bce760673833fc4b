"""Ordered migration through a connector: discover, plan, copy, recreate, log."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from itertools import batched

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.names import object_id, plain_name, with_clash, with_destination
from lakeops.functions.refs import extract_refs
from lakeops.operators.deps import dependency_levels, external_refs, view_edges, view_reads
from lakeops.operators.discovery import WAREHOUSE_SYSTEM_SCHEMAS, attach_definitions, discover_objects, join_metadata
from lakeops.operators.procedures import PROCEDURE_CREATED, procedure_ddl, procedure_status
from lakeops.operators.typing_plan import plans_by_table, type_plan
from lakeops.parallel import run_each
from lakeops.session import cut_lineage, scratch
from lakeops.sinks.copy_queue import copy_queued, plan_queue, queue_states
from lakeops.sinks.runlog import append_run_log, run_stamp
from lakeops.sinks.tables import FAILED, Outcome, copy_each, ensure_schemas, outcomes_frame
from lakeops.sinks.views import create_each, with_statement
from lakeops.sources.connector import scan_metadata, table_reader

# Outcomes per append: the driver never holds more, and the log gets no tiny files.
LOG_BATCH = 1000

IDENTITY = ["src_db", "schema", "name"]


def plan_views(objects: DataFrame, definitions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Views with level, the views they read and CREATE statement, and all references of their definitions.

    Definitions are read once; the checkpoint holds them for the three uses.
    """
    views = cut_lineage(with_statement(attach_definitions(objects.filter("kind = 'view'"), definitions)))
    refs = extract_refs(views, IDENTITY, "view_definition")
    keyed = views.withColumn("view_id", object_id(*[F.col(c) for c in IDENTITY]))
    edges = view_edges(refs, views)
    return keyed.join(dependency_levels(keyed, edges), "view_id").join(view_reads(edges), "view_id", "left"), refs


def preflight(mapping: DataFrame, tables: DataFrame, definitions: DataFrame, **discover) -> DataFrame:
    """References of the run's views to databases outside the mapping.

    Definitions are reduced to their external references where they are
    scanned, so no text is shuffled.
    """
    views = discover_objects(mapping, tables, ordered=False, **discover).filter("kind = 'view'")
    named = definitions.withColumnsRenamed({"table_schema": "schema", "table_name": "name"})
    external = external_refs(extract_refs(named, IDENTITY, "view_definition"), mapping, id_cols=IDENTITY, keep=True)
    in_run = views.select(F.upper("src_db").alias("_db"), "src_db", "schema", "name")
    found = external.withColumn("_db", F.upper("src_db")).drop("src_db").join(in_run, ["_db", "schema", "name"])
    return found.select(plain_name(*map(F.col, IDENTITY)).alias("view_id"), "ref", "missing_db")


def run_migration(
    spark: SparkSession,
    mapping: DataFrame,
    tables: DataFrame,
    definitions: DataFrame,
    reader: Callable[[Row], DataFrame],
    log_table: str,
    run_ts: str,
    *,
    columns: DataFrame | None = None,
    procedures: DataFrame | None = None,
    split_columns: DataFrame | None = None,
    create_procedure: Callable[[str], object] | None = None,
    skip_schemas: Iterable[str] = WAREHOUSE_SYSTEM_SCHEMAS,
    ignore_case: bool = False,
    parallelism: int = 4,
    strict: bool = True,
    fmt: str = "parquet",
    queue: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Copy everything the mapping names and return the run log.

    Tables first, then procedures, then views level by level. ``reader`` scans
    one source table. ``columns`` brings the type plan, ``split_columns``
    (``src_db``, ``schema``, ``name``, ``split_column``) the column by which the
    reader splits a large table. ``create_procedure`` runs one CREATE PROCEDURE
    text where the host can; without it procedures are inventoried only. With
    the name of a table as ``queue`` a run that was cut off goes on where it
    stood: tables that it has created are not read again. A run repeated under
    the same ``run_id`` (with a queue, that is its name unless given) and stamp
    replaces its rows in the log; any other is appended.
    """
    with scratch(spark):
        _migrate(
            spark, mapping, tables, definitions, reader, log_table, run_ts, columns, procedures, split_columns,
            create_procedure, skip_schemas, ignore_case, parallelism, strict, fmt, queue, run_id or queue or uuid.uuid4().hex,
        )
    return spark.table(log_table)


def _migrate(
    spark: SparkSession,
    mapping: DataFrame,
    tables: DataFrame,
    definitions: DataFrame,
    reader: Callable[[Row], DataFrame],
    log_table: str,
    run_ts: str,
    columns: DataFrame | None,
    procedures: DataFrame | None,
    split_columns: DataFrame | None,
    create_procedure: Callable[[str], object] | None,
    skip_schemas: Iterable[str],
    ignore_case: bool,
    parallelism: int,
    strict: bool,
    fmt: str,
    queue: str | None,
    run_id: str,
) -> None:
    found = discover_objects(mapping, tables, procedures, skip_schemas, ignore_case, ordered=False)
    objects = cut_lineage(with_clash(with_destination(found)))
    ensure_schemas(spark, objects)
    views, refs = plan_views(objects, definitions)

    to_copy = objects.filter("kind = 'table'").select(*IDENTITY, "dst_cat", "dst_schema", "dst_fq", "dst_plain", "n_same")
    if columns is not None:
        keyed = columns.select(
            "src_db",
            F.col("table_schema").alias("schema"),
            F.col("table_name").alias("name"),
            "column_ordinal",
            "column_name",
            "data_type",
            "numeric_precision",
            "numeric_scale",
        )
        to_copy = join_metadata(to_copy, plans_by_table(type_plan(keyed), *IDENTITY))

    if split_columns is not None:
        to_copy = join_metadata(to_copy, split_columns.select(*IDENTITY, "split_column"))
    if queue is None:
        _log(spark, copy_each(spark, to_copy, reader, parallelism, fmt=fmt, strict=strict), log_table, run_ts, fmt, f"{run_id} tables")
    else:
        plan_queue(spark, to_copy, queue)
        tried = queue_states(spark, queue).agg(F.max("attempts")).first()[0]
        copies = copy_queued(spark, queue, reader, parallelism, fmt=fmt, strict=strict)
        _log(spark, copies, log_table, run_ts, fmt, f"{run_id} tables {tried or 0}")

    if procedures is not None:
        procs = procedure_status(objects.filter("kind = 'procedure'"), create_procedure is not None)
        ready = procs.filter(F.col("status") == PROCEDURE_CREATED)
        noted = procs.filter(F.col("status") != PROCEDURE_CREATED).select(
            F.col("dst_plain").alias("table"),
            "kind",
            "status",
            F.lit(None).cast("bigint").alias("rows"),
            F.lit(None).cast("string").alias("error"),
        )
        append_run_log(spark, noted, log_table, run_ts, fmt, batch=f"{run_id} procedures noted")
        if create_procedure is not None:
            _log(spark, _create_procedures(ready, create_procedure, parallelism), log_table, run_ts, fmt, f"{run_id} procedures")

    # A view's own list of references, bounded by its definition.
    needs = external_refs(refs, mapping, keep=True).groupBy(*IDENTITY).agg(
        F.array_join(F.sort_array(F.collect_set("ref")), ", ").alias("needs")
    )
    told = join_metadata(views, needs)
    _log(spark, create_each(spark, told, parallelism), log_table, run_ts, fmt, f"{run_id} views")


def migrate_warehouse(
    spark: SparkSession,
    mapping: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    log_table: str,
    run_ts: str | None = None,
    *,
    database_key: str = "database",
    with_procedures: bool = True,
    **run,
) -> DataFrame:
    """The whole migration through one connector: metadata scans, then :func:`run_migration`.

    A database whose metadata can't be asked is a failed row of the log, and the others go on.
    """
    databases = [pair.source_database for pair in mapping.toLocalIterator()]
    run_ts = run_ts or run_stamp()
    run_id = run["run_id"] = run.get("run_id") or run.get("queue") or uuid.uuid4().hex
    refused: dict[str, str] = {}

    def scan(view: str) -> DataFrame:
        asked = [d for d in databases if d not in refused]
        return scan_metadata(spark, fmt, options, asked, view, database_key=database_key, refused=refused)

    scans = {view: scan(view) for view in ("tables", "views", "columns", *(["procedures"] if with_procedures else []))}
    if refused:
        failed = [(database, "database", FAILED, None, error) for database, error in refused.items()]
        append_run_log(spark, outcomes_frame(spark, failed), log_table, run_ts, run.get("fmt", "parquet"), batch=f"{run_id} databases")
    return run_migration(
        spark,
        mapping,
        scans["tables"],
        scans["views"],
        table_reader(spark, fmt, options, database_key=database_key),
        log_table,
        run_ts,
        columns=scans["columns"],
        procedures=scans.get("procedures"),
        **run,
    )


def _create_procedures(ready: DataFrame, create: Callable[[str], object], parallelism: int) -> Iterator[Outcome]:
    def one(p: Row) -> Outcome:
        try:
            if not p.ddl:
                raise ValueError("procedure has no body")
            create(p.ddl)
            return (p.dst_plain, "procedure", PROCEDURE_CREATED, None, None)
        except Exception as error:
            return (p.dst_plain, "procedure", FAILED, None, str(error))

    return run_each(procedure_ddl(ready).select("dst_plain", "ddl").toLocalIterator(), one, parallelism)


def _log(spark: SparkSession, outcomes: Iterator[Outcome], table: str, run_ts: str, fmt: str, phase: str) -> None:
    """Outcomes of a phase as numbered batches of the run."""
    for k, batch in enumerate(batched(outcomes, LOG_BATCH)):
        append_run_log(spark, outcomes_frame(spark, batch), table, run_ts, fmt, batch=f"{phase} {k:06d}")
