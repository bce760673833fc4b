"""Copy of whole catalogs that Spark itself can read."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.names import object_id, plain_name, quoted_name, with_clash
from lakeops.functions.rewrite import rewrite_backtick, select_body
from lakeops.functions.scopes import extract_relations
from lakeops.operators.deps import dependency_levels, view_reads
from lakeops.session import written_out
from lakeops.sinks.runlog import append_run_log, run_stamp
from lakeops.sinks.tables import FAILED, SESSION_CATALOG, copy_each, ensure_schemas, outcomes_frame
from lakeops.sinks.views import create_each
from lakeops.sources.catalog import SYSTEM_SCHEMAS, classify_spark, discover_spark, full_name, list_schemas


def _listed(spark: SparkSession, src: str, unit: str, skip_schemas: Iterable[str]) -> DataFrame:
    if unit != "catalog":
        return discover_spark(spark, [src], skip_schemas)
    databases = (r.database for r in list_schemas(spark, src, skip_schemas).toLocalIterator())
    return discover_spark(spark, databases, skip_schemas, catalog=src)


def federated_copy(
    spark: SparkSession,
    mapping: DataFrame,
    *,
    source: str = "source_catalog",
    destination: str = "destination_catalog",
    unit: str = "catalog",
    skip_schemas: Iterable[str] = SYSTEM_SCHEMAS,
    parallelism: int = 4,
    fmt: str = "parquet",
    log_table: str | None = None,
    run_ts: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Copy all tables, then recreate all views, of each pair; one outcome row per object.

    A view is created once, after the views of its pair that its definition
    reads; one that reads a failed view fails without a try.

    ``unit="catalog"`` maps catalogs and keeps their schemas;
    ``unit="database"`` maps databases of the session catalog. Names keep their case.
    A pair that can't be listed is a failed row, and the others go on; objects
    with the same destination all fail. With ``log_table`` the outcomes are
    appended to the run log, in place of those of the same ``run_id`` and stamp.
    """
    skip_schemas = list(skip_schemas)
    found, refused = [], []
    for pair in mapping.toLocalIterator():
        src, dst = pair[source], pair[destination]
        try:
            found.append(_listed(spark, src, unit, skip_schemas).withColumns({"src": F.lit(src), "dst": F.lit(dst)}))
        except Exception as error:
            refused.append((src, unit, FAILED, None, str(error)))
    done = [outcomes_frame(spark, refused)]
    if found:
        done += _copied(spark, reduce(DataFrame.union, found), parallelism, fmt)
    outcomes = reduce(DataFrame.unionByName, done)
    if log_table:
        append_run_log(spark, outcomes, log_table, run_ts or run_stamp(), fmt, batch=f"{run_id or uuid.uuid4().hex} federated")
    return outcomes


def plan_federated_views(views: DataFrame) -> DataFrame:
    """Views with level, the views of the same pair that they read, CREATE statement and the home of its short names.

    Names of one to three parts are found by scope, completed by the home of the
    view's source, and moved to the destination where their catalog or database
    is the one that moves.
    """
    view_id = object_id(*[F.col(c) for c in ("dst_cat", "dst_schema", "name")])
    session = F.array(F.lit(SESSION_CATALOG))
    home = F.when(F.size("home") > 1, F.col("home")).otherwise(F.concat(session, "home"))
    keyed = written_out(views.select("*", view_id.alias("view_id")).withColumn("home", home))

    def moved(at: Column) -> Column:
        """A catalog and database as they are called at the destination, null where they don't move."""
        is_src = [F.lower(at[k]) == F.lower("src") for k in (0, 1)]
        by_catalog = F.when(is_src[0], F.array(F.col("dst"), at[1]))
        by_database = F.when((F.lower(at[0]) == SESSION_CATALOG) & is_src[1], F.array(F.lit(SESSION_CATALOG), F.col("dst")))
        return F.when(F.col("catalog").isNotNull(), by_catalog).otherwise(by_database)

    texts = keyed.withColumn("_body", select_body(F.col("ddl")))
    names = extract_relations(texts, ["view_id", "catalog", "src", "dst", "home"], "_body").filter(F.size("parts") <= 3)
    whole = F.concat(F.slice("home", 1, F.greatest(F.lit(0), 3 - F.size("parts"))), "parts").alias("parts")
    at = names.select("view_id", "catalog", "src", "dst", whole).withColumn("at", F.slice("parts", 1, 2))
    to = at.withColumn("to", moved(F.col("at"))).filter(F.col("to").isNotNull())
    edges = to.select("view_id", object_id(F.col("to")[0], F.col("to")[1], F.element_at("parts", -1)).alias("dep_id"))
    in_run = keyed.select(F.col("view_id").alias("dep_id"))
    edges = edges.filter("view_id <> dep_id").join(in_run, "dep_id", "left_semi").select("view_id", "dep_id").distinct()
    planned = keyed.withColumn("home", F.coalesce(moved(F.col("home")), "home"))
    statement = rewrite_backtick(F.col("ddl"), F.col("src"), F.col("dst")).alias("statement")
    planned = planned.select("view_id", "dst_plain", "n_same", "home", statement)
    return planned.join(dependency_levels(keyed, edges), "view_id").join(view_reads(edges), "view_id", "left")


def _copied(spark: SparkSession, listed: DataFrame, parallelism: int, fmt: str) -> list[DataFrame]:
    # In the database unit there is no catalog, so the database is the part that moves.
    is_catalog = F.col("catalog").isNotNull()
    destination_of = {
        "dst_cat": F.when(is_catalog, F.col("dst")).otherwise(SESSION_CATALOG),
        "dst_schema": F.when(is_catalog, F.col("database")).otherwise(F.col("dst")),
    }
    distinct = listed.select("catalog", "database", "name").distinct()
    objects = classify_spark(spark, distinct, parallelism).withColumn("src", F.coalesce("catalog", "database"))
    objects = objects.join(listed.select("src", "dst").distinct(), "src").withColumns(destination_of)
    parts = (F.col("dst_cat"), F.col("dst_schema"), F.col("name"))
    # Read for tables, views and failures: written once.
    objects = written_out(with_clash(objects.withColumns({"dst_fq": quoted_name(*parts), "dst_plain": plain_name(*parts)})))

    ensure_schemas(spark, objects)

    def read(o: Row) -> DataFrame:
        if [n.lower() for n in (o.catalog or SESSION_CATALOG, o.database, o.name)] == [n.lower() for n in (o.dst_cat, o.dst_schema, o.name)]:
            raise ValueError(f"{o.dst_plain} is its own source")
        return spark.table(full_name(o.catalog, o.database, o.name))

    tables = objects.filter("kind = 'table'").drop("ddl", "error")
    copied = outcomes_frame(spark, copy_each(spark, tables, read, parallelism, fmt=fmt))
    recreated = outcomes_frame(spark, create_each(spark, plan_federated_views(objects.filter("kind = 'view'")), parallelism))
    unknown = objects.filter("kind = 'failed'").select(
        F.col("dst_plain").alias("table"),
        F.lit("unknown").alias("kind"),
        F.lit(FAILED).alias("status"),
        F.lit(None).cast("bigint").alias("rows"),
        "error",
    )
    return [copied, recreated, unknown]
