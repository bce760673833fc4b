"""Dependencies between views: what leaves the migration, and in which order to build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.names import object_id, plain_name
from lakeops.session import new_path, remove_path, written_out

# Fixed value: the wording of an error whose view reads what is not in the run.
MISSING_DEPENDENCY = "missing dependency — view needs {} which is not in this run. original error: {}"


def external_refs(
    refs: DataFrame,
    databases: DataFrame,
    *,
    id_cols: Sequence[str] = ("src_db", "schema", "name"),
    database: str = "source_database",
    keep: bool = False,
) -> DataFrame:
    """References to databases that are not part of the run; ``keep`` leaves ``id_cols`` in the result."""
    in_run = databases.select(F.upper(database).alias("ref_db"))
    return refs.join(in_run, "ref_db", "left_anti").select(
        *(id_cols if keep else ()),
        plain_name(*[F.col(c) for c in id_cols]).alias("view_id"),
        plain_name(F.col("ref_db"), F.col("ref_schema"), F.col("ref_table")).alias("ref"),
        F.col("ref_db").alias("missing_db"),
    )


def external_refs_by_db(external: DataFrame) -> DataFrame:
    """Missing databases, sorted, with how much of the run needs them.

    Counts, not lists: one database may hold a large share of all references.
    The references themselves are the rows of ``external``, which sort by
    database, view and reference for a report.
    """
    per_view = external.groupBy("missing_db", "view_id").agg(F.count(F.lit(1)).alias("n"))
    counts = (F.count(F.lit(1)).alias("n_views"), F.sum("n").cast("bigint").alias("n_refs"))
    return per_view.groupBy("missing_db").agg(*counts).orderBy("missing_db")


def view_edges(
    refs: DataFrame, views: DataFrame, *, id_cols: Sequence[str] = ("src_db", "schema", "name")
) -> DataFrame:
    """(view, view it reads) for references to other views of the run."""
    view_id = object_id(*[F.col(c) for c in id_cols])
    edges = refs.select(
        view_id.alias("view_id"),
        object_id(F.col("ref_db"), F.col("ref_schema"), F.col("ref_table")).alias("dep_id"),
    )
    in_run = views.select(view_id.alias("dep_id"))
    return edges.filter("view_id <> dep_id").join(in_run, "dep_id", "left_semi").select("view_id", "dep_id")


def view_reads(edges: DataFrame) -> DataFrame:
    """The views that each view reads, as a list no longer than its own definition."""
    return edges.groupBy("view_id").agg(F.sort_array(F.collect_set("dep_id")).alias("reads"))


def in_degree(views: DataFrame, edges: DataFrame) -> DataFrame:
    """How many views of the run each view reads, zeros included. ``views`` has ``view_id``."""
    counted = edges.groupBy("view_id").agg(F.count_distinct("dep_id").alias("n"))
    return views.join(counted, "view_id", "left").select("view_id", F.coalesce("n", F.lit(0)).alias("in_degree"))


def dependency_levels(nodes: DataFrame, edges: DataFrame, *, node: str = "view_id", dep: str = "dep_id") -> DataFrame:
    """Level of each node: 0 without dependencies, else above all of them.

    Nodes on a cycle or downstream of one share one extra level at the end and
    are flagged ``is_circular``. ``edges`` join nodes of ``nodes``.

    A round marks the edges whose dependency was settled last and keeps the
    others: nodes with marked edges only are settled next. It is one write of
    the edges still open and one look whether it settled any node, so rounds get
    cheaper as levels settle, and neither the plan nor a recovery grows with the
    depth. The rounds lie side by side in the shared folder, are read once more
    for the result, and then removed.
    """
    spark = nodes.sparkSession
    path = new_path(spark)
    schema = T.StructType([edges.schema[node], edges.schema[dep], T.StructField("_met", T.BooleanType())])
    every = nodes.select(node).distinct()
    open_ = edges.select(node, dep).filter(F.col(node) != F.col(dep)).distinct()
    front = every.join(open_.select(node), node, "left_anti")
    level = 0
    while True:
        level += 1
        settled = not front.isEmpty()
        newest = front.select(F.col(node).alias(dep), F.lit(True).alias("_met"))
        marked = open_.join(newest, dep, "left").select(node, dep, F.coalesce("_met", F.lit(False)).alias("_met"))
        marked.write.parquet(f"{path}/level={level}")
        if not settled:
            break
        last = spark.read.schema(schema).parquet(f"{path}/level={level}")
        front = last.groupBy(node).agg(F.min("_met").alias("_met")).filter("_met").select(node)
        open_ = last.filter(~F.col("_met")).select(node, dep)
    rounds = spark.read.schema(T.StructType([*schema, T.StructField("level", T.IntegerType())])).parquet(path)
    above = rounds.groupBy(node).agg(F.max(F.when(F.col("_met"), F.col("level"))).alias("level"), F.max("level").alias("_seen"))
    # A node that is open in the last round, which settled nothing, is on a cycle or above one.
    placed = every.join(above, node, "left").select(
        node,
        F.when(F.col("_seen") == level, F.lit(level - 1)).otherwise(F.coalesce("level", F.lit(0))).alias("level"),
        F.coalesce(F.col("_seen") == level, F.lit(False)).alias("is_circular"),
    )
    result = written_out(placed)
    remove_path(spark, path)
    return result


def level_sizes(levels: DataFrame) -> DataFrame:
    """Views per level."""
    return levels.groupBy("level", "is_circular").agg(F.count(F.lit(1)).alias("n_views"))


def enrich_failures(log: DataFrame, external: DataFrame, *, view_id: str = "view_id") -> DataFrame:
    """Error of each failed view, naming the references that are not in the run.

    Only the references of failed views are gathered, per view: a list no
    longer than that view's own definition.
    """
    is_failed = (F.col("kind") == "view") & (F.col("status") == "failed")
    failed = log.filter(is_failed).select(view_id)
    needs = (
        external.join(failed, view_id, "left_semi")
        .groupBy(view_id)
        .agg(F.array_join(F.sort_array(F.collect_set("ref")), ", ").alias("_needs"))
    )
    before, between, after = MISSING_DEPENDENCY.split("{}")
    message = F.concat(F.lit(before), F.col("_needs"), F.lit(between), F.col("error"), F.lit(after))
    enriched = F.when(is_failed & F.col("_needs").isNotNull(), message).otherwise(F.col("error"))
    return log.join(needs, view_id, "left").withColumn("error", enriched).drop("_needs")
