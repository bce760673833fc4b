"""A bulk copy that can be taken up again: its queue outlives the run, and large tables start first."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.names import with_clash, with_destination
from lakeops.session import spooled
from lakeops.sinks.runlog import append_run_log
from lakeops.sinks.tables import TABLE_CREATED, Outcome, copy_each, outcomes_frame, overwrite_table
from lakeops.sources.catalog import full_name, table_detail

# State of an object that no attempt has settled.
PLANNED = "planned"
STATES = "_states"


def source_bytes(spark: SparkSession, objects: DataFrame, name: Callable[[Row], str]) -> DataFrame:
    """``objects`` with ``bytes``, the size of the files of each one's source table; null where the catalog can't say.

    ``name`` gives an object's source table. One question to the catalog and one
    to the file system for each table; no row is read.
    """
    schema = T.StructType([*objects.schema.fields, T.StructField("bytes", T.LongType())])
    path = spark._jvm.org.apache.hadoop.fs.Path

    def sized() -> Iterator[tuple]:
        for o in objects.toLocalIterator():
            try:
                place = path(table_detail(spark, name(o))["location"])
                size = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
            except Exception:
                size = None
            yield (*o, size)

    return spooled(spark, sized(), schema)


def plan_queue(spark: SparkSession, objects: DataFrame, queue: str, *, lower: bool = True) -> DataFrame:
    """Write the tables to copy to the table ``queue``, unless it is there already: then that is the plan.

    ``objects`` are those of ``copy_tables``, optionally with ``bytes``.
    """
    if not spark.catalog.tableExists(queue):
        placed = objects if "dst_fq" in objects.columns else with_clash(with_destination(objects, lower))
        overwrite_table(placed if "bytes" in placed.columns else placed.withColumn("bytes", F.lit(None).cast("bigint")), queue)
    return spark.table(queue)


def queue_states(spark: SparkSession, queue: str) -> DataFrame:
    """Each planned table with the outcome of its newest attempt, and the number of attempts; ``planned`` before any."""
    planned = spark.table(queue).select(F.col("dst_plain").alias("table"), "bytes")
    if not spark.catalog.tableExists(queue + STATES):
        return planned.select(
            "table", "bytes", F.lit(PLANNED).alias("status"), F.lit(None).cast("bigint").alias("rows"),
            F.lit(None).cast("string").alias("error"), F.lit(0).cast("bigint").alias("attempts"),
        )
    newest = (
        spark.table(queue + STATES)
        .groupBy("table")
        .agg(F.max_by(F.struct("status", "rows", "error"), "migrated_at").alias("_now"), F.count_distinct("migrated_at").alias("attempts"))
    )
    found = planned.join(newest, "table", "left")
    return found.select(
        "table", "bytes", F.coalesce("_now.status", F.lit(PLANNED)).alias("status"), "_now.rows", "_now.error",
        F.coalesce("attempts", F.lit(0)).alias("attempts"),
    )


def copy_queued(
    spark: SparkSession,
    queue: str,
    reader: Callable[[Row], DataFrame],
    parallelism: int = 4,
    *,
    fmt: str = "parquet",
    strict: bool = True,
    every_rows: int = 1000,
    every_seconds: float = 10,
) -> Iterator[Outcome]:
    """Copy what the queue still holds, largest tables first; yields an outcome for each one tried.

    Tables that an earlier call has created, and that are still there, are left
    alone; failed ones are tried again. Outcomes are kept beside the queue in
    batches of ``every_rows`` or ``every_seconds``: a driver that is lost loses
    no more than that, and those tables are written once more, in whole.
    """
    states = queue_states(spark, queue)
    attempt = f"{(states.agg(F.max('attempts')).first()[0] or 0) + 1:06d}"
    gone = spooled(spark, ((r.table,) for r in _created(spark, queue, states) if not spark.catalog.tableExists(r.dst_fq)), "`table` string")
    open_ = states.filter(F.col("status") != TABLE_CREATED).select("table").union(gone).distinct()
    todo = spark.table(queue).join(open_.withColumnRenamed("table", "dst_plain"), "dst_plain", "left_semi")
    todo = todo.orderBy(F.col("bytes").desc_nulls_last(), "dst_plain")
    held: list[Outcome] = []
    sent, since = 0, time.monotonic()

    def keep() -> None:
        nonlocal sent, since, held
        if held:
            append_run_log(spark, outcomes_frame(spark, held), queue + STATES, attempt, batch=f"{sent:06d}")
        sent, since, held = sent + 1, time.monotonic(), []

    try:
        for outcome in copy_each(spark, todo, reader, parallelism, fmt=fmt, strict=strict):
            held.append(outcome)
            if len(held) >= every_rows or time.monotonic() - since >= every_seconds:
                keep()
            yield outcome
    finally:
        keep()


def _created(spark: SparkSession, queue: str, states: DataFrame) -> Iterator[Row]:
    done = states.filter(F.col("status") == TABLE_CREATED).select("table")
    named = spark.table(queue).select(F.col("dst_plain").alias("table"), "dst_fq").join(done, "table", "left_semi")
    return named.toLocalIterator()


def copy_resumable(
    spark: SparkSession,
    objects: DataFrame,
    reader: Callable[[Row], DataFrame],
    queue: str,
    parallelism: int = 4,
    *,
    lower: bool = True,
    fmt: str = "parquet",
    strict: bool = True,
) -> DataFrame:
    """Plan and copy, or go on with a copy that was begun under the same ``queue``; every table's state in the end."""
    plan_queue(spark, objects, queue, lower=lower)
    for _ in copy_queued(spark, queue, reader, parallelism, fmt=fmt, strict=strict):
        pass
    return queue_states(spark, queue)
