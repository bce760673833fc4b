"""Exported snapshots of jobs, clusters, runs, usage and prices, in their service shape.

A snapshot is read with its declared schema, so a field no record holds is
null instead of missing, and nothing is scanned to infer types. The ``*_input``
functions give the flat columns the operators take by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.audit import flatten_tasks

# Record schemas.
SCHEMAS = {
    "jobs": "job_id bigint, settings struct<name: string, tasks: array<struct<existing_cluster_id: string>>>",
    "clusters": "cluster_id string, cluster_name string, node_type_id string, driver_node_type_id string, "
    "num_workers int, autoscale struct<min_workers: int, max_workers: int>, spark_version string, "
    "cluster_source string",
    "runs": "job_id bigint, run_id bigint, start_time bigint, "
    "state struct<result_state: string, life_cycle_state: string>",
    "usage": "sku_name string, usage_start_time timestamp, usage_quantity decimal(38,18), "
    "usage_metadata struct<cluster_id: string>",
    "prices": "sku_name string, price_start_time timestamp, price_end_time timestamp, "
    "pricing struct<`default`: decimal(38,18)>",
}


def read_snapshot(spark: SparkSession, record: str, path: str, fmt: str = "json") -> DataFrame:
    """Records of one kind (a key of ``SCHEMAS``) from JSON, parquet or another file format."""
    return spark.read.schema(SCHEMAS[record]).format(fmt).load(path)


def jobs_input(jobs: DataFrame) -> DataFrame:
    return jobs.select("job_id", F.col("settings.name").alias("job_name"))


def tasks_input(jobs: DataFrame) -> DataFrame:
    return flatten_tasks(jobs)


def clusters_input(clusters: DataFrame) -> DataFrame:
    return clusters.withColumns(
        {"autoscale_min": F.col("autoscale.min_workers"), "autoscale_max": F.col("autoscale.max_workers")}
    ).drop("autoscale")


def runs_input(runs: DataFrame) -> DataFrame:
    return runs.select("job_id", "run_id", "start_time", "state.result_state", "state.life_cycle_state")


def usage_input(usage: DataFrame) -> DataFrame:
    return usage.withColumn("cluster_id", F.col("usage_metadata.cluster_id")).drop("usage_metadata")


def prices_input(prices: DataFrame) -> DataFrame:
    return prices.withColumn("price", F.col("pricing.default")).drop("pricing")
