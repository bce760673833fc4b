from __future__ import annotations

import json
import types
import uuid

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from lakeops import session
from lakeops.parallel import run_each
from lakeops.plans.audit_report import audit_report
from lakeops.sources import catalog, connector, snapshots
from tests.conftest import rows


@pytest.fixture
def echo(spark):
    """A source whose only row tells the options it was read with."""

    # Local classes travel to the workers by value.
    class EchoReader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def read(self, partition):
            yield (json.dumps(self.options, sort_keys=True),)

    class Echo(DataSource):
        @classmethod
        def name(cls):
            return "echo"

        def schema(self):
            return "OPTIONS string"

        def reader(self, schema):
            return EchoReader(dict(self.options))

    spark.dataSource.register(Echo)
    return "echo"


def told(df):
    return {k.lower(): v for k, v in json.loads(df.first()[0]).items()}


def test_connector_options(spark):
    base = {"url": "u", "user": "me"}
    assert connector.connector_options(base) == base
    assert connector.connector_options(base, "db", "") == {**base, "database": "db"}
    named = connector.connector_options(base, "db", "s", database_key="whDatabase", schema_key="whSchema")
    assert named == {**base, "whDatabase": "db", "whSchema": "s"}


def test_connector_scans(spark, echo):
    base = {"url": "u"}
    assert told(connector.scan_query(spark, echo, base, "SELECT 1")) == {"url": "u", "query": "SELECT 1"}
    assert told(connector.scan_table(spark, echo, base, 'S"x', "t")) == {"url": "u", "dbtable": '"S""x"."t"'}
    split = told(connector.scan_table(spark, echo, base, "s", "t", split=("id", 0, 100, 4)))
    assert split["partitioncolumn"] == "id" and split["numpartitions"] == "4" and split["upperbound"] == "100"


def test_large_tables_are_read_in_ranges(spark, echo, monkeypatch):
    base = {"url": "u"}
    asked = told(connector.scan_query(spark, echo, base, "SELECT 1 AS id", split=("id", 1, 9, 2)))
    assert asked["dbtable"] == "(SELECT 1 AS id) source" and "query" not in asked and asked["lowerbound"] == "1"

    sent = []

    def bounds(spark_, fmt, options, sql, split=None):
        sent.append((sql, split))
        return spark.createDataFrame([(5, 50, 31)], "low int, high int, n bigint")

    monkeypatch.setattr(connector, "scan_query", bounds)
    assert connector.split_by(spark, echo, base, "s", "t", "k", 4) == ("k", 5, 50, 8)
    assert sent == [('SELECT MIN("k") AS low, MAX("k") AS high, COUNT(*) AS n FROM "s"."t"', None)]
    read = connector.table_reader(spark, echo, base, part_rows=8)
    time_column = Row(column_ordinal=1, column_name="at", target_type="time_text")
    plain = Row(src_db="DB", schema="s", name="t", split_column="k")
    assert told(read(plain))["partitioncolumn"] == "k"
    read(Row(src_db="DB", schema="s", name="t", split_column="k", columns=[time_column]))
    assert sent[-1] == ("SELECT TO_VARCHAR(\"at\", 'HH24:MI:SS') AS \"at\" FROM \"s\".\"t\"", ("k", 5, 50, 4))


def test_metadata_is_one_query_per_database(spark, echo):
    found = connector.scan_metadata(spark, echo, {"url": "u"}, ["A", "B"], "views", database_key="db")
    assert found.columns == ["options", "src_db"]
    sent = {r.src_db: json.loads(r.options) for r in found.collect()}
    assert sorted(sent) == ["A", "B"]
    assert sent["B"]["db"] == "B"
    assert sent["B"]["query"] == "SELECT table_schema, table_name, view_definition FROM B.information_schema.views"


def test_a_database_that_refuses_is_noted(spark, monkeypatch):
    def ask(spark_, fmt, options, sql, split=None):
        if "bad" in sql:
            raise RuntimeError("login refused")
        return spark.createDataFrame([("S", "T", "VIEW")], "TABLE_SCHEMA string, TABLE_NAME string, TABLE_TYPE string")

    monkeypatch.setattr(connector, "scan_query", ask)
    refused = {}
    found = connector.scan_metadata(spark, "x", {}, ["good", "bad"], "tables", refused=refused)
    assert rows(found, "src_db") == [("good",)] and refused == {"bad": "login refused"}
    none = connector.scan_metadata(spark, "x", {}, ["bad"], "columns", refused=refused)
    assert none.columns[-2:] == ["column_ordinal", "src_db"] and none.count() == 0
    with pytest.raises(RuntimeError):
        connector.scan_metadata(spark, "x", {}, ["bad"], "tables")


def test_a_table_without_split_column_is_warned_of(spark, monkeypatch):
    monkeypatch.setattr(connector, "scan_table", lambda *a, **k: spark.range(1))
    with pytest.warns(UserWarning, match="split_column"):
        connector.table_reader(spark, "jdbc", {})(Row(src_db="DB", schema="s", name="t"))


@pytest.fixture
def database(spark):
    name = f"cat_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    spark.range(3).write.saveAsTable(f"{name}.t")
    spark.sql(f"CREATE VIEW {name}.v AS SELECT id, 'MANAGED' AS type FROM {name}.t")
    return name


def test_catalog(spark, database):
    spark.range(1).createOrReplaceTempView("a_temporary_view")
    found = catalog.discover_spark(spark, [database, "Information_Schema"])
    assert rows(found, "catalog", "name") == [(None, "t"), (None, "v")]
    assert rows(catalog.discover_spark(spark, [database], catalog="spark_catalog"), "catalog", "name") == [
        ("spark_catalog", "t"), ("spark_catalog", "v"),
    ]
    assert database in {r.database for r in catalog.list_schemas(spark, "spark_catalog").collect()}
    others = catalog.list_schemas(spark, skip_schemas=[database.upper()])
    assert rows(others.filter(F.col("database") == database)) == []


def test_classification(spark, database):
    missing = spark.createDataFrame([(None, database, "gone")], catalog.FOUND_SCHEMA)
    objects = catalog.discover_spark(spark, [database]).union(missing)
    got = {r.name: r for r in catalog.classify_spark(spark, objects).collect()}
    # A column called "type" does not hide that v is a view.
    assert (got["t"].kind, got["v"].kind, got["gone"].kind) == ("table", "view", "failed")
    assert got["v"].ddl.startswith("CREATE VIEW") and got["gone"].error


def test_scans_of_a_federated_catalog(spark, database):
    assert connector.scan_table(spark, None, None, database, "t").count() == 3
    assert connector.scan_query(spark, None, None, f"SELECT max(id) AS m FROM {database}.t").first().m == 2


def test_shared_folder(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert spark.sparkContext.getCheckpointDir().startswith(f"file:{named}")
    cluster = types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda key, default: None),
        sparkContext=types.SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(cluster)


def test_run_each_draws_only_a_few_ahead(spark):
    drawn = []

    def items():
        for i in range(100):
            drawn.append(i)
            yield i

    results = run_each(items(), lambda i: i * 2, parallelism=2)
    next(results)
    assert len(drawn) <= 4
    assert len(list(results)) == 99


def test_snapshots_give_the_report(spark, tmp_path):
    def write(record, *records):
        (tmp_path / record).write_text("\n".join(json.dumps(r) for r in records))
        return snapshots.read_snapshot(spark, record, str(tmp_path / record))

    jobs = write(
        "jobs",
        {"job_id": 1, "settings": {"name": "a", "tasks": [{"existing_cluster_id": "c"}, {"existing_cluster_id": "c"}]}},
        {"job_id": 2, "settings": {"name": "b"}},
        {"job_id": 3},
    )
    sizes = {"min_workers": 1, "max_workers": 3}
    clusters = write("clusters", {"cluster_id": "c", "cluster_name": "C", "autoscale": sizes})
    running = {"life_cycle_state": "RUNNING"}
    runs = write("runs", {"job_id": 1, "run_id": 5, "start_time": 1704153600000, "state": running})
    used = {"sku_name": "A", "usage_start_time": "2024-01-02T00:00:00Z"}
    usage = write(
        "usage",
        {**used, "usage_quantity": 2.5, "usage_metadata": {"cluster_id": "c"}},
        {**used, "usage_quantity": 9, "usage_metadata": {}},
    )
    prices = write("prices", {"sku_name": "A", "price_start_time": "2020-01-01T00:00:00Z", "pricing": {"default": 0.4}})
    report = audit_report(
        snapshots.jobs_input(jobs), snapshots.tasks_input(jobs), snapshots.clusters_input(clusters),
        snapshots.runs_input(runs), snapshots.usage_input(usage), snapshots.prices_input(prices),
        "https://h/", "2024-01-31", 30,
    )
    row = report.drop("snapshot_timestamp").collect()
    assert len(row) == 1
    row = row[0].asDict()
    assert {k: str(v) for k, v in row.items()} == {
        "job_id": "1", "job_name": "a", "job_url": "https://h/jobs/1", "cluster_id": "c", "cluster_name": "C",
        "worker_node_type": "Unknown", "driver_node_type": "Unknown", "workers_config": "Autoscale 1-3",
        "autoscale_min_workers": "1", "autoscale_max_workers": "3", "spark_version": "Unknown", "latest_run_id": "5",
        "latest_run_start_time": "2024-01-02 00:00:00", "latest_run_state": "RUNNING", "num_tasks_on_cluster": "2",
        "total_dbus_consumed": "2.50", "estimated_cost_usd": "1.00",
    }
