from __future__ import annotations

import uuid
from collections import Counter

import pytest
from pyspark.sql.datasource import DataSource, DataSourceReader

from lakeops.plans.federated import federated_copy
from lakeops.plans.migration import migrate_warehouse, run_migration
from lakeops.sinks.runlog import run_summary

TABLES = "src_db string, table_schema string, table_name string, table_type string"
VIEWS = "src_db string, table_schema string, table_name string, view_definition string"
PROCS = (
    "src_db string, procedure_schema string, procedure_name string, argument_signature string, return_type string, "
    "procedure_language string, procedure_definition string, comment string"
)
COLUMNS = (
    "src_db string, table_schema string, table_name string, column_ordinal int, column_name string, "
    "data_type string, numeric_precision int, numeric_scale int"
)


@pytest.fixture
def schema():
    return f"S_{uuid.uuid4().hex[:8]}".upper()


def run(spark, schema, **options):
    mapping = spark.createDataFrame([("wh", "spark_catalog")], "source_database string, destination_catalog string")
    views = [
        ("TOP", f"CREATE VIEW TOP AS SELECT * FROM WH.{schema}.MID"),
        ("MID", f'CREATE OR REPLACE SECURE VIEW MID (K, TOTAL) AS SELECT id, ZEROIFNULL(n) AS n FROM "WH".{schema}.T'),
        ("LOOP1", f"CREATE VIEW LOOP1 AS SELECT * FROM WH.{schema}.LOOP2"),
        ("LOOP2", f"CREATE VIEW LOOP2 AS SELECT * FROM WH.{schema}.LOOP1"),
        ("LOST", "CREATE VIEW LOST AS SELECT * FROM B.S.T, A.S.T"),
        ("EMPTY", None),
    ]
    tables = [("T", "BASE TABLE"), ("BAD", "BASE TABLE")] + [(v, "VIEW") for v, _ in views]
    procs = [("P1", "()", None, None, "BEGIN END", None), ("P2", None, "INT", "python", "x", "it's")]

    def read(o):
        if o.name == "BAD":
            raise ValueError("unreadable")
        return spark.sql("SELECT id, IF(id = 1, NULL, id) AS n, '10:00:00.5' AS at FROM range(3)")

    columns = [("ID", "NUMBER", 9, 0), ("N", "NUMBER", 18, 0), ("AT", "TIME", None, None)]
    return run_migration(
        spark,
        mapping,
        spark.createDataFrame([("WH", schema, *t) for t in tables], TABLES),
        spark.createDataFrame([("WH", schema, *v) for v in views], VIEWS),
        read,
        f"{schema}.run_log",
        "2026-01-01 00:00:00",
        columns=spark.createDataFrame([("WH", schema, "T", i, *c) for i, c in enumerate(columns)], COLUMNS),
        procedures=spark.createDataFrame([("WH", schema, *p) for p in procs], PROCS),
        **options,
    )


def by_name(log):
    return {r.table.split(".")[-1]: r for r in log.collect()}


def test_ordered_migration(spark, schema):
    log = run(spark, schema)
    got = by_name(log)
    assert {n: r.status for n, r in got.items()} == {
        "t": "table_created", "bad": "failed", "mid": "view_created", "top": "view_created", "loop1": "failed",
        "loop2": "failed", "lost": "failed", "empty": "failed", "p1": "inventoried_dbr_too_old",
        "p2": "inventoried_dbr_too_old",
    }
    assert got["t"].rows == 3 and got["bad"].error == "unreadable"
    assert got["lost"].error.startswith("missing dependency — view needs A.S.T, B.S.T which is not in this run.")
    assert got["empty"].error == "view definition is empty"
    assert spark.table(f"{schema}.t").dtypes == [("id", "int"), ("n", "bigint"), ("at", "string")]
    assert [tuple(r) for r in spark.table(f"{schema}.top").orderBy("K").collect()] == [(0, 0), (1, 0), (2, 2)]
    assert spark.table(f"{schema}.top").columns == ["K", "TOTAL"]
    summary = run_summary(log).first()
    assert (summary.n_objects, summary.n_tables, summary.n_views, summary.n_failed) == (10, 2, 6, 5)
    # Every run is appended, and what exists is replaced.
    assert run(spark, schema).count() == 20


def test_procedures_run_where_the_host_can(spark, schema):
    sent = []
    got = by_name(run(spark, schema, create_procedure=sent.append))
    assert got["p1"].status == "procedure_created"
    assert got["p2"].status == "inventoried_manual_port_python"
    name = f"`spark_catalog`.`{schema.lower()}`.`p1`"
    assert len(sent) == 1 and sent[0].startswith(f"CREATE OR REPLACE PROCEDURE {name} ()")

    def refuse(ddl):
        raise RuntimeError("not here")

    failed = [r for r in run(spark, schema, create_procedure=refuse).collect() if r.error == "not here"]
    assert [r.status for r in failed] == ["failed"]


@pytest.fixture
def connector(spark, schema):
    """A connector that answers the four metadata queries and the scans of two tables."""
    view = f"CREATE VIEW V AS SELECT TO_VARCHAR(K) AS k, AT FROM WH.{schema}.T"
    answers = {
        "information_schema.tables": (
            "TABLE_SCHEMA string, TABLE_NAME string, TABLE_TYPE string",
            [(schema, "T", "BASE TABLE"), (schema, "U", "BASE TABLE"), (schema, "V", "VIEW")],
        ),
        "information_schema.views": (
            "TABLE_SCHEMA string, TABLE_NAME string, VIEW_DEFINITION string", [(schema, "V", view)],
        ),
        "information_schema.columns": (
            "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string, NUMERIC_PRECISION int, "
            "NUMERIC_SCALE int, COLUMN_ORDINAL int",
            [(schema, "T", "AT", "TIME", None, None, 2), (schema, "T", "K", "NUMBER", 5, 0, 1)],
        ),
        "information_schema.procedures": (
            "PROCEDURE_SCHEMA string, PROCEDURE_NAME string, ARGUMENT_SIGNATURE string, RETURN_TYPE string, "
            "PROCEDURE_LANGUAGE string, PROCEDURE_DEFINITION string, COMMENT string",
            [(schema, "P", None, None, "JAVA", "x", None)],
        ),
        f"SELECT \"K\", TO_VARCHAR(\"AT\", 'HH24:MI:SS') AS \"AT\" FROM \"{schema}\".\"T\"": (
            "K long, AT string", [(1, "01:02:03"), (2, "04:05:06")],
        ),
        f'"{schema}"."U"': ("X string", [("x",)]),
    }

    def answer(options):
        asked = options.get("query") or options["dbtable"]
        assert options["db"] == "WH" and options["user"] == "me"
        return next(value for key, value in answers.items() if key in asked)

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def read(self, partition):
            yield from answer(self.options)[1]

    class Warehouse(DataSource):
        @classmethod
        def name(cls):
            return "answers"

        def schema(self):
            return answer(self.options)[0]

        def reader(self, schema):
            return Reader(dict(self.options))

    spark.dataSource.register(Warehouse)
    return "answers"


def test_migration_through_a_connector(spark, schema, connector):
    mapping = spark.createDataFrame([("WH", "spark_catalog")], "source_database string, destination_catalog string")
    log = migrate_warehouse(spark, mapping, connector, {"user": "me"}, f"{schema}.log", database_key="db")
    got = {n: (r.status, r.rows, r.error) for n, r in by_name(log).items()}
    assert got == {
        "t": ("table_created", 2, None), "u": ("table_created", 1, None), "v": ("view_created", None, None),
        "p": ("inventoried_dbr_too_old", None, None),
    }
    assert spark.table(f"{schema}.t").dtypes == [("K", "int"), ("AT", "string")]
    assert sorted(tuple(r) for r in spark.table(f"{schema}.v").collect()) == [("1", "01:02:03"), ("2", "04:05:06")]


@pytest.mark.parametrize("unit", ["database", "catalog"])
def test_federated_copy(spark, unit):
    source, destination = (f"{n}_{uuid.uuid4().hex[:8]}" for n in ("from", "into"))
    spark.sql(f"CREATE DATABASE {source}")
    spark.range(5).write.saveAsTable(f"{source}.T")
    spark.sql(f"CREATE VIEW {source}.z AS SELECT * FROM {source}.T")
    spark.sql(f"CREATE VIEW {source}.a AS SELECT id AS type FROM `{source}`.z WHERE id > 2")
    if unit == "catalog":
        # One catalog is all there is here: it is copied onto itself, so tables refuse to be overwritten.
        everything_else = [r.namespace for r in spark.sql("SHOW SCHEMAS").collect() if r.namespace != source]
        pairs = [("spark_catalog", "spark_catalog")]
        options = {"skip_schemas": everything_else}
    else:
        pairs, options = [(source, destination)], {}
    mapping = spark.createDataFrame(pairs, "source_catalog string, destination_catalog string")
    got = by_name(federated_copy(spark, mapping, unit=unit, **options))
    if unit == "catalog":
        assert got["t"].status == "failed" and got["a"].status == got["z"].status == "view_created"
        assert spark.table(f"{source}.T").count() == 5
    else:
        assert {n: (r.status, r.rows) for n, r in got.items()} == {
            "t": ("table_created", 5), "a": ("view_created", None), "z": ("view_created", None),
        }
        spark.sql(f"DROP DATABASE {source} CASCADE")
        assert [r.type for r in spark.table(f"{destination}.a").orderBy("type").collect()] == [3, 4]


def test_a_run_repeated_under_its_name_is_logged_once(spark, schema):
    for _ in range(2):
        log = run(spark, schema, run_id="nightly")
    assert log.count() == 10
    again = [run(spark, schema, queue=f"{schema}.queue") for _ in range(2)][-1]
    # The unreadable table is tried again, and so is in the log of both attempts; nothing else is there twice.
    of_queue = [r for r in again.collect() if f"{schema}.queue" in r.batch]
    assert sorted(Counter(r.table.split(".")[-1] for r in of_queue).items()) == [
        ("bad", 2), ("empty", 1), ("loop1", 1), ("loop2", 1), ("lost", 1), ("mid", 1), ("p1", 1), ("p2", 1), ("t", 1), ("top", 1),
    ]
