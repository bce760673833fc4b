from __future__ import annotations

import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lakeops.operators import procedures, typing_plan
from lakeops.sinks import runlog, tables, views
from tests.conftest import rows

COLUMNS = (
    "column_ordinal int, column_name string, data_type string, numeric_precision int, numeric_scale int"
)


def plan_of(spark, *columns):
    return typing_plan.type_plan(spark.createDataFrame([(i, *c) for i, c in enumerate(columns)], COLUMNS))


@pytest.fixture
def database(spark):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def test_target_types(spark):
    cases = [
        (("NUMBER", 9, 0), "int"),
        (("number", 10, 0), "bigint"),
        (("DECIMAL", None, None), "bigint"),
        (("NUMERIC", 0, 0), "bigint"),
        (("NUMBER", 38, 0), "bigint"),
        (("NUMBER", 5, None), "int"),
        (("NUMBER", 10, 2), None),
        (("TIME", None, None), "time_text"),
        (("Timestamp_NTZ", None, None), "timestamp_ntz"),
        (("timestamp without time zone", None, None), "timestamp_ntz"),
        (("TIMESTAMP_TZ", None, None), None),
        (("FLOAT", None, None), None),
    ]
    plan = plan_of(spark, *[(f"c{i}", *c) for i, (c, _) in enumerate(cases)])
    assert [r.target_type for r in plan.orderBy("column_ordinal").collect()] == [t for _, t in cases]


def test_plan_is_applied_in_column_order(spark):
    df = spark.sql(
        "SELECT CAST(7 AS DECIMAL(38,0)) n, '12:34:56.789' t, TIMESTAMP_NTZ'2024-01-02 03:04:05.6' ts, "
        "TIMESTAMP'2024-01-02 03:04:05.6' z, CAST(1.25 AS DECIMAL(10,2)) d, 'x' extra"
    )
    plan = plan_of(
        spark, ("Z", "TIMESTAMP_NTZ", None, None), ("TS", "TIME", None, None), ("T", "TIME", None, None),
        ("D", "NUMBER", 10, 2), ("N", "NUMBER", 38, 0),
    )
    got = typing_plan.apply_type_plan(df, plan)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("z", "timestamp_ntz"), ("ts", "string"), ("t", "string"), ("d", "decimal(10,2)"), ("n", "bigint"),
        ("extra", "string"),
    ]
    instant = datetime(2024, 1, 2, 3, 4, 5, 600000)
    assert tuple(got.first()) == (instant, "03:04:05", "12:34:56", Decimal("1.25"), 7, "x")
    with pytest.raises(ValueError, match="NOWHERE"):
        typing_plan.apply_type_plan(df, plan_of(spark, ("NOWHERE", "TEXT", None, None)))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_do_not_fit(spark, setting, ansi):
    setting("spark.sql.ansi.enabled", ansi)
    df = spark.createDataFrame([(Decimal(10) ** 30,), (Decimal(1),), (None,)], "n decimal(38,0)")
    plan = plan_of(spark, ("N", "NUMBER", 38, 0))
    with pytest.raises(Exception, match="column n does not fit bigint: 1000000000000000000000000000000"):
        typing_plan.apply_type_plan(df, plan).collect()
    assert rows(typing_plan.apply_type_plan(df, plan, strict=False)) == [(1,), (None,), (None,)]
    assert rows(typing_plan.overflow_counts(df, plan)) == [("N", 1)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_lost_fraction_does_not_fit(spark, setting, ansi):
    setting("spark.sql.ansi.enabled", ansi)
    plan = [Row(column_ordinal=1, column_name="N", target_type="int")]
    for kind, values in (("decimal(10,2)", ("1.75", "2.00")), ("double", ("1.75", "2")), ("string", ("1.75", "2.0"))):
        df = spark.createDataFrame([(v,) for v in values], "N string").select(F.col("N").cast(kind))
        assert rows(typing_plan.overflow_counts(df, plan)) == [("N", 1)]
        assert rows(typing_plan.apply_type_plan(df, plan, strict=False)) == [(2,), (None,)]
        with pytest.raises(Exception, match="does not fit int"):
            typing_plan.apply_type_plan(df, plan).collect()
    untyped = [Row(column_ordinal=1, column_name="N", target_type=None)]
    assert rows(typing_plan.overflow_counts(df, untyped)) == []


def test_objects_with_one_destination_are_not_written(spark, database):
    objects = spark.createDataFrame([("spark_catalog", database, n) for n in ("T", "t", "u")], "dst_cat string, schema string, name string")
    done = {(r.table.split(".")[-1], r.status, r.rows) for r in tables.copy_tables(spark, objects, lambda o: spark.range(5)).collect()}
    assert done == {("t", "failed", None), ("u", "table_created", 5)}
    assert not spark.catalog.tableExists(f"{database}.t")


def test_thousands_of_names_make_a_flat_plan(spark):
    counted = tables.copy_counts(spark, [])
    assert counted.columns == ["table", "n_rows"] and counted.count() == 0
    outcomes = tables.outcomes_frame(spark, ((f"t{k}", "table", "failed", None, "x" * 100) for k in range(3500)))
    assert outcomes.count() == 3500
    assert "Union" not in outcomes._jdf.queryExecution().toString()


def test_plans_by_table_keep_order(spark):
    plan = plan_of(spark, ("b", "TEXT", None, None), ("a", "TIME", None, None)).withColumn("t", F.lit("x"))
    assert [(c.column_name, c.target_type) for c in typing_plan.plans_by_table(plan, "t").first()["columns"]] == [
        ("b", None), ("a", "time_text"),
    ]


def test_overwrite_replaces_the_schema(spark, database):
    tables.overwrite_table(spark.range(3), f"{database}.t")
    tables.overwrite_table(spark.createDataFrame([("a", 1)], "x string, y int"), f"{database}.t")
    assert rows(spark.table(f"{database}.t")) == [("a", 1)]


def objects_of(spark, *found, catalog="spark_catalog"):
    named = [("src", catalog, schema, name) for schema, name in found]
    return spark.createDataFrame(named, "src_db string, dst_cat string, schema string, name string")


def test_one_failure_does_not_stop_the_copy(spark, database):
    def read(o):
        if o.name == "BAD":
            raise ValueError("no such table")
        return spark.range(int(o.name[1:]))

    names = [f"T{i}" for i in range(12)] + ["BAD"]
    new_schema = f"{database}_New".upper()
    done = tables.copy_tables(spark, objects_of(spark, *[(new_schema, n) for n in names]), read, parallelism=3)
    got = {r.table.split(".")[-1]: (r.kind, r.status, r.rows, r.error) for r in done.collect()}
    assert got.pop("bad") == ("table", "failed", None, "no such table")
    assert got == {f"t{i}": ("table", "table_created", i, None) for i in range(12)}
    counted = tables.copy_counts(spark, [f"{new_schema.lower()}.t{i}" for i in (0, 5, 11)])
    assert sorted(r.n_rows for r in counted.collect()) == [0, 5, 11]


def test_schema_that_cannot_be_made_fails_its_own_tables(spark, database):
    good = objects_of(spark, (database, "T"))
    bad = objects_of(spark, ("s", "T"), catalog="no_such_catalog")
    got = {r.table: r.status for r in tables.copy_tables(spark, good.union(bad), lambda o: spark.range(1)).collect()}
    assert got == {f"spark_catalog.{database}.t": "table_created", "no_such_catalog.s.t": "failed"}


def test_copy_with_type_plan(spark, database):
    plan = plan_of(spark, ("ID", "NUMBER", 9, 0)).withColumn("name", F.lit("T"))
    objects = objects_of(spark, (database, "T")).join(typing_plan.plans_by_table(plan, "name"), "name")
    assert tables.copy_tables(spark, objects, lambda o: spark.range(3)).first().status == "table_created"
    assert spark.table(f"{database}.t").dtypes == [("id", "int")]


def log_rows(spark, *names, kind=True):
    schema = "`table` string, kind string, status string, `rows` bigint, error string"
    df = spark.createDataFrame([(n, "table", "table_created", 1, None) for n in names], schema)
    return df if kind else df.drop("kind")


def test_log_gains_columns(spark, database):
    log = f"{database}.log"
    assert runlog.append_run_log(spark, log_rows(spark, kind=False), log, "t0").count() == 0
    runlog.append_run_log(spark, log_rows(spark, "a", kind=False), log, "t1")
    runlog.append_run_log(spark, log_rows(spark, "b", "c"), log, "t2")
    runlog.append_run_log(spark, log_rows(spark), log, "t3")
    done = runlog.append_run_log(spark, log_rows(spark, "d", kind=False), log, "t4")
    assert rows(done, "table", "kind", "rows", "migrated_at") == [
        ("a", None, 1, "t1"), ("b", "table", 1, "t2"), ("c", "table", 1, "t2"), ("d", None, 1, "t4"),
    ]


def test_summary_counts_tried_and_created(spark):
    log = spark.createDataFrame(
        [
            ("table", "table_created"), ("table", "failed"), ("view", "view_created"), ("view", "failed"),
            ("procedure", "procedure_created"), ("procedure", "inventoried_dbr_too_old"),
            ("procedure", "inventoried_manual_port_python"), ("procedure", "inventoried_manual_port_java"),
        ],
        "kind string, status string",
    )
    assert runlog.run_summary(log).first().asDict() == {
        "n_objects": 8, "n_tables": 2, "n_tables_created": 1, "n_views": 2, "n_views_created": 1,
        "n_procedures_created": 1, "n_procedures_manual_port": 2, "n_procedures_host_too_old": 1, "n_failed": 2,
    }


def test_views_are_built_by_level(spark, database):
    tables.overwrite_table(spark.range(4), f"{database}.base")
    full = f"spark_catalog.{database}"
    planned = spark.createDataFrame(
        [
            (1, f"{full}.a", f'CREATE OR REPLACE VIEW {full}.a AS SELECT * FROM "spark_catalog".{database}."b"'),
            (0, f"{full}.b", f"CREATE OR REPLACE VIEW {full}.b (n) AS SELECT id FROM {full}.base"),
            (0, f"{full}.c", None),
            (2, f"{full}.d", f"CREATE OR REPLACE VIEW {full}.d AS SELECT * FROM {full}.nothing"),
        ],
        "level int, dst_plain string, statement string",
    )
    done = {r.table: (r.status, r.error) for r in views.recreate_views(spark, planned).collect()}
    assert done[f"{full}.a"] == done[f"{full}.b"] == ("view_created", None)
    assert done[f"{full}.c"] == ("failed", "view definition is empty")
    assert done[f"{full}.d"][0] == "failed" and "nothing" in done[f"{full}.d"][1]
    # The names stay names after the session option is back to what it was.
    assert spark.conf.get(views.QUOTED_NAMES[1]) == "false"
    assert spark.table(f"{full}.a").agg(F.sum("n")).first()[0] == 6


PROCS = (
    "src_db string, dst_cat string, dst_schema string, dst_name string, arg_sig string, language string, "
    "body string, comment string"
)


def test_quoted_names_of_views_are_names_in_any_mode(spark, setting, database):
    setting("spark.sql.ansi.enabled", "false")
    setting("spark.sql.ansi.doubleQuotedIdentifiers", "false")
    spark.sql(f"CREATE TABLE {database}.t AS SELECT 1 AS a")
    statement = f'CREATE OR REPLACE VIEW {database}.v AS SELECT "a" AS b FROM {database}.t'
    view = spark.createDataFrame([(0, "v", statement)], "level int, dst_plain string, statement string")
    assert rows(views.recreate_views(spark, view), "status") == [("view_created",)]
    assert rows(spark.table(f"{database}.v")) == [(1,)]
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"


def test_procedure_text(spark):
    def ddl(arg_sig, language, body, comment):
        row = ("DB", "Cat", "s", "p`q", arg_sig, language, body, comment)
        return procedures.procedure_ddl(spark.createDataFrame([row], PROCS)).first().ddl

    head = "CREATE OR REPLACE PROCEDURE `Cat`.`s`.`p``q` (X INT)\nLANGUAGE SQL\nSQL SECURITY INVOKER\n"
    assert ddl("X INT", "SQL", "BEGIN db.s.t; END", "it's") == head + "COMMENT 'it''s'\nAS\nBEGIN cat.s.t; END"
    assert ddl("(X INT)", "SQL", "b", "") == ddl("X INT", "SQL", "b", None) == head + "AS\nb"
    assert ddl("()", "PYTHON", "b", None) is None
    assert ddl("()", "SQL", None, None) is None


def test_batch_translation_keeps_rows_without_body(spark):
    staged = spark.createDataFrame(
        [
            ("a", "t.a", "PYTHON", "()", None, "body a", None, "DB", "cat"),
            ("b", "t.b", "JAVA", "()", "INT", None, None, "DB", "cat"),
        ],
        "source_name string, target_name string, language string, arg_signature string, return_type string, "
        "original_body string, comment string, source_db string, target_catalog string",
    )
    request = {r.source_name: r.request for r in procedures.translation_request(staged, "Do it.").collect()}
    assert request["b"] is None
    assert "return_type: VARIANT\n" in request["a"] and request["a"].startswith("Do it.\n\nsource_name: a\n")
    got = procedures.translate(staged, lambda requests: [f"{len(r)}" for r in requests], instruction="Do it.")
    with pytest.raises(ValueError, match="instruction"):
        procedures.translate(staged, lambda requests: requests)
    assert {r.source_name: r.translated_sql for r in got.collect()} == {"a": str(len(request["a"])), "b": None}
    assert [f.name for f in got.schema] == [
        "source_name", "target_name", "language", "original_body", "translated_sql", "translated_at", "applied",
    ]
    assert procedures.to_review(got).count() == 2
    numbers = F.sequence(F.lit(1), F.lit(40)).cast("array<string>")
    many = staged.withColumn("source_name", F.explode(numbers))
    spread = procedures.translate(many, lambda requests: ["x"] * len(requests), instruction="Do it.", tasks=8)
    assert spread.select(F.spark_partition_id()).distinct().count() > 4 and spread.count() == 80


def test_procedure_outcomes(spark):
    procs = spark.createDataFrame([("SQL",), ("JAVASCRIPT",)], "language string")
    can = rows(procedures.procedure_status(procs, True))
    assert can == [("JAVASCRIPT", "inventoried_manual_port_javascript"), ("SQL", "procedure_created")]
    assert {r.status for r in procedures.procedure_status(procs, False).collect()} == {"inventoried_dbr_too_old"}
