"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import (
    BODY, CALLS, N, PREFIXES, QUOTE, SRC, TABLES, TICK, fixture, given, over_given, text_of,
)
from lakeops.functions.calls import translate_functions
from lakeops.functions.names import object_id, plain_name, with_destination
from lakeops.functions.refs import extract_refs
from lakeops.functions.rewrite import rewrite_backtick, rewrite_dquote, select_body, view_columns
from lakeops.operators import audit, cost, cycles, deps, discovery, procedures, typing_plan
from lakeops.plans import translation
from lakeops.plans.audit_report import audit_report
from lakeops.plans.federated import federated_copy
from lakeops.plans.migration import IDENTITY, plan_views, preflight, run_migration
from lakeops.session import new_path, scratch_database, written_out
from lakeops.sinks import copy_queue, runlog, tables, verify, views
from lakeops.sources import catalog, connector, incremental, mapping, snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF, LOOKBACK, HOST = "1998-01-01", 365, "https://workspace.example/"
RUN_TS = "2026-01-01 00:00:00"
VIEW_ID = ("src_db", "table_schema", "table_name")


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


# --- audit -----------------------------------------------------------------


@query
def cost_rollup(spark, d):
    return cost.cost_rollup(fixture(spark, d, "fx_usage"), fixture(spark, d, "fx_prices"), "1997-01-01")


@query
def cost_rollup_nested(spark, d):
    """Same, on the nested shape of billing tables, without splitting prices by month."""
    usage = fixture(spark, d, "fx_usage").withColumn("usage_metadata", F.struct("cluster_id")).drop("cluster_id")
    prices = fixture(spark, d, "fx_prices").withColumn("pricing", F.struct(F.col("price").alias("default")))
    return cost.cost_rollup(
        usage, prices.drop("price"), "1997-01-01", ["usage_metadata.cluster_id"], price="pricing.default", grain=None
    )


@query
def cost_rollup_fine(spark, d):
    """Quantities of six and prices of eight decimal places."""
    return cost.cost_rollup(fixture(spark, d, "fx_fine_usage"), fixture(spark, d, "fx_fine_prices"), "1997-01-01")


def _interval_price_join(spark, d, grain):
    usage, prices = fixture(spark, d, "fx_usage"), fixture(spark, d, "fx_prices")
    return cost.interval_join(
        usage, prices, ["sku_name"], "usage_start_time", "price_start_time", "price_end_time", grain=grain
    )


@query
def interval_price_join(spark, d):
    return _interval_price_join(spark, d, None)


@query
def interval_price_join_by_month(spark, d):
    return _interval_price_join(spark, d, "month")


@query
def flatten_tasks(spark, d):
    """Orders as jobs, each with a task on its customer's cluster; some have no settings or no tasks."""
    customer = F.col("o_custkey")
    no_cluster = F.lit(None).cast("bigint")
    some = F.array(*[F.struct(c.alias("existing_cluster_id")) for c in (customer, no_cluster)])
    none = F.array().cast("array<struct<existing_cluster_id:bigint>>")
    task_list = F.when(F.col("o_orderstatus") == "F", some).when(F.col("o_orderstatus") == "O", none)
    jobs = given(spark, d, "orders").select(
        F.col("o_orderkey").alias("job_id"), F.struct(F.col("o_orderpriority").alias("name"), task_list.alias("tasks"))
        .alias("settings")
    )
    return audit.flatten_tasks(jobs)


@query
def job_cluster_usage(spark, d):
    return audit.job_cluster_usage(fixture(spark, d, "fx_jobs"), fixture(spark, d, "fx_tasks"))


@query
def latest_run(spark, d):
    return audit.latest_run(fixture(spark, d, "fx_runs"), AS_OF, LOOKBACK)


@query
def latest_run_epoch_ms(spark, d):
    """Events as runs of their user, with starts in epoch milliseconds."""
    runs = given(spark, d, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("user_id").alias("job_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("start_time"),
        F.nullif(F.upper("event_type"), F.lit("ERROR")).alias("result_state"),
        F.lit("TERMINATED").alias("life_cycle_state"),
    )
    return audit.latest_run(runs, "2024-01-31T00:00:00+00:00", 30)


@query
def cluster_dim(spark, d):
    return audit.cluster_dim(fixture(spark, d, "fx_clusters"))


@query
def cluster_lookup(spark, d):
    pairs = audit.task_pairs(fixture(spark, d, "fx_tasks"))
    return audit.cluster_lookup(pairs, audit.cluster_dim(fixture(spark, d, "fx_clusters")))


def _audit(spark, d, *cost_fixtures):
    names = ["fx_jobs", "fx_tasks", "fx_clusters", "fx_runs"]
    usage, prices = [fixture(spark, d, n) for n in cost_fixtures] or (None, None)
    stamp = F.lit(AS_OF).cast("timestamp_ntz")
    return audit_report(
        *[fixture(spark, d, n) for n in names], usage, prices, HOST, AS_OF, LOOKBACK, snapshot_at=stamp
    )


@query
def audit_report_query(spark, d):
    return _audit(spark, d, "fx_usage", "fx_prices")


@query
def audit_report_no_cost(spark, d):
    return _audit(spark, d)


@query
def audit_report_fine(spark, d):
    return _audit(spark, d, "fx_fine_usage", "fx_fine_prices")


def _records(spark, d) -> dict[str, DataFrame]:
    """The fixtures in the shape of exported records."""
    read = {n: fixture(spark, d, f"fx_{n}") for n in ("jobs", "tasks", "clusters", "runs", "usage", "prices")}
    text = lambda c: F.col(c).cast("string").alias(c)
    instant = lambda c: F.col(c).cast("timestamp").alias(c)
    tasks = read["tasks"].groupBy("job_id").agg(F.collect_list(F.struct(text("existing_cluster_id"))).alias("tasks"))
    return {
        "jobs": read["jobs"].join(tasks, "job_id", "left").select("job_id", F.struct(F.col("job_name").alias("name"), "tasks").alias("settings")),
        "clusters": read["clusters"].select(
            text("cluster_id"), "cluster_name", "node_type_id", "driver_node_type_id", "num_workers", "spark_version", "cluster_source",
            F.struct(F.col("autoscale_min").alias("min_workers"), F.col("autoscale_max").alias("max_workers")).alias("autoscale"),
        ),
        "runs": read["runs"].select(
            "job_id", "run_id", F.unix_millis(F.col("start_time").cast("timestamp")).alias("start_time"), F.struct("result_state", "life_cycle_state").alias("state")
        ),
        "usage": read["usage"].select("sku_name", instant("usage_start_time"), "usage_quantity", F.struct(text("cluster_id")).alias("usage_metadata")),
        "prices": read["prices"].select("sku_name", instant("price_start_time"), instant("price_end_time"), F.struct(F.col("price").alias("default")).alias("pricing")),
    }


def _exported(spark, d) -> dict[str, DataFrame]:
    """The records written and read again."""
    records, path = _records(spark, d), new_path(spark)
    for name, rows in records.items():
        rows.write.json(f"{path}/{name}")
    return {name: snapshots.read_snapshot(spark, name, f"{path}/{name}") for name in records}


@query
def audit_report_snapshots(spark, d):
    """The report over exported records."""
    return _audit_of(_exported(spark, d))


def _audit_of(found: dict[str, DataFrame]) -> DataFrame:
    return audit_report(
        snapshots.jobs_input(found["jobs"]), snapshots.tasks_input(found["jobs"]),
        snapshots.clusters_input(found["clusters"]), snapshots.runs_input(found["runs"]),
        snapshots.usage_input(found["usage"]), snapshots.prices_input(found["prices"]),
        HOST, AS_OF, LOOKBACK, snapshot_at=F.lit(AS_OF).cast("timestamp_ntz"),
    )


# --- discovery ---------------------------------------------------------------


def _mapping(spark, d) -> DataFrame:
    return mapping.clean_mapping(fixture(spark, d, "fx_mapping"))


def _objects(spark, d, **options) -> DataFrame:
    return discovery.discover_objects(
        _mapping(spark, d), fixture(spark, d, "fx_objects"), fixture(spark, d, "fx_procs"), **options
    )


@query
def mapping_clean(spark, d):
    return mapping.clean_mapping(fixture(spark, d, "fx_mapping").toDF(" Source_Database", "DESTINATION_CATALOG "))


@query
def discover_objects(spark, d):
    return _objects(spark, d)


@query
def discover_objects_ignore_case(spark, d):
    """System schemas skipped in any case; tables and views only."""
    return discovery.discover_objects(
        _mapping(spark, d),
        fixture(spark, d, "fx_objects"),
        skip_schemas=["information_schema", "pg_catalog", "sys"],
        ignore_case=True,
    )


@query
def object_counts(spark, d):
    return discovery.object_counts(_objects(spark, d, ordered=False))


@query
def destination_names(spark, d):
    placed = with_destination(_objects(spark, d, ordered=False))
    return placed.select("kind", "src_db", "name", "dst_schema", "dst_name", "dst_fq", "dst_plain")


def _views(spark, d) -> DataFrame:
    found = discovery.discover_objects(_mapping(spark, d), fixture(spark, d, "fx_objects"), ordered=False)
    return discovery.attach_definitions(found.filter("kind = 'view'"), fixture(spark, d, "fx_views"))


@query
def view_definitions_join(spark, d):
    return _views(spark, d)


# --- dependencies --------------------------------------------------------------


def _refs(spark, d) -> DataFrame:
    return extract_refs(fixture(spark, d, "fx_views"), VIEW_ID, "view_definition")


@query
def extract_refs_query(spark, d):
    return _refs(spark, d)


@query
def extract_refs_pages(spark, d):
    return extract_refs(given(spark, d, "pages"), ["page_id"], "url")


@query
def extract_refs_html(spark, d):
    return extract_refs(given(spark, d, "pages"), ["page_id"], "html")


@query
def extract_refs_documents(spark, d):
    return extract_refs(given(spark, d, "documents"), ["doc_id"], "text")


def _external(spark, d) -> DataFrame:
    return deps.external_refs(_refs(spark, d), _mapping(spark, d), id_cols=VIEW_ID)


@query
def external_refs(spark, d):
    return _external(spark, d)


@query
def external_refs_by_db(spark, d):
    return deps.external_refs_by_db(_external(spark, d))


@query
def migration_preflight(spark, d):
    found = preflight(_mapping(spark, d), fixture(spark, d, "fx_objects"), fixture(spark, d, "fx_views"))
    return found.orderBy("missing_db", "view_id", "ref")


def _edges(spark, d) -> DataFrame:
    return deps.view_edges(_refs(spark, d), fixture(spark, d, "fx_views"), id_cols=VIEW_ID)


def _nodes(spark, d) -> DataFrame:
    return fixture(spark, d, "fx_views").select(object_id(*[F.col(c) for c in VIEW_ID]).alias("view_id"))


@query
def view_edges(spark, d):
    return _edges(spark, d)


@query
def view_in_degree(spark, d):
    return deps.in_degree(_nodes(spark, d), _edges(spark, d))


def _levels(spark, d) -> DataFrame:
    return deps.dependency_levels(_nodes(spark, d), _edges(spark, d))


@query
def view_levels(spark, d):
    return _levels(spark, d)


@query
def view_levels_cycle(spark, d):
    """The dependencies of all views, with V6 and V7 made to read each other."""
    six_seven = _nodes(spark, d).filter("view_id IN ('DB1.PUB.V6', 'DB2.PUB.V7')")
    other = F.when(F.col("view_id") == "DB1.PUB.V6", "DB2.PUB.V7").otherwise("DB1.PUB.V6")
    edges = _edges(spark, d).unionByName(six_seven.withColumn("dep_id", other))
    return deps.dependency_levels(_nodes(spark, d), edges)


@query
def level_sizes(spark, d):
    return deps.level_sizes(_levels(spark, d))


# --- text ------------------------------------------------------------------------


def _part_texts(spark, d, template, **exprs) -> DataFrame:
    return over_given(spark, d, f"select p_partkey, {text_of(template, n=N, **exprs)} as text, {SRC} as src from part")


def _dst() -> Column:
    return F.concat(F.lit("New$"), F.col("src"))


@query
def rewrite_backtick_query(spark, d):
    texts = _part_texts(spark, d, TICK, s=SRC, o=SRC)
    return texts.select("p_partkey", rewrite_backtick(F.col("text"), F.col("src"), _dst()).alias("text"))


@query
def rewrite_dquote_query(spark, d):
    texts = _part_texts(spark, d, QUOTE, s=SRC, o=SRC, u=f"upper({SRC})", l=f"lower({SRC})")
    return texts.select("p_partkey", rewrite_dquote(F.col("text"), F.col("src"), _dst()).alias("text"))


@query
def select_body_query(spark, d):
    def one(i):
        template = PREFIXES[i] + BODY + "\n"
        return _part_texts(spark, d, template, s=SRC).withColumn("form", F.lit(i))

    texts = reduce(DataFrame.union, [one(i) for i in range(len(PREFIXES))])
    return texts.select(
        "p_partkey", "form", select_body(F.col("text")).alias("body"), view_columns(F.col("text")).alias("columns")
    )


@query
def translate_functions_query(spark, d):
    return _part_texts(spark, d, CALLS).select("p_partkey", translate_functions(F.col("text")).alias("text"))


@query
def translate_functions_documents(spark, d):
    """Whole documents as string literals inside calls."""
    literal = F.concat(F.lit("'"), F.replace("text", F.lit("'"), F.lit("''")), F.lit("'"))
    text = F.concat(F.lit("SELECT IFF(ZEROIFNULL(q) > 0, "), literal, F.lit(", TO_VARCHAR(r))"))
    return given(spark, d, "documents").select("doc_id", translate_functions(text).alias("text"))


# --- procedures --------------------------------------------------------------------


def _procs(spark, d) -> DataFrame:
    return with_destination(_objects(spark, d, ordered=False).filter("kind = 'procedure'"))


@query
def procedure_ddl(spark, d):
    return procedures.procedure_ddl(_procs(spark, d)).select("src_db", "name", "ddl")


@query
def procedure_status(spark, d):
    can = procedures.procedure_status(_procs(spark, d), True).select("src_db", "name", "status")
    cannot = procedures.procedure_status(_procs(spark, d), False).select("name", F.col("status").alias("status_old"))
    return can.join(cannot, "name")


def _staged(spark, d) -> DataFrame:
    return procedures.stage_procedures(fixture(spark, d, "fx_procs"), _mapping(spark, d))


@query
def stage_procedures(spark, d):
    name = f"{scratch_database(spark, 'staging')}.procedures"
    tables.overwrite_table(_staged(spark, d), name)
    return spark.table(name)


@query
def translation_request(spark, d):
    return procedures.translation_request(_staged(spark, d), "Translate.\n").select("source_name", "request")


@query
def translate_procedures(spark, d):
    database = scratch_database(spark, "translated")
    found = translation.translate_procedures(
        spark, _mapping(spark, d), fixture(spark, d, "fx_procs"), f"{database}.staged", f"{database}.translated"
    )
    return found.drop("translated_at")


@query
def translate_procedures_batch(spark, d):
    """With a caller's batch function; it sees requests only of rows that have a body."""

    def shout(requests: list[str]) -> list[str]:
        return [r.upper() for r in requests]

    return procedures.translate(_staged(spark, d), shout, instruction="Translate.\n").drop("translated_at")


# --- types ------------------------------------------------------------------------


@query
def type_plan(spark, d):
    return typing_plan.type_plan(fixture(spark, d, "fx_columns"))


@query
def type_plan_by_table(spark, d):
    plans = typing_plan.plans_by_table(typing_plan.type_plan(fixture(spark, d, "fx_columns")), "table_name")
    entry = F.transform(
        "columns", lambda c: F.concat_ws(":", c["column_name"], F.coalesce(c["target_type"], F.lit("-")))
    )
    return plans.select("table_name", F.array_join(entry, ",").alias("columns"))


def _stated_plan(spark, rows) -> DataFrame:
    """Column metadata as a source states it: (name, type, precision, scale)."""
    schema = "column_ordinal int, column_name string, data_type string, numeric_precision int, numeric_scale int"
    return typing_plan.type_plan(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema))


@query
def typed_copy(spark, d):
    plan = _stated_plan(spark, [
        ("L_ORDERKEY", "NUMBER", 38, 0), ("L_LINENUMBER", "number", 9, 0), ("L_QUANTITY", "DECIMAL", 9, None),
        ("L_EXTENDEDPRICE", "NUMBER", 12, 2), ("L_PARTKEY", "NUMERIC", None, None),
        ("L_SHIPDATE", "TIMESTAMP_NTZ", None, None), ("L_RETURNFLAG", "TEXT", None, None),
    ])
    return typing_plan.apply_type_plan(given(spark, d, "lineitem"), plan)


@query
def typed_copy_time(spark, d):
    """Events with their instant as a time of day, and as fractional text cut to seconds."""
    plan = _stated_plan(spark, [
        ("EVENT_ID", "NUMBER", 10, 0), ("TS", "TIME", None, None), ("TS_TEXT", "time", None, None),
        ("USER_ID", "NUMBER", 9, 0), ("VALUE", "NUMBER", 10, 2),
    ])
    texts = given(spark, d, "events").withColumn("ts_text", F.date_format("ts", "HH:mm:ss.SSS"))
    return typing_plan.apply_type_plan(texts, plan)


@query
def type_overflow(spark, d):
    plan = _stated_plan(spark, [("SMALL", "NUMBER", 9, 0), ("WIDE", "NUMBER", 38, 0), ("FLAG", "TEXT", None, None)])
    exact = F.col("l_extendedprice").cast("decimal(18,2)")
    df = given(spark, d, "lineitem").select(
        (exact * 100000).cast("decimal(38,0)").alias("SMALL"),
        (exact * 1000000000000).cast("decimal(38,0)").alias("WIDE"),
        F.col("l_returnflag").alias("FLAG"),
    )
    return typing_plan.overflow_counts(df, plan)


@query
def type_overflow_fraction(spark, d):
    """Fractions that a whole-number target would cut off."""
    plan = _stated_plan(spark, [("PART", "NUMBER", 9, None), ("WHOLE", "NUMBER", 38, 0)])
    cents = F.col("l_discount").cast("decimal(18,2)") * 100
    df = given(spark, d, "lineitem").select(
        (cents / 4).cast("decimal(18,2)").alias("PART"), cents.cast("decimal(18,2)").alias("WHOLE")
    )
    return typing_plan.overflow_counts(df, plan)


# --- copies and logs ------------------------------------------------------------------


def _warehouse(spark, d) -> str:
    """A database whose tables are the given files, read in place."""
    database = scratch_database(spark, "warehouse")
    for name in TABLES:
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{d}/{name}.parquet'")
    return database


def _source_tables(spark, source, destination) -> DataFrame:
    """Metadata of the warehouse; its schema is named like the destination database."""
    return catalog.discover_spark(spark, [source]).select(
        F.lit("WH").alias("src_db"),
        F.lit(destination.upper()).alias("table_schema"),
        F.upper("name").alias("table_name"),
        F.lit("BASE TABLE").alias("table_type"),
    )


def _to_session(spark) -> DataFrame:
    return spark.createDataFrame([("wh", "spark_catalog")], "source_database string, destination_catalog string")


def _neutral(df: DataFrame, database: str, *columns: str) -> DataFrame:
    """Replace the generated name of a scratch database."""
    return df.withColumns({c: F.regexp_replace(c, f"(?i){database}", "dst") for c in columns})


@query
def copy_snapshot(spark, d):
    source, destination = _warehouse(spark, d), scratch_database(spark, "snapshot")
    objects = discovery.discover_objects(_to_session(spark), _source_tables(spark, source, destination))
    copied = tables.copy_tables(
        spark, objects, lambda o: connector.scan_table(spark, None, None, source, o.name), parallelism=4
    )
    return _neutral(copied, destination, "table")


@query
def copy_name_clash(spark, d):
    """Two source tables whose names fold to one destination, beside one that is alone there."""
    source, destination = _warehouse(spark, d), scratch_database(spark, "clash")
    names = {"ORDERS": "orders", "Orders": "customer", "NATION": "nation"}
    objects = spark.createDataFrame(
        [("spark_catalog", destination, name) for name in names], "dst_cat string, schema string, name string"
    )
    copied = tables.copy_tables(spark, objects, lambda o: spark.table(f"{source}.{names[o.name]}"))
    written = F.lit(spark.catalog.tableExists(f"{destination}.orders"))
    return _neutral(copied.withColumn("written", written), destination, "table").select("table", "status", "rows", "written")


@query
def copy_counts(spark, d):
    database = _warehouse(spark, d)
    names = [f"{database}.{r.name}" for r in catalog.discover_spark(spark, [database]).toLocalIterator()]
    return _neutral(tables.copy_counts(spark, names), database, "table")


def _definitions(spark, source, destination) -> DataFrame:
    """Two views per table, the second reading the first."""
    found = _source_tables(spark, source, destination).select("table_schema", "table_name")
    full = "WH." + destination.upper()
    plain = F.format_string(f"CREATE VIEW {full}.V_%s AS SELECT * FROM {full}.%s", "table_name", "table_name")
    counted = F.format_string(
        f"create or replace secure view {full}.W_%s (N_ROWS) as "
        f'SELECT ZEROIFNULL(COUNT(*)) AS N FROM "WH".{full[3:]}.V_%s',
        "table_name",
        "table_name",
    )
    first = found.select(F.concat(F.lit("V_"), "table_name").alias("table_name"), plain.alias("view_definition"))
    second = found.select(F.concat(F.lit("W_"), "table_name").alias("table_name"), counted.alias("view_definition"))
    return first.union(second).select(
        F.lit("WH").alias("src_db"), F.lit(destination.upper()).alias("table_schema"), "table_name", "view_definition"
    )


def _view_metadata(definitions: DataFrame) -> DataFrame:
    return definitions.select("src_db", "table_schema", "table_name", F.lit("VIEW").alias("table_type"))


@query
def recreate_views(spark, d):
    """Views over the warehouse tables, each with its level and the rows it counts."""
    database = _warehouse(spark, d)
    definitions = _definitions(spark, database, database)
    objects = with_destination(
        discovery.discover_objects(_to_session(spark), _view_metadata(definitions), ordered=False)
    )
    planned, _ = plan_views(objects, definitions)
    created = views.recreate_views(spark, planned)
    counted = [
        spark.table(f"{database}.w_{name}").select(F.lit(f"w_{name}").alias("name"), F.col("n_rows").alias("n"))
        for name in TABLES
    ]
    placed = planned.select(F.col("dst_plain").alias("table"), "level", F.col("dst_name").alias("name"))
    rows = created.join(placed, "table")
    result = rows.join(reduce(DataFrame.union, counted), "name", "left")
    return result.select("name", "level", "status", "n")


@query
def ordered_migration(spark, d):
    """The whole run: tables, procedures and views, with one view that needs a missing database."""
    source, destination = _warehouse(spark, d), scratch_database(spark, "migrated")
    broken = [("WH", destination.upper(), "BROKEN", "CREATE VIEW BROKEN AS SELECT * FROM EXT.PUB.T")]
    definitions = _definitions(spark, source, destination)
    definitions = definitions.union(spark.createDataFrame(broken, definitions.schema))
    procs = fixture(spark, d, "fx_procs").withColumns(
        {"src_db": F.lit("WH"), "procedure_schema": F.lit(destination.upper())}
    )
    log = run_migration(
        spark,
        _to_session(spark),
        _source_tables(spark, source, destination).union(_view_metadata(definitions)),
        definitions,
        lambda o: connector.scan_table(spark, None, None, source, o.name),
        f"{destination}.run_log",
        RUN_TS,
        procedures=procs,
    )
    short = F.split("error", " original error: ")[0]
    return _neutral(log.drop("batch").withColumn("error", short), destination, "table")


@query
def federated_copy_query(spark, d):
    """Tables and views of one database copied to another; a view may read a later view."""
    source, destination = _warehouse(spark, d), scratch_database(spark, "federated")
    spark.sql(f"CREATE VIEW {source}.z_orders AS SELECT * FROM {source}.orders")
    spark.sql(f"CREATE VIEW {source}.a_orders (type) AS SELECT o_orderkey FROM `{source}`.z_orders")
    pairs = spark.createDataFrame([(source, destination)], "source_catalog string, destination_catalog string")
    return _neutral(federated_copy(spark, pairs, unit="database"), destination, "table")


@query
def federated_copy_partial(spark, d):
    """One source is missing; the other is copied, and all outcomes are in the run log."""
    source, destination = _warehouse(spark, d), scratch_database(spark, "federated")
    pairs = spark.createDataFrame(
        [("no_such_database", destination), (source, destination)], "source_catalog string, destination_catalog string"
    )
    log = f"{scratch_database(spark, 'log')}.run_log"
    federated_copy(spark, pairs, unit="database", log_table=log, run_ts=RUN_TS)
    return _neutral(spark.table(log).drop("error", "batch"), destination, "table")


@query
def remote_query_scan(spark, d):
    database = _warehouse(spark, d)
    sql = f"SELECT o_custkey, COUNT(*) AS n_orders FROM {database}.orders GROUP BY o_custkey"
    return connector.scan_query(spark, None, None, sql)


@query
def remote_table_scan(spark, d):
    return connector.scan_table(spark, None, None, _warehouse(spark, d), "orders")


def _with_counts(spark, found) -> DataFrame:
    """The rows each found table or view holds, beside it."""
    names = [f"{o.database}.{o.name}" for o in found.toLocalIterator()]
    return found.withColumn("table", plain_name(F.col("database"), F.col("name"))).join(
        tables.copy_counts(spark, names), "table"
    )


@query
def discover_spark_catalog(spark, d):
    database = _warehouse(spark, d)
    listed = catalog.list_schemas(spark).filter(F.col("database") == database)
    found = catalog.discover_spark(spark, [r.database for r in listed.toLocalIterator()] + ["information_schema"])
    return _neutral(_with_counts(spark, found).select("database", "name", "n_rows"), database, "database")


@query
def classify_spark_objects(spark, d):
    database = _warehouse(spark, d)
    for name in TABLES:
        spark.sql(f"CREATE VIEW {database}.v_{name} AS SELECT *, 'MANAGED' AS type FROM {database}.{name}")
    kinds = _with_counts(spark, catalog.classify_spark(spark, catalog.discover_spark(spark, [database])))
    return kinds.select("name", "kind", F.col("ddl").startswith("CREATE VIEW").alias("has_ddl"), "error", "n_rows")


def _outcomes(spark, d) -> DataFrame:
    """An outcome per object: every seventh table or view has failed."""
    number = F.regexp_extract("name", r"\d+", 0).cast("bigint")
    is_failed = number % 7 == 0
    found = discovery.discover_objects(_mapping(spark, d), fixture(spark, d, "fx_objects"), ordered=False)
    placed = with_destination(found)
    done = F.when(F.col("kind") == "view", views.VIEW_CREATED).otherwise(tables.TABLE_CREATED)
    return placed.select(
        F.col("dst_plain").alias("table"),
        "kind",
        F.when(is_failed, tables.FAILED).otherwise(done).alias("status"),
        F.when(~is_failed & (F.col("kind") == "table"), number).alias("rows"),
        F.when(is_failed, "not found").alias("error"),
        plain_name(*[F.col(c) for c in IDENTITY]).alias("view_id"),
    )


@query
def run_log(spark, d):
    log = f"{scratch_database(spark, 'log')}.runs"
    return runlog.append_run_log(spark, _outcomes(spark, d).drop("view_id"), log, RUN_TS)


@query
def run_log_evolve(spark, d):
    """A run that knows kinds, appended to a log that did not."""
    log = f"{scratch_database(spark, 'log')}.runs"
    rows = _outcomes(spark, d).drop("view_id")
    runlog.append_run_log(spark, rows.drop("kind"), log, "2025-01-01 00:00:00")
    return runlog.append_run_log(spark, rows, log, RUN_TS)


@query
def run_summary(spark, d):
    procs = procedures.procedure_status(_procs(spark, d), True)
    procs = procs.select(F.col("dst_plain").alias("table"), "kind", "status")
    return runlog.run_summary(_outcomes(spark, d).unionByName(procs, allowMissingColumns=True))


@query
def enrich_failures(spark, d):
    return deps.enrich_failures(_outcomes(spark, d), _external(spark, d))


# --- runs that are cut off, repeated and taken up again ---------------------------------


@query
def run_log_retry(spark, d):
    """Outcomes of a run by kind, each a batch: one sent twice, and one whose first write fails half-way."""
    log = f"{scratch_database(spark, 'log')}.runs"
    found = _outcomes(spark, d).drop("view_id")
    of = lambda kind: found.filter(F.col("kind") == kind)
    send = lambda rows, name: runlog.append_run_log(spark, rows, log, RUN_TS, batch=name)
    send(of("table"), "tables")
    broken = of("view").withColumn("error", F.when(F.col("status") == tables.FAILED, F.raise_error(F.lit("cut off"))).otherwise(F.col("error")))
    try:
        send(broken, "views")
    except Exception as error:
        if "cut off" not in str(error):
            raise
    send(of("view"), "views")
    return send(of("table"), "tables")


def _placed(spark, source, destination) -> DataFrame:
    """The warehouse tables as objects to copy."""
    return discovery.discover_objects(_to_session(spark), _source_tables(spark, source, destination), ordered=False)


def _cut_off(df: DataFrame) -> DataFrame:
    """Rows whose reading fails half-way."""
    first = F.col(f"`{df.columns[0]}`")
    return df.withColumn(df.columns[0], F.when(F.rand(1) < 0.5, first).otherwise(F.raise_error(F.lit("cut off")).cast(df.schema[0].dataType)))


@query
def copy_snapshot_interrupted(spark, d):
    """Tables copied twice; the second time those with an ``r`` in their name fail half-way and keep their first rows."""
    source, destination = _warehouse(spark, d), scratch_database(spark, "snapshot")
    objects = _placed(spark, source, destination)
    read = lambda o: connector.scan_table(spark, None, None, source, o.name)
    tables.copy_tables(spark, objects, read)
    twice = lambda o: _cut_off(read(o)) if "R" in o.name else read(o).union(read(o))
    second = tables.copy_tables(spark, objects, twice).select("table", "status")
    counted = tables.copy_counts(spark, [r.table for r in second.toLocalIterator()])
    return _neutral(second.join(counted, "table"), destination, "table")


@query
def copy_resume(spark, d):
    """A copy whose first attempt fails for some tables; the second reads only those. ``reads`` counts the reads of each."""
    source, destination = _warehouse(spark, d), scratch_database(spark, "resumed")
    objects = copy_queue.source_bytes(spark, _placed(spark, source, destination), lambda o: f"{source}.{o.name}")
    asked: list[str] = []

    def read(o):
        asked.append(o.dst_plain)
        if "A" in o.name and asked.count(o.dst_plain) == 1:
            raise ConnectionError("source went away")
        return connector.scan_table(spark, None, None, source, o.name)

    queue = f"{scratch_database(spark, 'queue')}.copies"
    for _ in range(3):
        states = copy_queue.copy_resumable(spark, objects, read, queue)
    reads = spark.createDataFrame([(t, asked.count(t)) for t in set(asked)], "`table` string, reads long")
    found = states.join(reads, "table").select("table", "status", "rows", "attempts", "reads", (F.col("bytes") > 0).alias("sized"))
    return _neutral(found, destination, "table")


@query
def copy_verified(spark, d):
    """Tables copied with checksums taken while writing, then compared; one cell of ``nation`` is changed in between."""
    source, destination = _warehouse(spark, d), scratch_database(spark, "verified")
    copied = verify.copy_verified(spark, _placed(spark, source, destination), lambda o: connector.scan_table(spark, None, None, source, o.name))
    changed = F.when(F.col("n_nationkey") == 7, "ATLANTIS").otherwise(F.col("n_name"))
    tables.overwrite_table(spark.table(f"{destination}.nation").withColumn("n_name", changed), f"{destination}.nation")
    compared = verify.verify_copies(spark, copied)
    columns = F.col("column_name").isNotNull()
    counted = compared.groupBy("table").agg(
        F.max(F.when(~columns, F.col("found").cast("bigint"))).alias("n_rows"),
        F.count_if(columns).alias("n_columns"),
        F.array_join(F.sort_array(F.collect_list(F.when(~F.col("same"), F.coalesce("column_name", F.lit("rows"))))), ",").alias("differing"),
    )
    return _neutral(counted, destination, "table")


@query
def copy_ranges(spark, d):
    """Line items read in ranges of equal numbers of rows by a skewed price, and by a key with nulls."""
    database = _warehouse(spark, d)
    skewed = f"SELECT *, power(l_extendedprice / 1000, 4) AS skewed, nullif(l_suppkey % 50, 7) AS few FROM {database}.lineitem"
    spark.sql(f"CREATE VIEW {database}.skewed_items AS {skewed}")
    found = []
    for column in ("skewed", "few"):
        ranges = connector.depth_ranges(spark, None, {}, database, "skewed_items", column, max(1, spark.table(f"{database}.lineitem").count() // 12))
        source = connector.quoted_table(database, "skewed_items", "`")
        parts = [connector.scan_ranges(spark, None, None, source, [r]).select(F.lit(k).alias("part"), column) for k, r in enumerate(ranges)]
        sizes = reduce(DataFrame.union, parts).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull()).alias("nulls"))
        even = F.max(F.when(F.col("nulls") == 0, F.col("n"))) < 2 * F.median(F.when(F.col("nulls") == 0, F.col("n")))
        found.append(sizes.agg(F.lit(column).alias("column"), F.sum("n").alias("n_rows"), F.max("nulls").alias("n_nulls"), even.alias("even")))
    return reduce(DataFrame.union, found)


@query
def views_poisoned(spark, d):
    """For each table a chain of views over a missing database beside one over the table: no dependant is tried."""
    database = _warehouse(spark, d)
    found = _source_tables(spark, database, database).select("table_schema", "table_name")
    full = "WH." + database.upper()

    def view(prefix, reads):
        text = F.format_string(f"CREATE VIEW {full}.{prefix}_%1$s AS SELECT 1 AS one FROM {reads}", "table_name")
        return found.select(F.concat(F.lit(f"{prefix}_"), "table_name").alias("table_name"), text.alias("view_definition"))

    chain = [
        view("A", f"{full}.%1$s"), view("B", "EXT.PUB.%1$s"), view("C", f"{full}.B_%1$s b CROSS JOIN {full}.A_%1$s a"),
        view("D", f"{full}.C_%1$s"), view("E", f"{full}.A_%1$s"),
    ]
    definitions = reduce(DataFrame.union, chain).select(
        F.lit("WH").alias("src_db"), F.lit(database.upper()).alias("table_schema"), "table_name", "view_definition"
    )
    objects = with_destination(discovery.discover_objects(_to_session(spark), _view_metadata(definitions), ordered=False))
    planned, _ = plan_views(objects, definitions)
    created = views.recreate_views(spark, planned)
    tried = F.coalesce(~F.col("error").startswith(views.NOT_TRIED.split("{")[0]), F.lit(True))
    return _neutral(created.select("table", "status", tried.alias("tried")), database, "table")


@query
def federated_copy_levels(spark, d):
    """Views that read each other against the order of their names, under names that texts, comments and WITH hold as well."""
    source, destination = _warehouse(spark, d), scratch_database(spark, "federated")
    for name, body in {
        "z_base": "SELECT o_orderkey AS k FROM {s}.orders",
        "y_one": "WITH x_two AS (SELECT k FROM {s}.z_base) SELECT k, 'FROM a_four' AS note FROM x_two -- JOIN a_four",
        "x_two": "SELECT k FROM (SELECT k, /* FROM a_four */ 1 AS one FROM {s}.y_one) q",
        "m_three": "SELECT a.k FROM {s}.x_two a, {s}.y_one b WHERE a.k = b.k",
        "a_four": "WITH q AS (SELECT k FROM {s}.m_three) SELECT q.k FROM q JOIN {s}.z_base USING (k)",
    }.items():
        spark.sql(f"CREATE VIEW {source}.{name} AS {body.format(s=f'`{source}`')}")
    pairs = spark.createDataFrame([(source, destination)], "source_catalog string, destination_catalog string")
    log = f"{scratch_database(spark, 'log')}.run_log"
    outcomes = federated_copy(spark, pairs, unit="database", log_table=log, run_ts=RUN_TS)
    spark.sql(f"DROP DATABASE {source} CASCADE")
    made = outcomes.filter(F.col("kind") == "view")
    counted = tables.copy_counts(spark, [r.table for r in made.filter(F.col("status") == views.VIEW_CREATED).toLocalIterator()])
    return _neutral(made.join(counted, "table", "left").select("table", "status", "n_rows"), destination, "table")


@query
def view_cycles(spark, d):
    """The dependencies of all views with two cycles: V6 and V7, and V12, V24 and V48, of which V12 reads V6."""
    back = {"DB1.PUB.V6": "DB2.PUB.V7", "DB2.PUB.V7": "DB1.PUB.V6", "DB2.PUB.V12": "DB3.PUB.V48"}
    nodes = _nodes(spark, d)
    added = spark.createDataFrame(list(back.items()), "view_id string, dep_id string")
    added = added.join(nodes, "view_id", "left_semi").join(nodes.withColumnRenamed("view_id", "dep_id"), "dep_id", "left_semi")
    return cycles.view_cycles(nodes, _edges(spark, d).unionByName(added.select("view_id", "dep_id")))


@query
def translate_procedures_isolated(spark, d):
    """A caller's function that refuses some requests; asked twice over one cache, in three waves."""

    def shout(requests: list[str]) -> list[str]:
        if any("3\ntarget_name" in r for r in requests):
            raise ValueError("refused")
        return [r.upper() for r in requests]

    cache = f"{scratch_database(spark, 'answers')}.cache"
    for _ in range(2):
        found = procedures.translate_isolated(_staged(spark, d), shout, cache, instruction="Translate.\n", waves=3)
    return found.drop("translated_at")


@query
def audit_report_incremental(spark, d):
    """The report over exports that came in two drops of files, the first with stale records and half of the usage."""
    records = _records(spark, d)
    # Both drops have the jobs: gathered once, from all their tasks.
    records["jobs"] = written_out(records["jobs"])
    late = F.pmod(F.xxhash64("sku_name", "usage_start_time", "usage_quantity"), F.lit(2)) == 0
    first = {
        "jobs": records["jobs"].withColumn("settings", F.struct(F.lit("stale").alias("name"), F.col("settings.tasks").alias("tasks"))),
        "clusters": records["clusters"].withColumn("cluster_name", F.lit("stale")),
        "runs": records["runs"].limit(0),
        "usage": records["usage"].filter(~late),
        "prices": records["prices"],
    }
    second = {**records, "usage": records["usage"].filter(late), "prices": records["prices"].limit(0)}
    path, database = new_path(spark), scratch_database(spark, "incremental")
    for drop in (first, second):
        found = {}
        for name, rows in drop.items():
            # A compressed file is read by one task, so none is long.
            rows.write.mode("append").option("maxRecordsPerFile", 1_000_000).json(f"{path}/{name}", compression="gzip")
            found[name] = incremental.refresh(spark, name, f"{path}/{name}", f"{database}.{name}", f"{path}/progress/{name}")
    return _audit_of(found)


# Queries whose operator already has the plain name at this level.
for _name in [n for n in QUERIES if n.endswith("_query")]:
    QUERIES[_name.removesuffix("_query")] = QUERIES.pop(_name)
