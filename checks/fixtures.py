"""Operations tables derived from the given TPC-H-like tables.

Each statement runs unchanged in Spark; ``for_duckdb`` gives the other spelling
of the one type name that differs. The conditions assign kinds and states
(a part is a view or a table, a cluster is alive or gone); every row of the
source table is used by one of the fixtures that read it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

FIXTURES = {
    "fx_mapping": """
        select case when r_regionkey = 4 then '  ' else 'DB' || cast(r_regionkey as string) end as source_database,
               'migrated_db' || cast(r_regionkey as string) as destination_catalog
        from region""",
    "fx_jobs": "select c_custkey as job_id, c_name as job_name from customer",
    "fx_tasks": """
        select o_custkey as job_id, l_orderkey, l_linenumber,
               case when l_linestatus = 'O' then l_suppkey end as existing_cluster_id
        from lineitem join orders on l_orderkey = o_orderkey""",
    # Every tenth cluster has been terminated.
    "fx_clusters": """
        select cluster_id, cluster_name, node_type_id, driver_node_type_id, autoscale_min, autoscale_max, num_workers,
               spark_version, cluster_source
        from (select s_suppkey as cluster_id,
                     s_suppkey % 10 = 0 as is_terminated,
                     case when s_suppkey % 17 <> 0 then s_name end as cluster_name,
                     case when s_nationkey % 7 = 0 then '' else 'node.' || cast(s_nationkey as string) end
                         as node_type_id,
                     case when s_nationkey % 3 = 0 then null when s_nationkey % 3 = 1 then ''
                          else 'driver.' || cast(s_nationkey as string) end as driver_node_type_id,
                     case when s_suppkey % 4 = 0 then s_nationkey % 5 end as autoscale_min,
                     case when s_suppkey % 4 = 0 then s_nationkey % 5 + 4 end as autoscale_max,
                     case when s_suppkey % 4 <> 3 then s_nationkey % 6 end as num_workers,
                     case when s_nationkey % 4 = 1 then '' when s_nationkey % 4 <> 2
                          then '1' || cast(s_nationkey % 4 as string) || '.3' end as spark_version,
                     case s_nationkey % 3 when 0 then 'UI' when 1 then 'API' end as cluster_source
              from supplier) c
        where not is_terminated""",
    "fx_runs": """
        select o_orderkey as run_id, o_custkey as job_id, o_orderdate as start_time,
               case o_orderstatus when 'F' then 'FAILED' when 'O' then 'SUCCESS' end as result_state,
               'TERMINATED' as life_cycle_state
        from orders""",
    "fx_usage": """
        select l_suppkey as cluster_id, l_returnflag as sku_name, l_shipdate as usage_start_time,
               cast(l_quantity as decimal(18,2)) as usage_quantity
        from lineitem""",
    # Returned goods have a price list only from 1997 on.
    "fx_prices": """
        select sku_name, price_start_time,
               lead(price_start_time) over (partition by sku_name order by price_start_time) as price_end_time, price
        from (select l_returnflag as sku_name,
                     cast(date_trunc('year', l_shipdate) as timestamp_ntz) as price_start_time,
                     cast(1 + round(avg(cast(l_discount as decimal(18,4))), 4) as decimal(18,4)) as price
              from lineitem where not (l_returnflag = 'R' and year(l_shipdate) < 1997) group by 1, 2) p""",
    # Finer than cents: rounding a row, or a price, before the sum gives another total.
    "fx_fine_usage": """
        select l_suppkey as cluster_id, l_returnflag as sku_name, l_shipdate as usage_start_time,
               cast(cast(l_quantity as decimal(18,6)) / 1000 as decimal(18,6))
               + cast(cast(l_tax as decimal(18,6)) / 10000 as decimal(18,6)) as usage_quantity
        from lineitem""",
    "fx_fine_prices": """
        select sku_name, price_start_time, price_end_time,
               cast(price as decimal(18,8)) + cast(0.00003457 as decimal(18,8)) as price
        from (select sku_name, price_start_time,
                     lead(price_start_time) over (partition by sku_name order by price_start_time) as price_end_time,
                     price
              from (select l_returnflag as sku_name, cast(date_trunc('year', l_shipdate) as timestamp_ntz)
                               as price_start_time,
                           cast(1 + round(avg(cast(l_discount as decimal(18,4))), 4) as decimal(18,4)) as price
                    from lineitem group by 1, 2) y) p""",
    "fx_objects": """
        select 'DB' || cast(p_partkey % 5 as string) as src_db,
               case when p_partkey % 50 = 49 then 'INFORMATION_SCHEMA' else 'PUB' end as table_schema,
               case when p_partkey % 3 = 2 then 'T' else 'V' end || cast(p_partkey as string) as table_name,
               case when p_partkey % 3 <> 2 then 'VIEW' when p_partkey % 2 = 0 then 'BASE TABLE'
                    else 'EXTERNAL TABLE' end as table_type
        from part""",
    "fx_views": """
        select 'DB' || cast(p_partkey % 5 as string) as src_db, 'PUB' as table_schema,
               'V' || cast(p_partkey as string) as table_name,
               'CREATE OR REPLACE VIEW DB' || cast(p_partkey % 5 as string) || '.PUB.V' || cast(p_partkey as string)
               || ' AS SELECT ZEROIFNULL(abs(q)) AS q, REGEXP_REPLACE(n, ' || chr(39) || 'x' || chr(39)
               || ') AS n FROM DB' || cast(cast(floor(p_partkey / 2) as bigint) % 5 as string) || '.PUB.V'
               || cast(cast(floor(p_partkey / 2) as bigint) as string) || ' a JOIN "EXT'
               || cast(p_partkey % 3 as string) || '"."PUB"."T" b ON a.k = b.k' as view_definition
        from (select p_partkey, case when p_partkey % 3 <> 2 then 'VIEW' else 'TABLE' end as kind from part) p
        where kind = 'VIEW'""",
    # Three columns of each table.
    "fx_columns": """
        select 'T' || cast(p_partkey as string) as table_name, s as column_ordinal,
               'C' || cast(s as string) as column_name,
               case (p_partkey + s) % 6 when 0 then 'NUMBER' when 1 then 'TIME' when 2 then 'TIMESTAMP_NTZ'
                    when 3 then 'DECIMAL' when 4 then 'TEXT' else 'timestamp without time zone' end as data_type,
               case when (p_partkey + s) % 3 = 0 then case when p_partkey % 11 = 0 then null else p_size % 38 + 1 end
                    end as numeric_precision,
               case when (p_partkey + s) % 3 = 0 then p_size % 3 end as numeric_scale
        from (select p_partkey, p_size, 1 as s, case when p_partkey % 3 <> 2 then 'VIEW' else 'TABLE' end as kind
              from part
              union all
              select p_partkey, p_size, 2, case when p_partkey % 3 <> 2 then 'VIEW' else 'TABLE' end from part
              union all
              select p_partkey, p_size, 3, case when p_partkey % 3 <> 2 then 'VIEW' else 'TABLE' end from part) p
        where kind = 'TABLE'""",
    "fx_procs": """
        select 'DB' || cast(s_suppkey % 5 as string) as src_db, 'PUB' as procedure_schema,
               'P' || cast(s_suppkey as string) as procedure_name,
               case when s_suppkey % 4 = 0 then null when s_suppkey % 4 = 1 then '(X NUMBER)' else 'X NUMBER' end
                   as argument_signature,
               case when s_suppkey % 3 = 0 then 'VARCHAR' end as return_type,
               case s_nationkey % 5 when 0 then 'SQL' when 1 then 'JAVASCRIPT' when 2 then 'PYTHON' when 3 then 'sql'
                    end as procedure_language,
               case when s_suppkey % 9 <> 0 then 'EXECUTE AS CALLER BEGIN UPDATE DB' || cast(s_suppkey % 5 as string)
                    || '.PUB.T SET q = ZEROIFNULL(q); END' end as procedure_definition,
               case when s_suppkey % 2 = 0 then 'it' || chr(39) || 's ' || s_name end as comment
        from supplier""",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def text_of(template: str, **exprs: str) -> str:
    """SQL expression for ``template`` with each ``{name}`` replaced by the value of its expression."""
    pieces = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(exprs[piece])
        elif piece:
            # Written without escapes, so both engines read the same characters.
            quoted = piece.replace("'", "' || chr(39) || '").replace("\n", "' || chr(10) || '")
            pieces.append(f"'{quoted}'")
    return " || ".join(pieces)


# Definition texts over all parts: the same template gives the input and, with
# the rewritten pieces in place, the expected text.
N = "cast(p_partkey as string)"
SRC = "'Db' || cast(p_partkey % 5 as string)"
TICK = "  create\n view `{s}`.PUB.V{n} AS SELECT '{s}.x' AS a FROM {s}.PUB.T{n} JOIN X{o}.PUB.U ON `{o}x`.k = 1"
TICK_DONE = (
    "CREATE OR REPLACE VIEW `{s}`.PUB.V{n} AS SELECT '{s}.x' AS a FROM {s}.PUB.T{n} JOIN X{o}.PUB.U ON `{o}x`.k = 1"
)
QUOTE = (
    'SELECT {s}.PUB.z, {u}.PUB.a, "{u}"."PUB"."b" FROM {l}.PUB.T{n} JOIN "{l}".PUB.U '
    'ON X{o}.k = "{o}x".k AND {l}x.k = 1'
)
BODY = "SELECT ZEROIFNULL(q) AS q FROM {s}.PUB.T{n} WHERE a AS b"
PREFIXES = (
    "CREATE VIEW {s}.PUB.V{n} AS ",
    "  create or replace\nview {s}.PUB.V{n} as\n",
    "CREATE OR REPLACE SECURE RECURSIVE VIEW \"{s}\".\"PUB\".\"V {n}\" (A, B)\n AS ",
    "",
)
CALLS = (
    "SELECT ZEROIFNULL(zeroifnull ( a{n} )), REGEXP_REPLACE(f(a, b), 'p),('), REGEXP_REPLACE(a, b, c), "
    "IFF(x > 1, 'IFF(1,2,3)', TO_VARCHAR(y)), TO_VARCHAR(z, 'f'), my.IFF(1, 2, 3) /* ZEROIFNULL(a */ FROM T{n} "
    "WHERE f(ZEROIFNULL(b) AND (c"
)
CALLS_DONE = (
    "SELECT COALESCE(COALESCE( a{n} , 0), 0), REGEXP_REPLACE(f(a, b), 'p),(', ''), REGEXP_REPLACE(a, b, c), "
    "CASE WHEN x > 1 THEN 'IFF(1,2,3)' ELSE CAST(y AS STRING) END, TO_VARCHAR(z, 'f'), my.IFF(1, 2, 3) "
    "/* ZEROIFNULL(a */ FROM T{n} WHERE f(COALESCE(b, 0) AND (c"
)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def over_given(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A query over the given tables, as a plan."""
    named = rf"(?i)\b(from|join) ({'|'.join(TABLES)})\b"
    sources = {m[2]: given(spark, sf_dir, m[2]) for m in re.finditer(named, text)}
    return spark.sql(re.sub(named, r"\1 {\2}", text), **sources)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return over_given(spark, sf_dir, FIXTURES[name])


def for_duckdb(text: str) -> str:
    return text.replace("timestamp_ntz", "timestamp")


def with_fixtures(query: str) -> str:
    """DuckDB text of ``query`` with the fixtures it names defined in front."""
    needed = [f"{n} as ({for_duckdb(sql)})" for n, sql in FIXTURES.items() if n in query]
    if not needed:
        return query
    body = query.strip()
    if body.lower().startswith("with recursive"):
        return "with recursive " + ", ".join(needed) + ", " + body[len("with recursive") :]
    if body.lower().startswith("with "):
        return "with " + ", ".join(needed) + ", " + body[len("with") :]
    return "with " + ", ".join(needed) + " " + body
