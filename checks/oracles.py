"""Expected result of each query, as DuckDB SQL over the given tables."""

from __future__ import annotations

from checks.fixtures import (
    BODY, CALLS_DONE, N, PREFIXES, QUOTE, SRC, TABLES, TICK_DONE, text_of, with_fixtures,
)
from lakeops.functions.refs import SQL_KEYWORDS

PRICED = """
    select u.*, p.price_start_time, p.price_end_time, p.price
    from fx_usage u left join fx_prices p
      on u.sku_name = p.sku_name and u.usage_start_time >= p.price_start_time
     and (p.price_end_time is null or u.usage_start_time < p.price_end_time)"""

COST = f"""
    select cluster_id, cast(round(sum(usage_quantity), 2) as decimal(38,2)) as total_dbus_consumed,
           cast(round(sum(usage_quantity * price), 2) as decimal(38,2)) as estimated_cost_usd
    from ({PRICED}) p
    where usage_start_time >= timestamp '1997-01-01' and cluster_id is not null
    group by cluster_id"""

FINE_COST = COST.replace("fx_usage", "fx_fine_usage").replace("fx_prices", "fx_fine_prices")

PAIRS = """
    select job_id, existing_cluster_id as cluster_id, cast(count(*) as int) as num_tasks_on_cluster
    from fx_tasks where existing_cluster_id is not null group by 1, 2"""

LATEST = """
    select job_id, run_id as latest_run_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') as latest_run_start_time,
           coalesce(result_state, life_cycle_state) as latest_run_state
    from fx_runs where start_time >= timestamp '1997-01-01'
    qualify row_number() over (partition by job_id order by start_time desc, run_id desc) = 1"""

CLUSTERS = """
    select cluster_id, cluster_name, coalesce(nullif(node_type_id, ''), 'Unknown') as worker_node_type,
           coalesce(nullif(driver_node_type_id, ''), nullif(node_type_id, ''), 'Unknown') as driver_node_type,
           case when autoscale_min is not null then 'Autoscale ' || autoscale_min || '-' || autoscale_max
                when num_workers is not null then 'Fixed ' || num_workers else 'Unknown' end as workers_config,
           num_workers, autoscale_min as autoscale_min_workers, autoscale_max as autoscale_max_workers,
           coalesce(nullif(spark_version, ''), 'Unknown') as spark_version,
           coalesce(nullif(cluster_source, ''), 'Unknown') as cluster_source
    from fx_clusters"""

LOOKUP = f"""
    select p.*,
           case when c.cluster_id is null then 'UNKNOWN/TERMINATED' else cluster_name end as cluster_name,
           coalesce(worker_node_type, 'Unknown') as worker_node_type,
           coalesce(driver_node_type, 'Unknown') as driver_node_type,
           coalesce(workers_config, 'Unknown') as workers_config,
           autoscale_min_workers, autoscale_max_workers,
           coalesce(spark_version, 'Unknown') as spark_version
    from ({PAIRS}) p left join ({CLUSTERS}) c on p.cluster_id = c.cluster_id"""


def _audit(cost: str) -> str:
    return f"""
    select l.*, j.job_name, 'https://workspace.example/jobs/' || l.job_id as job_url, r.latest_run_id,
           r.latest_run_start_time, r.latest_run_state, timestamp '1998-01-01' as snapshot_timestamp,
           c.total_dbus_consumed, c.estimated_cost_usd
    from ({LOOKUP}) l join fx_jobs j on l.job_id = j.job_id
    left join ({LATEST}) r on l.job_id = r.job_id
    left join ({cost}) c on l.cluster_id = c.cluster_id"""


NO_COST = """
    select null::bigint as cluster_id, null::decimal(38,2) as total_dbus_consumed,
           null::decimal(38,2) as estimated_cost_usd"""

MAPPING = "select * from fx_mapping where trim(source_database) <> '' and trim(destination_catalog) <> ''"

FOUND = f"""
    select case when upper(table_type) = 'VIEW' then 'view' else 'table' end as kind, src_db,
           destination_catalog as dst_cat, table_schema as "schema", table_name as name
    from fx_objects join ({MAPPING}) m on upper(src_db) = upper(source_database)
    where table_schema <> 'INFORMATION_SCHEMA'"""

PROCS = f"""
    select 'procedure' as kind, src_db, destination_catalog as dst_cat, procedure_schema as "schema",
           procedure_name as name, coalesce(argument_signature, '()') as arg_sig, return_type,
           coalesce(upper(procedure_language), 'SQL') as language, procedure_definition as body, comment
    from fx_procs join ({MAPPING}) m on upper(src_db) = upper(source_database)"""

OBJECTS = f"""
    select *, null as arg_sig, null as return_type, null as language, null as body, null as comment from ({FOUND}) f
    union all {PROCS}"""

# The three names of a reference stand between dots; no name in the data holds one.
PART = '(?:"[^"]+"|[A-Z_][A-Z0-9_]*)'
THREE = rf"(?i){PART}\.{PART}\.{PART}"
KEYWORDS = ", ".join(f"'{word}'" for word in SQL_KEYWORDS)


def _refs(source: str, ids: str, text: str) -> str:
    return f"""
    select distinct {ids}, split_part(m, '.', 1) as ref_db, split_part(m, '.', 2) as ref_schema,
           split_part(m, '.', 3) as ref_table
    from (select {ids}, upper(replace(unnest(regexp_extract_all({text}, '{THREE}')), '"', '')) as m from {source}) x
    where split_part(m, '.', 1) not in ({KEYWORDS}) and split_part(m, '.', 2) not in ({KEYWORDS})
      and split_part(m, '.', 3) not in ({KEYWORDS})"""


REFS = _refs("fx_views", "src_db, table_schema, table_name", "view_definition")

EXTERNAL = f"""
    select src_db || '.' || table_schema || '.' || table_name as view_id,
           ref_db || '.' || ref_schema || '.' || ref_table as ref, ref_db as missing_db
    from ({REFS}) r where ref_db not in (select upper(source_database) from ({MAPPING}) m)"""

PREFLIGHT = f"""
    select e.* from ({EXTERNAL}) e
    join ({FOUND}) o on o.kind = 'view' and e.view_id = o.src_db || '.' || o."schema" || '.' || o.name"""

# Views are numbered, and V(n) reads V(n/2) where that is a view; V0 reads itself.
EDGES_BY_NUMBER = """
    numbered as (select cast(substr(table_name, 2) as bigint) as n,
                        src_db || '.' || table_schema || '.' || table_name as view_id from fx_views),
    edges as (select a.n, b.n as dep, a.view_id, b.view_id as dep_id
              from numbered a join numbered b on b.n = a.n // 2 and a.n <> b.n)"""

LEVELS = f"""
    with recursive {EDGES_BY_NUMBER},
    climb as (select n, view_id, 0 as level from numbered where n not in (select n from edges)
              union all select e.n, e.view_id, c.level + 1 from climb c join edges e on e.dep = c.n)
    select view_id, level, false as is_circular from climb"""

LEVELS_CYCLE = f"""
    with recursive {EDGES_BY_NUMBER},
    circle as (select n, view_id from numbered where n in (6, 7)
               union select e.n, e.view_id from circle c join edges e on e.dep = c.n),
    climb as (select n, view_id, 0 as level from numbered where n not in (select n from edges)
              union all select e.n, e.view_id, c.level + 1 from climb c join edges e on e.dep = c.n
              where e.n not in (6, 7))
    select view_id, level, false as is_circular from climb where n not in (select n from circle)
    union all
    select view_id, (select max(level) + 1 from climb where n not in (select n from circle)), true from circle"""

BODY_SQL = """
    case when p.body is not null then
      ' BEGIN UPDATE ' || lower(p.dst_cat) || '.PUB.T SET q = COALESCE(q, 0); END' end"""

DDL = f"""
    select p.src_db, p.name, case when p.language = 'SQL' then
      'CREATE OR REPLACE PROCEDURE `' || p.dst_cat || '`.`' || lower(p."schema") || '`.`' || lower(p.name) || '` '
      || case when p.arg_sig like '(%' then p.arg_sig else '(' || p.arg_sig || ')' end
      || chr(10) || 'LANGUAGE SQL' || chr(10) || 'SQL SECURITY INVOKER' || chr(10)
      || case when p.comment is not null then 'COMMENT ''' || replace(p.comment, '''', '''''') || '''' || chr(10)
              else '' end
      || 'AS' || chr(10) || {BODY_SQL} end as ddl
    from ({PROCS}) p"""

STAGED = f"""
    select src_db || '.' || procedure_schema || '.' || procedure_name as source_name,
           destination_catalog || '.' || lower(procedure_schema) || '.' || lower(procedure_name) as target_name,
           procedure_language as language, coalesce(argument_signature, '()') as arg_signature, return_type,
           procedure_definition as original_body, comment, src_db as source_db, destination_catalog as target_catalog
    from fx_procs join ({MAPPING}) m on upper(src_db) = upper(source_database)
    where coalesce(upper(procedure_language), 'SQL') <> 'SQL'"""

REQUEST = """
    'Translate.' || chr(10) || chr(10) || 'source_name: ' || source_name || chr(10) || 'target_name: ' || target_name
    || chr(10) || 'language: ' || language || chr(10) || 'arg_signature: ' || arg_signature || chr(10)
    || 'return_type: ' || coalesce(return_type, 'VARIANT') || chr(10) || 'source_db: ' || source_db || chr(10)
    || 'target_catalog: ' || target_catalog || chr(10) || 'original_body:' || chr(10) || original_body"""

TYPES = """
    select *, case
        when upper(data_type) = 'TIME' then 'time_text'
        when upper(data_type) in ('TIMESTAMP_NTZ', 'TIMESTAMP WITHOUT TIME ZONE') then 'timestamp_ntz'
        when upper(data_type) in ('NUMBER', 'DECIMAL', 'NUMERIC') and coalesce(numeric_scale, 0) = 0
        then case when coalesce(numeric_precision, 38) <= 9 then 'int' else 'bigint' end end as target_type
    from fx_columns"""

OUTCOMES = f"""
    select dst_cat || '.' || lower("schema") || '.' || lower(name) as "table", kind,
           case when n % 7 = 0 then 'failed' when kind = 'view' then 'view_created' else 'table_created' end as status,
           case when n % 7 <> 0 and kind = 'table' then n end as "rows",
           case when n % 7 = 0 then 'not found' end as error,
           src_db || '.' || "schema" || '.' || name as view_id
    from (select *, cast(substr(name, 2) as bigint) as n from ({FOUND}) f) o"""

COPIED = " union all ".join(
    f"""select 'spark_catalog.dst.{t}' as "table", 'table' as kind, 'table_created' as status, count(*) as "rows",
    null::varchar as error from {t}"""
    for t in TABLES
)


def _per_table(template: str) -> str:
    return " union all ".join(template.format(t=t) for t in TABLES)


MIGRATED = f"""
    select *, '2026-01-01 00:00:00' as migrated_at from (
      {COPIED}
      union all
      {_per_table('''select 'spark_catalog.dst.v_{t}', 'view', 'view_created', null, null''')}
      union all
      {_per_table('''select 'spark_catalog.dst.w_{t}', 'view', 'view_created', null, null''')}
      union all
      select 'spark_catalog.dst.broken', 'view', 'failed', null,
             'missing dependency — view needs EXT.PUB.T which is not in this run.'
      union all
      select 'spark_catalog.dst.' || lower(procedure_name), 'procedure', 'inventoried_dbr_too_old', null, null
      from fx_procs) r"""


def _part_texts(expected: str, **exprs: str) -> str:
    return f"select p_partkey, {text_of(expected, n=N, **exprs)} as text from part"


DST = f"'New$' || {SRC}"

BODIES = " union all ".join(
    f"""select p_partkey, {i} as form, {text_of(BODY, s=SRC, n=N)} as body,
    {"'(A, B)'" if "(A, B)" in prefix else "null"} as columns from part"""
    for i, prefix in enumerate(PREFIXES)
)

ORACLES = {
    "cost_rollup": COST,
    "cost_rollup_nested": COST,
    "cost_rollup_fine": FINE_COST,
    "interval_price_join": PRICED,
    "interval_price_join_by_month": PRICED,
    "flatten_tasks": """
        select o_orderkey as job_id, o_custkey as existing_cluster_id from orders where o_orderstatus = 'F'
        union all select o_orderkey, null from orders where o_orderstatus = 'F'""",
    "job_cluster_usage": f"select p.*, job_name from ({PAIRS}) p join fx_jobs j on p.job_id = j.job_id",
    "latest_run": LATEST,
    # Whole milliseconds by division: epoch_ms(ts) would round them up.
    "latest_run_epoch_ms": """
        select user_id as job_id, event_id as latest_run_id,
               strftime(epoch_ms(ms), '%Y-%m-%d %H:%M:%S') as latest_run_start_time,
               coalesce(nullif(upper(event_type), 'ERROR'), 'TERMINATED') as latest_run_state
        from (select *, epoch_us(ts) // 1000 as ms from events) e
        where ms >= epoch_us(timestamp '2024-01-01') // 1000
        qualify row_number() over (partition by user_id order by ms desc, event_id desc) = 1""",
    "cluster_dim": CLUSTERS,
    "cluster_lookup": LOOKUP,
    "audit_report": _audit(COST),
    "audit_report_no_cost": _audit(NO_COST),
    "audit_report_fine": _audit(FINE_COST),
    "audit_report_snapshots": f"select * replace (cast(cluster_id as varchar) as cluster_id) from ({_audit(COST)}) a",
    "mapping_clean": MAPPING,
    "discover_objects": OBJECTS,
    "discover_objects_ignore_case": FOUND,
    "object_counts": f"select src_db, kind, count(*) as n_objects from ({OBJECTS}) o group by 1, 2",
    "destination_names": f"""
        select kind, src_db, name, lower("schema") as dst_schema, lower(name) as dst_name,
               '`' || dst_cat || '`.`' || lower("schema") || '`.`' || lower(name) || '`' as dst_fq,
               dst_cat || '.' || lower("schema") || '.' || lower(name) as dst_plain
        from ({OBJECTS}) o""",
    "view_definitions_join": f"""
        select o.*, v.view_definition from ({FOUND}) o
        left join fx_views v on o.src_db = v.src_db and o."schema" = v.table_schema and o.name = v.table_name
        where kind = 'view'""",
    "extract_refs": REFS,
    "extract_refs_pages": _refs("pages", "page_id", "url"),
    "extract_refs_html": _refs("pages", "page_id", "html"),
    "extract_refs_documents": _refs("documents", "doc_id", "text"),
    "external_refs": EXTERNAL,
    "external_refs_by_db": f"""
        select missing_db, count(distinct view_id) as n_views, count(*) as n_refs from ({EXTERNAL}) e group by 1""",
    "migration_preflight": PREFLIGHT,
    "view_edges": f"with {EDGES_BY_NUMBER} select view_id, dep_id from edges",
    "view_in_degree": f"""
        with {EDGES_BY_NUMBER}
        select v.view_id, count(e.dep_id) as in_degree from numbered v left join edges e on v.view_id = e.view_id
        group by 1""",
    "view_levels": LEVELS,
    "view_levels_cycle": LEVELS_CYCLE,
    "level_sizes": LEVELS.replace(
        "select view_id, level, false as is_circular from climb",
        "select level, false as is_circular, count(*) as n_views from climb group by 1",
    ),
    "rewrite_backtick": _part_texts(TICK_DONE, s=DST, o=SRC),
    "rewrite_dquote": _part_texts(
        QUOTE.replace("{l}x", "{k}x"), s=f"lower({DST})", u=f"lower({DST})", l=f"lower({DST})", o=SRC, k=f"lower({SRC})"
    ),
    "select_body": BODIES,
    "translate_functions": _part_texts(CALLS_DONE),
    "translate_functions_documents": """
        select doc_id, 'SELECT CASE WHEN COALESCE(q, 0) > 0 THEN ''' || replace(text, '''', '''''')
               || ''' ELSE CAST(r AS STRING) END' as text
        from documents""",
    "procedure_ddl": DDL,
    "procedure_status": f"""
        select src_db, name,
               case when language = 'SQL' then 'procedure_created'
                    else 'inventoried_manual_port_' || lower(language) end as status,
               'inventoried_dbr_too_old' as status_old
        from ({PROCS}) p""",
    "stage_procedures": STAGED,
    "translation_request": f"select source_name, {REQUEST} as request from ({STAGED}) s",
    "translate_procedures": f"""
        select source_name, target_name, language, original_body,
               {BODY_SQL.replace("p.body", "original_body").replace("p.dst_cat", "target_catalog")} as translated_sql,
               false as applied
        from ({STAGED}) s""",
    "translate_procedures_batch": f"""
        select source_name, target_name, language, original_body, upper({REQUEST}) as translated_sql, false as applied
        from ({STAGED}) s""",
    "type_plan": TYPES,
    "type_plan_by_table": f"""
        select table_name,
               string_agg(column_name || ':' || coalesce(target_type, '-'), ',' order by column_ordinal) as columns
        from ({TYPES}) t group by 1""",
    "typed_copy": """
        select * replace (cast(l_quantity as int) as l_quantity) from lineitem""",
    "typed_copy_time": """
        select event_id, strftime(ts, '%H:%M:%S') as ts, strftime(ts, '%H:%M:%S') as ts_text,
               cast(user_id as int) as user_id, "value", event_type, props
        from events""",
    "type_overflow": """
        select 'SMALL' as column_name, count(*) filter (cast(l_extendedprice as decimal(18,2)) * 100000 > 2147483647)
               as n_overflow from lineitem
        union all
        select 'WIDE', count(*) filter (cast(l_extendedprice as decimal(18,2)) * 1000000000000 > 9223372036854775807)
        from lineitem""",
    "type_overflow_fraction": """
        select 'PART' as column_name, count(*) filter (l_discount * 100 % 4 <> 0) as n_overflow from lineitem
        union all
        select 'WHOLE', 0""",
    "copy_snapshot": COPIED,
    "copy_name_clash": """
        select 'spark_catalog.dst.orders' as "table", 'failed' as status, null::bigint as "rows", false as written
        from range(2)
        union all
        select 'spark_catalog.dst.nation', 'table_created', count(*), false from nation""",
    "copy_counts": _per_table("select 'dst.{t}' as \"table\", count(*) as n_rows from {t}"),
    "recreate_views": f"""
        {_per_table("select 'v_{t}' as name, 0 as level, 'view_created' as status, null::bigint as n")}
        union all
        {_per_table("select 'w_{t}', 1, 'view_created', count(*) from {t}")}""",
    "ordered_migration": MIGRATED,
    "federated_copy": f"""
        {COPIED}
        union all select 'spark_catalog.dst.a_orders', 'view', 'view_created', null, null
        union all select 'spark_catalog.dst.z_orders', 'view', 'view_created', null, null""",
    "federated_copy_partial": f"""
        select * exclude (error), '2026-01-01 00:00:00' as migrated_at from ({COPIED}) c
        union all select 'no_such_database', 'database', 'failed', null, '2026-01-01 00:00:00'""",
    "remote_query_scan": "select o_custkey, count(*) as n_orders from orders group by 1",
    "remote_table_scan": "select * from orders",
    "discover_spark_catalog": _per_table(
        "select 'dst' as \"database\", '{t}' as name, count(*) as n_rows from {t}"
    ),
    "classify_spark_objects": f"""
        {_per_table("""select '{t}' as name, 'table' as kind, null::boolean as has_ddl, null::varchar as error,
        count(*) as n_rows from {t}""")}
        union all
        {_per_table("select 'v_{t}', 'view', true, null, count(*) from {t}")}""",
    "run_log": f"""
        select "table", kind, status, "rows", error, '2026-01-01 00:00:00' as migrated_at from ({OUTCOMES}) o""",
    "run_log_evolve": f"""
        select "table", kind, status, "rows", error, '2026-01-01 00:00:00' as migrated_at from ({OUTCOMES}) o
        union all
        select "table", null, status, "rows", error, '2025-01-01 00:00:00' from ({OUTCOMES}) o""",
    "run_log_retry": f"""
        select "table", kind, status, "rows", error, '2026-01-01 00:00:00' as migrated_at,
               '2026-01-01 00:00:00 ' || kind || 's' as batch
        from ({OUTCOMES}) o where kind in ('table', 'view')""",
    "copy_snapshot_interrupted": _per_table("""
        select 'spark_catalog.dst.{t}' as "table", case when '{t}' like '%r%' then 'failed' else 'table_created' end as status,
               case when '{t}' like '%r%' then count(*) else 2 * count(*) end as n_rows from {t}"""),
    "copy_resume": _per_table("""
        select 'spark_catalog.dst.{t}' as "table", 'table_created' as status, count(*) as "rows",
               case when '{t}' like '%a%' then 2 else 1 end as attempts,
               case when '{t}' like '%a%' then 2 else 1 end as reads, true as sized from {t}"""),
    "copy_verified": _per_table("""
        select 'spark_catalog.dst.{t}' as "table", count(*) as n_rows,
               (select count(*) from (describe select * from {t}) c) as n_columns,
               case when '{t}' = 'nation' then 'n_name' else '' end as differing from {t}"""),
    "copy_ranges": """
        select 'skewed' as "column", count(*) as n_rows, 0 as n_nulls, true as even from lineitem
        union all
        select 'few', count(*), count(*) filter (l_suppkey % 50 = 7), true from lineitem""",
    "views_poisoned": _per_table("""
        select 'spark_catalog.dst.' || v || '_{t}' as "table",
               case when v in ('a', 'e') then 'view_created' else 'failed' end as status, v not in ('c', 'd') as tried
        from (select distinct 'abcde'[i % 5 + 1] as v from (select row_number() over () as i from range(5)) n) x
        where (select count(*) from {t}) > 0"""),
    "federated_copy_levels": """
        select 'spark_catalog.dst.' || v as "table", 'view_created' as status, n as n_rows
        from (select unnest(['z_base', 'y_one', 'x_two', 'm_three', 'a_four']) as v) x, (select count(*) as n from orders) o""",
    "view_cycles": f"""
        with recursive {EDGES_BY_NUMBER},
        every as (select view_id, dep_id from edges
                  union select v.view_id, w.view_id
                  from (values (6, 7), (7, 6), (12, 48)) as b(x, y)
                  join numbered v on v.n = b.x join numbered w on w.n = b.y),
        reach as (select view_id, dep_id from every
                  union select r.view_id, e.dep_id from reach r join every e on r.dep_id = e.view_id),
        members as (select a.view_id, a.dep_id as other from reach a join reach b
                    on a.view_id = b.dep_id and a.dep_id = b.view_id),
        on_one as (select view_id, min(other) as cycle, count(distinct other) as n_members from members group by 1),
        above as (select distinct view_id from reach where dep_id in (select view_id from on_one))
        select a.view_id, o.cycle, coalesce(o.n_members, 0) as n_members
        from (select view_id from above union select view_id from on_one) a left join on_one o on a.view_id = o.view_id""",
    "translate_procedures_isolated": f"""
        select source_name, target_name, language, original_body,
               case when source_name not like '%3' then upper({REQUEST}) end as translated_sql,
               case when source_name like '%3' and original_body is not null then 'refused' end as error, false as applied
        from ({STAGED}) s""",
    "audit_report_incremental": f"select * replace (cast(cluster_id as varchar) as cluster_id) from ({_audit(COST)}) a",
    "run_summary": f"""
        select count(*) as n_objects, count(*) filter (kind = 'table') as n_tables,
               count(*) filter (status = 'table_created') as n_tables_created,
               count(*) filter (kind = 'view') as n_views,
               count(*) filter (status = 'view_created') as n_views_created,
               count(*) filter (status = 'procedure_created') as n_procedures_created,
               count(*) filter (status like 'inventoried_manual_port%') as n_procedures_manual_port,
               count(*) filter (status = 'inventoried_dbr_too_old') as n_procedures_host_too_old,
               count(*) filter (status = 'failed') as n_failed
        from (select kind, status from ({OUTCOMES}) o
              union all select kind, case when language = 'SQL' then 'procedure_created'
                                          else 'inventoried_manual_port_' || lower(language) end
              from ({PROCS}) p) r""",
    "enrich_failures": f"""
        select o."table", o.kind, o.status, o."rows", o.view_id,
               case when o.kind = 'view' and o.status = 'failed' and e.needs is not null
                    then 'missing dependency — view needs ' || e.needs
                         || ' which is not in this run. original error: ' || o.error
                    else o.error end as error
        from ({OUTCOMES}) o
        left join (select view_id, string_agg(distinct ref, ', ' order by ref) as needs
                   from ({EXTERNAL}) x group by 1) e on o.view_id = e.view_id""",
}
ORACLES = {name: with_fixtures(sql) for name, sql in ORACLES.items()}
