from __future__ import annotations

import random

import pytest

from lakeops.operators import deps, discovery
from lakeops.plans.migration import preflight
from lakeops.sources import mapping
from tests.conftest import rows


def levels_of(spark, nodes, edges):
    node_df = spark.createDataFrame([(n,) for n in nodes], "view_id string")
    edge_df = spark.createDataFrame(edges, "view_id string, dep_id string")
    return {r.view_id: (r.level, r.is_circular) for r in deps.dependency_levels(node_df, edge_df).collect()}


def expected_levels(nodes, edges):
    """Level by level on plain sets."""
    open_deps = {n: {d for v, d in edges if v == n and d != n} for n in nodes}
    out, level = {}, 0
    while True:
        ready = {n for n in nodes if n not in out and not open_deps[n] - set(out)}
        if not ready:
            break
        out.update({n: level for n in ready})
        level += 1
    return {n: (out[n], False) if n in out else (level, True) for n in nodes}


@pytest.mark.parametrize(
    ("nodes", "edges"),
    [
        ("ab", []),
        ("", []),
        ("abcd", [("b", "a"), ("c", "a"), ("d", "b"), ("d", "c")]),
        ("abcd", [("b", "a"), ("c", "b"), ("c", "a"), ("d", "c"), ("d", "a"), ("d", "d")]),
        ("abcde", [("a", "b"), ("b", "a"), ("c", "a"), ("d", "e"), ("c", "d")]),
        ("ab", [("a", "b"), ("b", "a")]),
        ("a", [("a", "a")]),
        ("ab", [("b", "a"), ("b", "a")]),
    ],
)
def test_levels(spark, nodes, edges):
    assert levels_of(spark, nodes, edges) == expected_levels(nodes, edges)


@pytest.mark.parametrize("broadcast", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_levels_of_random_graphs(spark, setting, seed, broadcast):
    if not broadcast:
        setting("spark.sql.autoBroadcastJoinThreshold", "-1")
        setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(seed)
    nodes = [f"n{i}" for i in range(40)]
    acyclic = seed % 2 == 0
    edges = []
    for _ in range(60):
        a, b = rng.sample(range(40), 2)
        edges.append((nodes[max(a, b)], nodes[min(a, b)]) if acyclic else (nodes[a], nodes[b]))
    got = levels_of(spark, nodes, edges)
    assert got == expected_levels(nodes, edges)
    assert all(got[v][0] > got[d][0] for v, d in edges if not got[v][1])


def test_levels_of_a_long_chain(spark):
    n = 60
    edges = [(f"v{i + 1}", f"v{i}") for i in range(n)]
    got = levels_of(spark, [f"v{i}" for i in range(n + 1)], edges)
    assert got == {f"v{i}": (i, False) for i in range(n + 1)}


VIEWS = "src_db string, schema string, name string, view_definition string"


def test_edges_between_views_of_the_run(spark):
    from lakeops.functions.refs import extract_refs

    views = spark.createDataFrame(
        [
            ("db", "S", "base", "SELECT * FROM db.s.table1"),
            ("DB", "S", "self", "SELECT * FROM DB.S.SELF JOIN db.s.base ON 1 = 1"),
            ("DB", "S", "twice", 'SELECT * FROM db.s.base, DB."S"."BASE", other.s.base'),
            ("DB", "S", "none", None),
        ],
        VIEWS,
    )
    refs = extract_refs(views, ["src_db", "schema", "name"], "view_definition")
    edges = deps.view_edges(refs, views)
    assert rows(edges) == [("DB.S.SELF", "DB.S.BASE"), ("DB.S.TWICE", "DB.S.BASE")]
    ids = spark.createDataFrame([(f"DB.S.{n}",) for n in ("BASE", "SELF", "TWICE", "NONE")], "view_id string")
    assert rows(deps.in_degree(ids, edges)) == [
        ("DB.S.BASE", 0), ("DB.S.NONE", 0), ("DB.S.SELF", 1), ("DB.S.TWICE", 1),
    ]


def test_external_references(spark):
    pairs = spark.createDataFrame([("db", "cat")], "source_database string, destination_catalog string")
    refs = spark.createDataFrame(
        [("db", "S", "v", "DB", "S", "T"), ("db", "S", "v", "EXT", "S", "T"), ("db", "S", "w", "EXT", "S", "T")],
        "src_db string, schema string, name string, ref_db string, ref_schema string, ref_table string",
    )
    external = deps.external_refs(refs, pairs)
    assert rows(external) == [("db.S.v", "EXT.S.T", "EXT"), ("db.S.w", "EXT.S.T", "EXT")]
    assert rows(deps.external_refs_by_db(external)) == [("EXT", 2, 2)]


def test_failed_views_name_what_they_miss(spark):
    log = spark.createDataFrame(
        [
            ("a", "view", "failed", "boom", "db.s.a"),
            ("b", "view", "failed", "boom", "db.s.b"),
            ("c", "view", "view_created", None, "db.s.c"),
            ("d", "table", "failed", "boom", "db.s.d"),
        ],
        "table string, kind string, status string, error string, view_id string",
    )
    external = spark.createDataFrame(
        [(f"db.s.{v}", f"X.S.{t}", "X") for v, t in ["a2", "a1", "a1", "c1", "d1"]],
        "view_id string, ref string, missing_db string",
    )
    assert rows(deps.enrich_failures(log, external), "table", "error") == [
        ("a", "missing dependency — view needs X.S.1, X.S.2 which is not in this run. original error: boom"),
        ("b", "boom"),
        ("c", None),
        ("d", "boom"),
    ]


def test_mapping_file(spark, tmp_path):
    path = tmp_path / "mapping.csv"
    path.write_text(" Source_Database ,DESTINATION_CATALOG,note\nDB1,cat1,x\nNA, c2 ,\nnull,n,\nDB3,  ,\n,cat4,\n")
    assert rows(mapping.read_mapping(spark, str(path))) == [("DB1", "cat1"), ("NA", " c2 "), ("null", "n")]
    path.write_text("source_catalog,destination_catalog\n")
    assert rows(mapping.read_mapping(spark, str(path), "source_catalog")) == []
    with pytest.raises(ValueError, match="source_database"):
        mapping.read_mapping(spark, str(path))


TABLES = "src_db string, table_schema string, table_name string, table_type string"


def test_discovery(spark):
    pairs = spark.createDataFrame([("db", "cat")], "source_database string, destination_catalog string")
    tables = spark.createDataFrame(
        [
            ("DB", "S", "t", "BASE TABLE"),
            ("DB", "S", "v", "view"),
            ("DB", "S", "m", "MATERIALIZED VIEW"),
            ("DB", "S", "n", None),
            ("DB", "INFORMATION_SCHEMA", "x", "VIEW"),
            ("DB", "information_schema", "y", "VIEW"),
            ("OTHER", "S", "t", "VIEW"),
        ],
        TABLES,
    )
    found = discovery.discover_objects(pairs, tables)
    assert rows(found, "kind", "src_db", "name") == [
        ("table", "db", "m"), ("table", "db", "n"), ("table", "db", "t"), ("view", "db", "v"), ("view", "db", "y"),
    ]
    folded = discovery.discover_objects(pairs, tables, ignore_case=True)
    assert "y" not in {r.name for r in folded.collect()}
    assert [r.name for r in folded.collect()] == ["m", "n", "t", "v"]
    assert rows(discovery.object_counts(found)) == [("db", "table", 3), ("db", "view", 2)]
    definitions = spark.createDataFrame(
        [("DB", "S", "v", "SELECT * FROM EXT.S.T, DB.S.U"), ("DB", "S", "gone", "SELECT * FROM EXT.S.T")],
        "src_db string, table_schema string, table_name string, view_definition string",
    )
    texts = discovery.attach_definitions(found, definitions)
    assert {r.name for r in texts.filter("view_definition is not null").collect()} == {"v"}
    # References of definitions that are not part of the run are not reported.
    assert rows(preflight(pairs, tables, definitions)) == [("db.S.v", "EXT.S.T", "EXT")]
