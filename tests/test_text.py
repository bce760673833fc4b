from __future__ import annotations

import random
import re
import time
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeops.functions import calls
from lakeops.functions.calls import translate_functions, translate_text
from lakeops.functions.names import object_id, plain_name, quoted_name, with_destination
from lakeops.functions.refs import QUOTED, SQL_KEYWORDS, extract_refs
from lakeops.functions.rewrite import (
    rewrite_backtick,
    rewrite_dquote,
    select_body,
    sql_text,
    view_columns,
    with_procedure_body,
    with_rewritten,
)
from tests.conftest import rows


def each(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.out for r in df.select("i", fn(F.col("t")).alias("out")).orderBy("i").collect()]


def test_names(spark):
    df = spark.createDataFrame([("Cat", "S`x", "T")], "dst_cat string, schema string, name string")
    got = with_destination(df).first()
    assert (got.dst_schema, got.dst_name) == ("s`x", "t")
    assert (got.dst_fq, got.dst_plain) == ("`Cat`.`s``x`.`t`", "Cat.s`x.t")
    assert with_destination(df, lower=False).first().dst_plain == "Cat.S`x.T"
    parts = [F.lit("a.b"), F.lit("c"), F.lit("d")]
    other = [F.lit("a"), F.lit("b.c"), F.lit("d")]
    assert df.select(object_id(*parts) != object_id(*other)).first()[0]
    assert df.select(quoted_name(F.lit(None), F.lit("a")), plain_name(F.lit("a"), F.lit(None))).first() == (None, None)


def refs_of(spark, text):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    return sorted(tuple(r)[1:] for r in extract_refs(df, ["id"], "text").collect())


def test_references(spark):
    assert refs_of(spark, 'select * from db.sch.t join "D b"."s.x".T2 on a.b = c.d') == [
        ("D B", "S.X", "T2"),
        ("DB", "SCH", "T"),
    ]
    # Spelling does not matter for what is the same reference; the keywords rule a match out.
    assert refs_of(spark, 'a.b.c, A.B.C, "a"."b"."c"') == [("A", "B", "C")]
    assert refs_of(spark, "x.select.y from.a.b a.b.end") == []
    # Comments and strings are searched as well, and a column path reads as a reference.
    assert refs_of(spark, "-- see o.l.d\n select 'q.r.s', sch.tab.col") == [
        ("O", "L", "D"), ("Q", "R", "S"), ("SCH", "TAB", "COL"),
    ]
    assert refs_of(spark, "two.parts only, four.parts.are.read as three") == [("FOUR", "PARTS", "ARE")]
    assert refs_of(spark, "1abc.d.e") == [("ABC", "D", "E")]
    assert refs_of(spark, 'x"A"."b".c') == [("A", "B", "C")]
    assert refs_of(spark, None) == refs_of(spark, "") == []


def plain_references(text):
    """The same definition, spelled with Python's own matching."""
    part = rf"(?:{QUOTED}|[A-Z_][A-Z0-9_]*)"
    found = set()
    for match in re.findall(rf"(?i){part}\.{part}\.{part}", text):
        names = re.findall(r'"[^"]+"|[^."]+', match)
        names = tuple(n.strip('"').upper() for n in names)
        if not set(names) & set(SQL_KEYWORDS):
            found.add(names)
    return sorted(found)


def test_references_against_brute_force(spark):
    rng = random.Random(3)
    pieces = ['"', ".", ".", "a", "B", "_", "1", " ", "on", "-"]
    texts = ["".join(rng.choices(pieces, k=60)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for r in extract_refs(df, ["id"], "text").collect():
        got.setdefault(r.id, []).append(tuple(r)[1:])
    for i, text in enumerate(texts):
        assert sorted(got.get(i, [])) == plain_references(text), text


def test_backtick_rewrite(spark):
    texts = [
        "CREATE VIEW `src`.a AS SELECT * FROM src.s.t",
        " create  view v AS SELECT mysrc.x, `src`.y, 'src.z' FROM xsrc.s.t",
        "SELECT 1 /* CREATE VIEW later */ FROM SRC.s.t",
        "CREATE OR REPLACE VIEW v AS SELECT 1",
        "SELECT ésrc.a, src.b",
        None,
    ]
    assert each(spark, texts, lambda t: rewrite_backtick(t, "src", "dst")) == [
        "CREATE OR REPLACE VIEW `dst`.a AS SELECT * FROM dst.s.t",
        "CREATE OR REPLACE VIEW v AS SELECT mysrc.x, `dst`.y, 'dst.z' FROM xsrc.s.t",
        "SELECT 1 /* CREATE VIEW later */ FROM SRC.s.t",
        "CREATE OR REPLACE VIEW v AS SELECT 1",
        "SELECT ésrc.a, dst.b",
        None,
    ]


@pytest.mark.parametrize("src", ["a.b", "x+", r"q\E", "(", "$d"])
def test_names_are_not_patterns(spark, src):
    text = f"SELECT * FROM {src}.s.t, ab.s.t"
    done = f"SELECT * FROM $1\\x.s.t, ab.s.t"
    assert each(spark, [text], lambda t: rewrite_backtick(t, src, "$1\\x")) == [done]
    assert each(spark, [text], lambda t: rewrite_dquote(t, src, "$1\\X")) == [done]


def test_dquote_rewrite(spark):
    texts = ['SELECT * FROM Src.a, SRC.b, src.c, sRc.d, mysrc.e, "SRC".f, "src"."g", "sRc".h', None]
    expected = ['SELECT * FROM dst.a, dst.b, dst.c, sRc.d, mysrc.e, "dst".f, "dst"."g", "sRc".h', None]
    assert each(spark, texts, lambda t: rewrite_dquote(t, "Src", "DST")) == expected
    # A destination that holds the source name is written once.
    assert each(spark, ["DB.s.t"], lambda t: rewrite_dquote(t, "DB", "my-db")) == ["my-db.s.t"]


def test_rewrites_are_idempotent(spark):
    texts = ["CREATE VIEW `src`.v AS SELECT src.a FROM src.s.t", 'SELECT "src".a, SRC.b FROM src.s.t']
    for rewrite in (rewrite_backtick, rewrite_dquote):
        once = each(spark, texts, lambda t: rewrite(t, "src", "dst"))
        assert each(spark, once, lambda t: rewrite(t, "src", "dst")) == once


def test_names_may_differ_per_row(spark):
    df = spark.createDataFrame([("a.x b.x", "a", "A1"), ("a.x b.x", "b", "B1")], "t string, s string, d string")
    assert rows(df.select(rewrite_dquote(F.col("t"), F.col("s"), F.col("d")))) == [("a.x b1.x",), ("a1.x b.x",)]


def test_select_body(spark):
    texts = [
        "CREATE VIEW v AS SELECT 1",
        "\n create or replace\nsecure recursive view a.\"b c\".`d e` ( x , y )\nas\n select 'AS' as q \n",
        "CREATE VIEW v (a COMMENT 'n (1)', b) AS WITH c AS (SELECT 1) SELECT * FROM c",
        "CREATE VIEW db.v (c1) WITH SCHEMA COMPENSATION AS SELECT 1 AS c1",
        "CREATE VIEW db.v WITH SCHEMA TYPE EVOLUTION AS SELECT 1",
        "CREATE VIEW assets AS SELECT 1",
        "SELECT 1 AS a",
        "CREATE TABLE t AS SELECT 1",
        "CREATE VIEW v AS(SELECT 1)",
        None,
    ]
    assert each(spark, texts, select_body) == [
        "SELECT 1",
        "select 'AS' as q",
        "WITH c AS (SELECT 1) SELECT * FROM c",
        "SELECT 1 AS c1",
        "SELECT 1",
        "SELECT 1",
        "SELECT 1 AS a",
        "CREATE TABLE t AS SELECT 1",
        "(SELECT 1)",
        None,
    ]
    assert each(spark, texts[:4], view_columns) == [None, "( x , y )", "(a COMMENT 'n (1)', b)", "(c1)"]


def test_long_column_list(spark):
    names = ", ".join(f"c{i} COMMENT 'number ({i}'" if i % 9 == 0 else f"c{i} (x)" for i in range(3000))
    text = f"CREATE VIEW v ({names}) AS SELECT 1"
    assert each(spark, [text], select_body) == ["SELECT 1"]
    assert each(spark, [text], view_columns) == [f"({names})"]
    plain = ", ".join(f"column_number_{i}" for i in range(50_000))
    assert each(spark, [f"CREATE VIEW v ({plain}) AS SELECT 1"], view_columns) == [f"({plain})"]


CASES = [
    ("ZEROIFNULL(x)", "COALESCE(x, 0)"),
    ("zeroifnull (f(x, (y)))", "COALESCE(f(x, (y)), 0)"),
    ("ZEROIFNULL(ZEROIFNULL(x))", "COALESCE(COALESCE(x, 0), 0)"),
    ("ZEROIFNULL(')')", "COALESCE(')', 0)"),
    ("ZEROIFNULL(x", "ZEROIFNULL(x"),
    ("ZEROIFNULL(ZEROIFNULL(x)", "ZEROIFNULL(COALESCE(x, 0)"),
    ("a) ZEROIFNULL(x)", "a) COALESCE(x, 0)"),
    ("MYZEROIFNULL(x)", "MYZEROIFNULL(x)"),
    ("ZEROIFNULL()", "ZEROIFNULL()"),
    ("REGEXP_REPLACE(a, b)", "REGEXP_REPLACE(a, b, '')"),
    ("regexp_replace(f(a,b),'p')", "REGEXP_REPLACE(f(a,b), 'p', '')"),
    ("REGEXP_REPLACE(a, '(x),(y))')", "REGEXP_REPLACE(a, '(x),(y))', '')"),
    ("REGEXP_REPLACE(a, 'it''s,')", "REGEXP_REPLACE(a, 'it''s,', '')"),
    ("REGEXP_REPLACE(a, b, c)", "REGEXP_REPLACE(a, b, c)"),
    ("regexp_replace(zeroifnull(a), b, c)", "regexp_replace(COALESCE(a, 0), b, c)"),
    ("IFF(a, b, c)", "CASE WHEN a THEN b ELSE c END"),
    ("IFF(a, IFF(b, 1, 2), c)", "CASE WHEN a THEN CASE WHEN b THEN 1 ELSE 2 END ELSE c END"),
    ("IFF(a, b)", "IFF(a, b)"),
    ("TO_VARCHAR(x)", "CAST(x AS STRING)"),
    ("TO_VARCHAR(x, 'YYYY')", "TO_VARCHAR(x, 'YYYY')"),
    ("s.TO_VARCHAR(x)", "s.TO_VARCHAR(x)"),
    ("-- ZEROIFNULL(x)\nZEROIFNULL(y)", "-- ZEROIFNULL(x)\nCOALESCE(y, 0)"),
    ("-- don't\nZEROIFNULL(y)", "-- don't\nCOALESCE(y, 0)"),
    ('"ZEROIFNULL(" ZEROIFNULL(y)', '"ZEROIFNULL(" COALESCE(y, 0)'),
    ("LISTAGG(x, ',') WITHIN GROUP (ORDER BY y)", "LISTAGG(x, ',') WITHIN GROUP (ORDER BY y)"),
    ("ZEROIFNULL({x}) {0}", "COALESCE({x}, 0) {0}"),
    ("", ""),
    (None, None),
]


def test_translated_calls(spark):
    assert each(spark, [c[0] for c in CASES], translate_functions) == [c[1] for c in CASES]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab(),'\"- *//\nZIF", max_size=60))
def test_other_text_is_untouched(text):
    if not re.search(r"(?i)(ZEROIFNULL|REGEXP_REPLACE|IFF|TO_VARCHAR)\s*\(", text):
        assert translate_text(text) == text


@settings(max_examples=200, deadline=None)
@given(
    st.recursive(
        st.sampled_from([("x", "x"), ("'a)'", "'a)'"), ("f(y, 1)", "f(y, 1)")]),
        lambda inner: st.one_of(
            inner.map(lambda p: (f"ZEROIFNULL({p[0]})", f"COALESCE({p[1]}, 0)")),
            inner.map(lambda p: (f"TO_VARCHAR({p[0]})", f"CAST({p[1]} AS STRING)")),
            st.tuples(inner, inner, inner).map(
                lambda t: (
                    f"IFF({t[0][0]}, {t[1][0]}, {t[2][0]})",
                    f"CASE WHEN {t[0][1]} THEN {t[1][1]} ELSE {t[2][1]} END",
                )
            ),
        ),
        max_leaves=12,
    )
)
def test_nested_calls(pair):
    assert translate_text(f"SELECT {pair[0]} FROM t") == f"SELECT {pair[1]} FROM t"


def test_long_text_is_translated_whole():
    text = "ZEROIFNULL(a) " * 50_000
    assert translate_text(text) == "COALESCE(a, 0) " * 50_000


@pytest.mark.parametrize("piece", ["/* ", "' ", '" ', "/*'\"", "ZEROIFNULL( /* "])
def test_hostile_text_is_scanned_once(piece):
    text = "SELECT ZEROIFNULL(a), " + piece * (1_000_000 // len(piece))
    start = time.perf_counter()
    assert translate_text(text).startswith("SELECT COALESCE(a, 0), ")
    assert time.perf_counter() - start < 2


def test_spark_runs_the_translated_text(spark):
    text = "SELECT ZEROIFNULL(NULL) a, REGEXP_REPLACE('axb', 'x') b, IFF(1 > 0, TO_VARCHAR(7), 'n') c"
    assert spark.sql(translate_text(text)).first() == (0, "ab", "7")


def test_procedure_body(spark):
    texts = ["EXECUTE AS CALLER BEGIN UPDATE DB.s.t SET q = ZEROIFNULL(q); END", "execute  as owner x", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    done = with_procedure_body(df, "out", F.col("t"), "DB", "New").orderBy("i")
    assert [r.out for r in done.collect()] == [" BEGIN UPDATE new.s.t SET q = COALESCE(q, 0); END", " x", "", None]
    assert each(spark, ["it's"], sql_text) == ["it''s"]


def test_text_is_repointed_once(spark):
    df = spark.createDataFrame([("DB.x",)], "t string")
    plan = with_rewritten(df, "out", F.col("t"), "DB", "new")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(regexp_replace(") == 1


def test_a_worker_holds_one_text_at_a_time():
    """Of a batch of 20 MB, Python's own memory never has more than a few texts."""
    texts = pa.array(["SELECT ZEROIFNULL(q), '" + "x" * 100_000 + "'", None] * 200)
    tracemalloc.start()
    done = next(calls._translate_batches.func(iter([texts])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done.to_pylist() == ["SELECT COALESCE(q, 0), '" + "x" * 100_000 + "'", None] * 200
    assert peak < 2_000_000
