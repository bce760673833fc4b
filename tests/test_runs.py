"""Runs that are cut off, repeated and taken up again."""

from __future__ import annotations

import itertools
import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from lakeops.functions.calls import translate_text
from lakeops.functions.scopes import extract_relations, relations
from lakeops.operators import cycles, requests
from lakeops.session import new_path, scratch, shared_dir
from lakeops.sinks import batches, copy_queue, runlog, tables, verify, views
from lakeops.sources import connector, incremental
from tests.conftest import rows

LOG = "`table` string, kind string, status string, `rows` bigint, error string"


@pytest.fixture
def database(spark):
    name = f"run_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def _outcomes(spark, *names):
    return spark.createDataFrame([(n, "table", "table_created", 1, None) for n in names], LOG)


def _failing(df, at="table"):
    return df.repartition(4).withColumn(at, F.when(F.col(at) != "bad", F.col(at)).otherwise(F.raise_error(F.lit("cut off"))))


def test_a_batch_sent_twice_is_there_once(spark, database):
    log = f"{database}.log"
    with pytest.raises(Exception, match="cut off"):
        runlog.append_run_log(spark, _failing(_outcomes(spark, *"abcd", "bad")), log, "t0", batch="first")
    assert rows(spark.table(log)) == []
    for _ in range(2):
        runlog.append_run_log(spark, _outcomes(spark, *"abcd"), log, "t0", batch="first")
    runlog.append_run_log(spark, _outcomes(spark, "e"), log, "t0", batch="it's 2/3 = another")
    with pytest.raises(Exception, match="cut off"):
        runlog.append_run_log(spark, _failing(_outcomes(spark, "e", "bad")), log, "t0", batch="first")
    # The same name in another run is another batch; rows without a name stay; columns are added.
    runlog.append_run_log(spark, _outcomes(spark, "a"), log, "t1", batch="first")
    runlog.append_run_log(spark, _outcomes(spark, "f"), log, "t1")
    done = runlog.append_run_log(spark, _outcomes(spark, "g").withColumn("note", F.lit("new")), log, "t2", batch="first")
    assert rows(done, "table", "migrated_at", "note") == [
        ("a", "t0", None), ("a", "t1", None), ("b", "t0", None), ("c", "t0", None), ("d", "t0", None), ("e", "t0", None),
        ("f", "t1", None), ("g", "t2", "new"),
    ]


def test_batches_in_a_log_from_before_them(spark, database):
    log = f"{database}.log"
    runlog.append_run_log(spark, _outcomes(spark, "a"), log, "t0")
    for _ in range(2):
        runlog.append_run_log(spark, _outcomes(spark, "b"), log, "t1", batch="x")
    assert rows(spark.table(log), "table", "batch") == [("a", None), ("b", "t1 x")]


def test_a_failed_write_leaves_the_old_rows(spark, database):
    name = f"{database}.t"
    tables.overwrite_table(_outcomes(spark, "a", "b"), name)
    reader = spark.table(name)
    with pytest.raises(Exception, match="cut off"):
        tables.overwrite_table(_failing(_outcomes(spark, "c", "bad")), name)
    assert rows(spark.table(name), "table") == [("a",), ("b",)]
    # Its own rows may be read for the new ones, and a reader that has begun still finds its files.
    tables.overwrite_table(spark.table(name).union(_outcomes(spark, "c")), name)
    assert rows(spark.table(name), "table") == [("a",), ("b",), ("c",)] and rows(reader, "table") == [("a",), ("b",)]
    # Other columns or another format take its place as well, and a failure before that still leaves the old rows.
    with pytest.raises(Exception, match="cut off"):
        tables.overwrite_table(_failing(_outcomes(spark, "bad")).select("table"), name)
    tables.overwrite_table(spark.range(2), name, "orc")
    assert rows(spark.table(name)) == [(0,), (1,)]
    folders = spark._jvm.org.apache.hadoop.fs.Path(spark.catalog.getDatabase(database).locationUri + "/t.versions")
    left = folders.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folders)
    assert len(left) == 2
    spark.sql(f"CREATE VIEW {database}.v AS SELECT 1 AS a")
    with pytest.raises(ValueError, match="is a view"):
        tables.overwrite_table(spark.range(1), f"{database}.v")


def test_snapshots_over_a_table_that_spark_made(spark, database):
    spark.range(3).write.saveAsTable(f"{database}.made")
    tables.overwrite_table(spark.range(5), f"`spark_catalog`.`{database}`.made")
    assert spark.table(f"{database}.made").count() == 5


def _objects(spark, database, *named):
    return spark.createDataFrame([("src", "spark_catalog", database, n, b) for n, b in named], "src_db string, dst_cat string, schema string, name string, bytes bigint")


def test_a_copy_goes_on_where_it_was_cut_off(spark, database):
    sizes = {"A": 10, "B": 500, "C": 70, "D": None, "E": 300, "F": 1}
    read = []

    def reader(o):
        read.append(o.name)
        if o.name == "C" and read.count("C") == 1:
            raise ConnectionError("gone")
        return spark.range(len(read))

    queue = f"{database}.queue"
    copy_queue.plan_queue(spark, _objects(spark, database, *sizes.items()), queue)
    first = copy_queue.copy_queued(spark, queue, reader, parallelism=1, every_rows=1)
    begun = [o[0] for o in itertools.islice(first, 3)]
    first.close()
    assert read[:4] == ["B", "E", "C", "A"] and [b[-1] for b in begun] == ["b", "e", "c"]
    # The plan is that of the first call, whatever the second one names.
    states = copy_queue.copy_resumable(spark, _objects(spark, database, ("Z", 1)), reader, queue, parallelism=1)
    assert {r.table[-1]: (r.status, r.attempts) for r in states.collect()} == {
        "a": ("table_created", 1), "b": ("table_created", 1), "c": ("table_created", 2), "d": ("table_created", 1),
        "e": ("table_created", 1), "f": ("table_created", 1),
    }
    assert read.count("B") == read.count("E") == 1 and read.count("C") == 2
    # A table that has gone since is copied again, and nothing else.
    spark.sql(f"DROP TABLE {database}.e")
    before = len(read)
    copy_queue.copy_resumable(spark, _objects(spark, database), reader, queue)
    assert read[before:] == ["E"] and spark.catalog.tableExists(f"{database}.e")


def test_a_queue_of_nothing(spark, database):
    assert copy_queue.copy_resumable(spark, _objects(spark, database), lambda o: 1 / 0, f"{database}.queue").count() == 0


def test_one_changed_cell_is_found(spark, database):
    df = spark.sql(
        "SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS n, CAST(id AS STRING) AS `a``b.c`, map('k', id) AS m, "
        "array(named_struct('x', id, 'y', map(1, 'z'))) AS nested, CAST(id / 7 AS DOUBLE) AS d FROM range(100)"
    )
    objects = _objects(spark, database, ("T", 1), ("EMPTY", 1), ("BAD", 1))
    copied = verify.copy_verified(spark, objects, lambda o: {"T": df, "EMPTY": df.limit(0)}[o.name])
    assert {r.table.split(".")[-1]: (r.status, r.rows) for r in copied.collect()} == {"t": ("table_created", 100), "empty": ("table_created", 0), "bad": ("failed", None)}
    assert rows(verify.verify_copies(spark, copied), "same") == [(True,)] * 14
    name = f"{database}.t"

    def differing(changed):
        tables.overwrite_table(changed, name)
        return [r[0] for r in rows(verify.verify_copies(spark, copied).filter("NOT same"), "column_name")]

    assert differing(df.orderBy(F.rand())) == []
    assert differing(df.withColumn("n", F.when(F.col("id") != 4, F.col("n")))) == ["n"]
    assert differing(df.withColumn("m", F.when(F.col("id") != 4, F.col("m")).otherwise(F.create_map(F.lit("k"), F.lit(5).cast("long"))))) == ["m"]
    assert differing(df.filter("id <> 4")) == ["a`b.c", "d", "id", "m", "n", "nested", None]
    assert differing(df.filter("id <> 4").union(df.filter("id = 5"))) == ["a`b.c", "d", "id", "m", "n", "nested"]
    assert differing(df.drop("d")) == ["d"]


def test_ranges_hold_even_numbers_of_rows(spark, database):
    name = f"{database}.skewed"
    spark.sql(f"CREATE VIEW {name} AS SELECT id, pow(id, 6) AS p, CASE WHEN id % 10 = 0 THEN NULL ELSE date_add(DATE '2020-01-01', CAST(sqrt(id) AS INT)) END AS day FROM range(20000)")
    for column, nulls in (("p", 0), ("day", 2000), ("id", 0)):
        ranges = connector.depth_ranges(spark, None, {}, database, "skewed", column, 1000)
        sizes = [connector.scan_ranges(spark, None, None, name, [r]).count() for r in ranges]
        assert sum(sizes) == 20000 and len(sizes) >= 19
        even = sorted(sizes[:-1] if nulls else sizes)
        assert max(even) < 2 * even[len(even) // 2] and (not nulls or sizes[-1] == nulls)
        assert connector.scan_ranges(spark, None, None, name, ranges).count() == 20000
    none = f"{database}.none"
    spark.sql(f"CREATE VIEW {none} AS SELECT CAST(NULL AS INT) AS k FROM range(3)")
    assert connector.depth_ranges(spark, None, {}, database, "none", "k", 1) == []
    one = f"{database}.one"
    spark.sql(f"CREATE VIEW {one} AS SELECT IF(id < 5, 1, NULL) AS k FROM range(9)")
    ranges = connector.depth_ranges(spark, None, {}, database, "one", "k", 2)
    assert [connector.scan_ranges(spark, None, None, one, [r]).count() for r in ranges] == [5, 4]


def _views(spark, *given):
    return spark.createDataFrame(given, "level int, view_id string, dst_plain string, reads array<string>, statement string")


def test_views_start_when_what_they_read_is_there(spark, database):
    made = lambda n, sql: f"CREATE OR REPLACE VIEW {database}.{n} AS {sql}"
    planned = _views(
        spark,
        (0, "A", "a", [], made("a", "SELECT 1 AS x")),
        (0, "BAD", "bad", None, made("bad", "SELECT * FROM nowhere")),
        (1, "B", "b", ["A"], made("b", f"SELECT * FROM {database}.a")),
        (1, "P", "p", ["BAD", "A"], made("p", "SELECT 1 AS x")),
        (2, "Q", "q", ["P", "B"], made("q", "SELECT 1 AS x")),
        (2, "C", "c", ["B", "C"], made("c", f"SELECT * FROM {database}.b")),
        (3, "ONE", "one", ["TWO"], made("one", f"SELECT * FROM {database}.two")),
        (3, "TWO", "two", ["ONE"], made("two", f"SELECT * FROM {database}.one")),
    )
    for parallelism in (1, 4):
        got = {r.table: (r.status, r.error) for r in views.recreate_views(spark, planned, parallelism).collect()}
        assert [n for n in got if got[n][0] == "view_created"] and {n for n in got if got[n][0] == "view_created"} == {"a", "b", "c"}
        assert got["p"][1] == views.NOT_TRIED.format("BAD") and got["q"][1] == views.NOT_TRIED.format("P")
        assert "nowhere" in got["bad"][1] and not spark.catalog.tableExists(f"{database}.p")
        assert {got["one"][0], got["two"][0]} == {"failed"}


def test_views_wait_for_no_level(spark, monkeypatch):
    """A slow view holds up those that read it, and no others; few are drawn ahead."""
    monkeypatch.setattr(views, "DRAWN_AHEAD", 2)
    log = []

    def create(v):
        log.append(("begin", v.view_id))
        time.sleep(0.8 if v.view_id == "slow" else 0.01)
        log.append(("end", v.view_id))
        return (v.dst_plain, "view", views.VIEW_CREATED, None, None)

    named = [(0, "slow", []), (0, "fast", []), (1, "on fast", ["fast"]), (1, "on slow", ["slow"]), (2, "last", ["on fast"]), (3, "both", ["last", "on slow"])]
    rows_ = _views(spark, *[(level, n, n, reads, "") for level, n, reads in named]).collect()
    done = list(views._as_ready(spark, sorted(rows_, key=lambda v: v.level), create, lambda v, e: None, 2))
    assert len(done) == 6 and log.index(("end", "last")) < log.index(("end", "slow")) < log.index(("begin", "on slow"))
    assert log[-1] == ("end", "both")


def test_short_names_mean_what_they_mean_to_the_caller(spark, database):
    spark.sql(f"CREATE TABLE {database}.here AS SELECT 1 AS x")
    spark.sql("CREATE TABLE default.here AS SELECT 2 AS x")
    other = f"{database}_home"
    spark.sql(f"CREATE DATABASE {other}")
    spark.sql(f"CREATE TABLE {other}.here AS SELECT 3 AS x")
    try:
        spark.sql(f"USE {database}")
        planned = spark.createDataFrame(
            [(0, "v", f"CREATE VIEW {database}.v AS SELECT * FROM here", None), (0, "w", f"CREATE VIEW {database}.w AS SELECT * FROM here", ["spark_catalog", other])],
            "level int, dst_plain string, statement string, home array<string>",
        )
        assert rows(views.recreate_views(spark, planned), "status") == [("view_created",)] * 2
        assert spark.catalog.currentDatabase() == database
    finally:
        spark.sql("USE default")
        spark.sql("DROP TABLE default.here")
    assert rows(spark.table(f"{database}.v")) == [(1,)] and rows(spark.table(f"{database}.w")) == [(3,)]


@pytest.mark.parametrize(
    ("sql", "want"),
    [
        ("select * from a, b.c join `x y`.d.e on f.g = h.i where j in (select k from l)", ["a", "b.c", "x y.d.e", "l"]),
        ("with a as (select * from t), b as (select * from a) select * from a join b join c", ["t", "c"]),
        ("select * from (with a as (select 1) select * from a) x, a", ["a"]),
        ("with a as (select * from a) select * from a", ["a"]),
        ("with recursive a as (select 1 union all select * from a), b as (select * from a) select * from b", []),
        ("select extract(year from d), trim(both 'x' from s) from t -- from u\n where x = 'from v' /* from /* n */ from z */", ["t"]),
        ("select a is distinct from b, a is not distinct from c from t", ["t"]),
        ("select * from (a join b on a.x = b.x) join (select * from c) d, ((select * from e) union (select * from f)) g", ["a", "b", "c", "e", "f"]),
        ("select * from t lateral view explode(x) e as f, g", ["t"]),
        ("select * from range(5), explode(a) u, v where x = 'it''s' and y = 'a\\' from z'", ["v"]),
        ("with a(x, y) as (select 1, 2), b as (select * from a, q) (select * from b) union select * from a", ["q"]),
        ("select * from a left outer join lateral (select * from b) c on true, lateral (select * from d) e", ["a", "b", "d"]),
        ("select * from `a``b`.c /* open", ["a`b.c"]),
        ("", []),
        ("select ((((1", []),
    ],
)
def test_names_in_their_scopes(sql, want):
    assert [".".join(p) for p in relations(sql)] == want


def test_names_of_texts(spark):
    assert relations('select * from "a b"."c"', True) == [("a b", "c")] and relations('select "from x" from t') == [("t",)]
    df = spark.createDataFrame([(1, "select * from a join b"), (2, None), (3, "select 1"), (4, "select * from " + "(" * 50_000)], "id int, text string")
    assert rows(extract_relations(df, ["id"], "text")) == [(1, ["a"]), (1, ["b"])]


def _plain_cycles(nodes, edges):
    """By reach of each node."""
    reads = {n: {d for a, d in edges if a == n and d != n} for n in nodes}
    reach = {}
    for n in nodes:
        seen, open_ = set(), list(reads[n])
        while open_:
            d = open_.pop()
            if d not in seen:
                seen.add(d)
                open_ += reads[d]
        reach[n] = seen
    on = {n: frozenset(m for m in reach[n] if n in reach[m]) for n in nodes if n in reach[n]}
    above = {n for n in nodes if n not in on and reach[n] & on.keys()}
    return {**{n: (min(m), len(m)) for n, m in on.items()}, **{n: (None, 0) for n in above}}


@pytest.mark.parametrize("seed", range(3))
def test_cycles_against_reach(spark, setting, seed):
    rng = random.Random(seed)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1" if seed else "10MB")
    nodes = [f"n{k:02d}" for k in range(30)]
    edges = [(a, rng.choice(nodes)) for a in nodes for _ in range(rng.choice([0, 1, 1, 2]))]
    if seed == 2:
        edges = [(a, b) for a, b in edges if a > b] + [("n05", "n05")]
    got = cycles.view_cycles(spark.createDataFrame([(n,) for n in nodes], "view_id string"), spark.createDataFrame(edges, "view_id string, dep_id string"))
    assert {r.view_id: (r.cycle, r.n_members) for r in got.collect()} == _plain_cycles(nodes, edges)


def test_bad_requests_stand_alone():
    calls = []

    def fn(batch):
        calls.append(len(batch))
        if any(b.startswith("bad") for b in batch):
            raise ValueError(f"no: {batch[0]}")
        return [b.upper() for b in batch][: 1 if "short" in batch else None]

    asked = [f"r{k}" for k in range(64)]
    asked[37] = "bad one"
    got = requests.ask_apart(fn, asked)
    assert got[37] == (None, "no: bad one") and [g for k, g in enumerate(got) if k != 37] == [(a.upper(), None) for a in asked if a != "bad one"]
    assert len(calls) <= 14
    assert requests.ask_apart(fn, ["short", "b"]) == [("SHORT", None), ("B", None)] and requests.ask_apart(fn, []) == []


def test_answers_are_asked_for_once(spark, database):
    asked = spark.sparkContext.accumulator(0)

    def fn(batch):
        asked.add(len(batch))
        if any("bad" in b for b in batch):
            raise ValueError("no")
        return [f"<{b}>" for b in batch]

    cache = f"{database}.cache"
    df = spark.createDataFrame([(k, f"q{k % 7}", "old") for k in range(70)] + [(100, None, "old")], "id int, request string, answer string")
    got = requests.with_answers(df, fn, cache, waves=3, tasks=2)
    assert asked.value == 7 and got.columns == ["id", "request", "answer", "error"]
    assert {(r.id, r.answer) for r in got.collect()} == {(k, f"<q{k % 7}>") for k in range(70)} | {(100, None)}
    more = spark.createDataFrame([(1, "q1"), (2, "bad"), (3, "new")], "id int, request string")
    before = asked.value
    assert rows(requests.with_answers(more, fn, cache), "id", "answer", "error") == [(1, "<q1>", None), (2, None, "no"), (3, "<new>", None)]
    # The new one once alone and once beside the bad one.
    assert asked.value - before <= 4
    assert rows(requests.with_answers(more, lambda batch: ["late"] * len(batch), cache), "id", "answer", "error") == [(1, "<q1>", None), (2, "late", None), (3, "<new>", None)]


def test_files_are_taken_up_as_they_come(spark, database, tmp_path):
    def drop(name, **records):
        spark.createDataFrame([(k, v) for k, v in records.items()], "cluster_id string, cluster_name string").coalesce(1).write.mode("append").json(f"{tmp_path}/{name}")
        time.sleep(0.05)

    def refresh(name, **how):
        found = incremental.refresh(spark, "clusters", f"{tmp_path}/{name}", f"{database}.{name}", f"{tmp_path}/progress-{name}", **how)
        return rows(found, "cluster_id", "cluster_name")

    drop("c", a="1", b="1")
    assert refresh("c") == [("a", "1"), ("b", "1")] and refresh("c") == [("a", "1"), ("b", "1")]
    drop("c", b="2", c="2")
    drop("c", c="3")
    assert refresh("c", files=1) == [("a", "1"), ("b", "2"), ("c", "3")]
    # All at once, without the progress of before, gives the same; so does a merge that is repeated.
    again = incremental.refresh(spark, "clusters", f"{tmp_path}/c", f"{database}.again", f"{tmp_path}/progress-again")
    assert rows(again, "cluster_id", "cluster_name") == refresh("c")
    assert rows(incremental.refresh(spark, "clusters", f"{tmp_path}/c", f"{database}.c", f"{tmp_path}/progress-other"), "cluster_id", "cluster_name") == refresh("c")
    spark.createDataFrame([("s", 1)], "sku_name string, usage_quantity int").write.json(f"{tmp_path}/u")
    for _ in range(2):
        usage = incremental.refresh(spark, "usage", f"{tmp_path}/u", f"{database}.u", f"{tmp_path}/progress-u")
    assert usage.count() == 1
    spark.createDataFrame([("s", 1)] * 2, "sku_name string, usage_quantity int").write.mode("append").json(f"{tmp_path}/u")
    assert incremental.refresh(spark, "usage", f"{tmp_path}/u", f"{database}.u", f"{tmp_path}/progress-u").count() == 3


def test_newest_sends_a_record_and_its_file_once(spark, setting):
    setting("spark.sql.adaptive.enabled", "false")
    file = F.concat(F.lit("f" * 5000), F.col("id").cast("string"))
    ages = F.struct(F.lit(1).alias("at"), file.alias("file")).alias(incremental.AGE)
    records = spark.range(300).select((F.col("id") % 100).alias("cluster_id"), F.format_string("n%03d", "id").alias("cluster_name"), ages)
    found = incremental.newest(records, ("cluster_id",))
    assert found.columns == records.columns
    # The last file by name: 3, 103 and 203 for cluster 3, and 99, 199 and 299 for cluster 99.
    last = {k: max((k, k + 100, k + 200), key=str) for k in range(100)}
    assert {r["cluster_id"]: (r["cluster_name"], r[incremental.AGE]["file"][5000:]) for r in found.collect()} == {k: (f"n{v:03d}", str(v)) for k, v in last.items()}
    nodes, sent = [found._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName() == "Exchange":
            sent += node.metrics().apply("dataSize").value()
    assert 100 * 5000 < sent < 300 * 5000 * 1.5


def test_scratch_is_removed_when_its_work_is_done(spark):
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(shared_dir(spark)).getFileSystem(spark._jsc.hadoopConfiguration())
    outside = new_path(spark)
    with pytest.raises(ZeroDivisionError), scratch(spark):
        with scratch(spark):
            inner = new_path(spark)
            spark.range(1).write.parquet(inner)
        assert not files.exists(place(inner))
        kept, never = new_path(spark), new_path(spark)
        spark.range(1).write.parquet(kept)
        assert files.exists(place(kept)) and not files.exists(place(never))
        spark.range(1).write.parquet(outside)
        1 / 0  # noqa: B018
    assert not files.exists(place(kept)) and files.exists(place(outside))


def test_batches_of_odd_names(spark, database):
    for name in ("a=b/c", "a b", "", "ü%"):
        for _ in range(2):
            batches.put_batch(spark, spark.range(2), f"{database}.t", name or "empty")
    assert spark.table(f"{database}.t").count() == 8


def _by_copies(sql):
    """Innermost calls first, one at a time, over text without strings or comments."""
    import re

    from lakeops.functions.calls import CALLS

    inner = re.compile(r"(?i)(?:(?<![\w.])(IFF|ZEROIFNULL|TO_VARCHAR|REGEXP_REPLACE)\s*)?\(([^()]*)\)")
    held = []
    while m := inner.search(sql):
        args = m[2].split(",")
        shape = CALLS.get((m[1].upper(), len(args))) or CALLS.get((m[1].upper(), None)) if m[1] else None
        done = shape.format(*[a.strip() for a in args], all=m[2]) if shape and all(a.strip() for a in args) else m[0]
        held.append(done)
        sql = f"{sql[: m.start()]}\x01{len(held) - 1}\x02{sql[m.end() :]}"
    while "\x01" in sql:
        sql = re.sub("\x01(\\d+)\x02", lambda m: held[int(m[1])], sql)
    return sql


def test_edits_are_those_of_copied_strings():
    rng = random.Random(5)
    bits = ["IFF(", "ZEROIFNULL(", "to_varchar (", "REGEXP_REPLACE( ", "f(", "(", ")", ")", ")", ")", ",", ",", " a ", "b", " ", "my.IFF("]
    for _ in range(3000):
        sql = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 25)))
        # Only balanced texts: the plain version can't tell what stays open.
        depth, ok = 0, True
        for c in sql:
            depth += (c == "(") - (c == ")")
            ok = ok and depth >= 0
        if ok and not depth:
            assert translate_text(sql) == _by_copies(sql), sql


@pytest.mark.parametrize("call", ["IFF(a, b, ", "ZEROIFNULL( ", "(", "TO_VARCHAR("])
def test_deep_nesting_is_linear(call):
    n = 1_000_000 // (len(call) + 1)
    start = time.perf_counter()
    out = translate_text(call * n + "x" + ")" * n)
    assert time.perf_counter() - start < 10 and len(out) >= n
