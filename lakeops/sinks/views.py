"""Recreating views at the destination, what they read before themselves."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from itertools import groupby
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.rewrite import select_body, view_columns, with_rewritten
from lakeops.operators.deps import MISSING_DEPENDENCY
from lakeops.parallel import run_each
from lakeops.sinks.tables import FAILED, Outcome, outcomes_frame, refuse_clash
from lakeops.sources.catalog import full_name

# Outcome of a view, and the error of one without a definition.
VIEW_CREATED = "view_created"
NO_DEFINITION = "view definition is empty"
NOT_TRIED = "not tried: it reads {}, which failed"
# Views drawn ahead for each thread.
DRAWN_AHEAD = 64

# Name parts in double quotes are kept by the rewrite. Spark reads them as names with both of these on,
# and as texts otherwise.
QUOTED_NAMES = ("spark.sql.ansi.enabled", "spark.sql.ansi.doubleQuotedIdentifiers")


def with_statement(views: DataFrame, text: str = "view_definition") -> DataFrame:
    """Add the CREATE statement of each view; ``views`` has a destination and its source database."""
    views = with_rewritten(views, "_body", select_body(F.col(text)), F.col("src_db"), F.col("dst_cat"))
    columns = F.coalesce(F.concat(F.lit(" "), view_columns(F.col(text))), F.lit(""))
    statement = F.concat(F.lit("CREATE OR REPLACE VIEW "), F.col("dst_fq"), columns, F.lit(" AS "), F.col("_body"))
    return views.withColumn("statement", F.when(F.col(text) != "", statement)).drop("_body")


def _view_session(spark: SparkSession, home: tuple[str, ...] = ()) -> SparkSession:
    """A session beside the caller's, with its options, in which double quotes hold names.

    Short names mean the same in it as in the caller's, or those of ``home``.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key in QUOTED_NAMES:
        own.conf.set(key, "true")
    own.sql(f"USE {full_name(*(home or (spark.catalog.currentCatalog(), spark.catalog.currentDatabase())))}")
    return own


def create_each(spark: SparkSession, views: DataFrame, parallelism: int = 4) -> Iterator[Outcome]:
    """Run the ``statement`` of each view, one attempt each, with what it reads before itself.

    With ``view_id`` and ``reads``, the ids of the views of the run that a view
    reads, each starts as soon as those are there, and one that reads a failed
    view fails without a try. Rows come by ``level``, so nothing waits for a row
    that has not come. Without them a level starts when the one below is done.

    Statements run in sessions of their own, so no option of the caller's
    changes, and none decides how a quoted name is read. Short names are the
    caller's current database's, or those of ``home``, a view's own. ``views``
    may have ``n_same`` (see ``with_clash``) and ``needs``, the references of a
    view that are not in the run, which its error then names.
    """
    sessions: dict[tuple[str, ...], SparkSession] = {}
    lock = Lock()

    def session(home: tuple[str, ...]) -> SparkSession:
        with lock:
            if home not in sessions:
                sessions[home] = _view_session(spark, home)
            return sessions[home]

    def failed(v: Row, error: str) -> Outcome:
        needs = getattr(v, "needs", None)
        return (v.dst_plain, "view", FAILED, None, MISSING_DEPENDENCY.format(needs, error) if needs else error)

    def create(v: Row) -> Outcome:
        try:
            refuse_clash(v)
            if not v.statement:
                raise ValueError(NO_DEFINITION)
            session(tuple(getattr(v, "home", None) or ())).sql(v.statement)
            return (v.dst_plain, "view", VIEW_CREATED, None, None)
        except Exception as error:
            return failed(v, str(error))

    wanted = [c for c in ("level", "dst_plain", "statement", "n_same", "needs", "view_id", "reads", "home") if c in views.columns]
    rows = views.select(*wanted).orderBy("level", "dst_plain").toLocalIterator()
    if "reads" in wanted:
        yield from _as_ready(spark, rows, create, failed, parallelism)
    else:
        for _, level in groupby(rows, key=lambda v: v.level):
            yield from run_each(level, create, parallelism)


def _as_ready(
    spark: SparkSession, rows: Iterable[Row], create: Callable[[Row], Outcome], failed: Callable[[Row, str], Outcome], parallelism: int
) -> Iterator[Outcome]:
    """Outcomes of views as they settle; a few rows are drawn ahead, and only names are kept of those that failed."""
    create = inheritable_thread_target(spark)(create)
    rows = iter(rows)
    running: dict[Future, Row] = {}
    # A view that waits, with the ids it still waits for; who waits for an id; ids that are not settled; ids that failed.
    waiting: dict[str, tuple[Row, set[str]]] = {}
    readers: dict[str, list[str]] = {}
    unsettled: dict[str, int] = {}
    lost: set[str] = set()

    def poisoned(v: Row) -> Outcome:
        return failed(v, NOT_TRIED.format(", ".join(sorted(lost.intersection(v.reads or ())))))

    def settle(v: Row, outcome: Outcome) -> Iterator[Outcome]:
        """The outcome of a view, and those of the views that it takes along."""
        settled = [(v, outcome)]
        while settled:
            v, outcome = settled.pop()
            yield outcome
            unsettled[v.view_id] -= 1
            if outcome[2] == FAILED:
                lost.add(v.view_id)
            if unsettled[v.view_id]:
                continue
            del unsettled[v.view_id]
            for reader in readers.pop(v.view_id, ()):
                if reader not in waiting:
                    continue
                w, left = waiting[reader]
                left.discard(v.view_id)
                if v.view_id in lost:
                    del waiting[reader]
                    settled.append((w, poisoned(w)))
                elif not left:
                    del waiting[reader]
                    running[pool.submit(create, w)] = w

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        more = True
        while more or running:
            while more and len(running) + len(waiting) < DRAWN_AHEAD * parallelism:
                v = next(rows, None)
                if v is None:
                    more = False
                    break
                reads = set(v.reads or ()) - {v.view_id}
                again = unsettled.get(v.view_id, 0)
                unsettled[v.view_id] = again + 1
                left = {d for d in reads if d in unsettled}
                if lost & reads:
                    yield from settle(v, poisoned(v))
                elif left and not again:
                    waiting[v.view_id] = (v, left)
                    for d in left:
                        readers.setdefault(d, []).append(v.view_id)
                else:
                    running[pool.submit(create, v)] = v
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                yield from settle(running.pop(future), future.result())


def recreate_views(spark: SparkSession, views: DataFrame, parallelism: int = 4) -> DataFrame:
    """One outcome row per view of ``views`` (``level``, ``dst_plain``, ``statement``; see :func:`create_each`)."""
    return outcomes_frame(spark, create_each(spark, views, parallelism))
