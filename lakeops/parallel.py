"""Several independent Spark jobs at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, as_completed, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Out = TypeVar("Out")


def run_each(items: Iterable[Item], action: Callable[[Item], Out], parallelism: int = 4) -> Iterator[Out]:
    """Results of ``action`` as they finish, ``parallelism`` running at once.

    Items are drawn a few ahead, so a long list is never held whole, and a slow
    item holds up nothing but its own thread.
    """
    action = inheritable_thread_target(SparkSession.active())(action)
    waiting: set[Future] = set()
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        for item in items:
            waiting.add(pool.submit(action, item))
            if len(waiting) > parallelism:
                done, waiting = wait(waiting, return_when=FIRST_COMPLETED)
                yield from (f.result() for f in done)
        yield from (f.result() for f in as_completed(waiting))
