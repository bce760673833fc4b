"""Helpers for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often and deep in loops over arrays the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def numbered(df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """Some columns under the names _0, _1, ..., and the name that each one got: so no other name can clash with theirs."""
    names = {c: f"_{k}" for k, c in enumerate(columns)}
    return df.select(*[df[f"`{c}`"].alias(n) for c, n in names.items()]), names
