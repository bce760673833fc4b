"""Validity-interval join and the cost rollup built on it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sums of money and units, rounded to cents: wide enough for any sum of the inputs.
MONEY = "decimal(38,2)"
# What a quantity or price is read as, and its decimal places: eighteen are what exports of usage and prices declare.
EXACT, PLACES = "decimal(38,18)", 18


# Calendar units an interval can be split by, each with its step.
GRAINS = {"day": "1 day", "week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}


def _unit_of(instant: Column, grain: str, by_clock: bool) -> Column:
    """Calendar unit of an instant; never decreases as instants increase.

    Local times without a zone go by their date. Instants go by their UTC date,
    as the local date of a session can step back when clocks change.
    """
    if by_clock:
        date_of = F.to_date(instant)
    else:
        days = F.floor(F.unix_seconds(instant.cast("timestamp")) / 86400)
        date_of = F.date_from_unix_date(days.cast("int"))
    return date_of if grain == "day" else F.trunc(date_of, grain)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    at: str,
    start: str,
    end: str,
    how: str = "left",
    *,
    grain: str | None = None,
) -> DataFrame:
    """Join rows to the intervals that hold their instant: ``start <= at < end``.

    A null ``end`` leaves the interval open. Overlapping intervals all match, so
    they multiply rows. The result has the left columns, then the right columns
    other than ``on``.

    Without ``grain`` each left row is compared with every interval of its key.
    With ``grain`` (a key of ``GRAINS``) intervals are listed once per calendar
    unit they touch and the unit becomes part of the join key: a row meets an
    interval or two, however long the history of its key, and a hot key is
    spread over its units.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    names = list(on)
    if grain:
        kinds = {left.schema[at].dataType, right.schema[start].dataType, right.schema[end].dataType}
        by_clock = len(kinds) == 1 and isinstance(kinds.pop(), (T.DateType, T.TimestampNTZType))
        right = right.filter(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
        # Nothing starts after the last start or ends before the first end, so
        # one unit is enough on either side, also for far-off marker dates.
        first_end = F.min(_unit_of(F.col(end), grain, by_clock))
        last_start = F.max(_unit_of(F.col(start), grain, by_clock))
        bounds = right.agg(F.struct(first_end.alias("first"), last_start.alias("last"))).scalar()
        first, last = bounds["first"], bounds["last"]

        def unit(instant: Column) -> Column:
            return F.greatest(F.least(_unit_of(instant, grain, by_clock), last), first)

        step = F.expr(f"interval {GRAINS[grain]}")
        open_end = F.greatest(last, first)
        last_touched = F.when(F.col(end).isNull(), open_end).otherwise(unit(F.col(end)))
        touched = F.sequence(unit(F.col(start)), last_touched, step)
        right = right.withColumn("_unit", F.explode(touched))
        left = left.withColumn("_unit", unit(F.col(at)))
        names.append("_unit")
    lhs, rhs = left.alias("l"), right.alias("r")
    matches = F.col(f"l.{at}") >= F.col(f"r.{start}")
    matches &= F.col(f"r.{end}").isNull() | (F.col(f"l.{at}") < F.col(f"r.{end}"))
    for name in names:
        matches &= F.col(f"l.{name}") == F.col(f"r.{name}")
    kept = [F.col(f"l.{c}") for c in left.columns if c != "_unit"]
    kept += [F.col(f"r.{c}") for c in right.columns if c not in names]
    return lhs.join(rhs, matches, how).select(*kept)


def _parts(value: Column) -> tuple[Column, Column]:
    """Whole part of an exact value, and the rest in units of its last place; both whole numbers of the value's sign."""
    whole = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("decimal(20,0)")
    rest = (value - whole).cast(f"decimal({PLACES + 1},{PLACES})")
    return whole, (rest * F.lit(10**9).cast("decimal(10,0)") * F.lit(10**9).cast("decimal(10,0)")).cast(f"decimal({PLACES},0)")


def _exact_products(quantity: Column, price: Column) -> dict[str, Column]:
    """Quantity times price in three whole numbers: units, units of 10^-18, units of 10^-36.

    A product of two values of 18 places has 36 of them, more than a decimal of 38 digits leaves room for.
    """
    (q, q_rest), (p, p_rest) = _parts(quantity), _parts(price)
    return {"_units": q * p, "_middle": q * p_rest + q_rest * p, "_low": q_rest * p_rest}


def _rounded_total() -> Column:
    """The three sums as one amount, rounded to cents once, halves away from zero."""
    base = F.lit(10**PLACES).cast(f"decimal({PLACES + 1},0)")

    def split(total: Column) -> tuple[Column, Column]:
        # Whole division in decimals, downwards: the operator for it gives 64 bits.
        rest = F.pmod(total, base).cast(f"decimal({PLACES + 1},0)")
        return ((total - rest) / base).cast("decimal(38,0)"), rest

    carried, below = split(F.sum("_low"))
    carried, rest = split((F.sum("_middle") + carried).cast("decimal(38,0)"))
    units = (F.sum("_units") + carried).cast("decimal(36,0)")
    cents, part = split(rest * 100)
    half = part * 2
    up = (half > base) | ((half == base) & ((below > 0) | (units >= 0)))
    cents = cents.cast("decimal(4,0)") + F.when(up, 1).otherwise(0)
    return (units + cents / 100).cast(MONEY)


def cost_rollup(
    usage: DataFrame,
    prices: DataFrame,
    since: date | datetime | str,
    keys: Sequence[str] = ("cluster_id",),
    *,
    on: Sequence[str] = ("sku_name",),
    at: str = "usage_start_time",
    quantity: str = "usage_quantity",
    price: str = "price",
    start: str = "price_start_time",
    end: str = "price_end_time",
    grain: str | None = "month",
) -> DataFrame:
    """Units used and estimated cost per key since the *date* of ``since``.

    ``keys`` and ``price`` may be nested (``usage_metadata.cluster_id``,
    ``pricing.default``); each key column is named by its last part. Usage with
    no price counts as units without cost. Several prices for one unit and
    instant multiply both sums; pass more columns in ``on`` to tell them apart.

    Nothing is rounded before the sums: quantities and prices are taken to
    ``PLACES`` decimal places, quantities are summed for each price first, and
    each sum is multiplied once, exactly. The totals are rounded to cents.
    """
    day = str(since)[:10]
    wanted = usage.filter(F.col(at) >= F.lit(day).cast(usage.select(at).schema[0].dataType))
    for key in keys:
        wanted = wanted.filter(F.col(key).isNotNull())
    named = [F.col(key).alias(key.split(".")[-1]) for key in keys]
    # Exact types before the sum: the order of additions must not matter.
    slim = wanted.select(*named, *on, at, F.col(quantity).cast(EXACT).alias("_quantity"))
    listed = prices.select(*on, start, end, F.col(price).cast(EXACT).alias("_price"))
    priced = interval_join(slim, listed, on, at, start, end, grain=grain)
    names = [key.split(".")[-1] for key in keys]
    per_price = priced.groupBy(*names, "_price").agg(F.sum("_quantity").alias("_quantity"))
    return (
        per_price.withColumns(_exact_products(F.col("_quantity"), F.col("_price")))
        .groupBy(*names)
        .agg(
            F.round(F.sum("_quantity"), 2).cast(MONEY).alias("total_dbus_consumed"),
            _rounded_total().alias("estimated_cost_usd"),
        )
    )
