"""Roll-ups of the aggregation tree: how leaf rows become one value a slice. All are aggregates, so they combine before a shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from benthos.functions.exprs import finite

#: Fixed: the channels of a colour, in the order of dim_c.
CHANNELS = ("slice_red", "slice_green", "slice_blue")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean by weight (frame pairs, pixels) over rows with a finite value and a weight above 0; null if there are none."""
    counts = finite(value) & (weight > 0)
    return F.try_divide(F.sum(F.when(counts, value * weight)), F.sum(F.when(counts, weight)))


def nan_max(value: Column) -> Column:
    """The largest that is a number; null if none is."""
    return F.max(F.when(~F.isnan(value), value))


def whole_sum(value: Column) -> Column:
    return F.sum(F.coalesce(value, F.lit(0))).cast("bigint")


def of_surest(payload: Column, confidence: Column, order: Column, filled: bool = True) -> Column:
    """The payload of the row with the highest confidence, the first in `order` on ties.

    A null confidence counts as 0 and one of -1 or less never wins.  With `filled` an empty payload doesn't
    count; without, only a null one doesn't (a picture).
    """
    sure = F.coalesce(confidence, F.lit(0.0))
    some = payload.isNotNull() & (sure > -1)
    if filled:
        some &= payload != ""
    return F.min(F.when(some, F.struct((-sure).alias("c"), order.alias("o"), payload.alias("p"))))["p"]


def earliest(stamp: Column) -> Column:
    """The first moment in the group; stamps are text in one zone, which sorts as it reads."""
    return F.min(F.nullif(stamp, F.lit("")))


def shared(value: Column, order: Column) -> Column:
    """The value that all rows share: that of the first row with one."""
    return F.min(F.when(value.isNotNull() & (value != ""), F.struct(order.alias("o"), value.alias("v"))))["v"]


def channel(value: Column, dim_c: Column, order: Column, number: int) -> Column:
    """One channel of a colour: the only known value, else that of the channel's row, else the mean."""
    own = F.min(F.when(value.isNotNull() & (dim_c == number), F.struct(order.alias("o"), value.alias("v"))))["v"]
    return F.when(F.count(value) == 1, F.max(value)).otherwise(F.coalesce(own, F.avg(value)))
