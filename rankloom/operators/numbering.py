"""Row numbers over a whole table, without one task that sees all rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: ``monotonically_increasing_id`` holds the partition above this many bits and the row's place in it below.
PLACE_BITS = 33


def number_rows(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with ``name`` = 1, 2, 3 ... in the given order.

    One range exchange sorts the rows; each gets its partition and its place
    in it, and the sorted table is written once (session.materialize), so a
    number never changes when a lost task is run again.  What is added to a
    place is the number of rows in the partitions before: a table with one
    row per partition, the only thing that is ordered as a whole and the only
    one that is broadcast.  The order should end with a unique key; rows that
    are equal in it are numbered in any order.  An existing column ``name``
    is replaced; an empty table stays empty.  Without an ``order`` the rows are
    numbered as they lie, for a table that is sorted already."""
    at = f"_place_{uuid.uuid4().hex[:8]}"
    lying = df.drop(name).orderBy(*order) if order else df.drop(name)
    held = materialize(lying.withColumn(at, F.monotonically_increasing_id()))
    part, before = f"{at}_part", f"{at}_before"
    of = F.shiftright(F.col(at), PLACE_BITS)
    counts = held.groupBy(of.alias(part)).agg(F.count(F.lit(1)).alias(at))
    offsets = counts.select(part, F.coalesce(F.sum(at).over(
        Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    place = F.col(at).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return held.withColumn(part, of).join(F.broadcast(offsets), part).select(
        *[F.col(f"`{c}`") for c in held.columns if c != at], (F.col(before) + place + 1).alias(name))
