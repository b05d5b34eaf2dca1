"""Layout by several columns: a space-filling (Z) order.

Files sorted by one column have narrow ranges of that column only. In Z order the
bits of the columns' places take turns, so files and row groups have narrow ranges of
all of them, and a filter on any one skips most of the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's place, and the leading bytes of a text that decide it.
BITS, PREFIX = 10, 6


def _number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column's values."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, PREFIX)), 2 * PREFIX, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def _place(number: Column, bounds: list[float]) -> Column:
    """How many of the sorted bounds lie below a value; NULL comes first."""
    if not bounds:
        return F.lit(0)
    listed = F.array(*(F.lit(b) for b in bounds))
    return F.when(number.isNull(), 0).otherwise(F.size(F.filter(listed, lambda b: b < number)))


def z_value(places: list[Column], bits: int = BITS) -> Column:
    """The bits of the places, highest first, in turn."""
    n, parts = len(places), []
    for i, place in enumerate(places):
        for bit in range(bits):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("bigint")
            parts.append(F.shiftleft(one, bit * n + (n - 1 - i)))
    return reduce(Column.bitwiseOR, parts)


def clustered(df: DataFrame, columns: list[str], files: int, accuracy: int = 2000) -> DataFrame:
    """The rows in Z order of two or three columns, in ``files`` partitions of about equal
    size. Places come from approximate quantiles of all rows, so skewed columns
    are cut evenly; a value that holds a large share of one column is still cut by the
    others, and rows of equal places are dealt out. Order only: any bounds are right."""
    if not 2 <= len(columns) <= 3:
        raise ValueError("two or three columns")
    bits = min(BITS, max(2, -(-files.bit_length() // len(columns)) + 2))
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    numbers = {f"_z{i}": _number(df, c) for i, c in enumerate(columns)}
    found = df.select(*(v.alias(k) for k, v in numbers.items())).agg(
        *(F.percentile_approx(k, shares, accuracy).alias(k) for k in numbers)).first()
    bounds = [sorted(set(found[k] or ())) for k in numbers]
    placed = df.withColumn("_z", z_value([_place(v, b) for v, b in zip(numbers.values(), bounds)], bits))
    return placed.withColumn("_t", F.rand(7)).repartitionByRange(files, "_z", "_t").sortWithinPartitions("_z").drop("_z", "_t")
