"""Running totals over very long ordered groups, without one task per group.

An integer order key is cut into nested ranges by dropping low bits.  Range
totals are summed level by level.  How many bits the first level drops follows
from the keys: so many that a range of the fullest group holds some thousand
rows, dense keys or hashed ones alike, and never more than ``RANGE_ROWS``.  Each
further level drops 16 bits, up to all 64, so every window holds at most 65,536
ranges however the keys are spread.  A group with a third of all rows spreads
over as many tasks as it has ranges.  Ranges are a fixed function of the keys,
so a retried task finds the same ones.

Keys are unique within their group and not null; a query over others fails.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: most rows of a range
RANGE_ROWS = 4096
#: bits dropped by each level after the first
LEVEL_BITS = 16


def range_bits(rows: DataFrame, group: Sequence[str], order_key: str, most: int = RANGE_ROWS) -> tuple[int, ...]:
    """Bits dropped at each level, so that no range has more than ``most`` rows and no level more than 2**16 ranges."""
    key = F.col(order_key).cast("bigint")
    spans = rows.groupBy(*group).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("n")
    ).agg(F.max(F.col("high").cast("double") - F.col("low").cast("double")).alias("span"), F.min(
        (F.col("high").cast("double") - F.col("low").cast("double") + 1) / F.col("n")
    ).alias("gap")).first()
    if spans["gap"] is None:
        return (0,)
    first = min(62, max(0, int(math.log2(max(spans["gap"], 1) * most))))
    while first and (1 << first) > most:  # keys lie apart on average, but some may lie close
        fullest = rows.groupBy(*group, F.shiftright(key, first).alias("rng")).count().agg(F.max("count")).first()[0]
        if fullest <= most:
            break
        first = max(0, first - max(1, math.ceil(math.log2(fullest / most))))
    levels = [first]
    while spans["span"] / 2.0 ** sum(levels) >= 2**LEVEL_BITS:
        levels.append(min(LEVEL_BITS, 63 - sum(levels)))
    return tuple(levels)


def _bases(totals: DataFrame, group: Sequence[str], bits: Sequence[int]) -> DataFrame:
    """Exclusive running total of ``total`` per group in order of ``rng``."""
    exclusive = (Window.unboundedPreceding, -1)
    if not bits:
        window = Window.partitionBy(*group).orderBy("rng").rowsBetween(*exclusive)
        base = F.coalesce(F.sum("total").over(window), F.lit(0))
        return totals.select(*group, "rng", "total", base.alias("base"))
    outer = totals.withColumn("outer", F.shiftright("rng", bits[0]))
    outer_bases = _bases(
        outer.groupBy(*group, "outer").agg(F.sum("total").alias("total")).withColumnRenamed("outer", "rng"),
        group,
        bits[1:],
    ).select(*group, F.col("rng").alias("outer"), F.col("base").alias("outer_base"))
    window = Window.partitionBy(*group, "outer").orderBy("rng").rowsBetween(*exclusive)
    return (
        outer.withColumn("inside", F.coalesce(F.sum("total").over(window), F.lit(0)))
        .join(outer_bases, [*group, "outer"])
        .select(*group, "rng", "total", (F.col("outer_base") + F.col("inside")).alias("base"))
    )


def _order_key(order_key: str) -> Column:
    message = F.lit(f"null in the order key {order_key}")
    return F.coalesce(F.col(order_key).cast("bigint"), F.raise_error(message).cast("bigint"))


def _ranges(
    rows: DataFrame, group: Sequence[str], order_key: str, length: Column | str, bits: Sequence[int]
) -> tuple[DataFrame, DataFrame]:
    """Rows with their range and length, and the start of every range."""
    length = F.col(length) if isinstance(length, str) else length
    # a key that cannot be null keeps the join from adding null tests to some of
    # the branches, which would make them read the rows anew instead of sharing
    key = F.coalesce(_order_key(order_key), F.lit(0))
    ranged = rows.withColumn("rng", F.shiftright(key, bits[0])).withColumn("_length", length.cast("bigint"))
    totals = ranged.groupBy(*group, "rng").agg(F.sum("_length").alias("total"))
    return ranged, _bases(totals, group, bits[1:])


def keep_heads(
    rows: DataFrame,
    source: str,
    order_key: str,
    length: Column | str,
    limit: Column | int,
    bits: Sequence[int] | None = None,
) -> DataFrame:
    """Drop rows of ranges that start at or beyond ``limit``, before any shuffle.

    The last range needed is found from range totals alone and comes to the
    driver as one number per configured source; it turns into a plain bound on
    the order key, which the scan can use to skip files and row groups.
    """
    bits = bits or range_bits(rows, [source], order_key)
    _, bases = _ranges(rows, [source], order_key, length, bits)
    limit = F.lit(limit) if isinstance(limit, int) else limit
    lasts = bases.where(F.col("base") < limit).groupBy(source).agg(F.max("rng").alias("last")).collect()
    keep = F.lit(False)
    for row in lasts:
        bound = min((row["last"] + 1 << bits[0]) - 1, 2**63 - 1)
        keep = keep | ((F.col(source) == row[source]) & (F.col(order_key) <= F.lit(bound)))
    # the range totals above have failed if a key is null
    return rows.where(keep)


def running_start(
    rows: DataFrame,
    group: Sequence[str],
    order_key: str,
    length: Column | str,
    bits: Sequence[int] | None = None,
) -> DataFrame:
    """Add ``start``, the sum of ``length`` over earlier rows of the group.

    ``order_key`` is an integer, unique within its group.  The rows move once,
    by (group, ``rng``), and the output keeps that partitioning; ``rng_start``
    and ``rng_end`` are the bounds of the row's range in the same running sum.
    """
    bits = bits or range_bits(rows, group, order_key)
    ranged, bases = _ranges(rows, group, order_key, length, bits)
    window = Window.partitionBy(*group, "rng").orderBy(order_key)
    inside = F.coalesce(F.sum("_length").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    twice = F.lag(F.col(order_key)).over(window) == F.col(order_key)
    message = F.concat(F.lit(f"repeated order key {order_key}: "), F.col(order_key).cast("string"))
    return (
        ranged.withColumn("_inside", F.when(F.coalesce(twice, F.lit(False)), F.raise_error(message).cast("bigint")).otherwise(inside))
        .join(bases, [*group, "rng"])
        .withColumn("start", F.col("base") + F.col("_inside"))
        .withColumn("rng_end", F.col("base") + F.col("total"))
        .withColumnRenamed("base", "rng_start")
        .drop("_inside", "_length", "total")
    )
