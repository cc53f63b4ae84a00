"""Exact order statistics without gathering a column in one place.

``median`` and ``percentile`` keep every distinct value of a group in one
buffer, approximate percentiles merge the sketches of all tasks in one, and a
sorted limit sends ``limit`` rows of every task to a single one. Here values
are counted per bucket, which tasks combine before the shuffle, and the buckets
that hold the wanted ranks are cut into buckets again until one value is left.
The same rounds run on any number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import materialize

BUCKETS = 1000


@dataclass(frozen=True)
class Ranked:
    value: float
    below: int  # how many values are smaller
    equal: int  # how many values are the same


@dataclass
class _Search:
    """A rank of a column, and the range that it is known to lie in."""

    column: str
    rank: int
    low: float
    high: float
    n: int  # values in the range
    below: int = 0  # values before it


def _bucket(value: Column, low: float, high: float) -> Column:
    """0 for ``low`` up to ``BUCKETS - 1`` for ``high``, never falling in between."""
    span = high - low
    if isinstance(span, int) and span < 2**53:
        offset = value - F.lit(low)
    elif math.isinf(span):
        offset, span = value / 2 - low / 2, high / 2 - low / 2
    else:
        offset = value.cast("double") - float(low)
    return F.least((offset / float(span) * BUCKETS).cast("int"), F.lit(BUCKETS - 1))


def _known(df: DataFrame, column: str) -> Column:
    """The value, NULL where it is not a number."""
    value = F.col(column)
    if dict(df.dtypes)[column] in ("double", "float"):
        return F.when(~F.isnan(value), value)
    return value


def values_at_ranks(
    df: DataFrame, wanted: Sequence[tuple[str, int]], ranges: dict[str, tuple] | None = None
) -> list[Ranked | None]:
    """The values at the given (column, rank), ranks counted from 0; None beyond the last.

    The columns must be of one type, integers or doubles; NULL and NaN are left out,
    and an infinite value is an error. Every round is one aggregate for all searches
    and brings a row per bucket and search to the driver. ``ranges`` has the count,
    lowest and highest value of each column if they are known.
    """
    df = df.select(*[_known(df, c).alias(c) for c in dict.fromkeys(c for c, _ in wanted)])
    ranges = ranges or _ranges(df, df.columns)
    found: list[Ranked | None] = [None] * len(wanted)
    open_: dict[int, _Search] = {}
    for i, (column, rank) in enumerate(wanted):
        n, low, high = ranges[column]
        if 0 <= rank < n:
            open_[i] = _Search(column, rank, low, high, n)
    while open_:
        for i, s in list(open_.items()):
            if s.low == s.high:
                found[i] = Ranked(s.low, s.below, s.n)
                del open_[i]
        if not open_:
            break
        parts = []
        for i, s in open_.items():
            value = F.col(s.column)
            inside = (value >= s.low) & (value <= s.high)
            part = F.struct(
                F.lit(i).alias("i"), _bucket(value, s.low, s.high).alias("b"), value.alias("v")
            )
            parts.append(F.when(inside, part))
        rows = df.select(F.explode(F.array_compact(F.array(*parts))).alias("x")).select("x.*")
        buckets = (
            rows.groupBy("i", "b")
            .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .orderBy("i", "b")
            .collect()
        )
        # Buckets are in the order of their values, and equal values share one.
        for i, s in open_.items():
            for bucket in (b for b in buckets if b["i"] == i):
                if s.rank - s.below < bucket["n"]:
                    s.n, s.low, s.high = bucket["n"], bucket["low"], bucket["high"]
                    break
                s.below += bucket["n"]
    return found


def _ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """Count, lowest and highest value of each column, from one aggregate."""
    parts = [f(_known(df, c)) for c in columns for f in (F.count, F.min, F.max)]
    row = df.agg(*parts).first()
    ranges = {c: tuple(row[3 * i : 3 * i + 3]) for i, c in enumerate(columns)}
    for c, (n, low, high) in ranges.items():
        if n and (math.isinf(low) or math.isinf(high)):
            raise ValueError(f"column {c} has an infinite value")
    return ranges


def value_at_rank(df: DataFrame, column: str, rank: int) -> Ranked | None:
    return values_at_ranks(df, [(column, rank)])[0]


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Exact medians; the mean of the two middle values for an even count."""
    if not columns:
        return {}
    df = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    ranges = _ranges(df, columns)
    wanted = [(c, rank) for c in columns for rank in {(ranges[c][0] - 1) // 2, ranges[c][0] // 2}]
    middle: dict[str, list[float]] = {c: [] for c in columns}
    for (c, _), found in zip(wanted, values_at_ranks(df, wanted, ranges), strict=True):
        if found is not None:
            middle[c].append(found.value)
    return {c: min(v) + (max(v) - min(v)) * 0.5 if v else None for c, v in middle.items()}


def _cut(rows: DataFrame, n: int, lead: str) -> tuple[object, int, int] | None:
    """The value of ``lead`` at the n-th row in Spark's order, the rows before it, and those with NULL.

    NULL comes first. None if there are fewer rows. A date is found from one count per
    day, any other lead by ranks.
    """
    if dict(rows.dtypes)[lead] == "date":
        counts = rows.groupBy(lead).agg(F.count("*").alias("n")).collect()
        before, missing = 0, sum(r["n"] for r in counts if r[0] is None)
        for day, count in sorted(map(tuple, counts), key=lambda r: (r[0] is not None, r[0])):
            if before + count >= n:
                return day, before, missing
            before += count
        return None
    missing = rows.filter(F.col(lead).isNull()).count()
    if n <= missing:
        return None, 0, missing
    found = value_at_rank(rows, lead, n - missing - 1)
    return found and (found.value, missing + found.below, missing)


def _first_by_count(counted: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a table of distinct rows with copies ``_n``, as copies.

    Rows are range-partitioned, each partition is summed up by itself, and the sums of
    the partitions before it are added.
    """
    columns = [c for c in counted.columns if c != "_n"]
    ranged = counted.repartitionByRange(*columns).withColumn("_p", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    before, total = {}, 0
    for part, copies in sorted(map(tuple, ranged.groupBy("_p").agg(F.sum("_n")).collect())):
        if total >= n:
            break
        before[part] = total
        total += copies
    if not before:
        return ranged.select(*columns).limit(0)
    offset = reduce(
        lambda rest, x: F.when(F.col("_p") == x[0], F.lit(x[1])).otherwise(rest),
        before.items(),
        F.lit(0),
    )
    upto = F.sum("_n").over(Window.partitionBy("_p").orderBy(*columns)) + offset
    return (
        ranged.filter(F.col("_p").isin(*before))
        .withColumn("_copies", F.least("_n", F.lit(n) - (upto - F.col("_n"))))
        .filter(F.col("_copies") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*columns)
    )


def first_rows(df: DataFrame, n: int, lead: str, *rest: str) -> DataFrame:
    """``orderBy(lead, *rest).limit(n)`` of exactly these columns, NULL first as Spark sorts.

    The cut is found on ``lead`` alone (a date or a finite number), rows before it need
    no sorting, and of the rows at the cut equal ones are counted, not shipped. The
    rows up to the cut are written once.
    """
    columns = [lead, *rest]
    rows = df.select(*columns)
    if n <= 0:
        return rows.limit(0)
    cut = _cut(rows.select(lead), n, lead)
    if cut is None:
        return rows
    value, before, missing = cut
    if value is None:
        earlier, at = F.lit(False), F.col(lead).isNull()
        upto = at
    else:
        earlier, at = F.col(lead) < F.lit(value), F.col(lead) == F.lit(value)
        upto = F.col(lead) <= F.lit(value)
        if missing:
            earlier, upto = F.col(lead).isNull() | earlier, F.col(lead).isNull() | upto
    rows = materialize(rows.filter(upto), "upto")
    counted = rows.filter(at).groupBy(*columns).agg(F.count("*").alias("_n"))
    return rows.filter(earlier).unionByName(_first_by_count(counted, n - before))
