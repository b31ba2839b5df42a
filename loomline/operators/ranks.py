"""Running numbers over all rows or over few large groups, without sorting a group in one task.

Integer keys are cut into ranges. Rows are numbered within their range, and shifted by the rows of the ranges
before; the ranges' counts are summed up in two levels, so that no task gets more than about the square
root of their number.

Exact percentiles come in two passes: a sketch of bounded size brackets the wanted rank of each group, and only the values
within the bracket, equal ones counted, are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE, LEVEL = 4096, 4096


def _start(key: Column, size: int) -> Column:
    """The first key of the range that holds ``key``; whole numbers throughout."""
    return key - F.pmod(key, F.lit(size).cast("bigint"))


def _before(counts: DataFrame, groups: list[str], size: int) -> DataFrame:
    """``groups, part, before``: the rows of a group's parts before each part."""
    part, upper = F.col("part"), _start(F.col("part"), size * LEVEL)
    tops = counts.groupBy(*groups, upper.alias("upper")).agg(F.sum("n").alias("n"))
    up = F.sum("n").over(Window.partitionBy(*groups).orderBy("upper").rowsBetween(Window.unboundedPreceding, -1))
    tops = tops.select(*groups, "upper", F.coalesce(up, F.lit(0)).alias("above"))
    own = F.sum("n").over(Window.partitionBy(*groups, "upper").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    low = counts.withColumn("upper", upper).select(*groups, "upper", part, F.coalesce(own, F.lit(0)).alias("own"))
    return low.join(tops, [*groups, "upper"]).select(*groups, "part", (F.col("own") + F.col("above")).alias("before"))


def running_number(df: DataFrame, key: str, *groups: str, size: int = RANGE) -> DataFrame:
    """``df`` with ``number``, from 0 in the order of the integer ``key`` within ``groups``. Keys and groups mustn't be null; equal keys are numbered in any order."""
    parted = df.withColumn("part", _start(F.col(key).cast("bigint"), size))
    before = _before(parted.groupBy(*groups, "part").agg(F.count("*").alias("n")), list(groups), size)
    own: Column = F.row_number().over(Window.partitionBy(*groups, "part").orderBy(key)) - 1
    out = parted.withColumn("own", own).join(before, [*groups, "part"])
    return out.withColumn("number", F.col("own") + F.col("before")).drop("part", "own", "before")


#: The bracket is so many parts of a group wide on either side; smaller groups are put in order whole.
PARTS, WHOLE = 10_000, 20_000


def _same(a: str, b: str, groups: tuple[str, ...]) -> Column:
    """Groups match, null ones too."""
    out = F.lit(True)
    for g in groups:
        out = out & F.col(f"{a}.{g}").eqNullSafe(F.col(f"{b}.{g}"))
    return out


def percentiles(df: DataFrame, value: str, points: dict[str, float], *groups: str) -> DataFrame:
    """``groups``, and for each name in ``points`` the exact percentile of ``value``, between two neighbours by their distance, as a double.

    Null values don't count; a group without any has null percentiles. ``groups`` may be null. No task sees more than about ``3 / PARTS`` of
    a group's distinct values, or ``WHOLE`` rows.
    """
    own = df.select(*groups, F.col(value).cast("double").alias("v"))
    asked = [F.percentile_approx("v", [max(0.0, p - 2 / PARTS), min(1.0, p + 2 / PARTS)], PARTS).alias(f"q_{k}") for k, p in points.items()]
    marks = own.groupBy(*groups).agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), *asked)
    small = F.col("n") <= WHOLE
    bounds = [x for k in points for x in (F.when(small, F.col("low")).otherwise(F.col(f"q_{k}")[0]).alias(f"from_{k}"), F.when(small, F.col("high")).otherwise(F.col(f"q_{k}")[1]).alias(f"to_{k}"))]
    marks = marks.select(*groups, "n", *bounds)
    both = own.where("v is not null").alias("o").join(marks.alias("m"), _same("o", "m", groups)).select("o.*", *[f"m.{c}" for c in marks.columns if c not in groups])
    out = marks.select(*groups, "n")
    for k, p in points.items():
        below = both.groupBy(*groups).agg(F.count_if(F.col("v") < F.col(f"from_{k}")).alias("below"))
        inside = both.where(F.col("v").between(F.col(f"from_{k}"), F.col(f"to_{k}"))).groupBy(*groups, "v", "n").agg(F.count("*").alias("times"))
        upto = F.sum("times").over(Window.partitionBy(*groups).orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        placed = inside.withColumn("upto", upto).alias("i").join(below.alias("b"), _same("i", "b", groups)).select("i.*", (F.col("b.below") + F.col("i.upto")).alias("end"))
        # Ranks from 0: a value holds those from ``end - times`` to before ``end``.
        at = F.lit(p) * (F.col("n") - 1)
        holds = lambda r: (F.col("end") - F.col("times") <= r) & (r < F.col("end"))
        found = placed.groupBy(*groups).agg(F.max(F.when(holds(F.floor(at)), F.col("v"))).alias("x"), F.max(F.when(holds(F.ceil(at)), F.col("v"))).alias("y"), F.max(at - F.floor(at)).alias("w"))
        exact = found.select(*groups, (F.col("x") + (F.col("y") - F.col("x")) * F.col("w")).alias(k))
        out = out.alias("a").join(exact.alias("e"), _same("a", "e", groups), "left").select("a.*", f"e.{k}")
    return out.drop("n")
