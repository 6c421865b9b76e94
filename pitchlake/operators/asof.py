"""As-of joins: the nearest row of another table at or before, or at or after, a place in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, at: Column, place: str, name: str, values: Sequence[str], keys: Sequence[str] = ("match_id",), after: bool = False, unique: bool = False) -> DataFrame:
    """left with `name`, a struct of values of the row of right with the same keys whose place is
    the last not above `at` (or, with after, the first not below it); null if there is none,
    or if at is null. Of rows of right with one place, the one of the greatest values counts;
    with unique there are no such rows, and they are not looked for.

    Rows of both tables are put in one order for each key and the values carried along it,
    so this is one shuffle and one sort, without pairs of rows, and each table is read once.
    """
    rows = F.struct(*left.columns)
    mine = left.select(*keys, at.cast("double").alias("__at"), F.lit(1).alias("__side"), rows.alias("__row"), F.lit(None).alias("__value"))
    one = right.where(F.col(place).isNotNull())
    one = one.withColumn("__value", F.struct(*values)) if unique else one.groupBy(*keys, place).agg(F.max(F.struct(*values)).alias("__value"))
    theirs = one.select(*keys, F.col(place).cast("double").alias("__at"), F.lit(0).alias("__side"), F.lit(None).alias("__row"), "__value")
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_first("__at") if after else F.asc_nulls_first("__at"), "__side").rowsBetween(Window.unboundedPreceding, 0)
    carried = mine.unionByName(theirs).withColumn("__value", F.last("__value", ignorenulls=True).over(order)).where("__side = 1")
    return carried.select("__row.*", F.col("__value").alias(name))
