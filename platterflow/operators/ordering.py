"""Running totals, ranks and exact medians over a whole table, without a one-task window.

The table is range-partitioned on its order and materialised with the number of the slice each row
is in.  A slice then only needs the total of the slices before it: one small row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platterflow.session import keep


def running_totals(frame: DataFrame, order: Sequence[Column], sums: Sequence[str]) -> DataFrame:
    """Adds `<c>_before` for every column of `sums`: its total over the rows ordered earlier.

    `order` has to be a total order; ties are then split over slices like any other rows.  Rows are
    materialised once, so the sampled range bounds are the same in both reads below.
    """
    sliced = keep(frame.repartitionByRange(*order).withColumn("__slice", F.spark_partition_id()))
    totals = sliced.groupBy("__slice").agg(*[F.sum(c).alias(f"__{c}") for c in sums])
    # One row per slice, at most as many as there are shuffle partitions: small by construction.
    earlier = Window.partitionBy(F.lit(0)).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__slice", *[
        F.coalesce(F.sum(f"__{c}").over(earlier), F.lit(0)).alias(f"__{c}_offset") for c in sums])
    inside = Window.partitionBy("__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = sliced.join(F.broadcast(offsets), "__slice")
    return joined.withColumns({
        f"{c}_before": F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"__{c}_offset")
        for c in sums
    }).select(*frame.columns, *[f"{c}_before" for c in sums])


def global_rank(frame: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Adds the position 1..n in a total order of the whole table."""
    counted = running_totals(frame.withColumn("__one", F.lit(1).cast("bigint")), order, ["__one"])
    return counted.withColumn(name, F.col("__one_before") + 1).drop("__one", "__one_before")


def _value_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n): a value on a third of the rows is one row here."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    long = frame.select(F.expr(f"stack({len(columns)}, {pairs}) as (feature, value)"))
    return long.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"))


def value_ranges(frame: DataFrame, columns: Sequence[str], most: int) -> DataFrame:
    """(feature, place, low, high): the values of each numeric column in at most `most` ranges, from the counts of all of them.

    Up to `most` values have a range each; more share ranges of about equally many rows.
    """
    counts = _value_counts(frame, columns).withColumn("one", F.lit(1).cast("bigint"))
    placed = running_totals(counts, [F.col("feature"), F.col("value")], ["n", "one"])
    per_feature = placed.groupBy("feature").agg(
        F.sum("n").alias("size"), F.min("n_before").alias("start"), F.sum("one").alias("values"), F.min("one_before").alias("first"))
    below = F.col("n_before") - F.col("start")
    place = F.when(F.col("values") <= most, F.col("one_before") - F.col("first")).otherwise(F.floor(below * most / F.col("size")))
    # One row per named column: small by construction.
    return placed.join(F.broadcast(per_feature), "feature").withColumn("place", place).groupBy("feature", "place").agg(
        F.min("value").alias("low"), F.max("value").alias("high"))


def exact_medians(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Interpolated median per numeric column: one row per column that has any value.

    Values are counted before they are ordered.
    """
    placed = running_totals(_value_counts(frame, columns), [F.col("feature"), F.col("value")], ["n"])
    per_feature = placed.groupBy("feature").agg(
        F.sum("n").alias("size"), F.min("n_before").alias("start"))
    # One row per named column: small by construction.
    ranked = placed.join(F.broadcast(per_feature), "feature").select(
        "feature", "value", (F.col("n_before") - F.col("start")).alias("below"), "n",
        F.floor((F.col("size") - 1) / 2).alias("low"), F.floor(F.col("size") / 2).alias("high"))

    def at(rank: str) -> Column:
        inside = (F.col("below") <= F.col(rank)) & (F.col(rank) < F.col("below") + F.col("n"))
        return F.max(F.when(inside, F.col("value")))

    return ranked.groupBy("feature").agg(((at("low") + at("high")) / 2).alias("median"))


def most_frequent(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent text per column, the smallest of equally frequent ones."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    long = frame.select(F.expr(f"stack({len(columns)}, {pairs}) as (feature, value)"))
    counts = long.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"))
    return counts.groupBy("feature").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
