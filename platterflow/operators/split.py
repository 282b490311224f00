"""Chronological splits, the seeded balanced sample, and the guards before training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platterflow import constants as K
from platterflow.session import pin


def latest(frame: DataFrame, column: str | Column) -> Column:
    """Maximum of a column over a whole frame, as a scalar subquery."""
    return frame.agg(F.max(column)).scalar()


def split_last_days(frame: DataFrame, day: str = "date", days: int = K.HOLDOUT_DAYS):
    """(train, test): test holds the last `days` days."""
    cutoff = F.date_sub(latest(frame, day), days)
    return frame.filter(F.col(day) <= cutoff), frame.filter(F.col(day) > cutoff)


def split_last_period(frame: DataFrame, period: Column):
    """(train, test): test holds the rows of the latest period, a month for instance."""
    last = latest(frame, period)
    return frame.filter(period < last), frame.filter(period == last)


def require_rows(train: DataFrame, test: DataFrame | None, minimum: int) -> tuple[int, int]:
    """Row counts of a split; raises ValueError when it is too small to train on.  Runs two counts."""
    trained, tested = train.count(), test.count() if test is not None else 0
    if trained < minimum or (test is not None and tested == 0):
        raise ValueError(f"Need at least {minimum} training rows and a non-empty holdout; "
                         f"found {trained} and {tested}.")
    return trained, tested


def class_counts(frame: DataFrame, label: str) -> DataFrame:
    return frame.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def balanced_sample(
    frame: DataFrame, label: str, key: str, maximum: int = K.MAX_TRAINING_ORDERS, seed: int = K.SEED,
) -> DataFrame:
    """Exactly n rows per class, drawn by a seeded hash of the key, when there are over `maximum`.

    n is half of `maximum` or the size of the smallest class.  The rows with the smallest hashes
    are taken.  Their limit is found from counts per hash prefix: rows under the limiting prefix
    are taken without being ordered, and only the rows that share it are ranked.
    """
    hashed = frame.withColumn("__hash", F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed)))))
    hashed = hashed.withColumn("__prefix", F.conv(F.substring("__hash", 1, 4), 16, 10).cast("int"))
    # At most 65,536 rows per class: stored, so that quota and limits come from one read of the rows.
    counts = pin(hashed.groupBy(label, "__prefix").agg(F.count(F.lit(1)).alias("n")))
    sizes = counts.groupBy(label).agg(F.sum("n").alias("size"))
    quota = sizes.agg(
        F.when(F.sum("size") > maximum, F.least(F.lit(maximum // 2), F.min("size")))
        .otherwise(F.sum("size")).cast("bigint")).scalar()
    # Four hex digits: at most 65,536 rows per class reach this window.
    earlier = Window.partitionBy(label).orderBy("__prefix").rowsBetween(Window.unboundedPreceding, -1)
    room = quota - F.coalesce(F.sum("n").over(earlier), F.lit(0))
    limits = (
        counts.withColumn("room", room).filter(F.col("room") < F.col("n"))
        .groupBy(label).agg(F.min(F.struct("__prefix", "room")).alias("__limit"))
    )
    # One row per class.
    placed = hashed.join(F.broadcast(limits), label, "left")
    limit = F.col("__limit.__prefix")
    inside = placed.filter(limit.isNull() | (F.col("__prefix") < limit))
    place = F.row_number().over(Window.partitionBy(label).orderBy("__hash", key))
    edge = (placed.filter(F.col("__prefix") == limit).withColumn("__place", place)
            .filter(F.col("__place") <= F.col("__limit.room")))
    return inside.select(*frame.columns).unionByName(edge.select(*frame.columns))
