"""Fixed-size samples, ordered heads and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlab.functions.calendar import month_start
from demandlab.schemas import WINDOW, ZONE


def row_hash(seed: int, key: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def fixed_sample(df: DataFrame, size: int, key: Sequence[str], seed: int = 42, prefix_bits: int = 20) -> DataFrame:
    """``size`` rows (or all, if fewer), the same ones on every run.

    The sample is the ``size`` smallest seeded hashes of a unique key. A count
    per hash prefix finds the prefix that completes the sample, so the final
    top-k only sees about ``size + rows / 2**prefix_bits`` rows instead of
    ``size`` from every task.
    """
    digits = prefix_bits // 4
    hashed = df.withColumn("_hash", row_hash(seed, key))
    prefix = F.substring("_hash", 1, digits)
    per_prefix = hashed.groupBy(prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    # At most 2**prefix_bits rows, whatever the input size.
    running = F.sum("_n").over(W.orderBy("_prefix"))
    enough = per_prefix.withColumn("_running", running).filter(F.col("_running") >= size)
    cutoff = enough.agg(F.coalesce(F.min("_prefix"), F.lit("g")).alias("c")).scalar()
    return hashed.filter(prefix <= cutoff).orderBy("_hash", *key).limit(size).drop("_hash")


def head(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows by a complete order."""
    return df.orderBy(*order).limit(n)


def label_by_month(df: DataFrame, train_months: int = 10, ts: str = WINDOW) -> DataFrame:
    """Adds ``part``: train for the first ``train_months`` distinct months, validation after.

    The month list is one row per month of history, so broadcasting it is bounded by the calendar.
    """
    months = df.select(month_start(ts).alias("year_month")).distinct()
    numbered = months.withColumn("_month_no", F.row_number().over(W.orderBy("year_month")))
    dated = df.withColumn("year_month", month_start(ts))
    part = F.when(F.col("_month_no") <= train_months, "train").otherwise("validation")
    return dated.join(F.broadcast(numbered), "year_month").withColumn("part", part).drop("_month_no")


def split_by_month(df: DataFrame, train_months: int = 10, ts: str = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(train, validation) as semi and anti joins against the training months."""
    months = df.select(month_start(ts).alias("year_month")).distinct()
    first = months.withColumn("_month_no", F.row_number().over(W.orderBy("year_month")))
    chosen = F.broadcast(first.filter(F.col("_month_no") <= train_months).select("year_month"))
    dated = df.withColumn("year_month", month_start(ts))
    return dated.join(chosen, "year_month", "left_semi"), dated.join(chosen, "year_month", "left_anti")


def label_by_position(df: DataFrame, share: float = 0.8, ts: str = WINDOW, zone: str = ZONE) -> DataFrame:
    """Adds ``part`` by position in (zone, window) order: the first ``share`` of the rows train.

    The split point is one (zone, window) pair. Zone totals name its zone, the
    windows of that one zone (96 a day) name its window, and every row is then
    compared with it in place: the labelled rows are never shuffled.
    """
    per_zone = df.groupBy(zone).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(W.orderBy(zone))
    total = F.sum("_n").over(W.partitionBy())
    placed = per_zone.withColumns({"_upto": upto, "_train": F.floor(total * F.lit(share))})
    start = F.col("_upto") - F.col("_n")
    split_zone = placed.filter((F.col("_train") > start) & (F.col("_train") <= F.col("_upto"))).select(
        zone, (F.col("_train") - start).alias("_place"))
    # One zone at most, hence one row.
    candidates = df.select(zone, ts).join(F.broadcast(split_zone), zone)
    numbered = candidates.withColumn("_row", F.row_number().over(W.orderBy(ts)))
    last = numbered.filter(F.col("_row") == F.col("_place")).agg(F.max(F.struct(zone, ts)).alias("last")).scalar()
    return df.withColumn("part", F.when(F.struct(zone, ts) <= last, "train").otherwise("validation"))


def label_by_time(df: DataFrame, share: float = 0.8, ts: str = WINDOW) -> DataFrame:
    """Adds ``part`` by time: windows up to the ``share`` rank of the distinct windows train.

    Distinct windows are bounded by the calendar (96 a day), so ranking them in one task is safe.
    """
    windows = df.select(ts).distinct().withColumn("_rank", F.percent_rank().over(W.orderBy(ts)))
    last = windows.filter(F.col("_rank") <= share).agg(F.max(ts).alias("t")).scalar()
    return df.withColumn("part", F.when(F.col(ts) <= last, "train").otherwise("validation"))
