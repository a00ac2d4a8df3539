"""Row rules, batch validation, consistency checks and the column profile."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlab.functions.documents import texts_if, two_decimals
from demandlab.functions.numeric import nan_to_null, safe_ratio, z_score
from demandlab.operators.cleaning import duplicate_count
from demandlab.operators.ranking import exact_quantiles, settle, value_counts
from demandlab.schemas import QUALITY_MAX_Z, QUALITY_RANGES, QUALITY_Z_STATS, REQUEST_RANGES, WINDOW, ZONE


def _limit(bound: float | None) -> str:
    return "inf" if bound is None else str(bound)


def _outside(x: Column, low: float, high: float | None) -> Column:
    return (x < low) if high is None else (x < low) | (x > high)


Rule = tuple[Column, Callable[[], Column]]


def row_checks(df: DataFrame) -> list[Rule]:
    """Every row rule as (violated, how to word it).

    A NULL or NaN yields one message and suppresses the column's other rules. A
    column missing from the table fails every row with a single message.
    """
    missing = [c for c in QUALITY_RANGES if c not in df.columns]
    if missing:
        return [(F.lit(True), lambda: F.lit("Missing features: " + ", ".join(missing)))]
    return [rule for name in QUALITY_RANGES for rule in _column_checks(name)]


def _column_checks(name: str) -> list[Rule]:
    low, high = QUALITY_RANGES[name]
    x = F.col(name).cast("double")
    absent = x.isNull() | F.isnan(x)

    def out_of_range() -> Column:
        ending = f" out of range [{low}, {_limit(high)}]"
        return F.concat(F.lit(f"{name}: Value "), x.cast("string"), F.lit(ending))

    rules: list[Rule] = [
        (absent, lambda: F.lit(f"{name}: Value is None or NaN")),
        (~absent & _outside(x, low, high), out_of_range),
    ]
    if name in QUALITY_Z_STATS:
        z = z_score(x, *QUALITY_Z_STATS[name])
        rules.append((~absent & (z > QUALITY_MAX_Z), lambda: F.concat(
            F.lit(f"{name}: Statistical anomaly detected (z-score: "), two_decimals(z), F.lit(")"))))
    return rules


def rule_errors(df: DataFrame) -> Column:
    return texts_if([(violated, wording()) for violated, wording in row_checks(df)])


def passes_rules(df: DataFrame) -> Column:
    """Whether no row rule is violated, without building any message."""
    return ~reduce(or_, [violated for violated, _ in row_checks(df)])


def with_rule_errors(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", rule_errors(df))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(passes_rules(df))


def validation_summary(df: DataFrame) -> DataFrame:
    """Totals of one batch; the rate is NULL for an empty batch."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(passes_rules(df)).alias("valid_records")
    )
    return counts.withColumns({
        "invalid_records": F.col("total_records") - F.col("valid_records"),
        "validation_rate": safe_ratio(F.col("valid_records"), F.col("total_records")) * 100,
    })


def request_errors() -> Column:
    """Messages for request fields that are missing or outside their range."""
    checks = []
    for name, (low, high) in REQUEST_RANGES.items():
        x = F.col(name).cast("double")
        checks.append((x.isNull() | F.isnan(x), F.lit(f"{name}: missing")))
        checks.append((~F.isnan(x) & _outside(x, low, high), F.lit(f"{name}: not in [{low}, {_limit(high)}]")))
    return texts_if(checks)


def validated_requests(df: DataFrame) -> DataFrame:
    return df.withColumn("errors", request_errors())


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their messages)."""
    ok = F.size("errors") == 0
    return checked.filter(ok).drop("errors"), checked.filter(~ok)


def write_split(df: DataFrame, good_path: str, bad_path: str, mode: str = "append") -> None:
    """Good rows to one table, quarantined rows with their messages to another.

    The rows are made once, with the verdict; they spill to disk. A filter on them then tests a stored column: on
    the plan it would be moved to the scan with everything the rules are made of, once for every use. Only
    quarantined rows get messages.
    """
    judged = df.withColumn("_passes", passes_rules(df)).persist()
    try:
        judged.filter("_passes").drop("_passes").write.mode(mode).parquet(good_path)
        with_rule_errors(judged.filter("NOT _passes").drop("_passes")).write.mode(mode).parquet(bad_path)
    finally:
        judged.unpersist()


def consistency_check(df: DataFrame, keys: Sequence[str] = (WINDOW, ZONE), lag_factor: float = 3.0,
                      mean_gap: float = 50.0) -> DataFrame:
    """Counts of inconsistent rows and the overall status.

    A missing value (NULL or NaN) is not inconsistent. A test is left out, with a count of 0,
    where one of its columns is absent.
    """

    def number(name: str) -> Column:
        return nan_to_null(F.col(name).cast("double")) if name in df.columns else F.lit(None).cast("double")

    lag_1, expected_mean = number("lag_1"), (number("lag_1") + number("lag_4")) / 2
    counts = df.agg(
        F.count_if(lag_1 > number("lag_96") * lag_factor).alias("lag_inconsistent"),
        F.count_if(F.abs(number("rolling_mean_4") - expected_mean) > mean_gap).alias("mean_inconsistent"),
    )
    # One row, so reading it as a scalar is safe.
    repeated = duplicate_count(df, keys).scalar()
    checked = counts.withColumn("duplicate_rows", repeated)
    clean = (F.col("lag_inconsistent") + F.col("mean_inconsistent") + F.col("duplicate_rows")) == 0
    return checked.withColumn("consistency_check", F.when(clean, "passed").otherwise("failed"))


def quality_profile(df: DataFrame, columns: Sequence[str] = tuple(QUALITY_RANGES)) -> DataFrame:
    """Per ruled column: moments, quartiles, missing values and IQR outliers."""
    present = [c for c in columns if c in df.columns]
    kinds = F.create_map(*[F.lit(v) for c in present for v in (c, df.schema[c].dataType.simpleString())])
    long = df.select(*[F.col(c).cast("double").alias(c) for c in present]).unpivot(
        [], present, "feature", "value").withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    moments = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("total_rows"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count_if(F.col("value").isNull()).alias("missing_count"),
    )
    counts = settle(value_counts(long, ["feature"], "value"), "quality-values")
    q = exact_quantiles(counts, ["feature"], "value", [0.25, 0.5, 0.75]).select("feature", *[
        F.col("quantiles")[i].alias(name) for i, name in enumerate(("q25", "median", "q75"))])
    # Quartiles: one row per ruled column.
    fenced = counts.join(F.broadcast(q), "feature")
    spread = 1.5 * (F.col("q75") - F.col("q25"))
    outside = (F.col("value") < F.col("q25") - spread) | (F.col("value") > F.col("q75") + spread)
    outliers = fenced.groupBy("feature").agg(F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outlier_count"))
    joined = moments.join(F.broadcast(q), "feature", "left").join(F.broadcast(outliers), "feature", "left")
    return joined.withColumns({
        "outlier_count": F.coalesce("outlier_count", F.lit(0)),
        "missing_pct": safe_ratio(F.col("missing_count"), F.col("total_rows")) * 100,
        "outlier_pct": safe_ratio(F.coalesce("outlier_count", F.lit(0)), F.col("total_rows")) * 100,
        "data_type": kinds[F.col("feature")],
    })
