"""Data quality (Q1-Q5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.catalog import adapters as ad
from demandlab.catalog.adapters import sql_over
from demandlab.catalog.registry import query, rounded
from demandlab.operators.quality import (
    consistency_check, quality_profile, validation_summary, with_rule_errors, write_split,
)
from demandlab.schemas import QUALITY_RANGES, QUALITY_Z_STATS
from demandlab.session import scratch_path


def rule_sql() -> str:
    parts = []
    for name, (low, high) in QUALITY_RANGES.items():
        text = "inf" if high is None else high
        outside = f"{name} < {low}" + ("" if high is None else f" OR {name} > {high}")
        parts.append(f"CASE WHEN {name} IS NULL THEN '{name}: Value is None or NaN' END")
        parts.append(f"CASE WHEN {outside} THEN '{name}: Value ' || CAST({name} AS DOUBLE) || "
                     f"' out of range [{low}, {text}]' END")
        if name in QUALITY_Z_STATS:
            mean, std = QUALITY_Z_STATS[name]
            z = f"abs(({name} - {mean}::DOUBLE) / {std}::DOUBLE)"
            parts.append(f"CASE WHEN {z} > 5 THEN printf('{name}: Statistical anomaly detected "
                         f"(z-score: %.2f)', {z}) END")
    return "concat_ws(' | ', " + ", ".join(parts) + ")"


CHECKED = {"checked": f"SELECT event_id, {rule_sql()} AS messages FROM quality"}


@query("q1_row_rules", sql_over("quality", extra=CHECKED, body="SELECT * FROM checked"))
def row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = with_rule_errors(ad.quality_rows(spark, sf_dir))
    return checked.select("event_id", F.array_join("errors", " | ").alias("messages"))


@query("q2_batch_validation", sql_over("quality", extra=CHECKED, body="""
SELECT count(*) AS total_records, count(*) FILTER (WHERE messages = '') AS valid_records,
  count(*) FILTER (WHERE messages <> '') AS invalid_records,
  round(count(*) FILTER (WHERE messages = '') / count(*) * 100, 6) AS validation_rate FROM checked"""))
def batch_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(validation_summary(ad.quality_rows(spark, sf_dir)))


@query("q3_consistency", sql_over("quality", body="""
SELECT *, CASE WHEN lag_inconsistent + mean_inconsistent + duplicate_rows = 0 THEN 'passed' ELSE 'failed' END
  AS consistency_check FROM (
SELECT count(*) FILTER (WHERE lag_1 > lag_96 * 3) AS lag_inconsistent,
  count(*) FILTER (WHERE abs(rolling_mean_4 - (lag_1 + lag_4) / 2) > 50) AS mean_inconsistent,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM quality GROUP BY pickup_window, PULocationID))
  AS duplicate_rows FROM quality)"""))
def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consistency_check(ad.quality_rows(spark, sf_dir))


def _profile_sql() -> str:
    rows = []
    for name in QUALITY_RANGES:
        kind = "int" if name in ("PULocationID", "hour", "day_of_week", "month") else "double"
        x = f"CAST({name} AS DOUBLE)"
        q1, q3 = f"quantile_cont({x}, 0.25)", f"quantile_cont({x}, 0.75)"
        rows.append(f"""SELECT '{name}' AS feature, count(*) AS total_rows, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, round(max({x}), 6) AS max,
  count(*) - count({name}) AS missing_count, round({q1}, 6) AS q25, round(median({x}), 6) AS median,
  round({q3}, 6) AS q75,
  (SELECT count(*) FROM quality, (SELECT {q1} AS a, {q3} AS b FROM quality) WHERE {x} < a - 1.5 * (b - a)
   OR {x} > b + 1.5 * (b - a)) AS outlier_count,
  round((count(*) - count({name})) / count(*) * 100, 6) AS missing_pct, '{kind}' AS data_type FROM quality""")
    return "SELECT *, round(outlier_count / total_rows * 100, 6) AS outlier_pct FROM (" + " UNION ALL ".join(rows) + ")"


@query("q4_quality_profile", sql_over("quality", body=_profile_sql()))
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality_profile(ad.quality_rows(spark, sf_dir)))


@query("q5_quarantine_split", sql_over("quality", extra=CHECKED, body="""
SELECT CASE WHEN messages = '' THEN 'good' ELSE 'quarantine' END AS part, count(*) AS n,
  CAST(sum(event_id) AS BIGINT) AS id_sum FROM checked GROUP BY 1"""))
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "quarantine")
    write_split(ad.quality_rows(spark, sf_dir), good, bad)

    def count(path: str, part: str) -> DataFrame:
        return spark.read.parquet(path).groupBy(F.lit(part).alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))

    return count(good, "good").unionByName(count(bad, "quarantine"))
