"""Forecast error metrics, comparisons and leaderboards.

All metric sets take a table with the actual and predicted value as columns of
one row and optional group columns. Moments need one pass; the median needs the
exact-quantile operator and is joined on the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandlab.functions.calendar import seconds_between
from demandlab.functions.numeric import is_finite, percent_change, percent_error, safe_ratio
from demandlab.operators.ranking import exact_quantiles, same, settle, value_counts
from demandlab.schemas import DEMAND

METRIC_NAMES = [
    "rmse", "mae", "mape", "r2_score", "median_ae", "bias", "max_error", "within_5_trips", "within_10_pct",
]
HIGHER_IS_BETTER = ["r2_score", "within_5_trips", "within_10_pct"]
SKLEARN_EPSILON = 2.220446049250313e-16


def share_pct(condition: Column) -> Column:
    return F.avg(condition.cast("double")) * 100


def r2(actual: Column, error: Column) -> Column:
    """1 - SS_res / SS_tot in one pass."""
    return 1 - safe_ratio(F.sum(error * error), F.var_pop(actual) * F.count(actual))


def error_moments(actual: str, predicted: str) -> dict[str, Column]:
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = p - y
    return {
        "rmse": F.sqrt(F.avg(e * e)),
        "mae": F.avg(F.abs(e)),
        "mape": F.avg(percent_error(e, y, SKLEARN_EPSILON, "floor")) * 100,
        "r2_score": r2(y, e),
        "bias": F.avg(e),
        "max_error": F.max(F.abs(e)),
        "within_5_trips": share_pct(F.abs(e) <= 5),
        "within_10_pct": share_pct(percent_error(e, y, 1e-8) <= 0.1),
    }


def regression_metrics(df: DataFrame, actual: str = DEMAND, predicted: str = "predicted",
                       by: Sequence[str] = ("model",)) -> DataFrame:
    """The nine-metric set per model. ``by`` names few groups, such as models or weeks."""
    by = list(by)
    moments = df.groupBy(*by).agg(*[c.alias(n) for n, c in error_moments(actual, predicted).items()],
                                  F.count(F.lit(1)).alias("samples"))
    errors = df.select(*by, F.abs(F.col(predicted) - F.col(actual)).cast("double").alias("abs_error"))
    counts = settle(value_counts(errors, by, "abs_error"), "abs-errors")
    middle = exact_quantiles(counts, by, "abs_error", [0.5])
    medians = middle.select(*by, F.col("quantiles")[0].alias("median_ae"))
    # Few groups, as ``by`` names them; a NULL group keeps its median.
    joined = moments.alias("m").join(F.broadcast(medians).alias("q"), same(by, "m", "q"), "left")
    return joined.select("m.*", "median_ae").select(*by, *METRIC_NAMES, "samples")


def basic_metrics(df: DataFrame, actual: str = DEMAND, predicted: str = "predicted",
                  by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and the number of samples in one pass."""
    chosen = error_moments(actual, predicted)
    return df.groupBy(*by).agg(
        *[chosen[n].alias(a) for n, a in (("mae", "mae"), ("rmse", "rmse"), ("r2_score", "r2"))],
        F.count(F.lit(1)).alias("samples"),
    )


def performance_check(df: DataFrame, baseline_mae: float, actual: str = DEMAND, predicted: str = "predicted",
                      by: Sequence[str] = ()) -> DataFrame:
    """Current error against the registered baseline."""
    measured = basic_metrics(df, actual, predicted, by)
    return measured.withColumns({
        "baseline_mae": F.lit(float(baseline_mae)),
        "mae_increase_pct": percent_change(F.col("mae"), F.lit(float(baseline_mae))),
    })


def guarded_metrics(df: DataFrame, actual: str = DEMAND, predicted: str = "predicted",
                    epsilon: float = 1e-10) -> DataFrame:
    """Display variant: only finite percentage errors count, and R2 tolerates a constant target."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = y - p
    pct = percent_error(e, y, epsilon) * 100
    return df.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.when(is_finite(pct), pct)).alias("mape"),
        (1 - F.sum(e * e) / (F.var_pop(y) * F.count(y) + epsilon)).alias("r2"),
    )


def prediction_performance(df: DataFrame, actual: str = DEMAND, predicted: str = "predicted") -> DataFrame:
    """Drift-report variant."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = p - y
    return df.agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(percent_error(e, y, 1e-8)) * 100).alias("mape"), F.avg(e).alias("bias"),
    )


def running_score(df: DataFrame, actual: str, predicted: str, succeeded: Column, ts: str | None = None) -> DataFrame:
    """Request totals, success rate and running error sums, and requests per second when ``ts`` is given."""
    e = F.when(succeeded, F.col(actual).cast("double") - F.col(predicted).cast("double"))
    aggs = [
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(succeeded).alias("successful"),
        F.count_if(~succeeded).alias("failed"),
        F.sum(F.abs(e)).alias("sum_abs_error"),
        F.sum(e * e).alias("sum_sq_error"),
    ]
    if ts:
        span = seconds_between(F.min(ts), F.max(ts))
        aggs.append((F.count(F.lit(1)) / F.greatest(span, F.lit(1.0))).alias("requests_per_second"))
    totals = df.agg(*aggs)
    return with_rates(totals)


def with_rates(totals: DataFrame) -> DataFrame:
    ok = F.col("successful")
    return totals.withColumns({
        "success_rate_pct": F.col("successful") / F.greatest(F.col("total_requests"), F.lit(1)) * 100,
        "mae": safe_ratio(F.col("sum_abs_error"), ok),
        "rmse": F.sqrt(safe_ratio(F.col("sum_sq_error"), ok)),
    })


def history_stats(df: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """Latest, mean, minimum and maximum of a history and its length."""
    return df.agg(
        F.max_by(F.col(value), F.struct(*order)).alias("latest"), F.avg(value).alias("mean"),
        F.min(value).alias("lowest"), F.max(value).alias("highest"), F.count(value).alias("points"),
    )


def leaderboard(metrics: DataFrame, names: Sequence[str] = METRIC_NAMES,
                higher: Sequence[str] = HIGHER_IS_BETTER, bias: str = "signed",
                order: Sequence[str] = ()) -> DataFrame:
    """Metric wins per model over long metric rows (model, metric_name, metric_value).

    Ties score for every tied model; equal wins go to the model listed first in
    ``order``, else to the first name. A signed bias rewards the most negative
    one; ``bias="abs"`` rewards the one nearest zero. One row per (model,
    metric), so the windows are tiny.
    """
    v = F.col("metric_value")
    if bias == "abs":
        v = F.when(F.col("metric_name") == "bias", F.abs(v)).otherwise(v)
    cost = F.when(F.col("metric_name").isin(*higher), -v).otherwise(v)
    ranked = metrics.filter(F.col("metric_name").isin(*names)).withColumn(
        "_rank", F.rank().over(W.partitionBy("metric_name").orderBy(cost))
    )
    wins = ranked.groupBy("model").agg(F.count_if(F.col("_rank") == 1).alias("wins"))
    listed = F.array(*[F.lit(m) for m in order]).cast("array<string>")
    place = F.nullif(F.array_position(listed, F.col("model")), F.lit(0))
    first = F.row_number().over(W.orderBy(F.desc("wins"), place.asc_nulls_last(), "model"))
    return wins.withColumn("is_winner", first == 1)


def compare_models(df: DataFrame, champion: str, challenger: str, names: tuple[str, str] = ("v1", "v2"),
                   actual: str = DEMAND) -> DataFrame:
    """Both predictions scored on the same rows in one pass; the challenger must be strictly better on MAE."""
    aggs = []
    for tag, column in (("champion", champion), ("challenger", challenger)):
        m = error_moments(actual, column)
        aggs += [m["mae"].alias(f"{tag}_mae"), m["rmse"].alias(f"{tag}_rmse"), m["r2_score"].alias(f"{tag}_r2")]
    scored = df.agg(*aggs, F.count(F.lit(1)).alias("test_samples"))
    better = F.col("challenger_mae") < F.col("champion_mae")
    return scored.withColumns({
        "winner": F.when(better, F.lit(names[1])).otherwise(F.lit(names[0])),
        "mae_improvement_pct": F.abs(percent_change(F.col("challenger_mae"), F.col("champion_mae"))),
    })


def error_table(df: DataFrame, actual: str = DEMAND, predicted: str = "predicted") -> DataFrame:
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    e = y - p
    return df.withColumns({
        "error": e, "abs_error": F.abs(e), "error_pct": percent_error(e, y, 1e-10) * 100,
    })
