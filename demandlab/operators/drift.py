"""Distribution drift: reference statistics, KS, PSI and the drift table.

Both samples are unpivoted and merged into one table of value counts per
feature (``ref_n``, ``prod_n``), written once. Every statistic is read off that
table, so the feature rows are read and shuffled once, already reduced to
distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlab.functions.numeric import safe_ratio
from demandlab.operators.metrics import prediction_performance
from demandlab.operators.ranking import (
    exact_quantiles, held_ranks, interpolated, rank_map, running_totals, settle, value_counts,
)
from demandlab.schemas import DEMAND, FEATURES, PREDICTION_DRIFT, ZONE

PSI_LIMIT = 0.1
P_VALUE_LIMIT = 0.05
EMPTY_BIN_FLOOR = 1e-4


def long_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, feature) with a double value."""
    wide = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])
    return wide.unpivot(list(keep), list(features), "feature", "value")


def feature_stats(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Per feature: mean, sample deviation, range and exact quartiles."""
    long = long_features(df, features)
    moments = long.groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    counts = settle(value_counts(long, ["feature"], "value"), "feature-values")
    named = exact_quantiles(counts, ["feature"], "value", [0.5, 0.25, 0.75]).select("feature", *[
        F.col("quantiles")[i].alias(name) for i, name in enumerate(("median", "q25", "q75"))])
    return moments.join(F.broadcast(named), "feature", "left")


def sample_counts(reference: DataFrame, production: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Value counts of both samples: (feature, value, ref_n, prod_n)."""
    ref = long_features(reference, features).withColumn("side", F.lit(0))
    prod = long_features(production, features).withColumn("side", F.lit(1))
    counted = value_counts(ref.unionByName(prod), ["feature"], "value",
                           ref_n=1 - F.col("side"), prod_n=F.col("side"))
    return settle(counted, "sample-counts")


def split_sample_counts(rows: DataFrame, in_reference: Column, in_production: Column,
                        features: Sequence[str] = FEATURES) -> DataFrame:
    """The same table when both samples are parts of one table, which is then read once. The parts may overlap."""
    marked = rows.withColumns({
        "_ref": F.coalesce(in_reference, F.lit(False)).cast("int"),
        "_prod": F.coalesce(in_production, F.lit(False)).cast("int"),
    }).filter("_ref + _prod > 0")
    long = long_features(marked, features, ["_ref", "_prod"])
    counted = value_counts(long, ["feature"], "value", ref_n=F.col("_ref"), prod_n=F.col("_prod"))
    return settle(counted, "sample-counts")


def grouped_sample_counts(reference: DataFrame, production: DataFrame, group: str, group_values: Sequence[str],
                          features: Sequence[str] = FEATURES) -> DataFrame:
    """Counts for several production groups (say weeks) against one reference.

    The reference is reduced to distinct values first and then repeated for the
    listed groups.
    """
    ref = value_counts(long_features(reference, features), ["feature"], "value", ref_n=F.lit(1))
    listed = F.explode(F.array(*[F.lit(g) for g in group_values])).alias(group)
    ref = ref.select(listed, "feature", "value", "ref_n", F.lit(0).cast("long").alias("prod_n"))
    prod = value_counts(long_features(production, features, [group]), [group, "feature"], "value", prod_n=F.lit(1))
    prod = prod.select(group, "feature", "value", F.lit(0).cast("long").alias("ref_n"), "prod_n")
    both = ref.unionByName(prod)
    merged = both.groupBy(group, "feature", "value").agg(
        F.sum("ref_n").alias("ref_n"), F.sum("prod_n").alias("prod_n"))
    return settle(merged, "grouped-counts")


def ks_p_value(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value by the Kolmogorov series; 1 where the series does not settle.

    NULL where a sample is empty: nothing was compared.
    """
    lam = d * F.sqrt(n.cast("double") * m.cast("double") / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    settled = F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)))
    return F.when(lam.isNotNull() & (n > 0) & (m > 0), settled)


def ranked_counts(counts: DataFrame, groups: Sequence[str] = ("feature",)) -> DataFrame:
    """Counts with running and total counts of both samples, and the totals the moments need."""
    v = F.col("value")
    measured = counts.withColumns({
        "seen": (F.col("ref_n") > 0).cast("int"),
        "ref_sum": v * F.col("ref_n"), "prod_sum": v * F.col("prod_n"),
    })
    return running_totals(measured, list(groups), "value", ["ref_n", "prod_n"], ["seen", "ref_sum", "prod_sum"])


def ks_table(ranked: DataFrame, groups: Sequence[str] = ("feature",)) -> DataFrame:
    """Per group: KS statistic, p-value, and mean and deviation of both samples, in one aggregate."""
    v, n, m = F.col("value"), F.col("all_ref_n"), F.col("all_prod_n")
    ref_mean, prod_mean = safe_ratio(F.col("all_ref_sum"), n), safe_ratio(F.col("all_prod_sum"), m)
    gap = F.abs(safe_ratio(F.col("cum_ref_n"), n) - safe_ratio(F.col("cum_prod_n"), m))

    def deviation(count: str, mean: Column, total: Column) -> Column:
        squares = F.sum(F.col(count) * (v - mean) * (v - mean))
        return F.sqrt(F.try_divide(squares, F.max(total) - F.lit(1.0)))

    measured = ranked.groupBy(*groups).agg(
        F.max(gap).alias("ks"), F.max(n).alias("n_ref"), F.max(m).alias("n_prod"),
        F.max(ref_mean).alias("reference_mean"), F.max(prod_mean).alias("production_mean"),
        deviation("ref_n", ref_mean, n).alias("reference_std"),
        deviation("prod_n", prod_mean, m).alias("production_std"),
    )
    return measured.withColumn("p_value", ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_prod")))


def integer_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    whole = (T.IntegerType, T.LongType)
    return [f for f in features if isinstance(df.schema[f].dataType, whole)]


def psi_edges(ranked: DataFrame, groups: Sequence[str], integers: Sequence[str], buckets: int = 10) -> DataFrame:
    """Bin edges from the reference: its deciles, or its distinct values for integers with few of them.

    Only the values holding a decile rank, and fewer than ``buckets`` distinct values, are gathered.
    """
    shares = [i / buckets for i in range(buckets + 1)]
    few = F.lit(False)
    if integers:
        few = F.col("feature").isin(*integers) & (F.col("all_seen") < buckets)
    seen = ranked.filter(F.col("ref_n") > 0).withColumn("_held", held_ranks(shares, "ref_n"))
    found = seen.filter((F.size("_held") > 0) | few).groupBy(*groups).agg(
        rank_map(F.col("_held"), "value").alias("_at"), F.max("all_ref_n").alias("_total"),
        F.sort_array(F.collect_list(F.when(few, F.col("value")))).alias("_values"))
    deciles = F.array_sort(F.array_distinct(interpolated(shares, F.col("_at"), F.col("_total"))))
    return found.select(*groups, F.when(F.size("_values") > 0, F.col("_values")).otherwise(deciles).alias("edges"))


def bin_number(value: Column, edges: Column) -> Column:
    """Right-closed bin, the lowest edge included in bin 1, NULL outside the edges."""
    below = F.size(F.filter(edges, lambda e: e < value))
    slot = F.when(value == edges[0], 1).otherwise(below)
    return F.when((slot >= 1) & (slot < F.size(edges)), slot)


def psi_table(ranked: DataFrame, groups: Sequence[str] = ("feature",), integers: Sequence[str] = (),
              buckets: int = 10, empty_bin: str = "inf") -> DataFrame:
    """Population stability index per group.

    A bin only one sample fills makes the index infinite; ``empty_bin="floor"``
    puts 1e-4 in its place. Values outside the reference range leave the
    production sample before it is normalised.
    """
    groups = list(groups)
    # Edges: at most buckets + 1 numbers per feature and listed group.
    edges = F.broadcast(psi_edges(ranked, groups, integers, buckets))
    binned = ranked.select(*groups, "value", "ref_n", "prod_n").join(edges, groups)
    # Values outside the edges stay as a row without a bin, so a reference without bins still has a row.
    filled = binned.groupBy(*groups, bin_number(F.col("value"), F.col("edges")).alias("bin")).agg(
        F.sum("ref_n").alias("ref_n"), F.sum("prod_n").alias("prod_n"))
    return psi_of_bins(filled, groups, empty_bin)


def psi_of_bins(filled: DataFrame, groups: Sequence[str], empty_bin: str = "inf") -> DataFrame:
    """The index from counts per bin; a row without a bin stands for values outside the edges."""
    inside = F.col("bin").isNotNull()
    whole = W.partitionBy(*groups)
    r = safe_ratio(F.col("ref_n"), F.sum(F.when(inside, F.col("ref_n"))).over(whole))
    p = safe_ratio(F.col("prod_n"), F.sum(F.when(inside, F.col("prod_n"))).over(whole))
    if empty_bin == "floor":
        r, p = F.greatest(r, F.lit(EMPTY_BIN_FLOOR)), F.greatest(p, F.lit(EMPTY_BIN_FLOOR))
    elif empty_bin != "inf":
        raise ValueError(f"unknown empty_bin {empty_bin!r}")
    shares = filled.select(*groups, inside.alias("inside"), r.alias("r"), p.alias("p"))
    r, p = F.col("r"), F.col("p")
    # A bin empty in both samples contributes nothing and has no row.
    term = F.when((r == 0) & (p == 0), 0.0).when((r == 0) | (p == 0), F.lit(float("inf"))).otherwise(
        (p - r) * F.ln(p / r))
    return shares.groupBy(*groups).agg(F.coalesce(F.sum(F.when(F.col("inside"), term)), F.lit(0.0)).alias("psi"))


def drift_table(counts: DataFrame, categorical: Sequence[str] = (ZONE,), integers: Sequence[str] = (ZONE,),
                groups: Sequence[str] = ("feature",), p_limit: float = P_VALUE_LIMIT,
                psi_limit: float = PSI_LIMIT, empty_bin: str = "inf") -> DataFrame:
    """One row per feature: PSI for the categorical ones, KS for the others, and how the moments moved."""
    groups = list(groups)
    ranked = ranked_counts(counts, groups)
    psi = None
    if categorical:
        chosen = ranked.filter(F.col("feature").isin(*categorical))
        psi = psi_table(chosen, groups, integers, empty_bin=empty_bin)
    return drift_rows(ks_table(ranked, groups), psi, categorical, groups, p_limit, psi_limit)


def drift_rows(measured: DataFrame, psi: DataFrame | None, categorical: Sequence[str],
               groups: Sequence[str] = ("feature",), p_limit: float = P_VALUE_LIMIT,
               psi_limit: float = PSI_LIMIT) -> DataFrame:
    """The drift table from the measures of ``ks_table`` and, for the categorical features, the index."""
    groups = list(groups)
    if psi is None:
        joined = measured.withColumn("psi", F.lit(None).cast("double"))
    else:
        joined = measured.join(F.broadcast(psi), groups, "left")
    by_psi = F.col("feature").isin(*categorical) if categorical else F.lit(False)
    return joined.select(
        *groups,
        F.coalesce(F.when(by_psi, F.col("psi") > psi_limit).otherwise(F.col("p_value") < p_limit), F.lit(False))
        .alias("drift_detected"),
        F.when(by_psi, "PSI").otherwise("KS").alias("test"),
        F.when(by_psi, F.col("psi")).otherwise(F.col("ks")).alias("drift_score"),
        F.when(~by_psi, F.col("p_value")).alias("p_value"),
        "reference_mean", "production_mean",
        (F.col("production_mean") - F.col("reference_mean")).alias("mean_shift"),
        "reference_std", "production_std",
    )


def feature_drift(reference: DataFrame, production: DataFrame, features: Sequence[str] = FEATURES,
                  categorical: Sequence[str] = (ZONE,), **limits) -> DataFrame:
    named = [f for f in categorical if f in features]
    counts = sample_counts(reference, production, features)
    return drift_table(counts, named, integer_features(reference, named), **limits)


def feature_drift_within(rows: DataFrame, in_reference: Column, in_production: Column,
                         features: Sequence[str] = FEATURES, categorical: Sequence[str] = (ZONE,),
                         **limits) -> DataFrame:
    """Drift between two parts of one table, reading it once."""
    named = [f for f in categorical if f in features]
    counts = split_sample_counts(rows, in_reference, in_production, features)
    return drift_table(counts, named, integer_features(rows, named), **limits)


def drifted_names(order: Sequence[str] = FEATURES) -> Column:
    """Names of the drifted features in model order; a feature table holds a few dozen rows."""
    place = F.array_position(F.array(*[F.lit(f) for f in order]), F.col("feature"))
    hits = F.collect_list(F.when(F.col("drift_detected"), F.struct(place.alias("place"), F.col("feature"))))
    return F.transform(F.sort_array(hits), lambda h: h["feature"])


def drift_summary(table: DataFrame, groups: Sequence[str] = (), order: Sequence[str] = FEATURES) -> DataFrame:
    return table.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("total_features"),
        F.count_if("drift_detected").alias("drifted_features"),
        drifted_names(order).alias("drifted_feature_names"),
    ).withColumn("drift_detected", F.col("drifted_features") > 0)


def prediction_drift(predictions: DataFrame, predicted: str = "predicted", actual: str | None = DEMAND) -> DataFrame:
    """One row: the predictions' distribution, and ``performance`` where an actual value is at hand (null otherwise)."""
    stats = prediction_stats(predictions, predicted)
    known = prediction_performance(predictions, actual, predicted) if actual else None
    row = F.struct("mae", "rmse", "mape", "bias")
    measured = F.lit(None).cast(PREDICTION_DRIFT["performance"].dataType) if known is None else \
        known.select(F.when(F.col("mae").isNotNull(), row)).scalar()
    return stats.withColumn("performance", measured)


def drift_report(table: DataFrame, run_at: Column, production_size: Column, order: Sequence[str] = FEATURES,
                 predictions: DataFrame | None = None, predicted: str = "predicted",
                 actual: str | None = DEMAND) -> DataFrame:
    """The nested report row, ready for a JSON sink; ``prediction_drift`` is null without predictions."""
    if predictions is None:
        about = F.lit(None).cast(PREDICTION_DRIFT)
    else:
        about = prediction_drift(predictions, predicted, actual).select(F.struct(
            "mean", "std", "min", "max", "median", "performance")).scalar()
    rolled = table.agg(
        F.count(F.lit(1)).alias("total_features"), F.count_if("drift_detected").alias("drifted_features"),
        drifted_names(order).alias("drifted_feature_names"),
        F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in table.columns]))).alias("feature_drift"),
    ).withColumn("drift_detected", F.col("drifted_features") > 0)
    return rolled.select(
        run_at.cast("string").alias("timestamp"),
        F.struct("total_features", "drifted_features", "drift_detected", "drifted_feature_names").alias("summary"),
        "feature_drift", about.alias("prediction_drift"), production_size.alias("production_data_size"),
    )


def prediction_stats(df: DataFrame, predicted: str = "predicted") -> DataFrame:
    """Mean, population deviation, range and exact median of the predictions."""
    values = df.select(F.lit("all").alias("sample"), F.col(predicted).cast("double").alias("value"))
    counts = settle(value_counts(values, ["sample"], "value"), "prediction-values")
    median = exact_quantiles(counts, ["sample"], "value", [0.5]).select(F.col("quantiles")[0]).scalar()
    moments = values.agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    return moments.withColumn("median", median)


def shifted_means(hourly: DataFrame, limit: float = 10.0) -> DataFrame:
    """Rows of ``observability.trailing_means`` whose mean moved by more than ``limit``."""
    shift = F.abs(F.col("mean_1h") - F.col("mean_24h_week_ago"))
    return hourly.withColumn("shift", shift).filter(F.col("shift") > limit)
