"""A standing reference profile: what drift needs of the reference sample, counted and ranked once.

A profile is three tables under one path:

- ``values``: (feature, value, ref_n, cum_ref_n), cut into slices of at most ``SLICE_VALUES`` distinct
  values, one folder each;
- ``slices``: the lowest value of each slice;
- ``features``: per feature the number of values, mean, deviation, bin edges and counts per bin.

A batch is reduced to its own value counts and looked up in the slices its values fall into. Between two of its
values its own share stands still and the reference's only rises, so the largest gap is at one of its values or
just below one: the reference's other values need not be read. Counts of two samples add up, so a profile can be
extended without the rows it was made of.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlab.functions.numeric import safe_ratio
from demandlab.operators.drift import (
    bin_number, drift_rows, integer_features, ks_p_value, long_features, psi_edges, psi_of_bins,
)
from demandlab.operators.ranking import running_totals, settle, value_counts
from demandlab.schemas import DBL, FEATURES, INT, LONG, STR, ZONE, table

SLICE_VALUES = 1_000_000
VALUES = table(value=DBL, ref_n=LONG, cum_ref_n=LONG, feature=STR, slice=LONG)
SLICES = table(feature=STR, slice=LONG, low=DBL)
FEATURE_ROWS = table(
    feature=STR, n_ref=LONG, reference_mean=DBL, reference_std=DBL, edges=T.ArrayType(DBL),
    bins=T.ArrayType(table(bin=INT, ref_n=LONG)),
)


@dataclass(frozen=True)
class Profile:
    values: DataFrame
    slices: DataFrame
    features: DataFrame


def read_profile(spark: SparkSession, path: str) -> Profile:
    return Profile(*[spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in
                     (("values", VALUES), ("slices", SLICES), ("features", FEATURE_ROWS))])


def write_profile(reference: DataFrame, path: str, features: Sequence[str] = FEATURES,
                  categorical: Sequence[str] = (ZONE,), slice_values: int = SLICE_VALUES) -> None:
    """Reads the reference once; the categorical features get bin edges."""
    named = [f for f in categorical if f in features]
    counts = value_counts(long_features(reference, features), ["feature"], "value", ref_n=F.lit(1))
    _write_counts(counts, path, named, integer_features(reference, named), slice_values)


def extend_profile(profile: Profile, reference: DataFrame, path: str, features: Sequence[str] = FEATURES,
                   categorical: Sequence[str] = (ZONE,), slice_values: int = SLICE_VALUES) -> None:
    """The profile of the old reference and the new rows together, written to another path."""
    named = [f for f in categorical if f in features]
    more = value_counts(long_features(reference, features), ["feature"], "value", ref_n=F.lit(1))
    both = profile.values.select("feature", "value", "ref_n").unionByName(more)
    counts = both.groupBy("feature", "value").agg(F.sum("ref_n").alias("ref_n"))
    _write_counts(counts, path, named, integer_features(reference, named), slice_values)


def _write_counts(counts: DataFrame, path: str, categorical: Sequence[str], integers: Sequence[str],
                  slice_values: int) -> None:
    measured = counts.withColumns({"seen": F.lit(1).cast("long"), "ref_sum": F.col("value") * F.col("ref_n")})
    ranked = settle(running_totals(measured, ["feature"], "value", ["ref_n", "seen"], ["ref_sum"]), "profile-ranks")
    # The place of a value among the distinct ones decides its slice, so no slice grows with the data.
    placed = ranked.withColumn("slice", F.floor((F.col("cum_seen") - 1) / slice_values))
    (placed.select(*VALUES.fieldNames()).repartition("feature", "slice").sortWithinPartitions("feature", "slice", "value")
     .write.mode("overwrite").partitionBy("feature", "slice").parquet(f"{path}/values"))
    placed.groupBy("feature", "slice").agg(F.min("value").alias("low")).write.mode("overwrite").parquet(f"{path}/slices")
    mean = safe_ratio(F.col("all_ref_sum"), F.col("all_ref_n"))
    squares = F.sum(F.col("ref_n") * (F.col("value") - mean) * (F.col("value") - mean))
    totals = ranked.groupBy("feature").agg(
        F.max("all_ref_n").alias("n_ref"), F.max(mean).alias("reference_mean"),
        F.sqrt(F.try_divide(squares, F.max("all_ref_n") - F.lit(1.0))).alias("reference_std"))
    edges = F.broadcast(psi_edges(ranked.filter(F.col("feature").isin(*categorical)), ["feature"], integers))
    binned = ranked.join(edges, "feature").groupBy(
        "feature", "edges", bin_number(F.col("value"), F.col("edges")).alias("bin")).agg(F.sum("ref_n").alias("ref_n"))
    bins = binned.groupBy("feature", "edges").agg(F.sort_array(F.collect_list(F.struct("bin", "ref_n"))).alias("bins"))
    # At most one row per feature on both sides.
    joined = totals.join(F.broadcast(bins), "feature", "left").select(*FEATURE_ROWS.fieldNames())
    joined.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def _reference_ranks(batch: DataFrame, profile: Profile) -> DataFrame:
    """``batch`` (one row per feature and value) with the reference's counts up to (``at``) and below (``under``) it."""
    # One row per feature; an array holds the lowest value of each slice.
    lows = profile.slices.groupBy("feature").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("slice", "low"))), lambda s: s["low"]).alias("_lows"))
    slot = F.size(F.filter("_lows", lambda low: low <= F.col("value"))) - 1
    placed = batch.join(F.broadcast(lows), "feature", "left").withColumn(
        "slice", F.greatest(F.coalesce(slot, F.lit(0)), F.lit(0)).cast("long")).drop("_lows")
    # One row per feature and one number per slice. As literals they decide which folders are listed and read.
    touched = placed.groupBy("feature").agg(F.collect_set("slice").alias("slices")).collect()
    wanted = [(F.col("feature") == t["feature"]) & F.col("slice").isin(t["slices"]) for t in touched]
    stored = profile.values.filter(reduce(or_, wanted, F.lit(False)))
    both = placed.unionByName(stored, allowMissingColumns=True)
    known = F.when(F.col("ref_n").isNotNull(), F.struct("value", "cum_ref_n", "ref_n"))
    up_to = W.partitionBy("feature", "slice").orderBy("value").rangeBetween(W.unboundedPreceding, W.currentRow)
    found = both.withColumn("_last", F.max(known).over(up_to)).filter(F.col("prod_n").isNotNull())
    at = F.coalesce(F.col("_last.cum_ref_n"), F.lit(0))
    equal = F.when(F.col("_last.value") == F.col("value"), F.col("_last.ref_n")).otherwise(0)
    return found.select(*batch.columns, at.alias("at"), (at - equal).alias("under"))


def _gaps(found: DataFrame, features: DataFrame) -> DataFrame:
    """Per feature of either sample: KS statistic, p-value, and mean and deviation of both."""
    n, m, v = F.col("n_ref"), F.col("all_prod_n"), F.col("value")
    mean = safe_ratio(F.col("all_prod_sum"), m)

    def gap(reference: Column, production: Column) -> Column:
        return F.abs(safe_ratio(reference, n) - safe_ratio(production, m))

    here = gap(F.col("at"), F.col("cum_prod_n"))
    below = gap(F.col("under"), F.col("cum_prod_n") - F.col("prod_n"))
    sizes = features.select("feature", "n_ref")
    measured = found.join(F.broadcast(sizes), "feature", "left").groupBy("feature").agg(
        F.max(F.greatest(here, below)).alias("ks"), F.max(m).alias("n_prod"), F.max(mean).alias("production_mean"),
        F.sqrt(F.try_divide(F.sum(F.col("prod_n") * (v - mean) * (v - mean)), F.max(m) - F.lit(1.0)))
        .alias("production_std"))
    both = features.drop("edges", "bins").join(measured, "feature", "full_outer").withColumns({
        "n_ref": F.coalesce("n_ref", F.lit(0)), "n_prod": F.coalesce("n_prod", F.lit(0))})
    return both.withColumn("p_value", ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_prod")))


def _bin_shares(found: DataFrame, features: DataFrame, empty_bin: str) -> DataFrame:
    edged = features.filter(F.col("edges").isNotNull())
    stored = edged.select("feature", F.inline("bins")).withColumn("prod_n", F.lit(0).cast("long"))
    arrived = found.join(F.broadcast(edged.select("feature", "edges")), "feature").select(
        "feature", bin_number(F.col("value"), F.col("edges")).alias("bin"), F.lit(0).cast("long").alias("ref_n"), "prod_n")
    filled = stored.unionByName(arrived).groupBy("feature", "bin").agg(
        F.sum("ref_n").alias("ref_n"), F.sum("prod_n").alias("prod_n"))
    return psi_of_bins(filled, ["feature"], empty_bin)


def profile_drift(profile: Profile, production: DataFrame, features: Sequence[str] = FEATURES,
                  categorical: Sequence[str] = (ZONE,), empty_bin: str = "inf", **limits: float) -> DataFrame:
    """The rows of ``drift.feature_drift`` from a profile: the reference is neither read nor ranked."""
    named = [f for f in categorical if f in features]
    counts = settle(value_counts(long_features(production, features), ["feature"], "value", prod_n=F.lit(1)),
                    "batch-counts")
    summed = counts.withColumn("prod_sum", F.col("value") * F.col("prod_n"))
    ranked = running_totals(summed, ["feature"], "value", ["prod_n"], ["prod_sum"])
    about = profile.features.filter(F.col("feature").isin(*features))
    found = _reference_ranks(ranked, profile)
    return drift_rows(_gaps(found, about), _bin_shares(counts, about, empty_bin) if named else None, named,
                      **limits)
