"""Raw trip files and demand tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlab.schemas import TRIPS, WINDOW

# Fixed value: how a monthly trip file is named.
MONTH_IN_NAME = r"_(\d{4})-(\d{2})\.parquet"


def file_month(path: Column, strict: bool = True) -> Column:
    """Month number in a ``..._YYYY-MM.parquet`` file or directory name.

    A name without one fails the job; ``strict=False`` gives NULL instead so
    the rows can be set aside.
    """
    found = F.regexp_extract(path, MONTH_IN_NAME + r"(?:/[^/]*)?$", 2)
    bad = F.raise_error(F.concat(F.lit("no month in file name: "), path)).cast("int") if strict else F.lit(None)
    return F.when(found != "", found.cast("int")).otherwise(bad)


def read_table(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; with a schema nothing is inferred and only its columns are read."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_trips(spark: SparkSession, paths: str | Sequence[str], strict_month: bool = True) -> DataFrame:
    """Trip files with the month each name promises.

    Monthly paths are read as one branch per calendar month, whose month is then
    a constant. A directory holding monthly files takes the month from each
    row's file name instead, which costs a pattern match per row.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    by_month: dict[int, list[str]] = {}
    for path in listed:
        named = re.search(MONTH_IN_NAME + "/?$", path)
        if named is None:
            month = file_month(F.col("_metadata.file_path"), strict_month)
            return read_table(spark, listed, TRIPS).select(*TRIPS.fieldNames(), month.alias("expected_month"))
        by_month.setdefault(int(named.group(2)), []).append(path)
    branches = [
        read_table(spark, by_month[m], TRIPS).withColumn("expected_month", F.lit(m)) for m in sorted(by_month)
    ]
    return reduce(DataFrame.unionByName, branches)


def read_directory(spark: SparkSession, directory: str, pattern: str = "*.parquet",
                   schema: T.StructType | None = None) -> DataFrame:
    """Every matching file in a directory; an error when there is none. No data is read."""
    reader = spark.read.option("pathGlobFilter", pattern)
    found = (reader.schema(schema) if schema is not None else reader).parquet(directory)
    if not found.inputFiles():
        raise FileNotFoundError(f"no {pattern} in {directory}")
    return found


def check_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Raises when a required column is missing; returns the extra ones."""
    required = list(required)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return [c for c in df.columns if c not in required]


def contract_counts(df: DataFrame, keys: Sequence[str], typed: dict[str, str]) -> DataFrame:
    """One pass over the data: rows, NULL keys and values that do not fit their type."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys]
    aggs += [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(f"bad_{c}")
        for c, kind in typed.items()
    ]
    return df.agg(*aggs)


def trailing(df: DataFrame, ts: str = WINDOW, *, days: int = 0, hours: int = 0) -> DataFrame:
    """Rows within the last days/hours before the newest timestamp.

    The cut-off is an uncorrelated scalar subquery, so the comparison reaches the scan.
    """
    span = F.make_dt_interval(F.lit(days), F.lit(hours))
    cutoff = df.agg((F.max(ts) - span).alias("cutoff")).scalar()
    return df.filter(F.col(ts) >= cutoff)


def between(df: DataFrame, start: str | None = None, end: str | None = None, ts: str = WINDOW) -> DataFrame:
    """Rows in ``[start, end]``, both ends included."""
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col(ts) <= F.lit(end).cast("timestamp_ntz"))
    return df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet table; with partition columns, rows are rebalanced so a partition gets few files and no huge one."""
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
