"""JSON reports and the model registry."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlab.schemas import MODEL_REGISTRY


def append_report(report: DataFrame, path: str, run_at: str) -> None:
    """Writes one run's report rows below ``run_at=<text>``; running it again replaces them."""
    report.write.mode("overwrite").json(f"{path.rstrip('/')}/run_at={run_at}")


def newest_reports(spark: SparkSession, path: str, schema: T.StructType, limit: int = 10) -> DataFrame:
    """All rows of the ``limit`` newest runs (partition or file name), JSON objects one per line."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
    named = rows.select(*schema.fieldNames(), F.col("_metadata.file_path").alias("source_file"))
    run = F.regexp_replace("source_file", "/part-[^/]*$", "")
    kept = named.select(run.alias("_run")).distinct().orderBy(F.desc("_run")).limit(limit)
    # At most ``limit`` rows.
    return named.withColumn("_run", run).join(F.broadcast(kept), "_run").drop("_run").orderBy(F.desc("source_file"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registered model versions; no rows when nothing was registered yet."""
    try:
        return spark.read.schema(MODEL_REGISTRY).option("recursiveFileLookup", True).json(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], MODEL_REGISTRY)
