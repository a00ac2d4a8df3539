"""Numbers that are given once, to any number of writers.

A claim is a small JSON file that only one writer can create: it is written aside and then put at its
name by a step that fails where the name is taken (a hard link on a file system, a rename without
overwriting elsewhere; the storage must offer that rename as one step, as HDFS does). A writer that loses
reads what was claimed and tries the next name. A key that has a claim keeps it, so a repeated run takes nothing.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from demandlab.schemas import LONG, STR, table

CLAIM = table(place=LONG, key=STR, first=LONG, rows=LONG, at=STR)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Creates the file with its whole text, or returns False where there is one already."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = files.create(aside, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    try:
        if files.getUri().getScheme() == "file":
            return _link(aside.toUri().getPath(), target.toUri().getPath())
        return _rename(spark, files, aside, target)
    finally:
        files.delete(aside, False)


def _link(source: str, target: str) -> bool:
    try:
        os.link(source, target)
    except FileExistsError:
        return False
    return True


def _rename(spark: SparkSession, files, source, target) -> bool:
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), files.getConf())
    try:
        context.rename(files.makeQualified(source), files.makeQualified(target), options)
    except Py4JJavaError as problem:
        if "FileAlreadyExistsException" in problem.java_exception.getClass().getName():
            return False
        raise
    return True


def read_claims(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(CLAIM).json(folder)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], CLAIM)


def take_block(spark: SparkSession, folder: str, key: str, rows: int = 1, at: str | None = None,
               least: int = 1) -> Row:
    """The block of ``rows`` numbers that ``key`` owns: its old one, else the next free one from ``least`` on.

    Blocks follow each other without a gap unless ``least`` is beyond the last one.
    """
    while True:
        claims = read_claims(spark, folder)
        mine = F.col("key") == key
        # One row: the key's claim, and the end of the last block.
        state = claims.agg(
            F.first(F.when(mine, F.struct(*CLAIM.fieldNames())), ignorenulls=True).alias("own"),
            F.coalesce(F.max("place"), F.lit(-1)).alias("place"), F.max(F.col("first") + F.col("rows")).alias("end"),
        ).first()
        if state["own"] is not None:
            if state["own"]["rows"] != rows:
                raise ValueError(f"{key} was claimed with {state['own']['rows']} rows and comes back with {rows}")
            return state["own"]
        claim = Row(place=state["place"] + 1, key=key, first=max(least, state["end"] or least), rows=rows, at=at)
        if create_once(spark, f"{folder.rstrip('/')}/{claim.place:012d}.json", json.dumps(claim.asDict())):
            return claim
