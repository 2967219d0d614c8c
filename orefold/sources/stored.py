"""Tables that a run writes once and reads several times, in the folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """This application's folder, which the driver and all executors see. Only a session on one machine may leave the setting open."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="orefold-")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/{spark.sparkContext.applicationId}"


def fresh(spark: SparkSession, name: str) -> str:
    """The path of a new table; nothing is written yet."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df``, written as Parquet and read back; ``by``: columns of few values that become folders, so that a filter on them reads only its own (an
    empty text among them comes back as NULL)."""
    path = fresh(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
