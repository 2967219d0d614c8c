"""A log of runs, only ever added to, that tells the next run where to begin and readers which table is current.

A run is ``started``, then ``completed`` or ``failed``. The row that completes it names the table that it wrote, so what is published and where the next run
begins change together, with one file. A run that was interrupted has only started: nothing of it is seen, and it is done again; one that is completed is not.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "name string, run string, status string, started_at timestamp, logged_at timestamp, path string, message string"


class RunLog:
    """The log at ``where``, for runs of any number of names."""

    def __init__(self, spark: SparkSession, where: str):
        self.spark, self.where = spark, where

    def entries(self) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.where}/log")
        there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(ENTRY).parquet(f"{self.where}/log") if there else self.spark.createDataFrame([], ENTRY)

    def _add(self, name: str, run: str, status: str, started: dt.datetime, path: str | None = None, message: str | None = None) -> None:
        self.spark.createDataFrame([(name, run, status, started, dt.datetime.now(), path, message)], ENTRY).coalesce(1).write.mode("append").parquet(f"{self.where}/log")

    def states(self) -> DataFrame:
        """name, run, status (the latest), started_at, path; a completed run stays completed."""
        order = F.struct((F.col("status") == "completed").alias("done"), F.col("logged_at"), (F.col("status") != "started").alias("ended"))
        last = F.max_by(F.struct("status", "started_at", "path", "message"), order).alias("last")
        return self.entries().groupBy("name", "run").agg(last).select("name", "run", "last.*")

    def last(self, name: str) -> tuple[dt.datetime, str] | None:
        """When the last completed run started, and the table that it published."""
        done = self.states().where((F.col("name") == name) & (F.col("status") == "completed"))
        row = done.agg(F.max_by(F.struct("started_at", "path"), F.struct("started_at", "run")).alias("last")).first().last
        return None if row is None else (row.started_at, row.path)

    def current(self, name: str) -> DataFrame:
        known = self.last(name)
        if known is None:
            raise ValueError(f"no run of {name} is completed")
        return self.spark.read.parquet(known[1])

    def run(self, name: str, run: str, work: Callable[[dt.datetime | None, DataFrame | None], DataFrame], *, started: dt.datetime | None = None) -> bool:
        """Runs ``work(since, current)`` and publishes what it returns; False where this run is completed already. ``since`` is when the last completed run started,
        so that what came in while it ran is seen now."""
        if not self.states().where((F.col("name") == name) & (F.col("run") == run) & (F.col("status") == "completed")).isEmpty():
            return False
        known = self.last(name)
        started = started or dt.datetime.now()
        self._add(name, run, "started", started)
        path = f"{self.where}/{name}/{uuid.uuid4().hex}"
        try:
            work(*((None, None) if known is None else (known[0], self.spark.read.parquet(known[1])))).write.parquet(path)
        except Exception as e:
            self._add(name, run, "failed", started, message=str(e)[:2000])
            raise
        self._add(name, run, "completed", started, path)
        return True
