"""Tables hashed by key into folders, so that a merge rewrites only the folders its keys fall in.

A table is a folder with

* ``data/<version>/bucket=<n>``: Parquet files of the rows of one bucket, never changed once written;
* ``manifest``: one small file a commit, with a row for each bucket that it replaced: commit, bucket, path, n_rows, label. The
  path of a bucket is the one of its greatest commit, so a commit takes effect when its one file appears and readers see the
  table before it or after it, never between.

The number of buckets is chosen when the table is made; a row's bucket is a hash of its key, with NULL as a value.
Folders that no commit names any more can be removed by whoever knows that nobody reads them (``unused``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.merge import latest, same_keys

MANIFEST = "commit bigint, buckets int, bucket int, path string, n_rows bigint, label string"


@dataclass(frozen=True)
class Keyed:
    """A table of ``schema`` at ``where``; of one key's rows the first by ``order`` is kept, of rows that the order can't tell apart the one that came first."""

    spark: SparkSession
    where: str
    schema: StructType
    keys: tuple[str, ...]
    order: tuple[Column, ...]
    buckets: int = 64

    def _manifest(self) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.where}/manifest")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.where}/manifest")

    def commits(self) -> DataFrame:
        """commit, label, the buckets it replaced and their rows."""
        return self._manifest().groupBy("commit", "label").agg(F.count("bucket").alias("n_buckets"), F.sum("n_rows").alias("n_rows"))

    def files(self) -> dict[int, str]:
        """The path of each bucket; as many as the table has buckets at most."""
        rows = self._manifest().groupBy("bucket").agg(F.max_by(F.struct("path", "n_rows", "buckets"), "commit").alias("last")).select("bucket", "last.*").collect()
        if any(r.buckets != self.buckets for r in rows):
            raise ValueError(f"the table was made with other than {self.buckets} buckets")
        return {r.bucket: r.path for r in rows if r.n_rows}

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The table, or the rows of some buckets."""
        paths = [p for b, p in self.files().items() if buckets is None or b in set(buckets)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """Rows whose key ``wanted`` has; only these keys' folders are read."""
        asked = wanted.select(*self.keys).distinct()
        old = self.read(self._touched(asked))
        return old.join(asked, same_keys(old, asked, list(self.keys)), "left_semi")

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r.b for r in rows.select(self.bucket().alias("b")).distinct().collect()]

    def merge(self, rows: DataFrame, label: str = "") -> int:
        """Brings rows in and returns how many folders were replaced; rows that change nothing, such as those of a batch that runs again, replace none.

        ``rows`` is read three times (its buckets, its winners, the writing), so what is dear to compute should be stored. New rows meet
        the old ones of their buckets to find those that win; then only the folders of winners are written.
        """
        known = self.files()
        rows = rows.select(*self.schema.names)
        touched = self._touched(rows)
        old = self.read([b for b in touched if b in known])
        both = old.withColumn("__new", F.lit(0)).unionByName(rows.withColumn("__new", F.lit(1))).withColumn("__bucket", self.bucket()).repartition("__bucket")
        first = Window.partitionBy("__bucket", *self.keys).orderBy(*self.order, "__new")
        ranked = both.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")
        changed = [r.b for r in ranked.where("__new = 1").select(F.col("__bucket").alias("b")).distinct().collect()]
        if not changed:
            return 0
        kept = ranked if len(changed) == len(touched) else ranked.where(F.col("__bucket").isin(changed))
        self._commit(kept.drop("__new").withColumnRenamed("__bucket", "bucket"), changed, label)
        return len(changed)

    def replace(self, rows: DataFrame, label: str = "") -> int:
        """The table becomes ``rows``, one per key; every folder is written."""
        once = latest(rows.select(*self.schema.names), list(self.keys), list(self.order)).withColumn("bucket", self.bucket()).repartition("bucket")
        self._commit(once, list(range(self.buckets)), label)
        return self.buckets

    def _commit(self, rows: DataFrame, buckets: list[int], label: str) -> None:
        version = f"{self.where}/data/{uuid.uuid4().hex}"
        rows.write.partitionBy("bucket").parquet(version)
        written = self.spark.read.schema(StructType([*self.schema.fields, StructField("bucket", IntegerType())])).parquet(version)
        counts = {r.bucket: r.n for r in written.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        last = self._manifest().agg(F.max("commit")).first()[0] or 0
        entries = [(last + 1, self.buckets, b, f"{version}/bucket={b}", counts.get(b, 0), label) for b in buckets]
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.where}/manifest")

    def unused(self) -> list[str]:
        """Folders that a later commit has replaced."""
        current = set(self.files().values())
        return [r.path for r in self._manifest().select("path").distinct().collect() if r.path not in current]
