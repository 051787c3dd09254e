"""Crawl tables as snapshots in buckets by key, of which a change rewrites only those that it falls in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Snapshot:
    """A table in a folder, hash-partitioned by ``keys`` into ``buckets``; a bucket is to fit a task, so their number goes with the table's size."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 256):
        self.spark, self.path, self.keys, self.buckets = spark, path, keys, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def write(self, table: DataFrame) -> None:
        """Replaces the buckets that ``table`` has rows of, when all new files are there."""
        dealt = table.withColumn("bucket", self.bucket()).repartition("bucket")
        out = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        out.partitionBy("bucket").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("bucket")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that rows of these keys fall in: as many numbers as there are buckets at most."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("bucket")).distinct().collect())

    def change(self, rows: DataFrame, make: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Rewrites the buckets that ``rows`` fall in: ``make`` takes their part of the table and gives the next. Other buckets keep their files.

        ``make`` may add rows of the keys of ``rows``, and leaves none of a bucket without rows. Returns the buckets.
        """
        hit = self.touched(rows)
        if hit:
            part = self.spark.read.parquet(self.path).where(F.col("bucket").isin(hit)).drop("bucket")
            self.write(make(part).select(*part.columns))
        return hit
