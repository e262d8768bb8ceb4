"""Session helpers: where intermediate tables live, how they are written and dropped."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tessellon import files


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    ``spark.checkpoint.dir`` is read from the session. Only where it is unset (tests, one machine)
    a folder of our own is made and set as the checkpoint folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    found = spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    found = "file://" + tempfile.mkdtemp(prefix="tessellon-")
    spark.sparkContext.setCheckpointDir(found)
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Scratch:
    """Tables written below the shared folder; a lost executor only costs a read of the files.

    The tables stay as long as a result may read them. ``close``, or the end of a ``with`` block in which the result is
    written, removes them all.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.id = f"{label}_{uuid.uuid4().hex[:12]}"
        self.root = f"{shared_dir(spark).rstrip('/')}/tessellon/{self.id}"

    def write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        (df.write.partitionBy(by) if by else df.write).mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, name: str, buckets: int, key: str, first: tuple[str, ...] = ()) -> DataFrame:
        return files.write_bucketed(self.spark, df, f"{self.root}/{name}", buckets, key, first)

    def close(self) -> None:
        files.delete(self.spark, self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def drop(self, name: str) -> None:
        """Delete a table that nothing will read again."""
        files.delete(self.spark, f"{self.root}/{name}")
