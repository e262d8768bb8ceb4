"""Files and bucketed tables at paths of their own, on whatever file system the path names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> set[str]:
    fs, p = _at(spark, path)
    return {f.getPath().getName() for f in fs.listStatus(p)}


def read(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace(spark: SparkSession, path: str, text: str) -> None:
    """A small file written beside its old version and renamed into its place."""
    fs, p = _at(spark, path)
    _, new = _at(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(new, p):
        raise OSError(f"cannot rename {new} to {path}")


def read_bucketed(spark: SparkSession, schema: StructType, path: str, buckets: int, key: str) -> DataFrame:
    """Files that ``write_bucketed`` wrote, as a table that knows its buckets."""
    name = f"bucketed_{uuid.uuid4().hex}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry only: the files lie at a path of their own
    return out


def write_bucketed(spark: SparkSession, df: DataFrame, path: str, buckets: int, key: str, first: tuple[str, ...] = ()) -> DataFrame:
    """One file per bucket, sorted by ``first`` and the key; a join on the key with as many partitions needs no shuffle of this side."""
    name = f"bucketed_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(*first, key).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out
