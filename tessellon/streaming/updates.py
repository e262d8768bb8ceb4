"""Update files in order, as a file stream: the last title of an article holds, its statuses are united.

The table is kept in buckets of the article's identifier. A micro-batch reads and writes only the buckets it
touches; a manifest, replaced when the batch is complete, says which folder holds each bucket and which batches
are in. A batch that comes again after a failure changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellon import files

SCHEMA = "file_seq INT, pos INT, pmid STRING, title STRING, status STRING"
STATE = "pmid STRING, last STRUCT<has: BOOLEAN, file_seq: INT, pos: INT, title: STRING>, statuses ARRAY<STRING>, bucket INT"
BUCKETS = 256


def read_updates(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def merge(old: DataFrame | None, batch: DataFrame) -> DataFrame:
    """One row per article: title of the greatest (file_seq, pos) and the sorted distinct statuses.

    Merging is associative: files may come in any split and order. Rows without an id are nothing.
    """
    new = batch.where("pmid IS NOT NULL").select("pmid", F.struct(F.col("title").isNotNull().alias("has"), "file_seq", "pos", "title").alias("last"), F.array_compact(F.array("status")).alias("statuses"))
    rows = new if old is None else old.select("pmid", "last", "statuses").unionByName(new)
    return rows.groupBy("pmid").agg(F.max("last").alias("last"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("statuses")))).alias("statuses"))


def _manifest(spark: SparkSession, target: str) -> dict:
    path = f"{target}/MANIFEST"
    return json.loads(files.read(spark, path)) if files.exists(spark, path) else {"buckets": BUCKETS, "at": {}, "done": {}, "old": []}


def _rows(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.schema(STATE).parquet(*folders) if folders else spark.createDataFrame([], STATE)


def upsert(spark: SparkSession, target: str, batch: DataFrame, epoch: int, stream: str) -> None:
    """Merge a micro-batch into the table below ``target``. ``stream`` names the query whose epochs are counted."""
    m = _manifest(spark, target)
    if m["done"].get(stream, -1) >= epoch:
        return
    bucket = F.pmod(F.xxhash64("pmid"), F.lit(m["buckets"])).cast("int")
    touched = [r["bucket"] for r in batch.where("pmid IS NOT NULL").select(bucket.alias("bucket")).distinct().collect()]  # as many as there are buckets
    folder = f"{target}/{uuid.uuid4().hex}"
    outdated = [m["at"][str(b)] for b in touched if str(b) in m["at"]]
    if touched:
        merged = merge(_rows(spark, outdated), batch).withColumn("bucket", bucket)
        # the bucket stands in the rows and, as a folder, beside them
        merged.withColumn("b", F.col("bucket")).repartition("b").write.partitionBy("b").parquet(folder)
    m["at"] |= {str(b): f"{folder}/b={b}" for b in touched}
    gone, m["old"] = m["old"], outdated  # deleted one batch later, when nobody who read the last manifest needs them
    m["done"][stream] = epoch
    files.replace(spark, f"{target}/MANIFEST", json.dumps(m))
    for f in gone:
        files.delete(spark, f)


def start(updates: DataFrame, target: str, checkpoint: str):
    """Upsert each micro-batch in the table below ``target``; a table may be fed by several streams, one after the other."""
    spark = updates.sparkSession
    return updates.writeStream.foreachBatch(lambda batch, epoch: upsert(spark, target, batch, epoch, checkpoint)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def table(spark: SparkSession, target: str) -> DataFrame:
    return _rows(spark, list(_manifest(spark, target)["at"].values()))


def titles(rows: DataFrame) -> DataFrame:
    return rows.select("pmid", F.col("last.title").alias("title"), "statuses")
