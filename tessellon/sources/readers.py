"""Readers of the intermediate tables: text with explicit columns, JSON lines with explicit schemas.

Lines are read as text and split, as trailing empty fields must not change the column count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str, encoding: str = "UTF-8", sep: str | None = None) -> DataFrame:
    """seq, value: the lines of a text file (gzip by its ending) with an order that follows the file.

    ``sep`` parts records other than lines. The order comes from the file's splits as read, before any shuffle.
    """
    if encoding.upper() != "UTF-8":
        raw = spark.read.format("csv").option("encoding", encoding).option("sep", "\x01").option("quote", "").option("escape", "").schema("value STRING").load(path)
    else:
        reader = spark.read.option("lineSep", sep) if sep else spark.read
        raw = reader.text(path)
    return raw.select(F.monotonically_increasing_id().alias("seq"), "value")


def fields(rows: DataFrame, *names: str, sep: str = "\t", at_least: int | None = None) -> DataFrame:
    """seq and the named leading fields of each line; lines with fewer than ``at_least`` fields are skipped, others give nulls."""
    parts = F.split("value", "\\" + sep if sep in "|." else sep, -1)
    kept = rows.withColumn("_f", parts)
    if at_least:
        kept = kept.where(F.size("_f") >= at_least)
    return kept.select("seq", *[F.get("_f", F.lit(i)).alias(n) for i, n in enumerate(names)])


def labels(spark: SparkSession, path: str) -> DataFrame:
    return fields(lines(spark, path), "curie", "label")


def synonyms(spark: SparkSession, path: str) -> DataFrame:
    """Three columns are needed; lines with fewer are skipped."""
    return fields(lines(spark, path), "curie", "predicate", "synonym", at_least=3)


def descriptions(spark: SparkSession, path: str) -> DataFrame:
    """All after the first tab is the text, tabs included."""
    i = F.instr("value", "\t")
    return lines(spark, path).where(i > 0).select("seq", F.substr("value", F.lit(1), i - 1).alias("curie"), F.substr("value", i + 1).alias("description"))


def taxa(spark: SparkSession, path: str) -> DataFrame:
    return fields(lines(spark, path), "curie", "taxon", at_least=2)


def identifiers(spark: SparkSession, path: str, file_seq: int = 0) -> DataFrame:
    return fields(lines(spark, path), "curie", "type").withColumn("file_seq", F.lit(file_seq))


def concord(spark: SparkSession, path: str, file_seq: int = 0) -> DataFrame:
    return fields(lines(spark, path), "subject", "predicate", "object", at_least=3).withColumn("file_seq", F.lit(file_seq))


def prefix_ranks(spark: SparkSession, path: str) -> DataFrame:
    """``type``, ``prefix``, best first: type, prefix, rank from 0. A model's table of valid prefixes, as ``nodes.ordered_members`` takes it."""
    rows = fields(lines(spark, path), "type", "prefix", at_least=2)
    first = rows.groupBy("type", "prefix").agg(F.min("seq").alias("seq"))
    return first.select("type", "prefix", (F.row_number().over(Window.partitionBy("type").orderBy("seq")) - 1).alias("rank"))  # a static table


def type_tree(spark: SparkSession, path: str) -> DataFrame:
    """``type``, ``parent`` (or mix-in): a model's tree, as ``nodes.ancestors`` takes it."""
    return fields(lines(spark, path), "type", "parent", at_least=2).select("type", "parent").distinct()


def scores(spark: SparkSession, path: str) -> DataFrame:
    return fields(lines(spark, path), "iri", "ic", at_least=2).withColumn("ic", F.col("ic").try_cast("double"))


def properties(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("curie STRING, predicate STRING, value STRING, source STRING").option("mode", "FAILFAST").json(path)


def common_synonyms(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("curie STRING, predicate STRING, synonym STRING").json(path)


def common_descriptions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("curie STRING, descriptions ARRAY<STRING>").json(path).select("curie", F.explode("descriptions").alias("description"))


def compendium(spark: SparkSession, path: str) -> DataFrame:
    """Missing nested fields read as null."""
    from tessellon.sources.sinks import COMPENDIUM_SCHEMA

    return spark.read.schema(COMPENDIUM_SCHEMA).json(path)


def synonym_docs(spark: SparkSession, path: str) -> DataFrame:
    from tessellon.sources.sinks import SYNONYM_SCHEMA

    return spark.read.schema(SYNONYM_SCHEMA).json(path)


def conflation(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of leaders per line. clique (the first), pos, curie."""
    a = F.from_json("value", "array<string>")
    return spark.read.text(path).select(F.get(a, F.lit(0)).alias("clique"), F.posexplode(a).alias("pos", "curie"))


def manual_concord(spark: SparkSession, path: str) -> DataFrame:
    """Comments and blank lines are skipped; any other line must have three columns."""
    rows = lines(spark, path).where(~F.trim("value").startswith("#") & (F.trim("value") != ""))
    n = F.size(F.split("value", "\t", -1))
    rows = rows.withColumn("value", F.when(n == 3, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not three columns: "), "value"))))
    return fields(rows, "subject", "predicate", "object")


def headed(spark: SparkSession, path: str, expected: list[str], sep: str = "\t", **options: str) -> DataFrame:
    """A table with a header that must be exactly ``expected``."""
    df = spark.read.options(**options).option("header", True).option("sep", sep).csv(path)
    if df.columns != expected:
        raise ValueError(f"header is {df.columns}, not {expected}")
    return df


def md5_mismatches(spark: SparkSession, folder: str, pattern: str = "*.gz") -> DataFrame:
    """Files whose MD5 is not the one in their ``.md5`` file, or that have none: path, found, stated."""
    got = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", F.md5("content").alias("found"))
    said = spark.read.format("binaryFile").option("pathGlobFilter", pattern + ".md5").load(folder)
    said = said.select(F.regexp_replace("path", r"\.md5$", "").alias("path"), F.regexp_extract(F.col("content").cast("string"), r"\b([0-9a-f]{32})\b", 1).alias("stated"))
    return got.join(said, "path", "left").where(~F.col("found").eqNullSafe(F.col("stated")))


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def project_ids(rows: DataFrame, type_name: str) -> DataFrame:
    """First white-space field of each line, with a fixed type."""
    return rows.select("seq", F.get(F.split(F.trim("value"), r"\s+"), F.lit(0)).alias("curie"), F.lit(type_name).alias("type")).where("curie <> ''")
