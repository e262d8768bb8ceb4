"""Exports: Parquet tables of cliques, graph files, training rows, compressed text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPENDIUM_SCHEMA = "type STRING, ic DOUBLE, identifiers ARRAY<STRUCT<i: STRING, l: STRING, d: ARRAY<STRING>, t: ARRAY<STRING>>>, preferred_name STRING, taxa ARRAY<STRING>"
SYNONYM_SCHEMA = "curie STRING, names ARRAY<STRING>, types ARRAY<STRING>, preferred_name STRING, shortest_name_length INT, clique_identifier_count INT, curie_suffix BIGINT, taxa ARRAY<STRING>"


def clique_tables(records: DataFrame) -> dict[str, DataFrame]:
    """``records``: filename and the columns of the compendium record. The tables Clique, Edge and Node."""
    lead = F.get("identifiers", F.lit(0))["i"]
    base = records.where(F.size("identifiers") > 0)
    each = base.select("filename", lead.alias("clique_leader"), F.explode("identifiers").alias("x"))
    return {
        "Clique": base.select("filename", lead.alias("clique_leader"), "preferred_name", F.size("identifiers").alias("clique_identifier_count"), F.col("type").alias("biolink_type"), F.col("ic").cast("float").alias("information_content")),
        "Edge": each.select("filename", "clique_leader", F.col("x.i").alias("curie"), F.lit("None").alias("conflation")),
        "Node": each.select("filename", F.col("x.i").alias("curie"), F.col("x.l").alias("label"), F.lower("x.l").alias("label_lc"), F.col("x.d").alias("description")),
    }


def synonym_table(docs: DataFrame) -> DataFrame:
    """One row per name of a synonym document, with lower-cased copies."""
    return docs.select(
        "filename", F.col("curie").alias("clique_leader"), "preferred_name", F.lower("preferred_name").alias("preferred_name_lc"), F.concat(F.lit("biolink:"), F.get("types", F.lit(0))).alias("biolink_type"), F.explode("names").alias("label")
    ).withColumn("label_lc", F.lower("label"))


def write_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Parquet below ``root``, a folder per table, partitioned by filename; an existing table is an error."""
    for name, df in tables.items():
        df.write.partitionBy("filename").mode("error").parquet(f"{root}/{name}")


def graph_nodes(members: DataFrame, names: DataFrame, types: DataFrame) -> DataFrame:
    """``members``: clique, pos, curie. id, name, category, equivalents (in clique order, joined by ``|``): a node per clique."""
    g = members.groupBy("clique").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "curie"))), lambda x: x["curie"]), "|").alias("equivalents"), F.min_by("curie", "pos").alias("id"))
    return g.join(names, "clique", "left").join(types, "clique", "left").select("id", F.col("preferred_name").alias("name"), F.col("type").alias("category"), "equivalents")


def same_as_edges(members: DataFrame, filename: str) -> DataFrame:
    """id, subject, predicate, object for each unordered pair of a clique's members (i before j); id is an MD5 of both and the file.

    The pairs are the export's own definition. A clique's later members are matched to its earlier ones in a join, so
    large cliques spread over tasks.
    """
    later = members.select("clique", F.col("pos").alias("q"), F.col("curie").alias("object"))
    both = members.select("clique", "pos", F.col("curie").alias("subject")).join(later, "clique").where("pos < q")
    return both.select(F.md5(F.concat("subject", "object", F.lit(filename))).alias("id"), "subject", F.lit("biolink:same_as").alias("predicate"), "object")


def training_pairs(docs: DataFrame, most: int = 50) -> DataFrame:
    """``docs``: curie, type, preferred_name, names. curie, line: ``type||curie||name||synonym||synonym`` in lower case names, runs of
    pipes collapsed to one inside a name.

    No name: nothing. One distinct name: a row with it twice. Else pairs of distinct names, at most ``most`` per document,
    evenly spread over all pairs from a start that its identifier decides (the sampling is the export's own feature). Pairs are
    numbered and only the chosen numbers are made into rows.
    """
    clean = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\|\|+", "|")))
    d = docs.where("preferred_name IS NOT NULL AND preferred_name <> ''").withColumn("n", F.array_sort(F.array_distinct(F.filter(F.transform("names", clean), lambda x: x.isNotNull() & (x != "")))))
    d = d.where(F.size("n") > 0).select("curie", "type", "preferred_name", "n", F.size("n").cast("bigint").alias("k"), F.expr("size(n) * (size(n) - 1L) div 2").alias("pairs"))
    d = d.withColumn("step", F.greatest(F.lit(1).cast("bigint"), F.expr(f"pairs div {most}")))
    d = d.withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), F.least("pairs", F.lit(most).cast("bigint"))) - 1)))
    number = F.when(F.col("pairs") > 0, F.pmod(F.pmod(F.xxhash64("curie"), F.col("pairs")) + F.col("j") * F.col("step"), F.col("pairs")))
    d = d.withColumn("number", number)
    # pair (a, b), a < b, number a * (2k - a - 1) / 2 + (b - a - 1)
    guess = F.floor(((2 * F.col("k") - 1) - F.sqrt((2 * F.col("k") - 1) * (2 * F.col("k") - 1) - 8 * F.col("number"))) / 2)
    before = lambda a: a * (2 * F.col("k") - a - 1) / 2
    d = d.withColumn("g", guess).withColumn("a", F.when(before(F.col("g")) > F.col("number"), F.col("g") - 1).when(before(F.col("g") + 1) <= F.col("number"), F.col("g") + 1).otherwise(F.col("g")))
    b = (F.col("number") - before(F.col("a"))).cast("bigint") + F.col("a") + 1
    first, second = F.get("n", F.coalesce("a", F.lit(0)).cast("int")), F.get("n", F.coalesce(b, F.lit(0)).cast("int"))
    return d.select("curie", F.concat_ws("||", "type", "curie", clean(F.col("preferred_name")), first, second).alias("line"))


def write_json_lines(df: DataFrame, path: str, compressed: bool = True) -> None:
    df.write.option("compression", "gzip" if compressed else "none").json(path)


def gzip_text(df: DataFrame, path: str) -> None:
    df.write.option("compression", "gzip").text(path)
