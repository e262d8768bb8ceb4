"""Queries of the general data operators, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellon.functions.curie import not_blank, plain_curie, plain_value
from tessellon.operators import badrows, nested, orphans, skew, snapshots
from tessellon.session import Scratch, shuffle_partitions, table

RELEASES = ("2024mar24", "2024jul13", "2024oct24", "2025jan23", "2025mar31")


def _nested_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return nested.shred(table(spark, d, "compendium_jsonl"), "line_id", "raw_line", nested.COMPENDIUM)


NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """One row per child of a line, out of the rows of the flat tables."""
    rows = nested.shred_rows(table(spark, d, "compendium_jsonl"), "line_id", "raw_line", nested.COMPENDIUM)
    element, ic = F.col("x.element"), F.try_variant_get("x.v", "$.ic", "string")
    rows = rows.where((element != "record") | ic.rlike(NUMERIC))
    pos = F.when(element == "identifier", F.col("x.pos")).when(element == "record", -1).otherwise(F.col("x.parent_pos"))
    place = F.when(element.isin("record", "identifier"), 0).otherwise(F.col("x.pos"))
    return rows.select(F.col("_key").alias("line_id"), pos.alias("pos"), F.when(element == "record", "ic").otherwise(F.col("x.kind")).alias("child_kind"), place.alias("ord"))


def p2_identifiers(spark: SparkSession, d: str) -> DataFrame:
    """The identifier table: curie and label of every member of every line, in both shapes."""
    t = _nested_tables(spark, d)["identifier"]
    return t.select("line_id", "pos", F.coalesce("i", "identifier", "value").alias("curie"), F.coalesce("l", "label").alias("label"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return badrows.failed_rows(_parsed(spark, d)).select("line_id", "reason")


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return badrows.parse_lines(table(spark, d, "raw_lines"), table(spark, d, "known_predicates"))


def p3_synonyms(spark: SparkSession, d: str) -> DataFrame:
    return badrows.valid_rows(_parsed(spark, d), badrows.SYNONYMS)


def p3_drugchemical(spark: SparkSession, d: str) -> DataFrame:
    return badrows.valid_rows(_parsed(spark, d), badrows.DRUGCHEMICAL)


def p3_edits(spark: SparkSession, d: str) -> DataFrame:
    """Failed lines with the reason and the fewest edits that would make them readable."""
    return badrows.failed_rows(_parsed(spark, d)).select("line_id", "reason", F.array_join("edits", "; ").alias("edits"))


def _changes(spark: SparkSession, d: str, fetch: bool) -> DataFrame:
    rows = table(spark, d, "release_counts").where(F.col("count_path").isNotNull()).select("release_tag", "count_path", "delivered_at", "row_id", snapshots.whole_number("cnt").alias("n"))
    last = snapshots.latest(rows, ["release_tag", "count_path"], ["delivered_at", "row_id"])
    return snapshots.changes(last, "release_tag", list(RELEASES), "count_path", ["n"], Scratch(spark, "p4"), fetch)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _changes(spark, d, fetch=False)


def p4_values(spark: SparkSession, d: str) -> DataFrame:
    """The changes with the old and the new count."""
    return _changes(spark, d, fetch=True).withColumns({c: F.col(c).cast("bigint") for c in ("old_n", "new_n")})


def _canonical_type(c: str):
    t = F.btrim(F.col(c))
    return F.when(t.startswith("biolink:"), t).otherwise(F.concat(F.lit("biolink:"), t))


def _leader_counts(spark: SparkSession, d: str) -> DataFrame:
    edge = table(spark, d, "edge").select(plain_value("clique_leader").alias("key_value"), plain_value("curie").alias("member"))
    return skew.distinct_per_key(edge, "key_value", "member", shuffle_partitions(spark)).select(F.lit("edge.clique_leader").alias("field_name"), "key_value", "n")


def _type_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "clique").where(not_blank("biolink_type")).select(_canonical_type("biolink_type").alias("key_value"), plain_value("clique_leader").alias("member"))
    return skew.distinct_per_key(rows, "key_value", "member", shuffle_partitions(spark)).select(F.lit("clique.biolink_type").alias("field_name"), "key_value", "n")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The heavy keys: at least a hundredth of the field's distinct pairs."""
    scratch, found = Scratch(spark, "p5"), []
    for name, counts in (("edge", _leader_counts(spark, d)), ("clique", _type_counts(spark, d))):
        counts = scratch.write(counts, name)
        total = counts.agg(F.sum("n")).first()[0] or 0
        found.append(counts.where(F.col("n") * 100 >= total).select("field_name", "key_value"))
    return found[0].unionByName(found[1])


def p5_per_key(spark: SparkSession, d: str) -> DataFrame:
    """Distinct members of every leader and distinct leaders of every type."""
    return _leader_counts(spark, d).unionByName(_type_counts(spark, d)).withColumnRenamed("n", "pairs")


def p5_leader_types(spark: SparkSession, d: str) -> DataFrame:
    """Edges joined with their leader's clique types, per type: the join is uneven on the leader."""
    edge = table(spark, d, "edge").select("row_id", plain_curie("clique_leader").alias("leader")).where(F.col("leader").isNotNull())
    types = table(spark, d, "clique").where(not_blank("biolink_type")).select(plain_curie("clique_leader").alias("leader"), _canonical_type("biolink_type").alias("type")).distinct()
    both = skew.join_balanced(edge, types, "leader", "leader", ["row_id"], shuffle_partitions(spark))
    return both.groupBy("type").agg(F.count("*").alias("edges"))


def _references(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for tbl, field in (("edge", "curie"), ("drugchemical", "subject"), ("drugchemical", "object")):
        rows = table(spark, d, tbl).where(not_blank(field)).select(
            plain_curie(field).alias("_key"), F.col("loaded_at").cast("timestamp_ntz").alias("_ts"), F.lit(tbl).alias("tbl"), "row_id", F.lit(field).alias("field_name"), "release_tag"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "ids").select(plain_curie("curie").alias("_key"), F.col("registered_at").cast("timestamp_ntz").alias("_start"), F.col("retired_at").cast("timestamp_ntz").alias("_end"))
    return orphans.orphans(_references(spark, d), ids, Scratch(spark, "p7"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table, field and release."""
    return p7_found(spark, d).groupBy("tbl", "field_name", "release_tag", "orphan_state").agg(F.count("*").alias("refs"))


QUERIES = {f.__name__: f for f in (p2_found, p2_identifiers, p3_found, p3_synonyms, p3_drugchemical, p3_edits, p4_found, p4_values, p5_found, p5_per_key, p5_leader_types, p7_found, p7_report)}
