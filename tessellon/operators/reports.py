"""Quality reports over cliques, edges and releases."""

from __future__ import annotations

import itertools
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellon import files
from tessellon.functions.curie import prefix
from tessellon.operators.nested import parsed

SEP = "||"


def _joined(c, distinct: bool = True):
    items = F.collect_set(c) if distinct else F.collect_list(c)
    return F.array_join(F.array_sort(items), SEP)


def identically_labelled(cliques: DataFrame, left_out: tuple[str, ...] = (), name: str = "preferred_name") -> DataFrame:
    """Names (lower case) of more than one clique: name_lc, clique_count, leaders (distinct), filenames and biolink_types (distinct,
    sorted, joined by ``||``: as many as there are files and types). Blank names are none."""
    rows = cliques.where(F.col(name).isNotNull() & (F.trim(name) != "") & ~F.coalesce(F.col("filename").isin(*left_out), F.lit(False)))
    g = rows.groupBy(F.lower(name).alias("name_lc")).agg(F.count("*").alias("clique_count"), F.count_distinct("clique_leader").alias("leaders"), _joined("filename").alias("filenames"), _joined("biolink_type").alias("biolink_types"))
    return g.where("clique_count > 1")


def identically_labelled_rows(cliques: DataFrame, left_out: tuple[str, ...] = (), name: str = "preferred_name") -> DataFrame:
    """name_lc, clique_count, clique_leader, name, biolink_type: a row per clique, as stand-in names may be borne by any number."""
    some = identically_labelled(cliques, left_out, name).select("name_lc", "clique_count")
    rows = cliques.where(~F.coalesce(F.col("filename").isin(*left_out), F.lit(False))).withColumn("name_lc", F.lower(name))
    return rows.join(some, "name_lc").select("name_lc", "clique_count", "clique_leader", name, "biolink_type")


def duplicate_curies(edges: DataFrame) -> DataFrame:
    """curie, leaders, n: identifiers in cliques of more than one leader; n counts their rows, leaders the distinct ones."""
    return edges.where("curie IS NOT NULL AND clique_leader IS NOT NULL").groupBy("curie").agg(F.count_distinct("clique_leader").alias("leaders"), F.count("*").alias("n"), F.min("clique_leader").alias("first_leader"), F.max("clique_leader").alias("last_leader")).where("leaders > 1")


def duplicate_curie_rows(edges: DataFrame, cliques: DataFrame, conflation: str | None = None) -> DataFrame:
    """curie, clique_leader, filename, biolink_type, preferred_name: what holds each identifier of more than one clique, a row each, as
    any number of cliques may hold one; ``conflation`` keeps the edges of one conflation. Leaders without a clique row have no type or name."""
    e = edges.where("curie IS NOT NULL AND clique_leader IS NOT NULL")
    e = e.where(F.col("conflation") == conflation) if conflation is not None else e
    some = e.groupBy("curie").agg(F.count_distinct("clique_leader").alias("n")).where("n > 1").select("curie")
    held = e.select("curie", "clique_leader", "filename").distinct().join(some, "curie", "left_semi")
    facts = cliques.select("clique_leader", "biolink_type", "preferred_name").distinct()
    return held.join(facts, "clique_leader", "left").select("curie", "clique_leader", "filename", "biolink_type", "preferred_name")


def duplicate_leaders(cliques: DataFrame, strict: bool = False) -> DataFrame:
    """Leaders in more than one clique row. ``strict`` counts the distinct leaders of a leader, so nothing ever comes out."""
    n = F.count_distinct("clique_leader") if strict else F.count("*")
    return cliques.where("clique_leader IS NOT NULL").groupBy("clique_leader").agg(n.alias("n"), _joined("filename").alias("filenames")).where("n > 1")


def prefix_summary(edges: DataFrame) -> DataFrame:
    """prefix, curie_count, distinct_curies, distinct_leaders, files: the last a histogram by file, ``file=n`` joined by ``||``."""
    e = edges.where("curie IS NOT NULL").withColumn("prefix", F.coalesce(prefix("curie"), F.lit("")))
    totals = e.groupBy("prefix").agg(F.count("*").alias("curie_count"), F.count_distinct("curie").alias("distinct_curies"), F.count_distinct("clique_leader").alias("distinct_leaders"))
    by_file = e.groupBy("prefix", "filename").agg(F.count("*").alias("n")).groupBy("prefix").agg(_joined(F.concat_ws("=", F.coalesce("filename", F.lit("")), F.col("n").cast("string"))).alias("files"))
    return totals.join(by_file, "prefix")


def clique_prefix_report(edges: DataFrame) -> DataFrame:
    """leader_prefix, filename (null: all files; both null: everything), cliques, curies, histogram of member prefixes."""
    e = edges.where("curie IS NOT NULL AND clique_leader IS NOT NULL").select(
        F.coalesce(prefix("clique_leader"), F.lit("")).alias("leader_prefix"), F.coalesce("filename", F.lit("")).alias("filename"), F.coalesce(prefix("curie"), F.lit("")).alias("p"), "clique_leader"
    )
    level = F.grouping_id()
    sizes = e.rollup("leader_prefix", "filename").agg(level.alias("level"), F.count_distinct("clique_leader").alias("cliques"), F.count("*").alias("curies"))
    base = e.groupBy("leader_prefix", "filename", "p").agg(F.count("*").alias("n"))  # a row per file and pair of prefixes
    shares = None
    for lv, lead, file in ((0, F.col("leader_prefix"), F.col("filename")), (1, F.col("leader_prefix"), F.lit(None).cast("string")), (3, F.lit(None).cast("string"), F.lit(None).cast("string"))):
        part = base.groupBy(lead.alias("lp"), file.alias("fn"), "p").agg(F.sum("n").alias("n")).groupBy("lp", "fn").agg(_joined(F.concat_ws("=", "p", F.col("n").cast("string"))).alias("histogram")).withColumn("lv", F.lit(lv))
        shares = part if shares is None else shares.unionByName(part)
    out = sizes.join(shares, (F.col("level") == F.col("lv")) & F.col("leader_prefix").eqNullSafe(F.col("lp")) & F.col("filename").eqNullSafe(F.col("fn")))
    return out.select(F.col("level").cast("int").alias("level"), "leader_prefix", "filename", "cliques", "curies", "histogram")


def label_lengths(labels: DataFrame, label: str, order: str) -> DataFrame:
    """length, frequency, example: the example is the label of the first row (by ``order``) of that length."""
    return labels.where(F.col(label).isNotNull()).groupBy(F.length(label).alias("length")).agg(F.count("*").alias("frequency"), F.min_by(label, order).alias("example"))


def content_histograms(members: DataFrame, types: DataFrame) -> DataFrame:
    """``members``: clique, curie, label; ``types``: clique, type. measure, bucket, n: how many cliques have each type, size, number of
    labels and of distinct labels, and how many members each prefix has."""
    named = F.when(F.col("label").isNotNull() & (F.col("label") != ""), F.col("label"))
    per = members.groupBy("clique").agg(F.count("*").alias("ids"), F.count(named).alias("labels"), F.count_distinct(named).alias("unique_labels"))
    out = None
    for measure, df in (
        ("type", types.select(F.coalesce("type", F.lit("")).alias("bucket"))),
        ("prefix", members.select(F.coalesce(prefix("curie"), F.lit("")).alias("bucket"))),
        *[(m, per.select(F.col(m).cast("string").alias("bucket"))) for m in ("ids", "labels", "unique_labels")],
    ):
        part = df.groupBy("bucket").agg(F.count("*").alias("n")).select(F.lit(measure).alias("measure"), "bucket", "n")
        out = part if out is None else out.unionByName(part)
    return out


def sum_reports(reports: DataFrame, *keys: str) -> DataFrame:
    """Key-wise sum of histograms (keys, n) of several files."""
    return reports.groupBy(*keys).agg(F.sum("n").alias("n"))


def assert_files(spark: SparkSession, folder: str, expected: list[str]) -> None:
    """The folder holds exactly the files expected; leftovers of a network file system (``.nfs*``) do not count."""
    got = {f for f in files.names(spark, folder) if not f.startswith(".nfs")}
    if got != set(expected):
        raise AssertionError(f"missing: {sorted(set(expected) - got)}, unexpected: {sorted(got - set(expected))}")


def incomplete(ids: DataFrame, members: DataFrame) -> DataFrame:
    """Identifiers that no clique holds."""
    return ids.where("curie IS NOT NULL").select("curie").distinct().join(members.select("curie").distinct(), "curie", "left_anti")


def clique_sizes(members: DataFrame) -> DataFrame:
    """size, cliques."""
    return members.groupBy("clique").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("cliques"))


def clique_shapes(members: DataFrame) -> DataFrame:
    """shape (``prefix=n`` sorted, joined by ``||``), cliques: histogram of the multisets of prefixes."""
    per = members.groupBy("clique", F.coalesce(prefix("curie"), F.lit("")).alias("p")).agg(F.count("*").alias("n"))
    return per.groupBy("clique").agg(_joined(F.concat_ws("=", "p", F.col("n").cast("string"))).alias("shape")).groupBy("shape").agg(F.count("*").alias("cliques"))


def first_singles(members: DataFrame, wanted: str, n: int) -> DataFrame:
    """The first ``n`` cliques (by identifier) of one member with the prefix."""
    one = members.groupBy("clique").agg(F.count("*").alias("k"), F.min("curie").alias("curie")).where((F.col("k") == 1) & (prefix("curie") == wanted))
    return one.orderBy("curie", "clique").limit(n).select("clique", "curie")


def big_cliques(members: DataFrame, over: int, n: int) -> DataFrame:
    """The ``n`` largest cliques with more than ``over`` members."""
    return members.groupBy("clique").agg(F.count("*").alias("size")).where(F.col("size") > over).orderBy(F.desc("size"), "clique").limit(n)


def without_singles(members: DataFrame) -> DataFrame:
    kept = members.groupBy("clique").agg(F.count("*").alias("_n")).where("_n > 1").select("clique")
    return members.join(kept, "clique", "left_semi")


def concord_metadata(pairs: DataFrame) -> DataFrame:
    """measure, key, n: rows, distinct identifiers, rows per predicate and per unordered pair of prefixes. Rows with a null
    end are malformed and skipped."""
    good = pairs.where("subject IS NOT NULL AND object IS NOT NULL").withColumn("predicate", F.coalesce("predicate", F.lit("")))
    ps, po = prefix("subject"), prefix("object")
    return (
        good.agg(F.count("*").alias("n")).select(F.lit("rows").alias("measure"), F.lit("").alias("key"), "n")
        .unionByName(good.select(F.explode(F.array("subject", "object")).alias("c")).agg(F.count_distinct("c").alias("n")).select(F.lit("curies").alias("measure"), F.lit("").alias("key"), "n"))
        .unionByName(good.groupBy("predicate").agg(F.count("*").alias("n")).select(F.lit("predicate").alias("measure"), F.col("predicate").alias("key"), "n"))
        .unionByName(good.groupBy(F.concat_ws("-", F.least(ps, po), F.greatest(ps, po)).alias("key")).agg(F.count("*").alias("n")).select(F.lit("prefixes").alias("measure"), "key", "n"))
    )


def combined_metadata(name: str, parts: list[dict], **facts) -> str:
    """JSON of a result's inputs nested by name; names that repeat become lists."""
    inside: dict = {}
    for p in parts:
        key = p["name"]
        if key not in inside:
            inside[key] = p
        else:
            inside[key] = [*(inside[key] if isinstance(inside[key], list) else [inside[key]]), p]
    return json.dumps({"name": name, "combined_from": inside} | facts, sort_keys=True)


def flatten_counters(lines: DataFrame, json_col: str) -> DataFrame:
    """path, n: the leaves of nested JSON counters, keys joined by dots. Arrays and text are no counters."""
    step = lines.select(F.lit("").alias("path"), parsed(lines.sparkSession, json_col).alias("v")).where("v IS NOT NULL")
    out = None
    for level in itertools.count():
        inner = step.where(F.schema_of_variant("v").startswith("OBJECT")).select("path", F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("k", "v"))
        inner = inner.select(F.when(F.col("path") == "", F.col("k")).otherwise(F.concat_ws(".", "path", "k")).alias("path"), "v")
        leaves = inner.where(~F.schema_of_variant("v").startswith("OBJECT")).select("path", F.try_variant_get("v", "$", "bigint").alias("n")).where("n IS NOT NULL")
        out = leaves if out is None else out.unionByName(leaves)
        step = inner
        if level > 4 and step.isEmpty():
            break
    return out


def release_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """path, old_n, new_n, delta of every counter of either release; a missing one counts 0 in delta."""
    j = old.select("path", F.col("n").alias("old_n")).join(new.select("path", F.col("n").alias("new_n")), "path", "full_outer")
    return j.withColumn("delta", F.coalesce("new_n", F.lit(0)) - F.coalesce("old_n", F.lit(0)))
