"""Conflation: looser groups over clique leaders (genes with proteins, drugs with chemicals)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellon.functions.curie import numeric_suffix, prefix
from tessellon.operators.cliques import glom, of_single_rows
from tessellon.operators.typing import rank_of
from tessellon.session import Scratch


def single_row_subjects(pairs: DataFrame) -> DataFrame:
    """Pairs whose subject stands in one row only."""
    return of_single_rows(pairs, "subject")


def valid_pairs(pairs: DataFrame, *valid: DataFrame) -> DataFrame:
    """Pairs both of whose ends occur in one of the tables ``valid`` (curie)."""
    ids = valid[0].select("curie")
    for v in valid[1:]:
        ids = ids.unionByName(v.select("curie"))
    ids = ids.distinct()
    out = pairs
    for end in ("subject", "object"):
        out = out.join(ids.withColumnRenamed("curie", end), end, "left_semi")
    return out.select(*pairs.columns)


def gene_protein(pairs: DataFrame, genes: DataFrame, proteins: DataFrame, scratch: Scratch, order: tuple[str, ...] = ("NCBIGene", "UniProtKB")) -> DataFrame:
    """clique, pos, curie: genes before proteins, each by identifier. Another prefix is an error."""
    kept = valid_pairs(pairs, genes, proteins)
    sets = glom(kept.select(F.lit(0).alias("stage"), "file_seq", "seq", F.col("subject").alias("left"), F.col("object").alias("right")), scratch, ())
    place = rank_of(prefix("curie"), order)
    place = F.when(place < len(order), place).otherwise(F.raise_error(F.concat(F.lit("unexpected prefix: "), "curie")))
    return sets.withColumn("pos", F.row_number().over(Window.partitionBy("clique").orderBy(place, "curie")) - 1).select("clique", "pos", "curie")


def merged_gene_protein(genes: DataFrame, proteins: DataFrame, groups: DataFrame) -> DataFrame:
    """``genes``, ``proteins``: leader, curie (members); ``groups``: clique, curie (leaders). leader, curie, kind:
    complete groups (a gene and all its proteins present) take all members under the gene; all else passes apart."""
    have = genes.select("leader").distinct().withColumn("g", F.lit(1)).join(proteins.select("leader").distinct().withColumn("p", F.lit(1)), "leader", "full_outer")
    seen = groups.withColumnRenamed("curie", "leader").join(have, "leader", "left")
    full = seen.groupBy("clique").agg(
        F.sum(F.when(F.col("g").isNull() & F.col("p").isNull(), 1).otherwise(0)).alias("lost"), F.count("g").alias("genes"), F.count("p").alias("proteins"), F.min(F.when(F.col("g") == 1, F.col("leader"))).alias("gene")
    ).where("lost = 0 AND genes = 1 AND proteins > 0")
    to = seen.join(full.select("clique", "gene"), "clique").select("leader", "gene")
    both = genes.select("leader", "curie", F.lit("gene").alias("kind")).unionByName(proteins.select("leader", "curie", F.lit("protein").alias("kind")))
    return both.join(to, "leader", "left").select(F.coalesce("gene", "leader").alias("leader"), "curie", F.when(F.col("gene").isNotNull(), "merged").otherwise(F.col("kind")).alias("kind"))


def resolve_concepts(rel: DataFrame, conso: DataFrame) -> DataFrame:
    """``rel``: kind1, id1, kind2, id2, relation; ``conso``: cui, aui, sdui. subject, predicate, object as CUIs: the indicator
    (CUI, AUI, SDUI) tells how an end is given; SCUI and unknown ends are dropped."""
    aui = conso.where("aui IS NOT NULL").groupBy("aui").agg(F.max("cui").alias("cui"))
    sdui = conso.where("sdui IS NOT NULL").groupBy("sdui").agg(F.max("cui").alias("cui"))
    out = rel
    for i in ("1", "2"):
        a, s = aui.select(F.col("aui").alias(f"id{i}"), F.col("cui").alias("_a")), sdui.select(F.col("sdui").alias(f"id{i}"), F.col("cui").alias("_s"))
        out = out.join(a, f"id{i}", "left").join(s, f"id{i}", "left")
        kind = F.col(f"kind{i}")
        out = out.withColumn(f"cui{i}", F.when(kind == "CUI", F.col(f"id{i}")).when(kind == "AUI", F.col("_a")).when(kind == "SDUI", F.col("_s"))).drop("_a", "_s")
    return out.where("cui1 IS NOT NULL AND cui2 IS NOT NULL").select(F.col("cui1").alias("subject"), F.col("relation").alias("predicate"), F.col("cui2").alias("object"))


def single_use(pairs: DataFrame, single: tuple[str, ...], one_to_one: tuple[str, ...] = ()) -> DataFrame:
    """subject, predicate, object without repetitions and self pairs. For predicates of ``single`` a subject must have
    exactly one object, for ``one_to_one`` an object also one subject; other predicates pass, a null one is no relation."""
    p = pairs.where("subject <> object AND predicate IS NOT NULL").select("subject", "predicate", "object").distinct()
    free, bound = p.where(~F.col("predicate").isin(*single, *one_to_one)), p.where(F.col("predicate").isin(*single, *one_to_one))
    if not single and not one_to_one:
        return p
    kept = of_single_rows(bound, "predicate", "subject")
    if one_to_one:
        lone = of_single_rows(bound.where(F.col("predicate").isin(*one_to_one)), "predicate", "object")
        both = kept.where(F.col("predicate").isin(*one_to_one)).join(lone, ["subject", "predicate", "object"], "left_semi")
        kept = kept.where(F.col("predicate").isin(*single)).unionByName(both.where(~F.col("predicate").isin(*single)) if single else both)
    return free.unionByName(kept)


def flatten_annotations(lines: DataFrame) -> DataFrame:
    """``value``: JSON ``[[pubchem, rxnorm], ...]`` or ``{pubchem: [rxnorm, ...]}``. Rows subject, object."""
    a = F.from_json("value", "array<array<string>>")
    m = F.from_json("value", "map<string,array<string>>")
    pairs = lines.select(F.explode(a).alias("p")).where(F.size("p") == 2).select(F.col("p")[0].alias("subject"), F.col("p")[1].alias("object"))
    maps = lines.where(F.trim("value").startswith("{")).select(F.explode(m).alias("subject", "o")).select("subject", F.explode("o").alias("object"))
    return pairs.unionByName(maps)


def leaders_of(members: DataFrame, wanted: str = "RXCUI") -> DataFrame:
    """``members``: seq, leader, curie. curie, leader of identifiers of the prefix: the last line wins."""
    return members.where(prefix("curie") == wanted).groupBy("curie").agg(F.max_by("leader", "seq").alias("leader"))


def drug_chemical_pairs(pairs: DataFrame, drugs: DataFrame, chemicals: DataFrame, manual: DataFrame | None = None, tolerant: bool = False) -> DataFrame:
    """``pairs``, ``manual``: subject, object; ``drugs``, ``chemicals``: curie, leader (one row per curie).

    Both ends go to their leader, a drug's before a chemical's; pairs with an unknown end are dropped (with ``tolerant``
    an unknown object stands as it is). Where an end is known as both, its two leaders are paired too.
    """
    both = drugs.select("curie", F.col("leader").alias("d")).join(chemicals.select("curie", F.col("leader").alias("c")), "curie", "full_outer").withColumn("leader", F.coalesce("d", "c"))
    p = pairs.select("subject", "object")
    p = p if manual is None else p.unionByName(manual.select("subject", "object"))
    ends = both.select("curie", "leader")
    p = p.join(ends.select(F.col("curie").alias("subject"), F.col("leader").alias("s")), "subject", "left").join(ends.select(F.col("curie").alias("object"), F.col("leader").alias("o")), "object", "left")
    p = p.withColumn("o", F.coalesce("o", "object")) if tolerant else p
    used = p.where("s IS NOT NULL AND o IS NOT NULL")
    cross = both.where("d IS NOT NULL AND c IS NOT NULL AND d <> c").join(pairs.select(F.explode(F.array("subject", "object")).alias("curie")).distinct(), "curie", "left_semi")
    return used.select(F.col("s").alias("subject"), F.col("o").alias("object")).unionByName(cross.select(F.col("d").alias("subject"), F.col("c").alias("object"))).distinct()


def conflation_type(members: DataFrame, types: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """clique, type: the first by ``order`` among the members' types."""
    rows = members.select("clique", "curie").join(types, "curie").where(F.col("type").isNotNull())
    return rows.groupBy("clique").agg(F.min_by("type", F.struct(rank_of(F.col("type"), order).alias("r"), "type")).alias("type"))


def order_members(members: DataFrame, types: DataFrame, prefix_ranks: DataFrame, last: tuple[str, ...] = ("RXCUI", "UMLS")) -> DataFrame:
    """clique, pos, curie: by the type's prefix order, then number of the suffix (non-numeric ones after), then identifier.
    Prefixes of ``last`` and those the type does not list come at the end, in this order."""
    rows = members.select("clique", "curie").distinct().join(types, "clique", "left").withColumn("prefix", prefix("curie")).join(prefix_ranks, ["type", "prefix"], "left")
    n = numeric_suffix("curie")
    rank = F.when(F.col("prefix").isin(*last), 1_000_000).otherwise(F.coalesce("rank", F.lit(2_000_000)))
    w = Window.partitionBy("clique").orderBy(rank, n.isNull(), n, "curie")
    return rows.withColumn("pos", F.row_number().over(w) - 1).select("clique", "pos", "curie")


def leader_by_ic(ordered: DataFrame, types: DataFrame, member_types: DataFrame, ic: DataFrame) -> DataFrame:
    """``ordered``: clique, pos, curie. Among members of the leader's prefix and the group's type the one with the smallest
    score below the leader's (none: 100) moves to the front; the others keep their order."""
    rows = ordered.join(ic, "curie", "left").join(member_types.select("curie", F.col("type").alias("_t")), "curie", "left")
    lead = rows.where("pos = 0").join(types, "clique", "left").select("clique", prefix("curie").alias("_p"), F.coalesce("ic", F.lit(100.0)).alias("_ic"), F.col("type").alias("_want"))
    rows = rows.join(lead, "clique")
    fits = (prefix("curie") == F.col("_p")) & (F.col("_t") == F.col("_want")) & (F.col("ic") < F.col("_ic")) & (F.col("pos") > 0)
    front = rows.where(fits).groupBy("clique").agg(F.min_by("pos", F.struct("ic", "pos")).alias("_front"))
    w = Window.partitionBy("clique").orderBy(F.when(F.col("pos") == F.col("_front"), -1).otherwise(F.col("pos")))
    return ordered.join(front, "clique", "left").withColumn("new", F.row_number().over(w) - 1).select("clique", F.col("new").alias("pos"), "curie")


def conflated_synonyms(docs: DataFrame, conflation: DataFrame) -> DataFrame:
    """``docs``: curie, names, types (arrays), preferred_name, shortest_name_length, clique_identifier_count, taxa; ``conflation``:
    clique, pos, curie. Documents of one group become one under its first member: names and types in group order, first
    occurrence kept; least length; sum of counts; union of taxa, sorted. Others pass as they are."""
    primary = conflation.where("pos = 0").select("clique", F.col("curie").alias("primary"))
    to = conflation.join(primary, "clique").select("curie", "primary", "pos")
    rows = docs.join(to, "curie", "left").withColumn("primary", F.coalesce("primary", "curie")).withColumn("pos", F.coalesce("pos", F.lit(0)))
    g = rows.groupBy("primary").agg(
        F.array_sort(F.collect_list(F.struct("pos", "curie", "names", "types", "preferred_name"))).alias("d"),  # members of one group
        F.min("shortest_name_length").alias("shortest_name_length"),
        F.sum("clique_identifier_count").alias("clique_identifier_count"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("taxa")))).alias("taxa"),
    )
    joined: Column = lambda f: F.array_distinct(F.flatten(F.transform("d", lambda x: x[f])))
    return g.select(F.col("primary").alias("curie"), joined("names").alias("names"), joined("types").alias("types"), F.col("d")[0]["preferred_name"].alias("preferred_name"), "shortest_name_length", "clique_identifier_count", "taxa")


def label_cliques(members: DataFrame, labels: DataFrame) -> DataFrame:
    """clique, label: of the first member with a label, ``?`` if none has."""
    m = members.join(labels.select("curie", "label"), "curie", "left")
    named = F.col("label").isNotNull() & (F.col("label") != "")
    return m.groupBy("clique").agg(F.coalesce(F.min_by(F.when(named, F.col("label")), F.when(named, F.col("pos"))), F.lit("?")).alias("label"))


def leftover_concepts(concepts: DataFrame, used: DataFrame, semantic_types: DataFrame, type_map: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``concepts``: seq, curie, label; ``used``: curie; ``semantic_types``: curie, tree; ``type_map``: tree, type; ``rules``: see
    ``resolve_types``. Concepts in no clique with their first label and type; and the untyped ones with the reason."""
    from tessellon.operators.typing import resolve_types

    left = concepts.join(used.select("curie").distinct(), "curie", "left_anti").groupBy("curie").agg(F.min_by("label", "seq").alias("label"))
    kinds = semantic_types.join(type_map, "tree").select(F.col("curie").alias("concept"), "type")
    typed, failed = resolve_types(kinds.join(left.select(F.col("curie").alias("concept")), "concept", "left_semi"), rules)
    good = left.join(typed.withColumnRenamed("concept", "curie"), "curie")
    bad = left.join(good.select("curie"), "curie", "left_anti").join(failed.withColumnRenamed("concept", "curie"), "curie", "left")
    return good, bad.select("curie", "label", F.coalesce("types", F.lit("no type")).alias("reason"))
