"""Building a clique's record: order of members, labels, names, scores, synonyms, descriptions, taxa.

Everything is joins and pre-aggregated picks over (clique, curie) rows; arrays are only built in the
final record, whose members belong to one clique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellon.functions.curie import numeric_suffix, prefix, suffix, upper_prefix

#: Names of this many characters or more are only used where a clique has no shorter one.
LONG_LABEL = 15


def ordered_members(members: DataFrame, types: DataFrame, prefix_ranks: DataFrame) -> DataFrame:
    """``members``: clique, curie; ``types``: clique, type; ``prefix_ranks``: type, prefix, rank (a static table).

    clique, pos, curie: members whose prefix (any case) is valid for the type, by rank, then identifier, with
    the prefix spelled as in the table. Cliques without a valid member vanish.
    """
    ranks = prefix_ranks.select("type", F.col("prefix").alias("spelled"), F.upper("prefix").alias("_p"), "rank")
    rows = members.select("clique", "curie").distinct().join(types, "clique").withColumn("_p", upper_prefix("curie")).join(ranks, ["type", "_p"])
    rows = rows.select("clique", "rank", F.concat("spelled", F.lit(":"), suffix("curie")).alias("curie")).distinct()
    return rows.withColumn("pos", F.row_number().over(Window.partitionBy("clique").orderBy("rank", "curie")) - 1).select("clique", "pos", "curie")


def pubchem_leader(members: DataFrame, leading: str = "PUBCHEM.COMPOUND", no_name: str = "CID") -> DataFrame:
    """``members``: clique, curie, label (blank or null: none). clique, leader among several ids of prefix ``leading``:

    the id whose label most other members bear (ties: greatest id); if none is borne, the shortest label that does not
    start with ``no_name``; else the smallest labelled id; else the smallest id. Cliques with fewer than two give none.
    """
    label = F.when(F.trim("label") != "", F.lower("label"))
    m = members.select("clique", "curie", "label", label.alias("l"), (prefix("curie") == leading).alias("own"))
    lead = m.where("own")
    borne = m.where("NOT own AND l IS NOT NULL").groupBy("clique", "l").agg(F.count("*").alias("n"))
    lead = lead.join(borne, ["clique", "l"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    named = F.col("l").isNotNull() & ~F.upper("label").startswith(no_name)
    best = lead.groupBy("clique").agg(
        F.count("*").alias("k"),
        F.max_by(F.when(F.col("n") > 0, F.col("curie")), F.when(F.col("n") > 0, F.struct("n", "curie"))).alias("a"),
        F.min_by(F.when(named, F.col("curie")), F.when(named, F.struct(F.length("label").alias("s"), "curie"))).alias("b"),
        F.min(F.when(F.col("l").isNotNull(), F.col("curie"))).alias("c"),
        F.min("curie").alias("d"),
    )
    return best.where("k > 1").select("clique", F.coalesce("a", "b", "c", "d").alias("leader"))


def last_label(labels: DataFrame) -> DataFrame:
    """curie, label: of several lines the last (greatest seq) holds."""
    return labels.groupBy("curie").agg(F.max_by("label", "seq").alias("label"))


def longest_label(labels: DataFrame) -> DataFrame:
    """curie, label: the longest, of equally long ones the first."""
    return labels.where("label IS NOT NULL").groupBy("curie").agg(F.max_by("label", F.struct(F.length("label").alias("n"), (-F.col("seq")).alias("s"))).alias("label"))


def apply_labels(members: DataFrame, *sources: DataFrame) -> DataFrame:
    """members with label: from the first of the sources (curie, label; one row per curie) that has one."""
    out = members
    for i, s in enumerate(sources):
        out = out.join(s.select("curie", F.col("label").alias(f"_l{i}")), "curie", "left")
    label = F.coalesce(*[F.when(F.col(f"_l{i}") != "", F.col(f"_l{i}")) for i in range(len(sources))])
    return out.withColumn("label", label).drop(*[f"_l{i}" for i in range(len(sources))])


def clean_members(members: DataFrame) -> DataFrame:
    """clique, curie, label: one row per member; a labelled duplicate beats one without a label."""
    named = F.col("label").isNotNull() & (F.col("label") != "")
    return members.groupBy("clique", "curie").agg(F.min(F.when(named, F.col("label"))).alias("label"))


def prefixes_of(types: DataFrame, added: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``types``: type, prefixes (array). type, prefix, rank without repetitions, in order; ``added``: more at the end."""
    extra = F.lit(None).cast("array<string>")
    for t, p in (added or {"biolink:BiologicalProcess": ("UMLS",)}).items():
        extra = F.when(F.col("type") == t, F.array(*map(F.lit, p))).otherwise(extra)
    full = F.array_distinct(F.concat("prefixes", F.coalesce(extra, F.array().cast("array<string>"))))
    return types.select("type", F.posexplode(full).alias("rank", "prefix"))


def ancestors(parents: DataFrame, depth: int = 32) -> DataFrame:
    """``parents``: type, parent (a static tree with mix-ins). type, ancestor, distance; the type itself at 0."""
    out = parents.select("type").unionByName(parents.select(F.col("parent").alias("type"))).distinct().select("type", F.col("type").alias("ancestor"), F.lit(0).alias("distance"))
    step, found = out, out
    up = parents.select(F.col("type").alias("ancestor"), "parent")
    for d in range(1, depth):
        step = step.join(up, "ancestor").select("type", F.col("parent").alias("ancestor"), F.lit(d).alias("distance")).distinct()
        if step.isEmpty():
            break
        found = found.unionByName(step)
    return found.groupBy("type", "ancestor").agg(F.min("distance").alias("distance"))


def information_content(members: DataFrame, ic: DataFrame) -> DataFrame:
    """clique, ic: the smallest score of a member, null without one."""
    return members.select("clique", "curie").join(ic, "curie", "left").groupBy("clique").agg(F.min("ic").alias("ic"))


def contract_iris(iris: DataFrame, prefix_map: DataFrame) -> DataFrame:
    """``iris``: iri, ...; ``prefix_map``: stem, prefix (a static table). Adds curie by the longest stem that fits; null if none does.

    Stems are matched by equality on every length they occur in, not by a scan of all pairs.
    """
    lengths = [r[0] for r in prefix_map.select(F.length("stem")).distinct().collect()]  # a few lengths of a static table
    out = iris.withColumn("_s", F.explode_outer(F.array(*[F.when(F.length("iri") > n, F.left("iri", F.lit(n))) for n in sorted(lengths)])))
    out = out.join(prefix_map.select(F.col("stem").alias("_s"), F.col("prefix").alias("_p")), "_s", "left")
    made = F.concat("_p", F.lit(":"), F.substr("iri", F.length("_s") + 1))
    keep = [c for c in iris.columns]
    return out.groupBy(*keep).agg(F.max_by(F.when(F.col("_p").isNotNull(), made), F.when(F.col("_p").isNotNull(), F.length("_s"))).alias("curie"))


def load_ic(iris: DataFrame, prefix_map: DataFrame) -> DataFrame:
    """``iris``: seq, iri, ic. curie, ic: the last line of a CURIE holds."""
    return contract_iris(iris, prefix_map).where("curie IS NOT NULL").groupBy("curie").agg(F.max_by("ic", "seq").alias("ic"))


def all_synonyms(labels: DataFrame, synonyms: DataFrame, common: DataFrame | None = None) -> DataFrame:
    """curie, predicate, synonym: labels as exact synonyms, and the synonym tables; blank ones left out."""
    out = labels.select("curie", F.lit("oio:hasExactSynonym").alias("predicate"), F.col("label").alias("synonym")).unionByName(synonyms.select("curie", "predicate", "synonym"))
    out = out if common is None else out.unionByName(common.select("curie", "predicate", "synonym"))
    return out.where("synonym IS NOT NULL AND synonym <> ''").distinct()


def all_descriptions(*tables: DataFrame) -> DataFrame:
    out = tables[0].select("curie", "description")
    for t in tables[1:]:
        out = out.unionByName(t.select("curie", "description"))
    return out.where("description IS NOT NULL AND description <> ''").distinct()


def taxa_of(members: DataFrame, taxa: DataFrame) -> DataFrame:
    """clique, curie, taxon; the identifier is looked up regardless of letter case."""
    t = taxa.select(F.upper("curie").alias("_u"), "taxon").distinct()
    return members.select("clique", "curie").distinct().withColumn("_u", F.upper("curie")).join(t, "_u").select("clique", "curie", "taxon")


def preferred_name(members: DataFrame, boosted: tuple[str, ...] = (), long_label: int = LONG_LABEL) -> DataFrame:
    """``members``: clique, pos, curie, label. clique, preferred_name: the first label in clique order, or in the order of
    ``boosted`` prefixes where given; labels over ``long_label`` characters only where there is none shorter; '' without any."""
    named = F.col("label").isNotNull() & (F.col("label") != "")
    place = F.array_position(F.array(*map(F.lit, boosted)), prefix("curie")) if boosted else F.lit(1)
    place = F.when(place > 0, place).otherwise(len(boosted) + 1)
    key = F.struct((F.length("label") > long_label).alias("long"), place.alias("boost"), "pos")
    return members.groupBy("clique").agg(F.coalesce(F.min_by(F.when(named, F.col("label")), F.when(named, key)), F.lit("")).alias("preferred_name"))


def boost_prefixes(members: DataFrame, boosted: tuple[str, ...]) -> DataFrame:
    """Members reordered stably: prefixes of ``boosted`` first, in their order."""
    place = F.array_position(F.array(*map(F.lit, boosted)), prefix("curie"))
    w = Window.partitionBy("clique").orderBy(F.when(place > 0, place).otherwise(len(boosted) + 1), "pos")
    return members.withColumn("pos", F.row_number().over(w) - 1)


def insert_alternatives(members: DataFrame, properties: DataFrame) -> DataFrame:
    """``members``: clique, pos, curie; ``properties``: curie, predicate, value. After each member come its alternative
    identifiers, in order; of an identifier that occurs twice in a clique the first place counts."""
    alt = properties.where(F.col("predicate") == "hasAlternativeId").select("curie", F.col("value").alias("alt")).distinct()
    rows = members.select("clique", "pos", F.lit("").alias("sub"), "curie")
    more = members.join(alt, "curie").select("clique", "pos", F.col("alt").alias("sub"), F.col("alt").alias("curie"))
    first = rows.unionByName(more).groupBy("clique", "curie").agg(F.min(F.struct("pos", "sub")).alias("at"))
    return first.withColumn("pos", F.row_number().over(Window.partitionBy("clique").orderBy("at.pos", "at.sub", "curie")) - 1).select("clique", "pos", "curie")


def check_properties(properties: DataFrame, allowed: tuple[str, ...] = ("hasAlternativeId",)) -> DataFrame:
    """Distinct curie, predicate, value, source; a predicate that is not allowed is an error."""
    p = F.when(F.col("predicate").isin(*allowed), F.col("predicate")).otherwise(F.raise_error(F.concat(F.lit("unknown predicate "), F.coalesce("predicate", F.lit("null")))))
    return properties.withColumn("predicate", p).select("curie", "predicate", "value", "source").distinct()


def _by_number(c: str) -> Column:
    n = numeric_suffix(c)
    return F.struct(n.isNull().alias("none"), n.alias("n"), F.col(c).alias("value"))


def compendium_records(members: DataFrame, types: DataFrame, labels: DataFrame, names: DataFrame, ic: DataFrame, descriptions: DataFrame, taxa: DataFrame) -> DataFrame:
    """clique and the nested record type, ic, identifiers [i, l, d, t], preferred_name, taxa."""
    d = descriptions.groupBy("curie").agg(F.transform(F.array_sort(F.collect_set(F.struct(F.length("description").alias("n"), "description"))), lambda x: x["description"]).alias("d"))
    t = taxa.select("curie", "taxon").distinct().groupBy("curie").agg(F.transform(F.array_sort(F.collect_set(_by_number("taxon"))), lambda x: x["value"]).alias("t"))
    none = F.array().cast("array<string>")
    rows = members.join(labels.select("curie", "label"), "curie", "left").join(d, "curie", "left").join(t, "curie", "left")
    ident = F.struct("pos", F.col("curie").alias("i"), F.coalesce("label", F.lit("")).alias("l"), F.coalesce("d", none).alias("d"), F.coalesce("t", none).alias("t"))
    rec = rows.groupBy("clique").agg(F.array_sort(F.collect_list(ident)).alias("m"))
    idents = F.transform("m", lambda x: F.struct(x["i"].alias("i"), x["l"].alias("l"), x["d"].alias("d"), x["t"].alias("t")))
    every = F.array_distinct(F.flatten(F.transform("m", lambda x: x["t"])))
    ordered = F.transform(F.array_sort(F.transform(every, lambda x: F.struct(numeric_suffix(x).isNull().alias("none"), numeric_suffix(x).alias("n"), x.alias("v")))), lambda x: x["v"])
    return rec.join(types, "clique").join(names, "clique", "left").join(ic, "clique", "left").select("clique", "type", "ic", idents.alias("identifiers"), "preferred_name", ordered.alias("taxa"))


def synonym_records(members: DataFrame, synonyms: DataFrame, names: DataFrame, types: DataFrame, ancestors_of: DataFrame | None = None) -> DataFrame:
    """curie (leader), names (distinct, by length then text), types (without ``biolink:``), preferred_name, shortest_name_length,
    clique_identifier_count, curie_suffix: one row per clique with a preferred name and a name."""
    n = members.join(synonyms.select("curie", "synonym"), "curie").groupBy("clique").agg(
        F.transform(F.array_sort(F.collect_set(F.struct(F.length("synonym").alias("n"), "synonym"))), lambda x: x["synonym"]).alias("names"), F.min(F.length("synonym")).alias("shortest_name_length")
    )
    lead = members.groupBy("clique").agg(F.min_by("curie", "pos").alias("curie"), F.count("*").alias("clique_identifier_count"))
    kinds = types.select("clique", F.array(F.col("type")).alias("t"))
    if ancestors_of is not None:
        chain = ancestors_of.groupBy("type").agg(F.transform(F.array_sort(F.collect_list(F.struct("distance", "ancestor"))), lambda x: x["ancestor"]).alias("t"))
        kinds = types.join(chain, "type").select("clique", "t")
    out = lead.join(n, "clique").join(names.where("preferred_name <> ''"), "clique").join(kinds, "clique")
    return out.select("curie", "names", F.transform("t", lambda x: F.regexp_replace(x, "^biolink:", "")).alias("types"), "preferred_name", "shortest_name_length", "clique_identifier_count", numeric_suffix("curie").alias("curie_suffix"))


def counts(members: DataFrame, synonyms: DataFrame) -> DataFrame:
    """One row: cliques, identifiers and synonyms."""
    a = members.agg(F.count_distinct("clique").alias("cliques"), F.count("*").alias("eq_ids")).withColumn("_one", F.lit(1))
    return a.join(synonyms.agg(F.count("*").alias("synonyms")).withColumn("_one", F.lit(1)), "_one").drop("_one")
