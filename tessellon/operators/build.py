"""The build of a domain: identifiers and cross-references to cliques, types and records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellon.operators import cliques, nodes, typing
from tessellon.session import Scratch


@dataclass(frozen=True)
class Inputs:
    """``ids``: file_seq, seq, curie, type; ``concords``: source, file_seq, seq, subject, predicate, object; ``ranks``: type, prefix, rank;
    ``labels``: seq, curie, label; ``synonyms``: curie, predicate, synonym; ``descriptions``: curie, description; ``taxa``: curie, taxon;
    ``ic``: curie, ic; ``close``: subject, object."""

    ids: DataFrame
    concords: DataFrame
    ranks: DataFrame
    labels: DataFrame
    synonyms: DataFrame
    descriptions: DataFrame
    taxa: DataFrame
    ic: DataFrame
    close: DataFrame | None = None


def filtered_concords(concords: DataFrame, settings: dict) -> DataFrame:
    """Concords of the sources that a domain filters without overused cross-references (counted by source), the others as they are."""
    chosen = settings.get("filter", ())
    if not chosen:
        return concords
    bound = concords if chosen == "all" else concords.where(F.col("source").isin(*chosen))
    kept = cliques.of_single_rows(bound, "source", "object")
    if settings.get("both_ways"):
        kept = kept.join(cliques.of_single_rows(bound, "source", "subject").select("source", "subject").distinct(), ["source", "subject"], "left_semi").select(*concords.columns)
    return kept if chosen == "all" else kept.unionByName(concords.where(~F.coalesce(F.col("source").isin(*chosen), F.lit(False))))


def build(settings: dict, inputs: Inputs, scratch: Scratch, vote_order: tuple[str, ...] = (), leading: tuple[str, ...] = (), default_type: str | None = None, boosted: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """``settings``: an entry of ``cliques.DOMAINS``. cliques (curie, clique), types (clique, type), members (clique, pos, curie),
    records and synonyms of the domain.

    Identifiers come first, then the filtered concords; cliques are merged under the domain's unique prefixes, typed by a
    leading prefix or by vote, and their members ordered by the type's prefixes; ``extra`` prefixes of the settings come
    behind those of every type. Cliques without a valid member vanish.
    """
    singles, types_of = cliques.read_identifiers(inputs.ids)
    pairs = filtered_concords(inputs.concords, settings).select(F.lit(1).alias("stage"), "file_seq", "seq", F.col("subject").alias("left"), F.col("object").alias("right"))
    found = scratch.write(cliques.glom(singles.unionByName(pairs), scratch, settings.get("unique", ()), inputs.close), "cliques")
    types_of = scratch.write(types_of, "types_of")
    typed = scratch.write(typing.typed_by_vote(found, types_of, vote_order, leading, default_type).where("type IS NOT NULL"), "types")
    ranks = inputs.ranks
    extra = settings.get("extra", ())
    if extra:
        behind = ranks.select("type").distinct().select("type", F.posexplode(F.array(*map(F.lit, extra))).alias("rank", "prefix"))
        behind = behind.join(ranks.select("type", F.upper("prefix").alias("_p")), (F.upper("prefix") == F.col("_p")) & (behind["type"] == ranks["type"]), "left_anti")
        ranks = ranks.select("type", "prefix", "rank").unionByName(behind.select("type", "prefix", (F.col("rank") + 1_000_000).alias("rank")))
    members = scratch.write(nodes.ordered_members(found, typed, ranks), "members")
    labels = nodes.last_label(inputs.labels)
    named = scratch.write(members.join(labels, "curie", "left"), "named")
    names = nodes.preferred_name(named, boosted)
    records = nodes.compendium_records(members, typed, labels, names, nodes.information_content(members, inputs.ic), inputs.descriptions, inputs.taxa)
    synonyms = nodes.synonym_records(members, nodes.all_synonyms(inputs.labels, inputs.synonyms).select("curie", "synonym").distinct(), names, typed)
    return {"cliques": found, "types": typed, "members": members, "records": records, "synonyms": synonyms}

