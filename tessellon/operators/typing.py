"""One type for each clique: by the type of a leading member, by majority, or by rules on pairs of types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_of(c: Column, order: tuple[str, ...]) -> Column:
    """Place in ``order`` from 0; values not in it come after all that are."""
    place = F.array_position(F.array(*map(F.lit, order)), c)
    return F.when(place > 0, place - 1).otherwise(F.lit(len(order)))


def typed_by_vote(members: DataFrame, types: DataFrame, order: tuple[str, ...], first_prefixes: tuple[str, ...] = (), default: str | None = None) -> DataFrame:
    """``members``: clique, curie; ``types``: curie, type. Returns clique, type.

    The type of the smallest known member of the first of ``first_prefixes`` that has one; else the type
    most members have, ties by ``order`` (most specific first), then by name; else ``default``. Types of a
    clique are few, so the vote's second step is small.
    """
    from tessellon.functions.curie import prefix

    known = members.select("clique", "curie").distinct().join(types.where(F.col("type").isNotNull()), "curie")
    votes = known.groupBy("clique", "type").agg(F.count("*").alias("n"))
    best = votes.groupBy("clique").agg(F.min_by("type", F.struct((-F.col("n")).alias("n"), rank_of(F.col("type"), order).alias("r"), "type")).alias("voted"))
    out = members.select("clique").distinct().join(best, "clique", "left")
    if first_prefixes:
        p = rank_of(prefix("curie"), first_prefixes)
        lead = known.where(p < len(first_prefixes)).groupBy("clique").agg(F.min_by("type", F.struct(p.alias("p"), "curie")).alias("led"))
        out = out.join(lead, "clique", "left")
    else:
        out = out.withColumn("led", F.lit(None).cast("string"))
    return out.select("clique", F.coalesce("led", "voted", F.lit(default).cast("string")).alias("type"))


def typed_with_split(members: DataFrame, types: DataFrame, order: tuple[str, ...], leading: str, split: tuple[str, str], default: str) -> DataFrame:
    """clique, part, type: where all typed members of prefix ``leading`` agree, their type; where these have exactly
    the two types of ``split``, the clique falls in two parts; else the vote, else ``default``.

    ``part`` is null for an undivided clique. A member of a split clique goes to the part of its own type;
    members of neither type go with the first of ``split``: see ``split_members``.
    """
    from tessellon.functions.curie import prefix

    known = members.select("clique", "curie").distinct().join(types.where(F.col("type").isNotNull()), "curie")
    lead = known.where(prefix("curie") == leading).groupBy("clique").agg(F.array_sort(F.collect_set("type")).alias("t"))  # as many as there are types
    both = F.col("t") == F.array_sort(F.array(*map(F.lit, split)))
    vote = typed_by_vote(members, types, order, default=default)
    joined = vote.join(lead, "clique", "left")
    parts = F.when(both, F.array(*[F.struct(F.lit(i).alias("part"), F.lit(x).alias("type")) for i, x in enumerate(split)])).otherwise(
        F.array(F.struct(F.lit(None).cast("int").alias("part"), F.when(F.size("t") == 1, F.col("t")[0]).otherwise(F.col("type")).alias("type")))
    )
    return joined.select("clique", F.explode(parts).alias("x")).select("clique", "x.part", "x.type")


def split_members(members: DataFrame, types: DataFrame, typed: DataFrame, split: tuple[str, str]) -> DataFrame:
    """clique, part, curie: the members of each part."""
    halves = typed.where(F.col("part").isNotNull()).select("clique").distinct().withColumn("_split", F.lit(True))
    m = members.select("clique", "curie").distinct().join(types, "curie", "left").join(halves, "clique", "left")
    return m.select("clique", F.when(F.col("_split"), F.when(F.col("type") == split[1], 1).otherwise(0)).alias("part"), "curie")


def type_of_smiles(c: Column | str) -> Column:
    """A structure of several parts is a mixture; null without a structure."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.contains("."), "biolink:MolecularMixture").when(c.isNotNull(), "biolink:SmallMolecule")


def fixed_type(cliques: DataFrame, type_name: str) -> DataFrame:
    return cliques.select("clique").distinct().withColumn("type", F.lit(type_name))


def resolve_types(concepts: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``concepts``: concept, type (several rows); ``rules``: types (sorted, joined by ``|``), resolved (a short table).

    One type stands; several go by the rule for that set. Returns (concept, type) and the unresolved (concept, types).
    """
    sets = concepts.where(F.col("type").isNotNull()).groupBy("concept").agg(F.array_join(F.array_sort(F.collect_set("type")), "|").alias("types"))
    got = sets.join(rules, "types", "left").withColumn("type", F.coalesce("resolved", F.when(~F.col("types").contains("|"), F.col("types"))))
    return got.where(F.col("type").isNotNull()).select("concept", "type"), got.where(F.col("type").isNull()).select("concept", "types")
