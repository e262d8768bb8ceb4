"""Subclass closure and look-ups over triples (s, p, o) of ontologies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellon.functions.curie import obo_to_curie, prefix, suffix
from tessellon.session import Scratch

SUBCLASS, LABEL = "rdfs:subClassOf", "rdfs:label"
XREF = "oboInOwl:hasDbXref"
EXACT = ("skos:exactMatch", "owl:equivalentClass", "MONDO:exactMatch")
CLOSE = ("skos:closeMatch", "MONDO:closeMatch")


def subclasses(edges: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges``: child, parent; ``roots``: root. root, node: reflexive transitive closure. Cycles do no harm: a node once
    reached is not followed again. Each level is one join; a level is written before the next."""
    edges = edges.where("child IS NOT NULL AND parent IS NOT NULL AND child <> parent").distinct()
    new = scratch.write(roots.where("root IS NOT NULL").select("root", F.col("root").alias("node")).distinct(), "level0")
    found, n = new, 0
    while not new.isEmpty():
        n += 1
        step = new.join(edges, new["node"] == edges["parent"]).select("root", F.col("child").alias("node")).distinct()
        new = scratch.write(step.join(found, ["root", "node"], "left_anti"), f"level{n}")
        found = found.unionByName(new)
    return found


def with_label(nodes: DataFrame, triples: DataFrame) -> DataFrame:
    """nodes with label: the smallest of several, null without one."""
    labels = triples.where(F.col("p") == LABEL).groupBy(F.col("s").alias("node")).agg(F.min("o").alias("label"))
    return nodes.join(labels, "node", "left")


def with_objects(nodes: DataFrame, triples: DataFrame, predicates: tuple[str, ...], optional: bool = False) -> DataFrame:
    """nodes with each distinct object of the predicates; ``optional`` keeps nodes without one."""
    o = triples.where(F.col("p").isin(*predicates)).select(F.col("s").alias("node"), F.col("o").alias("object")).distinct()
    return nodes.join(o, "node", "left" if optional else "inner")


def with_fallback(nodes: DataFrame, triples: DataFrame, first: tuple[str, ...], fallback: tuple[str, ...]) -> DataFrame:
    """Objects of the first predicates; nodes without any take those of the fallback."""
    main = with_objects(nodes, triples, first)
    rest = with_objects(nodes.join(main.select("node").distinct(), "node", "left_anti"), triples, fallback)
    return main.unionByName(rest)


def concord_of(xrefs: DataFrame, root_prefix: str, renames: dict[str, str], ignored: tuple[str, ...] = (), hop: bool = False) -> DataFrame:
    """``xrefs``: node, object. subject, predicate, object: nodes of the root's prefix (with ``hop`` all), objects' prefixes renamed
    regardless of case, ignored prefixes left out, distinct."""
    rows = xrefs if hop else xrefs.where(prefix("node") == root_prefix)
    p = F.upper(prefix("object"))
    renamed = p
    new = F.lit(None).cast("string")
    for old, to in renames.items():
        new = F.when(renamed == old.upper(), F.concat(F.lit(to), F.lit(":"), suffix("object"))).otherwise(new)
    obj = F.coalesce(new, F.col("object"))
    return rows.select(F.col("node").alias("subject"), F.lit("xref").alias("predicate"), obj.alias("object")).where(prefix("object").isNotNull() & ~prefix("object").isin(*ignored) if ignored else prefix("object").isNotNull()).distinct()


def ids_by_roots(closure: DataFrame, root_types: DataFrame, excluded: DataFrame | None = None, wanted_prefix: str | None = None) -> DataFrame:
    """``closure``: root, node; ``root_types``: root, type, rank (rank 0 is most specific). curie, type: the most specific root's type;
    nodes below an excluded root fall out."""
    rows = closure.join(root_types, "root")
    if excluded is not None:
        gone = closure.join(excluded.select("root"), "root", "left_semi").select("node").distinct()
        rows = rows.join(gone, "node", "left_anti")
    if wanted_prefix:
        rows = rows.where(prefix("node") == wanted_prefix)
    return rows.groupBy(F.col("node").alias("curie")).agg(F.min_by("type", F.struct("rank", "type")).alias("type"))


def tree_ids(tree: DataFrame, branches: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """``tree``: id, number (``D03.633.100``); ``branches``: branch, type, rank. curie, type: the type of the first branch by rank a tree
    number lies in; type ``EXCLUDE`` drops the id. ``extra``: id, type of further classes, behind all branches.

    A number lies in a branch if one of its own leading parts is the branch: an equality, not a scan of pairs."""
    parts = F.split("number", "\\.")
    heads = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    rows = tree.where("number IS NOT NULL").select("id", F.explode(heads).alias("branch")).join(branches, "branch").select("id", "type", "rank")
    if extra is not None:
        rows = rows.unionByName(extra.select("id", "type", F.lit(1_000_000).alias("rank")))
    key = F.struct((F.col("type") != "EXCLUDE").alias("kept"), "rank", "type")
    return rows.groupBy(F.concat(F.lit("MESH:"), "id").alias("curie")).agg(F.min_by("type", key).alias("type")).where("type <> 'EXCLUDE'")


def registry_numbers(triples: DataFrame, concept: str = "meshv:preferredConcept", registry: str = "meshv:registryNumber") -> DataFrame:
    """id, registry: two hops from a term to its concept's registry number; ``0`` means none."""
    a = triples.where(F.col("p") == concept).select(F.col("s").alias("id"), F.col("o").alias("c"))
    b = triples.where(F.col("p") == registry).select(F.col("s").alias("c"), F.col("o").alias("registry"))
    return a.join(b, "c").where("registry <> '0'").select("id", "registry").distinct()


def common_rows(rows: DataFrame) -> DataFrame:
    """Rows (iri, value) of general files as curie, value; prefixes ``http`` and ``ro``, those that start with ``t`` and names with ``#`` fall out."""
    c = rows.select(obo_to_curie("iri").alias("curie"), "value")
    p = prefix("curie")
    return c.where(p.isNotNull() & ~F.lower(p).isin("http", "https", "ro") & ~F.lower(p).startswith("t") & ~F.col("curie").contains("#") & F.col("value").isNotNull()).distinct()


def page(rows: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """One page of an ordered scan; a plain scan reads all of them at once."""
    return rows.orderBy(*order).offset(offset).limit(limit)
