"""Equivalence cliques: order-dependent merging under uniqueness constraints, and the filters of its inputs.

A constraint can only refuse a pair, so every clique lies inside one unconstrained component. Components
are found in parallel; only those in which a constraint can bite are folded pair by pair in input order,
each by one task that streams its sorted pairs. Sets are kept as rows (set, member), never as arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellon.functions.curie import prefix, upper_prefix
from tessellon.operators.components import components
from tessellon.session import Scratch

if TYPE_CHECKING:
    import pandas as pd

#: Prefixes that must not occur bare; a pair with one is an error in the input.
BARE_PREFIXES = ("KEGG", "PUBCHEM")
ORDER = ("stage", "file_seq", "seq")


def pairs_of_sets(df: DataFrame, members: str, *order: str) -> DataFrame:
    """Sets of one or two members as rows left, right; larger sets are an error."""
    m = F.col(members)
    checked = F.when(F.size(m) > 2, F.raise_error(F.lit("a group may hold two members at most"))).otherwise(m)
    return df.where(F.size(m) > 0).select(*order, F.get(checked, F.lit(0)).alias("left"), F.get(checked, F.lit(1)).alias("right"))


class _Fold:
    """Sequential merge of one component's pairs."""

    def __init__(self, unique: set[str], close: set[tuple[str, str]]):
        self.unique, self.close = unique, close
        self.root: dict[str, str] = {}
        self.held: dict[str, list[str]] = {}
        self.kept: dict[str, dict[str, str]] = {}

    def add(self, left: str, right: str | None) -> None:
        roots = {self.root[x]: None for x in (left, right) if x in self.root}
        new = [x for x in dict.fromkeys((left, right)) if x is not None and x not in self.root]
        ids: dict[str, str] = {}
        for part in [*(self.kept[r] for r in roots), *({x.split(":", 1)[0]: x} for x in new if x.split(":", 1)[0] in self.unique)]:
            for p, x in part.items():
                if ids.setdefault(p, x) != x:
                    return
        if self.close:
            all_members = {x for r in roots for x in self.held[r]} | set(new)
            if any(a in all_members and b in all_members for a, b in self.close):
                return
        main = max(roots, key=lambda r: len(self.held[r])) if roots else new[0]
        members = self.held.setdefault(main, [])
        for r in roots:
            if r != main:
                for x in self.held.pop(r):
                    self.root[x] = main
                    members.append(x)
                self.kept.pop(r)
        for x in new:
            self.root[x] = main
            members.append(x)
        self.kept[main] = ids

    def rows(self) -> list[tuple[str, str]]:
        out = []
        for members in self.held.values():
            least = min(members)
            out += [(x, least) for x in members]
        return out


def _fold(unique: tuple[str, ...], close: set[tuple[str, str]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        now, fold = None, None
        for pdf in batches:
            rows = []
            for comp, left, right in zip(pdf["component"], pdf["left"], pdf["right"]):
                if comp != now:
                    rows += fold.rows() if fold else []
                    now, fold = comp, _Fold(set(unique), close)
                fold.add(left, None if right is None or right != right else right)
            yield pd.DataFrame(rows, columns=["curie", "clique"])
        if fold:
            yield pd.DataFrame(fold.rows(), columns=["curie", "clique"])

    return run


def glom(pairs: DataFrame, scratch: Scratch, unique_prefixes: tuple[str, ...] = ("INCHIKEY",), close: DataFrame | None = None) -> DataFrame:
    """``pairs``: stage, file_seq, seq, left, right (null: a single). Returns curie, clique (smallest member).

    Pairs are taken in the order of (stage, file_seq, seq, left, right). A pair is ignored if the merged
    set would hold two identifiers of a unique prefix (case matters) or both ends of a ``close`` pair
    (subject, object: a small curated list); ends of an ignored pair not met otherwise do not come out.
    Null left ends count as singles of the right end; rows with both null are nothing.
    """
    p = pairs.select(*ORDER, F.coalesce("left", "right").alias("left"), F.when(F.col("left").isNotNull(), F.col("right")).alias("right")).where("left IS NOT NULL")
    bad = F.coalesce(prefix("left").isin(*BARE_PREFIXES), F.lit(False)) | F.coalesce(prefix("right").isin(*BARE_PREFIXES), F.lit(False))
    p = scratch.write(p.withColumn("left", F.when(bad, F.raise_error(F.concat(F.lit("bare prefix in "), "left"))).otherwise(F.col("left"))), "pairs")
    comp = scratch.write(components(p.select(F.col("left").alias("a"), F.col("right").alias("b")), scratch), "components")
    clashes = comp.withColumn("p", prefix("node")).where(F.col("p").isin(*unique_prefixes)).groupBy("component", "p").agg(F.count("*").alias("n")).where("n > 1").select("component")
    near: set[tuple[str, str]] = set()
    if close is not None:
        close = close.where("subject IS NOT NULL AND object IS NOT NULL").distinct()
        near = {(r["subject"], r["object"]) for r in close.select("subject", "object").collect()}  # a curated list
        a, b = comp.select(F.col("node").alias("subject"), F.col("component").alias("ca")), comp.select(F.col("node").alias("object"), F.col("component").alias("cb"))
        clashes = clashes.unionByName(close.join(a, "subject").join(b, "object").where("ca = cb").select(F.col("ca").alias("component")))
    clashes = scratch.write(clashes.distinct(), "clashes")
    free = comp.join(clashes, "component", "left_anti").select(F.col("node").alias("curie"), F.col("component").alias("clique"))
    bound = p.join(comp.select(F.col("node").alias("left"), "component"), "left").join(clashes, "component", "left_semi")
    sorted_pairs = bound.repartition("component").sortWithinPartitions("component", *ORDER, "left", "right").select("component", "left", "right")
    return free.unionByName(sorted_pairs.mapInPandas(_fold(unique_prefixes, near), "curie string, clique string"))


def of_single_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys stand in one row only: counts combine before the shuffle, so no task gathers a common key's rows.
    Null keys are a key like any other."""
    once = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n")
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    for m in match[1:]:
        match[0] = match[0] & m
    return rows.join(once, match[0], "left_semi")


def overused_xrefs(pairs: DataFrame, both_ways: bool = False) -> DataFrame:
    """Pairs (subject, object, ...) whose object occurs in one row only, with ``both_ways`` its subject too.
    Rows are counted, so a repeated pair drops itself."""
    out = of_single_rows(pairs, "object")
    return out.join(of_single_rows(pairs, "subject").select(F.col("subject").alias("_s")), F.col("subject").eqNullSafe(F.col("_s")), "left_semi") if both_ways else out


def unique_members(sets: DataFrame, set_key: str, member: str) -> DataFrame:
    """Rows (set, member) without the members that more than one set holds; emptied sets keep one row with null."""
    once = sets.select(set_key, member).distinct()
    shared = once.groupBy(member).agg(F.count("*").alias("n")).where("n > 1").select(member)
    return _emptied(sets.select(set_key).distinct(), once.join(shared, member, "left_anti"), set_key, member)


def clean_sets(lists: DataFrame, set_key: str, member: str) -> DataFrame:
    """As ``unique_members`` for lists: a member repeated in one list counts as often as it stands there."""
    shared = lists.groupBy(member).agg(F.count("*").alias("n")).where("n > 1").select(member)
    return _emptied(lists.select(set_key).distinct(), lists.select(set_key, member).join(shared, member, "left_anti"), set_key, member)


def overused_in_lists(lists: DataFrame, set_key: str, member: str) -> DataFrame:
    """Lists without repetitions and without the members of more than one list; emptied lists vanish."""
    return unique_members(lists, set_key, member).where(F.col(member).isNotNull())


def _emptied(keys: DataFrame, kept: DataFrame, set_key: str, member: str) -> DataFrame:
    return keys.join(kept.select(set_key, member), set_key, "left").select(set_key, member)


def by_prefix(ids: DataFrame, curie: str) -> DataFrame:
    """Identifiers with their upper-case prefix; null prefix without a colon."""
    return ids.select(upper_prefix(curie).alias("prefix"), curie)


def read_identifiers(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``ids``: file_seq, seq, curie, type. Singles for ``glom`` and curie, type: the last type given wins."""
    singles = ids.select(F.lit(0).alias("stage"), "file_seq", "seq", F.col("curie").alias("left"), F.lit(None).cast("string").alias("right"))
    types = ids.where(F.col("type").isNotNull()).groupBy("curie").agg(F.max_by("type", F.struct("file_seq", "seq")).alias("type"))
    return singles, types


def known_pairs(pairs: DataFrame, membership: DataFrame, applies=None) -> DataFrame:
    """Pairs both of whose ends are in cliques already; rows where ``applies`` is false pass untouched."""
    known = membership.select("curie").distinct()
    kept = pairs.where(applies) if applies is not None else pairs
    for end in ("subject", "object"):
        kept = kept.join(known.withColumnRenamed("curie", end), end, "left_semi")
    kept = kept.select(*pairs.columns)
    return kept if applies is None else kept.unionByName(pairs.where(~applies))


def without_bad_pairs(pairs: DataFrame, bad: DataFrame) -> DataFrame:
    """Anti-join on the exact ordered pair (subject, object)."""
    return pairs.join(bad.select("subject", "object").distinct(), ["subject", "object"], "left_anti").select(*pairs.columns)


def parse_bad_pairs(lines: DataFrame) -> DataFrame:
    """``value``: ``subject object`` with one space between; lines that start with ``#`` are comments."""
    parts = F.split(F.trim("value"), " ")
    return lines.where(~F.col("value").startswith("#") & (F.size(parts) == 2)).select(parts[0].alias("subject"), parts[1].alias("object"))


#: Sources whose structure concords pass the overused-xref filter.
FILTERED_STRUCTURES = ("UNII", "KEGG.COMPOUND", "DrugCentral")


def combine_structures(concords: DataFrame, scratch: Scratch) -> DataFrame:
    """Merge of per-source structure concords (file_seq, seq, subject, predicate, object); a file holds one subject prefix."""
    p = prefix("subject")
    mixed = concords.groupBy("file_seq").agg(F.count_distinct(p).alias("n")).where("n > 1")
    if not mixed.isEmpty():
        raise ValueError("a structure concord mixes prefixes")
    filtered = [overused_xrefs(concords.where(p == x)) for x in FILTERED_STRUCTURES]
    rest = concords.where(~F.coalesce(p.isin(*FILTERED_STRUCTURES), F.lit(False)))
    for f in filtered:
        rest = rest.unionByName(f)
    return glom(rest.select(F.lit(1).alias("stage"), "file_seq", "seq", F.col("subject").alias("left"), F.col("object").alias("right")), scratch)


def seed_pairs(cliques: DataFrame) -> DataFrame:
    """Earlier cliques (curie, clique) as star pairs of a stage before all others."""
    return cliques.select(F.lit(-1).alias("stage"), F.lit(0).alias("file_seq"), F.xxhash64("clique", "curie").alias("seq"), F.col("clique").alias("left"), F.when(F.col("curie") != F.col("clique"), F.col("curie")).alias("right"))


def untyped_cliques(ids: DataFrame, concords: DataFrame, scratch: Scratch, seed: DataFrame | None = None, unique_prefixes: tuple[str, ...] = ("INCHIKEY",)) -> DataFrame:
    """Seed, then identifiers, then filtered concords, merged in this order: curie, clique."""
    singles, _ = read_identifiers(ids)
    per_file = of_single_rows(concords, "file_seq", "object")
    pairs = singles.unionByName(per_file.select(F.lit(1).alias("stage"), "file_seq", "seq", F.col("subject").alias("left"), F.col("object").alias("right")))
    if seed is not None:
        pairs = pairs.unionByName(seed_pairs(seed).select(*pairs.columns))
    return glom(pairs, scratch, unique_prefixes)


#: Settings of the domains: unique prefixes, which concords are filtered, and prefixes kept beside those of the type.
DOMAINS = {
    "anatomy": {"unique": ("UBERON", "GO"), "filter": "all", "both_ways": False},
    "disease": {"unique": ("MONDO", "HP"), "filter": ("MONDO", "HP", "EFO"), "both_ways": False},
    "process": {"unique": ("GO",), "filter": "all", "both_ways": True},
    "gene": {"unique": ("NCBIGene", "HGNC", "ENSEMBL", "OMIM"), "filter": (), "both_ways": False},
    "protein": {"unique": ("UniProtKB", "PR"), "filter": (), "both_ways": False, "extra": ("DRUGBANK",)},
    "taxon": {"unique": ("NCBITaxon", "MESH", "UMLS"), "filter": (), "both_ways": False},
    "chemicals": {"unique": ("INCHIKEY",), "filter": "all", "both_ways": False},
    "publications": {"unique": ("PMID",), "filter": (), "both_ways": False},
    "cell_line": {"unique": (), "filter": (), "both_ways": False},
    "gene_family": {"unique": (), "filter": (), "both_ways": False},
    "macromolecular_complex": {"unique": ("INCHIKEY",), "filter": (), "both_ways": False, "extra": ("ComplexPortal",)},
}
