"""Which roots, trees and semantic types give the identifiers of each domain: settings of the operators, as data."""

# Roots of the ontologies, tree numbers and semantic-type trees, with the type each gives.
ROOTS = {
    "anatomy": {"UBERON:0001062": "biolink:AnatomicalEntity", "UBERON:0010000": "biolink:GrossAnatomicalStructure", "CL:0000000": "biolink:Cell", "GO:0005575": "biolink:CellularComponent", "NCIT:C12219": "biolink:AnatomicalEntity", "NCIT:C12508": "biolink:Cell", "NCIT:C34070": "biolink:CellularComponent"},
    "disease": {"MONDO:0000001": "biolink:Disease", "MONDO:0042489": "biolink:Disease", "HP:0000118": "biolink:PhenotypicFeature", "EFO:0000408": "biolink:Disease", "EFO:0000651": "biolink:PhenotypicFeature", "EFO:0001444": "biolink:PhenotypicFeature", "NCIT:C2991": "biolink:Disease", "NCIT:C3367": "biolink:PhenotypicFeature"},
    "process": {"GO:0007165": "biolink:Pathway", "GO:0008150": "biolink:BiologicalProcess", "GO:0003674": "biolink:MolecularActivity"},
    "protein": {"PR:000000001": "biolink:Protein"},
}
MESH_BRANCHES = {
    "anatomy": [("A11.284", "biolink:CellularComponent"), ("A11", "biolink:Cell"), *[(f"A{n:02d}", "biolink:AnatomicalEntity") for n in range(1, 21) if n != 11]],
    "disease": [("C23", "biolink:PhenotypicFeature"), *[(f"C{n:02d}", "biolink:Disease") for n in range(1, 27) if n != 23]],
    "taxon": [(f"B{n:02d}", "biolink:OrganismTaxon") for n in range(1, 6)],
    "chemicals": [*[(b, "biolink:Polypeptide") for b in ("D12.125", "D12.644", "D13")], ("D20", "biolink:ComplexMolecularMixture"), *[(f"D{n:02d}", "biolink:ChemicalEntity") for n in range(1, 27) if n not in (5, 8, 13, 20)]],
}
#: Branches whose terms are none of the domain's; and the further class of records that hang in no branch.
MESH_EXCLUDED = {"chemicals": ("D05", "D08", "D12.776")}
MESH_RECORDS = {"chemicals": ("SCR_Chemical", "biolink:ChemicalEntity"), "taxon": ("SCR_Organism", "biolink:OrganismTaxon")}
#: Concords taken from UMLS: source and the prefix its codes get.
UMLS_SOURCES = {
    "anatomy": {"SNOMEDCT_US": "SNOMEDCT", "MSH": "MESH", "NCI": "NCIT", "GO": "GO", "FMA": "FMA"},
    "disease": {"SNOMEDCT_US": "SNOMEDCT", "MSH": "MESH", "NCI": "NCIT", "HPO": "HP", "MDR": "MEDDRA", "OMIM": "OMIM"},
    "process": {"GO": "GO"},
    "gene": {"HGNC": "HGNC"},
    "protein": {"NCI": "NCIT", "MSH": "MESH", "DRUGBANK": "DRUGBANK"},
    "taxon": {"MSH": "MESH", "NCBI": "NCBITaxon"},
    "chemicals": {"MSH": "MESH", "DRUGBANK": "DRUGBANK", "RXNORM": "RXCUI"},
}

# Semantic-type trees of UMLS that give each domain's identifiers, with their type.
UMLS_TREES = {
    "anatomy": {"A1.2": "biolink:AnatomicalEntity", "A1.2.1": "biolink:AnatomicalEntity", "A1.2.3.1": "biolink:AnatomicalEntity", "A1.2.3.2": "biolink:AnatomicalEntity", "A2.1.4.1": "biolink:AnatomicalEntity", "A2.1.5.1": "biolink:AnatomicalEntity", "A2.1.5.2": "biolink:AnatomicalEntity", "A1.2.3.3": "biolink:Cell", "A1.2.3.4": "biolink:CellularComponent"},
    "disease": {"B2.2.1.2.1": "biolink:Disease", "A1.2.2.1": "biolink:Disease", "A1.2.2.2": "biolink:Disease", "B2.3": "biolink:Disease", "B2.2.1.2": "biolink:Disease", "B2.2.1.2.1.1": "biolink:Disease", "B2.2.1.2.2": "biolink:Disease", "A1.2.2": "biolink:Disease", "B2.2.1.2.1.2": "biolink:Disease", "A2.2": "biolink:PhenotypicFeature", "A2.2.1": "biolink:PhenotypicFeature", "A2.2.2": "biolink:PhenotypicFeature", "A2.3": "biolink:PhenotypicFeature"},
    "process": {"B2.2.1.1.4": "biolink:MolecularActivity", "B2.2.1.1": "biolink:BiologicalProcess", "B2.2.1.1.1": "biolink:BiologicalProcess", "B2.2.1.1.2": "biolink:BiologicalProcess", "B2.2.1.1.3": "biolink:BiologicalProcess", "B2.2.1.1.4.1": "biolink:BiologicalProcess"},
    "protein": {"A1.4.1.2.1.7": "biolink:Protein"},
    "taxon": {"A1.1.3": "biolink:OrganismTaxon", "A1.1.2": "biolink:OrganismTaxon", "A1.1.3.3": "biolink:OrganismTaxon", "A1.1.3.2": "biolink:OrganismTaxon", "A1.1.3.1.1.3": "biolink:OrganismTaxon", "A1.1.3.1.1.2": "biolink:OrganismTaxon", "A1.1.4": "biolink:OrganismTaxon", "A1.1.3.1.1.4": "biolink:OrganismTaxon", "A1.1.3.1.1.5": "biolink:OrganismTaxon", "A1.1.3.1.1.1": "biolink:OrganismTaxon", "A1.1.1": "biolink:OrganismTaxon", "A1.1.3.1": "biolink:OrganismTaxon", "A1.1": "biolink:OrganismTaxon", "A1.1.3.1.1": "biolink:OrganismTaxon"},
    "chemicals": {"A1.4.1.1.1.1": "biolink:ChemicalEntity", "A1.4.1.1.3.2": "biolink:ChemicalEntity", "A1.4.1.1.3.4": "biolink:ChemicalEntity", "A1.4.1.1.3.5": "biolink:ChemicalEntity", "A1.4.1.1.4": "biolink:ChemicalEntity", "A1.4.1.2": "biolink:ChemicalEntity", "A1.4.1.2.1": "biolink:ChemicalEntity", "A1.4.1.2.1.5": "biolink:ChemicalEntity", "A1.4.1.2.2": "biolink:ChemicalEntity", "A1.4.1.2.3": "biolink:ChemicalEntity", "A1.3.3": "biolink:Drug"},
}
# Trees that keep a concept out of a domain whatever else it is.
UMLS_BLOCKED = {"chemicals": ("A1.4.1.1.3.6", "A1.4.1.1.3.3", "A1.4.1.2.1.7")}
# Orders of types from most specific, for votes, and the order of a conflation's type.
VOTE_ORDER = {
    "anatomy": ("biolink:CellularComponent", "biolink:Cell", "biolink:GrossAnatomicalStructure", "biolink:AnatomicalEntity"),
    "disease": ("biolink:Disease", "biolink:PhenotypicFeature"),
    "process": ("biolink:Pathway", "biolink:BiologicalProcess", "biolink:MolecularActivity"),
    "chemicals": ("biolink:Drug", "biolink:MolecularMixture", "biolink:SmallMolecule", "biolink:Polypeptide", "biolink:ComplexMolecularMixture", "biolink:ChemicalMixture", "biolink:ChemicalEntity"),
}
LEADING_PREFIXES = {"anatomy": ("GO", "CL", "UBERON"), "disease": ("MONDO", "HP"), "process": ("GO",)}
CONFLATION_TYPE_ORDER = (
    "biolink:SmallMolecule", "biolink:Polypeptide", "biolink:NucleicAcidEntity", "biolink:MolecularEntity", "biolink:ComplexMolecularMixture", "biolink:ChemicalMixture", "biolink:MolecularMixture",
    "biolink:ProcessedMaterial", "biolink:Drug", "biolink:FoodAdditive", "biolink:Food", "biolink:EnvironmentalFoodContaminant", "biolink:ChemicalEntity",
)


# Cross-references of the ontologies: roots, kind of match, renamed prefixes (in upper case) and prefixes left out.
XREFS = {
    "anatomy": {"roots": ("UBERON:0001062", "GO:0005575"), "match": "xref", "renames": {}, "ignored": ("PMID", "BTO", "BAMS", "FMA", "CALOHA", "GOC", "WIKIPEDIA.EN", "CL", "GO", "NIF_SUBCELLULAR", "HTTP", "OPENCYC")},
    "disease HP": {
        "roots": ("HP:0000118",), "match": "xref", "ignored": ("ICD",),
        "renames": {"MSH": "MESH", "SNOMEDCT_US": "SNOMEDCT", "SNOMED_CT": "SNOMEDCT", "ORPHANET": "orphanet", "ICD-9": "ICD9", "ICD-10": "ICD10", "ICD-0": "ICD0", "ICD-O": "ICD0"},
    },
    "disease MONDO": {"roots": ("MONDO:0000001", "MONDO:0042489"), "match": "exact", "renames": {"ORPHANET": "orphanet"}, "ignored": ()},
    "disease MONDO_close": {"roots": ("MONDO:0000001", "MONDO:0042489"), "match": "close", "renames": {"ORPHANET": "orphanet"}, "ignored": ()},
    "disease DOID": {
        "roots": (), "match": "xref", "ignored": (),
        "renames": {"ICD10CM": "ICD10", "ICD9CM": "ICD9", "ICDO": "ICD0", "NCI": "NCIT", "SNOMEDCT_US_2018_03_01": "SNOMEDCT", "SNOMEDCT_US_2019_09_01": "SNOMEDCT", "SNOMEDCT_US_2020_03_01": "SNOMEDCT", "SNOMEDCT_US_2020_09_01": "SNOMEDCT", "UMLS_CUI": "UMLS", "KEGG": "KEGG.DISEASE"},
    },
    "process": {"roots": ("GO:0007165", "GO:0008150", "GO:0003674"), "match": "xref", "renames": {"WIKIPEDIA": "WIKIPATHWAYS", "REACTOME": "REACT", "TC": "TCDB"}, "ignored": ()},
    "protein": {"roots": ("PR:000000001",), "match": "xref", "renames": {}, "ignored": ()},
}
#: Prefixes of a domain's UMLS concord whose objects must be identifiers of the domain.
LISTED_ONLY = {"disease": ("OMIM", "NCIT")}


def umls_ids(sty, domain: str, blocked_ids=None):
    """Identifiers of a domain from UMLS semantic types (seq, cui, tree)."""
    from tessellon.sources import parsers

    trees = sty.sparkSession.createDataFrame(list(UMLS_TREES[domain].items()), "tree string, type string")
    return parsers.umls_ids(sty, trees, UMLS_BLOCKED.get(domain, ()), blocked_ids)


def mesh_ids(tree, domain: str, records=None, excluded: tuple[str, ...] = ()):
    """Identifiers of a domain from MeSH tree numbers (id, number); ``records``: id, class of supplementary records;
    ``excluded`` branches drop an id, beside those the domain excludes."""
    from pyspark.sql import functions as F

    from tessellon.operators import closure

    rows = [(b, "EXCLUDE", 0) for b in (*MESH_EXCLUDED.get(domain, ()), *excluded)] + [(b, t, i + 1) for i, (b, t) in enumerate(MESH_BRANCHES[domain])]
    extra = None
    if records is not None and domain in MESH_RECORDS:
        wanted, kind = MESH_RECORDS[domain]
        extra = records.where(F.col("class") == wanted).select("id", F.lit(kind).alias("type"))
    return closure.tree_ids(tree, tree.sparkSession.createDataFrame(rows, "branch string, type string, rank int"), extra)


def ontology_ids(reached, domain: str, wanted_prefix: str | None = None, excluded=None):
    """Identifiers of a domain below its ontology roots. ``reached``: root, node; the most specific root's type holds."""
    from tessellon.operators import closure

    order = VOTE_ORDER.get(domain, ())
    rows = [(root, kind, order.index(kind) if kind in order else len(order)) for root, kind in ROOTS[domain].items()]
    return closure.ids_by_roots(reached, reached.sparkSession.createDataFrame(rows, "root string, type string, rank int"), excluded, wanted_prefix)


def ontology_concord(reached, triples, source: str):
    """Pairs of the nodes below a source's roots (of the root's own prefix) with what they refer to. ``triples``: s, p, o."""
    from pyspark.sql import functions as F

    from tessellon.functions.curie import prefix
    from tessellon.operators import closure

    x = XREFS[source]
    predicates = {"xref": (closure.XREF,), "exact": closure.EXACT, "close": closure.CLOSE}[x["match"]]
    below = reached.where(F.col("root").isin(*x["roots"]))
    found = closure.with_objects(below, triples, predicates).where(prefix("node") == prefix("root"))
    return closure.concord_of(found, "", x["renames"], x["ignored"], hop=True)


def umls_concord(rows, domain: str, acceptable=None, listed=None):
    """A domain's pairs from concept rows (cui, sab, tty, code). ``acceptable``: curie of the concepts taken; ``listed``: curie of
    the identifiers that objects of the prefixes in ``LISTED_ONLY`` must be among."""
    from pyspark.sql import functions as F

    from tessellon.functions.curie import prefix
    from tessellon.sources import parsers

    out = parsers.umls_concord(rows, UMLS_SOURCES[domain], acceptable)
    strict = LISTED_ONLY.get(domain, ())
    if listed is None or not strict:
        return out
    bound = prefix("object").isin(*strict)
    return out.where(~bound).unionByName(out.where(bound).join(listed.select(F.col("curie").alias("object")).distinct(), "object", "left_semi").select(*out.columns))


def rxnorm_concord(rows, acceptable=None):
    """Pairs of RxNorm concepts with MeSH and DrugBank."""
    from tessellon.sources import parsers

    return parsers.umls_concord(rows, {k: v for k, v in UMLS_SOURCES["chemicals"].items() if k != "RXNORM"}, acceptable, "RXCUI")


def structure_ids(rows):
    """curie, type of rows id, smiles; the text ``None`` is no structure."""
    from pyspark.sql import functions as F

    from tessellon.operators.typing import type_of_smiles

    return rows.select(F.col("id").alias("curie"), F.coalesce(type_of_smiles(F.nullif("smiles", F.lit("None"))), F.lit("biolink:ChemicalEntity")).alias("type"))


def mapped_table(rows, left: str, right: str):
    """Pairs of a table (value) of two fields parted by white space; blank lines are skipped."""
    from pyspark.sql import functions as F

    parts = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    return rows.where(F.size(parts) >= 2).select(F.concat(F.lit(f"{left}:"), parts[0]).alias("subject"), F.lit("eq").alias("predicate"), F.concat(F.lit(f"{right}:"), parts[1]).alias("object"))


def typed(members, types, domain: str):
    """clique, type by the domain's leading prefixes, then by vote in its order of types."""
    from tessellon.operators import typing

    return typing.typed_by_vote(members, types, VOTE_ORDER[domain], LEADING_PREFIXES.get(domain, ()))
