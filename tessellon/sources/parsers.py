"""Parsers of the vocabularies' own formats: each turns rows of a source into identifiers, labels, synonyms or pairs."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessellon.functions.curie import prefix, suffix
from tessellon.operators.cliques import overused_xrefs

if TYPE_CHECKING:
    import pandas as pd

EXACT = "oio:hasExactSynonym"


# --- UMLS and RxNorm -------------------------------------------------------------------------------
def conso(rows: DataFrame, english: bool = True) -> DataFrame:
    """Pipe-delimited concept rows (seq, value): cui, aui, sab, tty, code, term of those in English that are not suppressed as O or E."""
    f = F.split("value", r"\|", -1)
    at = lambda i: F.get(f, F.lit(i))
    kept = rows.where(~F.coalesce(at(16), F.lit("")).isin("O", "E"))
    kept = kept.where(at(1) == "ENG") if english else kept
    return kept.select("seq", at(0).alias("cui"), at(7).alias("aui"), at(11).alias("sab"), at(12).alias("tty"), at(13).alias("code"), at(14).alias("term"))


def umls_ids(sty: DataFrame, type_map: DataFrame, blocked_trees: tuple[str, ...] = (), blocked_ids: DataFrame | None = None) -> DataFrame:
    """``sty``: seq, cui, tree; ``type_map``: tree, type. curie, type by the first mapped tree in file order; a concept with any blocked
    tree, and blocked ids, fall out."""
    g = sty.join(type_map, "tree", "left").groupBy("cui").agg(
        F.max(F.col("tree").isin(*blocked_trees) if blocked_trees else F.lit(False)).alias("blocked"),
        F.min_by(F.when(F.col("type").isNotNull(), F.col("type")), F.when(F.col("type").isNotNull(), F.struct("seq", "type"))).alias("type"),
    )
    out = g.where("NOT coalesce(blocked, false) AND type IS NOT NULL").select(F.concat(F.lit("UMLS:"), "cui").alias("curie"), "type")
    return out if blocked_ids is None else out.join(blocked_ids.select("curie"), "curie", "left_anti")


def rxnorm_ids(rows: DataFrame) -> DataFrame:
    """``rows``: rxcui, sab, tty. curie, type: needs a row of source RXNORM; dose forms fall out; ingredients are chemicals, several
    ingredients a mixture, all else a drug."""
    g = rows.groupBy("rxcui").agg(F.collect_set("tty").alias("t"), F.max(F.col("sab") == "RXNORM").alias("own"))  # a few term types
    has = lambda *x: F.arrays_overlap("t", F.array(*map(F.lit, x)))
    kind = F.when(has("IN", "PIN"), "biolink:ChemicalEntity").when(has("MIN"), "biolink:MolecularMixture").otherwise("biolink:Drug")
    return g.where(F.col("own") & ~has("DF")).select(F.concat(F.lit("RXCUI:"), "rxcui").alias("curie"), kind.alias("type"))


# Term types taken from a source when its codes are matched.
TERM_TYPES = {"MSH": ("MH", "NM", "HT", "QAB"), "DRUGBANK": ("IN", "PIN", "MIN")}


def umls_concord(rows: DataFrame, sources: dict[str, str], acceptable: DataFrame | None = None, cui_prefix: str = "UMLS") -> DataFrame:
    """``rows``: cui, sab, tty, code; ``sources``: source -> prefix. subject, predicate, object, distinct; an inner prefix of the code is cut."""
    ok = F.lit(False)
    for sab in sources:
        ok = ok | ((F.col("sab") == sab) & (F.col("tty").isin(*TERM_TYPES[sab]) if sab in TERM_TYPES else F.lit(True)))
    spelled = F.element_at(F.create_map(*[x for s, p in sources.items() for x in (F.lit(s), F.lit(p))]), F.col("sab"))
    kept = rows.where(F.col("sab").isin(*sources)).where(ok).select(F.concat(F.lit(f"{cui_prefix}:"), "cui").alias("subject"), F.lit("eq").alias("predicate"), F.concat(spelled, F.lit(":"), F.element_at(F.split("code", ":"), -1)).alias("object"))
    kept = kept.join(acceptable.select(F.col("curie").alias("subject")), "subject", "left_semi") if acceptable is not None else kept
    return kept.dropDuplicates(["subject", "object"]).select("subject", "predicate", "object")


def umls_labels(rows: DataFrame, precedence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows``: seq, cui, sab, tty, term; ``precedence``: sab, tty, priority. Labels (least priority, term, line) and synonyms (terms of
    digits only left out)."""
    p = rows.join(precedence, ["sab", "tty"], "left").withColumn("priority", F.coalesce("priority", F.lit(1_000_000)))
    labels = p.groupBy("cui").agg(F.min_by("term", F.struct("priority", "term", "seq")).alias("label")).select(F.concat(F.lit("UMLS:"), "cui").alias("curie"), "label")
    names = rows.where(~F.col("term").rlike(r"^\d+$")).select(F.concat(F.lit("UMLS:"), "cui").alias("curie"), F.lit(EXACT).alias("predicate"), F.col("term").alias("synonym")).distinct()
    return labels, names


def snomed_labels(rows: DataFrame) -> DataFrame:
    pt = rows.where("sab = 'SNOMEDCT_US' AND tty = 'PT'")
    return pt.groupBy("code").agg(F.min_by("term", "seq").alias("label")).select(F.concat(F.lit("SNOMEDCT:"), "code").alias("curie"), "label")


def uniprot_from_umls(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows``: umls, nci, uniprot. The two concords UMLS-UniProt and NCIT-UniProt."""
    u = F.concat(F.lit("UniProtKB:"), "uniprot")
    a = rows.where("umls <> '' AND uniprot <> ''").select(F.concat(F.lit("UMLS:"), "umls").alias("subject"), F.lit("eq").alias("predicate"), u.alias("object"))
    b = rows.where("nci <> '' AND uniprot <> ''").select(F.concat(F.lit("NCIT:"), "nci").alias("subject"), F.lit("eq").alias("predicate"), u.alias("object"))
    return a.distinct(), b.distinct()


# --- genes and proteins ----------------------------------------------------------------------------
SKIPPED_GENES = ("biological-region", "other", "unknown")


def _dash(c: str) -> Column:
    return F.nullif(F.col(c), F.lit("-"))


def gene_info(rows: DataFrame, skipped: tuple[str, ...] = SKIPPED_GENES) -> dict[str, DataFrame]:
    """``rows``: tax_id, gene_id, symbol, synonyms, description, authority_symbol, authority_name, other_designations, gene_type (``-``: none).
    labels, synonyms, taxa and descriptions."""
    r = rows.where(~F.coalesce(F.col("gene_type").isin(*skipped), F.lit(False))).withColumn("curie", F.concat(F.lit("NCBIGene:"), "gene_id"))
    none = F.array().cast("array<string>")
    many = lambda c: F.coalesce(F.split(_dash(c), r"\|"), none)
    one = lambda c: F.array_compact(F.array(_dash(c)))
    names = F.array_union(F.array_union(one("symbol"), many("synonyms")), F.array_union(F.array_union(one("authority_symbol"), one("authority_name")), many("other_designations")))
    return {
        "labels": r.select("curie", F.coalesce(_dash("authority_symbol"), _dash("symbol"), _dash("authority_name"), _dash("description")).alias("label")).where("label IS NOT NULL"),
        "synonyms": r.select("curie", F.lit(EXACT).alias("predicate"), F.explode(names).alias("synonym")),
        "taxa": r.select("curie", F.concat(F.lit("NCBITaxon:"), "tax_id").alias("taxon")),
        "descriptions": r.select("curie", _dash("description").alias("description")).where("description IS NOT NULL"),
    }


def gene_to_ensembl(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows``: seq, gene_id, ensembl_gene, ensembl_protein. Pairs of known genes; versions cut; repeats in a row dropped."""
    r = rows.withColumn("subject", F.concat(F.lit("NCBIGene:"), "gene_id")).join(ids.select(F.col("curie").alias("subject")), "subject", "left_semi")
    e = F.coalesce(F.nullif(F.regexp_extract("ensembl_gene", r"^([A-Z]+\d+)\.\d+", 1), F.lit("")), F.col("ensembl_gene"))
    r = r.where("ensembl_gene <> '-'").withColumn("object", F.concat(F.lit("ENSEMBL:"), e))
    last = F.lag("object").over(Window.partitionBy("subject").orderBy("seq"))
    return r.withColumn("_l", last).where(~F.col("_l").eqNullSafe(F.col("object"))).select("subject", F.lit("eq").alias("predicate"), "object")


def gene_xrefs(rows: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """``rows``: gene_id, xrefs (``MIM:1|HGNC:HGNC:2``). Pairs with the last colon part under the mapped prefix."""
    x = rows.select("gene_id", F.explode(F.split("xrefs", r"\|")).alias("x")).where("x <> '-'")
    spelled = F.element_at(F.create_map(*[v for k, p in prefixes.items() for v in (F.lit(k), F.lit(p))]), prefix("x"))
    return x.select(F.concat(F.lit("NCBIGene:"), "gene_id").alias("subject"), F.lit("eq").alias("predicate"), F.concat(spelled, F.lit(":"), F.element_at(F.split("x", ":"), -1)).alias("object")).where("object IS NOT NULL")


def medgen(rows: DataFrame) -> DataFrame:
    """``rows``: mim, gene_id, kind, cui. Of kind gene: NCBIGene-OMIM and, with a concept, NCBIGene-UMLS."""
    g = rows.where("kind = 'gene' AND gene_id <> '-'").withColumn("subject", F.concat(F.lit("NCBIGene:"), "gene_id"))
    a = g.select("subject", F.lit("eq").alias("predicate"), F.concat(F.lit("OMIM:"), "mim").alias("object"))
    return a.unionByName(g.where("cui <> '-'").select("subject", F.lit("eq").alias("predicate"), F.concat(F.lit("UMLS:"), "cui").alias("object")))


def gene_concepts(sty: DataFrame, rows: DataFrame, blacklist: DataFrame, tree: str = "A1.2.3.5") -> DataFrame:
    """UMLS genes: concepts of the tree, without the blacklist, those with an OMIM variant code (``.``) or a label of an allele or mutation."""
    out = sty.where(F.col("tree") == tree).select("cui").distinct().join(blacklist.select("cui"), "cui", "left_anti")
    bad = rows.where(((F.col("sab") == "OMIM") & F.col("code").contains(".")) | F.lower("term").rlike(r"\b(allele|mutation)\b")).select("cui")
    return out.join(bad, "cui", "left_anti").select(F.concat(F.lit("UMLS:"), "cui").alias("curie"), F.lit("biolink:Gene").alias("type"))


def unpivot_ids(rows: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Wide id columns as pairs: key, and ``prefix:value`` of each filled column."""
    long = rows.select(key, *columns).unpivot([key], list(columns), "_c", "_v").where("_v IS NOT NULL AND _v <> ''")
    spelled = F.element_at(F.create_map(*[v for k, p in columns.items() for v in (F.lit(k), F.lit(p))]), F.col("_c"))
    return long.select(F.concat(F.lit("ENSEMBL:"), key).alias("subject"), F.lit("eq").alias("predicate"), F.concat(spelled, F.lit(":"), "_v").alias("object")).distinct()


def merge_batches(key: str, *batches: DataFrame) -> DataFrame:
    """Attributes downloaded apart, merged by full outer join on the key."""
    out = batches[0]
    for b in batches[1:]:
        out = out.join(b, key, "full_outer")
    return out


def id_mapping(rows: DataFrame, key: str, spelled: str) -> DataFrame:
    """``rows``: accession, key, value of the long mapping table, for one key."""
    return rows.where(F.col("key") == key).select(F.concat(F.lit("UniProtKB:"), "accession").alias("subject"), F.lit("eq").alias("predicate"), F.concat(F.lit(f"{spelled}:"), "value").alias("object"))


def fasta_labels(rows: DataFrame) -> DataFrame:
    """Header lines ``>db|ACC|NAME text OS=...``: curie, label."""
    h = rows.where(F.col("value").startswith(">"))
    name = F.get(F.split(F.substr("value", F.instr("value", " ") + 1), " OS="), F.lit(0))
    return h.select("seq", F.concat(F.lit("UniProtKB:"), F.get(F.split("value", r"\|"), F.lit(1))).alias("curie"), name.alias("label"))


def mod_labels(rows: DataFrame, id_col: str, symbol: str, spelled: str) -> DataFrame:
    return rows.where(F.col(symbol).isNotNull()).select(F.concat(F.lit(f"{spelled}:"), id_col).alias("curie"), F.col(symbol).alias("label")).dropDuplicates(["curie"])


def hgnc(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs``: hgnc_id, symbol, name, alias_symbol, alias_name (arrays). Labels and synonyms."""
    none = F.array().cast("array<string>")
    names = F.array_compact(F.concat(F.array("name"), F.coalesce("alias_symbol", none), F.coalesce("alias_name", none)))
    return docs.select(F.col("hgnc_id").alias("curie"), F.col("symbol").alias("label")), docs.select(F.col("hgnc_id").alias("curie"), F.lit(EXACT).alias("predicate"), F.explode(names).alias("synonym")).distinct()


# --- chemicals -------------------------------------------------------------------------------------
def left_with_smiles(labels: DataFrame, smiles: DataFrame) -> DataFrame:
    """Two files sorted by identifier: a sort-merge left join. curie, type by structure."""
    from tessellon.operators.typing import type_of_smiles

    j = labels.select("curie").distinct().join(smiles.hint("merge"), "curie", "left")
    return j.select("curie", F.coalesce(type_of_smiles("smiles"), F.lit("biolink:ChemicalEntity")).alias("type"))


UNICHEM_SOURCES = {"1": "CHEMBL.COMPOUND", "2": "DRUGBANK", "4": "GTOPDB", "6": "KEGG.COMPOUND", "7": "CHEBI", "14": "UNII", "18": "HMDB", "22": "PUBCHEM.COMPOUND", "34": "DrugCentral"}


def unichem(reference: DataFrame, structure: DataFrame, sources: dict[str, str] | None = None) -> DataFrame:
    """``reference``: uci, src_id, src_compound_id, assignment; ``structure``: uci, inchikey. Pairs id-InChIKey of current
    assignments of the listed sources: a shuffled join, no table of keys in one memory."""
    s = sources or UNICHEM_SOURCES
    spelled = F.element_at(F.create_map(*[v for k, p in s.items() for v in (F.lit(k), F.lit(p))]), F.col("src_id"))
    ref = reference.where(F.col("src_id").isin(*s) & (F.col("assignment") == "1")).select("uci", F.concat(spelled, F.lit(":"), "src_compound_id").alias("subject"))
    return ref.join(structure.select("uci", F.concat(F.lit("INCHIKEY:"), "inchikey").alias("object")), "uci").select("subject", F.lit("rdkit:inchikey").alias("predicate"), "object")


def is_cas(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).rlike(r"^\d+-\d+-\d$")


def cas_concord(synonyms: DataFrame) -> DataFrame:
    return synonyms.where(is_cas("synonym")).select(F.col("curie").alias("subject"), F.lit("xref").alias("predicate"), F.concat(F.lit("CAS:"), "synonym").alias("object")).distinct()


def pubchem_mesh(rows: DataFrame, mesh_labels: DataFrame) -> DataFrame:
    """``rows``: seq, cid, name; ``mesh_labels``: curie, label. The first line of a compound whose name is a label of a C or D term."""
    m = mesh_labels.where(suffix("curie").rlike("^[CD]")).groupBy("label").agg(F.min("curie").alias("object"))
    j = rows.join(m, rows["name"] == m["label"])
    return j.groupBy("cid").agg(F.min_by("object", "seq").alias("object")).select(F.concat(F.lit("PUBCHEM.COMPOUND:"), "cid").alias("subject"), F.lit("xref").alias("predicate"), "object")


def mapped_pairs(rows: DataFrame, namespaces: dict[str, str], own: str) -> DataFrame:
    """``rows``: id, namespace, value. Pairs of the namespaces listed."""
    spelled = F.element_at(F.create_map(*[v for k, p in namespaces.items() for v in (F.lit(k), F.lit(p))]), F.col("namespace"))
    return rows.where(F.col("namespace").isin(*namespaces)).select(F.concat(F.lit(f"{own}:"), "id").alias("subject"), F.lit("xref").alias("predicate"), F.concat(spelled, F.lit(":"), "value").alias("object"))


def _plain(x: str | None) -> str | None:
    return None if x is None else html.unescape(re.sub(r"<[^<>]+>", "", x))


def plain_html(c: Column | str) -> Column:
    """Text without tags and with entities resolved."""
    return F.udf(_plain, StringType(), useArrow=True)(c)


def gtopdb(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows``: id, name, synonyms, inchikey. Labels without HTML, and id-InChIKey pairs."""
    labels = rows.select(F.concat(F.lit("GTOPDB:"), "id").alias("curie"), plain_html("name").alias("label"))
    keys = rows.where("inchikey IS NOT NULL AND inchikey <> ''").select(F.concat(F.lit("GTOPDB:"), "id").alias("subject"), F.lit("inchi").alias("predicate"), F.concat(F.lit("INCHIKEY:"), "inchikey").alias("object"))
    return labels, keys


def sdf_records(rows: DataFrame) -> DataFrame:
    """``value``: one record (records end with ``$$$$``). seq, fields: map of header to its lines."""
    blocks = F.filter(F.split("value", r"(?m)^> *"), lambda b: b.startswith("<"))
    pair = lambda b: F.struct(F.regexp_extract(b, r"^<([^>]*)>", 1).alias("k"), F.filter(F.slice(F.split(F.rtrim(F.regexp_replace(b, "\r", "")), "\n"), 2, 1_000_000), lambda x: x != "").alias("v"))
    # of a header that occurs twice the last counts
    m = F.aggregate(F.transform(blocks, pair), F.create_map().cast("map<string,array<string>>"), lambda a, x: F.map_concat(F.map_filter(a, lambda k, _: k != x["k"]), F.map_from_entries(F.array(x))))
    return rows.select("seq", m.alias("fields"))


def chebi(records: DataFrame, accessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of ``records`` (seq, fields) and, for compounds without a structure record, of ``accessions`` (id, kind, value); and
    secondary ids as properties."""
    f = lambda k: F.element_at("fields", k)
    own = F.get(f("ChEBI ID"), F.lit(0))
    r = records.withColumn("curie", own).where("curie IS NOT NULL")
    keyed = r.select("curie", F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.get(f(k), F.lit(0)).alias("v")) for k, p in (("KEGG COMPOUND Database Links", "KEGG.COMPOUND"), ("InChIKey", "INCHIKEY"), ("PubChem Database Links", "PUBCHEM.COMPOUND"))])).alias("x"))
    pairs = keyed.where("x.v IS NOT NULL").select(F.col("curie").alias("subject"), F.lit("xref").alias("predicate"), F.concat("x.p", F.lit(":"), "x.v").alias("object"))
    rest = accessions.withColumn("subject", F.concat(F.lit("CHEBI:"), "id")).join(r.select(F.col("curie").alias("subject")), "subject", "left_anti")
    more = rest.where("kind IN ('KEGG COMPOUND accession', 'Pubchem accession')").select("subject", F.lit("xref").alias("predicate"), F.concat(F.when(F.col("kind") == "KEGG COMPOUND accession", "KEGG.COMPOUND:").otherwise("PUBCHEM.COMPOUND:"), "value").alias("object"))
    props = r.select("curie", F.lit("hasAlternativeId").alias("predicate"), F.explode(f("Secondary ChEBI ID")).alias("value"), F.lit("ChEBI").alias("source"))
    return pairs.unionByName(more), props


def typed_by_flags(ids: DataFrame, flags: list[tuple[DataFrame, str]], smiles: DataFrame, default: str = "biolink:ChemicalEntity") -> DataFrame:
    """curie, type: of the first of ``flags`` (curie, type name) an id is in, else by structure, else the default."""
    from tessellon.operators.typing import type_of_smiles

    out = ids.select("curie").distinct().join(smiles.select("curie", "smiles").dropDuplicates(["curie"]), "curie", "left")
    kind = []
    for i, (df, t) in enumerate(flags):
        out = out.join(df.select("curie").distinct().withColumn(f"_f{i}", F.lit(t)), "curie", "left")
        kind.append(F.col(f"_f{i}"))
    return out.select("curie", F.coalesce(*kind, type_of_smiles("smiles"), F.lit(default)).alias("type"))


def unii_ids(rows: DataFrame, excluded_by: tuple[str, ...]) -> DataFrame:
    """Rows with any of the columns filled (organisms and the like) fall out."""
    from tessellon.operators.typing import type_of_smiles

    empty = [F.coalesce(F.col(c), F.lit("")) == "" for c in excluded_by]
    ok = empty[0]
    for e in empty[1:]:
        ok = ok & e
    return rows.where(ok).select(F.concat(F.lit("UNII:"), "unii").alias("curie"), F.coalesce(type_of_smiles(F.nullif("smiles", F.lit(""))), F.lit("biolink:ChemicalEntity")).alias("type"))


def drugbank_ids(reference: DataFrame, src_id: str = "2") -> DataFrame:
    return reference.where(F.col("src_id") == src_id).select(F.concat(F.lit("DRUGBANK:"), "src_compound_id").alias("curie")).distinct()


def registry_concord(rows: DataFrame) -> DataFrame:
    """``rows``: id, registry. CAS numbers and UNIIs as pairs; enzyme (EC) and taxon (txid) numbers are neither."""
    r = F.col("registry")
    obj = F.when(r.startswith("EC") | r.startswith("txid") | (r == "0") | (r == ""), None).when(is_cas("registry"), F.concat(F.lit("CAS:"), r)).otherwise(F.concat(F.lit("UNII:"), r))
    return rows.select(F.concat(F.lit("MESH:"), "id").alias("subject"), F.lit("reg").alias("predicate"), obj.alias("object")).where("object IS NOT NULL")


def registry_taxa(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("registry").startswith("txid")).select(F.concat(F.lit("MESH:"), "id").alias("subject"), F.lit("reg").alias("predicate"), F.concat(F.lit("NCBITaxon:"), F.substr("registry", F.lit(5))).alias("object"))


def wikidata_pairs(rows: DataFrame, both_unique: bool = True, drop_mesh_m: bool = False) -> DataFrame:
    """``rows``: subject, object. Pairs unique on both sides; with ``drop_mesh_m`` those with a MeSH id starting M fall out."""
    r = rows.where(~F.col("object").startswith("MESH:M")) if drop_mesh_m else rows
    return overused_xrefs(r, both_ways=both_unique)


# --- other vocabularies ----------------------------------------------------------------------------
def taxonomy(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows``: seq, tax_id, name, kind. Label ``scientific (genbank common)`` or the first there is of scientific, genbank common, any;
    all names as synonyms."""
    first = lambda k: F.min_by(F.when(F.col("kind") == k, F.col("name")), F.when(F.col("kind") == k, F.col("seq")))
    g = rows.groupBy("tax_id").agg(first("scientific name").alias("s"), first("genbank common name").alias("c"), F.min_by("name", "seq").alias("any"))
    label = F.when(F.col("s").isNotNull() & F.col("c").isNotNull(), F.concat("s", F.lit(" ("), "c", F.lit(")"))).otherwise(F.coalesce("s", "c", "any"))
    curie = F.concat(F.lit("NCBITaxon:"), "tax_id").alias("curie")
    return g.select(curie, label.alias("label")), rows.select(curie, F.lit(EXACT).alias("predicate"), F.col("name").alias("synonym")).distinct()


def table_names(rows: DataFrame, id_col: str, label_col: str, spelled: str, synonym_cols: tuple[str, ...] = (), sep: str = r"\|") -> tuple[DataFrame, DataFrame]:
    """Labels and synonyms of a plain table: families, model organisms, vocabularies, complexes."""
    curie = F.concat(F.lit(f"{spelled}:"), id_col).alias("curie")
    labels = rows.select(curie, F.col(label_col).alias("label")).where("label IS NOT NULL").dropDuplicates(["curie"])
    names = labels.select("curie", F.lit(EXACT).alias("predicate"), F.col("label").alias("synonym"))
    for c in synonym_cols:
        names = names.unionByName(rows.select(curie, F.lit(EXACT).alias("predicate"), F.explode(F.split(c, sep)).alias("synonym")).where("synonym <> '' AND synonym <> '-'"))
    return labels, names.distinct()


def broken_csv_names(rows: DataFrame) -> DataFrame:
    """Lines ``id,name, with commas,"quoted tail"``: id and the name put together again, the quoted tail dropped."""
    head = F.split("value", ',"')[0]
    parts = F.split(head, ",")
    return rows.select("seq", F.get(parts, F.lit(0)).alias("id"), F.array_join(F.slice(parts, 2, 1_000), ",").alias("name"))


def name_lines(rows: DataFrame) -> DataFrame:
    return rows.where("label IS NOT NULL AND label <> ''").dropDuplicates(["curie", "label"])


def _walk(node: dict, out: list) -> None:
    stack = [node]
    while stack:
        x = stack.pop()
        if x.get("stId"):
            out.append((x["stId"], x.get("name"), x.get("type")))
        stack.extend(x.get("children") or [])


def pathway_tree(trees: DataFrame, type_map: dict[str, str]) -> DataFrame:
    """``value``: a nested JSON node. curie, label, type of every node at any depth."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        for pdf in batches:
            rows: list = []
            for text in pdf["value"]:
                if text:
                    node = json.loads(text)
                    for n in node if isinstance(node, list) else [node]:
                        _walk(n, rows)
            yield pd.DataFrame(rows, columns=["id", "label", "kind"])

    spelled = F.element_at(F.create_map(*[v for k, t in type_map.items() for v in (F.lit(k), F.lit(t))]), F.col("kind"))
    return trees.select("value").mapInPandas(run, "id string, label string, kind string").select(F.concat(F.lit("REACT:"), "id").alias("curie"), "label", spelled.alias("type")).where("type IS NOT NULL").distinct()


def graph_json(nodes: DataFrame, renames: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """``nodes``: id, lbl, deprecated, xrefs (array). Labels, and pairs with renamed prefixes; deprecated nodes fall out."""
    n = nodes.where(~F.coalesce("deprecated", F.lit(False))).withColumn("curie", F.regexp_replace(F.element_at(F.split("id", "/"), -1), "_", ":"))
    x = n.select("curie", F.explode("xrefs").alias("x")).where(F.col("x").contains(":"))
    new = F.coalesce(F.element_at(F.create_map(*[v for k, p in renames.items() for v in (F.lit(k.upper()), F.lit(p))]), F.upper(prefix("x"))), prefix("x")) if renames else prefix("x")
    return n.where("lbl IS NOT NULL").select("curie", F.col("lbl").alias("label")), x.select(F.col("curie").alias("subject"), F.lit("xref").alias("predicate"), F.concat(new, F.lit(":"), suffix("x")).alias("object")).distinct()


def metabolites(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows`` of XML: accession, name, synonyms (array), smiles. Labels, synonyms, structures."""
    curie = F.concat(F.lit("HMDB:"), "accession").alias("curie")
    return rows.select(curie, F.col("name").alias("label")), rows.select(curie, F.lit(EXACT).alias("predicate"), F.explode("synonyms").alias("synonym")).distinct(), rows.where("smiles IS NOT NULL").select(curie, "smiles")


def articles(rows: DataFrame) -> dict[str, DataFrame]:
    """``rows``: file_seq, pos, pmid, title, doi, pmc, status. Baseline before updates (file_seq): the last title holds, statuses
    are united, ids pair."""
    curie = F.concat(F.lit("PMID:"), "pmid")
    titles = rows.where("title IS NOT NULL").groupBy("pmid").agg(F.max_by("title", F.struct("file_seq", "pos")).alias("label")).select(curie.alias("curie"), "label")
    statuses = rows.where("status IS NOT NULL").select(curie.alias("curie"), "status").distinct()
    pair = lambda c, p: rows.where(F.col(c).isNotNull() & (F.col(c) != "")).select(curie.alias("subject"), F.lit("eq").alias("predicate"), F.concat(F.lit(p), c).alias("object"))
    return {"ids": rows.select(curie.alias("curie")).distinct(), "titles": titles, "statuses": statuses, "concord": pair("doi", "doi:").unionByName(pair("pmc", "PMC:")).distinct()}


# Amino acids, three letters to one.
RESIDUES = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C", "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I",
    "Leu": "L", "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P", "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V",
}


def one_letter_sequence(c: Column | str) -> Column:
    """``Ala Arg-Gly`` to ``ARG``; null where a residue is unknown."""
    names = F.regexp_extract_all(F.col(c) if isinstance(c, str) else c, F.lit(r"([A-Za-z]+)"))
    letters = F.create_map(*[F.lit(x) for kv in RESIDUES.items() for x in kv])
    out = F.transform(names, lambda x: F.element_at(letters, F.initcap(x)))
    return F.when((F.size(out) > 0) & ~F.exists(out, lambda x: x.isNull()), F.array_join(out, ""))


def flat_file(rows: DataFrame) -> DataFrame:
    """``value``: an entry of a flat file (entries end with ``///``). id, names (of NAME, parted by ``;``), sequence (of SEQUENCE)."""
    section = lambda k: F.regexp_extract("value", rf"(?m)^{k} +(.*(?:\n +.*)*)", 1)
    joined = lambda k: F.trim(F.regexp_replace(section(k), r"\s*\n\s+", " "))
    ident = F.regexp_extract("value", r"(?m)^ENTRY +(\S+)", 1)
    return rows.where(ident != "").select("seq", ident.alias("id"), F.filter(F.transform(F.split(joined("NAME"), ";"), lambda x: F.trim(x)), lambda x: x != "").alias("names"), one_letter_sequence(F.nullif(joined("SEQUENCE"), F.lit(""))).alias("sequence"))


def omim_ids(rows: DataFrame, wanted: str) -> DataFrame:
    """``rows``: mim, kind. Genes by equality, phenotypes by containment."""
    ok = F.col("kind") == "gene" if wanted == "gene" else F.col("kind").contains("phenotype")
    return rows.where(ok).select(F.concat(F.lit("OMIM:"), "mim").alias("curie"))
