"""Queries of the domains' identifiers and concords, of further parsers and of the build, each with its SQL.

Parsers are fed from tables of like shape: every query runs over all rows of the tables it names.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tessellon.functions import curie as C
from tessellon.operators import build, cliques, closure, conflation, reports
from tessellon.operators.components import components
from tessellon.plans.data_sql import plain, value
from tessellon.plans.reference_queries import (
    _CLOSED, _COMP, _CONC, _IC, _IDT, _LAB, _MEM, _RANK_SQL, _SETS, _VOTE, BOOSTED, TYPE_ORDER, _concords, _ids, _member_labels, _members, _parts, _pfx, _rank_case, _ranks,
    _scores, _sets, _shredded, _synonyms, _tree, _types, _values, _typed_records,
)
from tessellon.session import Scratch, table
from tessellon.sources import domains, parsers, readers, sinks

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- cliques ---------------------------------------------------------------------------------------
@query(_COMP + " SELECT curie, clique FROM comp")
def op13_reloaded_sets(spark, d):
    """Earlier sets of any size (of curie_pairs) as the state that the pairs of drugchemical are merged into."""
    scratch = Scratch(spark, "op13")
    pairs = C.once(table(spark, d, "drugchemical").select(F.lit(1).alias("stage"), "file_seq", "seq", C.plain_curie("subject").alias("left"), C.plain_curie("object").alias("right")))
    earlier = C.once(table(spark, d, "curie_pairs").select(C.plain_curie("curie1").alias("a"), C.plain_curie("curie2").alias("b")))
    seed = cliques.seed_pairs(components(earlier, scratch).select(F.col("node").alias("curie"), F.col("component").alias("clique")))
    return cliques.glom(pairs.unionByName(seed.select(*pairs.columns)), scratch, ())


_PROCESS = domains.VOTE_ORDER["process"]


@query(f"""WITH {_MEM}, {_IDT}, {_VOTE.replace(_rank_case('type', TYPE_ORDER), _rank_case('type', _PROCESS))},
led AS (SELECT clique, min_by(type, curie) AS type FROM known WHERE {_pfx('curie')} = 'GO' GROUP BY clique)
SELECT c.clique, coalesce(led.type, voted.type) AS type FROM (SELECT DISTINCT clique FROM mem) c LEFT JOIN led ON led.clique = c.clique LEFT JOIN voted ON voted.clique = c.clique""")
def op22_process_types(spark, d):
    return domains.typed(_members(spark, d), _types(spark, d), "process")


_GP = f"""s AS (SELECT DISTINCT clique AS leader, curie FROM sets), genes AS (SELECT * FROM s WHERE {_pfx('leader')} = 'NCBIGENE'), proteins AS (SELECT * FROM s WHERE {_pfx('leader')} = 'UNIPROTKB'),
gr AS (SELECT {plain('curie1')} AS a, {plain('curie2')} AS b FROM curie_pairs), groups AS (SELECT a AS clique, a AS curie FROM gr WHERE {_pfx('a')} = 'NCBIGENE' AND {_pfx('b')} = 'UNIPROTKB' UNION SELECT a, b FROM gr WHERE {_pfx('a')} = 'NCBIGENE' AND {_pfx('b')} = 'UNIPROTKB')"""


@query(f"""WITH {_SETS}, {_GP}, g AS (SELECT DISTINCT leader FROM genes), p AS (SELECT DISTINCT leader FROM proteins),
seen AS (SELECT groups.*, g.leader IS NOT NULL AS ing, p.leader IS NOT NULL AS inp FROM groups LEFT JOIN g ON g.leader = curie LEFT JOIN p ON p.leader = curie),
done AS (SELECT clique, min(CASE WHEN ing THEN curie END) AS gene FROM seen GROUP BY clique HAVING bool_and(ing OR inp) AND count(CASE WHEN ing THEN 1 END) = 1 AND count(CASE WHEN inp THEN 1 END) > 0),
t AS (SELECT curie AS leader, gene FROM seen JOIN done USING (clique)), b AS (SELECT *, 'gene' AS kind FROM genes UNION ALL SELECT *, 'protein' FROM proteins)
SELECT coalesce(gene, b.leader) AS leader, curie, CASE WHEN gene IS NOT NULL THEN 'merged' ELSE kind END AS kind FROM b LEFT JOIN t ON t.leader = b.leader""")
def op53_merged_gene_protein(spark, d):
    s = _sets(spark, d).select(F.col("clique").alias("leader"), "curie").distinct()
    g = C.once(table(spark, d, "curie_pairs").select(C.plain_curie("curie1").alias("a"), C.plain_curie("curie2").alias("b"))).where((C.prefix("a") == "NCBIGENE") & (C.prefix("b") == "UNIPROTKB"))
    groups = g.select(F.col("a").alias("clique"), F.explode(F.array("a", "b")).alias("curie")).distinct()
    return conflation.merged_gene_protein(s.where(C.prefix("leader") == "NCBIGENE"), s.where(C.prefix("leader") == "UNIPROTKB"), groups)


@query(f"""WITH {_CONC}, p AS (SELECT DISTINCT subject, predicate, object FROM conc WHERE subject <> object AND predicate IS NOT NULL),
k AS (SELECT *, count(*) OVER (PARTITION BY predicate, subject) AS s, count(*) OVER (PARTITION BY predicate, object) AS o FROM p)
SELECT subject, predicate, object FROM k WHERE predicate NOT IN ('has_form', 'has_ingredient') OR (s = 1 AND o = 1)""")
def op56_one_to_one(spark, d):
    return conflation.single_use(_concords(spark, d), (), ("has_form", "has_ingredient"))


_VALID = "vp AS (SELECT a, b FROM gp WHERE a IN (SELECT curie FROM ids0) AND b IN (SELECT curie FROM ids0))"


@query(f"""WITH RECURSIVE {_IDT}, gp AS (SELECT * FROM (SELECT {plain('curie1')} AS a, {plain('curie2')} AS b FROM curie_pairs) WHERE {_pfx('a')} IN ('NCBIGENE', 'UNIPROTKB') AND {_pfx('b')} IN ('NCBIGENE', 'UNIPROTKB')), {_VALID},
e AS (SELECT a, b FROM vp UNION SELECT b, a FROM vp), r AS (SELECT a AS x, a AS y FROM e UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a), c AS (SELECT x AS curie, min(y) AS clique FROM r GROUP BY x)
SELECT clique, (row_number() OVER (PARTITION BY clique ORDER BY {_pfx('curie')} <> 'NCBIGENE', curie) - 1)::INT AS pos, curie FROM c""")
def op52_gene_protein(spark, d):
    p = C.once(table(spark, d, "curie_pairs").select(F.lit(0).alias("file_seq"), F.col("pair_id").alias("seq"), C.plain_curie("curie1").alias("subject"), C.plain_curie("curie2").alias("object")))
    both = p.where(C.prefix("subject").isin("NCBIGENE", "UNIPROTKB") & C.prefix("object").isin("NCBIGENE", "UNIPROTKB"))
    known = _ids(spark, d)
    return conflation.gene_protein(both, known.where(C.prefix("curie") == "NCBIGENE"), known.where(C.prefix("curie") == "UNIPROTKB"), Scratch(spark, "op52"), ("NCBIGENE", "UNIPROTKB"))


# --- files and metadata ----------------------------------------------------------------------------
@query("SELECT * FROM (VALUES ('Clique'), ('Edge'), ('Node')) t(name)")
def op88_expected_files(spark, d):
    """The export of the compendium holds its three tables and nothing else; anything else is an error."""
    s = Scratch(spark, "op88")
    sinks.write_tables(sinks.clique_tables(s.write(_typed_records(spark, d), "records")), f"{s.root}/export")
    reports.assert_files(spark, f"{s.root}/export", ["Clique", "Edge", "Node"])
    return spark.createDataFrame([("Clique",), ("Edge",), ("Node",)], "name string")


@query("SELECT filename AS name, count(*) AS predicates FROM known_predicates GROUP BY filename")
def op94_combined_metadata(spark, d):
    """The inputs of a result nested by name: names that repeat become lists, counted here."""
    parts = [{"name": r["filename"], "predicate": r["predicate"]} for r in table(spark, d, "known_predicates").collect()]  # a fixed list
    text = reports.combined_metadata("predicates", parts)
    nested = json.loads(text)["combined_from"]
    return spark.createDataFrame([(k, len(v) if isinstance(v, list) else 1) for k, v in nested.items()], "name string, predicates long")


@query(f"WITH {_IDT} SELECT curie, count(*) AS n FROM ids0 GROUP BY curie")
def op104_compressed_text(spark, d):
    s = Scratch(spark, "op104")
    sinks.gzip_text(_ids(spark, d).select("curie"), f"{s.root}/text")
    return spark.read.text(f"{s.root}/text").groupBy(F.col("value").alias("curie")).agg(F.count("*").alias("n"))


_CELLS = "replace(replace(coalesce(preferred_name, ''), chr(10), ' '), '|', '/')"


def _cells(c: str):
    return F.translate(F.coalesce(c, F.lit("")), "\n|", " /")


@query(f"SELECT row_id AS seq, {plain('clique_leader')} AS cui, 'A' || row_id AS aui, provider AS sab, 'PT' AS tty, 'X' || row_id AS code, {_CELLS} AS term FROM clique WHERE {plain('clique_leader')} IS NOT NULL AND provider IS NOT NULL AND row_id % 3 <> 0 AND row_id % 5 <> 0 AND row_id % 7 <> 0")
def op110_concept_rows(spark, d):
    c = C.once(table(spark, d, "clique").select("row_id", C.plain_curie("clique_leader").alias("leader"), "provider", _cells("preferred_name").alias("term"))).where("leader IS NOT NULL AND provider IS NOT NULL")
    e = F.lit("")
    held = F.when(F.col("row_id") % 5 == 0, "O").when(F.col("row_id") % 7 == 0, "E").otherwise("N")
    line = F.concat_ws("|", "leader", F.when(F.col("row_id") % 3 == 0, "GER").otherwise("ENG"), e, e, e, e, e, F.concat(F.lit("A"), "row_id"), e, e, e, "provider", F.lit("PT"), F.concat(F.lit("X"), "row_id"), "term", e, held, e)
    return parsers.conso(c.select(F.col("row_id").alias("seq"), line.alias("value")))


# --- genes and proteins ----------------------------------------------------------------------------
@query("""WITH m AS (SELECT p_partkey AS mim, CASE WHEN p_size % 4 = 0 THEN '-' ELSE p_size::VARCHAR END AS gene, CASE WHEN p_size % 3 = 0 THEN 'phenotype' ELSE 'gene' END AS kind, CASE WHEN p_size % 2 = 0 THEN '-' ELSE 'C' || p_partkey END AS cui FROM part)
SELECT 'NCBIGene:' || gene AS subject, 'eq' AS predicate, 'OMIM:' || mim AS object FROM m WHERE kind = 'gene' AND gene <> '-' UNION ALL SELECT 'NCBIGene:' || gene, 'eq', 'UMLS:' || cui FROM m WHERE kind = 'gene' AND gene <> '-' AND cui <> '-'""")
def op118_medgen(spark, d):
    n = F.col("p_size")
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("mim"), F.when(n % 4 == 0, "-").otherwise(n.cast("string")).alias("gene_id"), F.when(n % 3 == 0, "phenotype").otherwise("gene").alias("kind"), F.when(n % 2 == 0, "-").otherwise(F.concat(F.lit("C"), "p_partkey")).alias("cui"))
    return parsers.medgen(rows)


@query(f"""WITH {_IDT}, g AS (SELECT DISTINCT curie AS cui FROM ids0 WHERE type = 'biolink:Gene'), bad AS (SELECT {plain('clique_leader')} AS cui FROM clique WHERE regexp_matches(lower(preferred_name), '\\b(allele|mutation)\\b') OR contains(coalesce(preferred_name, ''), '.'))
SELECT 'UMLS:' || cui AS curie, 'biolink:Gene' AS type FROM g WHERE cui NOT IN (SELECT cui FROM bad WHERE cui IS NOT NULL) AND cui NOT IN (SELECT {plain('curie1')} FROM curie_pairs WHERE {plain('curie1')} IS NOT NULL)""")
def op119_gene_concepts(spark, d):
    sty = _ids(spark, d).select(F.col("curie").alias("cui"), F.when(F.col("type") == "biolink:Gene", "A1.2.3.5").otherwise("X").alias("tree"))
    rows = table(spark, d, "clique").select(C.plain_curie("clique_leader").alias("cui"), F.lit("OMIM").alias("sab"), F.coalesce("preferred_name", F.lit("")).alias("code"), F.col("preferred_name").alias("term"))
    blocked = table(spark, d, "curie_pairs").select(C.plain_curie("curie1").alias("cui"))
    return parsers.gene_concepts(sty, rows, blocked)


@query("""SELECT DISTINCT 'ENSEMBL:' || p_partkey AS subject, 'eq' AS predicate, x AS object FROM (SELECT p_partkey, unnest([CASE WHEN p_size % 2 = 0 THEN 'NCBIGene:' || p_size END, CASE WHEN p_size % 3 <> 0 THEN 'HGNC:' || p_brand END]) AS x FROM part) WHERE x IS NOT NULL""")
def op120_wide_ids(spark, d):
    p = table(spark, d, "part")
    key = F.col("p_partkey").cast("string").alias("id")
    wide = parsers.merge_batches("id", p.where("p_size % 2 = 0").select(key, F.col("p_size").cast("string").alias("a")), p.select(key, F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand")).alias("b")))
    return parsers.unpivot_ids(wide, "id", {"a": "NCBIGene", "b": "HGNC"})


@query("SELECT c_custkey AS seq, 'UniProtKB:P' || c_custkey AS curie, c_name AS label FROM customer")
def op122_sequence_labels(spark, d):
    c = table(spark, d, "customer")
    head = c.select(F.col("c_custkey").alias("seq"), F.concat(F.lit(">sp|P"), "c_custkey", F.lit("|X_"), "c_custkey", F.lit(" "), "c_name", F.lit(" OS=Homo sapiens OX=9606")).alias("value"))
    return parsers.fasta_labels(head.unionByName(c.select(F.col("c_custkey").alias("seq"), F.lit("MKVL").alias("value"))))


@query("SELECT DISTINCT 'UMLS:C' || p_size AS subject, 'eq' AS predicate, 'UniProtKB:' || p_partkey AS object FROM part WHERE p_size % 3 <> 0 UNION ALL SELECT DISTINCT 'NCIT:' || p_brand, 'eq', 'UniProtKB:' || p_partkey FROM part")
def op123_protein_concepts(spark, d):
    rows = table(spark, d, "part").select(F.when(F.col("p_size") % 3 == 0, "").otherwise(F.concat(F.lit("C"), "p_size")).alias("umls"), F.col("p_brand").alias("nci"), F.col("p_partkey").cast("string").alias("uniprot"))
    a, b = parsers.uniprot_from_umls(rows)
    return a.unionByName(b)


@query("SELECT 'PUBCHEM.COMPOUND:' || p_partkey AS curie, 'é ' || p_name AS label FROM part")
def op124_latin_labels(spark, d):
    """A compressed table in ISO-8859-1, written and read again."""
    s = Scratch(spark, "op124")
    rows = table(spark, d, "part").select(F.concat(F.lit("PUBCHEM.COMPOUND:"), "p_partkey").alias("a"), F.concat(F.lit("é "), "p_name").alias("b"))
    rows.write.options(sep="\t", encoding="ISO-8859-1", compression="gzip", quote="").csv(f"{s.root}/names")
    return readers.fields(readers.lines(spark, f"{s.root}/names", "ISO-8859-1"), "curie", "label").select("curie", "label")


# --- chemicals -------------------------------------------------------------------------------------
_SM = f"s AS (SELECT {plain('clique_leader')} AS curie, min(preferred_name) AS smiles FROM clique WHERE preferred_name IS NOT NULL GROUP BY 1)"
_KIND = "CASE WHEN contains(smiles, '.') THEN 'biolink:MolecularMixture' WHEN smiles IS NOT NULL THEN 'biolink:SmallMolecule' ELSE 'biolink:ChemicalEntity' END"


@query(f"WITH {_MEM}, {_LAB}, {_SM} SELECT i.curie, {_KIND} AS type FROM (SELECT DISTINCT curie FROM lab) i LEFT JOIN s USING (curie)")
def op126_typed_labels(spark, d):
    smiles = C.once(table(spark, d, "clique").select(C.plain_curie("clique_leader").alias("curie"), F.col("preferred_name").alias("smiles"))).where("curie IS NOT NULL AND smiles IS NOT NULL")
    return parsers.typed_by_flags(_member_labels(spark, d), [], smiles.groupBy("curie").agg(F.min("smiles").alias("smiles")))


@query("SELECT 'GTOPDB:' || p_partkey AS curie, 'α-' || p_name || ' & x' AS label, CASE WHEN p_size % 2 = 0 THEN 'INCHIKEY:' || p_brand END AS inchikey FROM part")
def op131_ligands(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("<i>&alpha;</i>-"), "p_name", F.lit(" &amp; x")).alias("name"), F.lit("").alias("synonyms"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("").alias("inchikey"))
    labels, keys = parsers.gtopdb(rows)
    return labels.join(keys.select(F.col("subject").alias("curie"), F.col("object").alias("inchikey")), "curie", "left")


@query("""SELECT 'CHEBI:' || s_suppkey AS subject, 'xref' AS predicate, 'INCHIKEY:' || s_name AS object FROM supplier UNION ALL SELECT 'CHEBI:' || s_suppkey, 'xref', 'KEGG.COMPOUND:C' || s_suppkey FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT 'CHEBI:' || p_partkey, 'xref', CASE WHEN p_size % 2 = 0 THEN 'KEGG.COMPOUND:' ELSE 'PUBCHEM.COMPOUND:' END || p_brand FROM part WHERE p_size % 3 <> 0 AND p_partkey NOT IN (SELECT s_suppkey FROM supplier)""")
def op132_structure_records(spark, d):
    s = table(spark, d, "supplier")
    line = lambda name, v: F.concat(F.lit(f"> <{name}>\n"), v, F.lit("\n\n"))
    text = F.concat(F.lit("head\n"), line("ChEBI ID", F.concat(F.lit("CHEBI:"), "s_suppkey")), line("InChIKey", F.col("s_name")), F.when(F.col("s_suppkey") % 2 == 0, line("KEGG COMPOUND Database Links", F.concat(F.lit("C"), "s_suppkey"))).otherwise(""))
    rest = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 3 == 0, "other").when(F.col("p_size") % 2 == 0, "KEGG COMPOUND accession").otherwise("Pubchem accession").alias("kind"), F.col("p_brand").alias("value"))
    return parsers.chebi(parsers.sdf_records(s.select(F.col("s_suppkey").alias("seq"), text.alias("value"))), rest)[0]


@query(f"SELECT 'UNII:' || row_id AS curie, {_KIND.replace('smiles', 's')} AS type FROM (SELECT row_id, nullif(preferred_name, '') AS s FROM clique WHERE coalesce(provider, '') = '' OR provider <> 'gene_feed')")
def op134_unii_ids(spark, d):
    rows = table(spark, d, "clique").select(F.col("row_id").alias("unii"), F.coalesce("preferred_name", F.lit("")).alias("smiles"), F.when(F.col("provider") == "gene_feed", "9606").alias("taxon"))
    return parsers.unii_ids(rows, ("taxon",))


@query("SELECT DISTINCT 'DRUGBANK:' || l_partkey AS curie FROM lineitem WHERE l_linenumber = 2")
def op135_drugbank_ids(spark, d):
    return parsers.drugbank_ids(table(spark, d, "lineitem").select(F.col("l_linenumber").cast("string").alias("src_id"), F.col("l_partkey").alias("src_compound_id")))


@query("""SELECT DISTINCT 'HGNC.FAMILY:' || p_partkey AS curie, 'oio:hasExactSynonym' AS predicate, s AS synonym FROM (SELECT p_partkey, unnest(list_concat([p_type], string_split(p_name, ' '))) AS s FROM part) WHERE s <> ''""")
def op139_table_names(spark, d):
    return parsers.table_names(table(spark, d, "part"), "p_partkey", "p_type", "HGNC.FAMILY", ("p_name",), " ")[1]


@query("SELECT DISTINCT 'PANTHER.PATHWAY:' || p_size AS curie, p_type AS label FROM part")
def op141_pathway_names(spark, d):
    return parsers.name_lines(table(spark, d, "part").select(F.concat(F.lit("PANTHER.PATHWAY:"), "p_size").alias("curie"), F.col("p_type").alias("label")))


@query("""SELECT 'REACT:R' || r_regionkey AS curie, r_name AS label, 'biolink:Pathway' AS type FROM region UNION ALL SELECT 'REACT:N' || n_nationkey, n_name, 'biolink:BiologicalProcess' FROM nation WHERE n_nationkey % 2 = 0""")
def op142_pathway_tree(spark, d):
    n = table(spark, d, "nation").select("n_regionkey", F.struct(F.concat(F.lit("N"), "n_nationkey").alias("stId"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, "Reaction").otherwise("Other").alias("type")).alias("x"))
    r = table(spark, d, "region").join(n.groupBy("n_regionkey").agg(F.collect_list("x").alias("children")), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    tree = F.to_json(F.struct(F.concat(F.lit("R"), "r_regionkey").alias("stId"), F.col("r_name").alias("name"), F.lit("Pathway").alias("type"), "children"))
    return parsers.pathway_tree(r.select(tree.alias("value")), {"Pathway": "biolink:Pathway", "Reaction": "biolink:BiologicalProcess"})


_DOID = domains.XREFS["disease DOID"]["renames"]
_XREF = ("NCI", "UMLS_CUI", "icdo", "MESH")


@query(f"""SELECT DISTINCT 'DOID:' || p_partkey AS subject, 'xref' AS predicate, CASE p_size % 4 WHEN 0 THEN 'NCIT' WHEN 1 THEN 'UMLS' WHEN 2 THEN 'ICD0' ELSE 'MESH' END || ':' || p_size AS object FROM part WHERE p_size % 5 <> 0""")
def op143_graph_xrefs(spark, d):
    p = table(spark, d, "part")
    x = F.concat(F.element_at(F.array(*map(F.lit, _XREF)), (F.col("p_size") % 4 + 1).cast("int")), F.lit(":"), "p_size")
    nodes = p.select(F.concat(F.lit("http://purl.obolibrary.org/obo/DOID_"), "p_partkey").alias("id"), F.col("p_name").alias("lbl"), (F.col("p_size") % 5 == 0).alias("deprecated"), F.array(x, F.lit("none")).alias("xrefs"))
    return parsers.graph_json(nodes, _DOID)[1]


@query("SELECT DISTINCT 'HMDB:' || p_partkey AS curie, 'oio:hasExactSynonym' AS predicate, unnest(string_split(p_name, ' ')) AS synonym FROM part")
def op144_metabolite_names(spark, d):
    """Rows as XML, written and read again."""
    s = Scratch(spark, "op144")
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("accession"), F.col("p_type").alias("name"), F.struct(F.split("p_name", " ").alias("synonym")).alias("synonyms"))
    rows.write.format("xml").options(rowTag="metabolite", rootTag="set").save(f"{s.root}/xml")
    back = readers.xml_rows(spark, f"{s.root}/xml", "metabolite", "accession STRING, name STRING, synonyms STRUCT<synonym: ARRAY<STRING>>, smiles STRING")
    return parsers.metabolites(back.selectExpr("accession", "name", "synonyms.synonym AS synonyms", "smiles"))[1]


@query("SELECT 'bad' AS kind, count(*) AS files FROM region WHERE r_regionkey % 2 = 1")
def op146_checksums(spark, d):
    """A file per region with its checksum beside it, every second one wrong."""
    from tessellon import files

    s = Scratch(spark, "op146")
    regions = table(spark, d, "region").select("r_regionkey", "r_name", F.md5("r_name").alias("sum")).collect()  # five rows
    for r in regions:
        files.replace(spark, f"{s.root}/md5/{r['r_regionkey']}.gz", r["r_name"])
        files.replace(spark, f"{s.root}/md5/{r['r_regionkey']}.gz.md5", f"MD5(x)= {r['sum'] if r['r_regionkey'] % 2 == 0 else '0' * 32}\n")
    return readers.md5_mismatches(spark, f"{s.root}/md5").groupBy(F.lit("bad").alias("kind")).agg(F.count("*").alias("files"))


@query("SELECT p_partkey AS seq, 'C' || p_partkey AS id, array_to_string(string_split(p_name, ' '), '|') AS names, CASE WHEN p_size % 2 = 0 THEN 'ARG' END AS sequence FROM part")
def op147_flat_entries(spark, d):
    p = table(spark, d, "part")
    text = F.concat(F.lit("ENTRY       C"), "p_partkey", F.lit("   Peptide\nNAME        "), F.regexp_replace("p_name", " ", ";\n            "), F.lit("\nSEQUENCE    Ala "), F.when(F.col("p_size") % 2 == 0, "Arg").otherwise("Zzz"), F.lit("\n            Gly\n"))
    return parsers.flat_file(p.select(F.col("p_partkey").alias("seq"), text.alias("value"))).withColumn("names", F.array_join("names", "|"))


@query("SELECT 'OMIM:' || p_partkey AS curie FROM part WHERE p_size % 3 = 1")
def op148_omim_genes(spark, d):
    kind = F.when(F.col("p_size") % 3 == 1, "gene").when(F.col("p_size") % 3 == 2, "gene/phenotype").otherwise("phenotype")
    return parsers.omim_ids(table(spark, d, "part").select(F.col("p_partkey").alias("mim"), kind.alias("kind")), "gene")


@query(f"WITH {_CONC} SELECT subject, coalesce(predicate, 'none') AS predicate, object FROM conc")
def op150_manual_concord(spark, d):
    """A file of pairs with comments and blank lines, written and read again."""
    s = Scratch(spark, "op150")
    lines = _concords(spark, d).select(F.explode(F.array(F.concat_ws("\t", "subject", F.coalesce("predicate", F.lit("none")), "object"), F.lit("# comment"), F.lit("  "))).alias("value"))
    lines.write.text(f"{s.root}/concord")
    return readers.manual_concord(spark, f"{s.root}/concord").select("subject", "predicate", "object")


# --- the domains' identifiers ----------------------------------------------------------------------
def _reached(spark, d, roots: dict[str, str]):
    """Closure of the tree of regions, nations and their members, its roots renamed."""
    names = spark.createDataFrame(list(roots.items()), "old string, root string")
    found = closure.subclasses(_tree(spark, d), names.select(F.col("old").alias("root")), Scratch(spark, "reached"))
    return found.withColumnRenamed("root", "old").join(names, "old").select("root", "node")


def _ids_sql(roots: dict[str, str], domain: str) -> str:
    order = domains.VOTE_ORDER.get(domain, ())
    rows = [(old, domains.ROOTS[domain][new], order.index(domains.ROOTS[domain][new]) if domains.ROOTS[domain][new] in order else 0) for old, new in roots.items()]
    return f"WITH RECURSIVE {_CLOSED}, k AS (SELECT * FROM {_values(rows, 'old', 'type', 'rank')}) SELECT node AS curie, arg_min(type, (rank, type)) AS type FROM r JOIN k ON old = root WHERE node NOT LIKE 'R:%' GROUP BY node"


_ANATOMY = {"R:0": "UBERON:0001062", "R:1": "UBERON:0010000", "R:2": "CL:0000000", "R:3": "GO:0005575"}
_DISEASE = {"R:0": "MONDO:0000001", "R:1": "HP:0000118", "R:2": "EFO:0000651"}
_PROC = {"R:0": "GO:0007165", "R:1": "GO:0008150", "R:2": "GO:0003674"}
_PROT = {"R:0": "PR:000000001"}


def _ontology(roots, domain, name):
    @query(_ids_sql(roots, domain))
    def run(spark, d):
        return domains.ontology_ids(_reached(spark, d, roots).where(~F.col("node").startswith("R:")), domain)

    QUERIES[name], SQL[name] = QUERIES.pop("run"), SQL.pop("run")


for _n, _r, _d in (("op151_anatomy_ids", _ANATOMY, "anatomy"), ("op154_disease_ids", _DISEASE, "disease"), ("op158_process_ids", _PROC, "process"), ("op171_protein_ids", _PROT, "protein")):
    _ontology(_r, _d, _n)


def _branch_sql(domain: str, letter: str) -> str:
    rows = [(b, "EXCLUDE", 0) for b in domains.MESH_EXCLUDED.get(domain, ())] + [(b, t, i + 1) for i, (b, t) in enumerate(domains.MESH_BRANCHES[domain])]
    extra = f"UNION ALL SELECT p_partkey, '{domains.MESH_RECORDS[domain][1]}', 1000000 FROM part WHERE p_size % 6 = 0" if domain in domains.MESH_RECORDS else ""
    return f"""WITH n AS (SELECT p_partkey, {_number_sql(letter)} AS num FROM part), b AS (SELECT * FROM {_values(rows, 'branch', 'type', 'rank')}),
m AS (SELECT p_partkey, type, rank FROM n JOIN b ON num = branch OR starts_with(num, branch || '.') {extra})
SELECT 'MESH:' || p_partkey AS curie, arg_min(type, (type <> 'EXCLUDE', rank, type)) AS type FROM m GROUP BY 1 HAVING min_by(type, (type <> 'EXCLUDE', rank, type)) <> 'EXCLUDE'"""


def _number_sql(letter: str) -> str:
    return f"'{letter}' || lpad(((p_size % 26) + 1)::VARCHAR, 2, '0') || CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '.284.5' WHEN 2 THEN '.125' ELSE '.776.9' END"


def _mesh(domain: str, letter: str, name: str):
    @query(_branch_sql(domain, letter))
    def run(spark, d):
        p, k = table(spark, d, "part"), F.col("p_partkey") % 4
        number = F.concat(F.lit(letter), F.lpad((F.col("p_size") % 26 + 1).cast("string"), 2, "0"), F.when(k == 0, "").when(k == 1, ".284.5").when(k == 2, ".125").otherwise(".776.9"))
        records = p.where("p_size % 6 = 0").select(F.col("p_partkey").alias("id"), F.lit(domains.MESH_RECORDS[domain][0]).alias("class")) if domain in domains.MESH_RECORDS else None
        return domains.mesh_ids(p.select(F.col("p_partkey").alias("id"), number.alias("number")), domain, records)

    QUERIES[name], SQL[name] = QUERIES.pop("run"), SQL.pop("run")


for _n, _l, _d in (("op152_anatomy_terms", "A", "anatomy"), ("op154_disease_terms", "C", "disease"), ("op172_taxon_terms", "B", "taxon"), ("op173_chemical_terms", "D", "chemicals")):
    _mesh(_d, _l, _n)


def _umls(domain: str, name: str):
    """Semantic types from the table of events: every user has the trees its events' numbers stand for."""
    trees = [*sorted(domains.UMLS_TREES[domain]), *domains.UMLS_BLOCKED.get(domain, ()), "Z9"]
    kinds, blocked = list(domains.UMLS_TREES[domain].items()), domains.UMLS_BLOCKED.get(domain, ())
    held = " OR ".join(f"tree = '{b}'" for b in blocked) or "false"

    @query(f"""WITH t AS (SELECT event_id AS seq, 'C' || user_id AS cui, {list(trees)}[event_id % {len(trees)} + 1] AS tree FROM events)
SELECT 'UMLS:' || cui AS curie, arg_min(type, (seq, type)) FILTER (type IS NOT NULL) AS type FROM t LEFT JOIN {_values(kinds, 'k', 'type')} m ON k = tree GROUP BY cui HAVING count(type) > 0 AND NOT bool_or({held})""")
    def run(spark, d):
        e = table(spark, d, "events")
        tree = F.element_at(F.array(*map(F.lit, trees)), (F.col("event_id") % len(trees) + 1).cast("int"))
        return domains.umls_ids(e.select(F.col("event_id").alias("seq"), F.concat(F.lit("C"), "user_id").alias("cui"), tree.alias("tree")), domain)

    QUERIES[name], SQL[name] = QUERIES.pop("run"), SQL.pop("run")


for _d in ("anatomy", "disease", "process", "protein", "taxon", "chemicals"):
    _umls(_d, {"anatomy": "op152", "disease": "op154", "process": "op158", "protein": "op171", "taxon": "op172", "chemicals": "op173"}[_d] + f"_{_d}_concepts")


@query("SELECT 'WormBase:' || p_partkey AS curie, 'biolink:Gene' AS type FROM part UNION ALL SELECT 'HGNC:' || s_suppkey, 'biolink:Gene' FROM supplier")
def op156_gene_ids(spark, d):
    """Identifiers out of label files and of a document per gene."""
    mods = table(spark, d, "part").select(F.col("p_partkey").alias("seq"), F.concat(F.lit("WormBase:"), "p_partkey", F.lit("\t"), "p_name").alias("value"))
    docs = table(spark, d, "supplier").select(F.concat(F.lit("HGNC:"), "s_suppkey").alias("hgnc_id"), F.col("s_name").alias("symbol"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("array<string>").alias("alias_symbol"), F.lit(None).cast("array<string>").alias("alias_name"))
    return readers.project_ids(mods, "biolink:Gene").select("curie", "type").unionByName(parsers.hgnc(docs)[0].select("curie", F.lit("biolink:Gene").alias("type")))


# --- the domains' concords -------------------------------------------------------------------------
_SEG = {"AUTOMOBILE": "FMA", "BUILDING": "MSH", "FURNITURE": "Orphanet", "HOUSEHOLD": "ICD-10", "MACHINERY": "REACTOME"}


def _customer_triples(spark, d, predicate: str):
    c = table(spark, d, "customer")
    p = F.element_at(F.create_map(*[F.lit(x) for kv in _SEG.items() for x in kv]), F.col("c_mktsegment"))
    return c.select(F.concat(F.lit("C:"), "c_custkey").alias("s"), F.lit(predicate).alias("p"), F.concat(p, F.lit(":"), "c_nationkey").alias("o"))


def _concord_sql(source: str, roots: dict[str, str]) -> str:
    x = domains.XREFS[source]
    spelled = [(seg, p, x["renames"].get(p.upper(), p)) for seg, p in _SEG.items() if p not in x["ignored"]]
    used = ", ".join(f"'{old}'" for old, new in roots.items() if new in x["roots"])
    return f"WITH RECURSIVE {_CLOSED} SELECT DISTINCT 'C:' || c_custkey AS subject, 'xref' AS predicate, new || ':' || c_nationkey AS object FROM r JOIN customer ON node = 'C:' || c_custkey JOIN {_values(spelled, 'seg', 'old', 'new')} k ON seg = c_mktsegment WHERE root IN ({used})"


def _ontology_concord(source: str, roots: dict[str, str], name: str):
    predicate = {"xref": closure.XREF, "exact": closure.EXACT[0], "close": closure.CLOSE[0]}[domains.XREFS[source]["match"]]

    @query(_concord_sql(source, roots))
    def run(spark, d):
        reached = _reached(spark, d, roots)
        # nodes come under the prefix of their root, and go back to their own
        mine = reached.select("root", F.concat(C.prefix("root"), F.lit(":"), "node").alias("node"))
        t = _customer_triples(spark, d, predicate)
        triples = None
        for pre in sorted({r.split(":")[0] for r in roots.values()}):
            part = t.select(F.concat(F.lit(f"{pre}:"), "s").alias("s"), "p", "o")
            triples = part if triples is None else triples.unionByName(part)
        return domains.ontology_concord(mine, triples, source).withColumn("subject", C.suffix("subject")).distinct()

    QUERIES[name], SQL[name] = QUERIES.pop("run"), SQL.pop("run")


for _n, _s, _r in (
    ("op153_anatomy_xrefs", "anatomy", _ANATOMY), ("op155_disease_xrefs", "disease HP", _DISEASE), ("op155_disease_exact", "disease MONDO", _DISEASE), ("op155_disease_close", "disease MONDO_close", _DISEASE), ("op159_process_xrefs", "process", _PROC), ("op171_protein_xrefs", "protein", _PROT),
):
    _ontology_concord(_s, _r, _n)


def _umls_concord(domain: str, name: str, rxnorm: bool = False):
    """Concept rows from the line items: the source by line number, listed identifiers by the parts' sizes."""
    known = {k: v for k, v in domains.UMLS_SOURCES[domain].items() if not (rxnorm and k == "RXNORM")}
    sources = [*known, "OTHER"]
    tty = {s: parsers.TERM_TYPES.get(s, ("PT",))[0] for s in sources}
    strict = ", ".join(f"'{p}'" for p in domains.LISTED_ONLY.get(domain, ())) or "''"

    @query(f"""WITH x AS (SELECT 'C' || l_orderkey AS cui, {sources}[(l_linenumber + l_suppkey) % {len(sources)} + 1] AS sab, l_partkey AS code FROM lineitem)
SELECT DISTINCT '{'RXCUI' if rxnorm else 'UMLS'}:' || cui AS subject, 'eq' AS predicate, pre || ':' || code AS object FROM x JOIN {_values(list(known.items()), 'k', 'pre')} m ON k = sab WHERE pre NOT IN ({strict}) OR code IN (SELECT p_partkey FROM part WHERE p_size % 2 = 0)""")
    def run(spark, d):
        sab = F.element_at(F.array(*map(F.lit, sources)), ((F.col("l_linenumber") + F.col("l_suppkey")) % len(sources) + 1).cast("int"))
        rows = table(spark, d, "lineitem").select(F.concat(F.lit("C"), "l_orderkey").alias("cui"), sab.alias("sab"), F.col("l_partkey").cast("string").alias("code"))
        rows = rows.withColumn("tty", F.element_at(F.create_map(*[F.lit(v) for kv in tty.items() for v in kv]), F.col("sab")))
        if rxnorm:
            return domains.rxnorm_concord(rows)
        listed = None
        for p in domains.LISTED_ONLY.get(domain, ()):
            part = table(spark, d, "part").where("p_size % 2 = 0").select(F.concat(F.lit(f"{p}:"), "p_partkey").alias("curie"))
            listed = part if listed is None else listed.unionByName(part)
        return domains.umls_concord(rows, domain, None, listed)

    QUERIES[name], SQL[name] = QUERIES.pop("run"), SQL.pop("run")


for _d, _n in (("anatomy", "op153"), ("disease", "op155"), ("gene", "op157"), ("process", "op159"), ("protein", "op171"), ("taxon", "op172"), ("chemicals", "op174")):
    _umls_concord(_d, f"{_n}_{_d}_concord")
_umls_concord("chemicals", "op174_rxnorm_concord", rxnorm=True)


@query("SELECT 'NCIT:C' || p_size AS subject, 'eq' AS predicate, 'UniProtKB:P' || p_partkey AS object FROM part")
def op171_mapped_proteins(spark, d):
    lines = table(spark, d, "part").select(F.explode(F.array(F.concat(F.lit(" C"), "p_size", F.lit(" \t P"), "p_partkey", F.lit("\r")), F.lit(" \r"))).alias("value"))
    return domains.mapped_table(lines, "NCIT", "UniProtKB")


@query(f"SELECT 'DrugCentral:' || row_id AS curie, {_KIND.replace('smiles', 's')} AS type FROM (SELECT row_id, nullif(preferred_name, 'None') AS s FROM clique)")
def op175_structure_ids(spark, d):
    return domains.structure_ids(table(spark, d, "clique").select(F.concat(F.lit("DrugCentral:"), "row_id").alias("id"), F.coalesce("preferred_name", F.lit("None")).alias("smiles")))


# --- triples ---------------------------------------------------------------------------------------
@query(f"WITH RECURSIVE {_CLOSED} SELECT root, node, c_mktsegment AS object FROM r LEFT JOIN customer ON node = 'C:' || c_custkey AND c_mktsegment <> 'BUILDING'")
def op163_structures(spark, d):
    reached = _reached(spark, d, {f"R:{i}": f"R:{i}" for i in range(5)})
    t = table(spark, d, "customer").where("c_mktsegment <> 'BUILDING'").select(F.concat(F.lit("C:"), "c_custkey").alias("s"), F.lit("chebi:smiles").alias("p"), F.col("c_mktsegment").alias("o"))
    return closure.with_objects(reached, t, ("chebi:smiles",), optional=True)


@query("SELECT DISTINCT o_orderkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'R' || c_nationkey END AS registry FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 3 <> 0")
def op168_registry_numbers(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("s"), F.lit("meshv:preferredConcept").alias("p"), F.col("o_custkey").cast("string").alias("o"))
    b = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("s"), F.lit("meshv:registryNumber").alias("p"), F.when(F.col("c_custkey") % 3 == 0, "0").otherwise(F.concat(F.lit("R"), "c_nationkey")).alias("o"))
    return closure.registry_numbers(a.unionByName(b)).withColumn("id", F.col("id").cast("bigint"))


@query(f"WITH RECURSIVE {_CLOSED}, x AS (SELECT root, node, c_mktsegment AS seg, c_nationkey AS n FROM r JOIN customer ON node = 'C:' || c_custkey) SELECT root, node, 'E:' || n AS object FROM x WHERE seg = 'BUILDING' UNION ALL SELECT root, node, 'X:' || n FROM x WHERE seg <> 'BUILDING'")
def op169_exact_else_xref(spark, d):
    """Exact matches; nodes without any take their cross-references."""
    reached = _reached(spark, d, {f"R:{i}": f"R:{i}" for i in range(5)})
    c = table(spark, d, "customer")
    s = F.concat(F.lit("C:"), "c_custkey").alias("s")
    exact = c.where("c_mktsegment = 'BUILDING'").select(s, F.lit(closure.EXACT[0]).alias("p"), F.concat(F.lit("E:"), "c_nationkey").alias("o"))
    xref = c.select(s, F.lit(closure.XREF).alias("p"), F.concat(F.lit("X:"), "c_nationkey").alias("o"))
    return closure.with_fallback(reached, exact.unionByName(xref), closure.EXACT, (closure.XREF,)).select("root", "node", "object")


@query("SELECT DISTINCT CASE p_size % 4 WHEN 0 THEN 'CL' WHEN 1 THEN 'GO' END || ':' || p_partkey AS curie, p_name AS value FROM part WHERE p_size % 4 < 2")
def op170_common_rows(spark, d):
    k = F.col("p_size") % 4
    iri = F.concat(F.lit("http://purl.obolibrary.org/obo/"), F.when(k == 0, "CL_").when(k == 1, "GO_").when(k == 2, "ro_").otherwise("topic#_"), "p_partkey")
    return closure.common_rows(table(spark, d, "part").select(iri.alias("iri"), F.col("p_name").alias("value")))


# --- CURIE helpers ---------------------------------------------------------------------------------
@query(f"""WITH t AS (SELECT seq, {value('curie')} AS t FROM ids), x AS (SELECT seq, regexp_extract(t, '^[^\\s]*', 0) AS x FROM t)
SELECT seq, CASE WHEN contains(x, ':') AND NOT ends_with(x, ':') THEN CASE upper({_pfx('x')}) WHEN 'MESH' THEN 'MSH' WHEN 'NCBIGENE' THEN 'NCBIGene' ELSE {_pfx('x')} END || ':' || substr(x, instr(x, ':') + 1) END AS curie FROM x""")
def curie_renamed(spark, d):
    t = table(spark, d, "ids").select("seq", C.plain_value("curie").alias("t"))
    return C.once(t).select("seq", C.normal_xref("t", {"MESH": "MSH", "NCBIGene": "NCBIGene"}).alias("curie"))


# --- the build -------------------------------------------------------------------------------------
_BUILD = {"unique": (), "filter": "all", "both_ways": False, "extra": ("RXCUI",)}
_EXTRA = f"(SELECT type, prefix, rank FROM {_RANK_SQL} UNION ALL SELECT type, 'RXCUI', 1000000 FROM (SELECT DISTINCT type FROM {_RANK_SQL} WHERE type NOT IN (SELECT type FROM {_RANK_SQL} WHERE prefix = 'RXCUI')))"


def _built(spark, d):
    t = _shredded(spark, d, once=True)
    labels = _member_labels(spark, d, t)
    desc = _parts(spark, d, "description", t).withColumnRenamed("value", "description")
    ranks = _ranks(spark).withColumn("prefix", F.upper("prefix"))
    concords = _concords(spark, d).withColumn("source", F.coalesce("predicate", F.lit("")))
    taxa = _parts(spark, d, "taxon", t).withColumnRenamed("value", "taxon")
    inputs = build.Inputs(_ids(spark, d), concords, ranks, labels, _synonyms(spark, d), desc, taxa, _scores(spark, d))
    return build.build(_BUILD, inputs, Scratch(spark, "build"), TYPE_ORDER, default_type=None, boosted=BOOSTED)


_BUILT = f"""{_IDT}, {_CONC}, f AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY coalesce(predicate, ''), object) AS n FROM conc) WHERE n = 1),
e AS (SELECT subject AS a, object AS b FROM f UNION SELECT object, subject FROM f), v AS (SELECT curie AS x FROM ids0 UNION SELECT a FROM e),
r AS (SELECT x, x AS y FROM v UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a), c AS (SELECT x AS curie, min(y) AS clique FROM r GROUP BY x),
votes AS (SELECT clique, type, count(*) AS n FROM c JOIN idt USING (curie) GROUP BY ALL),
ty AS (SELECT clique, type FROM (SELECT *, row_number() OVER (PARTITION BY clique ORDER BY n DESC, {_rank_case('type', TYPE_ORDER)}, type) AS rn FROM votes) WHERE rn = 1),
m AS (SELECT clique, curie, type, (row_number() OVER (PARTITION BY clique ORDER BY rank, curie) - 1)::INT AS pos FROM (SELECT DISTINCT c.clique, c.curie, ty.type, rank FROM c JOIN ty USING (clique) JOIN {_EXTRA} k ON k.type = ty.type AND upper(prefix) = {_pfx('c.curie')}))"""


@query(f"WITH RECURSIVE {_BUILT} SELECT clique, type, pos, curie FROM m")
def build_members(spark, d):
    """From identifiers and concords to typed cliques with ordered members."""
    b = _built(spark, d)
    return b["members"].join(b["types"], "clique").select("clique", "type", "pos", "curie")


@query(f"""WITH RECURSIVE {_MEM}, {_LAB}, {_IC}, {_BUILT}, ll AS (SELECT curie, arg_max(label, seq) AS label FROM lab GROUP BY curie), n AS (SELECT m.*, label, ic FROM m LEFT JOIN ll USING (curie) LEFT JOIN ics USING (curie))
SELECT clique, any_value(type) AS type, min(ic) AS ic, string_agg(curie || '=' || coalesce(label, ''), '|' ORDER BY pos) AS identifiers,
  coalesce(arg_min(CASE WHEN label <> '' THEN label END, CASE WHEN label <> '' THEN (length(label) > 15, {_rank_case(_pfx('curie'), BOOSTED)}, pos) END), '') AS preferred_name FROM n GROUP BY clique""")
def build_records(spark, d):
    """The records of the build, by one order of members, names and scores."""
    rec = _built(spark, d)["records"]
    idents = F.array_join(F.transform("identifiers", lambda x: F.concat(x["i"], F.lit("="), x["l"])), "|")
    return rec.select("clique", "type", "ic", idents.alias("identifiers"), "preferred_name")
