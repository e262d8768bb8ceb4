"""Queries of the source parsers, fed from tables of like shape, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessellon.functions import curie as C
from tessellon.plans.data_sql import plain
from tessellon.plans.reference_queries import _CONC, _IDT, _LAB, _MEM, _concords, _ids, _member_labels, _pfx, _values
from tessellon.session import table
from tessellon.sources import domains, parsers

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


_MAPPED = (("biolink:SmallMolecule", "biolink:ChemicalEntity"), ("biolink:Protein", "biolink:Protein"), ("biolink:Drug", "biolink:Drug"), ("biolink:Disease", "biolink:Disease"))


@query(f"""WITH {_IDT} SELECT 'UMLS:' || curie AS curie, arg_min(CASE WHEN kind IS NOT NULL THEN kind END, CASE WHEN kind IS NOT NULL THEN (seq, kind) END) AS type FROM ids0 LEFT JOIN {_values(_MAPPED, 'tree', 'kind')} m ON tree = type
GROUP BY ids0.curie HAVING NOT coalesce(bool_or(type = 'biolink:Gene'), false) AND count(kind) > 0""")
def op111_umls_ids(spark, d):
    sty = _ids(spark, d).select("seq", F.col("curie").alias("cui"), F.col("type").alias("tree"))
    return parsers.umls_ids(sty, spark.createDataFrame(list(_MAPPED), "tree string, type string"), ("biolink:Gene",))


_CL = f"c AS (SELECT *, {plain('clique_leader')} AS leader FROM clique WHERE {plain('clique_leader')} IS NOT NULL)"


def _cliques(spark, d):
    return table(spark, d, "clique").withColumn("leader", C.plain_curie("clique_leader")).where("leader IS NOT NULL")


@query(f"""WITH {_CL}, r AS (SELECT leader, CASE WHEN provider = 'gene_feed' THEN 'RXNORM' ELSE 'X' END AS sab, CASE biolink_type WHEN 'biolink:SmallMolecule' THEN 'IN' WHEN 'biolink:MolecularMixture' THEN 'MIN' WHEN 'biolink:Gene' THEN 'DF' ELSE 'SCD' END AS tty FROM c)
SELECT 'RXCUI:' || leader AS curie, CASE WHEN bool_or(tty = 'IN') THEN 'biolink:ChemicalEntity' WHEN bool_or(tty = 'MIN') THEN 'biolink:MolecularMixture' ELSE 'biolink:Drug' END AS type FROM r GROUP BY leader HAVING bool_or(sab = 'RXNORM') AND NOT bool_or(tty = 'DF')""")
def op112_rxnorm_ids(spark, d):
    t = F.col("biolink_type")
    tty = F.when(t == "biolink:SmallMolecule", "IN").when(t == "biolink:MolecularMixture", "MIN").when(t == "biolink:Gene", "DF").otherwise("SCD")
    return parsers.rxnorm_ids(_cliques(spark, d).select(F.col("leader").alias("rxcui"), F.when(F.col("provider") == "gene_feed", "RXNORM").otherwise("X").alias("sab"), tty.alias("tty")))


_E = f"e AS (SELECT {plain('clique_leader')} AS cui, {_pfx(plain('curie'))} AS sab, {plain('curie')} AS code FROM edge)"


@query(f"WITH {_E} SELECT DISTINCT 'UMLS:' || cui AS subject, 'eq' AS predicate, CASE sab WHEN 'MESH' THEN 'MESH' ELSE 'NCIT' END || ':' || string_split(code, ':')[-1] AS object FROM e WHERE sab IN ('MESH', 'NCIT') AND cui IS NOT NULL")
def op113_umls_concord(spark, d):
    e = table(spark, d, "edge").select(C.plain_curie("clique_leader").alias("cui"), C.plain_curie("curie").alias("code"))
    rows = e.where("cui IS NOT NULL").select("cui", C.prefix("code").alias("sab"), F.lit("PT").alias("tty"), "code")
    return parsers.umls_concord(rows, {"MESH": "MESH", "NCIT": "NCIT"})


@query(f"""WITH {_CL} SELECT 'UMLS:' || leader AS curie, arg_min(preferred_name, (coalesce(trust, 1000000), preferred_name, row_id)) AS label FROM c LEFT JOIN provider_rank USING (provider) WHERE preferred_name IS NOT NULL GROUP BY leader""")
def op114_umls_labels(spark, d):
    rows = _cliques(spark, d).where("preferred_name IS NOT NULL").select(F.col("row_id").alias("seq"), F.col("leader").alias("cui"), F.col("provider").alias("sab"), F.lit("PT").alias("tty"), F.col("preferred_name").alias("term"))
    rank = table(spark, d, "provider_rank").select(F.col("provider").alias("sab"), F.lit("PT").alias("tty"), F.col("trust").alias("priority"))
    return parsers.umls_labels(rows, rank)[0]


_GENE = "g AS (SELECT 'NCBIGene:' || p_partkey AS curie, p_partkey, nullif(CASE WHEN p_size % 3 = 0 THEN '-' ELSE p_brand END, '-') AS symbol, p_name, CASE WHEN p_size % 5 = 0 THEN p_type END AS authority FROM part WHERE p_size % 7 <> 0)"


def _genes(spark, d):
    p = table(spark, d, "part")
    return p.select(
        F.col("p_size").cast("string").alias("tax_id"), F.col("p_partkey").cast("string").alias("gene_id"), F.when(F.col("p_size") % 3 == 0, "-").otherwise(F.col("p_brand")).alias("symbol"), F.replace("p_name", F.lit(" "), F.lit("|")).alias("synonyms"),
        F.lit("-").alias("description"), F.when(F.col("p_size") % 5 == 0, F.col("p_type")).otherwise("-").alias("authority_symbol"), F.lit("-").alias("authority_name"), F.lit("-").alias("other_designations"), F.when(F.col("p_size") % 7 == 0, "other").otherwise("protein-coding").alias("gene_type"),
    )


@query(f"WITH {_GENE} SELECT curie, coalesce(authority, symbol) AS label FROM g WHERE coalesce(authority, symbol) IS NOT NULL")
def op115_gene_labels(spark, d):
    return parsers.gene_info(_genes(spark, d))["labels"]


@query(f"WITH {_GENE} SELECT DISTINCT curie, 'oio:hasExactSynonym' AS predicate, s AS synonym FROM (SELECT curie, unnest(list_concat(string_split(p_name, ' '), [symbol, authority])) AS s FROM g) WHERE s IS NOT NULL")
def op115_gene_synonyms(spark, d):
    return parsers.gene_info(_genes(spark, d))["synonyms"]


@query(f"""WITH {_IDT}, r AS (SELECT seq, 'NCBIGene:' || seq % 400 AS subject, 'ENSEMBL:' || coalesce(nullif(regexp_extract(x, '^([A-Z]+\\d+)\\.\\d+', 1), ''), x) AS object FROM (SELECT seq, substr(curie, 9) || CASE WHEN seq % 2 = 0 THEN '.3' ELSE '' END AS x FROM ids0 WHERE curie LIKE 'ENSEMBL:%') WHERE seq % 400 < 300)
SELECT subject, 'eq' AS predicate, object FROM (SELECT *, lag(object) OVER (PARTITION BY subject ORDER BY seq) AS l FROM r) WHERE l IS DISTINCT FROM object""")
def op116_gene_to_ensembl(spark, d):
    i = _ids(spark, d).where(C.prefix("curie") == "ENSEMBL")
    rows = i.select("seq", (F.col("seq") % 400).alias("gene_id"), F.concat(C.suffix("curie"), F.when(F.col("seq") % 2 == 0, ".3").otherwise("")).alias("ensembl_gene"), F.lit("-").alias("ensembl_protein"))
    return parsers.gene_to_ensembl(rows, spark.range(300).select(F.concat(F.lit("NCBIGene:"), "id").alias("curie")))


@query("SELECT 'UniProtKB:' || user_id AS subject, 'eq' AS predicate, 'EV:' || event_id AS object FROM events WHERE event_type = (SELECT min(event_type) FROM events)")
def op121_id_mapping(spark, d):
    e = table(spark, d, "events")
    key = e.agg(F.min("event_type")).first()[0]
    return parsers.id_mapping(e.select(F.col("user_id").alias("accession"), F.col("event_type").alias("key"), F.col("event_id").alias("value")), key, "EV")


@query(f"""WITH {_MEM}, {_LAB}, {_CL}, m AS (SELECT label, min(curie) AS object FROM lab WHERE {_pfx('curie')} = 'MESH' AND substr(curie, 6, 1) IN ('C', 'D') GROUP BY label)
SELECT 'PUBCHEM.COMPOUND:' || leader AS subject, 'xref' AS predicate, arg_min(object, row_id) AS object FROM c JOIN m ON preferred_name = label GROUP BY leader""")
def op129_pubchem_mesh(spark, d):
    labels = _member_labels(spark, d).where(C.prefix("curie") == "MESH").select("curie", "label")
    return parsers.pubchem_mesh(_cliques(spark, d).select(F.col("row_id").alias("seq"), F.col("leader").alias("cid"), F.col("preferred_name").alias("name")), labels)


@query(f"WITH {_CONC} SELECT 'DrugCentral:' || row_id AS subject, 'xref' AS predicate, CASE predicate WHEN 'has_form' THEN 'FORM' ELSE 'PART' END || ':' || object AS object FROM conc WHERE predicate IN ('has_form', 'has_part_form')")
def op130_mapped_pairs(spark, d):
    rows = _concords(spark, d).select(F.col("row_id").alias("id"), F.col("predicate").alias("namespace"), F.col("object").alias("value"))
    return parsers.mapped_pairs(rows, {"has_form": "FORM", "has_part_form": "PART"}, "DrugCentral")


@query(f"""WITH {_IDT}, {_CL}, s AS (SELECT leader AS curie, min(preferred_name) AS smiles FROM c WHERE preferred_name IS NOT NULL GROUP BY 1)
SELECT i.curie, CASE WHEN i.curie IN (SELECT curie FROM ids0 WHERE type = 'biolink:Protein') THEN 'protein' WHEN i.curie IN (SELECT curie FROM ids0 WHERE type = 'biolink:Gene') THEN 'gene' WHEN contains(smiles, '.') THEN 'biolink:MolecularMixture' WHEN smiles IS NOT NULL THEN 'biolink:SmallMolecule' ELSE 'biolink:ChemicalEntity' END AS type
FROM (SELECT DISTINCT curie FROM ids0) i LEFT JOIN s USING (curie)""")
def op133_typed_by_flags(spark, d):
    i = _ids(spark, d)
    smiles = _cliques(spark, d).where("preferred_name IS NOT NULL").groupBy(F.col("leader").alias("curie")).agg(F.min("preferred_name").alias("smiles"))
    return parsers.typed_by_flags(i, [(i.where("type = 'biolink:Protein'"), "protein"), (i.where("type = 'biolink:Gene'"), "gene")], smiles)


@query(f"""WITH {_CONC}, r AS (SELECT row_id, substr(object, instr(object, ':') + 1) AS g FROM conc)
SELECT 'MESH:' || row_id AS subject, 'reg' AS predicate, CASE WHEN regexp_full_match(g, '[0-9]+-[0-9]+-[0-9]') THEN 'CAS:' ELSE 'UNII:' END || g AS object FROM r WHERE NOT starts_with(g, 'EC') AND NOT starts_with(g, 'txid') AND g NOT IN ('0', '')""")
def op136_registry_concord(spark, d):
    return parsers.registry_concord(_concords(spark, d).select(F.col("row_id").alias("id"), C.suffix("object").alias("registry")))


@query("SELECT row_id AS seq, row_id::VARCHAR AS id, coalesce(preferred_name, '') || ', form' AS name FROM clique WHERE NOT contains(coalesce(preferred_name, ''), '\"')")
def op140_broken_csv(spark, d):
    c = table(spark, d, "clique").where(~F.coalesce(F.col("preferred_name").contains('"'), F.lit(False)))
    rows = c.select(F.col("row_id").alias("seq"), F.concat(F.col("row_id").cast("string"), F.lit(","), F.coalesce("preferred_name", F.lit("")), F.lit(', form,"tail, more"')).alias("value"))
    return parsers.broken_csv_names(rows)


@query(f"WITH {_CL} SELECT 'PMID:' || leader AS curie, arg_max(preferred_name, (year(updated_at), row_id)) AS label FROM c WHERE preferred_name IS NOT NULL GROUP BY leader")
def op145_article_titles(spark, d):
    rows = _cliques(spark, d).select(F.year("updated_at").alias("file_seq"), F.col("row_id").alias("pos"), F.col("leader").alias("pmid"), F.col("preferred_name").alias("title"), F.lit(None).cast("string").alias("doi"), F.lit(None).cast("string").alias("pmc"), F.lit(None).cast("string").alias("status"))
    return parsers.articles(rows)["titles"]


@query(f"WITH {_MEM}, {_IDT}, k AS (SELECT clique, arg_min(type, (list_position({list(domains.CONFLATION_TYPE_ORDER)}, type), type)) AS type FROM mem JOIN idt USING (curie) WHERE list_contains({list(domains.CONFLATION_TYPE_ORDER)}, type) GROUP BY clique) SELECT type, count(*) AS cliques FROM k GROUP BY type")
def op60_conflation_types_of_domain(spark, d):
    from tessellon.operators import conflation
    from tessellon.plans.reference_queries import _members, _types

    known = _types(spark, d).where(F.col("type").isin(*domains.CONFLATION_TYPE_ORDER))
    return conflation.conflation_type(_members(spark, d), known, domains.CONFLATION_TYPE_ORDER).groupBy("type").agg(F.count("*").alias("cliques"))
