"""Queries of the clique engine's operators over the domain tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellon.functions import curie as C
from tessellon.operators import badrows, cliques, closure, conflation, nested, nodes, reports, snapshots, typing
from tessellon.operators.components import components
from tessellon.plans.data_sql import _IDENTS, _LIST, _PARSED, plain, present, value
from tessellon.session import Scratch, table
from tessellon.sources import parsers, readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- inputs ----------------------------------------------------------------------------------------
RANKS = {
    "biolink:SmallMolecule": ("CHEBI", "UNII", "PUBCHEM.COMPOUND", "CHEMBL.COMPOUND", "DRUGBANK", "MESH", "HMDB", "KEGG.COMPOUND", "INCHIKEY", "UMLS"),
    "biolink:Gene": ("NCBIGene", "ENSEMBL", "HGNC", "UMLS"),
    "biolink:Protein": ("UniProtKB", "PR", "UMLS"),
    "biolink:Disease": ("MONDO", "orphanet", "HP", "NCIT", "MESH", "UMLS"),
    "biolink:Drug": ("RXCUI", "DRUGBANK", "UMLS"),
}
TYPE_ORDER = ("biolink:SmallMolecule", "biolink:MolecularMixture", "biolink:Protein", "biolink:Gene", "biolink:Disease", "biolink:PhenotypicFeature", "biolink:Drug", "biolink:ChemicalEntity")
PARENTS = (("biolink:SmallMolecule", "biolink:MolecularEntity"), ("biolink:MolecularEntity", "biolink:ChemicalEntity"), ("biolink:ChemicalEntity", "biolink:NamedThing"), ("biolink:Drug", "biolink:MolecularMixture"), ("biolink:MolecularMixture", "biolink:ChemicalMixture"), ("biolink:ChemicalMixture", "biolink:ChemicalEntity"), ("biolink:Gene", "biolink:NamedThing"), ("biolink:Protein", "biolink:NamedThing"))
RULES = (("biolink:Drug|biolink:SmallMolecule", "biolink:SmallMolecule"), ("biolink:ChemicalEntity|biolink:SmallMolecule", "biolink:SmallMolecule"), ("biolink:MolecularMixture|biolink:SmallMolecule", "biolink:MolecularMixture"), ("biolink:Gene|biolink:Protein", "biolink:Protein"))
BOOSTED = ("DRUGBANK", "CHEBI", "UNII")
SINGLE = ("has_ingredient", "consists_of", "has_tradename")


def _values(rows, *names: str) -> str:
    return "(SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows) + f") t({', '.join(names)}))"


def _rank_rows() -> list[tuple[str, str, int]]:
    return [(t, p, i) for t, ps in RANKS.items() for i, p in enumerate(ps)]


def _ranks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_rank_rows(), "type string, prefix string, rank int")


_RANK_SQL = _values(_rank_rows(), "type", "prefix", "rank")


def _concords(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "drugchemical").select("row_id", "file_seq", "seq", C.plain_curie("subject").alias("subject"), "predicate", C.plain_curie("object").alias("object"))
    return C.once(t).where("subject IS NOT NULL AND object IS NOT NULL")


_CONC = f"conc AS (SELECT * FROM (SELECT row_id, file_seq, seq, {plain('subject')} AS subject, predicate, {plain('object')} AS object FROM drugchemical) WHERE subject IS NOT NULL AND object IS NOT NULL)"


def _ids(spark: SparkSession, d: str) -> DataFrame:
    return C.once(table(spark, d, "ids").select("file_seq", "seq", C.plain_curie("curie").alias("curie"), F.col("biolink_type").alias("type"))).where("curie IS NOT NULL")


_IDT = f"""ids0 AS (SELECT file_seq, seq, {plain('curie')} AS curie, biolink_type AS type FROM ids WHERE {plain('curie')} IS NOT NULL),
idt AS (SELECT curie, arg_max(type, (file_seq, seq)) AS type FROM ids0 WHERE type IS NOT NULL GROUP BY curie)"""


def _types(spark: SparkSession, d: str) -> DataFrame:
    return cliques.read_identifiers(_ids(spark, d))[1]


def _shredded(spark: SparkSession, d: str, once: bool = False) -> dict[str, DataFrame]:
    """The compendium's flat tables; ``once`` for queries that use several of them or one several times."""
    return nested.shred(table(spark, d, "compendium_jsonl"), "line_id", "raw_line", nested.COMPENDIUM, Scratch(spark, "shred") if once else None)


def _members(spark: SparkSession, d: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """clique, pos, curie, label: the compendium lines' members."""
    t = (tables or _shredded(spark, d))["identifier"]
    return t.select(F.col("line_id").alias("clique"), "pos", C.plain_curie(F.coalesce("i", "identifier", "value")).alias("curie"), F.coalesce("l", "label").alias("label")).where("curie IS NOT NULL")


_MEM = f"""{_IDENTS},
mem AS (SELECT * FROM (SELECT line_id AS clique, pos::INT AS pos, {plain("coalesce(json_extract_string(o, '$.i'), json_extract_string(o, '$.identifier'), CASE WHEN json_type(o) <> 'OBJECT' THEN json_extract_string(o, '$') END)")} AS curie,
  coalesce(json_extract_string(o, '$.l'), json_extract_string(o, '$.label')) AS label FROM idents WHERE json_type(o) <> 'NULL') WHERE curie IS NOT NULL)"""


def _clique_types(spark: SparkSession, d: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    t = (tables or _shredded(spark, d))["type"].where("parent_kind = 'record' AND pos = 0")
    return t.select(F.col("line_id").alias("clique"), F.col("value").alias("type"))


_CT = f"ct AS (SELECT line_id AS clique, json_extract_string({_LIST.format('v')}[1], '$') AS type FROM (SELECT line_id, json_extract(j, '$.type') AS v FROM lines) WHERE v IS NOT NULL AND json_type({_LIST.format('v')}[1]) <> 'NULL')"


def _parts(spark: SparkSession, d: str, what: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """curie, value: descriptions or taxa of the members."""
    t = tables or _shredded(spark, d)
    part = t[what].where("parent_kind = 'identifier'").select("line_id", F.col("parent_id").alias("row_id"), "value")
    m = t["identifier"].select("line_id", "row_id", C.plain_curie(F.coalesce("i", "identifier", "value")).alias("curie"))
    return part.join(m, ["line_id", "row_id"]).select("curie", "value").where("curie IS NOT NULL AND value IS NOT NULL")


def _part_sql(name: str, path: str) -> str:
    v = f"json_extract(o, '$.{path}')"
    return f"""{name} AS (SELECT * FROM (SELECT {plain("coalesce(json_extract_string(o, '$.i'), json_extract_string(o, '$.identifier'))")} AS curie, json_extract_string(unnest({_LIST.format(v)}), '$') AS value FROM idents WHERE {v} IS NOT NULL) WHERE curie IS NOT NULL AND value IS NOT NULL)"""


def _member_labels(spark: SparkSession, d: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """seq, curie, label of all lines; the sequence is the line's."""
    return _members(spark, d, tables).where("label IS NOT NULL AND label <> ''").select((F.col("clique") * 1000 + F.col("pos")).alias("seq"), "curie", "label")


_LAB = "lab AS (SELECT clique * 1000 + pos AS seq, curie, label FROM mem WHERE label IS NOT NULL AND label <> '')"


def _scores(spark: SparkSession, d: str) -> DataFrame:
    ic = F.col("information_content").cast("double")
    t = table(spark, d, "clique").select(C.plain_curie("clique_leader").alias("curie"), ic.alias("ic")).where(ic.isNotNull() & ~F.isnan(ic) & (ic >= 0) & (ic <= 100))
    return t.where("curie IS NOT NULL").groupBy("curie").agg(F.min("ic").alias("ic"))


_IC = f"ics AS (SELECT {plain('clique_leader')} AS curie, min(information_content::DOUBLE) AS ic FROM clique WHERE {plain('clique_leader')} IS NOT NULL AND NOT isnan(information_content) AND information_content BETWEEN 0 AND 100 GROUP BY 1)"


def _synonyms(spark: SparkSession, d: str) -> DataFrame:
    parsed = badrows.parse_lines(table(spark, d, "raw_lines"), table(spark, d, "known_predicates"))
    return badrows.valid_rows(parsed, badrows.SYNONYMS).select(C.plain_curie("curie").alias("curie"), "predicate", "synonym")


_SYN = f"{_PARSED.replace('lines AS', 'rl AS', 1).replace('FROM lines', 'FROM rl')},\nsyn AS (SELECT {plain('fields[1]')} AS curie, fields[2] AS predicate, fields[3] AS synonym FROM judged WHERE reason IS NULL AND kind = 'synonyms')"


def _rank_case(c: str, order) -> str:
    return "(CASE " + " ".join(f"WHEN {c} = '{x}' THEN {i}" for i, x in enumerate(order)) + f" ELSE {len(order)} END)"


def _pfx(c: str) -> str:
    return f"(CASE WHEN instr({c}, ':') > 0 THEN left({c}, instr({c}, ':') - 1) END)"


def _num(c: str) -> str:
    return f"TRY_CAST(substr({c}, instr({c}, ':') + 1) AS BIGINT)"


# --- CURIE helpers ---------------------------------------------------------------------------------
@query(f"""SELECT seq, {_pfx('curie')} AS prefix, upper({_pfx('curie')}) AS upper_prefix, substr(curie, instr(curie, ':') + 1) AS suffix, {_num('curie')} AS number,
upper({_pfx('curie')}) || ':' || substr(curie, instr(curie, ':') + 1) AS upper_curie, {plain('curie')} AS plain FROM ids""")
def curie_normalize(spark, d):
    t = table(spark, d, "ids")
    return t.select("seq", C.prefix("curie").alias("prefix"), C.upper_prefix("curie").alias("upper_prefix"), C.suffix("curie").alias("suffix"), C.numeric_suffix("curie").alias("number"), C.upper_curie("curie").alias("upper_curie"), C.plain_curie("curie").alias("plain"))


# --- cliques ---------------------------------------------------------------------------------------
def _links(spark, d):
    out = None
    for name, a, b in (("drugchemical", "subject", "object"), ("curie_pairs", "curie1", "curie2")):
        part = table(spark, d, name).select(C.plain_curie(a).alias("a"), C.plain_curie(b).alias("b"))
        out = part if out is None else out.unionByName(part)
    return out


_COMP = f"""WITH RECURSIVE links AS (SELECT {plain('subject')} AS a, {plain('object')} AS b FROM drugchemical UNION ALL SELECT {plain('curie1')}, {plain('curie2')} FROM curie_pairs),
e AS (SELECT a, b FROM links WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM links WHERE a IS NOT NULL AND b IS NOT NULL),
v AS (SELECT a AS x FROM links WHERE a IS NOT NULL UNION SELECT b FROM links WHERE b IS NOT NULL),
r AS (SELECT x, x AS y FROM v UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a),
comp AS (SELECT x AS curie, min(y) AS clique FROM r GROUP BY x)"""


@query(_COMP + " SELECT curie, clique FROM comp")
def op01_components(spark, d):
    return components(_links(spark, d), Scratch(spark, "op01")).select(F.col("node").alias("curie"), F.col("component").alias("clique"))


def _pairs(spark, d):
    return _concords(spark, d).select(F.lit(1).alias("stage"), "file_seq", "seq", F.col("subject").alias("left"), F.col("object").alias("right"))


@query()
def op01_glom(spark, d):
    return cliques.glom(_pairs(spark, d), Scratch(spark, "op01g"), ("INCHIKEY", "MESH"))


@query(f"WITH {_CONC} SELECT row_id, subject, object FROM (SELECT *, count(*) OVER (PARTITION BY object) AS n FROM conc) WHERE n = 1")
def op02_overused_xrefs(spark, d):
    return cliques.overused_xrefs(_concords(spark, d)).select("row_id", "subject", "object")


@query(f"WITH {_CONC} SELECT row_id, subject, object FROM (SELECT *, count(*) OVER (PARTITION BY object) AS n, count(*) OVER (PARTITION BY subject) AS m FROM conc) WHERE n = 1 AND m = 1")
def op02_overused_bothways(spark, d):
    return cliques.overused_xrefs(_concords(spark, d), both_ways=True).select("row_id", "subject", "object")


def _sets(spark, d):
    return C.once(table(spark, d, "edge").select(C.plain_value("clique_leader").alias("clique"), C.plain_value("curie").alias("curie"))).where("clique IS NOT NULL AND curie IS NOT NULL")


_SETS = f"sets AS (SELECT * FROM (SELECT {value('clique_leader')} AS clique, {value('curie')} AS curie FROM edge) WHERE clique IS NOT NULL AND curie IS NOT NULL)"


@query(f"WITH {_SETS}, o AS (SELECT DISTINCT clique, curie FROM sets), k AS (SELECT *, count(*) OVER (PARTITION BY curie) AS n FROM o) SELECT c.clique, k.curie FROM (SELECT DISTINCT clique FROM sets) c LEFT JOIN (SELECT * FROM k WHERE n = 1) k USING (clique)")
def op03_unique_members(spark, d):
    return cliques.unique_members(_sets(spark, d), "clique", "curie")


@query(f"WITH {_SETS}, k AS (SELECT *, count(*) OVER (PARTITION BY curie) AS n FROM sets) SELECT c.clique, k.curie FROM (SELECT DISTINCT clique FROM sets) c LEFT JOIN (SELECT * FROM k WHERE n = 1) k USING (clique)")
def op04_clean_sets(spark, d):
    return cliques.clean_sets(_sets(spark, d), "clique", "curie")


@query(f"WITH {_SETS}, o AS (SELECT DISTINCT clique, curie FROM sets) SELECT clique, curie FROM (SELECT *, count(*) OVER (PARTITION BY curie) AS n FROM o) WHERE n = 1")
def op05_overused_in_lists(spark, d):
    return cliques.overused_in_lists(_sets(spark, d), "clique", "curie")


@query(f"SELECT upper({_pfx('curie')}) AS prefix, count(*) AS n, min(curie) AS first_curie FROM ids GROUP BY 1")
def op06_by_prefix(spark, d):
    return cliques.by_prefix(table(spark, d, "ids"), "curie").groupBy("prefix").agg(F.count("*").alias("n"), F.min("curie").alias("first_curie"))


@query(f"WITH {_IDT} SELECT curie, type FROM idt")
def op07_identifiers(spark, d):
    return _types(spark, d)


@query(_COMP + " SELECT DISTINCT clique FROM comp")
def op08_distinct_cliques(spark, d):
    return op01_components(spark, d).select("clique").distinct()


@query(f"WITH {_CONC}, {_IDT} SELECT row_id FROM conc WHERE subject IN (SELECT curie FROM ids0) AND object IN (SELECT curie FROM ids0)")
def op09_known_pairs(spark, d):
    return cliques.known_pairs(_concords(spark, d), _ids(spark, d)).select("row_id")


@query(f"WITH {_CONC}, {_IDT} SELECT row_id FROM conc WHERE coalesce(predicate, '') <> 'has_ingredient' OR (subject IN (SELECT curie FROM ids0) AND object IN (SELECT curie FROM ids0))")
def op10_known_pairs_of_some(spark, d):
    return cliques.known_pairs(_concords(spark, d), _ids(spark, d), F.coalesce("predicate", F.lit("")) == "has_ingredient").select("row_id")


@query(f"WITH {_CONC} SELECT row_id FROM conc WHERE NOT EXISTS (SELECT 1 FROM curie_pairs p WHERE {plain('curie1')} = subject AND {plain('curie2')} = object)")
def op11_bad_pairs(spark, d):
    bad = table(spark, d, "curie_pairs").select(C.plain_curie("curie1").alias("subject"), C.plain_curie("curie2").alias("object"))
    return cliques.without_bad_pairs(_concords(spark, d), bad).select("row_id")


@query()
def op12_combined_structures(spark, d):
    files = _concords(spark, d).withColumn("file_seq", F.xxhash64(C.prefix("subject")))
    return cliques.combine_structures(files, Scratch(spark, "op12"))


@query()
def op14_untyped_cliques(spark, d):
    return cliques.untyped_cliques(_ids(spark, d), _concords(spark, d), Scratch(spark, "op14"))


# --- typing ----------------------------------------------------------------------------------------
_VOTE = f"""known AS (SELECT DISTINCT clique, curie, type FROM mem JOIN idt USING (curie)),
votes AS (SELECT clique, type, count(*) AS n FROM known GROUP BY ALL),
voted AS (SELECT clique, type FROM (SELECT *, row_number() OVER (PARTITION BY clique ORDER BY n DESC, {_rank_case('type', TYPE_ORDER)}, type) AS rn FROM votes) WHERE rn = 1)"""
_LEADS = ("CHEBI", "MONDO", "NCBIGENE")


@query(f"""WITH {_MEM}, {_IDT}, {_VOTE},
led AS (SELECT clique, type FROM (SELECT *, row_number() OVER (PARTITION BY clique ORDER BY {_rank_case(_pfx('curie'), _LEADS)}, curie) AS rn FROM known WHERE {_pfx('curie')} IN ('CHEBI', 'MONDO', 'NCBIGENE')) WHERE rn = 1)
SELECT c.clique, coalesce(led.type, voted.type) AS type FROM (SELECT DISTINCT clique FROM mem) c LEFT JOIN led ON led.clique = c.clique LEFT JOIN voted ON voted.clique = c.clique""")
def op20_typed_by_leader(spark, d):
    return typing.typed_by_vote(_members(spark, d), _types(spark, d), TYPE_ORDER, _LEADS)


@query(f"WITH {_MEM}, {_IDT}, {_VOTE} SELECT c.clique, coalesce(voted.type, 'biolink:NamedThing') AS type FROM (SELECT DISTINCT clique FROM mem) c LEFT JOIN voted ON voted.clique = c.clique")
def op21_typed_by_vote(spark, d):
    return typing.typed_by_vote(_members(spark, d), _types(spark, d), TYPE_ORDER, default="biolink:NamedThing")


_SPLIT = ("biolink:SmallMolecule", "biolink:MolecularMixture")


@query(f"""WITH {_MEM}, {_IDT}, {_VOTE},
lead AS (SELECT clique, list_sort(list(DISTINCT type)) AS t FROM known WHERE {_pfx('curie')} = 'PUBCHEM.COMPOUND' GROUP BY clique),
b AS (SELECT c.clique, t, coalesce(voted.type, 'biolink:ChemicalEntity') AS v FROM (SELECT DISTINCT clique FROM mem) c LEFT JOIN lead ON lead.clique = c.clique LEFT JOIN voted ON voted.clique = c.clique)
SELECT clique, NULL::INT AS part, CASE WHEN len(t) = 1 THEN t[1] ELSE v END AS type FROM b WHERE t IS DISTINCT FROM ['{_SPLIT[1]}', '{_SPLIT[0]}']
UNION ALL SELECT clique, part, type FROM b, {_values([(0, _SPLIT[0]), (1, _SPLIT[1])], 'part', 'type')} s WHERE t = ['{_SPLIT[1]}', '{_SPLIT[0]}']""")
def op23_typed_with_split(spark, d):
    return typing.typed_with_split(_members(spark, d), _types(spark, d), TYPE_ORDER, "PUBCHEM.COMPOUND", _SPLIT, "biolink:ChemicalEntity")


@query(f"WITH {_MEM} SELECT DISTINCT clique, 'biolink:Gene' AS type FROM mem")
def op24_fixed_type(spark, d):
    return typing.fixed_type(_members(spark, d), "biolink:Gene")


@query("SELECT row_id, CASE WHEN contains(preferred_name, '.') THEN 'biolink:MolecularMixture' WHEN preferred_name IS NOT NULL THEN 'biolink:SmallMolecule' END AS type FROM clique")
def op25_structure_type(spark, d):
    return table(spark, d, "clique").select("row_id", typing.type_of_smiles("preferred_name").alias("type"))


@query(f"""WITH s AS (SELECT {plain('clique_leader')} AS concept, array_to_string(list_sort(list(DISTINCT biolink_type)), '|') AS types FROM clique WHERE biolink_type IS NOT NULL AND {plain('clique_leader')} IS NOT NULL GROUP BY 1)
SELECT concept, coalesce(resolved, CASE WHEN NOT contains(types, '|') THEN types END) AS type FROM s LEFT JOIN {_values(RULES, 'rule', 'resolved')} r ON rule = types WHERE resolved IS NOT NULL OR NOT contains(types, '|')""")
def op26_resolved_types(spark, d):
    concepts = table(spark, d, "clique").select(C.plain_curie("clique_leader").alias("concept"), F.col("biolink_type").alias("type")).where("concept IS NOT NULL")
    return typing.resolve_types(concepts, spark.createDataFrame(list(RULES), "types string, resolved string"))[0]


# --- nodes -----------------------------------------------------------------------------------------
_ORDERED = f"""{_CT}, ordered AS (SELECT clique, (row_number() OVER (PARTITION BY clique ORDER BY rank, curie) - 1)::INT AS pos, curie FROM (
  SELECT DISTINCT mem.clique, rank, prefix || ':' || substr(curie, instr(curie, ':') + 1) AS curie FROM mem JOIN ct USING (clique) JOIN {_RANK_SQL} k ON k.type = ct.type AND upper(k.prefix) = upper({_pfx('curie')})))"""


@query(f"WITH {_MEM}, {_ORDERED} SELECT clique, pos, curie FROM ordered")
def op30_ordered_members(spark, d):
    t = _shredded(spark, d, once=True)
    return nodes.ordered_members(_members(spark, d, t), _clique_types(spark, d, t), _ranks(spark))


@query(f"""WITH {_MEM}, m AS (SELECT clique, curie, label, CASE WHEN trim(label) <> '' THEN lower(label) END AS l, {_pfx('curie')} = 'PUBCHEM.COMPOUND' AS own FROM mem),
borne AS (SELECT clique, l, count(*) AS n FROM m WHERE NOT own AND l IS NOT NULL GROUP BY ALL),
x AS (SELECT m.*, coalesce(n, 0) AS n FROM m LEFT JOIN borne ON borne.clique = m.clique AND borne.l = m.l WHERE own)
SELECT clique, coalesce(arg_max(CASE WHEN n > 0 THEN curie END, CASE WHEN n > 0 THEN (n, curie) END), arg_min(CASE WHEN l IS NOT NULL AND upper(label) NOT LIKE 'CID%' THEN curie END, CASE WHEN l IS NOT NULL AND upper(label) NOT LIKE 'CID%' THEN (length(label), curie) END), min(CASE WHEN l IS NOT NULL THEN curie END), min(curie)) AS leader
FROM x GROUP BY clique HAVING count(*) > 1""")
def op31_pubchem_leader(spark, d):
    return nodes.pubchem_leader(_members(spark, d))


@query(f"""WITH {_MEM}, {_LAB}, {_SYN}, a AS (SELECT curie, arg_max(label, seq) AS label FROM lab WHERE {_pfx('curie')} = 'CHEBI' GROUP BY curie),
s AS (SELECT curie, min(synonym) AS label FROM syn GROUP BY curie), b AS (SELECT curie, arg_max(label, (length(label), -seq)) AS label FROM lab GROUP BY curie)
SELECT DISTINCT mem.curie, coalesce(a.label, s.label, b.label) AS label FROM mem LEFT JOIN a USING (curie) LEFT JOIN s USING (curie) LEFT JOIN b USING (curie)""")
def op32_labels(spark, d):
    t = _shredded(spark, d, once=True)
    lab = _member_labels(spark, d, t)
    first = nodes.last_label(lab.where(C.prefix("curie") == "CHEBI"))
    second = _synonyms(spark, d).groupBy("curie").agg(F.min("synonym").alias("label"))
    return nodes.apply_labels(_members(spark, d, t).select("curie").distinct(), first, second, nodes.longest_label(lab))


@query(f"WITH {_MEM}, {_LAB} SELECT curie, arg_max(label, (length(label), -seq)) AS label FROM lab GROUP BY curie")
def op33_longest_label(spark, d):
    return nodes.longest_label(_member_labels(spark, d))


@query(f"WITH {_MEM}, {_LAB} SELECT curie, arg_max(label, seq) AS label FROM lab GROUP BY curie")
def op34_last_label(spark, d):
    return nodes.last_label(_member_labels(spark, d))


@query(f"SELECT type, prefix, rank::INT AS rank FROM {_RANK_SQL}")
def op35_prefixes(spark, d):
    return nodes.prefixes_of(spark.createDataFrame([(t, [*p, p[0]]) for t, p in RANKS.items()], "type string, prefixes array<string>"))


@query(f"WITH RECURSIVE p AS (SELECT * FROM {_values(PARENTS, 'type', 'parent')}), r AS (SELECT type, type AS ancestor, 0 AS distance FROM (SELECT type FROM p UNION SELECT parent FROM p) UNION SELECT r.type, p.parent, r.distance + 1 FROM r JOIN p ON p.type = r.ancestor) SELECT type, ancestor, min(distance)::INT AS distance FROM r GROUP BY ALL")
def op36_ancestors(spark, d):
    return nodes.ancestors(spark.createDataFrame(list(PARENTS), "type string, parent string"))


@query(f"WITH {_MEM} SELECT clique, curie, min(CASE WHEN label <> '' THEN label END) AS label FROM mem GROUP BY ALL")
def op37_clean_members(spark, d):
    return nodes.clean_members(_members(spark, d))


@query(f"WITH {_MEM}, {_IC} SELECT clique, min(ic) AS ic FROM mem LEFT JOIN ics USING (curie) GROUP BY clique")
def op38_information_content(spark, d):
    return nodes.information_content(_members(spark, d), _scores(spark, d))


_STEMS = (("https://x/CHEB", "C1"), ("https://x/CHEBI_", "CHEBI"), ("https://x/", "X"), ("https://x/MONDO_", "MONDO"))


@query(f"""WITH {_IDT}, i AS (SELECT seq, 'https://x/' || replace(curie, ':', '_') AS iri, (seq % 97)::DOUBLE AS ic FROM ids0),
c AS (SELECT i.seq, iri, ic, arg_max(prefix || ':' || substr(iri, length(stem) + 1), length(stem)) AS curie FROM i JOIN {_values(_STEMS, 'stem', 'prefix')} m ON starts_with(iri, stem) GROUP BY ALL)
SELECT curie, arg_max(ic, seq) AS ic FROM c GROUP BY curie""")
def op39_contracted_scores(spark, d):
    iris = _ids(spark, d).select("seq", F.concat(F.lit("https://x/"), F.replace("curie", F.lit(":"), F.lit("_"))).alias("iri"), (F.col("seq") % 97).cast("double").alias("ic"))
    return nodes.load_ic(iris, spark.createDataFrame(list(_STEMS), "stem string, prefix string"))


@query(f"WITH {_MEM}, {_LAB}, {_SYN} SELECT DISTINCT * FROM (SELECT curie, 'oio:hasExactSynonym' AS predicate, label AS synonym FROM lab UNION ALL SELECT curie, predicate, synonym FROM syn) WHERE synonym <> ''")
def op40_synonyms(spark, d):
    return nodes.all_synonyms(_member_labels(spark, d), _synonyms(spark, d))


@query(f"WITH {_IDENTS}, {_part_sql('dd', 'd')} SELECT DISTINCT curie, value AS description FROM dd WHERE value <> ''")
def op41_descriptions(spark, d):
    return nodes.all_descriptions(_parts(spark, d, "description").withColumnRenamed("value", "description"))


@query(f"WITH {_MEM}, {_part_sql('tt', 't')} SELECT DISTINCT clique, mem.curie, value AS taxon FROM mem JOIN tt ON upper(mem.curie) = upper(tt.curie)")
def op42_taxa(spark, d):
    t = _shredded(spark, d, once=True)
    return nodes.taxa_of(_members(spark, d, t), _parts(spark, d, "taxon", t).withColumnRenamed("value", "taxon"))


_NAME = f"""pn AS (SELECT clique, coalesce(arg_min(CASE WHEN label <> '' THEN label END, CASE WHEN label <> '' THEN (length(label) > 15, {_rank_case(_pfx('curie'), BOOSTED)}, pos) END), '') AS preferred_name FROM mem GROUP BY clique)"""


@query(f"WITH {_MEM}, {_NAME} SELECT clique, preferred_name FROM pn")
def op43_preferred_name(spark, d):
    return nodes.preferred_name(_members(spark, d), BOOSTED)


@query(f"WITH {_MEM} SELECT clique, curie, pos, (row_number() OVER (PARTITION BY clique ORDER BY {_rank_case(_pfx('curie'), BOOSTED)}, pos) - 1)::INT AS new_pos FROM mem")
def op44_boosted_members(spark, d):
    m = _members(spark, d).select("clique", "curie", "pos", F.col("pos").alias("old"))
    return nodes.boost_prefixes(m, BOOSTED).select("clique", "curie", F.col("old").alias("pos"), F.col("pos").alias("new_pos"))


@query(f"""WITH {_MEM}, {_CONC}, alt AS (SELECT DISTINCT subject, object FROM conc WHERE predicate = 'skos:exactMatch'),
r AS (SELECT clique, pos, '' AS sub, curie FROM mem UNION ALL SELECT clique, pos, object, object FROM mem JOIN alt ON subject = curie),
f AS (SELECT clique, curie, min((pos, sub)) AS place FROM r GROUP BY ALL) SELECT clique, (row_number() OVER (PARTITION BY clique ORDER BY place, curie) - 1)::INT AS pos, curie FROM f""")
def op45_alternative_ids(spark, d):
    props = _concords(spark, d).where("predicate = 'skos:exactMatch'").select(F.col("subject").alias("curie"), F.lit("hasAlternativeId").alias("predicate"), F.col("object").alias("value"))
    return nodes.insert_alternatives(_members(spark, d), props)


@query(f"WITH {_CONC} SELECT DISTINCT subject AS curie, 'hasAlternativeId' AS predicate, object AS value, 'concord' AS source FROM conc")
def op46_properties(spark, d):
    return nodes.check_properties(_concords(spark, d).select(F.col("subject").alias("curie"), F.lit("hasAlternativeId").alias("predicate"), F.col("object").alias("value"), F.lit("concord").alias("source")))


def _records(spark, d):
    t = _shredded(spark, d, once=True)
    m = Scratch(spark, "records").write(nodes.ordered_members(_members(spark, d, t), _clique_types(spark, d, t), _ranks(spark)), "members")
    # members come spelled as their type's prefixes are; what enriches them is found by the plain form and takes their spelling
    spelled = m.select(C.plain_curie("curie").alias("plain"), "curie").distinct()
    own = lambda df, c: df.withColumnRenamed("curie", "plain").join(spelled, "plain").select("curie", c)
    labels = own(nodes.last_label(_member_labels(spark, d, t)), "label")
    desc = own(nodes.all_descriptions(_parts(spark, d, "description", t).withColumnRenamed("value", "description")), "description")
    tax = own(_parts(spark, d, "taxon", t).distinct(), "value").withColumnRenamed("value", "taxon")
    named = m.join(labels, "curie", "left")
    names = nodes.preferred_name(named, BOOSTED)
    ic = nodes.information_content(m, own(_scores(spark, d), "ic"))
    return nodes.compendium_records(m, _clique_types(spark, d, t), labels, names, ic, desc, tax)


_REC = f"""{_MEM}, {_LAB}, {_ORDERED}, {_IC}, {_part_sql('dd', 'd')}, {_part_sql('tt', 't')},
ll AS (SELECT curie AS u, arg_max(label, seq) AS label FROM lab GROUP BY curie),
named AS (SELECT ordered.*, label FROM ordered LEFT JOIN ll ON u = {plain('curie')}),
pn AS (SELECT clique, coalesce(arg_min(CASE WHEN label <> '' THEN label END, CASE WHEN label <> '' THEN (length(label) > 15, {_rank_case(_pfx('curie'), BOOSTED)}, pos) END), '') AS preferred_name FROM named GROUP BY clique)"""


@query(f"""WITH {_REC}, ds AS (SELECT curie, string_agg(value, '^' ORDER BY length(value), value) AS ds FROM (SELECT DISTINCT curie, value FROM dd WHERE value <> '') GROUP BY curie),
ts AS (SELECT curie, string_agg(value, '^' ORDER BY {_num('value')} IS NULL, {_num('value')}, value) AS ts FROM (SELECT DISTINCT curie, value FROM tt) GROUP BY curie),
n AS (SELECT clique, pos, curie, label, {plain('curie')} AS p FROM named),
r AS (SELECT clique, string_agg(n.curie || '=' || coalesce(label, '') || '=' || coalesce(ds, '') || '=' || coalesce(ts, ''), '|' ORDER BY pos) AS identifiers, min(ic) AS ic FROM n LEFT JOIN ds ON ds.curie = p LEFT JOIN ts ON ts.curie = p LEFT JOIN ics ON ics.curie = p GROUP BY clique),
ta AS (SELECT clique, string_agg(value, '^' ORDER BY {_num('value')} IS NULL, {_num('value')}, value) AS taxa FROM (SELECT DISTINCT clique, value FROM n JOIN tt ON tt.curie = p) GROUP BY clique)
SELECT r.clique, ct.type, ic, identifiers, preferred_name, coalesce(taxa, '') AS taxa FROM r JOIN ct USING (clique) LEFT JOIN pn USING (clique) LEFT JOIN ta USING (clique)""")
def op47_compendium_records(spark, d):
    rec = _records(spark, d)
    idents = F.array_join(F.transform("identifiers", lambda x: F.concat(x["i"], F.lit("="), x["l"], F.lit("="), F.array_join(x["d"], "^"), F.lit("="), F.array_join(x["t"], "^"))), "|")
    return rec.select("clique", "type", "ic", idents.alias("identifiers"), "preferred_name", F.array_join("taxa", "^").alias("taxa"))


@query(f"""WITH {_MEM}, {_LAB}, {_SYN}, {_CT}, {_NAME},
sy AS (SELECT DISTINCT curie, synonym FROM (SELECT curie, label AS synonym FROM lab UNION ALL SELECT curie, synonym FROM syn) WHERE synonym <> ''),
n AS (SELECT clique, string_agg(synonym, '|' ORDER BY length(synonym), synonym) AS names, min(length(synonym))::INT AS shortest_name_length FROM (SELECT DISTINCT clique, synonym FROM mem JOIN sy USING (curie)) GROUP BY clique),
l AS (SELECT clique, arg_min(curie, pos) AS curie, count(*) AS clique_identifier_count FROM mem GROUP BY clique)
SELECT curie, names, replace(type, 'biolink:', '') AS types, preferred_name, shortest_name_length, clique_identifier_count, {_num('curie')} AS curie_suffix FROM l JOIN n USING (clique) JOIN pn USING (clique) JOIN ct USING (clique) WHERE preferred_name <> ''""")
def op48_synonym_records(spark, d):
    t = _shredded(spark, d, once=True)
    m = _members(spark, d, t)
    syn = nodes.all_synonyms(_member_labels(spark, d, t), _synonyms(spark, d)).select("curie", "synonym").distinct()
    out = nodes.synonym_records(m, syn, nodes.preferred_name(m, BOOSTED), _clique_types(spark, d, t))
    return out.withColumns({"names": F.array_join("names", "|"), "types": F.array_join("types", "|")})


@query(f"WITH {_MEM}, {_SYN} SELECT (SELECT count(DISTINCT clique) FROM mem) AS cliques, (SELECT count(*) FROM mem) AS eq_ids, (SELECT count(*) FROM syn) AS synonyms")
def op49_counts(spark, d):
    return nodes.counts(_members(spark, d), _synonyms(spark, d))


# --- conflation ------------------------------------------------------------------------------------
@query(f"WITH {_CONC} SELECT row_id, subject, object FROM (SELECT *, count(*) OVER (PARTITION BY subject) AS n FROM conc) WHERE n = 1")
def op50_single_row_subjects(spark, d):
    return conflation.single_row_subjects(_concords(spark, d)).select("row_id", "subject", "object")


@query(f"WITH {_CONC}, {_IDT}, {_SETS} SELECT row_id FROM conc WHERE subject IN (SELECT curie FROM ids0 UNION SELECT clique FROM sets) AND object IN (SELECT curie FROM ids0 UNION SELECT clique FROM sets)")
def op51_valid_pairs(spark, d):
    return conflation.valid_pairs(_concords(spark, d), _ids(spark, d), _sets(spark, d).select(F.col("clique").alias("curie"))).select("row_id")


@query(f"""WITH {_CONC}, {_SETS}, a AS (SELECT curie AS aui, max(clique) AS cui FROM sets GROUP BY curie),
r AS (SELECT CASE WHEN row_id % 3 = 0 THEN 'CUI' WHEN row_id % 3 = 1 THEN 'AUI' ELSE 'SCUI' END AS k1, subject, predicate, object FROM conc)
SELECT CASE k1 WHEN 'CUI' THEN subject WHEN 'AUI' THEN a.cui END AS subject, predicate, b.cui AS object FROM r LEFT JOIN a ON a.aui = subject JOIN a b ON b.aui = object WHERE CASE k1 WHEN 'CUI' THEN subject WHEN 'AUI' THEN a.cui END IS NOT NULL""")
def op54_resolved_concepts(spark, d):
    c = _concords(spark, d)
    kind = F.when(F.col("row_id") % 3 == 0, "CUI").when(F.col("row_id") % 3 == 1, "AUI").otherwise("SCUI")
    rel = c.select(kind.alias("kind1"), F.col("subject").alias("id1"), F.lit("AUI").alias("kind2"), F.col("object").alias("id2"), F.col("predicate").alias("relation"))
    conso = _sets(spark, d).select(F.col("clique").alias("cui"), F.col("curie").alias("aui"), F.lit(None).cast("string").alias("sdui"))
    return conflation.resolve_concepts(rel, conso)


_SINGLE_SQL = ", ".join(f"'{x}'" for x in SINGLE)


@query(f"""WITH {_CONC}, p AS (SELECT DISTINCT subject, predicate, object FROM conc WHERE subject <> object AND predicate IS NOT NULL),
k AS (SELECT *, count(*) OVER (PARTITION BY predicate, subject) AS s, count(*) OVER (PARTITION BY predicate, object) AS o FROM p)
SELECT subject, predicate, object FROM k WHERE predicate NOT IN ({_SINGLE_SQL}, 'has_form') OR (predicate IN ({_SINGLE_SQL}) AND s = 1) OR (predicate = 'has_form' AND s = 1 AND o = 1)""")
def op55_single_use(spark, d):
    return conflation.single_use(_concords(spark, d).where("predicate IS NOT NULL"), SINGLE, ("has_form",))


@query(f"""WITH {_IDENTS}, l AS (SELECT line_id, raw_line FROM lines) SELECT json_extract_string(o, '$.identifier') AS subject, coalesce(json_extract_string(o, '$.label'), '') AS object FROM idents WHERE json_extract_string(o, '$.identifier') IS NOT NULL""")
def op57_flattened(spark, d):
    t = _shredded(spark, d)["identifier"].where("identifier IS NOT NULL")
    rows = t.select(F.to_json(F.array(F.array("identifier", F.coalesce("label", F.lit(""))))).alias("value"))
    return conflation.flatten_annotations(rows)


@query(f"WITH e AS (SELECT row_id, {value('clique_leader')} AS leader, {plain('curie')} AS curie FROM edge WHERE {present('clique_leader')}) SELECT curie, arg_max(leader, row_id) AS leader FROM e WHERE {_pfx('curie')} = 'RXCUI' GROUP BY curie")
def op58_leaders(spark, d):
    e = table(spark, d, "edge").where(C.not_blank("clique_leader")).select(F.col("row_id").alias("seq"), C.plain_value("clique_leader").alias("leader"), C.plain_curie("curie").alias("curie"))
    return conflation.leaders_of(e)


_DRUG = "('DRUGBANK', 'RXCUI')"


@query(f"""WITH {_CONC}, {_SETS}, dr AS (SELECT curie, max(clique) AS d FROM sets WHERE {_pfx('clique')} IN {_DRUG} GROUP BY curie), ch AS (SELECT curie, max(clique) AS c FROM sets WHERE {_pfx('clique')} NOT IN {_DRUG} GROUP BY curie),
b AS (SELECT coalesce(dr.curie, ch.curie) AS curie, d, c, coalesce(d, c) AS leader FROM dr FULL OUTER JOIN ch ON dr.curie = ch.curie)
SELECT s.leader AS subject, o.leader AS object FROM conc JOIN b s ON s.curie = subject JOIN b o ON o.curie = object
UNION SELECT d, c FROM b WHERE d IS NOT NULL AND c IS NOT NULL AND d <> c AND curie IN (SELECT subject FROM conc UNION SELECT object FROM conc)""")
def op59_drug_chemical_pairs(spark, d):
    drug = C.prefix("clique").isin("DRUGBANK", "RXCUI")
    s = _sets(spark, d)
    pick = lambda df: df.groupBy("curie").agg(F.max("clique").alias("leader"))
    return conflation.drug_chemical_pairs(_concords(spark, d), pick(s.where(drug)), pick(s.where(~drug)))


@query(f"WITH {_MEM}, {_IDT} SELECT clique, arg_min(type, ({_rank_case('type', TYPE_ORDER)}, type)) AS type FROM mem JOIN idt USING (curie) GROUP BY clique")
def op60_conflation_type(spark, d):
    return conflation.conflation_type(_members(spark, d), _types(spark, d), TYPE_ORDER)


_OM = f"""{_MEM}, {_CT}, om AS (SELECT clique, (row_number() OVER (PARTITION BY clique ORDER BY CASE WHEN {_pfx('curie')} IN ('RXCUI', 'UMLS') THEN 1000000 ELSE coalesce(rank, 2000000) END, {_num('curie')} IS NULL, {_num('curie')}, curie) - 1)::INT AS pos, curie
FROM (SELECT DISTINCT clique, curie FROM mem) m LEFT JOIN ct USING (clique) LEFT JOIN {_RANK_SQL} k ON k.type = ct.type AND k.prefix = {_pfx('curie')})"""


@query(f"WITH {_OM} SELECT clique, pos, curie FROM om")
def op61_conflation_order(spark, d):
    t = _shredded(spark, d, once=True)
    return conflation.order_members(_members(spark, d, t), _clique_types(spark, d, t), _ranks(spark))


@query(f"""WITH {_OM}, {_IDT}, {_IC}, x AS (SELECT om.*, ic, idt.type AS t FROM om LEFT JOIN ics USING (curie) LEFT JOIN idt USING (curie)),
l AS (SELECT x.clique, {_pfx('curie')} AS p, coalesce(ic, 100) AS lic, ct.type AS want FROM x LEFT JOIN ct USING (clique) WHERE pos = 0),
f AS (SELECT x.clique, arg_min(pos, (ic, pos)) AS front FROM x JOIN l USING (clique) WHERE {_pfx('curie')} = p AND t = want AND ic < lic AND pos > 0 GROUP BY x.clique)
SELECT om.clique, (row_number() OVER (PARTITION BY om.clique ORDER BY CASE WHEN pos = front THEN -1 ELSE pos END) - 1)::INT AS pos, curie FROM om LEFT JOIN f USING (clique)""")
def op62_leader_by_score(spark, d):
    return conflation.leader_by_ic(op61_conflation_order(spark, d), _clique_types(spark, d), _types(spark, d), _scores(spark, d))


@query(f"""WITH {_SYN}, {_COMP.removeprefix('WITH RECURSIVE ').replace('RECURSIVE', '')},
docs AS (SELECT curie, synonym FROM syn), n AS (SELECT DISTINCT curie, synonym FROM docs),
cc AS (SELECT n.curie, coalesce(comp.clique, n.curie) AS p, synonym FROM n LEFT JOIN comp USING (curie))
SELECT p AS curie, count(DISTINCT synonym) AS names, min(length(synonym))::INT AS shortest_name_length, count(DISTINCT curie) AS clique_identifier_count FROM cc GROUP BY p""".replace("WITH ", "WITH RECURSIVE ", 1))
def op63_conflated_synonyms(spark, d):
    syn = _synonyms(spark, d).select("curie", "synonym").distinct()
    docs = syn.groupBy("curie").agg(F.array_sort(F.collect_set("synonym")).alias("names"), F.min(F.length("synonym")).alias("shortest_name_length"))
    docs = docs.select("curie", "names", F.array(F.lit("ChemicalEntity")).alias("types"), F.col("names")[0].alias("preferred_name"), "shortest_name_length", F.lit(1).alias("clique_identifier_count"), F.array().cast("array<string>").alias("taxa"))
    comp = op01_components(spark, d)
    conf = comp.select("clique", F.when(F.col("curie") == F.col("clique"), 0).otherwise(1).alias("pos"), "curie")
    return conflation.conflated_synonyms(docs, conf).select("curie", F.size("names").cast("bigint").alias("names"), "shortest_name_length", "clique_identifier_count")


@query(f"WITH {_MEM}, {_LAB}, l AS (SELECT curie, arg_max(label, seq) AS label FROM lab GROUP BY curie) SELECT clique, coalesce(arg_min(CASE WHEN l.label <> '' THEN l.label END, CASE WHEN l.label <> '' THEN pos END), '?') AS label FROM mem LEFT JOIN l USING (curie) GROUP BY clique")
def op64_labelled_cliques(spark, d):
    t = _shredded(spark, d, once=True)
    return conflation.label_cliques(_members(spark, d, t).select("clique", "pos", "curie"), nodes.last_label(_member_labels(spark, d, t)))


_TREES = tuple((t, t) for t in TYPE_ORDER)


@query(f"""WITH {_MEM}, {_LAB}, {_IDT}, u AS (SELECT DISTINCT {plain('curie')} AS curie FROM edge), l AS (SELECT curie, arg_min(label, seq) AS label FROM lab WHERE curie NOT IN (SELECT curie FROM u WHERE curie IS NOT NULL) GROUP BY curie),
s AS (SELECT curie, array_to_string(list_sort(list(DISTINCT type)), '|') AS types FROM ids0 JOIN {_values(_TREES, 'tree', 'kind')} t ON tree = type GROUP BY curie)
SELECT l.curie, label, coalesce(resolved, CASE WHEN NOT contains(types, '|') THEN types END) AS type FROM l JOIN s USING (curie) LEFT JOIN {_values(RULES, 'rule', 'resolved')} r ON rule = types WHERE resolved IS NOT NULL OR NOT contains(types, '|')""")
def op70_leftover_concepts(spark, d):
    used = table(spark, d, "edge").select(C.plain_curie("curie").alias("curie")).where("curie IS NOT NULL")
    sem = _ids(spark, d).select("curie", F.col("type").alias("tree")).where("tree IS NOT NULL")
    good, _ = conflation.leftover_concepts(_member_labels(spark, d), used, sem, spark.createDataFrame(list(_TREES), "tree string, type string"), spark.createDataFrame(list(RULES), "types string, resolved string"))
    return good


# --- reports ---------------------------------------------------------------------------------------
@query("""SELECT lower(preferred_name) AS name_lc, count(*) AS clique_count, count(DISTINCT clique_leader) AS leaders,
coalesce(array_to_string(list_sort(list(DISTINCT filename) FILTER (filename IS NOT NULL)), '||'), '') AS filenames, coalesce(array_to_string(list_sort(list(DISTINCT biolink_type) FILTER (biolink_type IS NOT NULL)), '||'), '') AS biolink_types FROM clique
WHERE preferred_name IS NOT NULL AND trim(preferred_name) <> '' AND coalesce(filename NOT IN ('Publication', 'Food'), true) GROUP BY 1 HAVING count(*) > 1""")
def op80_identical_labels(spark, d):
    return reports.identically_labelled(table(spark, d, "clique"), ("Publication", "Food"))


@query("""WITH c AS (SELECT *, lower(preferred_name) AS name_lc FROM clique WHERE coalesce(filename NOT IN ('Publication', 'Food'), true)),
g AS (SELECT name_lc, count(*) AS n FROM c WHERE preferred_name IS NOT NULL AND trim(preferred_name) <> '' GROUP BY 1 HAVING count(*) > 1)
SELECT name_lc, n AS clique_count, clique_leader, preferred_name, biolink_type FROM c JOIN g USING (name_lc)""")
def op80_identical_label_rows(spark, d):
    return reports.identically_labelled_rows(table(spark, d, "clique"), ("Publication", "Food"))


@query("SELECT curie, count(DISTINCT clique_leader) AS leaders, count(*) AS n, min(clique_leader) AS first_leader, max(clique_leader) AS last_leader FROM edge WHERE curie IS NOT NULL AND clique_leader IS NOT NULL GROUP BY curie HAVING count(DISTINCT clique_leader) > 1")
def op81_duplicate_curies(spark, d):
    return reports.duplicate_curies(table(spark, d, "edge"))


_FILES = "array_to_string(list_sort(list(DISTINCT filename)), '||') AS filenames"


@query("""WITH s AS (SELECT curie FROM edge WHERE curie IS NOT NULL AND clique_leader IS NOT NULL AND conflation = 'None' GROUP BY curie HAVING count(DISTINCT clique_leader) > 1),
h AS (SELECT DISTINCT curie, clique_leader, filename FROM edge WHERE clique_leader IS NOT NULL AND conflation = 'None' AND curie IN (SELECT curie FROM s)),
r AS (SELECT h.*, biolink_type, preferred_name FROM h LEFT JOIN (SELECT DISTINCT clique_leader, biolink_type, preferred_name FROM clique) c USING (clique_leader))
SELECT curie, clique_leader, filename, biolink_type, preferred_name FROM r""")
def op81_duplicate_curie_rows(spark, d):
    return reports.duplicate_curie_rows(table(spark, d, "edge"), table(spark, d, "clique"), "None")


@query(f"SELECT clique_leader, count(*) AS n, {_FILES} FROM clique WHERE clique_leader IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def op82_duplicate_leaders(spark, d):
    return reports.duplicate_leaders(table(spark, d, "clique"))


@query(f"SELECT clique_leader, count(DISTINCT clique_leader) AS n, {_FILES} FROM clique WHERE clique_leader IS NOT NULL GROUP BY 1 HAVING count(DISTINCT clique_leader) > 1")
def op82_duplicate_leaders_strict(spark, d):
    return reports.duplicate_leaders(table(spark, d, "clique"), strict=True)


_E = f"e AS (SELECT coalesce({_pfx('curie')}, '') AS prefix, coalesce({_pfx('clique_leader')}, '') AS leader_prefix, coalesce(filename, '') AS filename, curie, clique_leader FROM edge WHERE curie IS NOT NULL)"


@query(f"""WITH {_E}, f AS (SELECT prefix, array_to_string(list_sort(list(filename || '=' || n)), '||') AS files FROM (SELECT prefix, filename, count(*) AS n FROM e GROUP BY ALL) GROUP BY prefix)
SELECT prefix, count(*) AS curie_count, count(DISTINCT curie) AS distinct_curies, count(DISTINCT clique_leader) AS distinct_leaders, any_value(files) AS files FROM e JOIN f USING (prefix) GROUP BY prefix""")
def op83_prefix_summary(spark, d):
    return reports.prefix_summary(table(spark, d, "edge"))


@query(f"""WITH {_E}, x AS (SELECT * FROM e WHERE clique_leader IS NOT NULL),
s AS (SELECT grouping(leader_prefix, filename)::INT AS level, leader_prefix, filename, count(DISTINCT clique_leader) AS cliques, count(*) AS curies FROM x GROUP BY ROLLUP (leader_prefix, filename)),
h AS (SELECT level, lp, fn, array_to_string(list_sort(list(prefix || '=' || n)), '||') AS histogram FROM (SELECT grouping(leader_prefix, filename)::INT AS level, leader_prefix AS lp, filename AS fn, prefix, count(*) AS n FROM x GROUP BY GROUPING SETS ((leader_prefix, filename, prefix), (leader_prefix, prefix), (prefix))) GROUP BY level, lp, fn)
SELECT s.level, leader_prefix, filename, cliques, curies, histogram FROM s JOIN h ON h.level = s.level AND leader_prefix IS NOT DISTINCT FROM lp AND filename IS NOT DISTINCT FROM fn""")
def op84_clique_prefix_report(spark, d):
    return reports.clique_prefix_report(table(spark, d, "edge"))


@query("SELECT length(preferred_name)::INT AS length, count(*) AS frequency, arg_min(preferred_name, row_id) AS example FROM clique WHERE preferred_name IS NOT NULL GROUP BY 1")
def op85_label_lengths(spark, d):
    return reports.label_lengths(table(spark, d, "clique"), "preferred_name", "row_id")


@query(f"""WITH {_MEM}, {_CT}, per AS (SELECT clique, count(*) AS ids, count(CASE WHEN label <> '' THEN 1 END) AS labels, count(DISTINCT CASE WHEN label <> '' THEN label END) AS unique_labels FROM mem GROUP BY clique)
SELECT measure, bucket, count(*) AS n FROM (SELECT 'type' AS measure, type AS bucket FROM ct UNION ALL SELECT 'prefix', {_pfx('curie')} FROM mem UNION ALL SELECT 'ids', ids::VARCHAR FROM per UNION ALL SELECT 'labels', labels::VARCHAR FROM per UNION ALL SELECT 'unique_labels', unique_labels::VARCHAR FROM per) GROUP BY ALL""")
def op86_content_histograms(spark, d):
    t = _shredded(spark, d, once=True)
    return reports.content_histograms(_members(spark, d, t), _clique_types(spark, d, t))


@query(f"WITH {_E}, f AS (SELECT filename, prefix, count(*) AS n FROM e GROUP BY ALL) SELECT prefix, sum(n)::BIGINT AS n FROM f GROUP BY prefix")
def op87_summed_reports(spark, d):
    e = table(spark, d, "edge").where("curie IS NOT NULL").select(F.coalesce(C.prefix("curie"), F.lit("")).alias("prefix"), "filename")
    return reports.sum_reports(e.groupBy("filename", "prefix").agg(F.count("*").alias("n")), "prefix")


@query(f"WITH {_MEM}, {_IDT} SELECT DISTINCT curie FROM ids0 WHERE curie NOT IN (SELECT curie FROM mem)")
def op89_incomplete(spark, d):
    return reports.incomplete(_ids(spark, d), _members(spark, d))


@query(f"WITH {_SETS} SELECT size, count(*) AS cliques FROM (SELECT clique, count(*) AS size FROM sets GROUP BY clique) GROUP BY size")
def op90_clique_sizes(spark, d):
    return reports.clique_sizes(_sets(spark, d))


@query(f"WITH {_SETS}, p AS (SELECT clique, coalesce({_pfx('curie')}, '') AS p, count(*) AS n FROM sets GROUP BY ALL) SELECT shape, count(*) AS cliques FROM (SELECT clique, array_to_string(list_sort(list(p || '=' || n)), '||') AS shape FROM p GROUP BY clique) GROUP BY shape")
def op90_clique_shapes(spark, d):
    return reports.clique_shapes(_sets(spark, d))


@query(f"WITH {_MEM} SELECT clique, curie FROM (SELECT clique, min(curie) AS curie FROM mem GROUP BY clique HAVING count(*) = 1) WHERE {_pfx('curie')} = 'CHEBI' ORDER BY curie, clique LIMIT 20")
def op91_first_singles(spark, d):
    return reports.first_singles(_members(spark, d), "CHEBI", 20)


@query(f"WITH {_SETS} SELECT clique, count(*) AS size FROM sets GROUP BY clique HAVING count(*) > 10 ORDER BY size DESC, clique LIMIT 20")
def op91_big_cliques(spark, d):
    return reports.big_cliques(_sets(spark, d), 10, 20)


@query(f"WITH {_MEM} SELECT clique, pos, curie FROM mem WHERE clique IN (SELECT clique FROM mem GROUP BY clique HAVING count(*) > 1)")
def op92_without_singles(spark, d):
    return reports.without_singles(_members(spark, d)).select("clique", "pos", "curie")


@query(f"""WITH {_CONC} SELECT 'rows' AS measure, '' AS key, count(*) AS n FROM conc UNION ALL SELECT 'curies', '', count(DISTINCT c) FROM (SELECT subject AS c FROM conc UNION ALL SELECT object FROM conc)
UNION ALL SELECT 'predicate', coalesce(predicate, ''), count(*) FROM conc GROUP BY 2 UNION ALL SELECT 'prefixes', least({_pfx('subject')}, {_pfx('object')}) || '-' || greatest({_pfx('subject')}, {_pfx('object')}), count(*) FROM conc GROUP BY 2""")
def op93_concord_metadata(spark, d):
    return reports.concord_metadata(_concords(spark, d))


_REL = "SELECT count_path AS path, round(TRY_CAST(replace(trim(arg_max(coalesce(cnt, ''), (delivered_at, row_id))), ',', '') AS DECIMAL(38, 6)))::BIGINT AS n FROM release_counts WHERE release_tag = '{}' GROUP BY 1"


@query(f"""WITH a AS ({_REL.format('2025jan23')}), b AS ({_REL.format('2025mar31')}) SELECT coalesce(a.path, b.path) AS path, a.n AS old_n, b.n AS new_n, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM a FULL OUTER JOIN b ON a.path = b.path""")
def op95_release_difference(spark, d):
    rows = table(spark, d, "release_counts").select("release_tag", F.col("count_path").alias("path"), "delivered_at", "row_id", snapshots.whole_number("cnt").cast("bigint").alias("n"))
    one = lambda r: snapshots.latest(rows.where(F.col("release_tag") == r).drop("release_tag"), ["path"], ["delivered_at", "row_id"]).select("path", "n")
    return reports.release_difference(one("2025jan23"), one("2025mar31"))


# --- exports ---------------------------------------------------------------------------------------
def _typed_records(spark, d):
    """The compendium lines of both shapes as records of the current shape; what stands for an array is read as in ``nested.shred``."""
    text = lambda v, *paths: F.coalesce(*[F.try_variant_get(v, p, "string") for p in paths])
    part = lambda v, name: F.try_variant_get(v, f"$.{name}", "variant")
    texts = lambda v: F.transform(nested.as_list(v), lambda x: text(x, "$"))
    listed = lambda name: F.coalesce(nested.as_list(F.col(name)), F.array().cast("array<variant>"))
    bare = lambda x: F.when(~F.schema_of_variant(x).startswith("OBJECT"), text(x, "$"))
    member = lambda x: F.struct(
        F.coalesce(text(x, "$.i", "$.identifier"), bare(x)).alias("i"), text(x, "$.l", "$.label").alias("l"), texts(part(x, "d")).alias("d"), texts(part(x, "t")).alias("t")
    )
    t = table(spark, d, "compendium_jsonl").select("filename", nested.parsed(spark, "raw_line").alias("v")).where("v IS NOT NULL")
    # a step each, so that no variant is taken apart twice
    t = t.select("filename", "v", *[part("v", x).alias(x) for x in ("identifiers", "equivalent_identifiers")])
    t = t.select("filename", "v", nested.opened(F.col("identifiers")).alias("now"), nested.opened(F.col("equivalent_identifiers")).alias("legacy"))
    t = t.select("filename", "v", F.filter(F.concat(listed("now"), listed("legacy")), lambda x: F.schema_of_variant(x) != "VOID").alias("members"))
    return t.select(
        "filename",
        F.get(texts(part("v", "type")), F.lit(0)).alias("type"),
        text("v", "$.ic").try_cast("double").alias("ic"),
        F.transform("members", member).alias("identifiers"),
        text("v", "$.preferred_name", "$.id.label").alias("preferred_name"),
        texts(part("v", "taxa")).alias("taxa"),
    )


def _exported(spark, d):
    s = Scratch(spark, "op100")
    sinks.write_tables(sinks.clique_tables(s.write(_typed_records(spark, d), "records")), s.root)
    return {n: spark.read.parquet(f"{s.root}/{n}") for n in ("Clique", "Edge", "Node")}


_EXPORT = f"""xl AS (SELECT line_id, filename, raw_line::JSON AS j FROM compendium_jsonl WHERE raw_line IS NOT NULL),
xa AS (SELECT line_id, filename, j, unnest([json_extract(j, '$.identifiers'), json_extract(j, '$.equivalent_identifiers')]) AS a, unnest([0, 1]) AS w FROM xl),
xo AS (SELECT line_id, filename, j, w, CASE WHEN json_type(a) = 'VARCHAR' AND json_valid(json_extract_string(a, '$')) THEN json_extract_string(a, '$')::JSON ELSE a END AS a FROM xa WHERE a IS NOT NULL),
xi AS (SELECT line_id, filename, j, w, unnest(range(len({_LIST.format('a')}))) AS pos, unnest({_LIST.format('a')}) AS o FROM xo),
xm AS (SELECT line_id, filename, j, w, pos, coalesce(json_extract_string(o, '$.i'), json_extract_string(o, '$.identifier'), CASE WHEN json_type(o) <> 'OBJECT' THEN json_extract_string(o, '$') END) AS curie FROM xi WHERE json_type(o) <> 'NULL'),
xr AS (SELECT *, first_value(curie) OVER (PARTITION BY line_id ORDER BY w, pos) AS leader FROM xm)"""


@query(f"""WITH {_EXPORT} SELECT filename, leader AS clique_leader, coalesce(json_extract_string(j, '$.preferred_name'), json_extract_string(j, '$.id.label')) AS preferred_name, count(*)::INT AS clique_identifier_count,
json_extract_string({_LIST.format("json_extract(j, '$.type')")}[1], '$') AS biolink_type, TRY_CAST(json_extract_string(j, '$.ic') AS DOUBLE)::FLOAT AS information_content FROM xr GROUP BY line_id, filename, leader, j""")
def op100_exported_cliques(spark, d):
    return _exported(spark, d)["Clique"]


@query(f"WITH {_EXPORT} SELECT filename, leader AS clique_leader, curie, 'None' AS conflation FROM xr")
def op100_exported_edges(spark, d):
    return _exported(spark, d)["Edge"]


@query(f"WITH {_SYN} SELECT curie AS clique_leader, lower(synonym) AS label_lc, synonym AS label, 'biolink:ChemicalEntity' AS biolink_type FROM (SELECT DISTINCT curie, synonym FROM syn)")
def op101_synonym_table(spark, d):
    docs = _synonyms(spark, d).select("curie", "synonym").distinct().select(F.lit("x").alias("filename"), "curie", F.lit("").alias("preferred_name"), F.array(F.lit("ChemicalEntity")).alias("types"), F.array("synonym").alias("names"))
    return sinks.synonym_table(docs).select("clique_leader", "label_lc", "label", "biolink_type")


@query(f"""WITH {_MEM}, {_NAME}, {_CT}, g AS (SELECT clique, arg_min(curie, pos) AS id, string_agg(curie, '|' ORDER BY pos, curie) AS equivalents FROM mem GROUP BY clique)
SELECT id, preferred_name AS name, type AS category, equivalents FROM g LEFT JOIN pn USING (clique) LEFT JOIN ct USING (clique)""")
def op102_graph_nodes(spark, d):
    t = _shredded(spark, d, once=True)
    m = _members(spark, d, t)
    return sinks.graph_nodes(m, nodes.preferred_name(m, BOOSTED), _clique_types(spark, d, t))


@query(f"WITH {_MEM} SELECT md5(a.curie || b.curie || 'compendium') AS id, a.curie AS subject, 'biolink:same_as' AS predicate, b.curie AS object FROM mem a JOIN mem b ON a.clique = b.clique AND a.pos < b.pos")
def op102_same_as(spark, d):
    return sinks.same_as_edges(_members(spark, d), "compendium")


_CLEAN = "lower(trim(regexp_replace({}, '\\|\\|+', '|', 'g')))"


@query(f"""WITH {_SYN}, n AS (SELECT DISTINCT curie, {_CLEAN.format('synonym')} AS n FROM syn WHERE {_CLEAN.format('synonym')} <> ''), p AS (SELECT curie, min(synonym) AS name FROM syn GROUP BY curie), k AS (SELECT curie, count(*) AS k FROM n GROUP BY curie)
SELECT a.curie, 'biolink:NamedThing||' || a.curie || '||' || {_CLEAN.format('name')} || '||' || a.n || '||' || b.n AS line FROM n a JOIN n b ON a.curie = b.curie JOIN p ON p.curie = a.curie JOIN k ON k.curie = a.curie WHERE a.n < b.n OR (k = 1 AND a.n = b.n)""")
def op103_training_pairs(spark, d):
    g = _synonyms(spark, d).groupBy("curie").agg(F.min("synonym").alias("preferred_name"), F.collect_set("synonym").alias("names"))
    return sinks.training_pairs(g.withColumn("type", F.lit("biolink:NamedThing")), most=1_000_000)


# --- source parsers, on tables of like shape --------------------------------------------------------
@query(f"""WITH {_IDT}, x AS (SELECT 'NCBIGene:' || seq AS subject, unnest(string_split(curie || '|HGNC:HGNC:' || seq || '|-', '|')) AS x FROM ids0)
SELECT subject, 'eq' AS predicate, CASE {_pfx('x')} WHEN 'HGNC' THEN 'HGNC' WHEN 'MESH' THEN 'MSH' END || ':' || string_split(x, ':')[-1] AS object FROM x WHERE {_pfx('x')} IN ('HGNC', 'MESH')""")
def op117_gene_xrefs(spark, d):
    rows = _ids(spark, d).select(F.col("seq").alias("gene_id"), F.concat("curie", F.lit("|HGNC:HGNC:"), "seq", F.lit("|-")).alias("xrefs"))
    return parsers.gene_xrefs(rows, {"HGNC": "HGNC", "MESH": "MSH"})


@query(f"""WITH {_IDT}, s AS (SELECT {plain('clique_leader')} AS curie, min(preferred_name) AS smiles FROM clique GROUP BY 1)
SELECT i.curie, CASE WHEN contains(smiles, '.') THEN 'biolink:MolecularMixture' WHEN smiles IS NOT NULL THEN 'biolink:SmallMolecule' ELSE 'biolink:ChemicalEntity' END AS type FROM (SELECT DISTINCT curie FROM ids0) i LEFT JOIN s USING (curie)""")
def op125_structures(spark, d):
    smiles = table(spark, d, "clique").select(C.plain_curie("clique_leader").alias("curie"), "preferred_name").where("curie IS NOT NULL").groupBy("curie").agg(F.min("preferred_name").alias("smiles"))
    return parsers.left_with_smiles(_ids(spark, d), smiles)


@query("""SELECT CASE l_linenumber WHEN 1 THEN 'CHEMBL.COMPOUND' WHEN 2 THEN 'DRUGBANK' WHEN 4 THEN 'GTOPDB' WHEN 6 THEN 'KEGG.COMPOUND' WHEN 7 THEN 'CHEBI' END || ':' || l_partkey AS subject, 'rdkit:inchikey' AS predicate, 'INCHIKEY:' || o_orderpriority AS object
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber IN (1, 2, 4, 6, 7) AND l_returnflag = 'N'""")
def op127_unichem(spark, d):
    ref = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("uci"), F.col("l_linenumber").cast("string").alias("src_id"), F.col("l_partkey").alias("src_compound_id"), F.when(F.col("l_returnflag") == "N", "1").otherwise("0").alias("assignment"))
    return parsers.unichem(ref, table(spark, d, "orders").select(F.col("o_orderkey").alias("uci"), F.col("o_orderpriority").alias("inchikey")))


@query(f"WITH {_CONC} SELECT DISTINCT subject, 'xref' AS predicate, 'CAS:' || substr(object, instr(object, ':') + 1) AS object FROM conc WHERE regexp_full_match(substr(object, instr(object, ':') + 1), '[0-9]+-[0-9]+-[0-9]')")
def op128_cas_concord(spark, d):
    return parsers.cas_concord(_concords(spark, d).select(F.col("subject").alias("curie"), C.suffix("object").alias("synonym")))


@query(f"WITH {_CONC}, w AS (SELECT * FROM conc WHERE object NOT LIKE 'MESH:M%') SELECT row_id, subject, object FROM (SELECT *, count(*) OVER (PARTITION BY object) AS n, count(*) OVER (PARTITION BY subject) AS m FROM w) WHERE n = 1 AND m = 1")
def op137_wikidata_pairs(spark, d):
    return parsers.wikidata_pairs(_concords(spark, d), drop_mesh_m=True).select("row_id", "subject", "object")


@query(f"""WITH e AS (SELECT {plain('clique_leader')} AS t, row_id, preferred_name AS name, provider AS kind FROM clique WHERE {plain('clique_leader')} IS NOT NULL AND preferred_name IS NOT NULL),
g AS (SELECT t, arg_min(CASE WHEN kind = 'gene_feed' THEN name END, CASE WHEN kind = 'gene_feed' THEN row_id END) AS s, arg_min(CASE WHEN kind = 'chem_feed' THEN name END, CASE WHEN kind = 'chem_feed' THEN row_id END) AS c, arg_min(name, row_id) AS a FROM e GROUP BY t)
SELECT 'NCBITaxon:' || t AS curie, CASE WHEN s IS NOT NULL AND c IS NOT NULL THEN s || ' (' || c || ')' ELSE coalesce(s, c, a) END AS label FROM g""")
def op138_taxonomy_labels(spark, d):
    kind = F.when(F.col("provider") == "gene_feed", "scientific name").when(F.col("provider") == "chem_feed", "genbank common name").otherwise("other")
    rows = table(spark, d, "clique").select(F.col("row_id").alias("seq"), C.plain_curie("clique_leader").alias("tax_id"), F.col("preferred_name").alias("name"), kind.alias("kind")).where("tax_id IS NOT NULL AND name IS NOT NULL")
    return parsers.taxonomy(rows)[0]


@query(r"SELECT seq, string_split_regex(trim(curie || ' x'), '\s+')[1] AS curie, 'biolink:Gene' AS type FROM (SELECT seq, trim(curie, ' ' || chr(9) || chr(160)) AS curie FROM ids)")
def op149_projected_ids(spark, d):
    rows = table(spark, d, "ids").select("seq", F.concat(F.btrim("curie", F.lit(" \t\xa0")), F.lit(" x")).alias("value"))
    return readers.project_ids(rows, "biolink:Gene")


# --- closure ---------------------------------------------------------------------------------------
_TREE = "t AS (SELECT 'N:' || n_nationkey AS child, 'R:' || n_regionkey AS parent FROM nation UNION ALL SELECT 'C:' || c_custkey, 'N:' || c_nationkey FROM customer UNION ALL SELECT 'S:' || s_suppkey, 'N:' || s_nationkey FROM supplier)"


def _tree(spark, d):
    n = table(spark, d, "nation").select(F.concat(F.lit("N:"), "n_nationkey").alias("child"), F.concat(F.lit("R:"), "n_regionkey").alias("parent"))
    c = table(spark, d, "customer").select(F.concat(F.lit("C:"), "c_custkey").alias("child"), F.concat(F.lit("N:"), "c_nationkey").alias("parent"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("S:"), "s_suppkey").alias("child"), F.concat(F.lit("N:"), "s_nationkey").alias("parent"))
    return n.unionByName(c).unionByName(s)


def _closure(spark, d):
    roots = table(spark, d, "region").select(F.concat(F.lit("R:"), "r_regionkey").alias("root"))
    return closure.subclasses(_tree(spark, d), roots, Scratch(spark, "op160"))


_CLOSED = f"{_TREE}, r AS (SELECT 'R:' || r_regionkey AS root, 'R:' || r_regionkey AS node FROM region UNION SELECT r.root, t.child FROM r JOIN t ON t.parent = r.node)"


@query(f"WITH RECURSIVE {_CLOSED} SELECT root, node FROM r")
def op160_subclasses(spark, d):
    return _closure(spark, d)


def _triples(spark, d):
    c = table(spark, d, "customer")
    node = F.concat(F.lit("C:"), "c_custkey")
    return c.select(node.alias("s"), F.lit(closure.XREF).alias("p"), F.concat(F.lit("SEG:"), "c_mktsegment").alias("o")).where("o <> 'SEG:BUILDING'").unionByName(c.select(node.alias("s"), F.lit(closure.LABEL).alias("p"), F.col("c_name").alias("o")))


@query(f"WITH RECURSIVE {_CLOSED} SELECT root, node, 'SEG:' || c_mktsegment AS object FROM r JOIN customer ON node = 'C:' || c_custkey WHERE c_mktsegment <> 'BUILDING'")
def op161_xrefs(spark, d):
    return closure.with_objects(_closure(spark, d), _triples(spark, d), (closure.XREF,)).select("root", "node", "object")


@query(f"WITH RECURSIVE {_CLOSED} SELECT root, node, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'SEG:' || c_mktsegment END AS object, c_name AS label FROM r LEFT JOIN customer ON node = 'C:' || c_custkey")
def op162_optional_objects(spark, d):
    t = _triples(spark, d)
    return closure.with_label(closure.with_objects(_closure(spark, d), t, (closure.XREF,), optional=True), t).select("root", "node", "object", "label")


@query("SELECT n_nationkey, n_name FROM nation ORDER BY n_name LIMIT 10 OFFSET 5")
def op164_page(spark, d):
    return closure.page(table(spark, d, "nation").select("n_nationkey", "n_name"), ["n_name"], 5, 10)


@query(f"WITH RECURSIVE {_CLOSED} SELECT DISTINCT node AS subject, 'xref' AS predicate, 'Segment:' || c_mktsegment AS object FROM r JOIN customer ON node = 'C:' || c_custkey WHERE c_mktsegment <> 'BUILDING'")
def op165_concord(spark, d):
    return closure.concord_of(op161_xrefs(spark, d), "C", {"SEG": "Segment"}, ("IGNORED",))


@query(f"WITH RECURSIVE {_CLOSED} SELECT node AS curie, min(CASE root WHEN 'R:1' THEN 'one' WHEN 'R:2' THEN 'two' END) AS type FROM r WHERE root IN ('R:1', 'R:2') AND node LIKE 'C:%' GROUP BY node")
def op166_ids_by_roots(spark, d):
    roots = spark.createDataFrame([("R:1", "one", 0), ("R:2", "two", 1)], "root string, type string, rank int")
    return closure.ids_by_roots(_closure(spark, d), roots, spark.createDataFrame([("R:3",)], "root string"), "C")


@query("""SELECT 'MESH:' || p_partkey AS curie, CASE WHEN p_size % 10 = 3 THEN 'three' ELSE 'five' END AS type FROM part WHERE p_size % 10 IN (3, 5)""")
def op167_tree_ids(spark, d):
    tree = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("D0"), F.col("p_size") % 10, F.lit("."), "p_size").alias("number"))
    branches = spark.createDataFrame([("D03", "three", 0), ("D05", "five", 1), ("D07", "EXCLUDE", 2)], "branch string, type string, rank int")
    return closure.tree_ids(tree, branches)
