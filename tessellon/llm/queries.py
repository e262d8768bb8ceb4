"""Queries of the training-data operators, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellon.functions.curie import not_blank, once, plain_curie, trim_ws
from tessellon.llm import groups, leak, mix, sentences, survivor
from tessellon.operators import nested
from tessellon.plans.data_sql import _IDENTS, plain, present, trim
from tessellon.plans.reference_queries import _COMP
from tessellon.session import Scratch, table

PAIRS = (("drugchemical", "subject", "object"), ("curie_pairs", "curie1", "curie2"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Group of every CURIE in the pairs."""
    links = None
    for name, a, b in PAIRS:
        part = once(table(spark, d, name).select(plain_curie(a).alias("left"), plain_curie(b).alias("right")))
        links = part if links is None else links.unionByName(part)
    none = links.select(F.col("left").alias("member")).where(F.lit(False))
    return groups.groups(links, none, Scratch(spark, "p1")).withColumnRenamed("member", "curie")


def p1_sizes(spark: SparkSession, d: str) -> DataFrame:
    """How many groups there are of each size."""
    sizes = p1_found(spark, d).groupBy("group_id").agg(F.count("*").alias("members"))
    return sizes.groupBy("members").agg(F.count("*").alias("groups"))


# What stands for a missing name, in lower case and without white space around it.
STAND_INS = ("unknown", "null", "none", "n/a", "na", "nan", "nil", "-", "--", "---", "?", "??", ".", "no label", "no name", "unnamed", "missing", "not available", "undefined", "tbd")


def _name_present():
    t = trim_ws("preferred_name")
    return not_blank("preferred_name") & ~F.lower(t).isin(*STAND_INS) & ~t.rlike(r"^[A-Za-z][\w.\-]*:\S+$")


def _survivor_rows(spark: SparkSession, d: str) -> DataFrame:
    """clique rows with their leader in plain form and their provider's trust (five known providers; 0 for any other)."""
    rank = table(spark, d, "provider_rank").where(F.col("provider").isNotNull()).groupBy("provider").agg(F.max("trust").alias("trust"))
    rows = once(table(spark, d, "clique").withColumn("leader", plain_curie("clique_leader"))).where(F.col("leader").isNotNull())
    return rows.join(rank, "provider", "left").withColumn("trust", F.coalesce("trust", F.lit(0)))


def _ident_lines(spark: SparkSession, d: str) -> DataFrame:
    """leader, ident_line: the compendium line whose first identifier is the leader, with most distinct CURIEs."""
    t = nested.shred(table(spark, d, "compendium_jsonl"), "line_id", "raw_line", nested.COMPENDIUM)["identifier"]
    t = once(t.select("line_id", "pos", plain_curie(F.coalesce("i", "identifier", "value")).alias("curie")))
    lines = t.groupBy("line_id").agg(F.min_by("curie", "pos").alias("leader"), F.count_distinct("curie").alias("n"))
    return lines.where(F.col("leader").isNotNull()).groupBy("leader").agg(F.max_by("line_id", F.struct("n", -F.col("line_id"))).alias("ident_line"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each leader with two clique rows or more, field by field."""
    rows = _survivor_rows(spark, d)
    ic = F.col("information_content")
    content = ic.isNotNull() & ~F.isnan(ic) & (ic >= 0) & (ic <= 100)
    row, last = F.col("row_id"), -F.col("row_id")
    best = rows.groupBy("leader").agg(
        survivor.pick(_name_present(), row, F.col("trust"), F.col("updated_at"), last).alias("name_row"),
        survivor.pick(content, row, F.col("updated_at"), last).alias("ic_row"),
        F.count("*").alias("n"),
    )
    return best.where("n >= 2").join(_ident_lines(spark, d), "leader", "left").select(F.col("leader").alias("clique_leader"), "name_row", "ic_row", "ident_line")


def _claims(spark: SparkSession, d: str) -> DataFrame:
    """field_name, item, source, value: who claims what of a leader's name, information content and identifiers.

    Providers of clique claim names and contents; the compendium's lines claim names, contents and the set of identifiers, each
    release being a source. A source is judged field by field, so its name carries the field's.
    """
    rows = _survivor_rows(spark, d)
    ic = F.col("information_content").cast("double")
    provider = F.coalesce("provider", F.lit(""))
    claim = lambda df, field, leader, source, value: df.select(F.lit(field).alias("field_name"), leader.alias("item"), source.alias("source"), value.cast("string").alias("value"))
    own = F.col("leader")
    name = F.when(_name_present(), trim_ws("preferred_name"))
    content = lambda c: F.when((c >= 0) & (c <= 100) & ~F.isnan(c), F.round(c, 4))
    out = claim(rows, "preferred_name", own, provider, name).unionByName(claim(rows, "information_content", own, provider, content(ic)))
    lines = table(spark, d, "compendium_jsonl")
    t = nested.shred(lines, "line_id", "raw_line", nested.COMPENDIUM, Scratch(spark, "p6s"))
    members = once(t["identifier"].select("line_id", "pos", plain_curie(F.coalesce("i", "identifier", "value")).alias("curie")))
    sets = members.groupBy("line_id").agg(F.min_by("curie", "pos").alias("leader"), F.array_join(F.array_sort(F.collect_set("curie")), "|").alias("identifiers"))  # a line's own members
    facts = t["record"].select("line_id", F.coalesce("preferred_name", "id_label").alias("preferred_name"), F.col("ic").try_cast("double").alias("ic"))
    lines = sets.join(facts, "line_id").join(lines.select("line_id", "release_tag"), "line_id")
    release = F.concat(F.lit("compendium "), F.coalesce("release_tag", F.lit("")))
    out = out.unionByName(claim(lines, "preferred_name", own, release, name)).unionByName(claim(lines, "information_content", own, release, content(F.col("ic")))).unionByName(claim(lines, "identifiers", own, release, F.col("identifiers")))
    return out.where("item IS NOT NULL AND value IS NOT NULL")


def p6_fused(spark: SparkSession, d: str) -> DataFrame:
    """Name, information content and identifiers of each leader with the greatest posterior, by fusion with copy detection."""
    claims = _claims(spark, d).select(F.struct("field_name", "item").alias("item"), F.concat_ws("/", "field_name", "source").alias("source"), "value")
    out = survivor.fuse(claims, Scratch(spark, "p6"))
    return out.select(F.col("item.item").alias("clique_leader"), "item.field_name", "value", F.round("posterior", 6).alias("posterior"), "votes")


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    docs, items = table(spark, d, "documents"), table(spark, d, "eval_items")
    return leak.leaks(docs, "doc_id", "text", items, "item_id", "item_text", Scratch(spark, "p8"), F.lower(F.trim("lang")).startswith("zh"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p8_runs(spark: SparkSession, d: str) -> DataFrame:
    """Leaks with the length and place of the longest shared run."""
    return _leaks(spark, d)


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    scratch = Scratch(spark, "p9")
    docs = mix.token_counts(table(spark, d, "documents"), "doc_id", "text", mix.source_name("source")).withColumnRenamed("doc_id", "id")
    return mix.mix(docs, table(spark, d, "mix_targets"), scratch)


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The mixture: every copy of every document used, with its place in the order."""
    return _mix(spark, d)[0].withColumnRenamed("id", "doc_id")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and reached share of each source."""
    return _mix(spark, d)[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.split_sentences(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p1_found, p1_sizes, p6_found, p6_fused, p8_found, p8_runs, p9_mixture, p9_shares, p10_found)}

_T = trim("preferred_name")
_PRESENT = f"""({present('preferred_name')} AND lower({_T}) NOT IN ({', '.join(f"'{x}'" for x in STAND_INS)}) AND NOT regexp_full_match({_T}, '[A-Za-z][\\w.\\-]*:\\S+'))"""
P6_FOUND = f"""WITH {_IDENTS},
i AS (SELECT line_id, pos, {plain("coalesce(json_extract_string(o, '$.i'), json_extract_string(o, '$.identifier'), CASE WHEN json_type(o) <> 'OBJECT' THEN json_extract_string(o, '$') END)")} AS curie FROM idents WHERE json_type(o) <> 'NULL'),
l AS (SELECT line_id, arg_min(curie, pos) AS leader, count(DISTINCT curie) AS n FROM i GROUP BY line_id),
best AS (SELECT leader, line_id AS ident_line FROM (SELECT *, row_number() OVER (PARTITION BY leader ORDER BY n DESC, line_id) AS rn FROM l WHERE leader IS NOT NULL) WHERE rn = 1),
c AS (SELECT q.*, {plain('clique_leader')} AS leader, coalesce(trust, 0) AS t FROM clique q LEFT JOIN provider_rank USING (provider)),
names AS (SELECT leader, row_id FROM (SELECT leader, row_id, row_number() OVER (PARTITION BY leader ORDER BY t DESC, updated_at DESC NULLS LAST, row_id) AS rn FROM c WHERE {_PRESENT}) WHERE rn = 1),
ics AS (SELECT leader, row_id FROM (SELECT leader, row_id, row_number() OVER (PARTITION BY leader ORDER BY updated_at DESC NULLS LAST, row_id) AS rn FROM c WHERE information_content BETWEEN 0 AND 100 AND NOT isnan(information_content)) WHERE rn = 1)
SELECT g.leader AS clique_leader, names.row_id AS name_row, ics.row_id AS ic_row, ident_line
FROM (SELECT leader FROM c WHERE leader IS NOT NULL GROUP BY leader HAVING count(*) >= 2) g
LEFT JOIN names ON names.leader = g.leader LEFT JOIN ics ON ics.leader = g.leader LEFT JOIN best ON best.leader = g.leader"""

_LINES = f"""{_IDENTS},
i AS (SELECT line_id, pos, {plain("coalesce(json_extract_string(o, '$.i'), json_extract_string(o, '$.identifier'), CASE WHEN json_type(o) <> 'OBJECT' THEN json_extract_string(o, '$') END)")} AS curie FROM idents WHERE json_type(o) <> 'NULL'),
sets AS (SELECT line_id, arg_min(curie, pos) AS leader, array_to_string(list_sort(list(DISTINCT curie) FILTER (curie IS NOT NULL)), '|') AS identifiers FROM i GROUP BY line_id),
facts AS (SELECT line_id, leader, identifiers, coalesce(json_extract_string(j, '$.preferred_name'), json_extract_string(j, '$.id.label')) AS preferred_name, TRY_CAST(json_extract_string(j, '$.ic') AS DOUBLE) AS ic, 'compendium ' || coalesce(release_tag, '') AS source
  FROM sets JOIN lines USING (line_id) JOIN (SELECT line_id, release_tag FROM compendium_jsonl) USING (line_id))"""
_RANGE = "CASE WHEN {0} >= 0 AND {0} <= 100 AND NOT isnan({0}) THEN round({0}, 4)::VARCHAR END"
_CLAIMS = f"""{_LINES}, cl AS (SELECT {plain('clique_leader')} AS leader, coalesce(provider, '') AS source, preferred_name, information_content::DOUBLE AS ic FROM clique),
claims AS (SELECT 'preferred_name' AS f, leader AS item, source, CASE WHEN {_PRESENT} THEN {_T} END AS value FROM cl UNION ALL SELECT 'information_content', leader, source, {_RANGE.format('ic')} FROM cl
  UNION ALL SELECT 'preferred_name', leader, source, CASE WHEN {_PRESENT} THEN {_T} END FROM facts UNION ALL SELECT 'information_content', leader, source, {_RANGE.format('ic')} FROM facts UNION ALL SELECT 'identifiers', leader, source, identifiers FROM facts),
counted AS (SELECT f, item, f || '/' || source AS source, value, count(*) AS n FROM claims WHERE item IS NOT NULL AND value IS NOT NULL GROUP BY ALL),
c AS (SELECT f, item, source, value FROM (SELECT *, row_number() OVER (PARTITION BY f, item, source ORDER BY n DESC, value) AS rn FROM counted) WHERE rn = 1),
acc0 AS (SELECT DISTINCT source, 0.8::DOUBLE AS a FROM c), ind0 AS (SELECT '' AS source, '' AS leader, 1.0::DOUBLE AS x WHERE false)"""


def _round_sql(r: int) -> str:
    """One round of fusion: votes, and but for the last round the accuracies and independences that follow."""
    vote = f"""w{r} AS (SELECT c.f, c.item, c.source, c.value, any_value(ln(10 * a / (1 - a))) * product(coalesce(x, 1)) AS s FROM c JOIN acc{r} USING (source)
  LEFT JOIN c d ON d.f = c.f AND d.item = c.item AND d.value = c.value AND d.source <> c.source LEFT JOIN ind{r} i ON i.source = c.source AND i.leader = d.source GROUP BY c.f, c.item, c.source, c.value),
v{r} AS (SELECT f, item, value, sum(s) AS s, count(*) AS votes FROM w{r} GROUP BY f, item, value), e{r} AS (SELECT *, exp(s - max(s) OVER (PARTITION BY f, item)) AS e FROM v{r}),
p{r} AS (SELECT f, item, value, votes, e / sum(e) OVER (PARTITION BY f, item) AS p FROM e{r})"""
    learn = f"""j{r} AS (SELECT c.*, p FROM c JOIN p{r} USING (f, item, value)), acc{r + 1} AS (SELECT source, least(0.99, greatest(0.05, avg(p))) AS a FROM j{r} GROUP BY source),
m{r} AS (SELECT x.source AS s1, y.source AS s2, sum(CASE WHEN x.value = y.value THEN x.p ELSE 0 END) AS t, sum(CASE WHEN x.value = y.value THEN 1 - x.p ELSE 0 END) AS f, sum(CASE WHEN x.value = y.value THEN 0 ELSE 1 END) AS d
  FROM j{r} x JOIN j{r} y ON x.f = y.f AND x.item = y.item AND y.source > x.source GROUP BY ALL),
k{r} AS (SELECT m.*, a.a AS a1, b.a AS a2, a.a * b.a AS pt, (1 - a.a) * (1 - b.a) / 10 AS pf FROM m{r} m JOIN acc{r + 1} a ON a.source = s1 JOIN acc{r + 1} b ON b.source = s2),
l{r} AS (SELECT *, greatest(-60, least(60, t * ln((0.8 * a1 + 0.2 * pt) / pt) + f * ln((0.8 * (1 - a1) + 0.2 * pf) / pf) + d * ln(0.2::DOUBLE))) AS ratio, a1 > a2 OR (a1 = a2 AND s1 < s2) AS first FROM k{r}),
ind{r + 1} AS (SELECT CASE WHEN first THEN s2 ELSE s1 END AS source, CASE WHEN first THEN s1 ELSE s2 END AS leader, 1 - 0.8 / (1 + 4 * exp(-ratio)) AS x FROM l{r})"""
    return vote if r == 2 else f"{vote},\n{learn}"


P6_FUSED = f"""WITH {_CLAIMS}, {_round_sql(0)}, {_round_sql(1)}, {_round_sql(2)}
SELECT item AS clique_leader, f AS field_name, value, round(p, 6) AS posterior, votes FROM (SELECT *, row_number() OVER (PARTITION BY f, item ORDER BY p DESC, value) AS rn FROM p2) WHERE rn = 1"""

P1_FOUND = _COMP + " SELECT curie, clique AS group_id FROM comp"
P1_SIZES = _COMP + " SELECT members, count(*) AS groups FROM (SELECT clique, count(*) AS members FROM comp GROUP BY clique) GROUP BY members"

_BLOCK, _TAG = leak.BLOCK_TAG, leak.TAG


def _words(c: str) -> str:
    clean = f"regexp_replace(regexp_replace({c}, '{_BLOCK}', ' ', 'gi'), '{_TAG}', '', 'gs')"
    return f"regexp_extract_all(regexp_replace(lower(strip_accents(regexp_replace({clean}, '[*_]', '', 'g'))), '[\\p{{Mn}}\\p{{Me}}\\p{{Cf}}]', '', 'g'), '[\\p{{L}}\\p{{N}}]+')"


_GRAMS = f"""i0 AS (SELECT item_id, coalesce(starts_with(lower(trim(lang)), 'zh'), false) AS zh, {_words('item_text')} AS w FROM eval_items WHERE item_text IS NOT NULL),
d0 AS (SELECT doc_id, {_words('text')} AS w FROM documents WHERE text IS NOT NULL),
it AS (SELECT item_id, zh, CASE WHEN zh THEN string_split(array_to_string(w, ''), '') ELSE w END AS t FROM i0),
dt AS (SELECT doc_id, false AS zh, w AS t FROM d0 UNION ALL SELECT doc_id, true, string_split(array_to_string(w, ''), '') FROM d0),
span AS (SELECT * FROM (VALUES (false, {leak.WORDS.span}), (true, {leak.CHARS.span})) s(zh, n)),
ig AS (SELECT DISTINCT item_id, zh, array_to_string(list_slice(t, k, k + n - 1), ' ') AS g FROM (SELECT item_id, zh, t, n, unnest(range(1, len(t) - n + 2)) AS k FROM it JOIN span USING (zh))),
dg AS (SELECT DISTINCT doc_id, zh, array_to_string(list_slice(t, k, k + n - 1), ' ') AS g FROM (SELECT doc_id, zh, t, n, unnest(range(1, len(t) - n + 2)) AS k FROM dt JOIN span USING (zh))),
leaks AS (SELECT DISTINCT zh, doc_id, item_id FROM dg JOIN ig USING (zh, g))"""
P8_FOUND = f"WITH {_GRAMS} SELECT doc_id, item_id FROM leaks"
P8_RUNS = f"""WITH {_GRAMS}, a AS (SELECT zh, doc_id, unnest(t) AS tok, unnest(range(len(t))) AS i FROM dt), b AS (SELECT zh, item_id, unnest(t) AS tok, unnest(range(len(t))) AS j FROM it),
m AS (SELECT doc_id, item_id, i, i - j AS diagonal, i - row_number() OVER (PARTITION BY doc_id, item_id, i - j ORDER BY i) AS island FROM leaks JOIN a USING (zh, doc_id) JOIN b USING (zh, item_id, tok)),
runs AS (SELECT doc_id, item_id, count(*) AS shared, min(i) AS start FROM m GROUP BY doc_id, item_id, diagonal, island)
SELECT doc_id, item_id, max(shared)::INT AS shared, arg_max(start, (shared, -start))::INT AS "at" FROM runs GROUP BY doc_id, item_id"""

SQL = {"p1_found": P1_FOUND, "p1_sizes": P1_SIZES, "p6_found": P6_FOUND, "p6_fused": P6_FUSED, "p8_found": P8_FOUND, "p8_runs": P8_RUNS}
