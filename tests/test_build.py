"""The build of a domain and the registry of its stages."""

import pytest
from pyspark.sql import functions as F

from tessellon.operators import build, cliques
from tessellon.plans.stages import Registry
from tessellon.sources import domains


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def inputs(spark, ids, concords, close=None):
    mk = lambda schema, data=(): spark.createDataFrame(list(data), schema)
    return build.Inputs(
        mk("file_seq int, seq long, curie string, type string", [(0, i, *x) for i, x in enumerate(ids)]),
        mk("source string, file_seq int, seq long, subject string, predicate string, object string", [(s, 1, i, a, "eq", b) for i, (s, a, b) in enumerate(concords)]),
        mk("type string, prefix string, rank int", [("biolink:Disease", "MONDO", 0), ("biolink:Disease", "UMLS", 2), ("biolink:Disease", "MESH", 1), ("biolink:PhenotypicFeature", "HP", 0), ("biolink:PhenotypicFeature", "UMLS", 1)]),
        mk("seq long, curie string, label string", [(1, "UMLS:1", "a long name of more than fifteen"), (2, "MESH:1", "short"), (3, "UMLS:1", "last name")]),
        mk("curie string, predicate string, synonym string", [("MONDO:1", "p", "syn")]),
        mk("curie string, description string", [("MESH:1", "text")]),
        mk("curie string, taxon string"),
        mk("curie string, ic double", [("UMLS:1", 50.0), ("MONDO:1", 70.0)]),
        close,
    )


def test_build(spark, scratch):
    """Two MONDO terms are never merged, a filtered source loses its overused objects, another keeps them."""
    ids = [("MONDO:1", "biolink:Disease"), ("MONDO:2", "biolink:Disease"), ("HP:1", "biolink:PhenotypicFeature"), ("UMLS:1", None), ("X:1", None)]
    concords = [("UMLS", "MONDO:1", "UMLS:1"), ("UMLS", "UMLS:1", "MESH:1"), ("UMLS", "MONDO:2", "MESH:1"), ("HP", "HP:1", "UMLS:9"), ("HP", "HP:2", "UMLS:9"), ("DOID", "X:1", "X:2")]
    b = build.build(cliques.DOMAINS["disease"], inputs(spark, ids, concords), scratch, domains.VOTE_ORDER["disease"], domains.LEADING_PREFIXES["disease"])
    assert rows(b["members"], "clique", "pos", "curie") == [("HP:1", 0, "HP:1"), ("MESH:1", 0, "MONDO:1"), ("MESH:1", 1, "MESH:1"), ("MESH:1", 2, "UMLS:1"), ("MONDO:2", 0, "MONDO:2")]
    rec = {r["clique"]: r for r in b["records"].collect()}
    assert rec["MESH:1"]["type"] == "biolink:Disease" and rec["MESH:1"]["ic"] == 50.0 and rec["MESH:1"]["preferred_name"] == "short"
    assert [(x["i"], x["l"], x["d"]) for x in rec["MESH:1"]["identifiers"]] == [("MONDO:1", "", []), ("MESH:1", "short", ["text"]), ("UMLS:1", "last name", [])]
    syn = {r["curie"]: r["names"] for r in b["synonyms"].collect()}
    assert "syn" in syn["MONDO:1"] and set(syn) == {"MONDO:1"}
    extra = build.build({**cliques.DOMAINS["disease"], "extra": ("X", "MESH")}, inputs(spark, [*ids, ("X:1", "biolink:Disease")], concords), scratch, domains.VOTE_ORDER["disease"])
    assert ("X:1", 0, "X:1") in rows(extra["members"], "clique", "pos", "curie")


def test_build_of_nothing(spark, scratch):
    b = build.build(cliques.DOMAINS["anatomy"], inputs(spark, [], []), scratch)
    assert all(df.count() == 0 for df in b.values())


def test_concord_filters(spark):
    c = inputs(spark, [], [("A", "a:1", "b:1"), ("A", "a:2", "b:1"), ("A", "a:3", "b:2"), ("B", "a:4", "b:2"), ("A", "a:3", "b:3")]).concords
    keep = lambda s: rows(build.filtered_concords(c, s), "source", "subject", "object")
    assert keep({"filter": "all"}) == [("A", "a:3", "b:2"), ("A", "a:3", "b:3"), ("B", "a:4", "b:2")]
    assert keep({"filter": "all", "both_ways": True}) == [("B", "a:4", "b:2")]
    assert len(keep({"filter": ("B",)})) == 5 and len(keep({})) == 5


def test_stages(spark, tmp_path):
    made = []
    reg = Registry(spark, f"file://{tmp_path}")

    @reg.add("raw", temporary=True)
    def raw(t):
        made.append("raw")
        return spark.range(5)

    @reg.each("part_{}", ["a", "b"], "raw")
    def part(t, v):
        made.append(v)
        return t["raw"].withColumn("v", F.lit(v))

    @reg.add("all", "part_a", "part_b")
    def all_(t):
        return t["part_a"].unionByName(t["part_b"])

    assert [s.name for s in reg.order("all")] == ["raw", "part_a", "part_b", "all"]
    assert reg.run("all") == ["raw", "part_a", "part_b", "all"] and reg.table("all").count() == 10
    assert not (tmp_path / "raw").exists() and reg.run("all") == [] and made == ["raw", "a", "b"]
    reg.add("x", "y")(lambda t: None)
    reg.add("y", "x")(lambda t: None)
    with pytest.raises(ValueError):
        reg.order("x")
    with pytest.raises(ValueError):
        reg.order("nowhere")
