"""The clique engine: constrained merging against a sequential model, and the other operators on small cases."""

import random

import pytest

from tessellon.operators import closure, cliques, conflation, nodes, reports, typing
from tessellon.operators.components import components
from tessellon.plans import reference_queries
from tessellon.session import Scratch


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


# --- merging ---------------------------------------------------------------------------------------
def model(pairs, unique, close=()):
    """Pairs one by one, as sets."""
    sets = {}
    for group in pairs:
        group = [x for x in group if x is not None]
        new = set(group).union(*(sets[x] for x in group if x in sets))
        if any(len({x for x in new if x.split(":")[0] == p}) > 1 for p in unique) or any(a in new and b in new for a, b in close):
            continue
        for x in new:
            sets[x] = new
    return {x: min(s) for x, s in sets.items()}


def frame(spark, pairs):
    return spark.createDataFrame([(1, 0, i, *p) for i, p in enumerate(pairs)], "stage int, file_seq int, seq long, left string, right string")


@pytest.mark.parametrize("seed", range(3))
def test_glom_is_the_sequential_merge(spark, seed):
    r = random.Random(seed)
    pairs = []
    for block in range(25):
        names = [f"{p}:{block}-{i}" for p in ("A", "B", "C") for i in range(4)]
        pairs += [(r.choice(names), r.choice([*names, None])) for _ in range(r.randrange(1, 12))]
    r.shuffle(pairs)
    close = [("A:1-0", "C:1-1"), ("B:2-0", "B:2-3")]
    near = spark.createDataFrame(close, "subject string, object string")
    want = model(pairs, ("A", "B"), close)
    for parts in (1, 5):  # partitioning changes nothing
        got = cliques.glom(frame(spark, pairs).repartition(parts), Scratch(spark, "t"), ("A", "B"), near)
        assert rows(got, "curie", "clique") == sorted(want.items())
    assert len(want) < len({x for p in pairs for x in p if x})


def test_glom_order_matters_and_unseen_ends_vanish(spark, scratch):
    a = [("A:1", "B:1"), ("B:1", "A:2")]
    assert rows(cliques.glom(frame(spark, a), scratch, ("A",)), "curie", "clique") == [("A:1", "A:1"), ("B:1", "A:1")]
    assert rows(cliques.glom(frame(spark, a[::-1]), scratch, ("A",)), "curie", "clique") == [("A:2", "A:2"), ("B:1", "A:2")]


def test_glom_errors(spark, scratch):
    with pytest.raises(Exception, match="two members"):
        cliques.pairs_of_sets(spark.createDataFrame([(["a", "b", "c"],)], "m array<string>"), "m").collect()
    with pytest.raises(Exception, match="bare prefix"):
        cliques.glom(frame(spark, [("KEGG:1", "B:1")]), scratch)
    assert cliques.glom(frame(spark, []), scratch).count() == 0


def test_components(spark, scratch):
    p = [f"n{i}" for i in range(120)]
    random.Random(1).shuffle(p)
    pairs = [*zip(p, p[1:]), ("x", "x"), ("y", None), (None, None), ("y", "z"), ("z", "y")]
    got = dict(rows(components(spark.createDataFrame(pairs, "a string, b string"), scratch), "node", "component"))
    assert {got[x] for x in p} == {"n0"} and (got["x"], got["y"], got["z"]) == ("x", "y", "y") and len(got) == 123


def test_seed_and_untyped(spark, scratch):
    seed = spark.createDataFrame([("A:1", "A:1"), ("B:1", "A:1"), ("C:1", "A:1")], "curie string, clique string")
    ids = spark.createDataFrame([(0, 1, "B:1", "T"), (0, 2, "D:1", None), (1, 1, "B:1", "U")], "file_seq int, seq long, curie string, type string")
    conc = spark.createDataFrame([(0, 1, "D:1", "x", "C:1"), (0, 2, "E:1", "x", "F:1"), (0, 3, "G:1", "x", "F:1")], "file_seq int, seq long, subject string, predicate string, object string")
    got = dict(rows(cliques.untyped_cliques(ids, conc, scratch, seed), "curie", "clique"))
    assert got == {x: "A:1" for x in ("A:1", "B:1", "C:1", "D:1")}
    assert dict(rows(cliques.read_identifiers(ids)[1], "curie", "type")) == {"B:1": "U"}


def test_untyped_cliques_of_untyped_ids(spark, tmp_path):
    ids = [(0, 1, "A:1", "T"), (0, 2, "b:1", None), (0, 3, None, "T")]
    spark.createDataFrame(ids, "file_seq int, seq long, curie string, biolink_type string").write.parquet(str(tmp_path / "ids.parquet"))
    spark.createDataFrame([(1, 0, 1, "A:1", "x", "C:1")], "row_id long, file_seq int, seq long, subject string, predicate string, object string").write.parquet(str(tmp_path / "drugchemical.parquet"))
    got = reference_queries.op14_untyped_cliques(spark, str(tmp_path))
    assert rows(got, "curie", "clique") == [("A:1", "A:1"), ("B:1", "B:1"), ("C:1", "A:1")]


def test_filters(spark):
    p = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("c", "z"), ("c", "w")], "subject string, object string")
    assert rows(cliques.overused_xrefs(p), "subject", "object") == [("b", "y"), ("c", "w"), ("c", "z")]
    assert rows(cliques.overused_xrefs(p, True), "subject", "object") == [("b", "y")]
    s = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, "c"), (3, "c")], "k int, m string")
    assert rows(cliques.unique_members(s, "k", "m"), "k", "m") == [(1, "a"), (2, None), (3, "c")]
    assert rows(cliques.clean_sets(s, "k", "m"), "k", "m") == [(1, "a"), (2, None), (3, None)]
    bad = cliques.parse_bad_pairs(spark.createDataFrame([("# a b",), ("b y",), ("c",)], "value string"))
    assert rows(cliques.without_bad_pairs(p, bad), "subject").count(("b",)) == 0
    with pytest.raises(ValueError):
        mixed = spark.createDataFrame([(0, 1, "A:1", "x", "C:1"), (0, 2, "B:1", "x", "D:1")], "file_seq int, seq long, subject string, predicate string, object string")
        cliques.combine_structures(mixed, None)


# --- typing and nodes ------------------------------------------------------------------------------
def test_typing(spark):
    m = spark.createDataFrame([(1, "GO:1"), (1, "X:1"), (1, "X:2"), (2, "X:1"), (2, "X:3"), (3, "Y:1")], "clique int, curie string")
    t = spark.createDataFrame([("GO:1", "cc"), ("X:1", "cell"), ("X:2", "cell"), ("X:3", "gross")], "curie string, type string")
    assert rows(typing.typed_by_vote(m, t, ("gross", "cell"), ("GO",)), "clique", "type") == [(1, "cc"), (2, "gross"), (3, None)]
    p = spark.createDataFrame([(1, "P:1"), (1, "P:2"), (1, "Q:1"), (2, "P:1"), (3, "Q:1")], "clique int, curie string")
    pt = spark.createDataFrame([("P:1", "small"), ("P:2", "mix")], "curie string, type string")
    split = typing.typed_with_split(p, pt, ("small", "mix"), "P", ("small", "mix"), "chem")
    assert rows(split, "clique", "part", "type") == sorted([(1, 0, "small"), (1, 1, "mix"), (2, None, "small"), (3, None, "chem")], key=repr)
    assert rows(typing.split_members(p, pt, split, ("small", "mix")), "clique", "part", "curie") == sorted([(1, 0, "P:1"), (1, 0, "Q:1"), (1, 1, "P:2"), (2, None, "P:1"), (3, None, "Q:1")], key=repr)


def test_pubchem_leader(spark):
    P = "PUBCHEM.COMPOUND"
    data = [(1, f"{P}:1", "water"), (1, f"{P}:2", "ice"), (1, "X:1", "ICE"), (2, f"{P}:1", "a longer name"), (2, f"{P}:3", "CID 3"), (2, f"{P}:4", "short"), (3, f"{P}:9", ""), (3, f"{P}:8", None), (4, f"{P}:1", "x"), (5, f"{P}:7", "CID 7"), (5, f"{P}:6", None)]
    got = nodes.pubchem_leader(spark.createDataFrame(data, "clique int, curie string, label string"))
    assert rows(got, "clique", "leader") == [(1, f"{P}:2"), (2, f"{P}:4"), (3, f"{P}:8"), (5, f"{P}:7")]


def test_names_and_order(spark):
    m = spark.createDataFrame([(1, 0, "A:1", "a very long label indeed"), (1, 1, "B:1", "short"), (1, 2, "C:1", "tiny"), (2, 0, "A:2", ""), (3, 0, "A:3", "another very long label")], "clique int, pos int, curie string, label string")
    assert rows(nodes.preferred_name(m), "clique", "preferred_name") == [(1, "short"), (2, ""), (3, "another very long label")]
    assert rows(nodes.preferred_name(m, ("C",)), "clique", "preferred_name")[0] == (1, "tiny")
    ranks = spark.createDataFrame([("t", "Bx", 0), ("t", "A", 1)], "type string, prefix string, rank int")
    o = nodes.ordered_members(spark.createDataFrame([(1, "a:2"), (1, "A:2"), (1, "BX:9"), (1, "Z:1"), (2, "Z:1")], "clique int, curie string"), spark.createDataFrame([(1, "t"), (2, "t")], "clique int, type string"), ranks)
    assert rows(o, "clique", "pos", "curie") == [(1, 0, "Bx:9"), (1, 1, "A:2")]
    props = spark.createDataFrame([("A:1", "hasAlternativeId", "Z:9"), ("A:1", "hasAlternativeId", "B:1")], "curie string, predicate string, value string")
    assert rows(nodes.insert_alternatives(m.where("clique = 1"), props), "pos", "curie") == [(0, "A:1"), (1, "B:1"), (2, "Z:9"), (3, "C:1")]
    with pytest.raises(Exception, match="unknown predicate"):
        nodes.check_properties(spark.createDataFrame([("a", "x", "b", "s")], "curie string, predicate string, value string, source string")).collect()


# --- conflation, reports, closure ------------------------------------------------------------------
def test_gene_protein(spark, scratch):
    pairs = spark.createDataFrame([(0, 1, "U:1", "N:1"), (0, 2, "U:2", "N:1"), (0, 3, "U:9", "N:9")], "file_seq int, seq long, subject string, object string")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "curie string")
    g = conflation.gene_protein(pairs, ids("N:1", "N:9"), ids("U:1", "U:2"), scratch, ("N", "U"))
    assert rows(g, "pos", "curie") == [(0, "N:1"), (1, "U:1"), (2, "U:2")]
    genes = spark.createDataFrame([("N:1", "N:1"), ("N:1", "E:1"), ("N:5", "N:5")], "leader string, curie string")
    proteins = spark.createDataFrame([("U:1", "U:1"), ("U:2", "U:2"), ("U:7", "U:7")], "leader string, curie string")
    assert rows(conflation.merged_gene_protein(genes, proteins, g), "leader", "curie", "kind") == [("N:1", "E:1", "merged"), ("N:1", "N:1", "merged"), ("N:1", "U:1", "merged"), ("N:1", "U:2", "merged"), ("N:5", "N:5", "gene"), ("U:7", "U:7", "protein")]
    with pytest.raises(Exception, match="unexpected prefix"):
        conflation.gene_protein(pairs, ids("N:1"), ids("U:1", "U:2"), scratch, ("N",)).collect()


def test_leader_by_score(spark):
    o = spark.createDataFrame([(1, 0, "A:1"), (1, 1, "B:1"), (1, 2, "A:2"), (1, 3, "A:3")], "clique int, pos int, curie string")
    t = spark.createDataFrame([("A:1", "t"), ("A:2", "t"), ("A:3", "u")], "curie string, type string")
    ic = spark.createDataFrame([("A:2", 50.0), ("A:3", 1.0), ("B:1", 0.0)], "curie string, ic double")
    got = conflation.leader_by_ic(o, spark.createDataFrame([(1, "t")], "clique int, type string"), t, ic)
    assert [c for _, c in rows(got, "pos", "curie")] == ["A:2", "A:1", "B:1", "A:3"]


def test_conflated_synonyms(spark):
    docs = spark.createDataFrame([("A", ["x", "y"], ["t"], "x", 1, 2, ["N:2"]), ("B", ["y", "z"], ["u"], "y", 3, 1, ["N:1", "N:2"]), ("C", ["c"], [], "c", 1, 1, [])], "curie string, names array<string>, types array<string>, preferred_name string, shortest_name_length int, clique_identifier_count int, taxa array<string>")
    conf = spark.createDataFrame([(1, 0, "B"), (1, 1, "A")], "clique int, pos int, curie string")
    got = {r["curie"]: r for r in conflation.conflated_synonyms(docs, conf).collect()}
    assert got["B"]["names"] == ["y", "z", "x"] and got["B"]["types"] == ["u", "t"] and got["B"]["clique_identifier_count"] == 3 and got["B"]["taxa"] == ["N:1", "N:2"] and set(got) == {"B", "C"}


def test_reports(spark, tmp_path):
    (tmp_path / "a").write_text("")
    (tmp_path / ".nfs1").write_text("")
    reports.assert_files(spark, str(tmp_path), ["a"])
    with pytest.raises(AssertionError):
        reports.assert_files(spark, str(tmp_path), ["a", "b"])
    c = reports.flatten_counters(spark.createDataFrame([('{"a": {"b": 1, "c": {"d": 2}}, "e": 3, "f": "x"}',)], "j string"), "j")
    assert rows(c, "path", "n") == [("a.b", 1), ("a.c.d", 2), ("e", 3)]
    assert '"x": [' in reports.combined_metadata("r", [{"name": "x"}, {"name": "x"}, {"name": "y"}])


def test_closure(spark, scratch):
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("d", "c"), ("x", "x"), (None, "a")], "child string, parent string")
    got = closure.subclasses(e, spark.createDataFrame([("b",), ("lone",)], "root string"), scratch)
    assert rows(got, "root", "node") == [("b", "a"), ("b", "b"), ("b", "c"), ("b", "d"), ("lone", "lone")]
    t = spark.createDataFrame([("a", "skos:exactMatch", "E:1"), ("a", closure.XREF, "X:1"), ("b", closure.XREF, "X:2")], "s string, p string, o string")
    n = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    assert rows(closure.with_fallback(n, t, closure.EXACT, (closure.XREF,)), "node", "object") == [("a", "E:1"), ("b", "X:2")]
    r = spark.createDataFrame([("http://p/CL_1", "v"), ("http://p/ro#x", "v"), ("http://p/TAX_2", "v")], "iri string, value string")
    assert rows(closure.common_rows(r), "curie") == [("CL:1",)]


def test_only_llm_knows_llm():
    import pathlib

    root = pathlib.Path(cliques.__file__).parents[1]
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "tessellon.llm" in p.read_text()]
