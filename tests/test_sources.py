"""Readers, parsers and sinks on small files and rows of the sources' shapes."""

import gzip
import hashlib
import json

import pytest

from tessellon.plans import reference_queries
from tessellon.sources import domains, parsers, readers, sinks


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_readers(spark, tmp_path):
    f = tmp_path / "a.txt"
    f.write_text("A:1\tname\t\nA:2\tx\ty\tz\nA:3\n", encoding="utf8")
    assert rows(readers.labels(spark, str(f)), "curie", "label") == [("A:1", "name"), ("A:2", "x"), ("A:3", None)]
    assert rows(readers.synonyms(spark, str(f)), "curie", "synonym") == [("A:1", ""), ("A:2", "y")]
    assert rows(readers.descriptions(spark, str(f)), "curie", "description") == [("A:1", "name\t"), ("A:2", "x\ty\tz")]
    (tmp_path / "l.txt").write_bytes("B:1\tM\xfcller\n".encode("latin-1"))
    assert readers.fields(readers.lines(spark, str(tmp_path / "l.txt"), "ISO-8859-1"), "curie", "label").first()["label"] == "Müller"
    (tmp_path / "m.txt").write_text("# c\n\nA:1\teq\tB:1\n")
    assert rows(readers.manual_concord(spark, str(tmp_path / "m.txt")), "subject", "object") == [("A:1", "B:1")]
    (tmp_path / "m2.txt").write_text("A:1\teq\n")
    with pytest.raises(Exception, match="three columns"):
        readers.manual_concord(spark, str(tmp_path / "m2.txt")).collect()
    (tmp_path / "c.txt").write_text('["A:1", "B:1"]\n')
    assert rows(readers.conflation(spark, str(tmp_path / "c.txt")), "clique", "pos", "curie") == [("A:1", 0, "A:1"), ("A:1", 1, "B:1")]
    (tmp_path / "r.tsv").write_text("T\tB\nT\tA\nU\tA\nT\tB\n")
    assert rows(readers.prefix_ranks(spark, str(tmp_path / "r.tsv")), "type", "prefix", "rank") == [("T", "A", 1), ("T", "B", 0), ("U", "A", 0)]
    (tmp_path / "t.tsv").write_text("T\tU\nU\tV\nT\tU\n")
    assert rows(readers.type_tree(spark, str(tmp_path / "t.tsv")), "type", "parent") == [("T", "U"), ("U", "V")]
    (tmp_path / "h.tsv").write_text("x\ty\n1\t2\n")
    assert readers.headed(spark, str(tmp_path / "h.tsv"), ["x", "y"]).count() == 1
    with pytest.raises(ValueError):
        readers.headed(spark, str(tmp_path / "h.tsv"), ["x"])
    (tmp_path / "s.sdf").write_text("head\n> <ChEBI ID>\nCHEBI:1\n\n> <Secondary ChEBI ID>\nCHEBI:8\nCHEBI:9\n\n$$$$\nhead\n> <ChEBI ID>\nCHEBI:2\n\n> <InChIKey>\nKEY\n\n$$$$\n")
    rec = parsers.sdf_records(readers.lines(spark, str(tmp_path / "s.sdf"), sep="$$$$"))
    pairs, props = parsers.chebi(rec, frame(spark, "id string, kind string, value string", ("1", "KEGG COMPOUND accession", "C1"), ("3", "KEGG COMPOUND accession", "C3"), ("3", "other", "z")))
    assert rows(pairs, "subject", "object") == [("CHEBI:2", "INCHIKEY:KEY"), ("CHEBI:3", "KEGG.COMPOUND:C3")]
    assert rows(props, "curie", "value") == [("CHEBI:1", "CHEBI:8"), ("CHEBI:1", "CHEBI:9")]


def test_md5_and_xml(spark, tmp_path):
    for n, ok in (("a", True), ("b", False)):
        body = gzip.compress(n.encode())
        (tmp_path / f"{n}.gz").write_bytes(body)
        (tmp_path / f"{n}.gz.md5").write_text(f"MD5({n}.gz)= {hashlib.md5(body if ok else b'').hexdigest()}\n")
    assert [p[0].split("/")[-1] for p in rows(readers.md5_mismatches(spark, str(tmp_path)), "path")] == ["b.gz"]
    (tmp_path / "x.xml").write_text("<set><m><accession>H1</accession><name>n</name><synonyms><synonym>a</synonym><synonym>b</synonym></synonyms></m></set>")
    x = readers.xml_rows(spark, str(tmp_path / "x.xml"), "m", "accession STRING, name STRING, synonyms STRUCT<synonym: ARRAY<STRING>>, smiles STRING").selectExpr("accession", "name", "synonyms.synonym AS synonyms", "smiles")
    assert rows(parsers.metabolites(x)[1], "curie", "synonym") == [("HMDB:H1", "a"), ("HMDB:H1", "b")]


def conso_line(cui, lat, aui, sab, tty, code, term, suppress="N"):
    return (0, "|".join([cui, lat, "", "", "", "", "", aui, "", "", "", sab, tty, code, term, "", suppress, ""]))


def test_umls(spark):
    c = parsers.conso(frame(spark, "seq long, value string", conso_line("C1", "ENG", "A1", "MSH", "MH", "D1", "One"), conso_line("C2", "GER", "A2", "MSH", "MH", "D2", "Zwei"), conso_line("C3", "ENG", "A3", "MSH", "MH", "D3", "x", "O"), conso_line("C4", "ENG", "A4", "MSH", "XX", "D4", "y"), conso_line("C5", "ENG", "A5", "GO", "PT", "GO:5", "123")))
    assert rows(c, "cui") == [("C1",), ("C4",), ("C5",)]
    assert rows(parsers.umls_concord(c, {"MSH": "MESH", "GO": "GO"}), "subject", "object") == [("UMLS:C1", "MESH:D1"), ("UMLS:C5", "GO:5")]
    labels, names = parsers.umls_labels(c, frame(spark, "sab string, tty string, priority int", ("MSH", "MH", 1)))
    assert ("UMLS:C1", "One") in rows(labels, "curie", "label") and "UMLS:C5" not in [r[0] for r in rows(names, "curie")]
    sty = frame(spark, "seq int, cui string, tree string", (1, "C1", "A"), (2, "C1", "B"), (3, "C2", "B"), (4, "C2", "X"), (5, "C3", "Z"))
    types = frame(spark, "tree string, type string", ("A", "ta"), ("B", "tb"))
    assert rows(parsers.umls_ids(sty, types, ("X",)), "curie", "type") == [("UMLS:C1", "ta")]
    rx = frame(spark, "rxcui string, sab string, tty string", ("1", "RXNORM", "IN"), ("2", "RXNORM", "MIN"), ("3", "RXNORM", "SCD"), ("4", "RXNORM", "DF"), ("5", "MSH", "IN"))
    assert [t for _, t in rows(parsers.rxnorm_ids(rx), "curie", "type")] == ["biolink:ChemicalEntity", "biolink:MolecularMixture", "biolink:Drug"]


def test_genes(spark):
    g = frame(spark, "tax_id string, gene_id string, symbol string, synonyms string, description string, authority_symbol string, authority_name string, other_designations string, gene_type string", ("9606", "1", "S", "a|b", "d", "-", "N", "-", "protein-coding"), ("9606", "2", "x", "-", "-", "-", "-", "-", "other"))
    t = parsers.gene_info(g)
    assert rows(t["labels"], "curie", "label") == [("NCBIGene:1", "S")]
    assert sorted(s for (s,) in rows(t["synonyms"], "synonym")) == ["N", "S", "a", "b"]
    e = frame(spark, "seq int, gene_id string, ensembl_gene string, ensembl_protein string", (1, "1", "ENSG1.2", "-"), (2, "1", "ENSG1.3", "-"), (3, "1", "ENSG2", "-"), (4, "9", "ENSG9", "-"), (5, "1", "-", "-"))
    assert rows(parsers.gene_to_ensembl(e, frame(spark, "curie string", ("NCBIGene:1",))), "object") == [("ENSEMBL:ENSG1",), ("ENSEMBL:ENSG2",)]
    m = frame(spark, "mim string, gene_id string, kind string, cui string", ("1", "2", "gene", "C1"), ("3", "4", "gene", "-"), ("5", "6", "phenotype", "C2"))
    assert rows(parsers.medgen(m), "object") == [("OMIM:1",), ("OMIM:3",), ("UMLS:C1",)]
    u = frame(spark, "id string, a string, b string", ("E1", "1", None), ("E2", "", "2"))
    assert rows(parsers.unpivot_ids(u, "id", {"a": "X", "b": "Y"}), "subject", "object") == [("ENSEMBL:E1", "X:1"), ("ENSEMBL:E2", "Y:2")]
    assert parsers.merge_batches("id", u.select("id", "a"), frame(spark, "id string, c int", ("E3", 1))).count() == 3
    f = parsers.fasta_labels(frame(spark, "seq int, value string", (1, ">sp|P1|N_H Some name OS=Homo"), (2, "MKV")))
    assert rows(f, "curie", "label") == [("UniProtKB:P1", "Some name")]
    h = frame(spark, "hgnc_id string, symbol string, name string, alias_symbol array<string>, alias_name array<string>", ("HGNC:1", "S", "n", ["a"], None))
    assert rows(parsers.hgnc(h)[1], "synonym") == [("a",), ("n",)]
    assert rows(parsers.omim_ids(frame(spark, "mim string, kind string", ("1", "gene"), ("2", "gene/phenotype")), "gene"), "curie") == [("OMIM:1",)]


def test_chemicals(spark):
    r = frame(spark, "id string, registry string", ("D1", "50-00-0"), ("D2", "EC 1.1"), ("D3", "0"), ("D4", "ABC12"), ("D5", "txid9606"))
    assert rows(parsers.registry_concord(r), "subject", "object") == [("MESH:D1", "CAS:50-00-0"), ("MESH:D4", "UNII:ABC12")]
    assert rows(parsers.registry_taxa(r), "object") == [("NCBITaxon:9606",)]
    p = frame(spark, "seq int, cid string, name string", (1, "1", "none"), (2, "1", "b"), (3, "1", "a"), (4, "2", "m"))
    assert rows(parsers.pubchem_mesh(p, frame(spark, "curie string, label string", ("MESH:D1", "a"), ("MESH:C2", "b"), ("MESH:M3", "m"))), "subject", "object") == [("PUBCHEM.COMPOUND:1", "MESH:C2")]
    g = parsers.gtopdb(frame(spark, "id string, name string, synonyms string, inchikey string", ("1", "<i>&alpha;</i>-x", "", "K"), ("2", "y", "", "")))
    assert rows(g[0], "label") == [("y",), ("α-x",)] and rows(g[1], "object") == [("INCHIKEY:K",)]
    ids = frame(spark, "curie string", ("A:1",), ("A:2",), ("A:3",))
    smi = frame(spark, "curie string, smiles string", ("A:1", "C.C"), ("A:2", "C.C"))
    assert rows(parsers.typed_by_flags(ids, [(frame(spark, "curie string", ("A:1",)), "peptide")], smi), "type") == [("biolink:ChemicalEntity",), ("biolink:MolecularMixture",), ("peptide",)]
    u = frame(spark, "unii string, smiles string, taxon string", ("1", "C", ""), ("2", "", "9606"), ("3", "", None))
    assert rows(parsers.unii_ids(u, ("taxon",)), "curie") == [("UNII:1",), ("UNII:3",)]


def test_other_sources(spark):
    b = parsers.broken_csv_names(frame(spark, "seq int, value string", (1, 'P1,Name, with commas,"tail, x"'), (2, "P2,Plain")))
    assert rows(b, "id", "name") == [("P1", "Name, with commas"), ("P2", "Plain")]
    tree = json.dumps([{"stId": "R1", "name": "a", "type": "P", "children": [{"stId": "R2", "name": "b", "type": "Q", "children": [{"stId": "R3", "type": "Z"}]}]}])
    assert rows(parsers.pathway_tree(frame(spark, "value string", (tree,), (None,)), {"P": "p", "Q": "q"}), "curie", "type") == [("REACT:R1", "p"), ("REACT:R2", "q")]
    n = frame(spark, "id string, lbl string, deprecated boolean, xrefs array<string>", ("http://x/DOID_1", "l", None, ["umls:1", "bad"]), ("http://x/DOID_2", "m", True, []))
    labels, pairs = parsers.graph_json(n, {"UMLS": "UMLS"})
    assert rows(labels, "curie") == [("DOID:1",)] and rows(pairs, "object") == [("UMLS:1",)]
    a = frame(spark, "file_seq int, pos int, pmid string, title string, doi string, pmc string, status string", (0, 1, "1", "old", "d1", None, "s1"), (1, 1, "1", "new", None, "PMC1", "s2"))
    t = parsers.articles(a)
    assert rows(t["titles"], "label") == [("new",)] and rows(t["concord"], "object") == [("PMC:PMC1",), ("doi:d1",)] and t["statuses"].count() == 2
    k = parsers.flat_file(frame(spark, "seq int, value string", (1, "ENTRY       C1   Peptide\nNAME        one;\n            two\nSEQUENCE    Ala Arg\n            Gly\n"), (2, "x")))
    assert [(r["id"], r["names"], r["sequence"]) for r in k.collect()] == [("C1", ["one", "two"], "ARG")]
    x = frame(spark, "seq int, tax_id string, name string, kind string", (1, "1", "sci", "scientific name"), (2, "1", "com", "genbank common name"), (3, "2", "only", "synonym"))
    assert rows(parsers.taxonomy(x)[0], "label") == [("only",), ("sci (com)",)]


def test_sinks(spark, tmp_path):
    rec = spark.read.schema("filename STRING, " + sinks.COMPENDIUM_SCHEMA).json(spark.sparkContext.parallelize(['{"filename": "F", "type": "t", "ic": 5.5, "identifiers": [{"i": "A:1", "l": "X", "d": ["d"]}, {"i": "B:1", "l": ""}], "preferred_name": "X"}', '{"filename": "F", "type": "t", "identifiers": []}']))
    tables = sinks.clique_tables(rec)
    sinks.write_tables(tables, str(tmp_path / "out"))
    back = {n: spark.read.parquet(str(tmp_path / "out" / n)) for n in tables}
    assert rows(back["Clique"], "clique_leader", "clique_identifier_count", "filename") == [("A:1", 2, "F")]
    assert rows(back["Edge"], "clique_leader", "curie", "conflation") == [("A:1", "A:1", "None"), ("A:1", "B:1", "None")]
    assert rows(back["Node"], "curie", "label_lc") == [("A:1", "x"), ("B:1", "")]
    with pytest.raises(Exception):
        sinks.write_tables(tables, str(tmp_path / "out"))
    m = frame(spark, "clique int, pos int, curie string", (1, 0, "A"), (1, 1, "B"), (1, 2, "C"))
    assert rows(sinks.same_as_edges(m, "f"), "subject", "object") == [("A", "B"), ("A", "C"), ("B", "C")]
    d = frame(spark, "curie string, type string, preferred_name string, names array<string>", ("A", "t", "N", ["x||y", "X|Y", "z"]), ("B", "t", "N", ["One", "ONE"]), ("C", "t", "", ["q"]), ("D", "t", "N", [str(i) for i in range(40)]), ("E", "t", "N", []))
    got = sinks.training_pairs(d)
    assert ("A", "t||A||n||x|y||z") in rows(got, "curie", "line") and ("B", "t||B||n||one||one") in rows(got, "curie", "line")
    assert got.where("curie = 'D'").count() == 50 and got.where("curie IN ('C', 'E')").count() == 0
    sinks.write_json_lines(d, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 5
    sinks.gzip_text(d.select("curie"), str(tmp_path / "g"))
    assert spark.read.text(str(tmp_path / "g")).count() == 5


def test_domains(spark):
    sty = frame(spark, "seq int, cui string, tree string", (1, "C1", "A1.2.3.3"), (2, "C2", "A1.4.1.2"), (3, "C2", "A1.4.1.1.3.3"), (4, "C3", "A1.3.3"), (5, "C4", "Z"))
    assert rows(domains.umls_ids(sty, "anatomy"), "curie", "type") == [("UMLS:C1", "biolink:Cell")]
    assert rows(domains.umls_ids(sty, "chemicals"), "curie", "type") == [("UMLS:C3", "biolink:Drug")]
    tree = frame(spark, "id string, number string", ("D1", "A11.284.1"), ("D2", "A11.5"), ("D3", "A01.1"), ("D4", "A01.9"), ("D4", "A02.1"), ("D5", "X1"), ("D6", "A110"))
    got = rows(domains.mesh_ids(tree, "anatomy", excluded=("A02",)), "curie", "type")
    assert got == [("MESH:D1", "biolink:CellularComponent"), ("MESH:D2", "biolink:Cell"), ("MESH:D3", "biolink:AnatomicalEntity")]
    m = frame(spark, "clique int, curie string", (1, "HP:1"), (1, "MONDO:1"), (2, "X:1"))
    t = frame(spark, "curie string, type string", ("HP:1", "biolink:PhenotypicFeature"), ("MONDO:1", "biolink:Disease"), ("X:1", "biolink:PhenotypicFeature"))
    assert rows(domains.typed(m, t, "disease"), "clique", "type") == [(1, "biolink:Disease"), (2, "biolink:PhenotypicFeature")]


def test_export_reads_every_shape(spark, tmp_path):
    lines = [
        '{"type": "biolink:Gene", "ic": "5.5", "identifiers": [{"i": "A:1", "l": "X", "d": ["d"]}, {"i": "B:1"}], "preferred_name": "X"}',
        '{"id": {"identifier": "C:1", "label": "Y"}, "equivalent_identifiers": [{"identifier": "C:1", "label": "Y"}, {"identifier": "D:1"}], "type": ["biolink:Drug", "biolink:Cell"]}',
        '{"type": null, "ic": {"a": 1}, "identifiers": "[{\\"i\\": \\"E:1\\", \\"l\\": \\"Z\\"}, \\"F:1\\"]"}',
        '{"identifiers": {"i": "G:1", "d": "one"}}',
        '{"identifiers": ["H:1", null, {"i": "I:1"}]}',
        '{"preferred_name": "J", "preferred_name": "K", "identifiers": "J:1"}',
        '{"identifiers": []}',
        '{"identifiers": null}',
    ]
    frame(spark, "line_id long, filename string, raw_line string", *[(i, "F", x) for i, x in enumerate(lines)]).write.parquet(str(tmp_path / "compendium_jsonl.parquet"))
    tables = reference_queries._exported(spark, str(tmp_path))
    cols = ("clique_leader", "preferred_name", "clique_identifier_count", "biolink_type", "information_content")
    want = [("A:1", "X", 2, "biolink:Gene", 5.5), ("C:1", "Y", 2, "biolink:Drug", None), ("E:1", None, 2, None, None), ("G:1", None, 1, None, None), ("H:1", None, 2, None, None), ("J:1", "K", 1, None, None)]
    assert rows(tables["Clique"], *cols) == want
    edges = [("A:1", "A:1"), ("A:1", "B:1"), ("C:1", "C:1"), ("C:1", "D:1"), ("E:1", "E:1"), ("E:1", "F:1"), ("G:1", "G:1"), ("H:1", "H:1"), ("H:1", "I:1"), ("J:1", "J:1")]
    assert rows(tables["Edge"], "clique_leader", "curie") == edges
    assert [tuple(r) for r in tables["Node"].where("description IS NOT NULL").select("curie", "description").orderBy("curie").collect()] == [("A:1", ["d"]), ("G:1", ["one"])]
