"""Nested records, bad rows, snapshots, skewed keys and orphans on small fixtures with all the dirt."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessellon.functions import curie
from tessellon.functions.curie import plain_curie, plain_value
from tessellon.operators import badrows, nested, orphans, reports, skew, snapshots
from tessellon.plans.data_queries import NUMERIC


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_curies(spark):
    df = spark.createDataFrame([("\u00a0chebi:1\t",), ("CHEBI_1",), ("a:b:c",), (None,), ("  ",), ("\u3000Mesh:x",)], "c string")
    got = [tuple(r) for r in df.select(plain_curie("c"), plain_value("c")).collect()]
    assert got == [("CHEBI:1", "CHEBI:1"), (None, "CHEBI_1"), ("A:b:c", "A:b:c"), (None, None), (None, None), ("MESH:x", "MESH:x")]


def test_curie_forms(spark):
    df = spark.createDataFrame([("msh:D1 (x)",), ("http://x.org/obo/CL_1",), ("https://id.org/mesh/D2",), ("plain",), (None,), ("EC:",), ("a:2",), ("a:10",)], "c string")
    stems = {"https://id.org/mesh/": "MESH", "https://id.org/": "X"}
    got = [tuple(r) for r in df.select(curie.normal_xref("c", {"MSH": "MESH"}), curie.iri_to_curie("c", stems), curie.recurie("c", {"msh": "MESH"})).collect()]
    assert got == [
        ("MESH:D1", "msh:D1 (x)", "MESH:D1 (x)"), ("http://x.org/obo/CL_1", "CL:1", "http://x.org/obo/CL_1"), ("https://id.org/mesh/D2", "MESH:D2", "https://id.org/mesh/D2"), (None, None, "plain"), (None, None, None),
        (None, "EC:", "EC:"), ("a:2", "a:2", "a:2"), ("a:10", "a:10", "a:10"),
    ]
    assert [r["c"] for r in df.where("c LIKE 'a:%' OR c LIKE 'EC%'").orderBy(*curie.suffix_order("c")).collect()] == ["a:2", "a:10", "EC:"]
    assert [r["c"] for r in curie.once(df).where("c = 'plain'").collect()] == ["plain"]


# --- nested ----------------------------------------------------------------------------------------
def test_recursive_elements_to_any_depth(spark):
    graph = nested.SchemaGraph("record", [nested.Edge("record", "part", "part", True), nested.Edge("part", "part", "part", True), nested.Edge("part", "n", "n")])
    deep, line = 35, "{}"
    for n in reversed(range(deep)):
        line = f'{{"n": {n}, "part": [{line}]}}' if n < deep - 1 else f'{{"n": {n}}}'
    df = spark.createDataFrame([(1, f'{{"part": [{line}]}}'), (2, '{"part": {"n": 0}, "part": {"n": 1}}')], "k int, j string")
    assert rows(nested.shred(df, "k", "j", graph)["part"], "k", "n") == sorted([*((1, str(n)) for n in range(deep)), (2, "1")], key=repr)
    counters = spark.createDataFrame([('{"a":' * 20 + "7" + "}" * 20,)], "j string")
    assert rows(reports.flatten_counters(counters, "j"), "path", "n") == [(".".join("a" * 20), 7)]


def test_schema_graph():
    g = nested.COMPENDIUM
    assert g.tables() == ["record", "type", "taxon", "description", "identifier"]
    assert ("$.id.identifier", "id_identifier") in g.inlined("record") and ("$.l", "l") in g.inlined("identifier")
    tree = nested.SchemaGraph("a", [nested.Edge("a", "one", "b"), nested.Edge("b", "again", "b"), nested.Edge("b", "x", "c")])
    assert tree.recursive() == {"b"} and tree.tables() == ["a", "b"]


def test_shred(spark):
    long_text = "x" * 200_000
    data = [
        (1, '{"type": "T", "ic": "2.9e+01", "identifiers": [{"i": "A:1", "l": "x", "d": ["p", null, "q"], "t": "N:1"}, null, "B:2"], "taxa": [null, "N:2"]}', "k"),
        (2, '{"identifiers": "[{\\"i\\": \\"C:1\\"}, \\"C:2\\"]", "ic": {"value": null}, "type": null}', "k"),
        (3, '{"id": {"identifier": "D:1", "label": "l"}, "equivalent_identifiers": {"identifier": "D:1"}, "type": ["T", "U"]}', None),
        (4, None, None), (5, "not json", None), (6, "{}", None), (7, '{"identifiers": "plain:text", "descriptions": "' + long_text + '"}', None), (6, "{}", None),
    ]
    t = nested.shred(spark.createDataFrame(data, "line_id long, raw_line string, pos string"), "line_id", "raw_line", nested.COMPENDIUM)
    assert rows(t["identifier"], "line_id", "pos", "i", "value") == sorted([(1, 0, "A:1", None), (1, 2, None, "B:2"), (2, 0, "C:1", None), (2, 1, None, "C:2"), (3, 0, None, None), (7, 0, None, "plain:text")], key=repr)
    assert rows(t["description"].where("parent_kind = 'identifier'"), "line_id", "parent_pos", "pos", "value") == [(1, 0, 0, "p"), (1, 0, 2, "q")]
    assert rows(t["taxon"], "line_id", "parent_kind", "parent_pos", "pos", "value") == [(1, "identifier", 0, 0, "N:1"), (1, "record", -1, 1, "N:2")]
    assert rows(t["type"], "line_id", "pos", "value") == [(1, 0, "T"), (3, 0, "T"), (3, 1, "U")]
    rec = {r["line_id"]: r for r in t["record"].collect()}
    assert set(rec) == {1, 2, 3, 6, 7} and rec[3]["id_label"] == "l"
    assert [r["line_id"] for r in t["record"].where(F.col("ic").rlike(NUMERIC)).collect()] == [1]
    assert t["description"].where("line_id = 7").first()["value"] == long_text


@pytest.mark.parametrize("written", [False, True])
def test_rows_name_their_parents(spark, scratch, written):
    """Both identifier arrays of a line hold a place 0; the description of each names its own parent."""
    line = '{"identifiers": [{"i": "A:1", "d": "a"}], "equivalent_identifiers": [{"identifier": "B:1", "d": ["b", "c"]}]}'
    t = nested.shred(spark.createDataFrame([(1, line)], "line_id long, raw_line string"), "line_id", "raw_line", nested.COMPENDIUM, scratch if written else None)
    members = t["identifier"].select("row_id", F.coalesce("i", "identifier").alias("curie"))
    got = t["description"].join(members, t["description"]["parent_id"] == members["row_id"]).select("curie", "value")
    assert rows(got, "curie", "value") == [("A:1", "a"), ("B:1", "b"), ("B:1", "c")]
    assert rows(t["identifier"], "parent_id", "pos") == [("", 0), ("", 0)]


def test_records_in_records(spark):
    g = nested.SchemaGraph("a", [nested.Edge("a", "kids", "a", True, "kid"), nested.Edge("a", "name", "name")])
    df = spark.createDataFrame([(1, '{"name": "x", "kids": [{"name": "y", "kids": [null, {"name": "z"}]}, {"name": "w"}]}')], "k int, j string")
    t = nested.shred(df, "k", "j", g)["a"].collect()
    name = {r["row_id"]: r["name"] for r in t}
    assert sorted((r["name"], r["pos"], name.get(r["parent_id"])) for r in t) == [("w", 1, "x"), ("x", -1, None), ("y", 0, "x"), ("z", 1, "y")]


def test_shred_recursive_and_empty(spark):
    g = nested.SchemaGraph("a", [nested.Edge("a", "kids", "n", True, "n"), nested.Edge("n", "kids", "n", True, "n"), nested.Edge("n", "name", "name")])
    df = spark.createDataFrame([(1, '{"kids": [{"name": "x", "kids": [{"name": "y", "kids": [{"name": "z"}]}]}]}')], "k int, j string")
    assert rows(nested.shred(df, "k", "j", g)["n"], "parent_kind", "pos", "name") == [("a", 0, "x"), ("n", 0, "y"), ("n", 0, "z")]
    assert nested.shred(df.limit(0), "k", "j", g)["n"].count() == 0


# --- bad rows --------------------------------------------------------------------------------------
KNOWN = [("synonyms", "p"), ("drugchemical", "q")]
CASES = [
    ("synonyms/A", "A:1\tp\tname", None), ("synonyms/A", "A:1\tp\tname\r\r", None), ("synonyms/A", "", ()), ("synonyms/A", " \t ", ()), ("synonyms/A", "# A:1", ()), ("synonyms/A", None, ()),
    ("synonyms/A", 'A:1\tp\t"two\tparts\nand ""quotes"""', None), ("synonyms/A", 'A:1\tp\tmid "quote" here', None), ("synonyms/A", 'A:1\tp\t"open', "quoting"), ("synonyms/A", 'A:1\tp\t"shut" x', "quoting"),
    ("synonyms/A", 'A:1\tp\t"a\\"b"', "quoting"), ("synonyms/A", 'A:1\t"p', "quoting"), ("synonyms/A", "A:1\tp", "column_count"), ("synonyms/A", "A:1\tp\tx\t", "column_count"), ("synonyms/A", '"A:1"\t"p"', "column_count"),
    ("synonyms/A", "A 1:2\tp\tx", "invalid_value"), ("synonyms/A", "A1\tp\tx", "invalid_value"), ("synonyms/A", ":1\tp\tx", "invalid_value"), ("synonyms/A", "A:\tp\tx", "invalid_value"), ("synonyms/A", "A:1:2\tp\tx", None), ("synonyms/A", "A:1\tP\tx", "invalid_value"),
    ("synonyms/A", "A:1\tp\t--", "invalid_value"), ("synonyms/A", "A:1\tp\t\ufffd x", "invalid_value"), ("synonyms/A", "A:1\tp\tx\x07", "invalid_value"), ("synonyms/A", "A:1\tp\tx\ny", None), ("synonyms/A", "A:1\tp\t\u0416", None), ("synonyms/A", "A:1\tp\t\u0663", None), ("synonyms/A", 'A:1\tp\t""', "invalid_value"),
    ("drugchemical.tsv", "A:1\tq\tB:2\t\t", None), ("drugchemical.tsv", "A:1\tq\tB:2\tnote\thttp://x", None), ("drugchemical.tsv", "A:1\tq\tB:2\t\thttp://x y", "invalid_value"), ("drugchemical.tsv", "A:1\tq\tB:2\t\tftp://x", "invalid_value"),
    ("drugchemical.tsv", "A:1\tp\tB:2\t\t", "invalid_value"), ("drugchemical.tsv", "A:1\tq\tB2\t\t", "invalid_value"), ("drugchemical.tsv", "A:1\tq\tB:2\t", "column_count"), ("drugchemical.tsv", 'A:1\tq\tB:2\t""\t""', None), ("other", "x", "unknown_file"),
]


def test_bad_rows(spark):
    df = spark.createDataFrame([(i, f, r, "extra") for i, (f, r, _) in enumerate(CASES)], "line_id long, filename string, raw_line string, reason string")
    parsed = badrows.parse_lines(df, spark.createDataFrame(KNOWN, "filename string, predicate string")).cache()
    got = {r["line_id"]: r["reason"] for r in parsed.collect()}
    want = {i: w for i, (_, _, w) in enumerate(CASES) if w != ()}
    assert got == want
    assert badrows.valid_rows(parsed, badrows.SYNONYMS).where("line_id = 6").first()["synonym"] == 'two\tparts\nand "quotes"'
    empty = badrows.parse_lines(df.limit(0), spark.createDataFrame([], "filename string, predicate string"))
    assert empty.count() == 0


ANY3 = ("any",) * 3


def strict(line):
    """Fields of a line by the rules of TESTDATA, read one after the other; None where quotes are broken."""
    fields, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            j, text = i + 1, ""
            while True:
                k = line.find('"', j)
                if k < 0:
                    return None
                text += line[j:k]
                if line[k + 1 : k + 2] != '"':
                    break
                text, j = text + '"', k + 2
            i = k + 1
            if i < len(line) and line[i] != "\t":
                return None
            fields.append(text)
        else:
            j = line.find("\t", i)
            j = len(line) if j < 0 else j
            fields.append(line[i:j])
            i = j
        if i >= len(line):
            return fields
        i += 1


def test_error_parse():
    assert badrows.error_parse('A:1\tp\t"open', ANY3)[1:] in (("quoting", ["delete quote at 6"]), ("quoting", ["insert quote at 11"]))
    assert badrows.error_parse("A:1\tp", ANY3) == (None, "column_count", ["append column"])
    assert badrows.error_parse("a\tb\tc\td\te", ANY3) == (None, "column_count", ["drop column"] * 2)
    assert badrows.error_parse('"' + "x" * 500_000 + '""' * 1000 + '"\ty', ("any", "any"))[0][1] == "y"
    assert len(badrows.error_parse('"' * 301, ANY3)[2]) >= 1
    # of two repairs with one edit each, the types choose: the quote goes and the tab stays
    assert badrows.error_parse('"A:1\tx', ("curie", "text")) == (None, "quoting", ["delete quote at 0"])
    assert badrows.error_parse('"A:1\tx', ("text",)) == (None, "quoting", ["insert quote at 6"])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='a"\t', max_size=9), st.integers(1, 4))
def test_reason_of_the_parse(line, n):
    """The reason equals the strict reading's, and no line with fewer edits inside reads."""
    fields, reason, edits = badrows.error_parse(line, ("any",) * n)
    want = strict(line)
    assert reason == ("quoting" if want is None else "column_count" if len(want) != n else None)
    assert fields == (want if reason is None else None)
    inside = [e for e in edits if e.split()[0] in ("insert", "delete")]
    seen, level, best = {line}, {line}, 0
    while not any(strict(x) is not None for x in level):
        nxt = set()
        for x in level:
            nxt |= {x[:i] + x[i + 1 :] for i, c in enumerate(x) if c in '"\t'}
            nxt |= {x[:i] + c + x[i:] for i in range(len(x) + 1) for c in '"\t'}
        level, best = nxt - seen, best + 1
        seen |= nxt
    assert len(inside) == best


# --- snapshots -------------------------------------------------------------------------------------
def test_whole_numbers(spark):
    texts = ["007", " 7 ", "7.0", "7e0", "1,007", "NA", "", None, "n/a", "7.6756e4", "99999999999999999999"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(snapshots.whole_number("t")).collect()]
    assert [None if x is None else int(x) for x in got] == [7, 7, 7, 7, 1007, None, None, None, None, 76756, 99999999999999999999]


CHANGED = [("a", "w", "added", None, 5), ("a", "x", "changed", 1, 2), ("a", "z", "removed", 3, None), ("b", "w", "removed", 5, None), ("b", "x", "removed", 2, None), ("b", "y", "removed", None, None)]
SNAPSHOTS = {"a": [("x", 1, "q"), ("y", None, "q"), ("z", 3, None), (None, 9, None)], "b": [("x", 2, None), ("y", None, None), ("w", 5, None)], "c": []}


def test_changes(spark, scratch):
    df = spark.createDataFrame([(t, *r) for t, rs in SNAPSHOTS.items() for r in rs] + [("other", "x", 7, None), (None, "x", 8, None)], "t string, k string, v int, change_kind string")
    got = rows(snapshots.changes(df, "t", ["a", "b", "c"], "k", ["v"], scratch), "from_release", "k", "change_kind", "old_v", "new_v")
    assert got == sorted(CHANGED, key=repr)
    with pytest.raises(ValueError):
        snapshots.changes(df, "t", ["a"], "k", ["v"], scratch)
    plan = snapshots.changes(df, "t", ["a", "b"], "k", ["v"], scratch, fetch=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan  # the index is bucketed


def test_index_is_kept_between_deliveries(spark, tmp_path):
    root, got = f"file://{tmp_path}/feed", []
    for tag, rs in SNAPSHOTS.items():
        index = snapshots.SnapshotIndex(spark, root, "k", ["v"])  # a session of its own
        diff = index.deliver(tag, spark.createDataFrame(rs, "k string, v int, x string"))
        if diff is not None:
            assert "Exchange hashpartitioning" not in diff._jdf.queryExecution().executedPlan().toString()
            got += rows(diff, "from_release", "k", "change_kind", "old_v", "new_v")
    assert sorted(got, key=repr) == sorted(CHANGED, key=repr)
    assert sorted(p.name for p in (tmp_path / "feed").iterdir() if p.name.startswith("v")) == ["v1", "v2"]


def test_latest(spark):
    df = spark.createDataFrame([("k", 1, 5), ("k", 2, None), ("k", 2, 7), ("j", None, 1)], "k string, t int, v int")
    assert rows(snapshots.latest(df, ["k"], ["t", "v"]), "k", "t", "v") == [("j", None, 1), ("k", 2, 7)]


# --- skew ------------------------------------------------------------------------------------------
def test_pack_bounds():
    plan = skew.pack([10] * 160, {"hot": 5000, "warm": 400}, 10)
    fair = (1600 + 5400) / 10
    assert len(plan.heavy["hot"]) == 8 and max(plan.loads) <= 1.5 * fair


@pytest.mark.parametrize("seed", [1, 2])
def test_distinct_per_key(spark, seed):
    r = random.Random(seed)
    data = [(r.choice(["hot"] * 6 + [f"k{i}" for i in range(30)] + [None]), r.choice([None] + [str(i) for i in range(200)]), 1) for _ in range(5000)]
    want = defaultdict(set)
    for k, m, _ in data:
        if k is not None and m is not None:
            want[k].add(m)
    df = spark.createDataFrame(data, "k string, m string, _task int")
    assert dict(rows(skew.distinct_per_key(df, "k", "m", 6), "k", "n")) == {k: len(v) for k, v in want.items()}
    assert skew.distinct_per_key(df.limit(0), "k", "m", 6).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_balanced(spark, how):
    left = [(i, "hot" if i % 3 else f"k{i % 7}") for i in range(600)] + [(1000, None), (1, "hot"), (1, "hot")]
    right = [("hot", "a"), ("hot", "b"), ("k3", "c"), (None, "d"), ("unused", "e")]
    a, b = spark.createDataFrame(left, "i int, k string"), spark.createDataFrame(right, "k string, v string")
    got = rows(skew.join_balanced(a, b, "k", "k", ["i"], 5, how), "i", "k", "v")
    assert got == rows(a.join(b, "k", how), "i", "k", "v")
    plan = skew.plan_by_load(a, "k", 5)
    assert len(plan.heavy["hot"]) > 1
    used = plan.fragment(a, "k", ["i"]).where("k = 'hot'").select("_task").distinct().count()
    assert used == len(set(plan.heavy["hot"]))
    assert plan.replicate(b, "k").where("k = 'unused'").count() == 1


# --- orphans ---------------------------------------------------------------------------------------
def _t(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("chunk", [200_000, 40])
def test_orphans(spark, scratch, chunk):
    r = random.Random(chunk)
    keys = ["hot"] * 12 + [f"k{i}" for i in range(12)]
    refs = [(r.choice(keys + ["gone", None]), r.choice([None] + list(range(60))), i, "x") for i in range(900)]
    parents = [(r.choice(keys + [None]), r.choice([None] + list(range(60))), r.choice([None] + list(range(60)))) for _ in range(150)]
    parents = [p for p in parents if p[0] != "k3"] + [("k5", None, None)]
    want = []
    for k, t, i, _ in refs:
        own = [p for p in parents if k is not None and p[0] == k]
        if any(s is not None and t is not None and s <= t and (e is None or e > t) for _, s, e in own):
            continue
        late = t is not None and any(s is not None and s > t for _, s, _ in own)
        want.append((i, "missing" if not own else "late" if late else "deleted"))
    a = spark.createDataFrame([(k, _t(t), i, x) for k, t, i, x in refs], "_key string, _ts timestamp_ntz, i int, extra string")
    b = spark.createDataFrame([(k, _t(s), _t(e)) for k, s, e in parents], "_key string, _start timestamp_ntz, _end timestamp_ntz")
    assert rows(orphans.orphans(a, b, scratch, chunk), "i", "orphan_state") == sorted(want, key=repr)
    if chunk < 100:
        assert orphans._cuts(a.select("_key", "_ts"), scratch, chunk) is not None
    assert orphans.orphans(a.limit(0), b, scratch, chunk).count() == 0
    assert {x["orphan_state"] for x in orphans.orphans(a, b.limit(0), scratch, chunk).collect()} == {"missing"}




def test_orphans_of_one_time(spark, scratch):
    """A key whose references all have one time is parted all the same, and more chunks than 64 are made where needed."""
    refs = [("hot", _t(5), i) for i in range(4000)] + [("even", _t(i % 1000), 10_000 + i) for i in range(4000)]
    parents = [("hot", _t(1), _t(4)), ("hot", _t(5), _t(6)), ("even", _t(0), _t(500))]
    a = spark.createDataFrame(refs, "_key string, _ts timestamp_ntz, i int")
    b = spark.createDataFrame(parents, "_key string, _start timestamp_ntz, _end timestamp_ntz")
    assert rows(orphans.orphans(a, b, scratch, 40), "i", "orphan_state") == sorted([(10_000 + i, "deleted") for i in range(4000) if i % 1000 >= 500], key=repr)
    assert {x["_key"]: len(x["_cuts"]) for x in orphans._cuts(a.select("_key", "_ts"), scratch, 40).collect()}["even"] > 64
    assert rows(orphans.orphans(a, b.where("_end = timestamp_ntz '2024-01-05 00:00:00'"), scratch, 40).where("i < 10000").groupBy("orphan_state").count(), "orphan_state", "count") == [("deleted", 4000)]
