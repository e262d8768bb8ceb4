"""The update stream equals one batch over all files."""

import json

from tessellon.streaming import updates


def test_stream_is_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rows = [(0, 1, "1", "old", "a"), (0, 2, "2", None, None), (1, 1, "1", "new", "b"), (2, 1, "1", None, "a"), (2, 2, None, "x", "x"), (2, 3, "3", "t", None)]
    for f in range(3):
        (src / f"{f}.json").write_text("\n".join(json.dumps(dict(zip(("file_seq", "pos", "pmid", "title", "status"), r))) for r in rows if r[0] == f))
    q = updates.start(updates.read_updates(spark, str(src), 1), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = {r["pmid"]: (r["title"], r["statuses"]) for r in updates.titles(updates.table(spark, str(tmp_path / "out"))).collect()}
    assert got == {"1": ("new", ["a", "b"]), "2": (None, []), "3": ("t", [])}
    whole = updates.titles(updates.merge(None, spark.createDataFrame(rows, updates.SCHEMA)))
    assert {r["pmid"]: (r["title"], r["statuses"]) for r in whole.collect()} == got


def test_batches_touch_their_buckets_only(spark, tmp_path):
    out = f"file://{tmp_path}/t"
    mk = lambda rows: spark.createDataFrame(rows, updates.SCHEMA)
    updates.upsert(spark, out, mk([(0, i, str(i), f"t{i}", "a") for i in range(400)]), 0, "s")
    first = updates._manifest(spark, out)["at"]
    updates.upsert(spark, out, mk([(1, 0, "7", "new", "b")]), 1, "s")
    second = updates._manifest(spark, out)["at"]
    assert sum(first[b] != second[b] for b in second) == 1
    updates.upsert(spark, out, mk([(2, 0, "7", "again", "c")]), 1, "s")  # the same batch once more
    updates.upsert(spark, out, mk([(3, 0, "7", None, "d"), (3, 1, None, "x", "x")]), 0, "another stream, from its start")
    updates.upsert(spark, out, mk([]), 2, "s")
    got = {r["pmid"]: (r["title"], r["statuses"]) for r in updates.titles(updates.table(spark, out)).collect()}
    assert len(got) == 400 and got["7"] == ("new", ["a", "b", "d"]) and got["8"] == ("t8", ["a"])


def test_scratch_is_removed(spark):
    from tessellon import files
    from tessellon.session import Scratch

    with Scratch(spark, "gone") as scratch:
        assert scratch.write(spark.range(3), "t").count() == 3 and files.exists(spark, scratch.root)
    assert not files.exists(spark, scratch.root)
