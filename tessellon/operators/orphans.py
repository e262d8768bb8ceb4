"""References to parents that are missing, deleted or late, by a merge of two sorted streams.

References and parents are co-partitioned by key and sorted by (key, time); one running maximum of the
parents' ends over the sorted stream tells whether a parent covers a reference. A key with many rows is
cut along time into chunks of bounded load; each chunk starts from a header that carries the summary of
the chunks before it, so no key is ever one task's work. Where very many references of a key have the same
time, their chunk is parted again by a hash of the reference, and the parents of that time go to every part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessellon.functions.curie import once
from tessellon.session import Scratch

#: Rows of one key that stay in one piece.
CHUNK_ROWS = 200_000
#: Parts that references without a key are spread over.
_KEYLESS = 65_536
_GROUPS = 65_536
_FOREVER = "9999-12-31 23:59:59.999999"


def _cuts(stream: DataFrame, scratch: Scratch, chunk_rows: int) -> DataFrame | None:
    """_key and the times at which to cut it, of each key with over ``chunk_rows`` rows; None where there is none.

    Sums over a fixed number of hashed groups of keys rule most inputs out before any key is counted. There are
    as many cuts as the rows need; the table grows with the rows (one cut in ``chunk_rows``) and is joined as any other.
    """
    keys = stream.where("_key IS NOT NULL").select("_key", "_ts")
    groups = keys.groupBy(F.pmod(F.xxhash64("_key"), F.lit(_GROUPS)).alias("_g")).agg(F.count("*").alias("n"))
    if (groups.agg(F.max("n")).first()[0] or 0) <= chunk_rows:
        return None
    hot = scratch.write(keys.groupBy("_key").agg(F.count("*").alias("n")).where(F.col("n") > chunk_rows), "hot")
    most = hot.agg(F.max("n")).first()[0]
    if most is None:
        return None
    parts = -(-most // chunk_rows)
    own = F.ceil(F.first("n") / chunk_rows)
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), "_ts")
    every = F.percentile_approx(micros, [i / parts for i in range(1, parts)] or [0.5], max(10_000, 4 * parts))
    cuts = keys.join(hot, "_key").groupBy("_key").agg(every.alias("q"), own.alias("own"))
    mine = F.array_sort(F.array_distinct(F.filter("q", lambda x, i: F.pmod((i + 1) * F.col("own"), F.lit(parts)) < F.col("own"))))
    times = F.transform(F.coalesce(mine, F.array().cast("array<bigint>")), lambda x: F.timestamp_add("MICROSECOND", x, F.lit("1970-01-01").cast("timestamp_ntz")))
    return scratch.write(cuts.select("_key", times.alias("_cuts")), "cuts")


def orphans(refs: DataFrame, parents: DataFrame, scratch: Scratch, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``refs``: _key, _ts and payload columns; ``parents``: _key, _start, _end (timestamp_ntz).

    Returns the payload of each reference no parent covers at _ts, i.e. none with _start <= _ts and _end
    null or later, with orphan_state: ``missing`` (key never listed, or null), ``late`` (some parent starts
    after _ts), else ``deleted``. A null _ts is never covered and never late. A parent with a null _start
    lists its key but covers nothing. Empty parents make all references missing.
    """
    payload = [c for c in refs.columns if c not in ("_key", "_ts")]
    none = lambda t: F.lit(None).cast(t)
    end = F.coalesce("_end", F.lit(_FOREVER).cast("timestamp_ntz")).alias("_end")
    p = once(parents.select("_key", F.col("_start").alias("_ts"), end)).where("_key IS NOT NULL")
    r = once(refs.select("_key", "_ts", *payload))
    empty = [none(refs.schema[c].dataType).alias(c) for c in payload]
    own = [F.col(c) for c in payload]
    # _kind 0: header, 1: parent, 2: reference; at equal times in this order
    rows = lambda df, kind, e, last, listed, values: df.select("_key", "_ts", F.lit(kind).alias("_kind"), e.alias("_end"), last.alias("_last"), listed.alias("_listed"), *values)
    stream = rows(p.where("_ts IS NOT NULL"), 1, F.col("_end"), none("timestamp_ntz"), F.lit(True), empty)
    stream = stream.unionByName(rows(r, 2, none("timestamp_ntz"), none("timestamp_ntz"), none("boolean"), own))
    heads = p.groupBy("_key").agg(F.max("_ts").alias("_last"))
    spread = F.pmod(F.xxhash64(*payload), F.lit(_KEYLESS)).cast("int") if payload else F.lit(0)
    cuts = _cuts(stream, scratch, chunk_rows)
    if cuts is None:
        # null keys find no header: they are missing, wherever they lie
        stream = stream.withColumns({"_chunk": F.lit(0), "_part": F.when(F.col("_key").isNull(), spread).otherwise(0)})
        heads = rows(heads.withColumn("_ts", none("timestamp_ntz")), 0, none("timestamp_ntz"), F.col("_last"), F.lit(True), empty).withColumns({"_chunk": F.lit(0), "_part": F.lit(0)})
    else:
        at = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_ts"))), F.lit(0))
        stream = stream.join(cuts, "_key", "left").withColumn("_chunk", F.when(F.col("_cuts").isNotNull(), at).otherwise(0)).drop("_cuts")
        load = stream.join(cuts.select("_key"), "_key", "left_semi").groupBy("_key", "_chunk").agg(F.max("_end").alias("_e"), F.sum(F.when(F.col("_kind") == 2, 1).otherwise(0)).alias("n"))
        load = scratch.write(load, "load")  # a row per chunk of a hot key
        piles = load.where(F.col("n") > 2 * chunk_rows).select("_key", "_chunk", F.ceil(F.col("n") / chunk_rows).cast("int").alias("_parts"))
        stream = stream.join(piles, ["_key", "_chunk"], "left")
        mine = F.when(F.col("_kind") == 2, F.array(F.pmod(F.xxhash64(*payload), F.col("_parts")).cast("int") if payload else F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_parts") - 1))
        lone = F.array(F.when(F.col("_key").isNull(), spread).otherwise(0))
        stream = stream.withColumn("_part", F.explode(F.when(F.col("_parts").isNotNull(), mine).otherwise(lone))).drop("_parts")
        before = F.max("_e").over(Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))  # a row per chunk
        whole = cuts.select("_key", F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_chunk")).join(load, ["_key", "_chunk"], "left").select("_key", "_chunk", before.alias("_e"))
        heads = heads.join(whole, "_key", "left").withColumn("_chunk", F.coalesce("_chunk", F.lit(0))).join(piles, ["_key", "_chunk"], "left")
        heads = heads.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).withColumn("_ts", none("timestamp_ntz"))
        heads = heads.select("_key", "_ts", F.lit(0).alias("_kind"), F.col("_e").alias("_end"), "_last", F.lit(True).alias("_listed"), *empty, "_chunk", "_part")
    w = Window.partitionBy("_key", "_chunk", "_part").orderBy(F.col("_kind") > 0, "_ts", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = stream.unionByName(heads).select(
        "*", F.max("_end").over(w).alias("_cover"), F.max("_last").over(w).alias("_start_last"), F.max("_listed").over(w).alias("_known")
    )
    covered = F.coalesce(F.col("_cover") > F.col("_ts"), F.lit(False))
    state = F.when(F.col("_known").isNull(), "missing").when(F.col("_start_last") > F.col("_ts"), "late").otherwise("deleted")
    return merged.where((F.col("_kind") == 2) & ~covered).select(*payload, state.alias("orphan_state"))
