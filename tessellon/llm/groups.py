"""Groups of records linked directly or indirectly, by low-diameter decomposition.

Each level draws a shift for every vertex from a (discrete) exponential distribution; a vertex with a
larger shift starts its cluster earlier. Clusters grow by one hop a round; a vertex joins the cluster that
reaches it first, ties going to the greater id. After ``MAX_SHIFT`` rounds all are settled and every
cluster is connected. Clusters become the vertices of the next level, links between clusters its edges;
the levels' assignments are then composed from the top down. A level shrinks paths about threefold and
denser graphs more, so the levels are logarithmic in the longest path.

A growth round is one pre-aggregated shuffle of messages, keyed by a single long: shift left in the top
bits, cluster in the rest. In round n only vertices settled in round n - 1 send, so a link is used at most
once in each direction. At every level a vertex with very many links is split into sub-vertices joined to
it, so no task holds all links of one vertex. The recursion ends where the links left fit in one task
(``FOREST_LINKS``, whatever the size of the input): a union-find there gives their components.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellon.session import Scratch

if TYPE_CHECKING:
    import pandas as pd

MAX_SHIFT = 6
#: Chance that a shift is one longer, exp(-beta) of the exponential distribution; 5 % of the shifts reach MAX_SHIFT.
STAY = 0.6
#: Links of one vertex before it is split.
MAX_DEGREE = 50_000
#: Links that one task joins at the end of the recursion (under 40 MB of Python objects).
FOREST_LINKS = 100_000
_ONE = 1 << 58  # one unit of shift in a key; ids lie below
_SUB = 1 << 57  # ids of sub-vertices start here
_SUBS = 1 << 50  # ids set aside for the sub-vertices of a level


def _shift(v: Column, level: int) -> Column:
    u = F.pmod(F.xxhash64(v, F.lit(level)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return sum((F.when(u < STAY**i, 1).otherwise(0) for i in range(1, MAX_SHIFT + 1)), F.lit(0)).cast("bigint")


def _split_hubs(edges: DataFrame, ends: DataFrame, level: int, scratch: Scratch, max_degree: int) -> DataFrame | None:
    """Links with every end of over ``max_degree`` links split into sub-vertices, each linked to the end.

    None where no vertex has so many. ``ends``: v, n. The table of hubs grows with the links (2 for every
    ``max_degree``), so it is joined as any other table.
    """
    hubs = ends.where(F.col("n") > max_degree).select("v", F.ceil(F.col("n") * 2 / max_degree).alias("parts"))
    if hubs.isEmpty():
        return None
    subs = hubs.select("v", "parts", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    subs = scratch.write(subs.withColumn("sub", F.monotonically_increasing_id() + (_SUB + level * _SUBS)), f"hubs{level}")
    out = edges
    for end, other in (("a", "b"), ("b", "a")):
        parts = subs.where("part = 0").select(F.col("v").alias(end), "parts")
        place = out.join(parts, end, "left").select("a", "b", F.pmod(F.xxhash64(other), F.col("parts")).alias("part"))
        sub = subs.select(F.col("v").alias(end), "part", "sub")
        out = place.join(sub, [end, "part"], "left").select(F.coalesce("sub", end).alias(end), other)
    return scratch.write(out.select("a", "b").unionByName(subs.select(F.col("v").alias("a"), F.col("sub").alias("b"))), f"split{level}")


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count("*").alias("n"))


def _grow(edges: DataFrame, ends: DataFrame, level: int) -> DataFrame:
    """v, c: the cluster of every vertex of ``ends``.

    All rounds are one statement, analysed once; the links' exchange is shared by the rounds. A key is
    settled in round n if its shift left is MAX_SHIFT - n; what comes later is smaller.
    """
    steps = edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("to")), F.struct(F.col("b").alias("v"), F.col("a").alias("to"))))).select("col.*")
    steps = steps.withColumn("cost", F.lit(_ONE)).unionByName(ends.select("v", F.col("v").alias("to"), F.lit(0).cast("bigint").alias("cost")))
    state = "SELECT v, key FROM {first}"
    for n in range(MAX_SHIFT):
        state = (
            f"SELECT s{n}.to AS v, max(p{n}.key - s{n}.cost) AS key FROM {{steps}} s{n} JOIN ({state}) p{n} ON s{n}.v = p{n}.v "
            f"WHERE s{n}.cost = 0 OR p{n}.key BETWEEN {(MAX_SHIFT - n) * _ONE} AND {(MAX_SHIFT - n + 1) * _ONE - 1} GROUP BY s{n}.to"
        )
    first = ends.select("v", (_shift(F.col("v"), level) * _ONE + F.col("v")).alias("key"))
    return edges.sparkSession.sql(f"SELECT v, key & {_ONE - 1} AS c FROM ({state})", steps=steps, first=first)


def _contract(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        edges = edges.join(clusters.select(F.col("v").alias(end), F.col("c").alias(f"c{end}")), end)
    return edges.where("ca <> cb").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pandas as pd

    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    yield pd.DataFrame({"v": np.array(list(root), np.int64), "c": np.array([find(x) for x in list(root)], np.int64)})


def component_ids(edges: DataFrame, scratch: Scratch, max_degree: int = MAX_DEGREE, forest_links: int = FOREST_LINKS) -> DataFrame:
    """``edges``: a, b (ids from 0 to 2^57), no loops. Returns v, root: the same root for all linked vertices."""
    now, maps, level = edges, [], 0
    while (left := now.count()) > (forest_links if level else 0):
        ends = scratch.write(_ends(now), f"ends{level}")
        split = _split_hubs(now, ends, level, scratch, max_degree)
        if split is not None:
            now = split
            ends = scratch.write(_ends(now), f"split_ends{level}")
        maps.append(scratch.write(_grow(now, ends, level), f"clusters{level}"))
        now = scratch.write(_contract(now, maps[-1]), f"edges{level}")
        for name in (f"ends{level}", f"split{level}", f"split_ends{level}", f"hubs{level}", f"edges{level - 1}"):
            scratch.drop(name)
        level += 1
    if left:
        maps.append(now.coalesce(1).mapInPandas(_forest, "v bigint, c bigint"))
    if not maps:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    label = maps[-1].withColumnRenamed("c", "root")
    for clusters in maps[-2::-1]:
        up = label.select(F.col("v").alias("c"), "root")
        label = clusters.join(up, "c", "left").select("v", F.coalesce("root", "c").alias("root"))
    return label.where(F.col("v") < _SUB)


def groups(links: DataFrame, members: DataFrame, scratch: Scratch, max_degree: int = MAX_DEGREE, forest_links: int = FOREST_LINKS) -> DataFrame:
    """``links``: left, right; ``members``: member. Returns member, group_id for every distinct member and
    linked value; group_id is the smallest value of the group by code point, a lone member's its own.

    Null members and links with a null end link nothing; a link's non-null end is still a member of its
    own. Repeated, reversed and self links change nothing. Empty input gives no rows; columns other than
    the three are ignored.
    """
    # the ends are computed once and the inputs read once: pairs that link nothing stay in the table for their lone ends
    ok = F.coalesce(F.col("left") != F.col("right"), F.lit(False))
    low, high = F.when(ok, F.least("left", "right")).otherwise(F.col("left")), F.when(ok, F.greatest("left", "right")).otherwise(F.col("right"))
    pairs = links.select(low.alias("left"), high.alias("right"), ok.alias("ok")).distinct()
    pairs = scratch.write(pairs, "links")
    real = pairs.where("ok").select("left", "right")
    ends = real.select(F.explode(F.array("left", "right")).alias("member")).distinct()
    # dense ids: written once, so that every later read sees the same
    ids = scratch.write(ends.select("member", F.monotonically_increasing_id().alias("v")), "ids")
    edges = real
    for side, name in (("left", "a"), ("right", "b")):
        edges = edges.join(ids.select(F.col("member").alias(side), F.col("v").alias(name)), side)
    edges = scratch.write(edges.select("a", "b"), "edges")
    rooted = scratch.write(ids.join(component_ids(edges, scratch, max_degree, forest_links), "v").select("member", "root"), "rooted")
    # written, so that both sides of the join are plain scans and a root with very many members can be split among tasks
    least = scratch.write(rooted.groupBy("root").agg(F.min("member").alias("group_id")), "least")
    linked = rooted.join(least, "root").select("member", "group_id")
    alone = members.select("member").unionByName(pairs.where("NOT ok").select(F.explode(F.array("left", "right")).alias("member")))
    alone = alone.where(F.col("member").isNotNull()).distinct().join(ids.select("member"), "member", "left_anti")
    return linked.unionByName(alone.select("member", F.col("member").alias("group_id")))
