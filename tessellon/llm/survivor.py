"""One surviving record for each group of duplicates, chosen field by field.

Two ways to choose a field's value:

- ``pick``: the candidate first by fixed priorities (trust, date, ...), a greatest-struct aggregate;
- ``fuse``: Bayesian fusion with copy detection. Sources' accuracies and the dependence between sources
  are estimated in turn: two sources that share many false values depend on each other, votes that a
  source may have copied are discounted, and the value with the greatest posterior wins.

All aggregates combine before the shuffle, so one group with a third of all rows is no task's burden.
Statistics of sources are small: one row per source or pair of sources.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellon.session import Scratch


def pick(ok: Column, value: Column, *priority: Column) -> Column:
    """Aggregate: ``value`` of the row with the greatest ``priority`` among those where ``ok``; null where
    there is none. Null priorities are lowest."""
    return F.max_by(F.when(ok, value), F.when(ok, F.struct(*[p.alias(f"p{i}") for i, p in enumerate(priority)])))


#: Sources that ``fuse`` takes; their statistics, and those of pairs, are gathered on the driver.
MAX_SOURCES = 1000


def fuse(
    claims: DataFrame, scratch: Scratch, rounds: int = 3, false_values: int = 10, copy_prior: float = 0.2, copy_rate: float = 0.8, start_accuracy: float = 0.8
) -> DataFrame:
    """``claims``: item, source, value (null in any is no claim). A source claims one value of an item: the
    one it gives most often, the smallest of equally frequent ones.

    Returns item, value, posterior (among the values claimed), votes (sources that claim it): one row per
    item with a claim. Equal posteriors go to the smallest value. ``false_values`` is the number of false
    values an item is taken to have, ``copy_prior`` the prior chance that one source copies from another,
    ``copy_rate`` the share of values a copier copies.

    An item's claims are one row, one claim per source, however many records it has; it is shuffled once, and
    each round reads it in place. Only statistics of sources and of pairs of sources leave the tasks: sources are few
    (``MAX_SOURCES`` at most, more is an error).
    """
    n = float(false_values)
    each = claims.where("item IS NOT NULL AND source IS NOT NULL AND value IS NOT NULL").groupBy("item", "source", "value").agg(F.count("*").alias("n"))
    held = each.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("source", (-F.col("n")).alias("n"), "value"))).alias("c"))
    # of a source's values the first in this order
    first = F.filter("c", lambda x, i: (i == 0) | (F.get("c", i - 1)["source"] != x["source"]))
    items = scratch.write(held.select("item", F.transform(first, lambda x: F.struct(x["source"].alias("source"), x["value"].alias("value"))).alias("c")), "items")
    sources = sorted(r[0] for r in items.select(F.explode("c.source")).distinct().limit(MAX_SOURCES + 1).collect())
    if len(sources) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    accuracy, independent = {s: start_accuracy for s in sources}, {}
    for r in range(rounds):
        judged = _vote(items, accuracy, independent, n)
        if r + 1 == rounds:
            break
        judged = scratch.write(judged, f"judged{r}")
        means = judged.select(F.explode("j").alias("x")).groupBy("x.source").agg(F.avg("x.posterior").alias("a")).collect()
        accuracy = {m["source"]: min(0.99, max(0.05, m["a"])) for m in means}
        independent = _independence(judged, accuracy, n, copy_prior, copy_rate)
    best = F.array_min(F.transform("v", lambda x: F.struct((-x["posterior"]).alias("p"), x["value"].alias("value"), x["votes"].alias("votes"))))
    return judged.select("item", best.alias("b")).select("item", "b.value", (-F.col("b.p")).alias("posterior"), "b.votes")


def _numbers(of: dict[str, float]) -> Column:
    """A constant map; empty where there is nothing."""
    return F.create_map(*[F.lit(x) for kv in of.items() for x in kv]) if of else F.create_map().cast("map<string,double>")


def _pair(a: Column, b: Column) -> Column:
    return F.concat(a, F.lit("\x00"), b)


def _vote(items: DataFrame, accuracy: dict[str, float], independent: dict[tuple[str, str], float], n: float) -> DataFrame:
    """item, c, v (value, posterior, votes of each value), j (source, value, posterior of each claim): log-odds votes of sources,
    each weighted by the chance that it copied none of the more accurate sources that claim the same."""
    score = _numbers({s: math.log(n * a / (1 - a)) for s, a in accuracy.items()})
    free = _numbers({f"{s}\x00{lead}": x for (s, lead), x in independent.items()})
    alike = lambda x: F.filter("c", lambda y: (y["value"] == x["value"]) & (y["source"] != x["source"]))
    weight = lambda x: F.aggregate(alike(x), F.lit(1.0), lambda a, y: a * F.coalesce(F.element_at(free, _pair(x["source"], y["source"])), F.lit(1.0)))
    rows = items.select("item", "c", F.transform("c", lambda x: F.struct(x["value"].alias("value"), (F.element_at(score, x["source"]) * weight(x)).alias("s"))).alias("w"))
    votes = lambda v: F.filter("w", lambda y: y["value"] == v)
    total = lambda v: F.aggregate(votes(v), F.lit(0.0), lambda a, y: a + y["s"])
    rows = rows.select("item", "c", F.transform(F.array_distinct("w.value"), lambda v: F.struct(v.alias("value"), total(v).alias("s"), F.size(votes(v)).cast("bigint").alias("votes"))).alias("v"))
    # relative to the item's greatest score
    rows = rows.select("item", "c", "v", F.array_max("v.s").alias("top"))
    rows = rows.select("item", "c", "v", "top", F.aggregate("v", F.lit(0.0), lambda a, y: a + F.exp(y["s"] - F.col("top"))).alias("all"))
    rows = rows.select("item", "c", F.transform("v", lambda x: F.struct(x["value"].alias("value"), (F.exp(x["s"] - F.col("top")) / F.col("all")).alias("posterior"), x["votes"].alias("votes"))).alias("v"))
    own = lambda x: F.get(F.filter("v", lambda y: y["value"] == x["value"]), F.lit(0))["posterior"]
    return rows.select("item", "c", "v", F.transform("c", lambda x: F.struct(x["source"].alias("source"), x["value"].alias("value"), own(x).alias("posterior"))).alias("j"))


def _independence(judged: DataFrame, accuracy: dict[str, float], n: float, prior: float, rate: float) -> dict[tuple[str, str], float]:
    """(source, more accurate source): the chance that the first did not copy a value from the second.

    For each pair of sources: how many values both hold are true, how many false (by their posterior), and
    on how many items they differ. Sharing false values is what speaks for copying.
    """
    later = lambda x: F.filter("j", lambda y: y["source"] > x["source"])
    met = F.flatten(F.transform("j", lambda x: F.transform(later(x), lambda y: F.struct(x["source"].alias("s1"), y["source"].alias("s2"), F.when(x["value"] == y["value"], x["posterior"]).alias("p")))))
    p = F.col("x.p")
    counts = judged.select(F.explode(met).alias("x")).groupBy("x.s1", "x.s2").agg(F.sum(F.coalesce(p, F.lit(0.0))).alias("true"), F.sum(F.coalesce(1 - p, F.lit(0.0))).alias("false"), F.sum(F.when(p.isNull(), 1).otherwise(0)).alias("differ"))
    out = {}
    for r in counts.collect():  # a row per pair of sources
        a1, a2 = accuracy[r["s1"]], accuracy[r["s2"]]
        t, f = a1 * a2, (1 - a1) * (1 - a2) / n
        d = max(1e-6, 1 - t - f)
        ratio = r["true"] * math.log((rate * a1 + (1 - rate) * t) / t) + r["false"] * math.log((rate * (1 - a1) + (1 - rate) * f) / f) + r["differ"] * math.log((1 - rate) * d / d)
        dependent = 1 / (1 + (1 - prior) / prior * math.exp(-max(-60.0, min(60.0, ratio))))
        first = a1 > a2 or (a1 == a2 and r["s1"] < r["s2"])
        out[(r["s2"], r["s1"]) if first else (r["s1"], r["s2"])] = 1 - rate * dependent
    return out
