"""Changes between full snapshots, through a bucketed key-to-hash index of the last snapshot.

Only (key, hash) of the last snapshot is probed; values are fetched for changed keys alone, and the new
index then takes the place of the old one. The index is bucketed and sorted by key, so a probe shuffles
no old data. ``changes`` compares all neighbours of many releases; ``SnapshotIndex`` keeps the index of a
feed between deliveries.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellon import files
from tessellon.functions.curie import WS_CLASS
from tessellon.session import Scratch, shuffle_partitions


def whole_number(c: Column | str) -> Column:
    """Count text as a whole number: thousands separators, leading zeros, ``.0`` and exponents are
    notations of one number; whatever is no number gives null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.regexp_replace(c, f"[,_{WS_CLASS}]", "").try_cast("decimal(38,6)")).cast("decimal(32,0)")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` (nulls lowest). Pre-aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    top = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(top.alias("_top")).select(*keys, *[F.col("_top")[c].alias(c) for c in rest])


def _hash(values: list[str]) -> Column:
    return F.md5(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}))


def _probe(old: DataFrame, new: DataFrame, values: list[str], fetch: bool) -> DataFrame:
    """``old``, ``new``: _k, _h and values, bucketed alike by _k. _k, change_kind and, with ``fetch``, old_<v> and new_<v>.
    Keys and hashes alone are compared; values are read for the keys that differ."""
    a, b = old.select("_k", F.col("_h").alias("_old")), new.select("_k", F.col("_h").alias("_new"))
    diff = a.join(b, "_k", "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    diff = diff.select("_k", F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed").alias("change_kind"))
    for side, frame in (("old", old), ("new", new)) if fetch else ():
        diff = diff.join(frame.select("_k", *[F.col(v).alias(f"{side}_{v}") for v in values]), "_k", "left")
    return diff


def _named(diff: DataFrame, key: str, before: str, after: str) -> DataFrame:
    rest = [c for c in diff.columns if c not in ("_k", "change_kind")]
    return diff.select(F.lit(before).alias("from_release"), F.lit(after).alias("to_release"), F.col("_k").alias(key), "change_kind", *rest)


def changes(rows: DataFrame, tag: str, tags: list[str], key: str, values: list[str], scratch: Scratch, fetch: bool = True) -> DataFrame:
    """``rows``: one row per tag and key; ``tags``: the releases, oldest first. Returns from_release, to_release, key,
    change_kind (added, removed, changed) and, with ``fetch``, old_<v> and new_<v> of each value.

    All releases are read once and written as one table, bucketed by key and in each bucket sorted by release: a
    release's rows are its index, whose row groups the scan finds by the tag, and no probe shuffles. Null keys are no records and are left out; null values are a
    value of their own, equal to each other. A release without rows removes all keys of the one before. Rows
    of other tags and other columns are ignored.
    """
    if len(tags) < 2:
        raise ValueError("at least two snapshots are needed")
    kept = rows.where(F.col(key).isNotNull() & F.col(tag).isin(*tags)).select(F.col(key).alias("_k"), _hash(values).alias("_h"), *values, F.col(tag).alias("_tag"))
    index = scratch.bucketed(kept, "index", shuffle_partitions(scratch.spark), "_k", first=("_tag",))
    of = lambda t: index.where(F.col("_tag") == t).drop("_tag")
    return reduce(DataFrame.unionByName, [_named(_probe(of(a), of(b), values, fetch), key, a, b) for a, b in zip(tags, tags[1:])])


class SnapshotIndex:
    """The index of a feed's last snapshot, kept below ``root`` from one delivery to the next.

    Each delivery is written once, bucketed by key, beside the last; the file ``CURRENT`` names the version that
    holds and is replaced when the new one is complete, so a broken delivery leaves the old index in place.
    The version before stays until the delivery after, since the changes returned still read it.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, values: list[str], buckets: int | None = None):
        self.spark, self.root, self.key, self.values = spark, root.rstrip("/"), key, values
        self.buckets = buckets or shuffle_partitions(spark)

    def current(self) -> tuple[str, str, int] | None:
        """(version, tag, buckets) of the last delivery."""
        if not files.exists(self.spark, f"{self.root}/CURRENT"):
            return None
        version, tag, buckets = files.read(self.spark, f"{self.root}/CURRENT").split("\n")
        return version, tag, int(buckets)

    def deliver(self, tag: str, rows: DataFrame, fetch: bool = True) -> DataFrame | None:
        """Changes from the last delivery to ``rows`` (one row per key), as ``changes`` gives them; None for the first."""
        last = self.current()
        version, buckets = f"v{int(last[0][1:]) + 1 if last else 0}", last[2] if last else self.buckets
        kept = rows.where(F.col(self.key).isNotNull()).select(F.col(self.key).alias("_k"), _hash(self.values).alias("_h"), *self.values)
        new = files.write_bucketed(self.spark, kept, f"{self.root}/{version}", buckets, "_k")
        files.replace(self.spark, f"{self.root}/CURRENT", f"{version}\n{tag}\n{buckets}")
        if last is None:
            return None
        if int(last[0][1:]):
            files.delete(self.spark, f"{self.root}/v{int(last[0][1:]) - 1}")
        old = files.read_bucketed(self.spark, kept.schema, f"{self.root}/{last[0]}", buckets, "_k")
        return _named(_probe(old, new, self.values, fetch), self.key, last[1], tag)
