"""Per-key work without stragglers: fragment-replicate by estimated load.

Load is estimated by sums over a fixed number of bins and, in crowded bins, by counts of keys. Keys above a share of a task's fair load
are split into shards in proportion; all others fall into a fixed number of bins. Shards and bins are
packed on tasks, longest first. Rows then go straight to their task (``repartitionById``), and the
matching side is copied only to the tasks that hold shards of its key.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellon.functions.curie import once

BINS_PER_TASK = 16


@dataclass
class Plan:
    tasks: int
    bins: list[int]  # task of each bin
    heavy: dict[object, list[int]]  # tasks of a heavy key's shards; at most 4 * tasks keys
    loads: list[int]  # estimated rows of each task

    def _with_shards(self, df: DataFrame, key: str) -> DataFrame:
        """Adds _shards, the tasks of a heavy key, else null. The table broadcast has at most 4 * tasks rows."""
        if not self.heavy:
            return df.withColumn("_shards", F.lit(None).cast("array<int>"))
        kind = df.schema[key].dataType.simpleString()
        table = df.sparkSession.createDataFrame(list(self.heavy.items()), f"_heavy {kind}, _shards array<int>")
        return df.join(F.broadcast(table), F.col(key) == F.col("_heavy"), "left").drop("_heavy")

    def _bin(self, key: Column) -> Column:
        return F.element_at(_ints(self.bins), _bin_of(key, len(self.bins)) + 1)

    def fragment(self, df: DataFrame, key: str, within: list[str]) -> DataFrame:
        """Rows on their tasks, named in ``_task``. ``within``: rows equal in these stay in one shard."""
        shard = F.element_at("_shards", F.pmod(F.xxhash64(*within), F.size("_shards")).cast("int") + 1)
        placed = self._with_shards(df, key).withColumn("_task", F.coalesce(F.when(F.col("_shards").isNotNull(), shard), self._bin(F.col(key))))
        return placed.drop("_shards").repartitionById(self.tasks, F.col("_task"))

    def replicate(self, df: DataFrame, key: str) -> DataFrame:
        """The matching side, on every task that holds a shard of the key and nowhere else."""
        tasks = F.coalesce(F.array_distinct("_shards"), F.array(self._bin(F.col(key))))
        return self._with_shards(df, key).withColumn("_task", F.explode(tasks)).drop("_shards").repartitionById(self.tasks, F.col("_task"))


def _ints(values: list[int]) -> Column:
    """A constant array, folded by the optimizer into one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def _bin_of(key: Column | str, bins: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bins)).cast("int")


def pack(bins: list[int], heavy: dict[object, int], tasks: int) -> Plan:
    """Longest processing time first; a heavy key's shards are its load over a task's fair load, rounded up."""
    fair = max(1, -(-(sum(bins) + sum(heavy.values())) // tasks))
    items = [(n, ("bin", i)) for i, n in enumerate(bins)]
    for k, n in heavy.items():
        parts = -(-n // fair)
        items += [(n / parts, ("key", k))] * parts
    free = [(0, t) for t in range(tasks)]
    plan = Plan(tasks, [0] * len(bins), {}, [0] * tasks)
    for n, (kind, what) in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        load, t = heapq.heappop(free)
        heapq.heappush(free, (load + n, t))
        plan.loads[t] = int(load + n)
        if kind == "bin":
            plan.bins[what] = t
        else:
            plan.heavy.setdefault(what, []).append(t)
    return plan


def plan_by_load(df: DataFrame, key: str, tasks: int) -> Plan:
    """A key is heavy from a quarter of a task's fair load on, so there are at most 4 * tasks of them.

    The first pass counts rows per bin, no keys: as many sums as there are bins come to the driver. A heavy
    key makes its bin crowded; the second pass counts the keys of crowded bins alone, and only if there are any.
    """
    n = tasks * BINS_PER_TASK
    bins, heavy = [0] * n, {}
    for r in df.groupBy(_bin_of(key, n).alias("_b")).agg(F.count("*").alias("_n")).collect():
        bins[r["_b"]] = r["_n"]
    limit = max(1, sum(bins) // (4 * tasks))
    crowded = [int(x > limit) for x in bins]
    if any(crowded):
        rows = df.where(F.element_at(_ints(crowded), _bin_of(key, n) + 1) == 1)
        top = rows.groupBy(key).agg(F.count("*").alias("_n")).where((F.col("_n") > limit) & F.col(key).isNotNull())
        for r in top.select(key, "_n", _bin_of(key, n).alias("_b")).collect():
            heavy[r[key]] = r["_n"]
            bins[r["_b"]] -= r["_n"]
    return pack(bins, heavy, tasks)


def distinct_per_key(df: DataFrame, key: str, member: str, tasks: int) -> DataFrame:
    """key, n: distinct members of each key; rows with a null key or member count nowhere.

    Equal pairs meet in one shard, so shards count apart and their counts add up. Empty input gives no
    rows. Columns other than the two are ignored.
    """
    pairs = once(df.select(F.col(key).alias("_key"), F.col(member).alias("_member"))).where("_key IS NOT NULL AND _member IS NOT NULL")
    plan = plan_by_load(pairs, "_key", tasks)
    each = plan.fragment(pairs, "_key", ["_member"]).groupBy("_task", "_key", "_member").agg(F.count("*").alias("_c"))
    return each.groupBy("_task", "_key").agg(F.count("*").alias("n")).groupBy("_key").agg(F.sum("n").alias("n")).withColumnRenamed("_key", key)


def join_balanced(left: DataFrame, right: DataFrame, left_key: str, right_key: str, within: list[str], tasks: int, how: str = "inner") -> DataFrame:
    """``left`` (skewed) joined with ``right`` on the key, each left row on its task; null keys match nothing
    and go with a left join to the bin of null. The right key column is dropped; the caller renames clashing columns."""
    plan = plan_by_load(left, left_key, tasks)
    a = plan.fragment(left, left_key, within)
    b = plan.replicate(right.withColumnRenamed(right_key, "_right_key"), "_right_key").withColumnRenamed("_task", "_right_task")
    return a.join(b, (F.col("_task") == F.col("_right_task")) & (F.col(left_key) == F.col("_right_key")), how).drop("_task", "_right_task", "_right_key")
