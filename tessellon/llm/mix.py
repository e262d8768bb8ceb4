"""Mixing sources to target weights, by Pfair scheduling.

Sizes are tokens of a public tokenizer. Each source's quota follows from its target share, the size of
the mixture and how often the source may repeat; what capped sources cannot give, the others give in
proportion to their shares. The mixture is cut into blocks; block k of a source with weight w has the
release floor(k / w) and the deadline ceil((k + 1) / w), and earliest deadline first interleaves the
sources so that none is ever a whole block off its share. The order of blocks is a stream that one task writes
(it holds a heap with a row per source); documents find their block by a two-level prefix sum of token counts.
Neither the size of a block nor the order depends on how much there is to mix.
"""

from __future__ import annotations

import heapq
import itertools
import os
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessellon.functions.curie import trim_ws
from tessellon.session import Scratch

if TYPE_CHECKING:
    import pandas as pd

TOKENIZER = os.environ.get("TESSELLON_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
BLOCK_TOKENS = 4096
#: Documents of a piece of a source for the prefix sums, on average. Pieces are ranges of the documents' hashes, so
#: their number changes no order.
PIECE_DOCS = 50_000


def source_name(c: str) -> Column:
    """Spelling variants of a source's name made equal: case, white space, hyphens."""
    return F.regexp_replace(F.lower(trim_ws(c)), r"[-\s]+", "_")


def _counter(path: str):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        for pdf in batches:
            sizes: list[int] = []
            for a in range(0, len(pdf), 256):
                sizes += [len(e.ids) for e in tok.encode_batch(list(pdf["_text"].iloc[a : a + 256]), add_special_tokens=False)]
            yield pd.DataFrame({"_id": pdf["_id"], "_source": pdf["_source"], "tokens": sizes})

    return count


def token_counts(docs: DataFrame, key: str, text: str, source: Column, tokenizer: str = TOKENIZER) -> DataFrame:
    """key, source, tokens of every text; null texts have none and are left out."""
    kt = docs.schema[key].dataType.simpleString()
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_id"), source.alias("_source"), F.col(text).alias("_text"))
    out = rows.mapInPandas(_counter(tokenizer), f"_id {kt}, _source string, tokens long")
    return out.select(F.col("_id").alias(key), F.col("_source").alias("source"), "tokens")


def quotas(available: dict[str, int], shares: dict[str, float], repeats: dict[str, int], total: int) -> dict[str, int]:
    """Tokens of each source in a mixture of ``total``: its share, capped at ``repeats`` times what there
    is; the shortfall goes to the uncapped sources in proportion to their shares."""
    cap = {s: available.get(s, 0) * max(0, repeats[s]) for s in shares}
    out, free, left = {}, {s for s in shares if shares[s] > 0 and cap[s] > 0}, float(total)
    while free:
        weight = sum(shares[s] for s in free)
        full = {s for s in free if left * shares[s] / weight >= cap[s]}
        if not full:
            out |= {s: int(left * shares[s] / weight) for s in free}
            break
        for s in full:
            out[s] = cap[s]
            left -= cap[s]
        free -= full
    return {s: out.get(s, 0) for s in shares}


def schedule(blocks: dict[str, int]) -> Iterator[tuple[str, int]]:
    """Order of (source, block number) by Pfair earliest deadline first; whole-number arithmetic.

    With weight w = blocks / total: block k may run from slot floor(k / w) on and must by ceil((k + 1) / w).
    """
    total = sum(blocks.values())
    waiting = [(0, s, 0) for s, n in sorted(blocks.items()) if n]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * total // blocks[s]), s, k))
        _, s, k = heapq.heappop(ready)
        yield s, k
        if k + 1 < blocks[s]:
            heapq.heappush(waiting, ((k + 1) * total // blocks[s], s, k + 1))


def _ordered(blocks: dict[str, int], batch: int = 100_000):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        for _ in batches:
            order, at = schedule(blocks), 0
            while part := list(itertools.islice(order, batch)):
                yield pd.DataFrame({"slot": range(at, at + len(part)), "source": [s for s, _ in part], "block": [k for _, k in part]})
                at += len(part)

    return run


def mix(docs: DataFrame, targets: DataFrame, scratch: Scratch, total: int | None = None, seed: int = 7, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """``docs``: id, source, tokens (one row per document); ``targets``: source, target_share, max_repeats.

    Returns the mixture (slot, source, pass_no, id, tokens, offset: order by slot, source, offset) and the
    report (source, target_share, max_repeats, available, used, passes, actual_share). ``total`` is the
    mixture's size, by default what the target sources hold. A source's last pass ends with the document
    that reaches the quota. Documents of no target source, with no tokens or a null id are not mixed;
    target sources without documents report a share of 0. Empty input gives an empty mixture.
    """
    spark = docs.sparkSession
    goals = [r for r in targets.where(F.col("source").isNotNull()).dropDuplicates(["source"]).collect()]  # a row per source
    shares, repeats = {r["source"]: r["target_share"] or 0.0 for r in goals}, {r["source"]: r["max_repeats"] or 0 for r in goals}
    rows = docs.where(F.col("source").isin(*shares) & (F.col("tokens") > 0) & F.col("id").isNotNull()).select("id", "source", "tokens")
    rows = scratch.write(rows.withColumn("place", F.xxhash64("id", F.lit(seed))), "docs")
    pieces = 1 << max(0, (rows.count() // PIECE_DOCS).bit_length())
    # the top bits of the hash: pieces are ranges of the order inside a source
    rows = rows.withColumn("shard", F.shiftrightunsigned("place", 64 - pieces.bit_length() + 1) if pieces > 1 else F.lit(0).cast("bigint"))
    rows = rows.withColumn("unsigned", F.col("place").bitwiseXOR(F.lit(-(1 << 63))))
    per_shard = scratch.write(rows.groupBy("source", "shard").agg(F.sum("tokens").alias("n")), "pieces")  # a row for PIECE_DOCS documents
    before = per_shard.select("source", "shard", (F.sum("n").over(Window.partitionBy("source").orderBy("shard")) - F.col("n")).alias("before"))
    available = {r["source"]: r["n"] for r in per_shard.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    want = quotas(available, shares, repeats, sum(available.values()) if total is None else total)
    blocks = {s: -(-n // block_tokens) for s, n in want.items()}
    order = spark.range(1, numPartitions=1).mapInPandas(_ordered(blocks), "slot long, source string, block long")
    order = scratch.write(order, "order")
    inside = Window.partitionBy("source", "shard").orderBy("unsigned", "id")
    at = rows.withColumn("own", F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"))
    at = at.join(before, ["source", "shard"]).withColumn("start", F.col("before") + F.col("own"))
    plan = spark.createDataFrame([(s, want[s], available.get(s, 0)) for s in want if want[s]], "source string, quota long, held long")
    copies = at.join(F.broadcast(plan), "source").withColumn("pass_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(quota - 1) div held"))))
    copies = copies.withColumn("offset", F.col("pass_no") * F.col("held") + F.col("start")).where(F.col("offset") < F.col("quota"))
    mixed = copies.withColumn("block", F.expr(f"offset div {block_tokens}")).join(order, ["source", "block"])
    mixture = scratch.write(mixed.select("slot", "source", F.col("pass_no").cast("int").alias("pass_no"), "id", "tokens", "offset"), "mixture")
    used = mixture.groupBy("source").agg(F.sum("tokens").alias("used"), (F.max("pass_no") + 1).alias("passes"))
    facts = spark.createDataFrame([(s, float(shares[s]), repeats[s], available.get(s, 0)) for s in shares], "source string, target_share double, max_repeats int, available long")
    report = facts.join(F.broadcast(used), "source", "left").withColumns({"used": F.coalesce("used", F.lit(0)), "passes": F.coalesce("passes", F.lit(0))})
    everything = F.sum("used").over(Window.partitionBy(F.lit(1)))  # a row per source
    return mixture, report.withColumn("actual_share", F.when(everything > 0, F.col("used") / everything).otherwise(0.0))
