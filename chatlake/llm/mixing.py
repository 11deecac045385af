"""Sources mixed to target shares of the total number of tokens.

Method. Sizes are tokens of a public tokenizer. The total is the largest that all sources that have any text can serve
with their shares and caps (or a stated smaller one), in blocks of equal tokens. Sainte-Lague apportionment gives each
source an integer number of blocks by highest quotients share / (2 n + 1). The blocks are dealt to output shards of
SHARD_BLOCKS in the order in which they were won, so every shard has integer quotas near the shares. A source's texts lie
in seeded hash order on a line of tokens, passed over as often as needed; its first blocks are therefore a seeded choice.
A text is used in a pass when its middle lies before the end of the quota. What a quota then lacks or exceeds, less than a
text, is mended by the one text whose size comes nearest to it. A use of a text belongs to the shard of the block in
which its middle lies.

Repeats are counted by text: equal texts count as one, that of the smallest doc_id. Source names are compared without
case, blanks and punctuation; a null or unknown source takes no part. Texts of no tokens and null texts take no part.
Targets that have no documents get none, and the others keep their proportions. Empty tables give empty results.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chatlake.llm.tokens import count_tokens
from chatlake.runtime import cut

#: Blocks that the whole mixture is cut into, at most; a block is at least BLOCK_TOKENS long; blocks of an output shard.
BLOCKS, BLOCK_TOKENS, SHARD_BLOCKS = 4000, 2000, 100


def source_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"(?U)[^\p{L}\p{N}]+", "")


def sainte_lague(shares: dict[str, float], seats: int) -> dict[str, int]:
    """Seats by highest quotients share / (2 n + 1); equal quotients go to the smaller name."""
    total = sum(s for s in shares.values() if s > 0)
    # with this divisor the quotients above it are at most `seats`, and so are won; one less is safe from rounding
    divisor = total / (seats - len(shares) / 2) if seats > len(shares) / 2 else 0.0
    won = {k: max(0, int(s / divisor + 0.5) - 1) if s > 0 and divisor else 0 for k, s in shares.items()}
    heap = [(-(s / (2 * won[k] + 1)), k) for k, s in shares.items() if s > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(won.values()) if heap else 0):
        _, k = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-(shares[k] / (2 * won[k] + 1)), k))
    return won


def sized_texts(docs: DataFrame, targets: DataFrame, tokenizer: str = "byte_bpe_50k", tokenizer_dir: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, digest): one row per distinct text of a target's source, written once."""
    names = targets.select(F.col("source").alias("target"), source_key(F.col("source")).alias("key")).dropDuplicates(["key"])
    rows = docs.filter("text is not null and text <> ''").select("doc_id", "text", source_key(F.col("source")).alias("key"))
    rows = rows.join(names, "key")
    sized = cut(rows.select("doc_id", F.col("target").alias("source"), count_tokens(tokenizer, tokenizer_dir)("text").alias("n_tokens"), F.sha2("text", 256).alias("digest")), "sized")
    keep = sized.groupBy("digest").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("k"))
    return keep.select("k.doc_id", "k.source", "k.n_tokens", "digest").filter("n_tokens > 0")


def mix(docs: DataFrame, targets: DataFrame, seed: int = 7, total_tokens: int | None = None, tokenizer: str = "byte_bpe_50k", tokenizer_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(chosen, shares).

    chosen: (doc_id, source, n_tokens, uses, shards) of the texts used, `shards` being the output shard of each use.
    shares: (source, target_share, max_repeats, available_tokens, quota_blocks, used_tokens, actual_share, most_uses), one
    row per target. Only the targets, and a few sums and one text per source, reach the driver.
    """
    spark = docs.sparkSession
    sized = cut(sized_texts(docs, targets, tokenizer, tokenizer_dir), "texts")
    want = {r["source"]: (float(r["target_share"]), int(r["max_repeats"])) for r in targets.collect() if r["source"] is not None and r["target_share"] is not None}
    have = {r["source"]: r["n"] for r in sized.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    live = {s: w for s, (w, cap) in want.items() if have.get(s, 0) > 0 and w > 0 and cap > 0}
    scale = sum(live.values())
    room = int(min((have[s] * want[s][1] / (w / scale) for s, w in live.items()), default=0))
    total = room if total_tokens is None else min(room, total_tokens)
    block = max(BLOCK_TOKENS, -(-total // BLOCKS)) if total >= 50 * BLOCK_TOKENS else max(1, total // 50)
    seats = total // block if live else 0
    upto = [sainte_lague(live, min(seats, n)) for n in range(SHARD_BLOCKS, seats + SHARD_BLOCKS, SHARD_BLOCKS)]  # after each shard
    plan = []
    for s, q in upto[-1].items() if upto else ():
        goal = min(q * block, have[s] * want[s][1])
        plan.append((s, have[s], goal // have[s], goal % have[s], q, [u[s] for u in upto]))
    plan_df = spark.createDataFrame(plan, "source string, available bigint, passes bigint, rest bigint, quota bigint, upto array<bigint>")

    # places on each source's line of tokens, by a range-partitioned running sum
    order = F.xxhash64("digest", F.lit(seed))
    line = cut(sized.withColumn("h", order).repartitionByRange("source", "h", "doc_id").withColumn("part", F.spark_partition_id()), "line")
    sums = line.groupBy("source", "part").agg(F.sum("n_tokens").alias("n"))
    ahead = sums.withColumn("ahead", F.sum("n").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1))).select("source", "part", F.coalesce("ahead", F.lit(0)).alias("ahead"))
    run = line.withColumn("upto_here", F.sum("n_tokens").over(W.partitionBy("source", "part").orderBy("h", "doc_id").rowsBetween(W.unboundedPreceding, 0)))
    placed = run.join(ahead, ["source", "part"]).withColumn("middle", F.col("ahead") + F.col("upto_here") - F.col("n_tokens") / 2)
    placed = placed.join(F.broadcast(plan_df), "source").withColumn("more", F.col("middle") < F.col("rest"))  # one row per target
    placed = cut(placed.select("doc_id", "source", "n_tokens", "middle", "more"), "placed")

    # the text that mends what is lacking (not used in the last pass) or too much (used in it)
    got = {r["source"]: r["n"] or 0 for r in placed.groupBy("source").agg(F.sum(F.when(F.col("more"), F.col("n_tokens"))).alias("n")).collect()}
    gaps = spark.createDataFrame([(p[0], p[3] - got.get(p[0], 0)) for p in plan], "source string, gap bigint")
    off = F.abs(F.col("n_tokens") - F.abs("gap"))
    fits = placed.join(F.broadcast(gaps), "source").filter(((F.col("gap") > 0) & ~F.col("more") | (F.col("gap") < 0) & F.col("more")) & (off < F.abs("gap")))
    mend = fits.groupBy("source").agg(F.min(F.struct(off.alias("off"), "doc_id")).alias("b")).select("source", F.col("b.doc_id").alias("mend_id")).collect()
    plan_df = plan_df.join(spark.createDataFrame([(r["source"], r["mend_id"]) for r in mend], f"source string, mend_id {docs.schema['doc_id'].dataType.simpleString()}"), "source", "left")

    chosen = placed.join(F.broadcast(plan_df), "source").withColumn("more", F.col("more") != F.coalesce(F.col("doc_id") == F.col("mend_id"), F.lit(False)))
    chosen = chosen.withColumn("uses", (F.col("passes") + F.col("more").cast("int")).cast("int")).filter("uses > 0")
    seat = lambda i: F.least(F.floor((i * F.col("available") + F.col("middle")) / F.lit(block)), F.col("quota") - 1)
    shards = F.transform(F.sequence(F.lit(0), F.col("uses") - 1), lambda i: F.size(F.filter("upto", lambda u: u <= seat(i))))
    chosen = cut(chosen.select("doc_id", "source", "n_tokens", "uses", shards.alias("shards")), "chosen")
    used = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("used_tokens"), F.max("uses").alias("most_uses"))
    sums_df = spark.createDataFrame([(s, int(n)) for s, n in have.items()], "source string, available_tokens bigint")
    shares = targets.select("source", "target_share", "max_repeats").join(sums_df, "source", "left").join(plan_df.select("source", F.col("quota").alias("quota_blocks")), "source", "left").join(used, "source", "left").fillna(0, ["available_tokens", "quota_blocks", "used_tokens", "most_uses"])
    all_used = F.sum("used_tokens").over(W.partitionBy(F.lit(1)))  # one row per target
    return chosen, shares.withColumn("actual_share", F.when(all_used > 0, F.col("used_tokens") / all_used).otherwise(F.lit(0.0)))


def shard_shares(chosen: DataFrame) -> DataFrame:
    """(shard, source, used_tokens, share): what each output shard holds of each source."""
    uses = chosen.select("source", "n_tokens", F.explode("shards").alias("shard")).groupBy("shard", "source").agg(F.sum("n_tokens").alias("used_tokens"))
    return uses.withColumn("share", F.col("used_tokens") / F.sum("used_tokens").over(W.partitionBy("shard")))  # one row per shard and target
