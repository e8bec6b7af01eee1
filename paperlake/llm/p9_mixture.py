"""Problem 9: a mixture of sources with given shares of the tokens, small sources repeated up to a cap.

Sainte-Laguë apportionment: the mixture is cut into blocks of equal tokens; block after block goes to the source
with the highest quotient of share and blocks already held, as long as its documents, repeated up to their cap,
can fill it. A source's blocks are apportioned to its shards in the same way. Within a shard the documents come
in a seeded order: whole passes first, then a beginning of the order up to the quota.

The size is the largest at which every source that has documents reaches its share, unless a size is given.
Sources without documents, and documents of sources without target, give nothing; null and empty texts have no
tokens and are left out. Repeated ids count once. Where a cap binds, its blocks go to the other sources, and
the report shows it.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .p8_tokens import encoded
from .work import Work

BLOCKS = 20_000  # blocks of a mixture
TARGETS = 10_000  # more sources with a target are refused: their shares are apportioned on the driver
SHARD_DOCS = 20_000  # documents of a shard, about; shards bound what one task orders
SEED = 17


def sainte_lague(weights: dict, capacity: dict, blocks: int) -> dict:
    """Blocks of each key: highest quotients weight / (2 held + 1), ties by key, never more than its capacity."""
    held = {k: 0 for k in weights}
    heap = [(-w, str(k), k) for k, w in weights.items() if w > 0 and capacity.get(k, 0) > 0]
    heapq.heapify(heap)
    while blocks and heap:
        _, name, k = heapq.heappop(heap)
        held[k] += 1
        blocks -= 1
        if held[k] < capacity[k]:
            heapq.heappush(heap, (-weights[k] / (2 * held[k] + 1), name, k))
    return held


def source_blocks(have: dict, targets: dict, total: int | None) -> tuple[dict, int]:
    """have {source: tokens}, targets {source: (share, repeats)} -> blocks of each source, tokens of a block."""
    live = {s: (w, r) for s, (w, r) in targets.items() if have.get(s, 0) > 0 and w > 0 and r > 0}
    if not live:
        return {}, 1
    weight = sum(w for w, _ in live.values())
    if total is None:
        total = int(min(have[s] * r * weight / w for s, (w, r) in live.items()))
    block = max(1, total // BLOCKS)
    capacity = {s: have[s] * r // block for s, (_, r) in live.items()}
    return sainte_lague({s: w for s, (w, _) in live.items()}, capacity, total // block), block


def shard_quotas(mine: dict, blocks: int, block: int, repeats: int) -> dict:
    """mine {shard: tokens} of one source -> tokens of each shard: its blocks by the same apportionment."""
    got = sainte_lague(mine, {k: t * repeats // block for k, t in mine.items()}, blocks)
    rest = (blocks - sum(got.values())) * block  # what whole blocks can't hold in any shard goes where there is room for tokens
    out = {}
    for k in sorted(mine):
        more = min(rest, mine[k] * repeats - got[k] * block)
        out[k] = got[k] * block + more
        rest -= more
    return out


def mixture(docs: DataFrame, targets: DataFrame, work: Work, total: int | None = None, seed: int = SEED) -> DataFrame:
    """docs (doc_id, source, text) -> (doc_id, source, tokens, copies), copies >= 1."""
    spark = docs.sparkSession
    rows = targets.where("source is not null").groupBy("source").agg(F.max("target_share"), F.max("max_repeats")).limit(TARGETS + 1).collect()
    if len(rows) > TARGETS:
        raise ValueError(f"more than {TARGETS} sources have a target")
    goal = {r[0]: (r[1] or 0.0, r[2] or 0) for r in rows}
    mine = docs.join(F.broadcast(targets.select("source").distinct()), "source", "left_semi").where("doc_id is not null and length(text) > 0")
    counted = encoded(mine, counts=True, keep=("source",)).where("tokens > 0").dropDuplicates(["doc_id"])
    counted = work.table(counted, "counted")
    shards = max(1, counted.count() // SHARD_DOCS)
    at = counted.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(shards)).cast("int"))
    sizes = work.table(at.groupBy("source", "shard").agg(F.sum("tokens").alias("size")), "sizes")
    have = {r[0]: r[1] for r in sizes.groupBy("source").agg(F.sum("size")).collect()}  # a row for each source with a target
    blocks, block = source_blocks(have, goal, total)
    told = spark.createDataFrame([(s, n, goal[s][1]) for s, n in blocks.items()], "source string, blocks long, repeats long")

    def apportion(g):  # one row per shard of a source: its documents / SHARD_DOCS
        q = shard_quotas(dict(zip(g["shard"].tolist(), g["size"].tolist())), int(g["blocks"].iloc[0]), block, int(g["repeats"].iloc[0]))
        g["passes"] = [int(q[k] // n) for k, n in zip(g["shard"], g["size"])]
        g["rest"] = [int(q[k] % n) for k, n in zip(g["shard"], g["size"])]
        return g[["source", "shard", "passes", "rest"]]

    plan = work.table(sizes.join(F.broadcast(told), "source").groupBy("source").applyInPandas(apportion, "source string, shard int, passes long, rest long"), "plan")
    order = Window.partitionBy("source", "shard").orderBy("u", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    x = at.join(plan, ["source", "shard"]).withColumn("u", F.xxhash64(F.lit(seed + 1), "doc_id"))
    x = x.withColumn("till", F.sum("tokens").over(order))
    # a document belongs to the last pass if its middle does
    copies = F.col("passes") + (F.col("till") * 2 - F.col("tokens") < F.col("rest") * 2).cast("long")
    return x.select("doc_id", "source", "tokens", copies.cast("int").alias("copies")).where("copies > 0")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, docs, tokens, max_copies, actual_share) of every target."""
    got = mixed.groupBy("source").agg(F.sum("copies").alias("docs"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("max_copies"))
    x = targets.select("source", "target_share").join(got, "source", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    all_tokens = F.sum(zero("tokens")).over(Window.partitionBy(F.lit(1)))  # as many rows as targets
    return x.select("source", "target_share", zero("docs").alias("docs"), zero("tokens").alias("tokens"), zero("max_copies").alias("max_copies"), (zero("tokens") / F.greatest(all_tokens, F.lit(1))).alias("actual_share"))


def _mix(spark: SparkSession, sf: str):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")
    targets = spark.read.parquet(f"{sf}/mix_targets.parquet")
    return mixture(docs, targets, Work(spark, "p9")), targets


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, source, tokens, copies) of the mixture."""
    return _mix(spark, sf)[0]


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual shares."""
    return shares(*_mix(spark, sf))
