"""Mixing sources to target weights: exact block quotas, split among output shards by a hypergeometric tree.

Targets. Sources in code-point order (NULL last) weigh 5, 2, 1, 5, 2, ... and share the total size by weight. No target
exceeds ``MOST_EPOCHS`` times its source's size; the excess goes to the other sources by weight until none is
above. That fixpoint is found in closed form: sorted by size per weight, the capped sources are a prefix.

Draws. A source is dealt by a hash into blocks of about equal size; one pass over a source takes its blocks in a
permuted order, each pass in another. A source takes whole passes and then a first part of one more: its quota. The quota
ends inside a block, which is cut the same way: into sub-blocks, and in the last of these document by document, as
close to the target as a document allows. Sums of blocks and sub-blocks come from partial aggregates; no task
ever orders more than a sub-block's documents.

Shards. The tree starts with the quotas of all sources and halves the shards at every node: how many of each source's
blocks go left is a draw without replacement from all blocks of the node (multivariate hypergeometric), so that
quotas add up exactly and each shard is a fair sample of the mix. A shard owns a run of each source's permuted blocks,
disjoint from the others, and is shuffled locally by a seeded hash when written.

The driver holds one row of integers per source, and nothing that follows the number of documents.

Defined results: a NULL text has size 0. Documents that agree in id and text share a place and are taken or left
together. Sources of size 0 have target 0. An empty table gives an empty result. Input columns named like those
that are added are replaced. Everything follows from the seed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.common import col, free_name, text_of, without, written

#: Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: A document is taken at most so often.
MOST_EPOCHS = 3
#: Output shards, and blocks per shard on average (so blocks of all sources are about SHARDS * BLOCKS).
SHARDS, BLOCKS = 64, 256
#: Sub-blocks of a block.
SUB = 4096
#: Multipliers of the block permutations, one a pass: primes above any number of blocks.
PRIMES = (2147483647, 2147483629, 2147483587)

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _number(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def _places(docs: DataFrame, seed: int, id_col: str, text_col: str) -> dict[str, Column]:
    """What a document's place in its source follows from: three numbers of a seeded digest."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(col(id_col).cast("string"), F.lit("")),
                               F.md5(text_of(text_col))))
    return {"h": _number(digest, 1, 8), "sub": _number(digest, 9, 3), "u": _number(digest, 12, 12)}


def _rank(h: Column, blocks: Column, shift: Column, epoch: int) -> Column:
    """The place of a document's block in the permuted order of a pass."""
    return F.pmod(F.lit(PRIMES[epoch % len(PRIMES)]) * (F.pmod(h, blocks) + shift), blocks)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from one row (source, source_size) per source."""
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = ranked.withColumn("weight", weight.cast("long"))
    # ascending by the share at which a source reaches its cap
    order = W.orderBy(F.col("source_size") / F.col("weight"), "rank")
    everything = W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    share = left / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    levelled = weighed.withColumn("share", share).withColumn(
        "free", F.col("share") * F.col("weight") < most * F.col("source_size"))
    level = F.min(F.when(F.col("free"), F.struct(F.col("source_size") / F.col("weight"), "rank", "share"))).over(everything)
    capped = F.least(level["share"] * F.col("weight"), (most * F.col("source_size")).cast("double"))
    return levelled.select("source", "source_size", "weight", "rank", F.coalesce(capped, F.lit(0.0)).alias("target"))


def split_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(sources, shards) block counts: rows sum to the quotas, columns differ by one block at most."""
    out = np.zeros((len(quotas), shards), np.int64)

    def split(node: int, first: int, last: int, have: np.ndarray, before: int):
        if last - first == 1:
            out[:, first] = have
            return
        middle = (first + last) // 2
        total = int(quotas.sum())
        go_left = total * middle // shards - before  # every shard's share of all blocks, rounded down as it adds up
        rng = np.random.default_rng([seed, node])
        left, rest, want = np.zeros_like(have), int(have.sum()), go_left
        for s, n in enumerate(have):  # conditional hypergeometric draws, one source at a time
            rest -= int(n)
            left[s] = rng.hypergeometric(int(n), rest, want) if want and (n or rest) else 0
            want -= int(left[s])
        split(2 * node, first, middle, left, before)
        split(2 * node + 1, middle, last, have - left, before + go_left)

    split(1, 0, shards, quotas.astype(np.int64), 0)
    return out


def plan(docs: DataFrame, seed: int = 11, shards: int = SHARDS, source_col: str = "source", id_col: str = "doc_id",
         text_col: str = "text", weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: its size, target, whole passes, the cut of the last pass, and the shards' shares."""
    spark = docs.sparkSession
    place = _places(docs, seed, id_col, text_col)
    rows = written(docs.select(col(source_col).alias("source"), col(id_col).cast("string").alias("id"),
                               words(text_of(text_col)).alias("size"),
                               *[c.alias(n) for n, c in place.items()]), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = F.sum("source_size").over(W.partitionBy())
    goal = (targets(sizes, weights)
            .withColumn("blocks", F.when(total > 0, F.greatest(F.lit(1), F.expr(
                f"source_size * {shards * BLOCKS}L div sum(source_size) over (partition by 1)"))).otherwise(1).cast("long"))
            .withColumn("shift", _number(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce("source", F.lit("")))), 1, 6))
            .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                        .otherwise(0).cast("long"))
            .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")))
    goal = written(goal, "mix-goals")
    cut = F.struct
    known = F.col("source").eqNullSafe(F.col("g_source"))

    def named(df):
        return df.withColumnRenamed("source", "g_source")

    rank = F.lit(None).cast("long")
    for e in range(MOST_EPOCHS):
        rank = F.when(F.col("passes") == e, _rank(F.col("h"), F.col("blocks"), F.col("shift"), e)).otherwise(rank)
    open_ = goal.filter("rest > 0").select("source", "blocks", "shift", "passes", "rest")

    def boundary(sums, keys):
        """The row of each source in which the running sum reaches the rest, and what is left of the rest there."""
        order = W.partitionBy("source").orderBy(keys).rowsBetween(W.unboundedPreceding, -1)
        return (sums.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
                .filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("size")))
                .withColumn("rest", F.col("rest") - F.col("before")).drop("before", "size"))

    at = rows.join(named(open_), known).withColumn("rank", rank)
    blocks = written(boundary(at.groupBy("source", "rest", "blocks", "shift", "passes", "rank")
                              .agg(F.sum("size").alias("size")), "rank"), "mix-blocks")
    inside = (rows.join(named(blocks.withColumnRenamed("rank", "at_rank")), known)
              .withColumn("rank", rank).filter("rank = at_rank"))
    subs = written(boundary(inside.groupBy("source", "rest", "rank", "sub").agg(F.sum("size").alias("size")), "sub")
                   .withColumnRenamed("sub", "at_sub"), "mix-subs")
    last = (inside.drop("rest").join(subs.select(F.col("source").alias("s"), F.col("at_sub"), "rest"),
                                     F.col("source").eqNullSafe(F.col("s")) & (F.col("sub") == F.col("at_sub"))))
    # documents of one place count together
    ties = last.groupBy("source", "u", "id", "rest").agg(F.sum("size").alias("size"))
    order = W.partitionBy("source").orderBy("u", "id").rowsBetween(W.unboundedPreceding, -1)
    taken = (ties.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
             .filter(F.col("before") + F.col("size") / 2 <= F.col("rest"))
             .groupBy("source").agg(F.max(F.struct("u", F.coalesce("id", F.lit("")).alias("id"))).alias("upto")))
    ended = (subs.join(taken.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")), "left")
             .select(F.col("source").alias("c_source"), F.col("rank").alias("cut_rank"), F.col("at_sub").alias("cut_sub"),
                     F.coalesce("upto.u", F.lit(-1)).alias("cut_u"), F.coalesce("upto.id", F.lit("")).alias("cut_id")))
    whole = written(
        goal.join(ended, F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source")
        .withColumn("quota", F.col("passes") * F.col("blocks") + F.coalesce(F.col("cut_rank") + 1, F.lit(0))), "mix-plan")
    quotas = whole.orderBy("rank").select("rank", "quota").toArrow()  # one row per source
    shares = split_tree(quotas.column("quota").to_numpy(), shards, seed)
    ends = np.cumsum(shares, axis=1)
    shared = spark.createDataFrame([(int(r), e.tolist()) for r, e in zip(quotas.column("rank").to_pylist(), ends)],
                                   "r int, shard_ends array<long>")
    return written(whole.join(shared, F.col("rank") == F.col("r")).drop("r", "rank", "weight"), "mix-shards")


def mix(docs: DataFrame, seed: int = 11, shards: int = SHARDS, source_col: str = "source", id_col: str = "doc_id",
        text_col: str = "text", weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """All rows and columns with size, source_size, target and draws: an array of (epoch, shard), one for each time
    that the mix takes the document."""
    docs = without(docs, "size", "source_size", "target", "draws")
    made = plan(docs, seed, shards, source_col, id_col, text_col, weights)
    p = free_name(docs, "_plan")
    whole = made.select(F.struct("*").alias(p))
    placed = docs.withColumn(free_name(docs, "_place"), F.struct(
        *[c.alias(n) for n, c in _places(docs, seed, id_col, text_col).items()]))
    place = placed.columns[-1]
    d = placed.join(whole, col(source_col).eqNullSafe(F.col(f"{p}.source")), "left")
    got = {n: F.col(f"{p}.{n}") for n in made.columns}
    h, sub, u = (F.col(f"{place}.{n}") for n in ("h", "sub", "u"))
    name = F.coalesce(col(id_col).cast("string"), F.lit(""))

    def draw(e):
        rank = _rank(h, got["blocks"], got["shift"], e)
        within = F.struct(rank.alias("a"), sub.alias("b"), u.alias("c"), name.alias("d")) <= F.struct(
            got["cut_rank"].alias("a"), got["cut_sub"].alias("b"), got["cut_u"].alias("c"), got["cut_id"].alias("d"))
        taken = (got["passes"] > e) | ((got["passes"] == e) & got["cut_rank"].isNotNull() & within)
        place_in_quota = got["blocks"] * e + rank
        shard = F.size(F.filter(got["shard_ends"], lambda x: x <= place_in_quota))
        return F.when(taken, F.struct(F.lit(e).alias("epoch"), shard.alias("shard")))

    draws = F.filter(F.array(*[draw(e) for e in range(MOST_EPOCHS)]), lambda x: x.isNotNull())
    return d.select(*[col(c) for c in docs.columns], words(text_of(text_col)).alias("size"),
                    got["source_size"].alias("source_size"), got["target"].alias("target"), draws.alias("draws"))


def drawn(mixed: DataFrame, seed: int = 11, id_col: str = "doc_id") -> DataFrame:
    """One row for each draw, with epoch, shard and the seeded order inside the shard."""
    draw = free_name(mixed, "_draw")
    each = mixed.withColumn(draw, F.explode("draws"))
    rest = without(mixed, "draws", "epoch", "shard", "shard_order").columns
    epoch = F.col(f"{draw}.epoch")
    return each.select(*[col(c) for c in rest], epoch.alias("epoch"), F.col(f"{draw}.shard").alias("shard"),
                       F.xxhash64(F.lit(seed), col(id_col), epoch).alias("shard_order"))


def write_mix(rows: DataFrame, path: str, files_per_shard: int = 4) -> None:
    """Write one folder per shard, shuffled locally: sorted by the seeded order."""
    part = F.pmod(F.col("shard_order"), F.lit(files_per_shard))
    (rows.repartition("shard", part).sortWithinPartitions("shard", "shard_order")
     .write.partitionBy("shard").parquet(path))
