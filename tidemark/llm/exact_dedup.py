"""Exact de-duplication with a heavy-hitter split. Built-in functions only.

1. One pass over the texts writes (id, SHA-256, row number) to the shared folder.
2. ``freqItems`` (the frequent-element count of Misra and Gries, as rediscovered by Karp, Shenker and
   Papadimitriou) names at most ``1 / support`` digests, among them every digest that holds more than
   ``support`` of all rows.
3. The winners of these candidates are verified by an exact count with map-side partial sums: candidates that
   do not repeat are dropped from the list. The list is broadcast; its length is bounded by
   ``1 / support`` whatever the input.
4. Rows of verified digests learn their winner map-side and are never shuffled. All other digests, each with
   at most ``support`` of the rows, go through one shuffle.

Defined results: a NULL text counts as the empty text. The row with the largest id stays, NULL ids last; of rows that
repeat id and text one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.llm.common import col, free_name, text_of, written

#: Digests with a larger share of the rows are removed map-side; at most 1 / SUPPORT digests are broadcast.
SUPPORT = 1 / 1024


def frequent(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(digest, top, n) of the verified frequent digests of (id, digest, row): the winner and the exact count."""
    candidates = rows.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    return written(rows.join(F.broadcast(candidates), "digest")
                   .groupBy("digest").agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("n"))
                   .filter("n > 1").coalesce(1), "dedup-winners")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    rows = written(docs.select(col(id_col).alias("id"), F.sha2(text_of(text_col), 256).alias("digest"),
                               F.monotonically_increasing_id().alias("row")), "dedup-digests")
    marked = rows.join(F.broadcast(frequent(rows, support)), "digest", "left")
    heavy = marked.filter("top is not null").select(
        "id", F.col("top.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("top.row")).alias("kept"), "digest")
    group = W.partitionBy("digest")
    top = F.max(F.struct("id", "row")).over(group)
    light = marked.filter("top is null").select(
        "id", top.getField("id").alias("keep_id"), F.count("*").over(group).alias("group_size"),
        (F.col("row") == top.getField("row")).alias("kept"), "digest")
    return heavy.unionByName(light).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                support: float = SUPPORT) -> DataFrame:
    """The rows that stay, with all their columns; of rows that repeat the winner's id and text, one of them.

    Losers of frequent digests leave before anything is shuffled. What remains is shuffled by digest once, and each
    task sends on one row of a digest only.
    """
    digest, winner, nth = (free_name(docs, x) for x in ("_digest", "_winner", "_nth"))
    keyed = docs.withColumn(digest, F.sha2(text_of(text_col), 256))
    rows = written(keyed.select(col(id_col).alias("id"), F.col(digest).alias("digest"),
                                F.monotonically_increasing_id().alias("row")), "dedup-digests")
    winners = frequent(rows, support).select(F.col("digest").alias(digest), F.struct("top.id").alias(winner))
    left = keyed.join(F.broadcast(winners), digest, "left").filter(
        F.col(winner).isNull() | col(id_col).eqNullSafe(F.col(f"{winner}.id")))
    first = W.partitionBy(digest).orderBy(col(id_col).desc_nulls_last())
    return (left.withColumn(nth, F.row_number().over(first)).filter(F.col(nth) == 1)
            .select(*[col(c) for c in docs.columns]))
