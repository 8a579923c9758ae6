"""The training-data pipeline over documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, exact_dedup, langid, mixing, simhash
from tidemark.llm.common import col, written
from tidemark.llm.queries import token_digests, vocabulary

#: Documents without letters go, those in scripts that no learned language uses, and those of which less than this share is in any one language for sure.
LEAST_SCORE = 0.1
#: Words that a worker remembers: fewer than the operators alone would, as all stages share the executors.
REMEMBER = 150_000
#: Pieces of a mixed shard, each shuffled on its own.
PIECES = 256


def numbered(docs: DataFrame):
    """The table with columns c0, c1, ..., which clash with no operator's; where each column is; and the way back."""
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return (docs.select(*[col(name).alias(c) for name, c in at.items()]), at,
            lambda df: df.select(*[F.col(c).alias(name) for name, c in at.items()]))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that was learned; the columns are those of the input."""
    model = langid.fit(docs.filter(~langid.is_held_out()))
    rows, at, back = numbered(docs)
    judged = langid.predict(rows, model, at["text"], remember=REMEMBER)
    return back(judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the row with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints keep the row with the smallest id."""
    return simhash.keep_one(docs, shingle=3, most=2, seed=42)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix draws them, shard by shard in shuffled order; one that is taken twice is there twice."""
    rows, at, back = numbered(docs)
    mixed = mixing.mix(rows, source_col=at["source"], id_col=at["doc_id"], text_col=at["text"])
    taken = mixing.drawn(mixed.select(*at.values(), "draws"), id_col=at["doc_id"])
    # many pieces of each shard, so that a task's share follows the number of tasks and not that of shards
    piece = F.pmod(F.col("shard_order"), F.lit(PIECES))
    return back(taken.repartition(F.col("shard"), piece).sortWithinPartitions("shard", "shard_order"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, token ids, and the digests of the ids and of what they decode to."""
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), vocabulary(), decoded_col="decoded",
                         remember=REMEMBER)
    return encoded.select("doc_id", "source", "token_ids", *token_digests())


STAGES = [("language ID", language), ("exact dedup", exact_copies), ("SimHash near-dedup", near_copies),
          ("mixing", mixture), ("BPE encoding", tokens)]

#: Language scores and fingerprints are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
