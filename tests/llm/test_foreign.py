"""Texts in scripts that no learned language uses leave the pipeline, however few languages there are."""

import corpus_pipeline as pipeline
from tests.llm.models import DOCS


def test_foreign_scripts_are_rejected(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(-1, "東京都 中文文本", "zh", "a", 8), (-2, "дом и дерево", "ru", "a", 12)], DOCS)
    odd = odd.selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars")
    kept = dict(pipeline.STAGES)["language ID"](spark, docs.select(*odd.columns).unionByName(odd), sf)
    assert kept.filter("doc_id < 0").count() == 0 and kept.count() == docs.count()
