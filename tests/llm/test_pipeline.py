"""The pipeline against a plain version of each stage, fed with what the stage before has kept."""

import hashlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tests.llm import models
from tests.llm.models import AWKWARD, DOCS
from tidemark.llm import langid, mixing

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return [tuple(r) for r in df.collect()]


def check(spark, docs, sf):
    """Run every stage on the written result of the last; returns the rows after each."""
    stages, out = dict(pipeline.STAGES), []
    model = langid.fit(docs.filter(~langid.is_held_out()))
    judged = {(r.doc_id, r.text): r for r in langid.predict(docs, model).collect()}
    kept = stages["language ID"](spark, docs, sf).cache()
    assert kept.columns == docs.columns
    assert Counter(rows(kept)) == Counter(r for r in rows(docs) if judged[r[0], r[1]].lang_pred != "und"
                                          and judged[r[0], r[1]].score >= pipeline.LEAST_SCORE)
    out.append(rows(kept))
    single = stages["exact dedup"](spark, kept, sf).cache()
    best = {}
    for r in rows(kept):
        if r[1] not in best or (r[0] is not None and (best[r[1]] is None or r[0] > best[r[1]])):
            best[r[1]] = r[0]
    assert Counter((r[0], r[1]) for r in rows(single)) == Counter((d, t) for t, d in best.items())
    out.append(rows(single))
    apart = stages["SimHash near-dedup"](spark, single, sf).cache()
    prints = [(r[0], models.fingerprint(r[1])) for r in rows(single)]
    least = models.linked(prints)
    left = Counter(rows(apart))
    assert not left - Counter(rows(single))
    # one row of each component: its smallest id, or NULL if all are
    at = {(d, t): least[fp] for (d, t, *_), (_, fp) in zip(rows(single), prints)}
    groups = models.components_of([fp for _, fp in prints])
    assert sum(left.values()) == len(set(groups.values()))
    assert all(r[0] == at[r[0], r[1]] for r in left)
    assert len({groups[models.fingerprint(r[1])] for r in left}) == len(set(groups.values()))
    out.append(rows(apart))
    mixed = stages["mixing"](spark, apart, sf).cache()
    assert mixed.columns == docs.columns
    draws = mixing.mix(apart).collect()
    assert Counter(rows(mixed)) == Counter({tuple(r[n] for n in NAMES): len(r.draws) for r in draws if r.draws})
    sizes = Counter()
    for r in draws:
        sizes[r.source] += len(models.WORD.findall(r.text))
    want = models.mix_targets(sizes)
    assert all(abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source]) for r in draws)
    out.append(rows(mixed))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    final = stages["BPE encoding"](spark, mixed, sf).collect()
    expected = Counter()
    for r in rows(mixed):
        ids = library.encode(r[1], add_special_tokens=False).ids
        expected[r[0], hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in final) == expected
    out.append(final)
    return out


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = check(spark, docs, sf)
    assert len(stages[0]) == docs.count()  # clean documents all stay in the language stage
    assert len(stages[1]) < len(stages[0])
    assert len(pipeline.run(spark, sf).collect()) == len(stages[-1])


def test_stages_on_awkward_rows_and_nothing(spark, sf):
    check(spark, spark.createDataFrame(AWKWARD, DOCS), sf)
    docs = spark.createDataFrame([], DOCS)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0, name
    extra = spark.createDataFrame([(*r, "x", "y") for r in AWKWARD], DOCS + ", score string, shard string")
    for name, stage in pipeline.STAGES[:-1]:
        extra = stage(spark, extra, sf)
        assert extra.columns == [*NAMES, "score", "shard"], name
    assert {(r.score, r.shard) for r in extra.collect()} <= {("x", "y")}
