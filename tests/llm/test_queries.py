"""Each registered query over its whole table at the smallest scale."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.compare import compare, connect
from tests.llm import models
from tidemark.llm import chat
from tidemark.llm.queries import REGISTRY


@pytest.fixture(scope="module")
def documents(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def run(spark, sf, name):
    return REGISTRY[name][0](spark, sf)


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in REGISTRY.items() if sql))
def test_sql(spark, sf, name):
    fn, sql = REGISTRY[name]
    problem, rows, _ = compare(spark, connect(sf), fn, sql, sf)
    assert problem is None and rows, problem


def test_thirteen_operators_are_registered():
    import __spark_entry__ as entry
    assert [n for i in range(1, 14) for n in REGISTRY if n.startswith(f"op{i}_")] == sorted(
        REGISTRY, key=lambda n: int(n[2:].split("_")[0]))
    assert "pipeline" in entry.queries() and len(REGISTRY) == 13


def test_chat(spark, sf):
    said = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    want, turns = models.conversations(rows), models.ordered(rows)
    got = {r[0]: tuple(r)[1:] for r in run(spark, sf, "op2_chat").collect()}
    assert got == {c: (*want[c], models.formatted_chars(turns[c], chat.BUDGET, chat.HISTORY, chat.SEGMENT)) for c in want}


def test_ann(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = defaultdict(list)
    for r in run(spark, sf, "op4_ann").orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    assert sorted(got) == sorted(i for i in ids.tolist() if i % 20 == 0)
    hits = 0
    for q, found in got.items():
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        best = np.lexsort((ids, -s))[:20]
        hits += len({r.vec_id for r in found} & set(ids[best].tolist()))
        assert [r["rank"] for r in found] == list(range(1, 21))
        assert all(abs(r.score - s[ids == r.vec_id][0]) < 1e-12 for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
    assert hits >= 0.9 * 20 * len(got)


def test_sharding(spark, sf, documents):
    got = run(spark, sf, "op5_sharding").collect()
    want = {d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _, _ in documents}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.slot, r.shard))] != sorted(want)


def test_mixing(spark, sf, documents):
    got = run(spark, sf, "op6_mixing").collect()
    size = {d: len(models.WORD.findall(t or "")) for d, t, _, _ in documents}
    source = {d: s for d, _, _, s in documents}
    sizes, taken = Counter(), Counter()
    for d, n in size.items():
        sizes[source[d]] += n
    want = models.mix_targets(sizes)
    for r in got:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (size[r.doc_id], sizes[s])
        assert r.target == pytest.approx(want[s]) and r.taken <= 3 * r["size"]
        taken[s] += r.taken
    longest = {s: max(n for d, n in size.items() if source[d] == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6 for s in sizes)
    assert {r.doc_id: r.taken for r in run(spark, sf, "op6_mixing").collect()} == {r.doc_id: r.taken for r in got}


def test_token_counts(spark, sf, documents, library):
    want = {d: len(library.encode(t or "", add_special_tokens=False).ids) for d, t, _, _ in documents}
    for r in run(spark, sf, "op7_token_counts").collect():
        assert (r.n_tokens, r.over_limit) == (want[r.doc_id], want[r.doc_id] > 2048)


def test_simhash(spark, sf, documents):
    prints = [(d, models.fingerprint(t)) for d, t, _, _ in documents]
    component = models.linked(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, sf, "op8_simhash").collect()}
    assert got == {d: (f"{fp:016x}", component[fp]) for d, fp in prints}


def test_bpe(spark, sf, documents, library):
    got = {r.doc_id: tuple(r)[1:4] for r in run(spark, sf, "op9_bpe").collect()}
    for d, t, _, _ in documents:
        ids = library.encode(t or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        assert got[d] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(said.encode()).hexdigest())


def test_langid(spark, sf, documents):
    lang = {d: x for d, _, x, _ in documents}
    got = run(spark, sf, "op10_langid").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(documents) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held) > 0
