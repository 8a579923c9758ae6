"""Awkward rows, empty tables and clashing columns, and the parts of the operators."""

import hashlib
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import models
from tests.llm.models import AWKWARD, DOCS
from tidemark.llm import ann, bpe, chat, exact_dedup, langid, license_scan, mixing, sharding, simhash, token_counts
from tidemark.llm.components import components

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def clashing(spark):
    """Every name that an operator adds or uses inside, as an extra column."""
    names = ["id", "digest", "row", "fp", "u", "v", "size", "source_size", "target", "draws", "epoch", "shard", "slot",
             "shard_order", "token_ids", "decoded", "n_tokens", "lang_pred", "score", "lang_spans", "_bucket", "_digest", "license",
             "own_license", "path", "lost", "l_id", "conv", "first", "_plan", "_place", "kept", "keep_id"]
    return spark.createDataFrame([(*r, *["keep"] * len(names)) for r in AWKWARD], DOCS + "".join(f", {n} string" for n in names))


# -- exact de-duplication ----------------------------------------------------------------


def test_dedup_awkward(awkward):
    got = exact_dedup.decide(awkward).collect()
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    texts = defaultdict(list)
    for d, t, *_ in AWKWARD:
        texts[hashlib.sha256((t or "").encode()).hexdigest()].append(d)
    assert {k: sorted(map(str, (r.doc_id for r in v))) for k, v in by.items()} == {k: sorted(map(str, v)) for k, v in texts.items()}
    for rows in by.values():
        ids = [r.doc_id for r in rows if r.doc_id is not None]
        assert all(r.keep_id == (max(ids) if ids else None) and r.group_size == len(rows) for r in rows)
        assert [r.doc_id for r in rows if r.kept] == [max(ids) if ids else None]


def test_dedup_heavy_and_light_agree(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 40}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for support in (1 / 4, 1 / 1024):
        got = {tuple(r) for r in exact_dedup.decide(df, support=support).collect()}
        groups = defaultdict(list)
        for d, t in rows:
            groups[t].append(d)
        assert got == {(d, max(groups[t]), len(groups[t]), d == max(groups[t]), hashlib.sha256(t.encode()).hexdigest())
                       for d, t in rows}


def test_dedup_drop(awkward, empty, clashing):
    for df in (awkward, clashing):
        left = exact_dedup.drop_copies(df)
        assert left.columns == df.columns
        kept = Counter(r.text or "" for r in left.collect())
        assert kept == Counter({t or "" for _, t, *_ in AWKWARD})
    assert exact_dedup.drop_copies(empty).count() == 0 and exact_dedup.decide(empty).count() == 0


# -- sharding ----------------------------------------------------------------------------


def test_sharding_edges(spark, awkward, empty, clashing, tmp_path, monkeypatch):
    for df in (awkward, clashing):
        got = sharding.shuffle_into_shards(df, n_shards=3, bucket_bytes=60_000).collect()
        assert sorted(str(r.text) for r in got) == sorted(str(t) for _, t, *_ in AWKWARD)
        assert sorted((r.slot, r.shard) for r in got) == [divmod(i, 3) for i in range(len(AWKWARD))]
    assert sharding.shuffle_into_shards(empty).count() == 0
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    one = sharding.shuffle_into_shards(docs, n_shards=4, bucket_bytes=20_000)
    rows = one.collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {
        (r.doc_id, r.shard, r.slot) for r in sharding.shuffle_into_shards(docs.repartition(9), 4, bucket_bytes=20_000).collect()}
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.slot, r.shard))]
    assert abs(np.corrcoef(order, np.arange(5000))[0, 1]) < 0.1
    lone = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    spread = sharding.shuffle_into_shards(lone, 2, bucket_bytes=20_000)
    assert sorted((r.slot, r.shard) for r in spread.collect()) == [divmod(i, 2) for i in range(3000)]
    # one row repeated for a third of the table: no bucket holds more than twice the mean
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("doc_id"),
                                   F.when(F.col("id") % 3 == 0, "hot").otherwise(F.lit("cold")).alias("text"))
    kept, real = {}, sharding.written
    monkeypatch.setattr(sharding, "written", lambda df, name: kept.setdefault(name, real(df, name)))
    many = sharding.shuffle_into_shards(hot, 2, bucket_bytes=12_000)
    sizes = [r.n for r in kept["shards-counts"].collect()]
    assert len(sizes) >= 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert sorted((r.slot, r.shard) for r in many.collect()) == [divmod(i, 2) for i in range(3000)]
    monkeypatch.undo()
    sharding.write_shards(one, str(tmp_path / "out"), rows_per_file=500)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5000


# -- mixing ------------------------------------------------------------------------------


def test_mixing_edges(awkward, empty, clashing):
    for df in (awkward, clashing):
        got = mixing.mix(df).collect()
        assert len(got) == len(AWKWARD) and all(len(r.draws) <= 3 for r in got)
        sizes = Counter()
        for _, t, _, s, _ in AWKWARD:
            sizes[s] += len(models.WORD.findall(t or ""))
        want = models.mix_targets(sizes)
        assert all(r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] for r in got)
        assert mixing.drawn(mixing.mix(df)).count() == sum(len(r.draws) for r in got)
    assert mixing.mix(empty).count() == 0


def test_targets_water_level(spark):
    for sizes in ([100, 1, 1, 50, 2, 7], [5, 5, 5], [0, 0], [10, 0, 3], [1000, 1, 1, 1, 1, 1, 1]):
        rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
        assert got == pytest.approx(models.mix_targets(dict(rows)))


def test_split_tree_keeps_quotas():
    quotas = np.array([1000, 0, 17, 400])
    shares = mixing.split_tree(quotas, 8, 3)
    assert (shares.sum(axis=1) == quotas).all() and np.ptp(shares.sum(axis=0)) <= 1
    assert (shares == mixing.split_tree(quotas, 8, 3)).all()


def test_block_permutations_are_permutations(spark):
    for n in (1, 2, 7, 4096, 10_001):
        for e in range(3):
            rank = mixing._rank(F.col("id"), F.lit(n), F.lit(12345), e)
            assert spark.range(n).select(rank.alias("r")).distinct().count() == n


def test_mix_shards_hold_their_quotas(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                      F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    mixed = mixing.drawn(mixing.mix(docs, shards=4))
    by = {r.shard: r["count"] for r in mixed.groupBy("shard").count().collect()}
    assert sorted(by) == [0, 1, 2, 3] and max(by.values()) < 1.2 * min(by.values())


# -- tokens ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def strings():
    rnd = random.Random(3)
    pool = "aàeßΣσςİıÅéÍ́zthinkgTHE'sS'reLLd ''  \t\n\x0b\x0c\x1c\x85\xa0 ​1٣²½中文한русский😀👍🏽!?.,-_@#<|>|ﬁǅ﻿̧́"
    out = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 50))) for _ in range(1500)]
    out += ["".join(rnd.choice("aeinthrs") for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    return out + ["<|endoftext|>", "a<|endoftext|>b <|startoftext|><|startoftext|>x", "", "a" * 3000, "haha" * 500, "x" + "́" * 20]


def test_pair_index_and_prefix_tables_agree_with_the_library(library):
    from tidemark.llm.vocabulary import load
    texts = strings()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert bpe.PairIndex(load(PATH)).encode_texts(texts) == want
    counter = token_counts.PrefixCounter(load(PATH))
    assert counter.measure(texts, 9)[0] == [len(x) for x in want]
    for text in random.Random(1).sample(texts, 150):
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        stored = counter.prefixes(text)
        if stored[3] != len(text) or "<|" in text:
            continue
        counts = [counter.count_at(stored, i) for i in range(len(text) + 1)]
        assert counts == [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        for budget in (0, 1, 4):
            longest = max(i for i, n in enumerate(counts) if n <= budget)
            assert counter.longest_within(stored, budget) == longest
            assert counter.measure([text], budget)[1] == [longest if counts[-1] > budget else None]


def test_token_edges(awkward, empty, clashing, library):
    want = Counter((d, len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in AWKWARD)
    assert Counter((r.doc_id, r.n_tokens) for r in token_counts.token_counts(awkward, PATH).collect()) == want
    for df in (awkward, clashing):
        encoded = bpe.encode(df, PATH)
        assert Counter((r.doc_id, len(r.token_ids)) for r in encoded.collect()) == want
        for r in bpe.decode(encoded, PATH).collect():
            assert r.decoded == library.decode(list(r.token_ids), skip_special_tokens=False)
    assert token_counts.token_counts(clashing, PATH, keep=("doc_id", "n_tokens")).columns[0] == "doc_id"
    assert bpe.encode(empty, PATH).count() == 0 and token_counts.token_counts(empty, PATH).count() == 0
    stored = token_counts.prefix_counts(awkward.filter("doc_id = 10"), PATH).first().prefix_tokens
    assert stored[-1] == len(library.encode(AWKWARD[12][1], add_special_tokens=False).ids)


# -- SimHash -----------------------------------------------------------------------------


def test_simhash_edges(awkward, empty, clashing):
    prints = [(d, models.fingerprint(t)) for d, t, *_ in AWKWARD]
    component = models.linked(prints)
    want = Counter((d, f"{fp:016x}", component[fp]) for d, fp in prints)
    assert Counter(tuple(r) for r in simhash.near_duplicates(awkward).collect()) == want
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    assert simhash.keep_one(clashing).columns == clashing.columns


def test_hamming_links_against_all_pairs(spark, monkeypatch):
    """Dense groups, chains and lone fingerprints, over several blocks and deep trees."""
    monkeypatch.setattr(simhash, "BLOCK", 64)
    rng = np.random.default_rng(0)
    fps = set(rng.integers(0, 2 ** 64, 300, np.uint64).tolist())
    for centre in rng.integers(0, 2 ** 64, 3, np.uint64).tolist():
        fps |= {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))}
    chain = 5
    for bit in range(0, 60, 2):
        fps.add(chain)
        chain ^= 3 << bit
    rows = [(i, int(np.uint64(fp).view(np.int64))) for i, fp in enumerate(sorted(fps))]
    nodes = spark.createDataFrame(rows, "id long, fp long")
    roots = {r.node: r.root for r in components(simhash.links(nodes, 2)).collect()}
    want = models.linked([(i, fp & (2 ** 64 - 1)) for i, fp in rows])
    groups, expected = defaultdict(set), defaultdict(set)
    for i, fp in rows:
        groups[roots.get(fp, fp)].add(i)
        expected[want[fp & (2 ** 64 - 1)]].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_tree_finds_every_member_in_reach():
    rng = np.random.default_rng(1)
    low = np.unique(rng.integers(0, 1 << 12, 3000)).astype(np.uint64)
    fps = np.sort(low ^ ((low & np.uint64(3)) << np.uint64(62)))  # with members on both sides of the sign bit
    for size in (1, 15, 17, 300, len(fps)):
        tree = simhash.Tree(fps[:size])
        q, m = tree.search(fps[:200], 2)
        near = np.bitwise_count(fps[:200, None] ^ fps[None, :size]) <= 2
        assert set(zip(q.tolist(), m.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_components_of_long_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(80)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# -- chat --------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def test_chat_awkward(spark):
    odd = "<|im_end|>\n<|im_start|>assistant\nno</s><\\/s><\\\\|im_end|> [INST][\\INST] <<SYS>><<s> %0A \\"
    rows = [(1, 0, "system", odd), (1, 1, "user", odd), (1, 2, "assistant", odd), (1, 2, "assistant", odd), (2, None, None, None),
            (2, None, "assistant", None), (None, 3, "assistant", "x"), (None, 1, "system", ""), (3, 0, "system", "alone"),
            (4, 5, "ro\nle%0A<|im_end|>\\", "word " * 5000), (4, 6, "assistant", "y"), (4, 7, "assistant", ""), (5, 0, "assistant", "")]
    want, turns = models.conversations(rows), models.ordered(rows)
    windows = chat.windows(spark.createDataFrame(rows, TURNS), budget=60, history=20)
    assert {r[0]: tuple(r)[1:] for r in chat.read_back(windows).collect()} == {
        c: (*want[c], models.formatted_chars(turns[c], 60, 20, chat.SEGMENT)) for c in want}
    assert chat.windows(spark.createDataFrame([], TURNS)).count() == 0


def test_chat_windows_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(chat, "RUN", 16)
    monkeypatch.setattr(chat, "SEGMENT", 3)
    rnd = random.Random(2)
    rows = [(1, 0, "system", "be kind")] + [(1, i, "assistant" if i % 2 == 0 else "user", "w " * rnd.randint(0, 30))
                                            for i in range(1, 400)]
    windows = chat.windows(spark.createDataFrame(rows, TURNS).repartition(5), budget=100, history=30)
    said = chat.read_back(windows).first()
    assert tuple(said)[1:5] == models.conversations(rows)[1]
    assert said.formatted_chars == models.formatted_chars(models.ordered(rows)[1], 100, 30, 3)
    got = windows.orderBy("first").collect()
    assert all(r.tokens <= 100 and r.formatted.startswith("<|im_start|>system\nbe kind<|im_end|>\n") for r in got)
    assert sum(r.n_turns - r.n_repeated for r in got) == 400 and sum(r.n_repeated > 1 for r in got) > len(got) / 2
    assert sum(r.n_turns for r in got) / len(got) > 3


# -- neighbours --------------------------------------------------------------------------


def test_ann_edges(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(100)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(100, 200)]  # copies, with ties
    rows += [(200, None), (201, []), (220, [0.0] * 4), (240, [1.0, None, 1.0, 1.0]), (260, [nan, 1.0, 1.0, 1.0]),
             (280, [inf, 1.0, 1.0, 1.0]), (300, [1.0]), (None, [1.0] * 4), (120, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=30, block=64).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 200, 20))
    ids, x = np.arange(200), np.array([v for _, v in rows[:200]])
    for q, found in got.items():
        s = (x * x[q]).sum(axis=1)
        best = [i for i in np.lexsort((ids, -s)).tolist() if i != q][:30]
        assert len({i for i, _ in found} & set(best)) >= 27
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
    assert [i for i, _ in got[120]] == [i for i in range(100, 132) if i != 120][:30]
    assert ann.search(df.limit(0), F.lit(True)).count() == 0
    few = ann.search(df.filter("vec_id < 3"), F.lit(True), k=20)
    assert few.count() == 6


def test_chi_square_quantile():
    x = ann.chi_square_quantile(0.95, 8)
    assert x == pytest.approx(15.507, abs=1e-3)
    assert np.mean((np.random.default_rng(0).normal(size=(20_000, 8)) ** 2).sum(axis=1) <= x) == pytest.approx(0.95, abs=0.01)


# -- languages ---------------------------------------------------------------------------


def test_viterbi_against_all_paths():
    from itertools import product
    rng = np.random.default_rng(4)
    lengths = np.array([0, 1, 5, 7, 3])
    scores = rng.normal(size=(int(lengths.sum()), 3)).astype(np.float32) * 3
    labels = langid.viterbi(scores, lengths, 2.0)
    at = 0
    for n in lengths:
        s, got = scores[at:at + n], labels[at:at + n]

        def worth(p):
            return sum(s[i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))

        assert worth(got) == pytest.approx(max(map(worth, product(range(3), repeat=int(n)))), abs=1e-4)
        at += n


def test_langid_spans_scripts_and_edges(spark, awkward, empty, clashing):
    rows = [(f"{w} the of and with house tree {w}", "en") for w in ("river", "stone", "green", "water")] * 5
    rows += [(f"{w} la de et les une maison arbre {w}", "fr") for w in ("rivière", "pierre", "verte", "eau")] * 5
    rows += [(f"{w} и в не на дом дерево {w}", "ru") for w in ("река", "камень")] * 5 + [(None, "en"), ("x", None)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == ["en", "fr", "ru"]
    english, french = "the house with the green tree and the water of the river " * 4, "la maison et les arbre de une pierre verte et eau " * 4
    texts = [(1, english), (2, french), (3, english + french), (4, "дом и дерево"), (5, "東京都"), (6, "123 ..."), (7, None), (8, "")]
    got = {r.i: r for r in langid.predict(spark.createDataFrame(texts, "i long, text string"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 4, 6, 7, 8)] == ["en", "fr", "ru", "und", "und", "und"]
    assert got[5].lang_pred == "en" and got[5].score == 0
    spans = got[3].lang_spans
    assert [s.lang for s in spans] == ["en", "fr"] and spans[0].start == 0 and spans[1].end == len(english + french)
    assert abs(spans[0].end - len(english)) < 8 and spans[0].end == spans[1].start
    for df in (awkward, clashing):
        assert langid.predict(df, model).count() == len(AWKWARD)
    assert langid.predict(empty, model).count() == 0
    nothing = langid.fit(empty)
    assert {r.lang_pred for r in langid.predict(awkward, nothing).collect()} == {"und"}


# -- licences ----------------------------------------------------------------------------


def test_license_inheritance_and_edges(spark, awkward, empty):
    apache = next(t for n, t in license_scan.TEMPLATES if n == "Apache-2.0" and "compliance" in t)
    rows = [("repo/LICENSE", "MIT License\n\nReleased under the MIT License."), ("repo/src/a.py", "code = 1"),
            ("repo/src/lib/COPYING", "This work is licensed under the GNU General Public License, version 3."),
            ("repo/src/lib/deep/er/b.py", "code"), ("repo/src/c.py", "".join(f"# {w}\n" for w in apache.split(" you ")) + "code = 2\n"),
            ("other/d.py", "we like the general public and its version of a license"), ("e.py", None), (None, "Licensed under CC BY 4.0."),
            ("repo/src/a.py", "code = 1")]
    got = license_scan.scan(spark.createDataFrame(rows, "path string, text string")).collect()
    assert len(got) == len(rows)
    by = {r.path: r for r in got}
    assert by["repo/src/a.py"].license == "MIT" and by["repo/src/a.py"].inherited_from == "repo"
    assert by["repo/src/lib/deep/er/b.py"].license == "GPL-3.0" and by["repo/src/lib/deep/er/b.py"].inherited_from == "repo/src/lib"
    assert by["repo/src/c.py"].own_license == "Apache-2.0" and by["repo/src/c.py"].inherited_from is None
    assert by["repo/LICENSE"].is_license_file and not by["repo/src/c.py"].is_license_file
    assert by[None].own_license == "CC-BY-4.0"
    assert (by["other/d.py"].own_license, by["other/d.py"].inherited_from) == (None, "" if by[None].is_license_file else None)
    odd = awkward.withColumn("path", F.concat(F.col("source"), F.lit("/x")))
    long = [("a/LICENSE", "// SPDX-License-Identifier: MIT\n" + "# c\n" * 100_000), ("b/c.py", "mit-" * 100_000 + "license")]
    scanned = {r.path: r.own_license for r in license_scan.scan(spark.createDataFrame(long, "path string, text string")).collect()}
    assert scanned["a/LICENSE"] == "MIT" and len(scanned) == 2
    scanned = license_scan.scan(odd)
    assert scanned.count() == len(AWKWARD) and scanned.filter("own_license = 'MIT'").count() >= 1
    assert license_scan.scan(empty.withColumn("path", F.col("text"))).count() == 0


def test_license_cosines_against_a_plain_version(spark, sf):
    import math
    import re
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    term = re.compile(license_scan.TERM)
    df = Counter(t for x in texts for t in set(term.findall(x.lower())))
    vocabulary = {t for _, x in license_scan.TEMPLATES for t in term.findall(x.lower())}

    def weights(x):
        return {t: n * (math.log((1 + len(texts)) / (1 + (df[t] if t in vocabulary else 0))) + 1)
                for t, n in Counter(term.findall(x.lower())).items()}

    def cosine(a, b):
        norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
        return sum(v * b.get(t, 0) for t, v in a.items()) / norm if norm else 0

    templates = [weights(x) for _, x in license_scan.TEMPLATES]
    want = {}
    for i, x in enumerate(texts):
        best = max((max((round(cosine(weights(l), t), 6), -k) for k, t in enumerate(templates)) for l in x.split("\n")))
        if best[0] >= license_scan.LINE:
            want[str(i)] = (license_scan.TEMPLATES[-best[1]][0], best[0])
    rows = spark.createDataFrame([(str(i), x) for i, x in enumerate(texts)], "path string, text string")
    got = {r.path: (r.own_license, r.own_score) for r in license_scan.scan(rows).filter("own_license is not null").collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()} and want
    assert all(abs(got[k][1] - want[k][1]) < 2e-6 for k in want)
