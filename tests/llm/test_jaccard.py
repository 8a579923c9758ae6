"""The Jaccard join against all pairs."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm import models
from tests.llm.models import AWKWARD, DOCS
from tidemark.llm import arrow, jaccard


def shingles(text: str | None, size: int) -> set[str]:
    w = models.WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {" ".join(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) > size else {" ".join(w)} - {""}


def plain(docs: list[tuple], size: int = 5, percent: int = 80) -> Counter:
    """(id, set size, smallest id reachable) of each row."""
    sets, root = [shingles(t, size) for _, t in docs], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and min(len(a), len(sets[j])) * 100 >= percent * max(len(a), len(sets[j])):
                both = len(a & sets[j])
                if 100 * both >= percent * (len(a) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs))


def families(rnd: random.Random, size: int) -> list[str]:
    """Sets of words at all distances: chains, shells around a centre, copies, and sets that lie just at the threshold."""
    out = []
    for n in [*range(1, 12), 17, 18, 26, 27, 40, 41, 60, 93, 150, 210, 400]:
        base = [f"w{rnd.randint(0, 10 ** 6)}" for _ in range(n)]
        out += [" ".join(base)] * 2
        for k in range(12):
            gone, new = rnd.randint(0, max(1, n // 6)), rnd.randint(0, max(1, n // 6))
            words = [w for w in base if rnd.random() >= gone / n] + [f"x{rnd.randint(0, 10 ** 6)}" for _ in range(new)]
            rnd.shuffle(words)
            out.append(" ".join(words))
        for k in range(8):
            base = base[1:] + [f"y{rnd.randint(0, 10 ** 6)}" for _ in range(1 + n // 12)]
            out.append(" ".join(base))
    return out


def test_links_against_all_pairs(spark, monkeypatch):
    """Shingles of one word: sets at every distance, of sizes on both sides of each band's edge; one hot word."""
    rnd = random.Random(0)
    texts = [t for i in range(3) for t in families(rnd, 1)]
    texts += [f"common {t}" for t in rnd.sample(texts, 60)] + ["common", "common", "Common", None, "", " "] * 3
    rnd.shuffle(texts)
    docs = list(enumerate(texts, 5))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = Counter(tuple(r) for r in jaccard.near_duplicates(df, shingle=1, percent=80).collect())
    assert got == plain(docs, 1, 80)


def test_split_keys_and_many_partitions(spark, monkeypatch):
    """One group of near copies holds a third of all rows; keys are split as if they were very frequent."""
    monkeypatch.setattr(jaccard, "PARTITION", 5000)
    rnd = random.Random(1)
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join(w if rnd.random() > 0.02 else "z" + str(rnd.randint(0, 99)) for w in base) for _ in range(200)]
    texts += [" ".join(f"c{rnd.randint(0, 5000)}" for _ in range(rnd.randint(1, 80))) for _ in range(400)]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = Counter(tuple(r) for r in jaccard.near_duplicates(df, shingle=2, percent=60).collect())
    assert got == plain(docs, 2, 60)


def test_allocation_reaches_every_partner():
    """Whatever the costs are, the lookups of the larger set find the smaller one."""
    rng = np.random.default_rng(2)
    bands = jaccard.Bands(80, 2000)
    for n in [*range(1, 40), 62, 92, 93, 139, 140, 500, 1000]:
        for _ in range(6):
            s = rng.integers(0, 2 ** 63, n).astype(np.uint64)
            most = n // 5
            gone = int(rng.integers(0, most + 1))
            r = s[gone:]
            if 100 * len(r) < 80 * n or not len(r):
                continue
            own, far = bands.of(np.array([len(r)])), bands.of(np.array([n]))
            assert far[0] - own[0] in (0, 1)
            sketch = rng.integers(0, 1000, jaccard.COUNTERS)
            a, b = jaccard.Entries(bands, r, np.array([len(r)]), own), jaccard.Entries(bands, s, np.array([n]), own)
            first, second = b.allocate(bands.differ(np.minimum(n, bands.top[own]), np.array([n])) + 1, sketch)
            assert not (second & ~first).any()
            asked = {*b.keys[first].tolist(), *b.less[second[b.of]].tolist()}
            assert asked & {*a.keys.tolist(), *a.less.tolist()}


def test_edges(spark):
    docs = [(r[0], r[1]) for r in AWKWARD]
    df = spark.createDataFrame(AWKWARD, DOCS)
    assert Counter(tuple(r) for r in jaccard.near_duplicates(df).collect()) == plain(docs)
    names = ["row", "id", "n", "d1", "node", "key", "component_id", "n_shingles", "counts", "u"]
    clash = spark.createDataFrame([(*r, *["keep"] * len(names)) for r in AWKWARD], DOCS + "".join(f", {n} string" for n in names))
    assert Counter(tuple(r) for r in jaccard.near_duplicates(clash).collect()) == plain(docs)
    assert jaccard.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    assert jaccard.near_duplicates(df.filter("text is null")).count() == 2


def test_parities_never_differ_in_more_bits_than_their_sets():
    """Whole and folded, of sets on both sides of a sketch's sizes; sets apart by more than the threshold are told apart."""
    rng = np.random.default_rng(3)
    sizes = [1, 2, 500, 512, 513, 1024, 1025, 5000, 32768, 40000]
    hashes = [rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in sizes]
    others = [h[int(len(h) * 0.35):] for h in hashes]
    sets = hashes + others
    sketches = jaccard.parities(np.concatenate(sets), np.array([len(h) for h in sets]))
    for n, h, o, a, b in zip(sizes, hashes, others, sketches, sketches[len(sizes):]):
        apart = len(set(h.tolist()) ^ set(o.tolist()))
        for words in (jaccard.PARITY, min(len(a), len(b)) // 8):
            differ = int(np.bitwise_count(jaccard.folded(a, words) ^ jaccard.folded(b, words)).sum())
            assert differ <= apart
        if 500 <= n <= 5000:
            assert differ * 180 > (n + len(o)) * 20
    assert jaccard.parities(np.array([], np.uint64), np.array([], np.int64)) == []


def test_sets_below_the_threshold_meet_few_times(spark, monkeypatch):
    """A group whose sets all lie near each other, but not near enough: nearly none of its pairs is left to compare."""
    rnd = random.Random(4)
    base = [f"b{i}" for i in range(320)]
    docs = [(i, " ".join(w if rnd.random() > 0.085 else f"x{rnd.randint(0, 10 ** 9)}" for w in base)) for i in range(60)]
    docs += [(100, docs[7][1] + " once more")]
    compared, real = [], jaccard.written

    def counted(df, name):
        out = real(df, name)
        if name == "jaccard-pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in jaccard.near_duplicates(df, shingle=1, percent=80).collect())
    assert got == plain(docs, 1, 80)
    assert sum(compared) < 200, compared


def test_texts_reach_a_worker_by_megabytes(spark):
    """Batches of whole texts stay near the operator's size, which holds for its own jobs only."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["b"])

    df = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('some text ', 500) text")
    with arrow.batches_of(spark, jaccard.BATCH):
        got = [r["b"] for r in df.mapInArrow(sizes, "b long").collect()]
    assert len(got) >= 3 and max(got) < 5 << 20
    assert spark.conf.get(name) == before

    seen, docs = [], spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string")
    real = jaccard.written
    try:
        jaccard.written = lambda *args: seen.append(spark.conf.get(name)) or real(*args)
        assert jaccard.near_duplicates(docs).count() == 3
    finally:
        jaccard.written = real
    assert set(seen) == {f"{jaccard.BATCH}b"} and spark.conf.get(name) == before


def test_hashing_and_packing_hold_little(spark, monkeypatch):
    """What a task holds while it hashes texts and packs entries does not follow from a batch of 8 MB."""
    runs, rnd = [], random.Random(5)
    monkeypatch.setattr(arrow, "mapped", lambda df, run, schema: runs.append(run) or df)
    monkeypatch.setattr(jaccard, "TaskContext", type("One", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 0})())}))
    frame = spark.createDataFrame([], "id long, row long, n long, text string, to long")
    words = [f"w{k}" for k in range(5000)]
    texts = pa.array([" ".join(rnd.choices(words, k=700)) for _ in range(2000)])
    jaccard._sets(frame, 5, 80, "id", "text")
    jaccard._live(frame, 5, 80, np.full(jaccard.COUNTERS, 20), 1000, 2_000_000)
    for run, name in zip(runs[:2], ("id", "row")):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], [name, "text"])
        tracemalloc.start()
        try:
            assert sum(out.num_rows for out in run(iter([batch]))) > 0
            peak = tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()
        assert peak < 35, (name, peak)
