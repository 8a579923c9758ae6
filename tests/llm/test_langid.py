"""Language identification against a plain scorer and a plain Viterbi, and the bound of its sample."""

import math

import pytest

from tidemark.llm import langid


def plain(model: langid.Model, text: str | None) -> tuple[str, float]:
    words = langid.WORD.findall((text or "").lower())
    if not words:
        return "und", 0.0
    n, scores, read = len(model.langs), [], []
    for w in words:
        script = max((s, name) for s, name in langid.SCRIPTS if s <= ord(w[0]))[1]
        uses = model.uses[langid.NAMES.index(script)]
        read.append(any(uses))
        sums = [langid.TEMPER * sum(model.logp[model.ids[g]][k] for g in langid.grams(w) if g in model.ids) for k in range(n)]
        sums = [0.0] * n if not any(uses) else [s if u else -1e9 for s, u in zip(sums, uses)]
        top = max(sums)
        total = top + math.log(sum(math.exp(s - top) for s in sums))
        scores.append([max(s - total, -langid.SWITCH) for s in sums])
    best, back = list(scores[0]), []
    for row in scores[1:]:
        came = [max(range(n), key=lambda j: (best[j] - langid.SWITCH * (j != k), j == k, -j)) for k in range(n)]
        best = [best[came[k]] - langid.SWITCH * (came[k] != k) + row[k] for k in range(n)]
        back.append(came)
    label = max(range(n), key=lambda k: (best[k], -k))
    labels = [label]
    for came in reversed(back):
        label = came[label]
        labels.append(label)
    labels.reverse()
    held = [sum(len(w) for w, x in zip(words, labels) if x == k) for k in range(n)]
    most = max(range(n), key=lambda k: (held[k], -k))
    sure = sum(len(w) * math.exp(s[most]) for w, s, x, r in zip(words, scores, labels, read) if x == most and r)
    return model.langs[most], min(1.0, sure / sum(held))


def test_all_documents_against_the_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs.filter(~langid.is_held_out()))
    got = langid.predict(docs, model).select("text", "lang_pred", "score").collect()
    mixed = [(f"{a.text[:300]} 東京都 {b.text[:300]}",) for a, b in zip(got[:20], got[20:40]) if a.text and b.text]
    got += langid.predict(spark.createDataFrame(mixed, "text string"), model).select("text", "lang_pred", "score").collect()
    for r in got:
        lang, score = plain(model, r.text[:4000] if r.text else r.text)
        if r.text is None or len(r.text) <= 4000:
            assert (r.lang_pred, r.score) == (lang, pytest.approx(score, abs=1e-3))
        else:
            assert r.lang_pred == lang


def test_copies_do_not_widen_the_sample(spark, monkeypatch):
    kept, real = {}, langid.written
    monkeypatch.setattr(langid, "written", lambda df, name: kept.setdefault(name, real(df, name)))
    rows = [(i, "q" if i % 3 == 0 else f"q w{'abcdefghij'[i % 10]}{'klmnop'[i % 6]}", "en") for i in range(6000)]
    langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=300)
    chosen = kept["langid-counts"].filter("kind = 'gram' and item = ' q '").first()["n"]
    assert 200 < chosen < 400


def test_many_languages(spark):
    rows = [(i, " ".join([f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + i % 7)}x"] * 3), f"l{i:03}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(df, langid.fit(df)).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) > 290
