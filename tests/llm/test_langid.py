from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import langid
from tests.llm.helpers import ODD, documents

SF_DIR = "/root/testdata/sf0.001"


def brute(scores: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals and pair sums of one text from all its labellings."""
    n, k = scores.shape
    out, pairs, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        weight = math.exp(
            sum(scores[i, a] for i, a in enumerate(path))
            + sum(transitions[a, b] for a, b in zip(path, path[1:], strict=False))
        )
        total += weight
        for i, a in enumerate(path):
            out[i, a] += weight
        for a, b in zip(path, path[1:], strict=False):
            pairs[a, b] += weight
    return out / total, pairs / total


def test_forward_backward_matches_all_labellings():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 6, 0, 4, 6])
    texts = [rng.normal(0, 2, (n, 3)) for n in lengths]
    transitions = rng.normal(0, 2, (3, 3))
    place, _, active = langid.packed(lengths)
    scores = np.empty((lengths.sum(), 3))
    scores[place] = np.concatenate(texts)
    found, pairs = langid.forward_backward(scores, transitions, active)
    again = langid._marginals(scores, transitions, active)
    wanted = [brute(t, transitions) for t in texts if len(t)]
    assert np.allclose(found[place], np.concatenate([w for w, _ in wanted]))
    assert np.allclose(again, found)
    assert np.allclose(pairs, sum(p for _, p in wanted))


def test_ngrams_are_those_of_each_word_alone():
    words = ["a", "été", "bonjour", "\U00010400\U00010401"]
    ids, starts = langid.ngrams(words)
    parts = np.split(ids, starts[1:])
    for word, part in zip(words, parts, strict=True):
        assert sorted(part) == sorted(langid.ngrams([word])[0])
    inside = sorted(parts[2][parts[2] < langid.FEATURES])
    n = len("bonjour") + 2
    assert len(inside) == n + (n - 1) + (n - 2) + 2


@pytest.fixture(scope="module")
def model():
    import duckdb

    rows = duckdb.sql(f"select doc_id, text, lang from '{SF_DIR}/documents.parquet'").fetchall()
    rest = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    return langid.fit([t for t, _ in rest], [lang for _, lang in rest])


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = docs.filter(langid.held_out(F.col("doc_id")))
    found = langid.identify(out.select("doc_id", "text", "lang"), model).collect()
    assert len(found) > 30
    assert sum(r["lang"] == r["__lang"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["__score"] <= 1 for r in found)


def test_switches_within_a_text(model):
    labeller = langid.Labeller(model)
    english = "the that thanster and for the tionation threstly"
    german = "ungkeit der die einver beschäch und für pfein"
    runs = labeller.switches(f"{english} {german} {english}")
    assert [lang for lang, _ in runs] == ["en", "de", "en"]
    assert abs(len(runs[1][1]) - 8) <= 1
    assert labeller.switches(None) == []


def test_odd_texts_and_bounded_store(spark, model, monkeypatch):
    monkeypatch.setattr(langid, "STORE", 5)
    monkeypatch.setattr(langid, "RUN_WORDS", 10)
    docs = documents(spark, ODD)
    rows = langid.identify(docs, model, keep_text=True).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["__lang"] == "und") == (not letters)
        assert r["__score"] == 0 or letters
    assert langid.identify(docs.limit(0), model).columns == [
        "doc_id", "lang", "key", "fingerprint", "__lang", "__score",
    ]
    one = langid.Labeller(model)
    monkeypatch.setattr(langid, "RUN_WORDS", 10**6)
    two = langid.Labeller(model)
    texts = [r["text"] for r in rows]
    for a, b in zip(one.languages(texts), two.languages(texts), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1])


def test_training_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_TEXTS", 3)
    rows = [(i, f"{'der die das' if i % 2 else 'the of and'} {i}", "de" if i % 2 else "en") for i in range(400)]
    rows += [(None, "the", "en"), (500, None, "en"), (501, "x" * 30_000, "xx"), (502, "the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = []
    monkeypatch.setattr(langid, "fit", lambda texts, langs: kept.append((texts, langs)))
    langid.trained_on_rest(docs)
    texts, langs = kept[0]
    assert langs == ["de"] * 3 + ["en"] * 3 + ["xx"]
    assert all(zlib.crc32(t.split()[-1].encode()) % 4 != 2 for t in texts[:6])
    assert texts[6] == "x" * langid.SAMPLE_BYTES  # one word: it is cut, and its language learned


def test_a_language_of_long_texts_only_is_learned(spark):
    long = {"de": "der die das und ", "el": "και το της είναι ", "th": "ที่ และ ใน ของ "}
    rows = [(i, "the of and in " * 9, "en") for i in range(9)]
    rows += [(50 + 9 * k + i, t * 2500, lang) for k, (lang, t) in enumerate(long.items()) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.trained_on_rest(docs)
    assert model.languages == ["de", "el", "en", "th"]
    labeller = langid.Labeller(model)
    assert [lang for lang, _ in labeller.languages([t * 9 for t in long.values()])] == list(long)
    for text, cut in docs.select("text", langid.piece(F.col("text"))).collect():
        assert text.startswith(cut) and len(cut.encode()) <= langid.SAMPLE_BYTES
        assert len(cut.encode()) > langid.SAMPLE_BYTES / 4 or cut == text
        assert set(cut.split()) <= set(text.split())


def test_no_or_one_language(spark):
    docs = documents(spark, [(1, "word"), (2, "12")])
    for model, wanted in ((langid.fit([], []), "und"), (langid.fit(["a b"], ["en"]), "en")):
        found = {r["doc_id"]: r["__lang"] for r in langid.identify(docs, model).collect()}
        assert found == {1: wanted, 2: "und"}
    empty = langid.trained_on_rest(docs.select("doc_id", "text", "lang").limit(0))
    assert empty.languages == []
