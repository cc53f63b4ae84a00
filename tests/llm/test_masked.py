from __future__ import annotations

import math
import random

import numpy as np
import pytest

from skyledger.llm import masked
from skyledger.llm.decontam import words_of
from tests.llm.helpers import ODD, documents


def brute_score(vocab, weights, text: str | None) -> tuple[int, float]:
    """Every place by itself, in double precision."""
    table, w1, b1, w2, b2 = (w.astype(float) for w in weights)
    tokens = [
        vocab.words.get(w) or 1 + masked.WORDS + masked.zlib.crc32(w[-3:]) % masked.CLASSES
        for w in words_of((text or "").encode())
    ]
    total = 0.0
    for at, token in enumerate(tokens):
        seen = []
        for k in range(-masked.SIDE, masked.SIDE + 1):
            if k:
                inside = 0 <= at + k < len(tokens)
                seen.append(table[tokens[at + k] if inside else 0])
        out = np.tanh(np.concatenate(seen) @ w1 + b1) @ w2 + b2
        total += out[token] - math.log(np.exp(out - out.max()).sum()) - out.max()
    return len(tokens), total


def corpus(n: int = 120) -> list[tuple]:
    """Sentences of a small grammar."""
    rng = random.Random(14)
    parts = [["the", "a"], ["cat", "dog", "bird"], ["sees", "likes"], ["the", "a"], ["tree", "house"], ["and"]]
    return [
        (1000 + i, " ".join(rng.choice(p) for _ in range(rng.randint(4, 30)) for p in parts)) for i in range(n)
    ]


def test_scores_are_the_sums_of_all_conditionals(spark, monkeypatch):
    monkeypatch.setattr(masked, "SCORED", 100)
    rows = ODD + corpus(30)
    docs = documents(spark, rows)
    vocab, weights = masked.fit(docs)
    found = masked.score(docs, vocab, weights)
    assert [c for c in docs.columns if c != "text"] == found.columns[:-2]
    got = sorted((str(r["doc_id"]), r["__n_tokens"], r["__log_likelihood"]) for r in found.collect())
    wanted = sorted((str(i), *brute_score(vocab, weights, t)) for i, t in rows)
    for a, b in zip(got, wanted, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-4, abs=1e-4)


def test_slopes_match_differences():
    rng = np.random.default_rng(0)
    weights = [w.astype(np.float64) for w in masked.start_weights()]
    around = rng.integers(0, masked.TOKENS, (7, 2 * masked.SIDE))
    tokens = rng.integers(0, masked.TOKENS, 7)
    made = masked.slopes(weights, around, tokens)

    def loss():
        return -masked.log_probabilities(weights, around, tokens).mean()

    for w, slope in zip(weights, made, strict=True):
        for _ in range(15):
            at = tuple(rng.integers(0, n) for n in w.shape)
            if w is weights[0]:
                at = (int(around[0, 0]), at[1])
            before = w[at]
            w[at] = before + 1e-5
            up = loss()
            w[at] = before - 1e-5
            down = loss()
            w[at] = before
            assert (up - down) / 2e-5 == pytest.approx(slope[at], rel=1e-3, abs=1e-6)


def test_every_place_is_learned_from_once():
    for n in (0, 1, 2, 7, 15, 1000):
        turns = [masked.turn_places(n, turn) for turn in range(masked.ROUNDS)]
        assert sorted(np.concatenate(turns)) == list(range(n))


def test_training_learns_what_stands_where(spark, monkeypatch):
    monkeypatch.setattr(masked, "STRIDE", 2)
    docs = documents(spark, corpus())
    vocab, weights = masked.fit(docs)
    rng = random.Random(15)
    fresh = [t for _, t in corpus(20)]
    shuffled = [" ".join(rng.sample(t.split(), len(t.split()))) for t in fresh]
    mean = [
        sum(brute_score(vocab, w, t)[1] for t in texts) / sum(len(t.split()) for t in texts)
        for w, texts in ((weights, fresh), (weights, shuffled), (masked.start_weights(), fresh))
    ]
    assert mean[0] > mean[1] + 0.3 and mean[0] > mean[2] + 2


def test_counts_and_the_vocabulary_cover_all_texts(spark, monkeypatch):
    monkeypatch.setattr(masked, "COUNTED", 5)
    rows = ODD + corpus(40)
    wanted: dict[bytes, int] = {}
    for _, t in rows:
        for w in words_of((t or "").encode()):
            wanted[w] = wanted.get(w, 0) + 1
    found = {bytes(r["word"]): r["n"] for r in masked.word_counts(documents(spark, rows)).collect()}
    assert found == wanted
    first = sorted(wanted, key=lambda w: (-wanted[w], w))[: masked.WORDS]
    assert list(masked.vocabulary(documents(spark, rows)).words) == first


def test_words_of_a_class_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(masked, "KNOWN", 2)
    monkeypatch.setattr(masked, "SPELLED", 50)
    common = " ".join(f"w{i:03}" for i in range(masked.WORDS))
    rare = ["station"] * 20 + ["ration"] * 9 + ["nation"] * 8 + ["motion", "potion", "qzion"]
    rows = ODD + [(i, common) for i in range(1000, 1050)] + [(3000, " ".join(rare))]
    fresh = [(1, "w000 station"), (2, "w000 nation"), (3, "w000 potion"), (4, "w000 xqzvkion"), (5, "w000")]
    model = masked.fit_words(documents(spark, rows))
    spelling = model[2]
    assert len(spelling.counts) <= 2 and b"station" in spelling.counts
    assert sum(spelling.totals.values()) == sum(
        len([w for w in words_of((t or "").encode()) if w not in model[0].words]) for _, t in rows
    )
    plain = {r["doc_id"]: r["__log_likelihood"] for r in masked.score(documents(spark, fresh), *model[:2]).collect()}
    found = {r["doc_id"]: r["__log_likelihood"] for r in masked.score(documents(spark, fresh), *model).collect()}
    assert [plain[i] for i in (2, 3, 4)] == pytest.approx([plain[1]] * 3, abs=1e-4)
    assert found[1] > found[2] > found[3] > found[4] and found[5] == pytest.approx(plain[5])
    for i, t in fresh[:4]:
        assert found[i] - plain[i] == pytest.approx(spelling.log_probability(t.split()[1].encode()), abs=1e-4)


def test_probabilities_of_a_class_add_up_to_at_most_one():
    words = {b"aion": 5, b"bion": 3, b"cion": 1, b"ion": 2}
    steps: dict[int, int] = {}
    for w in words:
        for step in masked.steps_of(w):
            steps[step] = steps.get(step, 0) + 1
    own = masked.class_of(b"ion")
    model = masked.Spelling({b"aion": 5, b"bion": 3}, {own: 11}, {own: 4}, {b"ion": 4}, steps)
    short = sum(math.exp(model.log_probability(bytes([a]) + b"ion")) for a in range(256))
    short += math.exp(model.log_probability(b"ion"))
    assert 0.7 < short < 1 and model.log_probability(b"aion") > model.log_probability(b"cion")


def test_empty_table(spark):
    docs = documents(spark, ODD).limit(0)
    vocab, weights = masked.fit(docs)
    assert masked.score(docs, vocab, weights).count() == 0
    assert all((a == b).all() for a, b in zip(weights, masked.start_weights(), strict=True))


def test_spellings_of_many_words_are_those_of_each(spark, monkeypatch):
    monkeypatch.setattr(masked, "STORE", 3)
    rng = random.Random(61)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    common = " ".join(f"w{i:03}" for i in range(masked.WORDS))
    rows = ODD + [(i, common) for i in range(1000, 1050)] + [(3000, " ".join(words))]
    vocab, _, spelling = masked.fit_words(documents(spark, rows))
    asked = [w.encode() for w in [*words[:150], "x", "xy", "xyz", "unseen", "été", "w001"]]
    wanted = [spelling.log_probability(w) for w in asked]
    assert spelling.log_probabilities(asked).tolist() == pytest.approx(wanted, abs=1e-9)
    store = masked.Store(spelling, vocab)
    for text in (asked[:100], asked[100:], asked, []):
        store.learn([text, text])
        assert [store[w] for w in text] == pytest.approx(
            [0.0 if w in vocab.words else spelling.log_probability(w) for w in text], abs=1e-9
        )
    nothing = masked.Spelling({}, {}, {}, {}, {})
    assert nothing.log_probabilities([b"one"])[0] == pytest.approx(nothing.log_probability(b"one"))


def test_large_weights_neither_overflow_nor_vanish():
    rng = np.random.default_rng(62)
    around = rng.integers(0, masked.TOKENS, (40, 2 * masked.SIDE))
    tokens = rng.integers(0, masked.TOKENS, 40)
    for times in (1, 300):
        weights = [w * np.float32(times) for w in masked.start_weights()]
        double = [w.astype(np.float64) for w in weights]
        found = masked.log_probabilities(weights, around, tokens)
        assert found == pytest.approx(masked.log_probabilities(double, around, tokens), rel=1e-3, abs=1e-3)
        for a, b in zip(masked.slopes(weights, around, tokens), masked.slopes(double, around, tokens), strict=True):
            assert np.isfinite(a).all() and a.shape == b.shape
