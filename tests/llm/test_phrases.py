from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from skyledger.llm import phrases
from tests.llm.helpers import ODD


def brute(rows, least, top=2000):
    """Collocations of (text, lang), by counting all sequences of words."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(5, len(words) - i) + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    made = []
    for (lang, p), a in found.items():
        inside = any(
            q[i : i + len(p)] == p
            for (other, q), b in found.items()
            if other == lang and len(q) > len(p) and 100 * b >= 100 * a
            for i in range(len(q) - len(p) + 1)
        )
        if not inside:
            n = totals[lang]
            cuts = [(counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
            score, k = min((1000 * a * n // (l * r), k) for k, (l, r) in enumerate(cuts))
            made.append((lang, -score, -a, " ".join(p).encode(), *cuts[k], n))
    ranks, out = Counter(), []
    for lang, score, a, phrase, l, r, n in sorted(made):
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], phrase.decode(), -a, l, r, n, -score))
    return out


def found(spark, rows, **options):
    made = [(i, t, x, n, "z") for n, (i, t, x) in enumerate(rows)]
    kinds = "doc_id long, text string, lang string, words int, a string"
    table = phrases.collocations(spark.createDataFrame(made, kinds).repartition(3), **options)
    return sorted(tuple(r) for r in table.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "tree", "é", "É", "a\0b", "a\1b", "a", "\0", "\1\2", "b", "x-y", "'", "(of)"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", "; ", "\xa0", "\x1f "]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "fr", None, "und", ""])))
    rows += [(900 + i, "One very common line of seven words", "en") for i in range(30)]
    return rows + [(i, t, "en") for i, t in ODD]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_matches_brute_force(spark, least):
    rows = corpus()
    assert found(spark, rows, least=least) == sorted(brute([r[1:] for r in rows], least))


@pytest.mark.parametrize("hot", [1, 30, 10**6])
def test_many_ranges_and_small_blocks(spark, monkeypatch, hot):
    """Phrases that go over the borders of ranges and of blocks of a text are counted whole."""
    monkeypatch.setattr(phrases, "PLACES", 40)
    monkeypatch.setattr(phrases, "TEXT_BYTES", 100)
    monkeypatch.setattr(phrases, "RANGE_ROWS", 25)
    monkeypatch.setattr(phrases, "HOT", hot)
    monkeypatch.setattr(phrases, "ROUTES", 7)
    rows = corpus(4) + [(5000, "a common pair " * 800, "en"), (5001, "long " * 3000, "fr")]
    assert found(spark, rows, least=4, top=50) == sorted(brute([r[1:] for r in rows], 4, 50))


def test_very_long_text_and_empty_tables(spark):
    text = "some words, other words. " * 60_000
    got = found(spark, [(1, text, "en")], least=100)
    assert [r[2:4] for r in got] == [("other words", 60_000), ("some words", 60_000)]
    assert found(spark, [(1, None, None)] * 3) == []
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(empty).count() == 0


def test_scores_beyond_64_bits(spark):
    words = spark.createDataFrame(
        [("en", None, 4 * 10**15), ("en", b"x", 3 * 10**15), ("en", b"y", 2 * 10**14 + 7)],
        "lang string, word binary, a long",
    )
    pairs = spark.createDataFrame([("en", [b"x", b"y"], 2 * 10**14 + 1)], "lang string, words array<binary>, a long")
    (row,) = phrases.scored(words, pairs).collect()
    assert row["score"] == 1000 * (2 * 10**14 + 1) * 4 * 10**15 // (3 * 10**15 * (2 * 10**14 + 7))


def test_quicksort_counts_and_abandons():
    rng = np.random.default_rng(5)
    table = np.full((3000, 5), -1)
    for row in table:
        length = rng.integers(2, 6)
        row[:length] = rng.integers(0, 6, length)
    weight = rng.integers(1, 4, len(table))
    wanted = Counter()
    for row, n in zip(table.tolist(), weight.tolist(), strict=True):
        for k in range(1, row.index(-1) + 1 if -1 in row else 6):
            wanted[tuple(row[:k])] += n
    border = np.zeros(len(table), bool)
    border[[5, 1234]] = True
    got = {tuple(table[r, :k].tolist()): n for r, k, n in phrases.quicksort(table, weight, border, 30)}
    kept = [table[5].tolist(), table[1234].tolist()]
    for phrase, n in got.items():
        assert wanted[phrase] == n
        assert n >= 30 or any(list(phrase) == row[: len(phrase)] for row in kept)
    assert {p for p, n in wanted.items() if n >= 30} <= set(got)
    assert all(tuple(w for w in row[:k] if w >= 0) in got for row in kept for k in range(1, 6))


def test_maps_only_save_work(spark, monkeypatch):
    """With maps of few bits all words and pairs seem frequent, and the result is the same."""
    rows = corpus(7)
    wanted = found(spark, rows, least=6)
    monkeypatch.setattr(phrases, "WORD_BITS", 4)
    monkeypatch.setattr(phrases, "PAIR_BITS", 4)
    monkeypatch.setattr(phrases, "ROW_BITS", 3)
    assert wanted and found(spark, rows, least=6) == wanted
