from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from skyledger.llm import copies
from tests.llm.helpers import ODD, documents


def brute_shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def brute_links(texts):
    """Pairs of different texts that are near copies."""
    sets = {t: brute_shingles(t) for t in texts}
    holders = defaultdict(set)
    for t, s in sets.items():
        for shingle in s or [b""]:
            holders[shingle].add(t)
    pairs = {p for group in holders.values() for p in combinations(sorted(group), 2)}
    return {p for p in pairs if alike(sets[p[0]], sets[p[1]])}


def brute_groups(texts, links):
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            root[t] = root[root[t]]
            t = root[t]
        return t

    for a, b in links:
        root[find(a)] = find(b)
    return {t: find(t) for t in texts}


def edited(rng, words, share):
    out = list(words)
    for i in rng.sample(range(len(out)), max(1, round(share * len(out)))):
        out[i] = rng.choice([f"new{rng.randrange(999)}", f"{out[i]} {out[i]}", ""])
    return " ".join(out)


def corpus(seed=1):
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in"] * 8 + [f"w{i}" for i in range(800)]
    texts = []
    for _ in range(50):
        words = rng.choices(common, k=rng.randint(40, 400))
        texts.append(" ".join(words))
        texts += [edited(rng, words, rng.choice([0.005, 0.01, 0.02, 0.03])) for _ in range(rng.choice([0, 1, 2, 5]))]
    words = rng.choices(common, k=300)
    texts += [edited(rng, words, 0.01) for _ in range(150)]  # a large group
    texts += [rng.choice(["Short text.", "short TEXT.", "a b c d", "a b c d e", "a b c d e f"]) for _ in range(10)]
    return texts


def grouped(spark, rows):
    found = defaultdict(set)
    for r in copies.components(documents(spark, rows)).collect():
        found[r["root"]].add((r["doc_id"], r["digest"]))
    return found


def recall_and_check(spark, texts):
    """The share of all links whose ends are in one component; all components must be real."""
    rows = list(enumerate(texts))
    links = brute_links(set(texts))
    groups = brute_groups(set(texts), links)
    mine = {}
    for root, members in grouped(spark, rows).items():
        assert len({groups[texts[i]] for i, _ in members}) == 1
        mine |= {texts[i]: root for i, _ in members}
    assert set(mine) == set(texts)
    return np.mean([mine[a] == mine[b] for a, b in links]), len(links)


def test_finds_nearly_all_links_and_no_others(spark):
    recall, n = recall_and_check(spark, corpus())
    assert n > 1000 and recall >= 0.97


def test_full_entries_are_split(spark, monkeypatch):
    monkeypatch.setattr(copies, "ENTRY", 40)
    recall, _ = recall_and_check(spark, corpus(2))
    assert recall >= 0.95


@pytest.mark.parametrize("size", [3, 700])
def test_spanning_connects_all_within_the_bits(size):
    rng = np.random.default_rng(size)
    centers = rng.integers(0, 1 << 60, 20, np.uint64)
    flips = np.zeros(size, np.uint64)
    for _ in range(5):
        flips ^= np.uint64(1) << rng.integers(0, 60, size, np.uint64)
    fps = centers[rng.integers(0, 20, size)] ^ flips
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= copies.MAX_BITS
    links = copies.spanning(fps)
    groups = brute_groups(range(size), [(a, b) for x, y in links for a, b in zip(x, y, strict=True)])
    assert all(near[a, b] for x, y in links for a, b in zip(x, y, strict=True))
    want = brute_groups(range(size), zip(*np.nonzero(near), strict=True))
    assert {frozenset(i for i in groups if groups[i] == r) for r in set(groups.values())} == {
        frozenset(i for i in want if want[i] == r) for r in set(want.values())
    }


def test_nine_bits_are_always_found(spark):
    """Any fingerprint and one that differs in nine bits share an entry."""
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 1 << 60, 400, np.uint64)
    other = fps.copy()
    for i in range(len(other)):
        for bit in rng.choice(60, 9, replace=False):
            other[i] ^= np.uint64(1) << np.uint64(bit)
    rows = [(i, int(f)) for i, f in enumerate(np.concatenate([fps, other]).tolist())]
    table = spark.createDataFrame(rows, "node long, fp long")
    found = {(r["a"], r["b"]) for r in copies.candidates(table).collect()}
    assert {(i, i + 400) for i in range(400)} <= found


def test_blocks_of_a_text_do_not_change_its_shingles(monkeypatch):
    from skyledger.llm import common

    text = ("one two  three\tfour\nFIVE six seven " * 500).encode()
    whole, print_ = copies.shingles(text), copies.word_print(text)
    monkeypatch.setattr(copies, "blocks_of_words", lambda data: common.blocks_of_words(data, 40))
    assert np.array_equal(whole, copies.shingles(text)) and print_ == copies.word_print(text)
    assert len(whole) == len(brute_shingles(text.decode()))


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    kept = copies.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    # Texts without words are one group; equal texts another; the rest stay.
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(
        ["None", "101", "104", "105", "106", "107", "108", "108", "109", "110"]
    )
    texts = [r["text"] for r in rows if r["doc_id"] == 108]
    assert sorted(texts) == ["the same id", "the same row"]
    assert copies.keep_one(docs.limit(0)).count() == 0


def test_very_long_texts(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(50_000)}" for _ in range(300_000)]
    rows = [(2, " ".join(words)), (1, edited(rng, words, 0.01)), (3, edited(rng, words, 0.2)), (4, "x" * 2_000_000)]
    kept = copies.keep_one(documents(spark, rows))
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [1, 3, 4]


def test_hot_copies_stay_once(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(900)}" for _ in range(120)]
    near = [(1000 + i, edited(rng, words, 0.008)) for i in range(40)]
    rows = [(i, " ".join(words)) for i in range(500)] + near + [(5000 + i, f"other text number {i} here") for i in range(9)]
    kept = {r["doc_id"] for r in copies.keep_one(documents(spark, rows)).select("doc_id").collect()}
    assert kept == {0, *range(5000, 5009)}


@pytest.mark.parametrize("entry", [7, 4096])
def test_no_link_is_lost_beside_a_text_with_near_fingerprints(spark, monkeypatch, entry):
    """Pairs whose words stand in many other texts too, in another order: their prints are equal."""
    monkeypatch.setattr(copies, "ENTRY", entry)
    rng = random.Random(51)
    words = [f"w{i}" for i in range(100)]
    texts = []
    for _ in range(30):
        rng.shuffle(words)
        texts += [" ".join(words), " ".join([*words, words[0]])]
    assert len({copies.word_print(t.encode()) for t in texts}) == 1
    found = grouped(spark, list(enumerate(texts)))
    assert sorted(sorted(i for i, _ in g) for g in found.values()) == [[i, i + 1] for i in range(0, 60, 2)]


@pytest.mark.parametrize("part", [200, 1_000_000])
def test_texts_with_near_fingerprints_make_links_in_proportion(spark, monkeypatch, part):
    """Texts of the same words in other orders, and edited copies of some of them."""
    monkeypatch.setattr(copies, "PART", part)
    rng = random.Random(52)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for n in range(60):
        rng.shuffle(words)
        texts += [" ".join(words)] + [edited(rng, words, 0.01) for _ in range(12 if n < 2 else 0)]
    nodes = [(i, copies.word_print(t.encode()), i, copies.shingles(t.encode()).view(np.int32).tolist()) for i, t in enumerate(texts)]
    table = spark.createDataFrame(nodes, "node long, fp long, root long, shingles array<int>")
    sets = table.select("node", "shingles")
    found = [(r["a"], r["b"]) for r in copies.apart(table.drop("shingles"), sets).collect()]
    links = brute_links(set(texts))
    groups = brute_groups(texts, [(texts[a], texts[b]) for a, b in found])
    assert all(tuple(sorted((texts[a], texts[b]))) in links for a, b in found)
    assert all(groups[a] == groups[b] for a, b in links)
    # As rows of pairs there would be one for each two of all texts.
    assert len(found) <= (len(texts) if part > 200 else len(links)) and len(links) > 100


def test_odd_buckets_never_differ_more_than_the_sets():
    rng = np.random.default_rng(53)
    for n, m in [(0, 0), (5, 3), (300, 40), (3000, 500)]:
        both, one, two = (np.unique(rng.integers(0, 1 << 31, k)).astype(np.int32) for k in (n, m, m))
        a, b = np.union1d(both, one), np.union1d(both, two)
        bits = int.from_bytes(copies.odd_bits(a)) ^ int.from_bytes(copies.odd_bits(b))
        assert bits.bit_count() <= np.setxor1d(a, b).size
