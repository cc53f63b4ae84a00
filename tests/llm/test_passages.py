from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import passages
from tests.llm.helpers import ODD, documents


@pytest.mark.parametrize("values", [2, 5, 10**9])
def test_every_long_passage_is_in_one_window_with_its_smallest_token(values):
    rng = np.random.default_rng(values)
    for n in (0, 1, 4, 5, 40, 90):
        row = rng.integers(0, values, n).astype(np.uint64)
        found = passages.windows(row, span=5)
        for low in range(n):
            for high in range(low + 4, n):
                inside = [w for w in found if w[0] <= low <= w[1] <= high <= w[2]]
                assert len(inside) == 1
                assert row[inside[0][1]] == row[low : high + 1].min()


def test_equal_values_make_few_windows():
    assert len(passages.windows(np.zeros(100_000, np.uint64), span=46)) < 2 * 100_000 // 40


def words(rng: random.Random, n: int) -> list[str]:
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def jaccard(a: list[str], b: list[str]) -> float:
    one, two = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b))
    return len(one & two) / len(one | two)


def classes(rows) -> dict[int, int]:
    return {r["doc_id"]: r["class_id"] for r in rows} | {r["of_doc_id"]: r["class_id"] for r in rows}


def test_repeated_passages_are_found_and_verified(spark, monkeypatch):
    monkeypatch.setattr(passages, "LOCAL", 300)
    rng = random.Random(16)
    shared = [words(rng, n) for n in (50, 60, 120, 400)]
    rows, holders = list(ODD), {k: [] for k in range(len(shared))}
    for n in range(160):
        text = words(rng, rng.randint(0, 300))
        if n % 2:
            k = rng.randrange(len(shared))
            holders[k].append(1000 + n)
            text += shared[k] + words(rng, rng.randint(0, 300))
        rows.append((1000 + n, " ".join(text)))
    near = list(shared[3])
    for at in range(30, 400, 60):
        near[at] = "changed"
    rows += [(5000, " ".join(near)), (5001, " ".join(shared[2])), (5001, " ".join(shared[2]))]
    found = passages.near_passages(documents(spark, rows)).collect()
    texts = dict(rows)
    for r in found:
        a = texts[r["doc_id"]].split()[r["first_word"] : r["last_word"] + 1]
        b = texts[r["of_doc_id"]].split()[r["of_first_word"] : r["of_last_word"] + 1]
        assert len(a) >= 50 and len(b) >= 50
        assert jaccard(a, b) == pytest.approx(r["similarity"]) and r["similarity"] >= 0.8
    of = classes(found)
    assert set(of) == {i for ids in holders.values() for i in ids} | {5000, 5001}
    for k, ids in holders.items():
        assert len({of[i] for i in ids}) == 1, k
    assert of[5000] == of[holders[3][0]] and of[5001] == of[holders[2][0]]
    assert passages.near_passages(documents(spark, rows).limit(0)).count() == 0


def test_a_large_group_makes_links_in_proportion(spark):
    rng = random.Random(17)
    text = words(rng, 200)
    rows = [(i, " ".join(words(rng, 20) + text)) for i in range(150)]
    named = documents(spark, rows).selectExpr("xxhash64(text) text_id", "text")
    # Two for each member and task-local group; all pairs would be 11,175.
    assert passages.candidates(named).count() <= 4 * 150
    assert len(set(classes(passages.near_passages(documents(spark, rows)).collect()).values())) == 1


def test_links_are_blind_to_batch_ends():
    rng = random.Random(18)
    keys = sorted(rng.choices(range(12), k=60))
    columns = [keys, [rng.randrange(9) for _ in keys], list(range(60))]
    arrays = [pa.array(v, pa.int64()) for v in columns] + [pa.nulls(60, pa.int64())] * 2
    whole = pa.RecordBatch.from_arrays(arrays, names=[*passages.COLUMNS, "o_text_id", "o_at"])

    def result(size):
        parts = iter([whole.slice(i, size) for i in range(0, 60, size)])
        return sorted(str(r) for b in passages._meet(parts) for r in b.to_pylist())

    assert result(1) == result(60) == result(7)
    assert result(60)


def test_regions_need_enough_functions():
    near = [(0, 0, 60, 100, 160), (1, 10, 70, 105, 170)]
    assert passages._regions(near) == [(0, 70, 100, 170)]
    assert passages._regions([near[0], (1, 10, 70, 500, 560)]) == []
    assert passages._regions([near[0], (0, 10, 70, 105, 170)]) == []
    bridge = [(0, 0, 50, 0, 50), (1, 100, 150, 100, 150), (0, 40, 110, 40, 110)]
    assert passages._regions(bridge) == [(0, 150, 0, 150)]


def test_parts_in_another_order_are_found():
    one, two = np.arange(100, dtype=np.uint64), np.arange(200, 300, dtype=np.uint64)
    gap = np.arange(1000, 1300, dtype=np.uint64)
    found = passages.compare(np.r_[one, two], np.r_[two, gap, one])
    covered = {i for a, b, *_ in found for i in range(a, b)}
    assert covered == set(range(200)) and all(similarity >= 0.8 for *_, similarity in found)


@pytest.mark.parametrize("stock", [0.0, 0.5])
def test_recall_among_stock_sentences_and_version_chains(spark, stock):
    """Of passages in two texts, of edited groups and of chains of versions nine in ten are linked."""
    rng = random.Random(31)
    common = [words(rng, 12) for _ in range(40)]

    def passage(n: int) -> list[str]:
        out: list[str] = []
        while len(out) < n:
            out += rng.choice(common) if rng.random() < stock else words(rng, 12)
        return out[:n]

    def version(of: list[str], edits: int) -> list[str]:
        out = list(of)
        for at in rng.sample(range(len(out)), edits):
            out[at] = f"new{rng.randrange(10**6)}"
        return out

    groups = [[p, p] for p in (passage(100) for _ in range(40))]
    for size in (2, 6, 20):
        of = passage(150)
        groups.append([of, *(version(of, 2) for _ in range(size - 1))])
    chain = [passage(150)]
    for _ in range(7):
        chain.append(version(chain[-1], 2))
    groups.append(chain)
    rows, ids = [], []
    for group in groups:
        ids.append([])
        for p in group:
            ids[-1].append(len(rows))
            text = words(rng, rng.randint(0, 200)) + p + words(rng, rng.randint(0, 200))
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + i, " ".join(passage(150))) for i in range(100)]
    found = passages.near_passages(documents(spark, rows)).collect()
    texts = {i: t.split() for i, t in rows}
    for r in found[:200]:
        one = texts[r["doc_id"]][r["first_word"] : r["last_word"] + 1]
        two = texts[r["of_doc_id"]][r["of_first_word"] : r["of_last_word"] + 1]
        assert jaccard(one, two) >= 0.8
    named = classes(found)
    linked = [named.get(a, -1) == named.get(b, -2) for g in ids for a, b in zip(g, g[1:])]
    assert np.mean(linked) >= 0.9


@pytest.mark.parametrize("block", [7, 2048])
def test_no_link_is_lost_among_texts_with_a_common_phrase(spark, monkeypatch, block):
    """The smallest shingles of most passages are those of a phrase that a hundred other texts have."""
    monkeypatch.setattr(passages, "BLOCK", block)
    rng = random.Random(41)
    phrase = words(rng, 40)  # too short for a passage of its own

    def around(middle: list[str]) -> str:
        return " ".join(words(rng, 30) + middle + words(rng, 30))

    texts = [around(phrase) for _ in range(100)]
    for _ in range(12):
        passage = words(rng, 8) + phrase + words(rng, 8)
        texts += [around(passage), around(passage)]
    named = classes(passages.near_passages(documents(spark, list(enumerate(texts)))).collect())
    assert named == {i: i - i % 2 for i in range(100, 124)}


def test_sketches_of_alike_passages_share_enough_bits(monkeypatch):
    monkeypatch.setattr(passages, "SKETCH", 4)
    rng = np.random.default_rng(5)
    for values in (3, 40, 10**9):
        both = rng.integers(0, values, 37).astype(np.uint64) << np.uint64(20)
        one, two = (
            passages._sketch(np.r_[rng.integers(0, 1 << 60, 100, np.uint64), both]) for _ in range(2)
        )
        shared = int.from_bytes(one[0]) & int.from_bytes(two[0])
        assert shared.bit_count() >= max(one[1], two[1])


def test_a_task_links_alike_windows_of_a_key_in_proportion():
    """Of a hundred classes that are alike, and as many that only share a phrase, links span the former."""
    rng = np.random.default_rng(71)
    phrase, rest = (rng.integers(0, 1 << 32, n, np.uint32) for n in (40, 60))
    rows = []
    for i in range(200):
        end = rest if i % 2 else rng.integers(0, 1 << 32, 60, np.uint32)
        rows.append((5, 7, i, i, 99, 99, 0, np.r_[phrase, end].tobytes()))
    names = ["dealt", "key", "text_id", "class", "at", "near", "part", "stretch"]
    arrays = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:7]] + [pa.array([r[7] for r in rows], pa.binary())]
    whole = pa.RecordBatch.from_arrays(arrays, names=names)
    for size in (30, 200):
        found = [r for b in passages._across(iter([whole.slice(i, size) for i in range(0, 200, size)])) for r in b.to_pylist()]
        assert len(found) == 99 and all(r["text_id"] > r["o_text_id"] for r in found)
        assert {x for r in found for x in (r["text_id"], r["o_text_id"])} == set(range(1, 200, 2))


def test_windows_of_many_texts_are_those_of_each():
    """Of texts laid end to end, some of them blank or short or full of repeats."""
    rng = random.Random(81)
    texts = [" ".join(words(rng, n)) for n in (0, 49, 50, 51, 400)] + ["la " * 300, "x Y " * 60, " \n ", "z" * 300 + " q" * 70]
    texts += [" ".join(rng.choices(words(rng, 30), k=rng.randrange(300))) for _ in range(20)]
    rows, place = passages._windows_of([text.encode() for text in texts])
    for i, text in enumerate(texts):
        tokens, wanted = passages.shingles([text.encode()])[0], set()
        assert tokens.size == max(0, len(text.split()) - 4)
        for function in range(passages.HASHES):
            for low, c, high in passages.windows(passages.hashed(tokens, function)):
                wanted.add(((int(tokens[c].view(np.int64)) & ~3) | function, low, high))
        assert {tuple(row) for row in rows[place == i].tolist()} == wanted


def test_stretches_with_only_a_phrase_in_common_are_not_compared(monkeypatch):
    """Comparing three hundred rows of a key in pairs would take 44,850 comparisons."""
    rng, calls, compare = np.random.default_rng(72), [], passages.compare
    monkeypatch.setattr(passages, "compare", lambda one, two: calls.append(1) or compare(one, two))
    phrase, rest = (rng.integers(0, 1 << 32, n, np.uint32) for n in (40, 60))
    rows = []
    for i in range(300):
        end = rest if i % 100 == 0 else rng.integers(0, 1 << 32, 60, np.uint32)
        rows.append((5, 7, i, i, 99, 99, 0, np.r_[phrase, end].tobytes()))
    names = ["dealt", "key", "text_id", "class", "at", "near", "part", "stretch"]
    arrays = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:7]] + [pa.array([r[7] for r in rows], pa.binary())]
    whole = pa.RecordBatch.from_arrays(arrays, names=names)
    found = [r for b in passages._across(iter([whole])) for r in b.to_pylist()]
    assert {x for r in found for x in (r["text_id"], r["o_text_id"])} == {0, 100, 200}
    assert len(found) == 2 and len(calls) < 300
