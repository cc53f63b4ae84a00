from __future__ import annotations

import random
import time
import tracemalloc

import numpy as np
import pytest

from skyledger.llm import decontam
from tests.llm.helpers import ODD, documents


def brute_align(item, words) -> int:
    table = [[0] * (len(words) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(words) + 1):
            same = decontam.MATCH if item[i - 1] == words[j - 1] else decontam.MISMATCH
            table[i][j] = max(
                0, table[i - 1][j - 1] + same, table[i - 1][j] + decontam.GAP, table[i][j - 1] + decontam.GAP
            )
    return max(map(max, table))


def test_alignment_matches_the_textbook_table():
    rng = random.Random(12)
    for _ in range(200):
        item = np.array(rng.choices(range(6), k=rng.randint(1, 20)))
        words = np.array(rng.choices(range(-1, 6), k=rng.randint(1, 40)))
        score, first, last = decontam.align(item, words)
        assert score == brute_align(item, words)
        if score:
            assert 0 <= first <= last < words.size
            assert brute_align(item, words[first : last + 1]) == score


def textbook_path(item, words):
    """The best score and its place, by the whole table and the way back through it."""
    table = [[0] * (len(words) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(words) + 1):
            same = decontam.MATCH if item[i - 1] == words[j - 1] else decontam.MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + same, table[i - 1][j] - 1, table[i][j - 1] - 1)
    best = max(map(max, table))
    i, j = next((i, j) for i, row in enumerate(table) for j, x in enumerate(row) if x == best)
    last = j - 1
    while table[i][j] > 0:
        same = decontam.MATCH if item[i - 1] == words[j - 1] else decontam.MISMATCH
        if table[i][j] == table[i - 1][j - 1] + same:
            i, j = i - 1, j - 1
        elif table[i][j] == table[i - 1][j] - 1:
            i -= 1
        else:
            j -= 1
    return best, j, last


def test_alignment_without_a_table_finds_the_same_place():
    rng = random.Random(21)
    for _ in range(400):
        item = rng.choices(range(5), k=rng.randint(1, 25))
        words = rng.choices(range(-1, 5), k=rng.randint(1, 50))
        got = decontam.align(np.array(item), np.array(words))
        assert got == textbook_path(item, words)


def test_a_long_item_takes_bounded_memory():
    rng = np.random.default_rng(5)
    item = rng.integers(0, 5000, 8_000)
    words = np.concatenate([rng.integers(0, 5000, 12_000), item, rng.integers(0, 5000, 12_000)])
    words[15_000] = -1
    tracemalloc.start()
    assert decontam.align(item, words) == (8_000 * 2 - 3, 12_000, 19_999)
    assert tracemalloc.get_traced_memory()[1] < 20 << 20
    tracemalloc.stop()


def test_seeds_of_many_items_are_chosen_at_once():
    rng = random.Random(3)
    rows = [(i, " ".join(f"v{rng.randrange(3000)}" for _ in range(50))) for i in range(8_000)]
    index = decontam.build_index(rows)
    counts = {(3, g): rng.randrange(9) for g in range(index.grams[3].size)}
    before = index.places[3]
    start = time.perf_counter()
    decontam.choose_seeds(index, counts)
    assert time.perf_counter() - start < 5
    _, item, place = index.places[3]
    for i in (0, 17, 7_999):
        own = sorted((counts[3, g], g, p) for g, j, p in zip(*(x.tolist() for x in before)) if j == i)
        wanted = [p for _, _, p in own[: decontam.seed_size(50)[1]]]
        assert sorted(place[item == i].tolist()) == sorted(wanted)


def test_equal_and_short_items(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 3)
    docs = documents(spark, [(1, "a b c d e f g h i j and more"), (2, "yes"), (3, "k l m n o p q r"), (4, None)])
    items = [(i, "a b c d e f g h i j") for i in range(40)] + [(None, "a b c d e f g h i j")] * 2
    items += [(50, "Yes"), (51, "k l m n o p q r"), (52, ""), (53, None), (54, "!? --")]
    found = decontam.pairs(decontam.scan(docs, table(spark, items), least_words=8)).collect()
    got = sorted((r["doc_id"], -1 if r["item_id"] is None else r["item_id"]) for r in found)
    assert got == sorted([(1, i) for i in range(40)] + [(1, -1)] * 2 + [(3, 51)])
    short = decontam.too_short(table(spark, items), 8).collect()
    assert sorted(map(tuple, short)) == [(50, 1), (52, 0), (53, 0), (54, 0)]
    whole = decontam.pairs(decontam.scan(docs, table(spark, items))).collect()
    assert (2, 50) in {(r["doc_id"], r["item_id"]) for r in whole}


def test_very_long_texts_and_items(spark):
    rng = random.Random(9)
    item = " ".join(f"v{rng.randrange(4000)}" for _ in range(3_000))
    text = " ".join(f"u{rng.randrange(4000)}" for _ in range(200_000))
    docs = documents(spark, [(1, text), (2, f"{text} {item} {text}"), (3, "x" * 3_000_000)])
    (row,) = decontam.pairs(decontam.scan(docs, table(spark, [(5, item)]))).collect()
    assert (row["doc_id"], row["score"], row["first_word"], row["last_word"]) == (2, 1.0, 200_000, 202_999)


def edited(rng: random.Random, words: list[str], edits: int) -> list[str]:
    out = list(words)
    for at in sorted(rng.sample(range(len(words)), edits), reverse=True):
        kind = rng.choice("sid")
        if kind == "s":
            out[at] = f"new{rng.random()}"
        elif kind == "i":
            out.insert(at, f"new{rng.random()}")
        else:
            del out[at]
    return out


def table(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, lang string")


@pytest.mark.parametrize("block", [20_000, 7])
def test_every_copy_with_few_edits_is_found_and_nothing_else(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", block)
    monkeypatch.setattr(decontam, "BATCH_WORDS", 300)
    rng = random.Random(13)
    vocabulary = [f"v{i}" for i in range(300)] + ["the", "of", "and"] * 40
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(8, 60)))) for i in range(25)]
    rows, wanted = list(ODD), set()
    for n in range(200):
        before = rng.choices(vocabulary, k=rng.randint(0, 80))
        after = rng.choices(vocabulary, k=rng.randint(0, 80))
        if n % 2:
            i, text = rng.choice(items)
            words = text.split()
            copy = edited(rng, words, rng.randint(0, int(decontam.EDITS * len(words))))
            wanted.add((1000 + n, i))
        else:
            copy = []
        rows.append((1000 + n, " ".join(before + copy + after).upper() + "."))
    found = decontam.pairs(
        decontam.scan(documents(spark, rows), table(spark, [*items, (90, None), (91, ""), (92, "?!")]))
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} >= wanted
    clean = {(r["doc_id"], r["item_id"]) for r in found} - wanted
    texts = dict(rows)
    for doc, item in clean:  # only what the alignment itself shows to be there
        own, words = decontam.words_of(dict(items)[item].encode()), decontam.words_of(texts[doc].encode())
        assert brute_align(own, words) >= decontam.SCORE * decontam.MATCH * len(own)
    for r in found:
        own = decontam.words_of(dict(items)[r["item_id"]].encode())
        words = decontam.words_of(texts[r["doc_id"]].encode())
        assert brute_align(own, words) == pytest.approx(r["score"] * decontam.MATCH * len(own))


def test_short_items_repeated_ids_and_empty_tables(spark):
    docs = documents(spark, [*ODD, (7, "say hello there world now"), (8, "hello")])
    items = table(spark, [(1, "hello there world"), (2, "Hello"), (2, "one"), (None, "now")])
    found = decontam.pairs(decontam.scan(docs, items)).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got == {(7, 1), (7, 2), (8, 2), (105, 2), (7, None)}
    assert decontam.scan(docs.limit(0), items).count() == 0
    empty = decontam.scan(docs, items.limit(0), keep_text=True)
    assert empty.columns == [*docs.columns, "__leaks"]
    assert {len(r["__leaks"]) for r in empty.collect()} == {0}


def test_seeds_are_the_rarest_and_enough(spark):
    for length in range(1, 400):
        n, seeds = decontam.seed_size(length)
        edits = int(decontam.EDITS * length)
        assert length - n + 1 - n * edits >= 1 and seeds + (length - n + 1 - n * edits) - 1 == length - n + 1
    index = decontam.build_index([(1, "a b c d e f g h i j k l m n")])
    docs = spark.createDataFrame([("a b c d e f g",)] * 5, "text string")
    counts = decontam.gram_counts(docs, index)
    assert sorted(counts.values()) == [5] * 5
    decontam.choose_seeds(index, counts)
    assert index.grams[3].size == decontam.seed_size(14)[1]
