from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import trees
from skyledger.llm.queries import QUERIES
from tests.llm.helpers import ODD, documents


def area(labels, scores):
    """The share of pairs of different labels in the right order, by all pairs."""
    good = [s for y, s in zip(labels, scores, strict=True) if y]
    bad = [s for y, s in zip(labels, scores, strict=True) if not y]
    return np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])


def walk(forest, row):
    """One row through all trees, node by node."""
    total = forest.base
    for feature, cut, value in zip(forest.feature, forest.cut, forest.value, strict=True):
        i = 0
        while i < len(feature):
            i = 2 * i + 1 + (row[feature[i]] > cut[i])
        total += value[i - len(feature)]
    return 1 / (1 + math.exp(-total))


def sample(n=600, columns=4, seed=3):
    rng = np.random.default_rng(seed)
    rows = np.round(rng.normal(size=(n, columns)), 1)
    labels = ((rows[:, 0] > 0.2) ^ (rows[:, 1] > 0)).astype(int)
    return rows, labels


def test_traversal_of_all_trees_at_once():
    rows, labels = sample()
    forest = trees.fit(rows, labels, np.ones(len(rows)))
    assert forest.feature.shape == (trees.TREES, 2**trees.DEPTH - 1)
    assert np.allclose(forest.score(rows), [walk(forest, r) for r in rows])
    assert area(labels, forest.score(rows)) > 0.99


def test_first_cut_is_the_best_of_all(monkeypatch):
    monkeypatch.setattr(trees, "TREES", 1)
    monkeypatch.setattr(trees, "DEPTH", 1)
    rows, labels = sample(seed=8)
    weights = np.where(labels, 0.5, 1.5)
    forest = trees.fit(rows, labels, weights)
    p = (weights @ labels + 1) / (weights.sum() + 2)
    pull, weight = weights * (labels - p), weights * p * (1 - p)

    def worth(chosen):
        return pull[chosen].sum() ** 2 / (weight[chosen].sum() + trees.RIDGE)

    best = []
    for column, cuts in enumerate(trees.edges(rows)):
        for cut in cuts:
            low = rows[:, column] <= cut
            if min(weight[low].sum(), weight[~low].sum()) >= trees.LEAST_WEIGHT:
                best.append((worth(low) + worth(~low), column, cut))
    _, column, cut = max(best)
    assert (forest.feature[0, 0], forest.cut[0, 0]) == (column, cut)
    low = rows[:, column] <= cut
    for leaf, chosen in enumerate((low, ~low)):
        wanted = trees.RATE * pull[chosen].sum() / (weight[chosen].sum() + trees.RIDGE)
        assert forest.value[0, leaf] == pytest.approx(wanted)


def test_one_label_or_none():
    rows, _ = sample(50)
    none = trees.fit(rows[:0], np.empty(0), np.empty(0))
    assert none.score(rows).tolist() == [0.5] * 50
    ones = trees.fit(rows, np.ones(50), np.ones(50))
    assert len(set(ones.score(rows))) == 1 and ones.score(rows)[0] > 0.9
    assert none.score(rows[:0]).size == 0


def test_statistics_of_blocks_are_those_of_the_text(monkeypatch):
    text = ("The Word 12 !! " * 700 + "\nAnother LINE, of words.\n" * 300).encode()
    classes = trees._classes()
    whole = dict(zip(trees.STATISTICS, trees.statistics(text, classes), strict=True))
    words = text.split()
    assert whole["log_words"] == pytest.approx(math.log1p(len(words)))
    assert whole["word_length"] == pytest.approx(sum(map(len, words)) / len(words))
    assert whole["capital_words"] == pytest.approx(sum(w.isupper() for w in words) / len(words))
    assert whole["digits"] == pytest.approx(1400 / len(text))
    assert whole["exclamations"] == pytest.approx(1400 / len(text))
    from skyledger.llm import common

    monkeypatch.setattr(trees, "blocks_of_words", lambda data: common.blocks_of_words(data, 500))
    parts = dict(zip(trees.STATISTICS, trees.statistics(text, classes), strict=True))
    cut = {"distinct_words", "least_distinct_words"}  # windows end with their block
    assert all(parts[k] == pytest.approx(whole[k]) for k in whole if k not in cut)
    for odd in (b"", b" \n ", b"\xff\x00", b"x" * 3_000_000, b"ab " * 500_000):
        found = trees.statistics(odd, classes)
        assert len(found) == len(trees.STATISTICS) and np.isfinite(found).all()


def corpus():
    rng = random.Random(6)
    words = ["tree", "house", "river", "walk", "green", "light", "stone", "over", "under", "the", "of"]
    rows, labels = [], []
    for i in range(400):
        good = i % 4 > 0
        picked = rng.choices(words, k=rng.randint(5, 80))
        text = " ".join(picked) + "." if good else " ".join(w + "$$$" for w in picked)
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_only_learning_rows_count(spark):
    rows, labels = corpus()
    kinds = "doc_id long, quality int, toxic int"
    docs = documents(spark, rows)
    forest = trees.trained(docs, spark.createDataFrame(labels, kinds))
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in labels]
    turned = [(i, 1 - q if h else q, t) for (i, q, t), h in zip(labels, held, strict=True)]
    more = [*turned, *turned[:7], (None, 1, 1), (3, None, 0)]  # repeated, no id, no label
    again = trees.trained(docs, spark.createDataFrame(more, kinds).repartition(5))
    for name in ("base", "feature", "cut", "value"):
        assert np.array_equal(getattr(forest, name), getattr(again, name))
    found = {r["doc_id"]: r["__score"] for r in trees.score(docs, forest).collect()}
    wanted = [q for (_, q, _), h in zip(labels, held, strict=True) if h]
    assert area(wanted, [found[i] for (i, _, _), h in zip(labels, held, strict=True) if h]) > 0.99


def test_bounded_sample_keeps_the_share_of_labels(spark, monkeypatch):
    monkeypatch.setattr(trees, "SAMPLE_ROWS", 40)
    rows, labels = corpus()
    forest = trees.trained(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    known = [q for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5]
    share = sum(known) / len(known)
    assert forest.base == pytest.approx(math.log((80 * share + 1) / (80 * (1 - share) + 1)), rel=1e-6)


def test_odd_rows_and_empty_tables(spark):
    rows, labels = corpus()
    docs = documents(spark, rows + ODD)
    kinds = "doc_id long, quality int, toxic int"
    forest = trees.trained(docs, spark.createDataFrame([*labels, (108, 1, 0), (108, 0, 0), (102, 0, 0), (5000, 0, 0)], kinds))
    found = trees.score(docs, forest)
    assert found.columns == [c for c in docs.columns if c != "text"] + ["__score"]
    scores = [r["__score"] for r in found.collect()]
    assert len(scores) == len(rows + ODD) and all(0 <= s <= 1 for s in scores)
    assert trees.score(docs.limit(0), forest).count() == 0
    nothing = trees.trained(docs.limit(0), spark.createDataFrame(labels, kinds))
    assert {r["__score"] for r in trees.score(docs, nothing).collect()} == {0.5}
    nothing = trees.trained(docs, spark.createDataFrame([], kinds))
    assert {r["__score"] for r in trees.score(docs, nothing).collect()} == {0.5}


def test_held_out_labels_of_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op13_quality"](spark, sf_dir)
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = found.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert area([r["quality"] for r in held], [r["score"] for r in held]) > 0.97
    assert np.mean([r["quality"] == r["predicted"] for r in held]) > 0.95
    assert found.filter(F.col("score").isNull()).count() == 0
