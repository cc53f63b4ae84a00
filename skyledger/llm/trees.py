"""A quality classifier: histogram gradient-boosted trees over statistics of documents.

Every text becomes a row of ``STATISTICS``, numbers about its bytes, words and lines that do
not depend on its language, source or id. Trees of one depth are grown level by level: values
are put into at most ``BINS`` bins by the quantiles of the sample, the gradients of the
logistic loss are summed per node, statistic and bin, and each node is cut where the gain is
greatest. The trees lie in two arrays, cut by node and value by leaf, so that numpy passes a
batch of texts through all trees at once, a level at a time.

Labelled texts are the training sample, at most ``SAMPLE_ROWS`` of each label, those with the
least hash of their id; each label weighs in training what it weighs among all labels that
may be learned from.
All texts are scored, whole: statistics are made in blocks and windows, so memory does not
grow with a text beyond the text itself.

A NULL text counts as empty, and an empty text has a score as well. A document with several
labels is learned from once for each; of texts with the same id one is learned from, and
labels without a text or an id from none. Without any labels every score is 0.5.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import blocks_of_words, share

#: The bound of the training sample: documents of each label.
SAMPLE_ROWS = 10_000
#: The trees.
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
#: Regularisation: added to the weight of a node, least weight of a node, least gain of a cut.
RIDGE = 1.0
LEAST_WEIGHT = 8.0
LEAST_GAIN = 1e-3
#: The score from which a text is taken for label 1.
ACCEPTED = 0.3
#: Words or lines in a window, in which they are compared with each other.
WINDOW = 256

STATISTICS = [
    "log_bytes", "log_words", "log_lines", "letters", "capitals", "digits", "blanks",
    "stops", "commas", "exclamations", "bars", "symbols", "other_marks", "beyond_ascii",
    "byte_entropy", "word_length", "word_spread", "capital_words", "titled_words",
    "one_byte_words", "repeated_words", "distinct_words", "least_distinct_words",
    "distinct_lines", "words_per_line", "longest_word",
]


def _classes() -> np.ndarray:
    """Byte x class of ``letters`` to ``beyond_ascii``."""
    sets = [
        bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b" \t\n\r\x0b\x0c", b".?", b",;:", b"!",
        b"|", b"#*$%&<>", b"\"'()-_/\\[]{}@^`~+=", bytes(range(128, 256)),
    ]
    table = np.zeros((256, len(sets)))
    for k, members in enumerate(sets):
        table[list(members), k] = 1
    return table


def distinct(items: list[bytes]) -> list[float]:
    """The share of different ``items`` in each window of them."""
    windows = (items[i : i + WINDOW] for i in range(0, len(items), WINDOW))
    return [len(set(w)) / len(w) for w in windows]


def statistics(data: bytes, classes: np.ndarray) -> list[float]:
    """The ``STATISTICS`` of a text."""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(float)
    n_bytes = max(len(data), 1)
    shares = counts[counts > 0] / n_bytes
    n_words = length = squares = capital = titled = single = repeated = longest = 0
    windows: list[float] = []
    last = b""
    for words in blocks_of_words(data):
        if not words:
            continue
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n_words += len(words)
        length += int(lengths.sum())
        squares += int((lengths * lengths).sum())
        longest = max(longest, int(lengths.max()))
        single += int((lengths == 1).sum())
        capital += sum(map(bytes.isupper, words))
        titled += sum(map(bytes.istitle, words))
        repeated += (words[0] == last) + sum(map(operator.eq, words, words[1:]))
        windows += distinct(words)
        last = words[-1]
    n = max(n_words, 1)
    mean = length / n
    lines = [line for line in data.split(b"\n") if line.strip()]
    line_windows = distinct(lines)
    return [
        np.log1p(len(data)), np.log1p(n_words), np.log1p(len(lines)),
        *(counts @ classes / n_bytes),
        -float(shares @ np.log2(shares)) if data else 0.0,
        mean, max(squares / n - mean * mean, 0.0) ** 0.5, capital / n, titled / n, single / n, repeated / n,
        float(np.mean(windows)) if windows else 1.0, min(windows, default=1.0),
        float(np.mean(line_windows)) if lines else 1.0, n_words / max(len(lines), 1), np.log1p(longest),
    ]


def matrix(texts: Iterator[bytes | None]) -> np.ndarray:
    """Text x statistic."""
    classes = _classes()
    return np.array([statistics(t or b"", classes) for t in texts]).reshape(-1, len(STATISTICS))


# ---- trees ----


@dataclass
class Forest:
    """Trees by node: its children are 2 i + 1 (at most the cut) and 2 i + 2."""

    base: float
    feature: np.ndarray  # tree x inner node
    cut: np.ndarray  # tree x inner node
    value: np.ndarray  # tree x leaf

    def margin(self, rows: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(rows), self.base)
        tree = np.arange(trees)[None, :]
        node = np.zeros((len(rows), trees), np.int64)
        row = np.arange(len(rows))[:, None]
        while inner:
            node = 2 * node + 1 + (rows[row, self.feature[tree, node]] > self.cut[tree, node])
            inner //= 2
        leaf = node - self.feature.shape[1]
        return self.base + self.value[tree, leaf].sum(axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of label 1."""
        parts = [self.margin(rows[i : i + 4096]) for i in range(0, len(rows), 4096)]
        return 1 / (1 + np.exp(-np.concatenate(parts))) if parts else np.empty(0)


def edges(rows: np.ndarray) -> list[np.ndarray]:
    """The cuts between the bins of every column."""
    shares = np.arange(1, BINS) / BINS
    return [np.unique(np.quantile(column, shares, method="lower")) for column in rows.T]


def best_cuts(histogram: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gain and the number of the best cut of every node.

    ``histogram``: gradient and weight x node x column x bin; ``whole``: the same by node.
    """
    left = np.cumsum(histogram, axis=3)
    right = whole[:, :, None, None] - left

    def worth(sums: np.ndarray) -> np.ndarray:
        return sums[0] ** 2 / (sums[1] + RIDGE)

    gain = worth(left) + worth(right) - worth(whole)[:, None, None]
    gain[(left[1] < LEAST_WEIGHT) | (right[1] < LEAST_WEIGHT)] = -np.inf
    flat = gain.reshape(gain.shape[0], -1)
    best = flat.argmax(axis=1)
    return flat[np.arange(len(best)), best], best


def fit(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Forest:
    """Trees for ``labels`` of 0 and 1; ``weights`` have a mean of about 1."""
    mean = (weights @ labels + 1) / (weights.sum() + 2)
    base = float(np.log(mean / (1 - mean)))
    inner = 2**DEPTH - 1
    forest = Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not len(rows) or labels.min() == labels.max():
        return forest
    n, columns = rows.shape
    cuts = edges(rows)
    bins = np.stack([np.searchsorted(c, rows[:, k]) for k, c in enumerate(cuts)], axis=1)
    ends = np.full((columns, BINS), np.inf)
    for k, c in enumerate(cuts):
        ends[k, : len(c)] = c
    column_bin = bins + np.arange(columns) * BINS
    margin = np.full(n, base)
    feature, cut, value = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        sums = np.stack([weights * (labels - p), weights * np.maximum(p * (1 - p), 1e-6)])
        node = np.zeros(n, np.int64)
        tree_feature, tree_cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            width = 2**level
            cell = (node[:, None] * columns * BINS + column_bin).ravel()
            histogram = np.stack([
                np.bincount(cell, np.repeat(s, columns), width * columns * BINS) for s in sums
            ]).reshape(2, width, columns, BINS)
            gain, best = best_cuts(histogram, histogram[:, :, 0].sum(axis=2))
            column, at = best // BINS, best % BINS
            good = gain > LEAST_GAIN
            place = width - 1 + np.arange(width)
            tree_feature[place] = np.where(good, column, 0)
            tree_cut[place] = np.where(good, ends[column, at], np.inf)
            right = good[node] & (bins[np.arange(n), column[node]] > at[node])
            node = 2 * node + right
        leaf = np.stack([np.bincount(node, s, inner + 1) for s in sums])
        leaf_value = RATE * leaf[0] / (leaf[1] + RIDGE)
        margin += leaf_value[node]
        feature.append(tree_feature)
        cut.append(tree_cut)
        value.append(leaf_value)
    return Forest(base, np.array(feature), np.array(cut), np.array(value))


# ---- tables ----


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def described(df: DataFrame) -> DataFrame:
    """``df`` with an array ``statistics`` in place of ``text``."""
    kept = [f for f in df.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("statistics", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
            rows = matrix(t.as_py() for t in texts)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            columns.append(pa.array(list(rows), pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def trained(docs: DataFrame, labels: DataFrame) -> Forest:
    """A model of ``labels`` (doc_id, quality), from those that are not held out."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    known = known.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.distinct()
    totals = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id", F.lit("quality sample")), "doc_id"]
    parts = [known.filter(F.col("quality") == q).orderBy(*order).limit(SAMPLE_ROWS) for q in (0, 1)]
    sample = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 x SAMPLE_ROWS rows of two numbers
    found = described(docs.select("doc_id", "text").join(sample, "doc_id"))
    rows = found.groupBy("doc_id", "quality").agg(F.min("statistics").alias("statistics"))
    rows = sorted((r["doc_id"], r["quality"], r["statistics"]) for r in rows.collect())
    if not rows:
        return fit(np.empty((0, len(STATISTICS))), np.empty(0), np.empty(0))
    y = np.array([r[1] for r in rows])
    weights = np.ones(len(y))
    for q in (0, 1):
        weights[y == q] = totals.get(q, 0) / max((y == q).sum(), 1)
    return fit(np.array([r[2] for r in rows]), y, weights / weights.mean())


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """``docs`` with the probability of label 1 in ``__score`` in place of ``text``."""
    model = share(docs.sparkSession, forest)
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("__score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
            scores = trees.score(matrix(t.as_py() for t in texts))
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)
