"""Language-model scores by masked pseudo-likelihood.

A token is a frequent word, or the class of a rarer one by its ending. A network
sees ``SIDE`` tokens before and after a masked place and gives the distribution of
the token there; a rarer word has a probability within its class, by its count over
all texts and by its spelling. The logarithms of what both give to the words that do
stand there add up to the score of a text. The network is trained over all texts: in each round
every task goes on training from the same weights on its own texts, and the weights
are averaged by the number of places that each task has seen.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import materialize, share
from skyledger.llm.decontam import words_of

#: Frequent words with a token of their own, and classes of the others.
WORDS, CLASSES = 191, 64
TOKENS = 1 + WORDS + CLASSES  # token 0 stands beyond the ends of a text
SIDE, WIDTH, HIDDEN = 2, 12, 32
#: Rounds of training, each on every ``STRIDE``-th place, others in each round: together on all of them.
ROUNDS, STRIDE = 2, 2
BATCH, RATE = 256, 0.1
#: Words that a task counts before it hands the counts on, and places that it scores at once.
COUNTED, SCORED = 300_000, 1024
#: Rarer words with a count of their own; what a count lends to words that are only spelled.
KNOWN, LENT = 200_000, 0.5
#: Words whose probabilities a task keeps, and numbers of spellings that a task holds before it hands them on.
STORE, SPELLED = 300_000, 300_000

_CELLS = np.arange(TOKENS * WIDTH).reshape(TOKENS, WIDTH)

Weights = list[np.ndarray]


def start_weights() -> Weights:
    draw = np.random.default_rng(0)
    return [
        draw.normal(0, 0.1, (TOKENS, WIDTH)).astype(np.float32),
        draw.normal(0, (2 * SIDE * WIDTH) ** -0.5, (2 * SIDE * WIDTH, HIDDEN)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        draw.normal(0, 0.05, (HIDDEN, TOKENS)).astype(np.float32),
        np.zeros(TOKENS, np.float32),
    ]


class Endings(dict):
    """The tokens of classes by the last three bytes of a word, made when they are asked for."""

    def __missing__(self, ending: bytes) -> int:
        if len(self) > STORE:
            self.clear()
        token = self[ending] = 1 + WORDS + zlib.crc32(ending) % CLASSES
        return token


@dataclass
class Vocabulary:
    words: dict[bytes, int]

    def __post_init__(self):
        self.ends = Endings()

    def tokens(self, data: bytes) -> np.ndarray:
        """The tokens of a text; a rarer word's class is that of its last three bytes."""
        return self.tokens_of(words_of(data))

    def tokens_of(self, words: list[bytes]) -> np.ndarray:
        get, ends = self.words.get, self.ends
        return np.fromiter([get(w) or ends[w[-3:]] for w in words], np.int64, len(words))


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def steps_of(word: bytes) -> list[int]:
    """The bytes before the last three from the last on, and the beginning, each with the two after it."""
    if len(word) < 3:
        return []
    before = [256, *word[:-1]]
    return [before[i] << 16 | word[i] << 8 | word[i + 1] for i in range(len(word) - 3, -1, -1)]


@dataclass
class Spelling:
    """Probabilities of the rarer words within their classes.

    A word with a count has its share of the class less ``LENT``; what all of them lend,
    and the words without one, is spread over all words by their spelling: the ending,
    and each byte before it given the two after it, as in the distinct words. The
    probabilities of all words of a class add up to at most 1.
    """

    counts: dict[bytes, int]
    totals: dict[int, int]  # occurrences by class
    kinds: dict[int, int]  # distinct words by class
    endings: dict[bytes, int]
    steps: dict[int, int]

    def __post_init__(self):
        self.kept, self.after = dict.fromkeys(self.totals, 0.0), {}
        for word, n in self.counts.items():
            self.kept[class_of(word)] += n - LENT
        for step, n in self.steps.items():
            self.after[step & 0xFFFF] = self.after.get(step & 0xFFFF, 0) + n
        # The same in arrays: by class, by the two bytes of a step, and by step.
        self.by_class = np.zeros((3, CLASSES))
        for row, numbers in zip(self.by_class, (self.kinds, self.totals, self.kept), strict=True):
            for i, n in numbers.items():
                row[i] = n
        self.by_pair = np.zeros(1 << 16)
        for pair, n in self.after.items():
            self.by_pair[pair] = n
        keys = np.array(sorted(self.steps) or [-1], np.int64)
        self.by_step = keys, np.array([self.steps.get(k, 0) for k in keys.tolist()], np.float64)

    def spelled(self, word: bytes) -> float:
        ending, kinds = self.endings.get(word[-3:], 0), self.kinds.get(class_of(word), 0)
        # There are about 2 ** 18 endings of each class.
        total = math.log((ending or 2.0**-18) / (kinds + 1))
        for step in steps_of(word):
            n = self.after.get(step & 0xFFFF, 0)
            total += math.log((self.steps.get(step, 0) + 1 / 257) / (n + 1))
        return total

    def log_probability(self, word: bytes) -> float:
        spelled = self.spelled(word)
        whole = self.totals.get(class_of(word), 0)
        if not whole:
            return spelled
        kept = self.kept[class_of(word)]
        lent = math.log((whole - kept) / whole) + spelled
        n = self.counts.get(word, 0)
        return float(np.logaddexp(math.log((n - LENT) / whole), lent)) if n else lent

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """``log_probability`` of each of ``words``, which may not be empty."""
        n = len(words)
        classes = np.fromiter(map(class_of, words), np.int64, n)
        endings = np.fromiter((self.endings.get(w[-3:], 0) for w in words), np.float64, n)
        counts = np.fromiter((self.counts.get(w, 0) for w in words), np.float64, n)
        total = np.log(np.where(endings > 0, endings, 2.0**-18) / (self.by_class[0][classes] + 1))
        # The steps of all words: each place but the last two of a word.
        line = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(sizes)
        inside = np.ones(line.size, bool)
        inside[ends - 1] = False
        inside[(ends - 2)[sizes > 1]] = False
        before = np.r_[256, line[:-1]]
        before[(ends - sizes)] = 256
        at = np.flatnonzero(inside)
        after = line[at] << 8 | line[at + 1]
        step = before[at] << 16 | after
        keys, found = self.by_step
        place = np.minimum(np.searchsorted(keys, step), keys.size - 1)
        seen = np.where(keys[place] == step, found[place], 0)
        parts = np.log((seen + 1 / 257) / (self.by_pair[after] + 1))
        of = np.repeat(np.arange(n), np.maximum(sizes - 2, 0))
        total += np.bincount(of, parts, n)
        whole, kept = self.by_class[1][classes], self.by_class[2][classes]
        some = whole > 0
        total[some] += np.log((whole - kept)[some] / whole[some])
        known = some & (counts > 0)
        total[known] = np.logaddexp(np.log((counts[known] - LENT) / whole[known]), total[known])
        return total


class Store(dict):
    """Log-probabilities of words within their tokens; ``learn`` must have seen the words that are asked for."""

    def __init__(self, spelling: Spelling, vocab: Vocabulary):
        super().__init__()
        self.spelling, self.vocab = spelling, vocab

    def learn(self, texts: list[list[bytes]]) -> None:
        if len(self) > STORE:
            self.clear()
        new = list({w for words in texts for w in words if w not in self})
        own = [w for w in new if w not in self.vocab.words]
        self.update(dict.fromkeys(new, 0.0))
        for i in range(0, len(own), SPELLED):
            part = own[i : i + SPELLED]
            self.update(zip(part, self.spelling.log_probabilities(part).tolist(), strict=True))


def contexts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens around each token of ``texts`` (place x 2 SIDE), and the tokens."""
    gap = np.zeros(SIDE, np.int64)
    line = np.concatenate([gap, *(x for text in texts for x in (text, gap))])
    starts = np.cumsum([SIDE, *(text.size + SIDE for text in texts)])[:-1]
    sizes = np.array([text.size for text in texts], np.int64)
    at = np.repeat(starts, sizes) + np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    offsets = [k for k in range(-SIDE, SIDE + 1) if k]
    return np.stack([line[at + k] for k in offsets], axis=1), line[at]


def _forward(weights: Weights, around: np.ndarray):
    """What the network sees and makes of it; the outputs have any number added to a whole row."""
    table, w1, b1, w2, b2 = weights
    seen = table.take(around.ravel(), axis=0).reshape(len(around), -1)
    inner = seen @ w1
    inner += b1
    hidden = np.ones((len(around), HIDDEN + 1), inner.dtype)  # the last column is for ``b2``
    np.tanh(inner, out=hidden[:, :-1])
    last = np.concatenate([w2, b2[None]])
    out = hidden @ last
    # What is hidden is at most 1. Only large weights can make outputs whose exponentials overflow or vanish.
    if np.abs(last).sum(axis=0).max() > 60:
        out -= out.max(axis=1, keepdims=True)
    return seen, hidden, out


def log_probabilities(weights: Weights, around: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Of each token given the tokens around it."""
    parts, ones = [np.empty(0, np.float32)], np.ones(TOKENS, weights[3].dtype)
    for i in range(0, len(tokens), SCORED):
        _, _, out = _forward(weights, around[i : i + SCORED])
        own = out[np.arange(len(out)), tokens[i : i + SCORED]]
        parts.append(own - np.log(np.exp(out, out=out) @ ones))
    return np.concatenate(parts)


def slopes(weights: Weights, around: np.ndarray, tokens: np.ndarray) -> Weights:
    """The gradient of the mean negative log-probability."""
    table, w1, _, w2, _ = weights
    seen, hidden, out = _forward(weights, around)
    np.exp(out, out=out)
    total = out @ np.ones(TOKENS, out.dtype)
    out[np.arange(len(out)), tokens] -= total
    # Rows of ``out`` times ``scale`` are the slopes; the smaller factors are scaled in their place.
    scale = (1 / (total * len(out)))[:, None]
    inner = out @ w2.T
    inner *= scale * (1 - hidden[:, :-1] ** 2)
    back = (inner @ w1.T).ravel()
    spread = np.bincount(_CELLS.take(around.ravel(), axis=0).ravel(), back, table.size).reshape(table.shape).astype(table.dtype)
    hidden *= scale
    last = out.T @ hidden
    return [spread, seen.T @ inner, inner.sum(axis=0), last[:, :-1].T, last[:, -1]]


class Trainer:
    """Adagrad from given weights."""

    def __init__(self, weights: Weights):
        self.flat = np.concatenate([w.ravel() for w in weights])
        ends = np.cumsum([w.size for w in weights])
        parts = np.split(self.flat, ends[:-1])
        self.weights = [part.reshape(w.shape) for part, w in zip(parts, weights, strict=True)]
        self.squares = np.full_like(self.flat, 1e-6)
        self.places = 0

    def learn(self, around: np.ndarray, tokens: np.ndarray) -> None:
        for i in range(0, len(tokens), BATCH):
            made = slopes(self.weights, around[i : i + BATCH], tokens[i : i + BATCH])
            slope = np.concatenate([x.ravel() for x in made])
            self.squares += slope * slope
            slope /= np.sqrt(self.squares)
            slope *= RATE
            self.flat -= slope
        self.places += len(tokens)


# ---- over all texts ----


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (binary) and ``n`` of all words of all texts, counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def given():
            return pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
                names=["word", "n"],
            )

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                counts.update(words_of(text.as_py() or b""))
                if len(counts) > COUNTED:
                    yield given()
                    counts = Counter()
        yield given()

    counted = docs.select("text").mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame) -> Vocabulary:
    """The ``WORDS`` most frequent words; of equally frequent ones those first in byte order."""
    return most_frequent(materialize(word_counts(docs), "word-counts"))


def most_frequent(counts: DataFrame) -> Vocabulary:
    """As ``vocabulary``, of ``word_counts`` that are there."""
    rows = counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()
    return Vocabulary({bytes(r["word"]): i for i, r in enumerate(rows, 1)})


def spelling(counts: DataFrame, vocab: Vocabulary) -> Spelling:
    """How the words of ``word_counts`` that are not in ``vocab`` are distributed.

    All of them take part. The driver gets at most ``KNOWN`` words with their counts, none
    rarer than one that is left out, and the numbers of endings and steps.
    """
    cut, known = 1, 0
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n"))
    for row in sizes.collect():
        known += row["words"]
        if known > KNOWN + WORDS:
            cut = row["n"] + 1
            break
    shared = share(counts.sparkSession, vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, found = shared().words, {}

        def given():
            numbers = [(*key, n) for key, n in found.items()]
            kinds = [pa.string(), pa.binary(), pa.int64()]
            arrays = [pa.array([x[i] for x in numbers], k) for i, k in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=["kind", "key", "n"])

        def add(kind: str, key: bytes, n: int = 1):
            found[kind, key] = found.get((kind, key), 0) + n

        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if word in words:
                    continue
                own = bytes([class_of(word)])
                add("total", own, n)
                add("kinds", own)
                add("ending", word[-3:])
                for step in steps_of(word):
                    add("step", step.to_bytes(4))
                if len(found) > SPELLED:
                    yield given()
                    found = {}
        yield given()

    parts = counts.select("word", "n").mapInArrow(run, "kind string, key binary, n long")
    table = parts.groupBy("kind", "key").agg(F.sum("n").alias("n")).toArrow()
    made: dict[str, dict] = {"total": {}, "kinds": {}, "ending": {}, "step": {}}
    for kind, key, n in zip(*(table.column(i).to_pylist() for i in range(3)), strict=True):
        made[kind][key if kind == "ending" else int.from_bytes(key)] = n
    table = counts.filter(F.col("n") >= cut).select("word", "n").toArrow()
    own = dict(zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True))
    own = {w: n for w, n in own.items() if w not in vocab.words}
    return Spelling(own, made["total"], made["kinds"], made["ending"], made["step"])


def turn_places(n: int, turn: int) -> np.ndarray:
    """Which of ``n`` places are learned from in round ``turn``; each is in one of ``ROUNDS``."""
    return np.arange(turn * STRIDE // ROUNDS, n, STRIDE)


def train_round(docs: DataFrame, vocab: Vocabulary, weights: Weights, turn: int) -> Weights:
    """The mean of what all tasks learn from ``weights``, by the places that each has seen.

    The means are made in Spark, weight by weight; the driver gets the weights once.
    """
    shared = share(docs.sparkSession, (vocab, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, weights = shared()
        trainer = Trainer(weights)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                texts = batch.column(0).slice(start, 256).cast(pa.binary())
                around, tokens = contexts([vocab.tokens(x.as_py() or b"") for x in texts])
                chosen = turn_places(len(tokens), turn)
                trainer.learn(around[chosen], tokens[chosen])
        if trainer.places:
            flat = np.concatenate([w.ravel() for w in trainer.weights]).astype(np.float64)
            yield pa.RecordBatch.from_pydict(
                {
                    "i": pa.array(np.arange(flat.size), pa.int32()),
                    "w": pa.array(flat * trainer.places),
                    "n": pa.array(np.full(flat.size, trainer.places)),
                }
            )

    parts = docs.select("text").mapInArrow(run, "i int, w double, n long").groupBy("i")
    means = parts.agg((F.sum("w") / F.sum("n")).alias("w")).collect()
    if not means:
        return weights
    flat = np.empty(len(means), np.float32)
    for row in means:
        flat[row["i"]] = row["w"]
    out, start = [], 0
    for w in weights:
        out.append(flat[start : start + w.size].reshape(w.shape))
        start += w.size
    return out


def fit(docs: DataFrame) -> tuple[Vocabulary, Weights]:
    """A vocabulary and a network of all texts of ``docs``; NULL texts add nothing."""
    vocab = vocabulary(docs)
    return vocab, train(docs, vocab)


def fit_words(docs: DataFrame) -> tuple[Vocabulary, Weights, Spelling]:
    """As ``fit``, and the probabilities of rarer words within their classes."""
    counts = materialize(word_counts(docs), "word-counts")
    vocab = most_frequent(counts)
    return vocab, train(docs, vocab), spelling(counts, vocab)


def train(docs: DataFrame, vocab: Vocabulary) -> Weights:
    docs, weights = docs.select("text"), start_weights()
    for turn in range(ROUNDS):
        weights = train_round(docs, vocab, weights, turn)
    return weights


def score(
    docs: DataFrame, vocab: Vocabulary, weights: Weights, spelling: Spelling | None = None
) -> DataFrame:
    """``docs`` without ``text``, with ``__n_tokens`` and ``__log_likelihood``.

    ``__log_likelihood`` is the sum of the conditional log-probabilities of all tokens of
    the whole text, with ``spelling`` of all its words; 0 for a text without words, NULL
    among them. Rows stay where they are.
    """
    shared = share(docs.sparkSession, (vocab, weights, spelling))
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType(
        [
            *kept,
            T.StructField("__n_tokens", T.LongType()),
            T.StructField("__log_likelihood", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, weights, spelling = shared()
        store = Store(spelling, vocab) if spelling else None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                column = rows.column(rows.schema.get_field_index("text")).cast(pa.binary())
                words = [words_of(x.as_py() or b"") for x in column]
                texts = [vocab.tokens_of(w) for w in words]
                found = log_probabilities(weights, *contexts(texts)).astype(np.float64)
                sizes = np.array([x.size for x in texts], np.int64)
                total = np.bincount(np.repeat(np.arange(len(texts)), sizes), found, len(texts))
                if store is not None:
                    store.learn(words)
                    total += [sum(map(store.__getitem__, w)) for w in words]
                arrays = [rows.column(rows.schema.get_field_index(f.name)) for f in kept]
                arrays += [pa.array(sizes, pa.int64()), pa.array(total, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.mapInArrow(run, schema)
