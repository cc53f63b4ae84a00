"""Language ID by a linear-chain conditional random field over words.

The score of a language for a word is the sum of the weights of its features:
character n-grams with word ends, affixes of three letters at the beginning and at
the end, and the word itself if it is in the lexicon. Learned transitions tie the
words of a text together. Forward-backward gives each word's distribution over the
languages, so a text may switch between them; the language of a text is the one
that has most of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import share

#: The bound of the training sample: texts of each language, and bytes of a text in it. Of a
#: longer text its beginning is taken, up to the last end of a word in it.
SAMPLE_TEXTS = 150
SAMPLE_BYTES = 20_000
#: Hashed n-gram features, and one more row that stays zero.
FEATURES = 1 << 17
#: Words whose scores a task keeps; beyond it the store begins anew.
STORE = 400_000
#: Words in one forward-backward run of a task; a longer text has a run of its own.
RUN_WORDS = 500_000
UNDETERMINED = "und"

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case. Numerals other than digits are no letters."""
    found = WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all ``words`` one after the other, and where each word begins."""
    joined = "".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass")
    c = np.frombuffer(joined, "<u4").astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    ends = np.repeat(np.cumsum(lengths), lengths)
    place = np.arange(c.size)
    after = np.concatenate([c, np.zeros(3, np.uint64)])
    columns, mixed = [], np.zeros(c.size, np.uint64)
    for n in (1, 2, 3, 4):
        mixed = (mixed + after[n - 1 : n - 1 + c.size] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        inside = place + n <= ends
        if n == 4:  # affixes: three letters and the end of the word
            inside &= (c == 2) | (after[3 : 3 + c.size] == 3)
        columns.append(np.where(inside, (mixed >> np.uint64(40)) % np.uint64(FEATURES), FEATURES))
    ids = np.stack(columns, axis=1).astype(np.int64)
    return ids.ravel(), 4 * (np.cumsum(lengths) - lengths)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # feature x language; the last row is zero
    lexicon: dict[str, int]
    word_weights: np.ndarray  # lexicon x language
    transitions: np.ndarray  # from x to, as logarithms

    def scores(self, words: list[str]) -> np.ndarray:
        """Word x language."""
        if len(words) > 20_000:
            parts = [self.scores(words[i : i + 20_000]) for i in range(0, len(words), 20_000)]
            return np.concatenate(parts)
        ids, starts = ngrams(words)
        total = np.add.reduceat(self.weights[ids], starts, axis=0)
        known = np.fromiter((self.lexicon.get(w, -1) for w in words), np.int64, len(words))
        hit = known >= 0
        total[hit] += self.word_weights[known[hit]]
        return total


# ---- forward and backward ----


def forward_backward(
    scores: np.ndarray, transitions: np.ndarray, active: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The distribution of every word, and of every pair of neighbours summed up.

    Rows of ``scores`` are in the order of place, then text; ``active[t]`` texts, the
    longest first, have a word at place ``t``.
    """
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(transitions - transitions.max())
    ends = np.cumsum(active)
    starts = ends - active
    forward, backward = np.empty_like(e), np.ones_like(e)
    pairs = np.zeros_like(a)
    for t in range(active.size):
        now = slice(starts[t], ends[t])
        step = e[now].copy()
        if t:
            step *= forward[starts[t - 1] : starts[t - 1] + active[t]] @ a
        forward[now] = step / step.sum(axis=1, keepdims=True)
    for t in range(active.size - 2, -1, -1):
        now = slice(starts[t], starts[t] + active[t + 1])
        after = slice(starts[t + 1], ends[t + 1])
        coming = e[after] * backward[after]
        step = coming @ a.T
        step /= step.sum(axis=1, keepdims=True)
        backward[now] = step
        pair = np.einsum("ni,nj->nij", forward[now], coming) * a
        pairs += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True), pairs


def _marginals(scores: np.ndarray, transitions: np.ndarray, active: np.ndarray) -> np.ndarray:
    """As ``forward_backward`` without the pairs."""
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(transitions - transitions.max())
    ends = np.cumsum(active)
    starts = ends - active
    forward = np.empty_like(e)
    last = None
    for t in range(active.size):
        step = e[starts[t] : ends[t]]
        if t:
            step = step * (last[: active[t]] @ a)
        last = step / step.sum(axis=1, keepdims=True)
        forward[starts[t] : ends[t]] = last
    last = None
    back = a.T
    for t in range(active.size - 2, -1, -1):
        coming = e[starts[t + 1] : ends[t + 1]]
        if last is not None:
            coming = coming.copy()
            coming[: last.shape[0]] *= last
        last = coming @ back
        last /= last.sum(axis=1, keepdims=True)
        forward[starts[t] : starts[t] + active[t + 1]] *= last
    forward /= forward.sum(axis=1, keepdims=True)
    return forward


def packed(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of ``lengths``: place of each word in packed order, texts by rank, active texts."""
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(order.size)
    longest = int(lengths.max()) if lengths.size else 0
    active = lengths.size - np.cumsum(np.bincount(lengths, minlength=longest + 1))[:longest]
    starts = np.cumsum(active) - active
    begin = np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.arange(int(lengths.sum())) - begin
    return starts[at] + np.repeat(rank, lengths), order, active


# ---- training ----


def _summed(at: np.ndarray, rows: np.ndarray, n: int, times: np.ndarray | int = 1) -> np.ndarray:
    """The sums of ``rows``, each taken ``times``, by the places ``at``, for places 0 to ``n`` - 1."""
    return np.stack([np.bincount(at, np.repeat(column, times), n) for column in rows.T], axis=1)


def _features(words: list[str], at_once: int = 10_000) -> tuple[np.ndarray, np.ndarray]:
    """``ngrams`` of many words, in small numbers and without its large intermediate arrays."""
    ids, starts, n = [], [], 0
    for i in range(0, len(words), at_once):
        some, begin = ngrams(words[i : i + at_once])
        ids.append(some.astype(np.int32))
        starts.append(begin + n)
        n += some.size
    return np.concatenate(ids), np.concatenate(starts)


def fit(
    texts: list[str], langs: list[str], steps: int = 60, rate: float = 0.3, ridge: float = 1e-6
) -> Model:
    """A model of labelled texts.

    The texts are cut into pieces and dealt to sequences in which the language
    changes, so that transitions are learned as well as features. Adam on the
    conditional likelihood of all sequences. The same input gives the same model.
    """
    languages = sorted(set(langs))
    if len(languages) < 2:
        nothing = np.zeros((FEATURES + 1, max(1, len(languages))), np.float32)
        return Model(languages, nothing, {}, nothing[:0], np.zeros((1, 1)))
    draw = np.random.default_rng(0)
    pieces, seen = [], {}
    for text, lang in zip(texts, langs, strict=True):
        found = words_of(text)
        start = 0
        while start < len(found):
            size = int(draw.geometric(1 / 25))
            pieces.append((found[start : start + size], languages.index(lang)))
            start += size
    order = draw.permutation(len(pieces))
    words = [w for i in order for w in pieces[i][0]]
    labels = np.array([pieces[i][1] for i in order for _ in pieces[i][0]])
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    unique = {w: i for i, w in enumerate(seen)}
    ids = np.fromiter((unique[w] for w in words), np.int64, len(words))
    lexicon = {w: i for i, w in enumerate(w for w in unique if seen[w] > 1)}
    length = 100
    size = max(1, len(words) // length)
    cut = min(len(words), size * length)
    length = cut // size
    ids, labels = ids[: size * length], labels[: size * length]
    # Packed order for sequences of one length: place, then sequence.
    ids = ids.reshape(size, length).T.ravel()
    labels = labels.reshape(size, length).T.ravel()
    active = np.full(length, size)
    n, k = len(languages), len(words)
    features, starts = _features(list(unique))
    counts = np.diff(np.r_[starts, features.size])
    known = np.fromiter((lexicon.get(w, -1) for w in unique), np.int64, len(unique))
    params = [np.zeros((FEATURES + 1, n)), np.zeros((max(1, len(lexicon)), n)), np.zeros((n, n))]
    means, squares = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    truth = np.eye(n)[labels]
    wanted = np.zeros((n, n))
    np.add.at(wanted, (labels[: size * (length - 1)], labels[size:]), 1)
    hit = known >= 0
    for step in range(1, steps + 1):
        # One language at a time: the features of all words are the largest arrays here.
        scores = np.stack(
            [np.add.reduceat(params[0][features, j], starts) for j in range(n)], axis=1
        )
        scores[hit] += params[1][known[hit]]
        found, pairs = forward_backward(scores[ids], params[2], active)
        off = found - truth
        by_word = _summed(ids, off, len(unique))
        slopes = [
            _summed(features, by_word, FEATURES + 1, counts),
            _summed(known[hit], by_word[hit], max(1, len(lexicon))),
            pairs - wanted,
        ]
        for p, slope, mean, square in zip(params, slopes, means, squares, strict=True):
            slope = slope / k + ridge * p
            mean += 0.1 * (slope - mean)
            square += 0.001 * (slope**2 - square)
            p -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        params[0][FEATURES] = 0
    return Model(
        languages, params[0].astype(np.float32), lexicon, params[1].astype(np.float32), params[2]
    )


def piece(text: Column) -> Column:
    """``text``, or its beginning of whole words if it has more than ``SAMPLE_BYTES`` bytes.

    Where that has no whole word, as in scripts without blanks, a word is cut.
    """
    # No character has more than four bytes; the first characters hold the first bytes.
    some = F.substring(text, 1, SAMPLE_BYTES)
    for part in (SAMPLE_BYTES // 2, SAMPLE_BYTES // 3, SAMPLE_BYTES // 4):
        some = F.when(F.octet_length(some) > SAMPLE_BYTES, F.substring(text, 1, part)).otherwise(some)
    whole = F.regexp_replace(some, r"\p{L}+$", "")
    whole = F.when(whole.rlike(r"\p{L}"), whole).otherwise(some)
    return F.when(F.octet_length(text) <= SAMPLE_BYTES, text).otherwise(whole)


def train(docs: DataFrame) -> Model:
    """A model of the labelled rows (``doc_id``, ``text``, ``lang``) of ``docs``.

    From each language at most ``SAMPLE_TEXTS`` texts are taken, those with the smallest
    hash of their id, and of a text with more than ``SAMPLE_BYTES`` bytes its ``piece``. Only
    they reach the driver.
    """
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40))
    rows = docs.filter(F.col("lang").isNotNull()).select(
        "lang", piece(F.col("text")).alias("text"), drawn.alias("drawn")
    ).filter(F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit([], [])
    # About twice as many as wanted, so that enough are there whatever the hashes.
    bound = F.lit(0)
    for lang, n in counts.items():
        share = min(1.0, (2 * SAMPLE_TEXTS + 50) / n)
        bound = F.when(F.col("lang") == lang, F.lit(int(share * (1 << 40)))).otherwise(bound)
    drawn_rows = rows.filter(F.col("drawn") < bound).select("lang", "drawn", "text")
    sample = sorted(tuple(r) for r in drawn_rows.collect())
    taken: dict[str, int] = {}
    texts, langs = [], []
    for lang, _, text in sample:
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= SAMPLE_TEXTS:
            texts.append(text)
            langs.append(lang)
    return fit(texts, langs)


# ---- prediction ----


class Labeller:
    """Distributions of words by a model, with a bounded store of word scores."""

    def __init__(self, model: Model):
        self.model, self.number, self.new = model, {}, []
        self.table = np.empty((0, len(model.languages)), np.float32)

    def _numbers(self, words: list[str]) -> list[int]:
        number, new = self.number, self.new
        out = []
        for w in words:
            i = number.get(w)
            if i is None:
                i = number[w] = len(number)
                new.append(w)
            out.append(i)
        return out

    def distributions(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Word x language for each of ``texts``."""
        if len(self.number) > STORE:
            self.number, self.new = {}, []
            self.table = self.table[:0]
        numbers = [np.array(self._numbers(words), np.int64) for words in texts]
        if self.new:
            self.table = np.concatenate([self.table, self.model.scores(self.new)])
            self.new = []
        lengths = np.array([x.size for x in numbers], np.int64)
        out: list[np.ndarray] = [np.empty((0, self.table.shape[1]))] * len(texts)
        todo = [i for i in np.argsort(-lengths, kind="stable") if lengths[i]]
        while todo:
            size, run = 0, []
            while len(run) < len(todo) and (not run or size + lengths[todo[len(run)]] <= RUN_WORDS):
                size += lengths[todo[len(run)]]
                run.append(todo[len(run)])
            todo = todo[len(run) :]
            place, _, active = packed(lengths[run])
            ids = np.empty(place.size, np.int64)
            ids[place] = np.concatenate([numbers[i] for i in run])
            found = _marginals(self.table[ids], self.model.transitions, active)[place]
            ends = np.cumsum(lengths[run])
            for i, end in zip(run, ends, strict=True):
                out[i] = found[end - lengths[i] : end]
        return out

    def languages(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language with most of the words of each text, and its share of them."""
        words = [words_of(text) if text else [] for text in texts]
        if len(self.model.languages) < 2:
            only = self.model.languages[0] if self.model.languages else UNDETERMINED
            return [(only, 1.0) if w and self.model.languages else (UNDETERMINED, 0.0) for w in words]
        out = []
        for rows in self.distributions(words):
            share = rows.mean(axis=0) if len(rows) else None
            if share is None:
                out.append((UNDETERMINED, 0.0))
            else:
                best = int(share.argmax())
                out.append((self.model.languages[best], min(1.0, float(share[best]))))
        return out

    def switches(self, text: str | None) -> list[tuple[str, list[str]]]:
        """The runs of words of a text that have the same most likely language."""
        words = words_of(text or "")
        out: list[tuple[str, list[str]]] = []
        for word, best in zip(words, self.distributions([words])[0].argmax(axis=1), strict=True):
            lang = self.model.languages[best]
            if out and out[-1][0] == lang:
                out[-1][1].append(word)
            else:
                out.append((lang, [word]))
        return out


def identify(docs: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``__lang`` and ``__score``; without ``text`` unless ``keep_text``.

    ``__lang`` is ``und`` with score 0 where a text is NULL or has no letter. Rows stay
    where they are. Of equal shares the language first in the alphabet is taken.
    """
    shared = share(docs.sparkSession, model)
    kept = [f for f in docs.schema.fields if keep_text or f.name != "text"]
    schema = T.StructType(
        [*kept, T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared())
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            found = []
            for start in range(0, len(column), 2000):
                found += labeller.languages(column.slice(start, 2000).to_pylist())
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            arrays.append(pa.array([lang for lang, _ in found], pa.string()))
            arrays.append(pa.array([score for _, score in found], pa.float64()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: CRC-32 of its id modulo 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained_on_rest(docs: DataFrame) -> Model:
    """A model of the documents that are not held out; those without an id are left out too."""
    rest = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return train(rest.select("doc_id", "text", "lang"))
