"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts are words in lower case without punctuation. A copy of a test item with
``EDITS`` of its words changed keeps a known number of the item's n-grams, so at
least one of its rarest n-grams, where rarity is counted over all texts: those are
the seeds. Around each seed that a text shares with an item the two are aligned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyledger.llm.common import share

#: The share of an item's words that a copy may have changed for the seeds to be sure.
EDITS = 0.2
#: The least alignment score, as a share of that of an unchanged copy.
SCORE = 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
#: Items, and bytes of their texts, that tasks hold at once. A larger benchmark is taken in blocks.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 8 << 20
#: Words of texts that a task looks up at once.
BATCH_WORDS = 500_000

LEAK = "array<struct<item_id:long,score:double,first_word:long,last_word:long>>"

_ASCII = "".join(chr(i).lower() if chr(i).isalnum() else " " for i in range(128)).encode("ascii")
_TABLE = _ASCII + bytes(range(128, 256))


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_TABLE).split()


def seed_size(length: int) -> tuple[int, int]:
    """n, and how many n-grams of an item of ``length`` words are seeds.

    The largest n up to three for which an n-gram survives ``EDITS``.
    """
    edits = int(EDITS * length)
    for n in (3, 2, 1):
        survive = length - n + 1 - n * edits
        if survive >= 1:
            return n, (length - n + 1) - survive + 1
    return 1, length


@dataclass
class Index:
    """The items of a block: their words as numbers, and where their n-grams stand."""

    ids: list[list[int | None]]  # of the items with this text
    vocabulary: dict[bytes, int]
    items: list[np.ndarray]
    grams: dict[int, np.ndarray]  # by n: sorted codes, each once
    places: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # gram, item, place; by gram

    def codes(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and codes of the n-grams of known words."""
        size = max(0, words.size - n + 1)
        known = np.ones(size, bool)
        for k in range(n):
            known &= words[k : k + size] >= 0
        at = np.flatnonzero(known)
        code = np.zeros(at.size, np.int64)
        for k in range(n):
            code = code * len(self.vocabulary) + words[at + k]
        return at, code

    def found(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``words`` and numbers of the n-grams that items have."""
        at, code = self.codes(words, n)
        grams = self.grams[n]
        if not grams.size:
            return at[:0], code[:0]
        number = np.minimum(np.searchsorted(grams, code), grams.size - 1)
        hit = grams[number] == code
        return at[hit], number[hit]


def build_index(rows: list[tuple[int | None, str]], least_words: int = 1) -> Index:
    """Of items as (id, text); equal texts are one item, shorter ones than ``least_words`` none."""
    vocabulary: dict[bytes, int] = {}
    ids, items = [], []
    texts: dict[str, list[int | None]] = {}
    for item_id, text in rows:
        texts.setdefault(text, []).append(item_id)
    for text, own in texts.items():
        words = words_of(text.encode())
        if len(words) >= least_words:
            ids.append(own)
            items.append(
                np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64)
            )
    index = Index(ids, vocabulary, items, {}, {})
    for n in (1, 2, 3):
        own = [(i, x) for i, x in enumerate(items) if seed_size(x.size)[0] == n]
        codes = [index.codes(x, n)[1] for _, x in own]
        every = np.concatenate([*codes, np.empty(0, np.int64)])
        index.grams[n], number = np.unique(every, return_inverse=True)
        item = np.repeat([i for i, _ in own], [c.size for c in codes]).astype(np.int64)
        place = np.concatenate([*(np.arange(c.size) for c in codes), np.empty(0, np.int64)])
        order = np.argsort(number, kind="stable")
        index.places[n] = (number[order], item[order], place[order])
    return index


def choose_seeds(index: Index, counts: dict[tuple[int, int], int]) -> None:
    """Leaves only the rarest n-grams of each item, as many as ``seed_size`` says."""
    most = np.array([seed_size(x.size)[1] for x in index.items], np.int64)
    for n, (number, item, place) in index.places.items():
        rarity = np.array([counts.get((n, g), 0) for g in range(index.grams[n].size)], np.int64)
        order = np.lexsort((number, rarity[number], item)) if number.size else number
        own = item[order]
        nth = np.arange(own.size) - np.searchsorted(own, own)  # among the n-grams of its item
        rows = order[nth < most[own]] if own.size else order
        rows = rows[np.argsort(number[rows], kind="stable")]
        used, again = np.unique(number[rows], return_inverse=True)
        index.grams[n] = index.grams[n][used]
        index.places[n] = (again, item[rows], place[rows])


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: the best score of ``item`` in ``words``, and the first and last word of it.

    Memory grows with ``words`` only: beside each score of a row stands the place where its
    alignment began. A match or mismatch goes before a gap in ``words``, that before a gap in
    ``item``; of equal scores the first counts.
    """
    places = np.arange(words.size + 1)
    across = places * -GAP
    score, start = np.zeros(words.size + 1, np.int64), places.copy()
    best, found = 0, (0, -1)
    for word in item:
        step = score[:-1] + np.where(words == word, MATCH, MISMATCH)
        gap = score[1:] + GAP
        row, begin = np.zeros_like(score), places.copy()
        np.maximum(step, gap, out=row[1:])
        begin[1:] = np.where(step >= gap, start[:-1], start[1:])
        np.maximum(row, 0, out=row)
        # A gap in the item: the best of all words before, less the way.
        reach = row + across
        most = np.maximum.accumulate(reach)
        origin = np.maximum.accumulate(np.where(reach == most, places, 0))
        row = most - across
        start = np.where(row > 0, begin[origin], places)
        score = row
        at = int(row.argmax())
        if row[at] > best:
            best, found = int(row[at]), (int(start[at]), at - 1)
    return best, *found


def _windows(index: Index, words: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, from, to): the surroundings of shared seeds, merged where they overlap."""
    spans: dict[int, list[tuple[int, int]]] = {}
    for n, (number, item, place) in index.places.items():
        at, gram = index.found(words, n)
        first = np.searchsorted(number, gram)
        after = np.searchsorted(number, gram, "right")
        for a, low, high in zip(at.tolist(), first.tolist(), after.tolist(), strict=True):
            for r in range(low, high):
                i = int(item[r])
                size = index.items[i].size
                slack = math.ceil((1 - SCORE) * MATCH * size / -GAP)
                start = a - int(place[r])
                spans.setdefault(i, []).append((start - slack, start + size + slack))
    out = []
    for i, found in spans.items():
        found.sort()
        low, high = found[0]
        for a, b in found[1:]:
            if a > high:
                out.append((i, max(0, low), min(words.size, high)))
                low, high = a, b
            else:
                high = max(high, b)
        out.append((i, max(0, low), min(words.size, high)))
    return out


def leaks(index: Index, words: np.ndarray) -> list[dict]:
    """The best alignment with each item that reaches ``SCORE``, in the order of items."""
    best: dict[int, tuple] = {}
    for i, low, high in _windows(index, words):
        item, near = index.items[i], words[low:high]
        # No more words can match than stand there at all.
        if np.isin(near, item).sum() < SCORE * item.size or np.isin(item, near).sum() < SCORE * item.size:
            continue
        score, first, last = align(item, near)
        if score >= SCORE * MATCH * item.size:
            found = (score / (MATCH * item.size), -(low + first), -(low + last))
            best[i] = max(best.get(i, found), found)
    rows = [
        {"item_id": item_id, "score": s, "first_word": -a, "last_word": -b}
        for i, (s, a, b) in best.items()
        for item_id in index.ids[i]
    ]
    return sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"]))


def _numbers(index: Index, texts: pa.Array) -> Iterator[np.ndarray]:
    get = index.vocabulary.get
    for text in texts.cast(pa.binary()):
        yield np.array([get(w, -1) for w in words_of(text.as_py() or b"")], np.int64)


def _batches(arrays: Iterator[np.ndarray], pad: int = 3) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Texts one after the other, parted by unknown words, and the size of each."""
    held, sizes, total = [], [], 0
    gap = np.full(pad, -1, np.int64)
    for words in arrays:
        held += [words, gap]
        sizes.append(words.size + pad)
        total += sizes[-1]
        if total >= BATCH_WORDS:
            yield np.concatenate(held), sizes
            held, sizes, total = [], [], 0
    if sizes:
        yield np.concatenate(held), sizes


def gram_counts(docs: DataFrame, index: Index) -> dict[tuple[int, int], int]:
    """How often each n-gram of the items stands in all texts.

    Counted in the tasks first. The driver gets a row for each n-gram of the block.
    """
    shared = share(docs.sparkSession, index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared()
        total = {n: np.zeros(grams.size, np.int64) for n, grams in index.grams.items()}
        for batch in batches:
            for words, _ in _batches(_numbers(index, batch.column(0))):
                for n, counts in total.items():
                    counts += np.bincount(index.found(words, n)[1], minlength=counts.size)
        for n, counts in total.items():
            some = np.flatnonzero(counts)
            arrays = [
                pa.array([n] * some.size, pa.int32()),
                pa.array(some, pa.int64()),
                pa.array(counts[some], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["n", "gram", "count"])

    found = docs.select("text").mapInArrow(run, "n int, gram long, count long")
    rows = found.groupBy("n", "gram").agg(F.sum("count").alias("count")).collect()
    return {(r["n"], r["gram"]): r["count"] for r in rows}


def _scan_block(docs: DataFrame, index: Index, name: str, keep_text: bool) -> DataFrame:
    shared = share(docs.sparkSession, index)
    kept = [f for f in docs.schema.fields if keep_text or f.name != "text"]
    leak = T._parse_datatype_string(LEAK)
    leaks_type = to_arrow_type(leak)
    schema = T.StructType([*kept, T.StructField(name, leak)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            found: list[list[dict]] = []
            for words, sizes in _batches(_numbers(index, texts)):
                # Most texts share no seed; only the others are looked at one by one.
                ends = np.cumsum(sizes)
                some = np.zeros(len(sizes), bool)
                for n in index.grams:
                    some[np.searchsorted(ends, index.found(words, n)[0], "right")] = True
                for size, end, hit in zip(sizes, ends, some, strict=True):
                    found.append(leaks(index, words[end - size : end - 3]) if hit else [])
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            arrays.append(pa.array(found, leaks_type))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.mapInArrow(run, schema)


def too_short(benchmark: DataFrame, least_words: int) -> DataFrame:
    """The items that a scan with ``least_words`` passes over: ``item_id`` and ``n_words``."""
    # Blanks, and ASCII that is neither letter nor digit, part words, as in ``words_of``.
    parted = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", " ")
    n_words = F.size(F.filter(F.split(parted, " "), lambda w: w != ""))
    rows = benchmark.select("item_id", n_words.cast("long").alias("n_words"))
    return rows.filter(F.col("n_words") < least_words)


def scan(
    docs: DataFrame, benchmark: DataFrame, keep_text: bool = False, least_words: int = 1
) -> DataFrame:
    """``docs`` with ``__leaks``, the items of ``benchmark`` (``item_id``, ``text``) that each text has.

    Rows stay where they are; ``text`` goes unless ``keep_text``. A NULL or empty text,
    and an item with fewer than ``least_words`` words (see ``too_short``), leak nothing. Items
    with the same text are looked for once and all reported. Every copy with at most ``EDITS``
    of its words changed is found, and of others those that share a seed and reach ``SCORE``.
    Texts and items may be of any length: an alignment holds a few rows as long as the
    surroundings of the item, not a table. A benchmark of more than ``BLOCK_ITEMS`` different
    texts or ``BLOCK_BYTES`` bytes takes a pass over the texts for each block.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.filter(F.col("text").isNotNull())
    texts = items.select("text").distinct()
    size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(size[0] / BLOCK_ITEMS), math.ceil(size[1] / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("text"), F.lit(blocks))
    names = []
    for b in range(blocks):
        own = items.filter(block == b).groupBy("text").agg(F.collect_list("item_id").alias("ids"), F.count("*").alias("n"))
        rows = []
        for r in own.collect():
            unnamed = [None] * (r["n"] - len(r["ids"]))
            rows += [(i, r["text"]) for i in (*r["ids"], *unnamed)]
        rows.sort(key=lambda r: (r[0] is None, r))
        index = build_index(rows, least_words)
        choose_seeds(index, gram_counts(docs, index))
        names.append("__leaks" if b == 0 else f"__leaks_{b}")
        docs = _scan_block(docs, index, names[-1], keep_text or b < blocks - 1)
    if blocks > 1:
        docs = docs.withColumn("__leaks", F.concat(*names)).drop(*names[1:])
    return docs


def pairs(scanned: DataFrame) -> DataFrame:
    """A row for each document and item that it leaks."""
    rows = scanned.select("doc_id", F.explode("__leaks").alias("l"))
    return rows.select("doc_id", "l.item_id", "l.score", "l.first_word", "l.last_word")
