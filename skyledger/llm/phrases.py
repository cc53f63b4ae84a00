"""Phrase collocations: frequent phrases counted by a multikey three-way quicksort of suffixes.

Texts are split into pieces at ``.,;:!?`` and line ends, pieces into words at blanks; A-Z
becomes lower case; everything is counted per language (NULL: ``und``). A phrase of two to
``LONGEST`` words that stands in at least ``least`` places is a candidate.

1. *Words.* Tasks count words; their sums give the frequent words and all words of a language.
2. *Leading pairs.* Tasks count pairs of frequent neighbours by hash. Words and pairs that
   are not frequent are abandoned by two bit maps of fixed size. A bit that is set in vain
   costs work and changes no result.
3. *Suffixes.* A suffix begins at each place and ends before the first abandoned pair, after
   ``LONGEST`` words at most. Tasks combine equal ones and route them by a hash of the leading
   word, or of the leading pair if the word has ``HOT`` places or more; those of a pair with so
   many are routed one by one in the order of their words. Routes are dealt to ranges of about
   equal size, so that a word or pair with a third of all places spreads over many tasks.
4. *Quicksort.* Each range holds an array of suffix pointers, which is parted by the word at
   depth 0 into smaller, equal and greater; the equal part, whose size is the count of the
   phrase up to there, is parted again by the next word, down to the greatest depth. Parts
   below ``least`` are abandoned, but for those with the first or last suffix of a range that
   was routed by itself: their phrases may go on in the next range, and the counts are summed
   afterwards.
5. *Scores.* The cut of a candidate with the lowest ``floor(1000 a n / (l r))`` counts, in
   decimals of 38 digits: exact as long as a language has fewer than 9e15 words.

A NULL or empty text has no words. Documents with equal ids, or without one, all count.
Columns other than ``text`` and ``lang`` are not looked at; an empty table gives no phrases.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import materialize, share

LEAST = 100
LONGEST = 5
#: The phrases of each language in the result.
TOP = 2000

#: Places from which a leading word or pair is split further, and the least number of routes.
HOT = 200_000
ROUTES = 512
#: Bits of the maps of words and of pairs: 1 MB and 4 MB. There is one each for those that are
#: frequent and for those that are hot.
WORD_BITS = 23
PAIR_BITS = 25
#: Bits in one row of a map.
ROW_BITS = 15
#: Places that a task holds at once, and suffixes that one range should have.
PLACES = 1 << 19
RANGE_ROWS = 400_000

#: A-Z in lower case, and all that ends a piece as a line end.
FOLD = bytes.maketrans(
    bytes(range(65, 91)) + b".,;:!?\r\x0b\x0c", bytes(range(97, 123)) + b"\n" * 9
)
#: Stands between pieces; the byte does not occur in UTF-8.
BREAK = b"\xff"
UNKNOWN = "und"


def words_of(data: bytes) -> list[bytes]:
    """The words of a text, with ``BREAK`` between pieces."""
    return data.translate(FOLD).replace(b"\n", b" \xff ").split()


def escaped(word: bytes) -> bytes:
    """``word`` with an end that no word contains, so that phrases sort word by word."""
    if b"\0" in word or b"\1" in word:
        word = word.replace(b"\1", b"\1\2").replace(b"\0", b"\1\1")
    return word + b"\0"


def plain(word: bytes) -> bytes:
    """An escaped word, without its end, as it stands in the text."""
    return word.replace(b"\1\1", b"\0").replace(b"\1\2", b"\1")


# ---- words and pairs of a task ----

#: Bytes of a text that are taken at once.
TEXT_BYTES = 4 << 20
ENDS = re.compile(rb"[\x20\x09-\x0d.,;:!?]")


def chunks(data: bytes) -> Iterator[bytes]:
    """``data`` cut after the first end of a word beyond each ``TEXT_BYTES``."""
    start = 0
    while start < len(data):
        end = ENDS.search(data, start + TEXT_BYTES)
        stop = end.end() if end else len(data)
        yield data[start:stop]
        start = stop


Block = tuple[str, list[bytes], int]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Words of one language from a break on, about ``PLACES`` of them, and how many of these
    places are to be counted. The others begin the next block again, since a phrase that
    begins there goes on behind the block.
    """
    held: dict[str, list[bytes]] = {}
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
            words = held.setdefault(lang, [BREAK])
            for chunk in chunks(text.as_py() or b""):
                words += words_of(chunk)
                if len(words) >= PLACES:
                    yield lang, words, len(words) - LONGEST + 1
                    words = held[lang] = [BREAK, *words[1 - LONGEST :]]
            words.append(BREAK)
    for lang, words in held.items():
        yield lang, words, len(words)


def numbered(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of ``words`` (-1: a break), and the different words. The first must be a break."""
    column = np.empty(len(words), object)
    column[:] = words
    numbers, different = pd.factorize(column)
    return numbers - 1, different[1:].tolist()


def digests_of(lang: str, different: list[bytes]) -> np.ndarray:
    start = zlib.crc32(lang.encode())
    # One more for -1, which stands for breaks.
    return np.fromiter((zlib.crc32(w, start) for w in (*different, b"")), np.uint64, len(different) + 1)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, and of all of them together in a row without a word."""
    for lang, words, places in blocks(batches):
        numbers, different = numbered(words)
        numbers = numbers[:places]
        counts = np.bincount(numbers[numbers >= 0], minlength=len(different))
        used = np.flatnonzero(counts)
        columns = [
            pa.array([lang] * (len(used) + 1), pa.string()),
            pa.array([None, *(different[i] for i in used)], pa.binary()),
            pa.array([int(counts.sum()), *counts[used].tolist()], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "a"])


def is_set(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def mixed(own: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Digests of pairs from the digests of their words."""
    both = (own * np.uint64(0x9E3779B97F4A7C15)) ^ (after * np.uint64(0xC2B2AE3D27D4EB4F))
    return (both ^ (both >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def word_bits(digests: np.ndarray) -> np.ndarray:
    return digests & np.uint64((1 << WORD_BITS) - 1)


def pair_bits(pairs: np.ndarray) -> np.ndarray:
    return pairs >> np.uint64(64 - PAIR_BITS)


def pairs_of(numbers: np.ndarray, digests: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a place and the next one, of the same piece, both have a frequent word; and a
    digest of the two."""
    good = is_set(frequent, word_bits(digests))[numbers] & (numbers >= 0)
    own = digests[numbers]
    return good & np.append(good[1:], False), mixed(own, np.append(own[1:], np.uint64(0)))


def pair_counter(word_maps):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, _ = word_maps()
        for lang, words, places in blocks(batches):
            numbers, different = numbered(words)
            good, pairs = pairs_of(numbers, digests_of(lang, different), frequent)
            found, n = np.unique(pairs[:places][good[:places]], return_counts=True)
            columns = [pa.array(found.view(np.int64)), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["pair", "n"])

    return run


def suffixes(numbers: np.ndarray, good: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray]:
    """The different suffixes of two words or more (-1 after their end), and their counts.

    ``good``: whether a place and the next one may stand in a phrase.
    """
    length = np.zeros(len(numbers) + 1, np.int64)
    for _ in range(LONGEST - 1):
        length[:-1] = good * (1 + length[1:])
    starts = np.flatnonzero(length[:places])
    table = np.full((len(starts), LONGEST), -1, np.int64)
    for depth in range(LONGEST):
        held = length[starts] >= depth
        table[held, depth] = numbers[starts[held] + depth]
    table = table[np.lexsort(table.T[::-1])]
    new = np.ones(len(table), bool)
    new[1:] = (table[1:] != table[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return table[at], np.diff(np.append(at, len(table)))


#: How suffixes are routed: by their first word, by two, or each by itself.
ONE, TWO, ALL = range(3)


def routing(
    table: np.ndarray, digests: np.ndarray, hot_words: np.ndarray, hot_pairs: np.ndarray, routes: int
) -> tuple[np.ndarray, np.ndarray]:
    """The kind and the number of the route of each suffix: the same in all tasks."""
    first = digests[table[:, 0]]
    pair = mixed(first, digests[table[:, 1]])
    hot = is_set(hot_words, word_bits(first))
    kind = np.where(hot & is_set(hot_pairs, pair_bits(pair)), ALL, np.where(hot, TWO, ONE))
    number = np.where(hot, pair >> np.uint64(8), mixed(first, first) >> np.uint64(8)) % np.uint64(routes)
    return kind, np.where(kind == ALL, 0, number.astype(np.int64))


def suffix_maker(word_maps, pair_maps, routes: int):
    """Rows of suffixes of a route, joined by line ends, which no word contains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (frequent, hot_words), (frequent_pairs, hot_pairs) = word_maps(), pair_maps()
        for lang, words, places in blocks(batches):
            numbers, different = numbered(words)
            digests = digests_of(lang, different)
            good, pairs = pairs_of(numbers, digests, frequent)
            good &= is_set(frequent_pairs, pair_bits(pairs))
            table, n = suffixes(numbers, good, places)
            kind, route = routing(table, digests, hot_words, hot_pairs, routes)
            order = np.lexsort((route, kind))
            table, n, kind, route = table[order], n[order], kind[order], route[order]
            new = np.ones(len(table), bool)
            new[1:] = (kind[1:] != kind[:-1]) | (route[1:] != route[:-1]) | (kind[1:] == ALL)
            starts = np.append(np.flatnonzero(new), len(table)).tolist()
            keys = [*map(escaped, different), b""]  # the last one for -1
            found = [b"".join([keys[k] for k in row]) for row in table.tolist()]
            names = [
                b"\2" + found[a] if kind[a] == ALL else b"%c%c%c%c%c" % (kind[a], *int(route[a]).to_bytes(4))
                for a in starts[:-1]
            ]
            joined = [b"\n".join(found[a:b]) for a, b in zip(starts, starts[1:])]
            columns = [
                pa.array([lang] * len(names), pa.string()),
                pa.array(names, pa.binary()),
                pa.array(joined, pa.binary()),
                pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(n, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "route", "suffixes", "n"])

    return run


# ---- the quicksort of a range ----


def quicksort(
    table: np.ndarray, weight: np.ndarray, border: np.ndarray, least: int
) -> Iterator[tuple[int, int, int]]:
    """A row, length and count of each phrase that begins at least ``least`` suffixes.

    ``table``: suffix x word number, -1 after the end. Phrases that begin a suffix of ``border``
    are given as well, with the counts that they have.
    """
    if not len(table):
        return
    parts = [(np.arange(len(table)), 0)]
    while parts:
        pointers, depth = parts.pop()
        words = table[pointers, depth]
        pivot = np.sort(words[[0, len(words) // 2, -1]])[1]
        for beside in (words < pivot, words > pivot):
            other = pointers[beside]
            if len(other) and (weight[other].sum() >= least or border[other].any()):
                parts.append((other, depth))
        if pivot < 0:
            continue
        equal = pointers[words == pivot]
        count = int(weight[equal].sum())
        if count >= least or border[equal].any():
            yield int(equal[0]), depth + 1, count
            if depth + 1 < table.shape[1]:
                parts.append((equal, depth + 1))


def phrase_counter(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, list, list]] = {}
        for batch in batches:
            for lang, route, suffixes, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found, weight, alone = held.setdefault(lang, ([], [], []))
                if route[0] == ALL:
                    alone.append((route, len(found)))
                found += suffixes.split(b"\n")
                weight += n
        for lang, (found, weight, alone) in held.items():
            border = np.zeros(len(found), bool)
            if alone:
                border[[min(alone)[1], max(alone)[1]]] = True
            words = b"".join(found).split(b"\0")[:-1]
            lengths = np.fromiter((s.count(b"\0") for s in found), np.int64, len(found))
            column = np.empty(len(words), object)
            column[:] = words
            numbers, different = pd.factorize(column)
            table = np.full((len(found), LONGEST), -1, np.int64)
            row = np.repeat(np.arange(len(found)), lengths)
            start = np.cumsum(lengths) - lengths
            table[row, np.arange(len(words)) - start[row]] = numbers
            rows = list(quicksort(table, np.array(weight, np.int64), border, least))
            raw = list(map(plain, different.tolist()))
            rows = [r for r in rows if r[1] > 1]
            phrases = [[raw[w] for w in table[row, :length]] for row, length, _ in rows]
            columns = [
                pa.array([lang] * len(rows), pa.string()),
                pa.array(phrases, pa.list_(pa.binary())),
                pa.array([n for _, _, n in rows], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "a"])

    return run


# ---- tables ----


def bit_maps(bits_set: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Maps of the numbers ``bit`` of a table, of all and of those of ``HOT`` places (``n``) or more.

    They come from at most ``2 ** (bits - ROW_BITS)`` rows of two times 4 KB.
    """
    at = F.col("bit") % (1 << ROW_BITS)
    rows = bits_set.groupBy(F.shiftright("bit", ROW_BITS).alias("row")).agg(
        F.bitmap_construct_agg(at).alias("all"),
        F.bitmap_construct_agg(F.when(F.col("n") >= HOT, at)).alias("hot"),
    )
    width = 1 << (ROW_BITS - 3)
    maps = np.zeros((2, 1 << (bits - 3)), np.uint8)
    for row in rows.collect():
        for found, name in zip(maps, ("all", "hot"), strict=True):
            part = np.frombuffer(row[name], np.uint8)
            found[row["row"] * width : (row["row"] + 1) * width] = part[:width]
    return maps[0], maps[1]


def counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """The counts of single words, and of candidates.

    Of words those from ``least`` on are given, and all words together in a row without one.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    words = texts.mapInArrow(count_words, "lang string, word binary, a long")
    words = words.groupBy("lang", "word").agg(F.sum("a").alias("a"))
    words = materialize(words.filter((F.col("a") >= least) | F.col("word").isNull()), "words")
    digest = F.crc32(F.concat(F.col("lang").cast("binary"), F.col("word")))
    bits = words.filter("word is not null").select((digest % (1 << WORD_BITS)).alias("bit"), F.col("a").alias("n"))
    word_maps = share(spark, bit_maps(bits, WORD_BITS))
    pairs = texts.mapInArrow(pair_counter(word_maps), "pair long, n long")
    pairs = pairs.groupBy("pair").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    bits = pairs.select(F.shiftrightunsigned("pair", 64 - PAIR_BITS).alias("bit"), "n")
    pair_maps = share(spark, bit_maps(bits, PAIR_BITS))
    places = words.filter("word is null").agg(F.coalesce(F.sum("a"), F.lit(0))).first()[0]
    routes = max(ROUTES, 2 * (places // RANGE_ROWS))
    routed = texts.mapInArrow(
        suffix_maker(word_maps, pair_maps, routes), "lang string, route binary, suffixes binary, n array<long>"
    )
    routed = materialize(routed, "suffixes")
    size = routed.agg(F.coalesce(F.sum(F.size("n")), F.lit(0))).first()[0]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE_ROWS + 1)
    phrases = routed.repartitionByRange(ranges, "lang", "route").mapInArrow(
        phrase_counter(least), "lang string, words array<binary>, a long"
    )
    phrases = phrases.groupBy("lang", "words").agg(F.sum("a").alias("a"))
    return words, materialize(phrases.filter(F.col("a") >= least), "phrases")


def part(first: Column | int, length: Column | int) -> Column:
    return F.slice("words", first, length)


def scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates with the cut that counts: its counts ``l`` and ``r``, and its ``score``."""
    single = words.filter("word is not null").select("lang", F.array("word").alias("words"), "a")
    known = single.unionByName(phrases)
    total = words.filter("word is null").select("lang", F.col("a").alias("n"))
    size = F.size("words")
    k = F.col("k")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "*", part(1, k).alias("first"), part(k + 1, size - k).alias("rest")
    )
    cuts = cuts.join(known.select("lang", F.col("words").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("words").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    exact = [F.col(c).cast("decimal(19,0)") for c in ("n", "l", "r")]
    cuts = cuts.join(total, "lang").withColumn("thousand", (1000 * F.col("a")).cast("decimal(19,0)"))
    above, below = F.col("thousand") * exact[0], exact[1] * exact[2]
    cuts = cuts.withColumn("above", above).withColumn("below", below).withColumn("score", F.expr("above div below"))
    best = cuts.groupBy("lang", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "words", "a", "n", "cut.score", "cut.l", "cut.r")


def closed(found: DataFrame, phrases: DataFrame) -> DataFrame:
    """``found`` without phrases that stand in a longer candidate wherever they stand.

    A phrase of one more word is enough to look at: it lies between the two, and so does its count.
    """
    size = F.size("words")
    inner = F.array(part(1, size - 1), part(2, size - 1))
    longer = phrases.filter(size > 2).select("lang", F.explode(inner).alias("words"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "words").agg(F.max("longer").alias("longer"))
    kept = found.join(longer, ["lang", "words"], "left")
    return kept.filter(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).drop("longer")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language by score, count and phrase."""
    words, phrases = counts(docs, least)
    found = closed(scored(words, phrases), phrases)
    text = F.array_join(F.transform("words", lambda w: w.cast("string")), " ")
    found = found.select("lang", text.alias("phrase"), "a", "l", "r", "n", "score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.withColumn("rank", F.col("rank").cast("long"))
