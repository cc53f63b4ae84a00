"""Byte-level BPE by the ranks of a vocabulary file.

Spark's higher-order functions fold the ranked merges over the byte arrays of
distinct words, with the ranks as a literal map. Words are distinct over all texts;
those that are frequent enough for ``TABLE_WORDS`` become a table of known size,
which the tasks hold while they encode texts. The remaining words, which are rare,
are merged where they stand, by the same rules. Decoding concatenates the binary
pieces of the ids, again by higher-order functions.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import materialize

#: The most words in the table, and the most bytes of a word in it.
TABLE_WORDS = 400_000
TABLE_BYTES = 48
#: Tasks that merge the words of the table.
TABLE_TASKS = 64
#: Chunks of text whose ids a task keeps; beyond it the store begins anew.
STORE = 500_000
#: Buckets of the literal rank map. Spark looks a map's key up by reading all keys.
BUCKETS = 1 << 14
#: Stands for "no such rank".
NONE = (1 << 31) - 1

# Unicode white space, by which text parts into chunks that the pattern never joins.
BLANKS = (0x1680, 0x2000, 0x2D, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)  # 0x2D: "to"
SPACE = "\t-\r \x85\xa0" + "".join(map(chr, BLANKS))
CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a file of base64 pieces and ranks, by rank."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    pieces = {int(rank): base64.b64decode(piece) for piece, rank in pairs}
    return [pieces[i] for i in range(len(pieces))]


# ---- merges by higher-order functions ----


def rank_map(pieces: list[bytes]) -> Column:
    """A literal array of maps from hex bytes to rank, by a hash of the bytes."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for rank, piece in enumerate(pieces):
        key = piece.hex().upper()
        buckets[xxhash.xxh64_intdigest(key, 42) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _rank(buckets: Column, key: Column) -> Column:
    bucket = F.get(buckets, F.xxhash64(key).bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
    return F.coalesce(F.try_element_at(bucket, key), F.lit(NONE))


def _merge(state: Column, buckets: Column) -> Column:
    """``state`` after its merge of the lowest rank, the first one of equal rank."""
    parts, ranks = state["parts"], state["ranks"]
    at = F.array_position(ranks, F.array_min(ranks)).cast("int")

    def merged(at: Column) -> Column:
        both = F.concat(F.get(parts, at - 1), F.get(parts, at))
        before, after = F.get(parts, at - 2), F.get(parts, at + 1)
        left = F.when(at > 1, F.array(_rank(buckets, F.concat(before, both)))).otherwise(
            F.array().cast("array<int>")
        )
        right = F.when(after.isNotNull(), F.array(_rank(buckets, F.concat(both, after)))).otherwise(
            F.array().cast("array<int>")
        )
        new_parts = F.concat(
            F.slice(parts, 1, at - 1), F.array(both), F.slice(parts, at + 2, F.size(parts))
        )
        new_ranks = F.concat(
            F.slice(ranks, 1, F.greatest(at - 2, F.lit(0))),
            left,
            right,
            F.slice(ranks, at + 2, F.size(ranks)),
        )
        return F.struct(new_parts.alias("parts"), new_ranks.alias("ranks"))

    done = F.coalesce(F.array_min(ranks), F.lit(NONE)) == NONE
    return F.when(done, state).otherwise(merged(at))


def merge_words(words: DataFrame, pieces: list[bytes]) -> DataFrame:
    """``word`` (text) and ``ids`` (array of int) for the distinct words of ``words``.

    NULL and empty words have no ids. The cost of a word grows with the square of
    its length.
    """
    hexed = F.hex(F.coalesce(F.col("word").cast("binary"), F.lit(b"")))
    size = F.octet_length(F.coalesce(F.col("word"), F.lit("")))
    places = F.sequence(F.lit(0), size - 1)
    parts = F.transform(places, lambda i: F.substring(hexed, 2 * i + 1, F.lit(2)))
    parts = F.when(size > 0, parts).otherwise(F.array().cast("array<string>"))
    rows = words.select("word").distinct().withColumn("parts", parts)

    def fold(buckets: Column) -> Column:
        pairs = F.when(
            F.size("parts") > 1,
            F.transform(
                F.sequence(F.lit(1), F.size("parts") - 1),
                lambda i: _rank(buckets, F.concat(F.get(F.col("parts"), i - 1), F.get(F.col("parts"), i))),
            ),
        ).otherwise(F.array().cast("array<int>"))
        start = F.struct(F.col("parts").alias("parts"), pairs.alias("ranks"))
        merged = F.aggregate(F.col("parts"), start, lambda state, _: _merge(state, buckets))
        return F.transform(merged["parts"], lambda piece: _rank(buckets, piece))

    ids = F.get(F.transform(F.array(rank_map(pieces)), fold), F.lit(0))
    return rows.select("word", ids.alias("ids"))


# ---- merges of a rare word ----


class Merger:
    """The same merges for one word in a task."""

    def __init__(self, pieces: list[bytes]):
        self.ranks = {piece: rank for rank, piece in enumerate(pieces)}

    def __call__(self, word: bytes) -> list[int]:
        rank = self.ranks.get(word)
        if rank is not None:
            return [rank]
        if len(word) > 200:
            return self._long(word)
        parts = [word[i : i + 1] for i in range(len(word))]
        get = self.ranks.get
        pairs = [get(a + b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            best = min(pairs)
            if best == NONE:
                break
            i = pairs.index(best)
            both = parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + both[0], NONE)
            if i < len(pairs):
                pairs[i] = get(both[0] + parts[i + 1], NONE)
        return [self.ranks[p] for p in parts]

    def _long(self, word: bytes) -> list[int]:
        """As above with a heap: a word may be as long as a text."""
        ranks, n = self.ranks, len(word)
        end = list(range(1, n + 1))  # where the part that begins here ends; 0 if none does
        before = list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            j = end[i]
            if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
                heap.append((rank, i, j, end[j])) if building else heapq.heappush(
                    heap, (rank, i, j, end[j])
                )

        building = True
        for i in range(n):
            push(i)
        heapq.heapify(heap)
        building = False
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if end[i] != j or end[j] != k:
                continue  # one of the two has been merged meanwhile
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : end[i]]])
            i = end[i]
        return out


# ---- texts ----


def frequent_words(texts: DataFrame, pattern: str, most: int = TABLE_WORDS) -> DataFrame:
    """At most ``most`` words (``word``) of the column ``text``: the most frequent ones.

    All words after a blank are counted, over whole texts. Words of equal frequency are
    taken together or not at all; the driver gets a few hundred counts.
    """
    chunks = texts.select(F.explode(F.split("text", rf"[{SPACE}]+", -1)).alias("chunk"))
    counts = chunks.groupBy("chunk").agg(F.count("*").alias("n"))
    found = F.regexp_extract_all(F.concat(F.lit(" "), "chunk"), F.lit("(?U)" + pattern), F.lit(0))
    words = counts.select(F.explode(found).alias("word"), "n").groupBy("word")
    words = words.agg(F.sum("n").alias("n")).filter(F.octet_length("word") <= TABLE_BYTES)
    words = materialize(words, "words")
    step = F.floor(F.log2("n") * 32).cast("int")
    room, least = most, math.inf
    steps = words.groupBy(step.alias("step")).agg(F.count("*").alias("n"))
    for row in steps.orderBy(F.desc("step")).collect():
        room -= row["n"]
        if room < 0:
            break
        least = row["step"]
    if least == math.inf:
        return words.select("word").limit(0)
    # Few bytes, but much to do for each word.
    return words.filter(step >= least).select("word").repartition(TABLE_TASKS, "word")


def word_table(texts: DataFrame, pieces: list[bytes], pattern: str) -> dict[str, bytes]:
    """The ids of the frequent words as bytes, four for each id, the lowest first.

    At most ``TABLE_WORDS`` words of at most ``TABLE_BYTES`` bytes.
    """
    # Written first, by many tasks at once: an iterator runs a job for each partition in turn.
    rows = materialize(merge_words(frequent_words(texts, pattern), pieces), "merged")
    return {r["word"]: np.array(r["ids"], "<i4").tobytes() for r in rows.toLocalIterator()}


def encode(docs: DataFrame, path: str, pattern: str, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``__ids`` (array of int) and ``__ids_sha256``; ``text`` only if ``keep_text``.

    ``path`` names the file of ranks, ``pattern`` parts a text into words. Rows stay
    where they are. NULL counts as the empty text, which has no ids. Special tokens
    are ordinary text. ``__ids_sha256`` is of the ids as little-endian 32-bit integers.
    """
    context = docs.sparkSession.sparkContext
    pieces = read_ranks(path)
    table = context.broadcast(word_table(docs.select("text"), pieces, pattern))
    vocabulary = context.broadcast(pieces)
    kept = [f for f in docs.schema.fields if keep_text or f.name != "text"]
    schema = T.StructType(
        [
            *kept,
            T.StructField("__ids", T.ArrayType(T.IntegerType())),
            T.StructField("__ids_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, merge, split = table.value, Merger(vocabulary.value), regex.compile(pattern).findall
        store: dict[str, bytes] = {}

        def ids_of(chunk: str) -> bytes:
            out = []
            for word in split(chunk):
                known = words.get(word)
                if known is None:
                    ids = merge(word.encode())
                    known = struct.pack(f"<{len(ids)}I", *ids)
                out.append(known)
            return b"".join(out)

        def encoded(text: str | None) -> bytes:
            out = []
            for chunk in CHUNK.findall(text or ""):
                known = words.get(chunk) or store.get(chunk)
                if known is None:
                    known = ids_of(chunk)
                    if len(chunk) <= TABLE_BYTES:
                        store[chunk] = known
                out.append(known)
            return b"".join(out)

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for start in range(0, len(texts), 500):
                if len(store) > STORE:
                    store.clear()
                rows = batch.slice(start, 500)
                found = [encoded(text.as_py()) for text in texts.slice(start, 500)]
                ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
                arrays = [rows.column(rows.schema.get_field_index(f.name)) for f in kept]
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), values))
                arrays.append(pa.array([hashlib.sha256(x).hexdigest() for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.mapInArrow(run, schema)


def decoded(ids: Column, path: str) -> Column:
    """The bytes that ``ids`` (array of int) stand for; NULL for NULL, an error for an unknown id."""
    pieces = F.split(F.lit(",".join(piece.hex() for piece in read_ranks(path))), ",")
    found = F.transform(F.array(pieces), lambda all_: F.transform(ids, lambda i: F.element_at(all_, i + 1)))
    return F.unhex(F.array_join(F.get(found, F.lit(0)), ""))
