"""Near-duplicates by SimHash, found through deletion-variant signatures.

Two fingerprints that differ in at most three of 64 bits have a half of 32 bits
that differs in at most one. A half is indexed as it is and with each of its bits
deleted, so the halves of such a pair share an index entry; whoever shares an
entry is verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import blocks_of_words, digest, map_texts, materialize
from skyledger.llm.components import connected

MAX_BITS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints of one index entry that a task verifies at once. Entries with more
#: are indexed again by their other bits; after the last level an entry has at most
#: 2 ** (8 + MAX_BITS) fingerprints.
ENTRY = 4096


def fingerprint(data: bytes) -> int:
    """The SimHash of a text's word shingles, as a signed 64-bit integer."""
    counts, n, tail = np.zeros(64, np.int64), 0, []
    for block in blocks_of_words(data.lower()):
        words = tail + block
        shingles = zip(*(words[i:] for i in range(SHINGLE)), strict=False)
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles]
        tail = words[-(SHINGLE - 1) :]
        if hashes:
            n += len(hashes)
            counts += _bits(hashes)
    if n == 0 and tail:
        n, counts = 1, _bits([xxhash.xxh64_intdigest(b" ".join(tail), SEED)])
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<i8")[0])


def _bits(hashes: list[int]) -> np.ndarray:
    """How many of ``hashes`` have each bit set, the lowest first."""
    rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``digest`` of every row of ``docs``.

    A NULL or blank text has fingerprint zero.
    """
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"), F.col("text"))
    return map_texts(rows, lambda data: (fingerprint(data),), "fingerprint long")


def _entries(half: int, offset: Column, prior: Column) -> Column:
    """The index keys of a fingerprint for two halves of ``half`` bits from ``offset``."""
    keys = []
    for h in (0, 1):
        shift = (offset + h * half).cast("int")
        part = F.call_function("shiftrightunsigned", F.col("fp"), shift).bitwiseAND(
            F.lit((1 << half) - 1)
        )
        other = offset + (1 - h) * half
        for deleted in range(half + 1):
            left = part if deleted == half else part.bitwiseAND(F.lit(~(1 << deleted)))
            bit = F.lit(64) if deleted == half else offset + (h * half + deleted)
            # Level 0 keys are exact; deeper ones are hashes, and links are verified anyway.
            key = (
                F.lit((h * 33 + deleted) << 32) + left
                if half == 32
                else F.xxhash64(prior, F.lit(h), F.lit(deleted), left)
            )
            keys.append(
                F.struct(key.alias("key"), bit.cast("int").alias("bit"), other.cast("int").alias("off"))
            )
    return F.explode(F.array(*keys))


def _spanning(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whoever is connected by differences of at most ``MAX_BITS``."""
    ones, others, left = [], [], members
    while left.size > 1:
        reached, left = [left[0]], left[1:]
        while reached and left.size:
            x = reached.pop()
            near = np.bitwise_count(left ^ x) <= MAX_BITS
            hits = left[near]
            if hits.size:
                ones.append(np.full(hits.size, x))
                others.append(hits)
                reached.extend(hits)
                left = left[~near]
    if not ones:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(ones), np.concatenate(others)


def _links_of(key: np.ndarray, bit: np.ndarray, fp: np.ndarray):
    """Links of all entries of rows sorted by ``key``, and the rows of too large ones."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, key.size])
    pairs = starts[sizes == 2]
    a, b = fp[pairs], fp[pairs + 1]
    near = np.bitwise_count(a ^ b) <= MAX_BITS
    links = [(a[near], b[near])]
    large = np.zeros(key.size, bool)
    for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
        members = fp[start : start + size]
        if bit[start] < 64:
            # Members with the same deleted bit meet in the entry without a deletion too.
            set_ = (members >> np.uint64(bit[start])) & np.uint64(1)
            if set_.min() == set_.max():
                continue
        if size > ENTRY:
            large[start : start + size] = True
        else:
            links.append(_spanning(members))
    return np.concatenate([x for x, _ in links]), np.concatenate([x for _, x in links]), large


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the entries in a partition sorted by key, fp; rows of entries beyond ENTRY as they are.

    An entry that is cut by the end of a batch is held back. One that is beyond
    ``ENTRY`` already passes through, so at most ``ENTRY`` rows are held.
    """
    held, passing = None, None
    schema = ["key", "bit", "off", "fp", "to"]

    def out(columns, to):
        arrays = [pa.array(c) for c in columns]
        last = pa.nulls(len(columns[0]), pa.int64()) if to is None else pa.array(to)
        return pa.RecordBatch.from_arrays([*arrays, last], names=schema)

    def solved(rows):
        a, b, large = _links_of(rows[0], rows[1], rows[3].view(np.uint64))
        if a.size:
            zero = np.zeros(a.size, np.int32)
            yield out([np.zeros(a.size, np.int64), zero, zero, a.view(np.int64)], b.view(np.int64))
        if large.any():
            yield out([c[large] for c in rows], None)

    for batch in batches:
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if passing is not None:
            more = rows[0] == passing
            if more.any():
                yield out([c[more] for c in rows], None)
                rows = [c[~more] for c in rows]
            if not rows[0].size:
                continue
            passing = None
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        if rows[0].size - cut > ENTRY:
            passing, held = rows[0][-1], None
            yield out([c[cut:] for c in rows], None)
        else:
            held = [c[cut:] for c in rows]
        if cut:
            yield from solved([c[:cut] for c in rows])
    if held is not None:
        yield from solved(held)


def links(values: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` among the distinct longs ``fp`` of ``values``.

    Not all links, which a group of near copies has in the square of its size, but
    enough that whoever is connected through differences of at most ``MAX_BITS``
    bits is connected through them; each is verified. An index entry with more than
    ``ENTRY`` fingerprints is split by indexing the bits it leaves open the same
    way, and so on: a task never holds more.
    """
    rows = values.select("fp").withColumns(
        {"off": F.lit(0), "prior": F.lit(0).cast("long")}
    )
    found = None
    for half in (32, 16, 8):
        entries = rows.select("fp", _entries(half, F.col("off"), F.col("prior")).alias("e"))
        entries = entries.select("e.key", "e.bit", "e.off", "fp")
        entries = entries.repartition("key").sortWithinPartitions("key")
        solved = materialize(
            entries.mapInArrow(_verify, "key long, bit int, off int, fp long, to long"), "entries"
        )
        made = solved.filter(F.col("to").isNotNull()).select(
            F.col("fp").alias("a"), F.col("to").alias("b")
        )
        found = made if found is None else found.unionByName(made)
        rows = solved.filter(F.col("to").isNull()).select(
            "fp", "off", F.col("key").alias("prior")
        )
        if rows.isEmpty():
            break
    return found


def components(prints: DataFrame) -> DataFrame:
    """``prints`` (as ``fingerprints`` gives it) with ``component_id`` and ``root``.

    Fingerprints link at ``MAX_BITS`` or fewer differing bits. ``component_id`` is the
    smallest ``doc_id`` that links reach, the document itself included; NULL ids are
    passed over, and a component of nothing else has NULL. ``root`` numbers the
    components. Repeated rows come back repeated.
    """
    prints = materialize(prints, "prints")
    classes = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least"))
    classes = materialize(classes, "classes")
    roots = materialize(connected(links(classes)), "roots")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    return prints.join(named, prints["fingerprint"] == named["fp"]).drop("fp")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each component, with all its columns: that with the smallest ``doc_id``.

    NULL ids come last; of rows with the same id, the one with the smallest digest
    of its text stays, and of rows that agree in both just one.
    """
    return keep_first(docs, components(fingerprints(docs)))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The row of ``docs`` that stays of each ``root``; ``found`` has ``root``, ``doc_id``, ``digest``."""
    found = found.groupBy("root", "doc_id", "digest")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "n")
    first = found.agg(F.count("*").alias("n")).groupBy("root").agg(F.min(order).alias("o"))
    first = first.select(
        F.col("root").alias("__root"),
        F.col("o.doc_id").alias("__id"),
        F.col("o.digest").alias("__digest"),
        F.col("o.n").alias("__n"),
    )
    first = materialize(first, "first")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("__row"),
        docs["doc_id"].alias("__doc"),
        digest(docs["text"]).alias("__of"),
    )
    same = F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__digest"))
    single = rows.join(first.filter("__n = 1"), same, "left_semi").select("__row")
    several = rows.join(first.filter("__n > 1"), same).groupBy("__root")
    one = several.agg(F.min_by("__row", F.xxhash64("__row")).alias("__row")).select("__row")
    return single.unionByName(one).select("__row.*")
