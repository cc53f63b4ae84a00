"""Near-dedup of documents: SimHash finds pairs by deletion variants, their words decide.

A text's fingerprint is the SimHash of its different words, ``BITS`` bits long: a text that
shares four fifths of its five-word shingles with another one shares nearly all of its words,
so few bits differ. Two fingerprints that differ in at most ``MAX_BITS`` = 9 bits and are cut
into five segments have one segment that differs in at most one bit. Each segment is indexed
as it is and with each of its bits deleted, so such a pair shares an index entry.

Within an entry the fingerprint that has most of the others within ``MAX_BITS`` is linked to
them, then the same with those that are left: the text that copies were made from is nearest
to most of them, so it is the one that they are linked to. An entry with more than ``ENTRY``
fingerprints is compared in parts; one of each group that is connected in its part is indexed
again by the bits that the entry leaves open, cut into five segments again.

That connects fingerprints, not texts: a text may be a copy of another one than that to which
it is linked. So when the links are decided, texts that are near by their fingerprints and not
in one component yet are compared as well, all of them, by the same index; entries with more
than ``ENTRY`` texts are dealt to pairs of blocks. Pairs are not listed: those that may be alike
by the odd buckets of their shingles make groups, and the texts of a group are compared in one
place, or in pairs of parts, where a link that joins no components is left out.

A link counts if the two texts share at least ``LEAST`` of their distinct five-word shingles,
by 32-bit hashes of all shingles of the whole texts. Of each component of such links one
document stays.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A text of fewer than five words is one
shingle; texts without words (NULL, empty or blank) are copies of each other. Equal texts are
one text from the start, however many there are. Documents without an id take part and come
last where one must stay; of rows with equal id and text one stays. Columns of ``docs`` may
have any names.
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
from skyledger.llm.simhash import keep_first

BITS = 60
MAX_BITS = 9
SEGMENTS = 5
SHINGLE = 5
#: The least similarity, as a fraction.
LEAST = (4, 5)
#: Bits of a segment at each level of the index. Each level leaves its bits less one segment.
WIDTHS = (12, 9, 7, 6, 5)
#: Fingerprints of an entry that are compared at once. Larger entries go to the next level.
ENTRY = 4096
#: Fingerprints that are compared with all others of an entry at once, and links that a task holds.
SQUARE, HELD = 512, 200_000
#: Bits by which texts with near fingerprints are told apart before their shingles are compared, and
#: shingles of a part of a group that is compared in parts.
ODD, PART = 1024, 1_000_000


def word_print(data: bytes) -> int:
    """The SimHash of the different words of a text, of ``BITS`` bits."""
    words = set()
    for block in blocks_of_words(data.lower()):
        words.update(block)
    if not words:
        return 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(words)
    majority[BITS:] = False
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def shingles(data: bytes) -> np.ndarray:
    """Hashes of the different five-word shingles of a text, in order."""
    found, tail = [], []
    for block in blocks_of_words(data.lower()):
        words = tail + block
        runs = zip(*(words[i:] for i in range(SHINGLE)), strict=False)
        found.append(np.unique(np.fromiter((xxhash.xxh32_intdigest(b" ".join(r)) for r in runs), np.uint32)))
        tail = words[1 - SHINGLE :]
    if not found or not sum(map(len, found)):
        return np.array([xxhash.xxh32_intdigest(b" ".join(tail))] if tail else [], np.uint32)
    return np.unique(np.concatenate(found))


def _described(data: bytes) -> tuple[int, np.ndarray]:
    return word_print(data), shingles(data).view(np.int32)


# ---- candidates ----


def _entries(level: int, rest: Column, prior: Column) -> Column:
    """The index entries of a text whose open bits at ``level`` are ``rest``."""
    width = WIDTHS[level]
    left = BITS - sum(WIDTHS[:level])
    found = []
    for segment in range(SEGMENTS):
        low = segment * width
        part = F.shiftright(rest, low).bitwiseAND(F.lit((1 << width) - 1))
        above = F.shiftright(rest, low + width)
        below = F.shiftleft(rest.bitwiseAND(F.lit((1 << low) - 1)), left - low - width)
        others = above.bitwiseOR(below)
        for deleted in range(width + 1):
            value = part if deleted == width else part.bitwiseAND(F.lit(~(1 << deleted)))
            key = F.xxhash64(prior, F.lit(segment), F.lit(deleted), value)
            found.append(F.struct(key.alias("key"), others.alias("rest")))
    return F.explode(F.array(*found))


def neighbours(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each fingerprint how many are near it, itself included, and how far these are in all."""
    near, total = np.empty(fps.size, np.int64), np.empty(fps.size, np.int64)
    for low in range(0, fps.size, SQUARE):
        apart = np.bitwise_count(fps[low : low + SQUARE, None] ^ fps[None, :])
        close = apart <= MAX_BITS
        near[low : low + SQUARE] = close.sum(axis=1)
        total[low : low + SQUARE] = np.where(close, apart, 0).sum(axis=1, dtype=np.int64)
    return near, total


def spanning(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between places of ``fps`` that connect whoever is connected within ``MAX_BITS``.

    Most fingerprints are near no other one and are left out first.
    """
    near, total = neighbours(fps)
    left = np.flatnonzero(near > 1)
    left = left[np.lexsort((total[left], -near[left]))]
    links = []
    while left.size > 1:
        reached, left = [left[0]], left[1:]
        while reached and left.size:
            x = reached.pop()
            close = np.bitwise_count(fps[left] ^ fps[x]) <= MAX_BITS
            hits = left[close]
            if hits.size:
                links.append((np.full(hits.size, x), hits))
                reached.extend(hits[::-1])
                left = left[~close]
    return links


def _solve(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Links (``to`` is set) of the entries of a partition sorted by ``key``, and rows of large ones.

    A large entry is taken in parts of ``ENTRY``. Of each group that is connected in a part one
    row goes on to the next level, so a large group of near copies does not go on as a whole.
    """
    names = ["node", "fp", "key", "rest"]
    most = 1 << 62 if last else ENTRY
    ones: list[np.ndarray] = []
    others: list[np.ndarray] = []
    onward: list[list[np.ndarray]] = []

    def part(rows: list[np.ndarray], whole: bool) -> None:
        """The rows of an entry, or of a part of one."""
        node, fp = rows[0], rows[1].view(np.uint64)
        reached = np.zeros(node.size, bool)
        for a, b in spanning(fp):
            ones.append(node[a])
            others.append(node[b])
            reached[b] = True
        if not whole:
            onward.append([c[~reached] for c in rows])

    def solved(rows: list[np.ndarray], split: int | None) -> None:
        """Whole entries, of which the one with the key ``split`` has had parts before."""
        node, fp, key = rows[0], rows[1].view(np.uint64), rows[2]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, key.size])
        large = (sizes > most) | (key[starts] == split if split is not None else False)
        pairs = starts[(sizes == 2) & ~large]
        near = np.bitwise_count(fp[pairs] ^ fp[pairs + 1]) <= MAX_BITS
        ones.append(node[pairs[near]])
        others.append(node[pairs[near] + 1])
        for start, size, is_large in zip(starts, sizes, large, strict=True):
            if is_large:
                for low in range(start, start + size, ENTRY):
                    part([c[low : min(low + ENTRY, start + size)] for c in rows], False)
            elif size > 2:
                part([c[start : start + size] for c in rows], True)

    def out() -> Iterator[pa.RecordBatch]:
        if ones:
            a, b = np.concatenate(ones), np.concatenate(others)
            # The same link comes from several entries.
            low, high = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            zero = np.zeros(low.size, np.int64)
            columns = [pa.array(c, pa.int64()) for c in (low, zero, zero, zero, high)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "to"])
        if onward:
            columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*onward, strict=True)]
            columns.append(pa.nulls(len(columns[0]), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "to"])
        ones.clear()
        others.clear()
        onward.clear()

    held, split = None, None
    for batch in batches:
        rows = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        if not rows[2].size:
            continue
        cut = int(np.searchsorted(rows[2], rows[2][-1]))  # the last entry may go on
        if cut:
            solved([c[:cut] for c in rows], split)
            split = None
        held = [c[cut:] for c in rows]
        while held[2].size > most:
            split = int(held[2][0])
            part([c[:ENTRY] for c in held], False)
            held = [c[ENTRY:] for c in held]
        yield from out()
    if held is not None and held[2].size:
        solved(held, split)
        yield from out()


def candidates(texts: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between the rows ``node``, ``fp`` of ``texts``, each of them once.

    Texts with the same fingerprint are linked to the first and to the last of them; in the
    index the first stands for all.
    """
    same = texts.groupBy("fp").agg(F.min("node").alias("node"), F.max("node").alias("end"))
    same = materialize(same, "fingerprints")
    several = texts.join(same.filter("end > node").withColumnRenamed("node", "start"), "fp")
    several = several.select(F.explode(F.array("start", "end")).alias("a"), F.col("node").alias("b"))
    found = several.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rows = same.select("node", "fp", F.col("fp").alias("rest"), F.lit(0).cast("long").alias("prior"))
    for level in range(len(WIDTHS)):
        last = level + 1 == len(WIDTHS)
        entries = rows.select("node", "fp", _entries(level, F.col("rest"), F.col("prior")).alias("e"))
        entries = entries.select("node", "fp", "e.key", "e.rest").repartition("key").sortWithinPartitions("key")
        solved = entries.mapInArrow(
            lambda batches, last=last: _solve(batches, last),
            "node long, fp long, key long, rest long, to long",
        )
        solved = materialize(solved, "entries")
        made = solved.filter(F.col("to").isNotNull()).select(F.col("node").alias("a"), F.col("to").alias("b"))
        found = found.unionByName(made)
        rows = solved.filter(F.col("to").isNull()).select("node", "fp", "rest", F.col("key").alias("prior"))
        if rows.isEmpty():
            break
    return found.distinct()


def _groups(batches: Iterator[pa.RecordBatch], names: list[str], wide: str | None = None):
    """The columns ``names`` of each ``dealt`` entry of a sorted partition, and of ``wide`` the words of 64 bits.

    Entries with one root are passed over.
    """

    def whole(rows: np.ndarray, bits: np.ndarray):
        starts = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])
        ends = np.r_[starts[1:], rows.shape[1]]
        root = rows[names.index("root")]
        mixed = np.maximum.reduceat(root, starts) != np.minimum.reduceat(root, starts)
        for start, end in zip(starts[mixed], ends[mixed], strict=True):
            yield rows[:, start:end], bits[start:end]

    rows, bits = np.empty((len(names), 0), np.int64), np.empty((0, ODD // 64 if wide else 0), np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        more = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
        rows = np.concatenate([rows, more], axis=1)
        made = np.frombuffer(b"".join(batch.column(wide).to_pylist()) if wide else b"", np.uint64)
        bits = np.concatenate([bits, made.reshape(batch.num_rows, -1)])
        cut = int(np.searchsorted(rows[0], rows[0, -1]))  # the last entry may go on
        if cut:
            yield from whole(rows[:, :cut], bits[:cut])
        rows, bits = rows[:, cut:], bits[cut:]
    if rows.shape[1]:
        yield from whole(rows, bits)


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts that are near one with another root in an entry.

    The rows of two blocks are compared across, as each block is an entry of its own too.
    """

    def found(rows: np.ndarray) -> np.ndarray:
        _, node, fp, root, part = rows
        two_parts, some = part.min() != part.max(), np.zeros(node.size, bool)
        for low in range(0, node.size, SQUARE):
            one = slice(low, low + SQUARE)
            hit = np.bitwise_count(fp[one][:, None] ^ fp) <= MAX_BITS
            hit &= root[one][:, None] != root
            if two_parts:
                hit &= part[one][:, None] != part
            some |= hit.any(axis=0)
        return node[some]

    def given(held: list[np.ndarray]) -> pa.RecordBatch:
        # The same text comes from several entries.
        return pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)))], names=["node"])

    held, size = [], 0
    for rows, _ in _groups(batches, ["dealt", "node", "fp", "root", "part"]):
        held.append(found(rows))
        size += held[-1].size
        if size >= HELD:
            yield given(held)
            held, size = [], 0
    if held:
        yield given(held)


def odd_bits(hashes: np.ndarray) -> bytes:
    """Of each of ``ODD`` buckets whether an odd number of ``hashes`` is in it.

    Two sets differ in at least as many members as these bits do.
    """
    counts = np.bincount(hashes.view(np.uint32) % np.uint32(ODD), minlength=ODD)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of ``shingles`` and their ``odd_bits`` in their place."""
    for batch in batches:
        column = batch.column("shingles")
        ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        odd = pa.array([odd_bits(values[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())
        arrays = [*(batch.column(n) for n in ("node", "fp", "root")), pa.array(np.diff(ends), pa.int64()), odd]
        yield pa.RecordBatch.from_arrays(arrays, names=["node", "fp", "root", "size", "odd"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect the texts of an entry that are near, have different roots and may be alike.

    Of texts that share ``LEAST`` of all their shingles few enough are in one of them only. Links
    span the groups that such pairs connect; they are not all pairs.
    """
    more, less = LEAST[1] - LEAST[0], LEAST[1] + LEAST[0]

    def given(held: list[np.ndarray]) -> pa.RecordBatch:
        a, b = np.unique(np.concatenate(held, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    held, size = [], 0
    for rows, bits in _groups(batches, ["dealt", "node", "fp", "root", "size"], "odd"):
        _, node, fp, root, n = rows
        left = np.arange(node.size)
        while left.size > 1:
            reached, left = [left[0]], left[1:]
            while reached and left.size:
                x = reached.pop()
                hits = left[(np.bitwise_count(fp[left] ^ fp[x]) <= MAX_BITS) & (root[left] != root[x])]
                if hits.size:
                    apart = np.bitwise_count(bits[hits] ^ bits[x]).sum(axis=1, dtype=np.int64)
                    hits = hits[less * np.maximum(apart, abs(n[hits] - n[x])) <= more * (n[hits] + n[x])]
                if hits.size:
                    held.append(np.sort(np.stack([np.full(hits.size, node[x]), node[hits]]), axis=0))
                    size += hits.size
                    reached.extend(hits)
                    left = left[~np.isin(left, hits, assume_unique=True)]
        if size >= HELD:
            yield given(held)
            held, size = [], 0
    if held:
        yield given(held)


def _dealt(texts: DataFrame, *more: str) -> DataFrame:
    """The rows ``node``, ``fp``, ``root`` of ``texts`` by ``dealt``, in pairs of blocks of their index entries."""
    prior = F.lit(0).cast("long")
    entries = texts.select("node", "fp", "root", *more, _entries(0, F.col("fp"), prior).alias("e"))
    entries = entries.select("node", "fp", "root", *more, "e.key")
    # The first level has at most 2 ** 12 * 13 * 5 entries, whatever the number of texts.
    large = texts.select(_entries(0, F.col("fp"), prior).alias("e")).groupBy("e.key").agg(F.count("*").alias("many"))
    large = materialize(large.filter(F.col("many") > ENTRY), "large-entries")
    parts = F.coalesce(F.ceil(F.col("many") / ENTRY), F.lit(1).cast("long"))
    rows = entries.join(F.broadcast(large), "key", "left").withColumn("parts", parts)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    dealt = F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("dealt")
    rows = rows.select(dealt, "node", "fp", "root", "part", *more)
    return rows.repartition("dealt").sortWithinPartitions("dealt")


def alike(root: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between places of ``sets`` that share ``LEAST`` of their members and have different roots.

    As many as connect whom all such links, and equal roots, connect.
    """
    sizes = np.array([s.size for s in sets], np.int64)
    _, ids, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(sizes.size), sizes)
    several = many[ids] > 1  # the others are shared by none
    ids, owner = ids[several], owner[several]
    order = np.argsort(ids, kind="stable")
    holders, starts = owner[order], np.r_[0, np.cumsum(np.bincount(ids, minlength=many.size))]
    ends = np.searchsorted(owner, np.arange(sizes.size + 1))
    _, of = np.unique(root, return_inverse=True)
    links = []
    for x in range(sizes.size):
        own = ids[ends[x] : ends[x + 1]]
        held = starts[own + 1] - starts[own]
        at = np.repeat(starts[own] - np.cumsum(held) + held, held) + np.arange(int(held.sum()))
        shared = np.bincount(holders[at], minlength=sizes.size)
        hit = (shared * LEAST[1] >= (sizes + sizes[x] - shared) * LEAST[0]) & (of != of[x])
        for y in np.flatnonzero(hit):
            if of[y] != of[x]:
                links.append((x, int(y)))
                of[of == of[y]] = of[x]
    return links


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of ``alike`` of each ``dealt`` part of a partition sorted by it."""

    def out(rows: list[np.ndarray], sets: list[np.ndarray]) -> pa.RecordBatch:
        node = rows[1]
        links = np.array(alike(rows[2], sets), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(node[links[:, i]]) for i in range(2)], names=["a", "b"])

    rows, sets = [np.empty(0, np.int64)] * 3, []
    for batch in batches:
        if not batch.num_rows:
            continue
        more = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("dealt", "node", "root")]
        column = batch.column("shingles")
        ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        rows = [np.concatenate(x) for x in zip(rows, more, strict=True)]
        sets += [values[a:b].copy() for a, b in zip(ends, ends[1:])]
        starts = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
        for a, b in zip(starts, starts[1:]):  # the last part may go on
            yield out([c[a:b] for c in rows], sets[a:b])
        rows, sets = [c[starts[-1] :] for c in rows], sets[starts[-1] :]
    if sets:
        yield out(rows, sets)


def apart(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that join the components of all texts that are near and alike.

    ``texts`` have ``node``, ``fp`` and ``root``, ``sets`` the ``shingles`` of each ``node``. First
    the texts are found that are near one with another root. Among these, pairs whose shingles may
    agree make groups, and the texts of a group are compared with each other on all shingles.
    Of both only links that span what they connect are given.
    """
    some = _dealt(texts).mapInArrow(_beside, "node long").distinct()
    some = materialize(texts.join(some, "node").join(sets, "node"), "beside")
    if some.isEmpty():
        return texts.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    marked = some.select("node", "fp", "root", "shingles").mapInArrow(
        _marked, "node long, fp long, root long, size long, odd binary"
    )
    marked = materialize(marked, "marked")
    links = _dealt(marked, "size", "odd").mapInArrow(_joined, "a long, b long").distinct()
    cells = materialize(connected(links).withColumnRenamed("root", "cell"), "cells")
    held = some.select("node", "root", "shingles").join(cells, "node")
    parts = held.groupBy("cell").agg(F.ceil(F.sum(F.size("shingles")) / PART).alias("parts"))
    rows = held.join(parts, "cell").withColumn("parts", F.greatest("parts", F.lit(1).cast("long")))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    # Two parts meet once; each of several is compared with itself there too.
    alone = (F.col("part") != F.col("other")) | (F.col("parts") == 1)
    dealt = F.xxhash64("cell", F.least("part", "other"), F.greatest("part", "other")).alias("dealt")
    rows = rows.filter(alone).select(dealt, "node", "root", "shingles")
    return rows.repartition("dealt").sortWithinPartitions("dealt").mapInArrow(_compared, "a long, b long")


# ---- links and components ----


def similar(links: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``links`` whose texts share enough of their ``shingles``."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = links.join(one, "a").join(other, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - shared
    return both.filter(shared * LEAST[1] >= either * LEAST[0]).select("a", "b")


def components(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest`` (of the text) and ``root`` (of its component) of every row of ``docs``."""
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"), F.col("text"))
    prints = map_texts(rows, _described, "fp long, shingles array<int>")
    prints = materialize(prints.withColumn("place", F.monotonically_increasing_id()), "prints")
    texts = prints.groupBy("digest").agg(F.min("place").alias("node"), F.min("fp").alias("fp"))
    texts = materialize(texts, "texts")
    sets = prints.select(F.col("place").alias("node"), "shingles")
    tried = materialize(candidates(texts), "candidates")
    links = materialize(similar(tried, sets), "similar")

    def with_roots(links: DataFrame) -> DataFrame:
        roots = texts.join(connected(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
        return materialize(roots, "roots")

    roots = with_roots(links)
    more = materialize(apart(roots, sets), "similar")
    if not more.isEmpty():
        roots = with_roots(links.unionByName(more))
    rooted = roots.select("digest", "root")
    return prints.select("doc_id", "digest").join(rooted, "digest")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each component, with all its columns: that with the smallest ``doc_id``."""
    return keep_first(docs, components(docs))
