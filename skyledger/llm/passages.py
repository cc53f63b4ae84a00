"""Near-duplicate passages by compact windows.

The tokens of a text are its shingles of ``SHINGLE`` words. Under one hash function
all passages that lie in a window (l, c, r), with l <= start <= c <= end <= r, have
the same smallest token, that at c: a Cartesian tree over the hashes gives few
windows that hold all passages of a length. Passages that are alike share the
smallest token under most hash functions. So windows meet by their smallest token;
places that meet under enough functions are candidates, and these are verified on
their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import materialize
from skyledger.llm.components import connected

SHINGLE = 5
#: Words of a passage at least, and the Jaccard similarity of the shingles of two.
WORDS = 50
SIMILARITY = 0.8
#: Hash functions, and under how many of them two places must meet.
HASHES, ENOUGH = 4, 2
#: Windows or pairs that a task holds before it hands them on.
LOCAL = 500_000
#: Windows of a key that are all paired at once. Keys with more are linked first, and then paired
#: where they stand in several classes, at most two blocks of them in a task.
FEW, BLOCK = 16, 16_384
#: Words of 64 bits of the sketch of a window, and stretches that a task holds before it hands them on.
SKETCH, HELD = 32, 10_000
#: Bytes of text that are hashed, and shingles of stretches that are looked up, at once.
MANY, LOOKED = 1 << 17, 1 << 20

SPAN = WORDS - SHINGLE + 1
_TURNS = np.random.default_rng(0).integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)


_BLANK = bytes(x in b" \t\n\r\x0b\x0c" for x in range(256))
#: The first 0 to 8 bytes of a word of 64 bits.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and of each text the first of its words and their number."""
    data = b" ".join(texts).lower()
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = np.frombuffer(data.translate(_BLANK), bool)
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))

    def taken(out: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        out = (out ^ (eight[at] & _FIRST[np.minimum(left, 8)])) * _ODD
        return out ^ (out >> np.uint64(29))

    out, step = taken(sizes.astype(np.uint64) * _ODD, starts, sizes), 8
    some = np.flatnonzero((sizes > 8) & (sizes <= 256))
    while some.size:
        out[some] = taken(out[some], starts[some] + step, sizes[some] - step)
        step += 8
        some = some[sizes[some] > step]
    for i in np.flatnonzero(sizes > 256):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + sizes[i]])
    out *= _ODD
    out ^= out >> np.uint64(32)
    ends = np.cumsum([len(text) + 1 for text in texts])
    last = np.searchsorted(starts, ends)
    first = np.r_[0, last[:-1]]
    return out, first, last - first


def mixed(one: np.ndarray) -> np.ndarray:
    """64-bit hashes of the shingles of words with the hashes ``one``."""
    n = max(0, one.size - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out ^= one[k : k + n]
        out *= _ODD
        out ^= out >> np.uint64(29)
    return out


def shingles(texts: list[bytes]) -> list[np.ndarray]:
    """64-bit hashes of the shingles of each text, in place."""
    one, first, sizes = word_hashes(texts)
    tokens = mixed(one)
    return [tokens[i : i + max(0, n - SHINGLE + 1)] for i, n in zip(first, sizes, strict=True)]


def hashed(tokens: np.ndarray, function: int) -> np.ndarray:
    mixed = (tokens ^ (tokens >> np.uint64(31))) * _TURNS[function]
    return mixed ^ (mixed >> np.uint64(32))


def windows(
    values: np.ndarray, span: int = SPAN, repeats: bool = True
) -> list[tuple[int, int, int]]:
    """The compact windows (l, c, r) of at least ``span`` tokens, r included.

    The nodes of the Cartesian tree from the smallest value down. Of equal values the
    middle one is the node, so that repeated text makes no deep tree; ``repeats`` says
    whether there can be any.
    """
    out, todo = [], [(0, values.size)]
    while todo:
        low, high = todo.pop()
        if high - low < span:
            continue
        part = values[low:high]
        c = int(part.argmin())
        if repeats and c + 1 < part.size and part[c + 1 :].min() == part[c]:
            same = np.flatnonzero(part == part[c])
            c = int(same[np.abs(same - part.size // 2).argmin()])
        c += low
        out.append((low, c, high - 1))
        todo += [(low, c), (c + 1, high)]
    return out


def _sliding(values: np.ndarray, span: int, of: np.ufunc) -> np.ndarray:
    """``of``, np.minimum or np.maximum, over each ``span`` consecutive values."""
    width = 1
    while 2 * width <= span:
        values = of(values[:-width], values[width:])
        width *= 2
    return of(values[: values.size - span + width], values[span - width :]) if width < span else values


def _smaller(values: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """The place before each of ``values`` that has a smaller one, or ``edge`` where none after that has."""
    before = np.arange(values.size) - 1
    todo = np.arange(values.size)
    while True:
        todo = todo[before[todo] > edge[todo]]
        todo = todo[values[before[todo]] > values[todo]]
        if not todo.size:
            return before
        before[todo] = before[before[todo]]


def _windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of texts: rows of key, l, r, and the place of the text of each.

    The two lowest bits of a key number the function. The nodes of the trees are the tokens that are
    the smallest of a stretch of ``SPAN``, each of which reaches to the next smaller ones. A text in
    which such a token comes again is left to ``windows``.
    """
    one, starts, sizes = word_hashes(texts)
    tokens = mixed(one)
    if tokens.size < SPAN:
        return np.empty((0, 3), np.int64), np.empty(0, np.int64)
    of = np.repeat(np.arange(len(texts)), sizes)
    within = of[: tokens.size - SPAN + 1] == of[SPAN + SHINGLE - 2 :]  # stretches that lie in one text
    rows, places = [], []
    for function in range(HASHES):
        values = hashed(tokens, function)
        least = np.zeros(tokens.size + SPAN - 1, np.uint64)
        least[SPAN - 1 : tokens.size] = np.where(within, _sliding(values, SPAN, np.minimum), np.uint64(0))
        c = np.flatnonzero(values == _sliding(least, SPAN, np.maximum))
        node, text = values[c], of[c]
        order = np.lexsort([node, text])
        again = (node[order][1:] == node[order][:-1]) & (text[order][1:] == text[order][:-1])
        odd = np.unique(text[order][1:][again])
        if odd.size:
            fine = ~np.isin(text, odd)
            c, node, text = c[fine], node[fine], text[fine]
        first = np.searchsorted(text, text)
        last = np.searchsorted(text, text, side="right") - 1
        before = _smaller(node, first - 1)
        after = c.size - 1 - _smaller(node[::-1], (c.size - 2 - last)[::-1])[::-1]
        low = np.where(before < first, starts[text], c[before] + 1)
        high = np.where(after > last, starts[text] + sizes[text] - SHINGLE, c[np.minimum(after, c.size - 1)] - 1)
        found = [np.column_stack([c, low, high])]
        for one in odd:
            more = windows(values[starts[one] : starts[one] + sizes[one] - SHINGLE + 1])
            found.append(np.array(more, np.int64).reshape(-1, 3)[:, [1, 0, 2]] + starts[one])
            text = np.r_[text, np.full(len(more), one)]
        found = np.concatenate(found)
        found[:, 1:] -= starts[text][:, None]
        found[:, 0] = (tokens[found[:, 0]].view(np.int64) & ~np.int64(3)) | function
        rows.append(found)
        places.append(text)
    return np.concatenate(rows), np.concatenate(places)


#: A window, and the window of another text that it meets. ``at`` has l and r, 32 bits each.
COLUMNS = ["key", "text_id", "at"]
ROW = "key long, text_id long, at long"
PAIR = f"{ROW}, o_text_id long, o_at long"


def _linked(rows: np.ndarray, prior: np.ndarray):
    """Pairs of rows sorted by key: each with the first and the previous one of its key.

    Columns of ``rows`` as in ``COLUMNS``. ``prior`` has the first and the last row of the
    key that went before, once if they are one, and none at the beginning. Returns the
    pairs, all rows, and the place of each row's first.
    """
    rows = np.concatenate([prior, rows])
    fresh = np.r_[True, rows[1:, 0] != rows[:-1, 0]]
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))
    at = np.flatnonzero(~fresh)
    at = at[at >= len(prior)]
    one, two = head[at], at - 1
    pairs = np.concatenate(
        [
            np.column_stack([rows[at], rows[one][:, 1:]]),
            np.column_stack([rows[at], rows[two][:, 1:]])[one != two],
        ]
    )
    return pairs[pairs[:, 1] != pairs[:, 3]], rows, head


def _all_pairs(rows: np.ndarray) -> np.ndarray:
    """All pairs of rows with equal key of ``rows`` sorted by key, with at most ``FEW`` of a key."""
    found = [np.empty((0, 5), np.int64)]
    for apart in range(1, FEW):
        low = np.flatnonzero((rows[apart:, 0] == rows[:-apart, 0]) & (rows[apart:, 1] != rows[:-apart, 1]))
        found.append(np.column_stack([rows[low + apart], rows[low][:, 1:]]))
    return np.concatenate(found)


def _batch(pairs: np.ndarray, alone: np.ndarray) -> pa.RecordBatch:
    """Pairs, and rows without another one, as a batch of ``PAIR``."""
    missing = np.r_[np.zeros(len(pairs), bool), np.ones(len(alone), bool)]
    arrays = [pa.array(np.concatenate([pairs[:, i], alone[:, i]])) for i in range(3)]
    filler = np.zeros(len(alone), np.int64)
    arrays += [pa.array(np.concatenate([pairs[:, i], filler]), mask=missing) for i in (3, 4)]
    return pa.RecordBatch.from_arrays(arrays, names=[*COLUMNS, "o_text_id", "o_at"])


def _make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of the texts; a text that comes again among the same ``LOCAL`` windows adds none."""
    held, size, seen = [], 0, set()
    ids, texts, length = [], [], 0

    def made() -> np.ndarray:
        found, place = _windows_of(texts)
        return np.column_stack([found[:, 0], np.array(ids, np.int64)[place], (found[:, 1] << 32) | found[:, 2]])

    def given(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held)
        return pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in range(3)], names=COLUMNS)

    for batch in batches:
        for text_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            if text_id in seen:
                continue
            seen.add(text_id)
            ids.append(text_id)
            texts.append(text.as_py())
            length += len(texts[-1])
            if length >= MANY or len(texts) >= MANY:
                held.append(made())
                size += len(held[-1])
                ids, texts, length = [], [], 0
            if held and (size >= LOCAL or len(seen) >= LOCAL):
                yield given(held)
                held, size, seen = [], 0, set()
    if texts:
        held.append(made())
    if held:
        yield given(held)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a partition sorted by key, text and place; the windows of keys with more than ``FEW``.

    Of such a key each window is paired with the first and the previous one, and given
    alone, for ``apart``; of other keys all pairs are made. Only the first and the last row of
    a large key are held, whatever its size.
    """

    def once(rows: np.ndarray) -> np.ndarray:
        """Without the windows of a text that several tasks have made."""
        return rows[np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)]] if len(rows) else rows

    def whole(rows: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
        sizes = np.diff(np.r_[starts, len(rows)])
        large = np.repeat(sizes > FEW, sizes)
        few, many = rows[~large & np.repeat(sizes > 1, sizes)], rows[large]
        if not len(many):
            return _batch(_all_pairs(few), many)
        return _batch(np.concatenate([_all_pairs(few), _linked(many, none)[0]]), many)

    none = np.empty((0, len(COLUMNS)), np.int64)
    held, prior = none, none
    for batch in batches:
        rows = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
        if len(prior):
            rows = once(np.concatenate([prior[-1:], rows]))[1:]
            end = int(np.searchsorted(rows[:, 0], prior[0, 0], side="right"))
            if end:
                pairs, more, _ = _linked(rows[:end], prior)
                yield _batch(pairs, rows[:end])
                prior = more[[0, -1]]
            rows = rows[end:]
            if len(rows):
                prior = none
        rows = once(np.concatenate([held, rows]))
        if not len(rows):
            continue
        end = int(np.searchsorted(rows[:, 0], rows[-1, 0]))  # the last key may go on
        if end:
            yield whole(rows[:end])
        held = rows[end:]
        if len(held) > FEW:
            yield whole(held)
            held, prior = none, held[[0, -1]]
    if len(held):
        yield whole(held)


def _regions(
    meets: list[tuple[int, int, int, int, int]], enough: int = ENOUGH
) -> list[tuple[int, int, int, int]]:
    """Where the windows (function, l, r, o_l, o_r) of two texts overlap in both, under ``enough`` functions.

    Windows that overlap in both texts make one region, l to r and o_l to o_r included.
    """
    out: list[list] = []
    for f, l, r, o_l, o_r in sorted(meets, key=lambda m: m[1:]):
        touched = [x for x in out if l <= x[1] and r >= x[0] and o_l <= x[3] and o_r >= x[2]]
        whole = [l, r, o_l, o_r, {f}]
        for x in touched:
            out.remove(x)
            whole = [
                min(whole[0], x[0]), max(whole[1], x[1]), min(whole[2], x[2]), max(whole[3], x[3]),
                whole[4] | x[4],
            ]
        out.append(whole)
    return [tuple(x[:4]) for x in out if len(x[4]) >= enough]


PAIRED = ["text_id", "o_text_id"]
REGION = "struct<l:int,r:int,o_l:int,o_r:int>"


def _overlap(batches: Iterator[pa.RecordBatch], enough: int) -> Iterator[pa.RecordBatch]:
    """The interval join of the windows of each pair of texts."""
    kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("l", "r", "o_l", "o_r")]))
    low = (1 << 32) - 1
    for batch in batches:
        found = []
        for meets in batch.column(2):
            rows = {
                (m["f"], m["at"] >> 32, m["at"] & low, m["o_at"] >> 32, m["o_at"] & low)
                for m in meets.as_py()
            }
            regions = _regions(list(rows), enough)
            found.append([dict(zip(("l", "r", "o_l", "o_r"), x, strict=True)) for x in regions])
        some = pa.array([bool(x) for x in found])
        out = pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, kind)], names=[*PAIRED, "regions"]
        )
        yield out.filter(some)


def meetings(texts: DataFrame) -> DataFrame:
    """Rows of ``PAIR``: windows of ``texts`` that meet, and alone those of keys with more than ``FEW``.

    Texts with one ``text_id`` are the same text.
    """
    made = texts.select("text_id", "text").mapInArrow(_make, ROW)
    dealt = made.repartition("key").sortWithinPartitions("key", "text_id", "at")
    return dealt.mapInArrow(_meet, PAIR)


def regions(pairs: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """``text_id``, ``o_text_id`` and ``regions``: where the ``pairs`` meet under ``enough`` functions."""
    swapped = F.col("text_id") < F.col("o_text_id")  # one direction: the larger id first

    def either(one: str, two: str):
        return F.when(swapped, F.col(two)).otherwise(F.col(one))

    rows = pairs.select(
        either("text_id", "o_text_id").alias("text_id"),
        either("o_text_id", "text_id").alias("o_text_id"),
        F.struct(
            F.col("key").bitwiseAND(F.lit(3)).cast("int").alias("f"),
            either("at", "o_at").alias("at"),
            either("o_at", "at").alias("o_at"),
        ).alias("meet"),
    )
    met = rows.groupBy(*PAIRED).agg(F.collect_list("meet").alias("meets"))
    return met.filter(F.size("meets") >= enough).mapInArrow(
        lambda batches: _overlap(batches, enough), f"text_id long, o_text_id long, regions array<{REGION}>"
    )


def candidates(texts: DataFrame) -> DataFrame:
    """``text_id``, ``o_text_id`` and ``regions``: where two of ``texts`` meet under ``ENOUGH`` functions.

    Windows of a key with more than ``FEW`` are linked with the first of them and with the one
    before, so a passage that stands in m texts makes fewer than 2 m links under a function,
    not the square of m. What that leaves out is found by ``apart``.
    """
    return regions(meetings(texts).filter(F.col("o_text_id").isNotNull()))


# ---- pairs that the links of large keys leave out ----


def _sketch(tokens: np.ndarray) -> tuple[bytes, int]:
    """A bit for each of ``tokens``, in ``SKETCH`` words of 64, and how many an alike passage has in common.

    So few bits, the most frequent ones, are of ``SIMILARITY * SPAN`` tokens.
    """
    kind = tokens.dtype.type
    counts = np.bincount(((tokens >> kind(20)) % kind(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH)
    most = np.cumsum(-np.sort(-counts))
    return np.packbits(counts > 0).tobytes(), int(np.searchsorted(most, SIMILARITY * SPAN)) + 1


#: Shingles that an alike passage has in common with the other one in some ``SPAN`` of its own, at least. A stretch
#: of n shingles with a share of ``SHARES[0]`` has one of less than ``2 * SPAN`` with it, which misses m of them.
#: Its first and last ``SPAN`` miss m and what is missed in both, so one of them misses at most 9 of 46.
NEED = int(np.ceil(SIMILARITY * SPAN))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of each text with a stretch of up to ``2 * SPAN`` - 1 shingles either side of the smallest.

    The stretch is given by ``near``, as ``at``, and by 16 bits of each of its words. Windows of a text
    with the same key and stretch are given once.
    """
    names = ["key", "text_id", "class", "size", "at", "near", "stretch"]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    low = (1 << 32) - 1

    def given(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    rows: list[tuple] = []
    for batch in batches:
        for begin in range(0, batch.num_rows, 32):
            part = batch.slice(begin, 32)
            one, first, sizes = word_hashes(part.column(2).cast(pa.binary()).to_pylist())
            tokens, short = mixed(one), (one >> np.uint64(48)).astype(np.uint16)
            keys = tokens.view(np.int64) & ~np.int64(3)
            for text_id, of, windows, start in zip(
                part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(3).to_pylist(), first.tolist(), strict=True
            ):
                seen = set()
                for w in windows:
                    l, r = start + (w["at"] >> 32), start + (w["at"] & low)
                    same = np.flatnonzero(keys[l : r + 1] == (w["key"] & ~3))
                    if same.size > 1:
                        values = hashed(tokens[l : r + 1], w["key"] & 3)
                        same = same[values[same] == values.min()]
                        same = same[[np.abs(same - (r + 1 - l) // 2).argmin()]]
                    c = l + int(same[0])
                    n_l, n_r = max(l, c - 2 * SPAN + 2), min(r, c + 2 * SPAN - 2)
                    stretch = short[n_l : n_r + SHINGLE].tobytes()
                    if (w["key"], stretch) not in seen:
                        seen.add((w["key"], stretch))
                        near = (n_l - start) << 32 | (n_r - start)
                        rows.append((w["key"], text_id, of, w["size"], w["at"], near, stretch))
            if len(rows) >= HELD:
                yield given(rows)
                rows = []
    if rows:
        yield given(rows)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """32 bits of each shingle in the place of 16 bits of each word of the last column."""
    for batch in batches:
        pieces = batch.columns[-1].to_pylist()
        sizes = np.array([len(x) // 2 for x in pieces], np.int64)
        tokens = mixed(np.frombuffer(b"".join(pieces), np.uint16).astype(np.uint64)) >> np.uint64(32)
        tokens, starts = tokens.astype(np.uint32), np.cumsum(sizes) - sizes
        ends = starts + np.maximum(0, sizes - SHINGLE + 1)
        made = [tokens[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.binary())], names=batch.schema.names)


LINK = "text_id long, at long, near long, o_text_id long, o_at long, o_near long"


def _common(group: np.ndarray, of: np.ndarray, part: np.ndarray, tokens: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rows that may hold a passage that rows of the same group and another class hold, and their hits.

    A hit is a shingle that another class of the group has too, and where the group has two
    parts, another part. Rows without ``NEED`` hits in some ``SPAN`` shingles are left out, and
    the hits looked for again among the others. Shingles are looked up by places of a table;
    two at one place may add hits, which another table takes back, and none goes missing.
    """
    _, of = np.unique(of, return_inverse=True)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, group.size])
    single = np.repeat(np.minimum.reduceat(part, starts) == np.maximum.reduceat(part, starts), sizes)
    number = np.repeat(np.arange(starts.size, dtype=np.uint64) * _ODD >> np.uint64(32), sizes)
    flat = np.concatenate(tokens).astype(np.uint64)
    owner = np.repeat(np.arange(len(tokens)), [x.size for x in tokens])
    live, hit, left, turn = np.arange(len(tokens)), np.ones(flat.size, bool), len(tokens) + 1, 0

    def several(place: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
        """Whether there are several values at the place of each."""
        last, more = np.empty(size, value.dtype), np.zeros(size, bool)
        last[place] = value
        more[place[last[place] != value]] = True
        return more[place]

    while live.size and (live.size < left or turn < HASHES):
        left = live.size
        of_hit, row = np.flatnonzero(hit), owner[hit]
        size = 1 << max(10, (4 * of_hit.size).bit_length())
        place = (flat[of_hit] ^ number[row]) * _TURNS[turn % HASHES] >> np.uint64(64 - size.bit_length() + 1)
        place, turn = place.astype(np.int64), turn + 1
        hit[of_hit] = several(place, of[row].astype(np.int32), size)
        if not single.all():
            hit[of_hit] &= single[row] | several(place, part[row].astype(np.int32), size)
        total = np.r_[0, np.cumsum(hit)]
        fine = total[SPAN:] - total[:-SPAN] >= NEED
        fine &= owner[SPAN - 1 :] == owner[: fine.size]
        live = np.unique(owner[: fine.size][fine])
        kept = np.zeros(len(tokens), bool)
        kept[live] = True
        kept = kept[owner]
        flat, owner, hit = flat[kept], owner[kept], hit[kept]
    ends = np.searchsorted(owner, live, side="right")
    hits = [hit[i:j] for i, j in zip(np.searchsorted(owner, live), ends, strict=True)]
    whole = [_longest(x, SHARES[0]) for x in hits]
    some = [i for i, (a, b) in enumerate(whole) if b - a >= SPAN]
    return live[some], [hits[i] for i in some]


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the windows of one key and two classes whose stretches hold an alike passage.

    What stretches have in common with no other class is found by one pass over their shingles, so
    that most are left out. The others are compared if their sketches share enough bits. A pair
    that an earlier link has put into one class is passed over, so a task makes fewer links of a
    key than there are classes.
    """
    names = [x.split()[0] for x in LINK.split(", ")]

    def links(numbers: np.ndarray, tokens: list[np.ndarray], hits: list[np.ndarray]) -> Iterator[tuple]:
        """Of the rows of one ``dealt`` key; those of two blocks are paired across."""
        _, _, text_id, of, at, near, part = numbers
        two_parts = part.min() != part.max()
        made = [_sketch(x[hit]) for x, hit in zip(tokens, hits, strict=True)]
        sketches = np.frombuffer(b"".join(x for x, _ in made), np.uint64).reshape(-1, SKETCH)
        least = np.array([x for _, x in made])
        _, of = np.unique(of, return_inverse=True)
        root = np.arange(int(of.max()) + 1)
        step = max(1, (1 << 21) // sketches.size)
        for first in range(0, len(tokens), step):
            one = slice(first, first + step)
            hit = of[one][:, None] < of
            hit &= root[of[one]][:, None] != root[of]
            if two_parts:
                hit &= part[one][:, None] != part
            shared = np.bitwise_count(sketches[one][:, None, :] & sketches).sum(axis=2, dtype=np.int32)
            hit &= shared >= np.maximum(least[one][:, None], least)
            for a, b in np.argwhere(hit).tolist():
                a += first
                if text_id[a] < text_id[b]:  # the larger id first, as in ``regions``
                    a, b = b, a
                if root[of[a]] != root[of[b]] and compare(tokens[a], tokens[b]):
                    root[root == root[of[b]]] = root[of[a]]
                    yield text_id[a], at[a], near[a], text_id[b], at[b], near[b]

    def out(numbers: np.ndarray, stretches: list[bytes]) -> Iterator[pa.RecordBatch]:
        tokens = [np.frombuffer(x, np.uint32) for x in stretches]
        live, hits = _common(numbers[0], numbers[3], numbers[6], tokens)
        if not live.size:
            return
        numbers = numbers[:, live]
        starts = np.flatnonzero(np.r_[True, numbers[0, 1:] != numbers[0, :-1]])
        found = []
        for start, end in zip(starts, np.r_[starts[1:], live.size], strict=True):
            if end - start > 1:
                found += links(numbers[:, start:end], [tokens[i] for i in live[start:end]], hits[start:end])
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.array(found, np.int64).T], names=names)

    numbers, stretches, length = np.empty((7, 0), np.int64), [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers = np.concatenate([numbers, np.stack([batch.column(i).to_numpy() for i in range(7)])], axis=1)
        more = batch.column(7).to_pylist()
        stretches += more
        length += sum(map(len, more)) // 4
        end = int(np.searchsorted(numbers[0], numbers[0, -1]))  # the last key may go on
        if end and length >= LOOKED:
            yield from out(numbers[:, :end], stretches[:end])
            numbers, stretches = numbers[:, end:], stretches[end:]
            length = sum(map(len, stretches)) // 4
    if numbers.shape[1]:
        yield from out(numbers, stretches)


def apart(met: DataFrame, found: DataFrame, texts: DataFrame, owners: DataFrame) -> DataFrame:
    """Links of windows of large keys in texts of different classes, as ``LINK``.

    ``met`` are the ``meetings`` of ``texts``, of which the verified pairs ``found`` make classes.
    ``owners`` names the document (``least``) that gives each text.
    Of a key that stands in one class only no link is lost. In the others each window is
    compared with all windows of other classes: a passage that is alike has a stretch of ``SPAN``
    to ``2 * SPAN`` - 1 shingles that is, of which at least ``SIMILARITY * SPAN`` stand in the
    other one. What passes is compared where it is. Windows of a key are dealt to pairs of blocks.
    """
    roots = materialize(connected(found.select(F.col("text_id").alias("a"), F.col("o_text_id").alias("b"))), "roots")
    roots = roots.select(F.col("node").alias("text_id"), F.col("root").alias("class"))
    large = met.filter(F.col("o_text_id").isNull()).select(*COLUMNS)
    large = large.join(roots, "text_id", "left").withColumn("class", F.coalesce("class", "text_id"))
    large = materialize(large, "large")
    keys = large.groupBy("key").agg(
        F.count("*").alias("size"), F.min("class").alias("low"), F.max("class").alias("high")
    )
    large = large.join(keys.filter("low < high").select("key", "size"), "key")
    listed = large.groupBy("text_id", "class").agg(F.collect_list(F.struct("key", "at", "size")).alias("windows"))
    listed = materialize(listed.join(owners.withColumnRenamed("least", "doc"), "text_id"), "mixed")
    # The document that gives a text may have several rows; those of one class are not compared.
    whole = texts.join(listed, ["doc", "text_id"]).select("text_id", "class", "text", "windows")
    rows = whole.mapInArrow(
        _stretches, "key long, text_id long, class long, size long, at long, near long, stretch binary"
    )
    parts = F.ceil(F.col("size") / BLOCK)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("text_id"), parts))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    dealt = F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("dealt")
    rows = rows.select(dealt, "key", "text_id", "class", "at", "near", "part", "stretch")
    return rows.repartition("dealt").sortWithinPartitions("dealt").mapInArrow(
        lambda batches: _across(_tokens(batches)), LINK
    )


# ---- verification ----


#: Shares of shingles that must stand in the other text: from what two passages that
#: are just alike have, to unchanged ones.
SHARES = (2 * SIMILARITY / (1 + SIMILARITY), 0.93, 0.97, 1.0)


def _longest(hit: np.ndarray, share: float) -> tuple[int, int]:
    """The longest stretch in which at least ``share`` of ``hit`` are true."""
    if hit.all():
        return 0, hit.size
    total = np.zeros(hit.size + 1)
    np.cumsum(hit - share, out=total[1:])
    lowest = np.minimum.accumulate(total)
    highest = np.maximum.accumulate(total[::-1])[::-1]
    # For each end the first start from which some end at or after it is reached.
    start = np.searchsorted(-lowest, -highest - 1e-9)
    length = np.arange(total.size) - start
    end = int(length.argmax())
    low = int(start[end])
    if length[end] <= 0:
        return 0, 0
    while total[end] < total[low] - 1e-9:
        end -= 1
    return low, end


def _among(one: np.ndarray, two: np.ndarray, size: int) -> np.ndarray:
    """Which numbers below ``size`` of ``one`` stand in ``two``."""
    there = np.zeros(size, bool)
    there[two] = True
    return there[one]


def _alike(one: np.ndarray, two: np.ndarray, longest: tuple[int, int], share: float, size: int):
    low, high = longest
    o_low, o_high = _longest(_among(two, one[low:high], size), share)
    if o_high - o_low < SPAN:
        return None
    # The stretch of ``two`` may hold only a part of what stands together in ``one``.
    part, end = _longest(_among(one[low:high], two[o_low:o_high], size), share)
    low, high = low + part, low + end
    if high - low < SPAN:
        return None
    there = np.zeros((2, size), bool)
    there[0, one[low:high]] = True
    there[1, two[o_low:o_high]] = True
    both, either = np.count_nonzero(there[0] & there[1]), np.count_nonzero(there[0] | there[1])
    similarity = both / either
    return (low, high, o_low, o_high, similarity) if similarity >= SIMILARITY else None


def compare(one: np.ndarray, two: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """The passages of two rows of shingles that are alike: starts and ends (excluded), similarity.

    The longest passage of ``one`` most of whose shingles stand in ``two``, with the
    stretch of ``two`` that holds most of these; then the same before and after it.
    """
    both = np.concatenate([one, two])
    numbers = np.searchsorted(np.sort(both), both)  # equal shingles have equal numbers
    one, two, size = numbers[: one.size], numbers[one.size :], both.size
    hit, out = _among(one, two, size), []
    todo = [(0, one.size)]
    while todo:
        low, high = todo.pop()
        if np.count_nonzero(hit[low:high]) < SIMILARITY * SPAN:
            continue
        for share in SHARES:
            longest = _longest(hit[low:high], share)
            if longest[1] - longest[0] < SPAN:  # nor is a larger share's
                break
            found = _alike(one[low:high], two, longest, share, size)
            if found:
                a, b = low + found[0], low + found[1]
                out.append((a, b, *found[2:]))
                todo += [(low, a), (b, high)]
                break
    return sorted(out)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words ``low`` to ``high`` (excluded) of each text, in the place of the text."""
    kept = [*PAIRED, "side", "regions"]
    for batch in batches:
        pieces = []
        for text, low, high in zip(
            batch.column("text").cast(pa.binary()),
            batch.column("low").to_pylist(),
            batch.column("high").to_pylist(),
            strict=True,
        ):
            pieces.append(b" ".join(text.as_py().split(None, high)[low:high]))
        arrays = [batch.column(c) for c in kept]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array(pieces, pa.binary())], names=[*kept, "piece"]
        )


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*PAIRED, "start", "end", "o_start", "o_end", "similarity"]
    kinds = [pa.int64()] * 6 + [pa.float64()]
    for batch in batches:
        out = []
        for start in range(0, batch.num_rows, 64):
            ids, o_ids, regions, pieces, o_pieces = (c.to_pylist() for c in batch.slice(start, 64).columns)
            tokens, o_tokens = shingles(pieces), shingles(o_pieces)
            for text_id, o_text_id, places, one, two in zip(ids, o_ids, regions, tokens, o_tokens, strict=True):
                base, o_base = min(x["l"] for x in places), min(x["o_l"] for x in places)
                for x in places:
                    l, o_l = x["l"], x["o_l"]
                    for a, b, o_a, o_b, similarity in compare(
                        one[l - base : x["r"] + 1 - base], two[o_l - o_base : x["o_r"] + 1 - o_base]
                    ):
                        ends = [l + a, l + b + SHINGLE - 1, o_l + o_a, o_l + o_b + SHINGLE - 1]
                        out.append((text_id, o_text_id, *ends, similarity))
        arrays = [pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def verified(met: DataFrame, texts: DataFrame, owners: DataFrame) -> DataFrame:
    """The passages of the ``candidates`` ``met`` that are alike.

    ``owners`` names the document (``least``) that gives each text. ``texts`` are shuffled
    once, to the pairs that need them; after that only the stretches that meet move on.
    """
    sides = []
    for side, (text_id, low, high) in enumerate([("text_id", "l", "r"), ("o_text_id", "o_l", "o_r")]):
        sides.append(
            F.struct(
                F.lit(side).alias("side"),
                F.col(text_id).alias("wanted"),
                F.array_min(f"regions.{low}").alias("low"),
                (F.array_max(f"regions.{high}") + SHINGLE).alias("high"),
                F.when(F.lit(side == 0), F.col("regions")).alias("regions"),
            )
        )
    wanted = met.select(*PAIRED, F.explode(F.array(*sides)).alias("s")).select(*PAIRED, "s.*")
    wanted = wanted.join(
        owners.select(F.col("text_id").alias("wanted"), F.col("least").alias("doc")), "wanted"
    )
    wanted = materialize(wanted, "wanted")  # its size then decides how the texts are joined
    named = texts.select("doc", F.col("text_id").alias("wanted"), "text")
    joined = wanted.join(named, ["doc", "wanted"]).select(*PAIRED, "side", "regions", "low", "high", "text")
    pieces = joined.mapInArrow(
        _cut, f"text_id long, o_text_id long, side int, regions array<{REGION}>, piece binary"
    )
    both = pieces.groupBy(*PAIRED).agg(
        F.first("regions", True).alias("regions"),
        F.first(F.when(F.col("side") == 0, F.col("piece")), True).alias("piece"),
        F.first(F.when(F.col("side") == 1, F.col("piece")), True).alias("o_piece"),
    )
    return both.mapInArrow(
        _verify,
        "text_id long, o_text_id long, start long, end long, o_start long, o_end long, "
        "similarity double",
    )


def near_passages(docs: DataFrame) -> DataFrame:
    """Verified pairs of passages of at least ``WORDS`` words in two documents.

    ``doc_id`` has words ``first_word`` to ``last_word`` (from 0, both included) alike
    to those of ``of_doc_id`` from ``of_first_word`` to ``of_last_word``; ``similarity`` is
    the Jaccard similarity of their shingles; ``class_id`` is the smallest id that can be
    reached through such pairs. Texts are compared once: of equal texts the document
    with the smallest id stands for the others, and each other one has a row that
    links its whole text with that document's. Of texts that share a key with more than
    ``FEW`` others those are compared that no other pair has put into one class, so a passage
    in many texts does not make all pairs of them. Rows without an id or text
    take no part; rows that agree in id and text are one document; shorter texts have
    no passage. Texts are told apart by a 64-bit hash.
    """
    named = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("text_id"), "text"
    )
    blank = r"[\x20\x09-\x0D]+"
    size = F.size(F.split(F.btrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), blank))
    owners = materialize(named.select("doc", "text_id", size.cast("long").alias("n_words")), "owners")
    first = materialize(owners.groupBy("text_id").agg(F.min("doc").alias("least")), "first")
    met = materialize(meetings(named), "meetings")
    linked = materialize(regions(met.filter(F.col("o_text_id").isNotNull())), "met")
    found = materialize(verified(linked, named, first), "passages")
    if not met.filter(F.col("o_text_id").isNull()).isEmpty():
        links = materialize(apart(met, found, named, first), "links")

        def passages(links: DataFrame, at: str, o_at: str) -> DataFrame:
            pairs = links.select(F.lit(0).alias("key"), "text_id", F.col(at).alias("at"), "o_text_id", F.col(o_at).alias("o_at"))
            return materialize(verified(materialize(regions(pairs, 1), "met"), named, first), "passages")

        if not links.isEmpty():
            more = passages(links, "at", "o_at")
            found = found.unionByName(more)
            # Whole windows may hide what the stretches in them have shown.
            hidden = materialize(links.join(more, PAIRED, "left_anti"), "hidden")
            if not hidden.isEmpty():
                found = found.unionByName(passages(hidden, "near", "o_near"))

    def owner(text_id: str, name: str) -> DataFrame:
        return first.select(F.col("text_id").alias(text_id), F.col("least").alias(name))

    between = found.join(owner("text_id", "doc"), "text_id").join(
        owner("o_text_id", "o_doc"), "o_text_id"
    )
    between = between.select("doc", "start", "end", "o_doc", "o_start", "o_end", "similarity")
    copies = owners.filter(F.col("n_words") >= WORDS).join(first, "text_id")
    copies = copies.filter(F.col("doc") != F.col("least")).distinct()
    zero = F.lit(0).cast("long")
    copies = copies.select(
        "doc", zero.alias("start"), F.col("n_words").alias("end"), F.col("least").alias("o_doc"),
        zero.alias("o_start"), F.col("n_words").alias("o_end"), F.lit(1.0).alias("similarity"),
    )
    # One id can stand for several texts, which then may be alike themselves.
    links = materialize(between.unionByName(copies), "passage-links")
    roots = connected(links.select(F.col("doc").alias("a"), F.col("o_doc").alias("b")))
    rows = links.join(roots, F.col("doc") == F.col("node"), "left")
    return rows.select(
        F.col("doc").alias("doc_id"),
        F.col("start").alias("first_word"),
        (F.col("end") - 1).alias("last_word"),
        F.col("o_doc").alias("of_doc_id"),
        F.col("o_start").alias("of_first_word"),
        (F.col("o_end") - 1).alias("of_last_word"),
        "similarity",
        F.coalesce("root", "doc").alias("class_id"),
    )
