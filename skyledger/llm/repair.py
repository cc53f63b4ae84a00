"""Structure repair of conversations by the cheapest edits, with Four-Russians block tables.

A sound conversation is empty, or an optional system turn and then user and assistant in
turn. Rows are taken by ``turn`` (NULL first; ties by role, then text). A row without
anything but blanks is blank, one whose role and text came earlier is a duplicate, and one
that does not end in ``.``, ``!`` or ``?`` is truncated. Edits and their costs: keep 0, give
another role 3, delete 4, insert an empty turn 3; a truncated row that stays costs 3 more;
blank rows and duplicates must be deleted. Of the cheapest scripts the one whose initials
(D, I, K, R) come first in ASCII is taken.

*What is left to pay* from a row on depends on the state of the conversation only: start,
after a system turn, after a user, after an assistant. Four costs, less their minimum, take
few values altogether, because any state reaches any sound end by few edits. So a table
holds, for every such vector and every block of ``BLOCK`` rows, the vector before the block.
Blocks are passed by lookup, from the last to the first. To read the edits a block is
expanded backward from the vector at its end, row by row, and then the first cheapest edit
is taken forward: ties are broken by what is to come and not by what was found first.

At scale: rows that are equal become one row with a count before they are sorted; the order
is that of range partitions, so a conversation with a third of all rows spreads over many
tasks; each run of at most 4,096 rows becomes a map from vectors to vectors in its own task,
and only these maps are folded along a conversation. The last pass streams a conversation
through one task with a state of fixed size, since its digest is sequential by nature.

NULL role or text count as one space. NULL ``conv_id`` is a conversation of its own. A role
with another initial than ``s``, ``u`` or ``a`` cannot be kept. Columns other than the four
named are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from skyledger.llm.common import materialize

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant turn that is legal in a state; it is the only one.
ADDED = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The state after a kept role, by state and role class (system, user, assistant, other).
KEPT = (
    (SYSTEM, USER, None, None),
    (None, USER, None, None),
    (None, None, ASSISTANT, None),
    (None, USER, None, None),
)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: Codes of rows: twice the role class, one more if truncated; then those that must go.
BLANK, DUPLICATE = 8, 9
#: Rows in a block of the table, and in a chunk that one task folds (as a power of two).
BLOCK = 4
CHUNK_BITS = 12

BLANKS = " \t\n\x0b\x0c\r"

ROW = "struct<place:bigint,code:int,n:bigint,turn:bigint,initial:string>"
REPORT = (
    "conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long,"
    " cost long, audit string, repaired_sha256 string"
)
TURNS = "conv_id {kind}, seq long, role string, text string, edit string"

Vector = tuple[int, int, int, int]


def with_insertions(costs: list[int]) -> list[int]:
    """Costs from each state if turns may be inserted first."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[ADDED[q]]) for q, c in enumerate(costs)]
    return costs


#: At the end of a conversation: nothing to pay after no turn or an assistant's.
END: Vector = tuple(with_insertions([0, 99, 99, 0]))


def options(code: int, after: Vector, state: int) -> list[tuple[int, str, int]]:
    """Cost, initial and next state of the edits of a row, with what is left after it."""
    kind, truncated = divmod(code, 2)
    more = TRUNCATED * truncated
    found = [(DELETE + after[state], "D", state)]
    kept = KEPT[state][kind]
    if kept is not None:
        found.append((more + after[kept], "K", kept))
    found.append((REROLE + more + after[ADDED[state]], "R", ADDED[state]))
    return found


def before(code: int, after: Vector) -> list[int]:
    """What is left to pay before a row of ``code``, given what is left after it."""
    return with_insertions([min(options(code, after, q))[0] for q in range(4)])


class Tables:
    """All vectors that occur, and the vector before every block of rows."""

    def __init__(self) -> None:
        self.vectors: list[Vector] = [END]
        number = {END: 0}
        steps: list[list[int]] = []
        while len(steps) < len(self.vectors):
            row = []
            for code in range(BLANK):
                found = before(code, self.vectors[len(steps)])
                least = min(found)
                vector = tuple(c - least for c in found)
                if vector not in number:
                    number[vector] = len(self.vectors)
                    self.vectors.append(vector)
                row.append(number[vector])
            steps.append([*row, len(steps)])  # rows that must go change nothing
        self.steps = steps
        one = np.array(steps, np.int16)
        self.base = one.shape[1]
        blocks = np.arange(self.base**BLOCK)
        table = np.repeat(np.arange(len(steps), dtype=np.int16)[:, None], blocks.size, axis=1)
        for _ in range(BLOCK):  # the last row of a block is its lowest digit
            table = one[table, blocks % self.base]
            blocks = blocks // self.base
        self.table = table
        self.choices: dict[tuple[int, int, int], tuple[str, tuple[str, ...], str | None, int]] = {}

    def blocks(self, codes: list[int]) -> np.ndarray:
        """The numbers of the blocks of ``codes``, the last one filled up with what changes nothing."""
        digits = np.full(-(-len(codes) // BLOCK) * BLOCK, BLANK)
        digits[: len(codes)] = np.minimum(codes, BLANK)
        return digits.reshape(-1, BLOCK) @ self.base ** np.arange(BLOCK - 1, -1, -1)

    def fold(self, codes: list[int]) -> np.ndarray:
        """The vector before ``codes`` for every vector after them."""
        found = np.arange(len(self.vectors))
        for block in self.blocks(codes)[::-1]:
            found = self.table[found, block]
        return found

    def choose(self, after: int, code: int, state: int) -> tuple[str, tuple[str, ...], str | None, int]:
        """The first cheapest edits of a row: initials, roles inserted before it, its new role,
        next state."""
        key = (after, code, state)
        if key not in self.choices:
            vector = self.vectors[after]
            left = before(code, vector)
            initials, roles = "", []
            while True:
                ways = {e: (cost, q) for cost, e, q in options(code, vector, state)}
                ways["I"] = (INSERT + left[ADDED[state]], ADDED[state])
                edit = min(e for e, (cost, _) in ways.items() if cost == left[state])
                initials += edit
                state = ways[edit][1]
                if edit != "I":
                    break
                roles.append(NAMES[state])
            self.choices[key] = (initials, tuple(roles), NAMES[state] if edit == "R" else None, state)
        return self.choices[key]

    def trace(self, codes: list[int], after: int, state: int) -> tuple[list, int]:
        """The choice for every row (None: it must go), and the state after them."""
        numbers = self.blocks(codes)
        ends = [after]  # the vector after each block, from the last to the first
        for block in numbers[:0:-1]:
            ends.append(int(self.table[ends[-1], block]))
        found = []
        for at, vector in zip(range(0, len(codes), BLOCK), reversed(ends), strict=True):
            block = codes[at : at + BLOCK]
            inside = [vector]
            for code in block[:0:-1]:
                inside.append(self.steps[inside[-1]][min(code, BLANK)])
            for code, left in zip(block, reversed(inside), strict=True):
                if code >= BLANK:
                    found.append(None)
                    continue
                found.append(self.choose(left, code, state))
                state = found[-1][3]
        return found, state


def ending(state: int) -> list[str]:
    """Roles to be inserted at the end of a conversation in ``state``."""
    roles = []
    while state in (SYSTEM, USER):
        state = ADDED[state]
        roles.append(NAMES[state])
    return roles


# ---- rows in order, as codes ----


def ordered(rows: DataFrame) -> DataFrame:
    """Different rows with their number ``n`` and a ``place`` that grows along every conversation."""
    keys = ["conv_id", "turn", "role", "text"]
    whole = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in keys[2:]],
    )
    equal = whole.groupBy(*keys).agg(F.count("*").alias("n"))
    in_order = equal.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = in_order.select(*keys, "n", F.monotonically_increasing_id().alias("place"))
    return materialize(placed, "turns")


def is_blank(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS)) == ""


def chunks(placed: DataFrame) -> DataFrame:
    """Runs of at most 4,096 neighbours of a conversation, as codes in order."""
    whole = placed.filter(~is_blank(F.col("text")))
    firsts = whole.groupBy("conv_id", "role", F.md5(F.col("text").cast("binary"))).agg(
        F.min("place").alias("place")
    )
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    kind = F.coalesce(F.array_position(F.array(*map(F.lit, "sua")), F.col("initial")), F.lit(0))
    kind = F.when(kind == 0, 3).otherwise(kind - 1)
    code = F.when(F.col("end") == "", BLANK).otherwise(
        2 * kind + (~F.col("end").isin(".", "!", "?")).cast("int")
    )
    marked = placed.select(
        "conv_id", "place", "n", "turn", F.substring("role", 1, 1).alias("initial"), end.alias("end")
    )
    marked = marked.withColumn("code", code.cast("int"))
    known = marked.join(firsts.select("place", F.lit(True).alias("first")), "place", "left")
    new = (F.col("code") == BLANK) | F.col("first").isNotNull()
    row = F.struct("place", F.when(new, F.col("code")).otherwise(DUPLICATE).alias("code"), "n", "turn", "initial")
    return known.groupBy("conv_id", F.shiftright("place", CHUNK_BITS).alias("chunk")).agg(
        F.array_sort(F.collect_list(row)).alias("rows"), F.min("place").alias("first")
    )


def fold_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = Tables()
    for batch in batches:
        rows = batch.column("rows")
        codes = pc.struct_field(rows.flatten(), "code").to_numpy(zero_copy_only=False)
        at = rows.offsets.to_numpy() - rows.offsets[0].as_py()
        maps = [tables.fold(codes[a:b]).tolist() for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(maps, pa.list_(pa.int16()))], names=[*batch.schema.names, "map"]
        )


def scan_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vector after every chunk; chunks of a conversation come last first."""
    conversation, vector = object(), 0
    for batch in batches:
        after = []
        ids = batch.column("conv_id").to_pylist()
        for conv, step in zip(ids, batch.column("map").to_pylist(), strict=True):
            if conv != conversation:
                conversation, vector = conv, 0
            after.append(vector)
            vector = step[vector]
        yield pa.RecordBatch.from_arrays(
            [batch.column("first"), pa.array(after, pa.int16())], names=["first", "after"]
        )


def planned(rows: DataFrame, every: DataFrame) -> DataFrame:
    """Conversations, their chunks and their texts, each conversation in one stream in order.

    ``every`` has the ``conv_id`` of all conversations, those without rows included.
    """
    placed = ordered(rows)
    kind = placed.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, chunk long, rows array<{ROW}>, first long, map array<smallint>"
    folded = materialize(chunks(placed).mapInArrow(fold_chunks, schema), "chunks")
    behind = (
        folded.select("conv_id", "first", "map")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.desc("first"))
        .mapInArrow(scan_back, "first long, after smallint")
    )
    no_text = [F.lit(None).cast("string").alias(c) for c in ("role", "text")]
    no_rows = [F.lit(None).cast(f"array<{ROW}>").alias("rows"), F.lit(None).cast("smallint").alias("after")]
    heads = folded.join(behind, "first").select(
        "conv_id", F.col("first").alias("place"), F.lit(1).alias("part"), *no_text, "rows", "after"
    )
    texts = placed.filter(~is_blank(F.col("text"))).select(
        "conv_id", "place", F.lit(2).alias("part"), "role", "text", *no_rows
    )
    names = every.select("conv_id").distinct().select(
        "conv_id", F.lit(-1).cast("long").alias("place"), F.lit(0).alias("part"), *no_text, *no_rows
    )
    stream = names.unionByName(heads).unionByName(texts)
    return stream.repartition("conv_id").sortWithinPartitions("conv_id", "place", "part")


# ---- the pass along each conversation ----


class Conversation:
    """What is known of a conversation up to some row."""

    LEGAL = {"su", "ua", "au"}

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.state = START
        self.audit: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.low = self.turn = self.initial = None
        self.turns = 0
        self.due: dict[int, tuple] = {}
        self.hash = hashlib.sha256()
        self.n_turns = 0

    def chunk(self, tables: Tables, rows: list[dict], after: int) -> None:
        choices, self.state = tables.trace([r["code"] for r in rows], after, self.state)
        self.due = {}
        for row, choice in zip(rows, choices, strict=True):
            code, n, turn, initial = row["code"], row["n"], row["turn"], row["initial"]
            if self.initial is not None and self.initial + initial not in self.LEGAL:
                self.illegal += 1
            self.illegal += n - 1
            self.initial = initial
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.turn = turn
                self.turns += 1
            if code == BLANK:
                self.blank += n
            else:
                self.duplicate += n - (code < BLANK)
                self.truncated += code < BLANK and code % 2
            gone = n
            if choice is not None:
                gone = n - 1
                initials, roles, role, _ = choice
                self.audit.append(initials)
                self.cost += INSERT * len(roles)
                if initials[-1] == "D":
                    self.cost += DELETE
                else:
                    self.cost += TRUNCATED * (code % 2) + REROLE * (role is not None)
                    self.due[row["place"]] = (roles, role, initials[-1])
            self.audit.append("D" * gone)
            self.cost += DELETE * gone

    def lines(self, place: int, role: str, text: str) -> list[tuple]:
        """The repaired turns that a row gives: inserted ones and itself."""
        if place not in self.due:
            return []
        roles, new, edit = self.due.pop(place)
        return [*((r, "", "I") for r in roles), (new or role, text, edit)]

    def end(self) -> list[tuple]:
        roles = ending(self.state)
        self.audit.append("I" * len(roles))
        self.cost += INSERT * len(roles)
        return [(r, "", "I") for r in roles]

    def add(self, turns: list[tuple]) -> None:
        for role, text, _ in turns:
            self.hash.update(b"\n" if self.n_turns else b"")
            self.hash.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.n_turns += 1

    def report(self) -> tuple:
        gaps = 0 if self.turn is None else self.turn - self.low + 1 - self.turns
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return (self.conv_id, *counts, "".join(self.audit), self.hash.hexdigest())


#: Bytes of text after which a batch of repaired turns is sent on.
BATCH_BYTES = 8 << 20


def _walk(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[list[tuple]]:
    """Repaired turns if ``whole``, otherwise a report of each conversation, in lists."""
    tables = Tables()
    now: Conversation | None = None
    made: list[tuple] = []
    size = 0

    def take(turns: list[tuple]) -> None:
        nonlocal size
        if whole:
            made.extend((now.conv_id, now.n_turns + i, *turn) for i, turn in enumerate(turns))
            now.n_turns += len(turns)
            size += sum(len(text) for _, text, _ in turns)
        else:
            now.add(turns)

    def close() -> None:
        if now is not None:
            take(now.end())
            if not whole:
                made.append(now.report())

    for batch in batches:
        columns = [batch.column(c) for c in ("conv_id", "place", "part", "role", "text", "rows", "after")]
        for row in zip(*columns, strict=True):
            conv, place, part, role, text, rows, after = row
            if part.as_py() == 0:
                close()
                now = Conversation(conv.as_py())
            elif part.as_py() == 1:
                now.chunk(tables, rows.as_py(), after.as_py())
            else:
                take(now.lines(place.as_py(), role.as_py(), text.as_py()))
            if size > BATCH_BYTES:
                yield made
                made, size = [], 0
        yield made
        made, size = [], 0
    close()
    yield made


def _run(rows: DataFrame, every: DataFrame, fields: str, whole: bool) -> DataFrame:
    plan = planned(rows, every)
    schema = fields.format(kind=plan.schema["conv_id"].dataType.simpleString())
    kinds = to_arrow_schema(T._parse_datatype_string(schema))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in _walk(batches, whole):
            columns = list(zip(*made, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds
            )

    return plan.mapInArrow(walk, schema)


def report(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """Of every conversation: faults, the cost and initials of its edits, and a digest of the result.

    ``repaired_sha256`` is of the lines ``role:text`` of the repaired turns, joined by newlines.
    Conversations of ``every`` that have no rows are reported with zeros.
    """
    return _run(rows, rows if every is None else every, REPORT, whole=False)


def repaired(rows: DataFrame) -> DataFrame:
    """The turns of every repaired conversation, numbered by ``seq``, with their edit (K, R or I)."""
    return _run(rows, rows, TURNS, whole=True)
