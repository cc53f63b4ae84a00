from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import cache

import pytest
from pyspark.sql import functions as F

from skyledger.llm import repair
from skyledger.llm.queries import QUERIES, damaged

SOUND = re.compile(r"(s?(ua)+)?")
FILLED = re.compile(r"[^\x20\x09-\x0d]")


def brute(rows: list[tuple]) -> dict:
    """Counts and cheapest edits of one conversation's (turn, role, text), by trying all scripts."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        filled = FILLED.findall(text)
        if not filled:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if filled[-1] not in ".!?" else "")
        seen.add((role, text))

    def legal(roles: str) -> bool:
        """Whether some end makes ``roles`` sound."""
        return any(SOUND.fullmatch(roles + end) for end in ("", "a", "ua"))

    def short(roles: str) -> str:
        """A beginning that allows the same ends."""
        return roles if len(roles) < 4 else roles[-2:] if roles[-1] == "a" else "u"

    @cache
    def best(i: int, roles: str, added: int) -> tuple[int, str, tuple]:
        roles = short(roles)
        found = []
        if i == len(rows) and SOUND.fullmatch(roles):
            found.append((0, "", ()))
        if added < 3:
            for role in ("user", "assistant"):
                if legal(roles + role[0]):
                    cost, audit, turns = best(i, roles + role[0], added + 1)
                    found.append((cost + 3, "I" + audit, ((role, ""), *turns)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, turns = best(i + 1, roles, 0)
            found.append((cost + 4, "D" + audit, turns))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                for name, price, initial in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    if name[:1] and legal(roles + name[:1]):
                        cost, audit, turns = best(i + 1, roles + name[:1], 0)
                        found.append((cost + price + more, initial + audit, ((name, text), *turns)))
        return min(found, default=(10**9, "", ()), key=lambda f: f[:2])

    cost, audit, turns = best(0, "", 0)
    initials = [role[:1] for _, role, _ in rows]
    known = {t for t, _, _ in rows if t is not None}
    return {
        "gaps": max(known) - min(known) + 1 - len(known) if known else 0,
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{x}" for r, x in turns).encode()).hexdigest(),
        "turns": turns,
    }


def table(spark, rows):
    made = [(*r, n, "z") for n, r in enumerate(rows)]
    kinds = "conv_id long, turn long, role string, text string, place int, n string"
    return spark.createDataFrame(made, kinds).repartition(3)


def check(spark, rows):
    grouped = defaultdict(list)
    for conv, *row in rows:
        grouped[conv].append(tuple(row))
    wanted = {conv: brute(group) for conv, group in grouped.items()}
    found = repair.report(table(spark, rows)).collect()
    assert len(found) == len(wanted)
    for row in found:
        want = wanted[row["conv_id"]]
        assert row.asDict() == {"conv_id": row["conv_id"], **{k: v for k, v in want.items() if k != "turns"}}
    turns = defaultdict(list)
    for row in repair.repaired(table(spark, rows)).orderBy("conv_id", "seq").collect():
        assert row["seq"] == len(turns[row["conv_id"]])
        turns[row["conv_id"]].append((row["role"], row["text"]))
    assert {c: tuple(t) for c, t in turns.items()} == {c: w["turns"] for c, w in wanted.items() if w["turns"]}


sys.setrecursionlimit(20_000)

ROLES = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "user", "System"]
TEXTS = ["Yes.", "No!", "What?", "cut", "cut off,", "", " \n\t", None, "x" * 50 + " . ", "é "]


def test_random_conversations(spark):
    rng = random.Random(11)
    rows = []
    for conv in range(120):
        for i in range(rng.randint(1, 11)):
            turn = rng.choice([i, i, i, i, rng.randint(-2, 12), None])
            text = rng.choice(TEXTS) if rng.random() < 0.4 else f"Turn {i}" + rng.choice(".!?;")
            role = rng.choice(ROLES) if rng.random() < 0.5 else ROLES[i % 2]
            rows.append((conv or None, turn, role, text))
    check(spark, rows)


def test_small_chunks_and_one_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_BITS", 3)
    rng = random.Random(5)
    rows = [(7, i, rng.choice(ROLES), f"Turn {i}" + rng.choice(".,")) for i in range(300)]
    rows += [(7, None, "user", "the same")] * 50 + [(c, 0, "user", "Yes.") for c in range(20, 60)]
    check(spark, rows)


def test_very_long_text_and_equal_rows(spark):
    rows = [(1, 0, "user", "word " * 400_000), (1, 1, "assistant", "  " * 200_000 + "." + " " * 200_000)]
    check(spark, rows + [(2, 3, "assistant", "Yes.")] * 400)


def test_empty_table_and_conversations_without_rows(spark):
    empty = table(spark, []).limit(0)
    assert repair.report(empty).count() == 0 and repair.repaired(empty).count() == 0
    (row,) = repair.report(empty, every=spark.range(1).select(F.col("id").alias("conv_id"))).collect()
    assert row["audit"] == "" and row["cost"] == 0
    assert row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_tables_hold_every_block():
    tables = repair.Tables()
    rng = random.Random(2)
    assert len(tables.vectors) < 100
    for _ in range(50):
        codes = [rng.randrange(8) for _ in range(rng.randint(0, 11))]
        vector = list(repair.END)
        for code in reversed(codes):
            vector = repair.before(code, vector)
        least = min(vector)
        assert tables.vectors[tables.fold(codes)[0]] == tuple(c - least for c in vector)


def test_damage(spark):
    rows = [(c, t, r, "A. b? c!") for c in (1, 2, None) for t in (*range(40), None) for r in ("user", None)]
    got = sorted((str(r[0]), str(r[1]), r[2], r[3]) for r in damaged(table(spark, rows)).drop("time").collect())
    wanted = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        role = "user" if fault == 4 else role or " "
        text = {1: "", 2: "A b c"}.get(fault, text)
        wanted += [(str(conv), str(turn), role, text)] * {0: 0, 3: 2}.get(fault, 1)
    assert got == sorted(wanted)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    grouped = {r[0]: [] for r in rows.select("conv_id").distinct().collect()}
    for conv, turn, role, text, _ in damaged(rows).collect():
        grouped[conv].append((turn, role, text))
    found = QUERIES["op11_conversations"](spark, sf_dir).collect()
    assert len(found) == len(grouped)
    for row in found:
        wanted = brute(grouped[row["conv_id"]])
        del wanted["turns"]
        assert row.asDict() == {"conv_id": row["conv_id"], **wanted}
