from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from skyledger.llm import simhash
from tests.llm.helpers import ODD, documents


def brute_print(text: str | None) -> int:
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0d]+", data)
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    shingles = shingles or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def brute_roots(values: list[int]) -> dict[int, int]:
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near(rng: random.Random, value: int, bits: int) -> int:
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


def test_fingerprints_and_components_match_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(40)]
    texts += [t.upper() for t in texts[:10]] + [t + " w1" for t in texts]
    rows = ODD + [(1000 + i, t) for i, t in enumerate(texts)]
    found = simhash.components(simhash.fingerprints(documents(spark, rows))).collect()
    assert len(found) == len(rows)
    prints = {}
    for i, t in rows:
        prints.setdefault(brute_print(t), []).append(i)
    roots = brute_roots(list(prints))
    least = {}
    for value, ids in prints.items():
        for i in ids:
            if i is not None:
                least[roots[value]] = min(i, least.get(roots[value], i))
    wanted = sorted(
        (str(i), signed(brute_print(t)), least.get(roots[brute_print(t)])) for i, t in rows
    )
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in found) == wanted


def test_multi_block_text(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000))
    blocks = simhash.blocks_of_words
    monkeypatch.setattr(simhash, "blocks_of_words", lambda data: blocks(data, 64))
    assert simhash.fingerprint(text.encode()) == signed(brute_print(text))


@pytest.mark.parametrize("entry", [4096, 4])
def test_links_keep_all_connections(spark, monkeypatch, entry):
    """Also where index entries are too large and are split again, twice."""
    monkeypatch.setattr(simhash, "ENTRY", entry)
    rng = random.Random(entry)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = set(base) | {near(rng, b, k) for b in base for k in (1, 2, 3, 4, 5)}
    hub = base[0]
    values |= {near(rng, hub, 3) for _ in range(150)}
    values |= {hub ^ (rng.getrandbits(32) << 32) for _ in range(60)}
    rows = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    found = simhash.connected(simhash.links(rows)).collect()
    roots = {r["node"]: r["root"] for r in found}
    values = sorted(signed(v) for v in values)
    wanted = brute_roots([v & (1 << 64) - 1 for v in values])
    groups, expected = {}, {}
    for v in values:
        groups.setdefault(roots.get(v, v), set()).add(v)
        expected.setdefault(wanted[v & (1 << 64) - 1], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_verify_is_blind_to_batch_ends(monkeypatch):
    monkeypatch.setattr(simhash, "ENTRY", 10)
    rng = random.Random(3)
    keys = sorted([1] * 5 + [2] * 40 + [3] + [4] * 9 + list(range(10, 60)))
    base = rng.getrandbits(60)
    fps = [near(rng, base, 1) for _ in keys]
    whole = pa.RecordBatch.from_arrays(
        [
            pa.array(keys, pa.int64()),
            pa.array([64] * len(keys), pa.int32()),
            pa.array([32] * len(keys), pa.int32()),
            pa.array(np.array(fps, np.uint64).view(np.int64)),
        ],
        names=["key", "bit", "off", "fp"],
    )

    def result(size):
        parts = [whole.slice(i, size) for i in range(0, len(keys), size)]
        rows = [r for b in simhash._verify(iter(parts)) for r in b.to_pylist()]
        large = sorted((r["key"], r["fp"]) for r in rows if r["to"] is None)
        links = sorted((r["fp"], r["to"]) for r in rows if r["to"] is not None)
        return large, links

    assert result(1000) == result(1) == result(7)
    assert {k for k, _ in result(3)[0]} == {2}


def test_keep_one(spark):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "x y z"), (9, "p q r")]
    kept = simhash.keep_one(documents(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "key", "fingerprint"]
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == [
        ("3", "a b c d"), ("9", "p q r"), ("None", "x y z"),
    ]
    assert simhash.keep_one(documents(spark, rows).limit(0)).count() == 0
