from __future__ import annotations

import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import warc


def pages(spark):
    rng = random.Random(7)
    large = "é" * 700
    rows = [(i, f"http://h/{i}", "".join(rng.choices("ab \r\n<é>", k=rng.randint(0, 3000)))) for i in range(40)]
    rows += [(100, None, None), (101, "http://x\r\ny", ""), (102, "u", "WARC/1.1\r\n\r\n\x1f"), (103, "u", None)]
    rows += [(i, "u", large) for i in range(200, 260)] + [(None, "u", large), (259, "u", large)]
    rows += [(i, "u", "é" * 499) for i in (300, 301)] + [(i, "u", "é" * 500) for i in (302, 303)]
    rows += [(None, "u", "z" * 2000), (None, "u", "z" * 2000)]
    made = [(*r, "WARC", 1) for r in rows]
    df = spark.createDataFrame(made, "page_id long, url string, html string, payload string, file int")
    return df.repartition(4), rows


def brute(rows: list[tuple]) -> list[tuple]:
    keeper: dict = {}
    for i, _, html in rows:
        if i is not None:
            keeper[html or ""] = max(i, keeper.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        k = keeper.get(html or "") if len(data) >= 1000 else None
        revisit = k is not None and i != k
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", k if revisit else None))
    return sorted(map(str, out))


def named(found):
    return found.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", warc.page_of(F.col("refers_to_id")).alias("refers_to"),
    )


@pytest.mark.parametrize("roll", [1 << 24, 500])
def test_round_trip(spark, monkeypatch, roll):
    monkeypatch.setattr(warc, "ROLL_BYTES", roll)
    df, rows = pages(spark)
    found = warc.round_trip(df)
    assert found.filter(F.col("gap").isNotNull()).count() == 0
    assert sorted(str(tuple(r)) for r in named(found).collect()) == brute(rows)
    assert warc.round_trip(df.limit(0)).count() == 0


def records(n: int) -> list[bytes]:
    rng = random.Random(n)
    out = []
    for i in range(n):
        payload = bytes(rng.choices(b"abc<>\r\n", k=rng.randint(0, 400)))
        out.append(warc.record(i, "u", payload, hashlib.sha1(payload).hexdigest(), None))
    return out


def read(data: bytes, chunk: int):
    class Small(io.BytesIO):
        def read(self, size=-1):
            return super().read(min(size, chunk))

    return list(warc.salvage(Small(data)))


def ids(found) -> list[int]:
    return [int(f[2]["warc-record-id"][10:-1]) for f in found if f[4] is None]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("chunk", [50, 1 << 20])
def test_damage_costs_only_what_it_hits(packed, chunk, monkeypatch):
    monkeypatch.setattr(warc.Source, "CHUNK", chunk)
    parts = [warc.member(r) if packed else r for r in records(30)]
    starts = [sum(map(len, parts[:i])) for i in range(31)]
    whole = b"".join(parts)
    assert ids(read(whole, chunk)) == list(range(30))
    rng = random.Random(8)
    for _ in range(25):
        hit = sorted(rng.sample(range(30), 3))
        data = bytearray(whole)
        for i in hit:
            # The last byte of the block or of the check sum: surely noticed.
            at = starts[i + 1] - (6 if packed else 5)
            data[at] ^= 0x55
        found = read(bytes(data), chunk)
        assert ids(found) == [i for i in range(30) if i not in hit]
        gaps = [(f[0], f[1]) for f in found if f[4] is not None]
        covered = {i for a, b in gaps for i in range(30) if a <= starts[i] and starts[i + 1] <= b}
        assert covered == set(hit)
        # Records and gaps cover the file without holes.
        assert [f[0] for f in found] == [0, *(f[1] for f in found[:-1])]
        assert found[-1][1] == len(data)


def test_garbage_truncation_and_mixed_forms():
    one, two, three = records(3)
    data = b"junk" + warc.member(one) + b"\x1f\x8b\x08 no member" + two + warc.member(three)[:-9]
    found = read(data, 1 << 20)
    assert ids(found) == [0, 1]
    assert [f[4] is not None for f in found] == [True, False, True, False, True]
    assert read(b"", 10) == []
    assert [f[:2] for f in read(b"nothing here", 10)] == [(0, 12)]
    cut = read(one[:-2] + two, 1 << 20)  # the end of a record is missing
    assert ids(cut) == [1]


def test_gaps_are_logged(spark, tmp_path):
    parts = [warc.member(r) for r in records(5)]
    (tmp_path / "a.warc.gz").write_bytes(parts[0] + b"?" * 77 + parts[1])
    files = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "file string")
    rows = warc.read_archives(files).orderBy("start").collect()
    assert [r["gap"] is not None for r in rows] == [False, True, False]
    assert rows[1]["end"] - rows[1]["start"] == 77 and rows[1]["payload"] is None
    assert hashlib.sha1(rows[0]["payload"]).hexdigest() == rows[0]["payload_digest"]
