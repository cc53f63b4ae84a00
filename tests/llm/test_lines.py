from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from skyledger.llm import lines
from tests.llm.helpers import ODD, documents


def brute(rows: list[tuple]) -> dict[tuple, tuple[str | None, int]]:
    """The text that is left of each (id, text), and how many lines went."""
    docs = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, lines_key(r[1])))
    first, gone = {}, {}
    for d, (_, text) in enumerate(docs):
        filled = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        for i in range(len(filled) - 2):
            window = "\n".join(filled[i : i + 3])
            if window not in first:
                first[window] = (d, i)
            elif first[window] != (d, i):
                low = max(i, first[window][1] + 3) if first[window][0] == d else i
                gone.setdefault(d, set()).update(range(low, i + 3))
    out = {}
    for d, (i, text) in enumerate(docs):
        if d not in gone:
            out[i, text] = (text, 0)
            continue
        k, left = 0, []
        for line in text.split("\n"):
            full = bool(re.search(r"[^\x20\x09-\x0d]", line))
            if not (full and k in gone[d]):
                left.append(line)
            k += full
        out[i, text] = ("\n".join(left), len(gone[d]))
    return out


def lines_key(text):
    import hashlib

    return hashlib.md5((text or "").encode()).digest()


def test_matches_brute_force(spark):
    rng = random.Random(4)
    pool = [f"line {i}" for i in range(12)] + ["", " ", "\t", "tail\r"]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(0, 25))) for _ in range(60)]
    texts += texts[:5] + ["same\n" * 9, "a\nb\nc\na\nb\nc\nd"]
    rows = ODD + [(i, t) for i, t in enumerate(texts)]
    found = lines.remove_repeated(documents(spark, rows))
    assert found.columns[:5] == ["doc_id", "text", "lang", "key", "fingerprint"]
    wanted = brute(rows)
    got = sorted((str(r["doc_id"]), str(r["text"]), r["__n_removed"]) for r in found.collect())
    assert got == sorted((str(i), str(wanted[i, t][0]), wanted[i, t][1]) for i, t in rows)
    assert lines.remove_repeated(documents(spark, rows).limit(0)).count() == 0


def test_no_join_is_forced_and_texts_are_not_gathered(spark):
    rows = [(i, "a\nb\nc\nd" if i % 3 else f"{i}\nx\ny") for i in range(300)]
    found = lines.remove_repeated(documents(spark, rows))
    assert found.agg(F.sum("__n_removed")).first()[0] == (200 - 1) * 4
