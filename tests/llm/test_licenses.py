from __future__ import annotations

import math
import random
import textwrap

from skyledger.llm import licenses
from tests.llm.helpers import ODD, documents


def brute(text: str | None) -> tuple:
    words = licenses.words_of(text or "")
    places, base, best = [], set(), 0.0
    for phrase, label in licenses.PHRASES.items():
        part = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(part)] == part]
        places += here
        base |= {label} if here else set()
    labels = set(base)
    for label, template, own in licenses.TEMPLATES:
        wanted = set(licenses.words_of(template))
        length = math.ceil(1.25 * len(licenses.words_of(template)))
        for i in range(len(words)):
            have = wanted & set(words[i : i + length])
            if 10 * len(have) >= 8 * len(wanted) and set(own.split()) <= have:
                labels.add(label)
                best = max(best, len(have) / len(wanted))
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if places else best,
    )


def test_matches_every_window_against_every_template(spark):
    rng = random.Random(6)
    vocabulary = licenses.vocabulary()
    texts = []
    for _, template, _ in licenses.TEMPLATES:
        words = template.split()
        texts += [template, "head\n" + template.upper() + "\ntail", " ".join(words[: len(words) // 2])]
        for share in (0.7, 0.8, 0.9):
            kept = [w for w in words if rng.random() < share]
            texts.append("x " + " ".join(kept) + " y\nz " + " ".join(rng.choices(vocabulary, k=5)))
    texts += [" ".join(rng.choices(vocabulary, k=60)) for _ in range(30)]
    texts += ["cc by cc by\nCC-BY, mit; License", "gnu general public", "apache\nlicense", "KIT LICENSE mit license"]
    rows = ODD + [(300 + i, t) for i, t in enumerate(texts)]
    found = licenses.scan(documents(spark, rows)).collect()
    got = sorted((str(r["doc_id"]), str(tuple(r)[1:])) for r in found)
    assert got == sorted((str(i), str(brute(t))) for i, t in rows)
    assert licenses.scan(documents(spark, rows).limit(0)).count() == 0


NOTICES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
      software and associated documentation files (the "Software"), to deal in the Software without
      restriction, including without limitation the rights to use""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are
      permitted provided that the following conditions are met:""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or
      without fee is hereby granted, provided that the above copyright notice""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of
      the GNU General Public License as published by the Free Software Foundation, either version 3""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
      file except in compliance with the License. You may obtain a copy""",
}


def test_wrapped_notices_are_found_and_others_not_mistaken(spark):
    rows = []
    for k, (label, notice) in enumerate(NOTICES.items()):
        for j, (width, mark) in enumerate(((80, "# "), (40, " * "), (24, "// "))):
            lines = textwrap.wrap(" ".join(notice.split()), width)
            rows.append((100 * k + j, "code\n" + "\n".join(mark + line for line in lines) + "\ncode"))
    others = ["Released under the BSD License", "Licensed under CC BY 4.0", "Released under the license of the museum"]
    others.append("released " + "word " * 30 + "under the " + "word " * 30 + "MIT-like license")
    rows += [(1000 + i, t) for i, t in enumerate(others)]
    found = {r["doc_id"]: r for r in licenses.scan(documents(spark, rows)).collect()}
    for k, label in enumerate(NOTICES):
        assert all(label in found[100 * k + j]["labels"].split(",") for j in range(3)), label
    assert [found[1000 + i]["labels"] for i in range(4)] == ["", "cc-by", "", ""]
    assert found[1001]["base_labels"] == "cc-by"


def test_very_long_text(spark):
    text = "under the " * 150_000 + "\n" + NOTICES["bsd"] + "\n" + "mit of the " * 50_000
    (row,) = licenses.scan(documents(spark, [(1, text)])).collect()
    assert (row["n_words"], row["labels"]) == (len(licenses.words_of(text)), "bsd")


def test_native(spark):
    plan = licenses.scan(documents(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
