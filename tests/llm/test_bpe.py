from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from skyledger.llm import bpe
from tests.llm.helpers import ODD, documents

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def random_text(rng: random.Random) -> str:
    alphabet = "aeiourstnl  \n\t'éßñ1²½Ⅷ中\U0001f600!?.,\xa0 \x1c‍"
    return "".join(rng.choices(alphabet, k=rng.randint(0, 200)))


def test_encodes_as_the_library_and_decodes_to_the_text(spark, encoding):
    rng = random.Random(9)
    rows = ODD + [(400 + i, random_text(rng)) for i in range(150)]
    rows += [(600, "it's we'll <|endoftext|> DON'T 'quoted' ''"), (601, "a\n\n\n b  \n"), (602, "ab" * 4000)]
    docs = documents(spark, rows)
    found = bpe.encode(docs, PATH, public_tokenizers.PATTERN, keep_text=True)
    found = found.withColumn("back", bpe.decoded(found["__ids"], PATH)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = r["text"] or ""
        ids = encoding.encode_ordinary(text)
        assert r["__ids"] == ids
        assert r["__ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert bytes(r["back"]) == text.encode()
    assert bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_folded_merges_of_words(spark, encoding):
    rng = random.Random(10)
    words = {w for _ in range(60) for w in regex.findall(public_tokenizers.PATTERN, random_text(rng))}
    words |= {"", " thstedly", "aaaaaaaaaaaaaaa", "中中中", " " * 20}
    rows = spark.createDataFrame([(w,) for w in [*words, "aa", "aa", None]], "word string")
    found = {r["word"]: r["ids"] for r in bpe.merge_words(rows, bpe.read_ranks(PATH)).collect()}
    assert set(found) == words | {"aa", None}
    merge = bpe.Merger(bpe.read_ranks(PATH))
    for word, ids in found.items():
        if word and not word.isspace():
            assert ids == merge(word.encode()) == encoding.encode_ordinary(word)
    assert found[None] == found[""] == []


def test_long_and_short_merges_agree():
    merge, rng = bpe.Merger(bpe.read_ranks(PATH)), random.Random(11)
    for _ in range(300):
        word = "".join(rng.choices("aetinosl", k=rng.randint(2, 60))).encode()
        if word not in merge.ranks:
            assert merge._long(word) == merge(word)


def test_words_that_are_left_out_of_the_table_change_nothing(spark, monkeypatch, encoding):
    monkeypatch.setattr(bpe, "STORE", 3)
    rows = [(i, " ".join(f"word{j}thsted" for j in range(i % 7))) for i in range(60)]
    docs = documents(spark, rows).select("doc_id", "text")
    words = bpe.frequent_words(docs.select("text"), public_tokenizers.PATTERN, most=3)
    assert words.count() <= 3
    found = bpe.encode(docs, PATH, public_tokenizers.PATTERN, keep_text=True).collect()
    assert all(r["__ids"] == encoding.encode_ordinary(r["text"]) for r in found)
