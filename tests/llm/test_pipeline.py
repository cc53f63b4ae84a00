"""Each stage of the pipeline against brute force on its own input."""

from __future__ import annotations

import base64

import pytest
import tiktoken
import public_tokenizers

import corpus_pipeline
from skyledger.llm import decontam, langid
from skyledger.llm.common import materialize
from tests.llm.test_copies import brute_groups, brute_links
from tests.llm.test_lines import brute as brute_lines

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = docs.limit(1).selectExpr("5000000L doc_id", "cast(null as string) text", "lang", "source", "n_chars")
    docs = docs.unionByName(odd)
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF_DIR), "stage")
        tables.append(docs)
    return [(t.columns, [r.asDict() for r in t.collect()]) for t in tables]


def texts(stage) -> dict[int, str]:
    return {r["doc_id"]: r["text"] for r in stage[1]}


def test_columns(stages):
    assert all(columns == stages[0][0] for columns, _ in stages[:-1])
    assert stages[-1][0] == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def test_language_keeps_documents_with_letters(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert 5000000 not in after
    assert {i: before[i] for i in after} == after
    assert len(after) >= 0.99 * (len(before) - 1)
    assert all(langid.words_of(t) for t in after.values())


def test_line_dedup(stages):
    wanted = brute_lines(list(texts(stages[1]).items()))
    kept = {}
    for (i, old), (new, gone) in wanted.items():
        filled = sum(bool(x.strip(" \t\r\x0b\x0c")) for x in old.split("\n"))
        if gone == 0 or gone < filled:
            kept[i] = new
    assert texts(stages[2]) == kept
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2][1])


def test_near_copies(stages):
    """Of each brute-force group of near copies the document with the least id stays.

    No document goes that is like none of its group, and nearly all near copies do.
    """
    before, after = texts(stages[2]), texts(stages[3])
    links = brute_links(set(before.values()))
    groups = brute_groups(set(before.values()), links)
    least: dict[str, int] = {}
    for i, t in before.items():
        least[groups[t]] = min(i, least.get(groups[t], i))
    assert {i: before[i] for i in after} == after
    assert set(least.values()) <= set(after)
    copied = len(before) - len(least)
    assert copied > 2 and len(before) - len(after) >= 0.9 * copied


def test_benchmark_copies(stages, spark):
    before, after = texts(stages[3]), texts(stages[4])
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    index = decontam.build_index(list(enumerate(items)))  # every n-gram is a seed
    get = index.vocabulary.get
    clean = {}
    for i, t in before.items():
        words = decontam.np.array([get(w, -1) for w in decontam.words_of(t.encode())], int)
        if not decontam.leaks(index, words):
            clean[i] = t
    assert after == clean and len(clean) < len(before)


def test_encoding(stages):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    before = texts(stages[4])
    assert {r["doc_id"]: r["ids"] for r in stages[5][1]} == {
        i: encoding.encode_ordinary(t) for i, t in before.items()
    }


def test_run_gives_the_rows_of_the_last_stage(stages, spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    wanted = {r["doc_id"]: r["ids_sha256"] for r in stages[5][1]}
    assert {r["doc_id"]: r["ids_sha256"] for r in found.collect()} == wanted


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0
