"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    bpe,
    decontam,
    langid,
    licenses,
    lines,
    masked,
    passages,
    phrases,
    quality,
    repair,
    simhash,
    trees,
    warc,
)
from skyledger.llm.common import digest, read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and component."""
    found = simhash.components(simhash.fingerprints(read_table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", simhash.hex_fingerprint(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated windows of lines."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.remove_repeated(docs).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_removed").alias("n_removed"),
        digest(F.col("text")).alias("text_md5"),
    )


ORACLES["op2_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents
), f AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), w AS (
  SELECT doc_id, pos, line || chr(10) || lead(line, 1) OVER o || chr(10) || lead(line, 2) OVER o AS w
  FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), r AS (
  SELECT *, first_value(doc_id) OVER o AS first_doc, first_value(pos) OVER o AS first_at
  FROM w WHERE w IS NOT NULL WINDOW o AS (PARTITION BY w ORDER BY doc_id, pos)
), c AS (
  SELECT DISTINCT doc_id, pos + k AS pos
  FROM r, (SELECT unnest(range(3)) AS k)
  WHERE (doc_id <> first_doc OR pos <> first_at) AND (doc_id <> first_doc OR pos + k > first_at + 2)
), gone AS (
  SELECT f.doc_id, f.i FROM f JOIN c ON f.doc_id = c.doc_id AND f.pos = c.pos
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i
  WHERE gone.i IS NULL GROUP BY l.doc_id
)
SELECT d.doc_id,
       (SELECT count(*) FROM f WHERE f.doc_id = d.doc_id) AS n_lines,
       (SELECT count(*) FROM gone WHERE gone.doc_id = d.doc_id) AS n_removed,
       md5(coalesce(kept.text, '')) AS text_md5
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality ledger of every document, and the verdict of the latest policy."""
    rows = quality.ledger(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality.fails("base").alias("base_failed"),
        (~quality.fails("base") & ~quality.fails("v2")).alias("kept"),
        "n_exclamations",
        "n_lines",
        "failed",
    )


ORACLES["op7_quality"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(ws[i + 1 : i + 8], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(len(ws) - 7)) AS i FROM d WHERE len(ws) >= 8)
), r AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1
), c AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest(range(8)) AS k) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(regexp_extract_all(t, '!')) AS n_exclamations,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM d LEFT JOIN c ON d.doc_id = c.doc_id
), b AS (
  SELECT *,
         CASE WHEN n_words < 20 THEN 1 ELSE 0 END
       + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
       + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 4 ELSE 0 END
       + CASE WHEN 4 * n_symbols > n_words THEN 8 ELSE 0 END
       + CASE WHEN 2 * n_exclamations > n_words THEN 16 ELSE 0 END
       + CASE WHEN word_chars < 2 * n_words OR word_chars > 16 * n_words THEN 32 ELSE 0 END AS failed
  FROM m
)
SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM b
"""


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it comes back from the archives."""
    found = warc.round_trip(read_table(spark, sf_dir, "pages")).filter(F.col("gap").isNull())
    return found.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to_id")).alias("refers_to"),
    )


ORACLES["op9_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), k AS (
  SELECT html, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY html
)
SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN k.keeper <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.keeper <> p.page_id THEN k.keeper END AS refers_to
FROM p LEFT JOIN k ON p.html = k.html
"""


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses that every document names or grants."""
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    """The scan with every window of words against every template."""
    rows = ", ".join(
        f"({i}, '{t.label}', {t.words}, {t.own}, {t.need}, {t.length})"
        for i, t in enumerate(licenses.templates())
    )
    found = "regexp_extract_all(translate({}, '{}', '{}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    words = found.replace("'{}', '{}'", f"'{licenses.UPPER}', '{licenses.UPPER.lower()}'")
    phrases = " ".join(
        "WHEN " + " AND ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split()))
        + f" THEN '{label}'"
        for phrase, label in licenses.PHRASES.items()
    )
    return f"""
WITH t(t, label, words, own, need, length) AS (VALUES {rows}), d AS (
  SELECT doc_id, {words.format("coalesce(text, '')")} AS ws FROM documents
), s AS (
  SELECT doc_id, i, ws[i] AS w, ws[i : i + 40] AS ws FROM (
    SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)
), p AS (
  SELECT doc_id, i - 1 AS place, CASE {phrases.replace("ws[i + ", "ws[1 + ")} END AS label FROM s
), b AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         list(label) AS labels
  FROM p WHERE label IS NOT NULL GROUP BY doc_id
), v AS (
  SELECT t, label, own, need, length, words, unnest(words) AS w FROM t
), x AS (
  SELECT doc_id, label, len(words) AS n, own, need, list_intersect(words, s.ws[1 : length]) AS shared
  FROM s JOIN v ON s.w = v.w
), m AS (
  SELECT doc_id, list(label) AS labels, max(len(shared) / n) AS score
  FROM x WHERE len(shared) >= need AND len(list_intersect(own, shared)) = len(own) GROUP BY doc_id
)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(list_distinct(coalesce(b.labels, []))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(
         list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(m.score, 0.0) END AS score
FROM d LEFT JOIN b ON d.doc_id = b.doc_id LEFT JOIN m ON d.doc_id = m.doc_id
"""


ORACLES["op4_licenses"] = _license_sql()


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it has a copy of."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.pairs(decontam.scan(docs, read_table(spark, sf_dir, "benchmark")))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a model of the documents that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = langid.trained_on_rest(docs)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        langid.held_out(F.col("doc_id")).alias("held_out"),
        F.col("__lang").alias("lang_pred"),
        F.col("__score").alias("score"),
    )


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and what they decode to, as digests."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = bpe.encode(docs, path, public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        F.size("__ids").cast("long").alias("n_tokens"),
        F.col("__ids_sha256").alias("ids_sha256"),
        F.sha2(bpe.decoded(F.col("__ids"), path), 256).alias("decoded_sha256"),
    )


@query
def op6_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log-likelihood, and the mean probability that a word has."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = masked.score(docs, *masked.fit_words(docs))
    mean = F.col("__log_likelihood") / F.col("__n_tokens")
    return rows.select(
        "doc_id",
        F.col("__n_tokens").alias("n_tokens"),
        F.col("__log_likelihood").alias("log_likelihood"),
        F.when(F.col("__n_tokens") > 0, F.exp(mean)).alias("score"),
    )


@query
def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that stand, all but unchanged, in other documents."""
    return passages.near_passages(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that the digest of a row's name chooses; NULLs count as a space."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")]
    fault = F.crc32(name) % 20
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault"))
    fault = F.col("fault")
    text = (
        F.when(fault == 1, "")
        .when(fault == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    times = F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.filter(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(times).alias("time"),
    )


@query
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation's faults, and the cheapest edits that mend its structure."""
    rows = read_table(spark, sf_dir, "conversations")
    return repair.report(damaged(rows), every=rows)


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language."""
    found = phrases.collocations(read_table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLES["op12_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
), s AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w
), g AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM s, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(ws)
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL
), t AS (
  SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang
), c AS MATERIALIZED (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, a FROM f WHERE k > 1 AND a >= 100
), e AS MATERIALIZED (
  SELECT *, array_to_string(ws[1 : j], ' ') AS head, array_to_string(ws[j + 1 : k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)
), u AS (
  SELECT e.lang, e.phrase, e.a, t.n, j, l.a AS l, r.a AS r,
         (1000::HUGEINT * e.a * t.n) // (l.a::HUGEINT * r.a) AS score
  FROM e JOIN t ON e.lang = t.lang
  JOIN f AS l ON l.lang = e.lang AND l.phrase = e.head
  JOIN f AS r ON r.lang = e.lang AND r.phrase = e.tail
), b AS (
  SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), z AS (
  SELECT lang, unnest([array_to_string(ws[1 : k - 1], ' '), array_to_string(ws[2 : k], ' ')]) AS phrase, a
  FROM c WHERE k > 2
), y AS (
  SELECT lang, phrase, max(a) AS longer FROM z GROUP BY ALL
), x AS (
  SELECT b.* FROM b LEFT JOIN y ON y.lang = b.lang AND y.phrase = b.phrase
  WHERE y.longer IS NULL OR y.longer < b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM x QUALIFY rank <= 2000
"""


@query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, by trees that learn from the labels that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = trees.trained(docs, read_table(spark, sf_dir, "labels"))
    found = trees.score(docs, forest)
    return found.select(
        "doc_id",
        trees.held_out(F.col("doc_id")).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= trees.ACCEPTED).cast("int").alias("predicted"),
    )
