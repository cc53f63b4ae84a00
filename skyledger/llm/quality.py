"""Quality rules as a ledger of bits, and policies over it.

Every rule is evaluated once. The ledger keeps what was measured and a bit for
each rule that a text fails; a policy is a mask of bits, so policies can be
changed, compared and taken apart without reading a text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]"
WINDOW = 8

#: Rules in the order of their bits: what fails, over the measured columns.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "symbols": "4 * n_symbols > n_words",
    "exclamations": "2 * n_exclamations > n_words",
    "word_length": "word_chars < 2 * n_words or word_chars > 16 * n_words",
}

#: Policies by version: the rules that a text must not fail.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "word_length"),
    "v2": tuple(RULES),
}


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measurements of every whole text; a NULL text has no words.

    ``n_repeat_words`` counts the words that lie in a window of eight words found more
    than once in the text; windows are compared by 64-bit hashes of their words'
    hashes. Everything stays inside the row: no shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    inner = F.btrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, f"{BLANK}+")
    )
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        F.length(F.regexp_replace("text", f"{BLANK}+", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_exclamations"),
        lines.alias("lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("words"),
    )
    at = F.sequence(F.lit(0), F.size("words") - WINDOW)
    windows = F.transform(
        at, lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)])
    )
    rows = rows.select(
        "doc_id",
        "word_chars",
        "n_symbols",
        "n_exclamations",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= WINDOW, windows).alias("windows"),
    )
    placed = F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("placed", F.when(some, F.sort_array(placed))).drop("windows")

    def found_again(e: Column, k: Column) -> Column:
        before, after = F.get(F.col("placed"), k - 1), F.get(F.col("placed"), k + 1)
        return F.coalesce(before["x"] == e["x"], F.lit(False)) | F.coalesce(
            after["x"] == e["x"], F.lit(False)
        )

    again = F.sort_array(F.transform(F.filter("placed", found_again), lambda e: e["i"]))
    rows = rows.withColumn("again", again).drop("placed")
    # From one start to the next, but no further than a window reaches.
    def step(place: Column, k: Column) -> Column:
        following = F.get(F.col("again"), k + 1) - place
        return F.least(F.coalesce(following, F.lit(WINDOW)), F.lit(WINDOW))

    steps = F.transform("again", step)
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("again")


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements of ``docs`` with ``failed``: the bits of the rules that a text fails."""
    bits = [
        F.when(F.expr(condition), F.lit(bit(rule)).cast("long")).otherwise(F.lit(0).cast("long"))
        for rule, condition in RULES.items()
    ]
    failed = bits[0]
    for other in bits[1:]:
        failed = failed.bitwiseOR(other)
    return measure(docs).withColumn("failed", failed)


def fails(policy: str) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) != 0


def ablations(rows: DataFrame) -> DataFrame:
    """``policy``, ``rule``, ``n_kept``, ``n_without``, ``n_alone`` from a ledger.

    How many texts a policy keeps, how many it would keep without the rule, and how
    many only that rule rejects. The ledger is first reduced to a row for each
    combination of bits; everything else is bitwise arithmetic on those few rows. An
    empty ledger gives zeros.
    """
    counts = rows.groupBy("failed").agg(F.count("*").alias("n"))
    sums = []
    for policy, rules in POLICIES.items():
        failed = F.col("failed").bitwiseAND(F.lit(mask(policy)))
        for rule in rules:
            without = failed.bitwiseAND(F.lit(~bit(rule)))
            sums.append(
                F.struct(
                    F.lit(policy).alias("policy"),
                    F.lit(rule).alias("rule"),
                    F.coalesce(F.sum(F.when(failed == 0, F.col("n"))), F.lit(0)).alias("n_kept"),
                    F.coalesce(F.sum(F.when(without == 0, F.col("n"))), F.lit(0)).alias("n_without"),
                    F.coalesce(F.sum(F.when(failed == bit(rule), F.col("n"))), F.lit(0)).alias("n_alone"),
                )
            )
    return counts.agg(F.array(*sums).alias("all")).select(F.inline("all"))
