"""Quality rules as a short-circuit cascade, ordered by rejections per unit of cost."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, texts, words_of

WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Rule:
    """A document fails when ``fails`` (SQL over text and the base counts) is true."""

    name: str
    fails: str


#: The thresholds are wide: they are meant for junk, not for odd but honest prose.
RULES = (
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 6 * n_lines"),
    Rule("few_letters", r"2 * length(regexp_replace(text, '[^\\p{L}]', '')) < word_chars"),
    Rule("shouting", r"2 * length(regexp_replace(text, '[^\\p{Lu}]', '')) > word_chars"),
    Rule("bullets", r"10 * regexp_count(text, '(?m)^[\\x20\\x09]*[*\\x2D\\u2022]') > 9 * n_lines AND n_lines > 4"),
    Rule("cut_lines", r"2 * regexp_count(text, '(?m)(\\.\\.\\.|\\u2026)$') > n_lines AND n_lines > 4"),
)


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    r"""Counts per row: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Words are ``[^\x20\x09-\x0D]+``. ``n_repeat_words`` counts the words inside
    three-word windows that occur twice or more in the text: window hashes are sorted
    with their position in the low bits (as many as the text needs), so equal windows
    are neighbours, and each found window adds the words up to the next found one.
    A null or empty text has only zeros.
    """
    d = texts(docs, id_col, text_col)
    d = d.withColumn("words", words_of(F.col("text")))
    d = d.withColumn("n_words", F.size("words").cast("long"))
    d = d.withColumn("bits", F.length(F.bin(F.col("n_words"))))
    d = d.withColumn(
        "coded",
        F.expr(
            "CASE WHEN n_words > 3 THEN sort_array(transform(sequence(1, size(words) - 2), i -> "
            "(shiftleft(shiftright(xxhash64(words[i - 1], words[i], words[i + 1]), bits), bits) | cast(i as bigint)))) "
            "ELSE cast(array() AS array<bigint>) END"
        ),
    )
    d = d.withColumn(
        "found",
        F.expr(
            "CASE WHEN size(coded) > 1 THEN sort_array(transform(filter(sequence(1, size(coded)), j -> "
            "(j > 1 AND shiftright(coded[j - 1], bits) = shiftright(coded[j - 2], bits)) OR "
            "(j < size(coded) AND shiftright(coded[j - 1], bits) = shiftright(coded[j], bits))), "
            "j -> (coded[j - 1] & (shiftleft(1L, bits) - 1L)))) ELSE cast(array() AS array<bigint>) END"
        ),
    )
    repeated = F.expr(
        "CASE WHEN size(found) = 0 THEN 0L ELSE aggregate(sequence(1, size(found)), 0L, (n, j) -> "
        "n + CASE WHEN j < size(found) THEN least(3L, found[j] - found[j - 1]) ELSE 3L END) END"
    )
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0))
    return d.select(
        "doc_id",
        "text",
        "n_words",
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
    )


def order_rules(drawn: DataFrame, rules=RULES) -> list[Rule]:
    """The rules by rejections per second, each timed alone over ``drawn`` (base counts of a sample).

    The order affects only the time and the name of the first failed rule, never the
    verdict.
    """
    drawn = drawn.persist()
    try:
        rows = max(1, drawn.count())
        rated = []
        for rule in rules:
            start = time.perf_counter()
            rejected = drawn.where(f"coalesce({rule.fails}, false)").count()
            rated.append(((rejected + 0.5) / rows / (time.perf_counter() - start), rule))
    finally:
        drawn.unpersist()
    return [rule for _, rule in sorted(rated, key=lambda x: -x[0])]


def judge(docs: DataFrame, rules=RULES, sample_rows: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, ``base_failed`` and the cascade's verdict for each row.

    base_failed: fewer than 50 words, or over half of the words in repeated windows.
    Such rows skip the cascade. The cascade stops at the first rule that a row fails
    (``first_failed``, null for kept rows), so costly rules see only what cheap ones let
    pass. About ``sample_rows`` rows, drawn by a hash of the key, order the rules. Null
    and empty texts fail the base; an empty table gives an empty result; repeated rows
    are judged alike.
    """
    d = texts(docs, id_col, text_col)
    share = sample_rows / max(1, d.count())
    drawn = d.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) <= int(min(1.0, share) * 1_000_000))
    cases = " ".join(f"WHEN {r.fails} THEN '{r.name}'" for r in order_rules(base_counts(drawn), rules))
    judged = (
        base_counts(d)
        .withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
        .withColumn("first_failed", F.expr(f"CASE WHEN base_failed THEN 'base' {cases} END"))
        .withColumn("kept", F.col("first_failed").isNull())
        .drop("text")
    )
    return settle(judged, "judged")  # written, so that a later filter on the verdict isn't evaluated inside the counting
