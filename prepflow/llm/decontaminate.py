"""Short benchmark items inside long documents: size-partitioned MinHash containment search, then an exact check.

A document that holds at least a share t of an item's q shingles misses at most
floor((1 - t) q) of them, so it has one of any floor((1 - t) q) + 1. The item's sketch is
that many of its smallest shingle hashes; items are partitioned by size, and each
partition has the largest sketched hash as its bound, so documents probe only with
their shingles below the bounds. Candidates are then counted on the shingles
themselves. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, texts

SHINGLE = 5


def plain_words(text: F.Column) -> F.Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def hashes(words: str, n: int = SHINGLE) -> F.Column:
    parts = ", ".join(f"{words}[i + {j}]" for j in range(n))
    return F.expr(
        f"CASE WHEN size({words}) >= {n} THEN transform(sequence(0, size({words}) - {n}), i -> xxhash64({parts})) "
        "ELSE cast(array() AS array<bigint>) END"
    )


def shingles(words: str, n: int = SHINGLE) -> F.Column:
    return F.expr(
        f"CASE WHEN size({words}) >= {n} THEN array_distinct(transform(sequence(1, size({words}) - {n - 1}), "
        f"i -> concat_ws(' ', slice({words}, i, {n})))) ELSE cast(array() AS array<string>) END"
    )


def sketch_items(items: DataFrame, threshold: float, n: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(classes, sketches). A class is a set of shingles with all items that have it; items under ``n`` words have none.

    A sketch row is (part, bound, h, class_id); part is the power of two above the size.
    """
    t = texts(items, id_col, text_col).withColumn("words", plain_words(F.col("text")))
    # written before the filter: a filter pushed below would repeat the word splitting for each shingle
    t = settle(t.select("doc_id", F.sort_array(shingles("words", n)).alias("items")), "item-shingles")
    classes = (
        t.where(F.size("items") > 0)
        .groupBy("items")
        .agg(F.min("doc_id").alias("first_item"), F.count("*").alias("n_items"))
        .withColumn("class_id", F.sha2(F.concat_ws("\n", "items"), 256))
    )
    classes = settle(classes, "items")
    q = F.size("items")
    kept = q - F.ceil(F.lit(threshold) * q - F.lit(1e-9)) + 1
    h = F.expr(f"transform(items, x -> xxhash64({', '.join(f'split(x, chr(32))[{j}]' for j in range(n))}))")
    rows = classes.select(
        "class_id", F.bin(q).alias("part"), F.slice(F.sort_array(h), 1, kept.cast("int")).alias("low")
    ).withColumn("part", F.length("part"))
    rows = settle(rows.select("class_id", "part", F.explode("low").alias("h")), "sketches")
    return classes, rows


def find_items(
    docs: DataFrame, items: DataFrame, threshold: float = 0.8, n: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", most_broadcast: int = 1_000_000,
) -> DataFrame:
    """Links (doc_id, text_hash, class_id, first_item, n_items, containment) with containment of at least ``threshold``.

    Items of equal shingles are one class, so repeated items add no rows. Sketches are
    broadcast when they have at most ``most_broadcast`` rows, else joined by shuffle.
    Null and short texts hold nothing; an empty table on either side gives no links.
    """
    classes, sketches = sketch_items(items, threshold, n, item_id, item_text)
    bound = sketches.groupBy("part").agg(F.max("h").alias("h")).agg(F.max("h")).first()[0]
    n_sketches = sketches.count()
    d = texts(docs, id_col, text_col).withColumn("words", plain_words(F.col("text")))
    probes = d.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.filter(hashes("words", n), lambda h: h <= F.lit(bound)).alias("low")
    ).select("doc_id", "text_hash", F.explode_outer("low").alias("h"))  # outer: plain explode adds a filter that is pushed below
    side = sketches.select("h", "class_id")
    found = probes.join(F.broadcast(side) if n_sketches <= most_broadcast else side, "h")
    pairs = settle(found.select("doc_id", "text_hash", "class_id").distinct(), "candidates")

    named = pairs.select("doc_id", "text_hash").distinct()
    d = texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    same = F.expr("a.doc_id <=> b.doc_id AND a.text_hash = b.text_hash")
    held = d.alias("a").join(named.alias("b"), same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    held = held.withColumn("words", plain_words(F.col("text"))).select("doc_id", "text_hash", shingles("words", n).alias("have"))
    both = pairs.alias("a").join(held.alias("b"), same).select("a.*", "have").join(classes, "class_id")
    share = F.size(F.array_intersect("items", "have")) / F.size("items")
    return (
        both.select("doc_id", "text_hash", "class_id", "first_item", "n_items", share.alias("containment"))
        .where(F.col("containment") >= threshold - 1e-9)
    )


def mark(docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """For each row of ``docs``: doc_id, text_hash, n_items found in it, first_item (smallest id) and the largest containment (0 without)."""
    links = find_items(docs, items, threshold, id_col=id_col, text_col=text_col, **more)
    per = links.groupBy("doc_id", "text_hash").agg(
        F.sum("n_items").alias("n"), F.min("first_item").alias("first_item"), F.max("containment").alias("best")
    )
    d = texts(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"))
    joined = d.alias("a").join(settle(per, "leaks").alias("b"), F.expr("a.doc_id <=> b.doc_id AND a.text_hash = b.text_hash"), "left")
    return joined.select(
        "a.doc_id", "a.text_hash", F.coalesce("n", F.lit(0)).alias("n_items"), "first_item", F.coalesce("best", F.lit(0.0)).alias("containment")
    )


MARK_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda j: array_to_string(w[j:j + 4], ' '))) AS g FROM i),
q AS (SELECT item_id, count(*) AS q FROM s GROUP BY 1),
g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda j: array_to_string(w[j:j + 4], ' '))) AS g FROM d),
m AS (SELECT g.doc_id, s.item_id, count(*) AS n FROM g JOIN s USING (g) GROUP BY 1, 2),
f AS (SELECT doc_id, item_id, n / q AS c FROM m JOIN q USING (item_id) WHERE 10 * n >= 8 * q),
p AS (SELECT doc_id, count(*) AS n, min(item_id) AS first_item, max(c) AS best FROM f GROUP BY 1)
SELECT d.doc_id, coalesce(p.n, 0)::BIGINT AS n_items, p.first_item, coalesce(p.best, 0.0)::DOUBLE AS containment
FROM d LEFT JOIN p USING (doc_id)
"""
