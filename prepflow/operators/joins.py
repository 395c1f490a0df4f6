"""Joins. Spark chooses the strategy; the code below only bounds what may be broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 16 * 1024 * 1024
HOT_SHARE = 1000


def join_full_outer(frames: list[DataFrame], key: str) -> DataFrame:
    """Fold frames that hold one row per key into one wide frame."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), frames)


def join_inner(frames: list[DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key, "inner"), frames)


def join_keep_larger(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """All rows of the frame with more rows, the other one's columns where they match.

    On equal counts ``b`` is kept. The kept frame's columns come last.
    """
    if b.count() < a.count():
        return b.join(a, key, "right")
    return a.join(b, key, "right")


def inherit(parent: DataFrame, child: DataFrame, parent_key: str, link: str) -> DataFrame:
    """Rows of a child table with the columns of the parent row they extend."""
    return child.join(parent, child[link] == parent[parent_key], "inner")


def lookup_join(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Left join to a frame with unique keys, whatever its size and however skewed ``df`` is.

    A mapping of up to ``BROADCAST_BYTES`` (measured, not estimated) is
    broadcast. A larger one is shuffled, except for its hot keys: a key in
    at least one of ``HOT_SHARE`` rows of ``df`` is looked up by broadcast.
    There are at most ``HOT_SHARE`` such keys, and with them gone no shuffle
    partition is dominated by one key.
    """
    if _bytes_of(mapping) <= BROADCAST_BYTES:
        return df.join(F.broadcast(mapping), key, "left")
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    floor = max(df.count() // HOT_SHARE, 1)
    hot = [r[0] for r in counts.where(F.col("_rows") > floor).select(key).collect()]
    is_hot = F.col(key).isNull() | F.col(key).isin(hot) if hot else F.col(key).isNull()
    few = mapping.where(F.col(key).isin(hot)) if hot else mapping.where(F.lit(False))
    return (
        df.where(is_hot)
        .join(F.broadcast(few), key, "left")
        .unionByName(df.where(~is_hot).join(mapping, key, "left"))
    )


def _bytes_of(mapping: DataFrame) -> int:
    """Size of the cells: the text form of a value is at least as large as most binary forms."""
    cells = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in mapping.columns), F.lit(0))
    return mapping.select(cells.alias("n")).agg(F.sum("n")).first()[0] or 0
