"""Helpers shared by the text operators: reading tables, word hashes, scratch tables."""

from __future__ import annotations

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import prepflow
from prepflow.sources.scratch import settle  # noqa: F401  (re-exported)

# Functions of this package travel to the workers by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(prepflow)


MOST_KEYS = 2_000_000  # that are sent to every task, some 60 bytes each there


def by_keys(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in the settled table ``keys`` (left_semi) or isn't (left_anti); neither has null keys.

    Up to ``MOST_KEYS`` keys, as measured, go to the rows; for more of them both are shuffled.
    """
    count = keys.count()
    if not count and how == "left_anti":
        return df
    return df.join(F.broadcast(keys) if count <= MOST_KEYS else keys, key, how)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text (null becomes empty), under fixed names, so that no other column can clash."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )


def spaced(text: F.Column) -> F.Column:
    """Every ASCII white-space character as a blank."""
    return F.translate(text, "\t\n\x0b\x0c\r", "     ")


def words_of(text: F.Column) -> F.Column:
    r"""The words ``[^\x20\x09-\x0D]+`` as an array."""
    return F.filter(F.split(spaced(text), " "), lambda w: w != "")


LONG_WORD = 128  # bytes; longer words are hashed one by one
FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    r"""64-bit hashes of the words ``[^\x20\x09-\x0D]+``, and the byte at which each starts.

    All words are hashed together, eight bytes at a time; the length counts too, as a word may end in zero bytes.
    """
    raw = np.frombuffer(data + b" " * 8, np.uint8)
    blank = (raw - np.uint8(9) < np.uint8(5)) | (raw == 32)
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(data) and not blank[0]:
        edges = np.concatenate([np.zeros(1, edges.dtype), edges])
    starts, ends = edges[0::2], edges[1::2]
    sizes = ends - starts
    eight = np.ndarray(len(data) + 1, "<u8", raw, strides=(1,))
    hashes = mixed((eight[starts] & FIRST_BYTES[np.minimum(sizes, 8)]) ^ mixed(sizes.astype(np.uint64)))
    some, at = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD)), 8
    while len(some):
        rest = np.minimum(sizes[some] - at, 8)
        hashes[some] = mixed(hashes[some] + (eight[starts[some] + at] & FIRST_BYTES[rest]))
        at += 8
        some = some[sizes[some] > at]
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        import xxhash

        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]])
    return hashes, starts


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values (multiply and shift, twice)."""
    v = values ^ (values >> np.uint64(31))
    v = v * np.uint64(0x9E3779B97F4A7C15)
    v ^= v >> np.uint64(29)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    return v ^ (v >> np.uint64(32))


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, one per start."""
    count = len(ids) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + ids[i : i + count]
    return mixed(total)


def shingle_set(ids: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of ``n``-word shingles; a shorter text is one shingle, an empty one has none."""
    if not len(ids):
        return np.zeros(0, dtype=np.uint64)
    return np.unique(grams(ids, min(n, len(ids))))


LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))  # A-Z to a-z, all else as it is
