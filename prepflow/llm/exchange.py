"""Lookups in distributed dictionaries: chunks of documents ask shards, and the answers come back to the chunks.

A chunk asks each shard once for all its distinct keys, as one compressed cell; so a key costs a
chunk one entry however often it occurs, and no shard sees more than its share of the keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = "chunk long, body binary"
ASK = "shard int, chunk long, body binary"


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays in one buffer, each at a multiple of eight bytes, so that a mapped buffer is viewed without a copy."""
    kinds = ";".join(f"{a.dtype.str}:{len(a)}" for a in arrays).encode()
    out = [len(kinds).to_bytes(8, "little"), kinds, b"\0" * (-len(kinds) % 8)]
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        out += [raw, b"\0" * (-len(raw) % 8)]
    return b"".join(out)


def view(buffer) -> list[np.ndarray]:
    """The arrays of ``pack`` as views of any buffer: bytes, a cell, a memory-mapped file."""
    buffer = memoryview(buffer)
    size = int.from_bytes(buffer[:8], "little")
    at, out = 8 + size + -size % 8, []
    for kind in bytes(buffer[8 : 8 + size]).decode().split(";") if size else []:
        dtype, n = kind.rsplit(":", 1)
        out.append(np.frombuffer(buffer, dtype, int(n), at))
        at += out[-1].nbytes + -out[-1].nbytes % 8
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    """Nonnegative integers in the least width that holds them."""
    most = int(a.max(initial=0))
    return a.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max))


def squeeze(arrays: list[np.ndarray]) -> bytes:
    """``pack`` of byte planes, compressed: integers of one column compress better plane by plane."""
    planes = [a.view(np.uint8).reshape(len(a), a.itemsize).T.ravel() if a.itemsize > 1 else a for a in map(np.ascontiguousarray, arrays)]
    raw = pack([np.frombuffer(";".join(a.dtype.str for a in arrays).encode(), np.uint8), *planes])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def expand(cell) -> list[np.ndarray]:
    cell = memoryview(cell)
    raw = pa.decompress(pa.py_buffer(cell[8:]), decompressed_size=int.from_bytes(cell[:8], "little"), codec="zstd")
    kinds, *planes = view(raw)
    out = []
    for kind, p in zip(kinds.tobytes().decode().split(";") if len(kinds) else [], planes, strict=True):
        dtype = np.dtype(kind)
        out.append(np.ascontiguousarray(p.reshape(dtype.itemsize, -1).T).view(dtype).ravel() if dtype.itemsize > 1 else p.view(dtype))
    return out


def chunk_name(number: int) -> int:
    """Names a task's chunks; they are written once and then only read, so names don't change."""
    from pyspark import TaskContext

    return (TaskContext.get().partitionId() << 32) + number


def cut(shard: np.ndarray, columns: list[np.ndarray]):
    """(shard, squeezed columns) for each shard of entries that are sorted by shard."""
    if not len(shard):
        return
    starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(shard)], strict=True):
        yield int(shard[a]), squeeze([narrow(c[a:b]) for c in columns])


def ask(chunks: DataFrame, entries) -> DataFrame:
    """Questions of every chunk; ``entries(arrays)`` gives the shard of each entry, sorted, and the columns."""

    def run(batches):
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                rows = list(cut(*entries(expand(body.as_buffer()))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                    names=["shard", "chunk", "body"],
                )

    return chunks.select("chunk", "body").mapInArrow(run, ASK)


def answer(asks: DataFrame, reply, keep_levels: bool = True, stored: DataFrame | None = None) -> DataFrame:
    """``reply(shard, columns, level)`` answers all entries of a shard at once: it gives the answer columns, the shard's
    dictionary as a buffer (a new one where ``level`` is None, else the ``stored`` one) and its number of entries.

    Rows: shard, chunk, body, number, level. Level 0 has an answer for each question, level 1 a dictionary for each shard
    (an empty cell unless ``keep_levels``). A shard without a stored dictionary is answered from an empty one.
    """

    def run(key, pdf, held=None):
        import pandas as pd

        bodies = [expand(b) for b in pdf["body"]]
        sizes = [len(b[0]) for b in bodies]
        columns = [np.concatenate(c).astype(np.uint64) for c in zip(*bodies, strict=True)]
        level = None
        if held is not None and len(held):
            level = held["body"].iloc[0]
        elif held is not None:
            level = reply(int(key[0]), [c[:0] for c in columns], None)[1]
        if not columns:
            return pd.DataFrame({c: [] for c in ("shard", "chunk", "body", "number", "level")})
        columns, level, number = reply(int(key[0]), columns, level)
        cells = [squeeze([narrow(c[b - n : b]) for c in columns]) for n, b in zip(sizes, np.cumsum(sizes).tolist(), strict=True)]
        return pd.DataFrame(
            {
                "shard": key[0], "chunk": pd.array([*pdf["chunk"], None], "Int64"), "body": [*cells, level if keep_levels else b""],
                "number": [0] * len(cells) + [number], "level": [0] * len(cells) + [1],
            }
        )

    schema = ASK + ", number long, level int"
    if stored is None:
        return asks.groupBy("shard").applyInPandas(lambda key, pdf: run(key, pdf), schema)
    return asks.groupBy("shard").cogroup(stored.groupBy("shard")).applyInPandas(run, schema)


def merge(chunks: DataFrame, answers: DataFrame, join, schema: str, joined: bool = True) -> DataFrame:
    """``join(chunk, arrays, columns)`` meets each chunk with its answers, in the order of its questions; gives a frame of ``schema``.

    Without ``joined`` it gets the answers as a list by shard instead of as one set of columns.
    """

    def run(key, state, replies):
        replies = [expand(b) for b in replies.sort_values("shard")["body"]]
        return join(int(key[0]), expand(state["body"].iloc[0]), [np.concatenate(c) for c in zip(*replies, strict=True)] if joined else replies)

    replies = answers.select("shard", "chunk", "body")
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(run, schema)
