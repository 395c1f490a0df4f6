"""Alignment of two tokenizers: which ids of A and B stand for the same bytes, counted over a corpus.

Both tokenizers are cut at blanks that no token of either can cross, so a chunk encodes each of its
distinct segments once. Byte offsets where tokens of both end cut a segment into groups. The identity
map, from each A id to the B id of the same bytes, is computed beforehand: groups of one token each that follow it
are counted in vectors as long as the vocabulary. Only the pairs of irregular groups, once per chunk, enter
the pair shuffle. A shard owns some A ids with all their pairs, so it knows the best partner of each.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from prepflow.sources.scratch import discard, settle_at

from .common import texts
from .elias_fano import distinct_keys
from .exchange import ASK, CHUNK, chunk_name, expand, merge, narrow, pack, squeeze, view

U = np.uint64
UNSAFE = re.compile(r"^\s|\s$| \s|\s ")  # white space beside a blank, or at an end
SLICE = 4_000_000  # pairs that are expanded at once
PAIRS_IN_CHUNK, PAIRS_IN_SHARD = 400_000, 1_000_000


# ---- vocabularies ----------------------------------------------------------------------


def byte_level() -> dict[str, int]:
    """The byte of each character in a byte-level vocabulary: printable ones stand for themselves, the others follow from 256."""
    printable = [b for low, high in ((33, 126), (161, 172), (174, 255)) for b in range(low, high + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenizerA:
    """A byte-level tokenizer; strings of special tokens are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.lengths = np.array([len(x) for x in self.token_bytes()], np.int64)

    def token_bytes(self) -> list[bytes]:
        chars, out = byte_level(), [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            out[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        return out

    def encode(self, segments: list[str], together: int = 500) -> list[list[int]]:
        """The ids of a blank and each segment. Segments without outer white space go together, as no token crosses the blanks between them."""
        out: list[list[int]] = [[]] * len(segments)
        plain = [i for i, s in enumerate(segments) if s and not s[0].isspace() and not s[-1].isspace()]
        alone = sorted(set(range(len(segments))).difference(plain))
        for low in range(0, len(plain), together):
            some = plain[low : low + together]
            ids = self.tokenizer.encode_batch_fast([" " + " ".join([segments[i] for i in some])], add_special_tokens=False)[0].ids
            ends = np.cumsum(self.lengths[ids])
            stops = np.cumsum([1 + len(segments[i].encode()) for i in some])
            cuts = np.searchsorted(ends, stops)
            if cuts[-1] != len(ids) - 1 or (ends[cuts] != stops).any():
                alone += some
                continue
            for i, a, b in zip(some, [0, *(cuts[:-1] + 1).tolist()], (cuts + 1).tolist(), strict=True):
                out[i] = ids[a:b]
        for i, e in zip(alone, self.tokenizer.encode_batch_fast([" " + segments[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out


class TokenizerB:
    """A sentencepiece model with byte pieces, which puts a blank before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def token_bytes(self) -> list[bytes]:
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        return [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def cuts_at_blanks(self) -> bool:
        """No piece goes on beyond a blank that follows something else."""
        return not any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(self.model.get_piece_size()))

    def encode(self, segments: list[str]) -> list[list[int]]:
        return self.model.encode(segments, num_threads=1)


def identity_map(a: list[bytes], b: list[bytes], byte_pieces: list[bool]) -> np.ndarray:
    """For each A id the B id of the same bytes (whole pieces before byte pieces, then the lower id), or -1."""
    of: dict[bytes, int] = {}
    for i in sorted(range(len(b)), key=lambda i: (byte_pieces[i], i)):
        of.setdefault(b[i], i)
    return np.array([of.get(x, -1) for x in a], np.int64)


def segments_of(text: str, cut: bool = True) -> list[str]:
    """The text between blanks that stand alone; blanks beside other white space don't part."""
    if not cut:
        return [text]
    if not UNSAFE.search(text):
        return text.split(" ")
    out, run, open_end = [], [], False
    for part in text.split(" "):
        if run and open_end and part and not part[0].isspace():
            out.append(" ".join(run))
            run = []
        run.append(part)
        open_end = bool(part) and not part[-1].isspace()
    return [*out, " ".join(run)]


# ---- groups and links ------------------------------------------------------------------


def groups_of(a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of A and of B, for token sequences of the same bytes; all tokens have bytes."""
    end_a, end_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])
    last_a = end_b[np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)] == end_a if len(b) else np.zeros(0, bool)
    last_b = end_a[np.minimum(np.searchsorted(end_a, end_b), len(end_a) - 1)] == end_b if len(a) else np.zeros(0, bool)
    return np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b


def group_texts(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, sizes: np.ndarray, names: list[str]) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each segment; ``sizes``: tokens (of both) in each segment. names: ids with each of the marks , | ;"""
    tokens, side = np.concatenate([a, b]), np.r_[np.zeros(len(a), np.int64), np.ones(len(b), np.int64)]
    place = 2 * np.concatenate([group_a, group_b]) + side
    order = np.argsort(place, kind="stable")
    tokens, place, many = tokens[order], place[order], len(names) // 3
    last = np.r_[place[1:] != place[:-1], True][: len(place)]
    mark = np.where(last, 1 + place % 2, 0)
    pieces = [names[i] for i in (mark * many + tokens).tolist()]
    joined, ends = "".join(pieces), np.cumsum([0, *map(len, pieces)])
    stops = ends[np.cumsum(np.r_[0, sizes])].tolist()
    return [joined[x : max(x, y - 1)] for x, y in zip(stops[:-1], stops[1:], strict=True)]


class Links:
    """Links of the distinct segments of a chunk: (segment, A id, times) along the identity map, and (segment, pair, times) off it."""

    def __init__(self, a_sizes, a, b_sizes, b, len_a, len_b, identity):
        a, b, wide = a.astype(np.int64), b.astype(np.int64), len(len_b)
        n = len(a_sizes)
        self.n_a, self.n_b = a_sizes.astype(np.int64), b_sizes.astype(np.int64)
        group_a, group_b = groups_of(a, b, len_a, len_b)
        groups = int(group_a[-1]) + 1 if len(a) else 0
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        of_token = np.repeat(np.arange(n), self.n_a)
        segment = np.zeros(groups, np.int64)
        segment[group_a] = of_token
        self.n_groups = np.bincount(segment, minlength=n)
        self.n_links = np.bincount(segment, in_a * in_b, n).astype(np.int64)

        first_a, first_b = np.searchsorted(group_a, np.arange(groups)), np.searchsorted(group_b, np.arange(groups))
        exact = (in_a == 1) & (in_b == 1)
        exact[exact] = identity[a[first_a[exact]]] == b[first_b[exact]]
        vocabulary, self.all_pairs = len(len_a), len(len_a) * wide
        # (segment, A id) on the map and (segment, pair) off it; segments times pairs stay far below 2^63
        same = [summed(segment[exact] * vocabulary + a[first_a[exact]])]
        off = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        odd_a, odd_b = ~exact[group_a], ~exact[group_b]
        key_a, times_a = summed(group_a[odd_a] * vocabulary + a[odd_a])
        key_b, times_b = summed(group_b[odd_b] * wide + b[odd_b])
        at_b = np.searchsorted(key_b // wide, np.arange(groups + 1))
        fan = np.diff(at_b)[key_a // vocabulary]
        stops, low = np.cumsum(fan), 0
        while low < len(key_a):  # an A id of a group has at most a vocabulary of partners
            high = max(low + 1, int(np.searchsorted(stops, (stops[low - 1] if low else 0) + SLICE, "right")))
            f = fan[low:high]
            x = np.repeat(np.arange(low, high), f)
            g, left = key_a[x] // vocabulary, key_a[x] % vocabulary
            y = at_b[g] + np.arange(len(x)) - np.repeat(np.cumsum(f) - f, f)
            right, times = key_b[y] % wide, times_a[x] * times_b[y]
            mapped = identity[left] == right
            same.append(summed((segment[g] * vocabulary + left)[mapped], times[mapped]))
            off.append(summed((segment[g] * self.all_pairs + left * wide + right)[~mapped], times[~mapped]))
            low = high
        key, self.same_times = summed(*map(np.concatenate, zip(*same, strict=True)))
        self.same_segment, self.same_id = key // vocabulary, key % vocabulary
        key, self.off_times = summed(*map(np.concatenate, zip(*off, strict=True)))
        self.off_segment, pair = key // self.all_pairs, key % self.all_pairs
        self.pairs, self.off_pair = distinct_keys(pair)  # off_pair: place in pairs
        self.pairs = self.pairs.astype(np.int64)


def summed(keys: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each comes (or its weights' sum)."""
    some, at = distinct_keys(keys)
    return some.astype(np.int64), np.bincount(at, weight, len(some)).astype(np.int64)


def document_counts(doc: np.ndarray, segment: np.ndarray, of: np.ndarray, item: np.ndarray, items: int) -> np.ndarray:
    """In how many documents each item occurs: (doc, segment) are distinct and sorted by doc, (of, item) sorted by segment ``of``."""
    counts = np.zeros(items, np.int64)
    starts = np.searchsorted(of, np.arange(int(max(of.max(initial=-1), segment.max(initial=-1))) + 2))
    fan = np.diff(starts)[segment]
    stops, low = np.cumsum(fan), 0
    while low < len(doc):  # whole documents at a time
        high = max(low + 1, int(np.searchsorted(stops, (stops[low - 1] if low else 0) + SLICE, "right")))
        if doc[high - 1] != doc[low]:
            high = int(np.searchsorted(doc, doc[high - 1])) if high < len(doc) and doc[high] == doc[high - 1] else high
        else:
            high = int(np.searchsorted(doc, doc[low], "right"))
        f = fan[low:high]
        at = np.repeat(starts[segment[low:high]], f) + np.arange(f.sum()) - np.repeat(np.cumsum(f) - f, f)
        keys, _ = distinct_keys(np.repeat(doc[low:high] - doc[low], f) * items + item[at])
        counts += np.bincount((keys % U(items)).astype(np.int64), minlength=items) if items else 0
        low = high
    return counts


# ---- chunks ----------------------------------------------------------------------------


def read_chunks(docs: DataFrame, path_a: str, path_b: str, identity: np.ndarray, chunk_words: int) -> DataFrame:
    """Chunks of whole documents: doc_ids, whether null, SHA-256 of the groups, segments of each document, the segments'
    numbers, and of each distinct segment the A and B ids. Documents without tokens have no segments."""

    def run(batches):
        a, b = TokenizerA(path_a), TokenizerB(path_b)
        bytes_a, bytes_b, cuts = a.token_bytes(), b.token_bytes(), b.cuts_at_blanks()
        len_a, len_b = (np.array([len(x) for x in t], np.int64) for t in (bytes_a, bytes_b))
        names = [f"{i}{mark}" for mark in ",|;" for i in range(max(len(len_a), len(len_b)))]
        keys, held, known, size, number = [], [], {}, 0, 0

        def close():
            segments = list(known)
            ids_a, ids_b, right = [], [], []
            for i in range(0, len(segments), 2000):
                some = segments[i : i + 2000]
                for s, x, y in zip(some, a.encode(some), b.encode(some), strict=True):
                    raw = b" " + s.encode()
                    right.append(b"".join([bytes_a[t] for t in x]) == raw and b"".join([bytes_b[t] for t in y]) == raw)
                    ids_a.append(x if right[-1] else [])
                    ids_b.append(y if right[-1] else [])
            sizes_a, sizes_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
            flat_a, flat_b = (np.array([t for x in ids for t in x], np.int64) for ids in (ids_a, ids_b))
            group_a, group_b = groups_of(flat_a, flat_b, len_a, len_b)
            shown = group_texts(flat_a, flat_b, group_a, group_b, sizes_a + sizes_b, names)
            right, digests = np.array(right, bool), []
            for i, numbers in enumerate(held):
                if not right[numbers].all():
                    held[i] = numbers[:0]
                whole = ";".join([shown[k] for k in held[i].tolist()])
                digests.append(hashlib.sha256(whole.encode()).digest() if whole else bytes(32))
            arrays = [
                np.array([0 if k is None else k for k in keys], np.int64), np.array([k is None for k in keys], np.uint8), np.frombuffer(b"".join(digests), np.uint8),
                narrow(np.array([len(x) for x in held])), narrow(np.concatenate(held)), narrow(sizes_a), narrow(flat_a), narrow(sizes_b), narrow(flat_b),
            ]
            return pa.RecordBatch.from_arrays([pa.array([chunk_name(number)]), pa.array([squeeze(arrays)], pa.binary())], names=["chunk", "body"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                keys.append(key)
                held.append(np.array([known.setdefault(s, len(known)) for s in segments_of(text, cuts)] if text else [], np.int64))
                size += len(held[-1])
                if size >= chunk_words or len(held) >= chunk_words:
                    yield close()
                    keys, held, known, size, number = [], [], {}, 0, number + 1
        if held:
            yield close()

    return docs.select("doc_id", "text").mapInArrow(run, CHUNK)


class Chunk:
    def __init__(self, arrays: list[np.ndarray], vocabularies):
        self.keys, self.no_key, self.digests, lengths, occurring, *ids = arrays
        self.lengths, self.occurring = lengths.astype(np.int64), occurring.astype(np.int64)
        self.links = Links(*ids, *vocabularies)

    def counts(self, identity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold each A id with its identity partner (a vector of the vocabulary) and each other pair."""
        x = self.links
        n = max(1, len(x.n_a))
        keys, _ = distinct_keys(np.repeat(np.arange(len(self.lengths)), self.lengths) * n + self.occurring)
        doc, segment = np.divmod(keys.astype(np.int64), n)
        return document_counts(doc, segment, x.same_segment, x.same_id, len(identity)), document_counts(doc, segment, x.off_segment, x.off_pair, len(x.pairs))

    def total(self, by_segment: np.ndarray) -> np.ndarray:
        """Sums over each document's segments."""
        sums = np.r_[0, np.cumsum(by_segment[self.occurring])]
        ends = np.cumsum(self.lengths)
        return sums[ends] - sums[ends - self.lengths]


def by_shard(pairs: np.ndarray, wide: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pairs by the shard of their A id, and where each shard starts."""
    shard = pairs // wide % shards
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def questions(chunks: DataFrame, vocabularies, shards: int) -> DataFrame:
    """For each shard its part of the chunk's identity vector, and the chunk's other pairs with their counts."""
    wide, identity = len(vocabularies[1]), vocabularies[2]

    def run(batches):
        for batch in batches:
            for chunk, body in zip(batch.column("chunk").to_pylist(), batch.column("body"), strict=True):
                c = Chunk(expand(body.as_buffer()), vocabularies)
                same, off = c.counts(identity)
                order, starts = by_shard(c.links.pairs, wide, shards)
                cells = []
                for s in range(shards):
                    own = order[starts[s] : starts[s + 1]]
                    cells.append(squeeze([narrow(same[s::shards]), narrow(c.links.pairs[own]), narrow(off[own])]))
                yield pa.RecordBatch.from_arrays([pa.array(range(shards), pa.int32()), pa.array([chunk] * shards), pa.array(cells, pa.binary())], names=["shard", "chunk", "body"])

    return chunks.mapInArrow(run, ASK)


def replies(asks: DataFrame, vocabularies, shards: int) -> DataFrame:
    """Corpus-wide counts of what each chunk asked (level 0) and the shard's table of pairs (level 1)."""
    wide, identity = len(vocabularies[1]), vocabularies[2]

    def run(key, pdf):
        import pandas as pd

        shard = int(key[0])
        bodies = [expand(b) for b in pdf["body"]]
        same = np.sum([b[0].astype(np.int64) for b in bodies], axis=0)
        asked = np.concatenate([b[1] for b in bodies]).astype(np.int64)
        pairs, at = distinct_keys(asked)
        pairs = pairs.astype(np.int64)
        count = np.bincount(at, np.concatenate([b[2] for b in bodies]), len(pairs)).astype(np.int64)
        best = same.copy()
        np.maximum.at(best, pairs // wide // shards, count)
        top, same_top = count == best[pairs // wide // shards], same == best
        sizes = [len(b[1]) for b in bodies]
        cells = []
        for b, n, stop in zip(bodies, sizes, np.cumsum(sizes).tolist(), strict=True):
            own, some = at[stop - n : stop], b[0] > 0
            cells.append(squeeze([narrow(same[some]), same_top[some].astype(np.uint8), narrow(count[own]), top[own].astype(np.uint8)]))
        ids = np.flatnonzero(same)
        a = ids * shards + shard
        level = pack([np.r_[a * wide + identity[a], pairs], np.r_[same[ids], count], np.r_[same_top[ids], top].astype(np.uint8)])
        return pd.DataFrame({"shard": shard, "chunk": pd.array([*pdf["chunk"], None], "Int64"), "body": [*cells, level], "level": [0] * len(cells) + [1]})

    return asks.groupBy("shard").applyInPandas(run, ASK + ", level int")


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def results(vocabularies, shards: int):
    wide, identity = len(vocabularies[1]), vocabularies[2]

    def join(_, arrays, answers):
        import pandas as pd

        c = Chunk(arrays, vocabularies)
        x, (same, _) = c.links, c.counts(identity)
        order, starts = by_shard(x.pairs, wide, shards)
        count, top = np.zeros(len(x.pairs), np.int64), np.zeros(len(x.pairs), np.int64)
        same_count, same_top = np.zeros(len(identity), np.int64), np.zeros(len(identity), np.int64)
        for s, (a, b, p, q) in enumerate(answers):
            own, ids = order[starts[s] : starts[s + 1]], np.flatnonzero(same[s::shards]) * shards + s
            count[own], top[own], same_count[ids], same_top[ids] = p, q, a, b
        n = len(x.n_a)

        def by_segment(for_id, for_pair):
            return np.bincount(x.same_segment, x.same_times * for_id[x.same_id], n).astype(np.int64) + np.bincount(x.off_segment, x.off_times * for_pair[x.off_pair], n).astype(np.int64)

        some = c.lengths > 0
        raw = c.digests.tobytes()
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if gone else k for k, gone in zip(c.keys.tolist(), c.no_key.tolist(), strict=True)], "Int64"),
                "n_a": c.total(x.n_a), "n_b": c.total(x.n_b), "n_groups": c.total(x.n_groups), "n_links": c.total(x.n_links),
                "n_best": c.total(by_segment(same_top, top)), "count_sum": c.total(by_segment(same_count, count)),
                "groups_sha256": [raw[32 * i : 32 * i + 32].hex() if k else "" for i, k in enumerate(some.tolist())],
            }
        )

    return join


def pair_table(levels: DataFrame, wide: int) -> DataFrame:
    """a_id, b_id, docs, best: all linked pairs, the documents that hold them, and whether no other partner of a_id has more."""

    def run(batches):
        for batch in batches:
            for body in batch.column("body"):
                pair, docs, best = view(body.as_buffer())
                pair = pair.astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pair // wide, pair % wide, docs.astype(np.int64), best > 0)], names=["a_id", "b_id", "docs", "best"])

    return levels.select("body").mapInArrow(run, "a_id long, b_id long, docs long, best boolean")


def align(docs: DataFrame, path_a: str, path_b: str, chunk_words: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) and the table of linked pairs, see ``pair_table``.

    A is a byte-level BPE file of the tokenizers library and encodes a blank and the text; B is a sentencepiece model, which
    adds the blank itself. Null and empty texts, and those whose tokens don't join to the very bytes, have zeros and no digest.
    Repeated rows and keys count as documents of their own, null keys stay null, an empty table gives no rows, other columns are
    ignored. A text lies in one chunk whatever its length; only a run without lone blanks is encoded in one piece.
    """
    a, b = TokenizerA(path_a), TokenizerB(path_b)
    bytes_a, bytes_b = a.token_bytes(), b.token_bytes()
    identity = identity_map(bytes_a, bytes_b, [b.model.is_byte(i) for i in range(len(bytes_b))])
    vocabularies = (np.array([len(x) for x in bytes_a], np.int64), np.array([len(x) for x in bytes_b], np.int64), identity)

    spark = docs.sparkSession
    chunks, at = settle_at(read_chunks(texts(docs, id_col, text_col), path_a, path_b, identity, chunk_words), "aligned")
    shards = min(len(bytes_a), max(1, chunks.count() * PAIRS_IN_CHUNK // PAIRS_IN_SHARD))
    counted, _ = settle_at(replies(questions(chunks, vocabularies, shards), vocabularies, shards), "pair-counts", ("level",))
    found, _ = settle_at(merge(chunks, counted.where("level = 0"), results(vocabularies, shards), RESULT, joined=False), "alignment")
    discard(spark, at)
    return found, pair_table(counted.where("level = 1"), len(bytes_b))
