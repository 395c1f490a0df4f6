"""Token ids in grammar-compressed shards (Re-Pair), with random access to documents.

A shard holds consecutive documents. Frequent pairs of neighbouring symbols are replaced
by nonterminals, round after round; no pair spans two documents. Stored are the rules,
the number of ids that each symbol expands to, the remaining symbols, and where each
document starts, so that a document (or a range of its ids) is decoded alone. Shards are
rows of a stored table, so they lie on any file system and survive lost executors.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settle, texts

TAIL = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
SHARD_SCHEMA = (
    "part int, start_in_part long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, doc_symbols array<long>, "
    "width int, vocabulary long, rules binary, lengths binary, symbols binary"
)


# ---- text to ids ---------------------------------------------------------------------


LATIN = "[A-Za-zªµºÀ-ÖØ-öø-įı-ſ]"  # letters that are one token word for the vocabulary, whatever stands around them
TEXT_BYTES = 8_000_000  # of texts that are encoded together, unless one alone has more


def gather(flat: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen ones of the runs that follow each other in ``flat``, and where each of them ends."""
    kind = np.int32 if len(chosen) * (int(lengths.max(initial=0)) + 1) < 1 << 31 else np.int64
    starts = (np.cumsum(lengths) - lengths).astype(kind)
    sizes = lengths.astype(kind)[chosen]
    ends = np.cumsum(sizes, dtype=kind)
    places = np.arange(ends[-1] if len(ends) else 0, dtype=kind)
    places += np.repeat(starts[chosen] - (ends - sizes), sizes)
    return flat[places], ends


def last_bytes(strings: pa.Array, sizes: np.ndarray) -> pa.Array:
    """The last bytes of each string, so many as ``sizes`` says."""
    _, offsets, data = strings.buffers()
    after = np.frombuffer(offsets, np.int32)[strings.offset + 1 : strings.offset + 1 + len(strings)]
    ends = np.cumsum(sizes, dtype=np.int32)
    places = np.repeat(after - ends, sizes) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
    own = np.frombuffer(data, np.uint8)[places] if len(places) else np.zeros(0, np.uint8)
    return pa.StringArray.from_buffers(len(strings), pa.py_buffer(np.r_[np.int32(0), ends].astype(np.int32)), pa.py_buffer(own))


class Encoder:
    """Ids of texts, by way of their different pieces between blanks.

    Blanks end a word in this vocabulary, and so does ASCII punctuation after a letter,
    so words can be encoded apart from their text, each once for many texts. Words go through the tokenizer
    many at a time; the ids that end a word part them again. Other pieces go one by one, and so do those
    that hold a special token. Nothing is kept between calls.
    The tokenizer's own threads stay off, unless set otherwise: tasks share the cores already, and
    each thread keeps an arena of memory in each worker.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.vocabulary <= 60_000 else "<u4")
        self.end = np.array([end_id], self.dtype)
        self.ends_word = np.zeros(self.vocabulary, dtype=bool)
        self.ends_word[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def apart(self, strings: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """Ids of each string alone: arrays of ids, and the number of ids of each string."""
        found, sizes = [], []
        for i in range(0, len(strings), 2000):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(strings[i : i + 2000], add_special_tokens=False)]
            found.append(np.array([x for one in ids for x in one], self.dtype))
            sizes += map(len, ids)
        return found, sizes

    def words(self, words: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """The same for words of Latin letters, 500 of them joined by blanks."""
        found, sizes = [], []
        groups = [words[i : i + 500] for i in range(0, len(words), 500)]
        for i in range(0, len(groups), 20):
            some = groups[i : i + 20]
            for group, e in zip(some, self.tokenizer.encode_batch_fast([" ".join(g) for g in some], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, self.dtype)
                cuts = np.flatnonzero(self.ends_word[ids]) + 1
                if len(cuts) == len(group):
                    found.append(ids)
                    sizes += np.diff(np.r_[0, cuts]).tolist()
                else:
                    more, own = self.apart(group)
                    found += more
                    sizes += own
        return found, sizes

    def pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces, one after the other, and the number of ids of each piece."""
        stripped = pc.utf8_rtrim(pieces, TAIL)
        parted = pc.match_substring_regex(stripped, LATIN + r"\z")
        for token in self.special:
            parted = pc.and_not(parted, pc.match_substring(pieces, token))
        core = pc.if_else(parted, stripped, pieces)
        tail = last_bytes(pieces, pc.subtract(pc.binary_length(pieces), pc.binary_length(core)).to_numpy()).dictionary_encode()
        core = pc.if_else(pc.match_substring_regex(core, rf"\A{LATIN}+\z"), pc.utf8_lower(core), core).dictionary_encode()
        is_word = pc.match_substring_regex(core.dictionary, rf"\A{LATIN}+\z").to_numpy(zero_copy_only=False)
        place = np.empty(len(is_word), np.int64)
        place[is_word], place[~is_word] = np.arange(is_word.sum()), np.arange(is_word.sum(), len(is_word))
        found, sizes = self.words(core.dictionary.filter(pa.array(is_word)).to_pylist())
        others, own = self.apart(core.dictionary.filter(pa.array(~is_word)).to_pylist() + tail.dictionary.to_pylist())
        flat, sizes = np.concatenate([self.end[:0], *found, *others]), np.array(sizes + own, np.int64)
        both = np.stack([place[core.indices.to_numpy()], len(place) + tail.indices.to_numpy()], axis=1).ravel()
        flat, ends = gather(flat, sizes, both)
        return flat, np.diff(np.r_[0, ends[1::2]])

    def encode(self, texts) -> list[np.ndarray]:
        """Ids of each text, with the end id."""
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        after = np.cumsum(pc.list_value_length(split).to_numpy())  # pieces up to the end of each text
        coded = split.flatten().dictionary_encode()
        del split
        flat, lengths = self.pieces(coded.dictionary)
        chosen = np.insert(coded.indices.to_numpy(), after, len(lengths))
        del coded
        pa.default_memory_pool().release_unused()
        ids, ends = gather(np.r_[flat, self.end], np.r_[lengths, 1], chosen)
        return np.split(ids, ends[after + np.arange(len(after))][:-1]) if len(after) else []


def few_texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``TEXT_BYTES`` of text (the second column)."""
    run = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64)) // TEXT_BYTES
    cuts = np.flatnonzero(np.r_[True, run[1:] != run[:-1], True]) if len(run) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


# ---- grammar -------------------------------------------------------------------------


@dataclass
class Shard:
    vocabulary: int  # ids below are tokens, the others nonterminals in the order of the rules
    rules: np.ndarray  # (n, 2)
    lengths: np.ndarray  # ids that each nonterminal expands to
    symbols: np.ndarray
    doc_symbols: np.ndarray  # symbols of each document


def choose(keys: np.ndarray, counts: np.ndarray, shift: int, room: int) -> list[tuple[int, int]]:
    """Frequent pairs that can be replaced at once: no symbol is the left of one and the right of another."""
    top = np.lexsort((keys, -counts))[: 2 * room]
    role: dict[int, int] = {}
    found: list[tuple[int, int]] = []
    for key in keys[top].tolist():
        a, b = key >> shift, key & ((1 << shift) - 1)
        if a == b:
            ok = a not in role
            role.setdefault(a, 3)
        else:
            ok = role.get(a, 1) == 1 and role.get(b, 2) == 2
            if ok:
                role[a], role[b] = 1, 2
        if ok:
            found.append((a, b))
            if len(found) == room:
                break
    return found


def compress(ids: np.ndarray, doc_tokens: np.ndarray, vocabulary: int, rounds: int = 4, least: int = 8, per_round: int = 2000) -> Shard:
    """Re-Pair: in each round the most frequent pairs (``least`` times or more) become nonterminals.

    Works for any ids, also for equal neighbours (paired from the left) and empty shards.
    The rules stop where 16-bit symbols end when the vocabulary leaves room for that.
    """
    narrow = vocabulary <= 60_000
    wide, shift = (np.uint32, 16) if narrow else (np.uint64, 32)
    most = (1 << 16) - vocabulary if narrow else 1 << 24
    s = ids.astype(np.uint16 if narrow else np.uint32)
    ends = np.cumsum(doc_tokens) - 1  # last symbol of each document; documents aren't empty, for they end with an id
    rules: list[tuple[int, int]] = []
    for _ in range(rounds):
        room = min(per_round, most - len(rules))
        if len(s) < 2 or room <= 0:
            break
        key = (s[:-1].astype(wide) << wide(shift)) | s[1:]
        inside = np.ones(len(key), dtype=bool)
        inside[ends[ends < len(key)]] = False
        k = np.sort(key[inside])
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, int)
        counts = np.diff(np.r_[starts, len(k)])
        often = counts >= least
        pairs = choose(k[starts[often]], counts[often], shift, room)
        if not pairs:
            break
        first = vocabulary + len(rules)
        left, right = np.zeros(first, np.uint16), np.zeros(first, np.uint16)
        lefts, rights = sorted({a for a, _ in pairs}), sorted({b for _, b in pairs})
        left[lefts], right[rights] = np.arange(1, len(lefts) + 1), np.arange(1, len(rights) + 1)
        new = np.zeros((len(lefts) + 1, len(rights) + 1), s.dtype)
        a, b = np.array(pairs).T
        new[left[a], right[b]] = np.arange(first, first + len(pairs))
        la, rb = left[s[:-1]], right[s[1:]]
        at = np.flatnonzero((la > 0) & (rb > 0) & inside)
        made = new[la[at], rb[at]]
        at, made = at[made > 0], made[made > 0]
        # equal neighbours overlap: keep every second place of a run
        run = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1]) if len(at) else np.zeros(0, int)
        place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
        at, made = at[place % 2 == 0], made[place % 2 == 0]
        s[at] = made
        keep = np.ones(len(s), dtype=bool)
        keep[at + 1] = False
        ends = ends - np.searchsorted(at + 1, ends, side="right")
        s = s[keep]
        rules += pairs
    lengths = np.ones(vocabulary + len(rules), np.int64)
    for i, (a, b) in enumerate(rules, vocabulary):
        lengths[i] = lengths[a] + lengths[b]
    return Shard(vocabulary, np.array(rules, np.int64).reshape(-1, 2), lengths[vocabulary:], s, np.diff(np.r_[-1, ends]))


class Decoder:
    """Expands symbols of one shard; any slice of the symbols can be expanded alone."""

    def __init__(self, shard: Shard):
        self.shard = shard
        n = shard.vocabulary
        parts = [np.arange(n, dtype=np.uint32)]
        made: list[np.ndarray] = []
        one = lambda x: parts[0][x : x + 1] if x < n else made[x - n]
        for a, b in shard.rules.tolist():
            made.append(np.concatenate([one(a), one(b)]))
        self.flat = np.concatenate(parts + made)
        self.lengths = np.r_[np.ones(n, np.int64), shard.lengths]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        lengths = self.lengths[symbols]
        total = np.cumsum(lengths)
        shift = self.starts[symbols] - (total - lengths)
        return self.flat[np.repeat(shift, lengths) + np.arange(total[-1] if len(total) else 0)]

    def document(self, k: int) -> np.ndarray:
        """All ids of the k-th document of the shard."""
        at = int(self.shard.doc_symbols[:k].sum())
        return self.expand(self.shard.symbols[at : at + int(self.shard.doc_symbols[k])])

    def tokens(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start:stop`` of the k-th document; only the symbols that cover them are expanded."""
        at = int(self.shard.doc_symbols[:k].sum())
        symbols = self.shard.symbols[at : at + int(self.shard.doc_symbols[k])]
        ends = np.cumsum(self.lengths[symbols])
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b])[start - skipped : stop - skipped]


# ---- tables --------------------------------------------------------------------------


def write_shards(
    docs: DataFrame, path: str, end_id: int = 2, shard_tokens: int = 2_000_000, rounds: int = 4,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Encodes every text in ascending order of the key and stores the shards; ``path`` is the tokenizer's file.

    Null and empty texts have only the end id. Equal keys are ordered by a hash of the
    text, null keys come first. A shard ends after ``shard_tokens`` ids, so a task holds
    no more than that and one document. An empty table gives no shards.
    """
    d = texts(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = d.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches):
        from pyspark import TaskContext

        encoder = Encoder(path, end_id)  # gone with the task
        part, start, ids, doc_ids, sizes, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def close():
            tokens = np.concatenate(ids)
            shard = compress(tokens, np.array(sizes, np.int64), encoder.vocabulary, rounds)
            row = {
                "part": [part], "start_in_part": [start], "n_tokens": [len(tokens)], "doc_ids": [doc_ids], "doc_tokens": [sizes],
                "doc_symbols": [shard.doc_symbols.tolist()], "width": [encoder.dtype.itemsize], "vocabulary": [encoder.vocabulary],
                "rules": [shard.rules.astype(encoder.dtype).tobytes()], "lengths": [shard.lengths.astype("<u4").tobytes()],
                "symbols": [shard.symbols.astype(encoder.dtype).tobytes()],
            }
            kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.int32(), pa.int64(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

        for batch in batches:
            pairs = (x for r in few_texts(batch) for x in zip(r.column(0).to_pylist(), encoder.encode(r.column(1)), strict=True))
            for key, coded in pairs:
                ids.append(coded)
                doc_ids.append(key)
                sizes.append(len(coded))
                held += sizes[-1]
                if held >= shard_tokens:
                    yield close()
                    start, ids, doc_ids, sizes, held = start + held, [], [], [], 0
        if ids:
            yield close()

    return settle(ordered.select("doc_id", "text").mapInArrow(write, SHARD_SCHEMA), "tokens")


def load(row: dict) -> Decoder:
    """The decoder of one stored shard."""
    kind = np.dtype(f"<u{row['width']}")
    return Decoder(
        Shard(
            row["vocabulary"], np.frombuffer(row["rules"], kind).reshape(-1, 2).astype(np.int64), np.frombuffer(row["lengths"], "<u4").astype(np.int64),
            np.frombuffer(row["symbols"], kind), np.array(row["doc_symbols"], np.int64),
        )
    )


def read_documents(shards: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, on request, the ids, decoded from the stored shards.

    The number of ids before a shard comes from the shards' sums: one row for each
    written partition, so few, and shared as a broadcast.
    """
    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = load(row)
                ids = ids.expand(ids.shard.symbols)
                ends = np.cumsum(row["doc_tokens"])
                cut = [ids[b - n : b] for n, b in zip(row["doc_tokens"], ends.tolist(), strict=True)]
                out = {
                    "part": pa.array([row["part"]] * len(cut), pa.int32()), "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "at": pa.array(row["start_in_part"] + ends - row["doc_tokens"], pa.int64()), "n_tokens": pa.array(row["doc_tokens"], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in cut], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array([x.tolist() for x in cut], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    sums = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sums.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    found = shards.mapInArrow(read, schema).join(F.broadcast(before), "part")
    return found.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
