"""A trigram model in Elias-Fano tries, learnt from and asked by whole corpora.

Levels are learnt in order: words, pairs, triples. Chunks of documents send their distinct
grams with counts to shards; a shard adds the counts up, smooths them, stores its part of the
level as a trie and answers the same chunks out of it. A pair's shard goes by its first word and
a triple's by its middle word, so that a word's successors lie together; contexts too frequent
for one shard are split further (by the earlier word, then by the last).

A trie's level holds monotone sequences only: context words, pointers to where each context's
successors start, the successors, and sums of counts. A triple's last word is stored relative to its middle word: as its
place among that word's successors. Probabilities are quantised to 1/2048 of a decade, and a
level is one flat buffer, viewed in place whether it is a cell or a memory-mapped file.

Smoothing is by Dirichlet priors: p(w|h) = (c(hw) + m p(w|h')) / (c(h) + m), so the
probabilities of all words after a context sum to 1 (unknown words share one place).
"""

from __future__ import annotations

import gc
import itertools
import time
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepflow.sources.scratch import discard, settle_at

from .common import LOWER, mixed, texts
from .elias_fano import EliasFano, distinct_keys
from .exchange import CHUNK, answer, ask, chunk_name, expand, merge, narrow, pack, squeeze, view

END, START = np.uint64(1), np.uint64(2)  # stand for the end of a text and the place before it
STEPS = 2048  # quantised steps in a decade
MISS = 0xFFFF
PIECE = 250_000  # occurrences of a context that one shard takes
U = np.uint64


def coded(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-STEPS * np.log10(p)), MISS - 1).astype(np.uint16)


def decoded(code: np.ndarray) -> np.ndarray:
    return -code.astype(np.float64) / STEPS


def dealt(keys: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each hash."""
    return ((keys >> U(32)) * U(shards)) >> U(32)


def word_shard(words: np.ndarray, shards: int) -> np.ndarray:
    return dealt(words, shards)


def pair_shard(h: np.ndarray, w: np.ndarray, count_h: np.ndarray, shards: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        part = mixed(w) % (U(1) + count_h.astype(U) // U(PIECE))
        return dealt(mixed(h * U(0x9E3779B97F4A7C15) + part), shards)


def triple_shard(h2: np.ndarray, h1: np.ndarray, w: np.ndarray, count_h1: np.ndarray, count_h: np.ndarray, shards: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        early = mixed(h2) % (U(1) + count_h1.astype(U) // U(PIECE))
        late = mixed(w) % (U(1) + count_h.astype(U) // U(PIECE))
        return dealt(mixed((h1 * U(0x9E3779B97F4A7C15) + early) * U(0xD6E8FEB86659FD93) + late), shards)


# ---- levels of the trie ----------------------------------------------------------------


def sums(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(np.r_[U(0), counts.astype(U)], dtype=U)


def flat(sequences: list[np.ndarray], extra: list[np.ndarray]) -> bytes:
    """Elias-Fano sequences and plain arrays as one buffer."""
    return pack([x for s in sequences for x in EliasFano.encode(s)] + extra)


class Words:
    """Level 1: hashes of the words, and their counts; a word's number is its place."""

    def __init__(self, buffer):
        a = view(buffer)
        self.words, self.counts = (EliasFano(*a[i : i + 3]) for i in (0, 3))

    @staticmethod
    def build(words: np.ndarray, counts: np.ndarray) -> bytes:
        return flat([words, sums(counts)], [])

    def ranks(self) -> np.ndarray:
        """The rank of each word by falling count: small numbers for frequent words take less room in questions."""
        order = np.argsort(-np.diff(self.counts.access(np.arange(self.words.n + 1)).astype(np.int64)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return rank

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place (-1: unknown) and count of each word."""
        at = self.words.find(words)
        return at, spans(self.counts, at)


def spans(prefix: EliasFano, at: np.ndarray) -> np.ndarray:
    """Differences of neighbouring sums at places ``at``; 0 at -1."""
    out = np.zeros(len(at), U)
    known = np.flatnonzero(at >= 0)
    if len(known):
        out[known] = prefix.access(at[known] + 1) - prefix.access(at[known])
    return out


class Pairs:
    """Level 2: contexts, pointers to their successors, the successors, counts and probabilities."""

    def __init__(self, buffer):
        a = view(buffer)
        self.words, self.heads, self.starts, self.successors, self.counts = (EliasFano(*a[i : i + 3]) for i in range(0, 15, 3))
        self.codes, self.wide = a[15], U(self.words.n)

    @staticmethod
    def build(h: np.ndarray, w: np.ndarray, counts: np.ndarray, p: np.ndarray) -> bytes:
        """Entries sorted by (h, w), distinct."""
        words = np.unique(np.concatenate([h, w]))
        heads, first, head = np.unique(h, return_index=True, return_inverse=True)
        successors = head.astype(U) * U(len(words)) + np.searchsorted(words, w).astype(U)
        return flat([words, np.searchsorted(words, heads).astype(U), np.r_[first, len(h)].astype(U), successors, sums(counts)], [coded(p)])

    def place(self, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the context, place of the pair), -1 where absent."""
        word, (of_h, of_w) = numbers_of(self.words, [h, w])
        head, word = search(self.heads, word)[of_h], word[of_w]
        pair = np.full(len(h), -1, np.int64)
        both = np.flatnonzero((head >= 0) & (word >= 0))
        pair[both] = self.successors.find(head[both].astype(U) * self.wide + word[both].astype(U))
        return head, pair

    def find(self, h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (0: absent) and quantised probability of each pair."""
        _, at = self.place(h, w)
        return spans(self.counts, at), np.where(at >= 0, self.codes[np.maximum(at, 0)], MISS).astype(np.uint16) if len(self.codes) else np.full(len(at), MISS, np.uint16)


def numbers_of(words: EliasFano, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(places of the distinct words of a batch, the index of each column's entries among them)."""
    some, index = distinct_keys(np.concatenate(columns))
    return words.find(some), np.split(index, np.cumsum([len(c) for c in columns])[:-1])


def search(sequence: EliasFano, at: np.ndarray) -> np.ndarray:
    """``find`` that lets -1 stay."""
    out = np.full(len(at), -1, np.int64)
    known = np.flatnonzero(at >= 0)
    out[known] = sequence.find(at[known].astype(U))
    return out


class Triples:
    """Level 3: below each middle word its successors and its earlier words; below each earlier word
    the last words, as places among the middle word's successors."""

    def __init__(self, buffer):
        a = view(buffer)
        self.words, self.heads, self.starts, self.successors, self.contexts, self.bases, self.lasts = (EliasFano(*a[i : i + 3]) for i in range(0, 21, 3))
        self.codes, self.wide = a[21], U(self.words.n)

    @staticmethod
    def build(h2: np.ndarray, h1: np.ndarray, w: np.ndarray, p: np.ndarray) -> bytes:
        """Entries sorted by (h1, h2, w), distinct."""
        words, index = distinct_keys(np.concatenate([h2, h1, w]))
        wide, (early, middle, last) = U(len(words)), index.astype(U).reshape(3, -1)
        heads, head = distinct_keys(middle)
        head = head.astype(U)
        below = head * wide + last
        successors, place = distinct_keys(below)
        starts = np.searchsorted(successors, np.arange(len(heads) + 1, dtype=U) * wide).astype(U)
        contexts, context = distinct_keys(head * wide + early)
        fan = np.diff(starts)[(contexts // wide).astype(np.int64)] if len(contexts) else np.zeros(0, U)
        bases = sums(fan)  # context number i owns the values from bases[i] to bases[i + 1] - 1
        relative = place.astype(U) - starts[head.astype(np.int64)]
        return flat([words, heads, starts, successors, contexts, bases, bases[context] + relative], [coded(p)])

    def find(self, h2: np.ndarray, h1: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The quantised probability of each triple; MISS where it is absent."""
        out = np.full(len(w), MISS, np.uint16)
        word, (of_h2, of_h1, of_w) = numbers_of(self.words, [h2, h1, w])
        head, early, last = search(self.heads, word)[of_h1], word[of_h2], word[of_w]
        at = np.flatnonzero((head >= 0) & (early >= 0) & (last >= 0))
        under = head[at].astype(U) * self.wide
        context, successor = self.contexts.find(under + early[at].astype(U)), self.successors.find(under + last[at].astype(U))
        both = (context >= 0) & (successor >= 0)
        at, context, successor = at[both], context[both], successor[both]
        if len(at):
            relative = successor.astype(U) - self.starts.access(head[at])
            found = self.lasts.find(self.bases.access(context) + relative)
            out[at[found >= 0]] = self.codes[found[found >= 0]]
        return out


# ---- chunks ----------------------------------------------------------------------------


class Places(dict):
    """Numbers of the words of a chunk as they come, after those of END (0) and START (1)."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self) + 2
        return place


def read_chunks(docs: DataFrame, chunk_tokens: int) -> DataFrame:
    """docs: doc_id, text, learn. Chunks of whole documents: doc_ids, whether null, learnt, lengths, hashes of the words (END, START, then as they come; none after the first level), tokens (places in words)."""

    def run(batches):
        known, keys, learnt, held, size, number = Places(), [], [], [], 0, 0

        def close():
            hashes = np.array([END, START, *map(xxhash.xxh64_intdigest, known)], U)
            keyed = np.array([0 if k is None else k for k in keys], np.int64)
            lengths = np.array([len(x) for x in held], np.int64)
            arrays = [keyed, np.array([k is None for k in keys], np.uint8), np.array(learnt, np.uint8), narrow(lengths), hashes, narrow(np.concatenate(held))]
            trained = int(lengths[arrays[2] > 0].sum())
            return pa.RecordBatch.from_arrays([pa.array([chunk_name(number)]), pa.array([squeeze(arrays)], pa.binary()), pa.array([trained])], names=["chunk", "body", "trained"])

        for batch in batches:
            for key, text, learn in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = text.as_py().encode().translate(LOWER).split()
                held.append(np.fromiter(itertools.chain(map(known.__getitem__, words), (0,)), np.int64, len(words) + 1))
                keys.append(key)
                learnt.append(learn)
                size += len(held[-1])
                if size >= chunk_tokens:
                    yield close()
                    known, keys, learnt, held, size, number = Places(), [], [], [], 0, number + 1
        if held:
            yield close()

    return docs.select("doc_id", "text", "learn").mapInArrow(run, CHUNK + ", trained long")


class Chunk:
    """Arrays of a chunk at any stage; grams and their order are derived again, always alike."""

    def __init__(self, arrays: list[np.ndarray]):
        self.arrays = arrays
        self.keys, self.no_key, self.learnt, lengths, self.hashes, tokens = arrays[:6]
        self.lengths, self.tokens = lengths.astype(np.int64), tokens.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.weight = np.repeat(self.learnt, self.lengths).astype(np.int64)
        if len(arrays) > 6:
            self.numbers, self.counts = (a.astype(U) for a in arrays[6:8])  # number 0: unknown
        if len(arrays) > 8:
            self.pair_counts, self.pair_codes = arrays[8].astype(U), arrays[9].astype(np.uint16)

    def before(self) -> np.ndarray:
        """The word before each token."""
        h = np.r_[0, self.tokens[:-1]]
        h[self.starts] = 1  # START
        return h

    def pairs(self):
        """(context word, word, learnt count) of the distinct pairs, and each token's pair."""
        wide = len(self.numbers)
        keys, pair = distinct_keys(self.before() * wide + self.tokens)
        keys = keys.astype(np.int64)
        return keys // wide, keys % wide, np.bincount(pair, self.weight, len(keys)).astype(U), pair

    def triples(self, pair: np.ndarray, n_pairs: int):
        """(earlier pair, pair, learnt count) of the distinct triples, each token's triple, and the tokens that have one."""
        inner = np.ones(len(self.tokens), bool)
        inner[self.starts] = False
        at = np.flatnonzero(inner)
        keys, triple = distinct_keys(pair[at - 1] * n_pairs + pair[at])
        keys = keys.astype(np.int64)
        return keys // max(1, n_pairs), keys % max(1, n_pairs), np.bincount(triple, self.weight[at], len(keys)).astype(U), triple, at


def word_questions(shards: int):
    def entries(arrays):
        c = Chunk(arrays)
        counts = np.bincount(c.tokens, c.weight, len(c.hashes)).astype(U)
        counts[1] = int(c.learnt.sum())
        order = np.argsort(c.hashes)  # by hash, so by shard
        return word_shard(c.hashes[order], shards), [c.hashes[order], counts[order]]

    return entries


def by_shard(shard: np.ndarray, shards: int) -> np.ndarray:
    """A stable order; narrow integers are sorted by radix."""
    return np.argsort(shard.astype(np.uint16 if shards <= 1 << 16 else U), kind="stable")


def pair_entries(c: Chunk, shards: int):
    """Shards of the pairs that can be known, the order by shard, and all pairs."""
    h, w, counts, pair = c.pairs()
    known = np.flatnonzero((c.numbers[h] > 0) & (c.numbers[w] > 0))
    shard = pair_shard(c.numbers[h[known]], c.numbers[w[known]], c.counts[h[known]], shards)
    order = by_shard(shard, shards)
    return shard[order], known[order], h, w, counts, pair


def pair_questions(shards: int):
    def entries(arrays):
        c = Chunk(arrays)
        shard, at, h, w, counts, _ = pair_entries(c, shards)
        return shard, [c.numbers[h[at]], c.numbers[w[at]], counts[at], c.counts[h[at]], c.counts[w[at]]]

    return entries


def triple_entries(c: Chunk, shards: int):
    h, w, _, pair = c.pairs()
    early, late, counts, triple, at = c.triples(pair, len(h))
    known = np.flatnonzero((c.pair_counts[early] > 0) & (c.pair_counts[late] > 0))
    e, l = early[known], late[known]
    h2, h1, last = c.numbers[h[e]], c.numbers[h[l]], c.numbers[w[l]]
    shard = triple_shard(h2, h1, last, c.counts[h[l]], c.pair_counts[e], shards)
    order = by_shard(shard, shards)
    columns = [h2[order], h1[order], last[order], counts[known[order]], c.pair_counts[e[order]], c.pair_codes[l[order]]]
    return shard[order], known[order], columns, (h, w, pair, early, late, triple, at)


def triple_questions(shards: int):
    def entries(arrays):
        shard, _, columns, _ = triple_entries(Chunk(arrays), shards)
        return shard, columns

    return entries


# ---- shards ----------------------------------------------------------------------------


def distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each distinct entry in sorted order, each row's entry); columns too wide for one word are ranked first."""
    if sum(int(c.max(initial=0)).bit_length() for c in columns) > 64:
        columns = [distinct_keys(c)[1].astype(U) for c in columns]
    key = np.zeros(len(columns[0]), U)
    for c in columns:
        key = (key << U(int(c.max(initial=0)).bit_length())) | c
    _, entry = distinct_keys(key)
    row = np.empty(int(entry.max(initial=-1)) + 1, np.int64)
    row[entry] = np.arange(len(entry))
    return row, entry


def added(counts: np.ndarray, entry: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(entry, counts.astype(np.float64), n).astype(U)  # exact below 2^53


def word_replies(shards: int):
    def reply(shard, columns, level):
        words, counts = columns
        row, entry = distinct([words])
        words, total, grams = words[row], added(counts, entry, len(row)), 0
        if level is None:
            some = total > 0
            level = Words.build(words[some], total[some])
            grams = int(some.sum()) - int((words[some] == START).sum())
        known = Words(level)
        at, count = known.find(words)
        number = np.where(at >= 0, known.ranks()[at] * shards + shard + 1, 0).astype(U) if known.words.n else np.zeros(len(words), U)
        return [number[entry], count[entry]], level, grams

    return reply


def pair_replies(n: int, v: int, prior: float):
    def reply(_, columns, level):
        row, entry = distinct(columns[:2])
        h, w, _, of_h, of_w = (c[row] for c in columns)
        total, some = added(columns[2], entry, len(row)), []
        if level is None:
            some = np.flatnonzero(total > 0)
            below = (of_w[some] + 0.1) / (n + 0.1 * (v + 1))
            level = Pairs.build(h[some], w[some], total[some], (total[some] + prior * below) / (of_h[some] + prior))
        count, code = Pairs(level).find(h, w)
        return [count[entry], code[entry]], level, len(some)

    return reply


def triple_replies(prior: float):
    def reply(_, columns, level):
        row, entry = distinct([columns[1], columns[0], columns[2]])
        h2, h1, w, _, of_h, below = (c[row] for c in columns)
        total, some = added(columns[3], entry, len(row)), []
        if level is None:
            some = np.flatnonzero(total > 0)
            p = (total[some] + prior * 10 ** decoded(below[some])) / (of_h[some] + prior)
            level = Triples.build(h2[some], h1[some], w[some], p)
        return [Triples(level).find(h2, h1, w)[entry]], level, len(some)

    return reply


# ---- the model -------------------------------------------------------------------------

SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double, learn boolean"


@dataclass
class Model:
    """What ``fit`` learnt: levels (words, pairs, triples), each a table of shard, body (the trie) and number (of grams)."""

    levels: dict[str, DataFrame]
    shards: int
    n_tokens: int
    n_words: int
    priors: tuple[float, float]


def fit(
    docs: DataFrame, learn: str = "true", priors: tuple[float, float] = (50.0, 5.0), chunk_tokens: int = 1_000_000, shard_tokens: int = 500_000,
    id_col: str = "doc_id", text_col: str = "text", keep_levels: bool = True,
) -> tuple[Model, DataFrame]:
    """A model of the rows where the SQL condition ``learn`` on (doc_id, text) is true, and the scores of all rows under it.

    Scores: doc_id, n_tokens, n_known, base_score, score, learn. Tokens are the words ``[^\\x20\\x09-\\x0D]+`` after
    lowering A-Z, then one end. base_score sums log10((c + 0.1) / (N + 0.1 (V + 1))); score is the trigram model's log10 probability.
    Without ``keep_levels`` a shard's trie lives only in the task that answers from it, and the model has no levels.

    Null and empty texts are the end alone. A null ``learn`` counts as false (so does a null key, if it decides). Repeated rows
    count each time. An empty table gives no rows; without learnt rows every word is unknown and takes the one place for
    unknown words. Other columns are ignored. A document of any length lies in one chunk. Words are
    named by 64-bit hashes; two of a billion words share one with a chance of 3 percent.
    """
    d = texts(docs, id_col, text_col).withColumn("learn", F.coalesce(F.expr(learn), F.lit(False)))
    return run_levels(d, None, priors, chunk_tokens, shard_tokens, keep_levels)


def score(docs: DataFrame, model: Model, chunk_tokens: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of other documents under a fitted model, from its stored levels; columns and cases as in ``fit``, learn is false."""
    d = texts(docs, id_col, text_col).withColumn("learn", F.lit(False))
    return run_levels(d, model, model.priors, chunk_tokens, 1, False)[1]


def run_levels(d: DataFrame, model: Model | None, priors, chunk_tokens: int, shard_tokens: int, keep_levels: bool) -> tuple[Model, DataFrame]:
    spark = d.sparkSession
    chunks, at = settle_at(read_chunks(d, chunk_tokens), "chunks")
    n = model.n_tokens if model else chunks.agg(F.sum("trained")).first()[0] or 0
    shards = model.shards if model else max(1, -(-n // shard_tokens))
    stored, levels = model.levels if model else {}, {}

    def level(name: str, questions, replies, join, schema: str, label: str):
        nonlocal chunks, at
        answers, place = settle_at(answer(ask(chunks, questions), replies, keep_levels, stored.get(name)), name, ("level",))
        grams = model.n_words if model else answers.agg(F.sum("number")).first()[0] or 0
        release(spark)  # of the questions
        chunks, at, old = *settle_at(merge(chunks, answers.where("level = 0"), join(grams), schema), label), at
        discard(spark, old, place + "/level=0")
        levels[name] = answers.where("level = 1").select("shard", "body", "number")
        release(spark)
        return grams

    v = level("words", word_questions(shards), word_replies(shards), lambda _: keep_state, CHUNK, "chunks")
    level("pairs", pair_questions(shards), pair_replies(n, v, priors[0]), lambda _: keep_pairs(shards), CHUNK, "chunks")
    level("triples", triple_questions(shards), triple_replies(priors[1]), lambda _: final_scores(shards, n, v, priors), SCORES, "scores")
    return Model(levels if keep_levels else {}, shards, n, v, priors), chunks


def release(spark) -> None:
    """Lets the driver's JVM collect frames no longer in use, upon which Spark removes their shuffle files."""
    for _ in range(2):  # frames let go on this side reach the JVM with a delay
        gc.collect()
        time.sleep(0.5)
        spark.sparkContext._jvm.System.gc()


def frame(chunk: int, arrays: list[np.ndarray]):
    import pandas as pd

    return pd.DataFrame({"chunk": [chunk], "body": [squeeze(arrays)]})


def keep_state(chunk, arrays, replies):
    order, placed = np.argsort(arrays[4]), [np.zeros(len(arrays[4]), U) for _ in replies]
    for into, reply in zip(placed, replies, strict=True):
        into[order] = reply
    return frame(chunk, [*arrays[:4], arrays[4][:0], arrays[5], *map(narrow, placed)])


def keep_pairs(shards: int):
    def join(chunk, arrays, replies):
        c = Chunk(arrays)
        _, at, h, *_ = pair_entries(c, shards)
        counts, codes = np.zeros(len(h), U), np.full(len(h), MISS, np.uint16)
        if replies:
            counts[at], codes[at] = replies
        return frame(chunk, [*arrays, narrow(counts), codes])

    return join


def final_scores(shards: int, n: int, v: int, priors: tuple[float, float]):
    def join(_, arrays, replies):
        import pandas as pd

        c = Chunk(arrays)
        _, known, _, (h, w, pair, early, late, triple, at) = triple_entries(c, shards)
        one = np.log10((c.counts + 0.1) / (n + 0.1 * (v + 1)))
        two = np.where(c.pair_counts > 0, decoded(c.pair_codes), np.log10(priors[0] / (c.counts[h] + priors[0])) + one[w])
        three = np.log10(priors[1] / (c.pair_counts[early] + priors[1])) + two[late]
        if replies:
            hit = replies[0] != MISS
            three[known[hit]] = decoded(replies[0][hit])
        score = two[pair]
        score[at] = three[triple]
        base = one[c.tokens]
        total = lambda x: np.add.reduceat(x, c.starts)  # noqa: E731  (no document is empty)
        return pd.DataFrame(
            {
                "doc_id": pd.array([None if gone else k for k, gone in zip(c.keys.tolist(), c.no_key.tolist(), strict=True)], "Int64"), "n_tokens": c.lengths,
                "n_known": total((c.counts[c.tokens] > 0).astype(np.int64)), "base_score": total(base), "score": total(score), "learn": c.learnt > 0,
            }
        )

    return join
