"""Repeated passages across all texts, through one FM-index for each shard.

A window is a run of consecutive words; it is repeated if the same words also start
anywhere else. Windows are sent to shards by their minimizer, the run of a few words with
the smallest hash in them: equal windows have equal minimizers, so all their occurrences
meet in one shard, and neighbouring windows with one minimizer travel as one segment.
Segments whose minimizer occurs once are dropped before any text moves, and equal segments
are sent once with their number. A shard builds an FM-index over its segments and matches
each of them against it by backward search.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grams, mixed, settle, texts, word_hashes
from .fm_index import FMIndex

ANCHOR = 8  # words of a minimizer
RUN_BYTES = 1_000_000  # of texts that are cut together
BASE = 0x9FB21C651E98DF25  # odd, of the segments' hashes


def leftmost_minima(values: np.ndarray, span: int) -> np.ndarray:
    """The place of the smallest value (the leftmost one) in each run of ``span``."""
    at, width = np.arange(len(values)), 1
    while 2 * width <= span:
        a, b = at[: len(at) - width], at[width:]
        at = np.where(values[a] <= values[b], a, b)
        width *= 2
    if width < span:
        a, b = at[: len(at) - (span - width)], at[span - width :]
        at = np.where(values[a] <= values[b], a, b)
    return at


def cut(ids: np.ndarray, begin: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, text, first word, words) of each segment: the windows of a text that share one minimizer, together.

    ``ids`` has the words of texts that follow each other, ``begin`` where each begins and, last, their number.
    """
    none = np.zeros(0, np.int64)
    if len(ids) < window:
        return none.astype(np.uint64), none, none, none
    values = grams(ids, anchor)
    at = leftmost_minima(values, window - anchor + 1)
    new = np.ones(len(at) + 1, dtype=bool)
    new[1:-1] = at[1:] != at[:-1]
    long = np.diff(begin) >= window
    new[begin[:-1][long]] = True
    new[begin[1:][long] - window + 1] = True  # after the last window of a text
    edges = np.flatnonzero(new)
    first, last = edges[:-1], edges[1:] - 1
    text = np.searchsorted(begin, first, "right") - 1
    whole = first + window <= begin[text + 1]  # others reach into the next text
    first, last, text = first[whole], last[whole], text[whole]
    return values[at[first]], text, first, last - first + window


def powers_of(base: int, n: int) -> np.ndarray:
    """The first n powers of a number, modulo 2 ** 64."""
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def segment_hashes(ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of the words of each segment, from running sums of the words times powers of an odd number."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(mixed(ids) * powers_of(BASE, len(ids)), out=sums[1:])
        inverse = powers_of(pow(BASE, -1, 1 << 64), len(ids) + 1)
        return mixed((sums[first + length] - sums[first]) * inverse[first] + length.astype(np.uint64))


def segments(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(gram, seg, rid, place) for every segment; place holds the first word and the number of words."""

    def run(batches):
        for batch in batches:
            bounds = np.cumsum(pc.binary_length(batch.column(1)).to_numpy().astype(np.int64) + 1)
            run = bounds // RUN_BYTES
            edges = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1], [True]])) if len(run) else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                words, starts = word_hashes("\n".join(batch.column(1).slice(a, b - a).to_pylist()).encode())
                ends = np.searchsorted(starts, bounds[a:b] - (bounds[a - 1] if a else 0))
                begin = np.concatenate([[0], ends])
                gram, text, first, length = cut(words, begin, window, anchor)
                if len(gram):
                    seg = segment_hashes(words, first, length)
                    rid = batch.column(0).to_numpy()[a:b][text]
                    columns = gram.view(np.int64), seg.view(np.int64), rid, (first - begin[text]) << 24 | length
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["gram", "seg", "rid", "place"])

    return docs.select("rid", "text").mapInArrow(run, "gram long, seg long, rid long, place long")


class KeyFilter:
    """A bitmap of hashed keys: never misses one, and is at most ``most_bits`` (a power of two) large."""

    def __init__(self, keys: DataFrame, key: str, most_bits: int = 1 << 27):
        n = keys.count()
        self.bits = max(1 << 20, min(most_bits, 1 << (16 * n).bit_length()))
        rows = keys.select(self.column(key).alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
        rows = rows.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("map"))
        found = bytearray((self.bits // 32768 + 1) * 4096)
        for r in rows.toLocalIterator():
            at = (r["bucket"] - 1) * 4096
            found[at : at + 4096] = r["map"]
        self.sent = keys.sparkSession.sparkContext.broadcast(bytes(found))

    def column(self, key: str):
        """A row's bit, counted from 1, to be looked up by ``may_hold``."""
        return F.pmod(F.xxhash64(key, F.lit("bit")), F.lit(self.bits)) + 1


def may_hold(found: np.ndarray, bit: np.ndarray) -> np.ndarray:
    at = bit - 1
    return (found[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def only_held(docs: DataFrame, keys: KeyFilter, keep_others: bool) -> DataFrame:
    """doc_id, rid and text of rows that may hold a key; others are dropped, or kept with their digest instead of the text."""
    sent = keys.sent
    schema = "doc_id long, rid long, text string, n_words long, digest string"

    def run(batches):
        found = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            held = may_hold(found, batch.column(3).to_numpy())
            if not keep_others:
                batch = batch.filter(pa.array(held))
                empty = pa.nulls(batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), empty.cast(pa.int64()), empty.cast(pa.string())],
                    names=["doc_id", "rid", "text", "n_words", "digest"],
                )
                continue
            text, n_words, digest = batch.column(2).to_pylist(), [None] * len(held), [None] * len(held)
            for i in np.flatnonzero(~held).tolist():
                words = text[i].encode().split()
                n_words[i], digest[i], text[i] = len(words), hashlib.sha256(b" ".join(words)).hexdigest(), None
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(n_words, pa.int64()), pa.array(digest, pa.string())],
                names=["doc_id", "rid", "text", "n_words", "digest"],
            )

    return docs.select("doc_id", "rid", "text", keys.column("rid").alias("bit")).mapInArrow(run, schema)


def shard_rows(docs: DataFrame, chosen: DataFrame, window: int, anchor: int, hot: int) -> DataFrame:
    """(key, gram, seg, off, copies, words) of the chosen segments, cut from their texts.

    A minimizer with more than ``hot`` different segments would overload its shard: its
    segments travel as single windows, each to the shard of its own hash.
    """
    listed = chosen.groupBy("rid").agg(F.collect_list(F.struct("gram", "seg", "place", "copies", "variants")).alias("segs"))
    filtered = only_held(docs, KeyFilter(listed, "rid"), keep_others=False).dropDuplicates(["rid"])
    joined = filtered.join(listed, "rid").select("text", "segs")

    def run(batches):
        for batch in batches:
            out = []
            for text, segs in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words, _ = word_hashes(text.as_py().encode())
                for s in segs:
                    first, length = s["place"] >> 24, s["place"] & 0xFFFFFF
                    own = words[first : first + length]
                    if s["variants"] <= hot:
                        out.append((s["gram"], s["gram"], s["seg"], 0, s["copies"], own.tobytes()))
                    else:
                        for i, h in enumerate(grams(own, window).view(np.int64).tolist()):
                            out.append((h, s["gram"], s["seg"], i, s["copies"], own[i : i + window].tobytes()))
            kinds = [pa.int64()] * 5 + [pa.binary()]
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["key", "gram", "seg", "off", "copies", "words"]
            )

    return joined.mapInArrow(run, "key long, gram long, seg long, off long, copies long, words binary")


def match_shards(rows: DataFrame, window: int, shard_words: int) -> DataFrame:
    """(gram, seg, first, last): runs of repeated windows in each segment, by their first words, found in the shards' indexes.

    Keys are dealt to tasks by their hash; a task cuts its keys, in order, into shards of
    about ``shard_words`` words, never within a key.
    """
    ordered = rows.repartition("key").sortWithinPartitions("key")

    def run(batches):
        held, size, last = [], 0, None

        def close():
            words = [np.frombuffer(r[4], np.uint64) for r in held]
            index = FMIndex(words, np.array([r[3] for r in held], np.int64), max(map(len, words)))  # a match may be a whole segment
            seg, first, end = index.repeated_windows(window)
            own = [held[i] for i in seg.tolist()]
            off = np.array([r[2] for r in own], np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in own], pa.int64()), pa.array([r[1] for r in own], pa.int64()), pa.array(first + off, pa.int64()), pa.array(end + off, pa.int64())],
                names=["gram", "seg", "first", "last"],
            )

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for key, *row in zip(*columns, strict=True):
                if size >= shard_words and key != last:
                    yield close()
                    held, size = [], 0
                held.append(row)
                size += len(row[4]) // 8
                last = key
        if held:
            yield close()

    return ordered.select("key", "gram", "seg", "off", "copies", "words").mapInArrow(run, "gram long, seg long, first long, last long")


def repeated_runs(docs: DataFrame, window: int, anchor: int, shard_words: int, hot: int) -> DataFrame:
    """(rid, runs): for each text with repeated windows, (first, last) window starts as first << 32 | last. ``docs`` has rid and text.

    As numbers, runs that came more than once are told apart by a hash; structs would be compared pair by pair.
    """
    found = settle(segments(docs, window, anchor), "segments")
    often = found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    often = settle(often, "shared-grams")  # a plain side, so that the join below can split a hot minimizer
    found = settle(found.join(often, "gram"), "shared-segments")
    once = found.groupBy("gram", "seg").agg(F.count("*").alias("copies"), F.first("rid").alias("rid"), F.first("place").alias("place"))
    once = settle(once, "distinct-segments")
    variants = once.groupBy("gram").agg(F.count("*").alias("variants"))
    rows = shard_rows(docs, once.join(variants, "gram"), window, anchor, hot)
    runs = settle(match_shards(rows, window, shard_words), "matches")
    runs = runs.groupBy("gram", "seg").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    shift = F.expr("transform(runs, x -> shiftleft(shiftright(place, 24) + x.first, 32) | (shiftright(place, 24) + x.last))")
    placed = found.join(runs, ["gram", "seg"]).select("rid", shift.alias("runs"))
    return placed.groupBy("rid").agg(F.array_distinct(F.flatten(F.collect_list("runs"))).alias("runs"))


def remove_repeats(
    docs: DataFrame, window: int = 35, anchor: int = ANCHOR, shard_words: int = 1_000_000, hot: int = 4000,
    id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
) -> DataFrame:
    r"""doc_id, n_words, n_removed, kept_sha256 and the removed spans (first word, word after) of each row.

    Words are ``[^\x20\x09-\x0D]+``, unchanged. A word is removed if any window over it is
    repeated, in the same row or another; with ``with_text`` the kept words follow. Null,
    empty and short texts lose nothing. Repeated rows repeat each other. An empty table
    gives an empty result.
    """
    d = texts(docs, id_col, text_col).withColumn("rid", F.xxhash64("doc_id", "text"))
    runs = settle(repeated_runs(d, window, anchor, shard_words, hot), "runs")
    if with_text:
        rows = d.selectExpr("doc_id", "rid", "text", "cast(null AS long) AS n_words", "cast(null AS string) AS digest")
    else:  # only texts that may lose words meet their runs
        rows = only_held(d, KeyFilter(runs, "rid"), keep_others=True)
    joined = rows.join(runs, "rid", "left").select("doc_id", "text", "n_words", "digest", "runs")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first:long,after:long>>"

    def finish(batches):
        for batch in batches:
            out = []
            for key, text, n, digest, runs in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                spans, kept = [], None
                if digest is None:
                    words = text.encode().split()
                    gone = np.zeros(len(words) + 1, np.int64)
                    run = np.array(runs or (), np.int64)
                    np.add.at(gone, run >> 32, 1)
                    np.subtract.at(gone, (run & 0xFFFFFFFF) + window, 1)
                    gone = np.cumsum(gone)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                    spans = [{"first": a, "after": b} for a, b in edge.reshape(-1, 2).tolist()]
                    kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                    n, digest = len(words), hashlib.sha256(kept).hexdigest()
                row = (key, n, sum(s["after"] - s["first"] for s in spans), digest, spans)
                out.append(row + ((kept.decode() if kept is not None else None),) if with_text else row)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))]
            kinds += [pa.string()] * with_text
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "text"][: len(kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return joined.mapInArrow(finish, schema + (", text string" if with_text else ""))


REPEATS_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM d),
x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM p),
r AS (SELECT doc_id, i FROM x WHERE h IN (SELECT h FROM x GROUP BY h HAVING count(*) > 1)),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
l AS (SELECT doc_id, list(j) AS gone FROM g GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: NOT list_contains(gone, z[2])), lambda z: z[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN l USING (doc_id)
"""
