"""The text operators against plain Python, on awkward rows and on the smallest table."""

import collections
import gzip
import hashlib
import io
import random
import re
import struct
import warnings
import zipfile
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepflow.llm import archives, decontaminate, fm_index, licenses, mixing, pii, quality, set_join, substrings, tokens, toxicity
from prepflow.llm.common import word_hashes
from prepflow.llm.queries import vocabulary

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, node string, words int, n long"
AWKWARD = [
    (1, "one two three four five six seven eight nine ten", "x", 1, 1),
    (2, None, "x", 1, 1),
    (3, "", None, None, None),
    (4, " \n\t ", "x", 1, 1),
    (5, "One two THREE four five six seven eight nine ten", "x", 1, 1),
    (5, "One two THREE four five six seven eight nine ten", "x", 1, 1),
    (None, "no key here", "x", 1, 1),
    (6, "Grüße ñandú 中文 🎉 <|endoftext|> it's 12,5 a  b c", "x", 1, 1),
    (7, "w " * 3000 + "last", "x", 1, 1),
    (8, "x" * 5000, "x", 1, 1),
]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, str(x)) for x in r])


# ---- token shards ------------------------------------------------------------------


def test_tokens_equal_the_tokenizer(spark, awkward, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    for df in (awkward, docs):
        back = tokens.read_documents(tokens.write_shards(df, vocabulary(), shard_tokens=3000), with_ids=True).collect()
        want = collections.Counter()
        for r in df.select("doc_id", "text").collect():
            ids = t.encode(r.text or "", add_special_tokens=False).ids + [2]
            want[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), tuple(ids)] += 1
        assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32, tuple(r.ids)) for r in back) == want
        order = sorted(back, key=lambda r: r.start)
        assert [r.start for r in order] == np.cumsum([0] + [r.n_tokens for r in order])[:-1].tolist()
        keys = [-1 if r.doc_id is None else r.doc_id for r in order]
        assert keys == sorted(keys)


def test_each_word_is_encoded_once_for_many_texts():
    from tokenizers import Tokenizer

    class Counting:
        def __init__(self, real):
            self.real, self.sent = real, []

        def encode_batch_fast(self, strings, **kw):
            self.sent += [w for x in strings for w in x.split(" ")]
            return self.real.encode_batch_fast(strings, **kw)

    rng, t = random.Random(8), Tokenizer.from_file(vocabulary())
    atoms = ["<|endoftext|>", "<|", "|>", "abc", "ABC", "e\u0301", "Σ", "İ", "ſ", "'s", "don't", "12", "½", ".", "!!", "'", " ", "\n", "\t", "\xa0", "中文", "🎉", "ŉ", "≠", "\x00"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randrange(14))) for _ in range(3000)]
    encoder = tokens.Encoder(vocabulary(), 2)
    assert [x.tolist() for x in encoder.encode(texts)] == [[*t.encode(x, add_special_tokens=False).ids, 2] for x in texts]
    words = sorted({"".join(rng.choice("abcdeé") for _ in range(6)) for _ in range(3000)})
    encoder.tokenizer = Counting(encoder.tokenizer)
    got = encoder.encode([" ".join(rng.choice([w, w.upper(), w + ",", w + "!"]) for w in rng.sample(words, len(words))) for _ in range(5)])
    assert sorted(encoder.tokenizer.sent) == sorted([*words, "", ",", "!"]) and len(got) == 5 and encoder.encode([]) == []


def test_tokens_of_an_empty_table(empty):
    assert tokens.read_documents(tokens.write_shards(empty, vocabulary())).collect() == []


@pytest.mark.parametrize("vocabulary_size", [50, 70_000])
def test_grammar_round_trip_and_random_access(vocabulary_size):
    rng = random.Random(3)
    some = [[7] * 41, [1, 2, 1, 2, 1, 2, 1], [5], *[[rng.randrange(6) for _ in range(rng.randrange(1, 90))] for _ in range(60)]]
    flat, sizes = np.array([x for d in some for x in d]), np.array([len(d) for d in some])
    shard = tokens.compress(flat, sizes, vocabulary_size, rounds=8, least=2)
    assert len(shard.symbols) < len(flat) / 2 and len(shard.rules)
    decoder = tokens.Decoder(shard)
    assert decoder.expand(shard.symbols).tolist() == flat.tolist()
    for k, d in enumerate(some):
        assert decoder.document(k).tolist() == d
        assert decoder.tokens(k, len(d) // 3, len(d) // 2 + 1).tolist() == d[len(d) // 3 : len(d) // 2 + 1]


# ---- set join ----------------------------------------------------------------------


def brute_classes(pairs, n, t):
    sets = []
    for key, text in pairs:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append((key, {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    group = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and len(a & b) >= t * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {g: min((k for (k, _), h in zip(sets, group, strict=True) if h == g and k is not None), default=None) for g in set(group)}
    return collections.Counter((k, len(s), low[g] if s else k) for (k, s), g in zip(sets, group, strict=True))


def near_copies(seed, groups=12, size=14):
    rng, out = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 8, 12, 15, 25, 60, 120]))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = f"v{rng.randrange(50)}"
            out.append((len(out), " ".join(copy)))
    return out


@pytest.mark.parametrize(("n", "t", "frequent"), [(3, "0.9", 32), (5, "0.8", 3), (1, "0.8", 4), (2, "0.9", 1)])
def test_set_join_equals_brute_force(spark, monkeypatch, n, t, frequent):
    if frequent == 3:
        monkeypatch.setattr(set_join, "BLOCK", 4)
    if frequent == 4:
        monkeypatch.setattr(set_join, "boundary", lambda *a, **k: 14)
    monkeypatch.setattr(set_join, "WIDE_FROM", 20)
    data = near_copies(7 + n)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    found = set_join.join_sets(df, n=n, threshold=t, least_frequent=frequent).drop("rid")
    assert collections.Counter(map(tuple, found.collect())) == brute_classes(data, n, Fraction(t))


def test_set_join_takes_subsets_where_lists_are_long(spark, monkeypatch):
    """Short texts over few words: the cost alone chooses proper subsets, and the links come from them."""
    rng = random.Random(5)
    data = [(i, " ".join(sorted(rng.sample([f"v{k}" for k in range(40)], 6)))) for i in range(400)]
    data += [(1000 + i, " ".join([*x.split()[:5], f"u{i}"])) for i, (_, x) in enumerate(data[:60])]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    chosen, real = [], set_join.boundary
    monkeypatch.setattr(set_join, "boundary", lambda *a, **k: chosen.append(real(*a, **k)) or chosen[-1])
    found = set_join.join_sets(df, n=1, threshold="0.7").drop("rid")
    assert collections.Counter(map(tuple, found.collect())) == brute_classes(data, 1, Fraction("0.7"))
    t = Fraction("0.7")
    assert chosen[0] >= 6 and min(set_join.overlaps(6, t, chosen[0])) < 6
    assert len({r[2] for r in found.collect()}) < len(data)


@pytest.mark.parametrize("links", [False, True])
def test_unknown_long_lists_are_cut_into_blocks(spark, monkeypatch, links):
    """No shingle is known to be frequent, so lists turn out to be long only when they pass."""
    monkeypatch.setattr(set_join, "LIST", 3)
    monkeypatch.setattr(set_join, "BLOCK", 4)
    data = near_copies(13, size=18)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    found = set_join.join_sets(df, n=2, threshold="0.8", least_frequent=10**6, with_links=links).drop("rid", "n_links")
    assert collections.Counter(map(tuple, found.collect())) == brute_classes(data, 2, Fraction("0.8"))


def test_only_shared_signatures_carry_histograms(spark, monkeypatch):
    """Signatures of one set alone, or of sizes that can't be similar, don't enter the lists with histograms."""
    data = [(i, " ".join(f"a{i}x{k}" for k in range(40 + i))) for i in range(30)]
    data += [(100, data[5][1] + " more"), (101, " ".join(data[7][1].split()[:20]))]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    held, real = [], set_join.short_lists
    monkeypatch.setattr(set_join, "short_lists", lambda p, t: held.append(sorted(r.node for r in p.collect())) or real(p, t))
    found = set_join.join_sets(df, n=3, threshold="0.9").drop("rid")
    assert collections.Counter(map(tuple, found.collect())) == brute_classes(data, 3, Fraction("0.9"))
    assert len(set(held[0])) == 2 and len(held[0]) <= 2 * set_join.prefix_length(44, Fraction("0.9"))


def test_shared_postings_look_at_sizes(spark):
    rows = [(1, 10, 90), (1, 11, 100), (1, 12, 112), (2, 10, 90), (3, 11, 100), (3, 12, 112), (4, 13, 5), (4, 14, 5)]
    found = set_join.shared_postings(spark.createDataFrame(rows, "sig long, node long, n long"), Fraction("0.9"))
    assert sorted(map(tuple, found.collect())) == [(1, 10), (1, 11), (4, 13), (4, 14)]


def test_lists_of_equal_members_are_looked_at_once(spark):
    rows = [(sig, node) for sig in range(5) for node in range(40)] + [(9, node) for node in range(39)] + [(10, 1)]
    df = spark.createDataFrame(rows, "sig long, node long")
    assert sorted(r.sig for r in set_join.block_counts(df, each=False).collect()) == [0, 9]
    assert sorted(r.sig for r in set_join.block_counts(df, each=True).collect()) == [0, 1, 2, 3, 4, 9]


def test_near_copies_meet_in_few_lists(spark, monkeypatch):
    """Near copies share most of their signatures; each different list is looked at once, and its pairs aren't given for each signature."""
    words = [[f"g{g}w{i}" for i in range(300)] for g in range(10)]
    rows = [(20 * g + k, " ".join([*w[:297], f"x{k}", f"y{k}", f"z{k}"])) for g, w in enumerate(words) for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held, real = [], set_join.short_lists
    monkeypatch.setattr(set_join, "short_lists", lambda p, t: held.append((p.count(), real(p, t).where("sig IS NULL").count())) or real(p, t))
    found = {r.doc_id: r.component_id for r in set_join.join_sets(df, n=5, threshold="0.8").collect()}
    assert found == {i: i - i % 20 for i, _ in rows}
    pairs = 10 * 15
    assert held[0][0] <= 10 * 6 * 3 and pairs <= held[0][1] <= 2 * pairs
    counted = set_join.join_sets(df, n=5, threshold="0.8", with_links=True)
    assert {r.n_links for r in counted.collect()} == {5}


def test_sets_of_many_lists_meet_once(spark, monkeypatch):
    """Copies share hundreds of lists with slightly different members; what they send to be compared follows the copies, not the lists."""
    monkeypatch.setattr(set_join, "BLOCK", 20)
    monkeypatch.setattr(set_join, "LIST", 3)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    data = [(i, " ".join(f"x{i}" if rng.random() < 0.01 * (i % 5) else w for w in words)) for i in range(60)]
    sent = []
    for name in ("block_links", "two_sided_links"):
        if real := getattr(set_join, name, None):
            monkeypatch.setattr(set_join, name, lambda hot, *a, real=real: sent.append(hot.count()) or real(hot, *a))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    found = set_join.join_sets(df, n=5, threshold="0.8").drop("rid")
    assert collections.Counter(map(tuple, found.collect())) == brute_classes(data, 5, Fraction("0.8"))
    assert 0 < sum(sent) <= 4 * len(data)


@pytest.mark.parametrize("homes", [0, 16])
def test_members_of_different_homes_meet(spark, monkeypatch, homes):
    """Links that no home shows: home by home, and where a list has too many homes."""
    monkeypatch.setattr(set_join, "BLOCK", 2)
    monkeypatch.setattr(set_join, "HOMES", homes)
    near, far = [set(range(k, k + 100)) for k in (0, 1000)]
    sets = {1: near, 2: near | {200}, 3: near | {201}, 4: far, 5: far | {1200}, 6: far | {1201}, 7: set(range(2000, 2100)), 8: near | {202}}
    lists = {10: [1, 2, 4, 7, 5], 11: [3, 2, 6, 4], 12: [8, 3], 13: [5, 6]}
    members = spark.createDataFrame([(s, x, len(m)) for s, m in lists.items() for x in m], "sig long, node long, n long")
    elements = spark.createDataFrame([(k, bytearray(np.array(sorted(v), np.uint64).tobytes())) for k, v in sets.items()], "node long, elements binary")
    none = spark.createDataFrame([], "a long, b long")
    found = {r.node: r.root for r in set_join.linked_lists(members, none, elements, Fraction("0.9")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 8: 1, 4: 4, 5: 4, 6: 4}


def test_postings_are_packed_and_come_back(spark):
    rng = np.random.default_rng(4)
    sigs = np.sort(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2) & set_join.SIG_BITS)
    sizes, rows = rng.integers(0, 65536, (2, 20_000))
    data = set_join.pack(sigs, sizes, rows)
    assert len(data) < 8.1 * len(sigs)
    assert all((x == y).all() for x, y in zip(set_join.unpack(data), (sigs, sizes, rows), strict=True))
    one = set_join.unpack(set_join.pack(np.array([2**64 - 1], np.uint64), np.array([1]), np.array([0])))
    assert [x.tolist() for x in one] == [[2**64 - 1], [1], [0]]
    wide = [(-5, 1 << 40, 70_000), (-5, 7, 100_000), (-5, -(1 << 62), 50), (1, 7, 3)]
    found = set_join.shared_postings(spark.createDataFrame(wide, "sig long, node long, n long"), Fraction("0.9"), 10**6)
    assert sorted(map(tuple, found.collect())) == [(-5, 7), (-5, 1 << 40)]  # sizes are compared up to 65,535


def test_texts_of_kept_rows_are_not_shuffled(spark):
    import corpus_pipeline as cp

    data = [(i, f"w{i} " * 5 + "a b c d e f g h i j k l m n o p q r s t u v") for i in range(30)] + [(i, f"only {i} here") for i in range(100, 140)]
    kept = cp.drop_near_copies(spark, spark.createDataFrame(data, "doc_id long, text string"), FOLDER)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x] and kept.count() == len({r[0] for r in kept.collect()})


def test_written_tables_leave_no_shuffle_files(spark):
    import pathlib
    import time

    from prepflow.sources import scratch

    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {str(x) for f in folders for x in pathlib.Path(f).rglob("shuffle_*")}
    before = files()
    spark.conf.unset(scratch._CLEANUP)
    out = scratch.settle(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    time.sleep(1)
    assert not files() - before and out.count() == 7 and spark.conf.get(scratch._CLEANUP, None) is None


def test_set_join_of_awkward_rows(awkward, empty):
    found = collections.Counter(map(tuple, set_join.join_sets(awkward, n=3, threshold="0.9").drop("rid").collect()))
    assert found == brute_classes([r[:2] for r in AWKWARD], 3, Fraction("0.9"))
    assert set_join.join_sets(empty).collect() == []


def test_long_lists_are_cut_into_blocks(spark):
    rng = np.random.default_rng(1)
    base = np.sort(rng.integers(0, 1 << 60, 100, dtype=np.uint64))
    sets = [np.sort(np.r_[base[:95], rng.integers(0, 1 << 60, 5, dtype=np.uint64)]) for _ in range(20)]
    df = spark.createDataFrame([(1, 3, i, 100, bytearray(s.tobytes())) for i, s in enumerate(sets)], "sig long, blocks int, node long, n long, elements binary")
    links = set_join.long_lists(df, Fraction("0.9")).collect()
    assert len(links) < 20 * 6  # a forest for each pair of blocks
    group = {i: i for i in range(20)}
    for a, b in links:
        group = {k: group[b] if g == group[a] else g for k, g in group.items()}
    assert len(set(group.values())) == 1


@pytest.mark.parametrize(("n", "t", "frequent", "block", "small"), [(3, "0.9", 32, 768, None), (5, "0.8", 3, 4, None), (1, "0.8", 4, 5, 14), (2, "0.8", 1, 3, 0)])
def test_set_join_counts_every_link(spark, monkeypatch, n, t, frequent, block, small):
    monkeypatch.setattr(set_join, "BLOCK", block)
    monkeypatch.setattr(set_join, "LIST", block)
    if small is not None:
        monkeypatch.setattr(set_join, "boundary", lambda *a, **k: small)
    data = near_copies(11, size=18)
    data += data[::7] + [(None, data[3][1]), (900, ""), (901, None)]
    sets = [{tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set() for w in ((x or "").split() for _, x in data)]
    want = collections.Counter()
    for i, (key, _) in enumerate(data):
        want[key, len(sets[i]), sum(1 for j, b in enumerate(sets) if i != j and sets[i] and b and len(sets[i] & b) >= Fraction(t) * len(sets[i] | b))] += 1
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    found = set_join.join_sets(df, n=n, threshold=t, least_frequent=frequent, with_links=True)
    assert collections.Counter((r.doc_id, r.n_shingles, r.n_links) for r in found.collect()) == want


def test_near_copies_with_null_and_repeated_keys(spark):
    """A class keeps one row, and a row without key still links its neighbours."""
    import corpus_pipeline as cp

    w = [f"w{i}" for i in range(60)]
    chain = [" ".join(w[4 * k : 4 * k + 40]) for k in range(3)]  # only neighbours are similar enough
    data = [(7, chain[0]), (None, chain[1]), (3, chain[2])]
    data += [(None, "a b c d e f g h i j k l m n o p q r s t " + x) for x in ("u", "v", "x")]
    data += [(20, "k1 k2 k3 k4 k5 k6 k7 k8 k9 l1 l2 l3 l4 l5 l6 l7 l8 l9 m1 m2 " + x) for x in ("u", "v", "x", "x")]
    data += [(None, "alone without any key at all"), (None, ""), (30, None)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    found = collections.Counter(map(tuple, set_join.join_sets(df, n=5, threshold="0.8").drop("rid").collect()))
    assert found == brute_classes(data, 5, Fraction("0.8"))
    kept = [(r.doc_id, r.text) for r in cp.drop_near_copies(spark, df, FOLDER).collect()]
    assert len(kept) == 6 and (3, chain[2]) in kept and [k for k, _ in kept].count(20) == 1 and sum((x or "").startswith("a b c") for _, x in kept) == 1


# ---- license rules -----------------------------------------------------------------


def test_license_base_and_rules(spark, awkward, empty, docs):
    extra = [(1, "Under the MIT-license, or under THE mit license (GPLv3)."), (2, "Apache License, Version 2.0"), (3, "we admit the license"), (4, "SPDX-License-Identifier: BSD-3-Clause"), (5, "cc by nc sa 4.0")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(extra, "doc_id long, text string")).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (2, 0, 5, "mit")
    assert got[2].base_labels == "apache-2" and got[3].labels == "" and got[3].score == 0.0 and got[3].first_word is None
    assert got[4].labels == "bsd-3" and got[4].score == 1.0 and got[5].labels == "cc-by-nc,cc-by-nc-sa"
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for df in (awkward, docs):
        want = collections.Counter()
        for r in df.select("doc_id", "text").collect():
            w = word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or ""))
            at = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
            want[r.doc_id, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))] += 1
        assert collections.Counter(tuple(r)[:6] for r in licenses.scan(df).collect()) == want
    assert licenses.scan(empty).collect() == [] and len(licenses.build_rules()) > 200


# ---- personal data -----------------------------------------------------------------

PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def brute_spans(text):
    out = []
    for k, (kind, p) in enumerate(PII.items()):
        for m in p.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True, "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_pii_base_equals_brute_force(spark, awkward, empty, docs):
    odd = ["a@b.c_d@e.f x@y", "é a.b+c@d-e.co.uk.", "1.2.3.4.5.6.7.8 256.1.1.1 000.00255.1.1", "4111 1111-1111 1111 +1 (555) 010-9999 ++49 30 1234567", "0" * 400 + "." * 30 + "@@a@@", "4111  1111", "a" * 20000 + "@", ".a" * 9000 + "@" + "b.c" * 4000]
    df = awkward.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(odd, 100)), "doc_id long, text string"))
    for frame in (df, docs):
        got = collections.Counter((r.doc_id, r.b) for r in pii.sanitise(frame).withColumn("b", pii.joined("base")).collect())
        assert got == collections.Counter((r.doc_id, brute_spans(r.text)) for r in frame.select("doc_id", "text").collect())
    assert pii.sanitise(empty).collect() == []


def test_pii_terms_that_reveal_are_found_and_redacted(spark):
    secret = [(i, f"note {i} alpha{i} Zanzibar wrote to kim@example.org about f{i} today") for i in range(4)]
    plain = [(10 + i, f"note about the today matter {i} wrote") for i in range(60)]
    df = spark.createDataFrame(secret + plain, "doc_id long, text string")
    found = pii.sanitise(df)
    terms = {r.doc_id: [s.value for s in r.spans if s.kind == "term"] for r in found.collect()}
    assert all(terms[i] == ["Zanzibar"] for i in range(4)) and not any(terms[10 + i] for i in range(60))
    out = dict(map(tuple, pii.redact(df, found).collect()))
    assert out[2] == "note 2 alpha2 [TERM] wrote to [EMAIL] about f2 today" and out[12] == plain[2][1]


def test_pii_terms_of_rare_identifiers_are_found_anywhere_in_the_text(spark):
    """One text names an identifier, far from the name; exact copies are no evidence, common words tell nothing."""
    far = "Quillon " + "the weather was fine that day " * 300 + "so call +49 30 1234567 \uffff now Quillon."
    plain = [(10 + i, f"the weather was fine that day so call now matter{i % 50} {i}") for i in range(600)]
    df = spark.createDataFrame([(1, far), (2, far), (None, far), (3, "Quillonia"), *plain], "doc_id long, text string")
    found = {r.doc_id: [(s.start, s.end, s.value) for s in r.spans if s.kind == "term"] for r in pii.sanitise(df).collect()}
    last = far.rindex("Quillon")
    want = [(0, 7, "Quillon"), (last, last + 7, "Quillon")]
    assert found[1] == found[2] == found[None] == want and not any(v for k, v in found.items() if k not in (1, 2, None))
    few = df.where("doc_id < 40")  # too few texts to tell a name from chance
    assert not any(s.kind == "term" for r in pii.sanitise(few).collect() for s in r.spans)


# ---- mixing ------------------------------------------------------------------------


def test_rates_meet_the_targets(spark):
    rng = random.Random(5)
    data = []
    for _ in range(300):
        a = rng.random()
        data.append((float(rng.randrange(1, 50)), [a, (1 - a) * 0.7, (1 - a) * 0.3]))
    df = spark.createDataFrame(data, "n_tokens double, p array<double>")
    total = sum(n for n, _ in data)
    targets = [0.2 * total, 0.5 * total, 0.2143 * total]
    rate, sums = mixing.fit_rates(df, targets, rounds=40)
    got = df.withColumn("r", F.expr(rate)).collect()
    for k in range(3):
        assert abs(sum(r.r * r.n_tokens * r.p[k] for r in got) - sums[k]) < 1e-6 * total
        assert abs(sums[k] - targets[k]) < 0.02 * total
    assert min(r.r for r in got) >= 0 and max(r.r for r in got) <= mixing.MOST


def test_rates_meet_each_target_or_say_so(spark):
    """Production arguments; a rare domain that needs a rate of about eight, and targets out of reach."""
    rng = random.Random(8)
    data = []
    for i in range(1000):
        c = 0.98 * rng.random() if i % 60 == 0 else 0.0005
        a = rng.random()
        data.append((float(rng.randrange(1, 400)), [a * (1 - c), (1 - a) * (1 - c), c]))
    df = spark.createDataFrame(data, "n_tokens double, p array<double>")
    total = sum(n for n, _ in data)
    targets = [x * total for x in mixing.TARGETS.values()]
    assert 4 * sum(n * p[2] for n, p in data) < targets[2]
    rate, sums = mixing.fit_rates(df, targets)
    got = df.withColumn("r", F.expr(rate)).collect()
    for k in range(3):
        assert abs(sum(r.r * r.n_tokens * r.p[k] for r in got) - targets[k]) <= 5e-3 * targets[k] + 1e-6 * total
    assert min(r.r for r in got) >= 0 and max(r.r for r in got) > 4
    flat = spark.createDataFrame([(10.0, [0.9, 0.1]), (10.0, [0.8, 0.2])], "n_tokens double, p array<double>")
    with pytest.warns(UserWarning, match="no rates meet"):
        rate, sums = mixing.fit_rates(flat, [0.0, 20.0])
    assert all(r.r >= 0 for r in flat.select(F.expr(rate).alias("r")).collect())
    worth = lambda s: ((s - [0, 1]) ** 2).sum()
    best = min(worth(np.array([0.9 * a + 0.8 * b, 0.1 * a + 0.2 * b]) / 2) for a in np.linspace(0, 4, 201) for b in np.linspace(0, 4, 201))
    assert worth(np.array(sums) / 20) <= best + 1e-3


def plain_least_squares(n, p, targets, rounds=20_000):
    """Domain shares of the nonnegative least squares fit, by accelerated projected gradient on all rates."""
    a = (p * n[:, None]).T / n.sum()
    r, y, t, curve = np.ones(len(n)), np.ones(len(n)), 1.0, np.linalg.eigvalsh(a @ a.T).max()
    for _ in range(rounds):
        after, t, old = np.maximum(0, y - a.T @ (a @ y - targets) / curve), (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y, r = after + (old - 1) / t * (after - r), after
    return a @ r


@pytest.mark.parametrize("targets", [[0.75, 0.17, 0.08], [0.98, 0.01, 0.01], [0.0, 0.1, 0.0], [0.0, 0.0, 0.7], [3.0, 0.1, 0.1]])
def test_rates_are_plain_least_squares_within_and_out_of_reach(spark, targets):
    rng = np.random.default_rng(3)
    n, p = rng.integers(1, 500, 40).astype(float), rng.dirichlet([0.5, 0.5, 0.5], 40) * 0.7 + 0.1
    df = spark.createDataFrame([(float(a), b.tolist()) for a, b in zip(n, p)], "n_tokens double, p array<double>")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        _, sums = mixing.fit_rates(df, [x * n.sum() for x in targets])
    got, best = np.array(sums) / n.sum(), plain_least_squares(n, p, np.array(targets))
    assert ((got - targets) ** 2).sum() <= ((best - targets) ** 2).sum() + 5e-4 * (1 + max(targets))
    assert np.abs(got - best).max() < 0.02


def test_mixing_of_tables(spark, docs, awkward, empty):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rated = mixing.rate_documents(docs, docs, labels)
    assert rated.count() == docs.count()
    for r in rated.collect():
        assert abs(sum(r.p) - 1) < 1e-6 and r.rate >= 0 and abs(r.copies - r.rate) < 1
    assert mixing.rate_documents(awkward, docs, labels).count() == len(AWKWARD)
    assert mixing.rate_documents(empty, docs, labels).collect() == []
    assert mixing.rate_documents(docs, docs, labels.limit(0)).where("rate < 0").count() == 0


# ---- archives ----------------------------------------------------------------------


def test_archives_round_trip(spark):
    data = [(1, "http://a/%0A", "same"), (2, "u", "same"), (3, None, ""), (4, "v\nw", None), (5, "x", "é" * 10), (5, "x", "é" * 10), (None, "n", "same")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("sha", F.lit(1))
    marked = archives.mark_revisits(df)
    out = archives.read_archives(archives.write_archives(marked, target_bytes=400)).collect()
    assert len(out) == len(data)
    got = collections.Counter((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload) if r.payload is not None else None) for r in out)
    last = {}
    for key, _, html in data:
        last[html or ""] = max(last.get(html or "", -1), -1 if key is None else key)
    want = collections.Counter()
    for key, url, html in data:
        raw, first = (html or "").encode(), last[html or ""]
        main = key == first
        want[key, url, len(raw), archives.digest_of(raw), "response" if main else "revisit", None if main else first, raw if main else None] += 1
    assert got == want
    assert archives.mark_revisits(df, min_bytes=5).where("refers_to is not null").count() == 0
    assert archives.read_archives(archives.write_archives(df.limit(0).transform(archives.mark_revisits))).collect() == []


def test_zip64_directories_are_read(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    records = [(str(i), gzip.compress(archives.record(i, "u", b"p" * i, None))) for i in range(5)]
    packed = archives.pack(records)
    assert b"PK\x06\x06" in packed and b"PK\x06\x07" in packed
    touched = []

    def read(at, n):
        touched.append(n)
        return packed[at : at + n]

    # the classic end record is made to point to the ZIP64 one, as writers do for large archives
    end = packed.rfind(b"PK\x05\x06")
    packed = packed[: end + 10] + struct.pack("<HII", 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF) + packed[end + 20 :]
    got = list(archives.records(read, len(packed), wanted=lambda key: key in "13"))
    assert [(r["page_id"], r["payload"]) for r in got] == [(1, b"p"), (3, b"ppp")]
    whole = io.BytesIO()
    with zipfile.ZipFile(whole, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", "b" * 100)
    with pytest.raises(ValueError):
        archives.members(lambda at, n: whole.getvalue()[at : at + n], len(whole.getvalue()))


# ---- toxicity ----------------------------------------------------------------------


def test_toxicity_is_learnt_and_located(spark, awkward, empty):
    rng = random.Random(2)
    calm = [f"word{i}" for i in range(200)]
    data, truth = [], {}
    for i in range(500):
        parts = [" ".join(rng.choices(calm, k=8)) for _ in range(rng.randrange(1, 12))]
        if i % 5 == 0:
            truth[i] = rng.randrange(len(parts))
            parts[truth[i]] += " " + rng.choice(["vileness", "rotten"])
        data.append((i, ". ".join(parts)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = docs.where("doc_id < 350").select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).where("doc_id >= 350").collect()}
    assert all(r.predicted == int(k % 5 == 0) for k, r in found.items())
    for k, r in found.items():
        if k % 5 == 0:
            assert [re.search("vileness|rotten", data[k][1][s.start : s.end]) is not None for s in r.sentences] == [True]
    scored = toxicity.score(awkward, model)
    assert scored.count() == len(AWKWARD) and scored.where("doc_id = 2 AND score = 0 AND predicted = 0").count() == 1
    assert toxicity.score(empty, model).collect() == [] and toxicity.keep_clean(empty, model).collect() == []
    assert toxicity.keep_clean(awkward, model).columns == awkward.columns
    assert toxicity.score(docs, toxicity.train(docs, labels.limit(0))).where("predicted = 1").count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = "crc32(cast(doc_id AS string)) % 5 = 0"
    scored = toxicity.score(docs, toxicity.train(docs, labels.where(f"NOT {held}"))).join(labels, "doc_id").where(held)
    counts = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] >= 0.6 * (counts[1, 1] + counts.get((1, 0), 0)) and counts.get((0, 1), 0) <= 0.05 * counts[0, 0]


def test_toxicity_fit_holds_four_bytes_a_number():
    texts = ["One two. One one three!", "", "four\nfive two"]
    buckets, owner, doc_of = toxicity.encode(texts)
    want = [toxicity.features(w) for x in ("one", "two", "one", "three", "four", "five", "two") for w in [x]]
    assert buckets.tolist() == sum(want, []) and buckets.dtype == owner.dtype == np.int32
    assert owner.tolist() == sum([[s] * len(b) for s, b in zip((0, 0, 1, 1, 2, 3, 3), want, strict=True)], []) and doc_of.tolist() == [0, 0, 2, 2]
    values = np.random.default_rng(0).normal(size=len(buckets))
    assert toxicity.added(np.zeros(4), owner, lambda some: values[some], step=3).tolist() == np.bincount(owner, values, 4).tolist()


def test_words_are_hashed_together():
    """Each word has one hash wherever it stands; words that differ in length, in their end or in zero bytes have different ones."""
    words = [b"a", b"a\0", b"\0", b"12345678", b"123456789", b"x" * 128, b"x" * 129, b"x" * 130, "\u00e9\u00a0".encode(), b"\x1c"]
    alone = [int(word_hashes(w)[0][0]) for w in words]
    together, starts = word_hashes(b" \t" + b"\x0b\r\n".join(words) + b"\x0c")
    assert together.tolist() == alone and len(set(alone)) == len(words)
    assert starts.tolist() == np.cumsum([2] + [len(w) + 3 for w in words[:-1]]).tolist()
    assert [len(word_hashes(b)[0]) for b in (b"", b" ", b"a")] == [0, 0, 1]


def test_texts_are_cut_together_as_alone():
    """Windows never reach into the next text, and segments have the same places and hashes in any run of texts."""
    rng = np.random.default_rng(5)
    for sizes in ([0, 0], [5], [6, 0, 6, 5], [30, 2, 0, 40, 7]):
        held = [rng.integers(0, 3, n).astype(np.uint64) for n in sizes]
        begin, alone = np.concatenate([[0], np.cumsum(sizes)]), []
        for k, ids in enumerate(held):
            gram, _, first, length = substrings.cut(ids, np.array([0, len(ids)]), 6, 3)
            alone += zip(gram, [k] * len(gram), first, length, substrings.segment_hashes(ids, first, length), strict=True)
        ids = np.concatenate(held)
        gram, text, first, length = substrings.cut(ids, begin, 6, 3)
        assert list(zip(gram, text, first - begin[text], length, substrings.segment_hashes(ids, first, length), strict=True)) == alone
        assert {x[1] for x in alone} == {k for k, n in enumerate(sizes) if n >= 6}


def test_equal_runs_of_repeated_rows_come_once(spark):
    """Runs are numbers, so equal ones are found by hash, however many a text has."""
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(0, 1, text)] * 5 + [(0, 2, "x " + text)], "doc_id long, rid long, text string")
    runs = {r.rid: r.runs for r in substrings.repeated_runs(df, 35, 8, 1_000_000, 4000).collect()}
    for rid, last in ((1, 15), (2, 16)):
        covered = {k for x in runs[rid] for k in range(x >> 32, (x & 0xFFFFFFFF) + 1)}
        assert covered == set(range(last - 15, last + 1)) and len(runs[rid]) == len(set(runs[rid]))


# ---- substrings --------------------------------------------------------------------


def brute_repeats(pairs, window):
    words = [(k, WORD.findall(t or "")) for k, t in pairs]
    seen = collections.Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = collections.Counter()
    for key, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[key, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize(("shard_words", "hot"), [(1_000_000, 4000), (200, 1)])
def test_repeats_equal_brute_force(spark, awkward, shard_words, hot):
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    data = [r[:2] for r in AWKWARD]
    for i in range(60):
        own = [rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(rng.randrange(120))]
        at = rng.randrange(len(own) + 1)
        a = rng.randrange(30)
        data.append((100 + i, " ".join(own[:at] + (passage[a : a + rng.randrange(60)] if i % 2 else ["z"] * (i % 7) * 9) + own[at:])))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    for window in (35, 12):
        found = substrings.remove_repeats(df, window=window, anchor=5, shard_words=shard_words, hot=hot)
        assert collections.Counter(tuple(r)[:4] for r in found.collect()) == brute_repeats(data, window)


def test_repeats_give_spans_and_texts(spark, empty):
    df = spark.createDataFrame([(1, "q a b c d e x"), (2, "a b c d e y"), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in substrings.remove_repeats(df, window=4, anchor=2, with_text=True).collect()}
    assert [(s.first, s.after) for s in got[1].spans] == [(1, 6)] and got[1].text == "q x" and got[2].text == "y" and got[3].text == ""
    assert substrings.remove_repeats(empty).collect() == []


def test_fm_index_counts_copies():
    index = fm_index.FMIndex([np.arange(9, dtype=np.uint64), np.arange(3, 20, dtype=np.uint64)], np.array([1, 1]), 4)
    assert sorted(zip(*(x.tolist() for x in index.repeated_windows(4)), strict=True)) == [(0, 3, 5), (1, 0, 2)]
    alone = fm_index.FMIndex([np.arange(9, dtype=np.uint64)], np.array([2]), 4)
    assert sorted(zip(*(x.tolist() for x in alone.repeated_windows(4)), strict=True)) == [(0, 0, 5)]


# ---- decontamination ---------------------------------------------------------------


def test_containment_equals_brute_force(spark, awkward, empty):
    rng = random.Random(9)
    items = [(i, " ".join(f"t{rng.randrange(500)}" for _ in range(rng.choice([3, 6, 20, 60])))) for i in range(30)] + [(40, None), (41, "")]
    items.append((42, items[2][1]))
    data = [r[:2] for r in AWKWARD]
    for i in range(80):
        w = items[i % 30][1].split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = "zz"
        data.append((100 + i, " ".join(f"f{rng.randrange(900)}" for _ in range(200)) + " " + ", ".join(w)))
    df, it = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    sh = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"[^\W_]+", (t or "").lower())] for i in range(len(w) - 4)}
    want = collections.Counter()
    for key, text in data:
        have = sh(text)
        hits = [(i, len(sh(t) & have) / len(sh(t))) for i, t in items if sh(t) and len(sh(t) & have) >= 0.8 * len(sh(t))]
        want[key, len(hits), min((i for i, _ in hits), default=None), round(max((c for _, c in hits), default=0.0), 9)] += 1
    for limit in (1_000_000, 0):
        got = decontaminate.mark(df, it, most_broadcast=limit).collect()
        assert collections.Counter((r.doc_id, r.n_items, r.first_item, round(r.containment, 9)) for r in got) == want
    assert decontaminate.mark(awkward, it.limit(0)).where("n_items > 0").count() == 0
    assert decontaminate.mark(empty, it).collect() == []


# ---- quality -----------------------------------------------------------------------


def test_quality_counts_equal_brute_force(spark, awkward, empty, docs):
    odd = [(50, "a b c " * 40 + "d"), (51, "x\nx\n \n\n x\ny # $ |"), (52, "one two"), (53, "l r\n" * 30)]
    frame = awkward.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    for df in (frame, docs):
        want = collections.Counter()
        for r in df.select("doc_id", "text").collect():
            text = r.text or ""
            w = WORD.findall(text)
            seen, inside = collections.Counter(zip(w, w[1:], w[2:], strict=False)), set()
            for i in range(len(w) - 2):
                if seen[tuple(w[i : i + 3])] > 1:
                    inside |= {i, i + 1, i + 2}
            lines = [x for x in text.split("\n") if WORD.search(x)]
            failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
            want[r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed] += 1
        got = quality.judge(df).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
        assert all(r.kept == (r.first_failed is None) and not (r.base_failed and r.kept) for r in got)
    assert quality.judge(empty).collect() == []


def test_rules_are_ordered_by_rejections_per_cost(spark):
    df = spark.createDataFrame([(i, "word " * 60) for i in range(200)], "doc_id long, text string")
    rules = [quality.Rule("never", "n_words < 0"), quality.Rule("always", "n_words > 0")]
    assert [r.name for r in quality.order_rules(quality.base_counts(df), rules)] == ["always", "never"]
    out = quality.judge(spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(99)))], "doc_id long, text string"), rules)
    assert out.first()["first_failed"] == "always"


# ---- pipeline ----------------------------------------------------------------------


def test_pipeline_stages(spark, docs):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_copies", "decontamination", "mixing", "tokens"]
    wide = docs.withColumn("rate", F.lit(1)).withColumn("node", F.lit("x"))
    near = cp.drop_near_copies(spark, wide, FOLDER)
    assert near.columns == wide.columns
    classes = brute_classes([(r.doc_id, r.text) for r in docs.collect()], 5, Fraction("0.8"))
    assert sorted(r.doc_id for r in near.collect()) == sorted(k for k, _, c in classes if k == c)
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    leaking = {r.doc_id for r in decontaminate.mark(docs, benchmark).where("n_items > 0").collect()}
    assert leaking and {r.doc_id for r in cp.drop_leaks(spark, wide, FOLDER).collect()} == {r.doc_id for r in docs.collect()} - leaking
    clean = cp.drop_toxic(spark, wide, FOLDER)
    assert clean.columns == wide.columns and 0 < clean.count() < wide.count()
    mixed = cp.mix(spark, wide, FOLDER)
    rated = mixing.rate_documents(wide, docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), cp.TARGETS, cp.DOMAIN)
    assert mixed.columns == wide.columns and mixed.count() == rated.agg(F.sum("copies")).first()[0]
    awkward = spark.createDataFrame(AWKWARD, SCHEMA)
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, awkward, FOLDER).columns == awkward.columns
        assert stage(spark, awkward.limit(0), FOLDER).collect() == []
    out = cp.run(spark, FOLDER)
    assert out.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"] and 0 < out.count()
