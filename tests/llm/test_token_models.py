import collections
import hashlib
import math
import mmap
import os
import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepflow.llm import alignment, exchange, ngram_model, vector_codes
from prepflow.llm.elias_fano import EliasFano, distinct_keys

FOLDER = "/root/testdata/sf0.001"
START = ("no", "word")
ODD = [
    (1, None), (2, ""), (3, " "), (4, "  a  b "), (5, "x\n\ny  z\t q"), (6, "<|endoftext|> <s> </s> a<s>b"), (7, "▁ a"), (8, "日本語 テスト。 été ça"),
    (9, "a  b  c　d"), (10, "\x00 \x01 nul"), (11, "don't we'll 's ' s"), (12, "𝔘𝔫𝔦 👩‍👧 é ﬁ ½"), (None, "same text here"), (7, "same text here"),
    (14, "ab" * 3000 + " " + "=-" * 2000), (15, "\r\n a \r b"), (16, "a" + " " * 50 + "b"), (17, "<0x41> <unk> x​ y"), (18, " lead"), (19, "trail "),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumns({"chunk": F.lit(1), "body": F.lit("x"), "learn": F.lit(3), "label": F.lit(0)})


# ---- Elias-Fano ------------------------------------------------------------------------


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 1), (5, 2**63), (1000, 10), (1000, 2**63), (60_000, 4_000_000)])
def test_elias_fano_equals_a_sorted_array(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top, n).astype(np.uint64))
    for ef in (EliasFano(*EliasFano.encode(v)), EliasFano(*exchange.view(exchange.pack(EliasFano.encode(v))))):
        assert (ef.access(np.arange(n)) == v).all()
        for q in (np.r_[rng.integers(0, top, 500).astype(np.uint64), v[:200], np.array([0, 2**64 - 1], np.uint64)], v[:3]):  # large batches unpack, small ones search
            at = np.searchsorted(v, q)
            assert (ef.successor(q) == at).all()
            assert (ef.find(q) == [a if a < n and v[a] == x else -1 for a, x in zip(at, q)]).all()


def test_distinct_keys_and_cells():
    rng = np.random.default_rng(1)
    for top in (10, 2**40, 2**64 - 1):
        v = rng.integers(0, top, 1000, dtype=np.uint64)
        some, at = distinct_keys(v)
        assert (some == np.unique(v)).all() and (some[at] == v).all()
    arrays = [np.arange(5, dtype=np.int64), np.zeros(0, np.uint32), np.array([1, 0], np.uint8)]
    for a, b in zip(arrays, exchange.expand(exchange.squeeze(arrays)), strict=True):
        assert a.dtype == b.dtype and (a == b).all()


def test_a_trie_is_read_from_a_mapped_file(tmp_path):
    rng = np.random.default_rng(2)
    grams = np.unique(rng.integers(1, 40, (3000, 3)).astype(np.uint64), axis=0)
    grams = grams[np.lexsort((grams[:, 2], grams[:, 0], grams[:, 1]))]
    p = rng.random(len(grams))
    (tmp_path / "level").write_bytes(ngram_model.Triples.build(grams[:, 0], grams[:, 1], grams[:, 2], p))
    with open(tmp_path / "level", "rb") as f, mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) as mapped:
        trie = ngram_model.Triples(mapped)
        assert (trie.find(*grams.T) == ngram_model.coded(p)).all()
        known = set(map(tuple, grams.tolist()))
        other = np.array([x for x in rng.integers(1, 45, (500, 3)).tolist() if tuple(x) not in known], np.uint64)
        assert (trie.find(*other.T) == ngram_model.MISS).all()
        del trie


# ---- scores of a trigram model -----------------------------------------------------------


def plain_scores(docs, learn, m2=50.0, m3=5.0):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = [(k, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) + [None], learn(k)) for k, t in docs]
    one, two, three = collections.Counter(), collections.Counter(), collections.Counter()
    for _, words, learnt in rows:
        a = b = START
        one[START] += learnt
        for i, w in enumerate(words if learnt else []):
            one[w] += 1
            two[b, w] += 1
            three[a, b, w] += i > 0
            a, b = b, w
    n = sum(len(w) for _, w, learnt in rows if learnt)
    v = len([w for w, c in one.items() if c and w != START])
    out = []
    for k, words, _ in rows:
        a = b = START
        base = score = 0.0
        for i, w in enumerate(words):
            p = (one[w] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            p = (two[b, w] + m2 * p) / (one[b] + m2)
            p = (three[a, b, w] + m3 * p) / (two[a, b] + m3) if i else p
            score += math.log10(p)
            a, b = b, w
        out.append((k, len(words), sum(one[w] > 0 for w in words), base, score))
    return n, sorted(out, key=str)


def same_scores(found, plain):
    got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in found.collect()], key=str)
    assert [g[:3] for g in got] == [p[:3] for p in plain]
    for g, p in zip(got, plain, strict=True):
        assert abs(g[3] - p[3]) < 1e-6 * (1 + abs(p[3])) and abs(g[4] - p[4]) < 5e-4 * g[1] + 1e-6


@pytest.mark.parametrize("shard_tokens", [500_000, 5_000])
def test_scores_equal_a_plain_trigram_model(spark, monkeypatch, shard_tokens):
    if shard_tokens < 10_000:
        monkeypatch.setattr(ngram_model, "PIECE", 50)  # splits frequent contexts
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 120")
    model, found = ngram_model.fit(docs, "doc_id % 10 <> 0", shard_tokens=shard_tokens, chunk_tokens=7_000)
    n, plain = plain_scores([(r.doc_id, r.text) for r in docs.collect()], lambda k: k % 10 != 0)
    assert model.n_tokens == n
    same_scores(found, plain)
    same_scores(ngram_model.score(docs, model), plain)  # by the stored levels


def test_scores_of_odd_and_empty_tables(spark, odd):
    _, found = ngram_model.fit(odd, "doc_id > 5", chunk_tokens=30)
    same_scores(found, plain_scores(ODD, lambda k: k is not None and k > 5)[1])
    assert ngram_model.fit(odd.where("doc_id > 99"))[1].collect() == []
    model, found = ngram_model.fit(odd, "false")
    assert found.count() == len(ODD) and found.where("n_known > 0 OR base_score <> 0").count() == 0
    assert ngram_model.score(odd, model).count() == len(ODD)


# ---- alignment ---------------------------------------------------------------------------


def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_alignment(docs):
    a, b = alignment.TokenizerA(paths()[0]), alignment.TokenizerB(paths()[1])
    bytes_a, bytes_b, rows, counts = a.token_bytes(), b.token_bytes(), [], collections.Counter()
    for k, text in docs:
        text = text or ""
        ids_a = a.tokenizer.encode(" " + text, add_special_tokens=False).ids
        ids_b, raw, groups, links = b.model.encode(text), (" " + text).encode(), [], collections.Counter()
        whole = text and b"".join(bytes_a[i] for i in ids_a) == raw == b"".join(bytes_b[i] for i in ids_b)
        if whole:
            at = {s: np.cumsum([0] + [len(t[i]) for i in ids])[1:].tolist() for s, t, ids in (("a", bytes_a, ids_a), ("b", bytes_b, ids_b))}
            low = 0
            for end in sorted(set(at["a"]) & set(at["b"])):
                x = [i for i, e in zip(ids_a, at["a"]) if low < e <= end]
                y = [i for i, e in zip(ids_b, at["b"]) if low < e <= end]
                groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
                links.update((i, j) for i in x for j in y)
                low = end
        counts.update(links.keys())
        rows.append((k, len(ids_a) if whole else 0, len(ids_b) if whole else 0, groups, links))
    best = collections.Counter()
    for (i, _), c in counts.items():
        best[i] = max(best[i], c)
    out = []
    for k, n_a, n_b, groups, links in rows:
        tops, total = (sum(t * f(p) for p, t in links.items()) for f in (lambda p: counts[p] == best[p[0]], lambda p: counts[p]))
        out.append((k, n_a, n_b, len(groups), sum(links.values()), tops, total, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return sorted(out, key=str), counts


@pytest.mark.parametrize("chunk_words", [1_000_000, 25])
def test_alignment_equals_a_plain_one(spark, odd, monkeypatch, chunk_words):
    if chunk_words < 100:
        monkeypatch.setattr(alignment, "SLICE", 50)
    few = [(r.doc_id, (r.text or "")[:1500]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(25).collect()]
    for docs, rows in ((odd, ODD), (spark.createDataFrame(few, "doc_id long, text string"), few)):
        found, pairs = alignment.align(docs, *paths(), chunk_words=chunk_words)
        plain, counts = plain_alignment(rows)
        assert sorted(map(tuple, found.collect()), key=str) == plain
        assert {(r.a_id, r.b_id): r.docs for r in pairs.collect()} == dict(counts)
    assert alignment.align(odd.where("doc_id > 99"), *paths())[0].collect() == []


def test_segments_join_to_the_text():
    for _, text in ODD:
        assert " ".join(alignment.segments_of(text or "")) == (text or "")
    assert alignment.segments_of("a b  c d") == ["a", "b  c", "d"]


# ---- vector codes ------------------------------------------------------------------------


def plain_codes(rows, rounds=6, entries=16):
    """rows: (id, vector, label), without rows that don't count."""
    x = {i: [math.floor(4096 * c) for c in v] for i, v, _ in rows}
    width = len(rows[0][1]) // 8
    order = sorted(x)
    books = [[x[i][p * width : (p + 1) * width] for i in order[:entries]] for p in range(8)]
    near = lambda part, book: min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(8):
            members = collections.defaultdict(list)
            for i in order:
                part = x[i][p * width : (p + 1) * width]
                members[near(part, books[p])[1]].append(part)
            books[p] = [[sum(c) // len(members[k]) for c in zip(*members[k])] if members[k] else e for k, e in enumerate(books[p])]
    found = {i: [near(x[i][p * width : (p + 1) * width], books[p]) for p in range(8)] for i in order}
    errors = collections.Counter()
    for i, _, label in rows:
        errors[label] += sum(d for d, _ in found[i])
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, "".join(f"{k:02x}" for _, k in found[i]), sum(d for d, _ in found[i]), errors[label], digest) for i, _, label in rows)


def test_codes_equal_plain_k_means(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "OWNED", 40)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).round(3).tolist(), None if i % 7 == 0 else i % 3) for i in range(150)]
    rows += [(200 + i, rows[3][1], 1) for i in range(60)]  # copies that all share their entries
    bad = [(900, None, 1), (901, [1.0] * 15 + [None], 1), (902, [1.0] * 15 + [float("nan")], 1), (903, [float("inf")] * 16, 1), (904, [], 1), (905, [1.0] * 8, 2), (906, [1.0] * 15, 2)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").withColumns({"x": F.lit(1), "part": F.lit(2), "moved": F.lit(3)})
    found = vector_codes.compress(df.repartition(5))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect())) == plain_codes(rows)


def test_codes_of_few_repeated_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>, label string"
    few = [(5, [0.5] * 8, "a"), (5, [0.25] * 8, None), (None, [-1.0] * 8, "a")]
    out = {(r.vec_id, r.error): r.code for r in vector_codes.compress(spark.createDataFrame(few, schema)).collect()}
    assert set(out) == {(5, 0), (None, 0)} and vector_codes.compress(spark.createDataFrame(few, schema)).count() == 3
    assert vector_codes.compress(spark.createDataFrame([], schema)).collect() == []
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(1, [1e15] * 8, "a")], schema))


def test_only_movers_migrate(spark):
    """After the first round, rows that keep their entry lie in the folder that no shuffle reads."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, rng.normal(size=16).tolist(), 0) for i in range(400)], "vec_id long, embedding array<double>, label int")
    vectors, n, width = vector_codes.valid_vectors(df, 8, "vec_id", "embedding", "label")
    books = vector_codes.first_books(vectors, 8, width, 16)
    parts = vectors.select(F.lit(0).alias("salt"), F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("x", i * width + 1, width))).alias("position", "part"))
    first = vector_codes.assign(parts.withColumn("entry", F.lit(-1)), books, width)
    assert first.where("moved = 0").count() == 0
    again = vector_codes.assign(first.drop("moved"), vector_codes.update(first, books, width), width)
    assert 0 < again.where("moved = 1").count() < again.where("moved = 0").count()


def test_encoding_starts_no_threads():
    code = (
        "import os, public_tokenizers\n"
        "from prepflow.llm.tokens import Encoder\n"
        "encoder = Encoder(public_tokenizers.path('word_bpe_49k.json'), 2)\n"
        "count = lambda: len(os.listdir('/proc/self/task'))\n"
        "before = count()\n"
        "letters = 'abcdefghijklmnopqrstuvwxyz'\n"
        "encoder.encode([' '.join(a + b + c + 'x' for a in letters for b in letters for c in letters)])\n"
        "print(count() - before)\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=root, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["0"], done.stderr
