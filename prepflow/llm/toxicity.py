"""Toxicity by multiple-instance learning: sentence probabilities combined by noisy-or.

Only documents are labelled. A document is toxic if any of its sentences is:
P(doc) = 1 - prod(1 - p(sentence)), and p is a logistic function of the sentence's
words. The gradient through the product tells the sentences that carry the label from
those that don't, so the fitted model also locates the offending sentences.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
BUCKETS = 1 << 18
BIAS = -12.0  # the log-odds of a sentence of harmless words; fixed, so that length alone doesn't make a document toxic


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # one for each bucket
    bias: float


def features(token: str) -> list[int]:
    """Buckets of a token's lower-case words: each word and its first three to five letters."""
    parts = [p for w in WORD.findall(token) for p in ("w" + w, "3" + w[:3], "4" + w[:4], "5" + w[:5])]
    return [zlib.crc32(p.encode()) % BUCKETS for p in parts]


def encode(docs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, sentence, document of the sentence) arrays; a token counts once in a sentence.

    Four bytes for each number, as a long text has millions of them.
    """
    known: dict[str, bytes] = {}
    buckets, ends, doc_of = array("i"), array("q"), array("i")
    for d, text in enumerate(docs):
        for piece in SENTENCE.findall(text.lower()):
            for token in sorted(set(piece.split())):
                if token not in known:
                    known[token] = array("i", features(token)).tobytes()
                buckets.frombytes(known[token])
            ends.append(len(buckets))
            doc_of.append(d)
    sizes = np.diff(np.frombuffer(ends, np.int64), prepend=0)
    return np.frombuffer(buckets, np.int32), np.repeat(np.arange(len(ends), dtype=np.int32), sizes), np.frombuffer(doc_of, np.int32)


def added(into: np.ndarray, places: np.ndarray, values: Callable[[slice], np.ndarray], step: int = 1_000_000) -> np.ndarray:
    """``into`` with the values added at their places, in their order, some at a time."""
    for i in range(0, len(places), step):
        np.add.at(into, places[i : i + step], values(slice(i, i + step)))
    return into


def fit_arrays(docs: list[str], labels: np.ndarray, rounds: int = 40, rate: float = 0.4, decay: float = 1e-5, toxic_weight: float = 1.0) -> Model:
    """Full-batch Adam on the documents' log likelihood, in which toxic ones count ``toxic_weight`` times.

    Weights stay nonnegative: a word can make a sentence offensive, and no number of
    harmless words around it can excuse it. Without documents of both labels, every
    score is near 0.
    """
    weights, bias = np.zeros(BUCKETS), BIAS
    y = np.asarray(labels, dtype=float)
    if not len(docs) or not 0 < y.sum() < len(docs):
        return Model(weights, bias)
    buckets, owner, doc_of = encode(docs)
    n, n_s = len(docs), len(doc_of)
    m, v = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for step in range(1, rounds + 1):
        z = bias + added(np.zeros(n_s), owner, lambda some: weights[buckets[some]])  # noqa: B023
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.bincount(doc_of, np.logaddexp(0, np.clip(z, -30, 30)), n)  # -log P(no toxic sentence)
        any_p = np.clip(-np.expm1(-none), 1e-9, 1)
        slope = np.where(y > 0, -toxic_weight * (1 - any_p) / any_p, 1.0)[doc_of] * p / n
        grad = added(np.zeros(BUCKETS), buckets, lambda some: slope[owner[some]]) + decay * weights  # noqa: B023
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights = np.maximum(weights - move, 0)
    return Model(weights, BIAS)


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = 6000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fits on about ``fit_rows`` labelled documents, drawn by a hash of the key; rows with a null label or key are left out.

    The drawn rows (a bounded number) go to one task, which returns the weights.
    """
    lab = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("y"))
    lab = lab.where("doc_id IS NOT NULL AND y IS NOT NULL").dropDuplicates(["doc_id"])
    share = min(1.0, fit_rows / max(1, lab.count()))
    drawn = lab.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = texts(docs, id_col, text_col).join(drawn, "doc_id").repartition(1)

    def fit(batches):
        held = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "y": []}), *batches])
        held = held.sort_values(["doc_id", "text"], kind="stable")
        model = fit_arrays(held["text"].tolist(), held["y"].to_numpy())
        yield pd.DataFrame({"weights": [model.weights.astype("<f4").tobytes()], "bias": [model.bias]})

    fitted = rows.mapInPandas(fit, "weights binary, bias double").first()
    if fitted is None:
        return Model(np.zeros(BUCKETS), BIAS)
    return Model(np.frombuffer(fitted["weights"], dtype="<f4").astype(float), fitted["bias"])


class Scorer(dict):
    """Scores texts with a model; token weights are remembered up to a bound."""

    def __init__(self, model: Model, limit: int = 400_000):
        self.model, self.limit = model, limit

    def __missing__(self, token: str) -> float:
        if len(self) > self.limit:
            self.clear()
        self[token] = value = float(self.model.weights[features(token)].sum())
        return value

    def logits(self, text: str) -> np.ndarray:
        """One for each sentence that holds a token."""
        weight = self.__getitem__
        tokens = [set(piece.split()) for piece in SENTENCE.findall(text.lower())]
        return np.clip(np.array([sum(map(weight, t)) for t in tokens if t], dtype=float) + self.model.bias, -30, 30)

    def score(self, text: str) -> float:
        """Noisy-or over the sentences; 0 for a text without words."""
        return float(-np.expm1(-np.logaddexp(0, self.logits(text)).sum()))

    def locate(self, text: str, least: float = 0.5) -> list[dict]:
        """The offending sentences: (start, end, score), in order of their place."""
        found = []
        for m in SENTENCE.finditer(text):
            for z in self.logits(m.group()):
                if (p := 1 / (1 + math.exp(-z))) >= least:
                    found.append({"start": m.start(), "end": m.end(), "score": p})
        return found


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", spans: bool = True) -> DataFrame:
    """doc_id, score, predicted (1 from 0.5 on) and, with ``spans``, the offending sentences, for each row.

    Null and empty texts score 0. Repeated rows score alike; an empty table gives an
    empty result. The model (a fixed number of weights) is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.weights.astype("<f4"), model.bias))

    def run(batches):
        scorer = Scorer(Model(sent.value[0].astype(float), sent.value[1]))
        for b in batches:
            s = [scorer.score(t) for t in b["text"]]
            out = pd.DataFrame({"doc_id": b["doc_id"], "score": s})
            out["predicted"] = (out["score"] >= 0.5).astype("int32")
            if spans:
                out["sentences"] = [scorer.locate(t) if p >= 0.5 else [] for t, p in zip(b["text"], s, strict=True)]
            yield out

    kind = "doc_id long, score double, predicted int" + (", sentences array<struct<start:int,end:int,score:double>>" if spans else "")
    return texts(docs, id_col, text_col).mapInPandas(run, kind)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text isn't predicted toxic."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights.astype("<f4"), model.bias))

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(Model(sent.value[0].astype(float), sent.value[1]))
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t or "") < 0.5 for t in batch.column(text_col).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
