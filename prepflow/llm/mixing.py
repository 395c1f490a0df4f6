"""Mixing to target weights with soft domains.

A classifier fitted on labelled documents gives each document a probability for every
domain. Document rates r >= 0 are then fitted by projected gradient so that the expected
tokens of each domain, sum(r n p), meet the targets. The gradient steps from rate 1 add up
to one number for each domain, so the rates are a short formula, evaluated in place, and
each step needs only sums (a few numbers). DataFrame and SQL functions only.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, texts, words_of

#: Domains are (quality, toxic) classes of the label table; shares of the mixed tokens.
TARGETS = {"good": 0.75, "poor": 0.17, "toxic": 0.08}
MOST = math.inf  # rates have no upper limit
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE 'poor' END"


def fit_domains(
    docs: DataFrame, labels: DataFrame, domains: list[str], domain: str = DOMAIN, fit_rows: int = 5000, features: int = 1 << 13,
    id_col: str = "doc_id", text_col: str = "text",
) -> PipelineModel | None:
    """A multinomial logistic regression over hashed words, on about ``fit_rows`` labelled rows drawn by a hash of the key.

    Rows with a null key or a domain not named are left out. None without two domains.
    """
    lab = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.expr(domain).alias("domain"))
    code = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")).cast("double") - 1
    lab = lab.withColumn("label", code).where("label >= 0 AND doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    share = min(1.0, fit_rows / max(1, lab.count()))
    drawn = lab.where(F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = texts(docs, id_col, text_col).join(drawn.select("doc_id", "label"), "doc_id")
    rows = settle(rows.select(words_of(F.lower("text")).alias("words"), "label"), "mix-fit")
    if rows.select("label").distinct().count() < 2:
        return None
    stages = [HashingTF(inputCol="words", outputCol="tf", numFeatures=features), Normalizer(inputCol="tf", outputCol="v")]
    fit = LogisticRegression(featuresCol="v", labelCol="label", family="multinomial", maxIter=25, regParam=0.0001, standardization=False)
    return Pipeline(stages=[*stages, fit]).fit(rows)


def posteriors(docs: DataFrame, model: PipelineModel | None, n_domains: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n_tokens (words) and p, an array with a probability for each domain. Without a model all are equal."""
    d = texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text")).withColumn("words", words_of(F.lower("text")))
    if model is None:
        p = F.array(*[F.lit(1.0 / n_domains)] * n_domains)
    else:
        d, p = model.transform(d), vector_to_array("probability")
    p = p if model is None or model.stages[-1].numClasses == n_domains else F.concat(p, F.array_repeat(F.lit(0.0), n_domains - model.stages[-1].numClasses))
    return d.select("doc_id", "text_hash", F.size("words").cast("double").alias("n_tokens"), p.alias("p"))


def rate_sql(step: list[float]) -> str:
    """The rate after the summed gradient ``step`` from rate 1, projected to nonnegative rates, as SQL over ``p``."""
    return "greatest(0.0D, 1.0D" + "".join(f" + p[{k}] * {float(x)!r}D" for k, x in enumerate(step)) + ")"


def fit_rates(weighted: DataFrame, targets: list[float], rounds: int = 200, tolerance: float = 5e-3, pull: float = 1e-6) -> tuple[str, list[float]]:
    """SQL for each document's rate, and the domain totals it gives.

    ``weighted`` has n_tokens and p. Minimises |S - T|^2 + ``pull`` * sum(n (r - 1)^2) over r >= 0, in shares of all tokens, with
    S the domain totals sum(r n p) and T the targets: plain least squares, and of equal totals those rates that
    stay nearest to the present mixture. The optimum has the rates max(0, 1 + p.x), projected from the sum x of
    all gradient steps, with ``pull`` x = T - S. Steps follow the gradient S - T + ``pull`` x of the dual problem,
    preconditioned by the documents with positive rates and halved until they descend; that
    problem is strictly convex, so a vanishing gradient proves the optimum.

    Ends when every total is within ``tolerance`` of its own target (or 1e-9 of all tokens), or
    when the optimum is reached; a RuntimeError if neither is so after ``rounds`` scans. A
    warning names the targets that the optimum misses. Each round is one scan for a few sums.
    """
    k = len(targets)
    total = weighted.agg(F.sum("n_tokens")).first()[0] or 0.0
    if not total:
        return rate_sql([0.0] * k), [0.0] * k
    goal = np.array(targets, dtype=float) / total
    limit = np.maximum(tolerance * goal, 1e-9)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def scan(x):
        """Half the sum of squared rates, the domain shares, and the Gram matrix of the documents with positive rates."""
        state = weighted.select("n_tokens", "p", F.expr(rate_sql(x)).alias("r"))
        parts = [F.sum(F.expr("n_tokens * r * r / 2")).alias("half"), *[F.sum(F.expr(f"n_tokens * r * p[{i}]")).alias(f"s{i}") for i in range(k)]]
        parts += [F.sum(F.expr(f"CASE WHEN r > 0 THEN n_tokens * p[{i}] * p[{j}] ELSE 0.0D END")).alias(f"g{i}_{j}") for i, j in pairs]
        row, gram = state.agg(*parts).first(), np.zeros((k, k))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = row[f"g{i}_{j}"] / total
        return row["half"] / total, np.array([row[f"s{i}"] for i in range(k)]) / total, gram

    x, done = np.zeros(k), 1
    half, sums, gram = scan(x)
    while True:
        gradient = sums - goal + pull * x
        if (met := bool(np.all(np.abs(sums - goal) <= limit))) or np.all(np.abs(gradient) <= np.maximum(0.01 * limit, 1e-8)):
            break
        value = half - goal @ x + pull * x @ x / 2
        step = -np.linalg.solve(gram + pull * np.eye(k), gradient)
        size = 1.0
        while True:
            if done == rounds:
                raise RuntimeError(f"rates didn't settle in {rounds} scans: shares {sums.tolist()} for the targets {goal.tolist()}")
            half, sums, gram = scan(x + size * step)
            done += 1
            after = x + size * step
            # near the optimum values differ by less than they are exact: there the slope decides
            slope = (sums - goal + pull * after) @ step
            if half - goal @ after + pull * after @ after / 2 <= value + 1e-4 * size * (gradient @ step) or abs(slope) <= 0.5 * abs(gradient @ step):
                break
            size /= 2
        x = after
    if not met:
        warnings.warn(f"no rates meet the targets {goal.tolist()}; the nearest shares are {sums.tolist()}", stacklevel=2)
    return rate_sql(x.tolist()), (sums * total).tolist()


def rate_documents(
    docs: DataFrame, labelled: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, domain: str = DOMAIN,
    fit_rows: int = 5000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """For each row of ``docs``: doc_id, text_hash, n_tokens, p, rate and copies.

    ``targets`` are shares of the present number of tokens. ``copies`` rounds the rate up
    or down by a hash of key and text, with the right expectation. ``labelled`` holds the
    texts of the labelled rows. Targets out of reach give a warning and the nearest totals, see
    ``fit_rates``. Null and empty texts have no tokens, and the rate of their
    posterior; repeated rows get equal rates; an empty table gives an empty result.
    """
    names = list(targets)
    model = fit_domains(labelled, labels, names, domain, fit_rows, id_col=id_col, text_col=text_col)
    weighted = settle(posteriors(docs, model, len(names), id_col, text_col), "mix-posteriors")
    total = weighted.agg(F.sum("n_tokens")).first()[0] or 0.0
    rate, _ = fit_rates(weighted, [targets[n] * total for n in names])
    chance = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("copies")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return weighted.withColumn("rate", F.expr(rate)).withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))


