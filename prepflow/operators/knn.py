"""Exact k-nearest-neighbour classification as a partitioned join.

Training vectors are grouped into cells around pivot vectors. A cell's radii give,
for each query, an upper bound for the distance to its k-th neighbour and a lower
bound for every cell (triangle inequality), so a query visits only cells that can
hold a neighbour. Cells near each other form groups, and a query is sent once to a group,
however many of its cells it visits. A group's rows and its visitors are cut into blocks of bounded size;
a task meets one block of each, cell by cell, and returns at most k neighbours per query. A training
row is copied once for each block of visitors of its own group, and not at all when
nobody visits the group.

The idea follows Lu, Shen, Chen and Ooi, "Efficient processing of k nearest
neighbor joins using MapReduce", PVLDB 2012.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepflow.functions.scalars import stable_hash
from prepflow.sources.scratch import settle

MAX_PIVOTS = 1024
BLOCK_ROWS = 20_000
SLICE_ROWS = 256
PAIRS_AT_ONCE = 200_000
TIE = 2e-9  # distances are compared after rounding to nine decimals


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By the expanded square: fast, and off by up to ``_rounding``."""
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _rounding(scale, dims: int):
    """Bound of the error of ``_distances`` between vectors whose lengths add up to ``scale``."""
    return 2.0 * np.sqrt(np.finfo(float).eps * (dims + 4)) * scale


def _lengths(a: np.ndarray) -> np.ndarray:
    return np.sqrt((a * a).sum(1))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def _slices(rows: int):
    return (slice(i, i + SLICE_ROWS) for i in range(0, rows, SLICE_ROWS))


def _nearest(asked: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of asked, row of points, distance) of the ``k`` nearest points of each asked row.

    Those that may be among them by the fast distance are measured again by the
    differences of their coordinates. Equal distances go by the order of ``points``.
    """
    centre = points.mean(0)
    fast = _distances(asked - centre, points - centre)
    scale = _lengths(asked - centre) + _lengths(points - centre).max()
    bound = np.partition(fast, k - 1, axis=1)[:, k - 1] + 2 * _rounding(scale, points.shape[1]) + TIE
    q, p = np.nonzero(fast <= bound[:, None])
    exact = np.concatenate(
        [_lengths(asked[q[i : i + PAIRS_AT_ONCE]] - points[p[i : i + PAIRS_AT_ONCE]]) for i in range(0, len(q), PAIRS_AT_ONCE)]
    ).round(9)
    order = np.lexsort((p, exact, q))
    q, p, exact = q[order], p[order], exact[order]
    first = np.searchsorted(q, q)
    best = np.arange(len(q)) - first < k
    return q[best], p[best], exact[best]


def _best(parts: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (row of asked, row of points, distance), the ``k`` nearest points of each asked row; ties go by the order of points."""
    q, p, distance = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((p, distance, q))
    q, p, distance = q[order], p[order], distance[order]
    best = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[best], p[best], distance[best]


def nearest_neighbours(
    train: DataFrame, queries: DataFrame, key: str, vector: str, label: str, k: int = 5, skip_self: bool = False
) -> DataFrame:
    """The ``k`` nearest training rows of each query row: query key, neighbour key,
    its label, distance and rank. Distances that agree to nine decimals tie, and ties
    go to the smaller neighbour key.

    With ``skip_self`` a row is not its own neighbour. Rows with a null vector are
    nobody's neighbours and have none.
    """
    need = k + int(skip_self)
    points = train.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.col(label).alias("label")).where("v IS NOT NULL")
    asked = queries.select(F.col(key).alias("q"), F.col(vector).alias("v")).where("v IS NOT NULL")
    n_pivots = max(1, min(math.isqrt(points.count()), MAX_PIVOTS))
    rows = points.select("v", stable_hash(F.col("id")).alias("h"), "id").orderBy("h", "id").limit(n_pivots).collect()
    if not rows:
        return _ranked(asked.sparkSession.createDataFrame([], _found_schema(points, asked)), k)
    pivots = np.array([r.v for r in rows], dtype="float64")
    centre = pivots.mean(0)
    pivots -= centre
    reach_of_pivots, dims = _lengths(pivots).max(), pivots.shape[1]

    def to_cells(batches):
        for pdf in batches:
            if len(pdf):
                v = _matrix(pdf["v"]) - centre
                d = [_distances(v[s], pivots) for s in _slices(len(v))]
                pdf["cell"] = np.concatenate([x.argmin(1) for x in d])
                pdf["radius"] = np.concatenate([x.min(1) for x in d])
                yield pdf

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
    placed = settle(points.mapInPandas(to_cells, f"{fields}, cell int, radius double"), "knn-cells")
    cells = placed.groupBy("cell").agg(
        F.min("radius").alias("near"), F.max("radius").alias("far"), F.count(F.lit(1)).alias("n")
    ).orderBy("cell").toPandas()
    ids, near, far, sizes = (cells[c].to_numpy() for c in ("cell", "near", "far", "n"))

    # a query travels to a group of cells once, however many of them it visits
    n_groups = max(-(-int(sizes.sum()) // BLOCK_ROWS), 3 * asked.sparkSession.sparkContext.defaultParallelism)
    group_of = _distances(pivots[ids], pivots[ids[:n_groups]]).argmin(1)

    def least_distance(v, some=slice(None)):
        d = _distances(v, pivots[ids[some]])
        return d, np.maximum(np.maximum(d - far[some], near[some] - d), 0.0)

    def open_groups(v):
        d, least = least_distance(v)
        reach = d + far
        order = reach.argsort(1)
        enough = sizes[order].cumsum(1) >= need
        at = np.where(enough.any(1), enough.argmax(1), len(ids) - 1)
        bound = np.take_along_axis(reach, order, 1)[np.arange(len(d)), at]
        # four measured distances take part in the comparison
        bound += 4 * _rounding(_lengths(v) + 2 * reach_of_pivots + far.max(), dims) + TIE
        return [np.unique(group_of[m]).tolist() for m in least <= bound[:, None]], bound

    def to_candidates(batches):
        for pdf in batches:
            if len(pdf):
                v = _matrix(pdf["v"]) - centre
                found = [open_groups(v[s]) for s in _slices(len(v))]
                pdf["groups"] = [g for groups, _ in found for g in groups]
                pdf["bound"] = np.concatenate([bound for _, bound in found])
                yield pdf

    asked_fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema.fields)
    visits = settle(asked.mapInPandas(to_candidates, f"{asked_fields}, groups array<int>, bound double"), "knn-visits")
    groups = asked.sparkSession.createDataFrame(list(zip(ids.tolist(), group_of.tolist(), strict=True)), "cell int, grp int")
    placed = placed.join(F.broadcast(groups), "cell")
    # one row for each group: how many blocks its rows and its visitors are cut into
    block_count = lambda n: F.ceil(F.col(n) / BLOCK_ROWS).cast("bigint")
    visitors = visits.select(F.explode("groups").alias("grp")).groupBy("grp").agg(F.count(F.lit(1)).alias("asking"))
    plan = placed.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).join(visitors, "grp")
    plan = F.broadcast(settle(plan.select("grp", block_count("n").alias("blocks"), block_count("asking").alias("chunks")), "knn-plan"))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = placed.join(plan, "grp").select(
        "id", "v", "label", "cell", "grp", F.pmod(stable_hash(F.col("id")), "blocks").alias("block"), numbers("chunks").alias("chunk")
    )
    right = visits.select("q", "v", "bound", F.explode("groups").alias("grp")).join(plan, "grp").select(
        "q", "v", "bound", "grp", F.pmod(stable_hash(F.col("q")), "chunks").alias("chunk"), numbers("blocks").alias("block")
    )

    def meet(block: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        """The best of the block for each visitor, which meets only the cells within its bound."""
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))  # row of some, row of block, distance
        if len(block) and len(some):
            block = block.sort_values("id")
            t, cell_of = _matrix(block["v"]), block["cell"].to_numpy()
            here = np.searchsorted(ids, np.unique(cell_of))
            wanted, bound = _matrix(some["v"]), some["bound"].to_numpy()
            open_to = np.concatenate([least_distance(wanted[s] - centre, here)[1] <= bound[s, None] for s in _slices(len(some))])
            parts, held = [found], 0
            for i, c in enumerate(ids[here]):
                rows, visiting = np.flatnonzero(cell_of == c), np.flatnonzero(open_to[:, i])
                for s in _slices(len(visiting)):
                    q, p, distance = _nearest(wanted[visiting[s]], t[rows], min(need, len(rows)))
                    parts.append((visiting[s][q], rows[p], distance))
                    held += len(q)
                if held > PAIRS_AT_ONCE:
                    parts, held = [_best(parts, need)], 0
            found = _best(parts, need)
        q, p, distance = found
        return pd.DataFrame({"q": some["q"].to_numpy()[q], "id": block["id"].to_numpy()[p], "label": block["label"].to_numpy()[p], "distance": distance})

    place = ["grp", "block", "chunk"]
    found = left.groupBy(*place).cogroup(right.groupBy(*place)).applyInPandas(meet, _found_schema(points, asked))
    if skip_self:
        found = found.where(F.col("q") != F.col("id"))
    return _ranked(found, k)


def _found_schema(points: DataFrame, asked: DataFrame) -> str:
    q, i, lab = asked.schema["q"], points.schema["id"], points.schema["label"]
    kinds = [f.dataType.simpleString() for f in (q, i, lab)]
    return f"q {kinds[0]}, id {kinds[1]}, label {kinds[2]}, distance double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Best ``k`` per query among its few candidates per visited block."""
    rank = F.row_number().over(Window.partitionBy("q").orderBy("distance", "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def knn_classify(
    train: DataFrame, queries: DataFrame, key: str, vector: str, label: str, k: int = 5, skip_self: bool = False
) -> DataFrame:
    """Majority label of the ``k`` nearest training rows; ties go to the smallest label."""
    near = nearest_neighbours(train, queries, key, vector, label, k, skip_self)
    votes = near.groupBy("q", "label").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), "label")).alias("best")
    return votes.groupBy("q").agg(best).select(F.col("q").alias(key), F.col("best.label").alias("predicted"))
