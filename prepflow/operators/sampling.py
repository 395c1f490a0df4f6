"""Class resampling and train/test splits that do not depend on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepflow.functions.scalars import stable_hash, wide_hash
from prepflow.operators.aggregate import value_counts
from prepflow.operators.joins import lookup_join
from prepflow.operators.ranking import number_rows
from prepflow.sources.scratch import settle

HASH_RANGE = 2**32
ROWS_PER_CELL = 50_000
MAX_CELL_BITS = 16
DRAWS_PER_COPY = 65_536
FEW_DRAWS = 4


def number_in_class(df: DataFrame, label: str, key: str, seed: int, total: int) -> DataFrame:
    """Add ``position``: 0-based place of each row in its class, ordered by the hash of its key.

    The hash range is cut into cells of about ``ROWS_PER_CELL`` rows, up to 65,536
    of them. Rows are numbered inside a cell and shifted by the sizes of the cells
    before, so a class of any size is spread over many tasks. The numbers are the
    same for any number of cells. ``key`` must be unique.
    """
    bits = min(math.ceil(math.log2(max(total / ROWS_PER_CELL, 1))), MAX_CELL_BITS)
    h = stable_hash(F.lit(seed), F.col(key))
    hashed = df.withColumn("_h", h).withColumn("_cell", F.shiftright("_h", 32 - bits))
    inside = F.row_number().over(Window.partitionBy(label, "_cell").orderBy("_h", key)) - 1
    numbered = hashed.withColumn("position", inside.cast("bigint"))
    if bits:
        before = Window.partitionBy(label).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        sizes = (
            df.select(label, F.shiftright(h, 32 - bits).alias("_cell"))
            .groupBy(label, "_cell")
            .agg(F.count(F.lit(1)).alias("_n"))
            .select(label, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
        )
        numbered = numbered.join(sizes, [label, "_cell"]).withColumn("position", F.col("position") + F.col("_shift"))
        numbered = numbered.drop("_shift")
    return numbered.drop("_h", "_cell")


def resample(df: DataFrame, label: str, key: str, mode: str, seed: int = 12345) -> DataFrame:
    """Draw rows with replacement until every class has the size of the smallest
    (``down``) or largest (``up``) one. Adds ``draw``, the number of the draw in its class.

    Draw ``i`` of a class takes the row at position ``hash(seed, class, i) mod
    class size``. When a small class is drawn very often its rows are copied
    first and the draws spread over the copies, so that no join key gets more
    than about ``DRAWS_PER_COPY`` draws.

    When there are fewer than one draw per ``FEW_DRAWS`` rows, only keys are
    numbered and shuffled, and the full rows are looked up by the drawn keys.
    """
    known = df.where(F.col(label).isNotNull())
    classes = number_rows(value_counts(known, label), [F.col(label).asc()], "class_no")
    facts = classes.agg(
        F.min("count").alias("min"), F.max("count").alias("max"), F.sum("count").alias("n"), F.count("*").alias("k")
    ).first()
    if not facts.k:
        return df.withColumn("draw", F.lit(None).cast("bigint"))
    size = {"down": facts.min, "up": facts.max}[mode]

    per_copy = F.col("count") * DRAWS_PER_COPY
    copies = F.greatest(F.ceil(F.lit(size) / per_copy), F.lit(1)).cast("bigint")
    classes = classes.select(label, F.col("count").alias("_class_size"), "class_no", copies.alias("_copies"))

    few = size * facts.k * FEW_DRAWS <= facts.n
    rows = number_in_class(known.select(label, key) if few else known, label, key, seed, facts.n)
    if size <= facts.min * DRAWS_PER_COPY:  # no class needs more than one copy
        rows = rows.withColumn("_copy", F.lit(0).cast("bigint"))
    else:
        rows = lookup_join(rows, classes.select(label, "_copies"), label)
        numbers = F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)
        rows = rows.withColumn("_copy", F.explode(numbers)).drop("_copies")

    wanted = size * facts.k
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, wanted // 1_000_000)
    draws = spark.range(0, wanted, 1, tasks).select(
        F.expr(f"id div {size} + 1").alias("class_no"), (F.col("id") % size).alias("draw")
    )
    draws = lookup_join(draws, classes, "class_no").select(
        F.col(label),
        "draw",
        (wide_hash(F.lit(seed), F.col(label), F.col("draw")) % F.col("_class_size")).alias("position"),
        (F.col("draw") % F.col("_copies")).alias("_copy"),
    )
    drawn = draws.join(rows, [label, "position", "_copy"])
    if few:
        drawn = known.join(settle(drawn.select(key, "draw"), "draws"), key)
    return drawn.select(*df.columns, "draw")


def resample_each(df: DataFrame, labels: list[str], key: str, mode: str, seed: int = 12345) -> DataFrame:
    """Resample once per label column and stack the results; ``by`` names the label."""
    out = None
    for label in labels:
        part = resample(df, label, key, mode, seed).withColumn("by", F.lit(label))
        out = part if out is None else out.unionByName(part)
    return out


def split_random(df: DataFrame, fraction: float = 0.8, seed: int = 12345) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split. The rows it picks depend on the partitioning."""
    train, test = df.randomSplit([fraction, 1 - fraction], seed=seed)
    return train, test


def train_flag(key: str, fraction: float = 0.8, seed: int = 12345):
    """True for about ``fraction`` of the keys (exact to 2^-60), always the same ones."""
    return wide_hash(F.lit(seed), F.col(key)) < F.lit(int(fraction * (1 << 60)))


def split_hash(df: DataFrame, key: str, fraction: float = 0.8, seed: int = 12345) -> tuple[DataFrame, DataFrame]:
    flag = train_flag(key, fraction, seed)
    return df.where(flag), df.where(~flag)


def split_exact(df: DataFrame, key: str, test_fraction: float, seed: int = 12345) -> DataFrame:
    """Add ``in_test``, true for exactly ``ceil(n * test_fraction)`` rows.

    They are the rows with the smallest key hashes. A histogram of the hash's
    upper half, at most 65,536 counts, finds the cell where the quota runs out,
    and only that cell's rows are sorted. ``key`` must be unique.
    """
    h = stable_hash(F.lit(seed), F.col(key))
    cell = F.shiftright(h, 16)
    counts = df.select(cell.alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    running = counts.select(
        "cell",
        "n",
        F.sum("n").over(Window.orderBy("cell")).alias("upto"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    quota = F.ceil(F.round(F.col("total") * F.lit(test_fraction), 6))
    edge = (
        running.withColumn("quota", quota)
        .where(F.col("upto") >= F.col("quota"))
        .agg(F.min(F.struct("cell", (F.col("quota") - F.col("upto") + F.col("n")).alias("take"))).alias("e"))
        .first()
        .e
    )
    if edge is None or edge.take <= 0:
        return df.withColumn("in_test", F.lit(False))
    place = F.struct(h.alias("h"), F.col(key).alias("k"))
    first = df.where(cell == edge.cell).select(place.alias("p")).orderBy("p").limit(edge.take)
    last = first.agg(F.max("p").alias("p")).first().p
    return df.withColumn("in_test", place <= F.struct(F.lit(last.h).alias("h"), F.lit(last.k).alias("k")))
