"""Product codes of vectors by integer k-means whose members stay where they lie.

A vector is cut into equal parts; each part position has its own codebook. The rows of
the fit are parts, owned by (position, entry, salt). A pass over the owners assigns their
resident members again and writes those that keep their entry in place, without a shuffle;
only parts that change entry migrate, in the shuffle that feeds the next pass. An entry
that attracts most of the data is dealt over salts, so no owner is large. All arithmetic
is on integers, so codes don't depend on partitions. Only the codebooks reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepflow.sources.scratch import discard, settle_at

SCALE = 4096  # integers per unit
EXACT = 2**52  # squared distances below are exact as doubles
OWNED = 100_000  # parts of one position that an owner holds at most, when all share an entry

Codebooks = list[np.ndarray]  # for each position (entries, width), int64


# ---- arithmetic ------------------------------------------------------------------------


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part (ties: the lower one) and the squared distance, exactly."""
    if len(book) == 0 or len(parts) == 0:
        return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    reach = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
    if parts.shape[1] * (2 * reach) ** 2 < EXACT:
        x, c = parts.astype(np.float64), book.astype(np.float64)
        far = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
        at = far.argmin(axis=1)
        return at, far[np.arange(len(x)), at].astype(np.int64)
    best, at = None, np.zeros(len(parts), np.int64)
    for k, entry in enumerate(book):
        far = ((parts - entry) ** 2).sum(axis=1)
        closer = np.ones(len(parts), bool) if best is None else far < best
        at[closer] = k
        best = far if best is None else np.where(closer, far, best)
    return at, best


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def digest(books: Codebooks) -> str:
    """SHA-256 of all components in decimal by position, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


# ---- rows ------------------------------------------------------------------------------


def valid_vectors(table: DataFrame, parts: int, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, int, int]:
    """vec_id, label and x (the integer vector) of the rows that count, their number and the width of a part."""
    x = F.col("v")
    finite = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    d = table.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    d = d.where(finite & (F.size("v") > 0) & (F.size("v") % parts == 0))
    lead = F.struct(F.col("vec_id").isNull().alias("last"), "vec_id", "v")
    reach = F.max(F.array_max(F.transform(x, F.abs)))
    seen = d.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"), F.min(lead).alias("first"), reach.alias("reach"))
    lowest = seen.orderBy("first.last", "first.vec_id", "first.v").select("size", "n", "reach").first()
    size, n, reach = (lowest["size"], lowest["n"], lowest["reach"]) if lowest else (parts, 0, 0.0)
    if size // parts * (2 * (SCALE * reach + 1)) ** 2 >= 2**63 or n * (SCALE * reach + 1) >= 2**63:
        raise ValueError(f"components up to {reach} don't leave room for exact 64-bit distances")
    return d.where(F.size("v") == size).select("vec_id", "label", F.transform(x, lambda c: F.floor(c * SCALE)).alias("x")), n, size // parts


def first_books(vectors: DataFrame, parts: int, width: int, entries: int) -> Codebooks:
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    x = np.array([r["x"] for r in rows], dtype=np.int64).reshape(len(rows), parts, width)
    return [x[:, i] for i in range(parts)]


# ---- resident members ------------------------------------------------------------------

MEMBERS = "position int, entry int, salt int, part array<bigint>, moved int"


def assign(members: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """The members under the codebooks; ``moved`` is 1 where the entry isn't the owner's."""

    def run(batches):
        for batch in batches:
            position, entry = batch.column("position").to_numpy(), batch.column("entry").to_numpy()
            x, now = matrix(batch.column("part"), width), np.zeros(batch.num_rows, np.int32)
            for p in np.unique(position):
                own = position == p
                now[own] = nearest(x[own], books[p])[0]
            moved = (now != entry).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(now), batch.column("salt"), batch.column("part"), pa.array(moved)], names=["position", "entry", "salt", "part", "moved"])

    return members.select("position", "entry", "salt", "part").mapInArrow(run, MEMBERS)


def update(members: DataFrame, books: Codebooks, width: int) -> Codebooks:
    """Each entry's floored mean over its members; entries without members stay."""
    sums = members.groupBy("position", "entry").agg(F.count("*").alias("n"), F.array(*[F.sum(F.col("part")[i]) for i in range(width)]).alias("total"))
    new = [b.copy() for b in books]
    for r in sums.collect():  # at most positions x entries rows
        new[r["position"]][r["entry"]] = [s // r["n"] for s in r["total"]]
    return new


def train(vectors: DataFrame, n: int, parts: int, width: int, entries: int = 16, rounds: int = 6) -> Codebooks:
    """Codebooks after ``rounds`` rounds of assigning and updating, or at a fixed point before."""
    spark = vectors.sparkSession
    books = first_books(vectors, parts, width, entries)
    if not n or not rounds:
        return books
    salts = max(1, -(-n // OWNED))
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.slice("x", i * width + 1, F.lit(width)))
    members = vectors.select(F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias("salt"), F.posexplode(cut).alias("position", "part"))
    members, path = settle_at(assign(members.withColumn("entry", F.lit(-1)), books, width), "members", ("moved",))
    for left in range(rounds - 1, -1, -1):
        before, books = books, update(members, books, width)
        if not left or all(np.array_equal(a, b) for a, b in zip(before, books, strict=True)):
            break
        arriving = members.where("moved = 1").drop("moved").repartition("position", "entry", "salt")
        old = path
        members, path = settle_at(assign(members.where("moved = 0").drop("moved").unionByName(arriving), books, width), "members", ("moved",))
        discard(spark, old)
    discard(spark, path)
    return books


# ---- codes -----------------------------------------------------------------------------


def encode(vectors: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """vec_id, label, code (two hex digits for each part) and error (squared distances summed) of each vector."""
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("x"), width * len(books)).reshape(batch.num_rows, len(books), width)
            at = np.zeros((batch.num_rows, len(books)), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for p, book in enumerate(books):
                entry, far = nearest(x[:, p], book)
                at[:, p] = entry
                error += far
            code = pa.array([row.tobytes().hex() for row in at], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), code, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return vectors.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(
    table: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error (errors of all rows with the same label) and codebooks_sha256.

    Rows whose vector is null, or holds null or non-finite components, are dropped; so are
    vectors that can't be cut into ``parts`` equal parts (empty ones too) and those of another length than the valid
    vector with the smallest id. The first entries are the vectors with the smallest ids: null ids come
    last, equal ids go by the vector. Fewer than ``entries`` vectors give fewer entries. Repeated
    rows are rows of their own, null labels form one group, an empty table gives no rows, and
    other columns are ignored. Components so large that a distance would not fit into 64 bits raise an error.
    At most 256 entries, for an index has two hex digits.
    """
    if not 0 < entries <= 256:
        raise ValueError("an index of two hex digits allows 1 to 256 entries")
    vectors, n, width = valid_vectors(table, parts, id_col, vector_col, label_col)
    books = train(vectors, n, parts, width, entries, rounds)
    coded, _ = settle_at(encode(vectors, books, width), "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    both = coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return both.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def compress_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The same over the table ``embeddings``, for vectors of one length."""
    steps = [
        f"""WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, i AS pos, x[i * len(x) // {parts} + 1:(i + 1) * len(x) // {parts}] AS x FROM k, range({parts}) t(i)),
c0 AS MATERIALIZED (SELECT pos, r - 1 AS e, x AS c FROM p WHERE r <= {entries})"""
    ]
    near = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, pos, any_value(x) AS x, min({near} * 256 + e) AS m FROM p JOIN c{i} USING (pos) GROUP BY r, pos)")
        if i < rounds:
            steps.append(
                f"""u{i} AS (SELECT pos, m % 256 AS e, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM a{i}),
f{i} AS (SELECT pos, e, j, sum(v)::BIGINT AS s, count(*) AS n FROM u{i} GROUP BY pos, e, j),
g{i} AS (SELECT pos, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM f{i} GROUP BY pos, e),
c{i + 1} AS MATERIALIZED (SELECT o.pos, o.e, coalesce(g.c, o.c) AS c FROM c{i} o LEFT JOIN g{i} g ON o.pos = g.pos AND o.e = g.e)"""
            )
    steps.append(
        f"""done AS (SELECT r, string_agg(printf('%02x', m % 256), '' ORDER BY pos) AS code, sum(m // 256)::BIGINT AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY pos, e)) AS s FROM c{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (SELECT s FROM h) AS codebooks_sha256 FROM k JOIN done USING (r)"""
    )
    return ",\n".join(steps)
