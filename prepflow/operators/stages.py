"""Pipeline stages that MLlib lacks: filling missing cells, category codes kept as a table, sparse vectors.

They are written and read with the pipeline they are part of. Codes never pass through the
driver: they are a stored table that rows are joined to, so a column may have millions of categories.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepflow.operators.clean import FittedImputer, apply_imputer, fit_imputer_both
from prepflow.operators.columns import split_by_type
from prepflow.operators.encode import fit_index
from prepflow.sources.scratch import settle_at


def quoted(name: str) -> Column:
    """A column by its name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """A sparse vector from ascending positions and their values, without leaving the JVM."""
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"))
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]


# ---- missing cells ---------------------------------------------------------------------


class _Filling(Params):
    strategy = Param(Params._dummy(), "strategy", "mean, median, mode or constant; text takes its mode for the first two", TypeConverters.toString)
    leaveOut = Param(Params._dummy(), "leaveOut", "columns that stay as they are", TypeConverters.toListString)


class FillMissing(Estimator, _Filling, DefaultParamsReadable, DefaultParamsWritable):
    """Learns one replacement for each text and number column of the rows it is fitted on."""

    @keyword_only
    def __init__(self, *, strategy: str = "median", leaveOut: list[str] = ()):
        super().__init__()
        self._set(strategy=strategy, leaveOut=list(leaveOut))

    def _fit(self, df: DataFrame) -> FillMissingModel:
        fitted = fit_imputer_both(df, self.getOrDefault("strategy"), leave_out=tuple(self.getOrDefault("leaveOut")))
        model = FillMissingModel()
        model._set(replacements={c: [fitted.types[c], None if v is None else str(v)] for c, v in fitted.values.items()})
        return model


class FillMissingModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Null and NaN cells become the learnt value; columns that a frame lacks are passed over."""

    replacements = Param(Params._dummy(), "replacements", "type and value (as text) by column", TypeConverters.identity)

    def _transform(self, df: DataFrame) -> DataFrame:
        learnt = self.getOrDefault("replacements")
        return apply_imputer(df, FittedImputer({c: v for c, (_, v) in learnt.items()}, {c: t for c, (t, _) in learnt.items()}))


# ---- codes -----------------------------------------------------------------------------


class _Coding(Params):
    columns = Param(Params._dummy(), "columns", "text columns; a code goes to <column>_code", TypeConverters.toListString)
    invalid = Param(Params._dummy(), "invalid", "unknown and null values: error, skip the row, or keep as one more category", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "number of categories by column", TypeConverters.identity)


class CategoryCodes(Estimator, _Coding, DefaultParamsReadable, DefaultParamsWritable):
    """Codes by falling frequency, ties in text order. Each column's table is numbered in parallel and stays on the shared store."""

    @keyword_only
    def __init__(self, *, columns: list[str] = (), invalid: str = "error"):
        super().__init__()
        if invalid not in ("error", "skip", "keep"):
            raise ValueError(f"invalid must be error, skip or keep, not {invalid!r}")
        self._set(columns=list(columns), invalid=invalid)

    def _fit(self, df: DataFrame) -> CategoryCodesModel:
        names = self.getOrDefault("columns")
        model = CategoryCodesModel()
        model.tables = {c: settle_at(fit_index(df.select(quoted(c).alias("value")), "value"), "codes")[0] for c in names}
        model._set(columns=names, invalid=self.getOrDefault("invalid"), sizes={c: t.count() for c, t in model.tables.items()})
        return model


class CategoryCodesModel(Model, _Coding, MLReadable, MLWritable):
    """Joins rows to the code tables; small tables are broadcast, large ones shuffled, as their true sizes tell."""

    tables: dict[str, DataFrame]

    def _transform(self, df: DataFrame) -> DataFrame:
        invalid, out = self.getOrDefault("invalid"), df
        for c, size in self.getOrDefault("sizes").items():
            code = f"{c}_code"
            own = self.tables[c].select(F.col("value").alias("_value"), F.col("code").cast("double").alias("_coded"))
            joined = out.join(own, quoted(c) == F.col("_value"), "left").drop("_value")
            if invalid == "skip":
                joined = joined.where("_coded IS NOT NULL")
            missing = F.lit(float(size))
            if invalid == "error":
                told = F.concat(F.lit(f"{c} has a value without a code: "), F.coalesce(quoted(c), F.lit("null")))
                missing = F.raise_error(told).cast("double")
            out = joined.withColumn(code, F.coalesce("_coded", missing)).drop("_coded")
        return out

    def width(self, column: str) -> int:
        return self.getOrDefault("sizes")[column] + (self.getOrDefault("invalid") == "keep")

    def write(self) -> MLWriter:
        return _CodesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CodesReader()


class _CodesWriter(MLWriter):
    def __init__(self, model: CategoryCodesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for i, table in enumerate(self.model.tables.values()):
            table.write.parquet(f"{path}/codes/{i}")


class _CodesReader(MLReader):
    def load(self, path: str) -> CategoryCodesModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = CategoryCodesModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.tables = {c: spark.read.parquet(f"{path}/codes/{i}") for i, c in enumerate(model.getOrDefault("columns"))}
        return model


# ---- vectors ---------------------------------------------------------------------------


class SparseFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """One indicator for each category, then the numbers, as a sparse vector. A null number raises an error: fill it before."""

    widths = Param(Params._dummy(), "widths", "indicator entries by text column", TypeConverters.identity)
    numbers = Param(Params._dummy(), "numbers", "number columns", TypeConverters.toListString)
    output = Param(Params._dummy(), "output", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, widths: dict[str, int] | None = None, numbers: list[str] = (), output: str = "features"):
        super().__init__()
        self._set(widths=widths or {}, numbers=list(numbers), output=output)

    def _transform(self, df: DataFrame) -> DataFrame:
        entries, at = [], 0
        for c, width in self.getOrDefault("widths").items():
            entries.append(F.struct((F.lit(at) + quoted(f"{c}_code").cast("int")).alias("i"), F.lit(1.0).alias("x")))
            at += width
        for c in self.getOrDefault("numbers"):
            told = F.raise_error(F.lit(f"{c} has a null: fill it before")).cast("double")
            entries.append(F.struct(F.lit(at).alias("i"), F.coalesce(quoted(c).cast("double"), told).alias("x")))
            at += 1
        some = F.filter(F.array(*entries), lambda e: e["x"] != 0) if entries else F.array().cast("array<struct<i:int,x:double>>")
        vector = sparse_vector(at, F.transform(some, lambda e: e["i"]), F.transform(some, lambda e: e["x"]))
        return df.withColumn(self.getOrDefault("output"), vector)


class VectorStages(Estimator):
    """Fits codes for all text columns of a frame and lays out the vector with its numbers."""

    @keyword_only
    def __init__(self, *, leaveOut: list[str] = (), invalid: str = "error", output: str = "features"):
        super().__init__()
        self.leave_out, self.invalid, self.output = tuple(leaveOut), invalid, output

    def _fit(self, df: DataFrame):
        from pyspark.ml import PipelineModel

        kinds = split_by_type(df, self.leave_out)
        codes = CategoryCodes(columns=kinds.categorical, invalid=self.invalid).fit(df)
        layout = SparseFeatures(widths={c: codes.width(c) for c in kinds.categorical}, numbers=kinds.continuous, output=self.output)
        return PipelineModel(stages=[codes, layout])

