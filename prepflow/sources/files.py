"""CSV and Parquet files."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepflow.functions.scalars import named

#: Both directions, so that text survives: quotes are doubled, blanks kept, null and empty text differ.
TEXT_RULES = {
    "escape": '"', "nullValue": "\\N", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
#: Text that is the null mark, or the mark with backslashes before it, is written with one more and read with one less.
MARK_WRITTEN, MARK_READ = r"^(\\+N)$", r"^\\(\\+N)$"


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred by an extra pass.

    Cells may hold newlines, for which a file is read by one task; ``multi_line=False`` splits
    large files of which no cell holds one. The mark ``\\N`` is null and ``\\\\N`` the text of the mark.
    """
    reader = spark.read.option("header", True).options(**TEXT_RULES).options(multiLine=multi_line, emptyValue="")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return _each_text(reader.csv(path), MARK_READ, "$1")


def _each_text(df: DataFrame, pattern: str, new: str) -> DataFrame:
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.regexp_replace(named(c), pattern, new).alias(c) if c in texts else named(c) for c in df.columns])


def csv_safe(df: DataFrame) -> DataFrame:
    """Vector and array columns as JSON text, because CSV cells hold scalars only."""
    cols = []
    for field in df.schema.fields:
        col = named(field.name)
        kind = field.dataType.typeName()
        if kind in ("udt", "vectorudt"):
            col = F.to_json(vector_to_array(col))
        elif kind in ("array", "map", "struct"):
            col = F.to_json(col)
        cols.append(col.alias(field.name))
    return _each_text(df.select(*cols), MARK_WRITTEN, r"\\$1")


def write_csv(
    df: DataFrame,
    path: str,
    files: int | None = None,
    partition_by: tuple[str, ...] = (),
    max_rows_per_file: int | None = None,
) -> str:
    """Overwrite ``path`` with CSV files that carry a header.

    ``files`` sets the number of output files by a shuffle, which leaves the work
    before it parallel; left out, every partition writes its own. ``partition_by`` lays the rows out as ``column=value`` folders.
    """
    out = csv_safe(df)
    if files is not None:
        out = out.repartition(files)
    writer = out.write.mode("overwrite").option("header", True).options(**TEXT_RULES)
    if max_rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if partition_by:  # a few tasks for each folder instead of all of them
        salt = F.pmod(F.xxhash64(*out.columns), F.lit(8))
        out = out.repartition(*partition_by, salt) if files is None else out
        writer = out.write.mode("overwrite").option("header", True).options(**TEXT_RULES)
        if max_rows_per_file is not None:
            writer = writer.option("maxRecordsPerFile", max_rows_per_file)
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
    return path


def stage_path(root: str, process: str, template: str, product: str, algorithm: str, stage: str) -> str:
    """Output folder of one stage of one run."""
    return "/".join([root.rstrip("/"), process, template, product, algorithm, stage])
