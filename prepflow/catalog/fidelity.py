"""Queries that send awkward text through CSV files and back."""

from __future__ import annotations

from pyspark.sql import functions as F

from prepflow.catalog.registry import query
from prepflow.sources import files
from prepflow.sources.scratch import scratch_path

_TEXT_SQL = (
    "select 'd' || doc_id::varchar as key, case when doc_id % 7 = 0 then null when doc_id % 11 = 0 then '\\N' when doc_id % 5 = 0 then '' "
    "when doc_id % 3 = 0 then '  \"' || text || '\\ ' else text end as text from documents "
    "union all select 'c' || conv_id::varchar || '-' || turn::varchar, chr(10) || text || chr(10) from conversations"
)


@query("csv_text_roundtrip", _TEXT_SQL)
def csv_text_roundtrip(spark, folder):
    """Texts with newlines, quotes, backslashes, blanks at the ends, empty, null and the null mark itself, written as CSV and read again."""
    docs = files.read_parquet(spark, folder, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("key"),
        F.when(F.col("doc_id") % 7 == 0, None)
        .when(F.col("doc_id") % 11 == 0, "\\N")
        .when(F.col("doc_id") % 5 == 0, "")
        .when(F.col("doc_id") % 3 == 0, F.concat(F.lit('  "'), "text", F.lit("\\ ")))
        .otherwise(F.col("text"))
        .alias("text"),
    )
    turns = files.read_parquet(spark, folder, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("key"), F.concat(F.lit("\n"), "text", F.lit("\n")).alias("text")
    )
    both = docs.union(turns)
    return files.read_csv(spark, files.write_csv(both, scratch_path(spark, "csv")), both.schema)
