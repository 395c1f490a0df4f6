"""Queries over tables: sources and sinks, filters, joins, aggregates, mutations.

The employee table of the tutorial queries is the customer table under other
names: key as ``id`` and ``eno``, name, balance as ``esal``, segment as ``eaddr``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from prepflow.catalog.registry import query
from prepflow.functions import scalars
from prepflow.functions.lookups import all_of, exclude_rows, filter_rows, get_one
from prepflow.operators import aggregate, columns, joins, mutate, quantiles, reshape
from prepflow.sources import audit, files, manifest, tables
from prepflow.sources.scratch import scratch_path

EMP = "(select c_custkey as id, c_custkey as eno, c_name as ename, c_acctbal as esal, c_mktsegment as eaddr from customer)"
EMP_GAPS = (
    "(select c_custkey as id, c_custkey as eno, c_name as ename, "
    "case when c_custkey % 7 <> 0 then c_acctbal end as esal, "
    "case when c_custkey % 5 <> 0 then c_mktsegment end as eaddr from customer)"
)
ORD_GAPS = (
    "(select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 7 <> 0 then o_totalprice end as o_totalprice, "
    "case when o_orderkey % 5 <> 0 then o_orderpriority end as o_orderpriority from orders)"
)


def round_sql(value, digits=4):
    """Means of cents often end in exactly half a unit of the last digit, where the
    engines' last bits decide; a small offset moves such values off the edge.
    """
    return f"round({value} + 1e-{digits + 3}, {digits}) + 0.0"


def rounded(df, keep, digits=4):
    """All columns but ``keep`` rounded as ``round_sql`` does."""
    offset = F.lit(10.0 ** -(digits + 3))
    return df.select(*keep, *[(F.round(F.col(c) + offset, digits) + F.lit(0.0)).alias(c) for c in df.columns if c not in keep])


def employees(spark, folder):
    return files.read_parquet(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").alias("eno"),
        F.col("c_name").alias("ename"),
        F.col("c_acctbal").alias("esal"),
        F.col("c_mktsegment").alias("eaddr"),
    )


def employees_with_gaps(spark, folder):
    """The test tables hold no nulls, so some are put in by key."""
    return employees(spark, folder).withColumns(
        {"esal": F.when(F.col("id") % 7 != 0, F.col("esal")), "eaddr": F.when(F.col("id") % 5 != 0, F.col("eaddr"))}
    )


def orders(spark, folder):
    return files.read_parquet(spark, folder, "orders")


def orders_with_gaps(spark, folder):
    return orders(spark, folder).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def orders_by_month(spark, folder):
    return orders(spark, folder).withColumn("ym", F.date_format("o_orderdate", "yyyy-MM"))


def lineitem(spark, folder):
    return files.read_parquet(spark, folder, "lineitem")


def events(spark, folder):
    return files.read_parquet(spark, folder, "events")


# ---- sources and sinks -------------------------------------------------------


@query("scan_all", f"select * from {EMP}")
def scan_all(spark, folder):
    return employees(spark, folder)


@query("csv_roundtrip", "select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def csv_roundtrip(spark, folder):
    """Written as CSV below one folder per brand, read back with an explicit schema."""
    part = files.read_parquet(spark, folder, "part")
    root = scratch_path(spark, "csv")
    path = files.stage_path(root, "p1", "t1", "parts", "none", "cleanse")
    files.write_csv(part, path, partition_by=("p_brand",))
    kinds = dict(part.dtypes)
    ordered = [c for c in part.columns if c != "p_brand"] + ["p_brand"]
    back = files.read_csv(spark, path, ", ".join(f"{c} {kinds[c]}" for c in ordered))
    return back.select(part.columns)


@query("csv_inferred", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def csv_inferred(spark, folder):
    supplier = files.read_parquet(spark, folder, "supplier")
    path = files.write_csv(supplier, scratch_path(spark, "csv"), files=6)
    back = files.read_csv(spark, path)
    return back.select(*[F.col(c).cast(t) for c, t in supplier.dtypes])


@query(
    "csv_vector",
    "select vec_id, label, len(embedding)::int as entries, " + round_sql('list_sum(embedding::double[])', 3) + " as total from embeddings",
)
def csv_vector(spark, folder):
    """An array column survives the trip through CSV as JSON text."""
    vectors = files.read_parquet(spark, folder, "embeddings")
    path = files.write_csv(vectors, scratch_path(spark, "csv"))
    back = files.read_csv(spark, path, "vec_id bigint, embedding string, label int")
    values = F.from_json("embedding", "array<float>")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rounded(back.select("vec_id", "label", F.size(values).alias("entries"), total.alias("total")), ["vec_id", "label", "entries"], 3)


@query("dropped_features", "select distinct o_orderpriority as column_name from orders")
def dropped_features(spark, folder):
    """The first column of a stored table, as used for the list of dropped features."""
    stored = orders(spark, folder).groupBy(F.col("o_orderpriority").alias("column_name")).agg(F.count("*").alias("n"))
    return tables.first_column(stored)


PRIORITY_CODES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("5-LOW", 5)]


@query(
    "inline_rows",
    "select m.code, count(*) as n from orders join (values ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('5-LOW', 5)) "
    "as m(o_orderpriority, code) using (o_orderpriority) group by m.code",
)
def inline_rows(spark, folder):
    """Literal rows become a frame and are joined to a table. They come from the driver, so they are
    small and broadcast; by key, the table's rows would be sorted in as many tasks as there are codes."""
    literal = F.broadcast(spark.createDataFrame(PRIORITY_CODES, "o_orderpriority string, code int"))
    joined = joins.join_inner([orders(spark, folder), literal], "o_orderpriority")
    return joined.groupBy("code").agg(F.count("*").alias("n"))


@query("table_publish", f"select *, 0 as version from {EMP} where id < 10 union all select *, 1 as version from {EMP} where id >= 10")
def table_publish(spark, folder):
    """A second version made from the first, which stays for its readers."""
    root = scratch_path(spark, "published")
    tables.publish(employees(spark, folder).withColumn("version", F.lit(0)), root)
    changed = tables.read_published(spark, root).withColumn("version", F.when(F.col("id") >= 10, 1).otherwise(F.col("version")))
    tables.publish(changed, root)
    return tables.read_published(spark, root)


@query("table_replace", f"select * from (select *, 0 as version from {EMP} where id < 10) union all select *, 1 as version from {EMP} where id >= 10")
def table_replace(spark, folder):
    """A table is written, then replaced by rows computed from itself."""
    name = "prepflow_" + scratch_path(spark, "t").rpartition("-")[2]
    tables.replace_table(employees(spark, folder).withColumn("version", F.lit(0)), name, scratch_path(spark, "table"))
    changed = mutate.update_where(tables.read_table(spark, name), F.col("id") >= 10, {"version": 1})
    return tables.replace_table(changed, name, scratch_path(spark, "table"))


@query(
    "mapping_table",
    "select 'M' || rk::varchar || '_' || status as column_name, 0::bigint as rows from "
    "(select ym, row_number() over (order by ym desc) as rk from (select distinct strftime(o_orderdate, '%Y-%m') as ym from orders)) "
    "cross join (select distinct o_orderstatus as status from orders) where rk <= 12",
)
def mapping_table(spark, folder):
    """An empty table whose columns are named by the periods and states in the data; its columns are listed."""
    labels = [r.label for r in reshape.latest_period_labels(orders_by_month(spark, folder), "ym", 12).collect()]
    states = [s for (s,) in reshape.all_values(orders(spark, folder), "o_orderstatus")]
    name = "prepflow_" + scratch_path(spark, "t").rpartition("-")[2]
    names = [f"{m}_{s}" for m in labels for s in states]
    made = tables.empty_table(spark, name, names, scratch_path(spark, "table"))
    counts = made.agg(*[F.count(c).alias(c) for c in names])
    return counts.unpivot([], names, "column_name", "rows")


@query("manifest")
def file_manifest(spark, folder):
    """MD5 and size of each file a stage wrote."""
    path = files.write_csv(orders(spark, folder), scratch_path(spark, "csv"), partition_by=("o_orderstatus",), max_rows_per_file=1_000_000)
    return manifest.file_manifest(spark, path, "*.csv")


@query("content_fingerprint", "select count(*) as rows, true as same from orders")
def content_fingerprint(spark, folder):
    """The checksum of the rows is the same before and after a trip through CSV files."""
    source = orders(spark, folder)
    path = files.write_csv(source, scratch_path(spark, "csv"))
    back = files.read_csv(spark, path, source.schema)
    both = manifest.row_fingerprint(source).union(manifest.row_fingerprint(back))
    return both.agg(F.first("rows").alias("rows"), (F.countDistinct("rows", "checksum") == 1).alias("same"))


@query(
    "audit_append",
    "select 'cleanse' as stage, 'OK' as status, count(*)::double as rows from orders "
    "union all select 'scale', 'OK', count(*)::double from lineitem",
)
def audit_append(spark, folder):
    path = scratch_path(spark, "audit")
    for stage, frame in (("cleanse", orders(spark, folder)), ("scale", lineitem(spark, folder))):
        audit.append_audit(spark, path, "run-1", stage, "OK", {"folder": folder}, {"rows": frame.count()})
    return audit.read_audit(spark, path).select("stage", "status", F.col("metrics")["rows"].alias("rows"))


# ---- projections -------------------------------------------------------------


@query("project_only", f"select id, ename, esal, eaddr from {EMP}")
def project_only(spark, folder):
    return columns.project_with_key(employees(spark, folder), "id", ["ename", "esal", "eaddr"])


@query("project_values", f"select ename, esal, eaddr from {EMP}")
def project_values(spark, folder):
    return columns.project(employees(spark, folder), ["ename", "esal", "eaddr"])


@query("project_values_list", f"select ename, esal, eaddr from {EMP}")
def project_values_list(spark, folder):
    return columns.project_tuples(employees(spark, folder), ["ename", "esal", "eaddr"]).select("row.*")


@query("project_list", "select o_orderkey, o_totalprice from orders")
def project_list(spark, folder):
    return columns.project(orders(spark, folder), ["o_orderkey", "o_totalprice"])


@query("drop_columns", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def drop_columns(spark, folder):
    return columns.drop_columns(orders(spark, folder), ["o_orderdate", "o_orderpriority"])


@query("rename_columns", f'select ename as name, esal as salary, eaddr as "2" from {EMP}')
def rename_columns(spark, folder):
    chosen = columns.project(employees(spark, folder), ["ename", "esal", "eaddr"])
    return columns.rename_columns(columns.rename_by_position(chosen), {"0": "name", "1": "salary"})


@query(
    "split_by_type",
    "select 'categorical' as kind, count(o_orderstatus) + count(o_orderpriority) as cells from orders "
    "union all select 'continuous', count(o_orderkey) + count(o_custkey) + count(o_totalprice) from orders "
    "union all select 'other', count(o_orderdate) from orders",
)
def split_by_type(spark, folder):
    """Non-null cells per kind of column."""
    df = orders(spark, folder)
    split = columns.split_by_type(df)
    kinds = {"categorical": split.categorical, "continuous": split.continuous, "other": split.other}
    sums = df.agg(*[reduce(lambda a, b: a + b, [F.count(c) for c in cs]).alias(k) for k, cs in kinds.items()])
    return sums.unpivot([], list(kinds), "kind", "cells")


@query(
    "cast_prefix",
    "select o_orderkey, try_cast(regexp_extract(o_orderpriority, '^([0-9])', 1) as int) as \"M1\", "
    "null::int as \"M2\" from orders",
)
def cast_prefix(spark, folder):
    """Columns starting with M become integers; text that is no number becomes null."""
    text = orders(spark, folder).select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("M1"), F.col("o_orderstatus").alias("M2")
    )
    return columns.cast_prefix(text, "M")


@query(
    "cast_labels",
    "select o_orderkey, case when trunc(o_totalprice / 1000) between -128 and 127 then trunc(o_totalprice / 1000)::tinyint end as small, "
    "o_custkey::int as cust from orders",
)
def cast_labels(spark, folder):
    df = orders(spark, folder).select(
        "o_orderkey", (F.col("o_totalprice") / 1000).alias("small"), F.col("o_custkey").cast("string").alias("cust")
    )
    return columns.cast_columns(df, {"small": "tinyint", "cust": "int"})


@query(
    "map_values",
    "select o_orderkey, coalesce(m.new, o.o_orderpriority) as o_orderpriority from orders o "
    "left join (values ('1-URGENT', 'high'), ('2-HIGH', 'high'), ('5-LOW', 'low')) as m(old, new) on o.o_orderpriority = m.old",
)
def map_values(spark, folder):
    mapping = spark.createDataFrame([("1-URGENT", "high"), ("2-HIGH", "high"), ("5-LOW", "low")], "old string, new string")
    return columns.map_values(orders(spark, folder).select("o_orderkey", "o_orderpriority"), "o_orderpriority", mapping)


@query(
    "recent_periods",
    "with m as (select ym, row_number() over (order by ym desc) as rk from (select distinct strftime(o_orderdate, '%Y-%m') as ym from orders)) "
    "select o.o_orderkey, 'M' || m.rk::varchar as ym from orders o join m on strftime(o.o_orderdate, '%Y-%m') = m.ym where m.rk <= 6",
)
def recent_periods(spark, folder):
    return reshape.keep_recent(orders_by_month(spark, folder).select("o_orderkey", "ym"), "ym", 6)


@query("fill_constant", f"select o_orderkey, coalesce(o_totalprice, 0.0) as o_totalprice, coalesce(o_orderpriority, 'none') as o_orderpriority from {ORD_GAPS}")
def fill_constant(spark, folder):
    df = orders_with_gaps(spark, folder).select("o_orderkey", "o_totalprice", "o_orderpriority")
    return columns.fill_constant(df, {"o_totalprice": 0.0, "o_orderpriority": "none"})


@query("fill_conditional", f"select o_orderkey, case when o_totalprice is null then -1.0 else o_totalprice end as o_totalprice from {ORD_GAPS}")
def fill_conditional(spark, folder):
    df = orders_with_gaps(spark, folder).select("o_orderkey", "o_totalprice")
    return columns.fill_where(df, "o_totalprice", F.col("o_totalprice").isNull(), F.lit(-1.0))


@query("pad_periods", 'select o_orderkey, o_totalprice as "M1", 0.0::double as "M2", 0.0::double as "M3" from orders')
def pad_periods(spark, folder):
    df = orders(spark, folder).select("o_orderkey", F.col("o_totalprice").alias("M1"))
    return columns.pad_columns(df, ["M1", "M2", "M3"], 0.0)


@query("drop_null_rows", f"select * from {ORD_GAPS} where o_totalprice is not null and o_orderpriority is not null")
def drop_null_rows(spark, folder):
    return columns.drop_null_rows(orders_with_gaps(spark, folder))


@query("filter_not_null", f"select * from {ORD_GAPS} where o_totalprice is not null")
def filter_not_null(spark, folder):
    return columns.keep_not_null(orders_with_gaps(spark, folder), "o_totalprice")


@query("filter_not_between", f"select o_orderkey, o_totalprice from {ORD_GAPS} where o_totalprice not between 50000 and 250000")
def filter_not_between(spark, folder):
    df = columns.keep_outside(orders_with_gaps(spark, folder), "o_totalprice", 50000, 250000)
    return df.select("o_orderkey", "o_totalprice")


@query("exclude_values", f"select o_orderkey, o_orderpriority from {ORD_GAPS} where o_orderpriority not in ('1-URGENT', '5-LOW')")
def exclude_values(spark, folder):
    df = orders_with_gaps(spark, folder).select("o_orderkey", "o_orderpriority")
    return columns.exclude_values(df, "o_orderpriority", ["1-URGENT", "5-LOW"])


@query(
    "exclude_values_of_table",
    f"select o_orderkey, o_custkey from {ORD_GAPS} where o_custkey not in (select c_custkey from customer where c_mktsegment = 'MACHINERY')",
)
def exclude_values_of_table(spark, folder):
    unwanted = filter_rows(files.read_parquet(spark, folder, "customer"), c_mktsegment="MACHINERY").select("c_custkey")
    return columns.exclude_values(orders_with_gaps(spark, folder).select("o_orderkey", "o_custkey"), "o_custkey", unwanted)


# ---- lookups -----------------------------------------------------------------


@query("get_exact", f"select * from {EMP} where id = 2")
def get_exact(spark, folder):
    return get_one(employees(spark, folder), id=2)


@query("get_iexact", f"select * from {EMP} where lower(ename) = lower('CUSTOMER#000000002')")
def get_iexact(spark, folder):
    return get_one(employees(spark, folder), ename__iexact="CUSTOMER#000000002")


_FILTERS = {
    "filter_contains": ({"id__contains": 2}, "id::varchar like '%2%'"),
    "filter_icontains": ({"eaddr__icontains": "MaCh"}, "lower(eaddr) like '%mach%'"),
    "filter_in": ({"id__in": [2, 5]}, "id in (2, 5)"),
    "filter_gt": ({"esal__gt": 4000.0}, "esal > 4000"),
    "filter_gte": ({"id__gte": 50}, "id >= 50"),
    "filter_lt": ({"esal__lt": 4000.0}, "esal < 4000"),
    "filter_lte": ({"id__lte": 50}, "id <= 50"),
    "filter_startswith": ({"eaddr__startswith": "M"}, "eaddr like 'M%'"),
    "filter_istartswith": ({"eaddr__istartswith": "m"}, "lower(eaddr) like 'm%'"),
    "filter_endswith": ({"eaddr__endswith": "Y"}, "eaddr like '%Y'"),
    "filter_iendswith": ({"eaddr__iendswith": "y"}, "lower(eaddr) like '%y'"),
    "filter_and": ({"ename__startswith": "C", "esal__lt": 4000.0}, "ename like 'C%' and esal < 4000"),
}


def _register_filter(name, lookups, condition):
    @query(name, f"select * from {EMP_GAPS} where {condition}")
    def run(spark, folder):
        return filter_rows(employees_with_gaps(spark, folder), **lookups)


for _name, (_lookups, _condition) in _FILTERS.items():
    _register_filter(_name, _lookups, _condition)


@query("filter_or", f"select * from {EMP_GAPS} where eaddr like 'M%' or esal < 4000")
def filter_or(spark, folder):
    return employees_with_gaps(spark, folder).where(all_of(eaddr__startswith="M") | all_of(esal__lt=4000.0))


@query("filter_not", f"select * from {EMP_GAPS} where eaddr not like 'M%' or eaddr is null")
def filter_not(spark, folder):
    return exclude_rows(employees_with_gaps(spark, folder), eaddr__startswith="M")


@query("exclude", f"select * from {EMP_GAPS} where not coalesce(eaddr like 'M%' and esal < 4000, false)")
def exclude(spark, folder):
    return exclude_rows(employees_with_gaps(spark, folder), eaddr__startswith="M", esal__lt=4000.0)


# ---- joins -------------------------------------------------------------------


def _customer_sums(spark, folder, status):
    part = filter_rows(orders(spark, folder), o_orderstatus=status)
    return part.groupBy("o_custkey").agg(F.count("*").alias(f"n_{status}"))


@query(
    "join_full_outer",
    "with f as (select o_custkey, count(*) as n from orders where o_orderstatus = 'F' group by 1), "
    "o as (select o_custkey, count(*) as n from orders where o_orderstatus = 'O' group by 1), "
    "p as (select o_custkey, count(*) as n from orders where o_orderstatus = 'P' group by 1) "
    'select coalesce(f.o_custkey, o.o_custkey, p.o_custkey) as o_custkey, f.n as "n_F", o.n as "n_O", p.n as "n_P" '
    "from f full join o on f.o_custkey = o.o_custkey full join p on coalesce(f.o_custkey, o.o_custkey) = p.o_custkey",
)
def join_full_outer(spark, folder):
    return joins.join_full_outer([_customer_sums(spark, folder, s) for s in "FOP"], "o_custkey")


@query(
    "join_keep_larger",
    "select c.c_custkey, c.c_mktsegment, o.n from customer c left join "
    "(select o_custkey, count(*) as n from orders where o_orderstatus = 'F' group by 1) o on o.o_custkey = c.c_custkey",
)
def join_keep_larger(spark, folder):
    counts = _customer_sums(spark, folder, "F").toDF("c_custkey", "n")
    customers = files.read_parquet(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return joins.join_keep_larger(counts, customers, "c_custkey")


@query(
    "join_inner",
    "select o_orderkey, o_totalprice, n, q from orders join (select l_orderkey, count(*) as n, sum(l_quantity) as q "
    "from lineitem group by 1) on l_orderkey = o_orderkey",
)
def join_inner(spark, folder):
    lines = lineitem(spark, folder).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("q")
    )
    return joins.join_inner([orders(spark, folder).select("o_orderkey", "o_totalprice"), lines], "o_orderkey")


@query("inherit_2level", "select c_custkey, c_name, n_nationkey, n_name from customer join nation on c_nationkey = n_nationkey")
def inherit_2level(spark, folder):
    read = files.read_parquet
    both = joins.inherit(read(spark, folder, "nation"), read(spark, folder, "customer"), "n_nationkey", "c_nationkey")
    return both.select("c_custkey", "c_name", "n_nationkey", "n_name")


@query(
    "inherit_3level",
    "select c_custkey, c_name, n_name, r_name from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
)
def inherit_3level(spark, folder):
    read = files.read_parquet
    middle = joins.inherit(read(spark, folder, "region"), read(spark, folder, "nation"), "r_regionkey", "n_regionkey")
    full = joins.inherit(middle, read(spark, folder, "customer"), "n_nationkey", "c_nationkey")
    return full.select("c_custkey", "c_name", "n_name", "r_name")


def _cascade(spark, folder):
    customers = files.read_parquet(spark, folder, "customer")
    return mutate.cascade_delete(customers, orders(spark, folder), "c_custkey", "o_custkey", F.col("c_acctbal") > 4000)


@query("cascade_delete_parent", "select * from customer where not coalesce(c_acctbal > 4000, false)")
def cascade_delete_parent(spark, folder):
    return _cascade(spark, folder)[0]


@query(
    "cascade_delete_child",
    "select o_orderkey, o_custkey, o_totalprice from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 4000)",
)
def cascade_delete_child(spark, folder):
    return _cascade(spark, folder)[1].select("o_orderkey", "o_custkey", "o_totalprice")


# ---- aggregates --------------------------------------------------------------


@query(
    "agg_global",
    f"select {round_sql('avg(esal)')} as avg, max(esal) as max, min(esal) as min, {round_sql('sum(esal)', 2)} as sum, count(esal) as count from {EMP_GAPS}",
)
def agg_global(spark, folder):
    stats = aggregate.global_stats(employees_with_gaps(spark, folder), "esal")
    return rounded(rounded(stats, ["max", "min", "sum", "count"]), ["avg", "max", "min", "count"], 2)


@query("agg_count", f"select count(*) as rows from {EMP}")
def agg_count(spark, folder):
    return aggregate.row_count(employees(spark, folder))


_PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("distinct_profile", " union all ".join(f"select '{c}' as column_name, count(distinct {c}) as distinct_count from {ORD_GAPS}" for c in _PROFILED))
def distinct_profile(spark, folder):
    return aggregate.distinct_profile(orders_with_gaps(spark, folder), _PROFILED).drop("rows")


@query("value_counts", f"select o_orderpriority, count(*) as count from {ORD_GAPS} group by 1")
def value_counts(spark, folder):
    return aggregate.value_counts(orders_with_gaps(spark, folder), "o_orderpriority")


def _mode_sql(source, names):
    return " union all ".join(
        f"select * from (select '{c}' as column_name, {c}::varchar as mode, count(*) as count from {source} "
        f"where {c} is not null group by {c} order by count(*) desc, {c} limit 1)"
        for c in names
    )


_MODES = ["o_custkey", "o_orderstatus", "o_orderpriority"]


@query("mode_per_column", _mode_sql(ORD_GAPS, _MODES))
def mode_per_column(spark, folder):
    return aggregate.mode_per_column(orders_with_gaps(spark, folder), _MODES)


@query("mode_complete_rows", _mode_sql(f"(select * from {ORD_GAPS} where o_totalprice is not null and o_orderpriority is not null)", _MODES))
def mode_complete_rows(spark, folder):
    return aggregate.mode_per_column(columns.drop_null_rows(orders_with_gaps(spark, folder)), _MODES)


@query("distinct_sorted", "select distinct strftime(o_orderdate, '%Y-%m') as ym from orders order by 1 desc")
def distinct_sorted(spark, folder):
    return aggregate.distinct_sorted(orders_by_month(spark, folder), "ym", descending=True)


@query(
    "dedup_first",
    "select user_id, event_id, event_type, value, props from (select *, row_number() over (partition by user_id order by ts, event_id) as rn from events) where rn = 1",
)
def dedup_first(spark, folder):
    first = aggregate.first_per_key(events(spark, folder), "user_id", ["ts", "event_id"])
    return first.select("user_id", "event_id", "event_type", "value", "props")


def _avg_if(measure, condition, name, fill="0.0"):
    return f'{round_sql(f"coalesce(avg({measure}) filter (where {condition}), {fill})")} as "{name}"'


@query(
    "pivot_mean",
    "select o_custkey, " + ", ".join(_avg_if("o_totalprice", f"o_orderstatus = '{s}'", s) for s in "FOP") + " from orders group by o_custkey",
)
def pivot_mean(spark, folder):
    wide = reshape.pivot_mean(orders(spark, folder), ["o_custkey"], "o_orderstatus", ["F", "O", "P"], ["o_totalprice"], lambda v, m: v)
    return rounded(wide, ["o_custkey"])


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "pivot_two_keys",
    "select o_custkey, "
    + ", ".join(
        _avg_if("o_totalprice", f"o_orderstatus = '{s}' and o_orderpriority = '{p}'", f"{s}-{p}-o_totalprice")
        for s in "FOP"
        for p in _PRIORITIES
    )
    + " from orders group by o_custkey",
)
def pivot_two_keys(spark, folder):
    wide = reshape.pivot_two_keys(orders(spark, folder), ["o_custkey"], "o_orderstatus", "o_orderpriority", ["o_totalprice"])
    return rounded(wide, ["o_custkey"])


@query(
    "pivot_multi_value",
    "select l_suppkey, "
    + ", ".join(_avg_if(m, f"l_returnflag = '{f}'", f"{f}_{m}") for f in "ANR" for m in ("l_quantity", "l_extendedprice"))
    + " from lineitem group by l_suppkey",
)
def pivot_multi_value(spark, folder):
    wide = reshape.pivot_mean(
        lineitem(spark, folder), ["l_suppkey"], "l_returnflag", ["A", "N", "R"], ["l_quantity", "l_extendedprice"], lambda v, m: f"{v}_{m}"
    )
    return rounded(wide, ["l_suppkey"])


_QUANTILE_COLUMNS = ["l_extendedprice", "l_quantity"]


@query(
    "quantiles",
    " union all ".join(
        f"select '{c}' as column_name, quantile_disc({c}, 0.25) as q25, quantile_disc({c}, 0.5) as q50, quantile_disc({c}, 0.75) as q75 from lineitem"
        for c in _QUANTILE_COLUMNS
    ),
)
def exact_quantiles(spark, folder):
    found = quantiles.exact_quantiles(lineitem(spark, folder), _QUANTILE_COLUMNS, [0.25, 0.5, 0.75])
    return spark.createDataFrame([(c, *q) for c, q in found.items()], "column_name string, q25 double, q50 double, q75 double")


_RANGED = ["o_orderkey", "o_custkey", "o_totalprice"]


@query("minmax_profile", " union all ".join(f"select '{c}' as column_name, min({c})::double as min_value, max({c})::double as max_value from orders" for c in _RANGED))
def minmax_profile(spark, folder):
    return aggregate.minmax_profile(orders(spark, folder), _RANGED)


@query(
    "period_rank",
    "select ym, row_number() over (order by ym desc) as rank from (select distinct strftime(o_orderdate, '%Y-%m') as ym from orders)",
)
def period_rank(spark, folder):
    return aggregate.rank_values(orders_by_month(spark, folder), "ym", descending=True)


@query("topk_counts", "select o_custkey, count(*) as count from orders group by 1 order by count(*) desc, o_custkey limit 10")
def topk_counts(spark, folder):
    return aggregate.top_groups(orders(spark, folder), "o_custkey", 10)


@query(
    "class_target_size",
    "select min(n) as smallest, max(n) as largest from (select count(*) as n from events group by event_type)",
)
def class_target_size(spark, folder):
    return aggregate.target_size(events(spark, folder), "event_type")


@query("preview_rows", f"select * from {EMP} order by id limit 20")
def preview_rows(spark, folder):
    return aggregate.preview(employees(spark, folder), ["id"], 20)


@query("union_distinct", f"select * from {EMP} where esal > 3000 union select * from {EMP} where esal < 5000")
def union_distinct(spark, folder):
    e = employees(spark, folder)
    return aggregate.union_distinct(filter_rows(e, esal__gt=3000.0), filter_rows(e, esal__lt=5000.0))


@query("union_all", f"select * from {EMP} where esal > 3000 union all select * from {EMP} where esal < 5000")
def union_all(spark, folder):
    e = employees(spark, folder)
    return aggregate.union_all(filter_rows(e, esal__gt=3000.0), filter_rows(e, esal__lt=5000.0))


# ---- scalar functions --------------------------------------------------------


@query("regex_digits", f"select id, ename, nullif(regexp_extract(ename, '([0-9]+)', 1), '') as digits, nullif(regexp_extract(eaddr, '([0-9]+)', 1), '') as none from {EMP}")
def regex_digits(spark, folder):
    e = employees(spark, folder)
    return e.select("id", "ename", scalars.first_digits(F.col("ename")).alias("digits"), scalars.first_digits(F.col("eaddr")).alias("none"))


@query(
    "text_replace",
    f"select id, replace(replace(ename, 'Customer', 'process_id'), '#', '/') || '/' || eaddr as path from {EMP}",
)
def text_replace(spark, folder):
    e = employees(spark, folder)
    text = scalars.replace_texts(F.col("ename"), {"Customer": "process_id", "#": "/"})
    return e.select("id", scalars.joined_label(text, F.col("eaddr"), sep="/").alias("path"))


@query(
    "vector_max_pct",
    "select vec_id, (list_max(list_transform(embedding::double[], lambda x: abs(x))) * 100)::float as pct from embeddings",
)
def vector_max_pct(spark, folder):
    values = F.transform("embedding", lambda x: x.cast("double"))
    return files.read_parquet(spark, folder, "embeddings").select("vec_id", scalars.array_max_abs_percent(values).alias("pct"))


# ---- mutations ---------------------------------------------------------------

_SUPPLIERS_SQL = (
    "select s_suppkey + (select max(c_custkey) from customer) + 1 as id, s_suppkey as eno, s_name as ename, s_acctbal as esal, "
    "'SUPPLIER' as eaddr from supplier"
)


def suppliers_as_employees(spark, folder):
    """Suppliers as new employees, their keys shifted beyond those in use."""
    last = files.read_parquet(spark, folder, "customer").agg(F.max("c_custkey")).first()[0]
    return files.read_parquet(spark, folder, "supplier").select(
        (F.col("s_suppkey") + F.lit(last + 1)).alias("id"),
        F.col("s_suppkey").alias("eno"),
        F.col("s_name").alias("ename"),
        F.col("s_acctbal").alias("esal"),
        F.lit("SUPPLIER").alias("eaddr"),
    )


@query("insert_row", f"select * from {EMP} union all ({_SUPPLIERS_SQL} order by s_acctbal desc, s_suppkey limit 1)")
def insert_row(spark, folder):
    """The supplier with the largest balance joins the employees."""
    first = suppliers_as_employees(spark, folder).orderBy(F.col("esal").desc(), "eno").limit(1)
    return mutate.insert_rows(employees(spark, folder), first)


@query("insert_rows", f"select * from {EMP} union all {_SUPPLIERS_SQL}")
def insert_rows(spark, folder):
    return mutate.insert_rows(employees(spark, folder), suppliers_as_employees(spark, folder))


@query("update_row", f"select id, eno, case when id = 3 then 'Changed' else ename end as ename, esal, eaddr from {EMP}")
def update_row(spark, folder):
    return mutate.update_where(employees(spark, folder), F.col("id") == 3, {"ename": "Changed"})


@query("delete_row", f"select * from {EMP} where id <> 4")
def delete_row(spark, folder):
    return mutate.delete_where(employees(spark, folder), F.col("id") == 4)


@query("delete_where", f"select * from {EMP_GAPS} where not coalesce(esal > 3000, false)")
def delete_where(spark, folder):
    return mutate.delete_where(employees_with_gaps(spark, folder), F.col("esal") > 3000)
