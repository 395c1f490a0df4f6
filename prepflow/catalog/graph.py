"""Queries that delete along the foreign keys of all tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepflow.catalog.registry import query
from prepflow.operators import key_graph
from prepflow.operators.key_graph import Link
from prepflow.sources import files

KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_suppkey"],
}
LINKS = [
    Link("nation", "n_regionkey", "region", "r_regionkey"),
    Link("customer", "c_nationkey", "nation", "n_nationkey"),
    Link("supplier", "s_nationkey", "nation", "n_nationkey"),
    Link("orders", "o_custkey", "customer", "c_custkey"),
    Link("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Link("lineitem", "l_suppkey", "supplier", "s_suppkey"),
]


def _left(spark, folder, links, start, condition) -> dict[str, DataFrame]:
    tables = {t: files.read_parquet(spark, folder, t) for t in KEYS}
    return key_graph.cascade(tables, KEYS, links, start, condition)


def _summary(left: dict[str, DataFrame]) -> DataFrame:
    """Rows left of each table and the sum of the first column of their keys."""
    parts = [
        df.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows_left"), F.coalesce(F.sum(KEYS[t][0]), F.lit(0)).cast("long").alias("key_sum"))
        for t, df in left.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _summary_sql(gone: str, conditions: dict[str, str]) -> str:
    return f"with {gone} " + " union all ".join(
        f"select '{t}' as table_name, count(*) as rows_left, coalesce(sum({KEYS[t][0]}), 0)::bigint as key_sum from {t} where not ({conditions.get(t, 'false')})"
        for t in KEYS
    )


@query(
    "cascade_graph",
    _summary_sql(
        "r as (select r_regionkey from region where r_name < 'B'), n as (select n_nationkey from nation where n_regionkey in (from r)), "
        "c as (select c_custkey from customer where c_nationkey in (from n)), s as (select s_suppkey from supplier where s_nationkey in (from n)), "
        "o as (select o_orderkey from orders where o_custkey in (from c))",
        {
            "region": "r_regionkey in (from r)", "nation": "n_nationkey in (from n)", "customer": "c_custkey in (from c)",
            "supplier": "s_suppkey in (from s)", "orders": "o_orderkey in (from o)", "lineitem": "l_orderkey in (from o) or l_suppkey in (from s)",
        },
    ),
)
def cascade_graph(spark, folder):
    """Regions deleted with all that hangs on them, four levels down by two ways."""
    return _summary(_left(spark, folder, LINKS, "region", F.col("r_name") < "B"))


@query(
    "cascade_graph_orders",
    "with n as (select n_nationkey from nation join region on n_regionkey = r_regionkey where r_name < 'B'), "
    "c as (select c_custkey from customer where c_nationkey in (from n)) "
    "select o_orderkey, o_custkey, o_totalprice from orders where o_custkey not in (from c)",
)
def cascade_graph_orders(spark, folder):
    """The orders that are left of the same delete."""
    return _left(spark, folder, LINKS, "region", F.col("r_name") < "B")["orders"].select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "cascade_inherited",
    _summary_sql(
        "c as (select distinct o_custkey from orders where o_totalprice > 300000), o as (select o_orderkey from orders where o_custkey in (from c))",
        {"customer": "c_custkey in (from c)", "orders": "o_orderkey in (from o)", "lineitem": "l_orderkey in (from o)"},
    ),
)
def cascade_inherited(spark, folder):
    """Orders as rows that extend their customer: deleting one deletes the customer, and with it the customer's other orders."""
    links = [Link(x.child, x.column, x.parent, x.parent_column, extends=x.child == "orders") for x in LINKS]
    return _summary(_left(spark, folder, links, "orders", F.col("o_totalprice") > 300000))
