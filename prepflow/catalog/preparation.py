"""Queries that reshape, clean, encode, scale and resample."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from prepflow.catalog.registry import query
from prepflow.catalog.relational import (
    ORD_GAPS,
    events,
    lineitem,
    orders,
    orders_by_month,
    orders_with_gaps,
    round_sql,
    rounded,
)
from prepflow.operators import clean, columns, encode, outliers, reshape, sampling, scale, select
from prepflow.plans.transpose import monthly_transpose, multi_output_transpose
from prepflow.sources.files import read_parquet
from prepflow.sources.scratch import scratch_path

# ---- monthly transpose -------------------------------------------------------

RUNNING_MONTHS, LOAN_MONTHS = 6, 4
LOAN_MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]

_RUN_CTE = (
    "rm as (select ym, row_number() over (order by ym desc) as rk from (select distinct strftime(o_orderdate, '%Y-%m') as ym from orders)), "
    f"rt as (select o.o_custkey, o.o_totalprice, rm.rk from orders o join rm on strftime(o.o_orderdate, '%Y-%m') = rm.ym where rm.rk <= {RUNNING_MONTHS}), "
    "run as (select o_custkey, "
    + ", ".join(f'{round_sql(f"coalesce(avg(o_totalprice) filter (where rk = {i}), 0.0)")} as "M{i}"' for i in range(1, RUNNING_MONTHS + 1))
    + " from rt group by o_custkey)"
)
_LOAN_CTE = (
    "lt as (select o.o_custkey, strftime(l.l_shipdate, '%Y-%m') as ym, l.l_quantity, l.l_extendedprice, l.l_discount "
    "from lineitem l join orders o on l.l_orderkey = o.o_orderkey), "
    "lm as (select ym, row_number() over (order by ym desc) as rk from (select distinct ym from lt)), "
    "loan as (select o_custkey, "
    + ", ".join(
        f'{round_sql(f"coalesce(avg({m}) filter (where rk = {i}), 0.0)")} as "M{i}-{m}"' for i in range(1, LOAN_MONTHS + 1) for m in LOAN_MEASURES
    )
    + f" from lt join lm using (ym) where rk <= {LOAN_MONTHS} group by o_custkey)"
)
_LOAN_COLUMNS = ", ".join(f'loan."M{i}-{m}"' for i in range(1, LOAN_MONTHS + 1) for m in LOAN_MEASURES)
_RUN_COLUMNS = ", ".join(f'run."M{i}"' for i in range(1, RUNNING_MONTHS + 1))


def _loans(spark, folder):
    """Line items as the transactions of a customer, by month of shipping."""
    owner = orders(spark, folder).select("o_orderkey", "o_custkey")
    lines = lineitem(spark, folder).select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM").alias("ym"), *LOAN_MEASURES)
    return lines.join(owner, lines["l_orderkey"] == owner["o_orderkey"]).drop("l_orderkey", "o_orderkey")


def _monthly(spark, folder):
    running = orders_by_month(spark, folder).select("o_custkey", "ym", "o_totalprice")
    return monthly_transpose(
        running, _loans(spark, folder), "o_custkey", "ym", "o_totalprice", LOAN_MEASURES, RUNNING_MONTHS, LOAN_MONTHS
    )


@query("monthly_transpose_running", f"with {_RUN_CTE} select * from run")
def monthly_transpose_running(spark, folder):
    running = orders_by_month(spark, folder).select("o_custkey", "ym", "o_totalprice")
    wide = reshape.pivot_periods(running, "o_custkey", "ym", ["o_totalprice"], RUNNING_MONTHS, name="{period}")
    return rounded(wide, ["o_custkey"])


@query(
    "monthly_transpose",
    f"with {_RUN_CTE}, {_LOAN_CTE}, sizes as (select (select count(*) from loan) < (select count(*) from run) as keep_run) "
    f"select coalesce(run.o_custkey, loan.o_custkey) as o_custkey, {_RUN_COLUMNS}, {_LOAN_COLUMNS} "
    "from run full join loan on run.o_custkey = loan.o_custkey, sizes "
    "where case when keep_run then run.o_custkey is not null else loan.o_custkey is not null end",
)
def monthly_transpose_query(spark, folder):
    return rounded(_monthly(spark, folder).merged, ["o_custkey"])


_FLAGS = ["A", "N", "R"]
_FLAGGED = "lt as (select o.o_custkey, strftime(l.l_shipdate, '%Y-%m') as ym, l.l_returnflag, l.l_quantity from lineitem l join orders o on l.l_orderkey = o.o_orderkey)"


@query(
    "monthly_transpose_two_keys",
    f"with {_FLAGGED}, lm as (select ym, row_number() over (order by ym desc) as rk from (select distinct ym from lt)) select o_custkey, "
    + ", ".join(
        f"""{round_sql(f"coalesce(avg(l_quantity) filter (where rk = {i} and l_returnflag = '{f}'), 0.0)")} as "M{i}-{f}-l_quantity\""""
        for i in range(1, LOAN_MONTHS + 1)
        for f in _FLAGS
    )
    + f" from lt join lm using (ym) where rk <= {LOAN_MONTHS} group by o_custkey",
)
def monthly_transpose_two_keys(spark, folder):
    """Columns for each pair of month and return flag."""
    owner = orders(spark, folder).select("o_orderkey", "o_custkey")
    lines = lineitem(spark, folder).select(
        F.col("l_orderkey").alias("o_orderkey"), F.date_format("l_shipdate", "yyyy-MM").alias("ym"), "l_returnflag", "l_quantity"
    )
    recent = reshape.keep_recent(lines.join(owner, "o_orderkey"), "ym", LOAN_MONTHS)
    return rounded(reshape.pivot_two_keys(recent, ["o_custkey"], "ym", "l_returnflag", ["l_quantity"]), ["o_custkey"])


@query(
    "month_labels",
    "select 'M' || row_number() over (order by ym desc)::varchar as \"Month_label\" from "
    f"(select distinct strftime(o_orderdate, '%Y-%m') as ym from orders order by 1 desc limit {RUNNING_MONTHS})",
)
def month_labels(spark, folder):
    labels = reshape.latest_period_labels(orders_by_month(spark, folder), "ym", RUNNING_MONTHS)
    return labels.select(F.col("label").alias("Month_label"))


# ---- multi-output transpose --------------------------------------------------

_EV = (
    "ev as (select user_id, event_id, ts, 'B' || (datediff('day', date '2024-01-01', ts::date) // 5)::varchar as bin, value, props, "
    "coalesce(case when event_id % 7 <> 0 then event_type end, 'missing') as event_type, "
    "coalesce(case when event_id % 5 <> 0 then 'band' || least(floor(value / 100), 4)::int::varchar end, 'missing') as band, "
    "least(floor(value / 100), 4) as label from events), "
    "et as (select event_type, row_number() over (order by event_type) - 1 as c from (select distinct event_type from ev)), "
    "eb as (select band, row_number() over (order by band) - 1 as c from (select distinct band from ev)), "
    "coded as (select ev.*, et.c as type_code, eb.c as band_code from ev join et using (event_type) join eb using (band)), "
    "st as (select user_id, props from (select *, row_number() over (partition by user_id order by ts, event_id) as rn from ev) where rn = 1)"
)
_BINS = [f"B{i}" for i in range(6)]
_WIDE_MEASURES = {"value": "value", "event_type": "type_code", "band": "band_code"}
_WIDE = "wide as (select user_id, " + ", ".join(
    f'{round_sql(f"coalesce(avg({m}) filter (where bin = {chr(39)}{b}{chr(39)}), 0.0)")} as "{b}_{n}"' for b in _BINS for n, m in _WIDE_MEASURES.items()
) + " from coded group by user_id)"
_OFN = "ofn as (select user_id, " + ", ".join(
    f"trunc(coalesce(avg(label) filter (where bin = '{b}'), 0))::tinyint as \"OFN{i + 1}\"" for i, b in enumerate(_BINS)
) + " from ev group by user_id)"


def _periods(spark, folder):
    source = events(spark, folder)
    level = F.least(F.floor(F.col("value") / 100), F.lit(4))
    base = source.select(
        "user_id",
        "event_id",
        "ts",
        five_day_bin().alias("bin"),
        "value",
        "props",
        F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("band"), level.cast("string"))).alias("band"),
    )
    labels = source.select("user_id", five_day_bin().alias("bin"), level.alias("label"))
    return multi_output_transpose(
        base,
        labels,
        key="user_id",
        order=["ts", "event_id"],
        static=["props"],
        period="bin",
        measures=["value", "event_type", "band"],
        text_labels=["event_type", "band"],
        missing_text="missing",
        output_period="bin",
        output_value="label",
        known=tuple(_BINS),
    )


def five_day_bin():
    """Five-day bin of the event time."""
    return F.concat(F.lit("B"), F.expr("datediff(ts, date'2024-01-01') div 5").cast("string"))


@query("fortnight_transpose", f"with {_EV}, {_WIDE}, {_OFN} select st.user_id, st.props, wide.* exclude (user_id) from st join wide using (user_id) join ofn using (user_id)")
def fortnight_transpose(spark, folder):
    return rounded(_periods(spark, folder).features, ["user_id", "props"])


@query("fortnight_labels", f"with {_EV}, {_WIDE}, {_OFN} select ofn.* from ofn join st using (user_id) join wide using (user_id)")
def fortnight_labels(spark, folder):
    return _periods(spark, folder).labels


# ---- cleaning ----------------------------------------------------------------


def _decision_sql(source, names, lower, upper):
    return " union all ".join(
        f"select '{c}' as column_name, count(distinct {e}) as distinct_count, "
        f"count(distinct {e}) <= {lower} or count(distinct {e}) >= {upper} as dropped from {source}"
        for c, e in names.items()
    )


_DECIDED = {c: c for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")} | {"source": "'web'", "empty": "null"}


def _with_constant(spark, folder):
    return orders_with_gaps(spark, folder).withColumns({"source": F.lit("web"), "empty": F.lit(None).cast("string")})


@query("drop_by_cardinality", _decision_sql(ORD_GAPS, _DECIDED, 1, "0.9 * count(*)"))
def drop_by_cardinality(spark, folder):
    return clean.cardinality_decisions(_with_constant(spark, folder), 1, 0.9)


@query("drop_by_cardinality_pct", _decision_sql(ORD_GAPS, _DECIDED, 0, "floor(0.8 * count(*))"))
def drop_by_cardinality_pct(spark, folder):
    return clean.cardinality_decisions(_with_constant(spark, folder), int(50 / 100), 80 / 100, whole_upper=True)


def _kept_sql(source, names, lower, upper):
    return " union all ".join(
        f"select '{c}' as column_name, count({e}) as filled from {source} having count(distinct {e}) > {lower} and count(distinct {e}) < {upper}"
        for c, e in names.items()
    )


@query("drop_columns_kept", _kept_sql(ORD_GAPS, {c: e for c, e in _DECIDED.items() if c != "source"}, 0, "floor(0.8 * count(*))"))
def drop_columns_kept(spark, folder):
    """The columns that are left once near-unique, empty and date columns are gone, with their numbers of values."""
    df = _with_constant(spark, folder).withColumn("day", F.lit("2024-01-01"))
    kept, _ = clean.drop_by_cardinality_percent(df, 50, 80, ["day", "source"])
    filled = kept.agg(*[F.count(c).alias(c) for c in kept.columns])
    return filled.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in kept.columns])))


def _imputed_sql(price, cust):
    return (
        f"select o_orderkey, {round_sql(f'coalesce(case when o_orderkey % 7 <> 0 then o_totalprice end, ({price}))')} as o_totalprice, "
        f"coalesce(case when o_orderkey % 5 <> 0 then o_custkey end, ({cust}))::bigint as o_custkey from orders"
    )


_IMP = "(select case when o_orderkey % 7 <> 0 then o_totalprice end as p, case when o_orderkey % 5 <> 0 then o_custkey end as c from orders)"


def _gaps_to_impute(spark, folder):
    return orders(spark, folder).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("o_custkey"),
    )


def _impute(spark, folder, strategy):
    df = _gaps_to_impute(spark, folder)
    filled = clean.apply_imputer(df, clean.fit_imputer(df, ["o_totalprice", "o_custkey"], strategy))
    return rounded(filled, ["o_orderkey", "o_custkey"])


@query("impute_mean", _imputed_sql(f"select avg(p) from {_IMP}", f"select trunc(avg(c)) from {_IMP}"))
def impute_mean(spark, folder):
    return _impute(spark, folder, "mean")


@query("impute_median", _imputed_sql(f"select quantile_disc(p, 0.5) from {_IMP}", f"select quantile_disc(c, 0.5) from {_IMP}"))
def impute_median(spark, folder):
    return _impute(spark, folder, "median")


@query(
    "impute_mode",
    _imputed_sql(
        f"select p from {_IMP} where p is not null group by p order by count(*) desc, p limit 1",
        f"select c from {_IMP} where c is not null group by c order by count(*) desc, c limit 1",
    ),
)
def impute_mode(spark, folder):
    return _impute(spark, folder, "mode")


_MODE_PRIORITY = f"(select o_orderpriority from {ORD_GAPS} where o_orderpriority is not null group by 1 order by count(*) desc, 1 limit 1)"


@query("impute_categorical", f"select o_orderkey, coalesce(o_orderpriority, {_MODE_PRIORITY}) as o_orderpriority from {ORD_GAPS}")
def impute_categorical(spark, folder):
    df = orders_with_gaps(spark, folder).select("o_orderkey", "o_orderpriority")
    return clean.apply_imputer(df, clean.fit_imputer(df, ["o_orderpriority"], "mode"))


@query(
    "impute_both",
    "select o_orderkey, o_custkey, o_orderstatus, "
    f"coalesce(o_totalprice, (select quantile_disc(o_totalprice, 0.5) from {ORD_GAPS})) as o_totalprice, "
    f"coalesce(o_orderpriority, {_MODE_PRIORITY}) as o_orderpriority from {ORD_GAPS}",
)
def impute_both(spark, folder):
    df = orders_with_gaps(spark, folder)
    return clean.apply_imputer(df, clean.fit_imputer_both(df, "median", leave_out=("o_orderkey",)))


@query(
    "impute_apply",
    f"select o_orderkey, coalesce(o_totalprice, (select quantile_disc(o_totalprice, 0.5) from {ORD_GAPS} where o_orderstatus = 'F')) as o_totalprice, "
    "coalesce(o_orderpriority, (select o_orderpriority from "
    f"{ORD_GAPS} where o_orderpriority is not null and o_orderstatus = 'F' group by 1 order by count(*) desc, 1 limit 1)) as o_orderpriority from {ORD_GAPS}",
)
def impute_apply(spark, folder):
    """Fitted on finished orders, stored, loaded, and applied to all orders."""
    df = orders_with_gaps(spark, folder).select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    fitted = clean.fit_imputer_both(df.where("o_orderstatus = 'F'"), "median", leave_out=("o_orderkey", "o_orderstatus"))
    path = fitted.save(spark, scratch_path(spark, "imputer"))
    return clean.apply_imputer(df, clean.FittedImputer.load(spark, path)).drop("o_orderstatus")


@query(
    "narrow_types",
    "select l_orderkey::bigint as l_orderkey, l_linenumber::int as l_linenumber, l_quantity::double as l_quantity, l_extendedprice, "
    "case when (select max(l_orderkey) from lineitem) <= 32767 then 'smallint' when (select max(l_orderkey) from lineitem) <= 2147483647 then 'int' else 'bigint' end as key_type, "
    "'tinyint' as number_type, 'float' as quantity_type, 'double' as price_type from lineitem",
)
def narrow_types(spark, folder):
    """The narrowed columns' types, and the values widened again to show that none changed."""
    wide = lineitem(spark, folder).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    narrow = columns.narrow_types(wide)
    kinds = dict(narrow.dtypes)
    return narrow.select(
        *[F.col(c).cast(t).alias(c) for c, t in wide.dtypes],
        F.lit(kinds["l_orderkey"]).alias("key_type"),
        F.lit(kinds["l_linenumber"]).alias("number_type"),
        F.lit(kinds["l_quantity"]).alias("quantity_type"),
        F.lit(kinds["l_extendedprice"]).alias("price_type"),
    )


# ---- outliers ----------------------------------------------------------------

_BOUNDS = (
    "b as (select q1, q3, q1 - (q3 - q1) * 1.5 as low, q3 + (q3 - q1) * 1.5 as high from "
    "(select quantile_disc(value, 0.25) as q1, quantile_disc(value, 0.75) as q3 from events))"
)


def _event_bounds(df):
    return outliers.iqr_bounds(df, ["value"])


@query("iqr_bounds", f"with {_BOUNDS} select 'value' as column_name, q1, q3, {round_sql('low')} as low, {round_sql('high')} as high from b")
def iqr_bounds(spark, folder):
    df = events(spark, folder)
    return rounded(outliers.bounds_frame(df, _event_bounds(df)), ["column_name", "q1", "q3"])


@query("iqr_flag", f"with {_BOUNDS} select event_id, value, case when value not between low and high then value end as value_outlier from events, b")
def iqr_flag(spark, folder):
    df = events(spark, folder).select("event_id", "value")
    return outliers.flag_outliers(df, _event_bounds(df))


@query(
    "outlier_cutoff",
    f"with {_BOUNDS}, m as (select min(value) as m from events, b where value > high) "
    "select event_id, value from events, m where m is null or value < floor(m)",
)
def outlier_cutoff(spark, folder):
    return outliers.outlier_stage(events(spark, folder).select("event_id", "value"), "value", True, "Regression")


@query("outlier_remove", f"with {_BOUNDS} select event_id, value from events, b where value between low and high")
def outlier_remove(spark, folder):
    df = events(spark, folder).select("event_id", "value")
    return outliers.remove_outliers(df, "value", _event_bounds(df)["value"])


# ---- encoding ----------------------------------------------------------------

_FREQ = "(select o_orderpriority, row_number() over (order by count(*) desc, o_orderpriority) - 1 as code from {src} where o_orderpriority is not null group by 1)"
_FIRST = "(select * from orders where o_orderstatus = 'F' and o_orderpriority <> '5-LOW')"


@query("string_index", f"select o_orderkey, o_orderpriority, code::double as code from orders join {_FREQ.format(src='orders')} using (o_orderpriority)")
def string_index(spark, folder):
    df = orders(spark, folder).select("o_orderkey", "o_orderpriority")
    codes = encode.fit_index(df, "o_orderpriority")
    return encode.apply_codes(df, codes, "o_orderpriority", "code").withColumn("code", F.col("code").cast("double"))


def _index_of_part(spark, folder, invalid):
    """Fitted on some orders, applied to all: the last priority and nulls are unknown."""
    part = orders(spark, folder).where("o_orderstatus = 'F' and o_orderpriority <> '5-LOW'")
    codes = encode.fit_index(part, "o_orderpriority")
    df = orders_with_gaps(spark, folder).select("o_orderkey", "o_orderpriority")
    return encode.apply_codes(df, codes, "o_orderpriority", "code", invalid)


@query("string_index_skip", f"select o.o_orderkey, o.o_orderpriority, i.code from {ORD_GAPS} o join {_FREQ.format(src=_FIRST)} i using (o_orderpriority)")
def string_index_skip(spark, folder):
    return _index_of_part(spark, folder, "skip")


@query(
    "string_index_keep",
    f"select o.o_orderkey, o.o_orderpriority, coalesce(i.code, 4) as code from {ORD_GAPS} o left join {_FREQ.format(src=_FIRST)} i on o.o_orderpriority = i.o_orderpriority",
)
def string_index_keep(spark, folder):
    return _index_of_part(spark, folder, "keep")


@query(
    "onehot_vector",
    "select o_orderkey, " + ", ".join(f"case when code = {i} then 1.0 else 0.0 end::double as e{i}" for i in range(4)) + f" from orders join {_FREQ.format(src='orders')} using (o_orderpriority)",
)
def onehot_vector(spark, folder):
    """MLlib's index and one-hot vector, the last category dropped; the vector is spread into columns."""
    df = orders(spark, folder).select("o_orderkey", "o_orderpriority")
    stages = [StringIndexer(inputCol="o_orderpriority", outputCol="i"), OneHotEncoder(inputCols=["i"], outputCols=["v"])]
    out = Pipeline(stages=stages).fit(df).transform(df).withColumn("a", vector_to_array("v"))
    return out.select("o_orderkey", *[F.col("a")[i].alias(f"e{i}") for i in range(4)])


@query(
    "assemble_features",
    "select o_orderkey, s0 as f0, s1 as f1, p0 as f2, p1 as f3, p2 as f4, p3 as f5, o_totalprice as f6 from "
    "(select o_orderkey, o_totalprice, "
    + ", ".join(f"case when s.code = {i} then 1.0 else 0.0 end::double as s{i}" for i in range(2))
    + ", "
    + ", ".join(f"case when p.code = {i} then 1.0 else 0.0 end::double as p{i}" for i in range(4))
    + f" from orders join {_FREQ.format(src='orders')} p using (o_orderpriority) "
    "join (select o_orderstatus, row_number() over (order by count(*) desc, o_orderstatus) - 1 as code from orders group by 1) s using (o_orderstatus))",
)
def assemble_features(spark, folder):
    df = orders(spark, folder).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    stages = encode.feature_stages(["o_orderstatus", "o_orderpriority"], ["o_totalprice"])
    out = stages.fit(df).transform(df).withColumn("a", vector_to_array("features"))
    return out.select("o_orderkey", *[F.col("a")[i].alias(f"f{i}") for i in range(7)])


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "onehot_wide",
    "select o_orderkey, "
    + ", ".join(f"case when o_orderpriority = '{p}' then 1.0 else 0.0 end::double as \"o_orderpriority_{p}\"" for p in _PRIORITIES)
    + f" from {ORD_GAPS}",
)
def onehot_wide(spark, folder):
    df = orders_with_gaps(spark, folder).select("o_orderkey", "o_orderpriority")
    return encode.apply_onehot(df, encode.fit_onehot(df, ["o_orderpriority"]))


@query(
    "label_encode",
    "select p_partkey, p_brand, code from part join (select p_brand, row_number() over (order by p_brand) - 1 as code from (select distinct p_brand from part)) using (p_brand)",
)
def label_encode(spark, folder):
    df = read_parquet(spark, folder, "part").select("p_partkey", "p_brand")
    return encode.apply_codes(df, encode.fit_labels(df, "p_brand"), "p_brand", "code")


# ---- scaling and selection ---------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_KEYS = ", ".join(LINE_KEY)


def _scaled(spark, folder, center, ddof):
    df = lineitem(spark, folder).select(*LINE_KEY, *SCALED).withColumn("constant", F.lit(3.0))
    fitted = scale.fit_scaler(df, [*SCALED, "constant"], center, ddof)
    return rounded(scale.apply_scaler(df, fitted), LINE_KEY)


@query(
    "scale_std",
    f"select {_KEYS}, " + ", ".join(f"{round_sql(f'{c} / (select stddev_samp({c}) from lineitem)')} as {c}" for c in SCALED) + ", 0.0::double as constant from lineitem",
)
def scale_std(spark, folder):
    return _scaled(spark, folder, center=False, ddof=1)


@query(
    "scale_zscore",
    f"select {_KEYS}, "
    + ", ".join(f"{round_sql(f'({c} - (select avg({c}) from lineitem)) / (select stddev_pop({c}) from lineitem)')} as {c}" for c in SCALED)
    + ", 0.0::double as constant from lineitem",
)
def scale_zscore(spark, folder):
    return _scaled(spark, folder, center=True, ddof=0)


_CHI = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]


def _chi_sql(c):
    return (
        f"select '{c}' as column_name, {round_sql('sum((coalesce(o.n, 0) - v.n * k.n / t.n::double) * (coalesce(o.n, 0) - v.n * k.n / t.n::double) / (v.n * k.n / t.n::double))')} as statistic, "
        f"((select count(distinct {c}) from lineitem) - 1) * ((select count(distinct l_returnflag) from lineitem) - 1) as df "
        f"from (select {c} as x, count(*) as n from lineitem group by 1) v cross join (select l_returnflag as y, count(*) as n from lineitem group by 1) k "
        f"cross join (select count(*) as n from lineitem) t "
        f"left join (select {c} as x, l_returnflag as y, count(*) as n from lineitem group by 1, 2) o on o.x = v.x and o.y = k.y"
    )


@query("chi_square_stats", " union all ".join(_chi_sql(c) for c in _CHI))
def chi_square_stats(spark, folder):
    stats = select.chi_square_stats(lineitem(spark, folder), _CHI, "l_returnflag")
    return rounded(stats, ["column_name", "df"])


def _f_sql(c):
    return (
        f"select '{c}' as column_name, (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) as f_value from "
        f"(select l_returnflag, count({c})::double as n, avg({c}) as m, var_pop({c}) as v, (select avg({c}) from lineitem) as g from lineitem group by 1)"
    )


_ALL_F = " union all ".join(_f_sql(c) for c in SCALED)


@query("anova_f", f"select column_name, {round_sql('f_value')} as f_value from ({_ALL_F})")
def anova_f(spark, folder):
    return rounded(select.anova_f(lineitem(spark, folder), SCALED, "l_returnflag"), ["column_name"])


@query(
    "select_anova",
    f"select column_name, row_number() over (order by f_value desc, column_name)::int as place from ({_ALL_F}) order by f_value desc, column_name limit 2",
)
def select_anova(spark, folder):
    best = select.top_by_anova(lineitem(spark, folder), SCALED, "l_returnflag", 2)
    return spark.createDataFrame([(c, i + 1) for i, c in enumerate(best)], "column_name string, place int")


_CHOICES = ["l_quantity", "l_discount", "l_tax"]
# Three classes make every number of degrees of freedom even, and then the tail
# probability is a finite sum: exp(-x/2) * sum of (x/2)^i / i! for i < df/2.
_CHI_TAIL = (
    "select column_name, list_sum(list_transform(range(0, df // 2), lambda i: exp(i * ln(statistic / 2) - lgamma(i + 1) - statistic / 2))) as p from ("
    + " union all ".join(_chi_sql(c) for c in _CHOICES)
    + ")"
)
_CHOSEN = f"(select column_name from ({_CHI_TAIL}) order by p limit 2)"


def _value_of(place):
    """The row's value of the feature at a place in the list of choices."""
    return f"case {place} " + " ".join(f"when {i} then {c}" for i, c in enumerate(_CHOICES)) + " end"


@query(
    "select_chisq",
    f"with chosen as (select list_sort(list(case column_name when 'l_quantity' then 0 when 'l_discount' then 1 else 2 end)) as places from {_CHOSEN}) "
    f"select {_KEYS}, case places[1] when 0 then 'l_quantity' else 'l_discount' end || ',' || case places[2] when 1 then 'l_discount' else 'l_tax' end as chosen, "
    f"{_value_of('places[1]')} as first, {_value_of('places[2]')} as second from lineitem, chosen",
)
def select_chisq(spark, folder):
    """MLlib's chi-square selection of two features; each row with its values of those."""
    df = lineitem(spark, folder).select(*LINE_KEY, *_CHOICES, "l_returnflag")
    label = StringIndexer(inputCol="l_returnflag", outputCol="label").fit(df).transform(df)
    out, names = select.select_top(label, _CHOICES, "label", 2, "chisquare")
    values = vector_to_array("selectedFeatures")
    return out.select(*LINE_KEY, F.lit(",".join(names)).alias("chosen"), values[0].alias("first"), values[1].alias("second"))


@query(
    "bin_features",
    f"select {_KEYS}, least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19)::int as l_extendedprice "
    "from lineitem, (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem)",
)
def bin_features(spark, folder):
    df = lineitem(spark, folder).select(*LINE_KEY, "l_extendedprice")
    return select.bin_equal_width(df, ["l_extendedprice"], 20)


# ---- sampling and splits -----------------------------------------------------


def _hash_sql(text):
    return f"('0x' || substr(md5({text}), 1, 8))::bigint"


def _wide_hash_sql(text):
    return f"('0x' || substr(md5({text}), 1, 15))::bigint"


def _draw_sql(label, which):
    return (
        f"select r.o_orderkey, r.o_orderstatus, r.o_orderpriority, d.draw, '{label}' as \"by\" from "
        f"(select k.y, k.n, i.draw, {_wide_hash_sql('12345::varchar || chr(45) || k.y || chr(45) || i.draw::varchar')} % k.n as position "
        f"from (select {label} as y, count(*) as n from orders group by 1) k "
        f"cross join (select unnest(range((select {which}(n) from (select count(*) as n from orders group by {label})))) as draw) i) d "
        f"join (select *, row_number() over (partition by {label} order by {_hash_sql('12345::varchar || chr(45) || o_orderkey::varchar')}, o_orderkey) - 1 as position from orders) r "
        f"on r.{label} = d.y and r.position = d.position"
    )


_SAMPLED = ["o_orderstatus", "o_orderpriority"]


def _sampled(spark, folder, mode):
    df = orders(spark, folder).select("o_orderkey", *_SAMPLED)
    return sampling.resample_each(df, _SAMPLED, "o_orderkey", mode)


@query("downsample", " union all ".join(_draw_sql(c, "min") for c in _SAMPLED))
def downsample(spark, folder):
    return _sampled(spark, folder, "down")


@query("upsample", " union all ".join(_draw_sql(c, "max") for c in _SAMPLED))
def upsample(spark, folder):
    return _sampled(spark, folder, "up")


@query("split_random")
def split_random(spark, folder):
    """Spark's seeded random split, both sides marked."""
    train, test = sampling.split_random(orders(spark, folder).select("o_orderkey"))
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


_KEY_HASH = _hash_sql("12345::varchar || chr(45) || o_orderkey::varchar")
_KEY_WIDE = _wide_hash_sql("12345::varchar || chr(45) || o_orderkey::varchar")


@query("split_hash", f"select o_orderkey, case when {_KEY_WIDE} < {int(0.8 * (1 << 60))} then 'train' else 'test' end as side from orders")
def split_hash(spark, folder):
    df = orders(spark, folder).select("o_orderkey")
    return df.withColumn("side", F.when(sampling.train_flag("o_orderkey"), "train").otherwise("test"))


@query(
    "split_exact",
    f"select o_orderkey, row_number() over (order by {_KEY_HASH}, o_orderkey) <= ceil((select count(*) from orders) * 0.2) as in_test from orders",
)
def split_exact(spark, folder):
    return sampling.split_exact(orders(spark, folder).select("o_orderkey"), "o_orderkey", 0.2)
