import pytest
from conftest import bag
from pyspark.sql import functions as F

from prepflow.functions import lookups, scalars
from prepflow.operators import aggregate, columns, joins, mutate, ranking
from prepflow.sources import audit, files, manifest, scratch, tables


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize(
    "lookup, value, expected",
    [
        ("id", 2, [2]),
        ("id__exact", 2, [2]),
        ("name__iexact", "ANN", [1]),
        ("name__exact", None, [4]),
        ("name__iexact", None, [4]),
        ("city__contains", "s", [1, 4]),
        ("city__icontains", "OS", [1, 4]),
        ("id__in", [1, 9], [1]),
        ("pay__gt", 10.0, [3, 4]),
        ("pay__gte", 10.0, [1, 3, 4]),
        ("pay__lt", 30.0, [1]),
        ("pay__lte", 30.0, [1, 3]),
        ("city__startswith", "O", [1]),
        ("city__istartswith", "o", [1, 4]),
        ("name__endswith", "b", [2]),
        ("name__iendswith", "N", [1]),
        ("pay__startswith", 3, [3]),
    ],
)
def test_lookups(people, lookup, value, expected):
    assert ids(lookups.filter_rows(people, **{lookup: value})) == expected


def test_exclude_is_the_complement_even_with_nulls(people):
    for lookup in ({"city__istartswith": "o"}, {"pay__gt": 10.0, "city__exact": "oslo"}, {"name__exact": None}):
        kept, gone = lookups.filter_rows(people, **lookup), lookups.exclude_rows(people, **lookup)
        assert ids(kept.union(gone)) == [1, 2, 3, 4]


def test_get_one_needs_exactly_one_row(people):
    assert ids(lookups.get_one(people, id=3)) == [3]
    with pytest.raises(LookupError):
        lookups.get_one(people, id=99)
    with pytest.raises(LookupError):
        lookups.get_one(people, id__gt=1)


def test_text_and_comparison_lookups_reach_the_scan(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "p"))
    df = lookups.filter_rows(spark.read.parquet(str(tmp_path / "p")), city__startswith="O", pay__gte=5.0).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(city,O)" in plan and "GreaterThanOrEqual(pay,5.0)" in plan
    assert "name" not in plan.split("ReadSchema")[1]


def test_map_values_keeps_the_unmapped(spark, people):
    mapping = spark.createDataFrame([("Oslo", "NO"), ("Paris", "FR")], "a string, b string")
    assert [r[0] for r in bag(columns.map_values(people, "city", mapping), "city")] == [None, "NO", "Rome", "oslo"]


def test_lookup_join_is_the_same_however_it_runs(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 > 0, F.col("id")).alias("k"))
    mapping = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    expected = bag(df.join(mapping, "k", "left"), "row", "k", "v")
    assert bag(joins.lookup_join(df, mapping, "k"), "row", "k", "v") == expected
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_SHARE", 10)
    assert bag(joins.lookup_join(df, mapping, "k"), "row", "k", "v") == expected


def test_narrow_types(spark):
    df = spark.createDataFrame(
        [(127, 128, 40_000, 2**40, 0.5, 0.1), (-128, 0, 0, 0, None, 0.2)],
        "a bigint, b int, c bigint, d bigint, e double, f double",
    )
    out = columns.narrow_types(df)
    assert dict(out.dtypes) == {"a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "float", "f": "double"}
    assert bag(out.select(*[F.col(c).cast(t) for c, t in df.dtypes])) == bag(df)
    assert dict(columns.narrow_types(df, ["f"], lossy_floats=True).dtypes)["f"] == "float"
    empty = columns.narrow_types(df.limit(0))
    assert dict(empty.dtypes)["a"] == "tinyint"


def test_cast_turns_bad_text_to_null(spark):
    df = spark.createDataFrame([("12", "x"), ("y", "7")], "M1 string, M2 string")
    assert bag(columns.cast_prefix(df, "M")) == [(None, 7), (12, None)]


def test_split_by_type_and_padding(people):
    df = people.withColumn("day", F.current_date())
    split = columns.split_by_type(df, leave_out=("id",))
    assert (split.categorical, split.continuous, split.other) == (["name", "city"], ["pay"], ["day"])
    assert columns.pad_columns(df, ["pay", "M9"]).columns == [*df.columns, "M9"]


def test_exclude_values_drops_nulls_either_way(spark, people):
    unwanted = spark.createDataFrame([("Rome",), (None,)], "x string")
    assert ids(columns.exclude_values(people, "city", ["Rome"])) == [1, 4]
    assert ids(columns.exclude_values(people, "city", unwanted)) == [1, 4]


def test_distinct_profile_ignores_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "a"), (1.0, None), (None, "b")], "x double, y string")
    assert bag(aggregate.distinct_profile(df)) == [("x", 1, 4), ("y", 2, 4)]
    assert bag(aggregate.approx_distinct_profile(df)) == [("x", 1), ("y", 2)]


def test_mode_ties_go_to_the_smallest_number_not_text(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (10, "a"), (9, "b"), (None, None), (None, None)], "x int, y string")
    assert bag(aggregate.mode_per_column(df, ["x", "y"])) == [("x", "9", 2), ("y", "a", 2)]


@pytest.mark.parametrize("parts", [1, 7])
def test_first_per_key_does_not_depend_on_partitions(spark, parts):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") * 37 % 1000).alias("t"), "id")
    got = bag(aggregate.first_per_key(df.repartition(parts), "k", ["t"]))
    rows = [(r.k, r.t, r.id) for r in df.collect()]
    assert got == sorted(min((x for x in rows if x[0] == k), key=lambda x: x[1]) for k in range(3))


def test_first_per_key_combines_before_the_shuffle(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), "id")
    plan = aggregate.first_per_key(df, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_numbering_by_ranges_equals_numbering_in_one_task(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string").cast("binary")).alias("v"))
    one = ranking.number_rows(df, [F.col("v").desc()])
    many = ranking.number_rows(df.repartition(5), [F.col("v").desc()], one_task_rows=10)
    assert bag(one) == bag(many)
    assert bag(many.agg(F.min("position"), F.max("position"), F.count_distinct("position"))) == [(1, 5000, 5000)]


def test_full_outer_and_keep_larger(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(2, "p"), (3, "q"), (4, "r")], "k int, b string")
    assert bag(joins.join_full_outer([a, b], "k")) == [(1, "x", None), (2, "y", "p"), (3, None, "q"), (4, None, "r")]
    kept = joins.join_keep_larger(a, b, "k")
    assert kept.columns == ["k", "a", "b"] and sorted(r.k for r in kept.collect()) == [2, 3, 4]
    assert joins.join_keep_larger(b, a, "k").columns == ["k", "a", "b"]


def test_mutations(spark, people):
    more = mutate.insert_rows(people, [(5, "Eve", 1.0, "Rome")])
    assert ids(more) == [1, 2, 3, 4, 5]
    assert bag(mutate.update_where(people, F.col("pay") > 20, {"pay": 0, "city": "X"}), "id", "pay", "city") == [
        (1, 10.0, "Oslo"), (2, None, "Rome"), (3, 0.0, "X"), (4, 0.0, "X"),
    ]
    assert ids(mutate.delete_where(people, F.col("pay") > 20)) == [1, 2]
    orders = spark.createDataFrame([(1, 3), (2, 1), (3, None), (4, 3)], "id int, owner bigint")
    parents, children = mutate.cascade_delete(people, orders, "id", "owner", F.col("pay") > 20)
    assert ids(parents) == [1, 2] and ids(children) == [2, 3]


def test_replacing_a_table_with_rows_read_from_it(spark, people, tmp_path):
    tables.replace_table(people, "t_people", str(tmp_path / "v1"))
    changed = mutate.delete_where(tables.read_table(spark, "t_people"), F.col("id") == 1)
    assert ids(tables.replace_table(changed, "t_people", str(tmp_path / "v2"))) == [2, 3, 4]
    assert ids(tables.append_rows(people.where("id = 1"), "t_people")) == [1, 2, 3, 4]
    assert tables.column_names_in(people.select("name").where("id < 3")) == ["Ann", "bob"]
    empty = tables.empty_table(spark, "t_empty", ["M1_x", "M2_x"], str(tmp_path / "e"))
    assert empty.columns == ["M1_x", "M2_x"] and empty.count() == 0


def test_manifest_matches_hashlib(spark, people, tmp_path):
    import glob
    import hashlib

    path = files.write_csv(people, str(tmp_path / "out"), files=1)
    row = manifest.file_manifest(spark, path, "*.csv").first()
    content = open(glob.glob(path + "/*.csv")[0], "rb").read()
    assert (row.md5, row.bytes, row.size) == (hashlib.md5(content).hexdigest(), len(content), "0.00 MB")
    again = files.read_csv(spark, path, people.schema)
    assert bag(manifest.row_fingerprint(again.repartition(3))) == bag(manifest.row_fingerprint(people))


def test_vectors_go_to_csv_as_text(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(1, Vectors.sparse(3, [1], [2.0]))], ["id", "v"])
    path = files.write_csv(df, str(tmp_path / "v"))
    assert files.read_csv(spark, path).first().v == "[0.0,2.0,0.0]"


def test_audit_appends(spark, tmp_path):
    for stage in ("a", "b"):
        audit.append_audit(spark, str(tmp_path / "log"), "r", stage, "OK", {"n": 1}, {"rmse": 2})
    rows = audit.read_audit(spark, str(tmp_path / "log")).collect()
    assert sorted((r.stage, r.params["n"], r.metrics["rmse"]) for r in rows) == [("a", "1", 2.0), ("b", "1", 2.0)]


def test_scratch_is_the_shared_folder_of_the_session(spark):
    assert scratch.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scalars(spark):
    df = spark.createDataFrame([("Row(min=1145.5)",), ("none",)], "t string")
    assert [r[0] for r in df.select(scalars.first_digits(F.col("t"))).collect()] == ["1145", None]
    replaced = df.select(scalars.replace_texts(F.col("t"), {"Row": "a.b", "(": "["})).first()[0]
    assert replaced == "a.b[min=1145.5)"
    values = spark.createDataFrame([([0.25, -0.75],)], "a array<double>")
    assert values.select(scalars.array_max_abs_percent(F.col("a"))).first()[0] == 75.0


def test_published_versions_are_whole_for_every_reader(spark, people, tmp_path):
    root = str(tmp_path / "people")
    with pytest.raises(ValueError, match="no published version"):
        tables.read_published(spark, root)
    first = tables.publish(people, root)
    begun = tables.read_published(spark, root)
    tables.publish(begun.where("id > 1"), root)  # reads the version it follows
    assert ids(tables.read_published(spark, root)) == [2, 3, 4]
    assert ids(begun) == [1, 2, 3, 4] == ids(tables.read_published(spark, root, first))
    (tmp_path / "people" / "versions" / "unfinished").mkdir()  # a write that died before it was made current
    assert ids(tables.read_published(spark, root)) == [2, 3, 4]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.publish(people.selectExpr("id div (id - id) AS id"), root)
    assert ids(tables.read_published(spark, root)) == [2, 3, 4]
    tables.publish(people.where("id = 3"), root)
    tables.publish(people.where("id = 9"), root, keep=1)
    assert ids(tables.read_published(spark, root)) == [] and first not in tables.published_versions(spark, root)
    assert len(tables.published_versions(spark, root)) == 2
    with pytest.raises(ValueError, match="no published version"):
        tables.read_published(spark, root, first)


def test_a_reader_during_publishing_always_finds_one_version(spark, tmp_path):
    import threading

    root, done, seen = str(tmp_path / "busy"), threading.Event(), []
    tables.publish(spark.range(50).selectExpr("id", "0 AS version"), root)

    def read():
        while not done.is_set():
            seen.append(tables.read_published(spark, root).groupBy("version").count().collect())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for v in range(1, 6):
            tables.publish(spark.range(50).selectExpr("id", f"{v} AS version"), root, keep=6)
    finally:
        done.set()
        reader.join()
    assert seen and all(len(rows) == 1 and rows[0]["count"] == 50 for rows in seen)


def test_literal_rows_do_not_shuffle_the_table(spark):
    from prepflow.catalog import relational

    plan = relational.inline_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
