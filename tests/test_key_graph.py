"""Deletes along links: nulls, cycles, both directions, repeated and composite keys."""

from conftest import bag
from pyspark.sql import functions as F

from prepflow.operators.key_graph import Link, cascade


def brute(rows, links, start, chosen):
    """Deleted places by table, one row at a time."""
    todo = [(start, i) for i in chosen]
    gone = set(todo)
    while todo:
        table, i = todo.pop()
        for x in links:
            steps = [(x.parent, x.parent_column, x.child, x.column)] + ([(x.child, x.column, x.parent, x.parent_column)] if x.extends else [])
            for a, b, c, d in steps:
                value = rows[table][i].get(b) if a == table else None
                for j, other in enumerate(rows[c] if value is not None else []):
                    if other[d] == value and (c, j) not in gone:
                        gone.add((c, j))
                        todo.append((c, j))
    return gone


def test_cascade_equals_row_by_row_deletes_in_a_cyclic_graph(spark):
    rows = {
        "a": [{"id": i, "boss": (i * 7 + 3) % 40 if i % 4 else None} for i in range(60)],
        "b": [{"id": i, "a_id": i % 23 if i % 5 else None, "c_id": i % 11} for i in range(50)],
        "c": [{"id": i, "part": i % 2, "b_id": (i * 3) % 50} for i in range(30)],
    }
    tables = {
        "a": spark.createDataFrame(rows["a"], "id int, boss int"),
        "b": spark.createDataFrame(rows["b"], "id int, a_id int, c_id int"),
        "c": spark.createDataFrame(rows["c"], "id int, part int, b_id int"),
    }
    keys = {"a": ["id"], "b": ["id"], "c": ["id", "part"]}
    for extends in (False, True):
        links = [Link("a", "boss", "a", "id"), Link("b", "a_id", "a", "id", extends), Link("c", "b_id", "b", "id")]
        left = cascade(tables, keys, links, "a", F.col("id").isin(5, 41))
        gone = brute(rows, links, "a", [5, 41])
        for t, df in left.items():
            expected = sorted(r["id"] for j, r in enumerate(rows[t]) if (t, j) not in gone)
            assert [r[0] for r in bag(df, "id")] == expected
        assert gone and left["b"].count() < 50


def test_cascade_of_nulls_repeats_and_nothing(spark):
    tables = {
        "p": spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (2, None)], "`k.1` int, v string"),
        "q": spark.createDataFrame([(1, 9), (None, 8), (2, 7)], "link int, `_hit` int"),
    }
    keys, links = {"p": ["k.1"], "q": ["_hit"]}, [Link("q", "link", "p", "k.1")]
    left = cascade(tables, keys, links, "p", F.col("v") == "x")
    assert bag(left["p"]) == [(None, "y"), (2, None)] and bag(left["q"], "link") == [(None,), (2,)]
    left = cascade(tables, keys, links, "p", F.col("v") == "y")  # the null key points nowhere
    assert bag(left["p"], "v") == [(None,), ("x",), ("x",)] and left["q"].count() == 3
    empty = {t: df.where("false") for t, df in tables.items()}
    assert all(df.isEmpty() for df in cascade(empty, keys, links, "p", F.lit(True)).values())
