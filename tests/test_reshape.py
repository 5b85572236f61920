"""Unnesting, zipping and renaming."""

from hypothesis import given, settings
from hypothesis import strategies as st

from starflow.operators import copy_column, project, rename, unnest, zip_arrays

ints = st.lists(st.one_of(st.none(), st.integers(-5, 5)), max_size=6)


@settings(max_examples=15, deadline=None)
@given(docs=st.lists(st.tuples(ints, ints, ints), min_size=1, max_size=5))
def test_zip_is_pythons_zip(spark, docs):
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)],
                               "id int, a array<int>, b array<int>, c array<int>")
    got = zip_arrays(df, {"x": "a", "y": "b", "z": "c"}, keep=["id"]).collect()
    expected = [(i, *z) for i, d in enumerate(docs) for z in zip(*d, strict=False)]
    assert [tuple(r) for r in got] == expected


def test_zip_lengths_and_nulls(spark):
    df = spark.createDataFrame([(1, [1, 2, 3], [4, 5]), (2, [1], None), (3, [], [1])],
                               "id int, a array<int>, b array<int>")
    assert [tuple(r) for r in zip_arrays(df, {"x": "a", "y": "b"}, keep=["id"]).collect()] == \
        [(1, 1, 4), (1, 2, 5)]
    assert zip_arrays(df, {"x": "a"}).count() == 4


def test_unnest(spark):
    df = spark.createDataFrame([(1, [(1, "a"), (2, None)]), (2, []), (3, None)],
                               "id int, rows array<struct<n: int, s: string>>")
    got = unnest(df, "rows", keep=["id"])
    assert got.columns == ["id", "n", "s"]
    assert [tuple(r) for r in got.collect()] == [(1, 1, "a"), (1, 2, None)]


def test_rename_by_name(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    out = project(copy_column(rename(df, {"b": "name"}), "name", "address"), "name", "address", "a")
    assert out.columns == ["name", "address", "a"] and tuple(out.first()) == ("x", "x", 1)
