"""Types and layouts found in text columns."""

from datetime import date, datetime

import pytest

from daymart.sources import find_types, typed


def found(spark, **columns):
    names = list(columns)
    rows = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{n}` string" for n in names))
    return rows, {r["column"]: r for r in find_types(rows).collect()}


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1", "-20", None, ""], "bigint"),
        (["1", "2.5", "1e3", ".5"], "double"),
        (["123456789012345678901", "1", "2", "3"], "double"),
        (["007", "1", "2", "3"], "string"),
        (["true", "FALSE", None, "True"], "boolean"),
        (["1", "2", "x", None], "string"),
        ([None, "", None, None], "string"),
        (["1\n", "2", "3", "4"], "string"),
        (["NaN", "1", "2", "3"], "string"),
        (["2020-02-29", None, "1999-12-31", ""], "date"),
        (["2020-02-30", "2020-02-01", "2020-02-02", None], "string"),
        (["2020-02-29T10:11:12", "2020-02-29T23:59:59", None, None], "timestamp"),
    ],
)
def test_the_narrowest_type_that_all_rows_fit(spark, values, kind):
    _, kinds = found(spark, c=values)
    row = kinds["c"]
    assert row["type"] == kind and row["n_rows"] == 4
    assert row["n_values"] == sum(v not in (None, "") for v in values)


def test_one_value_settles_the_layout_wherever_it_stands(spark):
    many = ["03/04/2020"] * 400
    _, kinds = found(spark, either=many, days_first=[*many[1:], "13/04/2020"], months_first=["04/13/2020", *many[1:]])
    assert kinds["either"]["type"] == "string" and kinds["either"]["candidates"] == ["dd/MM/yyyy", "MM/dd/yyyy"]
    assert kinds["days_first"]["time_format"] == "dd/MM/yyyy" and kinds["days_first"]["type"] == "date"
    assert kinds["months_first"]["time_format"] == "MM/dd/yyyy"


def test_ambiguous_columns_are_refused_by_name_unless_stated(spark):
    rows, _ = found(spark, n=["1", ""], **{"a day": ["03/04/2020", None]})
    types = find_types(rows)
    with pytest.raises(ValueError, match="a day: dd/MM/yyyy, MM/dd/yyyy"):
        typed(rows, types)
    got = typed(rows, types, {"a day": "dd/MM/yyyy"})
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "date"]
    assert [tuple(r) for r in got.collect()] == [(1, date(2020, 4, 3)), (None, None)]


def test_rows_are_read_as_found_and_others_fail(spark):
    rows, _ = found(spark, t=["29.03.2020 02:30", "1.1"][:1], x=["2.50"], s=[" a "], b=["true"])
    types = find_types(rows)
    assert [tuple(r) for r in typed(rows, types).collect()] == [(datetime(2020, 3, 29, 2, 30), 2.5, " a ", True)]
    other = spark.createDataFrame([("soon", "2.50", "a", "true")], rows.schema)
    with pytest.raises(Exception, match="soon"):
        typed(other, types).collect()


def test_no_rows_and_columns_that_are_no_text(spark):
    rows, _ = found(spark, a=["1"])
    empty = [tuple(r) for r in find_types(rows.limit(0)).collect()]
    assert empty == [("a", 0, 0, "string", None, [])]
    with pytest.raises(ValueError, match="no text: n"):
        find_types(spark.createDataFrame([(1, "a")], "n int, a string"))


def test_one_pass_and_one_row_of_counts(spark):
    rows, _ = found(spark, a=["1"], b=["x"])
    plan = find_types(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
