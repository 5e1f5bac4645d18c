import pytest
from conftest import as_list, as_set

from tallyloom.operators import review
from tallyloom.schemas import DATE_PATTERN, ORDER_HEADER


@pytest.fixture
def items(rows):
    return rows(
        [("1", "a", None), ("1", "b", "x"), (None, "c", "x"), (None, "d", "x"), ("2", None, "x")],
        "id string, a string, b string",
    )


def test_null_profile(items):
    assert as_list(review.null_profile(items)) == [(2, 1, 1)]
    assert review.null_profile(items).columns == ["id", "a", "b"]


def test_null_profile_of_no_rows(items):
    assert as_list(review.null_profile(items.limit(0))) == [(0, 0, 0)]


def test_rows_with_nulls(items):
    assert as_set(review.rows_with_nulls(items)) == {
        ("1", "a", None),
        (None, "c", "x"),
        (None, "d", "x"),
        ("2", None, "x"),
    }


def test_duplicate_keys_count_null_as_a_key(items):
    assert as_set(review.duplicate_keys(items, ["id"])) == {("1", 2), (None, 2)}


def test_duplicate_keys_over_several_columns(rows):
    df = rows([(1, 1), (1, 1), (1, 2), (2, 1)], "a int, b int")
    assert as_set(review.duplicate_keys(df, ["a", "b"])) == {(1, 1, 2)}


def test_rows_of_duplicate_keys_leave_null_keys_out(items):
    result = review.rows_of_duplicate_keys(items, ["id"])
    assert result.columns == items.columns
    assert as_set(result) == {("1", "a", None), ("1", "b", "x")}


def test_rows_of_duplicate_keys_keep_equal_rows(rows):
    df = rows([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    assert as_list(review.rows_of_duplicate_keys(df, ["id"])) == [(1, "a"), (1, "a")]


@pytest.mark.usefixtures("either_ansi")
def test_bad_format_checks_the_shape_only(rows):
    values = ["2021-06-07", "2021-06", "2021-06", "2021-13-45", "2021-06-07\n", " 2021-06-07", None, ""]
    df = rows([(v,) for v in values], "d string")
    assert as_set(review.bad_format(df, "d", DATE_PATTERN)) == {("2021-06",), (" 2021-06-07",), ("",)}


@pytest.mark.usefixtures("either_ansi")
def test_bad_decimals(rows):
    df = rows(
        [("10", "10.50"), (".25", "10."), ("-1", "1e3"), ("1,200.50", None), ("-1", "0")],
        "a string, b string",
    )
    assert as_list(review.bad_decimals(df, ["a", "b"])) == [
        ("a", "-1"),
        ("a", "1,200.50"),
        ("b", "10."),
        ("b", "1e3"),
    ]


def test_untrimmed_rows_look_at_spaces_only(rows):
    df = rows([(" a", "b"), ("a", "b "), ("a\t", "b"), (None, "b"), (None, " b")], "x string, y string")
    assert as_set(review.untrimmed_rows(df, ["x", "y"])) == {(" a", "b"), ("a", "b "), (None, " b")}


def test_row_counts(items):
    assert as_set(review.row_counts({"A": items, "B": items.limit(0)})) == {("A", 5), ("B", 0)}


def test_first_rows(items):
    assert as_list(review.first_rows(items.where("id is not null"), 2, ["id", "a"])) == [
        ("1", "a", None),
        ("1", "b", "x"),
    ]


def test_schema_report(rows):
    df = rows([], "SalesOrderID bigint, OrderDate string, Extra string")
    found = review.schema_report(df, ORDER_HEADER.store_schema).collect()
    report = {r.ColumnName: (r.Found, r.Expected, r.Agrees) for r in found}
    assert report["SalesOrderID"] == ("bigint", "bigint", True)
    assert report["OrderDate"] == ("string", "date", False)
    assert report["Freight"] == (None, "double", False)
    assert report["Extra"] == ("string", None, False)
