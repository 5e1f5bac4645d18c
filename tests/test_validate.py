from datetime import date

import pytest
from conftest import as_list, as_set

from tallyloom.operators import lookup, validate
from tallyloom.schemas import Minimum


@pytest.fixture(params=["small", "large"])
def parent_size(request, monkeypatch):
    """Run with parents and key sets treated as small, and as too large to broadcast."""
    if request.param == "large":
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    return request.param


@pytest.mark.usefixtures("parent_size")
def test_orphans(rows):
    child = rows([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "d"), (None, "d")], "k int, v string")
    parent = rows([(1,), (1,), (3,), (None,)], "id int")
    result = validate.orphans(child, parent, "k", "id")
    assert result.columns == ["k", "v"]
    assert as_list(result) == sorted([(2, "b"), (2, "b"), (None, "d"), (None, "d")], key=repr)


@pytest.mark.usefixtures("parent_size")
def test_orphans_with_the_same_key_name_and_empty_parent(rows):
    child = rows([(1,), (None,)], "k int")
    assert as_list(validate.orphans(child, child, "k", "k")) == [(None,)]
    assert as_list(validate.orphans(child, child.limit(0), "k", "k")) == [(1,), (None,)]


@pytest.mark.usefixtures("parent_size")
def test_rows_with_keys(rows):
    df = rows([(1, "a", "x"), (1, "b", "y"), (None, "a", "z")], "k int, l string, v string")
    keys = rows([(1, "a"), (None, "a")], "k int, l string")
    assert as_set(lookup.rows_with_keys(df, keys)) == {(1, "a", "x")}
    assert as_set(lookup.rows_with_keys(df, keys, null_matches=True)) == {(1, "a", "x"), (None, "a", "z")}


def test_size_check_counts_text(rows, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 1000)
    assert lookup.is_small(rows([("x" * 900,), (None,)], "k string"))
    assert not lookup.is_small(rows([("x" * 900,), ("y" * 900,)], "k string"))
    assert lookup.is_small(rows([(n,) for n in range(25)], "k int"))
    assert not lookup.is_small(rows([(n,) for n in range(26)], "k int"))
    assert lookup.is_small(rows([], "k int"))


def test_null_keys(rows):
    df = rows([(1, None), (None, 2), (1, 2)], "a int, b int")
    assert as_set(validate.null_keys(df, ["a"])) == {(None, 2)}
    assert as_set(validate.null_keys(df, ["a", "b"])) == {(None, 2), (1, None)}


def test_out_of_order_ignores_missing_dates(rows):
    day, next_day = date(2021, 6, 7), date(2021, 6, 8)
    df = rows([(day, next_day), (day, day), (next_day, day), (None, day), (day, None)], "o date, s date")
    assert as_set(validate.out_of_order(df, "o", "s")) == {(next_day, day)}


def test_below_minimum(rows):
    df = rows([(-1,), (0,), (1,), (None,)], "n int")
    assert as_set(validate.below_minimum(df, Minimum("n"))) == {(-1,)}
    assert as_set(validate.below_minimum(df, Minimum("n", inclusive=False))) == {(-1,), (0,)}
    assert as_set(validate.below_minimum(df, Minimum("n", value=1))) == {(-1,), (0,)}


def test_reconcile(rows):
    df = rows([(1,), (2,)], "n int")
    result = validate.reconcile({"A": (df, df.limit(1)), "B": (df.limit(0), df.limit(0))})
    assert result.columns == ["TableName", "RawRows", "StoreRows", "Difference"]
    assert as_set(result) == {("A", 2, 1, -1), ("B", 0, 0, 0)}
