from datetime import date
from itertools import permutations

import pytest
from conftest import as_list, as_set
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyloom.operators.standardise import apply_types, most_complete, trim_columns
from tallyloom.plans.quality import table_quality
from tallyloom.plans.store import store_detail, store_header, store_product
from tallyloom.schemas import ORDER_DETAIL, ORDER_HEADER, PRODUCT

WANTED = ["cat", "sub"]
SCHEMA = "id string, cat string, sub string, note string"


def test_trim_keeps_tabs(rows):
    df = rows([(" a ", "\tb "), (None, "c")], "x string, y string")
    assert as_set(trim_columns(df, ["x", "y"])) == {("a", "\tb"), (None, "c")}


def test_most_complete_prefers_the_first_wanted_column(rows):
    df = rows(
        [
            ("1", None, "s", "n"),
            ("1", "c", None, "n"),
            ("2", "c", None, "n"),
            ("2", "c", "s", "n"),
            ("3", None, None, "n"),
        ],
        SCHEMA,
    )
    result = most_complete(df, ["id"], WANTED)
    assert result.columns == df.columns
    assert as_set(result) == {("1", "c", None, "n"), ("2", "c", "s", "n"), ("3", None, None, "n")}


def test_most_complete_does_not_depend_on_row_order(rows):
    ties = [("1", "c", "s", "b"), ("1", "c", "s", "a"), ("1", "d", "s", None)]
    for order in permutations(ties):
        assert as_list(most_complete(rows(list(order), SCHEMA), ["id"], WANTED)) == [("1", "c", "s", "a")]


def test_most_complete_treats_null_keys_as_one_and_text_keys_as_text(rows):
    df = rows([(None, "c", "s", "a"), (None, None, "s", "b"), ("01", "c", "s", "a"), ("1", "c", "s", "a")], SCHEMA)
    assert as_set(most_complete(df, ["id"], WANTED)) == {
        (None, "c", "s", "a"),
        ("01", "c", "s", "a"),
        ("1", "c", "s", "a"),
    }


maybe = st.sampled_from([None, "a", "b"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(maybe, maybe, maybe, maybe), min_size=1, max_size=60))
def test_most_complete_keeps_one_real_row_per_key(rows, data):
    kept = as_list(most_complete(rows(data, SCHEMA), ["id"], WANTED))
    assert sorted(map(repr, (r[0] for r in kept))) == sorted({repr(r[0]) for r in data})
    for row in kept:
        rivals = [r for r in data if r[0] == row[0]]
        assert row in rivals
        assert (row[1] is None, row[2] is None) == min((r[1] is None, r[2] is None) for r in rivals)


@pytest.mark.usefixtures("either_ansi")
def test_bad_text_becomes_null(rows):
    schema = ", ".join(f"{c} string" for c in "abcd")
    df = rows(
        [("1", "1.5", "True", "2021-06-07"), ("x", "1,200.50", "maybe", "2021-06"), ("1.5", "", "0", "2021-13-45"),
         ("99999999999", "1e3", "yes", "2001-02-30"), (None, "-1", None, None), (" 7 ", ".25", "1", "2021-06-07 ")],
        schema,
    )
    typed = apply_types(df, {"a": "int", "b": "double", "c": "boolean", "d": "date"})
    assert [tuple(r) for r in typed.collect()] == [
        (1, 1.5, True, date(2021, 6, 7)),
        (None, None, None, None),
        (None, None, False, None),
        (None, 1000.0, True, None),
        (None, -1.0, None, None),
        (7, 0.25, True, None),
    ]


def test_date_with_a_final_line_break_has_the_shape(rows):
    """The end of the pattern also matches before a final line break, and the cast drops it."""
    assert apply_types(rows([("2021-06-07\n",)], "d string"), {"d": "date"}).first().d == date(2021, 6, 7)


def test_store_tables_have_their_types_and_keep_other_columns(spark):
    for layout, build in ((PRODUCT, store_product), (ORDER_HEADER, store_header), (ORDER_DETAIL, store_detail)):
        raw = spark.createDataFrame([], layout.raw_schema)
        assert build(raw).schema == layout.store_schema
        extra = raw.selectExpr("*", "'x' AS Extra")
        assert build(extra).columns == [*layout.columns, "Extra"]


def test_wide_keys_are_kept_and_narrow_layouts_report_what_they_lose(spark):
    wide = str(2**40)
    raw = spark.createDataFrame([(wide, wide, "1", wide, "1", "0")], ORDER_DETAIL.raw_schema)
    assert store_detail(raw).first()[:4] == (2**40, 2**40, 1, 2**40)
    layout = ORDER_DETAIL.with_types(SalesOrderID="int")
    assert store_detail(raw, layout).first().SalesOrderID is None
    found = {(r.CheckName, r.ColumnName): r.FailedRows for r in table_quality(raw, layout).collect()}
    assert found["lost_in_typing", "SalesOrderID"] == 1
    assert table_quality(raw, ORDER_DETAIL).where("CheckName = 'lost_in_typing' AND FailedRows > 0").count() == 0


def test_store_product_trims_before_it_compares_but_keeps_color_null(spark):
    row = {c: None for c in PRODUCT.columns} | {"ProductID": "1", "SizeUnitMeasureCode": " CM "}
    better = row | {"ProductCategoryName": "Bikes"}
    df = spark.createDataFrame([tuple(row.values()), tuple(better.values())], PRODUCT.raw_schema)
    [kept] = store_product(df).collect()
    assert (kept.ProductID, kept.SizeUnitMeasureCode, kept.ProductCategoryName, kept.Color) == (1, "CM", "Bikes", None)
