from datetime import date

from decimal import Decimal

import pytest
from conftest import as_list, as_set
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyloom.functions.totals import merge_sum, partial_sum
from tallyloom.operators import lookup
from tallyloom.plans import reports

Y1, Y2 = date(2020, 1, 1), date(2021, 1, 1)
ORDERS = "ProductID int, OrderDate date, LeadTimeInBusinessDays int, TotalLineExtendedPrice double"
PRODUCTS = "ProductID int, Color string, ProductCategoryName string"


@pytest.fixture(params=["small", "large"], autouse=True)
def product_size(request, monkeypatch):
    """Run with the products treated as small, and as too large to broadcast."""
    if request.param == "large":
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)


@pytest.fixture
def orders(rows):
    data = [
        (1, Y1, 2, 10.0),
        (1, Y1, 4, 0.1),
        (2, Y1, 0, 10.1),
        (3, Y1, None, 1.0),
        (1, Y2, 1, 5.0),
        (9, Y2, 7, 50.0),
        (None, Y2, 8, 0.5),
        (1, None, 3, 1000.0),
        (2, Y2, 1, None),
    ]
    return rows(data, ORDERS)


@pytest.fixture
def products(rows):
    return rows([(1, "Red", "Bikes"), (2, "Blue", "Clothing"), (3, "N/A", None), (4, "Black", "Bikes")], PRODUCTS)


@pytest.mark.usefixtures("either_ansi")
def test_revenue_by_year_color(orders, products):
    assert as_set(reports.revenue_by_year_color(orders, products)) == {
        (2020, "Red", 10.1),
        (2020, "Blue", 10.1),
        (2020, "N/A", 1.0),
        (2021, "Red", 5.0),
        (2021, "Blue", None),
        (2021, None, 50.5),
    }


def test_ties_go_to_the_first_color_and_unknown_products_can_win(orders, products):
    assert as_set(reports.top_color_per_year(orders, products)) == {(2020, "Blue", 10.1), (2021, None, 50.5)}


def test_ranks(orders, products):
    result = reports.ranked_colors(orders, products)
    assert result.columns == ["Year", "Color", "TotalRevenue", "rank"]
    assert as_set(result.select("Year", "Color", "rank")) == {
        (2020, "Blue", 1),
        (2020, "Red", 2),
        (2020, "N/A", 3),
        (2021, None, 1),
        (2021, "Red", 2),
        (2021, "Blue", 3),
    }


def test_spread_ranks_are_the_same(orders, products):
    spread = reports.ranked_colors(orders, products, spread=True)
    plain = reports.ranked_colors(orders, products)
    assert spread.dtypes == plain.dtypes
    assert as_list(spread) == as_list(plain)


@pytest.mark.usefixtures("either_ansi")
def test_lead_time_is_weighted_by_line(orders, products):
    result = reports.lead_time_by_category(orders, products)
    assert [tuple(r) for r in result.collect()] == [(None, 7.5), ("Bikes", 2.5), ("Clothing", 0.5)]
    known = reports.lead_time_by_known_category(orders, products)
    assert [tuple(r) for r in known.collect()] == [("Bikes", 2.5), ("Clothing", 0.5)]


def test_category_without_any_lead_time(rows, products):
    orders = rows([(1, Y1, None, 1.0)], ORDERS)
    assert as_list(reports.lead_time_by_category(orders, products)) == [("Bikes", None)]


def test_repeated_product_repeats_its_lines(rows, orders):
    """Keys that differ as text can collide once typed; a left join then repeats the lines."""
    products = rows([(1, "Red", "Bikes"), (1, "Blue", "Bikes")], PRODUCTS)
    found = as_set(reports.revenue_by_year_color(orders, products))
    assert {(2020, "Red", 10.1), (2020, "Blue", 10.1)} <= found
    assert as_set(reports.lead_time_by_known_category(orders, products)) == {("Bikes", 2.5)}


def test_nan_revenue_ranks_first_like_a_descending_sort(rows, products):
    orders = rows([(1, Y1, 1, float("nan")), (2, Y1, 1, 5.0)], ORDERS)
    [(year, color, revenue)] = as_list(reports.top_color_per_year(orders, products))
    assert (year, color) == (2020, "Red") and revenue != revenue
    ranks = reports.ranked_colors(orders, products).select("Color", "rank")
    assert as_set(ranks) == {("Red", 1), ("Blue", 2)}


amounts = st.integers(-(10**8), 10**8).map(lambda cents: cents / 100)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), amounts), min_size=1, max_size=100))
def test_sum_of_cents_is_exact(rows, data):
    df = rows(data, "k int, x double").repartition(5)
    result = df.groupBy("k", "x").agg(*partial_sum("x")).groupBy("k").agg(merge_sum().alias("total"))
    exact = {k: sum(round(x * 100) for j, x in data if j == k) / 100 for k, _ in data}
    assert dict(result.collect()) == exact


@pytest.mark.usefixtures("either_ansi")
@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([1e12, 1.0], 1e12 + 1.0),
        ([float("inf"), 1.0], float("inf")),
        ([None, None], None),
        ([None, 2.5], 2.5),
        ([-0.1, -0.2], -0.3),
        ([0.1] * 10, 1.0),
        ([1 / 3] * 30_000, 10_000.0),
        ([4e-7] * 1_000, 4e-4),
        ([4e-7] * 1_000 + [2e9], 2e9 + 4e-4),
        ([1e-12] * 3, 3e-12),
    ],
)
def test_sums_at_the_edges(rows, values, expected):
    df = rows([(i, x) for i, x in enumerate(values)], "k int, x double")
    [(total,)] = df.groupBy("k").agg(*partial_sum("x")).agg(merge_sum()).collect()
    assert total == (expected if expected is None else pytest.approx(expected, rel=1e-13))


def test_small_amounts_can_win(rows):
    data = [(1, "Red", 4.9e-7)] * 1_000 + [(1, "Blue", 1e-6)]
    df = rows(data, "k int, color string, x double")
    totals = dict(df.groupBy("color").agg(*partial_sum("x")).groupBy("color").agg(merge_sum()).collect())
    assert totals["Red"] == pytest.approx(4.9e-4) and totals["Blue"] == 1e-6


LIMBS = "_high long, _low long, _rest long, _beyond double, _amounts long"


def test_sums_beyond_a_long_carry(spark):
    """Partial sums of 2^63 units and more, which a single long sum of units could not hold, in any order."""
    parts = [(2**52, 2**53 - 1, 2**52 + 250_000, None, 2**43), (2**52, 1, -(2**52), None, 2**43), (-(2**20), 0, 500_000, None, 1), (None, None, None, 0.125, 1)] * 7
    units = sum((p[0] or 0) * 2**20 + (p[1] or 0) for p in parts)
    exact = float(units + sum(p[2] or 0 for p in parts) / Decimal(10**6)) + 7 * 0.125
    assert units > 2**63
    for order in (parts, parts[::-1], parts[3:] + parts[:3]):
        assert spark.createDataFrame(order, LIMBS).repartition(3).agg(merge_sum()).first()[0] == exact


@pytest.mark.parametrize("amount", [-1.0, -0.000001, -1048576.5, 999_999_999.999999, 1048576.0, -999_999_999.0])
def test_limbs_of_either_sign(rows, amount):
    df = rows([(1, amount)] * 3, "k int, x double")
    [(total,)] = df.groupBy("k").agg(*partial_sum("x")).agg(merge_sum()).collect()
    assert total == float(3 * Decimal(str(amount)))
