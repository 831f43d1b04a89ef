"""Lines go to their product once, as they are; orders and months are told apart by their order there."""

import re

import pytest

from provisio.operators import features as fe
from tests.test_product_months import lines_of


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_sent_once_and_not_aggregated_before(spark):
    from provisio.plans.inputs import Inputs

    lines = Inputs(spark, "/root/testdata/sf0.001").lines
    for found in (fe.demand_features(lines), fe.demand_aggregate(lines)):
        plan = plan_of(found)
        assert len(re.findall(r"\bExchange ", plan)) == 1 + len(re.findall(r"\bExchange ", plan_of(lines)))
        assert set(re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", plan)) == {re.search(r"HashAggregate\(keys=\[(product_id#\w+)\]", plan).group(1)}


def test_orders_and_months_without_a_date_or_a_number(spark):
    rows = [(1, None, 4.0, 1.0, None, 1), (1, None, 6.0, 1.0, 7, 1), (1, "2024-02-05", 5.0, 1.0, 8, 1), (1, "2024-02-01", 15.0, 1.0, 8, 1), (1, "2024-02-09", None, 1.0, None, 1),
            (1, "2024-04-01", 10.0, 1.0, 9, 1), (1, "2024-05-01", None, 1.0, 9, 1), (2, "2024-01-01", 3.0, 1.0, None, 1), (3, "2023-12-01", 2.0, 1.0, 1, 1), (3, "2024-01-01", 3.0, 1.0, 1, 1)]
    got = {r.product_id: r for r in fe.demand_features(lines_of(spark, rows)).collect()}
    # the lines without a date are a month of their own before the others: 10, 20, 10 and a month without quantity
    assert (got[1].order_nunique, got[1].demand_growth_mean, got[1].demand_trend_slope) == (4, 0.25, 0.0)
    assert (got[2].order_nunique, got[2].demand_growth_mean, got[2].demand_trend_slope, got[2].qty_std) == (0, None, 0.0, None)
    assert (got[3].order_nunique, got[3].demand_growth_mean, got[3].demand_growth_std, got[3].demand_trend_slope) == (2, 0.5, None, 1.0)
    assert got[1].demand_growth_std == pytest.approx(1.0607, abs=1e-4)
