from datetime import date

import pytest

from clickloom.operators import serving
from clickloom.operators.funnel import roll_up_funnel
from clickloom.operators.serving import Slice


@pytest.fixture
def gold(spark):
    weekday_hour = spark.createDataFrame(
        [("2019-10", 1, 0, 4, 2, 1), ("2019-10", 3, 5, 6, 1, 0), ("2019-11", 1, 0, 10, 5, 4)],
        "event_month string, spark_weekday_sunday_1 int, utc_hour int, view_sessions bigint, "
        "cart_after_view_sessions bigint, purchase_after_cart_sessions bigint",
    )
    category_day = spark.createDataFrame(
        [
            ("2019-10", date(2019, 10, 1), "b", 2, 10.0, 0),
            ("2019-10", date(2019, 10, 2), "a", 2, None, 2),
            ("2019-11", date(2019, 11, 1), "c", 5, 7.5, 0),
        ],
        "event_month string, purchase_date_utc date, category_code string, "
        "purchase_event_count bigint, estimated_value_sum_price double, "
        "nonpositive_price_events bigint",
    )
    by_time = spark.createDataFrame(
        [
            ("2019-10", date(2019, 10, 1), 9, 2, 10.0),
            ("2019-10", date(2019, 10, 2), 9, 2, None),
            ("2019-11", date(2019, 11, 1), 23, 5, 7.5),
        ],
        "event_month string, purchase_date_utc date, utc_hour int, "
        "purchase_event_count bigint, estimated_value_sum_price double",
    )
    return {
        "funnel_by_month": roll_up_funnel(weekday_hour, "event_month"),
        "funnel_by_utc_weekday_hour": weekday_hour,
        "purchases_by_category": category_day.groupBy("category_code").count(),
        "purchases_by_category_day": category_day,
        "purchases_by_utc_time": by_time,
    }


def test_kpis_without_choice_take_all(gold):
    found = serving.slice_kpis(gold, Slice()).first()
    assert found.asDict() == {
        "purchase_events": 9,
        "estimated_value": 17.5,
        "view_sessions": 20,
        "view_to_purchase_rate": 0.25,
    }


def test_dates_are_inclusive_and_category_leaves_sessions_alone(gold):
    picked = Slice(category="a", start=date(2019, 10, 2), end=date(2019, 10, 2))
    found = serving.slice_kpis(gold, picked).first()
    assert (found["purchase_events"], found["estimated_value"]) == (2, 0.0)
    assert found["view_sessions"] == 20


def test_nothing_picked_is_zero_and_no_rate(gold):
    found = serving.slice_kpis(gold, Slice(months=("2020-01",))).first()
    assert (found["purchase_events"], found["estimated_value"], found["view_sessions"]) == (0, 0, 0)
    assert found["view_to_purchase_rate"] is None


def test_domains(gold):
    found = {(r["domain"], r["value"]) for r in serving.filter_domains(gold).collect()}
    assert found == {
        ("month", "2019-10"),
        ("month", "2019-11"),
        ("category", "a"),
        ("category", "b"),
        ("category", "c"),
        ("first_date", "2019-10-01"),
        ("last_date", "2019-11-01"),
    }


def test_stages(gold):
    found = serving.funnel_stages(gold["funnel_by_month"], Slice(months=("2019-10",))).collect()
    assert {(r["stage"], r["sessions"]) for r in found} == {
        ("view_sessions", 10),
        ("cart_after_view_sessions", 3),
        ("purchase_after_cart_sessions", 1),
    }


def test_top_categories_break_ties_by_name(gold):
    found = serving.slice_top_categories(gold["purchases_by_category_day"], Slice(), k=2).collect()
    assert [r["category_code"] for r in found] == ["c", "a"]


def test_grid_has_all_hours_of_the_week(spark, gold):
    grid = serving.conversion_grid(spark, gold["funnel_by_utc_weekday_hour"], Slice())
    rows = {(r["weekday_number"], r["utc_hour"]): r for r in grid.collect()}
    assert len(rows) == 168
    assert rows[1, 0]["conversion_rate"] == pytest.approx(5 / 14)
    assert rows[7, 23]["conversion_rate"] is None
    assert rows[3, 5]["conversion_rate"] == 0.0


def test_hours_of_the_day_ignore_the_category(spark, gold):
    found = serving.slice_purchases_by_hour(
        spark, gold["purchases_by_utc_time"], Slice(category="c", months=("2019-10",))
    )
    assert {r["utc_hour"]: r["purchase_events"] for r in found.collect()} == {
        hour: 4 if hour == 9 else 0 for hour in range(24)
    }


def test_purchases_by_date(gold):
    found = serving.slice_purchases_by_date(
        gold["purchases_by_category_day"], Slice(start=date(2019, 10, 2))
    ).collect()
    assert [(r["purchase_date_utc"], r["purchase_events"]) for r in found] == [
        (date(2019, 10, 2), 2),
        (date(2019, 11, 1), 5),
    ]
