import pytest
from pyspark.sql.types import DoubleType, LongType, TimestampType

from clickloom.operators import gold
from clickloom.operators.parse import parse_events
from clickloom.operators.quality import silver_audit
from clickloom.operators.silver import is_rejected, rejected_rows, silver_events
from clickloom.sources.events_csv import read_events


@pytest.fixture
def shop(spark, csv_file, shop_files):
    return read_events(spark, [csv_file(name, lines) for name, lines in shop_files.items()])


def test_silver_of_two_files(shop):
    audit = silver_audit(parse_events(shop)).first()
    assert (audit["source_rows"], audit["rejected_rows"]) == (15, 3)
    assert audit["invalid_timestamp_rows"] == audit["unexpected_event_type_rows"] == 1
    assert audit["valid_rows_before_dedup"] == 12
    silver = silver_events(shop)
    types = {f.name: type(f.dataType) for f in silver.schema}
    assert [types[name] for name in ("event_time", "product_id", "user_id", "price")] == [
        TimestampType, LongType, LongType, DoubleType,
    ]
    rows = silver.collect()
    assert len(rows) == 10
    assert sorted(r["event_month"] for r in rows) == ["2021-04"] * 6 + ["2021-05"] * 4
    # The seeds have no category, the lines of the shed no session.
    assert sum(r["category_code"] is None for r in rows) == 2
    assert sum(r["user_session"] is None for r in rows) == 2
    assert sorted(r["price"] for r in rows if r["price_quality"] == "nonpositive") == [
        -3.25, -3.25, 0.0, 0.0,
    ]
    copies = [r for r in rows if r["event_type"] == "purchase" and r["product_id"] == 601]
    assert [r["source_file"] for r in copies] == ["april.csv"]


def test_gold_of_two_files(shop):
    tables = gold.gold_metrics(silver_events(shop))
    # All three sessions with a view began in April; the seeds were bought without a cart.
    month = tables["funnel_by_month"].first().asDict()
    assert month["event_month"] == "2021-04"
    assert [month[f"{stage}_sessions"] for stage in
            ("view", "cart_after_view", "purchase_after_cart")] == [3, 2, 2]
    by_category = {r["category_code"]: r.asDict() for r in tables["purchases_by_category"].collect()}
    assert set(by_category) == {"home.light.lamp", "home.office.desk", "garden.shed", "[sin categoría]"}
    assert by_category["home.office.desk"]["estimated_value_sum_price"] == 250.0
    assert by_category["garden.shed"]["nonpositive_price_events"] == 1
    assert by_category["[sin categoría]"]["purchase_event_count"] == 1
    assert tables["purchases_by_category_day"].count() == 4
    assert {r["utc_hour"] for r in tables["purchases_by_utc_time"].collect()} == {20, 6, 0, 11}
    # Thursday 20:00, Friday 06:00 and Friday 23:00.
    assert tables["funnel_by_utc_weekday_hour"].count() == 3


BAD = [
    {"_corrupt_record": "line"},
    {"event_time": ""},
    {"event_time": "2021-03-14"},
    {"event_type": None},
    {"event_type": "View"},
    {"event_type": "\tview"},
    {"product_id": " "},
    {"product_id": "a1"},
    {"category_id": "x"},
    {"user_id": "1.5"},
    {"price": "NaN"},
    {"price": "inf"},
    {"price": "\t"},
]
GOOD = [
    {},
    {"event_type": " view "},
    {"category_id": ""},
    {"user_id": None},
    {"price": ""},
    {"price": "-5"},
    {"user_session": ""},
    {"brand": None, "category_code": None},
]


@pytest.mark.parametrize("row", BAD)
def test_rejected(bronze, row):
    assert rejected_rows(parse_events(bronze(row))).count() == 1
    assert silver_events(bronze(row)).count() == 0


@pytest.mark.parametrize("row", GOOD)
def test_accepted(bronze, row):
    assert rejected_rows(parse_events(bronze(row))).count() == 0
    assert silver_events(bronze(row)).count() == 1


def test_rejection_is_never_null(bronze):
    rows = parse_events(bronze(*BAD, *GOOD, {"event_type": None, "product_id": None}))
    assert rows.where(is_rejected().isNull()).count() == 0


def test_copies_differ_by_any_text(bronze):
    rows = bronze({}, {}, {"brand": " fernwood"}, {"brand": None}, {"brand": ""})
    assert silver_events(rows).count() == 4


def test_copy_in_two_files_keeps_the_first_name(bronze):
    """Whatever the order of rows and the number of files."""
    names = ["b.csv", "a b.csv", "2021-Oct.csv", "2021-Nov.csv", "ä.csv"]
    for kept in range(2, 6):
        some = [{"source_file": name} for name in names[:kept]]
        for rows in (some, some[::-1], some + some):
            assert silver_events(bronze(*rows)).first()["source_file"] == min(names[:kept])


def test_a_row_with_a_third_of_all_copies(spark, bronze):
    one = bronze({})
    many = one.crossJoin(spark.range(20_000)).drop("id")
    others = bronze(*[{"product_id": str(i)} for i in range(2, 12)])
    assert silver_events(many.unionByName(others)).count() == 11


def test_plan_dedups_with_one_wide_exchange(bronze):
    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    without = plan(silver_events(bronze({})).drop("source_file"))
    assert without.count("Exchange") == 1
    assert "Sort" not in without
    whole = plan(silver_events(bronze({})))
    assert whole.count("Exchange") == 1
    assert "Join" not in whole
