from datetime import datetime

import pytest

from clickloom.operators import duplicates, frequency, purchases, quality, reports
from clickloom.operators.parse import column_catalogue, parse_events
from clickloom.schema import EVENT_TYPES, RAW_COLUMNS


def measured(bronze):
    return quality.quality(parse_events(bronze)).first()


def test_counts_and_period_of_known_and_unknown_types(bronze):
    rows = parse_events(
        bronze(
            {"event_type": "remove_from_cart", "event_time": "2021-12-31 23:59:59 UTC"},
            {"event_type": " purchase"},
            {"event_type": "wishlist", "event_time": "2020-02-29 00:00:00 UTC"},
            {"event_type": "wishlist", "event_time": "2021-02-29 00:00:00 UTC"},
            {"event_type": "Purchase", "event_time": "  "},
            {"event_type": None},
        )
    )
    found = quality.quality(rows).first()
    assert (found["record_count"], found["invalid_timestamps"]) == (6, 1)
    assert found["unexpected_events"] == 3
    assert found["period_min"] == datetime(2020, 2, 29)
    assert found["period_max"] == datetime(2021, 12, 31, 23, 59, 59)
    counts = {r["event_type"]: r["events"] for r in quality.event_counts(rows).collect()}
    assert counts == {"remove_from_cart": 1, "purchase": 1, "wishlist": 2, "Purchase": 1}


def test_every_column_knows_missing_and_padded(bronze):
    """Each column once null, once blank and once padded; the others of a row are plain."""
    rows = [{name: value} for name in RAW_COLUMNS for value in (None, "  ", " 7 ")]
    found = measured(bronze(*rows))
    for name in RAW_COLUMNS:
        assert found[f"missing_{name}"] == 2, name
        assert found[f"whitespace_{name}"] >= 1, name
    assert found["rows_with_session"] == len(rows) - 2
    assert found["nonpositive_product_id"] == 0


def test_ids_and_prices_at_zero_and_below(bronze):
    rows = bronze(
        {"product_id": "0", "category_id": "-12", "user_id": "+0", "price": "-0.01"},
        {"product_id": "-9223372036854775808", "price": "0"},
        {"product_id": "9223372036854775808", "user_id": "12e3", "price": "0x1"},
        {"category_id": "3.0", "price": "1e-9"},
    )
    found = measured(rows)
    nonpositive = [found[f"nonpositive_{n}"] for n in ("product_id", "category_id", "user_id", "price")]
    assert nonpositive == [2, 1, 1, 2]
    invalid = [found[f"invalid_{n}"] for n in ("product_id", "category_id", "user_id", "price")]
    assert invalid == [1, 1, 1, 1]


def test_groups_of_copies(bronze):
    seed = {"product_id": "603", "price": "0.35"}
    rows = bronze(seed, {}, seed, {}, seed, {"price": "0.350"}, {"_corrupt_record": "x"})
    assert duplicates.duplicate_summary(rows).first().asDict() == {
        "duplicate_groups": 2,
        "duplicate_excess_rows": 3,
    }


def test_missing_time_and_type_are_not_invalid_in_the_profile_but_bad_in_the_audit(bronze):
    rows = bronze({"event_time": "", "event_type": " "})
    found = measured(rows)
    assert found["invalid_timestamps"] == 0
    assert found["unexpected_events"] == 0
    audit = quality.silver_audit(parse_events(rows)).first()
    assert audit["invalid_timestamp_rows"] == 1
    assert audit["unexpected_event_type_rows"] == 1
    assert audit["rejected_rows"] == 1


@pytest.mark.parametrize(
    "text, readable",
    [
        ("2021-06-05 04:03:02 UTC", True),
        (" 2021-06-05 04:03:02 UTC ", True),
        ("2021-6-05 04:03:02 UTC", False),
        ("2021-06-05 04:03:02", False),
        ("2021-13-05 04:03:02 UTC", False),
        ("", False),
    ],
)
def test_times(bronze, text, readable):
    ts = parse_events(bronze({"event_time": text})).first()["ts"]
    assert ts == (datetime(2021, 6, 5, 4, 3, 2) if readable else None)


@pytest.mark.parametrize(
    "text, number",
    [("7", 7), ("+5", 5), (" 7 ", 7), ("1.5", None), ("1e3", None), ("9" * 19, None), ("x", None)],
)
def test_ids(bronze, text, number):
    assert parse_events(bronze({"product_id": text})).first()["product"] == number


@pytest.mark.parametrize("text", ["NaN", "Infinity", "-Infinity", "abc"])
def test_prices_that_are_no_numbers(bronze, text):
    found = measured(bronze({"price": text, "event_type": "purchase"}))
    assert found["invalid_price"] == 1
    assert found["valid_price_count"] == 0
    assert found["purchase_price_sum"] is None
    assert found["purchase_events"] == 1


def test_corrupt_rows_count_but_do_not_enter_sums(bronze):
    rows = bronze(
        {"event_type": "purchase", "_corrupt_record": "line", "brand": ""},
        {"event_type": "purchase", "event_time": "2021-04-02 00:00:00 UTC", "price": "7.75"},
    )
    found = measured(rows)
    assert found["record_count"] == 2
    assert found["corrupt_records"] == 1
    assert found["missing_brand"] == 1
    assert found["purchase_events"] == 1
    assert found["purchase_price_sum"] == 7.75
    assert found["period_min"] == datetime(2021, 4, 2)


def test_measures_of_files_add_up(bronze):
    rows = parse_events(
        bronze(
            {"brand": "", "event_type": "purchase", "price": "1.25"},
            {"source_file": "autumn.csv", "price": "x", "event_time": "2021-11-01 00:00:00 UTC"},
            {"source_file": "autumn.csv", "event_type": "purchase", "price": " 2.50"},
        )
    )
    combined = quality.combine_quality(quality.quality(rows, "source_file")).first()
    assert combined.asDict() == quality.quality(rows).first().asDict()
    per_file = quality.quality(rows, "source_file", measures=reports.inventory_measures())
    counts = quality.event_counts(rows, "source_file")
    inventory = {r["source_file"]: r for r in reports.file_inventory(per_file, counts).collect()}
    assert inventory["autumn.csv"]["events_by_type"] == {"purchase": 1, "view": 1}
    assert inventory["autumn.csv"]["record_count"] == 2
    assert inventory["autumn.csv"]["purchase_events"] == 1
    assert inventory["spring.csv"]["view_events"] == 0


def test_no_rows(bronze, spark):
    nothing = bronze({}).limit(0)
    rows = parse_events(nothing)
    assert quality.quality(rows).first()["missing_brand"] == 0
    assert quality.combine_quality(quality.quality(rows, "source_file")).first()["record_count"] == 0
    assert duplicates.duplicate_summary(nothing).first()["duplicate_excess_rows"] == 0
    stats = frequency.frequency_stats(frequency.events_per_hour(rows)).first()
    assert stats["valid_timestamp_events"] == 0
    assert stats["mean_events_per_observed_utc_hour"] is None


def test_fingerprint_tells_null_from_empty(bronze):
    rows = bronze({"brand": None}, {"brand": ""}, {"brand": ""})
    prints = rows.select(duplicates.row_fingerprint().alias("f")).distinct().count()
    assert prints == 2
    assert duplicates.duplicate_summary(rows).first()["duplicate_excess_rows"] == 1


def test_matrix_has_known_types_and_one_column_for_all_others(bronze):
    odd = [{"source_file": "autumn.csv", "event_type": f"type {n}"} for n in range(3)]
    rows = parse_events(bronze({}, {"event_type": " view "}, *odd))
    none = dict.fromkeys((*EVENT_TYPES, "other"), 0)
    found = {r["source_file"]: r.asDict() for r in reports.file_event_matrix(rows).collect()}
    assert found["spring.csv"] == {"source_file": "spring.csv", **none, "view": 2}
    assert found["autumn.csv"] == {"source_file": "autumn.csv", **none, "other": 3}


def test_catalogue_lists_the_nine_columns(spark):
    rows = column_catalogue(spark).collect()
    assert [r["name"] for r in rows] == list(RAW_COLUMNS)
    assert {r["csv_storage_type"] for r in rows} == {"string"}


def test_cube_rolls_up_to_the_direct_counts(bronze):
    rows = parse_events(
        bronze(
            {"event_type": "purchase"},
            {"event_type": "purchase", "event_time": "2021-03-21 23:10:00 UTC"},
            {"event_type": " ", "event_time": "2021-03-14 08:40:00 UTC"},
            {"event_type": "wishlist", "event_time": "bad", "source_file": "b.csv"},
            {"event_type": "purchase", "event_time": ""},
            {"event_type": "purchase", "_corrupt_record": "line"},
        )
    )
    cube = frequency.activity_cube(rows)
    for rolled, direct in (
        (frequency.cube_events_per_hour(cube), frequency.events_per_hour(rows)),
        (frequency.cube_event_counts(cube), quality.event_counts(rows)),
        (
            frequency.cube_event_counts(cube, "source_file"),
            quality.event_counts(rows, "source_file"),
        ),
        (
            frequency.cube_purchases_by_weekday_hour(cube),
            purchases.purchases_by_weekday_hour(rows),
        ),
    ):
        assert sorted(rolled.collect()) == sorted(direct.collect())


def test_ten_thousand_unknown_types_fit_the_matrix(spark, bronze):
    many = bronze({}).drop("event_type").crossJoin(
        spark.range(10_050).selectExpr("concat('type ', id) AS event_type")
    )
    found = reports.file_event_matrix(parse_events(many)).collect()
    assert [(r["view"], r["other"]) for r in found] == [(0, 10_050)]
