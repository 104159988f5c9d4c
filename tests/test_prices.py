import math

from hypothesis import HealthCheck, given, settings, strategies as st

from clickloom.operators import prices


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "amount double")


def test_fences_and_outliers(spark):
    amounts = frame(spark, [10, 11, 12, 13, 14, 15, 16, 100])
    found = prices.price_summary(amounts, prices.exact_quantiles(amounts)).first()
    assert (found["q1"], found["median"], found["q3"]) == (11.0, 13.0, 15.0)
    assert (found["iqr_lower_fence"], found["iqr_upper_fence"]) == (5.0, 21.0)
    assert found["iqr_outlier_candidate_count"] == 1


def test_values_on_a_fence_are_no_outliers(spark):
    amounts = frame(spark, [0, 4, 4, 8, 8, 14])
    fences = prices.with_fences(prices.exact_quantiles(amounts))
    high = fences.first()["iqr_upper_fence"]
    assert high == 14.0
    flagged = prices.flag_outliers(amounts, fences).where("is_outlier").count()
    assert flagged == 0


def test_without_prices_only_counts_are_given(spark):
    nothing = frame(spark, [])
    for quantiles in (prices.approximate_quantiles, prices.exact_quantiles):
        found = prices.price_summary(nothing, quantiles(nothing)).first()
        assert found["valid_numeric_count"] == 0
        assert found["iqr_outlier_candidate_count"] == 0
        assert found["median"] is None


def test_approximate_ranks_are_within_one_percent(spark):
    n = 20_000
    amounts = spark.range(n).selectExpr("CAST(pmod(id * 7919, 20000) AS DOUBLE) AS amount")
    found = prices.approximate_quantiles(amounts).first()
    for name, p in prices.QUARTILES.items():
        assert abs(found[name] - p * n) <= 0.01 * n + 1


def sketch_rows(spark, n):
    """Prices of three files, one with a price that a third of all rows has."""
    return spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7.5D ELSE CAST(pmod(id * 7919, 20000) AS DOUBLE) END AS amount",
        "CAST(NULL AS STRING) AS _corrupt_record",
        "concat('f', id % 7 % 3) AS source_file",
    )


def test_merged_sketches_are_near_by_rank(spark, tmp_path):
    rows = sketch_rows(spark, 60_000)
    path = str(tmp_path / "sketches")
    prices.price_sketches(rows.where("source_file < 'f2'"), "source_file").write.parquet(path)
    prices.price_sketches(rows.where("source_file = 'f2'"), "source_file").write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 3 and stored.schema["sketch"].dataType.simpleString() == "binary"
    found = prices.sketch_quantiles(stored)
    amounts = prices.valid_prices(rows)
    exact = prices.exact_quantiles(amounts).first()
    row = found.first()
    assert [row[c] for c in ("valid_numeric_count", "min", "max")] == [
        exact[c] for c in ("valid_numeric_count", "min", "max")
    ]
    errors = {r["quantile"]: r["rank_error"] for r in prices.quantile_rank_errors(amounts, found).collect()}
    assert set(errors) == set(prices.QUARTILES) and max(errors.values()) <= 0.01
    assert errors["min"] == errors["max"] == 0.0


def test_rank_errors_are_exact(spark):
    amounts = frame(spark, [1, 2, 3, 4, 5, 6, 7, 8, 9, 10])
    wrong = spark.createDataFrame([(1.0, 1.0, 5.0, 9.5, 11.0)], "min double, q1 double, median double, q3 double, max double")
    errors = {r["quantile"]: round(r["rank_error"], 9) for r in prices.quantile_rank_errors(amounts, wrong).collect()}
    assert errors == {"min": 0.0, "q1": 0.15, "median": 0.0, "q3": 0.15, "max": 0.0}


def test_sketches_without_prices(spark):
    nothing = prices.price_sketches(sketch_rows(spark, 0), "source_file")
    found = prices.price_summary(frame(spark, []), prices.sketch_quantiles(nothing)).first()
    assert (found["valid_numeric_count"], found["iqr_outlier_candidate_count"]) == (0, 0)
    assert found["median"] is None and found["max"] is None


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(-500, 2000).map(lambda n: n / 4), min_size=1, max_size=60))
def test_exact_quantiles_are_order_statistics(spark, values):
    found = prices.exact_quantiles(frame(spark, values), bins=5).first()
    ordered = sorted(values)
    for name, p in prices.QUARTILES.items():
        assert found[name] == ordered[max(math.ceil(p * len(ordered)), 1) - 1]


def test_a_price_with_a_third_of_all_rows(spark):
    amounts = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 5.0D ELSE CAST(id AS DOUBLE) END AS amount"
    )
    found = prices.exact_quantiles(amounts).first()
    assert found["q1"] == 5.0
    assert found["valid_numeric_count"] == 30_000
    assert found["max"] == 29_999.0
