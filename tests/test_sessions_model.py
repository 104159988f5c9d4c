import hashlib
import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.operators import scoring, sessions
from clickloom.plans import purchase_model
from clickloom.schema import FEATURES

SCHEMA = (
    "user_session string, event_time timestamp, event_type string, product_id bigint, "
    "category_code string, price double, price_quality string"
)
FIRST, LAST = "2019-10-01T00:00:00Z", "2019-11-30T23:59:59Z"


def at(day, hour, minute, second=0, month=10):
    return datetime(2019, month, day, hour, minute, second)


def events(spark, *rows):
    """Rows of session, time and type, with product, category and price where they matter."""
    filled = []
    for session, time, kind, *rest in rows:
        product, category, price = [*rest, *(1, "cat.a", 20.0)[len(rest):]]
        quality = "missing" if price is None else "positive" if price > 0 else "nonpositive"
        filled.append((session, time, kind, product, category, price, quality))
    return spark.createDataFrame(filled, SCHEMA)


def examples(frame, minutes=5):
    first, last = (F.to_timestamp(F.lit(edge)) for edge in (FIRST, LAST))
    built = sessions.session_examples(frame, first, last, minutes)
    return {r["user_session"]: r.asDict() for r in built.collect()}


def test_what_counts_before_and_after_the_cutoff(spark):
    """Nine minutes' wait: a basket filled, emptied and bought later; one only looked at, with
    dear and cheap goods; one bought within the wait; and one bought twice, early and late."""
    found = examples(
        events(
            spark,
            ("basket", at(17, 21, 30), "cart", 71, "toys.cube", 8.0),
            ("basket", at(17, 21, 31), "remove_from_cart", 71, "toys.cube", 8.0),
            ("basket", at(17, 21, 33), "cart", 72, "toys.kite", 12.5),
            ("basket", at(17, 21, 38, 59), "view", 72, "toys.kite", 12.5),
            ("basket", at(17, 22, 45), "purchase", 72, "toys.kite", 12.5),
            ("looker", at(18, 9, 0), "view", 80, "toys.train", 300.0),
            ("looker", at(18, 9, 2), "view", 81, "toys.kite", 9.0),
            ("looker", at(18, 9, 9), "view", 82, "toys.cube", 1.0),
            ("hasty", at(19, 5, 0), "view", 80, "toys.train", 300.0),
            ("hasty", at(19, 5, 8), "purchase", 80, "toys.train", 300.0),
            ("twice", at(19, 6, 0), "purchase", 81, "toys.kite", 9.0),
            ("twice", at(19, 7, 0), "purchase", 81, "toys.kite", 9.0),
        ),
        minutes=9,
    )
    assert {name: row["label"] for name, row in found.items()} == {"basket": 1.0, "looker": 0.0}
    basket, looker = found["basket"], found["looker"]
    assert [basket[f"log_{kind}_5m"] for kind in ("views", "carts", "removals")] == pytest.approx(
        [math.log(2), math.log(3), math.log(2)]
    )
    assert basket["mean_view_price_5m"] == pytest.approx(12.5)
    assert looker["log_views_5m"] == looker["log_unique_products_5m"] == pytest.approx(math.log(3))
    assert looker["log_carts_5m"] == 0.0
    assert looker["mean_view_price_5m"] == pytest.approx(154.5)
    assert basket["first_purchase_time"] == at(17, 22, 45)


def test_purchase_at_the_cutoff_is_a_label_and_events_there_no_features(spark):
    found = examples(
        events(
            spark,
            ("s", at(10, 10, 1), "view"),
            ("s", at(10, 10, 5, 59), "view"),
            ("s", at(10, 10, 6), "view"),
            ("s", at(10, 10, 6), "purchase"),
        )
    )
    assert found["s"]["label"] == 1.0
    assert found["s"]["log_views_5m"] == pytest.approx(math.log(3))


def test_counts_of_distinct_products_and_positive_prices(spark):
    found = examples(
        events(
            spark,
            ("s", at(10, 10, 4), "view", 1, "cat.a", 10.0),
            ("s", at(10, 10, 5), "view", 1, "cat.a", 20.0),
            ("s", at(10, 10, 6), "view", 2, None, -5.0),
            ("s", at(10, 10, 7), "view", None, "cat.a", None),
            ("s", at(10, 10, 8), "remove_from_cart", 9, "cat.z", 99.0),
        )
    )["s"]
    assert found["log_views_5m"] == pytest.approx(math.log(5))
    assert found["log_unique_products_5m"] == pytest.approx(math.log(3))
    assert found["log_unique_categories_5m"] == pytest.approx(math.log(2))
    assert found["log_removals_5m"] == pytest.approx(math.log(2))
    assert found["mean_view_price_5m"] == pytest.approx(15.0)


def test_a_session_without_views_gets_zeros(spark):
    found = examples(events(spark, ("s", at(10, 10, 0), "cart", 1, "cat.a", 5.0)))["s"]
    assert found["log_views_5m"] == found["mean_view_price_5m"] == 0.0


def test_sessions_at_the_edges_of_period_and_month_are_left_out(spark):
    found = examples(
        events(
            spark,
            ("at-start", at(1, 0, 4), "view"),
            ("just-in", at(1, 0, 5), "view"),
            ("month-end", at(31, 23, 56), "view"),
            ("month-fits", at(31, 23, 54), "view"),
            ("at-end", at(30, 23, 56, month=11), "view"),
        )
    )
    assert set(found) == {"just-in", "month-fits"}


def test_start_time_on_circles(spark):
    found = examples(events(spark, ("s", at(13, 6, 10), "view")))["s"]  # a Sunday
    assert found["hour_sin"] == pytest.approx(1.0)
    assert found["hour_cos"] == pytest.approx(0.0, abs=1e-12)
    assert (found["weekday_sin"], found["weekday_cos"]) == (0.0, 1.0)


@pytest.mark.parametrize("minutes", [0, -5])
def test_cutoff_has_to_be_positive(spark, minutes):
    with pytest.raises(ValueError):
        examples(events(spark, ("s", at(1, 1, 1), "view")), minutes)


def test_hot_session_is_spread_by_time(spark):
    """One session with a third of the rows, most of them long after its cutoff."""
    base = F.lit(at(10, 0, 0))
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "bot").otherwise(F.col("id").cast("string")).alias("user_session"),
        (base + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("event_time"),
        F.lit("view").alias("event_type"),
        F.col("id").alias("product_id"),
        F.lit("c").alias("category_code"),
        F.lit(1.0).alias("price"),
        F.lit("positive").alias("price_quality"),
    )
    first, last = (F.to_timestamp(F.lit(edge)) for edge in (FIRST, LAST))
    built = sessions.session_examples(rows, first, last, 5)
    bot = built.where("user_session = 'bot'").first()
    assert bot["log_views_5m"] == pytest.approx(math.log(101))
    assert built.count() == 20_001
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_session" in plan and ", slice" in plan


def test_one_hot_slice_is_split_by_adaptive_execution(spark):
    """A third of all rows in the first minutes of one session: the join splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    n = 600_000
    rows = spark.range(0, n, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'bot' ELSE CAST(id % 80000 AS STRING) END AS user_session",
        "timestamp '2019-10-05 10:00:00' + make_dt_interval(0, 0, 0, "
        "CAST(CASE WHEN id % 3 = 0 THEN id % 200 ELSE id END AS DECIMAL(18, 6))) AS event_time",
        "'view' AS event_type",
        "id AS product_id",
        "'c' AS category_code",
        "1.0D AS price",
        "'positive' AS price_quality",
    )
    first, last = (F.to_timestamp(F.lit(edge)) for edge in (FIRST, LAST))
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        built = sessions.session_examples(rows, first, last, 5)
        found = {r["user_session"]: r for r in built.collect()}
        plan = built._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "SortMergeJoin(skew=true)" in plan
    assert found["bot"]["log_views_5m"] == pytest.approx(math.log(1 + n // 3))
    assert found["bot"]["log_unique_products_5m"] == pytest.approx(math.log(1 + n // 3))


def test_sample_takes_whole_sessions(spark):
    rows = spark.range(20_000).selectExpr("concat('s', id % 4000) AS user_session")
    sample = sessions.sample_sessions(rows, 20)
    per_session = sample.groupBy("user_session").count()
    assert {r["count"] for r in per_session.select("count").distinct().collect()} == {5}
    assert 0.17 < per_session.count() / 4000 < 0.23
    assert sessions.sample_sessions(rows, 100).count() == 20_000
    for percent in (0, 101):
        with pytest.raises(ValueError):
            sessions.sample_sessions(rows, percent)


def scored(spark, *rows):
    return spark.createDataFrame(
        [tuple(map(float, row)) for row in rows], "label double, prediction double, probability double"
    )


def test_confusion_rates_bins_and_calibration(spark):
    counts = scoring.score_counts(
        scored(spark, (1, 1, 0.95), (1, 1, 1.0), (0, 1, 0.6), (0, 0, 0.05), (1, 0, 0.0), (0, 0, 0.09))
    )
    matrix = scoring.confusion(counts)
    assert matrix.first().asDict() == {
        "true_positive": 2,
        "false_positive": 1,
        "true_negative": 2,
        "false_negative": 1,
    }
    rates = scoring.score_rates(matrix).first()
    assert rates["precision"] == rates["recall"] == pytest.approx(2 / 3)
    assert rates["f1"] == pytest.approx(2 / 3)
    assert rates["accuracy"] == pytest.approx(4 / 6)
    bins = scoring.score_bins(counts)
    assert {(r["score_bin"], r["actual_label"]): r["sessions"] for r in bins.collect()} == {
        (9, 1): 2,
        (6, 0): 1,
        (0, 0): 2,
        (0, 1): 1,
    }
    calibrated = {r["score_bin"]: r for r in scoring.score_calibration(bins).collect()}
    assert calibrated[0]["observed_positive_rate"] == pytest.approx(1 / 3)
    assert sum(r["sessions"] for r in scoring.confusion_grid(matrix).collect()) == 6


def test_rates_without_denominators(spark):
    none = scoring.score_rates(scoring.confusion(scoring.score_counts(scored(spark, (0, 0, 0.1))))).first()
    assert none["precision"] is None and none["recall"] is None
    assert (none["f1"], none["accuracy"]) == (0.0, 1.0)
    missed = scoring.score_rates(
        scoring.confusion(scoring.score_counts(scored(spark, (1, 0, 0.1), (0, 1, 0.9))))
    ).first()
    assert (missed["precision"], missed["recall"], missed["f1"]) == (0.0, 0.0, 0.0)


def planted(spark, n=2000):
    """Buyers view more: a signal that a linear model has to find."""
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    buys = F.col("id") % 5 == 0
    columns = {name: F.lit(0.0) for name in FEATURES}
    columns["log_views_5m"] = noise + F.when(buys, 0.8).otherwise(0.0)
    columns["mean_view_price_5m"] = noise * 10
    month = F.when(F.col("id") % 2 == 0, "2019-10").otherwise("2019-11")
    return spark.range(n).select(
        month.alias("event_month"),
        F.when(buys, 1.0).otherwise(0.0).alias("label"),
        *[value.alias(name) for name, value in columns.items()],
    )


def test_model_finds_a_planted_signal(spark):
    rows = planted(spark)
    model, result = purchase_model.train_and_evaluate_months(rows, "2019-10", "2019-11")
    metrics = result["metrics"]
    assert metrics["roc_auc"] > 0.95
    assert metrics["pr_auc"] > 0.8
    assert sum(metrics["confusion_matrix"].values()) == 1000
    assert sum(row["session_count"] for row in result["score_deciles"]) == 1000
    weights = {row["feature"]: row["coefficient"] for row in result["feature_coefficients"]}
    assert weights["log_views_5m"] > 1
    assert result["class_weights"] == {"0": 0.625, "1": 2.5}
    _, again = purchase_model.train_and_evaluate_months(rows, "2019-10", "2019-11")
    for area in ("roc_auc", "pr_auc"):  # sums over tasks in any order
        assert again["metrics"].pop(area) == pytest.approx(result["metrics"].pop(area))
    assert again == result


def test_both_classes_are_needed(spark):
    rows = planted(spark, 200)
    with pytest.raises(ValueError, match="test examples"):
        purchase_model.train_and_evaluate_months(rows, "2019-10", "2019-12")
    with pytest.raises(ValueError, match="train examples"):
        purchase_model.train_and_evaluate_months(rows.where("label = 0"), "2019-10", "2019-11")


def test_exact_areas_by_hand(spark):
    """Pairs of a positive and a negative in the right order, ties by half; and a curve of four
    points, each with its precision and recall."""
    rows = scored(
        spark, (1, 1, 0.9), (1, 1, 0.7), (0, 1, 0.7), (1, 0, 0.4), (0, 0, 0.4), (0, 0, 0.4), (0, 0, 0.1)
    )
    found = scoring.score_areas(rows).first()
    assert found["roc_auc"] == pytest.approx((4 + 3.5 + 2) / 12)
    precision = [1, 2 / 3, 3 / 6, 3 / 7]
    steps = [1 / 3 * 1, 1 / 3 * (1 + precision[1]) / 2, 1 / 3 * (precision[1] + precision[2]) / 2]
    assert found["pr_auc"] == pytest.approx(sum(steps))
    assert scoring.score_areas(rows.where("label = 0")).first()["roc_auc"] is None
    assert scoring.score_areas(rows.limit(0)).first()["pr_auc"] is None


def example_rows(spark):
    draw = random.Random(3)
    rows = []
    for _ in range(300):
        values = [draw.random() * 3, 40 + draw.random() * 60, 2.0]
        rows.append((float(values[0] + draw.random() * 2 > 2.4), *values))
    return spark.createDataFrame(rows, "label double, a double, b double, c double"), rows


def loss_by_hand(rows, coefficients, intercept, weights, regularization):
    """In units of the weighted standard deviations; the intercept is free."""
    w = [weights[row[0]] for row in rows]
    total = sum(w)
    value = 0.0
    for row, weight in zip(rows, w):
        margin = intercept + sum(b * x for b, x in zip(coefficients, row[1:]))
        value += weight * (math.log1p(math.exp(-margin)) + (1 - row[0]) * margin)
    value /= total
    for j, coefficient in enumerate(coefficients, 1):
        mean = sum(weight * row[j] for row, weight in zip(rows, w)) / total
        spread = sum(weight * (row[j] - mean) ** 2 for row, weight in zip(rows, w))
        deviation = math.sqrt(spread / (total - sum(x * x for x in w) / total))
        value += regularization / 2 * (coefficient * deviation) ** 2
    return value


def test_gradient_is_the_losss(spark):
    frame, rows = example_rows(spark)
    weights, at = {1.0: 0.8, 0.0: 1.7}, [0.4, -0.02, 0.0]
    found = {r["term"]: r["gradient"] for r in scoring.loss_gradient(
        frame, dict(zip("abc", at)), 0.3, weights, 0.05).collect()}
    total = sum(weights[row[0]] for row in rows)
    for j, name in enumerate("ab"):
        up, down = list(at), list(at)
        up[j] += 1e-6
        down[j] -= 1e-6
        slope = (loss_by_hand(rows, up, 0.3, weights, 0.05) - loss_by_hand(rows, down, 0.3, weights, 0.05)) / 2e-6
        w = [weights[row[0]] for row in rows]
        mean = sum(x * row[j + 1] for row, x in zip(rows, w)) / total
        spread = sum(x * (row[j + 1] - mean) ** 2 for row, x in zip(rows, w))
        deviation = math.sqrt(spread / (total - sum(x * x for x in w) / total))
        assert found[name] == pytest.approx(slope / deviation, rel=1e-4)
    slope = (loss_by_hand(rows, at, 0.3 + 1e-6, weights, 0.05) - loss_by_hand(rows, at, 0.3 - 1e-6, weights, 0.05)) / 2e-6
    assert found["(intercept)"] == pytest.approx(slope, rel=1e-4)
    assert found["c"] == 0.0
    none = scoring.loss_gradient(frame.limit(0), dict(zip("abc", at)), 0.3, weights, 0.05).collect()
    assert [r["gradient"] for r in none] == [None] * 4


def planted_examples(spark):
    draw = random.Random(9)
    rows = []
    for _ in range(400):
        values = [draw.random() for _ in FEATURES]
        rows.append((float(values[0] + 0.3 * draw.random() > 0.6), *values))
    return spark.createDataFrame(rows, "label double, " + ", ".join(f"{f} double" for f in FEATURES))


def test_a_fit_is_stationary_and_a_moved_one_is_not(spark):
    train = planted_examples(spark)
    weights = purchase_model.checked_weights(train, "train")
    model = purchase_model.fit_purchase_model(train, weights)
    slopes = purchase_model.fit_certificate(train, model, weights).collect()
    assert len(slopes) == 11 and max(abs(r["gradient"]) for r in slopes) < 1e-4
    terms, intercept = purchase_model.linear_terms(model)
    moved = {**terms, FEATURES[0]: terms[FEATURES[0]] + 0.5}
    by_class = {1.0: weights["positive_weight"], 0.0: weights["negative_weight"]}
    off = scoring.loss_gradient(train, moved, intercept, by_class, purchase_model.REGULARIZATION)
    assert max(abs(r["gradient"]) for r in off.collect()) > 1e-2


def test_a_loaded_model_scores_alike(spark, tmp_path):
    train = planted_examples(spark)
    weights = purchase_model.checked_weights(train, "train")
    model = purchase_model.fit_purchase_model(train, weights)
    path = str(tmp_path / "model")
    purchase_model.save_model(model, path)
    loaded = purchase_model.load_model(path)
    assert purchase_model.linear_terms(loaded) == purchase_model.linear_terms(model)
    order = lambda m: sorted(tuple(r)[:2] + (r["probability"],) for r in purchase_model.score(m, train).collect())
    assert order(loaded) == order(model)
    with pytest.raises(ValueError, match="raw"):
        purchase_model.save_model(model, str(tmp_path / "raw" / "model"))


def test_sample_is_the_same_in_any_engine(spark):
    ids = [f"s-{n}" for n in range(500)]
    rows = spark.createDataFrame([(i,) for i in ids], "user_session string")
    found = {r[0] for r in sessions.sample_sessions(rows, 20).collect()}
    assert found == {i for i in ids if int(hashlib.md5(i.encode()).hexdigest()[:8], 16) % 100 < 20}
