"""Every query by name: a function of the session and the table folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from clickloom.functions import is_finite
from clickloom.operators import (
    duplicates,
    frequency,
    funnel,
    gold,
    parse,
    prices,
    purchases,
    quality,
    reports,
    scoring,
    serving,
    sessions,
    silver,
)
from clickloom.plans import medallion, profile, purchase_model
from clickloom.schema import CORRUPT, GOLD_TABLES, RAW_COLUMNS
from clickloom.session import shared_folder, use_utc
from clickloom.sources.events_csv import check_inputs, input_files, read_events, staged_events
from clickloom.sources.lake import (
    read_summary,
    read_table,
    rewrite_months,
    staged,
    write_silver,
    write_table,
)
from verification.clicks import clicks_raw

Query = Callable[[SparkSession, str], DataFrame]

# The tables span January to March 2024 with long gaps between a user's events.
CUTOFF_MINUTES = 240
TRAIN_MONTH, TEST_MONTH = "2024-01", "2024-02"
PICKED = serving.Slice(
    months=("2024-01", "2024-02"), start=date(2024, 1, 10), end=date(2024, 2, 20)
)
PICKED_CATEGORY = serving.Slice(months=("2024-02",), category="economy.red.widget")
# A model with given coefficients, so that scores can be checked in SQL.
COEFFICIENTS = {
    "log_views_5m": 0.8,
    "log_carts_5m": 0.6,
    "log_removals_5m": -0.4,
    "mean_view_price_5m": 0.01,
    "hour_sin": 0.5,
    "weekday_cos": -0.3,
}
INTERCEPT = -0.7

_REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    _REGISTRY[build.__name__] = build
    return build


def _tidy(frame: DataFrame) -> DataFrame:
    """Times without zone, as the reference SQL has them."""
    return frame.select(
        *[
            F.col(f.name).cast("timestamp_ntz") if isinstance(f.dataType, TimestampType) else f.name
            for f in frame.schema
        ]
    )


def queries() -> dict[str, Query]:
    def run(build: Query) -> Query:
        return lambda spark, sf_dir: _tidy(build(use_utc(spark), sf_dir))

    return {name: run(build) for name, build in _REGISTRY.items()}


def _rounded(frame: DataFrame, places: int, *columns: str) -> DataFrame:
    # Adding zero turns a negative zero into a plain one.
    return frame.withColumns({name: F.round(name, places) + F.lit(0.0) for name in columns})


# --- inputs ----------------------------------------------------------------
def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_events(clicks_raw(spark, sf))


def silver_table(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver_events(clicks_raw(spark, sf))


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.events_per_hour(parsed(spark, sf))


def profile_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.funnel_sessions(parse.profile_session_events(parsed(spark, sf)))


def profile_funnel_grid(spark: SparkSession, sf: str) -> DataFrame:
    return funnel.funnel_by_utc_weekday_hour(profile_funnel(spark, sf))


def gold_lazy(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return gold.gold_metrics(silver_table(spark, sf))


def written_silver(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Silver in the shared folder, for queries that read it more than once."""
    narrow = silver_table(spark, sf).select(*(columns or "*"))
    path = shared_folder(spark, "silver")
    narrow.write.parquet(path)
    return spark.read.schema(narrow.schema).parquet(path)


def examples(spark: SparkSession, sf: str) -> DataFrame:
    events = written_silver(
        spark, sf, "user_session", "event_time", "event_type", "product_id", "category_code",
        "price", "price_quality",
    )
    first, last = period_edges(spark, sf)
    return sessions.session_examples(events, first, last, CUTOFF_MINUTES)


def period_edges(spark: SparkSession, sf: str):
    edges = measured(spark, sf, quality.period_measures())
    return edges.select("period_min").scalar(), edges.select("period_max").scalar()


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.linear_score(examples(spark, sf), COEFFICIENTS, INTERCEPT)


# --- parsing and quality ---------------------------------------------------
@query
def parsed_events(spark, sf):
    return parsed(spark, sf)


def measured(spark, sf, measures) -> DataFrame:
    return quality.quality(parsed(spark, sf), measures=measures)


@query
def quality_missing(spark, sf):
    return measured(spark, sf, quality.missing_measures())


@query
def quality_whitespace(spark, sf):
    return measured(spark, sf, quality.whitespace_measures())


@query
def quality_validity(spark, sf):
    return _rounded(measured(spark, sf, quality.validity_measures()), 2, "purchase_price_sum")


@query
def quality_nonpositive(spark, sf):
    return measured(spark, sf, quality.nonpositive_measures())


@query
def session_coverage(spark, sf):
    return quality.session_coverage(measured(spark, sf, quality.session_measures()))


@query
def period(spark, sf):
    return measured(spark, sf, quality.period_measures())


@query
def quality_combined_from_files(spark, sf):
    per_file = quality.quality(parsed(spark, sf), "source_file")
    return _rounded(quality.combine_quality(per_file), 2, "purchase_price_sum")


@query
def event_counts(spark, sf):
    return quality.event_counts(parsed(spark, sf))


@query
def file_overview(spark, sf):
    return quality.file_overview(parsed(spark, sf))


@query
def file_event_counts(spark, sf):
    return quality.event_counts(parsed(spark, sf), "source_file")


@query
def file_event_matrix(spark, sf):
    return reports.file_event_matrix(parsed(spark, sf))


# --- silver ----------------------------------------------------------------
@query
def silver_audit(spark, sf):
    return quality.silver_audit(parsed(spark, sf))


@query
def silver_events(spark, sf):
    return silver_table(spark, sf)


@query
def rejected_rows(spark, sf):
    return silver.rejected_rows(parsed(spark, sf)).select(*RAW_COLUMNS, CORRUPT, "source_file")


# --- duplicates and prices -------------------------------------------------
@query
def row_fingerprints(spark, sf):
    return (
        clicks_raw(spark, sf)
        .groupBy(duplicates.row_fingerprint(*RAW_COLUMNS, CORRUPT).alias("fingerprint"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


@query
def duplicate_summary(spark, sf):
    return duplicates.duplicate_summary(clicks_raw(spark, sf))


@query
def price_quantiles_exact(spark, sf):
    return prices.exact_quantiles(prices.valid_prices(parsed(spark, sf)))


@query
def price_outliers_exact(spark, sf):
    amounts = prices.valid_prices(parsed(spark, sf))
    summary = prices.exact_price_summary(amounts)
    return _rounded(summary, 6, "iqr_lower_fence", "iqr_upper_fence")


@query
def price_flags(spark, sf):
    """Valid prices with their outlier mark, equal ones counted."""
    amounts = prices.valid_prices(parsed(spark, sf))
    fences = prices.with_fences(prices.exact_quantiles(amounts))
    return prices.flag_outliers(amounts, fences).groupBy("amount", "is_outlier").agg(
        F.count(F.lit(1)).alias("price_rows")
    )


@query
def price_quantiles_approx(spark, sf):
    return prices.approximate_quantiles(prices.valid_prices(parsed(spark, sf)))


# --- frequency -------------------------------------------------------------
@query
def events_per_hour(spark, sf):
    return hourly(spark, sf)


@query
def events_per_hour_of_day(spark, sf):
    return frequency.events_per_hour_of_day(hourly(spark, sf))


@query
def events_per_day(spark, sf):
    return frequency.events_per_day(hourly(spark, sf))


@query
def activity_cube(spark, sf):
    return frequency.activity_cube(parsed(spark, sf))


@query
def frequency_stats(spark, sf):
    return frequency.frequency_stats(hourly(spark, sf))


# --- funnel ----------------------------------------------------------------
@query
def funnel_sessions(spark, sf):
    return profile_funnel(spark, sf)


@query
def silver_funnel_sessions(spark, sf):
    return funnel.funnel_sessions(parse.session_events(silver_table(spark, sf)))


@query
def funnel_totals(spark, sf):
    return funnel.funnel_totals(profile_funnel_grid(spark, sf))


@query
def funnel_by_hour(spark, sf):
    return funnel.funnel_by_hour(profile_funnel_grid(spark, sf))


@query
def funnel_by_weekday(spark, sf):
    return funnel.funnel_by_weekday(profile_funnel_grid(spark, sf))


@query
def funnel_by_month(spark, sf):
    return gold_lazy(spark, sf)["funnel_by_month"]


@query
def funnel_by_utc_weekday_hour(spark, sf):
    return gold_lazy(spark, sf)["funnel_by_utc_weekday_hour"]


# --- purchases -------------------------------------------------------------
@query
def top_purchase_categories(spark, sf):
    top = purchases.top_purchase_categories(parsed(spark, sf))
    return _rounded(top, 2, "estimated_value_sum_price")


@query
def report_top_categories(spark, sf):
    top = reports.top_categories(purchases.top_purchase_categories(parsed(spark, sf)))
    return _rounded(top, 2, "estimated_value_sum_price")


@query
def purchases_by_hour(spark, sf):
    return purchases.purchases_by_hour(purchases.purchases_by_weekday_hour(parsed(spark, sf)))


@query
def purchases_by_weekday(spark, sf):
    return purchases.purchases_by_weekday(purchases.purchases_by_weekday_hour(parsed(spark, sf)))


@query
def purchases_by_category(spark, sf):
    table = gold_lazy(spark, sf)["purchases_by_category"]
    return _rounded(table, 2, "estimated_value_sum_price")


@query
def purchases_by_category_day(spark, sf):
    table = gold_lazy(spark, sf)["purchases_by_category_day"]
    return _rounded(table, 2, "estimated_value_sum_price")


@query
def purchases_by_utc_time(spark, sf):
    table = gold_lazy(spark, sf)["purchases_by_utc_time"]
    return _rounded(table, 2, "estimated_value_sum_price")


# --- session examples and model --------------------------------------------
@query
def session_eligibility(spark, sf):
    first, last = period_edges(spark, sf)
    return sessions.session_eligibility(silver_table(spark, sf), first, last, CUTOFF_MINUTES)


@query
def session_examples(spark, sf):
    return _rounded(examples(spark, sf), 9, *sessions.FEATURES)


@query
def session_sample(spark, sf):
    sample = sessions.sample_sessions(silver_table(spark, sf), 20)
    return sample.groupBy("user_session").agg(F.count(F.lit(1)).alias("events"))


@query
def class_weights(spark, sf):
    train = examples(spark, sf).where(F.col("event_month") == TRAIN_MONTH)
    return scoring.class_weights(train)


@query
def score_confusion(spark, sf):
    return scoring.confusion(scoring.score_counts(scored(spark, sf)))


@query
def score_rates(spark, sf):
    return scoring.score_rates(scoring.confusion(scoring.score_counts(scored(spark, sf))))


@query
def score_bins(spark, sf):
    return scoring.score_bins(scoring.score_counts(scored(spark, sf)))


@query
def score_calibration(spark, sf):
    return scoring.score_calibration(scoring.score_bins(scoring.score_counts(scored(spark, sf))))


@query
def score_areas(spark, sf):
    # Scores that are equal but for the last bits, which engines work out differently, are one.
    same = _rounded(scored(spark, sf), 10, "probability")
    return _rounded(scoring.score_areas(same), 9, "roc_auc", "pr_auc")


@query
def confusion_grid(spark, sf):
    return scoring.confusion_grid(scoring.confusion(scoring.score_counts(scored(spark, sf))))


def _trained(spark, sf):
    with staged(examples(spark, sf), "examples") as built:
        return purchase_model.train_and_evaluate_months(built, TRAIN_MONTH, TEST_MONTH)


@query
def purchase_model_metrics(spark, sf):
    _, result = _trained(spark, sf)
    metrics = {**result["metrics"]}
    row = {**metrics.pop("confusion_matrix"), **metrics}
    return spark.createDataFrame(
        [tuple(row.values())],
        ", ".join(
            f"{name} {'bigint' if isinstance(value, int) else 'double'}"
            for name, value in row.items()
        ),
    )


@query
def purchase_model_coefficients(spark, sf):
    model, _ = _trained(spark, sf)
    return purchase_model.coefficients(spark, model)


STATIONARY = 1e-3  # largest slope of the loss at the fitted model, which is of the order of one
SAMPLE_PERCENT = 50


@query
def model_stationary(spark, sf):
    """Classes that the model is fitted on, slopes of its loss, and whether all are near zero."""
    with staged(examples(spark, sf), "examples") as built:
        train = built.where(F.col("event_month") == TRAIN_MONTH)
        weights = purchase_model.checked_weights(train, "train")
        model = purchase_model.fit_purchase_model(train, weights)
        slopes = purchase_model.fit_certificate(train, model, weights)
        return _kept_table(
            slopes.agg(
                F.count("gradient").alias("terms"),
                (F.max(F.abs("gradient")) < STATIONARY).alias("stationary"),
            ).withColumns(
                {n: F.lit(weights[n]).cast("bigint") for n in ("negatives", "positives")}
            )
        )


@query
def model_round_trip(spark, sf):
    """Sessions of the test month, and how many of them a saved and loaded model scores otherwise
    than the model itself, or than its coefficients in SQL."""
    path = shared_folder(spark, "model")
    with staged(examples(spark, sf), "examples") as built:
        train = built.where(F.col("event_month") == TRAIN_MONTH)
        weights = purchase_model.checked_weights(train, "train")
        model = purchase_model.fit_purchase_model(train, weights)
        purchase_model.save_model(model, path)
        loaded = purchase_model.load_model(path)
        test = built.where(F.col("event_month") == TEST_MONTH)
        scored = loaded.transform(model.transform(test).select(
            *test.columns, F.col("prediction").alias("first"), vector_to_array("probability")[1].alias("p")
        )).select(
            *test.columns, "first", "p",
            F.col("prediction").alias("again"), vector_to_array("probability")[1].alias("q"),
        )
        plain = scoring.linear_score(scored, *purchase_model.linear_terms(loaded))
        return _kept_table(
            plain.agg(
                F.count(F.lit(1)).alias("sessions"),
                F.count_if((F.col("first") != F.col("again")) | (F.col("p") != F.col("q"))).alias(
                    "differ_when_loaded"
                ),
                F.count_if(
                    (F.col("prediction") != F.col("again"))
                    | (F.abs(F.col("probability") - F.col("q")) > 1e-12)
                ).alias("differ_from_coefficients"),
            )
        )


@query
def model_document(spark, sf):
    """The three jobs one after the other, from files to the model's document, and its counts."""
    lake = shared_folder(spark, "lake")
    with named_csv_files(clicks_raw(spark, sf)) as (folder, _):
        profile.profile(spark, [folder], f"{lake}/profile")
        medallion.run_medallion(
            spark, [folder], f"{lake}/silver", f"{lake}/gold", f"{lake}/summary"
        )
    purchase_model.train_purchase_model(
        spark, f"{lake}/silver", f"{lake}/profile/overview", f"{lake}/model", f"{lake}/metrics",
        SAMPLE_PERCENT, CUTOFF_MINUTES, TRAIN_MONTH, TEST_MONTH,
    )
    found = read_summary(spark, f"{lake}/metrics")
    split, sampling = found["temporal_split"], found["sampling"]
    row = {
        "train_negatives": split["train_class_counts"]["0"],
        "train_positives": split["train_class_counts"]["1"],
        "test_negatives": split["test_class_counts"]["0"],
        "test_positives": split["test_class_counts"]["1"],
        "sampled_event_rows": sampling["sampled_event_rows"],
        "sampled_sessions": sampling["eligible_session_examples"],
        "judged_sessions": sum(found["metrics"]["confusion_matrix"].values()),
        "binned_sessions": sum(row["session_count"] for row in found["score_deciles"]),
        "coefficients": len(found["feature_coefficients"]),
    }
    return spark.createDataFrame(
        [tuple(row.values())], ", ".join(f"{name} bigint" for name in row)
    )


# --- serving ---------------------------------------------------------------
_GOLD: dict[tuple[str, str], str] = {}


def stored_gold(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Gold as the medallion job leaves it, written once for each application and table folder; a
    slice reads the stored tables only."""
    key = spark.sparkContext.applicationId, sf
    if key not in _GOLD:
        path = shared_folder(spark, "gold")
        medallion.write_gold(written_silver(spark, sf), path)
        _GOLD[key] = path
    return medallion.read_gold(spark, _GOLD[key])


@query
def filter_domains(spark, sf):
    return serving.filter_domains(stored_gold(spark, sf))


@query
def slice_kpis(spark, sf):
    return _rounded(serving.slice_kpis(stored_gold(spark, sf), PICKED), 2, "estimated_value")


@query
def slice_category_kpis(spark, sf):
    kpis = serving.slice_kpis(stored_gold(spark, sf), PICKED_CATEGORY)
    return _rounded(kpis, 2, "estimated_value")


@query
def funnel_stages(spark, sf):
    return serving.funnel_stages(stored_gold(spark, sf)["funnel_by_month"], PICKED)


@query
def slice_purchases_by_date(spark, sf):
    by_day = stored_gold(spark, sf)["purchases_by_category_day"]
    return serving.slice_purchases_by_date(by_day, PICKED)


@query
def slice_top_categories(spark, sf):
    by_day = stored_gold(spark, sf)["purchases_by_category_day"]
    return _rounded(
        serving.slice_top_categories(by_day, PICKED), 2, "estimated_value_sum_price"
    )


@query
def conversion_grid(spark, sf):
    table = stored_gold(spark, sf)["funnel_by_utc_weekday_hour"]
    return serving.conversion_grid(spark, table, PICKED)


@query
def slice_purchases_by_hour(spark, sf):
    table = stored_gold(spark, sf)["purchases_by_utc_time"]
    return serving.slice_purchases_by_hour(spark, table, PICKED)


@query
def five_v_report(spark, sf):
    rows = parsed(spark, sf)
    report = reports.five_v_report(
        measured(spark, sf, {**quality.session_measures(), **quality.missing_measures()}),
        frequency.frequency_stats(frequency.events_per_hour(rows)),
        duplicates.duplicate_summary(clicks_raw(spark, sf)),
        funnel.funnel_totals(profile_funnel_grid(spark, sf)),
    )
    return _rounded(report, 9, "value")


# --- the path through files ------------------------------------------------
@contextmanager
def csv_files(rows: DataFrame) -> Iterator[str]:
    """A folder of event files with bronze rows; what bronze marks corrupt gets an unclosed
    quote. At the end the files are overwritten by an empty one."""
    category = F.col("category_code")
    broken = F.when(F.col(CORRUPT).isNotNull(), F.concat(F.lit('"'), category)).otherwise(category)
    lines = rows.withColumn("category_code", broken).select(*RAW_COLUMNS)
    folder = shared_folder(rows.sparkSession, "csv")

    def write(part: DataFrame) -> None:
        (
            part.write.mode("overwrite")
            .option("header", True)
            .option("quote", "")
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(folder)
        )

    write(lines)
    try:
        yield folder
    finally:
        write(lines.limit(0))


@query
def csv_corrupt_scan(spark, sf):
    with csv_files(clicks_raw(spark, sf)) as folder:
        scanned = parse.parse_events(read_events(spark, [folder]))
        counts = scanned.groupBy(F.col("kind").alias("event_type")).agg(
            F.count(F.lit(1)).alias("record_count"),
            F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt_records"),
        )
        return write_table(counts, shared_folder(spark, "counts"))


# The two files of the adapter by names that paths and listings write otherwise.
FILE_NAMES = {"part-a.csv": "part a+1.csv", "part-b.csv": "part 50%.csv"}


@contextmanager
def named_csv_files(rows: DataFrame, times: int = 1) -> Iterator[tuple[str, ...]]:
    """So many folders, each of two event files with the names above, and the path of an empty file
    beside the first. At the end the files are overwritten by empty ones.

    A file of one name has one writer. What makes the rows is done before, by many tasks, and the
    writer only passes stored rows on."""
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    folders = [shared_folder(spark, "named") for _ in range(times)]
    files = path(folders[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    with staged(rows, "rows") as made:
        for folder in folders:
            files.mkdirs(path(folder))
            for source, name in FILE_NAMES.items():
                part = made.where(F.col("source_file") == source).coalesce(1)
                with csv_files(part) as written:
                    found = [f.getPath() for f in files.listStatus(path(written))]
                    files.rename(
                        *(f for f in found if f.getName().startswith("part-")), path(folder, name)
                    )
    nothing = path(f"{folders[0]}-empty", "none.csv")
    files.create(nothing).close()
    try:
        yield *folders, nothing.toString()
    finally:
        for folder in folders:
            for name in FILE_NAMES.values():
                files.create(path(folder, name), True).close()


def _kept_table(table: DataFrame) -> DataFrame:
    """A small result, written before the files it was read from are emptied."""
    return write_table(table, shared_folder(table.sparkSession, "result"))


@query
def file_sizes(spark, sf):
    with named_csv_files(clicks_raw(spark, sf)) as (folder, _):
        check_inputs(spark, [folder])
        return _kept_table(input_files(spark, [folder]))


def _refused(spark: SparkSession, *paths: str) -> bool:
    try:
        check_inputs(spark, paths)
    except ValueError:
        return True
    return False


@query
def source_names(spark, sf):
    """Rows by the file they come from, and whether an empty file beside them, and a file given
    with another of its name, are refused."""
    with named_csv_files(clicks_raw(spark, sf), 2) as (folder, again, empty):
        cases = {
            "accepted": not _refused(spark, folder),
            "empty_refused": _refused(spark, folder, empty),
            "equal_names_refused": _refused(spark, folder, again),
            "nothing_refused": _refused(spark),
        }
        rows = read_events(spark, [folder]).groupBy("source_file").agg(
            F.count(F.lit(1)).alias("record_count")
        )
        return _kept_table(rows.withColumns({name: F.lit(is_so) for name, is_so in cases.items()}))


@query
def file_inventory(spark, sf):
    """Rows, bytes and events of all types by file; the map of types as JSON in order of type."""
    with named_csv_files(clicks_raw(spark, sf)) as (folder, _):
        rows = parse.parse_events(read_events(spark, [folder]))
        inventory = reports.file_inventory(
            quality.quality(rows, "source_file", measures=reports.inventory_measures()),
            quality.event_counts(rows, "source_file"),
            input_files(spark, [folder]),
        )
        return _kept_table(inventory.withColumn("events_by_type", F.to_json("events_by_type")))


@query
def column_catalogue(spark, sf):
    """The columns of the raw rows, with how many rows have each."""
    rows = clicks_raw(spark, sf)
    filled = rows.select(*(F.trim(name).alias(name) for name in RAW_COLUMNS)).agg(
        *(F.count(F.nullif(name, F.lit(""))).alias(name) for name in RAW_COLUMNS)
    )
    return parse.column_catalogue(spark).join(
        filled.unpivot([], list(RAW_COLUMNS), "name", "filled_rows"), "name"
    )


@query
def price_summary_empty(spark, sf):
    """The price summary of rows that have no valid price, exact and from sketches."""
    rows = parsed(spark, sf).where(~is_finite(F.col("amount")))
    amounts = prices.valid_prices(rows)
    sketched = prices.sketch_quantiles(prices.price_sketches(rows, "source_file"))
    exact = prices.exact_price_summary(amounts).withColumn("form", F.lit("exact"))
    near = prices.price_summary(amounts, sketched).withColumn("form", F.lit("sketch"))
    return exact.unionByName(near)


@query
def quantile_rank_errors(spark, sf):
    """Whether quartiles from stored sketches of each file are within one percent by rank."""
    rows = parsed(spark, sf)
    sketches = write_table(
        prices.price_sketches(rows, "source_file"), shared_folder(spark, "sketches")
    )
    errors = prices.quantile_rank_errors(
        prices.valid_prices(rows), prices.sketch_quantiles(sketches)
    )
    return errors.select(
        "quantile", "p", "price_rows", (F.col("rank_error") <= 0.01).alias("within_one_percent")
    )


AUDIT_COUNTS = ("corrupt_rows", "invalid_timestamp_rows", "unexpected_event_type_rows",
    "invalid_price_rows", "nonpositive_price_rows", "missing_category_code_rows", "missing_brand_rows",
    "missing_user_session_rows", "invalid_product_id_rows", "invalid_category_id_rows",
    "invalid_user_id_rows")
AUDIT_TOTALS = ("source_rows", "valid_rows_before_dedup", "rejected_rows", "silver_rows",
    "duplicate_excess_rows_removed")


@query
def medallion_audit(spark, sf):
    """All numbers of the audit document, read back from its JSON: totals, quality counts, files and
    bytes, and rows of each Gold table."""
    lake = shared_folder(spark, "lake")
    with named_csv_files(clicks_raw(spark, sf)) as (folder, _):
        medallion.run_medallion(
            spark, [folder], f"{lake}/silver", f"{lake}/gold", f"{lake}/summary"
        )

    def counts(names) -> str:
        return ", ".join(f"{name}: bigint" for name in names)

    schema = (
        f"struct<{counts(AUDIT_TOTALS)}, quality_counts: struct<{counts(AUDIT_COUNTS)}>, "
        "bronze: struct<input_files: bigint, input_bytes: bigint>, "
        f"gold: struct<row_counts: struct<{counts(GOLD_TABLES)}>>>"
    )
    written = spark.read.text(f"{lake}/summary", wholetext=True)
    return written.select(F.from_json("value", schema).alias("audit")).select(
        *(f"audit.{name}" for name in AUDIT_TOTALS),
        "audit.quality_counts.*", "audit.bronze.*", "audit.gold.row_counts.*",
    )


@query
def silver_month_rerun(spark, sf):
    """Silver after one month was written again, from one of the two files: rows by month, and
    whether a month's files are still those of the first write."""
    path = shared_folder(spark, "silver")

    def files() -> DataFrame:
        table = read_table(spark, path)
        return table.groupBy("event_month").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.array_sort(F.collect_set("_metadata.file_path")).alias("files"),
        )

    write_silver(silver_table(spark, sf), path)
    before = _kept_table(files())
    some = clicks_raw(spark, sf).where(F.col("source_file") == "part-a.csv")
    rewrite_months(silver.silver_events(some), path, [TEST_MONTH])
    old = before.select("event_month", F.col("files").alias("old_files"))
    return (
        files()
        .join(old, "event_month", "full")
        .select("event_month", "row_count", (F.col("files") == F.col("old_files")).alias("same_files"))
    )


@query
def profile_overview(spark, sf):
    """Numbers of the profile job's document, read back from its JSON."""
    output = shared_folder(spark, "profile")
    with named_csv_files(clicks_raw(spark, sf)) as (folder, _):
        profile.profile(spark, [folder], output)
    found = read_summary(spark, f"{output}/overview")["combined"]
    price, stages, often = found["price"], found["funnel"], found["frequency"]
    row = {
        "file_bytes": found["file_bytes"],
        "record_count": found["record_count"],
        "corrupt_records": found["corrupt_record_count"],
        "invalid_timestamps": found["invalid_timestamp_count"],
        "unexpected_events": found["unexpected_event_count"],
        **{f"missing_{name}": n for name, n in found["null_counts"].items()},
        **{f"whitespace_{name}": n for name, n in found["whitespace_inconsistency_counts"].items()},
        **{f"invalid_{name}": n for name, n in found["invalid_numeric_counts"].items()},
        **{f"nonpositive_{name}": n for name, n in found["nonpositive_id_counts"].items()},
        "rows_with_session": found["session_row_coverage"]["rows_with_nonblank_user_session"],
        "duplicate_groups": found["duplicate_groups"],
        "duplicate_excess_rows": found["duplicate_excess_rows"],
        "valid_price_count": price["valid_numeric_count"],
        "observed_utc_hours": often["observed_utc_hours"],
        "hours_of_day": len(often["by_hour_of_day_utc"]),
        **{name: stages[name] for name in funnel.STAGES},
        "purchase_events": found["purchases"]["purchase_event_count"],
    }
    numbers = spark.createDataFrame(
        [tuple(row.values())], ", ".join(f"{name} bigint" for name in row)
    )
    return numbers.withColumns(
        {
            "period_min": F.lit(found["period_utc"]["min"]),
            "period_max": F.lit(found["period_utc"]["max"]),
            "least_price": F.lit(price["min"]),
            "greatest_price": F.lit(price["max"]),
            "top_category": F.lit(found["purchases"]["top_categories"][0]["category_code"]),
        }
    )


@query
def header_contract(spark, sf):
    """Whether files of all rows are accepted with the right header, and with one file's header
    in upper case, with two names swapped, and with a name missing."""
    swapped = [*RAW_COLUMNS[:4], RAW_COLUMNS[5], RAW_COLUMNS[4], *RAW_COLUMNS[6:]]
    cases = {
        "exact": RAW_COLUMNS,
        "upper case": [name.upper() for name in RAW_COLUMNS],
        "swapped": swapped,
        "missing": RAW_COLUMNS[:-1],
    }
    found = []
    # The rows are made once for all files.
    with staged(clicks_raw(spark, sf).select(*RAW_COLUMNS), "lines") as lines:
        total = lines.count()
        for name, header in cases.items():
            folder = shared_folder(spark, "header")
            for part, columns in (("a", RAW_COLUMNS), ("b", header)):
                half = lines.where(F.pmod(F.xxhash64("event_time"), F.lit(2)) == int(part == "b"))
                half.toDF(*[f"c{i}" for i in range(9)]).select(
                    *[F.col(f"c{i}").alias(column) for i, column in enumerate(columns)]
                ).write.option("header", True).csv(f"{folder}/{part}")
            accepted = True
            try:
                with staged_events(spark, [f"{folder}/a", f"{folder}/b"]) as rows:
                    accepted = rows.count() == total
            except (Py4JJavaError, PySparkException) as refused:
                # The reader's own complaint, which the failed write wraps.
                if "CSV header does not conform to the schema" not in str(refused) and (
                    "Number of column in CSV header" not in str(refused)
                ):
                    raise
                accepted = False
            found.append((name, accepted))
    return spark.createDataFrame(found, "header_case string, accepted boolean")


@query
def medallion_roundtrip(spark, sf):
    """Files to Silver and Gold and back: rows and a measure of each written table."""
    lake = shared_folder(spark, "lake")
    with csv_files(clicks_raw(spark, sf)) as folder:
        medallion.run_medallion(
            spark, [folder], f"{lake}/silver", f"{lake}/gold", f"{lake}/summary"
        )

    def summed(path: str, measure: str) -> DataFrame:
        return spark.read.parquet(f"{lake}/{path}").agg(
            F.lit(path.split("/")[-1]).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.round(F.sum(measure).cast("double"), 2).alias("measure"),
        )

    checks = summed("silver", "price")
    for name in GOLD_TABLES:
        measure = "view_sessions" if name.startswith("funnel") else "estimated_value_sum_price"
        checks = checks.unionByName(summed(f"gold/{name}", measure))
    return checks
