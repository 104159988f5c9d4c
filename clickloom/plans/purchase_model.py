"""Job: train and evaluate a model of which sessions buy after an observation window."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators import scoring
from clickloom.operators.sessions import in_sample, sample_sessions, session_examples
from clickloom.schema import FEATURES
from clickloom.session import use_utc
from clickloom.sources.lake import guard_raw, read_summary, read_table, staged, write_summary

_EVENT_COLUMNS = (
    "user_session",
    "event_time",
    "event_type",
    "product_id",
    "category_code",
    "price",
    "price_quality",
)


def checked_weights(examples: DataFrame, part: str) -> dict:
    """Class counts and weights; an error if a class is missing."""
    weights = scoring.class_weights(examples).first().asDict()
    if not weights["negatives"] or not weights["positives"]:
        raise ValueError(f"{part} examples lack a class: {weights}")
    return weights


def fit_purchase_model(train: DataFrame, weights: dict) -> PipelineModel:
    """Logistic regression in which both classes weigh the same."""
    weighted = train.withColumn(
        "class_weight",
        F.when(F.col("label") == 1.0, weights["positive_weight"]).otherwise(
            weights["negative_weight"]
        ),
    )
    assemble = VectorAssembler(
        inputCols=list(FEATURES), outputCol="features", handleInvalid="error"
    )
    # Iterations, regularisation and threshold of the model.
    regression = LogisticRegression(
        maxIter=40,
        regParam=REGULARIZATION,
        elasticNetParam=0.0,
        threshold=0.5,
        featuresCol="features",
        labelCol="label",
        weightCol="class_weight",
    )
    return Pipeline(stages=[assemble, regression]).fit(weighted)


REGULARIZATION = 0.05  # fixed value of the model


def save_model(model: PipelineModel, path: str) -> None:
    """The whole fitted pipeline, features in their order included."""
    guard_raw(path)
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def linear_terms(model: PipelineModel) -> tuple[dict[str, float], float]:
    """Coefficients by the feature that the pipeline's own assembler feeds them, and intercept."""
    assemble, regression = model.stages
    values = regression.coefficients.toArray().tolist()
    return dict(zip(assemble.getInputCols(), values, strict=True)), float(regression.intercept)


def fit_certificate(train: DataFrame, model: PipelineModel, weights: dict) -> DataFrame:
    """Slopes of the loss at the model's coefficients, see :func:`scoring.loss_gradient`."""
    terms, intercept = linear_terms(model)
    by_class = {1.0: weights["positive_weight"], 0.0: weights["negative_weight"]}
    return scoring.loss_gradient(train, terms, intercept, by_class, REGULARIZATION)


def score(model: PipelineModel, examples: DataFrame) -> DataFrame:
    return model.transform(examples).select(
        "label",
        "prediction",
        "rawPrediction",
        vector_to_array("probability")[1].alias("probability"),
    )


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    terms, _ = linear_terms(model)
    return spark.createDataFrame(list(terms.items()), "feature string, coefficient double")


def evaluate(scored: DataFrame) -> dict[str, DataFrame | float]:
    """Counts by score bin, and the exact areas under the ROC and precision-recall curves."""
    areas = {
        name: BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(scored)
        for name, metric in (("roc_auc", "areaUnderROC"), ("pr_auc", "areaUnderPR"))
    }
    return {"counts": scoring.score_counts(scored), **areas}


def train_and_evaluate_months(
    examples: DataFrame, train_month: str, test_month: str, sample_percent: int = 100
) -> tuple[PipelineModel, dict]:
    """Fit on a sample of one month's sessions, test on all of another's; the result holds only
    bounded numbers."""
    spark = examples.sparkSession
    train = examples.where(F.col("event_month") == train_month)
    if sample_percent < 100:
        train = train.where(in_sample(sample_percent))
    test = examples.where(F.col("event_month") == test_month)
    weights = checked_weights(train, "train")
    test_counts = checked_weights(test, "test")

    model = fit_purchase_model(train, weights)
    measured = evaluate(score(model, test))
    # At most 40 rows: score bin, label, prediction.
    counts = spark.createDataFrame(
        measured["counts"].collect(), measured["counts"].schema
    )
    matrix = scoring.confusion(counts)
    bins = scoring.score_bins(counts).orderBy("score_bin", "actual_label")
    result = {
        "temporal_split": {
            "train_month": train_month,
            "test_month": test_month,
            "train_class_counts": {"0": weights["negatives"], "1": weights["positives"]},
            "test_class_counts": {"0": test_counts["negatives"], "1": test_counts["positives"]},
        },
        "class_weights": {"0": weights["negative_weight"], "1": weights["positive_weight"]},
        "decision_threshold": 0.5,
        "metrics": {
            **scoring.score_rates(matrix).first().asDict(),
            "roc_auc": measured["roc_auc"],
            "pr_auc": measured["pr_auc"],
            "confusion_matrix": matrix.first().asDict(),
        },
        "score_deciles": [
            {
                "decile": row["score_bin"],
                "actual_label": row["actual_label"],
                "session_count": row["sessions"],
            }
            for row in bins.collect()
        ],
        "feature_coefficients": [row.asDict() for row in coefficients(spark, model).collect()],
    }
    return model, result


def train_purchase_model(
    spark: SparkSession,
    silver_path: str,
    profile_summary_path: str,
    model_path: str,
    metrics_path: str,
    sample_percent: int = 2,
    cutoff_minutes: int = 5,
    train_month: str = "2019-10",
    test_month: str = "2019-11",
) -> dict:
    """Build examples of all sessions in Silver, train on a sample of them, evaluate on all of the
    test month, save model and metrics."""
    use_utc(spark)
    guard_raw(model_path, metrics_path)
    period = read_summary(spark, profile_summary_path)["combined"]["period_utc"]
    first, last = (F.to_timestamp(F.lit(period[edge])) for edge in ("min", "max"))

    events = read_table(spark, silver_path).select(*_EVENT_COLUMNS)
    built = session_examples(events, first, last, cutoff_minutes)
    with staged(built, "examples") as examples:
        model, result = train_and_evaluate_months(
            examples, train_month, test_month, sample_percent
        )
        save_model(model, model_path)
        document = {
            "generated_at_utc": datetime.now(timezone.utc).isoformat(),
            "engine": {"name": "Spark MLlib", "spark_version": spark.version},
            "model": "weighted logistic regression",
            "model_path": model_path,
            "target_definition": (
                f"purchase at or after session start + {cutoff_minutes} minutes; sessions "
                "with an earlier purchase are left out"
            ),
            "features_definition": (
                f"events other than purchases in the first {cutoff_minutes} minutes"
            ),
            "sampling": {
                "deterministic_session_hash_percent": sample_percent,
                "sampled_event_rows": sample_sessions(events, sample_percent).count(),
                "eligible_session_examples": examples.where(in_sample(sample_percent)).count(),
                "evaluated_on": "all eligible sessions of the test month",
            },
            **result,
        }
    write_summary(spark, document, metrics_path)
    return document
