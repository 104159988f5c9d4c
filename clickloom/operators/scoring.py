"""Evaluation of scored examples: ``label, prediction, probability`` of the positive class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions import rate

_CELLS = {
    "true_positive": (1.0, 1.0),
    "false_positive": (0.0, 1.0),
    "true_negative": (0.0, 0.0),
    "false_negative": (1.0, 0.0),
}


def class_weights(examples: DataFrame) -> DataFrame:
    """One row: examples per class, and weights that give both classes the same total."""
    label = F.col("label")
    negatives, positives = F.count_if(label == 0.0), F.count_if(label == 1.0)
    return examples.agg(negatives.alias("negatives"), positives.alias("positives")).select(
        "negatives",
        "positives",
        *[
            rate(F.col("negatives") + F.col("positives"), 2 * F.col(count)).alias(name)
            for name, count in (("negative_weight", "negatives"), ("positive_weight", "positives"))
        ],
    )


def loss_gradient(
    examples: DataFrame,
    coefficients: dict[str, float],
    intercept: float,
    class_weight: dict[float, float],
    regularization: float,
) -> DataFrame:
    """``term, gradient``: the slope of the loss that a weighted, L2-regularised logistic regression
    minimises, at given coefficients; all are near zero at the minimum, and only there, as the loss
    is convex. The term of the intercept is ``(intercept)``.

    The loss is the weighted mean of the log loss plus half the regularisation times the squares of
    the coefficients. As in the regression itself, features count in units of their weighted
    standard deviation, and the intercept is not regularised. A feature that never varies has
    slope zero. One aggregate over the examples, of fixed size; no examples give NULL slopes.
    """
    names = list(coefficients)
    margin: Column = F.lit(intercept)
    for name, coefficient in coefficients.items():
        margin = margin + F.col(name) * F.lit(coefficient)
    weight = F.lit(None).cast("double")
    for label, value in class_weight.items():
        weight = F.when(F.col("label") == label, F.lit(value)).otherwise(weight)
    weighted = examples.select(
        *names,
        weight.alias("w"),
        (weight * (1.0 / (1.0 + F.exp(-margin)) - F.col("label"))).alias("slope"),
    )
    sums = weighted.agg(
        F.sum("w").alias("w"),
        F.sum(F.col("w") * F.col("w")).alias("w2"),
        F.sum("slope").alias("slope"),
        *[
            F.struct(
                F.sum(F.col("w") * F.col(name)).alias("x"),
                F.sum(F.col("w") * F.col(name) * F.col(name)).alias("x2"),
                F.sum(F.col("slope") * F.col(name)).alias("slope"),
            ).alias(name)
            for name in names
        ],
    )

    def slope(name: str) -> Column:
        total, of = F.col("w"), F.col(name)
        spread = (of["x2"] - of["x"] * of["x"] / total) / (total - F.col("w2") / total)
        deviation = F.sqrt(F.greatest(spread, F.lit(0.0)))
        own = of["slope"] / total / deviation + regularization * coefficients[name] * deviation
        return F.when(deviation > 0, own).otherwise(F.when(total > 0, F.lit(0.0)))

    terms = [F.struct(F.lit(name).alias("term"), slope(name).alias("gradient")) for name in names]
    free = F.struct(
        F.lit("(intercept)").alias("term"), (F.col("slope") / F.col("w")).alias("gradient")
    )
    return sums.select(F.inline(F.array(free, *terms)))


def linear_score(examples: DataFrame, coefficients: dict[str, float], intercept: float) -> DataFrame:
    """Score with a logistic function of given coefficients; threshold 0.5."""
    margin: Column = F.lit(intercept)
    for name, coefficient in coefficients.items():
        margin = margin + F.col(name) * coefficient
    probability = 1.0 / (1.0 + F.exp(-margin))
    return examples.withColumn("probability", probability).withColumn(
        "prediction", F.when(F.col("probability") > 0.5, 1.0).otherwise(0.0)
    )


def score_counts(scored: DataFrame) -> DataFrame:
    """Examples by fixed-width score bin (0 to 9), label and prediction: at most 40 rows,
    from which the tables below follow."""
    score_bin = F.least(F.lit(9), F.floor(F.col("probability") * 10)).cast("int")
    return scored.groupBy(score_bin.alias("score_bin"), "label", "prediction").agg(
        F.count(F.lit(1)).alias("sessions")
    )


def confusion(counts: DataFrame) -> DataFrame:
    return counts.agg(
        *[
            F.coalesce(
                F.sum(
                    F.when(
                        (F.col("label") == label) & (F.col("prediction") == predicted),
                        F.col("sessions"),
                    )
                ),
                F.lit(0),
            ).alias(cell)
            for cell, (label, predicted) in _CELLS.items()
        ]
    )


def score_rates(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and accuracy. F1 is 0 where precision or recall is 0 or NULL."""
    tp, fp, tn, fn = (F.col(cell) for cell in _CELLS)
    precision, recall = F.col("precision"), F.col("recall")
    return (
        matrix.select(
            rate(tp, tp + fp).alias("precision"),
            rate(tp, tp + fn).alias("recall"),
            rate(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        )
        .withColumn(
            "f1", F.coalesce(rate(2 * precision * recall, precision + recall), F.lit(0.0))
        )
        .select("precision", "recall", "f1", "accuracy")
    )


def score_bins(counts: DataFrame) -> DataFrame:
    return counts.groupBy("score_bin", F.col("label").cast("int").alias("actual_label")).agg(
        F.sum("sessions").alias("sessions")
    )


def score_calibration(bins: DataFrame) -> DataFrame:
    """Share of positives among the examples of each score bin."""
    positives = F.sum(F.when(F.col("actual_label") == 1, F.col("sessions")).otherwise(0))
    return bins.groupBy("score_bin").agg(
        F.sum("sessions").alias("sessions"),
        rate(positives, F.sum("sessions")).alias("observed_positive_rate"),
    )


def confusion_grid(matrix: DataFrame) -> DataFrame:
    """The confusion matrix as four rows: actual, predicted, sessions."""
    cells = [
        F.struct(
            F.lit(int(label)).alias("actual_label"),
            F.lit(int(predicted)).alias("predicted_label"),
            F.col(cell).alias("sessions"),
        )
        for cell, (label, predicted) in _CELLS.items()
    ]
    return matrix.select(F.inline(F.array(*cells)))


def score_areas(scored: DataFrame, ranges: int = 1000) -> DataFrame:
    """Exact areas under the ROC and the precision-recall curve, in one row; NULL without examples
    of both labels.

    Equal scores are counted first. Running counts from the highest score down are kept within
    ranges of scores, whose totals (at most ``ranges + 1`` rows) say where each begins.
    """
    label, score = F.col("label"), F.col("probability")
    points = (
        scored.groupBy(F.floor(score * ranges).alias("range"), "probability")
        .agg(F.count_if(label == 1.0).alias("pos"), F.count_if(label == 0.0).alias("neg"))
    )
    down, all_rows = Window.orderBy(F.desc("range")), Window.partitionBy(F.lit(0))
    above = points.groupBy("range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        "range",
        (F.sum("p").over(down) - F.col("p")).alias("p_above"),
        (F.sum("n").over(down) - F.col("n")).alias("n_above"),
        F.sum("p").over(all_rows).alias("p_all"),
        F.sum("n").over(all_rows).alias("n_all"),
    )
    inside = Window.partitionBy("range").orderBy(F.desc("probability"))
    running = points.join(above, "range").withColumns(
        {
            "tp": F.col("p_above") + F.sum("pos").over(inside),
            "fp": F.col("n_above") + F.sum("neg").over(inside),
        }
    )
    tp, fp, pos, neg = (F.col(name) for name in ("tp", "fp", "pos", "neg"))
    before = tp - pos + fp - neg
    precision = tp / (tp + fp)
    earlier = F.when(before > 0, (tp - pos) / F.nullif(before, F.lit(0))).otherwise(precision)
    return running.agg(
        F.sum(neg * (tp - pos / 2) / F.nullif(F.col("p_all") * F.col("n_all"), F.lit(0))).alias(
            "roc_auc"
        ),
        F.sum(pos / F.nullif(F.col("p_all"), F.lit(0)) * (precision + earlier) / 2).alias("pr_auc"),
    )
