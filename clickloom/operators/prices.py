"""Price quantiles and outlier fences."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions import is_finite, rate
from clickloom.operators.parse import intact

QUARTILES = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def valid_prices(parsed: DataFrame) -> DataFrame:
    return intact(parsed).where(is_finite(F.col("amount"))).select("amount")


def approximate_quantiles(prices: DataFrame, relative_error: float = 0.01) -> DataFrame:
    """One row of quartiles and the count. The sketches merge, so nothing is shuffled but them."""
    sketch = F.percentile_approx(
        "amount", list(QUARTILES.values()), max(1, round(1 / relative_error))
    )
    return prices.agg(F.count("amount").alias("valid_numeric_count"), sketch.alias("q")).select(
        "valid_numeric_count",
        *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(QUARTILES)],
    )


SKETCH_SIZE = 800  # rank error of about a third of a percent


def price_sketches(parsed: DataFrame, *keys: str) -> DataFrame:
    """Count, least, greatest and a KLL sketch (binary) of the valid prices, per key (as
    ``source_file``). Sketches of new files can be merged with stored ones."""
    amounts = intact(parsed).where(is_finite(F.col("amount")))
    return amounts.groupBy(*keys).agg(
        F.count("amount").alias("price_rows"),
        F.min("amount").alias("min"),
        F.max("amount").alias("max"),
        F.kll_sketch_agg_double("amount", F.lit(SKETCH_SIZE)).alias("sketch"),
    )


def sketch_quantiles(sketches: DataFrame) -> DataFrame:
    """The row of :func:`approximate_quantiles` from stored sketches; the ends are exact. Without
    prices all but the count are NULL."""
    inner = [name for name, p in QUARTILES.items() if 0 < p < 1]
    merged = sketches.agg(
        F.coalesce(F.sum("price_rows"), F.lit(0)).alias("valid_numeric_count"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    some = F.col("valid_numeric_count") > 0
    return merged.select(
        "valid_numeric_count",
        "min",
        *[
            F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(QUARTILES[name]))).alias(name)
            for name in inner
        ],
        "max",
    )


def quantile_rank_errors(prices: DataFrame, quantiles: DataFrame) -> DataFrame:
    """``quantile, p, price_rows, rank_error`` for each value of a row of quantiles: how far ``p``
    lies from the ranks that the value's equals take up, as a share of all prices. Exact counts."""
    row = _as_value(quantiles)
    amount = F.col("amount")
    counts = prices.agg(
        F.count(amount).alias("price_rows"),
        *[F.count_if(amount < row[name]).alias(f"below_{name}") for name in QUARTILES],
        *[F.count_if(amount <= row[name]).alias(f"upto_{name}") for name in QUARTILES],
    )

    def line(name: str, p: float) -> Column:
        low, high = (rate(F.col(f"{side}_{name}"), F.col("price_rows")) for side in ("below", "upto"))
        return F.struct(
            F.lit(name).alias("quantile"),
            F.lit(p).alias("p"),
            F.col("price_rows"),
            F.greatest(low - p, p - high, F.lit(0.0)).alias("rank_error"),
        )

    return counts.select(F.inline(F.array(*[line(*each) for each in QUARTILES.items()])))


def price_counts(prices: DataFrame) -> DataFrame:
    """Distinct prices and how often each comes."""
    return prices.groupBy("amount").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(prices: DataFrame, bins: int | None = None) -> DataFrame:
    """The same row without error: the value at rank ``ceil(p * n)``."""
    return counted_quantiles(price_counts(prices), bins)


def counted_quantiles(counts: DataFrame, bins: int | None = None) -> DataFrame:
    """Exact quantiles from distinct prices and their counts.

    Cut points that lie evenly among the distinct prices split them into as many value ranges as
    the session has shuffle partitions (200 at least), so running counts are kept per range
    instead of over one global sort. The cuts are a value inside the query.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bins = bins or max(200, partitions)
    cuts = counts.agg(
        F.array_distinct(
            F.percentile_approx("amount", [i / bins for i in range(1, bins)], 10 * bins)
        ).alias("cuts")
    ).scalar()
    below = F.filter(
        F.coalesce("cuts", F.array().cast("array<double>")), lambda cut: cut < F.col("amount")
    )
    counts = counts.withColumn("cuts", cuts).select("amount", "n", F.size(below).alias("bin"))
    # At most `bins` rows, whatever the input, and of them those that hold a wanted rank.
    ranks = {
        name: F.greatest(F.ceil(F.lit(p) * F.col("total")), F.lit(1))
        for name, p in QUARTILES.items()
    }
    upto = F.sum("in_bin").over(Window.orderBy("bin"))
    starts = (
        counts.groupBy("bin")
        .agg(F.sum("n").alias("in_bin"))
        .select(
            "bin",
            (upto - F.col("in_bin")).alias("before"),
            upto.alias("upto"),
            F.sum("in_bin").over(Window.partitionBy(F.lit(0))).alias("total"),
        )
        .where(
            reduce(or_, [(F.col("before") < rank) & (rank <= F.col("upto")) for rank in ranks.values()])
        )
        .drop("upto")
    )
    # Prices of other ranges are left out before they are shuffled.
    ranked = counts.join(F.broadcast(starts), "bin").withColumn(
        "last_rank",
        F.col("before") + F.sum("n").over(Window.partitionBy("bin").orderBy("amount")),
    )
    return ranked.agg(
        F.coalesce(F.max("total"), F.lit(0)).alias("valid_numeric_count"),
        *[
            F.min(F.when(F.col("last_rank") >= rank, F.col("amount"))).alias(name)
            for name, rank in ranks.items()
        ],
    )


def with_fences(quantiles: DataFrame) -> DataFrame:
    iqr = F.col("q3") - F.col("q1")
    return quantiles.withColumns(
        {
            "iqr_lower_fence": F.col("q1") - 1.5 * iqr,
            "iqr_upper_fence": F.col("q3") + 1.5 * iqr,
        }
    )


def flag_outliers(prices: DataFrame, fences: DataFrame) -> DataFrame:
    """Mark prices outside the fences; none is removed. ``fences`` has one row."""
    return prices.withColumn("is_outlier", _outside(_as_value(fences)))


def _as_value(one_row: DataFrame) -> Column:
    """A one-row table as a struct value. Several uses in a query are worked out once."""
    return one_row.select(F.struct("*").alias("row")).scalar()


def _outside(fences: Column) -> Column:
    amount = F.col("amount")
    return (amount < fences["iqr_lower_fence"]) | (amount > fences["iqr_upper_fence"])


def exact_price_summary(prices: DataFrame) -> DataFrame:
    """Exact quartiles, fences and outlier count, all from the distinct prices."""
    counts = price_counts(prices)
    fences = with_fences(counted_quantiles(counts))
    row = _as_value(fences)
    outliers = counts.agg(
        F.coalesce(F.sum(F.when(_outside(row), F.col("n"))), F.lit(0)).alias(
            "iqr_outlier_candidate_count"
        )
    )
    return outliers.select(F.inline(F.array(row)), "iqr_outlier_candidate_count")


def price_summary(prices: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Quartiles, fences and outlier count in one row; without prices all but the counts are NULL."""
    fences = with_fences(quantiles)
    row = _as_value(fences)
    outliers = prices.agg(F.count_if(_outside(row)).alias("iqr_outlier_candidate_count"))
    return outliers.select(F.inline(F.array(row)), "iqr_outlier_candidate_count")
