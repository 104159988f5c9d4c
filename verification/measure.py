"""Times of this library's plans beside plain SQL on the same rows.

``python -m verification.measure <table folder> <copies> [folder for scratch tables]`` takes the
raw rows of the folder ``copies`` times, each copy under other users and products, and prints
seconds of the second and third run of each, in turns. The statements say what the results are, in
one way that SQL has for it, and leave the rest to Spark.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators import funnel, parse, quality, sessions, silver
from clickloom.schema import BRONZE_COLUMNS, RAW_COLUMNS
from verification.clicks import clicks_raw

MINUTES = 240


def many_rows(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    rows = clicks_raw(spark, sf_dir).crossJoin(spark.range(copies).withColumnRenamed("id", "copy"))
    again = F.concat(F.lit("-"), F.col("copy"))
    return rows.withColumns(
        {
            "user_session": F.when(F.col("user_session") == "", "").otherwise(
                F.concat("user_session", again)
            ),
            "user_id": F.concat("user_id", F.col("copy").cast("string")),
        }
    ).select(*BRONZE_COLUMNS)


# The definitions of the results as plain statements, over views of the same rows.
PLAIN_SILVER = f"""
SELECT ts, kind, product, category, amount, user, user_session, min(source_file) AS source_file
FROM valid_rows
GROUP BY {", ".join(RAW_COLUMNS)}, ts, kind, product, category, amount, user"""

PLAIN_FUNNEL = """
WITH viewed AS (
  SELECT user_session, min(event_time) AS view_time FROM funnel_events
  WHERE event_type = 'view' GROUP BY user_session),
carted AS (
  SELECT v.user_session, v.view_time, min(e.event_time) AS cart_time
  FROM viewed v LEFT JOIN funnel_events e ON e.user_session = v.user_session
    AND e.event_type = 'cart' AND e.event_time >= v.view_time
  GROUP BY v.user_session, v.view_time)
SELECT c.user_session, c.view_time, c.cart_time, min(e.event_time) AS purchase_time
FROM carted c LEFT JOIN funnel_events e ON e.user_session = c.user_session
  AND e.event_type = 'purchase' AND e.event_time >= c.cart_time
GROUP BY c.user_session, c.view_time, c.cart_time"""

PLAIN_EXAMPLES = """
SELECT e.user_session, any_value(e.session_start) AS session_start,
  any_value(e.first_purchase_time) AS first_purchase_time,
  count_if(s.event_type = 'view') AS views, count_if(s.event_type = 'cart') AS carts,
  count_if(s.event_type = 'remove_from_cart') AS removals,
  count(DISTINCT CASE WHEN s.event_type = 'view' THEN s.product_id END) AS products,
  count(DISTINCT CASE WHEN s.event_type = 'view' THEN s.category_code END) AS categories,
  avg(CASE WHEN s.event_type = 'view' AND s.price_quality = 'positive' THEN s.price END)
    AS view_price
FROM eligible e LEFT JOIN silver s ON s.user_session = e.user_session
  AND s.event_type <> 'purchase' AND s.event_time < e.cutoff_time
GROUP BY e.user_session"""


def seconds(frame: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    frame().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 1)


def main() -> None:
    sf_dir, copies = sys.argv[1], int(sys.argv[2])
    folder = sys.argv[3] if len(sys.argv) > 3 else "/tmp/clickloom-measure"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    many_rows(spark, sf_dir, copies).write.mode("overwrite").parquet(f"{folder}/bronze")
    bronze = spark.read.parquet(f"{folder}/bronze")
    silver.silver_events(bronze).write.mode("overwrite").parquet(f"{folder}/silver")
    events = spark.read.parquet(f"{folder}/silver")
    edges = quality.quality(parse.parse_events(bronze), measures=quality.period_measures())
    first, last = (F.lit(edge) for edge in edges.first())
    in_sessions = parse.session_events(events)
    views = {
        "valid_rows": parse.parse_events(bronze).where(silver.is_valid()),
        "funnel_events": in_sessions,
        "silver": events,
        "eligible": sessions.session_eligibility(events, first, last, MINUTES),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    steps = {
        "Silver": (lambda: silver.silver_events(bronze), lambda: spark.sql(PLAIN_SILVER)),
        "Session funnel": (
            lambda: funnel.funnel_sessions(in_sessions),
            lambda: spark.sql(PLAIN_FUNNEL),
        ),
        f"Session examples, {MINUTES}-minute cutoff": (
            lambda: sessions.session_examples(events, first, last, MINUTES),
            lambda: sessions.with_features(spark.sql(PLAIN_EXAMPLES)),
        ),
    }
    print(f"| {bronze.count():,} raw rows | This repository | Plain SQL | Rows |\n|---|---|---|---|")
    for name, (own, plain) in steps.items():
        runs = [(seconds(own), seconds(plain)) for _ in range(3)][1:]
        rows = own().count(), plain().count()
        mine, theirs = (", ".join(str(run[side]) for run in runs) for side in (0, 1))
        print(f"| {name} | {mine} | {theirs} | {rows[0]:,} / {rows[1]:,} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
