"""Raw clickstream rows, derived by arithmetic from the ``events`` and ``part`` tables.

Test data only: the tables have no sessions, categories or bad values, so the rules of
FIXTURES.md add them. All rules are plain expressions over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.schema import BRONZE_COLUMNS

_EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
_PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"

_PREPARED = (
    "event_id AS id",
    "user_id",
    "value",
    "ts + make_dt_interval(CAST(31 * (user_id % 2) AS INT)) AS t",
    "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
    """CASE event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'remove_from_cart'
       ELSE event_type END AS kind""",
)

_RULES = {
    "event_time": """CASE WHEN id % 499 = 0 THEN '' WHEN id % 101 = 0 THEN 'not-a-timestamp'
                     ELSE date_format(t, "yyyy-MM-dd HH:mm:ss 'UTC'") END""",
    "event_type": "CASE WHEN id % 67 = 0 THEN concat(' ', kind, ' ') ELSE kind END",
    "product_id": """CASE WHEN id % 211 = 0 THEN '' WHEN id % 223 = 0 THEN 'abc'
                     ELSE CAST(k AS STRING) END""",
    "category_id": "CASE WHEN id % 307 = 0 THEN 'x1' ELSE CAST(p_size AS STRING) END",
    "category_code": """CASE WHEN k % 3 = 0 THEN ''
                        ELSE concat(lower(p_type), '.', replace(p_name, ' ', '.')) END""",
    "brand": """CASE WHEN k % 7 = 0 THEN NULL WHEN id % 71 = 0 THEN concat(' ', p_brand, ' ')
                ELSE p_brand END""",
    "price": """CASE WHEN id % 541 = 0 THEN 'NaN' WHEN id % 113 = 0 THEN ''
                WHEN id % 109 = 0 THEN 'not-a-price' WHEN id % 83 = 0 THEN '-5.00'
                WHEN id % 41 = 0 THEN '0.00'
                ELSE CAST(CAST(value AS DECIMAL(12, 2)) AS STRING) END""",
    "user_id": "CAST(user_id AS STRING)",
    "user_session": """CASE WHEN id % 97 = 0 THEN ''
                       ELSE concat(user_id, '-', CAST(t AS DATE)) END""",
    "_corrupt_record": "CASE WHEN id % 401 = 0 THEN concat('corrupt:', id) END",
    "source_file": "CASE WHEN (id + copy) % 2 = 1 THEN 'part-a.csv' ELSE 'part-b.csv' END",
}


def clicks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows. Every 53rd comes twice, as an exact copy in the other file."""
    events = spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet")
    part = spark.read.schema(_PART).parquet(f"{sf_dir}/part.parquet")
    joined = events.selectExpr(*_PREPARED).join(
        part.withColumnRenamed("p_partkey", "k"), "k", "left"
    )
    copies = joined.selectExpr(
        "*", "explode(CASE WHEN id % 53 = 0 THEN array(1, 2) ELSE array(1) END) AS copy"
    )
    return copies.selectExpr(*[f"{rule} AS {name}" for name, rule in _RULES.items()]).select(
        *BRONZE_COLUMNS
    )
