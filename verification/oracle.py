"""The same results as plain SQL, for DuckDB on the same tables."""

from __future__ import annotations

from clickloom.schema import EVENT_TYPES, RAW_COLUMNS, SEMANTIC_TYPES, WEEKDAY_NAMES_ES
from verification import registry

_TYPES = ", ".join(f"'{name}'" for name in EVENT_TYPES)
_RAW = ", ".join(RAW_COLUMNS)

_CLICKS = """
base AS (
  SELECT e.event_id AS id, e.user_id AS uid, e.value,
         e.ts + to_days(CAST(31 * (e.user_id % 2) AS INTEGER)) AS t,
         CASE e.event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'remove_from_cart'
              ELSE e.event_type END AS et,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k, p.p_name, p.p_brand, p.p_type, p.p_size
  FROM events e
  LEFT JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
),
clicks AS (
  SELECT
    CASE WHEN id % 499 = 0 THEN '' WHEN id % 101 = 0 THEN 'not-a-timestamp'
         ELSE strftime(t, '%Y-%m-%d %H:%M:%S UTC') END AS event_time,
    CASE WHEN id % 67 = 0 THEN ' ' || et || ' ' ELSE et END AS event_type,
    CASE WHEN id % 211 = 0 THEN '' WHEN id % 223 = 0 THEN 'abc'
         ELSE CAST(k AS VARCHAR) END AS product_id,
    CASE WHEN id % 307 = 0 THEN 'x1' ELSE CAST(p_size AS VARCHAR) END AS category_id,
    CASE WHEN k % 3 = 0 THEN '' ELSE lower(p_type) || '.' || replace(p_name, ' ', '.') END
      AS category_code,
    CASE WHEN k % 7 = 0 THEN NULL WHEN id % 71 = 0 THEN ' ' || p_brand || ' '
         ELSE p_brand END AS brand,
    CASE WHEN id % 541 = 0 THEN 'NaN' WHEN id % 113 = 0 THEN ''
         WHEN id % 109 = 0 THEN 'not-a-price' WHEN id % 83 = 0 THEN '-5.00'
         WHEN id % 41 = 0 THEN '0.00'
         ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS price,
    CAST(uid AS VARCHAR) AS user_id,
    CASE WHEN id % 97 = 0 THEN ''
         ELSE CAST(uid AS VARCHAR) || '-' || CAST(CAST(t AS DATE) AS VARCHAR) END AS user_session,
    CASE WHEN id % 401 = 0 THEN 'corrupt:' || CAST(id AS VARCHAR) END AS _corrupt_record,
    CASE WHEN id % 2 = 0 THEN 'part-a.csv' ELSE 'part-b.csv' END AS source_file,
    id
  FROM base
),
raw_rows AS (
  SELECT * EXCLUDE (id) FROM clicks
  UNION ALL
  SELECT * EXCLUDE (id) REPLACE (
    CASE WHEN id % 2 = 0 THEN 'part-b.csv' ELSE 'part-a.csv' END AS source_file)
  FROM clicks WHERE id % 53 = 0
)"""


def _id(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({column}), '[+-]?[0-9]+') "
        f"THEN TRY_CAST(trim({column}) AS BIGINT) END"
    )


def _blank(column: str) -> str:
    return f"({column} IS NULL OR trim({column}) = '')"


_FINITE = "(amount IS NOT NULL AND NOT isnan(amount) AND NOT isinf(amount))"

_PARSED = f"""
parsed AS (
  SELECT *, trim(event_type) AS kind,
    try_strptime(trim(event_time), '%Y-%m-%d %H:%M:%S UTC') AS ts,
    {_id("product_id")} AS product, {_id("category_id")} AS category, {_id("user_id")} AS "user",
    TRY_CAST(trim(price) AS DOUBLE) AS amount
  FROM raw_rows
),
judged AS (
  SELECT *, (_corrupt_record IS NOT NULL OR {_blank("event_time")} OR ts IS NULL
    OR {_blank("event_type")} OR kind NOT IN ({_TYPES})
    OR {_blank("product_id")} OR product IS NULL
    OR (NOT {_blank("category_id")} AND category IS NULL)
    OR (NOT {_blank("user_id")} AND "user" IS NULL)
    OR (NOT {_blank("price")} AND NOT {_FINITE})) AS bad
  FROM parsed
),
silver AS (
  SELECT any_value(ts) AS event_time, any_value(kind) AS event_type,
    any_value(product) AS product_id, any_value(category) AS category_id,
    any_value(nullif(trim(category_code), '')) AS category_code,
    any_value(nullif(trim(brand), '')) AS brand, any_value(amount) AS price,
    any_value("user") AS user_id, any_value(nullif(trim(user_session), '')) AS user_session,
    min(source_file) AS source_file, strftime(any_value(ts), '%Y-%m') AS event_month,
    CASE WHEN any_value(amount) IS NULL THEN 'missing' WHEN any_value(amount) <= 0
         THEN 'nonpositive' ELSE 'positive' END AS price_quality
  FROM judged j WHERE NOT bad
  GROUP BY {", ".join("j." + name for name in RAW_COLUMNS)}
)"""


def _funnel(prefix: str, events: str) -> str:
    """First view, then two left joins with a minimum each."""
    return f"""
{prefix}_ev AS ({events}),
{prefix}_v AS (
  SELECT user_session, min(event_time) AS view_time FROM {prefix}_ev
  WHERE event_type = 'view' GROUP BY user_session
),
{prefix}_c AS (
  SELECT v.user_session, v.view_time, min(e.event_time) AS cart_time
  FROM {prefix}_v v LEFT JOIN {prefix}_ev e ON e.user_session = v.user_session
    AND e.event_type = 'cart' AND e.event_time >= v.view_time
  GROUP BY v.user_session, v.view_time
),
{prefix} AS (
  SELECT c.user_session, c.view_time, c.cart_time, min(e.event_time) AS purchase_time,
         strftime(c.view_time, '%Y-%m') AS event_month
  FROM {prefix}_c c LEFT JOIN {prefix}_ev e ON e.user_session = c.user_session
    AND e.event_type = 'purchase' AND e.event_time >= c.cart_time
  GROUP BY c.user_session, c.view_time, c.cart_time
)"""


_FUNNELS = (
    _funnel(
        "pf",
        "SELECT trim(user_session) AS user_session, ts AS event_time, kind AS event_type "
        "FROM parsed WHERE _corrupt_record IS NULL AND ts IS NOT NULL "
        f"AND NOT {_blank('user_session')} AND kind IN ('view', 'cart', 'purchase')",
    )
    + ","
    + _funnel(
        "sf",
        "SELECT user_session, event_time, event_type FROM silver "
        "WHERE user_session IS NOT NULL AND event_type IN ('view', 'cart', 'purchase')",
    )
)

_PURCHASES = """
bought AS (
  SELECT event_month, CAST(event_time AS DATE) AS purchase_date_utc,
    CAST(extract('hour' FROM event_time) AS INTEGER) AS utc_hour,
    coalesce(category_code, '[sin categoría]') AS category_code, price, price_quality
  FROM silver WHERE event_type = 'purchase'
),
cat_day AS (
  SELECT event_month, purchase_date_utc, category_code, count(*) AS purchase_event_count,
    sum(price) AS estimated_value_sum_price,
    count(*) FILTER (price_quality = 'nonpositive') AS nonpositive_price_events
  FROM bought GROUP BY ALL
),
by_time AS (
  SELECT event_month, purchase_date_utc, utc_hour, count(*) AS purchase_event_count,
    sum(price) AS estimated_value_sum_price
  FROM bought GROUP BY ALL
)"""

_EXAMPLES = f"""
bounds AS (
  SELECT min(ts) AS lo, max(ts) AS hi FROM parsed WHERE _corrupt_record IS NULL
),
starts AS (
  SELECT user_session, min(event_time) AS session_start,
    min(event_time) FILTER (event_type = 'purchase') AS first_purchase_time
  FROM silver WHERE user_session IS NOT NULL GROUP BY user_session
),
eligible AS (
  SELECT s.user_session, session_start, first_purchase_time,
    session_start + INTERVAL {registry.CUTOFF_MINUTES} MINUTE AS cutoff_time,
    strftime(session_start, '%Y-%m') AS event_month,
    CASE WHEN first_purchase_time IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label
  FROM starts s, bounds b
  WHERE session_start >= lo + INTERVAL {registry.CUTOFF_MINUTES} MINUTE
    AND session_start <= hi - INTERVAL {registry.CUTOFF_MINUTES} MINUTE
    AND strftime(session_start + INTERVAL {registry.CUTOFF_MINUTES} MINUTE, '%Y-%m')
        = strftime(session_start, '%Y-%m')
    AND (first_purchase_time IS NULL
         OR first_purchase_time >= session_start + INTERVAL {registry.CUTOFF_MINUTES} MINUTE)
),
feats AS (
  SELECT s.user_session,
    count(*) FILTER (s.event_type = 'view') AS views,
    count(*) FILTER (s.event_type = 'cart') AS carts,
    count(*) FILTER (s.event_type = 'remove_from_cart') AS removals,
    count(DISTINCT product_id) FILTER (s.event_type = 'view') AS products,
    count(DISTINCT category_code) FILTER (s.event_type = 'view') AS categories,
    avg(price) FILTER (s.event_type = 'view' AND price_quality = 'positive') AS view_price
  FROM silver s JOIN eligible e ON s.user_session = e.user_session
  WHERE s.event_time < e.cutoff_time AND s.event_type <> 'purchase'
  GROUP BY s.user_session
),
examples AS (
  SELECT e.user_session, e.event_month, e.session_start, e.first_purchase_time, e.label,
    ln(1 + coalesce(views, 0)) AS log_views_5m,
    ln(1 + coalesce(carts, 0)) AS log_carts_5m,
    ln(1 + coalesce(removals, 0)) AS log_removals_5m,
    ln(1 + coalesce(products, 0)) AS log_unique_products_5m,
    ln(1 + coalesce(categories, 0)) AS log_unique_categories_5m,
    coalesce(view_price, 0.0) AS mean_view_price_5m,
    sin(extract('hour' FROM session_start) * 2 * pi() / 24) AS hour_sin,
    cos(extract('hour' FROM session_start) * 2 * pi() / 24) AS hour_cos,
    sin(extract('dow' FROM session_start) * 2 * pi() / 7) AS weekday_sin,
    cos(extract('dow' FROM session_start) * 2 * pi() / 7) AS weekday_cos
  FROM eligible e LEFT JOIN feats f ON e.user_session = f.user_session
),
scored AS (
  SELECT label, 1.0 / (1.0 + exp(-({registry.INTERCEPT} + {" + ".join(
      f"({weight}) * {name}" for name, weight in registry.COEFFICIENTS.items())}))) AS probability
  FROM examples
),
judged_scores AS (
  SELECT label, probability, CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS predicted,
    CAST(least(9, floor(probability * 10)) AS INTEGER) AS score_bin
  FROM scored
),
matrix AS (
  SELECT count(*) FILTER (label = 1 AND predicted = 1) AS true_positive,
    count(*) FILTER (label = 0 AND predicted = 1) AS false_positive,
    count(*) FILTER (label = 0 AND predicted = 0) AS true_negative,
    count(*) FILTER (label = 1 AND predicted = 0) AS false_negative
  FROM judged_scores
)"""

_WITH = "WITH " + ",".join((_CLICKS, _PARSED, _FUNNELS, _PURCHASES, _EXAMPLES)) + "\n"

_STAGE_COUNTS = (
    "count(*) AS view_sessions, count(cart_time) AS cart_after_view_sessions, "
    "count(purchase_time) AS purchase_after_cart_sessions"
)
_STAGE_RATES = (
    "count(cart_time) / nullif(count(*), 0)::DOUBLE AS view_to_cart_rate, "
    "count(purchase_time) / nullif(count(*), 0)::DOUBLE AS view_to_purchase_rate, "
    "count(purchase_time) / nullif(count(cart_time), 0)::DOUBLE AS cart_to_purchase_rate"
)
_BRIEF_FUNNEL = (
    "count(*) AS view_sessions, count(cart_time) AS cart_sessions, "
    "count(purchase_time) AS purchase_sessions, "
    "count(purchase_time) / nullif(count(*), 0)::DOUBLE AS view_to_purchase_rate"
)
_DAY = "CAST(extract('dow' FROM {}) + 1 AS INTEGER)"
_HOUR = "CAST(extract('hour' FROM {}) AS INTEGER)"


def _day_name(day: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(WEEKDAY_NAMES_ES, 1))
    return f"CASE {day} {cases} END"


# Rows as they come back from files: what follows an unclosed quote is text of its column.
_CSV_ROWS = f"""
csv_rows AS (
  SELECT {", ".join(RAW_COLUMNS[:4])},
    CASE WHEN _corrupt_record IS NULL THEN category_code ELSE 'rest of line' END AS category_code,
    {", ".join(f"CASE WHEN _corrupt_record IS NULL THEN {name} END AS {name}" for name in RAW_COLUMNS[5:])},
    _corrupt_record, source_file
  FROM raw_rows
)"""
_WITH_CSV = "WITH " + ",".join(
    (_CLICKS, _CSV_ROWS, _PARSED.replace("FROM raw_rows", "FROM csv_rows"), _FUNNELS, _PURCHASES,
     _EXAMPLES)) + "\n"
_NAMED = "CASE source_file " + " ".join(
    f"WHEN '{source}' THEN '{name}'" for source, name in registry.FILE_NAMES.items()) + " END"
# A line has eight commas and a line feed, and a quote where it is broken; a header comes first.
_BYTES = (
    "CAST(sum(9 + CASE WHEN _corrupt_record IS NULL THEN 0 ELSE 1 END + "
    + " + ".join(f"strlen(coalesce({name}, ''))" for name in RAW_COLUMNS)
    + f") + {len(','.join(RAW_COLUMNS)) + 1} * count(DISTINCT source_file) AS BIGINT)"
)
_SAMPLED = (
    f"('0x' || substr(md5(user_session), 1, 8))::BIGINT % 100 < {registry.SAMPLE_PERCENT}"
)


def _measures() -> dict[str, str]:
    intact = "_corrupt_record IS NULL"
    count = "count(*) FILTER ({})".format
    measures = {"record_count": "count(*)"}
    for name in RAW_COLUMNS:
        measures[f"missing_{name}"] = count(_blank(name))
        measures[f"whitespace_{name}"] = count(f"NOT {_blank(name)} AND {name} <> trim({name})")
    measures["corrupt_records"] = count("_corrupt_record IS NOT NULL")
    measures["invalid_timestamps"] = count(f"NOT {_blank('event_time')} AND ts IS NULL")
    measures["unexpected_events"] = count(
        f"NOT {_blank('event_type')} AND kind NOT IN ({_TYPES})"
    )
    for raw, typed in (("product_id", "product"), ("category_id", "category"), ("user_id", '"user"')):
        measures[f"invalid_{raw}"] = count(f"NOT {_blank(raw)} AND {typed} IS NULL")
        measures[f"nonpositive_{raw}"] = count(f"{typed} <= 0")
    measures["invalid_price"] = count(f"NOT {_blank('price')} AND NOT {_FINITE}")
    measures["nonpositive_price"] = count(f"{_FINITE} AND amount <= 0")
    measures["valid_price_count"] = count(f"{intact} AND {_FINITE}")
    measures["purchase_price_sum"] = (
        f"round(sum(amount) FILTER ({intact} AND kind = 'purchase' AND {_FINITE}), 2)"
    )
    measures["purchase_events"] = count(f"{intact} AND kind = 'purchase'")
    measures["rows_with_session"] = count(f"NOT {_blank('user_session')}")
    measures["period_min"] = f"min(ts) FILTER ({intact})"
    measures["period_max"] = f"max(ts) FILTER ({intact})"
    return measures


def _select_measures(*names: str, tail: str = "") -> str:
    measures = _measures()
    return (
        "SELECT "
        + ", ".join(f"{measures[name]} AS {name}" for name in names)
        + f" FROM parsed{tail}"
    )


_HOURS = (
    "(SELECT date_trunc('hour', ts) AS hour_utc, count(*) AS events FROM parsed "
    "WHERE _corrupt_record IS NULL AND ts IS NOT NULL GROUP BY ALL)"
)
_PRICES = f"(SELECT amount FROM parsed WHERE _corrupt_record IS NULL AND {_FINITE})"
_QUARTILES = """count(*) AS valid_numeric_count, min(amount) AS "min",
  quantile_disc(amount, 0.25) AS q1, quantile_disc(amount, 0.5) AS median,
  quantile_disc(amount, 0.75) AS q3, max(amount) AS "max" """
_PICKED_DAYS = """(SELECT * FROM cat_day WHERE event_month IN ('2024-01', '2024-02')
  AND purchase_date_utc BETWEEN DATE '2024-01-10' AND DATE '2024-02-20')"""
_TOP = f"""SELECT coalesce(nullif(trim(category_code), ''), '[sin categoría]') AS category_code,
  count(*) AS purchase_event_count,
  round(sum(amount) FILTER ({_FINITE}), 2) AS estimated_value_sum_price,
  count(*) FILTER (NOT {_FINITE}) AS purchase_events_without_valid_price
FROM parsed WHERE _corrupt_record IS NULL AND kind = 'purchase'
GROUP BY 1 ORDER BY purchase_event_count DESC, category_code LIMIT """


def _kpis(days: str, months: str) -> str:
    return f"""SELECT
  (SELECT CAST(coalesce(sum(purchase_event_count), 0) AS BIGINT) FROM {days} d) AS purchase_events,
  (SELECT round(coalesce(sum(estimated_value_sum_price), 0.0), 2) FROM {days} d)
    AS estimated_value,
  count(*) AS view_sessions,
  count(purchase_time) / nullif(count(*), 0)::DOUBLE AS view_to_purchase_rate
FROM sf WHERE event_month IN ({months})"""


def _sql() -> dict[str, str]:
    per_file = (
        "record_count",
        "period_min",
        "period_max",
        "corrupt_records",
        "invalid_timestamps",
        *[f"missing_{name}" for name in RAW_COLUMNS],
    )
    known_type = f"NOT {_blank('event_type')}"
    counted = f"FROM parsed WHERE _corrupt_record IS NULL AND {known_type}"
    matrix_columns = ", ".join(
        [f"count(*) FILTER (kind = '{name}') AS {name}" for name in EVENT_TYPES]
        + [f"count(*) FILTER (kind NOT IN ({_TYPES})) AS other"]
    )
    return {
        "parsed_events": "SELECT * FROM parsed",
        "quality_missing": _select_measures(*[f"missing_{c}" for c in RAW_COLUMNS]),
        "quality_whitespace": _select_measures(*[f"whitespace_{c}" for c in RAW_COLUMNS]),
        "quality_validity": _select_measures(
            "record_count",
            "corrupt_records",
            "invalid_timestamps",
            "unexpected_events",
            "invalid_product_id",
            "invalid_category_id",
            "invalid_user_id",
            "invalid_price",
            "valid_price_count",
            "purchase_events",
            "purchase_price_sum",
        ),
        "quality_nonpositive": _select_measures(
            "nonpositive_product_id",
            "nonpositive_category_id",
            "nonpositive_user_id",
            "nonpositive_price",
        ),
        "session_coverage": f"""SELECT
  count(*) FILTER (NOT {_blank("user_session")}) AS rows_with_session,
  count(*) FILTER (NOT {_blank("user_session")}) / nullif(count(*), 0)::DOUBLE AS session_fraction
FROM parsed""",
        "period": _select_measures("period_min", "period_max"),
        "quality_combined_from_files": _select_measures(*_measures()),
        "event_counts": f"SELECT kind AS event_type, count(*) AS events {counted} GROUP BY ALL",
        "file_overview": _select_measures(*per_file, tail=" GROUP BY source_file").replace(
            "SELECT ", "SELECT source_file, ", 1
        ),
        "file_event_counts": (
            f"SELECT source_file, kind AS event_type, count(*) AS events {counted} GROUP BY ALL"
        ),
        "file_event_matrix": f"SELECT source_file, {matrix_columns} {counted} GROUP BY source_file",
        "file_inventory": f"""SELECT {_NAMED} AS source_file, count(*) AS record_count,
  min(ts) FILTER (_corrupt_record IS NULL) AS from_utc,
  max(ts) FILTER (_corrupt_record IS NULL) AS to_utc,
  {", ".join(
      f"count(*) FILTER (_corrupt_record IS NULL AND kind = '{name}') AS {name}_events"
      for name in EVENT_TYPES)},
  count(*) FILTER (_corrupt_record IS NULL AND {known_type} AND kind NOT IN ({_TYPES}))
    AS other_events,
  (SELECT '{{' || string_agg('"' || t.kind || '":' || t.n, ',' ORDER BY t.kind) || '}}'
   FROM (SELECT source_file AS f, kind, count(*) AS n {counted} GROUP BY ALL) t
   WHERE t.f = any_value(p.source_file)) AS events_by_type,
  (SELECT {_BYTES} FROM raw_rows r WHERE r.source_file = any_value(p.source_file)) AS file_bytes
FROM parsed p GROUP BY p.source_file""",
        "file_sizes": f"""SELECT {_NAMED} AS source_file, {_BYTES} AS file_bytes
FROM raw_rows GROUP BY source_file""",
        "source_names": f"""SELECT {_NAMED} AS source_file, count(*) AS record_count,
  true AS accepted, true AS empty_refused, true AS equal_names_refused, true AS nothing_refused
FROM raw_rows GROUP BY source_file""",
        "column_catalogue": " UNION ALL ".join(
            f"SELECT '{name}' AS name, 'string' AS csv_storage_type, '{kind}' AS analysis_type, "
            f"count(*) FILTER (NOT {_blank(name)}) AS filled_rows FROM raw_rows"
            for name, kind in SEMANTIC_TYPES.items()
        ),
        "price_summary_empty": """SELECT form, 0::BIGINT AS valid_numeric_count,
  NULL::DOUBLE AS "min", NULL::DOUBLE AS q1, NULL::DOUBLE AS median, NULL::DOUBLE AS q3,
  NULL::DOUBLE AS "max", NULL::DOUBLE AS iqr_lower_fence, NULL::DOUBLE AS iqr_upper_fence,
  0::BIGINT AS iqr_outlier_candidate_count FROM (VALUES ('exact'), ('sketch')) v(form)""",
        "quantile_rank_errors": f"""SELECT quantile, p::DOUBLE AS p,
  (SELECT count(*) FROM {_PRICES}) AS price_rows, true AS within_one_percent
FROM (VALUES ('min', 0.0), ('q1', 0.25), ('median', 0.5), ('q3', 0.75), ('max', 1.0)) v(quantile, p)""",
        "silver_month_rerun": f"""SELECT event_month, count(*) AS row_count, true AS same_files
FROM silver WHERE event_month <> '{registry.TEST_MONTH}' GROUP BY ALL
UNION ALL
SELECT '{registry.TEST_MONTH}', count(*), false FROM (SELECT DISTINCT {_RAW} FROM judged
  WHERE NOT bad AND source_file = 'part-a.csv' AND strftime(ts, '%Y-%m') = '{registry.TEST_MONTH}')""",
        "model_stationary": f"""SELECT 11::BIGINT AS terms, true AS stationary,
  count(*) FILTER (label = 0) AS negatives, count(*) FILTER (label = 1) AS positives
FROM examples WHERE event_month = '{registry.TRAIN_MONTH}'""",
        "model_round_trip": f"""SELECT count(*) AS sessions, 0::BIGINT AS differ_when_loaded,
  0::BIGINT AS differ_from_coefficients
FROM examples WHERE event_month = '{registry.TEST_MONTH}'""",
        "model_document": f"""SELECT
  count(*) FILTER (train AND sampled AND label = 0) AS train_negatives,
  count(*) FILTER (train AND sampled AND label = 1) AS train_positives,
  count(*) FILTER (test AND label = 0) AS test_negatives,
  count(*) FILTER (test AND label = 1) AS test_positives,
  (SELECT count(*) FROM silver WHERE user_session IS NOT NULL AND {_SAMPLED}) AS sampled_event_rows,
  count(*) FILTER (sampled) AS sampled_sessions, count(*) FILTER (test) AS judged_sessions,
  count(*) FILTER (test) AS binned_sessions, 10::BIGINT AS coefficients
FROM (SELECT label, {_SAMPLED} AS sampled, event_month = '{registry.TRAIN_MONTH}' AS train,
        event_month = '{registry.TEST_MONTH}' AS test FROM examples)""",
        "session_sample": """SELECT user_session, count(*) AS events FROM silver
WHERE user_session IS NOT NULL AND ('0x' || substr(md5(user_session), 1, 8))::BIGINT % 100 < 20
GROUP BY user_session""",
        "profile_overview": _select_measures(
            "record_count", "corrupt_records", "invalid_timestamps", "unexpected_events",
            *[f"missing_{c}" for c in RAW_COLUMNS], *[f"whitespace_{c}" for c in RAW_COLUMNS],
            *[f"invalid_{c}" for c in ("product_id", "category_id", "user_id", "price")],
            *[f"nonpositive_{c}" for c in ("product_id", "category_id", "user_id")],
            "rows_with_session", "valid_price_count", "purchase_events",
        ).replace(" FROM parsed", f""",
  (SELECT {_BYTES} FROM raw_rows) AS file_bytes,
  (SELECT count(*) FROM (SELECT 1 FROM raw_rows GROUP BY {_RAW}, _corrupt_record HAVING count(*) > 1))
    AS duplicate_groups,
  (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM raw_rows
    GROUP BY {_RAW}, _corrupt_record)) AS duplicate_excess_rows,
  (SELECT count(*) FROM {_HOURS}) AS observed_utc_hours,
  (SELECT count(DISTINCT extract('hour' FROM hour_utc)) FROM {_HOURS}) AS hours_of_day,
  (SELECT count(*) FROM pf) AS view_sessions, (SELECT count(cart_time) FROM pf)
    AS cart_after_view_sessions,
  (SELECT count(purchase_time) FROM pf) AS purchase_after_cart_sessions,
  strftime(min(ts) FILTER (_corrupt_record IS NULL), '%Y-%m-%dT%H:%M:%SZ') AS period_min,
  strftime(max(ts) FILTER (_corrupt_record IS NULL), '%Y-%m-%dT%H:%M:%SZ') AS period_max,
  (SELECT min(amount) FROM {_PRICES}) AS least_price,
  (SELECT max(amount) FROM {_PRICES}) AS greatest_price,
  (SELECT category_code FROM ({_TOP}1)) AS top_category FROM parsed"""),
        "silver_audit": f"""SELECT count(*) AS source_rows,
  count(*) FILTER (bad) AS rejected_rows,
  count(*) FILTER (NOT bad) AS valid_rows_before_dedup,
  count(*) FILTER (_corrupt_record IS NOT NULL) AS corrupt_rows,
  count(*) FILTER ({_blank("event_time")} OR ts IS NULL) AS invalid_timestamp_rows,
  count(*) FILTER ({_blank("event_type")} OR kind NOT IN ({_TYPES}))
    AS unexpected_event_type_rows,
  count(*) FILTER (NOT {_blank("price")} AND NOT {_FINITE}) AS invalid_price_rows,
  count(*) FILTER ({_FINITE} AND amount <= 0) AS nonpositive_price_rows,
  count(*) FILTER ({_blank("category_code")}) AS missing_category_code_rows,
  count(*) FILTER ({_blank("brand")}) AS missing_brand_rows,
  count(*) FILTER ({_blank("user_session")}) AS missing_user_session_rows,
  count(*) FILTER (NOT {_blank("product_id")} AND product IS NULL) AS invalid_product_id_rows,
  count(*) FILTER (NOT {_blank("category_id")} AND category IS NULL) AS invalid_category_id_rows,
  count(*) FILTER (NOT {_blank("user_id")} AND "user" IS NULL) AS invalid_user_id_rows
FROM judged""",
        "silver_events": "SELECT * FROM silver",
        "rejected_rows": f"SELECT {_RAW}, _corrupt_record, source_file FROM judged WHERE bad",
        "row_fingerprints": f"""SELECT sha256(to_json({{{", ".join(
            f"'{name}': {name}" for name in (*RAW_COLUMNS, "_corrupt_record"))}}})::VARCHAR)
  AS fingerprint, count(*) AS copies FROM raw_rows GROUP BY ALL""",
        "duplicate_summary": f"""SELECT count(*) AS duplicate_groups,
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_excess_rows
FROM (SELECT count(*) AS n FROM raw_rows GROUP BY {_RAW}, _corrupt_record) WHERE n > 1""",
        "price_quantiles_exact": f"SELECT {_QUARTILES} FROM {_PRICES}",
        "price_flags": f"""SELECT amount, amount < q1 - 1.5 * (q3 - q1)
    OR amount > q3 + 1.5 * (q3 - q1) AS is_outlier, count(*) AS price_rows
FROM {_PRICES}, (SELECT {_QUARTILES} FROM {_PRICES}) q GROUP BY 1, 2""",
        "price_outliers_exact": f"""SELECT q.valid_numeric_count, q."min", q.q1, q.median, q.q3,
  q."max", round(q1 - 1.5 * (q3 - q1), 6) AS iqr_lower_fence,
  round(q3 + 1.5 * (q3 - q1), 6) AS iqr_upper_fence,
  (SELECT count(*) FROM {_PRICES} WHERE amount < q1 - 1.5 * (q3 - q1)
     OR amount > q3 + 1.5 * (q3 - q1)) AS iqr_outlier_candidate_count
FROM (SELECT {_QUARTILES} FROM {_PRICES}) q""",
        "activity_cube": """SELECT source_file, kind AS event_type,
  date_trunc('hour', ts) AS hour_utc, count(*) AS events
FROM parsed WHERE _corrupt_record IS NULL GROUP BY ALL""",
        "events_per_hour": f"SELECT hour_utc, events FROM {_HOURS}",
        "events_per_hour_of_day": f"""SELECT {_HOUR.format("hour_utc")} AS hour,
  CAST(sum(events) AS BIGINT) AS events FROM {_HOURS} GROUP BY 1""",
        "events_per_day": f"""SELECT CAST(hour_utc AS DATE) AS date_utc,
  CAST(sum(events) AS BIGINT) AS events FROM {_HOURS} GROUP BY 1""",
        "frequency_stats": f"""SELECT CAST(sum(events) AS BIGINT) AS valid_timestamp_events,
  count(*) AS observed_utc_hours, avg(events) AS mean_events_per_observed_utc_hour,
  max(events) AS max_events_in_observed_utc_hour FROM {_HOURS}""",
        "funnel_sessions": "SELECT * FROM pf",
        "silver_funnel_sessions": "SELECT * FROM sf",
        "funnel_totals": f"SELECT {_STAGE_COUNTS}, {_STAGE_RATES} FROM pf",
        "funnel_by_hour": (
            f"SELECT {_HOUR.format('view_time')} AS utc_hour, {_BRIEF_FUNNEL} FROM pf GROUP BY 1"
        ),
        "funnel_by_weekday": f"""SELECT weekday_number,
  {_day_name("weekday_number")} AS weekday_name_es, {_BRIEF_FUNNEL}
FROM (SELECT *, {_DAY.format("view_time")} AS weekday_number FROM pf) GROUP BY weekday_number""",
        "funnel_by_month": (
            f"SELECT event_month, {_STAGE_COUNTS}, {_STAGE_RATES} FROM sf GROUP BY event_month"
        ),
        "funnel_by_utc_weekday_hour": f"""SELECT event_month,
  {_DAY.format("view_time")} AS spark_weekday_sunday_1, {_HOUR.format("view_time")} AS utc_hour,
  {_STAGE_COUNTS}, {_STAGE_RATES} FROM sf GROUP BY 1, 2, 3""",
        "top_purchase_categories": _TOP + "20",
        "report_top_categories": _TOP + "10",
        "purchases_by_hour": f"""SELECT {_HOUR.format("ts")} AS hour, count(*) AS events
FROM parsed WHERE _corrupt_record IS NULL AND kind = 'purchase' AND ts IS NOT NULL GROUP BY 1""",
        "purchases_by_weekday": f"""SELECT weekday_number, count(*) AS events,
  {_day_name("weekday_number")} AS weekday_name_es
FROM (SELECT {_DAY.format("ts")} AS weekday_number FROM parsed
      WHERE _corrupt_record IS NULL AND kind = 'purchase' AND ts IS NOT NULL)
GROUP BY weekday_number""",
        "purchases_by_category": """SELECT category_code, count(*) AS purchase_event_count,
  round(sum(price), 2) AS estimated_value_sum_price,
  count(*) FILTER (price_quality = 'nonpositive') AS nonpositive_price_events
FROM bought GROUP BY category_code""",
        "purchases_by_category_day": """SELECT * REPLACE (
  round(estimated_value_sum_price, 2) AS estimated_value_sum_price) FROM cat_day""",
        "purchases_by_utc_time": """SELECT * REPLACE (
  round(estimated_value_sum_price, 2) AS estimated_value_sum_price) FROM by_time""",
        "session_eligibility": "SELECT * FROM eligible",
        "session_examples": f"""SELECT user_session, event_month, session_start,
  first_purchase_time, label, {", ".join(
      f"round({name}, 9) + 0.0 AS {name}" for name in registry.sessions.FEATURES)} FROM examples""",
        "class_weights": f"""SELECT count(*) FILTER (label = 0) AS negatives,
  count(*) FILTER (label = 1) AS positives,
  count(*) / nullif(2 * count(*) FILTER (label = 0), 0)::DOUBLE AS negative_weight,
  count(*) / nullif(2 * count(*) FILTER (label = 1), 0)::DOUBLE AS positive_weight
FROM examples WHERE event_month = '{registry.TRAIN_MONTH}'""",
        "score_confusion": "SELECT * FROM matrix",
        "score_areas": """SELECT
  round(sum(neg * (tp - pos / 2.0) / nullif(p_all * n_all, 0)), 9) AS roc_auc,
  round(sum(pos::DOUBLE / nullif(p_all, 0) * (tp::DOUBLE / (tp + fp)
    + CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos)::DOUBLE / nullif(tp - pos + fp - neg, 0)
      ELSE tp::DOUBLE / (tp + fp) END) / 2), 9) AS pr_auc
FROM (SELECT pos, neg, (sum(pos) OVER down)::DOUBLE AS tp, (sum(neg) OVER down)::DOUBLE AS fp,
    (sum(pos) OVER ())::DOUBLE AS p_all, (sum(neg) OVER ())::DOUBLE AS n_all
  FROM (SELECT round(probability, 10) AS probability, count(*) FILTER (label = 1) AS pos,
          count(*) FILTER (label = 0) AS neg
        FROM judged_scores GROUP BY 1)
  WINDOW down AS (ORDER BY probability DESC))""",
        "score_rates": """SELECT p AS "precision", r AS recall,
  coalesce(2 * p * r / nullif(p + r, 0), 0.0) AS f1, a AS accuracy
FROM (SELECT true_positive / nullif(true_positive + false_positive, 0)::DOUBLE AS p,
  true_positive / nullif(true_positive + false_negative, 0)::DOUBLE AS r,
  (true_positive + true_negative) / nullif(true_positive + false_positive + true_negative
    + false_negative, 0)::DOUBLE AS a FROM matrix)""",
        "score_bins": """SELECT score_bin, CAST(label AS INTEGER) AS actual_label,
  count(*) AS sessions FROM judged_scores GROUP BY 1, 2""",
        "score_calibration": """SELECT score_bin, count(*) AS sessions,
  count(*) FILTER (label = 1) / count(*)::DOUBLE AS observed_positive_rate
FROM judged_scores GROUP BY score_bin""",
        "confusion_grid": """SELECT 1 AS actual_label, 1 AS predicted_label,
  true_positive AS sessions FROM matrix
UNION ALL SELECT 0, 1, false_positive FROM matrix
UNION ALL SELECT 0, 0, true_negative FROM matrix
UNION ALL SELECT 1, 0, false_negative FROM matrix""",
        "filter_domains": """SELECT DISTINCT 'month' AS domain, event_month AS value FROM sf
UNION ALL SELECT DISTINCT 'category', category_code FROM bought
UNION ALL SELECT 'first_date', CAST(min(purchase_date_utc) AS VARCHAR) FROM bought
UNION ALL SELECT 'last_date', CAST(max(purchase_date_utc) AS VARCHAR) FROM bought""",
        "slice_kpis": _kpis(_PICKED_DAYS, "'2024-01', '2024-02'"),
        "slice_category_kpis": _kpis(
            "(SELECT * FROM cat_day WHERE event_month = '2024-02' "
            "AND category_code = 'economy.red.widget')",
            "'2024-02'",
        ),
        "funnel_stages": """SELECT event_month, 'view_sessions' AS stage, count(*) AS sessions
FROM sf WHERE event_month IN ('2024-01', '2024-02') GROUP BY event_month
UNION ALL SELECT event_month, 'cart_after_view_sessions', count(cart_time)
FROM sf WHERE event_month IN ('2024-01', '2024-02') GROUP BY event_month
UNION ALL SELECT event_month, 'purchase_after_cart_sessions', count(purchase_time)
FROM sf WHERE event_month IN ('2024-01', '2024-02') GROUP BY event_month""",
        "slice_purchases_by_date": f"""SELECT purchase_date_utc,
  CAST(sum(purchase_event_count) AS BIGINT) AS purchase_events
FROM {_PICKED_DAYS} GROUP BY purchase_date_utc""",
        "slice_top_categories": f"""SELECT category_code,
  CAST(sum(purchase_event_count) AS BIGINT) AS purchase_event_count,
  round(coalesce(sum(estimated_value_sum_price), 0.0), 2) AS estimated_value_sum_price
FROM {_PICKED_DAYS} GROUP BY category_code
ORDER BY 2 DESC, category_code LIMIT 15""",
        "conversion_grid": f"""SELECT CAST(d AS INTEGER) AS weekday_number,
  CAST(h AS INTEGER) AS utc_hour, count(s.user_session) AS view_sessions,
  count(purchase_time) AS purchase_sessions,
  count(purchase_time) / nullif(count(s.user_session), 0)::DOUBLE AS conversion_rate
FROM range(1, 8) days(d) CROSS JOIN range(24) hours(h)
LEFT JOIN (SELECT * FROM sf WHERE event_month IN ('2024-01', '2024-02')) s
  ON {_DAY.format("s.view_time")} = d AND {_HOUR.format("s.view_time")} = h
GROUP BY d, h""",
        "slice_purchases_by_hour": """SELECT CAST(h AS INTEGER) AS utc_hour,
  count(category_code) AS purchase_events
FROM range(24) hours(h)
LEFT JOIN (SELECT * FROM bought WHERE event_month IN ('2024-01', '2024-02')
  AND purchase_date_utc BETWEEN DATE '2024-01-10' AND DATE '2024-02-20') b ON b.utc_hour = h
GROUP BY h""",
        "five_v_report": f"""SELECT v, metric, round(value, 9) AS value FROM (
SELECT 'Volume' AS v, 'record_count' AS metric, count(*)::DOUBLE AS value FROM parsed
UNION ALL SELECT 'Velocity', 'observed_utc_hours', count(*)::DOUBLE FROM {_HOURS}
UNION ALL SELECT 'Velocity', 'mean_events_per_observed_utc_hour', avg(events) FROM {_HOURS}
UNION ALL SELECT 'Variety', 'columns', 9.0::DOUBLE
UNION ALL SELECT 'Veracity', 'missing_category_code',
  (count(*) FILTER ({_blank("category_code")}))::DOUBLE FROM parsed
UNION ALL SELECT 'Veracity', 'duplicate_excess_rows', coalesce(sum(n - 1), 0)::DOUBLE
  FROM (SELECT count(*) AS n FROM raw_rows GROUP BY {_RAW}, _corrupt_record)
UNION ALL SELECT 'Value', 'view_to_purchase_rate',
  count(purchase_time) / nullif(count(*), 0)::DOUBLE FROM pf)""",
        "csv_corrupt_scan": """SELECT kind AS event_type, count(*) AS record_count,
  count(*) FILTER (_corrupt_record IS NOT NULL) AS corrupt_records FROM parsed GROUP BY kind""",
        "medallion_audit": f"""SELECT a.source_rows, a.rejected_rows, a.valid_rows_before_dedup,
  {", ".join("a." + name for name in registry.AUDIT_COUNTS)},
  (SELECT count(*) FROM silver) AS silver_rows,
  a.valid_rows_before_dedup - (SELECT count(*) FROM silver) AS duplicate_excess_rows_removed,
  2::BIGINT AS input_files, (SELECT {_BYTES} FROM raw_rows) AS input_bytes,
  (SELECT count(DISTINCT event_month) FROM sf) AS funnel_by_month,
  (SELECT count(*) FROM (SELECT DISTINCT event_month, {_DAY.format("view_time")},
    {_HOUR.format("view_time")} FROM sf)) AS funnel_by_utc_weekday_hour,
  (SELECT count(DISTINCT category_code) FROM bought) AS purchases_by_category,
  (SELECT count(*) FROM cat_day) AS purchases_by_category_day,
  (SELECT count(*) FROM by_time) AS purchases_by_utc_time
FROM (@silver_audit@) a""",
        "header_contract": """SELECT * FROM (VALUES ('exact', true), ('upper case', false),
  ('swapped', false), ('missing', false)) AS v(header_case, accepted)""",
        "medallion_roundtrip": f"""SELECT 'silver' AS table_name, count(*) AS row_count,
  round(sum(price), 2) AS measure FROM silver
UNION ALL SELECT 'funnel_by_month', count(DISTINCT event_month), count(*)::DOUBLE FROM sf
UNION ALL SELECT 'funnel_by_utc_weekday_hour', count(DISTINCT (event_month,
  {_DAY.format("view_time")}, {_HOUR.format("view_time")})), count(*)::DOUBLE FROM sf
UNION ALL SELECT 'purchases_by_category', count(DISTINCT category_code), round(sum(price), 2)
  FROM bought
UNION ALL SELECT 'purchases_by_category_day', count(*),
  round(sum(estimated_value_sum_price), 2) FROM cat_day
UNION ALL SELECT 'purchases_by_utc_time', count(*),
  round(sum(estimated_value_sum_price), 2) FROM by_time""",
    }


# Queries whose rows go through files.
_FROM_FILES = ("file_inventory", "medallion_audit", "profile_overview")


def oracle_sql() -> dict[str, str]:
    known = _sql()
    known["medallion_audit"] = known["medallion_audit"].replace("@silver_audit@", known["silver_audit"])
    return {name: (_WITH_CSV if name in _FROM_FILES else _WITH) + body for name, body in known.items()}
