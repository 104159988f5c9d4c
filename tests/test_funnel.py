import re
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from clickloom.operators import funnel
from clickloom.operators.parse import parse_events, profile_session_events, session_events

START = datetime(2019, 10, 31, 23, 0)
SCHEMA = "user_session string, event_time timestamp, event_type string"


def sessions(spark, events):
    rows = [(s, START + timedelta(seconds=t), kind) for s, t, kind in events]
    return funnel.funnel_sessions(session_events(spark.createDataFrame(rows, SCHEMA)))


def brute_force(events):
    """Walk each session's events in the plainest way."""
    found = {}
    for session in {s for s, _, _ in events}:
        times = {
            kind: sorted(t for s, t, k in events if s == session and k == kind)
            for kind in ("view", "cart", "purchase")
        }
        if not times["view"]:
            continue
        view = times["view"][0]
        cart = next((t for t in times["cart"] if t >= view), None)
        bought = cart is not None and next((t for t in times["purchase"] if t >= cart), None)
        found[session] = (view, cart, bought if bought is not False else None)
    return found


def seconds(time):
    return None if time is None else int((time - START).total_seconds())


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.sampled_from("abc"),
            st.integers(0, 9).map(lambda n: n * 14400),
            st.sampled_from(["view", "cart", "purchase", "remove_from_cart"]),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_same_as_brute_force(spark, events):
    found = {
        r["user_session"]: tuple(seconds(r[c]) for c in ("view_time", "cart_time", "purchase_time"))
        for r in sessions(spark, events).collect()
    }
    assert found == brute_force(events)


def test_purchase_before_cart_does_not_convert(spark):
    totals = funnel.funnel_totals(
        funnel.funnel_by_utc_weekday_hour(
            sessions(spark, [("a", 0, "view"), ("a", 60, "purchase"), ("a", 120, "cart")])
        )
    ).first()
    assert [totals[stage] for stage in funnel.STAGES] == [1, 1, 0]
    assert totals["cart_to_purchase_rate"] == 0.0


def test_stages_in_the_same_second_count(spark):
    found = sessions(spark, [("a", 5, "purchase"), ("a", 5, "cart"), ("a", 5, "view")]).first()
    assert found["view_time"] == found["cart_time"] == found["purchase_time"]


def test_month_is_that_of_the_first_view(spark):
    found = sessions(spark, [("a", 0, "view"), ("a", 7200, "cart"), ("a", 7300, "view")]).first()
    assert found["event_month"] == "2019-10"
    assert found["cart_time"] == datetime(2019, 11, 1, 1, 0)


def test_no_cart_gives_no_rate(spark):
    by_month = funnel.funnel_by(sessions(spark, [("a", 0, "view")]), "event_month").first()
    assert by_month["view_to_cart_rate"] == 0.0
    assert by_month["cart_to_purchase_rate"] is None


def test_rolled_up_counts_equal_direct_counts(spark):
    events = [
        (f"s{i}", i * 977 + step * 60, kind)
        for i in range(40)
        for step, kind in enumerate(("view", "cart", "purchase")[: 1 + i % 3])
    ]
    found = sessions(spark, events)
    fine = funnel.funnel_by_utc_weekday_hour(found)
    for coarse, direct in (
        (funnel.funnel_by_month(fine), funnel.funnel_by(found, "event_month")),
        (funnel.funnel_totals(fine), funnel.funnel_by(found)),
    ):
        assert sorted(coarse.collect()) == sorted(direct.collect())


def test_bad_price_stays_in_the_profile_funnel(bronze):
    rows = parse_events(bronze({"price": "x", "user_session": " s "}, {"_corrupt_record": "line"}))
    found = funnel.funnel_sessions(profile_session_events(rows)).collect()
    assert [r["user_session"] for r in found] == ["s"]


def test_hot_session_is_shrunk_before_it_is_gathered(spark):
    """A third of all rows is one session: it leaves no more rows than it has moments."""
    n = 90_000
    events = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "bot").otherwise((F.col("id") / 9).cast("int").cast("string"))
        .alias("user_session"),
        (F.lit(START) + F.make_dt_interval(secs=(F.col("id") % 600).cast("decimal(18,6)")))
        .alias("event_time"),
        F.when(F.col("id") % 2 == 0, "view").when(F.col("id") % 5 == 0, "cart").otherwise("purchase")
        .alias("event_type"),
    )
    bot = funnel.funnel_sessions(events).where("user_session = 'bot'").first()
    facts = events.where("user_session = 'bot'")
    view = facts.where("event_type = 'view'").agg(F.min("event_time")).first()[0]
    cart = facts.where((F.col("event_type") == "cart") & (F.col("event_time") >= view)).agg(
        F.min("event_time")
    ).first()[0]
    assert (bot["view_time"], bot["cart_time"]) == (view, cart)


def test_a_session_of_ten_million_moments_spreads_over_days(spark):
    """They meet the session's row in 117 groups, and none has more of them than a day has seconds."""
    n = 10_000_000
    events = spark.range(n, numPartitions=8).select(
        F.lit("bot").alias("user_session"),
        F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id")).alias("event_time"),
        F.when(F.col("id") == 7_000_000, "view")
        .when(F.col("id") % 2 == 0, "purchase")
        .otherwise("cart")
        .alias("event_type"),
    )
    days = events.groupBy(F.to_date("event_time")).count().agg(F.count("*"), F.max("count")).first()
    assert tuple(days) == (117, 86_400)
    found = funnel.funnel_sessions(events).first()
    at = [int(found[c].timestamp()) - 1_600_000_000 for c in ("view_time", "cart_time", "purchase_time")]
    assert at == [7_000_000, 7_000_001, 7_000_002]


def test_plan_has_no_window_and_meets_sessions_by_day(spark):
    plan = sessions(spark, [("a", 0, "view")])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_" not in plan and "ObjectHashAggregate" not in plan
    meetings = re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[(.*?)\], \[.*?\], Inner", plan)
    assert len(meetings) >= 2 and all("user_session" in keys and "day" in keys for keys in meetings)


def test_a_view_after_the_last_event_and_far_days(spark):
    day = 86_400
    found = sessions(spark, [
        ("a", 0, "cart"), ("a", 40 * day, "view"),
        ("b", 0, "view"), ("b", 400 * day, "cart"), ("b", 800 * day, "purchase"), ("b", 2, "purchase"),
    ])
    times = {r["user_session"]: [seconds(r[c]) for c in ("view_time", "cart_time", "purchase_time")] for r in found.collect()}
    assert times == {"a": [40 * day, None, None], "b": [0, 400 * day, 800 * day]}
