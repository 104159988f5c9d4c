"""URL filter by dated lists: each capture is judged by the entries active when it was fetched.

A list is a log of changes: on a day a domain is blocked, allowed or removed. Changes of a domain
become validity intervals, from their day to the day of the next change. A capture meets the
intervals of its host and of all domains above it, the top-level domain included, and the most specific active one decides.

The decision depends on host and day only, so captures are reduced to these first. Intervals are
cut at months, and the as-of join is an equality on domain and month with a range inside: a host
with very many captures or changes spreads over its months, and no pair outside a month is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK, ALLOW, REMOVE = "block", "allow", "remove"
# Of several changes of a domain on one day the strongest holds.
STRENGTH = {REMOVE: 0, ALLOW: 1, BLOCK: 2}


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and a last dot; empty if there is none."""
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#\\]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(found, r"^.*@", ""), r":[0-9]*$", "")
    return F.regexp_replace(bare, r"\.$", "")


def domains_of(host: Column) -> Column:
    """The host and the domains above it that have two labels at least; a lone label as it is."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    starts = F.sequence(F.lit(1), F.greatest(count - 1, F.lit(1)))
    return F.transform(
        starts, lambda at: F.array_join(F.slice(labels, at, count - at + 1), ".")
    )


def asked_domains(host: Column) -> Column:
    """All that an entry can name for a host: :func:`domains_of` and the last label alone."""
    return F.array_union(domains_of(host), F.array(F.substring_index(host, ".", -1)))


def entry_domain(domain: Column) -> Column:
    """An entry's domain as hosts are written: lower case, without blanks around, a leading dot
    or ``*.``, or a last dot."""
    return F.regexp_replace(F.lower(F.trim(domain)), r"^(\*?\.)+|\.$", "")


def _month(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day) - 1).cast("int")


def validity(changes: DataFrame) -> DataFrame:
    """``domain, action, valid_from, valid_to`` (exclusive, null if open) from a log with columns
    ``domain, action, listed_on``. Removals end an interval and begin none. Rows without domain,
    day or known action are no changes; repeated ones count once. Domains are as
    :func:`entry_domain` writes them, and an entry is for a domain and all below it."""
    strength = F.create_map(*[F.lit(x) for pair in STRENGTH.items() for x in pair])
    by_day = (
        changes.where(F.col("action").isin(*STRENGTH))
        .withColumn("domain", entry_domain(F.col("domain")))
        .where("domain <> '' AND listed_on IS NOT NULL")
        .groupBy("domain", F.col("listed_on").alias("valid_from"))
        .agg(F.max_by("action", strength[F.col("action")]).alias("action"))
    )
    following = Window.partitionBy("domain").orderBy("valid_from")
    return (
        by_day.withColumn("valid_to", F.lead("valid_from").over(following))
        .where(F.col("action") != REMOVE)
        .select("domain", "action", "valid_from", "valid_to")
    )


def judge_captures(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """All columns of the captures (``url``, ``fetched_on`` and others) and ``host, domain,
    action, valid_from, valid_to, kept``: the entry that decides, and whether the capture stays.

    A capture without an active entry stays, with null for the entry; so do captures without a
    readable host or without a day. Repeated captures are kept as they are. Columns of the same
    names in the captures are replaced. No entries, or no captures, are fine.
    """
    names = ("host", "domain", "action", "valid_from", "valid_to", "kept")
    own = captures.drop(*names).withColumn("host", host_of(F.col("url")))
    asked = (
        own.where("host <> '' AND fetched_on IS NOT NULL")
        .select("host", F.col("fetched_on").alias("day"))
        .distinct()
    )
    wanted = asked.select(
        "host", "day", F.explode(asked_domains(F.col("host"))).alias("domain")
    ).withColumn("month", _month(F.col("day")))
    # An open interval lasts to the last month that is asked for.
    last = asked.agg(F.max("day").alias("last")).scalar()
    until = F.least(F.coalesce(F.date_sub("valid_to", 1), last), last)
    intervals = (
        validity(changes)
        .withColumn("until", until)
        .where("until >= valid_from")
        .select(
            "domain",
            "action",
            "valid_from",
            "valid_to",
            F.explode(F.sequence(_month(F.col("valid_from")), _month(F.col("until")))).alias(
                "month"
            ),
        )
    )
    active = wanted.join(intervals, ["domain", "month"]).where(
        (F.col("valid_from") <= F.col("day"))
        & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    )
    decided = (
        active.groupBy("host", "day")
        .agg(
            F.max_by(
                F.struct("domain", "action", "valid_from", "valid_to"), F.length("domain")
            ).alias("entry")
        )
        .select("host", F.col("day").alias("fetched_on"), "entry.*")
    )
    return own.join(decided, ["host", "fetched_on"], "left").select(
        *[F.col(name) for name in own.columns if name != "host"],
        "host",
        "domain",
        "action",
        "valid_from",
        "valid_to",
        (F.coalesce("action", F.lit(ALLOW)) != BLOCK).alias("kept"),
    )
