"""Exact duplicates, by merging sorted runs of digests up a tree and sending answers down it.

Each input partition is a leaf. Its digests, sorted and with equal ones merged, are its run. In a
round, WAYS neighbouring partitions exchange their runs: a digest's hash picks which of them merges
it, so each merges a part of the digests of all, and none sees everything. After some rounds one
group holds all partitions, and each digest has met all of its equals. A round with WAYS = 2 ** k
does the work of k rounds of a binomial exchange between pairs in one shuffle.

An entry is a 64-bit digest, by which runs are ordered and dealt, the whole SHA-256, which verifies
that entries are equal before they are merged, the smallest identifier and the number of rows. As
every partition and every round passes on one entry for equal texts, a text that fills the corpus
is WAYS entries for each merge. On the way down, an entry meets only the entries it was made from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.llm.common import kept, text_of

WAYS = 16
SPACE = r"[\x20\x09-\x0D]+"


def normalized(text: Column) -> Column:
    """Each stretch of white space as one space."""
    return F.regexp_replace(text, SPACE, " ")


def _merged(runs: DataFrame) -> DataFrame:
    """One entry for each verified digest of a group. The minimum of a struct is aggregated over
    sorted rows: each task sorts and merges its part first, and the sorted parts meet."""
    return runs.groupBy("group", "short", "digest").agg(
        F.min("first").alias("first"), F.sum("n").alias("n")
    )


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, short, digest, group`` (the input partition) and ``row``, unique numbers."""
    digest = F.unhex(F.sha2(normalized(text_of()), 256))
    return docs.select(
        "doc_id",
        digest.alias("digest"),
        F.spark_partition_id().alias("group"),
        F.monotonically_increasing_id().alias("row"),
    ).select("doc_id", F.xxhash64("digest").alias("short"), "digest", "group", "row")


def exact_duplicates(docs: DataFrame, ways: int = WAYS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each row, dropped ones too.

    Texts are equal when they are after each stretch of white space is one space; a null text is
    empty. Of equal texts the row with the smallest ``doc_id`` stays, and ``keep_id`` is its id; a
    null id comes after all others, and ``keep_id`` is null only if all are. Of rows equal in text
    and id just one stays. Other columns are ignored; no rows give none.
    """
    rows = kept(digests(docs), "digests")
    last = rows.agg(F.max("group")).first()[0] or 0
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    leaves = rows.select("group", "short", "digest", first.alias("first"), F.lit(1).alias("n"))
    levels = [kept(_merged(leaves), "run")]
    while last:
        last //= ways
        up = levels[-1].withColumn("group", F.floor(F.col("group") / ways).cast("int"))
        levels.append(kept(_merged(up), "run"))
    # Down again: what the group above knows of a digest replaces what was known below.
    answer = levels.pop()
    key = ["group", "short", "digest"]
    while levels:
        below = levels.pop().select(*key, F.floor(F.col("group") / ways).cast("int").alias("up"))
        answer = (
            below.join(answer.withColumnRenamed("group", "up"), ["up", "short", "digest"])
            .drop("up")
        )
    return rows.join(answer, key).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, ways: int = WAYS) -> DataFrame:
    """The rows of ``docs`` that stay, with all of their columns.

    Texts are shuffled once, by id and digest, to meet the decisions. Rows equal in both are merged
    before that; of those, which white space may still tell apart, the one with the least text
    stays."""
    stays = exact_duplicates(docs, ways).where("kept").select("doc_id", "text_sha256")
    merged = (
        docs.select(
            F.struct(*docs.columns).alias("whole"),
            F.col("doc_id").alias("key_id"),
            F.sha2(normalized(text_of()), 256).alias("key_digest"),
            text_of().alias("whole_text"),
        )
        .groupBy("key_id", "key_digest")
        .agg(F.min_by("whole", "whole_text").alias("whole"))
    )
    met = merged.join(
        stays,
        F.col("key_id").eqNullSafe(stays["doc_id"]) & (F.col("key_digest") == stays["text_sha256"]),
        "left_semi",
    )
    return met.select(*(F.col(f"whole.{name}").alias(name) for name in docs.columns))
