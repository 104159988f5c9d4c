import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.llm import digest_merge
from tests.llm.conftest import ODD_TEXTS


def by_hand(rows):
    """One row for each pair of id and text."""
    groups = defaultdict(list)
    for at, (doc_id, text) in enumerate(rows):
        normal = re.sub("[\x20\x09-\x0d]+", " ", text or "")
        groups[hashlib.sha256(normal.encode()).hexdigest()].append((doc_id is None, doc_id, at))
    out = []
    for digest, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1] or 0, m[2]))
        for nth, (_, doc_id, _) in enumerate(members):
            out.append((doc_id, members[0][1], len(members), nth == 0, digest))
    return sorted(out, key=repr)


def found(frame, ways=digest_merge.WAYS):
    return sorted(map(tuple, digest_merge.exact_duplicates(frame, ways).collect()), key=repr)


ROWS = [
    (9, "same  words\there"), (3, "same words here"), (5, " same words here"), (None, "same words here"),
    (3, "same\nwords here"), (7, None), (8, ""), (None, "nameless"), (None, "nameless"),
    (11, "a\x1cb"), (12, "a b"), (13, "a\x85b"), (14, "a\xa0b"), (-5, "A b"), (2, " "), (1, "\t\n"),
]


@pytest.mark.parametrize("parts, ways", [(1, 16), (7, 2), (7, 16), (40, 4)])
def test_groups_as_by_hand(docs, parts, ways):
    rows = ROWS + list(enumerate(ODD_TEXTS, 100)) + [(1000 - n, "hot text") for n in range(300)]
    assert found(docs(*rows).repartition(parts), ways) == by_hand(rows)


def test_odd_tables(docs, clashing):
    rows = docs(*ROWS)
    assert found(clashing(rows)) == by_hand(ROWS)
    assert found(rows.limit(0)) == []
    assert found(rows.withColumn("text", F.lit(None).cast("string"))) == by_hand([(i, None) for i, _ in ROWS])


def test_dropped_rows_keep_their_columns(docs, clashing):
    rows = clashing(docs(*ROWS))
    out = digest_merge.drop_copies(rows, 2)
    assert out.columns == rows.columns
    wanted = [(i, h) for i, _, _, stays, h in by_hand(ROWS) if stays]
    got = [
        (r["doc_id"], hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", r["text"] or "").encode()).hexdigest())
        for r in out.collect()
    ]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert next(r["text"] for r in out.collect() if r["doc_id"] == 3) == "same\nwords here"


def test_a_short_digest_alone_merges_nothing(spark, docs, monkeypatch):
    """Entries with one 64-bit digest and different SHA-256 stay apart."""
    real = digest_merge.digests
    monkeypatch.setattr(digest_merge, "digests", lambda d: real(d).withColumn("short", F.lit(1).cast("long")))
    assert found(docs(*ROWS).repartition(5), 2) == by_hand(ROWS)


def test_a_hot_text_is_few_entries_in_each_merge(spark):
    """Of a text that fills the table, a merge reads one entry for each of the runs it merges."""
    rows = spark.range(100_000, numPartitions=32).select(F.col("id").alias("doc_id"), F.lit("hot").alias("text"))
    leaves = digest_merge.digests(rows).select(
        "group", "short", "digest", F.struct("doc_id", "row").alias("first"), F.lit(1).alias("n")
    )
    level = digest_merge._merged(leaves)
    assert level.count() == 32
    up = level.withColumn("group", F.floor(F.col("group") / 4).cast("int"))
    assert up.groupBy("group", "short").count().agg(F.max("count")).first()[0] == 4
    one = digest_merge.exact_duplicates(rows, 4).agg(F.sum(F.col("kept").cast("int")), F.max("keep_id"), F.min("group_size")).first()
    assert tuple(one) == (1, 0, 100_000)
