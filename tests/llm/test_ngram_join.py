import itertools
import random

import pytest

from clickloom.llm import ngram_join
from tests.llm.conftest import ODD_TEXTS


def shingles(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def components_by_hand(rows):
    """Smallest id that links reach, by comparing all pairs."""
    sets = {i: shingles(text) for i, text in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def corpus(seed, near):
    """Texts of common words, copies, near copies in chains, and a passage in many of them."""
    draw = random.Random(seed)
    words = [f"w{n}" for n in range(60)]
    passage = " ".join(f"p{n}" for n in range(25))
    texts = []
    for _ in range(60):
        own = " ".join(draw.choices(words, k=draw.randint(1, 60)))
        texts.append(own + (f" {passage}" if draw.random() < 0.4 else ""))
    base = [f"b{n}" for n in range(90)]
    for _ in range(near):
        copy = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 2, 3, 4])):
            copy[draw.randrange(len(copy))] = f"n{draw.randrange(10**6)}"
        texts.append(" ".join(copy[draw.choice([0, 0, 1, 3]) :]))
    texts += draw.choices(texts, k=20)
    texts += [text.upper() for text in draw.choices(texts, k=5)]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "near", "partitions"), [(1, 70, 3), (2, 120, 16)])
def test_components_as_by_hand(spark, docs, seed, near, partitions):
    texts = [*ODD_TEXTS, *corpus(seed, near)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        found = ngram_join.near_duplicates(docs(*texts)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found}
    assert got == components_by_hand([*enumerate(texts)])


def test_odd_rows_and_one_of_each(docs, clashing):
    rows = clashing(docs(*ODD_TEXTS, (None, "one"), (4, ODD_TEXTS[4]), (20, "One"), (3, "one")))
    found = ngram_join.near_duplicates(rows).collect()
    assert len(found) == len(ODD_TEXTS) + 4
    by_id = {row["doc_id"]: row["component_id"] for row in found}
    assert by_id[None] is None and by_id[20] == 3 and by_id[5] == 4
    assert [by_id[i] for i in range(3)] == [0, 1, 2]
    kept = ngram_join.keep_one(rows)
    assert kept.columns == rows.columns
    ids = [row["doc_id"] for row in kept.collect()]
    assert sorted(ids, key=str) == sorted([i for i in range(12) if i != 5] + [None], key=str)


def test_no_rows(docs):
    assert ngram_join.near_duplicates(docs("x").limit(0)).count() == 0
    assert ngram_join.keep_one(docs("x").limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 99), (100, 101), (103, 102)]
    found = ngram_join.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {
        **{i: 0 for i in range(61)}, 99: 99, 100: 99, 101: 99, 102: 102, 103: 102,
    }


def test_one_of_several_texts_under_one_id(docs):
    """The same one on every run, and in any order of rows."""
    text = " ".join(f"w{n}" for n in range(40))
    rows = [(1, f"{text} b"), (1, f"{text} a"), (1, f"{text} a"), (2, f"{text} c"), (3, "other words")]
    for order in (rows, rows[::-1]):
        for parts in (1, 5):
            kept = ngram_join.keep_one(docs(*order).repartition(parts)).collect()
            assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, f"{text} a"), (3, "other words")]
