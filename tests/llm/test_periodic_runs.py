import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import periodic_runs, queries
from clickloom.llm.common import table
from tests.llm.conftest import ODD_TEXTS

SPACES = " \t\n\v\f\r"


def words_of(text):
    for space in SPACES[1:]:
        text = text.replace(space, " ")
    return [word for word in text.split(" ") if word]


def runs_by_hand(words):
    """Every stretch, for each distance, whose words come again there; the smallest distance of
    each stretch counts."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end + period - at >= max(6, 4 * period):
                found.setdefault((at, end + period), period)
            at = end + 1
    return sorted((start, end - start, period) for (start, end), period in found.items())


def collapsed_by_hand(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [word for i, word in enumerate(words) if i not in gone]


def draw_words(draw):
    words = []
    while len(words) < draw.choice([0, 3, 8, 60, 250]):
        unit = [draw.randint(0, draw.choice([1, 2, 5, 900])) for _ in range(draw.choice([1, 2, 3, 7, 16, 31]))]
        words += (unit * draw.choice([1, 1, 4, 5, 9]))[: draw.randint(1, 150)]
    return words


@pytest.mark.parametrize("seed", range(80))
def test_runs_as_by_hand(seed):
    draw = random.Random(seed)
    texts = [draw_words(draw) for _ in range(draw.randint(1, 6))]
    words = np.array([w for text in texts for w in text], np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
    want = [(n, *run) for n, text in enumerate(texts) for run in runs_by_hand(text)]
    assert list(map(tuple, periodic_runs.find_runs(words, owner).tolist())) == want


def fibonacci_words(count):
    one, two = [0], [0, 1]
    while len(two) < count:
        one, two = two, two + one
    return two[:count]


@pytest.mark.parametrize(
    "words",
    [
        [0] * 3000,
        [0, 1] * 1500 + [0],
        (([0] * 40 + [1]) * 9 + [2]) * 5,
        ([0, 1, 2] * 5 + [0]) * 12,
        fibonacci_words(2000),
        list(range(300)) * 4 + [7],
        list(range(300)) * 3 + list(range(299)),
    ],
)
def test_nested_and_long_runs(words):
    found = periodic_runs.find_runs(np.array(words), np.zeros(len(words), np.int64))
    assert [tuple(row[1:]) for row in found.tolist()] == runs_by_hand(words)


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_sums_are_exact(size):
    draw = np.random.default_rng(size)
    blocks = draw.integers(0, 1 << 29, (5, size))
    windows = draw.integers(0, 1 << 29, (5, 2 * size))
    windows[0, size // 2 : size // 2 + size] = blocks[0]
    want = [
        [sum((int(b) - int(w)) ** 2 for b, w in zip(row, window[d : d + size])) % periodic_runs.PRIME
         for d in range(size)]
        for row, window in zip(blocks, windows)
    ]
    found = periodic_runs.mismatch_sums(blocks.astype(np.uint64), windows.astype(np.uint64))
    assert found.tolist() == want and found[0, size // 2] == 0


def test_a_sum_that_the_prime_divides(monkeypatch):
    """With a small prime most sums of zero are none; runs stay right."""
    monkeypatch.setattr(periodic_runs, "PRIME", 257)
    monkeypatch.setattr(periodic_runs, "LARGEST", 128)
    periodic_runs._roots.cache_clear()
    draw = random.Random(5)
    words = [draw.randint(0, 200) for _ in range(60)] + [draw.randint(0, 2) for _ in range(300)] * 4
    found = periodic_runs.find_runs(np.array(words), np.zeros(len(words), np.int64))
    periodic_runs._roots.cache_clear()
    assert [tuple(row[1:]) for row in found.tolist()] == runs_by_hand(words)


@pytest.mark.parametrize("largest", [1, 4, 32])
def test_windows_in_parts(monkeypatch, largest):
    monkeypatch.setattr(periodic_runs, "LARGEST", largest)
    for seed in range(20):
        words = draw_words(random.Random(seed)) or [1]
        found = periodic_runs.find_runs(np.array(words), np.zeros(len(words), np.int64))
        assert [tuple(row[1:]) for row in found.tolist()] == runs_by_hand(words)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_by_hand(doc_id, text):
    words = words_of(text or "")
    if doc_id is not None:
        words = planted(doc_id, words)
    runs = runs_by_hand(words)
    top = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=(None, None, None))
    milli = None if top[0] is None else 1000 * top[1] // top[2]
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    kept = " ".join(collapsed_by_hand(words, runs))
    return (doc_id, len(runs), *top, milli, digest(lines), digest(kept))


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256")


def in_order(rows):
    return sorted(rows, key=repr)


def test_query_as_by_hand_on_a_table(spark, small):
    docs = table(spark, small, "documents").collect()
    found = queries.op13_periodic_runs(spark, small).select(*COLUMNS).collect()
    want = [row_by_hand(row["doc_id"], row["text"]) for row in docs if len(row["text"] or "") < 20000]
    ids = {row[0] for row in want}
    assert len(want) > 150
    assert in_order(tuple(r) for r in found if r["doc_id"] in ids) == in_order(want)
    assert sum(row[1] > 0 for row in want) > 5


def test_odd_rows(spark, docs, clashing):
    rows = clashing(
        docs(*ODD_TEXTS, (None, "x y " * 9), (10, ODD_TEXTS[10]), *[(100 + n, "a b c d e f " * 40) for n in range(40)])
    )
    found = queries.digest_runs(periodic_runs.collapse_runs(queries.plant_runs(rows))).collect()
    want = [row_by_hand(row["doc_id"], row["text"]) for row in rows.collect()]
    assert in_order(tuple(r) for r in found) == in_order(want)
    out = periodic_runs.collapse_runs(rows, carry=("lang", "kept")).where(F.col("doc_id") == 10).first()
    assert (out["collapsed"], out["n_words"], out["kept"]) == ("again and", 6000, "kept")
    assert [tuple(run) for run in out["runs"]] == [(0, 6000, 2)]
    assert periodic_runs.collapse_runs(rows.limit(0)).count() == 0
