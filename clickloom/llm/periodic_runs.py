"""Periodic runs of words, by convolution of blocks with the words after them.

A run with smallest period ``q`` is sought at the dyadic scale ``L`` with ``L <= q < 2 L``. The words
are cut into blocks of ``L``. A run of four periods holds a whole block that comes again ``q`` words
later, so each block is compared with the window of the words ``L`` to ``3 L`` after its start. For
all distances at once, the sum of squared differences of word numbers is

    sum(block^2) + sum(window^2) - 2 * correlation(block, window)

worked out by number-theoretic transforms modulo a prime. It is zero wherever the block occurs, so
no occurrence is missed; a sum that the prime happens to divide is found out by comparing the words.
Each occurrence's distance is then extended to both sides as far as the period holds.

Two rules leave out blocks without losing a run: in a block inside a run each word comes again in
less than ``2 L`` words, and an occurrence that lies with its block in one run of a smaller scale
has a multiple of that run's period as its distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import map_rows, slices, text_of

LEAST_WORDS, LEAST_PERIODS = 6, 4
SLAB = 1 << 18  # numbers that are transformed at a time, one block at least
LARGEST = 1 << 22  # words of a block; beyond, a window is taken in parts
# A prime with a root of unity of order 2^23, and a generator of its group.
PRIME, GENERATOR = 998244353, 3
_SPACE = r"[ \t-\r]+"


@cache
def _roots(size: int, inverse: bool) -> np.ndarray:
    """The powers of a root of unity of that order, for half a turn."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    powers = np.ones(max(size // 2, 1), np.uint64)
    done = 1
    while done < size // 2:
        powers[done : 2 * done] = powers[:done] * np.uint64(pow(root, done, PRIME)) % PRIME
        done *= 2
    return powers


def transform(rows: np.ndarray) -> np.ndarray:
    """The transform of each row; its values come in bit-reversed order."""
    count, size = rows.shape
    rows = rows.copy()
    half = size // 2
    while half:
        parts = rows.reshape(count, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1]
        total = (low + high) % PRIME
        parts[:, :, 1] = (low + PRIME - high) % PRIME * _roots(2 * half, False) % PRIME
        parts[:, :, 0] = total
        half //= 2
    return rows


def transform_back(rows: np.ndarray) -> np.ndarray:
    count, size = rows.shape
    rows = rows.copy()
    half = 1
    while half < size:
        parts = rows.reshape(count, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1] * _roots(2 * half, True) % PRIME
        total = (low + high) % PRIME
        parts[:, :, 1] = (low + PRIME - high) % PRIME
        parts[:, :, 0] = total
        half *= 2
    return rows * np.uint64(pow(size, PRIME - 2, PRIME)) % PRIME


def mismatch_sums(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each block of L and its window of 2 L numbers, the sums of squared differences modulo
    the prime, at the L shifts at which the block lies in the window."""
    count, size = blocks.shape
    turned = np.zeros_like(windows)
    turned[:, :size] = blocks[:, ::-1]
    product = transform(windows) * transform(turned) % PRIME
    overlap = transform_back(product)[:, size - 1 : 2 * size - 1]
    squares = np.zeros((count, 2 * size + 1), np.uint64)
    np.cumsum(windows * windows % PRIME, axis=1, out=squares[:, 1:])
    in_window = squares[:, size : 2 * size] - squares[:, :size]
    in_block = (blocks * blocks % PRIME).sum(axis=1, keepdims=True)
    return (in_block + in_window + 2 * (PRIME - overlap)) % PRIME


def find_runs(words: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Rows of text, start, length and period for all runs, by text, start and period.

    ``words`` are small numbers of words, ``texts`` the ascending number of the text of each.
    A start counts from the first word of its text.
    """
    count = len(words)
    if not count:
        return np.zeros((0, 4), np.int64)
    first = np.searchsorted(texts, texts)
    lengths = np.searchsorted(texts, texts, side="right") - first
    # Texts are kept apart by marks that occur once; a run through one would not be one.
    place = np.arange(count) + texts
    total = int(place[-1]) + 1
    line = np.full(total, -1, np.int64)
    line[place] = words
    marks = np.flatnonzero(line < 0)
    line[marks] = int(words.max()) + 1 + np.arange(len(marks))
    text_words = np.zeros(total, np.int64)
    text_words[place] = lengths

    order = np.argsort(line, kind="stable")
    again = np.full(total, np.iinfo(np.int64).max)
    same = line[order[1:]] == line[order[:-1]]
    again[order[:-1][same]] = np.diff(order)[same]

    found = np.zeros((0, 3), np.int64)  # start, end, period
    scale, longest = 1, int(lengths.max())
    while LEAST_PERIODS * scale <= longest:
        runs = _runs_of_scale(line, text_words, again, scale, found)
        found = np.concatenate([found, runs])
        scale *= 2
    # One stretch has one smallest period.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[fresh]
    back = np.zeros(total, np.int64)
    back[place] = np.arange(count)
    at = back[found[:, 0]]
    rows = np.stack([texts[at], at - first[at], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _runs_of_scale(
    line: np.ndarray, text_words: np.ndarray, again: np.ndarray, scale: int, known: np.ndarray
) -> np.ndarray:
    total = len(line)
    size = min(scale, LARGEST)  # words of a block; one block for each stretch of scale words
    starts = np.arange(0, total - size + 1, scale)
    repeats = np.zeros(total + 1, np.int64)
    np.cumsum(again < 2 * scale, out=repeats[1:])
    # The furthest end of a known run from before or at each place.
    known = known[known[:, 2] <= size]
    reach = np.zeros(total, np.int64)
    np.maximum.at(reach, known[:, 0], known[:, 1])
    reach = np.maximum.accumulate(reach)
    starts = starts[
        (repeats[starts + size] - repeats[starts] == size)
        & (text_words[starts] >= LEAST_PERIODS * scale)
        & (starts + 2 * scale - 1 + size > reach[starts])
    ]
    if not len(starts):
        return np.zeros((0, 3), np.int64)
    padded = np.concatenate([line, np.full(3 * scale, int(line.max()) + 1)])
    inside = np.arange(size)
    pairs = [np.zeros((0, 2), np.int64)]
    for at in range(0, len(starts), step := max(SLAB // (2 * size), 1)):
        some = starts[at : at + step, None]
        blocks = padded[some + inside].astype(np.uint64)
        for nearest in range(scale, 2 * scale, size):
            windows = padded[some + nearest + np.arange(2 * size)].astype(np.uint64)
            block, shift = np.nonzero(mismatch_sums(blocks, windows) == 0)
            start, distance = some[block, 0], shift + nearest
            new = start + distance + size > reach[start]
            pairs.append(np.stack([distance[new], start[new]], axis=1))
    pairs = np.concatenate(pairs)
    pairs = pairs[_equal_words(padded, pairs[:, 1], pairs[:, 0], size)]
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    # Blocks that touch, at one distance, are one stretch.
    linked = np.zeros(len(pairs) + 1, bool)
    linked[1:-1] = (np.diff(pairs[:, 0]) == 0) & (np.diff(pairs[:, 1]) == size)
    start, end = pairs[~linked[:-1], 1], pairs[~linked[1:], 1] + size
    return _extended(line, start, end, pairs[~linked[:-1], 0], size)


def _equal_words(
    line: np.ndarray, starts: np.ndarray, distances: np.ndarray, size: int
) -> np.ndarray:
    whole = np.ones(len(starts), bool)
    inside = np.arange(size)
    for at in range(0, len(starts), step := max(SLAB // size, 1)):
        some = starts[at : at + step, None] + inside
        whole[at : at + step] = (line[some] == line[some + distances[at : at + step, None]]).all(
            axis=1
        )
    return whole


def _extended(
    line: np.ndarray, start: np.ndarray, end: np.ndarray, distance: np.ndarray, size: int
) -> np.ndarray:
    """Runs around stretches [start, end) whose words come again at a distance."""
    total = len(line)
    start, end = start.copy(), end.copy()
    ahead = np.arange(size)
    for at in range(0, len(start), step := max(SLAB // size, 1)):
        some = np.arange(at, min(at + step, len(start)))
        for side, towards in ((start, -1), (end, 1)):
            active = some
            while len(active):
                places = side[active, None] + (ahead if towards > 0 else -1 - ahead)
                others = places + distance[active, None]
                valid = (places >= 0) & (others < total)
                equal = valid & (line[np.maximum(places, 0) % total] == line[others % total])
                steps = np.where(equal.all(axis=1), size, equal.argmin(axis=1))
                side[active] += towards * steps
                active = active[steps == size]
    end = end + distance
    long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * distance)
    return np.unique(np.stack([start[long], end[long], distance[long]], axis=1), axis=0)


def collapsed_words(count: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of so many words stay when stretches [start, end) go."""
    steps = np.zeros(count + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) == 0


def collapse_runs(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Runs of every text, and the text with the first period of each run only: ``doc_id,
    n_words, runs`` (structs of start, length and period, by start and period), ``collapsed``, and
    the columns named in ``carry``.

    A run is a stretch of words with a smallest period, at least LEAST_WORDS words and
    LEAST_PERIODS periods long, that no word beside it extends. A word goes if it lies in any run
    after that run's first period. Words of ``collapsed`` are joined by single spaces.

    No shuffle: a text is judged alone and whole, in tasks that hold a few texts, or one long one.
    A null, empty or blank text has no words, no runs and an empty collapsed text. Null ids and
    repeated rows are kept as they are; other columns are ignored; no rows give none.
    """
    others = [F.col(name) for name in carry]
    columns = docs.select(text_of().alias("whole_text"), "doc_id", *others)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            # The space before each text gives all of them an empty first piece.
            texts = pc.binary_join_element_wise("", batch.column(0), " ")
            split = pc.split_pattern_regex(texts, _SPACE)
            pieces = split.flatten().dictionary_encode()
            numbers = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy())
            empty = pc.index(pieces.dictionary, "").as_py()
            word = numbers != empty
            words, owner = numbers[word], owner[word]
            counts = np.bincount(owner, minlength=len(batch)).astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)])
            found = find_runs(words, owner)
            text, start, length, period = found.T
            begin = offsets[text] + start
            stay = collapsed_words(len(words), begin + period, begin + length)
            left = np.concatenate([[0], np.cumsum(np.bincount(owner[stay], minlength=len(batch)))])
            lists = pa.ListArray.from_arrays(
                pa.array(left, pa.int32()), pieces.dictionary.take(pa.array(words[stay]))
            )
            per_text = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(batch)))])
            runs = pa.ListArray.from_arrays(
                pa.array(per_text, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(start), pa.array(length), pa.array(period)], fields=list(run)
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(counts), runs, pc.binary_join(lists, " ")],
                names=["doc_id", *carry, "n_words", "runs", "collapsed"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in columns.schema.fields[1:]}
    schema = ", ".join(
        [f"`{name}` {kind}" for name, kind in kinds.items()]
        + [
            "n_words long",
            "runs array<struct<start: long, length: long, period: long>>",
            "collapsed string",
        ]
    )
    return map_rows(columns, schema, work)
