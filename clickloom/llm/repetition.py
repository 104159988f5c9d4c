"""Quality rules on repetition inside a text, by a suffix array over its words.

Suffixes of a text, as rows of words, are sorted by prefix doubling: in each round only suffixes
that are not yet told apart are sorted again by what follows. Neighbours in the sorted order share
their longest common prefix, and runs of neighbours that share at least so many words are the
intervals of that length. An interval that no longer one encloses at a suffix gives the longest
repeat which starts there: the greater of the two values beside it. The union of these spans is
what repeats in the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import map_rows, slices

# Base rules.
WINDOW, FEWEST_WORDS, REPEATED_PERCENT = 5, 10, 20
# The method's limits: repeats of so many words count; their share of the words, and the longest.
REPEAT_WORDS, COVERED_PERCENT, LONGEST_WORDS = 10, 19, 40

_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"


def repeat_lengths(words: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """At each word, the words of the longest stretch from there that its text has elsewhere too.

    ``words`` are numbers of words, ``texts`` the ascending number of the text of each. Memory is
    four bytes a word for each doubling, of which there are as many as the longest repeat needs.
    """
    count = len(words)
    if not count:
        return np.zeros(0, np.int64)
    ends = np.searchsorted(texts, texts, side="right")
    # The rank of a suffix is the place in the sorted order where its group of equals begins.
    key = texts.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    rank = np.empty(count, np.int32)
    rank[order] = _group_starts(key[order])
    levels = [rank]
    active = np.flatnonzero(np.bincount(rank, minlength=count)[rank] > 1)
    reach = 1
    while len(active):
        after = active + reach
        inside = after < ends[active]
        second = np.where(inside, rank[np.minimum(after, count - 1)].astype(np.int64) + 1, 0)
        key = rank[active].astype(np.int64) * (count + 1) + second
        order = np.argsort(key, kind="stable")
        old = rank[active][order]
        finer = old + _group_starts(key[order]) - _group_starts(old)
        rank = rank.copy()
        rank[active[order]] = finer
        levels.append(rank)
        active = active[np.bincount(finer, minlength=count)[rank[active]] > 1]
        reach *= 2
    suffixes = np.empty(count, np.int64)
    suffixes[rank] = np.arange(count)
    # Common prefixes of neighbours, of those that share the first word at all.
    left, right = suffixes[:-1], suffixes[1:]
    common = np.zeros(count + 1, np.int64)
    at = np.flatnonzero(levels[0][left] == levels[0][right])
    a, b = left[at], right[at]
    shared, limit = np.zeros(len(at), np.int64), ends[a]
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        same = (x < limit) & (y < limit)
        same &= levels[level][np.minimum(x, count - 1)] == levels[level][np.minimum(y, count - 1)]
        shared += same.astype(np.int64) << level
    common[at + 1] = shared
    longest = np.empty(count, np.int64)
    longest[suffixes] = np.maximum(common[:-1], common[1:])
    return longest


def _group_starts(ordered: np.ndarray) -> np.ndarray:
    """For sorted values, the index of the first equal one."""
    first = np.empty(len(ordered), bool)
    first[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))


def covered_words(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeated stretch of at least so many words."""
    starts = np.flatnonzero(longest >= least)
    steps = np.zeros(len(longest) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + longest[starts], -1)
    return np.cumsum(steps[:-1]) > 0


def measures(texts: list[str]) -> dict[str, np.ndarray]:
    """What the rules look at, one number for each text."""
    split = [text.encode().split() for text in texts]
    n_words = np.array([len(words) for words in split], np.int64)
    numbers: dict[bytes, int] = {}
    give = numbers.setdefault
    words = np.array([give(w, len(numbers)) for some in split for w in some], np.int64)
    owner = np.repeat(np.arange(len(texts)), n_words)
    longest = repeat_lengths(words, owner)

    def per_text(marks: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=marks, minlength=len(texts)).astype(np.int64)

    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, owner, longest)
    return {
        "n_words": n_words,
        "word_chars": np.array(
            [len(t) - sum(map(t.count, _SPACES)) for t in texts], np.int64
        ),
        "n_symbols": np.array([sum(map(t.count, _SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([_repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": per_text(covered_words(longest, WINDOW)),
        "n_covered_words": per_text(covered_words(longest, REPEAT_WORDS)),
        "longest_repeat": top,
    }


def _repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def repetition_rules(
    docs: DataFrame,
    covered_percent: int = COVERED_PERCENT,
    longest_words: int = LONGEST_WORDS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Measures and verdict of every text: ``doc_id``, the columns of :func:`measures`,
    ``base_failed`` and ``kept``, and the columns named in ``carry``.

    No shuffle; a text is judged alone. A null or empty text has no words and fails. Repeated rows
    and null ids are kept as they are; other columns are ignored.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "n_covered_words", "longest_repeat"]
    others = [F.col(name) for name in carry]
    columns = docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("whole_text"), "doc_id", *others
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            found = measures(batch.column(0).to_pylist())
            total = found["n_words"]
            failed = (total < FEWEST_WORDS) | (
                100 * found["n_repeat_words"] > REPEATED_PERCENT * total
            )
            kept = (
                ~failed
                & (100 * found["n_covered_words"] <= covered_percent * total)
                & (found["longest_repeat"] <= longest_words)
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array(found[n]) for n in names), pa.array(failed),
                 pa.array(kept)],
                names=["doc_id", *carry, *names, "base_failed", "kept"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in columns.schema.fields[1:]}
    schema = ", ".join(
        [f"`{name}` {kind}" for name, kind in kinds.items()]
        + [f"{name} long" for name in names]
        + ["base_failed boolean", "kept boolean"]
    )
    return map_rows(columns, schema, work)
